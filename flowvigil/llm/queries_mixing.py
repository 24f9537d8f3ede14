"""op3: entropy balancing of sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowvigil.llm.mixing import mix_sources
from flowvigil.llm.registry import query, table


@query("op3_entropy_mixing")
def entropy_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix_sources(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "copies", "rate")
