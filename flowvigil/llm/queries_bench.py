"""op10: benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowvigil.llm.decontaminate import find_contamination
from flowvigil.llm.registry import query, table


@query("op10_decontamination")
def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_contamination(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
