"""op1, op5 and op9: fingerprints, near-duplicates by SimHash, repeated substrings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvigil.llm.multiset_hash import fingerprint_edits
from flowvigil.llm.registry import query, table
from flowvigil.llm.simhash import simhash_components
from flowvigil.llm.substring_dedup import remove_repeats


@query("op1_fingerprints")
def fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint_edits(table(spark, sf_dir, "documents"))


@query("op5_simhash")
def simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash_components(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("fp0"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query("op9_substring_dedup")
def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return remove_repeats(table(spark, sf_dir, "documents")).drop("kept")
