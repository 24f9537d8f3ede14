"""op11: approximate nearest neighbours."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowvigil.llm.nn_descent import nearest_neighbours
from flowvigil.llm.registry import query, table

#: Ids divisible by this are the queries.
EVERY = 50


@query("op11_nearest_neighbours")
def nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest_neighbours(table(spark, sf_dir, "embeddings"), F.col("vec_id") % EVERY == 0)
