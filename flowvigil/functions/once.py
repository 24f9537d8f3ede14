"""Keep a costly column from being computed again."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def once(df: DataFrame, name: str, column: Column) -> DataFrame:
    """Add a column that is computed once per row.

    A later filter on a plain column is pushed below the projection that makes
    it, and computes it a second time there: a JSON parser, or a whole chain of
    rules. Filters stay above an ``explode`` of one element.
    """
    kept = [other for other in df.columns if other != name]
    return df.select(*kept, F.explode(F.array(column)).alias(name))
