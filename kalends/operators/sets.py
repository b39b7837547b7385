"""Set operators over case and index tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from kalends.session import dealt


def common_cases(cases: DataFrame, keys: Sequence[str], of: str, count: int) -> DataFrame:
    """Keys that occur for every one of ``count`` models or scenarios."""
    return cases.groupBy(*keys).agg(F.count_distinct(of).alias("_n")).filter(F.col("_n") == count).drop("_n")


def sample_difference(left: DataFrame, right: DataFrame, keys: Sequence[str], rows: int | None = None) -> DataFrame:
    """Rows of one sample that the other lacks, both ways; repeated rows count.

    One grouping serves both ways: rows of the left count up, those of the right down. ``rows`` is how many both have at most;
    where it is given, they are dealt into tasks of bounded size.
    """
    both = left.select(*keys, F.lit(1).alias("_n")).unionByName(right.select(*keys, F.lit(-1).alias("_n")))
    both = both if rows is None else dealt(both, rows, *keys)
    over = both.groupBy(*keys).agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    copies = over.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.abs("_n"))))
    return copies.select(*keys, F.when(F.col("_n") > 0, "LEFT_ONLY").otherwise("RIGHT_ONLY").alias("side"))


def stack_indices(**families: DataFrame) -> DataFrame:
    """Index families under one schema with their name as ``index_id``."""
    result = None
    for name, df in families.items():
        named = df.withColumn("index_id", F.lit(name))
        result = named if result is None else result.unionByName(named)
    return result
