"""Connected components of a link table, by alternating large-star and small-star rounds."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kalends.llm.common import stored


def _state(links: DataFrame) -> tuple:
    row = links.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first()
    return row[0], row[1]


def component_labels(links: DataFrame) -> DataFrame:
    """Label every linked node with the smallest node it reaches.

    ``links`` has two columns of one orderable type, in any direction and with repeats; links to oneself and null ends
    are ignored. Returns ``node`` and ``label`` for every node of a component of two or more, its smallest included.
    Rounds grow with the logarithm of the longest path. A hub's minimum is pre-aggregated before the shuffle, and its
    links are joined, so that adaptive execution can split them. Every round is written to the shared folder.
    """
    a, b = links.columns
    pairs = (
        links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v"))
        .where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col("u") != F.col("v")))
        .distinct()
    )
    pairs = stored(pairs, "links")
    before, now = None, _state(pairs)
    while now != before and now[0]:
        both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u and v > m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v > m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        pairs = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).distinct(), "links")
        before, now = now, _state(pairs)
    members = pairs.select(F.col("u").alias("node"), F.col("v").alias("label"))
    return members.unionByName(pairs.select(F.col("v").alias("node"), F.col("v").alias("label")).distinct())
