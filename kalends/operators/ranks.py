"""Exact order statistics without ordering or shuffling whole groups.

Two rounds of histograms (map-side combined, at most ``BUCKETS`` rows per key) narrow each wanted position
down to a sliver of the value range; only the rows inside it are grouped by value and ordered. Equal values
are counted, not gathered. Rows meet the histograms by key and salt, never by the bare key, so where that join
is shuffled a heavy key is spread over ``SALTS`` tasks. The input is scanned once per step: cut it first if it
is costly to compute.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

BUCKETS = 1024
SLACK = 1e-9
SALTS = 32


@dataclass(frozen=True)
class Wanted:
    """The first value whose running count (or weight) reaches ``target``, an expression of total_n and total_w."""

    target: Column
    weighted: bool = False


def _bucket(low: str, high: str) -> Column:
    share = (F.col("_v") - F.col(low)) / (F.col(high) - F.col(low))
    return F.when(F.col(high) > F.col(low), F.least(F.floor(share * BUCKETS), F.lit(BUCKETS - 1))).otherwise(0).cast("int")


def _lookup(rows: DataFrame, small: DataFrame, keys: Sequence[str], salt: Column | None = None) -> DataFrame:
    """Join on keys that may be null; with ``salt``, of rows whose keys may be heavy: ``small`` is then repeated for each salt."""
    right = small.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in small.columns if c not in keys])
    rule = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys])
    if salt is not None:
        rows = rows.withColumn("_salt", F.pmod(salt, F.lit(SALTS)))
        right = right.withColumn("_r_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))))
        rule &= F.col("_salt") == F.col("_r_salt")
    return rows.join(right, rule).drop(*[f"_r_{k}" for k in keys], "_salt", "_r_salt")


def _holding(table: DataFrame, group: Sequence[str], order: str) -> DataFrame:
    """Add start and end positions of each bucket within its group (on top of _sn, _sw) and keep those that hold the target."""
    before = Window.partitionBy(*group).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    placed = table.withColumn("_en", F.col("_sn") + F.sum("_n").over(before)).withColumn("_ew", F.col("_sw") + F.sum("_ww").over(before))
    return placed.withColumn("_sn", F.col("_en") - F.col("_n")).withColumn("_sw", F.col("_ew") - F.col("_ww"))


def _inside() -> Column:
    counted = (F.col("_sn") < F.col("_target")) & (F.col("_en") >= F.col("_target"))
    # sums of weights in another order may differ in their last digits, so ends are taken loosely
    weighed = (F.col("_sw") * (1 - SLACK) < F.col("_target")) & (F.col("_ew") * (1 + SLACK) >= F.col("_target"))
    return F.when(F.col("_weighted"), weighed).otherwise(counted)


def pick(df: DataFrame, keys: Sequence[str], value: str, wanted: Mapping[str, Wanted], weight: str | None = None) -> DataFrame:
    """One row per key with the value at every wanted position."""
    source = df if keys else df.withColumn("_all", F.lit(1))
    keys = list(keys) or ["_all"]
    rows = source.select(*keys, F.col(value).cast("double").alias("_v"), (F.col(weight) if weight else F.lit(1)).alias("_w"), F.monotonically_increasing_id().alias("_row")).filter("_v is not null")
    sums = (F.count("*").alias("_n"), F.sum("_w").alias("_ww"))
    ends = rows.groupBy(*keys).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"), F.count("*").alias("total_n"), F.sum("_w").alias("total_w"))
    salt = F.xxhash64("_row", "_v", "_w")
    first = _lookup(rows, ends.select(*keys, "_lo", "_hi"), keys, salt).withColumn("_b", _bucket("_lo", "_hi")).drop("_lo", "_hi")
    counts = first.groupBy(*keys, "_b").agg(*sums, F.min("_v").alias("_blo"), F.max("_v").alias("_bhi"))
    zero = counts.withColumn("_sn", F.lit(0).cast("long")).withColumn("_sw", F.col("_ww") * 0)
    goals = F.array(*[
        F.struct(F.lit(name).alias("_name"), want.target.cast("double").alias("_target"), F.lit(want.weighted).alias("_weighted")) for name, want in wanted.items()])
    goal_rows = ends.select(*keys, F.explode(goals).alias("g")).select(*keys, "g.*")
    held = _lookup(_holding(zero, keys, "_b"), goal_rows, keys).filter(_inside()).select(
        *keys, "_b", "_name", "_target", "_weighted", "_blo", "_bhi", "_sn", "_sw")
    group = [*keys, "_name", "_b"]
    second = _lookup(first, held, [*keys, "_b"], salt).withColumn("_c", _bucket("_blo", "_bhi"))
    fixed = ["_target", "_weighted", "_sn", "_sw"]
    slivers = _holding(second.groupBy(*group, "_c", *fixed).agg(*sums), group, "_c").filter(_inside()).select(*group, "_c", "_sn", "_sw")
    last = _lookup(second.drop("_sn", "_sw"), slivers, [*group, "_c"], salt).groupBy(*group, "_c", *fixed, "_v").agg(*sums)
    upto = Window.partitionBy(*group, "_c").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    reached = F.when(F.col("_weighted"), F.col("_sw") + F.col("_cw") >= F.col("_target")).otherwise(F.col("_sn") + F.col("_cn") >= F.col("_target"))
    found = last.withColumn("_cn", F.sum("_n").over(upto)).withColumn("_cw", F.sum("_ww").over(upto)).filter(reached)
    return found.groupBy(*keys).agg(*[F.min(F.when(F.col("_name") == name, F.col("_v"))).alias(name) for name in wanted]).drop("_all")


def weighted_quantile(df: DataFrame, keys: Sequence[str], value: str, weight: str, quantiles: Mapping[str, float]) -> DataFrame:
    """First value whose running weight reaches the quantile of the total weight."""
    at = lambda q: Wanted(F.col("total_w").cast("double") * q * (1 - 1e-12), weighted=True)
    return pick(df, keys, value, {name: at(q) for name, q in quantiles.items()}, weight)


def percentile_nearest_rank(df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Element number ceil(q n), counted from one."""
    at = lambda q: Wanted(F.greatest(F.ceil(F.round(F.col("total_n") * q, 9)), F.lit(1)))
    return pick(df, keys, value, {name: at(q) for name, q in quantiles.items()})


def percentile_linear(df: DataFrame, keys: Sequence[str], value: str, quantiles: Mapping[str, float]) -> DataFrame:
    """Value at position q (n - 1), interpolated between neighbours."""
    spot = lambda q: F.round((F.col("total_n") - 1) * q, 9)
    wanted = {}
    for name, q in quantiles.items():
        wanted[f"_lo_{name}"] = Wanted(F.floor(spot(q)) + 1)
        wanted[f"_hi_{name}"] = Wanted(F.ceil(spot(q)) + 1)
    found = pick(df, keys, value, wanted)
    sizes = df.filter(F.col(value).isNotNull()).groupBy(*keys).agg(F.count("*").alias("total_n"))
    rows = _lookup(found, sizes, list(keys)) if keys else found.withColumn("total_n", sizes.scalar())
    part = lambda q: spot(q) - F.floor(spot(q))
    return rows.select(*keys, *[(F.col(f"_lo_{n}") * (1 - part(q)) + F.col(f"_hi_{n}") * part(q)).alias(n) for n, q in quantiles.items()])


def upper_median(df: DataFrame, keys: Sequence[str], value: str, name: str = "median") -> DataFrame:
    """Element number floor(n / 2), counted from zero."""
    return pick(df, keys, value, {name: Wanted(F.floor(F.col("total_n") / 2) + 1)})
