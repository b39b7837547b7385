"""Pre-release forecasts from first-published values: cells, economies, the global index, and their comparison."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from kalends.functions.months import shift_month
from kalends.functions.numbers import absolute_error_bps, signed_error_bps
from kalends.operators import joins, windows

# Forecast models and the pairs that are compared.
P0, P1, P2, P3, P4 = (
    "P0_EQUAL_HEADLINE", "P1_WEIGHTED_HEADLINE", "P2_CATEGORY_CARRY_FORWARD", "P3_CATEGORY_SEASONAL", "P4_HALF_ENSEMBLE")
PAIRS = ((P3, P2), (P4, P2), (P4, P3), (P2, P1), (P3, P1), (P4, P1))
KEYS = ("origin", "target", "horizon")


def forecast_pairs(panel: DataFrame, calendar: DataFrame, horizons: Sequence[int], window: tuple[str, str], lag: int = 12) -> DataFrame:
    """Rolling origins with a year of history behind both ends and the origin released before the target."""
    months = panel.select("period").distinct()
    pairs = joins.rolling_origin_pairs(months, horizons, window)
    for end in ("origin", "target"):
        seen = months.select(shift_month(F.col("period"), lag).alias(end))
        pairs = pairs.join(seen, end, "left_semi")
    dated = pairs.filter(shift_month(F.col("target"), -lag) <= F.col("origin"))
    first = calendar.select(F.col("period").alias("origin"), F.col("release_date").alias("origin_release"))
    last = calendar.select(F.col("period").alias("target"), F.col("release_date").alias("target_release"))
    return dated.join(first, "origin").join(last, "target").filter("origin_release < target_release").select(*KEYS)


def _models(carry: Column, seasonal: Column, lag: int) -> Column:
    source = F.array_sort(F.array_distinct(F.array(F.col("origin"), shift_month(F.col("target"), -lag), shift_month(F.col("origin"), -lag))))
    row = lambda model, value, periods: F.struct(F.lit(model).alias("model"), value.alias("forecast"), periods.alias("source_periods"))
    return F.array(row(P2, carry, F.array("origin")), row(P3, seasonal, source), row(P4, 0.5 * carry + 0.5 * seasonal, source))


def forecast_cells(panel: DataFrame, pairs: DataFrame, lag: int = 12) -> DataFrame:
    """Carry-forward, seasonal and half-ensemble forecast of every cell, with its truth and the months it read."""
    at = lambda column, name: panel.select("economy", "category", F.col("period").alias(column), F.col("value").alias(name))
    rows = (
        pairs.withColumn("season", shift_month(F.col("target"), -lag)).withColumn("before", shift_month(F.col("origin"), -lag))
        .join(at("origin", "now"), "origin").join(at("target", "truth"), ["target", "economy", "category"])
        .join(at("season", "last_season"), ["season", "economy", "category"]).join(at("before", "year_ago"), ["before", "economy", "category"]))
    seasonal = F.col("last_season") * (F.col("now") / F.col("year_ago"))
    return rows.select(*KEYS, "economy", "category", "truth", F.explode(_models(F.col("now"), seasonal, lag)).alias("m")).select(
        *KEYS, "economy", "category", "m.model", "m.forecast", "truth", "m.source_periods", absolute_error_bps(F.col("m.forecast"), F.col("truth")).alias("bps"))


def forecast_economies(cells: DataFrame, weights: DataFrame, headline: DataFrame, pairs: DataFrame) -> DataFrame:
    """Forecast and truth per economy with weights normalised inside it; P1 carries the headline forward."""
    weighted = cells.join(weights, ["economy", "category"])
    mean = lambda name: F.sum(F.col("weight") * F.col(name)) / F.sum("weight")
    found = weighted.groupBy(*KEYS, "economy", "model").agg(mean("forecast").alias("forecast"), mean("truth").alias("truth"))
    carried = pairs.join(headline.select("economy", F.col("period").alias("origin"), F.col("value").alias("forecast")), "origin")
    truth = found.filter(F.col("model") == P2).select(*KEYS, "economy", "truth")
    top = carried.join(truth, [*KEYS, "economy"]).withColumn("model", F.lit(P1))
    return found.unionByName(top.select(*found.columns)).withColumn("bps", absolute_error_bps(F.col("forecast"), F.col("truth")))


def forecast_global(cells: DataFrame, weights: DataFrame, headline: DataFrame, pairs: DataFrame) -> DataFrame:
    """P0 to P4 forecasts of the global index against its first-published truth."""
    total = lambda name: F.sum(F.col("weight") * F.col(name))
    category = cells.join(weights, ["economy", "category"]).groupBy(*KEYS, "model").agg(
        total("forecast").alias("forecast"), total("truth").alias("truth"), F.array_join(F.array_sort(F.array_distinct(F.flatten(F.collect_set("source_periods")))), "|").alias("source_periods"))
    economy = weights.groupBy("economy").agg(F.sum("weight").alias("w"))
    level = headline.join(economy, "economy").groupBy(F.col("period").alias("origin")).agg(F.avg("value").alias("equal"), F.sum(F.col("value") * F.col("w")).alias("weighted"))
    truth = category.filter(F.col("model") == P2).select(*KEYS, "truth")
    row = lambda model, name: F.struct(F.lit(model).alias("model"), F.col(name).alias("forecast"))
    top = pairs.join(level, "origin").join(truth, list(KEYS)).withColumn("m", F.explode(F.array(row(P0, "equal"), row(P1, "weighted")))).select(
        *KEYS, "m.model", "m.forecast", "truth", F.col("origin").alias("source_periods"))
    return category.unionByName(top).withColumn("signed_bps", signed_error_bps(F.col("forecast"), F.col("truth"))).withColumn("bps", F.abs("signed_bps"))


P95 = "percentile_disc(0.95) within group (order by {0})"


def forecast_metrics(cases: DataFrame, scopes: Sequence[Sequence[str]], by: Sequence[str], signed: bool = False) -> DataFrame:
    """Mean, nearest-rank p95 and maximum error for several scope sets in one pass; ``ALL`` marks a column left out."""
    columns = list(dict.fromkeys(c for names in scopes for c in names))
    measures = [F.count("*").alias("case_count"), F.avg("bps").alias("mean_bps"), F.expr(P95.format("bps")).alias("p95_bps"), F.max("bps").alias("max_bps")]
    if signed:
        measures.append(F.avg("signed_bps").alias("mean_signed_bps"))
    grouped = cases.groupingSets([[*names, *by] for names in scopes], *columns, *by).agg(*[F.grouping(c).alias(f"_g_{c}") for c in columns], *measures)
    named = grouped.withColumns({c: F.when(F.col(f"_g_{c}") == 1, "ALL").otherwise(F.col(c).cast("string")) for c in columns})
    return named.drop(*[f"_g_{c}" for c in columns])


SPLIT_SCOPES = ((), ("split",), ("horizon",), ("split", "horizon"))


def forecast_paired(cases: DataFrame, pairs: Sequence[tuple[str, str]] = PAIRS) -> DataFrame:
    """Fixed model pairs compared case by case, per split and horizon and their totals."""
    names = sorted({m for pair in pairs for m in pair})
    wide = cases.groupBy(*KEYS, "split").pivot("model", names).agg(F.first("bps").alias("bps"), F.first("signed_bps").alias("signed"))
    rows = F.array(*[F.struct(
        F.lit(a).alias("challenger"), F.lit(b).alias("baseline"), (F.col(f"{a}_bps") - F.col(f"{b}_bps")).alias("delta"),
        (F.col(f"{a}_signed") - F.col(f"{b}_signed")).alias("signed_delta")) for a, b in pairs])
    deltas = wide.select(*KEYS, "split", F.explode(rows).alias("p")).select(*KEYS, "split", "p.*").withColumn("sign", F.signum(F.round("delta", 8)))
    n = F.count("*")
    rate = lambda s: F.count_if(F.col("sign") == s) / n
    grouped = deltas.groupingSets([[*names, "challenger", "baseline"] for names in SPLIT_SCOPES], "split", "horizon", "challenger", "baseline").agg(
        F.grouping("split").alias("gs"), F.grouping("horizon").alias("gh"), n.alias("case_count"), F.avg("delta").alias("mean_delta"), F.percentile("delta", 0.5).alias("median_delta"),
        F.expr(P95.format("delta")).alias("p95_delta"), F.max("delta").alias("worst_regression"), F.min("delta").alias("best_improvement"),
        F.avg("signed_delta").alias("mean_signed_delta"), rate(-1).alias("improvement_rate"), rate(1).alias("regression_rate"), rate(0).alias("tie_rate"))
    return grouped.withColumn("split", F.when(F.col("gs") == 1, "ALL").otherwise(F.col("split"))).withColumn(
        "horizon", F.when(F.col("gh") == 1, "ALL").otherwise(F.col("horizon").cast("string"))).drop("gs", "gh")


def model_ranking(metrics: DataFrame) -> DataFrame:
    """Models ranked by (mean, p95, name) per split and horizon; ``metrics`` are the few grouped rows."""
    return windows.ranked_models(metrics, ["split", "horizon"], "mean_bps", "p95_bps")


def ranking_stability(ranking: DataFrame, before: str = "DEVELOPMENT", after: str = "HOLDOUT") -> DataFrame:
    """Whether the order or the winner of the models differs between the two splits, per horizon and overall."""
    order = F.transform(F.array_sort(F.collect_list(F.struct("rank", "model"))), lambda x: x["model"])
    named = lambda split: ranking.filter(F.col("split") == split).groupBy("horizon").agg(order.alias(split.lower()))
    left, right = F.col(before.lower()), F.col(after.lower())
    return named(before).join(named(after), "horizon").select(
        "horizon", F.array_join(left, "|").alias("development_ranking"), F.array_join(right, "|").alias("holdout_ranking"),
        (left != right).alias("ranking_changed"), (left[0] != right[0]).alias("winner_changed"))


def focus_ranking(focus: Sequence[tuple[str, DataFrame]], split: str = "HOLDOUT") -> DataFrame:
    """Rankings of chosen slices of metric tables, under their names."""
    found = None
    for name, metrics in focus:
        rows = metrics.filter(F.col("split") == split).withColumn("focus", F.lit(name)).select(
            "focus", "model", "case_count", "mean_bps", "p95_bps", "max_bps")
        found = rows if found is None else found.unionByName(rows)
    return windows.ranked_models(found, ["focus"], "mean_bps", "p95_bps")
