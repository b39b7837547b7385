"""Publication dates, first-published panels, revisions and what vintage does to backtest errors."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from kalends.functions.months import release_lag
from kalends.operators import aggregates, ranks, windows
from kalends.plans.backtest import B4, CASE, outcome_sign

HEADLINE = "HEADLINE"


def publication_availability(headline: DataFrame, calendar: DataFrame) -> DataFrame:
    """Release date and lag of every headline cell."""
    return headline.join(calendar, "period").withColumn("lag_days", release_lag(F.col("period"), F.col("release_date")))


def _relatives(obs: DataFrame, headline: DataFrame, year: int) -> DataFrame:
    cells = aggregates.annual_base_relatives(obs, year, ["economy", "category"]).select("economy", "category", "period", "relative")
    top = aggregates.annual_base_relatives(headline, year, ["economy"]).select("economy", F.lit(HEADLINE).alias("category"), "period", "relative")
    return cells.unionByName(top)


def first_published_panel(first: tuple[DataFrame, DataFrame], final: tuple[DataFrame, DataFrame], calendar: DataFrame, weights: DataFrame,
                          year: int) -> DataFrame:
    """First and final base-year relatives of each category and headline cell, their difference, weight and release date.

    ``first`` and ``final`` are (observations, headline) of the two vintages.
    """
    economy = weights.groupBy("economy").agg(F.sum("weight").alias("economy_weight"))
    cell_weights = weights.join(economy, "economy").unionByName(
        economy.select("economy", F.lit(HEADLINE).alias("category"), F.col("economy_weight").alias("weight"), "economy_weight"))
    left = _relatives(*first, year).withColumnRenamed("relative", "first_relative")
    right = _relatives(*final, year).withColumnRenamed("relative", "final_relative")
    delta = (F.col("first_relative") - F.col("final_relative")) * 10000
    return left.join(right, ["economy", "category", "period"]).join(cell_weights, ["economy", "category"]).join(calendar, "period").select(
        "economy", "category", "period", F.col("release_date").alias("available_from"), "first_relative", "final_relative",
        delta.alias("revision_bps"), "weight", "economy_weight")


def first_published_index(panel: DataFrame) -> DataFrame:
    """Equal headline, weighted headline and category index of the first-published values."""
    top = F.col("category") == HEADLINE
    x = F.col("first_relative")
    return panel.groupBy("period").agg(
        (100 * F.avg(F.when(top, x))).alias("equal_headline"), (100 * F.sum(F.when(top, x * F.col("weight")))).alias("weighted_headline"),
        (100 * F.sum(F.when(~top, x * F.col("weight")))).alias("category_index"))


def revision_summary(panel: DataFrame) -> DataFrame:
    """How many cells were revised and by how much; p95 is the nearest rank."""
    size = F.abs("revision_bps")
    revised = outcome_sign(size) != 0
    facts = panel.agg(
        F.count("*").alias("observations"), F.count_if(revised).alias("revised"), F.count_if(~revised).alias("unchanged"),
        F.avg(size).alias("mean_revision"), F.max(size).alias("max_revision"))
    tail = ranks.percentile_nearest_rank(panel.select(size.alias("size")), [], "size", {"p95": 0.95})
    return facts.withColumn("p95_revision", tail.scalar())


def model_errors(cases: DataFrame, safeguarded: DataFrame) -> DataFrame:
    """bps of every case under B0 to B4, long."""
    own = cases.select(*CASE, "model", "bps")
    return own.unionByName(safeguarded.select(*CASE, F.lit(B4).alias("model"), F.col("b4_bps").alias("bps")))


def release_time_cases(errors: DataFrame, calendar: DataFrame) -> DataFrame:
    """Cases with the release dates of origin and target: what was known, and when the estimate is made."""
    start = calendar.select(F.col("period").alias("origin"), F.col("release_date").alias("origin_available_from"))
    end = calendar.select(F.col("period").alias("target"), F.col("release_date").alias("as_of"))
    return errors.join(start, "origin").join(end, "target")


def split_metrics(errors: DataFrame, split) -> DataFrame:
    """Mean, nearest-rank p95 and maximum per split and model, with all splits together, in one pass."""
    rows = errors.withColumn("split", split).filter("split is not null")
    return aggregates.scoped_rollup(rows, (("ALL", ()), ("SPLIT", ("split",))), ["model"], [
        F.count("*").alias("case_count"), F.avg("bps").alias("mean_bps"), F.expr("percentile_disc(0.95) within group (order by bps)").alias("p95_bps"),
        F.max("bps").alias("max_bps")]).drop("scope").withColumn("split", F.when(F.col("split") == "*", "ALL").otherwise(F.col("split")))


def vintage_sensitivity(first: DataFrame, final: DataFrame) -> DataFrame:
    """The same cases on first and final values: errors, their difference and outcome rates by model and scope."""
    other = final.select("case_id", "model", F.col("bps").alias("final_bps"))
    rows = first.join(other, ["case_id", "model"]).withColumn("delta", F.col("bps") - F.col("final_bps"))
    scopes = [("overall", F.lit("ALL"))] + [(n, F.col(n).cast("string")) for n in ("scenario", "horizon", "economy", "category")]
    scope = F.filter(F.array(*[F.struct(F.lit(n).alias("dimension"), c.alias("label")) for n, c in scopes]), lambda s: s["label"] != "")
    p95 = lambda name: F.expr(f"percentile_disc(0.95) within group (order by {name})")
    n, sign = F.count("*"), outcome_sign(F.col("delta"))
    return rows.withColumn("s", F.explode(scope)).groupBy("model", F.col("s.dimension").alias("dimension"), F.col("s.label").alias("label")).agg(
        n.alias("case_count"), F.avg("bps").alias("first_mean"), F.avg("final_bps").alias("final_mean"), F.avg("delta").alias("mean_delta"),
        p95("bps").alias("first_p95"), p95("final_bps").alias("final_p95"), (F.count_if(sign < 0) / n).alias("first_better_rate"),
        (F.count_if(sign > 0) / n).alias("first_worse_rate"))


def vintage_ranking(sensitivity: DataFrame) -> DataFrame:
    """Position of each model on first and on final values."""
    rows = sensitivity.filter("dimension = 'overall'").select("model", "first_mean", "final_mean", F.lit(1).alias("one"))
    ranked = windows.ranked_models(rows, ["one"], "first_mean", "model").withColumnRenamed("rank", "first_position")
    ranked = windows.ranked_models(ranked, ["one"], "final_mean", "model").withColumnRenamed("rank", "final_position")
    return ranked.select("model", "first_position", "final_position", (F.col("final_position") - F.col("first_position")).alias("position_change"))
