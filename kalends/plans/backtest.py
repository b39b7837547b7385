"""Completion backtests on rolling origins, paired diagnostics and the temporal safeguard.

A masked cell changes the index only by its own weight times its prediction error, so an estimate is
the truth plus that sum over the masked cells; leave-out factors come from totals minus own sums.
Case tables have (masks x pairs x models) rows, bounded by the cell grid and the calendar.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from kalends.functions.months import temporal_split
from kalends.operators import checks, joins, windows
from kalends.session import cut

# Model names, from plainest to richest.
B0, B1, B2, B3, B4 = (
    "B0_GLOBAL_EQUAL_HEADLINE", "B1_WEIGHTED_HEADLINE", "B2_CATEGORY_CARRY_FORWARD", "B3_HIERARCHICAL_COMPLETION", "B4_TEMPORAL_SAFEGUARD")
MODELS = (B0, B1, B2, B3)
SCENARIOS = ("SINGLE_CELL", "ECONOMY_OUTAGE", "CATEGORY_OUTAGE")
PAIRS = (("B1_VS_B0", B1, B0), ("B3_VS_B0", B3, B0), ("B3_VS_B1", B3, B1), ("B3_VS_B2", B3, B2))
CASE = ("case_id", "scenario", "masked_group", "origin", "target", "horizon", "economy", "category")


def mask_groups(cells: DataFrame) -> DataFrame:
    """scenario, masked_group and the cells each group masks."""
    cell = cells.select("economy", "category").distinct()
    single = F.concat_ws("|", "economy", "category")
    rows = F.array(*[
        F.struct(F.lit(s).alias("scenario"), g.alias("masked_group")) for s, g in zip(SCENARIOS, (single, F.col("economy"), F.col("category")))])
    return cell.withColumn("m", F.explode(rows)).select("m.scenario", "m.masked_group", "economy", "category")


def pair_factors(panel: DataFrame, weights: DataFrame, pairs: DataFrame) -> DataFrame:
    """Value at origin and target, growth factor and weight of every cell for every (origin, target, horizon)."""
    start = panel.select("economy", "category", F.col("period").alias("origin"), F.col("price_relative").alias("before"))
    end = panel.select("economy", "category", F.col("period").alias("target"), F.col("price_relative").alias("after"))
    return pairs.join(start, "origin").join(end, ["target", "economy", "category"]).join(weights, ["economy", "category"]).withColumn(
        "factor", F.col("after") / F.col("before"))


def _headline_levels(headline: DataFrame, weights: DataFrame) -> DataFrame:
    """period, equal and weighted headline index of an independent headline panel (economy, period, relative)."""
    economy = weights.groupBy("economy").agg(F.sum("weight").alias("economy_weight"))
    return headline.join(economy, "economy").groupBy("period").agg(
        F.avg("relative").alias("equal"), F.sum(F.col("relative") * F.col("economy_weight")).alias("weighted"))


def completion_backtest(panel: DataFrame, weights: DataFrame, horizons: Sequence[int], window: tuple[str, str],
                        headline: DataFrame | None = None) -> DataFrame:
    """One case per mask, origin, target, horizon and model: estimate, error, bps and mean cell error.

    With ``headline`` the two headline models follow that panel instead of the unmasked cells. The step stops at repeated cells,
    a month that lacks a cell of ``weights``, prices or weights that are not positive, weights that do not sum up to 1, and cells without a
    weight. One job folds the months of the whole panel to the truth and to these checks.
    """
    prices = checks.stop_where(panel, ~checks.finite_positive(F.col("price_relative")), "prices that are not positive", "economy", "category", "period", "price_relative")
    truth = cut(checks.whole_months(prices, checks.valid_weights(weights), truth=F.col("weight") * F.col("price_relative"))).select(F.col("period").alias("target"), "truth")
    pairs = joins.rolling_origin_pairs(panel, horizons, window)
    factors = cut(pair_factors(panel, weights, pairs))
    keys = ("origin", "target", "horizon")
    rows = windows.leave_out_factors(factors, SCENARIOS, keys)
    equal, weighted = F.col("global_equal"), F.col("global_weighted")
    names = {B0: "P5_GLOBAL_EQUAL_HEADLINE", B1: "P5_GLOBAL_WEIGHTED"}
    if headline is not None:
        level = _headline_levels(headline, weights)
        start = level.select(F.col("period").alias("origin"), F.col("equal").alias("e0"), F.col("weighted").alias("w0"))
        end = level.select(F.col("period").alias("target"), F.col("equal").alias("e1"), F.col("weighted").alias("w1"))
        rows = rows.join(start, "origin").join(end, "target")
        equal, weighted = F.col("e1") / F.col("e0"), F.col("w1") / F.col("w0")
        names = {B0: "P1_OFFICIAL_HEADLINE_EQUAL", B1: "P1_OFFICIAL_HEADLINE_WEIGHTED"}
    economy, category = F.col("economy_weighted"), F.col("category_weighted")
    ladder = F.coalesce(F.sqrt(economy * category), category, economy, F.col("global_weighted"))
    rung = (
        F.when(economy.isNotNull() & category.isNotNull(), "P4_ECONOMY_AND_CATEGORY").when(category.isNotNull(), "P4_CATEGORY_PEERS")
        .when(economy.isNotNull(), "P4_ECONOMY_CONTEXT").otherwise("P5_GLOBAL_FALLBACK"))
    choice = lambda model, factor, evidence: F.struct(F.lit(model).alias("model"), factor.alias("factor"), evidence.alias("evidence"))
    models = F.array(choice(B0, equal, F.lit(names[B0])), choice(B1, weighted, F.lit(names[B1])), choice(B2, F.lit(1.0), F.lit("P3_CARRY_FORWARD")), choice(B3, ladder, rung))
    group = F.when(F.col("scenario") == "SINGLE_CELL", F.concat_ws("|", "economy", "category")).when(
        F.col("scenario") == "ECONOMY_OUTAGE", F.col("economy")).otherwise(F.col("category"))
    wrong = F.col("before") * F.col("m.factor") - F.col("after")
    masked = rows.withColumn("masked_group", group).withColumn("m", F.explode(models)).groupBy(
        "scenario", "masked_group", *keys, F.col("m.model").alias("model")).agg(
        F.sum(F.col("weight") * wrong).alias("error"), F.avg(F.abs(wrong / F.col("after")) * 100).alias("mape"),
        F.array_join(F.array_sort(F.collect_set("m.evidence")), "+").alias("evidence_class"),
        F.min("economy").alias("economy"), F.min("category").alias("category"))
    case_id = F.concat_ws("|", "scenario", "masked_group", "origin", "target", F.format_string("H%02d", F.col("horizon")))
    return masked.join(truth, "target").select(
        case_id.alias("case_id"), "scenario", "masked_group", *keys,
        F.when(F.col("scenario") == "CATEGORY_OUTAGE", "").otherwise(F.col("economy")).alias("economy"),
        F.when(F.col("scenario") == "ECONOMY_OUTAGE", "").otherwise(F.col("category")).alias("category"),
        "model", "truth", (F.col("truth") + F.col("error")).alias("estimate"), "error",
        (F.abs(F.col("error") / F.col("truth")) * 10000).alias("bps"), "mape", "evidence_class")


def case_metrics(cases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Index-point and bps errors per key; p95 is interpolated. Case groups are bounded, so the built-in percentile serves."""
    return cases.groupBy(*keys).agg(
        F.count("*").alias("case_count"), F.avg(F.abs("error")).alias("mae"), F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"),
        F.avg("error").alias("bias"), F.avg("bps").alias("mean_bps"), F.percentile("bps", 0.95).alias("p95_bps"), F.avg("mape").alias("mape"))


def construction_sensitivity(panel: DataFrame, weights: DataFrame, window: tuple[str, str]) -> DataFrame:
    """Full-weight index against equal cells and equal categories within weighted economies, in bps."""
    cells = panel.filter(F.col("period").between(*window)).join(weights, ["economy", "category"])
    economy = cells.groupBy("period", "economy").agg(
        F.sum("weight").alias("w"), F.avg("price_relative").alias("mean"), F.sum(F.col("weight") * F.col("price_relative")).alias("points"),
        F.sum("price_relative").alias("total"), F.count("*").alias("n"))
    index = economy.groupBy("period").agg(
        F.sum("points").alias("full_index"), (F.sum("total") / F.sum("n")).alias("equal_cell_index"), F.sum(F.col("w") * F.col("mean")).alias("category_equal_index"))
    bps = lambda name: (F.col(name) / F.col("full_index") - 1) * 10000
    return index.withColumn("equal_cell_bps", bps("equal_cell_index")).withColumn("category_equal_bps", bps("category_equal_index"))


def sensitivity_summary(rows: DataFrame) -> DataFrame:
    size = lambda name: F.abs(F.col(name))
    return rows.agg(*[f(size(n)).alias(f"{label}_{n}") for n in ("equal_cell_bps", "category_equal_bps") for label, f in (("mean", F.avg), ("max", F.max))])


def wide_cases(cases: DataFrame, models: Sequence[str] = MODELS) -> DataFrame:
    """One row per case with the bps and mape of every model: one shuffle in place of self-joins."""
    return cases.groupBy(*CASE).pivot("model", list(models)).agg(F.first("bps").alias("bps"), F.first("mape").alias("mape"))


def outcome_sign(delta: Column) -> Column:
    """-1, 0 or 1: differences below eight decimals of a basis point are ties."""
    return F.signum(F.round(delta, 8))


def paired_deltas(cases: DataFrame, pairs: Sequence[tuple[str, str, str]] = PAIRS) -> DataFrame:
    """Challenger minus baseline per case and pair, with its outcome."""
    wide = wide_cases(cases)
    rows = F.array(*[
        F.struct(F.lit(name).alias("pair_id"), F.col(f"{a}_bps").alias("challenger"), F.col(f"{b}_bps").alias("baseline"),
                 (F.col(f"{a}_mape") - F.col(f"{b}_mape")).alias("delta_mape"))
        for name, a, b in pairs])
    deltas = wide.select(*CASE, F.explode(rows).alias("p")).select(*CASE, "p.*").withColumn("delta", F.col("challenger") - F.col("baseline"))
    sign = outcome_sign(F.col("delta"))
    return deltas.withColumn("outcome", F.when(sign < 0, "IMPROVEMENT").when(sign > 0, "REGRESSION").otherwise("TIE"))


DIMENSIONS = (("scenario", "horizon"), ("category",), ("economy",))


def _strata(rows: DataFrame, dimensions: Sequence[Sequence[str]], metrics) -> DataFrame:
    """Metrics per stratum of each dimension list, labelled; strata with a blank part are left out."""
    found = None
    for fields in dimensions:
        label = F.concat_ws(" | ", *[F.concat(F.lit(f"{f}="), F.col(f).cast("string")) for f in fields])
        kept = rows
        for f in fields:
            kept = kept.filter(F.col(f).cast("string") != "")
        part = metrics(kept, fields).withColumn("dimension", F.lit("+".join(fields))).withColumn("label", label).drop(*fields)
        found = part if found is None else found.unionByName(part)
    return found


def top_error_sources(cases: DataFrame, minimum_cases: int, dimensions: Sequence[Sequence[str]] = DIMENSIONS, model: str = B3) -> DataFrame:
    """The worst stratum of each dimension list with enough cases."""
    strata = _strata(cases.filter(F.col("model") == model), dimensions, case_metrics).filter(F.col("case_count") >= minimum_cases)
    worst = F.max_by(F.struct("label", "case_count", "mean_bps", "p95_bps", "mape"), F.struct("mean_bps", "p95_bps", "label"))
    return strata.groupBy("dimension").agg(worst.alias("w")).select("dimension", "w.*")


def delta_metrics(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    n = F.count("*")
    return deltas.groupBy(*keys).agg(
        n.alias("case_count"), F.avg("delta").alias("mean_delta"), F.percentile("delta", 0.5).alias("median_delta"), F.percentile("delta", 0.95).alias("p95_delta"),
        F.greatest(F.max("delta"), F.lit(0.0)).alias("worst_regression"), F.greatest(-F.min("delta"), F.lit(0.0)).alias("best_improvement"),
        (F.count_if(outcome_sign(F.col("delta")) < 0) / n).alias("improvement_rate"), (F.count_if(outcome_sign(F.col("delta")) > 0) / n).alias("regression_rate"),
        F.avg("challenger").alias("mean_challenger"), F.avg("baseline").alias("mean_baseline"))


def priority_regressions(deltas: DataFrame, minimum_cases: int, pair: str = "B3_VS_B2", top: int = 3,
                         dimensions: Sequence[Sequence[str]] = DIMENSIONS) -> DataFrame:
    """The ``top`` worst mean regressions and best mean improvements over all strata."""
    strata = _strata(deltas.filter(F.col("pair_id") == pair), dimensions, delta_metrics).filter(F.col("case_count") >= minimum_cases)
    strata = strata.filter("mean_delta <> 0").withColumn(
        "priority", F.when(F.col("mean_delta") > 0, "MEAN_REGRESSION").otherwise("MEAN_IMPROVEMENT")).withColumn("size", -F.abs("mean_delta")).withColumn(
        "rate", F.when(F.col("mean_delta") > 0, -F.col("regression_rate")).otherwise(F.col("regression_rate")))
    ranked = windows.top_donors(strata, top, ("size", "rate", "dimension", "label"), ("priority",))
    return ranked.select("priority", F.col("donor_rank").alias("rank"), "dimension", "label", "case_count", "mean_delta", "p95_delta", "regression_rate", "mean_challenger", "mean_baseline")


@dataclass(frozen=True)
class Rule:
    """A candidate fallback rule; a part left out matches every case."""

    rule_id: str
    category: str | None = None
    scenario: str | None = None
    horizon: int | None = None

    def matches(self) -> Column:
        rule = F.lit(True)
        for name in ("category", "scenario", "horizon"):
            wanted = getattr(self, name)
            if wanted is not None:
                rule = rule & (F.col(name) == wanted)
        return rule


@dataclass(frozen=True)
class Safeguard:
    rules: tuple[Rule, ...]
    development: tuple[str, str]
    holdout: tuple[str, str]
    minimum_cases: int = 10
    mean_delta_above: float = 0.0
    regression_rate_from: float = 0.5

    def split(self) -> Column:
        return temporal_split(F.col("target"), self.development, self.holdout)


def _matched(wide: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return wide.withColumn("matched", F.filter(F.array(*[F.when(rule.matches(), rule.rule_id) for rule in rules]), lambda x: x.isNotNull()))


def activate_rules(cases: DataFrame, policy: Safeguard) -> DataFrame:
    """Judge every rule on development cases only: enough cases, B3 worse than B2 on average and often."""
    spark = cases.sparkSession
    b3, b2 = F.col(f"{B3}_bps"), F.col(f"{B2}_bps")
    wide = _matched(wide_cases(cases), policy.rules).filter(policy.split() == "DEVELOPMENT")
    judged = wide.select(F.explode("matched").alias("rule_id"), (b3 - b2).alias("delta")).groupBy("rule_id").agg(
        F.count("*").alias("n"), F.avg("delta").alias("m"), (F.count_if(outcome_sign(F.col("delta")) > 0) / F.count("*")).alias("r"))
    rules = spark.createDataFrame([(rule.rule_id,) for rule in policy.rules], "rule_id string")
    out = rules.join(judged, "rule_id", "left").select(
        "rule_id", F.coalesce("n", F.lit(0)).alias("case_count"), F.coalesce("m", F.lit(0.0)).alias("mean_delta"), F.coalesce("r", F.lit(0.0)).alias("regression_rate"))
    reasons = F.filter(F.array(
        F.when(F.col("case_count") < policy.minimum_cases, "INSUFFICIENT_DEVELOPMENT_CASES"),
        F.when(F.col("mean_delta") <= policy.mean_delta_above, "MEAN_REGRESSION_THRESHOLD_NOT_MET"),
        F.when(F.col("regression_rate") < policy.regression_rate_from, "REGRESSION_RATE_THRESHOLD_NOT_MET")), lambda x: x.isNotNull())
    return out.withColumn("activated", F.size(reasons) == 0).withColumn(
        "reasons", F.when(F.size(reasons) == 0, "ALL_DEVELOPMENT_CRITERIA_MET").otherwise(F.array_join(reasons, "|")))


def safeguarded_model(cases: DataFrame, activations: DataFrame, policy: Safeguard) -> DataFrame:
    """B4 takes B2 where an active rule matches and B3 elsewhere; its differences from B1, B2 and B3."""
    active = activations.filter("activated").agg(F.coalesce(F.collect_set("rule_id"), F.array().cast("array<string>"))).scalar()
    wide = _matched(wide_cases(cases), policy.rules).withColumn("active", F.array_intersect("matched", active))
    picked = F.size("active") > 0
    error = {m: F.col(f"{m}_bps") for m in (B1, B2, B3)}
    b4 = F.when(picked, error[B2]).otherwise(error[B3])
    return wide.select(
        *CASE, policy.split().alias("split"), "matched", "active", F.when(picked, B2).otherwise(B3).alias("selected_model"),
        error[B1].alias("b1_bps"), error[B2].alias("b2_bps"), error[B3].alias("b3_bps"), b4.alias("b4_bps"),
        *[(b4 - error[m]).alias(f"b4_minus_{m[:2].lower()}") for m in (B1, B2, B3)])


def _safeguard_metrics(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    n = F.count("*")
    return rows.groupBy(*keys).agg(
        n.alias("case_count"), F.count_if(F.col("selected_model") == B2).alias("selected_b2"), *[F.avg(f"b{i}_bps").alias(f"mean_b{i}") for i in (1, 2, 3, 4)],
        *[F.avg(f"b4_minus_b{i}").alias(f"mean_b4_minus_b{i}") for i in (1, 2, 3)],
        *[(F.count_if(outcome_sign(F.col(f"b4_minus_b{i}")) < 0) / n).alias(f"improvement_rate_b{i}") for i in (1, 3)],
        *[(F.count_if(outcome_sign(F.col(f"b4_minus_b{i}")) > 0) / n).alias(f"regression_rate_b{i}") for i in (1, 3)])


def holdout_evaluation(b4: DataFrame, activations: DataFrame) -> DataFrame:
    """Metrics per split, overall and per matched rule; each rule's holdout status."""
    rows = b4.filter("split is not null")
    scopes = F.array_union(F.array(F.lit("ALL")), F.col("matched"))
    metrics = _safeguard_metrics(rows.withColumn("scope", F.explode(scopes)), ["split", "scope"])
    judged = metrics.join(activations.select(F.col("rule_id").alias("scope"), "activated"), "scope", "left")
    mean = F.round("mean_b4_minus_b3", 8)
    status = (
        F.when(F.col("scope") == "ALL", "").when(~F.col("activated"), "INACTIVE_FROM_DEVELOPMENT").when(F.col("split") != "HOLDOUT", "")
        .when(mean < 0, "HOLDOUT_MEAN_IMPROVEMENT_VS_B3").when(mean > 0, "HOLDOUT_MEAN_REGRESSION_VS_B3").otherwise("HOLDOUT_MEAN_TIE_VS_B3"))
    return judged.withColumn("status", status).drop("activated")
