"""Expenditure-weight matrix: measures, cells, sources, weights, proxy audit, imputation and release.

Inputs are economy x heading tables, small beside the transactions they were summed from.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window, functions as F

from kalends.functions.classes import measure_kind
from kalends.operators import checks, joins, ranks, windows
from kalends.session import cut

KINDS = ("PPP", "NOMINAL_EXPENDITURE", "REAL_EXPENDITURE")


def select_measure_triple(obs: DataFrame, measures: DataFrame) -> DataFrame:
    """The (PPP, nominal, real) measure ids whose identity nominal / PPP = real holds best: least median error,
    then most comparisons, then ids. ``obs``: economy, heading, measure, value (null: not published); ``measures``: measure, label."""
    kinds = measures.select("measure", measure_kind(F.col("label")).alias("kind"))
    rows = obs.join(kinds, "measure")
    part = lambda kind, name: rows.filter(F.col("kind") == kind).select("economy", "heading", F.col("measure").alias(f"{name}_id"), F.col("value").alias(name))
    joined = part(KINDS[0], "ppp").join(part(KINDS[1], "nominal"), ["economy", "heading"]).join(part(KINDS[2], "real"), ["economy", "heading"])
    error = F.abs(F.col("nominal") / F.col("ppp") - F.col("real")) / F.abs("real")
    scored = joined.filter("ppp > 0 and real <> 0 and nominal is not null").groupBy("ppp_id", "nominal_id", "real_id").agg(
        F.percentile(error, 0.5).alias("median_error"), F.count("*").alias("comparisons"))
    order = F.struct("median_error", -F.col("comparisons"), "ppp_id", "nominal_id", "real_id")
    return scored.groupBy().agg(F.min_by(F.struct(*scored.columns), order).alias("best")).select("best.*")


def pivot_triple(obs: DataFrame, ppp: str, nominal: str, real: str) -> DataFrame:
    """economy, heading, ppp, nominal, real of a chosen triple."""
    pick = lambda name: F.max(F.when(F.col("measure") == name, F.col("value")))
    return obs.filter(F.col("measure").isin(ppp, nominal, real)).groupBy("economy", "heading").agg(
        pick(ppp).alias("ppp"), pick(nominal).alias("nominal"), pick(real).alias("real"))


def measure_identity_audit(wide: DataFrame, tolerance: float) -> DataFrame:
    """Calculated against published real expenditure, cell by cell."""
    whole = wide.filter("ppp is not null and nominal is not null and real is not null")
    good = F.col("ppp") > 0
    calculated = F.when(good, F.col("nominal") / F.col("ppp"))
    error = F.abs(calculated - F.col("real")) / F.greatest(F.abs("real"), F.lit(1e-30))
    return whole.withColumn("calculated", calculated).withColumn("relative_error", error).withColumn(
        "status", F.when(~good, "INVALID_NONPOSITIVE_PPP").when(error <= tolerance, "PASS").otherwise("WARN_PUBLISHED_ROUNDING_OR_INCONSISTENCY"))


def identity_summary(audit: DataFrame, tolerance: float) -> DataFrame:
    """Comparisons, upper-median and largest error; the median decides."""
    rows = audit.filter("relative_error is not null")
    facts = rows.agg(F.count("*").alias("comparisons"), F.coalesce(F.max("relative_error"), F.lit(0.0)).alias("maximum_error"),
                     F.count_if(F.col("relative_error") > tolerance).alias("cells_above_tolerance"))
    median = ranks.upper_median(rows, [], "relative_error").scalar()
    return facts.withColumn("median_error", F.coalesce(median, F.lit(0.0))).withColumn(
        "status", F.when(F.col("comparisons") == 0, "NO_COMPARISONS").when(F.col("median_error") <= tolerance, "PASS").otherwise("FAIL"))


def _expected(economies: DataFrame, headings: Mapping[str, Sequence[str]]) -> DataFrame:
    """Every economy with every category and the headings it is built from."""
    rows = F.array(*[F.struct(F.lit(c).alias("category"), F.array(*[F.lit(h) for h in hs]).alias("headings")) for c, hs in headings.items()])
    return economies.select("economy").distinct().withColumn("x", F.explode(rows)).select("economy", "x.category", "x.headings")


def direct_cells(wide: DataFrame, economies: DataFrame, headings: Mapping[str, Sequence[str]], multiplier: float = 1.0) -> DataFrame:
    """Real = nominal x unit / PPP, summed over a category's headings; the reason where one is unusable."""
    want = _expected(economies, headings).withColumn("heading", F.explode("headings"))
    usable = F.col("nominal").isNotNull() & F.coalesce(F.col("ppp") > 0, F.lit(False))
    nominal = F.col("nominal") * multiplier
    sums = want.join(wide, ["economy", "heading"], "left").groupBy("economy", "category").agg(
        F.sum(F.when(usable, nominal)).alias("nominal"), F.sum(F.when(usable, nominal / F.col("ppp"))).alias("real"), F.min(F.when(~usable, F.col("heading"))).alias("gap"), F.count("*").alias("parts"))
    whole = F.col("gap").isNull()
    return sums.select(
        "economy", "category", F.when(whole, F.col("nominal")).alias("nominal"), F.when(whole, F.col("nominal") / F.col("real")).alias("ppp"),
        F.when(whole, F.col("real")).alias("real"), F.when(F.col("parts") == 1, "DIRECT").otherwise("COMPOSITE").alias("derivation"), F.lit("ICP").alias("source_id"),
        F.when(whole, "").otherwise(F.concat(F.lit("MISSING_DIRECT_NOMINAL_OR_PPP:"), "gap")).alias("reason"))


def proxy_cells(selected: DataFrame, wide: DataFrame, economies: DataFrame, headings: Mapping[str, str]) -> DataFrame:
    """Selected household nominal over the proxy PPP of the category's heading."""
    want = _expected(economies, {c: [h] for c, h in headings.items()}).withColumn("heading", F.col("headings")[0])
    rows = want.join(selected.select("economy", "category", "value", "source_id"), ["economy", "category"], "left").join(
        wide.select("economy", "heading", "ppp"), ["economy", "heading"], "left")
    reason = (
        F.when(F.col("value").isNull(), "MISSING_STRICT_HOUSEHOLD_NOMINAL_EXPENDITURE").when(F.col("ppp").isNull(), F.concat(F.lit("MISSING_PPP_PROXY:"), "heading"))
        .when(F.col("ppp") <= 0, F.concat(F.lit("NONPOSITIVE_PPP_PROXY:"), "heading")).otherwise(""))
    good = reason == ""
    return rows.select(
        "economy", "category", F.when(good, F.col("value")).alias("nominal"), F.when(good, F.col("ppp")).alias("ppp"),
        F.when(good, F.col("value") / F.col("ppp")).alias("real"), F.lit("PROXY").alias("derivation"), F.coalesce("source_id", F.lit("")).alias("source_id"), reason.alias("reason"))


def entity_status(wide: DataFrame, registry: DataFrame, aggregate_tokens: Sequence[str], controls: Sequence[str], details: Sequence[str], aggregate_codes: Sequence[str] = ()) -> DataFrame:
    """PARTICIPATING, AGGREGATE (by code or by a token of the name), imputed aggregates only, or unavailable. ``registry``: economy, participating."""
    held = wide.filter("ppp is not null").groupBy("economy").agg(
        F.count_if(F.col("heading").isin(*controls)).alias("controls"), F.count_if(F.col("heading").isin(*details)).alias("details"))
    named = F.col("economy").isin(*aggregate_codes) if aggregate_codes else F.lit(False)
    for token in aggregate_tokens:
        named = named | F.lower("economy").contains(token)
    return registry.join(held, "economy", "left").select("economy", F.when(F.col("participating"), "PARTICIPATING").when(named, "AGGREGATE").when(
        (F.coalesce("controls", F.lit(0)) > 0) & (F.coalesce("details", F.lit(0)) == 0), "OFFICIALLY_IMPUTED_AGGREGATE_ONLY").otherwise("UNAVAILABLE_OR_NONPUBLISHED").alias("status"))


def select_single_source(nominal: DataFrame, required: Sequence[str], priority: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """The first source in priority order that holds all required categories, per economy; and the audit of all candidates.

    ``nominal``: economy, category, source_id, value; a source does not hold a category whose value is null.
    """
    place = F.coalesce(F.element_at(F.create_map(*[x for i, s in enumerate(priority) for x in (F.lit(s), F.lit(i))]), F.col("source_id")), F.lit(999))
    want = F.array(*[F.lit(c) for c in sorted(required)])
    sources = cut(nominal.groupBy("economy", "source_id").agg(F.collect_set(F.when(F.col("value").isNotNull(), F.col("category"))).alias("held")).withColumn("missing", F.array_except(want, "held")).withColumn("place", place))
    chosen = sources.filter(F.size("missing") == 0).groupBy("economy").agg(F.min(F.struct("place", "source_id")).alias("best")).select("economy", F.col("best.source_id").alias("chosen_source"))
    selected = nominal.join(chosen, "economy").filter("source_id = chosen_source").drop("chosen_source")
    grid = sources.join(chosen, "economy", "left").withColumn("category", F.explode(want))
    values = nominal.select("economy", "source_id", "category", F.col("value").alias("candidate_value"))
    picked = selected.select("economy", "category", F.col("value").alias("chosen_value"))
    return selected, grid.join(values, ["economy", "source_id", "category"], "left").join(picked, ["economy", "category"], "left").select(
        "economy", "category", F.coalesce("chosen_source", F.lit("")).alias("chosen_source"), "source_id", "chosen_value", "candidate_value",
        (F.size("missing") == 0).alias("complete"), F.array_join("missing", "|").alias("missing"))


def consistency_status(audit: DataFrame, tolerance: float) -> DataFrame:
    """How each candidate compares with the chosen source."""
    gap = F.abs(F.col("chosen_value") - F.col("candidate_value")) / F.greatest(F.abs("chosen_value"), F.abs("candidate_value"), F.lit(1.0))
    return audit.withColumn("relative_difference", gap).withColumn(
        "status", F.when(F.col("candidate_value").isNull(), "CANDIDATE_MISSING_CATEGORY").when(F.col("chosen_value").isNull(), "NO_COMPLETE_SOURCE_FOR_ECONOMY")
        .when(F.col("source_id") == F.col("chosen_source"), "SELECTED_SINGLE_SOURCE_ECONOMY").when(gap <= tolerance, "ALTERNATIVE_CONSISTENT").otherwise("ALTERNATIVE_DIVERGENT"))


def unit_reconciliation(nominal: DataFrame, wide: DataFrame, headings: Mapping[str, str], multiplier: float = 1.0) -> DataFrame:
    """Upper-median ratio of supplemental to published nominal per economy and source; between a half and two passes."""
    heading = F.element_at(F.create_map(*[F.lit(x) for pair in headings.items() for x in pair]), F.col("category"))
    direct = nominal.filter(F.col("category").isin(*headings)).withColumn("heading", heading)
    rows = direct.join(wide.select("economy", "heading", "nominal"), ["economy", "heading"]).filter("nominal <> 0 and value <> 0")
    ratios = rows.withColumn("ratio", F.col("value") / (F.col("nominal") * multiplier))
    found = ratios.groupBy("economy", "source_id").agg(F.count("*").alias("comparisons"), F.array_join(F.array_sort(F.collect_set("category")), "|").alias("categories"))
    median = ranks.upper_median(ratios, ["economy", "source_id"], "ratio")
    sources = nominal.select("economy", "source_id").distinct()
    out = sources.join(found, ["economy", "source_id"], "left").join(median, ["economy", "source_id"], "left")
    return out.select(
        "economy", "source_id", F.coalesce("categories", F.lit("")).alias("categories"), F.coalesce("comparisons", F.lit(0)).alias("comparisons"), F.coalesce("median", F.lit(0.0)).alias("median_ratio"),
        F.when(F.col("median").isNull(), "NOT_TESTABLE_NO_DIRECT_OVERLAP").when(F.col("median").between(0.5, 2), "PASS_COMPATIBLE_SCALE").otherwise("FAIL_INCOMPATIBLE_SCALE").alias("status"))


def hybrid_matrix(direct: DataFrame, proxy: DataFrame, category_count: int) -> dict[str, DataFrame]:
    """All built cells, missing cells with reasons, cells of complete economies, and the economies left out."""
    rows = cut(direct.unionByName(proxy))
    built = rows.filter("reason = ''").drop("reason")
    held = rows.groupBy("economy").agg(F.count_if(F.col("reason") == "").alias("cells"), F.min(F.when(F.col("reason") != "", F.col("reason"))).alias("first_reason"))
    whole = held.filter(F.col("cells") >= category_count).select("economy")
    return {
        "cells": built, "missing": rows.filter("reason <> ''").select("economy", "category", "reason"), "complete": built.join(whole, "economy", "left_semi"),
        "excluded": held.filter(F.col("cells") < category_count)}


def observed_weights(complete: DataFrame, places: int) -> DataFrame:
    """Real-expenditure shares of complete economies, rounded, summing to exactly one."""
    cells = complete.select("economy", "category", F.round("real", 6).cast("decimal(28,6)").alias("real"))
    total = cells.agg(F.sum("real").cast("double")).scalar()
    shares = cut(cells.withColumn("share", F.col("real").cast("double") / total))
    return windows.round_with_residual(shares, "share", places, ("economy", "category")).select("economy", "category", "weight", "residual")


def research_gate(matrix: Mapping[str, DataFrame], weights: DataFrame, expected_economies: int, category_count: int) -> DataFrame:
    """Counts against expectations, weight validity, blocking reasons and status, in one row."""
    facts = matrix["complete"].agg(F.count_distinct("economy").alias("complete_economies"), F.count("*").alias("cells"), F.count_if(F.col("real") <= 0).alias("nonpositive_cells"))
    facts = facts.withColumn("weight_sum", weights.agg(F.sum("weight")).scalar()).withColumn("missing_cells", matrix["missing"].agg(F.count("*")).scalar())
    reasons = F.filter(F.array(
        F.when(F.col("complete_economies") < expected_economies, "TOO_FEW_COMPLETE_ECONOMIES"), F.when(F.col("cells") != F.col("complete_economies") * category_count, "INCOMPLETE_GRID"),
        F.when(F.col("nonpositive_cells") > 0, "NONPOSITIVE_CELL"), F.when(F.coalesce(F.col("weight_sum") != 1, F.lit(True)), "WEIGHTS_DO_NOT_SUM_TO_ONE")), lambda x: x.isNotNull())
    return facts.withColumn("blocking_reasons", F.array_join(reasons, "|")).withColumn("status", F.when(F.size(reasons) == 0, "PASS").otherwise("BLOCKED"))


def core_basket(weights: DataFrame, economies: Sequence[str], categories: Sequence[str], exact: Sequence[str], derived: Sequence[str], places: int) -> DataFrame:
    """A fixed subset of the matrix renormalised once, with an evidence label per category."""
    chosen = weights.filter(F.col("economy").isin(*economies) & F.col("category").isin(*categories))
    total = chosen.agg(F.sum("weight").cast("double")).scalar()
    label = F.when(F.col("category").isin(*exact), "EXACT_OFFICIAL").when(F.col("category").isin(*derived), "OFFICIAL_DETERMINISTIC_DERIVATION").otherwise("EXPERIMENTAL_RESEARCH")
    share = F.col("weight").cast("double") / F.col("total")
    return chosen.withColumn("total", total).select("economy", "category", "weight", F.bround(share.cast("decimal(38,24)"), places).alias("fixed_universe_weight"), label.alias("evidence_class"))


def financing_exposure(complete: DataFrame, wide: DataFrame, aic: str, parent: str, parts: Sequence[str], net: str, multiplier: float = 1.0) -> DataFrame:
    """Household total rebuilt with the residual of a parent heading and net purchases, against actual consumption."""
    pick = lambda name: F.max(F.when(F.col("heading") == name, F.col("nominal") * multiplier))
    part_sum, part_count = F.sum(F.when(F.col("heading").isin(*parts), F.col("nominal") * multiplier)), F.count_if(F.col("heading").isin(*parts) & F.col("nominal").isNotNull())
    controls = wide.groupBy("economy").agg(pick(aic).alias("aic"), pick(parent).alias("parent"), part_sum.alias("parts"), part_count.alias("part_count"), pick(net).alias("net"))
    own = complete.groupBy("economy").agg(F.sum("nominal").alias("own"))
    rows = own.join(controls, "economy", "left").withColumn("residual", F.col("parent") - F.col("parts"))
    known = F.col("aic").isNotNull() & F.col("parent").isNotNull() & (F.col("part_count") == len(parts)) & F.col("net").isNotNull() & (F.col("own") > 0)
    total = F.col("own") + F.col("residual") + F.col("net")
    sound = known & (F.col("residual") >= 0) & (total > 0)
    ratio = F.when(sound, (F.col("aic") - total) / total)
    return rows.select(
        "economy", "own", F.when(known, F.col("residual")).alias("residual"), F.when(known, total).alias("reconstructed"), ratio.alias("gap_ratio"),
        F.when(~F.coalesce(known, F.lit(False)), "UNAVAILABLE").when(~sound, "WARN_CONCEPT_OR_UNIT_MISMATCH").when(ratio >= -0.02, "PASS_DIAGNOSTIC_ONLY")
        .otherwise("WARN_CONCEPT_OR_UNIT_MISMATCH").alias("status"))


def proxy_ppp_comparison(complete: DataFrame, benchmarks: DataFrame, proxies: Sequence[str]) -> DataFrame:
    """Strict over proxy PPP where a benchmark matches, and the error the proxy implies for real expenditure."""
    rows = complete.filter(F.col("category").isin(*proxies)).join(benchmarks, ["economy", "category"], "left")
    aic = F.coalesce("aic_ppp", "ppp")
    valid = (aic > 0) & (F.col("strict_ppp") > 0)
    ratio = F.when(valid, F.col("strict_ppp") / aic)
    return rows.select("economy", "category", aic.alias("aic_ppp"), "strict_ppp", ratio.alias("ppp_ratio"), (ratio - 1).alias("implied_error"),
                       F.when(ratio.isNotNull(), "DIRECT_OFFICIAL_COMPARISON_AVAILABLE").otherwise("NO_MATCHED_BENCHMARK").alias("status"))


def proxy_error_summary(comparison: DataFrame, by: str) -> DataFrame:
    """Signed and absolute errors of matched comparisons by category or economy."""
    rows = comparison.filter("implied_error is not null")
    size = F.abs("implied_error")
    return rows.groupBy(by).agg(
        F.count("*").alias("comparisons"), F.count_distinct("economy").alias("economies"), F.avg("implied_error").alias("mean_signed"), F.percentile("implied_error", 0.5).alias("median_signed"),
        F.avg(size).alias("mean_absolute"), F.percentile(size, 0.5).alias("median_absolute"), F.max(size).alias("maximum_absolute"))


def proxy_validation(comparison: DataFrame, proxies: int, minimum: int, minimum_economies: int, minimum_per_category: int, validated: float, limited: float) -> DataFrame:
    """Whether the proxy PPP is validated, validated with limits, rejected, or lacks evidence."""
    rows = comparison.filter("implied_error is not null")
    enough = rows.groupBy("category").agg(F.count("*").alias("n")).filter(F.col("n") >= minimum_per_category).agg(F.count("*")).scalar()
    facts = rows.agg(F.count("*").alias("comparisons"), F.count_distinct("economy").alias("economies"), F.percentile(F.abs("implied_error"), 0.5).alias("median_absolute")).withColumn("categories_meeting_minimum", enough)
    covered = (F.col("comparisons") >= minimum) & (F.col("economies") >= minimum_economies) & (F.col("categories_meeting_minimum") == proxies)
    return facts.withColumn("status", F.when(~covered, "INSUFFICIENT_DIRECT_EVIDENCE").when(F.col("median_absolute") <= validated, "PROXY_VALIDATED")
                            .when(F.col("median_absolute") <= limited, "PROXY_VALIDATED_WITH_LIMITS").otherwise("PROXY_REJECTED"))


def stage_evidence(matrix: DataFrame) -> DataFrame:
    """Strict rows as class A (direct) or B (derived) evidence; experimental allocations and non-positive rows are rejected."""
    experimental = F.array_contains(F.split(F.coalesce("quality_flags", F.lit("")), r"\|"), "EXPERIMENTAL_ALLOCATION")
    bad = experimental | ~F.coalesce(F.col("real") > 0, F.lit(False))
    evidence = F.when(bad, "REJECTED").when(F.col("derivation") == "DIRECT", "A_OFFICIAL_EXACT").otherwise("B_OFFICIAL_DETERMINISTIC")
    return matrix.select(
        "economy", "category", F.when(~bad, F.col("real")).alias("central"), F.when(~bad, F.col("real")).alias("lower"), F.when(~bad, F.col("real")).alias("upper"),
        evidence.alias("evidence_class"), F.when(experimental, "EXPERIMENTAL_ALLOCATION").when(bad, "NONPOSITIVE_VALUE").otherwise("").alias("rejection"))


@dataclass(frozen=True)
class ImputationPolicy:
    categories: tuple[str, ...]
    donor_count: int = 5
    minimum_donors: int = 3
    lower_quantile: float = 0.10
    upper_quantile: float = 0.90
    minimum_relative_interval: float = 0.10
    allocation_groups: tuple[tuple[str, tuple[str, ...]], ...] = ()


def core_vectors(cells: DataFrame, policy: ImputationPolicy) -> DataFrame:
    """Cells of economies that hold a value of class A or B in every category."""
    core = cells.filter(F.col("central").isNotNull() & (F.col("evidence_class").startswith("A_") | F.col("evidence_class").startswith("B_")))
    whole = core.groupBy("economy").agg(F.count_distinct("category").alias("n")).filter(F.col("n") == len(policy.categories))
    return core.join(whole, "economy", "left_semi").select(F.col("economy").alias("donor"), "category", F.col("central").alias("value"))


def donor_distance(profiles: DataFrame, donors: DataFrame) -> DataFrame:
    """target, donor, distance: 4 for another region, 2 for another income group, plus the root mean square
    covariate difference in population standard deviations over shared covariates."""
    spread = profiles.select(F.explode("covariates").alias("name", "x")).groupBy("name").agg(F.stddev_pop("x").alias("s"))
    scales = spread.agg(F.map_from_entries(F.collect_list(F.struct("name", F.when(F.col("s") > 1e-12, F.col("s")).otherwise(1.0).alias("scale"))))).scalar()
    names = ("economy", "region", "income_group", "covariates")
    left = profiles.withColumn("scales", scales).select(*[F.col(c).alias(f"t_{c}") for c in names], "scales")
    right = profiles.join(donors.select(F.col("donor").alias("economy")).distinct(), "economy", "left_semi").select(*[F.col(c).alias(f"d_{c}") for c in names])
    shared = F.array_sort(F.array_intersect(F.map_keys("t_covariates"), F.map_keys("d_covariates")))
    square = lambda n: F.pow((F.col("t_covariates")[n] - F.col("d_covariates")[n]) / F.col("scales")[n], F.lit(2.0))
    rms = F.when(F.size(shared) == 0, 0.0).otherwise(F.sqrt(F.aggregate(shared, F.lit(0.0), lambda a, n: a + square(n)) / F.size(shared)))
    other = lambda name, cost: F.when(F.col(f"t_{name}") == F.col(f"d_{name}"), 0.0).otherwise(cost)
    regions = profiles.agg(F.array_distinct(F.collect_list(F.coalesce("region", F.lit("")))).alias("r")).scalar()
    # the pairing is of economies, a dimension table, and is independent of the transactions
    return joins.paired(left, right, regions).select(
        F.col("t_economy").alias("target"), F.col("d_economy").alias("donor"), (F.col("t_region") == F.col("d_region")).alias("same_region"),
        (other("region", 4.0) + other("income_group", 2.0) + rms).alias("distance"))


def donor_pool(distances: DataFrame, policy: ImputationPolicy) -> DataFrame:
    """target, donor, rank, method: nearest donors (D); with too few, the region's economies or all of them by name (E)."""
    counts = Window.partitionBy("target")
    rows = distances.withColumn("near", F.row_number().over(counts.orderBy(F.round("distance", 9), "donor"))).withColumn("n", F.count("*").over(counts)).withColumn(
        "peers", F.count_if("same_region").over(counts))
    enough = F.least(F.col("n"), F.lit(policy.donor_count)) >= policy.minimum_donors
    method = F.when(enough, "D_DONOR").when(F.col("peers") > 0, "E_REGIONAL").otherwise("E_GLOBAL")
    kept = rows.withColumn("method", method).filter(
        ((F.col("method") == "D_DONOR") & (F.col("near") <= policy.donor_count)) | ((F.col("method") == "E_REGIONAL") & F.col("same_region")) | (F.col("method") == "E_GLOBAL"))
    order = (F.when(F.col("method") == "D_DONOR", F.col("near")).otherwise(0), F.col("donor"))
    return kept.withColumn("rank", F.row_number().over(counts.orderBy(*order))).select("target", "donor", "rank", "method")


def donor_template(need: DataFrame, pool: DataFrame, vectors: DataFrame, policy: ImputationPolicy, keys: Sequence[str] = ("target",)) -> DataFrame:
    """Share template of the needed categories of each key: donors' shares weighted by 1/k in order of rank,
    bounds from interpolated quantiles widened to a minimum. ``need``: keys (with target) and category."""
    keys = list(keys)
    rows = need.select(*keys, "category").join(pool, "target").join(vectors, ["donor", "category"])
    base = F.sum("value").over(Window.partitionBy(*keys, "donor"))
    usable = rows.withColumn("base", base).filter("base > 0").withColumn("share", F.col("value") / F.col("base"))
    ranked = usable.withColumn("k", F.row_number().over(Window.partitionBy(*keys, "category").orderBy("rank")))
    per = ranked.groupBy(*keys, "category", "method").agg(
        (F.sum(F.col("share") / F.col("k")) / F.sum(1 / F.col("k"))).alias("raw"), F.percentile("share", policy.lower_quantile).alias("lo"), F.percentile("share", policy.upper_quantile).alias("hi"),
        F.array_join(F.array_sort(F.collect_set("donor")), "|").alias("donors"))
    central = F.col("raw") / F.sum("raw").over(Window.partitionBy(*keys))
    least = policy.minimum_relative_interval
    return per.withColumn("share", central).select(
        *keys, "category", "method", "share", F.greatest(F.lit(0.0), F.least("lo", F.col("share") * (1 - least))).alias("lower_share"),
        F.greatest("hi", F.col("share") * (1 + least)).alias("upper_share"), "donors")


def _values(rows: DataFrame, amount: Column, policy: ImputationPolicy) -> DataFrame:
    least = policy.minimum_relative_interval
    central = amount * F.col("share")
    lower = F.least(amount * F.col("lower_share"), F.greatest(central * (1 - least), F.lit(1e-15)))
    upper = F.greatest(amount * F.col("upper_share"), central * (1 + least))
    return rows.withColumn("central", central).withColumn("lower", F.when(lower <= 0, F.greatest(central * 1e-6, F.lit(1e-15))).otherwise(lower)).withColumn("upper", upper)


def impute_grid(cells: DataFrame, profiles: DataFrame, constraints: DataFrame, policy: ImputationPolicy) -> DataFrame:
    """Complete economy x category grid: observed cells kept, C from own disjoint aggregates, D or E from donors. A null cell is not observed.

    ``profiles`` carries total_real; ``constraints``: economy, aggregate_id, categories, amount. A residual that is
    not positive gives null values with status NONPOSITIVE_RESIDUAL. Repeated cells or profiles and bounds that do not hold their
    value stop the step.
    """
    cells = checks.stop_where(cells, F.expr("not (lower <= central and central <= upper)"), "bounds that do not hold their value", "economy", "category", "lower", "central", "upper")
    cells = cut(checks.unrepeated(cells, ["economy"], ["category"], "repeated cells"))
    profiles = cut(checks.unrepeated(profiles, ["economy"], [], "repeated profiles"))
    vectors = cut(core_vectors(cells, policy))
    distances = cut(donor_distance(profiles, vectors))
    pool = cut(donor_pool(distances, policy))
    observed = cells.filter("central is not null").select("economy", "category", "central", "lower", "upper", "evidence_class", F.lit("").alias("donors"), F.lit("OBSERVED").alias("status"))
    known = observed.select("economy", "category", F.col("central").alias("known"))
    parts = constraints.withColumn("category", F.explode("categories")).join(known, ["economy", "category"], "left")
    left = parts.groupBy("economy", "aggregate_id").agg((F.max("amount") - F.coalesce(F.sum("known"), F.lit(0.0))).alias("residual"))
    want = parts.filter("known is null").select(F.col("economy").alias("target"), "aggregate_id", "category")
    nearest = cut(donor_pool(distances, ImputationPolicy(policy.categories, policy.donor_count, 1)))
    shares = donor_template(want, nearest, vectors, policy, ("target", "aggregate_id")).withColumnRenamed("target", "economy").join(left, ["economy", "aggregate_id"])

    def filled(rows: DataFrame, evidence: Column) -> DataFrame:
        amount = F.when(F.col("residual") > 0, F.col("residual"))
        return _values(rows, amount, policy).select(
            "economy", "category", "central", "lower", "upper", evidence.alias("evidence_class"), "donors",
            F.when(amount.isNull(), "NONPOSITIVE_RESIDUAL").otherwise("IMPUTED").alias("status"))

    own = cut(filled(shares, F.lit("C_OWN_ECONOMY_ESTIMATE")))
    so_far = observed.unionByName(own)
    grid = profiles.select("economy", "total_real").withColumn("category", F.explode(F.array(*[F.lit(c) for c in policy.categories])))
    held = so_far.groupBy("economy").agg(F.sum("central").alias("held"))
    rest = profiles.select("economy", "total_real").join(held, "economy", "left").select("economy", (F.col("total_real") - F.coalesce("held", F.lit(0.0))).alias("residual"))
    gaps = grid.join(so_far.select("economy", "category"), ["economy", "category"], "left_anti").select(F.col("economy").alias("target"), "category")
    template = donor_template(gaps, pool, vectors, policy).withColumnRenamed("target", "economy").join(rest, "economy")
    fallback = F.col("method") != "D_DONOR"
    template = template.withColumn("donors", F.when(fallback, "").otherwise(F.col("donors")))
    return so_far.unionByName(filled(template, F.when(fallback, "E_REGIONAL_GLOBAL_FALLBACK").otherwise("D_DONOR_IMPUTATION")))


def validate_imputation(cells: DataFrame, profiles: DataFrame, policy: ImputationPolicy) -> DataFrame:
    """Leave-one-economy-out predictions of complete A/B economies: whole grid (D or E) and allocation groups (C)."""
    vectors = cut(core_vectors(cells, policy))
    distances = cut(donor_distance(profiles, vectors))
    targets = vectors.select(F.col("donor").alias("target"), "category", F.col("value").alias("actual"))
    groups = F.array(F.struct(F.lit("").alias("group_id"), F.array(*[F.lit(c) for c in policy.categories]).alias("members")), *[
        F.struct(F.lit(name).alias("group_id"), F.array(*[F.lit(c) for c in members]).alias("members")) for name, members in policy.allocation_groups])
    need = targets.withColumn("g", F.explode(groups)).filter(F.array_contains("g.members", F.col("category"))).select("target", F.col("g.group_id").alias("group_id"), "category", "actual")
    whole = donor_template(need.filter("group_id = ''"), donor_pool(distances, policy), vectors, policy, ("target", "group_id"))
    nearest = donor_pool(distances, ImputationPolicy(policy.categories, policy.donor_count, 1))
    grouped = donor_template(need.filter("group_id <> ''"), nearest, vectors, policy, ("target", "group_id")).withColumn("method", F.lit("C_OWN_AGGREGATE"))
    total = F.sum("actual").over(Window.partitionBy("target", "group_id"))
    rows = whole.unionByName(grouped).join(need.withColumn("amount", total), ["target", "group_id", "category"])
    amount = F.col("amount")
    out = rows.select(
        "target", "group_id", "category", F.concat("method", F.lit("_LOO")).alias("method"), "actual", (amount * F.col("share")).alias("predicted"),
        (amount * F.col("lower_share")).alias("lower"), (amount * F.col("upper_share")).alias("upper"))
    error = F.col("predicted") - F.col("actual")
    return out.withColumn("error", error).withColumn("ape", F.when(F.col("actual") != 0, F.abs(error) / F.abs("actual"))).withColumn(
        "covered", F.col("actual").between(F.col("lower"), F.col("upper")))


def validation_summary(predictions: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    return predictions.groupBy(*by).agg(
        F.count("*").alias("predictions"), F.count_distinct("target").alias("economies"), F.avg(F.abs("error")).alias("mae"), F.avg("ape").alias("mape"),
        F.avg("error").alias("bias"), F.avg(F.col("covered").cast("double")).alias("coverage"))


def weight_release(cells: DataFrame) -> DataFrame:
    """Central weights and bounds l / (l + sum U - u), u / (u + sum L - l); core weights over class A and B cells."""
    core = F.substring("evidence_class", 1, 1).isin("A", "B")
    totals = cells.agg(F.struct(F.sum("central").alias("c"), F.sum("lower").alias("l"), F.sum("upper").alias("u"), F.sum(F.when(core, F.col("central"))).alias("core"))).scalar()
    low, high = F.col("lower"), F.col("upper")
    return cells.withColumn("t", totals).select(
        "economy", "category", "evidence_class", (F.col("central") / F.col("t.c")).alias("weight"), (low / (low + F.col("t.u") - high)).alias("weight_lower"),
        (high / (high + F.col("t.l") - low)).alias("weight_upper"), F.when(core, F.col("central") / F.col("t.core")).alias("core_weight"))


def weight_release_gate(shares: DataFrame, summary: DataFrame, complete_grid: DataFrame, thresholds: Mapping[str, float]) -> DataFrame:
    """Eleven checks with observed value, threshold and pass flag. ``shares`` and ``summary`` are one-row tables.

    ``summary`` also says how the validation was made: ``leave_one_out``, ``result_driven_donor_selection`` and ``monetary_release_allowed``.
    """
    fact = {name: shares.select(name).scalar().cast("double") for name in ("estimated_share", "class_e_share", "metric_coverage")}
    fact |= {name: summary.select(name).scalar().cast("double") for name in ("economies", "predictions", "mape", "coverage")}
    at_most = ("estimated_share", "class_e_share", "mape")
    row = complete_grid.agg(F.count_if("hole").alias("holes"))
    row = row.withColumns(fact)
    checks = [F.struct(F.lit("complete_grid").alias("check"), (F.col("holes") == 0).cast("double").alias("observed"), F.lit(1.0).alias("threshold"), (F.col("holes") == 0).alias("passed"))]
    for name in fact:
        limit = float(thresholds[name])
        checks.append(F.struct(F.lit(name).alias("check"), F.col(name).alias("observed"), F.lit(limit).alias("threshold"),
                               (F.col(name) <= limit if name in at_most else F.col(name) >= limit).alias("passed")))
    stated = (
        ("leave_one_out_validation", "leave_one_out", True), ("result_driven_donor_selection_disabled", "result_driven_donor_selection", False),
        ("validation_monetary_release_blocked", "monetary_release_allowed", False))
    row = row.withColumns({name: F.coalesce(summary.select(column).scalar(), F.lit(not wanted)) == wanted for name, column, wanted in stated})
    for name, _, _ in stated:
        checks.append(F.struct(F.lit(name).alias("check"), F.col(name).cast("double").alias("observed"), F.lit(1.0).alias("threshold"), F.col(name).alias("passed")))
    return row.select(F.explode(F.array(*checks)).alias("c")).select("c.*")
