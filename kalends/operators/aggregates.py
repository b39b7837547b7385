"""Index sums, coverage and error metrics. All group with partial aggregation; totals come from grouped rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kalends.functions.classes import EVIDENCE_CLASSES, is_direct
from kalends.operators import ranks

COMPLETE_TOLERANCE = 1e-9


def fixed_weight_index(cells: DataFrame, keys: Sequence[str] = ("period",)) -> DataFrame:
    """Weighted sum of relatives per month; null and INCOMPLETE unless the covered weight is one.

    ``cells`` is the full weight grid of each month (``attach_weights``) with ``evidence_class``.
    """
    held = F.col("price_relative").isNotNull()
    weight = lambda condition: F.coalesce(F.sum(F.when(condition, F.col("weight"))), F.lit(0.0))
    holes = F.array_sort(F.collect_list(F.when(~held, F.struct("economy", "category"))))
    sums = cells.groupBy(*keys).agg(
        F.sum(F.col("weight") * F.col("price_relative")).alias("weighted"), weight(held).alias("covered_weight"),
        weight(held & is_direct(F.col("evidence_class"))).alias("direct_weight"), F.count_if(~held).alias("missing_cell_count"),
        F.array_join(F.transform(holes, lambda h: F.concat_ws(":", h["economy"], h["category"])), "|").alias("missing_cells"))
    complete = F.abs(F.col("covered_weight") - 1) <= COMPLETE_TOLERANCE
    return sums.select(
        *keys, F.when(complete, F.col("weighted")).alias("value"), F.when(complete, "COMPLETE").otherwise("INCOMPLETE").alias("status"),
        "covered_weight", "direct_weight", (F.col("covered_weight") - F.col("direct_weight")).alias("proxy_weight"),
        "missing_cell_count", "missing_cells")


def contributions_by(cells: DataFrame, dims: Sequence[str]) -> DataFrame:
    """Index points and share of the month's index per value of ``dims``; ``cells`` has weight and price_relative."""
    points = cells.groupBy("period", *dims).agg(F.sum(F.col("weight") * F.col("price_relative")).alias("contribution"))
    total = F.sum("contribution").over(Window.partitionBy("period"))
    return points.withColumn("share", F.col("contribution") / total)


def canonical_merge(cells: DataFrame, mapping: DataFrame) -> DataFrame:
    """Source categories merged into canonical ones: summed weight and points, and their implied relative."""
    mapped = cells.join(mapping.select("source_category", "canonical"), F.col("category") == F.col("source_category"))
    merged = mapped.groupBy("period", "economy", "canonical").agg(
        F.sum("weight").alias("weight"), F.sum(F.col("weight") * F.col("price_relative")).alias("points"),
        F.sum(F.col("weight") * (F.col("price_relative") - 100)).alias("contribution_since_reference"),
        F.array_sort(F.collect_set("category")).alias("codes"))
    return merged.select(
        "period", "economy", "canonical", "weight", "points", (F.col("points") / F.col("weight")).alias("price_relative"),
        "contribution_since_reference", F.array_join("codes", "|").alias("source_categories"),
        F.when(F.size("codes") == 1, "EXACT_ONE_TO_ONE").otherwise("EXACT_MERGE").alias("mapping_type"))


def evidence_coverage(cells: DataFrame, keys: Sequence[str] = ("period",), classes: Sequence[str] = EVIDENCE_CLASSES) -> DataFrame:
    """Weight per month and evidence class, zero where a class is absent."""
    held = F.col("price_relative").isNotNull()
    share = lambda name: F.coalesce(F.sum(F.when(held & (F.col("evidence_class") == name), F.col("weight"))), F.lit(0.0))
    wide = cells.groupBy(*keys).agg(*[share(name).alias(name) for name in classes])
    return wide.unpivot(list(keys), list(classes), "evidence_class", "weight_share")


def annual_base_relatives(obs: DataFrame, year: int, keys: Sequence[str], value: str = "unit_price") -> DataFrame:
    """value over its mean in the base year; cells without all twelve base months drop out."""
    base = obs.filter(F.col("period").startswith(f"{year:04d}-")).groupBy(*keys).agg(
        F.avg(value).alias("base_value"), F.count_distinct("period").alias("base_months")).filter("base_months = 12")
    return obs.join(base.drop("base_months"), list(keys)).withColumn("relative", F.col(value) / F.col("base_value"))


def weighted_mean_factor(df: DataFrame, keys: Sequence[str], value: str, weight: str) -> DataFrame:
    """Weighted and simple mean; null when there is nothing to average."""
    return df.groupBy(*keys).agg(
        F.try_divide(F.sum(F.col(value) * F.col(weight)), F.sum(F.when(F.col(value).isNotNull(), F.col(weight)))).alias("weighted_mean"),
        F.avg(value).alias("simple_mean"), F.count(value).alias("items"))


def error_metrics(cases: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Count, MAE, MAPE, RMSE, bias, interval coverage and bps statistics; p95 is interpolated.

    ``cases``: error, ape (percent), bps (absolute), covered (boolean).
    """
    keys = list(keys)
    sums = cases.groupBy(*keys).agg(
        F.count("*").alias("case_count"), F.avg(F.abs("error")).alias("mae"), F.avg("ape").alias("mape"),
        F.sqrt(F.avg(F.col("error") * F.col("error"))).alias("rmse"), F.avg("error").alias("bias"),
        F.avg(F.col("covered").cast("double")).alias("coverage"), F.avg("bps").alias("mean_bps"), F.max("bps").alias("max_bps"))
    tail = ranks.percentile_linear(cases, keys, "bps", {"p95_bps": 0.95})
    return sums.join(tail, keys) if keys else sums.withColumn("p95_bps", tail.scalar())


def paired_rates(deltas: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distribution of challenger minus baseline: mean, median, p95, extremes and outcome rates."""
    keys = list(keys)
    sums = deltas.groupBy(*keys).agg(
        F.count("*").alias("case_count"), F.count_if(F.col("delta") < 0).alias("improvements"), F.count_if(F.col("delta") > 0).alias("regressions"),
        F.avg("challenger").alias("mean_challenger"), F.avg("baseline").alias("mean_baseline"), F.avg("delta").alias("mean_delta"),
        F.greatest(F.max("delta"), F.lit(0.0)).alias("worst_regression"), F.greatest(-F.min("delta"), F.lit(0.0)).alias("best_improvement"))
    tails = ranks.percentile_linear(deltas, keys, "delta", {"median_delta": 0.5, "p95_delta": 0.95})
    joined = sums.join(tails, keys)
    return joined.withColumn("improvement_rate", F.col("improvements") / F.col("case_count")).withColumn(
        "regression_rate", F.col("regressions") / F.col("case_count")).withColumn(
        "tie_rate", 1 - (F.col("improvements") + F.col("regressions")) / F.col("case_count"))


def scoped_rollup(df: DataFrame, scopes: Sequence[tuple[str, Sequence[str]]], by: Sequence[str], aggregates: Sequence[Column]) -> DataFrame:
    """The same metrics at several scopes in one pass; columns outside a scope read ``*``.

    ``scopes`` names each set of scope columns; ``by`` columns belong to every scope.
    """
    columns = list(dict.fromkeys(c for _, names in scopes for c in names))
    sets = [[*names, *by] for _, names in scopes]
    flags = [F.grouping(c).alias(f"_g_{c}") for c in columns]
    grouped = df.groupingSets(sets, *columns, *by).agg(*flags, *aggregates)
    label = F.lit(None).cast("string")
    for name, names in scopes:
        match = F.lit(True)
        for c in columns:
            match &= F.col(f"_g_{c}") == (0 if c in names else 1)
        label = F.when(match, name).otherwise(label)
    kept = [F.when(F.col(f"_g_{c}") == 1, "*").otherwise(F.col(c).cast("string")).alias(c) for c in columns]
    rest = [c for c in grouped.columns if c not in columns and not c.startswith("_g_")]
    return grouped.select(label.alias("scope"), *kept, *rest)


def coverage_extremes(coverage: DataFrame, direct: Sequence[str] = EVIDENCE_CLASSES[:2], headline: str = EVIDENCE_CLASSES[2],
                      world: str = EVIDENCE_CLASSES[4]) -> DataFrame:
    """Over months: smallest direct weight, largest headline and largest world-proxy weight."""
    share = lambda rule: F.coalesce(F.sum(F.when(rule, F.col("weight_share"))), F.lit(0.0))
    name = F.col("evidence_class")
    monthly = coverage.groupBy("period").agg(
        share(name.isin(*direct)).alias("direct"), share(name == headline).alias("p3"), share(name == world).alias("p5"))
    return monthly.agg(F.min("direct").alias("minimum_direct_weight"), F.max("p3").alias("maximum_p3_weight"), F.max("p5").alias("maximum_p5_weight"))


def smallest_group(df: DataFrame, field: str) -> DataFrame:
    return df.groupBy(field).agg(F.count("*").alias("n")).agg(F.coalesce(F.min("n"), F.lit(0)).alias("smallest_group"))


def evidence_weight_shares(cells: DataFrame) -> DataFrame:
    """Core, estimated and class-E shares of expenditure, and share of estimated cells with both metrics."""
    letter = F.substring("evidence_class", 1, 1)
    estimated = letter.isin("C", "D", "E")
    total = F.sum("central")
    share = lambda rule: F.coalesce(F.sum(F.when(rule, F.col("central"))), F.lit(0.0)) / total
    measured = F.count_if(estimated & F.col("validation_mae").isNotNull() & F.col("validation_bias").isNotNull())
    return cells.agg(
        F.count("*").alias("cells"), F.count_if(estimated).alias("estimated_cells"), share(~estimated).alias("core_share"),
        share(estimated).alias("estimated_share"), share(letter == "E").alias("class_e_share"),
        F.when(F.count_if(estimated) == 0, 1.0).otherwise(measured / F.count_if(estimated)).alias("metric_coverage"))


def category_coverage(cells: DataFrame, registry: DataFrame, required: Sequence[str]) -> DataFrame:
    """Per registered economy: categories held, required, complete and the missing list."""
    held = cells.groupBy("economy").agg(F.collect_set("category").alias("held"))
    want = F.array(*[F.lit(c) for c in sorted(required)])
    present = F.coalesce("held", F.array().cast("array<string>"))
    return registry.join(held, "economy", "left").select(
        "economy", F.size(present).alias("available"), F.lit(len(required)).alias("required"), (F.size(present) == len(required)).alias("complete"),
        F.array_join(F.array_except(want, present), "|").alias("missing"))


def reconcile_total(items: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Accepted plus excluded parts against the published total; ``role`` is ACCEPTED, EXCLUDED or TOTAL."""
    part = lambda role: F.coalesce(F.sum(F.when(F.col("role") == role, F.col("amount"))), F.lit(0).cast("decimal(18,2)"))
    sums = items.groupBy(*keys).agg(part("TOTAL").alias("source_total"), part("ACCEPTED").alias("accepted_total"), part("EXCLUDED").alias("excluded_total"))
    again = F.col("accepted_total") + F.col("excluded_total")
    gap = F.col("source_total") - again
    return sums.withColumn("reconstructed_total", again).withColumn("difference", gap).withColumn(
        "status", F.when(gap == 0, "PASS").otherwise("FAIL"))
