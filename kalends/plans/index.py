"""Price-index pipelines: rebase, select, index, pilot universe, vertical and headline series, currency separation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from kalends.operators import aggregates, checks, joins, sets, windows
from kalends.session import cut


def normalize_prices(definitions: DataFrame, obs: DataFrame, reference: str) -> DataFrame:
    """Enabled series rebased to 100 at the reference month, one row per target category.

    One pass: observations are dealt by series once; the check for repeated months, the reference value and the join with the
    definitions all use that. Repeated series-months or definitions, and observations of series that no definition knows, stop the
    job. Other columns of ``obs``, such as its provider, dataset, dates and flags, stay on their rows.
    """
    kept = [c for c in obs.columns if c not in ("series_id", "period", "value")]
    rows = checks.unrepeated(obs, ["series_id"], ["period"], "repeated series-months")
    base = F.max(F.when(F.col("period") == reference, F.struct("value"))).over(Window.partitionBy("series_id"))
    known = checks.unrepeated(definitions, ["series_id"], [], "repeated series definitions").withColumn("known", F.lit(True))
    rows = checks.stop_where(rows.withColumn("base", base).join(known, "series_id", "left"), F.col("known").isNull(), "unknown series", "series_id")
    rebased = rows.filter("enabled and base is not null").withColumn("price_relative", F.lit(100.0) * F.col("value") / F.col("base.value"))
    return rebased.withColumn("category", F.explode("target_categories")).select(
        "series_id", "economy", "category", "period", "price_relative", "evidence_class", "source_priority", *kept)


def missing_reference(definitions: DataFrame, obs: DataFrame, reference: str) -> DataFrame:
    """Enabled observed series without a value in the reference month."""
    seen = obs.join(definitions.filter("enabled").select("series_id"), "series_id", "left_semi").select("series_id").distinct()
    return seen.join(obs.filter(F.col("period") == reference), "series_id", "left_anti")


def monthly_indices(global_weights: DataFrame, core_weights: DataFrame, selected: DataFrame) -> dict[str, DataFrame]:
    """Global and core index with contributions and evidence coverage; incomplete months carry no value."""
    prices = selected.select("economy", "category", "period", "price_relative", "evidence_class")
    grid = cut(sets.stack_indices(
        GLOBAL=joins.attach_weights(prices, global_weights), CORE=joins.attach_weights(prices, core_weights)))
    index = aggregates.fixed_weight_index(grid, ("index_id", "period"))
    complete = index.filter("status = 'COMPLETE'").select("index_id", "period")
    contributions = grid.join(complete, ["index_id", "period"], "left_semi").select(
        "index_id", "period", "economy", "category", "weight", "price_relative", (F.col("weight") * F.col("price_relative")).alias("points"),
        (F.col("weight") * (F.col("price_relative") - 100)).alias("contribution_since_reference"), "evidence_class")
    return {"index": index, "contributions": contributions, "coverage": aggregates.evidence_coverage(grid, ("index_id", "period"))}


def fixed_universe_pilot(weights: DataFrame, selected: DataFrame, mapping: DataFrame, reference: str, categories: Sequence[str],
                         minimum_months: int) -> dict[str, DataFrame]:
    """Economies with a long enough complete run from the reference month, weights normalised once, index over the common months."""
    prefix = cut(windows.complete_prefix(selected, reference, len(categories), minimum_months))
    passing = prefix.filter("passes")
    months = cut(windows.common_interval(prefix, selected, reference, categories))
    held = weights.join(passing, "economy", "left_semi")
    covered = held.agg(F.sum("weight")).scalar()
    fixed = held.withColumn("covered_world_weight", covered).withColumn("weight", F.col("weight") / F.col("covered_world_weight"))
    common = months.filter("reason = 'COMMON'").select("period")
    cells = selected.join(common, "period", "left_semi").join(fixed, ["economy", "category"])
    index = cells.groupBy("period").agg(
        F.sum(F.col("weight") * F.col("price_relative")).alias("value"), F.max("covered_world_weight").alias("covered_world_weight"),
        F.count("*").alias("cells"))
    return {"index": index, "contributions": aggregates.canonical_merge(cells, mapping), "months": months, "universe": prefix}


def vertical_series(obs: DataFrame, weights: DataFrame, base_year: int) -> dict[str, DataFrame]:
    """Annual-base relatives times fixed weights: index, monthly change and contributions by dimension."""
    relatives = aggregates.annual_base_relatives(obs, base_year, ["economy", "category"])
    cells = cut(relatives.withColumn("price_relative", 100 * F.col("relative")).join(weights, ["economy", "category"]))
    index = cells.groupBy("period").agg(F.sum(F.col("weight") * F.col("price_relative")).alias("value")).withColumn("index_id", F.lit("VERTICAL"))
    return {
        "index": windows.index_change(index).drop("index_id"), "cells": cells,
        "by_economy": aggregates.contributions_by(cells, ["economy"]), "by_category": aggregates.contributions_by(cells, ["category"])}


def headline_series(headline: DataFrame, weights: DataFrame, base_year: int) -> DataFrame:
    """Equal-economy and economy-weighted index of headline relatives."""
    economy = weights.groupBy("economy").agg(F.sum("weight").alias("economy_weight"))
    relatives = aggregates.annual_base_relatives(headline, base_year, ["economy"]).join(economy, "economy")
    return relatives.groupBy("period").agg(
        (100 * F.avg("relative")).alias("equal_index"), (100 * F.sum(F.col("relative") * F.col("economy_weight"))).alias("weighted_index"))


# What rates and price relatives must be.
RATE_CONVENTION, PRICE_BASIS = "CURRENCY_UNITS_PER_EUR", "LOCAL_CURRENCY_RELATIVE"


def _local_cells(cells: DataFrame, reference: str, universe: DataFrame | None) -> DataFrame:
    """``cells`` of one universe with fixed weights, the reference month's unless given; its months are folded once, in a job of its own."""
    if "price_basis" in cells.columns:
        cells = checks.stop_where(cells, ~F.col("price_basis").eqNullSafe(PRICE_BASIS), "prices of another basis, converted twice", "economy", "category", "period", "price_basis").drop("price_basis")
    base = cells.filter(F.col("period") == reference) if universe is None else universe
    base = base.select("economy", "category", F.col("weight").alias("base_weight"))
    base = checks.valid_weights(checks.unrepeated(base, ["economy", "category"], [], "repeated cells"), "base_weight", 1e-9)
    moved = (~(F.abs(F.col("weight") - F.col("base_weight")) <= 1e-12)).cast("int")
    months = (checks.whole_months if universe is None else checks.single_cells)(cells, base, moved=F.coalesce(moved, F.lit(1)))
    cut(checks.stop_where(months, F.col("moved") > 0, "weights that change", "period", "moved"))
    return cells


def _single_assignments(assignments: DataFrame) -> DataFrame:
    """``assignments``, stopping at one that begins before an earlier one of its economy has ended."""
    until = F.when(F.coalesce("effective_to", F.lit("")) == "", "9999-12").otherwise(F.col("effective_to"))
    order = Window.partitionBy("economy").orderBy("effective_from", until, "currency").rowsBetween(Window.unboundedPreceding, -1)
    marked = assignments.withColumn("_occupied", F.max(until).over(order))
    return checks.stop_where(marked, F.col("_occupied") >= F.col("effective_from"), "overlapping currency assignments", "economy", "currency", "effective_from").drop("_occupied")


def fx_separation(cells: DataFrame, assignments: DataFrame, fx: DataFrame, reference: str, universe: DataFrame | None = None) -> dict[str, DataFrame]:
    """Local-price index beside a common-currency cost index; uncovered weight is reported, never renormalised.

    ``cells``: period, economy, category, weight, price_relative on a fixed universe. Rates are attached per
    economy-month, not per cell, before the cells are joined; a null rate is one that was not published. These stop the job:
    repeated cells, a month that lacks a cell of the reference month or has another, weights that change or do not sum up to 1, prices of
    another basis than ``PRICE_BASIS`` (where ``cells`` has a ``price_basis``), repeated rates, rates that are not positive or of
    another convention than ``RATE_CONVENTION`` (where ``fx`` has a ``convention``), and assignments that overlap.

    With a ``universe`` (economy, category, weight) the weights are its, and months may lack cells: such a month stays, its local
    index sums the cells that are there, and the weight of the others is missing, so it has no common index.
    """
    cells = _local_cells(cells, reference, universe)
    fx = checks.unrepeated(fx, ["currency"], ["period"], "repeated exchange rates")
    fx = checks.stop_where(fx, F.col("rate").isNotNull() & ~checks.finite_positive(F.col("rate") * F.col("redenomination")), "exchange rates that are not positive", "currency", "period", "rate")
    if "convention" in fx.columns:
        fx = checks.stop_where(fx, ~F.col("convention").eqNullSafe(RATE_CONVENTION), "rates of another convention", "currency", "period", "convention").drop("convention")
    assignments = _single_assignments(assignments)
    valid = joins.assign_currency(cells, assignments).drop("matches")
    rated = joins.attach_fx(valid, fx, reference)
    base = valid.filter(F.col("period") == reference).select("economy", F.col("currency").alias("reference_currency"))
    moved = F.col("currency") != F.col("reference_currency")
    unknown = F.col("currency").isNull() | F.col("reference_currency").isNull()
    reason = (
        F.when(unknown, "NO_SINGLE_CURRENCY")
        .when(moved, F.concat_ws("_", F.lit("UNRATIFIED_CURRENCY_TRANSITION"), "reference_currency", F.lit("TO"), "currency"))
        .when(F.col("current_fx").isNull() | F.col("reference_fx").isNull(), "MISSING_FX").otherwise(""))
    economy = cut(rated.join(base, "economy", "left").withColumn("reason", reason).withColumn(
        "factor", F.when(reason == "", F.col("reference_fx") / F.col("current_fx"))))
    joined = cells.join(economy.select("economy", "period", "currency", "reason", "factor"), ["economy", "period"])
    covered = F.coalesce(F.sum(F.when(F.col("factor").isNotNull(), F.col("weight"))), F.lit(0.0))
    index = joined.groupBy("period").agg(
        F.sum(F.col("weight") * F.col("price_relative")).alias("local_index"),
        F.sum(F.col("weight") * F.col("price_relative") * F.col("factor")).alias("_common"), covered.alias("covered_weight"))
    complete = F.abs(F.col("covered_weight") - 1) <= 1e-9
    coverage = joined.groupBy("period", "economy", "currency", "reason").agg(F.sum("weight").alias("weight"))
    return {
        "index": index.select(
            "period", "local_index", F.when(complete, F.col("_common")).alias("common_index"),
            F.when(complete, "COMPLETE").otherwise("INCOMPLETE_FX").alias("status"), "covered_weight",
            F.greatest(F.lit(0.0), 1 - F.col("covered_weight")).alias("missing_weight")),
        "coverage": coverage.withColumn("fx_available", F.col("reason") == "")}
