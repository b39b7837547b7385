"""Joins between price cells, weights, currencies, donors and release dates.

Grids come from exploding bounded lists (months, fixed categories), never from a cross join.
The one theta join pairs economies with economies: a dimension of countries, whatever the size
of the fact tables. No broadcast hints; size estimates and adaptive execution choose.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kalends.functions.months import month_number, months_between, shift_month
from kalends.functions.text import normalize_name


def with_periods(df: DataFrame, source: DataFrame) -> DataFrame:
    """Every row of ``df`` for every month that occurs in ``source``."""
    months = source.agg(F.array_sort(F.collect_set("period"))).scalar()
    return df.withColumn("_months", months).withColumn("period", F.explode("_months")).drop("_months")


def attach_weights(panel: DataFrame, weights: DataFrame) -> DataFrame:
    """Each weight cell for each month of the panel; ``price_relative`` is null where the panel has a hole."""
    return with_periods(weights, panel).join(panel, ["economy", "category", "period"], "left")


def map_categories(df: DataFrame, mapping: DataFrame) -> DataFrame:
    """Source categories to canonical ones through a bridge (source_category, canonical, mapping_type)."""
    return df.join(mapping, F.col("category") == F.col("source_category")).drop("source_category")


def assign_currency(cells: DataFrame, assignments: DataFrame) -> DataFrame:
    """The currency valid in each economy-month and how many assignments matched; exactly one is valid.

    Validity intervals are unrolled to months within the cells' bounds, so the interval join is an equi-join.
    """
    keys = cells.select("economy", "period").distinct()
    last = cells.agg(F.max("period")).scalar()
    until = F.least(F.when(F.coalesce("effective_to", F.lit("")) == "", "9999-12").otherwise(F.col("effective_to")), F.col("last"))
    valid = (
        assignments.withColumn("last", last).withColumn("until", until).filter("effective_from <= until")
        .select("economy", "currency", F.explode(months_between(F.col("effective_from"), F.col("until"))).alias("period"))
        .groupBy("economy", "period").agg(F.count("*").alias("matches"), F.min("currency").alias("currency"))
    )
    matches = F.coalesce("matches", F.lit(0))
    return keys.join(valid, ["economy", "period"], "left").select(
        "economy", "period", matches.cast("long").alias("matches"), F.when(matches == 1, F.col("currency")).alias("currency"))


def attach_fx(cells: DataFrame, fx: DataFrame, reference: str, numeraire: str = "EUR") -> DataFrame:
    """Current and reference rate (units per numeraire, redenominated) of each cell's currency; the numeraire is 1.

    ``cells`` carries ``currency``; ``fx`` is currency, period, rate, redenomination.
    """
    rates = fx.select("currency", "period", (F.col("rate") * F.col("redenomination")).alias("current_fx"))
    base = rates.filter(F.col("period") == reference).select("currency", F.col("current_fx").alias("reference_fx"))
    home = F.col("currency") == numeraire
    joined = cells.join(rates, ["currency", "period"], "left").join(base, "currency", "left")
    return joined.withColumn("current_fx", F.when(home, 1.0).otherwise(F.col("current_fx"))).withColumn(
        "reference_fx", F.when(home, 1.0).otherwise(F.col("reference_fx")))


def monthly_rates(levels: DataFrame, keys: Sequence[str], value: str, out: str = "rate") -> DataFrame:
    """value / value of the previous calendar month - 1; null across a gap. One partition holds one cell's months."""
    order = Window.partitionBy(*keys).orderBy("period")
    adjacent = month_number(F.col("period")) - F.lag(month_number(F.col("period"))).over(order) == 1
    return levels.withColumn(out, F.when(adjacent, F.col(value) / F.lag(value).over(order) - 1))


def covariate_scales(profiles: DataFrame) -> DataFrame:
    """One row: map from covariate to its range over economies, 1 where the range is 0."""
    spread = profiles.select(F.explode("covariates").alias("name", "x")).groupBy("name").agg((F.max("x") - F.min("x")).alias("spread"))
    return spread.agg(F.map_from_entries(F.collect_list(
        F.struct("name", F.when(F.col("spread") > 0, F.col("spread")).otherwise(1.0).alias("scale")))).alias("scales"))


def paired(left: DataFrame, right: DataFrame, regions: Column, own_only: bool = False) -> DataFrame:
    """Targets ``t_economy`` of ``left`` with donors ``d_economy`` of ``right``, block by block: an equi-join on the donor's region.

    ``regions`` is the array of all regions, a small fixed list with "" for null; with ``own_only`` a target meets its own region only.
    """
    known = lambda name: F.coalesce(F.col(name), F.lit(""))
    rows = left.withColumn("_blocks", F.array(known("t_region")) if own_only else regions).withColumn("_block", F.explode("_blocks")).drop("_blocks")
    return rows.join(right.withColumn("_own", known("d_region")), (F.col("_block") == F.col("_own")) & (F.col("t_economy") != F.col("d_economy"))).drop("_block", "_own")


def donor_pairs(profiles: DataFrame, weights: DataFrame, same_region: bool | None = None) -> DataFrame:
    """target, donor, same_region, income_match, overlap, distance and similarity weight for economy pairs.

    Distance is the mean range-scaled covariate difference, 1 for a covariate only one side has.
    Similarity weight is the donor's world weight times (1 + income match + overlap) over (1 + distance).
    """
    world = weights.groupBy("economy").agg(F.sum("weight").alias("world_weight"))
    scaled = profiles.withColumn("scales", covariate_scales(profiles).scalar())
    left = scaled.select(*[F.col(c).alias(f"t_{c}") for c in ("economy", "region", "income_group", "characteristics", "covariates", "scales")])
    right = profiles.join(world, "economy").select(
        *[F.col(c).alias(f"d_{c}") for c in ("economy", "region", "income_group", "characteristics", "covariates", "world_weight")])
    regions = profiles.agg(F.array_distinct(F.collect_list(F.coalesce("region", F.lit("")))).alias("r")).scalar()
    names = F.array_union(F.map_keys("t_covariates"), F.map_keys("d_covariates"))
    gap = lambda n: F.coalesce(F.abs(F.col("t_covariates")[n] - F.col("d_covariates")[n]) / F.col("t_scales")[n], F.lit(1.0))
    distance = F.when(F.size(names) == 0, 0.0).otherwise(F.aggregate(F.array_sort(names), F.lit(0.0), lambda s, n: s + gap(n)) / F.size(names))
    income = (F.col("t_income_group") == F.col("d_income_group")).cast("int")
    overlap = F.size(F.array_intersect("t_characteristics", "d_characteristics"))
    return paired(left, right, regions, bool(same_region)).select(
        F.col("t_economy").alias("target"), F.col("d_economy").alias("donor"), (F.col("t_region") == F.col("d_region")).alias("same_region"),
        income.alias("income_match"), overlap.alias("overlap"), distance.alias("distance"),
        (F.col("d_world_weight") * (1 + income + overlap) / (1 + distance)).alias("similarity"))


def history_residuals(residuals: DataFrame, pairs: DataFrame) -> DataFrame:
    """Donor residuals of all months up to each month: count, weight and extremes per target and category.

    Months are summed over donors first; a running window over one cell's months replaces the range join.
    """
    monthly = residuals.join(pairs.select("target", "donor", "similarity"), "donor").groupBy("target", "category", "period").agg(
        F.count("*").alias("n"), F.sum("similarity").alias("w"), F.min("residual").alias("lo"), F.max("residual").alias("hi"))
    upto = Window.partitionBy("target", "category").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    return monthly.select(
        "target", "category", "period", F.sum("n").over(upto).alias("residual_count"), F.sum("w").over(upto).alias("total_weight"),
        F.min("lo").over(upto).alias("lowest"), F.max("hi").over(upto).alias("highest"))


def as_of_panel(panel: DataFrame, calendar: DataFrame, as_of: str | Column) -> DataFrame:
    """Cells whose month was released on or before the decision date."""
    day = F.to_date(F.lit(as_of)) if isinstance(as_of, str) else as_of
    return panel.join(calendar, "period").filter(F.col("release_date") <= day)


def rolling_origin_pairs(periods: DataFrame, horizons: Sequence[int], window: tuple[str, str]) -> DataFrame:
    """origin, target, horizon with the target inside the window and present; origins start one month before it."""
    known = periods.select("period").distinct()
    origins = known.filter((F.col("period") >= shift_month(F.lit(window[0]), -1)) & (F.col("period") < window[1]))
    pairs = origins.select(F.col("period").alias("origin"), F.explode(F.array(*[F.lit(h) for h in horizons])).alias("horizon")).withColumn(
        "target", shift_month(F.col("origin"), F.col("horizon")))
    return pairs.filter(F.col("target").between(*window)).join(
        known.withColumnRenamed("period", "target"), "target", "left_semi").select("origin", "target", "horizon")


def map_names_to_codes(names: DataFrame, registry: DataFrame, aliases: DataFrame) -> DataFrame:
    """Official names to codes: an alias to a code, an alias to a name, or the normalised name itself.

    names(name), registry(code, label), aliases(name, alias). More than one candidate is ambiguous, none unresolved.
    """
    by_name = registry.groupBy(normalize_name(F.col("label")).alias("lookup")).agg(
        F.count("*").alias("candidates"), F.min(F.struct("code", "label")).alias("hit"))
    by_code = registry.groupBy(F.upper("code").alias("code_key")).agg(F.min(F.struct("code", "label")).alias("code_hit"))
    known = aliases.select(normalize_name(F.col("name")).alias("normalized"), F.trim("alias").alias("alias")).filter("alias <> ''")
    method = (
        F.when(F.col("code_hit").isNotNull(), "EXPLICIT_CODE_ALIAS").when(F.col("alias").isNotNull(), "EXPLICIT_NAME_ALIAS")
        .otherwise("NORMALIZED_EXACT"))
    found = F.when(F.col("code_hit").isNotNull(), 1).otherwise(F.coalesce("candidates", F.lit(0)))
    hit = F.coalesce("code_hit", "hit")
    return (
        names.withColumn("normalized", normalize_name(F.col("name"))).join(known, "normalized", "left")
        .withColumn("code_key", F.upper("alias")).join(by_code, "code_key", "left")
        .withColumn("lookup", F.when(F.col("alias").isNotNull(), normalize_name(F.col("alias"))).otherwise(F.col("normalized")))
        .join(by_name, "lookup", "left")
        .select("name", "normalized", F.when(found == 1, hit["code"]).otherwise("").alias("code"),
                F.when(found == 1, hit["label"]).otherwise("").alias("label"), method.alias("method"),
                F.when(found == 1, "MAPPED").when(found == 0, "UNRESOLVED").otherwise("AMBIGUOUS").alias("status")))


def complete_entities(cells: DataFrame, required: int, key: str = "economy", item: str = "category") -> tuple[DataFrame, DataFrame]:
    """Cells of entities that hold all required items, and the entities left out with their item count."""
    held = cells.groupBy(key).agg(F.count_distinct(item).alias("items"))
    whole = cells.join(held.filter(F.col("items") >= required), key, "left_semi")
    return whole, held.filter(F.col("items") < required)
