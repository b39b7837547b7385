"""Selection, runs, chaining and rankings.

Windows run over one cell's months, one economy's months or grouped metric rows, all bounded by
calendars and dimensions. Where a group can hold any number of sources, a minimum of an
ordered struct (combined map-side) takes the place of a ranked window.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from kalends.functions.classes import evidence_rank
from kalends.functions.months import month_number, months_between
from kalends.operators import checks
from kalends.session import cut, dealt

CELL = ("economy", "category")


def preference() -> tuple[Column, ...]:
    return evidence_rank(F.col("evidence_class")), F.col("source_priority"), F.col("series_id")


def select_best_price(normalized: DataFrame, rows: int | None = None) -> DataFrame:
    """Per cell and month the series with the best (evidence rank, priority, id), how many competed, and the passed-over ids in that order, with ``|`` between.

    A series that appears twice in a cell and month stops the job. That is looked for by series, as normalised prices are dealt already,
    so where the list is not read, the many candidates of a cell and month do not meet before they are reduced to the best of each task.
    A list is one row, so its candidates meet: with their number of ``rows``, cells and months are dealt first, since a task's lists
    take memory that Spark does not count.
    """
    normalized = checks.unrepeated(normalized, ["series_id"], [*CELL, "period"], "repeated candidates")
    if rows is not None:
        normalized = dealt(normalized, rows, *CELL, "period")
    rank, priority, series = preference()
    place = rank.alias("rank"), priority.alias("source_priority"), series.alias("series_id")
    ordered = F.struct(*place, "evidence_class", "price_relative")
    best = normalized.groupBy(*CELL, "period").agg(
        F.min(ordered).alias("best"), F.count("*").alias("candidate_count"), F.sort_array(F.collect_list(F.struct(*place))).alias("ladder"))
    rejected = F.slice("ladder", 2, F.size("ladder")).getField("series_id")
    return best.select(
        *CELL, "period", "best.series_id", "best.evidence_class", "best.source_priority", "best.price_relative", "candidate_count",
        F.array_join(rejected, "|").alias("rejected_series_ids"))


def rejected_candidates(normalized: DataFrame, selected: DataFrame) -> DataFrame:
    """The candidates each selection passed over, one row each."""
    winner = selected.select(*CELL, "period", F.col("series_id").alias("selected_series"))
    return normalized.join(winner, [*CELL, "period"]).filter("series_id <> selected_series").select(*CELL, "period", "series_id", "selected_series")


def source_switches(selected: DataFrame) -> DataFrame:
    """Whether the chosen series differs from the cell's previous available month."""
    before = F.lag("series_id").over(Window.partitionBy(*CELL).orderBy("period"))
    return selected.withColumn("previous_series", before).withColumn(
        "switched", F.coalesce(F.col("previous_series") != F.col("series_id"), F.lit(False)))


def candidate_ladder(definitions: DataFrame, economy: str | None = None, category: str | None = None) -> DataFrame:
    """Enabled series per cell in order of preference."""
    rows = definitions.filter("enabled").withColumn("category", F.explode("target_categories"))
    if economy is not None:
        rows = rows.filter(F.col("economy") == economy)
    if category is not None:
        rows = rows.filter(F.col("category") == category)
    rank, priority, series = preference()
    return rows.select(*CELL, rank.alias("rank"), priority, series).orderBy(*CELL, "rank", "source_priority", "series_id")


def index_change(index: DataFrame, keys: Sequence[str] = ("index_id",), value: str = "value") -> DataFrame:
    """Month-on-month change in percent of an index series (one row per month)."""
    before = F.lag(value).over(Window.partitionBy(*keys).orderBy("period"))
    return index.withColumn("change_percent", (F.col(value) / before - 1) * 100)


def complete_prefix(panel: DataFrame, reference: str, category_count: int, minimum_months: int) -> DataFrame:
    """Length of each economy's unbroken run of complete months from the reference month, and whether it is enough."""
    whole = panel.filter(F.col("period") >= reference).groupBy("economy", "period").agg(
        F.count_distinct("category").alias("held")).filter(F.col("held") >= category_count)
    offset = month_number(F.col("period")) - month_number(F.lit(reference))
    place = F.row_number().over(Window.partitionBy("economy").orderBy("period")) - 1
    run = whole.withColumn("place", place).groupBy("economy").agg(F.count_if(F.col("place") == offset).alias("run_months"))
    return run.filter("run_months > 0").withColumn("passes", F.col("run_months") >= minimum_months)


def common_interval(prefix: DataFrame, panel: DataFrame, reference: str, categories: Sequence[str]) -> DataFrame:
    """Every month from the reference on: COMMON inside the shortest passing run, else the reason and its holes."""
    passing = prefix.filter("passes")
    shared = passing.agg(F.min("run_months")).scalar()
    last = panel.agg(F.max("period")).scalar()
    months = passing.select("economy").withColumn("last", last).withColumn(
        "period", F.explode(months_between(F.lit(reference), F.col("last")))).drop("last")
    wanted = months.withColumn("category", F.explode(F.array(*[F.lit(c) for c in sorted(categories)])))
    have = panel.select(*CELL, "period").distinct().withColumn("have", F.lit(True))
    holes = F.array_sort(F.collect_list(F.when(F.col("have").isNull(), F.struct(*CELL))))
    monthly = wanted.join(have, [*CELL, "period"], "left").groupBy("period").agg(
        F.count_if(F.col("have").isNull()).alias("missing_cell_count"),
        F.array_join(F.transform(holes, lambda h: F.concat_ws(":", h["economy"], h["category"])), "|").alias("missing_cells"))
    inside = month_number(F.col("period")) - month_number(F.lit(reference)) < F.col("shared")
    return monthly.withColumn("shared", shared).withColumn(
        "reason", F.when(inside, "COMMON").when(F.col("missing_cell_count") == 0, "OUTSIDE_LARGEST_COMMON_COMPLETE_INTERVAL")
        .otherwise("INCOMPLETE_FIXED_UNIVERSE_MONTH")).drop("shared")


def chain_link(grid: DataFrame, keys: Sequence[str] = CELL) -> DataFrame:
    """Index levels from anchors and rates: an anchor month takes its level, other months compound their rates since.

    ``grid`` holds every month of a cell from the reference on with ``anchor`` (level or null), ``central_rate``,
    ``lower_rate`` and ``upper_rate``. A missing rate, or a lower rate at or below -1, voids the levels up to the next anchor.
    """
    upto = Window.partitionBy(*keys).orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    segmented = grid.withColumn("segment", F.count("anchor").over(upto))
    since = Window.partitionBy(*keys, "segment").orderBy("period").rowsBetween(Window.unboundedPreceding, 0)
    free = F.col("anchor").isNull()
    broken = free & (F.col("central_rate").isNull() | (F.col("lower_rate") <= -1))
    valid = (F.max(broken.cast("int")).over(since) == 0) & (F.col("segment") > 0)
    start = F.first("anchor").over(since)
    # the guard keeps the logarithm defined on rows that are void anyway
    step = lambda rate: F.when(free & ~broken, F.log1p(F.col(rate))).otherwise(0.0)
    level = lambda rate: F.when(valid, start * F.exp(F.sum(step(rate)).over(since)))
    return segmented.withColumns({
        "central": level("central_rate"), "lower": level("lower_rate"), "upper": level("upper_rate")}).drop("segment")


def top_donors(pairs: DataFrame, n: int, by: Sequence[Column], keys: Sequence[str] = ("target",)) -> DataFrame:
    """Best ``n`` donors per target in the given order, with their rank."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*by))
    return pairs.withColumn("donor_rank", rank).filter(F.col("donor_rank") <= n)


def leave_out_factors(factors: DataFrame, scenarios: str | Sequence[str], keys: Sequence[str] = ("origin", "target")) -> DataFrame:
    """Donor factors of each masked cell without the masked group, from totals minus own sums.

    ``factors`` has the keys, economy, category, factor and weight; its columns stay. Pools: all cells, same economy, same
    category. Each pool's totals are grouped once, pre-aggregated, and joined back; the scenarios are made from them in one pass.
    Counts decide whether a pool is empty.
    """
    measures = {"fw": F.col("factor") * F.col("weight"), "w": F.col("weight"), "f": F.col("factor"), "n": F.lit(1)}
    rows = factors
    for scope, names in {"g": (), "e": ("economy",), "c": ("category",)}.items():
        by = [*keys, *names]
        rows = rows.join(factors.groupBy(*by).agg(*[F.sum(expr).alias(f"{scope}_{m}") for m, expr in measures.items()]), by)
    own = dict(measures)
    same = {scope: {m: F.col(f"{scope}_{m}") for m in measures} for scope in "gec"}
    masked = {
        "SINGLE_CELL": {"g": own, "e": own, "c": own},
        "ECONOMY_OUTAGE": {"g": same["e"], "e": same["e"], "c": own},
        "CATEGORY_OUTAGE": {"g": same["c"], "e": own, "c": same["c"]},
    }

    def outcome(scenario: str) -> Column:
        left = lambda scope, m: same[scope][m] - masked[scenario][scope][m]
        mean = lambda scope, top, bottom: F.when(left(scope, "n") > 0, left(scope, top) / left(scope, bottom))
        return F.struct(
            F.lit(scenario).alias("scenario"), mean("g", "f", "n").alias("global_equal"), mean("g", "fw", "w").alias("global_weighted"),
            mean("e", "fw", "w").alias("economy_weighted"), mean("c", "fw", "w").alias("category_weighted"))

    wanted = (scenarios,) if isinstance(scenarios, str) else tuple(scenarios)
    if unknown := set(wanted) - masked.keys():
        raise ValueError(f"unknown scenario: {sorted(unknown)}")
    return rows.withColumn("s", F.explode(F.array(*map(outcome, wanted)))).select(*factors.columns, "s.*")


def gap_priority(cells: DataFrame, probe: DataFrame, categories: Sequence[str], direct: Sequence[str],
                 probability: dict[str, float], cost: dict[str, float]) -> DataFrame:
    """Incomplete economies by direct expenditure, running share, and a second rank by share x probability / cost.

    ``cells``: economy, category, real; a cell whose ``real`` is null is missing. ``probe``: economy, candidate_class (null: not probed),
    integration_cost. Ranks and running shares come from ``ranked``, in range partitions.
    """
    lookup = lambda table, key, default: F.coalesce(
        F.element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), key), F.lit(default))
    sums = cells.groupBy("economy").agg(
        F.array_sort(F.collect_set(F.when(F.col("real").isNotNull(), F.col("category")))).alias("held"),
        F.coalesce(F.sum(F.when(F.col("category").isin(*direct), F.col("real"))), F.lit(0.0)).alias("direct_real"))
    total = sums.agg(F.sum("direct_real")).scalar()
    candidate = F.coalesce("candidate_class", F.lit("NOT_PROBED"))
    costing = F.upper(F.coalesce("integration_cost", F.lit("NOT_ESTIMATED")))
    want = F.array(*[F.lit(c) for c in sorted(categories)])
    share = F.col("direct_real") / F.col("total")
    gaps = sums.withColumn("total", total).filter(F.size("held") < len(categories)).join(probe, "economy", "left").select(
        "economy", F.size("held").alias("categories_available"), F.array_join(F.array_except(want, "held"), "|").alias("missing_categories"),
        "direct_real", share.alias("share"), candidate.alias("candidate_class"),
        (share * lookup(probability, candidate, 0.0) / lookup(cost, costing, 10.0)).alias("score"))
    placed = ranked(gaps, (F.desc("direct_real"), F.desc("economy")), "gap_rank", cumulative_share=F.col("share"))
    second = ranked(placed.filter("candidate_class <> 'NOT_PROBED'"), (F.desc("score"), F.desc("direct_real"), F.desc("economy")), "score_rank")
    return placed.join(second.select("economy", "score_rank"), "economy", "left")


def ranked(df: DataFrame, order: Sequence[Column], name: str = "rank", parts: int | None = None, **sums: Column) -> DataFrame:
    """``df`` with each row's place in ``order`` and the running ``sums`` up to it, without a window over all rows.

    Rows are dealt into ``parts`` ranges of the order and written once; each range's size and sums are added up, and a row's place
    is its place within its range after the ranges before. ``order`` should leave no ties.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = cut(df.withColumns({f"_{n}": c for n, c in sums.items()}).repartitionByRange(parts, *order).withColumn("_part", F.spark_partition_id()))
    facts = dealt.groupBy("_part").agg(F.count("*").alias("n"), *[F.sum(f"_{n}").alias(n) for n in sums])
    facts = facts.agg(F.collect_list(F.struct(*facts.columns))).scalar()
    own = Window.partitionBy("_part").orderBy(*order)
    earlier = F.filter("_facts", lambda x: x["_part"] < F.col("_part"))
    before = lambda field, zero: F.aggregate(earlier, zero, lambda s, x: s + F.coalesce(x[field], zero))
    upto = own.rowsBetween(Window.unboundedPreceding, 0)
    placed = dealt.withColumn("_facts", facts).withColumns({
        name: (before("n", F.lit(0).cast("long")) + F.row_number().over(own)).cast("int"),
        **{n: before(n, F.lit(0.0)) + F.sum(F.col(f"_{n}").cast("double")).over(upto) for n in sums}})
    return placed.drop("_facts", "_part", *[f"_{n}" for n in sums])


def round_with_residual(df: DataFrame, share: str, places: int, order: Sequence[str]) -> DataFrame:
    """Shares rounded half-even; the last row takes the residual, so that they add up to exactly one."""
    rounded = df.withColumn("rounded", F.bround(F.col(share).cast("decimal(38,24)"), places))
    facts = rounded.agg(F.struct((F.lit(1) - F.sum("rounded")).alias("rest"), F.max(F.struct(*order)).alias("last"))).scalar()
    last = rounded.withColumn("_facts", facts)
    residual = F.when(F.struct(*order) == F.col("_facts.last"), F.col("_facts.rest")).otherwise(F.lit(0))
    return last.withColumn("residual", residual).withColumn("weight", F.col("rounded") + F.col("residual")).drop("_facts", "rounded")


def ranked_models(metrics: DataFrame, keys: Sequence[str], mean: str, p95: str, model: str = "model") -> DataFrame:
    """Rank of each model by (mean, p95, name) within its keys; metric rows are few."""
    return metrics.withColumn("rank", F.row_number().over(Window.partitionBy(*keys).orderBy(mean, p95, model)))
