"""Contract checks. Each returns violation rows; no rows means the table passes.

Checks group with map-side partial aggregation and compare counts or extremes, so no key
group is ever gathered whole. ``stop_where`` and the checks built on it are part of the plan of what
they guard: a bad row stops the job that meets it, and no job of its own is run.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from kalends.functions.classes import EXACT_CLASSES
from kalends.functions.months import months_between, release_lag, spine_of
from kalends.session import written

MONTH = "^[0-9]{4}-(0[1-9]|1[0-2])$"


def fail_on_rows(violations: DataFrame, message: str) -> None:
    """Fail closed: stop the step when a check found anything."""
    first = violations.limit(3).collect()
    if first:
        raise ValueError(f"{message}: {[row.asDict() for row in first]}")


def stop_where(df: DataFrame, bad: Column, message: str, *show: str) -> DataFrame:
    """``df`` as it is; a row that is ``bad`` stops the job that computes it, with the values of ``show``.

    The check is a filter inside the plan. It is not deterministic, so the optimizer neither merges it with other filters nor
    pushes them below it, and an outer join under it stays one.
    """
    said = F.concat(F.lit(f"{message}: "), F.to_json(F.struct(*show))) if show else F.lit(message)
    return df.filter(F.when(F.coalesce(bad, F.lit(False)), F.raise_error(said).cast("boolean")).otherwise(F.monotonically_increasing_id() >= 0))


def unrepeated(df: DataFrame, by: Sequence[str], order: Sequence[str], message: str) -> DataFrame:
    """``df``, stopping at two rows of equal ``by`` and ``order``. Rows are dealt by ``by`` and sorted, as windows and joins on it need them."""
    key = F.struct(*by, *order)
    marked = df.withColumn("_before", F.lag(key).over(Window.partitionBy(*by).orderBy(*(order or by))))
    return stop_where(marked, F.col("_before").isNotNull() & F.col("_before").eqNullSafe(key), message, *by, *order).drop("_before")


def numbered(df: DataFrame, keys: Sequence[str], buckets: int = 32) -> DataFrame:
    """``df`` with ``number``, 1 to its number of rows, in no particular order but the same in every run, and that number of rows as ``wanted``.

    Rows are counted in hashed buckets; a row's number is its rank in its bucket after the rows of the buckets before.
    """
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    sizes = df.agg(F.array(*[F.count_if(bucket == k) for k in range(buckets)])).scalar()
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy(*keys))
    total = lambda array: F.aggregate(array, F.lit(0).cast("long"), lambda s, n: s + n)
    counted = df.withColumn("_bucket", bucket).withColumn("_sizes", sizes)
    return counted.withColumn("number", total(F.slice("_sizes", 1, F.col("_bucket"))) + rank).withColumn("wanted", total(F.col("_sizes"))).drop("_bucket", "_sizes")


def month_cells(panel: DataFrame, cells: DataFrame, keys: Sequence[str] = ("economy", "category"), **sums: Column) -> DataFrame:
    """For each month of ``panel``: its rows, the distinct ``cells`` that they ``held``, how many are ``wanted``, and ``sums``.

    Cells get dense numbers, and a month folds its numbers into bitmaps of a fixed size before the shuffle: neither the grid of
    cells and months nor the panel's keys are shuffled. A row of no cell stops the job. ``sums`` may use the columns of both sides.
    """
    rows = panel.join(numbered(cells, keys), list(keys), "left")
    rows = stop_where(rows, F.col("number").isNull(), "cells without a weight", *keys)
    parts = rows.groupBy("period", F.bitmap_bucket_number("number").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"), F.count("*").alias("rows"), F.max("wanted").alias("wanted"), *[F.sum(c).alias(n) for n, c in sums.items()])
    return parts.groupBy("period").agg(
        F.sum("rows").alias("rows"), F.sum(F.bitmap_count("bits")).alias("held"), *[F.sum(n).alias(n) for n in sums], F.max("wanted").alias("wanted"))


def single_cells(panel: DataFrame, cells: DataFrame, keys: Sequence[str] = ("economy", "category"), **sums: Column) -> DataFrame:
    """``month_cells`` of a panel that may have holes: a month with repeated cells stops the job."""
    return stop_where(month_cells(panel, cells, keys, **sums), F.col("rows") > F.col("held"), "repeated cells", "period", "rows", "held")


def whole_months(panel: DataFrame, cells: DataFrame, keys: Sequence[str] = ("economy", "category"), **sums: Column) -> DataFrame:
    """``month_cells`` of a panel without holes: a month with repeated cells, or without one of the cells, stops the job."""
    found = single_cells(panel, cells, keys, **sums)
    return stop_where(found, F.col("held") < F.col("wanted"), "months with holes", "period", "held", "wanted")


def only_whole_months(panel: DataFrame, cells: DataFrame, keys: Sequence[str] = ("economy", "category")) -> DataFrame:
    """The rows of ``panel`` in months that hold every one of ``cells``: the panel of a fixed universe.

    A month is judged by its number of rows; that none of them repeats a cell is for ``whole_months`` to say.
    """
    wanted = cells.agg(F.count("*")).scalar()
    known = panel.join(cells, list(keys), "left_semi")
    whole = known.groupBy("period").agg(F.count("*").alias("rows")).withColumn("wanted", wanted).filter("rows >= wanted").select("period")
    return known.join(whole, "period", "left_semi")


def valid_weights(weights: DataFrame, weight: str = "weight", tol: float = 1e-6) -> DataFrame:
    """``weights``, stopping at one that is not positive and at a sum other than 1."""
    rows = stop_where(weights, ~finite_positive(F.col(weight)), "weights that are not positive", *weights.columns)
    total = weights.agg(F.sum(weight)).scalar()
    return stop_where(rows.withColumn("_total", total), ~(F.abs(F.col("_total") - 1) <= tol), "weights that do not sum up to 1", "_total").drop("_total")


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count("*").alias("copies")).filter("copies > 1")


def expected_grid(economies: DataFrame, categories: Sequence[str] | None = None, months: tuple[str, str] | None = None) -> DataFrame:
    """Economies times fixed categories times months, generated by explode (no cross join)."""
    grid = economies.select("economy").distinct()
    if categories is not None:
        grid = grid.withColumn("category", F.explode(F.array(*[F.lit(c) for c in categories])))
    if months is not None:
        grid = grid.withColumn("period", F.explode(months_between(F.lit(months[0]), F.lit(months[1]))))
    return grid


def grid_violations(df: DataFrame, expected: DataFrame) -> DataFrame:
    """Keys of ``expected`` that ``df`` lacks (MISSING) and keys of ``df`` outside it (EXTRA)."""
    keys = expected.columns
    have = df.select(*keys).distinct().withColumn("have", F.lit(1))
    want = expected.withColumn("want", F.lit(1))
    return want.join(have, keys, "full_outer").filter("have is null or want is null").select(
        *keys, F.when(F.col("have").isNull(), "MISSING").otherwise("EXTRA").alias("violation")
    )


def weight_sum_violations(df: DataFrame, group: Sequence[str], weight: str = "weight", tol: float = 1e-9) -> DataFrame:
    return df.groupBy(*group).agg(F.sum(weight).alias("weight_sum")).filter(
        F.col("weight_sum").isNull() | (F.abs(F.col("weight_sum") - 1) > tol)
    )


def domain_violations(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Rows breaking a rule, with every broken rule's name; a rule is a condition that must hold."""
    broken = F.filter(
        F.array(*[F.when(~F.coalesce(rule, F.lit(False)), name) for name, rule in rules.items()]), lambda x: x.isNotNull()
    )
    return df.withColumn("violations", F.array_join(broken, "|")).filter("violations <> ''")


def finite_positive(col: Column) -> Column:
    return col.isNotNull() & ~F.isnan(col) & (F.abs(col) != float("inf")) & (col > 0)


def valid_month(col: Column) -> Column:
    return col.rlike(MONTH)


def attribute_drift(df: DataFrame, key: Sequence[str], attributes: Sequence[str]) -> DataFrame:
    """One row per key and attribute that takes more than one value within the key."""
    ends = df.groupBy(*key).agg(
        *[F.min(a).cast("string").alias(f"lo_{a}") for a in attributes],
        *[F.max(a).cast("string").alias(f"hi_{a}") for a in attributes],
    )
    found = F.array(*[
        F.struct(F.lit(a).alias("attribute"), F.col(f"lo_{a}").alias("lowest"), F.col(f"hi_{a}").alias("highest"))
        for a in attributes
    ])
    return (
        ends.select(*key, F.explode(found).alias("d")).filter("d.lowest <> d.highest")
        .select(*key, "d.attribute", "d.lowest", "d.highest")
    )


def universe_drift(cells: DataFrame, reference: str, keys: Sequence[str] = ("economy", "category"), weight: str = "weight",
                   tol: float = 1e-12) -> DataFrame:
    """Months whose cells or weights differ from the reference month, by counts of matching cells."""
    base = cells.filter(F.col("period") == reference).select(*keys, F.col(weight).alias("base_weight"))
    size = base.agg(F.count("*").alias("n")).scalar()
    same = (F.abs(F.col(weight) - F.col("base_weight")) <= tol).cast("int")
    return (
        cells.join(base, list(keys), "left").groupBy("period")
        .agg(F.count("*").alias("cells"), F.sum(F.coalesce(same, F.lit(0))).alias("matching"))
        .withColumn("reference_cells", size)
        .filter("cells <> reference_cells or matching <> reference_cells")
    )


def index_identity(cells: DataFrame, published: DataFrame, tol: float) -> DataFrame:
    """Months where the published index is not the weighted sum of its cells."""
    again = cells.groupBy("period").agg(F.sum(F.col("weight") * F.col("price_relative")).alias("recomputed"))
    return published.join(again, "period", "full_outer").filter(
        F.col("recomputed").isNull() | F.col("value").isNull() | (F.abs(F.col("value") - F.col("recomputed")) > tol)
    ).select("period", "value", "recomputed")


def weight_hierarchy_identity(cells: DataFrame, parents: DataFrame, tol: float) -> DataFrame:
    """Economies whose cell weights do not add up to the economy weight."""
    summed = cells.groupBy("economy").agg(F.sum("weight").alias("cell_sum"))
    return parents.join(summed, "economy", "full_outer").filter(
        F.col("cell_sum").isNull() | F.col("economy_weight").isNull() | (F.abs(F.col("cell_sum") - F.col("economy_weight")) > tol)
    ).select("economy", "economy_weight", "cell_sum")


def sample_mismatch(cases: DataFrame, models: int | Column) -> DataFrame:
    """Case ids that not every model was run on."""
    held = cases.groupBy("case_id").agg(F.count_distinct("model").alias("model_count"))
    return held.filter(F.col("model_count") != models)


def case_metadata_mismatch(cases: DataFrame, fields: Sequence[str]) -> DataFrame:
    return attribute_drift(cases, ["case_id"], fields).select("case_id", F.col("attribute").alias("field"))


def interval_overlaps(assignments: DataFrame) -> DataFrame:
    """Every pair of intervals of one economy that share a month: the later start with the earlier one that lasts until then.

    An open end is ``9999-12``. An interval meets those that start after it and not after its end; the sweep goes by the months in
    which intervals start: an interval is unrolled to those of its economy's that it covers, and joined with the intervals that start there.
    """
    end = F.when(F.coalesce("effective_to", F.lit("")) == "", "9999-12").otherwise(F.col("effective_to"))
    place = F.row_number().over(Window.partitionBy("economy").orderBy("effective_from", "until", "currency"))
    spans = assignments.withColumn("until", end).withColumn("place", place)
    last = F.max("effective_from").over(Window.partitionBy("economy"))  # nothing starts later
    covered = months_between(F.col("effective_from"), F.least("until", "last"))
    earlier = spans.withColumn("last", last).filter("effective_from <= until and effective_from <= last").select(
        "economy", F.col("currency").alias("earlier_currency"), F.col("effective_from").alias("earlier_from"), F.col("until").alias("occupied_until"),
        F.col("place").alias("earlier_place"), F.explode(covered).alias("effective_from"))
    return spans.join(earlier, ["economy", "effective_from"]).filter("earlier_place < place").select(
        "economy", "currency", "effective_from", "until", "earlier_currency", "earlier_from", "occupied_until")


def registry_violations(definitions: DataFrame, category_count: int) -> DataFrame:
    """Unknown, cross-economy and non-overlapping fallbacks; P1 holds one category, P3 all of them."""
    targets = definitions.select(
        F.col("series_id").alias("fallback"), F.col("economy").alias("other_economy"), F.col("target_categories").alias("other_categories")
    )
    links = definitions.select("series_id", "economy", "target_categories", F.explode("fallback_series").alias("fallback"))
    reason = (
        F.when(F.col("other_economy").isNull(), "UNKNOWN_FALLBACK")
        .when(F.col("other_economy") != F.col("economy"), "CROSS_ECONOMY_FALLBACK")
        .when(~F.arrays_overlap("target_categories", "other_categories"), "NO_OVERLAPPING_CATEGORY")
    )
    links = links.join(targets, "fallback", "left").select("series_id", "fallback", reason.alias("violation"))
    held = F.size("target_categories")
    own = definitions.select(
        "series_id", F.lit("").alias("fallback"),
        F.when(F.col("evidence_class").startswith("P1_") & (held != 1), "P1_NEEDS_ONE_CATEGORY")
        .when(F.col("evidence_class").startswith("P3_") & (held != category_count), "P3_NEEDS_ALL_CATEGORIES")
        .when(F.size(F.array_distinct("target_categories")) != held, "DUPLICATE_TARGET_CATEGORY").alias("violation"))
    return links.unionByName(own).filter("violation is not null")


def _settled(state: DataFrame, step) -> DataFrame:
    """``state`` (node, label) after ``step`` changes nothing any more; every round is written."""
    sums = lambda df: df.agg(F.count("*"), F.sum(F.xxhash64("node", "label").cast("decimal(20,0)"))).first()
    state, before, now = written(state), None, None
    while before is None or before != now:
        before = sums(state) if now is None else now
        state = written(step(state))
        now = sums(state)
    return state


def _steps(links: DataFrame) -> list[DataFrame]:
    """Where nodes with one successor stand after 1, 2, 4, ... steps along such nodes: (node, to, low), ``low`` the least name passed.

    After the last table every ``to`` has left those nodes or runs round a circle of them.
    """
    lone = links.groupBy("a").agg(F.count("*").alias("n"), F.min("b").alias("to")).filter("n = 1")
    steps = [written(lone.select(F.col("a").alias("node"), "to", F.col("a").alias("low")))]
    for _ in range(steps[0].count().bit_length()):
        now = steps[-1]
        then = now.select(F.col("node").alias("to"), F.col("to").alias("later"), F.col("low").alias("low_later"))
        steps.append(written(now.join(then, "to", "left").select("node", F.coalesce("later", "to").alias("to"), F.least("low", "low_later").alias("low"))))
    return steps


def _contracted(live: DataFrame, backwards: bool) -> tuple[DataFrame, DataFrame, tuple]:
    """Links between the nodes with several successors (predecessors, ``backwards``), chains between them passed over in one link.

    Also the classes of closed circles, (node, label), and what it takes to find the chains' own nodes again: where chains begin, and the steps.
    """
    view = live.select(F.col("b").alias("a"), F.col("a").alias("b")) if backwards else live
    steps = _steps(view)
    last, lone = steps[-1], steps[0].select("node")
    circling = last.join(lone.select(F.col("node").alias("to")), "to", "left_semi").select(F.col("to").alias("node")).distinct()
    circles = last.join(circling, "node").select("node", F.col("low").alias("label"))
    forks = view.join(lone.select(F.col("node").alias("a")), "a", "left_anti").select("a", "b")
    ended = forks.join(last.select(F.col("node").alias("b"), F.col("to").alias("end")), "b", "left").withColumn("on_chain", F.col("end").isNotNull())
    ended = ended.withColumn("end", F.coalesce("end", "b")).join(forks.select(F.col("a").alias("end")).distinct(), "end", "left_semi")
    ended = written(ended)
    links = ended.select(F.col("end").alias("a"), F.col("a").alias("b")) if backwards else ended.select("a", F.col("end").alias("b"))
    return written(links.distinct()), written(circles), (ended.filter("on_chain").select("a", "b", "end"), steps)


def _on_chains(classes: DataFrame, begins: DataFrame, steps: list[DataFrame]) -> DataFrame:
    """Nodes of the chains that lead from a class back into it, with its label: marks double their way along the steps."""
    ends = classes.select(F.col("node").alias("end"), F.col("label").alias("end_label"))
    marks = written(begins.join(classes.withColumnRenamed("node", "a"), "a").join(ends, "end").filter("label = end_label").select(F.col("b").alias("node"), "label").distinct())
    if marks.isEmpty():
        return marks
    lone = steps[0].select("node")
    for step in steps:
        ahead = marks.join(step, "node").select(F.col("to").alias("node"), "label").join(lone, "node", "left_semi")
        marks = written(marks.unionByName(ahead).distinct())
    return marks


def _classes_of_forks(links: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One class for each name, as (node, label), and the links without their nodes.

    Each node takes the smallest name that reaches it; going back from the nodes that kept their own name, among those of its name,
    finds one strongly connected class per name.
    """
    ahead = lambda s: s.unionByName(links.join(s, links["a"] == s["node"]).select(F.col("b").alias("node"), "label")).groupBy("node").agg(F.min("label").alias("label"))
    named = _settled(links.select(F.col("a").alias("node"), F.col("a").alias("label")).distinct(), ahead)
    own = named.select(F.col("node").alias("a"), F.col("label"))
    inner = written(links.join(own, "a").join(named.select(F.col("node").alias("b"), F.col("label").alias("label_b")), "b").filter("label = label_b").select("a", "b"))
    back = lambda s: s.unionByName(inner.join(s, inner["b"] == s["node"]).select(F.col("a").alias("node"), "label")).distinct()
    members = _settled(named.filter("node = label"), back)
    loops = links.filter("a = b").select(F.col("a").alias("node")).withColumn("loops", F.lit(True))
    classes = members.join(loops, "node", "left").groupBy("label").agg(F.count("*").alias("n"), F.max("loops").alias("loops")).filter("n > 1 or loops")
    gone = members.select("node")
    left = links.join(gone, links["a"] == gone["node"], "left_anti").join(gone, F.col("b") == gone["node"], "left_anti")
    return written(members.join(classes.select("label"), "label").select("node", "label")), written(left)


def fallback_cycles(definitions: DataFrame) -> DataFrame:
    """Series on a fallback cycle.

    Chains of series with one fallback, then of series that are one fallback, are passed over by doubling steps: circles close, open ends
    drop off, and only series with several links each way are left, for which names are passed on link by link. Rounds grow with the
    logarithm of the longest chain; on what is left after that, with its diameter. Tables never exceed the links. Missing names are no series.
    """
    live = written(definitions.select(F.col("series_id").alias("a"), F.explode("fallback_series").alias("b")).filter("a is not null and b is not null").distinct())
    found, chains = live.select(F.col("a").alias("node"), F.col("a").alias("label")).limit(0), []
    size, still, backwards = live.count(), 0, False
    while size:
        live, closed, chain = _contracted(live, backwards)
        found, backwards = found.unionByName(closed), not backwards
        chains.append(chain)
        left = live.count()
        still, size = still + 1 if left == size else 0, left
        if size and still == 2:
            members, live = _classes_of_forks(live)
            found, size, still = found.unionByName(members), live.count(), 0
    found = written(found)
    for begins, steps in reversed(chains):
        found = written(found.unionByName(_on_chains(found, begins, steps)))
    return found.select(F.col("node").alias("series_id"))


def mapping_violations(mapping: DataFrame, source_codes: DataFrame, targets: DataFrame) -> DataFrame:
    """Strict bridge: every source code exactly once, every target covered, exact ratified types, valid interval."""
    def rows(df: DataFrame, code: str, name: str) -> DataFrame:
        return df.select(F.col(code).alias("code"), F.lit(name).alias("violation")).distinct()

    exact = F.col("mapping_type").isin("EXACT_ONE_TO_ONE", "EXACT_MERGE")
    found = [
        rows(source_codes.join(mapping, "source_code", "left_anti"), "source_code", "SOURCE_CODE_MISSING"),
        rows(mapping.join(source_codes, "source_code", "left_anti"), "source_code", "SOURCE_CODE_UNKNOWN"),
        rows(mapping.groupBy("source_code").agg(F.count("*").alias("n")).filter("n > 1"), "source_code", "SOURCE_CODE_NOT_UNIQUE"),
        rows(targets.join(mapping, "category", "left_anti"), "category", "TARGET_NOT_COVERED"),
        rows(mapping.join(targets, "category", "left_anti"), "category", "TARGET_UNKNOWN"),
        rows(mapping.filter(F.col("strict_admissible") & ~exact), "source_code", "NON_EXACT_STRICT_MAPPING"),
        rows(mapping.filter(~F.col("strict_admissible")), "source_code", "NOT_ADMISSIBLE"),
        rows(mapping.filter("effective_to <> '' and effective_from > effective_to"), "source_code", "INVALID_INTERVAL"),
    ]
    return reduce(DataFrame.unionByName, found)


def lookahead_violations(cases: DataFrame) -> DataFrame:
    """Cases that read the target month or any month after the origin."""
    target_used = F.array_contains("source_periods", F.col("target"))
    future = F.exists("source_periods", lambda p: p > F.col("origin"))
    return cases.withColumn(
        "violation", F.when(target_used, "TARGET_PERIOD_VALUE_USED").when(future, "FUTURE_SOURCE_PERIOD_USED")
    ).filter("violation is not null")


def release_calendar_violations(calendar: DataFrame, lowest: int, highest: int) -> DataFrame:
    """Lag outside its window, release dates that do not increase, months without a release.

    The calendar holds one row per month, so one ordered window is enough.
    """
    lag = release_lag(F.col("period"), F.col("release_date"))
    previous = F.lag("release_date").over(Window.orderBy("period"))
    found = F.filter(F.array(
        F.when(~lag.between(lowest, highest), "RELEASE_LAG_OUTSIDE_POLICY"),
        F.when(F.col("release_date") <= F.col("previous"), "RELEASE_DATE_NOT_INCREASING"),
    ), lambda x: x.isNotNull())
    held = calendar.withColumn("previous", previous).select("period", F.explode(found).alias("violation"))
    gaps = spine_of(calendar).join(calendar, "period", "left_anti").select("period", F.lit("RELEASE_PERIOD_MISSING").alias("violation"))
    return held.unionByName(gaps)


def gate_row_violations(gates: DataFrame, required: Sequence[str], statuses: Sequence[str], final: str) -> DataFrame:
    """Missing criteria, statuses not allowed, and a closed final rejection that no other row supports."""
    entities = gates.select("entity").distinct()
    wanted = entities.select("entity", F.explode(F.array(*[F.lit(r) for r in required])).alias("criterion"))
    missing = wanted.join(gates, ["entity", "criterion"], "left_anti").select(
        "entity", F.lit("MISSING_CRITERION").alias("violation"), F.col("criterion").alias("detail"))
    invalid = gates.filter(~F.col("status").isin(*statuses)).select(
        "entity", F.lit("INVALID_STATUS").alias("violation"), F.col("status").alias("detail")).distinct()
    contradicted = F.col("status") == "CONTRADICTED"
    closed = gates.groupBy("entity").agg(
        F.bool_or((F.col("criterion") == final) & contradicted).alias("rejected"),
        F.bool_or((F.col("criterion") != final) & contradicted).alias("supported"),
    ).filter("rejected and not coalesce(supported, false)").select(
        "entity", F.lit("UNSUPPORTED_REJECTION").alias("violation"), F.lit(final).alias("detail"))
    return missing.unionByName(invalid).unionByName(closed)


REQUIRED_FLAGS = ("CURRENT_PRICES", "GOVERNMENT_EXCLUDED", "NO_ALLOCATION", "NPISH_EXCLUDED")
PROVENANCE = ("source_authority", "source_file", "source_url", "source_hash")


def mixed_provider_admissibility(rows: DataFrame, order: str = "row_id") -> DataFrame:
    """Per economy: admissible, and the first broken rule of its first broken row.

    A category's first row is found by a minimum per key, so repeated categories need no window.
    """
    firsts = rows.groupBy("economy", "category").agg(F.min(order).alias("first_row"))
    missing = F.array_except(F.array(*[F.lit(f) for f in REQUIRED_FLAGS]), F.split(F.coalesce("quality_flags", F.lit("")), r"\|"))
    reason = (
        F.when(F.coalesce("category", F.lit("")) == "", "MISSING_CATEGORY")
        .when(F.col(order) > F.col("first_row"), F.concat(F.lit("DUPLICATE_CATEGORY:"), "category"))
        .when(F.coalesce("sector", F.lit("")) != "S14", "INCOMPATIBLE_SECTOR")
        .when(F.coalesce("transaction", F.lit("")) != "P31DC", "INCOMPATIBLE_TRANSACTION")
        .when(~F.coalesce(F.col("data_class").isin(*EXACT_CLASSES), F.lit(False)), "INCOMPATIBLE_DATA_CLASS")
        .when(F.size(missing) > 0, F.concat(F.lit("MISSING_QUALITY_FLAGS:"), F.array_join(missing, "|")))
    )
    for field in PROVENANCE:
        reason = reason.when(F.coalesce(field, F.lit("")) == "", f"MISSING_PROVENANCE:{field}")
    one = lambda name: F.min(F.coalesce(name, F.lit(""))) == F.max(F.coalesce(name, F.lit("")))
    verdict = (
        rows.join(firsts, ["economy", "category"], "left").withColumn("reason", reason).groupBy("economy")
        .agg(
            F.min_by("reason", F.when(F.col("reason").isNotNull(), F.col(order))).alias("row_reason"),
            one("reference_period").alias("one_period"), one("currency").alias("one_currency"), one("unit").alias("one_unit"),
        )
    )
    final = (
        F.when(F.col("row_reason").isNotNull(), F.col("row_reason"))
        .when(~F.col("one_period"), "INCOMPATIBLE_REFERENCE_PERIOD")
        .when(~F.col("one_currency"), "INCOMPATIBLE_CURRENCY")
        .when(~F.col("one_unit"), "INCOMPATIBLE_UNIT")
        .otherwise("PASS")
    )
    return verdict.select("economy", (final == "PASS").alias("admissible"), final.alias("reason"))
