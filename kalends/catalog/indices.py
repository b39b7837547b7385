"""Price-index pipelines over supplier series and the region panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.aggregates import INDEX_SQL, index_rows
from kalends.catalog.base import rnd, sql
from kalends.catalog.joins import BRIDGE_SQL, bridge, fx_rates
from kalends.functions.classes import EVIDENCE_CLASSES
from kalends.functions.numbers import rnd as r
from kalends.operators import windows
from kalends.plans import index
from kalends.session import cut, dealt
from kalends.sources import tables
from kalends.sources.tables import MONEY, table

REFERENCE = "1996-01"
_TYPES = "(SELECT unnest(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD']) AS category)"

base.add("sdef", f"""
    SELECT 'C' || s_suppkey || '_' || category AS series_id, s_suppkey AS k, n_name AS economy, category AS own, category AS target,
           CASE WHEN s_suppkey % 2 = 0 THEN 'P1_OFFICIAL_CATEGORY' ELSE 'P2_OFFICIAL_AGGREGATE' END AS evidence_class, 1 + s_suppkey % 3 AS source_priority, s_suppkey % 11 <> 0 AS enabled
    FROM supplier JOIN nation ON s_nationkey = n_nationkey, {_TYPES} WHERE s_suppkey % 5 < 3
    UNION ALL SELECT 'H' || s_suppkey, s_suppkey, n_name, NULL, category, CASE s_suppkey % 4 WHEN 2 THEN 'P4_REGIONAL_PROXY' WHEN 3 THEN 'P5_GLOBAL_PROXY' ELSE 'P3_OFFICIAL_HEADLINE' END,
           1 + s_suppkey % 2, s_suppkey % 11 <> 0 FROM supplier JOIN nation ON s_nationkey = n_nationkey, {_TYPES} WHERE s_suppkey % 5 >= 2""")
base.add("sobs", """
    SELECT 'C' || suppkey || '_' || category AS series_id, period, CAST(sum(amount) AS DOUBLE) / CAST(sum(units) AS DOUBLE) AS value FROM lines WHERE suppkey % 5 < 3 GROUP BY suppkey, category, period
    UNION ALL SELECT 'H' || suppkey, period, CAST(sum(amount) AS DOUBLE) / CAST(sum(units) AS DOUBLE) FROM lines WHERE suppkey % 5 >= 2 GROUP BY suppkey, period""", "lines")
base.add("snorm", f"""
    SELECT d.series_id, d.economy, d.target AS category, o.period, 100.0 * o.value / b.value AS price_relative, d.evidence_class, d.source_priority
    FROM sobs o JOIN sobs b ON b.series_id = o.series_id AND b.period = '{REFERENCE}' JOIN sdef d ON d.series_id = o.series_id WHERE d.enabled""", "sobs", "sdef")
base.add("ssel", """
    SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY economy, category, period ORDER BY evidence_class, source_priority, series_id) AS place,
           count(*) OVER (PARTITION BY economy, category, period) AS candidate_count FROM snorm) WHERE place = 1""", "snorm")


def definitions(spark, sf_dir):
    """Series registry: every supplier has a series per category, a headline series, or both."""
    key = F.col("s_suppkey")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("economy"))
    supplier = table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    categories = F.array(*[F.lit(c) for c in tables.CATEGORIES])
    own = supplier.filter(key % 5 < 3).withColumn("own", F.explode(categories)).select(
        F.concat(F.lit("C"), key, F.lit("_"), "own").alias("series_id"), "economy", F.array("own").alias("target_categories"),
        F.when(key % 2 == 0, EVIDENCE_CLASSES[0]).otherwise(EVIDENCE_CLASSES[1]).alias("evidence_class"), (1 + key % 3).alias("source_priority"), (key % 11 != 0).alias("enabled"))
    headline = supplier.filter(key % 5 >= 2).select(
        F.concat(F.lit("H"), key).alias("series_id"), "economy", categories.alias("target_categories"),
        F.when(key % 4 == 2, EVIDENCE_CLASSES[3]).when(key % 4 == 3, EVIDENCE_CLASSES[4]).otherwise(EVIDENCE_CLASSES[2]).alias("evidence_class"),
        (1 + key % 2).alias("source_priority"), (key % 11 != 0).alias("enabled"))
    return own.unionByName(headline)


def _targeted(lines):
    """About how many rows ``lines`` line items give per target category: half of the observations are headlines, for all categories."""
    return 3 * lines


def series_observations(spark, sf_dir):
    """Unit price per series and month. Supplier-category sums are made once and summed again for the headline; both are dealt by series, as the checks need them."""
    keys = ("l_suppkey", "category", "month")
    rows = table(spark, sf_dir, "lineitem").count()
    lines = dealt(tables.lines(spark, sf_dir).select(*keys, "amount", "units"), rows, *keys)
    sums = cut(lines.groupBy(*keys).agg(F.sum("amount").alias("amount"), F.sum("units").alias("units")))
    key = F.col("l_suppkey")
    own = sums.filter(key % 5 < 3).withColumn("series_id", F.concat(F.lit("C"), key, F.lit("_"), "category"))
    headline = sums.filter(key % 5 >= 2).withColumn("series_id", F.concat(F.lit("H"), key))
    both = dealt(own.unionByName(headline).select("series_id", "month", "amount", "units"), _targeted(rows), "series_id")
    return tables.priced(both, "series_id").select("series_id", "period", F.col("unit_price").alias("value"))


def normalized(spark, sf_dir):
    known = dealt(definitions(spark, sf_dir), _targeted(table(spark, sf_dir, "lineitem").count()), "series_id")
    return index.normalize_prices(known, series_observations(spark, sf_dir), REFERENCE)


@query("normalize_prices", sql(f"SELECT series_id, economy, category, period, {rnd('price_relative')} AS price_relative, evidence_class, source_priority FROM snorm", "snorm"))
def normalize_prices(spark, sf_dir):
    return normalized(spark, sf_dir).withColumn("price_relative", r(F.col("price_relative")))


@query("missing_reference", sql(f"""
    SELECT DISTINCT series_id FROM sobs WHERE series_id IN (SELECT series_id FROM sdef WHERE enabled) AND series_id NOT IN (SELECT series_id FROM sobs WHERE period = '{REFERENCE}')""", "sobs", "sdef"))
def missing_reference(spark, sf_dir):
    return index.missing_reference(definitions(spark, sf_dir), series_observations(spark, sf_dir), REFERENCE)


@query("select_best_price", sql(f"""
    SELECT s.economy, s.category, s.period, s.series_id, s.evidence_class, s.source_priority, {rnd('s.price_relative')} AS price_relative, s.candidate_count, n.rejected_series_ids
    FROM ssel s JOIN (SELECT economy, category, period, array_to_string(list(series_id ORDER BY evidence_class, source_priority, series_id)[2:], '|') AS rejected_series_ids FROM snorm GROUP BY ALL) n
      ON s.economy IS NOT DISTINCT FROM n.economy AND s.category IS NOT DISTINCT FROM n.category AND s.period IS NOT DISTINCT FROM n.period""", "ssel"))
def select_best_price(spark, sf_dir):
    rows = _targeted(table(spark, sf_dir, "lineitem").count())
    return windows.select_best_price(normalized(spark, sf_dir), rows).withColumn("price_relative", r(F.col("price_relative")))


@query("rejected_candidates", sql("""
    SELECT n.economy, n.category, n.period, n.series_id, s.series_id AS selected_series FROM snorm n JOIN ssel s
      ON s.economy = n.economy AND s.category = n.category AND s.period = n.period WHERE n.series_id <> s.series_id""", "ssel"))
def rejected_candidates(spark, sf_dir):
    rows = normalized(spark, sf_dir)
    return windows.rejected_candidates(rows, windows.select_best_price(rows))


@query("source_switches", sql("""
    SELECT economy, category, period, series_id, previous_series, coalesce(previous_series <> series_id, false) AS switched
    FROM (SELECT *, lag(series_id) OVER (PARTITION BY economy, category ORDER BY period) AS previous_series FROM ssel)""", "ssel"))
def source_switches(spark, sf_dir):
    return windows.source_switches(windows.select_best_price(normalized(spark, sf_dir))).select(
        "economy", "category", "period", "series_id", "previous_series", "switched")


@query("candidate_ladder", sql("""
    SELECT economy, target AS category, CAST(substr(evidence_class, 2, 1) AS INTEGER) AS rank, source_priority, series_id FROM sdef WHERE enabled""", "sdef"))
def candidate_ladder(spark, sf_dir):
    return windows.candidate_ladder(definitions(spark, sf_dir))


# cells of the core index: economies whose number is below ten, renormalised once
base.add("core_weights", """
    SELECT economy, category, weight / (SELECT sum(weight) FROM weights WHERE length(economy) = 8) AS weight FROM weights WHERE length(economy) = 8""", "weights")
base.add("igrid", """
    SELECT x.index_id, x.economy, x.category, p.period, x.weight, s.price_relative, s.evidence_class
    FROM (SELECT 'GLOBAL' AS index_id, * FROM weights UNION ALL SELECT 'CORE', * FROM core_weights) x, (SELECT DISTINCT period FROM ssel) p
    LEFT JOIN ssel s ON s.economy = x.economy AND s.category = x.category AND s.period = p.period""", "weights", "core_weights", "ssel")
_INDEX_BY_ID = INDEX_SQL.format("igrid").replace("SELECT period,", "SELECT index_id, period,").replace("GROUP BY period", "GROUP BY index_id, period")


def indices(spark, sf_dir):
    weights = cut(tables.weights_of(cut(tables.observations(spark, sf_dir))))
    core = weights.filter(F.length("economy") == 8)
    core = core.withColumn("total", core.agg(F.sum("weight")).scalar()).select("economy", "category", (F.col("weight") / F.col("total")).alias("weight"))
    return index.monthly_indices(weights, core, cut(windows.select_best_price(normalized(spark, sf_dir)).drop("rejected_series_ids")))


@query("monthly_indices", sql(_INDEX_BY_ID, "igrid"))
def monthly_indices(spark, sf_dir):
    return index_rows(indices(spark, sf_dir)["index"])


@query("monthly_contributions", sql(f"""
    SELECT g.index_id, g.period, g.economy, g.category, {rnd('weight * price_relative')} AS points, {rnd('weight * (price_relative - 100)')} AS contribution_since_reference, evidence_class
    FROM igrid g JOIN (SELECT index_id, period FROM igrid GROUP BY ALL HAVING abs(coalesce(sum(weight) FILTER (WHERE price_relative IS NOT NULL), 0) - 1) <= 1e-9) USING (index_id, period)""", "igrid"))
def monthly_contributions(spark, sf_dir):
    rows = indices(spark, sf_dir)["contributions"]
    return rows.select("index_id", "period", "economy", "category", r(F.col("points")).alias("points"),
                       r(F.col("contribution_since_reference")).alias("contribution_since_reference"), "evidence_class")


@query("index_change", sql(f"""
    SELECT period, {rnd('value')} AS value, {rnd('(value / lag(value) OVER (ORDER BY period) - 1) * 100')} AS change_percent
    FROM (SELECT period, sum(weight * price_relative) AS value FROM rrel JOIN rweights USING (economy, category) GROUP BY 1)""", "rrel", "rweights"))
def index_change(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    values = tables.relatives_of(obs, REFERENCE).join(tables.weights_of(obs), ["economy", "category"]).groupBy("period").agg(
        F.sum(F.col("weight") * F.col("price_relative")).alias("value"))
    return windows.index_change(values.withColumn("index_id", F.lit("ALL"))).select("period", r(F.col("value")).alias("value"), r(F.col("change_percent")).alias("change_percent"))


# the pilot reads a panel whose categories are canonical, so that long unbroken runs exist
base.add("prefix", f"""
    SELECT economy, count(*) AS run_months, count(*) >= 6 AS passes FROM (SELECT economy, period, row_number() OVER (PARTITION BY economy ORDER BY period) - 1 AS place,
        date_diff('month', DATE '{REFERENCE}-01', CAST(period || '-01' AS DATE)) AS off FROM rel WHERE period >= '{REFERENCE}' GROUP BY economy, period HAVING count(DISTINCT category) = 6)
    WHERE place = off GROUP BY economy""", "rel")
base.add("interval", f"""
    SELECT m.period, count(*) FILTER (WHERE r.economy IS NULL) AS missing_cell_count, coalesce(string_agg(m.economy || ':' || m.category, '|' ORDER BY m.economy, m.category) FILTER (WHERE r.economy IS NULL), '') AS missing_cells,
           CASE WHEN date_diff('month', DATE '{REFERENCE}-01', CAST(m.period || '-01' AS DATE)) < (SELECT min(run_months) FROM prefix WHERE passes) THEN 'COMMON'
                WHEN count(*) FILTER (WHERE r.economy IS NULL) = 0 THEN 'OUTSIDE_LARGEST_COMMON_COMPLETE_INTERVAL' ELSE 'INCOMPLETE_FIXED_UNIVERSE_MONTH' END AS reason
    FROM (SELECT economy, category, strftime(d, '%Y-%m') AS period FROM prefix, {_TYPES},
          (SELECT unnest(generate_series(DATE '{REFERENCE}-01', (SELECT max(CAST(period || '-01' AS DATE)) FROM rel), INTERVAL 1 MONTH)) AS d) WHERE passes) m
    LEFT JOIN rel r ON r.economy = m.economy AND r.category = m.category AND r.period = m.period GROUP BY m.period""", "prefix", "rel")
base.add("pilot_weights", "SELECT economy, category, weight / (SELECT sum(weight) FROM weights WHERE economy IN (SELECT economy FROM prefix WHERE passes)) AS weight FROM weights WHERE economy IN (SELECT economy FROM prefix WHERE passes)", "weights", "prefix")


def pilot(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir))
    return index.fixed_universe_pilot(tables.weights_of(obs), tables.relatives_of(obs, REFERENCE), bridge(spark), REFERENCE, tables.CATEGORIES, 6)


@query("complete_prefix", sql("SELECT * FROM prefix", "prefix"))
def complete_prefix(spark, sf_dir):
    return windows.complete_prefix(tables.relatives_of(tables.observations(spark, sf_dir), REFERENCE), REFERENCE, 6, 6)


@query("common_interval", sql("SELECT * FROM interval", "interval"))
def common_interval(spark, sf_dir):
    panel = cut(tables.relatives_of(tables.observations(spark, sf_dir), REFERENCE))
    return windows.common_interval(windows.complete_prefix(panel, REFERENCE, 6, 6), panel, REFERENCE, tables.CATEGORIES)


@query("fixed_universe_pilot", sql(f"""
    SELECT period, {rnd('sum(weight * price_relative)')} AS value, {rnd("(SELECT sum(weight) FROM weights WHERE economy IN (SELECT economy FROM prefix WHERE passes))", 9)} AS covered_world_weight, count(*) AS cells
    FROM rel JOIN pilot_weights USING (economy, category) WHERE period IN (SELECT period FROM interval WHERE reason = 'COMMON') GROUP BY period""", "rel", "pilot_weights", "interval"))
def fixed_universe_pilot(spark, sf_dir):
    return pilot(spark, sf_dir)["index"].select("period", r(F.col("value")).alias("value"), r(F.col("covered_world_weight"), 9).alias("covered_world_weight"), "cells")


base.add("vcells", """
    SELECT o.economy, o.category, o.period, 100 * o.unit_price / b.base_value AS price_relative, w.weight FROM robs o JOIN rweights w USING (economy, category)
    JOIN (SELECT economy, category, avg(unit_price) AS base_value FROM robs WHERE period LIKE '1996-%' GROUP BY ALL HAVING count(*) = 12) b USING (economy, category)""", "robs", "rweights")


@query("vertical_series", sql(f"""
    WITH_PLACE SELECT period, {rnd('value')} AS value, {rnd('(value / lag(value) OVER (ORDER BY period) - 1) * 100')} AS change_percent FROM (SELECT period, sum(weight * price_relative) AS value FROM vcells GROUP BY 1)""".replace("WITH_PLACE ", ""), "vcells"))
def vertical_series(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    rows = index.vertical_series(obs, tables.weights_of(obs), 1996)["index"]
    return rows.select("period", r(F.col("value")).alias("value"), r(F.col("change_percent")).alias("change_percent"))


@query("vertical_contributions", sql(f"""
    SELECT period, category, {rnd('c')} AS contribution, {rnd('c / sum(c) OVER (PARTITION BY period)', 9)} AS share FROM (SELECT period, category, sum(weight * price_relative) AS c FROM vcells GROUP BY ALL)""", "vcells"))
def vertical_contributions(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    rows = index.vertical_series(obs, tables.weights_of(obs), 1996)["by_category"]
    return rows.select("period", "category", r(F.col("contribution")).alias("contribution"), r(F.col("share"), 9).alias("share"))


@query("headline_series", sql(f"""
    SELECT period, {rnd('100 * avg(unit_price / base_value)')} AS equal_index, {rnd('100 * sum(unit_price / base_value * w)')} AS weighted_index
    FROM rheadline JOIN (SELECT economy, avg(unit_price) AS base_value FROM rheadline WHERE period LIKE '1996-%' GROUP BY 1 HAVING count(*) = 12) USING (economy)
    JOIN (SELECT economy, sum(weight) AS w FROM rweights GROUP BY 1) USING (economy) GROUP BY period""", "rheadline", "rweights"))
def headline_series(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    rows = index.headline_series(tables.headline_of(obs), tables.weights_of(obs), 1996)
    return rows.select("period", r(F.col("equal_index")).alias("equal_index"), r(F.col("weighted_index")).alias("weighted_index"))


base.add("rassign", """
    SELECT r_name AS economy, CASE r_regionkey WHEN 0 THEN 'EUR' ELSE 'C0' || r_regionkey END AS currency, '1995-01' AS effective_from,
           CASE WHEN r_regionkey = 1 THEN '1999-06' ELSE '9999-12' END AS effective_to FROM region UNION ALL SELECT r_name, 'EUR', '1999-07', '9999-12' FROM region WHERE r_regionkey = 1""")
base.add("fxcells", f"""
    SELECT c.*, a.currency, b.currency AS reference_currency, CASE WHEN a.currency <> b.currency THEN 'UNRATIFIED_CURRENCY_TRANSITION_' || b.currency || '_TO_' || a.currency
             WHEN a.currency <> 'EUR' AND (f.rate IS NULL OR g.rate IS NULL) THEN 'MISSING_FX' ELSE '' END AS reason,
           CASE WHEN a.currency = 'EUR' THEN 1.0 ELSE (g.rate * g.redenomination) / (f.rate * f.redenomination) END AS factor
    FROM (SELECT * FROM rrel JOIN rweights USING (economy, category)) c JOIN rassign a ON a.economy = c.economy AND c.period BETWEEN a.effective_from AND a.effective_to
    JOIN rassign b ON b.economy = c.economy AND '{REFERENCE}' BETWEEN b.effective_from AND b.effective_to
    LEFT JOIN (SELECT currency, period, CASE WHEN currency = 'C03' AND period LIKE '1998%' THEN NULL ELSE rate END AS rate, redenomination FROM fx) f ON f.currency = a.currency AND f.period = c.period
    LEFT JOIN fx g ON g.currency = a.currency AND g.period = '{REFERENCE}'""", "rrel", "rweights", "rassign", "fx")


def separated(spark, sf_dir):
    key = F.col("r_regionkey")
    region = table(spark, sf_dir, "region")
    first = region.select(F.col("r_name").alias("economy"), F.when(key == 0, "EUR").otherwise(F.concat(F.lit("C0"), key)).alias("currency"),
                          F.lit("1995-01").alias("effective_from"), F.when(key == 1, "1999-06").otherwise("").alias("effective_to"))
    second = region.filter(key == 1).select(F.col("r_name").alias("economy"), F.lit("EUR").alias("currency"), F.lit("1999-07").alias("effective_from"), F.lit("").alias("effective_to"))
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    weights = cut(tables.weights_of(obs))
    cells = tables.relatives_of(obs, REFERENCE).join(weights, ["economy", "category"]).withColumn("price_basis", F.lit(index.PRICE_BASIS))
    gap = (F.col("currency") == "C03") & F.col("period").startswith("1998")  # a year without a published rate
    fx = fx_rates(spark, sf_dir).withColumn("rate", F.when(~gap, F.col("rate"))).withColumn("convention", F.lit(index.RATE_CONVENTION))
    return index.fx_separation(cut(cells), first.unionByName(second), fx, REFERENCE, weights)


@query("fx_separation", sql(f"""
    SELECT period, {rnd('l')} AS local_index, CASE WHEN abs(w - 1) <= 1e-9 THEN {rnd('c')} END AS common_index, CASE WHEN abs(w - 1) <= 1e-9 THEN 'COMPLETE' ELSE 'INCOMPLETE_FX' END AS status,
           {rnd('w', 9)} AS covered_weight, {rnd('greatest(0.0, 1 - w)', 9)} AS missing_weight
    FROM (SELECT period, sum(weight * price_relative) AS l, sum(weight * price_relative * factor) FILTER (WHERE reason = '') AS c, coalesce(sum(weight) FILTER (WHERE reason = ''), 0) AS w FROM fxcells GROUP BY 1)""", "fxcells"))
def fx_separation(spark, sf_dir):
    rows = separated(spark, sf_dir)["index"]
    return rows.select("period", "status", r(F.col("local_index")).alias("local_index"), r(F.col("common_index")).alias("common_index"),
                       r(F.col("covered_weight"), 9).alias("covered_weight"), r(F.col("missing_weight"), 9).alias("missing_weight"))


@query("fx_coverage", sql(f"SELECT period, economy, currency, reason, {rnd('sum(weight)', 9)} AS weight, reason = '' AS fx_available FROM fxcells GROUP BY ALL", "fxcells"))
def fx_coverage(spark, sf_dir):
    return separated(spark, sf_dir)["coverage"].withColumn("weight", r(F.col("weight"), 9))
