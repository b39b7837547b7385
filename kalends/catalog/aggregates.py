"""Aggregations over line items, panels and error cases derived from them."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.base import rnd, sql
from kalends.catalog.joins import BRIDGE_SQL, bridge
from kalends.functions.classes import EVIDENCE_CLASSES
from kalends.functions.numbers import rnd as r
from kalends.operators import aggregates, joins, ranks
from kalends.session import cut
from kalends.sources import tables
from kalends.sources.tables import MONEY, table

CLASSES_SQL = "[" + ",".join(f"'{c}'" for c in EVIDENCE_CLASSES) + "]"


def evidence_by_cell():
    """Evidence class of a cell from the spelling of its keys, so that all five classes occur."""
    pick = (F.length("economy") * 3 + F.length("category") + F.month(F.to_date(F.concat("period", F.lit("-01"))))) % 5 + 1
    return F.element_at(F.array(*[F.lit(c) for c in EVIDENCE_CLASSES]), pick)


base.add("grid", f"""
    SELECT w.economy, w.category, p.period, w.weight, r.price_relative,
           CASE WHEN r.price_relative IS NOT NULL THEN {CLASSES_SQL}[(length(w.economy) * 3 + length(w.category) + CAST(substr(p.period, 6, 2) AS INTEGER)) % 5 + 1] END AS evidence_class
    FROM weights w, (SELECT DISTINCT period FROM rel) p LEFT JOIN rel r ON r.economy = w.economy AND r.category = w.category AND r.period = p.period""", "weights", "rel")


def grid(spark, sf_dir):
    """Weight grid of every month with relatives (holes are null) and evidence classes."""
    obs = cut(tables.observations(spark, sf_dir))
    cells = joins.attach_weights(tables.relatives_of(obs, "1996-01"), tables.weights_of(obs))
    return cells.withColumn("evidence_class", F.when(F.col("price_relative").isNotNull(), evidence_by_cell()))


INDEX_SQL = f"""
    SELECT period, CASE WHEN abs(covered - 1) <= 1e-9 THEN {rnd('weighted')} END AS value, CASE WHEN abs(covered - 1) <= 1e-9 THEN 'COMPLETE' ELSE 'INCOMPLETE' END AS status,
           {rnd('covered', 9)} AS covered_weight, {rnd('direct', 9)} AS direct_weight, {rnd('covered - direct', 9)} AS proxy_weight, missing_cell_count, coalesce(missing_cells, '') AS missing_cells
    FROM (SELECT period, sum(weight * price_relative) AS weighted, coalesce(sum(weight) FILTER (WHERE price_relative IS NOT NULL), 0) AS covered,
                 coalesce(sum(weight) FILTER (WHERE evidence_class IN ('P1_OFFICIAL_CATEGORY', 'P2_OFFICIAL_AGGREGATE')), 0) AS direct,
                 count(*) FILTER (WHERE price_relative IS NULL) AS missing_cell_count,
                 string_agg(economy || ':' || category, '|' ORDER BY economy, category) FILTER (WHERE price_relative IS NULL) AS missing_cells
          FROM {{0}} GROUP BY period)"""


def index_rows(df):
    return df.withColumn("value", r(F.col("value"))).withColumn("covered_weight", r(F.col("covered_weight"), 9)).withColumn(
        "direct_weight", r(F.col("direct_weight"), 9)).withColumn("proxy_weight", r(F.col("proxy_weight"), 9))


@query("fixed_weight_index", sql(INDEX_SQL.format("grid"), "grid"))
def fixed_weight_index(spark, sf_dir):
    return index_rows(aggregates.fixed_weight_index(grid(spark, sf_dir)))


@query("contributions_by", sql(f"""
    SELECT period, economy, {rnd('c')} AS contribution, {rnd('c / sum(c) OVER (PARTITION BY period)', 9)} AS share
    FROM (SELECT period, economy, sum(weight * price_relative) AS c FROM rrel JOIN rweights USING (economy, category) GROUP BY ALL)""", "rrel", "rweights"))
def contributions_by(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    cells = tables.relatives_of(obs, "1996-01").join(tables.weights_of(obs), ["economy", "category"])
    return aggregates.contributions_by(cells, ["economy"]).select("period", "economy", r(F.col("contribution")).alias("contribution"), r(F.col("share"), 9).alias("share"))


@query("canonical_merge", sql(f"""
    SELECT period, economy, canonical, {rnd('sum(weight)', 9)} AS weight, {rnd('sum(weight * price_relative)')} AS points, {rnd('sum(weight * price_relative) / sum(weight)')} AS price_relative,
           {rnd('sum(weight * (price_relative - 100))')} AS contribution_since_reference, string_agg(DISTINCT category, '|' ORDER BY category) AS source_categories,
           CASE WHEN count(DISTINCT category) = 1 THEN 'EXACT_ONE_TO_ONE' ELSE 'EXACT_MERGE' END AS mapping_type
    FROM rel JOIN weights USING (economy, category) JOIN {BRIDGE_SQL} ON category = b.source_category GROUP BY period, economy, canonical""", "rel", "weights"))
def canonical_merge(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir))
    cells = tables.relatives_of(obs, "1996-01").join(tables.weights_of(obs), ["economy", "category"])
    merged = aggregates.canonical_merge(cells, bridge(spark))
    return merged.withColumn("weight", r(F.col("weight"), 9)).withColumn("points", r(F.col("points"))).withColumn("price_relative", r(F.col("price_relative"))).withColumn(
        "contribution_since_reference", r(F.col("contribution_since_reference")))


@query("evidence_coverage", sql(f"""
    SELECT p.period, c.evidence_class, {rnd('coalesce(sum(g.weight), 0)', 9)} AS weight_share FROM (SELECT DISTINCT period FROM grid) p, (SELECT unnest({CLASSES_SQL}) AS evidence_class) c
    LEFT JOIN grid g ON g.period = p.period AND g.evidence_class = c.evidence_class GROUP BY ALL""", "grid"))
def evidence_coverage(spark, sf_dir):
    return aggregates.evidence_coverage(grid(spark, sf_dir)).withColumn("weight_share", r(F.col("weight_share"), 9))


@query("annual_base_relatives", sql(f"""
    SELECT economy, category, period, {rnd('unit_price / base_value', 9)} AS relative FROM obs JOIN (SELECT economy, category, avg(unit_price) AS base_value FROM obs
      WHERE period LIKE '1996-%' GROUP BY ALL HAVING count(*) = 12) USING (economy, category)""", "obs"))
def annual_base_relatives(spark, sf_dir):
    obs = tables.observations(spark, sf_dir)
    return aggregates.annual_base_relatives(obs, 1996, ["economy", "category"]).select("economy", "category", "period", r(F.col("relative"), 9).alias("relative"))


@query("weighted_mean_factor", sql(f"""
    SELECT category, period, {rnd('sum(factor * weight) / sum(weight)')} AS weighted_mean, {rnd('avg(factor)')} AS simple_mean, count(*) AS items
    FROM (SELECT category, period, rate + 1 AS factor, weight FROM rates JOIN weights USING (economy, category) WHERE rate IS NOT NULL) GROUP BY ALL""", "rates", "weights"))
def weighted_mean_factor(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir))
    factors = joins.monthly_rates(obs, ["economy", "category"], "unit_price").join(tables.weights_of(obs), ["economy", "category"]).filter("rate is not null")
    means = aggregates.weighted_mean_factor(factors.withColumn("factor", F.col("rate") + 1), ["category", "period"], "factor", "weight")
    return means.withColumn("weighted_mean", r(F.col("weighted_mean"))).withColumn("simple_mean", r(F.col("simple_mean")))


@query("weighted_quantile", """
    WITH c AS (SELECT l_returnflag, price, w, sum(w) OVER (PARTITION BY l_returnflag ORDER BY price) AS cum, sum(w) OVER (PARTITION BY l_returnflag) AS total
      FROM (SELECT l_returnflag, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, sum(CAST(l_quantity AS DECIMAL(18,2))) AS w FROM lineitem GROUP BY 1, 2))
    SELECT l_returnflag, CAST(min(price) FILTER (WHERE cum >= total * 0.1) AS DOUBLE) AS q10, CAST(min(price) FILTER (WHERE cum >= total * 0.5) AS DOUBLE) AS q50,
           CAST(min(price) FILTER (WHERE cum >= total * 0.9) AS DOUBLE) AS q90 FROM c GROUP BY 1""")
def weighted_quantile(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_extendedprice", F.col("l_quantity").cast(MONEY).alias("units"))
    return ranks.weighted_quantile(lines, ["l_returnflag"], "l_extendedprice", "units", {"q10": 0.1, "q50": 0.5, "q90": 0.9})


@query("percentile_linear", f"""
    SELECT l_returnflag, l_linestatus, {rnd('quantile_cont(l_extendedprice, 0.5)')} AS median, {rnd('quantile_cont(l_extendedprice, 0.953)')} AS p953 FROM lineitem GROUP BY 1, 2""")
def percentile_linear(spark, sf_dir):
    found = ranks.percentile_linear(table(spark, sf_dir, "lineitem"), ["l_returnflag", "l_linestatus"], "l_extendedprice", {"median": 0.5, "p953": 0.953})
    return found.withColumn("median", r(F.col("median"))).withColumn("p953", r(F.col("p953")))


@query("percentile_nearest_rank", """
    SELECT l_returnflag, quantile_disc(l_extendedprice, 0.95) AS p95, quantile_disc(l_extendedprice, 0.05) AS p05 FROM lineitem GROUP BY 1""")
def percentile_nearest_rank(spark, sf_dir):
    return ranks.percentile_nearest_rank(table(spark, sf_dir, "lineitem"), ["l_returnflag"], "l_extendedprice", {"p95": 0.95, "p05": 0.05})


@query("upper_median", """
    SELECT l_suppkey, l_extendedprice AS median FROM (SELECT l_suppkey, l_extendedprice, row_number() OVER (PARTITION BY l_suppkey ORDER BY l_extendedprice) AS k,
           count(*) OVER (PARTITION BY l_suppkey) AS n FROM lineitem) WHERE k = n // 2 + 1""")
def upper_median(spark, sf_dir):
    return ranks.upper_median(table(spark, sf_dir, "lineitem"), ["l_suppkey"], "l_extendedprice")


base.add("errors", """
    SELECT p_brand AS brand, p_type AS type, strftime(l_shipdate, '%Y') AS year, l_quantity * p_retailprice - l_extendedprice AS error,
           abs(l_quantity * p_retailprice - l_extendedprice) / l_extendedprice * 100 AS ape, abs(l_quantity * p_retailprice / l_extendedprice - 1) * 10000 AS bps,
           l_extendedprice BETWEEN l_quantity * p_retailprice * 0.5 AND l_quantity * p_retailprice * 1.5 AS covered FROM lineitem JOIN part ON l_partkey = p_partkey""")


def errors(spark, sf_dir):
    """Estimate each line's price from the list price of its part: one error case per line item."""
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_brand").alias("brand"), F.col("p_type").alias("type"), "p_retailprice")
    estimate = F.col("l_quantity") * F.col("p_retailprice")
    truth = F.col("l_extendedprice")
    return table(spark, sf_dir, "lineitem").join(part, F.col("l_partkey") == F.col("p_partkey")).select(
        "brand", "type", F.date_format("l_shipdate", "yyyy").alias("year"), (estimate - truth).alias("error"), (F.abs(estimate - truth) / truth * 100).alias("ape"),
        (F.abs(estimate / truth - 1) * 10000).alias("bps"), truth.between(estimate * 0.5, estimate * 1.5).alias("covered"))


@query("error_metrics", sql(f"""
    SELECT brand, count(*) AS case_count, {rnd('avg(abs(error))', 4)} AS mae, {rnd('avg(ape)', 4)} AS mape, {rnd('sqrt(avg(error * error))', 4)} AS rmse, {rnd('avg(error)', 4)} AS bias,
           {rnd('avg(CAST(covered AS DOUBLE))')} AS coverage, {rnd('avg(bps)', 3)} AS mean_bps, {rnd('max(bps)', 3)} AS max_bps, {rnd('quantile_cont(bps, 0.95)', 3)} AS p95_bps
    FROM errors GROUP BY brand""", "errors"))
def error_metrics(spark, sf_dir):
    cases = cut(errors(spark, sf_dir).select("brand", "error", "ape", "bps", "covered"))
    found = aggregates.error_metrics(cases, ["brand"])
    for name, places in (("mae", 4), ("mape", 4), ("rmse", 4), ("bias", 4), ("coverage", 6), ("mean_bps", 3), ("max_bps", 3), ("p95_bps", 3)):
        found = found.withColumn(name, r(F.col(name), places))
    return found


@query("paired_rates", f"""
    WITH d AS (SELECT l_returnflag, l_tax * l_extendedprice AS challenger, l_discount * l_extendedprice AS baseline, round(l_tax * l_extendedprice - l_discount * l_extendedprice, 6) AS delta FROM lineitem)
    SELECT l_returnflag, count(*) AS case_count, count(*) FILTER (WHERE delta < 0) AS improvements, count(*) FILTER (WHERE delta > 0) AS regressions, {rnd('avg(challenger)', 4)} AS mean_challenger,
           {rnd('avg(baseline)', 4)} AS mean_baseline, {rnd('avg(delta)', 4)} AS mean_delta, {rnd('greatest(max(delta), 0)', 4)} AS worst_regression, {rnd('greatest(-min(delta), 0)', 4)} AS best_improvement,
           {rnd("quantile_cont(delta, 0.5)", 6)} AS median_delta, {rnd('quantile_cont(delta, 0.95)', 4)} AS p95_delta, {rnd('count(*) FILTER (WHERE delta < 0) / count(*)')} AS improvement_rate,
           {rnd('count(*) FILTER (WHERE delta > 0) / count(*)')} AS regression_rate, {rnd('1 - count(*) FILTER (WHERE delta <> 0) / count(*)')} AS tie_rate FROM d GROUP BY 1""")
def paired_rates(spark, sf_dir):
    price = F.col("l_extendedprice")
    deltas = table(spark, sf_dir, "lineitem").select("l_returnflag", (F.col("l_tax") * price).alias("challenger"), (F.col("l_discount") * price).alias("baseline"))
    found = aggregates.paired_rates(deltas.withColumn("delta", F.round(F.col("challenger") - F.col("baseline"), 6)), ["l_returnflag"])
    for name in ("mean_challenger", "mean_baseline", "mean_delta", "worst_regression", "best_improvement", "p95_delta"):
        found = found.withColumn(name, r(F.col(name), 4))
    for name in ("improvement_rate", "regression_rate", "tie_rate", "median_delta"):
        found = found.withColumn(name, r(F.col(name)))
    return found


@query("scoped_rollup", sql(f"""
    SELECT CASE WHEN grouping(brand) = 1 AND grouping(type) = 1 THEN 'overall' WHEN grouping(type) = 1 THEN 'brand' ELSE 'type' END AS scope, coalesce(brand, '*') AS brand, coalesce(type, '*') AS type,
           year, count(*) AS case_count, {rnd('avg(bps)', 3)} AS mean_bps, {rnd('max(bps)', 3)} AS max_bps FROM errors GROUP BY GROUPING SETS ((year), (brand, year), (type, year))""", "errors"))
def scoped_rollup(spark, sf_dir):
    found = aggregates.scoped_rollup(errors(spark, sf_dir), (("overall", ()), ("brand", ("brand",)), ("type", ("type",))), ["year"],
                                     [F.count("*").alias("case_count"), F.avg("bps").alias("mean_bps"), F.max("bps").alias("max_bps")])
    return found.withColumn("mean_bps", r(F.col("mean_bps"), 3)).withColumn("max_bps", r(F.col("max_bps"), 3))


@query("coverage_extremes", sql(f"""
    SELECT {rnd('min(d)', 9)} AS minimum_direct_weight, {rnd('max(p3)', 9)} AS maximum_p3_weight, {rnd('max(p5)', 9)} AS maximum_p5_weight FROM (SELECT period,
      coalesce(sum(weight) FILTER (WHERE evidence_class < 'P3'), 0) AS d, coalesce(sum(weight) FILTER (WHERE evidence_class LIKE 'P3%'), 0) AS p3,
      coalesce(sum(weight) FILTER (WHERE evidence_class LIKE 'P5%'), 0) AS p5 FROM grid GROUP BY period)""", "grid"))
def coverage_extremes(spark, sf_dir):
    found = aggregates.coverage_extremes(aggregates.evidence_coverage(grid(spark, sf_dir)))
    return found.select(*[r(F.col(c), 9).alias(c) for c in found.columns])


@query("smallest_group", "SELECT min(n) AS smallest_group FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_suppkey)")
def smallest_group(spark, sf_dir):
    return aggregates.smallest_group(table(spark, sf_dir, "lineitem"), "l_suppkey")


@query("evidence_weight_shares", f"""
    WITH c AS (SELECT CAST(l_extendedprice AS DOUBLE) AS central, l_returnflag AS e, l_discount > 0.02 AS m, l_tax > 0.01 AS b FROM lineitem)
    SELECT count(*) AS cells, count(*) FILTER (WHERE e <> 'A') AS estimated_cells, {rnd("sum(central) FILTER (WHERE e = 'A') / sum(central)", 8)} AS core_share,
           {rnd("sum(central) FILTER (WHERE e <> 'A') / sum(central)", 8)} AS estimated_share, {rnd("sum(central) FILTER (WHERE e = 'R') / sum(central)", 8)} AS class_e_share,
           {rnd("count(*) FILTER (WHERE e <> 'A' AND m AND b) / count(*) FILTER (WHERE e <> 'A')", 8)} AS metric_coverage FROM c""")
def evidence_weight_shares(spark, sf_dir):
    flag = F.col("l_returnflag")
    letter = F.when(flag == "A", "A_OBSERVED").when(flag == "R", "E_FALLBACK").otherwise("D_DONOR")
    cells = table(spark, sf_dir, "lineitem").select(F.col("l_extendedprice").alias("central"), letter.alias("evidence_class"),
                                                    F.when(F.col("l_discount") > 0.02, F.col("l_discount")).alias("validation_mae"),
                                                    F.when(F.col("l_tax") > 0.01, F.col("l_tax")).alias("validation_bias"))
    found = aggregates.evidence_weight_shares(cells)
    return found.select("cells", "estimated_cells", *[r(F.col(c), 8).alias(c) for c in ("core_share", "estimated_share", "class_e_share", "metric_coverage")])


@query("category_coverage", """
    WITH h AS (SELECT l_suppkey, list(p_type) AS held FROM (SELECT l_suppkey, p_type FROM lineitem JOIN part ON l_partkey = p_partkey
      GROUP BY 1, 2 HAVING 3 * count(*) FILTER (l_returnflag = 'R') <= count(*)) GROUP BY 1)
    SELECT s_name AS economy, coalesce(len(held), 0)::INTEGER AS available, 6 AS required, coalesce(len(held), 0) = 6 AS complete,
           array_to_string(list_filter(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], lambda c: NOT list_contains(coalesce(held, []), c)), '|') AS missing
    FROM supplier LEFT JOIN h ON l_suppkey = s_suppkey""")
def category_coverage(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("category"))
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("economy"))
    # a supplier's category is available unless over a third of its lines came back
    lines = table(spark, sf_dir, "lineitem").select("l_suppkey", "l_partkey", "l_returnflag").join(part, F.col("l_partkey") == F.col("p_partkey"))
    shares = lines.groupBy("l_suppkey", "category").agg((3 * F.count_if(F.col("l_returnflag") == "R") <= F.count("*")).alias("available"))
    held = shares.filter("available").join(supplier, F.col("l_suppkey") == F.col("s_suppkey"))
    return aggregates.category_coverage(held, supplier.select("economy"), tables.CATEGORIES)


@query("reconcile_total", """
    WITH i AS (SELECT o_orderkey, CAST(o_totalprice AS DECIMAL(18,2)) AS total FROM orders), l AS (SELECT l_orderkey,
      sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag <> 'R') AS a, sum(CAST(l_extendedprice AS DECIMAL(18,2))) FILTER (WHERE l_returnflag = 'R') AS x FROM lineitem GROUP BY 1)
    SELECT o_orderkey, CAST(total AS DOUBLE) AS source_total, CAST(coalesce(a, 0) AS DOUBLE) AS accepted_total, CAST(coalesce(x, 0) AS DOUBLE) AS excluded_total,
           CAST(coalesce(a, 0) + coalesce(x, 0) AS DOUBLE) AS reconstructed_total, CAST(total - coalesce(a, 0) - coalesce(x, 0) AS DOUBLE) AS difference,
           CASE WHEN total - coalesce(a, 0) - coalesce(x, 0) = 0 THEN 'PASS' ELSE 'FAIL' END AS status FROM i LEFT JOIN l ON l_orderkey = o_orderkey""")
def reconcile_total(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.lit("TOTAL").alias("role"), F.col("o_totalprice").cast(MONEY).alias("amount"))
    parts = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), F.when(F.col("l_returnflag") == "R", "EXCLUDED").otherwise("ACCEPTED").alias("role"),
                                                    F.col("l_extendedprice").cast(MONEY).alias("amount"))
    found = aggregates.reconcile_total(orders.unionByName(parts), ["o_orderkey"])
    money = ("source_total", "accepted_total", "excluded_total", "reconstructed_total", "difference")
    return found.select("o_orderkey", *[F.col(c).cast("double").alias(c) for c in money], "status")
