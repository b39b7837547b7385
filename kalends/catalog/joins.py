"""Join operators over the driver's panel, profiles and customers."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.base import rnd, sql
from kalends.catalog.functions import normalized_sql
from kalends.functions.numbers import rnd as r
from kalends.operators import joins
from kalends.session import cut
from kalends.sources import tables
from kalends.sources.tables import table

# A bridge from the six part types to four canonical categories.
BRIDGE = (("ECONOMY", "BASIC"), ("STANDARD", "BASIC"), ("SMALL", "SIZED"), ("MEDIUM", "SIZED"), ("LARGE", "BULK"), ("PROMO", "OFFERS"))
BRIDGE_SQL = "(VALUES " + ", ".join(f"('{a}','{b}')" for a, b in BRIDGE) + ") b(source_category, canonical)"


def bridge(spark):
    return spark.createDataFrame(BRIDGE, "source_category string, canonical string").withColumn(
        "mapping_type", F.when(F.col("canonical").isin("BASIC", "SIZED"), "EXACT_MERGE").otherwise("EXACT_ONE_TO_ONE"))


@query("attach_weights", sql(f"""
    SELECT w.economy, w.category, p.period, {rnd('w.weight', 9)} AS weight, {rnd('r.price_relative')} AS price_relative
    FROM weights w, (SELECT DISTINCT period FROM rel) p LEFT JOIN rel r ON r.economy = w.economy AND r.category = w.category AND r.period = p.period""",
    "weights", "rel"))
def attach_weights(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir))
    cells = joins.attach_weights(tables.relatives_of(obs, "1996-01"), tables.weights_of(obs))
    return cells.select("economy", "category", "period", r(F.col("weight"), 9).alias("weight"), r(F.col("price_relative")).alias("price_relative"))


@query("map_categories", sql(f"""
    SELECT o.economy, b.canonical, o.period, count(*) AS source_cells, {rnd('sum(o.value)', 2)} AS value
    FROM obs o JOIN {BRIDGE_SQL} ON o.category = b.source_category GROUP BY ALL""", "obs"))
def map_categories(spark, sf_dir):
    mapped = joins.map_categories(tables.observations(spark, sf_dir), bridge(spark))
    return mapped.groupBy("economy", "canonical", "period").agg(F.count("*").alias("source_cells"), r(F.sum("value"), 2).alias("value"))


base.add("assignments", """
    SELECT n_name AS economy, CASE WHEN n_nationkey % 6 = 0 THEN 'EUR' ELSE 'C' || lpad(CAST(n_nationkey AS VARCHAR), 2, '0') END AS currency,
           '1995-01' AS effective_from, CASE WHEN n_nationkey % 4 = 1 THEN '1999-06' WHEN n_nationkey % 4 = 2 THEN '1999-08' ELSE '' END AS effective_to FROM nation
    UNION ALL SELECT n_name, 'EUR', CASE WHEN n_nationkey % 8 = 5 THEN '1999-05' ELSE '1999-07' END, '' FROM nation WHERE n_nationkey % 4 = 1""")
base.add("currency_of", """
    SELECT k.economy, k.period, count(a.currency) AS matches, CASE WHEN count(a.currency) = 1 THEN min(a.currency) END AS currency
    FROM (SELECT DISTINCT economy, period FROM obs) k LEFT JOIN assignments a ON a.economy = k.economy AND a.effective_from <= k.period
         AND k.period <= CASE WHEN a.effective_to = '' THEN '9999-12' ELSE a.effective_to END GROUP BY 1, 2""", "obs", "assignments")
base.add("fx", """
    SELECT 'C' || lpad(CAST(c_nationkey AS VARCHAR), 2, '0') AS currency, strftime(o_orderdate, '%Y-%m') AS period,
           CASE WHEN c_nationkey % 9 <> 8 THEN CAST(sum(CAST(o_totalprice AS DECIMAL(18,2))) AS DOUBLE) / count(*) / 97531.0 END AS rate, CASE WHEN c_nationkey % 7 = 0 THEN 1000.0 ELSE 1.0 END AS redenomination
    FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY c_nationkey, period""")


def assignments(spark, sf_dir):
    """Validity intervals per nation; some overlap, some end too early, some nations move to the euro."""
    key = F.col("n_nationkey")
    code = F.concat(F.lit("C"), F.lpad(key.cast("string"), 2, "0"))
    nation = table(spark, sf_dir, "nation")
    first = nation.select(
        F.col("n_name").alias("economy"), F.when(key % 6 == 0, "EUR").otherwise(code).alias("currency"), F.lit("1995-01").alias("effective_from"),
        F.when(key % 4 == 1, "1999-06").when(key % 4 == 2, "1999-08").otherwise("").alias("effective_to"))
    second = nation.filter(key % 4 == 1).select(
        F.col("n_name").alias("economy"), F.lit("EUR").alias("currency"), F.when(key % 8 == 5, "1999-05").otherwise("1999-07").alias("effective_from"), F.lit("").alias("effective_to"))
    return first.unionByName(second)


def fx_rates(spark, sf_dir):
    """Monthly rate per nation currency from mean order totals; null where none was published."""
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    orders = table(spark, sf_dir, "orders")
    return (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .groupBy("c_nationkey", tables.month_of(F.col("o_orderdate")).alias("period"))
        .agg((F.sum(F.col("o_totalprice").cast(tables.MONEY)).cast("double") / F.count("*") / 97531.0).alias("rate"))
        .withColumn("rate", F.when(F.col("c_nationkey") % 9 != 8, F.col("rate")))
        .select(F.concat(F.lit("C"), F.lpad(F.col("c_nationkey").cast("string"), 2, "0")).alias("currency"), "period", "rate",
                F.when(F.col("c_nationkey") % 7 == 0, 1000.0).otherwise(1.0).alias("redenomination")))


@query("assign_currency", sql("SELECT * FROM currency_of", "currency_of"))
def assign_currency(spark, sf_dir):
    return joins.assign_currency(tables.observations(spark, sf_dir).select("economy", "period"), assignments(spark, sf_dir))


@query("attach_fx", sql(f"""
    SELECT c.economy, c.period, c.currency, {rnd("CASE WHEN c.currency = 'EUR' THEN 1.0 ELSE f.rate * f.redenomination END", 9)} AS current_fx,
           {rnd("CASE WHEN c.currency = 'EUR' THEN 1.0 ELSE g.rate * g.redenomination END", 9)} AS reference_fx
    FROM currency_of c LEFT JOIN fx f ON f.currency = c.currency AND f.period = c.period
    LEFT JOIN fx g ON g.currency = c.currency AND g.period = '1996-01'""", "currency_of", "fx"))
def attach_fx(spark, sf_dir):
    cells = joins.assign_currency(tables.observations(spark, sf_dir).select("economy", "period"), assignments(spark, sf_dir))
    found = joins.attach_fx(cells, fx_rates(spark, sf_dir), "1996-01")
    return found.select("economy", "period", "currency", r(F.col("current_fx"), 9).alias("current_fx"), r(F.col("reference_fx"), 9).alias("reference_fx"))


base.add("rates", """
    SELECT o.economy, o.category, o.period, o.unit_price, o.unit_price / p.unit_price - 1 AS rate
    FROM obs o LEFT JOIN obs p ON p.economy = o.economy AND p.category = o.category
         AND p.period = strftime(CAST(o.period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')""", "obs")
base.add("hrates", """
    SELECT o.economy, o.period, o.unit_price, o.unit_price / p.unit_price - 1 AS headline_rate
    FROM headline o LEFT JOIN headline p ON p.economy = o.economy
         AND p.period = strftime(CAST(o.period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')""", "headline")
base.add("pairs", """
    SELECT t.economy AS target, d.economy AS donor, t.region = d.region AS same_region, CASE WHEN t.income_group = d.income_group THEN 1 ELSE 0 END AS income_match,
           len(list_intersect(t.characteristics, d.characteristics)) AS overlap,
           (abs(t.mean_balance - d.mean_balance) / s.sb + abs(t.mean_order - d.mean_order) / s.so) / 2 AS distance,
           w.world_weight * (1 + CASE WHEN t.income_group = d.income_group THEN 1 ELSE 0 END + len(list_intersect(t.characteristics, d.characteristics)))
             / (1 + (abs(t.mean_balance - d.mean_balance) / s.sb + abs(t.mean_order - d.mean_order) / s.so) / 2) AS similarity
    FROM profiles t JOIN profiles d ON t.economy <> d.economy
    JOIN (SELECT economy, sum(weight) AS world_weight FROM weights GROUP BY 1) w ON w.economy = d.economy,
    (SELECT max(mean_balance) - min(mean_balance) AS sb, max(mean_order) - min(mean_order) AS so FROM profiles) s""", "profiles", "weights")
base.add("residuals", """
    SELECT r.economy AS donor, r.category, r.period, r.rate - h.headline_rate AS residual FROM rates r JOIN hrates h USING (economy, period)
    WHERE r.rate IS NOT NULL AND h.headline_rate IS NOT NULL""", "rates", "hrates")


@query("monthly_rates", sql(f"SELECT economy, category, period, {rnd('rate')} AS rate FROM rates", "rates"))
def monthly_rates(spark, sf_dir):
    rates = joins.monthly_rates(tables.observations(spark, sf_dir), ["economy", "category"], "unit_price")
    return rates.select("economy", "category", "period", r(F.col("rate")).alias("rate"))


def residuals(obs):
    """donor, category, period, residual: category rate minus headline rate of the same economy."""
    rates = joins.monthly_rates(obs, ["economy", "category"], "unit_price").select("economy", "category", "period", "rate")
    headline = joins.monthly_rates(tables.headline_of(obs), ["economy"], "unit_price", "headline_rate").select("economy", "period", "headline_rate")
    return rates.join(headline, ["economy", "period"]).filter("rate is not null and headline_rate is not null").select(
        F.col("economy").alias("donor"), "category", "period", (F.col("rate") - F.col("headline_rate")).alias("residual"))


@query("donor_pairs", sql(f"""
    SELECT target, donor, same_region, income_match, overlap::INTEGER AS overlap, {rnd('distance', 9)} AS distance, {rnd('similarity', 9)} AS similarity FROM pairs""", "pairs"))
def donor_pairs(spark, sf_dir):
    weights = tables.weights_of(cut(tables.observations(spark, sf_dir)))
    pairs = joins.donor_pairs(tables.profiles(spark, sf_dir), weights)
    return pairs.withColumn("distance", r(F.col("distance"), 9)).withColumn("similarity", r(F.col("similarity"), 9))


@query("history_residuals", sql(f"""
    SELECT target, category, period, sum(n) OVER w::BIGINT AS residual_count, {rnd('sum(s) OVER w', 7)} AS total_weight, {rnd('min(lo) OVER w')} AS lowest, {rnd('max(hi) OVER w')} AS highest
    FROM (SELECT p.target, r.category, r.period, count(*) AS n, sum(similarity) AS s, min(residual) AS lo, max(residual) AS hi
          FROM residuals r JOIN pairs p ON p.donor = r.donor GROUP BY ALL)
    WINDOW w AS (PARTITION BY target, category ORDER BY period ROWS UNBOUNDED PRECEDING)""", "residuals", "pairs").replace("sum(n) OVER w::BIGINT", "CAST(sum(n) OVER w AS BIGINT)"))
def history_residuals(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir))
    pairs = joins.donor_pairs(tables.profiles(spark, sf_dir), tables.weights_of(obs))
    found = joins.history_residuals(residuals(obs), pairs)
    return found.select("target", "category", "period", "residual_count", r(F.col("total_weight"), 7).alias("total_weight"),
                        r(F.col("lowest")).alias("lowest"), r(F.col("highest")).alias("highest"))


@query("as_of_panel", sql("""
    SELECT economy, category, period, strftime(release_date, '%Y-%m-%d') AS release_date, unit_price
    FROM robs JOIN calendar USING (period) WHERE release_date <= DATE '1999-03-20'""", "robs", "calendar"))
def as_of_panel(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    seen = joins.as_of_panel(obs, tables.release_calendar(obs), "1999-03-20")
    return seen.select("economy", "category", "period", F.date_format("release_date", "yyyy-MM-dd").alias("release_date"), "unit_price")


base.add("pairs_months", """
    SELECT origin, target, horizon FROM (SELECT o.period AS origin, h.horizon, strftime(CAST(o.period || '-01' AS DATE) + to_months(h.horizon), '%Y-%m') AS target
      FROM (SELECT DISTINCT period FROM robs) o, (SELECT unnest([1, 3, 6, 12])::INTEGER AS horizon) h WHERE o.period >= '1997-12' AND o.period < '2000-12')
    WHERE target BETWEEN '1998-01' AND '2000-12' AND target IN (SELECT period FROM robs)""", "robs")


@query("rolling_origin_pairs", sql("SELECT * FROM pairs_months", "pairs_months"))
def rolling_origin_pairs(spark, sf_dir):
    return joins.rolling_origin_pairs(tables.observations(spark, sf_dir, by="region").select("period"), (1, 3, 6, 12), ("1998-01", "2000-12"))


@query("map_names_to_codes", f"""
    WITH reg AS (SELECT 'S' || s_suppkey AS code, CASE WHEN s_suppkey % 10 = 0 THEN 'Sùpplier & Co' ELSE s_name END AS label FROM supplier),
      al AS (SELECT {normalized_sql("'CUSTOMER ' || c_custkey")} AS n, CASE WHEN c_custkey % 20 = 0 THEN 's' || (c_custkey % 90) ELSE 'supplier & cô' END AS alias
             FROM customer WHERE c_custkey % 10 = 0),
      x AS (SELECT name, {normalized_sql('name')} AS normalized FROM (SELECT CASE WHEN c_custkey % 10 < 2 THEN 'Customer ' || c_custkey
                  ELSE 'SUPPLIER  ' || lpad(CAST(c_custkey % 150 AS VARCHAR), 9, '0') END AS name FROM customer)),
      j AS (SELECT x.*, al.alias, c.code AS cc, c.label AS cl FROM x LEFT JOIN al ON al.n = x.normalized LEFT JOIN reg c ON c.code = upper(al.alias)),
      k AS (SELECT {normalized_sql('label')} AS lookup, count(*) AS n, min(code) AS code, min(label) AS label FROM reg GROUP BY 1)
    SELECT name, normalized, CASE WHEN found = 1 THEN coalesce(cc, code) ELSE '' END AS code, CASE WHEN found = 1 THEN coalesce(cl, label) ELSE '' END AS label,
           CASE WHEN cc IS NOT NULL THEN 'EXPLICIT_CODE_ALIAS' WHEN alias IS NOT NULL THEN 'EXPLICIT_NAME_ALIAS' ELSE 'NORMALIZED_EXACT' END AS method,
           CASE WHEN found = 1 THEN 'MAPPED' WHEN found = 0 THEN 'UNRESOLVED' ELSE 'AMBIGUOUS' END AS status
    FROM (SELECT j.*, k.code, k.label, CASE WHEN cc IS NOT NULL THEN 1 ELSE coalesce(k.n, 0) END AS found
          FROM j LEFT JOIN k ON k.lookup = CASE WHEN j.alias IS NOT NULL THEN {normalized_sql('j.alias')} ELSE j.normalized END)""")
def map_names_to_codes(spark, sf_dir):
    key = F.col("c_custkey")
    customer, supplier = table(spark, sf_dir, "customer"), table(spark, sf_dir, "supplier")
    names = customer.select(F.when(key % 10 < 2, F.concat(F.lit("Customer "), key)).otherwise(
        F.concat(F.lit("SUPPLIER  "), F.lpad((key % 150).cast("string"), 9, "0"))).alias("name"))
    registry = supplier.select(F.concat(F.lit("S"), "s_suppkey").alias("code"),
                               F.when(F.col("s_suppkey") % 10 == 0, "Sùpplier & Co").otherwise(F.col("s_name")).alias("label"))
    aliases = customer.filter(key % 10 == 0).select(
        F.concat(F.lit("CUSTOMER "), key).alias("name"), F.when(key % 20 == 0, F.concat(F.lit("s"), key % 90)).otherwise("supplier & cô").alias("alias"))
    return joins.map_names_to_codes(names, registry, aliases)


@query("complete_entities", """
    WITH c AS (SELECT l_partkey AS economy, l_returnflag || l_linestatus AS category FROM lineitem), h AS (SELECT economy, count(DISTINCT category) AS n FROM c GROUP BY 1)
    SELECT economy, n AS items, n >= 6 AS complete, CASE WHEN n >= 6 THEN (SELECT count(*) FROM c WHERE c.economy = h.economy) ELSE 0 END AS cells FROM h""")
def complete_entities(spark, sf_dir):
    cells = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("economy"), F.concat("l_returnflag", "l_linestatus").alias("category"))
    whole, excluded = joins.complete_entities(cells, 6)
    return whole.groupBy("economy").agg(F.count_distinct("category").alias("items"), F.lit(True).alias("complete"), F.count("*").alias("cells")).unionByName(
        excluded.select("economy", "items", F.lit(False).alias("complete"), F.lit(0).cast("long").alias("cells")))
