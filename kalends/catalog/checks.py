"""Contract checks over tables derived from the driver's data."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import query
from kalends.catalog.base import rnd, sql
from kalends.functions.months import shift_month
from kalends.functions.numbers import rnd as r
from kalends.operators import checks
from kalends.sources import tables
from kalends.sources.tables import table

_CATEGORY_LIST = "['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD']"


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY ALL HAVING count(*) > 1")
def duplicate_keys(spark, sf_dir):
    return checks.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@query("grid_violations", sql(f"""
    SELECT * FROM (SELECT coalesce(g.economy, o.economy) AS economy, coalesce(g.category, o.category) AS category,
           coalesce(g.period, o.period) AS period, CASE WHEN o.economy IS NULL THEN 'MISSING' WHEN g.economy IS NULL THEN 'EXTRA' END AS violation
    FROM (SELECT economy, category, strftime(m, '%Y-%m') AS period FROM (SELECT DISTINCT economy FROM obs),
            (SELECT unnest({_CATEGORY_LIST}) AS category),
            (SELECT unnest(generate_series(CAST(min(period) || '-01' AS DATE), CAST(max(period) || '-01' AS DATE), INTERVAL 1 MONTH)) AS m FROM obs)) g
    FULL OUTER JOIN obs o USING (economy, category, period)) WHERE violation IS NOT NULL""", "obs"))
def grid_violations(spark, sf_dir):
    obs = tables.observations(spark, sf_dir)
    bounds = obs.agg(F.min("period"), F.max("period")).first()
    expected = checks.expected_grid(obs, tables.CATEGORIES, tuple(bounds))
    return checks.grid_violations(obs, expected)


@query("weight_sum_violations", sql(f"""
    SELECT economy, {rnd('sum(weight)', 9)} AS weight_sum FROM rweights GROUP BY economy HAVING abs(sum(weight) - 1) > 1e-9""", "rweights"))
def weight_sum_violations(spark, sf_dir):
    weights = tables.weights_of(tables.observations(spark, sf_dir, by="region"))
    return checks.weight_sum_violations(weights, ["economy"]).withColumn("weight_sum", r(F.col("weight_sum"), 9))


@query("domain_violations", """
    SELECT l_orderkey, l_linenumber, violations, count(*) AS n FROM (
      SELECT l_orderkey, l_linenumber, concat_ws('|', CASE WHEN NOT l_quantity BETWEEN 2 AND 49 THEN 'quantity_bounds' END,
        CASE WHEN NOT (l_discount > 0 AND isfinite(l_discount)) THEN 'discount_positive' END,
        CASE WHEN l_tax >= l_discount + 0.05 THEN 'bounds_contain_central' END) AS violations FROM lineitem)
    WHERE violations <> '' GROUP BY ALL""")
def domain_violations(spark, sf_dir):
    rules = {
        "quantity_bounds": F.col("l_quantity").between(2, 49),
        "discount_positive": checks.finite_positive(F.col("l_discount")),
        "bounds_contain_central": F.col("l_tax") < F.col("l_discount") + 0.05,
        "month_valid": checks.valid_month(tables.month_of(F.col("l_shipdate"))),
    }
    found = checks.domain_violations(table(spark, sf_dir, "lineitem"), rules)
    return found.groupBy("l_orderkey", "l_linenumber", "violations").agg(F.count("*").alias("n"))


@query("attribute_drift", """
    WITH a AS (SELECT p_name, unnest([struct_pack(attribute := 'p_brand', lowest := min(p_brand), highest := max(p_brand)),
      struct_pack(attribute := 'p_size', lowest := CAST(min(p_size) AS VARCHAR), highest := CAST(max(p_size) AS VARCHAR)),
      struct_pack(attribute := 'p_type', lowest := min(p_type), highest := max(p_type))]) AS d FROM part GROUP BY p_name)
    SELECT p_name, d.attribute AS attribute, d.lowest AS lowest, d.highest AS highest FROM a WHERE d.lowest <> d.highest""")
def attribute_drift(spark, sf_dir):
    return checks.attribute_drift(table(spark, sf_dir, "part"), ["p_name"], ["p_brand", "p_size", "p_type"])


@query("universe_drift", sql("""
    SELECT o.period, count(*) AS cells, sum(CASE WHEN b.economy IS NOT NULL THEN 1 ELSE 0 END)::BIGINT AS matching,
           (SELECT count(*) FROM obs WHERE period = '1996-01') AS reference_cells
    FROM obs o LEFT JOIN obs b ON o.economy = b.economy AND o.category = b.category AND b.period = '1996-01'
    GROUP BY o.period HAVING cells <> reference_cells OR matching <> reference_cells""", "obs"))
def universe_drift(spark, sf_dir):
    obs = tables.observations(spark, sf_dir)
    return checks.universe_drift(obs.join(tables.weights_of(obs), ["economy", "category"]), "1996-01")


@query("index_identity", sql(f"""
    SELECT * FROM (SELECT period, {rnd('round(sum(weight * price_relative), 2)')} AS value, {rnd('sum(weight * price_relative)')} AS recomputed,
                  abs(round(sum(weight * price_relative), 2) - sum(weight * price_relative)) AS gap
    FROM rrel JOIN rweights USING (economy, category) GROUP BY period) WHERE gap > 0.002""", "rrel", "rweights").replace("SELECT * FROM (SELECT period", "SELECT period, value, recomputed FROM (SELECT period"))
def index_identity(spark, sf_dir):
    obs = tables.observations(spark, sf_dir, by="region")
    cells = tables.relatives_of(obs, "1996-01").join(tables.weights_of(obs), ["economy", "category"])
    published = cells.groupBy("period").agg(F.round(F.sum(F.col("weight") * F.col("price_relative")), 2).alias("value"))
    return checks.index_identity(cells, published, 0.002).select("period", r(F.col("value")).alias("value"), r(F.col("recomputed")).alias("recomputed"))


@query("weight_hierarchy_identity", sql(f"""
    SELECT c.economy, {rnd('p.economy_weight', 9)} AS economy_weight, {rnd('c.cell_sum', 9)} AS cell_sum
    FROM (SELECT economy, sum(weight) AS cell_sum FROM rweights GROUP BY 1) c
    JOIN (SELECT region AS economy, CAST(sum(amount) FILTER (WHERE flag <> 'R') AS DOUBLE) / (SELECT CAST(sum(amount) AS DOUBLE) FROM lines
          WHERE flag <> 'R') AS economy_weight FROM lines GROUP BY 1) p USING (economy)
    WHERE abs(cell_sum - economy_weight) > 1e-4""", "rweights"))
def weight_hierarchy_identity(spark, sf_dir):
    cells = tables.weights_of(tables.observations(spark, sf_dir, by="region"))
    kept = tables.weights_of(tables.observations(spark, sf_dir, by="region", first_vintage=True))
    parents = kept.groupBy("economy").agg(F.sum("weight").alias("economy_weight"))
    return checks.weight_hierarchy_identity(cells, parents, 1e-4).select(
        "economy", r(F.col("economy_weight"), 9).alias("economy_weight"), r(F.col("cell_sum"), 9).alias("cell_sum"))


@query("sample_mismatch", """
    SELECT l_orderkey AS case_id, count(DISTINCT l_returnflag) AS model_count FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) <> 3""")
def sample_mismatch(spark, sf_dir):
    cases = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("case_id"), F.col("l_returnflag").alias("model"))
    return checks.sample_mismatch(cases, 3)


@query("case_metadata_mismatch", """
    SELECT case_id, unnest(list_filter([CASE WHEN a THEN 'l_suppkey' END, CASE WHEN b THEN 'l_linestatus' END], lambda x: x IS NOT NULL)) AS field
    FROM (SELECT l_orderkey AS case_id, min(l_suppkey) <> max(l_suppkey) AS a, min(l_linestatus) <> max(l_linestatus) AS b FROM lineitem GROUP BY 1)""")
def case_metadata_mismatch(spark, sf_dir):
    cases = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "case_id")
    return checks.case_metadata_mismatch(cases, ["l_suppkey", "l_linestatus"])


@query("interval_overlaps", """
    WITH a AS (SELECT o_custkey AS economy, o_orderpriority AS currency, strftime(min(o_orderdate), '%Y-%m') AS effective_from,
                      CASE WHEN o_orderpriority = '1-URGENT' THEN '9999-12' ELSE strftime(max(o_orderdate), '%Y-%m') END AS until
               FROM orders GROUP BY 1, 2)
    SELECT b.economy, b.currency, b.effective_from, b.until, a.currency AS earlier_currency, a.effective_from AS earlier_from, a.until AS occupied_until
    FROM a JOIN a b ON a.economy = b.economy AND (a.effective_from, a.until, a.currency) < (b.effective_from, b.until, b.currency) AND a.until >= b.effective_from""")
def interval_overlaps(spark, sf_dir):
    month = tables.month_of(F.col("o_orderdate"))
    spans = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("economy"), F.col("o_orderpriority").alias("currency")).agg(
        F.min(month).alias("effective_from"), F.max(month).alias("effective_to"))
    return checks.interval_overlaps(spans.withColumn("effective_to", F.when(F.col("currency") != "1-URGENT", F.col("effective_to"))))


_SERIES_SQL = """
    SELECT 'S' || s_suppkey AS series_id, n_name AS economy, CASE WHEN s_suppkey % 3 = 0 THEN 'P1_OFFICIAL_CATEGORY'
           WHEN s_suppkey % 3 = 1 THEN 'P3_OFFICIAL_HEADLINE' ELSE 'P2_OFFICIAL_AGGREGATE' END AS evidence_class,
           CASE s_suppkey % 4 WHEN 0 THEN ['ECONOMY'] WHEN 1 THEN ['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD']
             WHEN 2 THEN ['LARGE','MEDIUM'] ELSE ['SMALL'] END AS target_categories,
           CASE s_suppkey % 10 WHEN 0 THEN [1] WHEN 1 THEN [2] WHEN 2 THEN [-2, 5] WHEN 3 THEN [] WHEN 4 THEN [1] WHEN 6 THEN [1, 2]
             WHEN 7 THEN [-1] WHEN 8 THEN [-2, -5] WHEN 9 THEN [1000000000] ELSE [] END AS hops, s_suppkey AS k
    FROM supplier JOIN nation ON s_nationkey = n_nationkey"""


def series_links(spark, sf_dir):
    """A registry with one series per supplier and fallbacks to near neighbours, some of them circular."""
    key = F.col("s_suppkey")
    texts = lambda *names: F.array(*[F.lit(n) for n in names])
    hops = {0: (1,), 1: (2,), 2: (-2, 5), 4: (1,), 6: (1, 2), 7: (-1,), 8: (-2, -5), 9: (1000000000,)}
    jump = F.array().cast("array<bigint>")
    for rest, steps in hops.items():
        jump = F.when(key % 10 == rest, F.array(*[F.lit(s).cast("bigint") for s in steps])).otherwise(jump)
    categories = (
        F.when(key % 4 == 0, texts("ECONOMY")).when(key % 4 == 1, texts(*tables.CATEGORIES))
        .when(key % 4 == 2, texts("LARGE", "MEDIUM")).otherwise(texts("SMALL"))
    )
    evidence = F.when(key % 3 == 0, "P1_OFFICIAL_CATEGORY").when(key % 3 == 1, "P3_OFFICIAL_HEADLINE").otherwise("P2_OFFICIAL_AGGREGATE")
    nation = table(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("economy"))
    return table(spark, sf_dir, "supplier").join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.concat(F.lit("S"), key).alias("series_id"), "economy", evidence.alias("evidence_class"), categories.alias("target_categories"),
        F.transform(jump, lambda h: F.concat(F.lit("S"), key + h)).alias("fallback_series"))


@query("registry_violations", f"""
    WITH d AS ({_SERIES_SQL}), x AS (SELECT *, unnest(hops) AS hop FROM d)
    SELECT * FROM (SELECT x.series_id, 'S' || (x.k + x.hop) AS fallback,
        CASE WHEN t.k IS NULL THEN 'UNKNOWN_FALLBACK' WHEN t.economy <> x.economy THEN 'CROSS_ECONOMY_FALLBACK'
             WHEN NOT list_has_any(t.target_categories, x.target_categories) THEN 'NO_OVERLAPPING_CATEGORY' END AS violation
      FROM x LEFT JOIN d t ON t.k = x.k + x.hop
      UNION ALL SELECT series_id, '', CASE WHEN k % 3 = 0 AND len(target_categories) <> 1 THEN 'P1_NEEDS_ONE_CATEGORY'
             WHEN k % 3 = 1 AND len(target_categories) <> 6 THEN 'P3_NEEDS_ALL_CATEGORIES' END FROM d) WHERE violation IS NOT NULL""")
def registry_violations(spark, sf_dir):
    return checks.registry_violations(series_links(spark, sf_dir), len(tables.CATEGORIES))


@query("fallback_cycles", f"""
    WITH RECURSIVE d AS ({_SERIES_SQL}), e AS (SELECT DISTINCT k AS a, k + unnest(hops) AS b FROM d),
      reach(a, b) AS (SELECT a, b FROM e UNION SELECT reach.a, e.b FROM reach JOIN e ON reach.b = e.a)
    SELECT 'S' || a AS series_id FROM reach WHERE a = b""")
def fallback_cycles(spark, sf_dir):
    return checks.fallback_cycles(series_links(spark, sf_dir))


_MAPPING_SQL = """
    SELECT p_brand AS source_code, CASE WHEN p_type = 'SMALL' THEN 'OTHER' ELSE p_type END AS category,
           CASE CAST(substr(p_brand, 7) AS INTEGER) % 3 WHEN 0 THEN 'EXACT_ONE_TO_ONE' WHEN 1 THEN 'EXACT_MERGE' ELSE 'PROPORTIONAL' END AS mapping_type,
           min(p_partkey) % 4 <> 0 AS strict_admissible, CASE WHEN max(p_partkey) % 5 = 0 THEN '2002-01' ELSE '1995-01' END AS effective_from,
           '2001-12' AS effective_to FROM part GROUP BY p_brand, p_type"""


@query("mapping_violations", f"""
    WITH m AS ({_MAPPING_SQL}), s AS (SELECT DISTINCT p_brand AS source_code FROM part), t AS (SELECT DISTINCT p_type AS category FROM part)
    SELECT source_code AS code, 'SOURCE_CODE_MISSING' AS violation FROM s WHERE source_code NOT IN (SELECT source_code FROM m)
    UNION ALL SELECT source_code, 'SOURCE_CODE_NOT_UNIQUE' FROM m GROUP BY 1 HAVING count(*) > 1
    UNION ALL SELECT category, 'TARGET_NOT_COVERED' FROM t WHERE category NOT IN (SELECT category FROM m)
    UNION ALL SELECT DISTINCT category, 'TARGET_UNKNOWN' FROM m WHERE category NOT IN (SELECT category FROM t)
    UNION ALL SELECT DISTINCT source_code, 'NON_EXACT_STRICT_MAPPING' FROM m WHERE strict_admissible AND mapping_type = 'PROPORTIONAL'
    UNION ALL SELECT DISTINCT source_code, 'NOT_ADMISSIBLE' FROM m WHERE NOT strict_admissible
    UNION ALL SELECT DISTINCT source_code, 'INVALID_INTERVAL' FROM m WHERE effective_from > effective_to""")
def mapping_violations(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    number = F.substring("p_brand", 7, 10).cast("int") % 3
    mapping = part.groupBy(F.col("p_brand").alias("source_code"), "p_type").agg(
        (F.min("p_partkey") % 4 != 0).alias("strict_admissible"),
        F.when(F.max("p_partkey") % 5 == 0, "2002-01").otherwise("1995-01").alias("effective_from"),
    ).select("source_code", F.when(F.col("p_type") == "SMALL", "OTHER").otherwise(F.col("p_type")).alias("category"),
             "strict_admissible", "effective_from", F.lit("2001-12").alias("effective_to"))
    number = F.substring("source_code", 7, 10).cast("int") % 3
    mapping = mapping.withColumn("mapping_type", F.when(number == 0, "EXACT_ONE_TO_ONE").when(number == 1, "EXACT_MERGE").otherwise("PROPORTIONAL"))
    return checks.mapping_violations(mapping, part.select(F.col("p_brand").alias("source_code")).distinct(), part.select(F.col("p_type").alias("category")).distinct())


@query("lookahead_violations", """
    SELECT * FROM (SELECT o_orderkey AS case_id, CASE WHEN strftime(o_orderdate + INTERVAL 3 MONTH, '%Y-%m') = last THEN 'TARGET_PERIOD_VALUE_USED'
        WHEN list_contains(used, strftime(o_orderdate + INTERVAL 3 MONTH, '%Y-%m')) THEN 'TARGET_PERIOD_VALUE_USED'
        WHEN last > strftime(o_orderdate, '%Y-%m') THEN 'FUTURE_SOURCE_PERIOD_USED' END AS violation
      FROM orders JOIN (SELECT l_orderkey, max(strftime(l_shipdate, '%Y-%m')) AS last, list(strftime(l_shipdate, '%Y-%m')) AS used
                        FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey) WHERE violation IS NOT NULL""")
def lookahead_violations(spark, sf_dir):
    used = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.collect_set(tables.month_of(F.col("l_shipdate"))).alias("source_periods"))
    origin = tables.month_of(F.col("o_orderdate"))
    cases = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("case_id"), origin.alias("origin"), shift_month(origin, 3).alias("target"))
    return checks.lookahead_violations(cases.join(used, F.col("case_id") == F.col("l_orderkey"))).select("case_id", "violation")


@query("release_calendar_violations", """
    WITH c AS (SELECT strftime(o_orderdate, '%Y-%m') AS period, CAST(max(o_orderdate) AS DATE) + CAST(count(*) % 37 AS INTEGER) AS release_date
               FROM orders GROUP BY 1),
      x AS (SELECT *, date_diff('day', last_day(CAST(period || '-01' AS DATE)), release_date) AS lag_days, lag(release_date) OVER (ORDER BY period) AS prev FROM c),
      s AS (SELECT strftime(unnest(generate_series(CAST(min(period) || '-01' AS DATE), CAST(max(period) || '-01' AS DATE), INTERVAL 1 MONTH)), '%Y-%m') AS period FROM c)
    SELECT period, 'RELEASE_LAG_OUTSIDE_POLICY' AS violation FROM x WHERE NOT lag_days BETWEEN 5 AND 25
    UNION ALL SELECT period, 'RELEASE_DATE_NOT_INCREASING' FROM x WHERE release_date <= prev
    UNION ALL SELECT period, 'RELEASE_PERIOD_MISSING' FROM s WHERE period NOT IN (SELECT period FROM c)""")
def release_calendar_violations(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    calendar = orders.groupBy(tables.month_of(F.col("o_orderdate")).alias("period")).agg(
        F.date_add(F.to_date(F.max("o_orderdate")), (F.count("*") % 37).cast("int")).alias("release_date"))
    return checks.release_calendar_violations(calendar, 5, 25)


@query("gate_row_violations", """
    WITH g AS (SELECT source AS entity, lang AS criterion, CASE WHEN sum(toxic) > 1 THEN 'CONTRADICTED' WHEN sum(toxic) = 1 THEN 'PENDING'
                      WHEN count(quality) > 3 THEN 'CONFIRMED' ELSE 'UNKNOWN' END AS status
               FROM documents d LEFT JOIN labels USING (doc_id) GROUP BY 1, 2)
    SELECT entity, 'MISSING_CRITERION' AS violation, criterion AS detail FROM (SELECT DISTINCT entity FROM g), (SELECT unnest(['en','fr','de','es']) AS criterion)
      WHERE (entity, criterion) NOT IN (SELECT (entity, criterion) FROM g)
    UNION ALL SELECT DISTINCT entity, 'INVALID_STATUS', status FROM g WHERE status = 'PENDING'
    UNION ALL SELECT entity, 'UNSUPPORTED_REJECTION', 'en' FROM g GROUP BY entity
      HAVING bool_or(criterion = 'en' AND status = 'CONTRADICTED') AND NOT bool_or(criterion <> 'en' AND status = 'CONTRADICTED')""")
def gate_row_violations(spark, sf_dir):
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang").join(table(spark, sf_dir, "labels"), "doc_id", "left")
    toxic = F.sum("toxic")
    gates = docs.groupBy(F.col("source").alias("entity"), F.col("lang").alias("criterion")).agg(
        F.when(toxic > 1, "CONTRADICTED").when(toxic == 1, "PENDING").when(F.count("quality") > 3, "CONFIRMED").otherwise("UNKNOWN").alias("status"))
    return checks.gate_row_violations(gates, ("en", "fr", "de", "es"), ("CONFIRMED", "CONTRADICTED", "UNKNOWN"), "en")


@query("mixed_provider_admissibility", """
    WITH r AS (SELECT p_name AS economy, p_partkey AS row_id, p_type || (p_size % 7) AS category, CASE WHEN p_size = 50 THEN 'S13' ELSE 'S14' END AS sector,
        CASE WHEN p_size = 49 THEN 'P3' ELSE 'P31DC' END AS transaction, CASE WHEN p_size = 48 THEN 'PROXY' ELSE 'EXACT_OFFICIAL' END AS data_class,
        CASE WHEN p_size = 47 THEN 'A|B' END AS bad_flags, CASE WHEN p_size = 46 THEN '' ELSE p_brand END AS source_url,
        CASE WHEN p_partkey % 211 = 0 THEN 'USD' ELSE 'EUR' END AS currency, p_size FROM part),
      f AS (SELECT *, row_number() OVER (PARTITION BY economy, category ORDER BY row_id) AS rn FROM r),
      x AS (SELECT *, CASE WHEN rn > 1 THEN 'DUPLICATE_CATEGORY:' || category WHEN sector <> 'S14' THEN 'INCOMPATIBLE_SECTOR'
        WHEN transaction <> 'P31DC' THEN 'INCOMPATIBLE_TRANSACTION' WHEN data_class = 'PROXY' THEN 'INCOMPATIBLE_DATA_CLASS'
        WHEN p_size = 47 THEN 'MISSING_QUALITY_FLAGS:GOVERNMENT_EXCLUDED|NPISH_EXCLUDED' WHEN source_url = '' THEN 'MISSING_PROVENANCE:source_url' END AS why FROM f),
      v AS (SELECT economy, arg_min(why, row_id) FILTER (WHERE why IS NOT NULL) AS why, count(DISTINCT currency) AS currencies FROM x GROUP BY 1)
    SELECT economy, why IS NULL AND currencies = 1 AS admissible, coalesce(why, CASE WHEN currencies > 1 THEN 'INCOMPATIBLE_CURRENCY' ELSE 'PASS' END) AS reason FROM v""")
def mixed_provider_admissibility(spark, sf_dir):
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_name").alias("economy"), F.col("p_partkey").alias("row_id"), F.concat("p_type", (size % 7).cast("string")).alias("category"),
        F.when(size == 50, "S13").otherwise("S14").alias("sector"), F.when(size == 49, "P3").otherwise("P31DC").alias("transaction"),
        F.when(size == 48, "PROXY").otherwise("EXACT_OFFICIAL").alias("data_class"),
        F.when(size == 47, "CURRENT_PRICES|NO_ALLOCATION").otherwise("CURRENT_PRICES|NPISH_EXCLUDED|GOVERNMENT_EXCLUDED|NO_ALLOCATION").alias("quality_flags"),
        F.lit("office").alias("source_authority"), F.col("p_brand").alias("source_file"),
        F.when(size == 46, "").otherwise(F.col("p_brand")).alias("source_url"), F.md5("p_brand").alias("source_hash"),
        F.lit("2021").alias("reference_period"), F.when(F.col("p_partkey") % 211 == 0, "USD").otherwise("EUR").alias("currency"), F.lit("1").alias("unit"))
    return checks.mixed_provider_admissibility(rows)
