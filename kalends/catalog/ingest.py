"""Ingest cores: driver rows are packed into the raw form inside the plan and unpacked by the library."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.backtest import rounded
from kalends.catalog.base import rnd, sql
from kalends.catalog.joins import BRIDGE_SQL, bridge, fx_rates
from kalends.catalog.weights import DIRECT, PROXY, icp, icp_long, nominal, registry
from kalends.functions.months import months_between
from kalends.functions.numbers import rnd as r
from kalends.session import cut, shared_folder
from kalends.sources import ingest, tables
from kalends.sources.tables import MONEY, table


@query("read_weights", sql(f"SELECT upper(economy) AS economy, canonical AS category, {rnd('sum(weight)', 9)} AS weight FROM weights JOIN {BRIDGE_SQL} ON category = b.source_category GROUP BY 1, 2", "weights"))
def read_weights(spark, sf_dir):
    raw = tables.weights_of(cut(tables.observations(spark, sf_dir))).select(
        F.concat(F.lit(" "), F.lower("economy")).alias("economy_code"), F.concat(F.lower("category"), F.lit(" ")).alias("category_code"), F.col("weight").cast("string").alias("world_weight"))
    return rounded(ingest.parse_weights(raw, bridge(spark)), weight=9)


@query("read_price_observations", sql(f"""
    SELECT economy, CASE WHEN period LIKE '%-03' THEN 'HEADLINE' WHEN period LIKE '%-04' THEN 'UNKNOWN' ELSE category END AS category, period, unit_price AS price_relative,
      CASE length(category) WHEN 5 THEN 'P1_OFFICIAL_CATEGORY' WHEN 6 THEN 'P2_OFFICIAL_COMPATIBLE_AGGREGATE' WHEN 7 THEN 'P3_OFFICIAL_HEADLINE' END AS evidence_class, CASE WHEN period LIKE '%-05' THEN '' ELSE economy || '|z' END AS source_ids,
      CASE WHEN length(category) > 7 THEN 'UNSUPPORTED_EVIDENCE_CLASS' WHEN period LIKE '%-03' AND length(category) <> 7 THEN 'HEADLINE_CLASS_REQUIRED' WHEN period LIKE '%-04' THEN 'UNKNOWN_CATEGORY' WHEN period NOT LIKE '%-03' AND length(category) = 7 THEN 'CATEGORY_MUST_BE_DIRECT'
           WHEN period LIKE '%-05' THEN 'SOURCE_REQUIRED' ELSE '' END AS violation FROM obs""", "obs"))
def read_price_observations(spark, sf_dir):
    month, size = F.substring("period", 6, 2), F.length("category")
    raw = tables.observations(spark, sf_dir).select(
        F.lower("economy").alias("economy_code"), F.when(month == "03", "headline").when(month == "04", "unknown").otherwise(F.lower("category")).alias("category_code"), "period",
        F.col("unit_price").cast("string").alias("price_index"), F.when(size == 5, "p1_direct").when(size == 6, "P2_agg").when(size == 7, "p3_top").otherwise("P4_other").alias("price_evidence_class"),
        F.when(month == "05", " | ").otherwise(F.concat(F.lit("z| "), F.col("economy"), F.lit("|z"))).alias("series_id"))
    return ingest.parse_price_observations(raw, tables.CATEGORIES)


@query("read_profiles", sql(f"""
    SELECT economy, region, income_group, array_to_string(characteristics, '|') AS characteristics, {rnd('mean_balance', 5)} AS mean_balance, CASE WHEN economy LIKE '%3' THEN NULL ELSE {rnd('mean_order', 5)} END AS mean_order,
           CASE WHEN economy LIKE '%3' THEN 1 ELSE 2 END AS covariate_count FROM profiles""", "profiles"))
def read_profiles(spark, sf_dir):
    raw = tables.profiles(spark, sf_dir).select(
        F.lower("economy").alias("economy_code"), F.lower("region").alias("region"), "income_group", F.array_join("characteristics", " | ").alias("characteristics"),
        F.col("covariates")["mean_balance"].cast("string").alias("mean_balance"), F.when(F.col("economy").endswith("3"), " ").otherwise(F.col("covariates")["mean_order"].cast("string")).alias("mean_order"))
    rows = ingest.parse_profiles(raw)
    return rows.select("economy", "region", "income_group", F.array_join("characteristics", "|").alias("characteristics"), F.round(F.col("covariates")["mean_balance"], 5).alias("mean_balance"),
                       F.round(F.col("covariates")["mean_order"], 5).alias("mean_order"), F.size("covariates").alias("covariate_count"))


# Requested currencies; some have no rates at all.
CURRENCIES = tuple(f"C{i:02d}" for i in range(30))
base.add("fxkept", """
    SELECT currency, period, rate FROM fx WHERE rate > 0 AND CAST(substr(currency, 2) AS INTEGER) % 5 <> 4 AND period NOT LIKE '%-02' AND NOT (currency = 'C03' AND period LIKE '1997%')""", "fx")


def fx_raw(spark, sf_dir):
    number = F.substring("currency", 2, 2).cast("int")
    return fx_rates(spark, sf_dir).select(
        F.concat_ws(".", F.lit("M"), "currency", F.lit("EUR.SP00.A")).alias("KEY"), F.when(F.col("period").endswith("-02"), "D").otherwise("M").alias("FREQ"), F.lower("currency").alias("CURRENCY"),
        F.when(number % 5 == 4, "USD").otherwise("eur").alias("CURRENCY DENOM"), F.lit("SP00").alias("EXR_TYPE"),
        F.when((F.col("currency") == "C03") & F.col("period").startswith("1997"), "E").otherwise("A").alias("EXR_SUFFIX"), F.concat("period", F.lit("-15")).alias("TIME_PERIOD"), F.col("rate").cast("string").alias("OBS_VALUE"))


@query("ingest_fx_rates", sql(f"SELECT currency, period, {rnd('rate', 8)} AS rate FROM fxkept", "fxkept"))
def ingest_fx_rates(spark, sf_dir):
    return rounded(ingest.parse_fx_rates(fx_raw(spark, sf_dir), CURRENCIES)[0], rate=8)


@query("missing_fx_currencies", sql(f"SELECT currency FROM (VALUES {', '.join(f'({c!r})' for c in CURRENCIES)}) v(currency) WHERE currency NOT IN (SELECT currency FROM fxkept)", "fxkept"))
def missing_fx_currencies(spark, sf_dir):
    return ingest.parse_fx_rates(fx_raw(spark, sf_dir), CURRENCIES)[1]


@query("flatten_cube", sql(f"""
    SELECT economy, category, period, unit_price AS value, CASE WHEN ((list_position({list(tables.CATEGORIES)!r}, category) - 1) * (date_diff('month', lo, hi) + 1)
           + date_diff('month', lo, CAST(period || '-01' AS DATE))) % 7 = 0 THEN 'p' ELSE '' END AS status
    FROM obs, (SELECT CAST(min(period) || '-01' AS DATE) AS lo, CAST(max(period) || '-01' AS DATE) AS hi FROM obs) WHERE category <> 'PROMO'""", "obs"))
def flatten_cube(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir))
    bounds = obs.agg(F.struct(F.min("period").alias("lo"), F.max("period").alias("hi"))).scalar()
    spine = months_between(F.col("b.lo"), F.col("b.hi"))
    codes = F.array(*[F.lit(c) for c in tables.CATEGORIES])
    at = (F.array_position(codes, F.col("category")) - 1) * F.size("months") + F.array_position("months", F.col("period")) - 1
    placed = obs.withColumn("b", bounds).withColumn("months", spine).withColumn("at", at.cast("long"))
    packed = placed.groupBy("economy", "months").agg(F.map_from_entries(F.collect_list(F.struct(F.col("at"), F.col("unit_price")))).alias("points"))
    size = F.size("months") * len(tables.CATEGORIES)
    listed = F.to_json(F.transform(F.sequence(F.lit(0), size - 1), lambda i: F.col("points")[i.cast("long")]))
    index = F.to_json(F.map_from_entries(F.transform(codes, lambda c, i: F.struct(c, i))))
    odd = F.length("economy") % 2 == 1
    places = F.sequence(F.lit(0), size - 1)
    flagged = F.to_json(F.map_from_entries(F.transform(F.filter(places, lambda i: i % 7 == 0), lambda i: F.struct(i, F.lit("p")))))
    body = F.concat(
        F.lit('{"id":["category","time"],"size":['), F.lit(len(tables.CATEGORIES)), F.lit(","), F.size("months").cast("string"), F.lit(']'), F.lit(',"dimension":{"category":{"category":{"index":'),
        F.when(odd, index).otherwise(F.to_json(codes)), F.lit('}},"time":{"category":{"index":'), F.to_json("months"), F.lit('}}},"value":'), F.when(odd, F.to_json("points")).otherwise(listed),
        F.lit(',"status":'), F.when(odd, flagged).otherwise(F.to_json(F.transform(places, lambda i: F.when(i % 7 == 0, "p").otherwise("")))), F.lit("}"))
    cubes = packed.select("economy", body.alias("body"))
    rows = ingest.flatten_cube(cubes, ("category", "time"), keep={"category": [c for c in tables.CATEGORIES if c != "PROMO"]})
    return rows.withColumnRenamed("time", "period")


@query("discover_dimension_code", """
    SELECT p_brand AS dimension, n AS candidates, CASE WHEN n = 1 THEN code END AS code, CASE WHEN n = 1 THEN 'FOUND' WHEN n = 0 THEN 'MISSING' ELSE 'AMBIGUOUS' END AS status
    FROM (SELECT p_brand, count(*) FILTER (WHERE p_name LIKE '%red%widget%' AND p_type = 'PROMO') AS n, min(CASE WHEN p_name LIKE '%red%widget%' AND p_type = 'PROMO' THEN 'P' || p_partkey END) AS code FROM part GROUP BY 1)""")
def discover_dimension_code(spark, sf_dir):
    labels = table(spark, sf_dir, "part").select(F.col("p_brand").alias("dimension"), F.concat(F.lit("P"), "p_partkey").alias("code"), F.concat_ws(" ", "p_name", "p_type").alias("label"))
    return ingest.discover_dimension_code(labels, ("Red Widget", "PROMO"))


@query("discover_roles", """
    SELECT role, CASE WHEN n = 1 THEN d END AS dimension, n AS candidates FROM (VALUES ('country', 'REF', 1), ('heading', 'HEADING', 1), ('time', 'Time', 1), ('measure', 'PRIORITY', (SELECT CASE WHEN count(*) > 0 THEN 1 ELSE 0 END FROM orders))) v(role, d, n)""")
def discover_roles(spark, sf_dir):
    letters = F.translate(F.lpad((F.col("c_custkey") % 1000).cast("string"), 3, "0"), "0123456789", "ABCDEFGHIJ")
    row = lambda df, name, code, label: df.select(F.lit(name).alias("dimension"), code.alias("code"), label.alias("label")).distinct()
    part, orders, customer = (table(spark, sf_dir, n) for n in ("part", "orders", "customer"))
    year = F.date_format("o_orderdate", "yyyy")
    inventory = row(customer, "REF", letters, F.lit("economy")).unionByName(row(part, "HEADING", F.col("p_brand"), F.col("p_brand"))).unionByName(
        row(orders, "Time", F.concat(F.lit("YR"), year), year)).unionByName(row(orders, "PRIORITY", F.col("o_orderpriority"), F.col("o_orderpriority")))
    headings = part.filter("p_size > 10").select(F.col("p_brand").alias("code")).distinct()
    return ingest.discover_roles(inventory, headings, 1998)


@query("flatten_observation_pages", sql(f"SELECT economy, heading, {rnd('nominal', 2)} AS value, 3 AS concepts, 64 AS hash_size FROM icp WHERE heading <> 'Brand#7' AND nominal IS NOT NULL", "icp"))
def flatten_observation_pages(spark, sf_dir):
    variable = lambda concept, value: F.struct(F.lit(concept).alias("concept"), value.alias("id"), F.lower(value).alias("value"))
    value = F.when(F.col("heading") != "Brand#7", F.col("nominal"))
    point = F.struct(value.alias("value"), F.array(variable("Country", F.col("economy")), variable("Heading", F.col("heading")), variable("Time", F.lit("YR1996"))).alias("variable"))
    pages = icp(spark, sf_dir).withColumn("page", F.substring("heading", -1, 1)).groupBy("page").agg(F.collect_list(point).alias("data"))
    body = F.to_json(F.struct(F.array(F.struct(F.col("data"))).alias("source")), {"ignoreNullFields": "false"})
    rows = ingest.flatten_observation_pages(pages.select("page", body.alias("body")))
    return rows.select(F.col("variables")["Country"]["id"].alias("economy"), F.col("variables")["Heading"]["id"].alias("heading"), F.round("value", 2).alias("value"),
                       F.size("variables").alias("concepts"), F.length("source_hash").alias("hash_size"))


@query("classify_nominal_rows", f"""
    SELECT p_partkey, {rnd('CASE WHEN p_size % 9 = 8 THEN NULL WHEN p_partkey % 37 = 0 THEN -p_retailprice ELSE p_retailprice END * 10.0 ** CAST(p_size % 4 AS INTEGER)', 2)} AS value,
      CASE WHEN p_partkey % 11 = 0 THEN 'REFERENCE_YEAR_NOT_2021' WHEN p_partkey % 13 = 0 THEN 'FREQUENCY_NOT_ANNUAL' WHEN p_partkey % 17 = 0 THEN 'SECTOR_NOT_HOUSEHOLDS_S14' WHEN p_partkey % 19 = 0 THEN 'TRANSACTION_NOT_DOMESTIC_HFCE_P31DC'
        WHEN p_partkey % 23 = 0 THEN 'UNIT_NOT_NATIONAL_CURRENCY' WHEN p_partkey % 29 = 0 THEN 'NOT_CURRENT_PRICES' WHEN p_type IN ('LARGE') THEN 'NOT_REQUIRED_PROXY_CATEGORY' WHEN p_partkey % 31 >= 25 THEN 'ECONOMY_NOT_MAPPED'
        WHEN p_size % 9 = 8 THEN 'INVALID_OBSERVATION_VALUE' WHEN p_partkey % 37 = 0 THEN 'NEGATIVE_NOMINAL_EXPENDITURE' ELSE '' END AS reason FROM part""")
def classify_nominal_rows(spark, sf_dir):
    k, size = F.col("p_partkey"), F.col("p_size")
    odd = lambda n, bad, good: F.when(k % n == 0, bad).otherwise(good)
    raw = table(spark, sf_dir, "part").select(
        "p_partkey", odd(11, "2020", "2021").alias("TIME_PERIOD"), odd(13, "Q", "A").alias("FREQ"), odd(17, "S1", "").alias("SECTOR"), odd(19, "P3", "P31DC").alias("TRANSACTION"), odd(23, "USD", "XDC").alias("UNIT_MEASURE"),
        odd(29, "L", "V").alias("PRICE_BASE"), F.lower("p_type").alias("EXPENDITURE"), F.concat(F.lit("A"), k % 31).alias("REF_AREA"),
        F.when(size % 9 == 8, "n/a").otherwise(F.when(k % 37 == 0, -F.col("p_retailprice")).otherwise(F.col("p_retailprice")).cast("string")).alias("OBS_VALUE"), (size % 4).cast("string").alias("UNIT_MULT"))
    mapping = bridge(spark).filter("source_category <> 'LARGE'").select(F.col("source_category").alias("expenditure"), F.col("canonical").alias("category"))
    economies = table(spark, sf_dir, "nation").select(F.concat(F.lit("A"), "n_nationkey").alias("ref_area_code"), F.col("n_name").alias("economy"))
    return rounded(ingest.classify_nominal_rows(raw, mapping, economies), value=2).select("p_partkey", "value", "reason")


@query("dedupe_ranked_rows", """
    SELECT economy, category, rank, CASE WHEN lo = hi THEN lo END AS value, CASE WHEN lo = hi THEN '' ELSE 'CONFLICTING_DUPLICATE_VALUES' END AS reason
    FROM (SELECT economy, category, rank, min(value) AS lo, max(value) AS hi, max(rank) OVER (PARTITION BY economy, category) AS best
      FROM (SELECT l_suppkey AS economy, l_partkey % 97 AS category, l_quantity AS value, CASE WHEN l_linenumber % 3 = 0 THEN 2 WHEN l_linenumber % 3 = 1 THEN 1 ELSE 0 END + CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS rank FROM lineitem) GROUP BY 1, 2, 3)
    WHERE rank = best""")
def dedupe_ranked_rows(spark, sf_dir):
    n = F.col("l_linenumber") % 3
    rows = table(spark, sf_dir, "lineitem").select(
        F.col("l_suppkey").alias("economy"), (F.col("l_partkey") % 97).alias("category"), F.col("l_quantity").alias("value"), F.when(n == 0, "SNA 2008").when(n == 1, "1993 SNA").otherwise("1968").alias("sna_system"),
        F.when(F.col("l_returnflag") == "A", "Western  calendar-year").otherwise("Fiscal year").alias("fiscal_type"))
    return ingest.dedupe_ranked_rows(rows)


@query("bridge_components", f"""
    SELECT economy, canonical AS category, CASE WHEN present = required AND most = 1 THEN v END AS value, CASE WHEN present <> required THEN 'INCOMPLETE_BRIDGE' WHEN most > 1 THEN 'AMBIGUOUS_COMPONENT' ELSE '' END AS reason, present, required
    FROM (SELECT economy, canonical, string_agg(component, '|' ORDER BY component) AS present, max(n) AS most, CAST(sum(v) AS DOUBLE) AS v FROM (SELECT l_orderkey AS economy, p_type AS component, b.canonical, count(*) AS n, sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS v
            FROM lineitem JOIN part ON l_partkey = p_partkey JOIN {BRIDGE_SQL} ON p_type = b.source_category GROUP BY 1, 2, 3) GROUP BY 1, 2)
    JOIN (SELECT canonical, string_agg(source_category, '|' ORDER BY source_category) AS required FROM {BRIDGE_SQL} GROUP BY 1) USING (canonical)""")
def bridge_components(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("component"))
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.join(part, F.col("l_partkey") == F.col("p_partkey")).select(F.col("l_orderkey").alias("economy"), "component", F.col("l_extendedprice").cast(MONEY).alias("value"))
    found = ingest.bridge_components(rows, bridge(spark).select(F.col("source_category").alias("component"), F.col("canonical").alias("category")), lines.count())
    return found.withColumn("value", F.col("value").cast("double"))


@query("check_structure_conformance", """
    WITH d AS (SELECT p_partkey, 'P' || p_partkey AS series_id, p_brand AS geo, p_type AS coicop FROM part), s AS (SELECT DISTINCT p_brand AS geo FROM part WHERE p_size = 3), t AS (SELECT DISTINCT p_type AS coicop FROM part WHERE p_size = 1 AND p_partkey % 7 = 0)
    SELECT series_id, 'geo' AS dimension, geo AS code, 'CODE_NOT_ALLOWED' AS violation FROM d WHERE geo NOT IN (SELECT geo FROM s) AND EXISTS (SELECT 1 FROM s)
    UNION ALL SELECT series_id, 'coicop', coicop, 'CODE_NOT_ALLOWED' FROM d WHERE coicop NOT IN (SELECT coicop FROM t) AND EXISTS (SELECT 1 FROM t)
    UNION ALL SELECT series_id, 'freq', 'M', 'RAW_KEY_MISMATCH' FROM d WHERE p_partkey % 50 = 0
    UNION ALL SELECT series_id, 'geo', geo, 'RAW_KEY_MISMATCH' FROM d WHERE p_partkey % 60 = 0""")
def check_structure_conformance(spark, sf_dir):
    part = table(spark, sf_dir, "part")
    series = F.concat(F.lit("P"), "p_partkey")
    definitions = part.select(series.alias("series_id"), F.create_map(F.lit("freq"), F.lit("M"), F.lit("geo"), F.col("p_brand"), F.lit("coicop"), F.col("p_type")).alias("key"))
    allowed = lambda name, col, rows: rows.groupBy(F.lit(name).alias("dimension")).agg(F.collect_set(col).alias("allowed"))
    structure = allowed("geo", "p_brand", part.filter("p_size = 3")).unionByName(allowed("coicop", "p_type", part.filter("p_size = 1 and p_partkey % 7 = 0")))
    raw = part.select(series.alias("series_id"), "p_partkey", F.explode(F.create_map(F.lit("freq"), F.lit("M"), F.lit("geo"), F.col("p_brand"), F.lit("coicop"), F.col("p_type"))).alias("dimension", "actual"))
    unnamed = (F.col("dimension") == "freq") & (F.col("p_partkey") % 50 == 0)
    elsewhere = (F.col("dimension") == "geo") & (F.col("p_partkey") % 60 == 0)
    raw = raw.withColumn("actual", F.when(elsewhere, "elsewhere").when(~unnamed, F.col("actual"))).drop("p_partkey")
    return ingest.check_structure_conformance(definitions, structure, raw)


@query("series_health", """
    SELECT p_partkey AS series_id, CASE WHEN p_size = 7 THEN 404 ELSE 200 END AS http_status, coalesce(n, 0) AS observation_count, CASE WHEN p_size <> 7 AND coalesce(n, 0) > 0 THEN 'OK' ELSE 'FAILED' END AS status
    FROM part LEFT JOIN (SELECT l_partkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_partkey = p_partkey""")
def series_health(spark, sf_dir):
    receipts = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("series_id"), F.when(F.col("p_size") == 7, 404).otherwise(200).alias("http_status"))
    obs = table(spark, sf_dir, "lineitem").select(F.col("l_partkey").alias("series_id"))
    return ingest.series_health(receipts, obs)


@query("audit_file_hashes", """
    WITH h AS (SELECT 'page-' || page_id AS name, sha256(coalesce(html, '')) AS actual, page_id AS k FROM pages),
      m AS (SELECT name, CASE WHEN k % 7 = 0 THEN repeat('0', 64) WHEN k % 3 = 0 THEN upper(actual) ELSE actual END AS expected FROM h WHERE k % 5 <> 4
            UNION ALL SELECT name, actual FROM h WHERE k % 11 = 0 UNION ALL SELECT 'gone-' || k, actual FROM h WHERE k % 13 = 0 UNION ALL SELECT '../' || name, actual FROM h WHERE k % 17 = 0),
      e AS (SELECT name, count(*) AS entries, min(expected) AS expected FROM m GROUP BY 1)
    SELECT coalesce(e.name, h.name) AS name, CASE WHEN e.name LIKE '%/%' THEN 'UNSAFE_PATH' WHEN entries > 1 THEN 'DUPLICATE' WHEN entries IS NULL THEN 'UNLISTED'
           WHEN actual IS NULL THEN 'MISSING' WHEN lower(expected) <> actual THEN 'MISMATCH' ELSE 'OK' END AS status FROM e FULL OUTER JOIN h ON e.name = h.name""")
def audit_file_hashes(spark, sf_dir):
    """Pages as the files of a bundle, against a manifest with wrong, missing, repeated and unsafe entries."""
    key = F.col("page_id")
    hashes = table(spark, sf_dir, "pages").select(
        F.concat(F.lit("page-"), key).alias("name"), F.sha2(F.coalesce("html", F.lit("")).cast("binary"), 256).alias("actual"), key)
    stated = F.when(key % 7 == 0, "0" * 64).when(key % 3 == 0, F.upper("actual")).otherwise(F.col("actual"))
    entries = F.array_compact(F.array(
        F.when(key % 5 != 4, F.struct("name", stated.alias("expected"))), F.when(key % 11 == 0, F.struct("name", F.col("actual").alias("expected"))),
        F.when(key % 13 == 0, F.struct(F.concat(F.lit("gone-"), key).alias("name"), F.col("actual").alias("expected"))),
        F.when(key % 17 == 0, F.struct(F.concat(F.lit("../"), F.col("name")).alias("name"), F.col("actual").alias("expected")))))
    manifest = hashes.select(F.explode(entries).alias("e")).select("e.*")
    return ingest.audit_file_hashes(hashes.drop("page_id"), manifest)


@query("audit_bundle_files")
def audit_bundle_files(spark, sf_dir):
    """The tables' own files against a manifest of their hashes; file bytes are out of SQL's reach."""
    hashes = cut(ingest.file_hashes(spark, sf_dir, "*.parquet"))
    good = hashes.select("name", F.when(F.col("name").startswith("n"), F.lit("0" * 64)).otherwise(F.col("actual")).alias("expected")).filter("name not like 'c%'")
    extra = hashes.groupBy().agg(F.count("*").alias("n")).select(F.explode(F.array(F.lit("gone.parquet"), F.lit("../region.parquet"), F.lit("part.parquet"))).alias("name"), F.lit("1" * 64).alias("expected"))
    return ingest.audit_file_hashes(hashes, good.unionByName(extra))


@query("write_tables", sql(f"SELECT economy, category, period, unit_price, {rnd('weight', 9)} AS weight FROM obs JOIN weights USING (economy, category)", "obs", "weights"))
def write_tables(spark, sf_dir):
    folder = f"{shared_folder(spark)}/tables-{uuid.uuid4().hex}"
    obs = cut(tables.observations(spark, sf_dir))
    ingest.write_tables({
        "weights": (tables.weights_of(obs), ("economy", "category", "weight"), ("economy", "category")),
        "prices": (obs, ("economy", "category", "period", "unit_price"), ("economy", "category", "period"))}, folder)
    read = spark.read.parquet(f"{folder}/prices").join(spark.read.parquet(f"{folder}/weights"), ["economy", "category"])
    return read.withColumn("weight", r(F.col("weight"), 9))


_HEADING_ROWS = [(h, c) for c, hs in DIRECT.items() for h in hs] + [(h, c) for c, h in PROXY.items()]
_HEADINGS_SQL = "(VALUES " + ", ".join(f"('{h}', '{c}')" for h, c in _HEADING_ROWS) + ") h(heading, category)"


@query("unify_normalized_rows", sql(f"""
    SELECT x.economy, x.heading, x.category, x.measure, {rnd('x.value', 2)} AS value, x.basis, coalesce(s.status, 'UNAVAILABLE_OR_NONPUBLISHED') AS status FROM (
      SELECT i.economy, i.heading, coalesce(h.category, '') AS category, CASE i.measure WHEN 'M1' THEN 'PPP' WHEN 'M2' THEN 'NOMINAL' WHEN 'M3' THEN 'REAL' ELSE i.measure END AS measure, i.value,
             CASE i.measure WHEN 'M1' THEN 'LCU_PER_INTERNATIONAL_DOLLAR' WHEN 'M2' THEN 'LOCAL_CURRENCY_UNITS_REPORTED_SCALE' WHEN 'M3' THEN 'PPP_BASED_INTERNATIONAL_DOLLARS_REPORTED_SCALE' ELSE 'PUBLISHED_MEASURE' END AS basis
      FROM ilong i LEFT JOIN {_HEADINGS_SQL} ON h.heading = i.heading
      UNION ALL SELECT economy, source_id || ':' || category, category, 'NOMINAL_HFCE_STRICT', value, 'CURRENT_PRICE_DOMESTIC_HOUSEHOLD_EXPENDITURE_LCU' FROM nominal) x
    LEFT JOIN (SELECT n_name AS economy, 'PARTICIPATING' AS status FROM nation WHERE n_nationkey % 7 <> 6) s ON s.economy = x.economy WHERE x.value IS NOT NULL""", "ilong", "nominal"))
def unify_normalized_rows(spark, sf_dir):
    measure = F.col("measure")
    rows = icp_long(spark, sf_dir).withColumn("measure", F.when(measure == "M1", "PPP").when(measure == "M2", "NOMINAL").when(measure == "M3", "REAL").otherwise(measure))
    status = registry(spark, sf_dir).filter("participating").select("economy", F.lit("PARTICIPATING").alias("status"))
    headings = spark.createDataFrame(_HEADING_ROWS, "heading string, category string")
    return rounded(ingest.unify_normalized_rows(rows, nominal(spark, sf_dir), status, headings), value=2)
