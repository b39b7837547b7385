"""Chaining, donor ranks, leave-out pools, rankings, rounding and set operators."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.base import rnd, sql
from kalends.functions.months import months_between
from kalends.functions.numbers import rnd as r
from kalends.operators import joins, sets, windows
from kalends.session import cut
from kalends.sources import tables
from kalends.sources.tables import MONEY, table

# anchors: the first month and every month divisible by five; other months only have a rate
base.add("chain_grid", """
    SELECT economy, category, period, CASE WHEN period = '1995-01' OR CAST(substr(period, 6, 2) AS INTEGER) % 5 = 0 THEN unit_price / 7.13 END AS anchor,
           rate / 10 AS central_rate, rate / 10 - 0.01 AS lower_rate, rate / 10 + 0.01 AS upper_rate FROM rates""", "rates")


@query("chain_link", sql(f"""
    SELECT economy, category, period, {rnd('CASE WHEN ok THEN a * exp(c) END', 4)} AS central, {rnd('CASE WHEN ok THEN a * exp(l) END', 4)} AS lower, {rnd('CASE WHEN ok THEN a * exp(u) END', 4)} AS upper
    FROM (SELECT economy, category, period, segment > 0 AND max(bad) OVER w = 0 AS ok, first_value(anchor) OVER w AS a, sum(CASE WHEN anchor IS NULL AND bad = 0 THEN ln(1 + central_rate) ELSE 0 END) OVER w AS c,
            sum(CASE WHEN anchor IS NULL AND bad = 0 THEN ln(1 + lower_rate) ELSE 0 END) OVER w AS l, sum(CASE WHEN anchor IS NULL AND bad = 0 THEN ln(1 + upper_rate) ELSE 0 END) OVER w AS u
          FROM (SELECT *, count(anchor) OVER (PARTITION BY economy, category ORDER BY period) AS segment,
                  CASE WHEN anchor IS NULL AND (central_rate IS NULL OR lower_rate <= -1) THEN 1 ELSE 0 END AS bad FROM chain_grid)
          WINDOW w AS (PARTITION BY economy, category, segment ORDER BY period ROWS UNBOUNDED PRECEDING))""", "chain_grid"))
def chain_link(spark, sf_dir):
    rates = joins.monthly_rates(tables.observations(spark, sf_dir), ["economy", "category"], "unit_price")
    anchored = (F.col("period") == "1995-01") | (F.substring("period", 6, 2).cast("int") % 5 == 0)
    grid = rates.select("economy", "category", "period", F.when(anchored, F.col("unit_price") / 7.13).alias("anchor"), (F.col("rate") / 10).alias("central_rate"),
                        (F.col("rate") / 10 - 0.01).alias("lower_rate"), (F.col("rate") / 10 + 0.01).alias("upper_rate"))
    return windows.chain_link(grid).select("economy", "category", "period", *[r(F.col(c), 4).alias(c) for c in ("central", "lower", "upper")])


@query("top_donors", sql("""
    SELECT target, donor, donor_rank::INTEGER AS donor_rank FROM (SELECT target, donor, row_number() OVER (PARTITION BY target ORDER BY income_match DESC, overlap DESC, donor) AS donor_rank FROM pairs) WHERE donor_rank <= 7""", "pairs"))
def top_donors(spark, sf_dir):
    pairs = joins.donor_pairs(tables.profiles(spark, sf_dir), tables.weights_of(cut(tables.observations(spark, sf_dir))))
    return windows.top_donors(pairs, 7, (F.desc("income_match"), F.desc("overlap"), F.col("donor"))).select("target", "donor", "donor_rank")


base.add("factors", """
    SELECT m.origin, m.target, a.economy, a.category, b.price_relative / a.price_relative AS factor, w.weight FROM pairs_months m JOIN rrel a ON a.period = m.origin
    JOIN rrel b ON b.period = m.target AND b.economy = a.economy AND b.category = a.category JOIN rweights w ON w.economy = a.economy AND w.category = a.category WHERE m.horizon = 3""", "pairs_months", "rrel", "rweights")
_OTHER = "b.origin = a.origin AND b.target = a.target AND {0}"


@query("leave_out_factors", sql("\nUNION ALL\n".join(f"""
    SELECT a.origin, a.target, '{name}' AS scenario, a.economy, a.category, {rnd(f"avg(b.factor) FILTER (WHERE {rule})")} AS global_equal,
           {rnd(f"sum(b.factor * b.weight) FILTER (WHERE {rule}) / sum(b.weight) FILTER (WHERE {rule})")} AS global_weighted,
           {rnd(f"sum(b.factor * b.weight) FILTER (WHERE {rule} AND b.economy = a.economy) / sum(b.weight) FILTER (WHERE {rule} AND b.economy = a.economy)")} AS economy_weighted,
           {rnd(f"sum(b.factor * b.weight) FILTER (WHERE {rule} AND b.category = a.category) / sum(b.weight) FILTER (WHERE {rule} AND b.category = a.category)")} AS category_weighted
    FROM factors a JOIN factors b ON b.origin = a.origin AND b.target = a.target GROUP BY a.origin, a.target, a.economy, a.category"""
    for name, rule in (("SINGLE_CELL", "(b.economy <> a.economy OR b.category <> a.category)"), ("ECONOMY_OUTAGE", "b.economy <> a.economy"), ("CATEGORY_OUTAGE", "b.category <> a.category"))), "factors"))
def leave_out_factors(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    panel = cut(tables.relatives_of(obs, "1996-01"))
    pairs = joins.rolling_origin_pairs(panel, (3,), ("1998-01", "2000-12")).select("origin", "target")
    start = panel.select("economy", "category", F.col("period").alias("origin"), F.col("price_relative").alias("before"))
    end = panel.select("economy", "category", F.col("period").alias("target"), F.col("price_relative").alias("after"))
    factors = pairs.join(start, "origin").join(end, ["target", "economy", "category"]).join(tables.weights_of(obs), ["economy", "category"])
    factors = cut(factors.select("origin", "target", "economy", "category", (F.col("after") / F.col("before")).alias("factor"), "weight"))
    rows = windows.leave_out_factors(factors, ("SINGLE_CELL", "ECONOMY_OUTAGE", "CATEGORY_OUTAGE"))
    means = ("global_equal", "global_weighted", "economy_weighted", "category_weighted")
    return rows.select("origin", "target", "scenario", "economy", "category", *[r(F.col(c)).alias(c) for c in means])


# Candidate classes and integration costs of the priority score.
PROBABILITY = {"A_EXACT": 0.9, "B_BRIDGEABLE": 0.6, "C_PARTIAL": 0.25}
COST = {"LOW": 1.0, "MEDIUM": 2.0, "HIGH": 4.0, "VERY_HIGH": 8.0}


@query("gap_priority", f"""
    WITH c AS (SELECT n_name AS economy, p_type AS category, CASE WHEN 3 * count(*) FILTER (l_returnflag = 'R') <= count(*) THEN CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DOUBLE) END AS real FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
               JOIN nation ON s_nationkey = n_nationkey JOIN part ON l_partkey = p_partkey WHERE strftime(l_shipdate, '%Y') = '1996' GROUP BY 1, 2),
      p AS (SELECT n_name AS economy, CASE WHEN n_nationkey % 5 = 4 THEN NULL WHEN n_nationkey % 3 = 0 THEN 'A_EXACT' WHEN n_nationkey % 3 = 1 THEN 'B_BRIDGEABLE' ELSE 'D_UNAVAILABLE' END AS candidate_class,
              CASE WHEN n_nationkey % 5 = 4 THEN NULL WHEN n_nationkey % 4 = 0 THEN 'low' WHEN n_nationkey % 4 = 1 THEN 'MEDIUM' WHEN n_nationkey % 4 = 2 THEN 'HIGH' ELSE 'UNKNOWN' END AS integration_cost FROM nation),
      s AS (SELECT economy, coalesce(list(DISTINCT category) FILTER (WHERE real IS NOT NULL), []) AS held, coalesce(sum(real) FILTER (WHERE category IN ('ECONOMY','LARGE','PROMO')), 0) AS direct_real FROM c GROUP BY 1),
      g AS (SELECT s.*, direct_real / (SELECT sum(direct_real) FROM s) AS share, coalesce(candidate_class, 'NOT_PROBED') AS candidate_class,
              direct_real / (SELECT sum(direct_real) FROM s) * CASE candidate_class WHEN 'A_EXACT' THEN 0.9 WHEN 'B_BRIDGEABLE' THEN 0.6 WHEN 'C_PARTIAL' THEN 0.25 ELSE 0.0 END
                / CASE upper(coalesce(integration_cost, 'NOT_ESTIMATED')) WHEN 'LOW' THEN 1.0 WHEN 'MEDIUM' THEN 2.0 WHEN 'HIGH' THEN 4.0 WHEN 'VERY_HIGH' THEN 8.0 ELSE 10.0 END AS score
            FROM s LEFT JOIN p USING (economy) WHERE len(held) < 6)
    SELECT economy, len(held)::INTEGER AS categories_available, array_to_string(list_filter(['ECONOMY','LARGE','MEDIUM','PROMO','SMALL','STANDARD'], lambda x: NOT list_contains(held, x)), '|') AS missing_categories,
           {rnd('direct_real', 2)} AS direct_real, {rnd('share', 9)} AS share, candidate_class, {rnd('score', 9)} AS score, (row_number() OVER o)::INTEGER AS gap_rank, {rnd('sum(share) OVER o', 9)} AS cumulative_share,
           CASE WHEN candidate_class <> 'NOT_PROBED' THEN (row_number() OVER (PARTITION BY candidate_class <> 'NOT_PROBED' ORDER BY score DESC, direct_real DESC, economy DESC))::INTEGER END AS score_rank
    FROM g WINDOW o AS (ORDER BY direct_real DESC, economy DESC)""")
def gap_priority(spark, sf_dir):
    part = table(spark, sf_dir, "part").select("p_partkey", F.col("p_type").alias("category"))
    key = F.col("n_nationkey")
    nation = table(spark, sf_dir, "nation")
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey")
    named = nation.select("n_nationkey", F.col("n_name").alias("economy"))
    held = table(spark, sf_dir, "lineitem").filter(F.year("l_shipdate") == 1996)
    cells = held.join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).join(part, F.col("l_partkey") == F.col("p_partkey")).join(
        named, F.col("s_nationkey") == F.col("n_nationkey")).groupBy("economy", "category").agg(
        F.when(3 * F.count_if(F.col("l_returnflag") == "R") <= F.count("*"), F.sum(F.col("l_extendedprice").cast(MONEY)).cast("double")).alias("real"))  # null if over a third of its lines came back
    probed = key % 5 != 4
    probe = nation.select(
        F.col("n_name").alias("economy"), F.when(probed, F.when(key % 3 == 0, "A_EXACT").when(key % 3 == 1, "B_BRIDGEABLE").otherwise("D_UNAVAILABLE")).alias("candidate_class"),
        F.when(probed, F.when(key % 4 == 0, "low").when(key % 4 == 1, "MEDIUM").when(key % 4 == 2, "HIGH").otherwise("UNKNOWN")).alias("integration_cost"))
    found = windows.gap_priority(cut(cells), probe, tables.CATEGORIES, ("ECONOMY", "LARGE", "PROMO"), PROBABILITY, COST)
    return found.withColumn("direct_real", r(F.col("direct_real"), 2)).withColumn("share", r(F.col("share"), 9)).withColumn("score", r(F.col("score"), 9)).withColumn(
        "cumulative_share", r(F.col("cumulative_share"), 9))


@query("round_with_residual", sql("""
    WITH x AS (SELECT economy, category, round_even(CAST(weight AS DECIMAL(38,24)), 6) AS rounded, row_number() OVER (ORDER BY economy DESC, category DESC) = 1 AS last FROM weights)
    SELECT economy, category, CAST(CASE WHEN last THEN 1 - (SELECT sum(rounded) FROM x) ELSE 0 END AS DOUBLE) AS residual,
           CAST(rounded + CASE WHEN last THEN 1 - (SELECT sum(rounded) FROM x) ELSE 0 END AS DOUBLE) AS weight FROM x""", "weights").replace("WITH lines", "WITH lines").replace("\n    WITH x AS", ", x AS"))
def round_with_residual(spark, sf_dir):
    weights = cut(tables.weights_of(cut(tables.observations(spark, sf_dir)))).withColumnRenamed("weight", "share")
    found = windows.round_with_residual(weights, "share", 6, ("economy", "category"))
    return found.select("economy", "category", F.col("residual").cast("double").alias("residual"), F.col("weight").cast("double").alias("weight"))


@query("common_cases", "SELECT l_partkey, l_suppkey FROM lineitem GROUP BY ALL HAVING count(DISTINCT l_returnflag) = 3")
def common_cases(spark, sf_dir):
    return sets.common_cases(table(spark, sf_dir, "lineitem"), ["l_partkey", "l_suppkey"], "l_returnflag", 3)


@query("sample_difference", """
    SELECT *, 'LEFT_ONLY' AS side FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A' EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N')
    UNION ALL SELECT *, 'RIGHT_ONLY' FROM (SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'N' EXCEPT ALL SELECT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'A')""")
def sample_difference(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    return sets.sample_difference(lines.filter("l_returnflag = 'A'"), lines.filter("l_returnflag = 'N'"), ["l_partkey", "l_suppkey"], lines.count())


@query("stack_indices", sql(f"""
    SELECT 'ALL_LINES' AS index_id, period, {rnd('sum(weight * price_relative)')} AS value FROM rrel JOIN rweights USING (economy, category) GROUP BY period
    UNION ALL SELECT 'SIMPLE_MEAN', period, {rnd('avg(price_relative)')} FROM rrel GROUP BY period""", "rrel", "rweights"))
def stack_indices(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    relatives = tables.relatives_of(obs, "1996-01")
    weighted = relatives.join(tables.weights_of(obs), ["economy", "category"]).groupBy("period").agg(F.sum(F.col("weight") * F.col("price_relative")).alias("value"))
    simple = relatives.groupBy("period").agg(F.avg("price_relative").alias("value"))
    return sets.stack_indices(ALL_LINES=weighted, SIMPLE_MEAN=simple).withColumn("value", r(F.col("value")))
