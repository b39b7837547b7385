"""Completion pipelines on the nation panel, whose holes call for every kind of donor pool."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.base import rnd, sql
from kalends.functions.numbers import rnd as r
from kalends.operators import joins
from kalends.plans import completion
from kalends.plans.completion import Policy
from kalends.session import cut
from kalends.sources import tables

REFERENCE = "1996-01"
POLICY = Policy(minimum_region_donors=4, minimum_world_donors=20, maximum_donors=22, horizons=(1, 3, 6, 12))
BASELINES = completion.baseline_policies(POLICY)
SCENARIOS = completion.sensitivity_policies(POLICY)
CLASSES_SQL = "[" + ",".join(f"'{c}'" for c in completion.COMPLETION_CLASSES) + "]"

# levels are damped unit prices: the spread of the raw ones would push lower rates below -100 %
base.add("clevel", """
    SELECT economy, category, period, 20000 + unit_price AS level, CASE WHEN length(category) = 5 THEN 'P2_OFFICIAL_COMPATIBLE_AGGREGATE' ELSE 'P1_OFFICIAL_CATEGORY' END AS evidence_class FROM obs""", "obs")
base.add("chead", "SELECT economy, period, 20000 + unit_price AS level FROM headline", "headline")
base.add("chrate", """
    SELECT a.economy, a.period, a.level / b.level - 1 AS headline_rate FROM chead a JOIN chead b ON b.economy = a.economy
      AND b.period = strftime(CAST(a.period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m')""", "chead")
base.add("cresid", """
    SELECT a.economy AS donor, a.category, a.period, a.level / b.level - 1 - h.headline_rate AS residual FROM clevel a JOIN clevel b ON b.economy = a.economy AND b.category = a.category
      AND b.period = strftime(CAST(a.period || '-01' AS DATE) - INTERVAL 1 MONTH, '%Y-%m') JOIN chrate h ON h.economy = a.economy AND h.period = a.period""", "clevel", "chrate")
base.add("cpool", """
    SELECT p.target, r.category, r.period, p.donor, p.same_region, r.residual, p.similarity AS w,
           row_number() OVER (PARTITION BY p.target, r.category, r.period ORDER BY p.income_match DESC, p.overlap DESC, p.donor) AS world_place,
           row_number() OVER (PARTITION BY p.target, r.category, r.period, p.same_region ORDER BY p.income_match DESC, p.overlap DESC, p.donor) AS region_place
    FROM cresid r JOIN pairs p ON p.donor = r.donor""", "cresid", "pairs")
base.add("ccells", "SELECT h.economy, c.category, h.period, h.headline_rate FROM chrate h, (SELECT DISTINCT category FROM clevel) c", "chrate", "clevel")
base.add("cpast", """
    SELECT target, category, until, min(residual) FILTER (WHERE cum >= total * 0.1 * (1 - 1e-12)) AS past_lo, min(residual) FILTER (WHERE cum >= total * 0.9 * (1 - 1e-12)) AS past_hi
    FROM (SELECT p.target, x.category, c.period AS until, x.residual, sum(p.similarity) OVER (PARTITION BY p.target, x.category, c.period ORDER BY x.residual, p.similarity ROWS UNBOUNDED PRECEDING) AS cum,
                 sum(p.similarity) OVER (PARTITION BY p.target, x.category, c.period) AS total
          FROM ccells c JOIN pairs p ON p.target = c.economy JOIN cresid x ON x.donor = p.donor AND x.category = c.category AND x.period <= c.period) GROUP BY ALL""", "ccells", "pairs", "cresid")


def _values(policies):
    rows = ", ".join(f"('{n}', {p.minimum_region_donors}, {p.minimum_world_donors}, {p.maximum_donors})" for n, p in policies.items())
    return f"SELECT * FROM (VALUES {rows}) v(scenario, least_region, least_world, most)"


def _predictions(suffix, policies):
    """Expressions giving the predictions, the completed grid, its index and the validation cases of some policies."""
    s = suffix
    base.add(f"scen{s}", _values(policies))
    base.add(f"cquant{s}", f"""
        SELECT scenario, pool, target, category, period, count(*) AS n, string_agg(donor, '|' ORDER BY donor) AS donors,
               array_to_string(list_sort(list_concat(list('SRC_' || donor || '_' || left(category, 2)), list('HEAD_' || donor))), '|') AS sources, min(residual) FILTER (WHERE cum >= total * 0.1 * (1 - 1e-12)) AS lo,
               min(residual) FILTER (WHERE cum >= total * 0.5 * (1 - 1e-12)) AS mid, min(residual) FILTER (WHERE cum >= total * 0.9 * (1 - 1e-12)) AS hi
        FROM (SELECT *, sum(w) OVER (PARTITION BY scenario, pool, target, category, period ORDER BY residual, w ROWS UNBOUNDED PRECEDING) AS cum, sum(w) OVER (PARTITION BY scenario, pool, target, category, period) AS total
              FROM (SELECT s.scenario, 'R' AS pool, p.* FROM cpool p, scen{s} s WHERE p.same_region AND p.region_place <= s.most
                    UNION ALL SELECT s.scenario, 'W', p.* FROM cpool p, scen{s} s WHERE p.world_place <= s.most)) GROUP BY ALL""", "cpool", f"scen{s}")
    base.add(f"cpred{s}", f"""
        SELECT *, headline_rate + CASE WHEN k < 3 THEN mid ELSE 0 END AS central_rate,
               headline_rate + CASE WHEN k < 3 THEN least(lo, mid) WHEN past_lo IS NOT NULL THEN least(past_lo, 0) ELSE -0.03 END AS lower_rate,
               headline_rate + CASE WHEN k < 3 THEN greatest(hi, mid) WHEN past_lo IS NOT NULL THEN greatest(past_hi, 0) ELSE 0.03 END AS upper_rate,
               CASE k WHEN 1 THEN 'P4_REGIONAL_PATTERN' WHEN 2 THEN 'P5_WORLD_PATTERN' ELSE 'P3_OFFICIAL_HEADLINE' END AS evidence_class,
               CASE WHEN k < 3 THEN 'HEADLINE_PLUS_WEIGHTED_MEDIAN_DEVIATION' WHEN past_lo IS NOT NULL THEN 'HEADLINE_WITH_HISTORICAL_RESIDUAL_INTERVAL' ELSE 'HEADLINE_WITH_DEFAULT_INTERVAL' END AS method
        FROM (SELECT s.scenario, c.economy, c.category, c.period, c.headline_rate, CASE WHEN a.n >= s.least_region THEN 1 WHEN b.n >= s.least_world THEN 2 ELSE 3 END AS k,
                CASE WHEN a.n >= s.least_region THEN a.lo WHEN b.n >= s.least_world THEN b.lo END AS lo, CASE WHEN a.n >= s.least_region THEN a.mid WHEN b.n >= s.least_world THEN b.mid END AS mid,
                CASE WHEN a.n >= s.least_region THEN a.hi WHEN b.n >= s.least_world THEN b.hi END AS hi, CASE WHEN a.n >= s.least_region THEN a.donors WHEN b.n >= s.least_world THEN b.donors ELSE '' END AS donors,
                CASE WHEN a.n >= s.least_region THEN a.sources WHEN b.n >= s.least_world THEN b.sources ELSE '' END AS sources,
                h.past_lo, h.past_hi
              FROM ccells c CROSS JOIN scen{s} s LEFT JOIN cquant{s} a ON a.scenario = s.scenario AND a.pool = 'R' AND a.target = c.economy AND a.category = c.category AND a.period = c.period
              LEFT JOIN cquant{s} b ON b.scenario = s.scenario AND b.pool = 'W' AND b.target = c.economy AND b.category = c.category AND b.period = c.period
              LEFT JOIN cpast h ON h.target = c.economy AND h.category = c.category AND h.until = c.period)""", "ccells", f"scen{s}", f"cquant{s}", "cpast")
    base.add(f"cgrid{s}", f"""
        SELECT g.scenario, g.economy, g.category, g.period, CASE WHEN g.period = '{REFERENCE}' THEN b.level IS NOT NULL ELSE d.level IS NOT NULL AND b.level IS NOT NULL END AS observed,
               CASE WHEN g.period = '{REFERENCE}' THEN 100.0 WHEN d.level IS NOT NULL AND b.level IS NOT NULL THEN d.level / b.level * 100 END AS anchor,
               b.evidence_class AS base_class, d.evidence_class AS direct_class, p.central_rate, p.lower_rate, p.upper_rate, p.evidence_class, p.method, p.donors, p.sources
        FROM (SELECT scenario, economy, category, strftime(m, '%Y-%m') AS period FROM scen{s}, (SELECT DISTINCT economy FROM chead), (SELECT DISTINCT category FROM clevel),
                (SELECT unnest(generate_series(DATE '{REFERENCE}-01', (SELECT max(CAST(period || '-01' AS DATE)) FROM chead), INTERVAL 1 MONTH)) AS m)) g
        LEFT JOIN clevel b ON b.economy = g.economy AND b.category = g.category AND b.period = '{REFERENCE}'
        LEFT JOIN clevel d ON d.economy = g.economy AND d.category = g.category AND d.period = g.period
        LEFT JOIN cpred{s} p ON p.scenario = g.scenario AND p.economy = g.economy AND p.category = g.category AND p.period = g.period""", f"scen{s}", "chead", "clevel", f"cpred{s}")
    step = "sum(CASE WHEN anchor IS NULL AND bad = 0 THEN ln(1 + {0}) ELSE 0 END) OVER w"
    base.add(f"cdone{s}", f"""
        SELECT *, central / lag(central) OVER (PARTITION BY scenario, economy, category ORDER BY period) - 1 AS direct_rate FROM (
          SELECT *, CASE WHEN max(bad) OVER w = 0 THEN first_value(anchor) OVER w * exp({step.format('central_rate')}) END AS central,
                 CASE WHEN max(bad) OVER w = 0 THEN first_value(anchor) OVER w * exp({step.format('lower_rate')}) END AS lower,
                 CASE WHEN max(bad) OVER w = 0 THEN first_value(anchor) OVER w * exp({step.format('upper_rate')}) END AS upper
          FROM (SELECT *, count(anchor) OVER (PARTITION BY scenario, economy, category ORDER BY period) AS segment, CASE WHEN anchor IS NULL AND (central_rate IS NULL OR lower_rate <= -1) THEN 1 ELSE 0 END AS bad FROM cgrid{s})
          WINDOW w AS (PARTITION BY scenario, economy, category, segment ORDER BY period ROWS UNBOUNDED PRECEDING))""", f"cgrid{s}")
    base.add(f"cindex{s}", f"""
        SELECT scenario, period, CASE WHEN m = 0 THEN c END AS central_index, CASE WHEN m = 0 THEN least(l, c) END AS lower_index, CASE WHEN m = 0 THEN greatest(u, c) END AS upper_index, m AS missing_cells
        FROM (SELECT scenario, period, sum(weight * central) AS c, sum(weight * lower) AS l, sum(weight * upper) AS u, count(*) FILTER (WHERE central IS NULL) AS m FROM cdone{s} JOIN weights USING (economy, category) GROUP BY 1, 2)""", f"cdone{s}", "weights")
    base.add(f"ccase{s}", f"""
        SELECT scenario, economy, region, category, end_period, horizon, hidden_class, fallback, actual, predicted, lower, upper, predicted - actual AS error, abs(predicted - actual) / abs(actual) * 100 AS ape,
               actual >= lower AND actual <= upper AS covered
        FROM (SELECT p.scenario, p.economy, f.region, p.category, d.period AS end_period, h.horizon, d.evidence_class AS hidden_class, max(p.k) AS fallback, any_value(d.level) / any_value(b.level) * 100 AS actual,
                     100 * exp(sum(ln(1 + p.central_rate))) AS predicted, 100 * exp(sum(ln(1 + p.lower_rate))) AS lower, 100 * exp(sum(ln(1 + p.upper_rate))) AS upper, count(*) AS n
              FROM places z CROSS JOIN (SELECT unnest([1, 3, 6, 12])::INTEGER AS horizon) h JOIN clevel d ON d.period = z.period JOIN places y ON y.place = z.place - h.horizon
              JOIN clevel b ON b.economy = d.economy AND b.category = d.category AND b.period = y.period JOIN places x ON x.place > y.place AND x.place <= z.place
              JOIN (SELECT *, CASE evidence_class WHEN 'P4_REGIONAL_PATTERN' THEN 1 WHEN 'P5_WORLD_PATTERN' THEN 2 ELSE 3 END AS kk FROM cpred{s} WHERE lower_rate > -1) p ON p.economy = d.economy AND p.category = d.category AND p.period = x.period
              JOIN profiles f ON f.economy = d.economy GROUP BY ALL) WHERE n = horizon""".replace("GROUP BY ALL", "GROUP BY p.scenario, p.economy, f.region, p.category, d.period, h.horizon, d.evidence_class"), "places", "clevel", f"cpred{s}", "profiles")
    base.add(f"csum{s}", f"""
        SELECT scenario, count(*) AS observation_count, avg(abs(error)) AS mae, avg(ape) AS mape, sqrt(avg(error * error)) AS rmse, avg(error) AS bias, avg(CAST(covered AS DOUBLE)) AS coverage
        FROM ccase{s} SEMI JOIN (SELECT economy, category, end_period, horizon FROM ccase{s} GROUP BY ALL HAVING count(*) = {len(policies)}) USING (economy, category, end_period, horizon) GROUP BY 1""", f"ccase{s}")


base.add("places", f"SELECT period, row_number() OVER (ORDER BY period) AS place FROM (SELECT DISTINCT period FROM chead WHERE period >= '{REFERENCE}')", "chead")
_predictions("c", {"CANDIDATE_SELECTED_PATTERN": POLICY})
_predictions("b", BASELINES)
_predictions("s", SCENARIOS)


def inputs(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir))
    evidence = F.when(F.length("category") == 5, completion.COMPLETION_CLASSES[1]).otherwise(completion.COMPLETION_CLASSES[0])
    levels = obs.select("economy", "category", "period", (20000 + F.col("unit_price")).alias("level"), evidence.alias("evidence_class"),
                        F.concat(F.lit("SRC_"), "economy", F.lit("_"), F.left("category", F.lit(2))).alias("source_id"))
    headline = cut(tables.headline_of(obs).select("economy", "period", (20000 + F.col("unit_price")).alias("level"), F.concat(F.lit("HEAD_"), "economy").alias("source_id")))
    return levels, headline, cut(tables.profiles(spark, sf_dir)), cut(tables.weights_of(obs))


def predicted(spark, sf_dir, policies):
    levels, headline, profiles, weights = inputs(spark, sf_dir)
    rows = cut(completion.predict_rates(levels, headline, profiles, weights, tables.CATEGORIES, policies))
    return levels, headline, profiles, weights, rows


def _round(df, places, *names):
    return df.withColumns({name: r(F.col(name), places) for name in names})


@query("predict_rates", sql(f"""
    SELECT economy, category, period, {rnd('central_rate', 7)} AS central_rate, {rnd('lower_rate', 7)} AS lower_rate, {rnd('upper_rate', 7)} AS upper_rate, evidence_class, donors, method FROM cpredc""", "cpredc"))
def predict_rates(spark, sf_dir):
    rows = predicted(spark, sf_dir, {"CANDIDATE_SELECTED_PATTERN": POLICY})[-1]
    return _round(rows, 7, "central_rate", "lower_rate", "upper_rate").select("economy", "category", "period", "central_rate", "lower_rate", "upper_rate", "evidence_class", "donors", "method")


@query("complete_price_grid", sql(f"""
    SELECT economy, category, period, {rnd('central', 5)} AS central, {rnd('lower', 5)} AS lower, {rnd('upper', 5)} AS upper,
           {rnd(f"CASE WHEN period = '{REFERENCE}' THEN 0.0 WHEN observed THEN direct_rate ELSE central_rate END")} AS rate,
           CASE WHEN period = '{REFERENCE}' THEN coalesce(base_class, 'P3_OFFICIAL_HEADLINE') WHEN observed THEN direct_class ELSE evidence_class END AS evidence_class,
           CASE WHEN period = '{REFERENCE}' AND observed THEN 'OFFICIAL_REFERENCE_REBASE_100' WHEN period = '{REFERENCE}' THEN 'REFERENCE_NORMALISATION_100_WITHOUT_CATEGORY_OBSERVATION'
                WHEN observed THEN 'DIRECT_OFFICIAL_LEVEL_RELATIVE_TO_REFERENCE' ELSE method END AS method, observed,
           CASE WHEN observed OR period = '{REFERENCE}' THEN '' ELSE coalesce(donors, '') END AS donors,
           CASE WHEN observed THEN 'SRC_' || economy || '_' || left(category, 2) WHEN period = '{REFERENCE}' THEN '' ELSE coalesce(sources, '') END AS sources, CASE WHEN central IS NULL THEN 'MISSING_RATE' ELSE 'COMPLETE' END AS status FROM cdonec""", "cdonec"))
def complete_price_grid(spark, sf_dir):
    levels, headline, _, _, rows = predicted(spark, sf_dir, {"CANDIDATE_SELECTED_PATTERN": POLICY})
    done = completion.complete_price_grid(levels, headline, rows, tables.CATEGORIES, REFERENCE).drop("scenario")
    return _round(_round(done, 5, "central", "lower", "upper"), 6, "rate")


@query("global_index_with_bounds", sql(f"""
    SELECT period, {rnd('central_index')} AS central_index, {rnd('lower_index')} AS lower_index, {rnd('upper_index')} AS upper_index, missing_cells FROM cindexc""", "cindexc"))
def global_index_with_bounds(spark, sf_dir):
    levels, headline, _, weights, rows = predicted(spark, sf_dir, {"CANDIDATE_SELECTED_PATTERN": POLICY})
    done = completion.complete_price_grid(levels, headline, rows, tables.CATEGORIES, REFERENCE)
    return _round(completion.global_index_with_bounds(done, weights).drop("scenario"), 6, "central_index", "lower_index", "upper_index")


_CASE_COLUMNS = ("economy", "region", "category", "end_period", "horizon", "hidden_class", "fallback_class", "actual", "predicted", "lower", "upper", "error", "ape", "covered")


@query("leave_one_out_validation", sql(f"""
    SELECT economy, region, category, end_period, horizon, hidden_class, CASE fallback WHEN 1 THEN 'P4_REGIONAL_PATTERN' WHEN 2 THEN 'P5_WORLD_PATTERN' ELSE 'P3_OFFICIAL_HEADLINE' END AS fallback_class,
           {rnd('actual')} AS actual, {rnd('predicted')} AS predicted, {rnd('lower')} AS lower, {rnd('upper')} AS upper, {rnd('error')} AS error, {rnd('ape')} AS ape, covered FROM ccasec""", "ccasec"))
def leave_one_out_validation(spark, sf_dir):
    levels, headline, profiles, _, rows = predicted(spark, sf_dir, {"CANDIDATE_SELECTED_PATTERN": POLICY})
    cases = completion.leave_one_out(levels, headline, rows, profiles, REFERENCE, POLICY.horizons).select(*_CASE_COLUMNS)
    return _round(cases, 6, "actual", "predicted", "lower", "upper", "error", "ape")


_METRICS = ", ".join(f"{rnd(m)} AS {m}" for m in ("mae", "mape", "rmse", "bias", "coverage"))


@query("baseline_comparison", sql(f"""
    SELECT scenario, observation_count, {_METRICS}, {rnd("CASE WHEN scenario LIKE 'CAND%' THEN 0 ELSE (mae - (SELECT mae FROM csumb WHERE scenario LIKE 'CAND%')) / mae * 100 END")} AS improvement FROM csumb""", "csumb"))
def baseline_comparison(spark, sf_dir):
    levels, headline, profiles, _, rows = predicted(spark, sf_dir, BASELINES)
    cases = cut(completion.leave_one_out(levels, headline, rows, profiles, REFERENCE, POLICY.horizons))
    return _round(completion.baseline_comparison(cases), 6, "mae", "mape", "rmse", "bias", "coverage", "improvement")


_SHIFT = """SELECT i.scenario, count(*) AS period_count, max(abs(i.central_index / b.central_index - 1) * 10000) AS maximum_shift_bps FROM cindexs i JOIN cindexs b ON b.period = i.period AND b.scenario = 'BASELINE' GROUP BY 1"""


@query("sensitivity_scenarios", sql(f"""
    SELECT scenario, observation_count, {_METRICS}, {rnd("(mae - (SELECT mae FROM csums WHERE scenario = 'BASELINE')) / (SELECT mae FROM csums WHERE scenario = 'BASELINE') * 100")} AS mae_degradation,
           period_count, {rnd('maximum_shift_bps', 5)} AS maximum_shift_bps FROM csums JOIN ({_SHIFT}) USING (scenario)""", "csums", "cindexs"))
def sensitivity_scenarios(spark, sf_dir):
    levels, headline, profiles, weights, rows = predicted(spark, sf_dir, SCENARIOS)
    cases = cut(completion.leave_one_out(levels, headline, rows, profiles, REFERENCE, POLICY.horizons))
    index = cut(completion.global_index_with_bounds(completion.complete_price_grid(levels, headline, rows, tables.CATEGORIES, REFERENCE), weights))
    found = completion.sensitivity_scenarios(cases, index, len(SCENARIOS))
    return _round(_round(found, 6, "mae", "mape", "rmse", "bias", "coverage", "mae_degradation"), 5, "maximum_shift_bps")


# Thresholds of the demonstration gates.
THRESHOLDS = {
    "HISTORY_LENGTH": 36, "VALIDATION_OBSERVATIONS": 5000, "VALIDATION_PER_CATEGORY": 300, "VALIDATION_PER_REGION": 500, "MAXIMUM_MAE": 5.0, "MAXIMUM_MAPE": 5.0,
    "MAXIMUM_RMSE": 8.0, "MAXIMUM_ABSOLUTE_BIAS": 1.0, "INTERVAL_COVERAGE_MINIMUM": 0.75, "INTERVAL_COVERAGE_MAXIMUM": 0.95, "IMPROVEMENT_VS_HEADLINE": 5.0,
    "MINIMUM_DIRECT_WORLD_WEIGHT": 0.7, "MAXIMUM_P3_WORLD_WEIGHT": 0.1, "MAXIMUM_P5_WORLD_WEIGHT": 0.2, "SENSITIVITY_INDEX_SHIFT": 25.0, "SENSITIVITY_MAE_DEGRADATION": 10.0, "POLICY_RATIFICATION": 1.0,
}
_GATE_SQL = "\nUNION ALL ".join(
    f"SELECT '{gate}' AS gate, {rnd(f'CAST({metric} AS DOUBLE)', 5)} AS observed, {float(THRESHOLDS[gate])}::DOUBLE AS threshold, {metric} {'>=' if low else '<='} {float(THRESHOLDS[gate])} AS passed FROM m"
    for gate, metric, low in completion.GATES)


@query("release_gates", sql(_GATE_SQL, "ccasec", "csumb", "csums", "cindexs", "cdonec", "weights", extra={"shift": _SHIFT, "cov": f"""
    SELECT period, coalesce(sum(weight) FILTER (WHERE class < 'P3'), 0) AS d, coalesce(sum(weight) FILTER (WHERE class LIKE 'P3%'), 0) AS p3, coalesce(sum(weight) FILTER (WHERE class LIKE 'P5%'), 0) AS p5
    FROM (SELECT period, weight, CASE WHEN central IS NULL THEN NULL WHEN period = '{REFERENCE}' THEN coalesce(base_class, 'P3_OFFICIAL_HEADLINE') WHEN observed THEN direct_class ELSE evidence_class END AS class
          FROM cdonec JOIN weights USING (economy, category)) GROUP BY 1""", "m": """
    SELECT c.*, (SELECT count(DISTINCT period) FROM cdonec) AS history_months, (SELECT min(n) FROM (SELECT count(*) AS n FROM ccasec GROUP BY category)) AS smallest_category,
           (SELECT min(n) FROM (SELECT count(*) AS n FROM ccasec GROUP BY region)) AS smallest_region,
           (SELECT ((SELECT mae FROM csumb WHERE scenario LIKE 'B0%') - mae) / (SELECT mae FROM csumb WHERE scenario LIKE 'B0%') * 100 FROM csumb WHERE scenario LIKE 'CAND%') AS improvement,
           (SELECT min(d) FROM cov) AS minimum_direct_weight, (SELECT max(p3) FROM cov) AS maximum_p3_weight, (SELECT max(p5) FROM cov) AS maximum_p5_weight,
           (SELECT max(maximum_shift_bps) FROM shift WHERE scenario <> 'BASELINE') AS maximum_shift_bps,
           (SELECT (max(mae) FILTER (WHERE scenario <> 'BASELINE') / max(mae) FILTER (WHERE scenario = 'BASELINE') - 1) * 100 FROM csums) AS maximum_degradation, 0.0 AS ratified
    FROM (SELECT CAST(count(*) AS DOUBLE) AS observation_count, avg(abs(error)) AS mae, avg(ape) AS mape, sqrt(avg(error * error)) AS rmse, abs(avg(error)) AS absolute_bias, avg(CAST(covered AS DOUBLE)) AS coverage FROM ccasec) c"""}))
def release_gates(spark, sf_dir):
    levels, headline, profiles, weights, rows = predicted(spark, sf_dir, {**BASELINES, **SCENARIOS})
    cases = cut(completion.leave_one_out(levels, headline, rows, profiles, REFERENCE, POLICY.horizons))
    done = cut(completion.complete_price_grid(levels, headline, rows.filter(F.col("scenario").isin(*SCENARIOS)), tables.CATEGORIES, REFERENCE))
    index = cut(completion.global_index_with_bounds(done, weights))
    own = cases.filter("scenario = 'CANDIDATE_SELECTED_PATTERN'")
    metrics = completion.gate_metrics(
        own, cut(completion.baseline_comparison(cases.filter(F.col("scenario").isin(*BASELINES)))),
        cut(completion.sensitivity_scenarios(cases.filter(F.col("scenario").isin(*SCENARIOS)), index, len(SCENARIOS))),
        completion.completion_coverage(done.filter("scenario = 'BASELINE'"), weights), done.agg(F.count_distinct("period")), ratified=False)
    return completion.release_gates(metrics, THRESHOLDS).withColumn("observed", r(F.col("observed"), 5))
