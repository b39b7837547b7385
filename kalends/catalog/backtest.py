"""Completion backtests on the region panel, whose months are complete."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.base import rnd, sql
from kalends.functions.numbers import rnd as r
from kalends.operators import aggregates, checks
from kalends.plans import backtest
from kalends.plans.backtest import B1, B2, B3, Rule, Safeguard
from kalends.session import cut
from kalends.sources import tables

HORIZONS, WINDOW, BASE_YEAR = (1, 3, 6, 12), ("1998-01", "2000-12"), 1996
POLICY = Safeguard(
    (Rule("R_PROMO", category="PROMO"), Rule("R_LARGE", category="LARGE"), Rule("R_OUTAGE_H1", scenario="CATEGORY_OUTAGE", horizon=1),
     Rule("R_SINGLE_H12", scenario="SINGLE_CELL", horizon=12), Rule("R_NEVER", category="NO_SUCH_CATEGORY")),
    development=("1998-01", "1999-06"), holdout=("1999-07", "2000-12"), minimum_cases=20, mean_delta_above=-30.0, regression_rate_from=0.42)

base.add("fvcells", """
    SELECT o.economy, o.category, o.period, 100 * o.unit_price / b.base_value AS price_relative, w.weight FROM fobs o JOIN rweights w USING (economy, category)
    JOIN (SELECT economy, category, avg(unit_price) AS base_value FROM fobs WHERE period LIKE '1996-%' GROUP BY ALL HAVING count(*) = 12) b USING (economy, category)""", "fobs", "rweights")
# the panel of the backtests: months that hold every weighted cell
for _name, _source in (("vwhole", "vcells"), ("fvwhole", "fvcells")):
    base.add(_name, f"SELECT * FROM {_source} WHERE period IN (SELECT period FROM {_source} GROUP BY period HAVING count(*) = (SELECT count(*) FROM rweights))", _source, "rweights")
for _name, _source in (("hlevel", "rheadline"), ("fhlevel", "fheadline")):
    base.add(_name, f"""
        SELECT period, avg(unit_price / base_value) AS equal, sum(unit_price / base_value * w) AS weighted FROM {_source}
        JOIN (SELECT economy, avg(unit_price) AS base_value FROM {_source} WHERE period LIKE '1996-%' GROUP BY 1 HAVING count(*) = 12) USING (economy)
        JOIN (SELECT economy, sum(weight) AS w FROM rweights GROUP BY 1) USING (economy) GROUP BY 1""", _source, "rweights")


def _case_parts(prefix, cells, level):
    """Expressions for the cases of one panel, by looking at every masked group in full."""
    base.add(f"{prefix}factor", f"""
        SELECT m.origin, m.target, m.horizon, a.economy, a.category, a.price_relative AS before, b.price_relative AS after, b.price_relative / a.price_relative AS factor, a.weight
        FROM pairs_months m JOIN {cells} a ON a.period = m.origin JOIN {cells} b ON b.period = m.target AND b.economy = a.economy AND b.category = a.category""", "pairs_months", cells)
    parts = []
    for name, group, rule in (("SINGLE_CELL", "a.economy || '|' || a.category", "(b.economy <> a.economy OR b.category <> a.category)"),
                              ("ECONOMY_OUTAGE", "a.economy", "b.economy <> a.economy"), ("CATEGORY_OUTAGE", "a.category", "b.category <> a.category")):
        mean = lambda extra: f"sum(b.factor * b.weight) FILTER (WHERE {rule}{extra}) / sum(b.weight) FILTER (WHERE {rule}{extra})"
        parts.append(f"""SELECT '{name}' AS scenario, {group} AS masked_group, a.origin, a.target, a.horizon, a.economy, a.category, a.before, a.after, a.weight, avg(b.factor) FILTER (WHERE {rule}) AS ge,
            {mean('')} AS gw, {mean(' AND b.economy = a.economy')} AS ew, {mean(' AND b.category = a.category')} AS cw
            FROM {prefix}factor a JOIN {prefix}factor b ON b.origin = a.origin AND b.target = a.target AND b.horizon = a.horizon GROUP BY a.origin, a.target, a.horizon, a.economy, a.category, a.before, a.after, a.weight""")
    base.add(f"{prefix}pool", "\nUNION ALL ".join(parts), f"{prefix}factor")
    base.add(f"{prefix}truth", f"SELECT period AS target, sum(weight * price_relative) AS truth FROM {cells} GROUP BY 1", cells)
    for kind, b0, b1, n0, n1 in (("case", "ge", "gw", "P5_GLOBAL_EQUAL_HEADLINE", "P5_GLOBAL_WEIGHTED"),
                                 ("hcase", "e1.equal / e0.equal", "e1.weighted / e0.weighted", "P1_OFFICIAL_HEADLINE_EQUAL", "P1_OFFICIAL_HEADLINE_WEIGHTED")):
        base.add(f"{prefix}{kind}", f"""
            SELECT scenario || '|' || masked_group || '|' || origin || '|' || target || '|H' || lpad(CAST(horizon AS VARCHAR), 2, '0') AS case_id, scenario, masked_group, origin, target, horizon,
                   CASE WHEN scenario = 'CATEGORY_OUTAGE' THEN '' ELSE economy END AS economy, CASE WHEN scenario = 'ECONOMY_OUTAGE' THEN '' ELSE category END AS category, model, truth, truth + error AS estimate, error,
                   abs(error / truth) * 10000 AS bps, mape, evidence_class
            FROM (SELECT scenario, masked_group, origin, target, horizon, m.model AS model, min(economy) AS economy, min(category) AS category, sum(weight * (before * m.f - after)) AS error,
                         avg(abs(before * m.f / after - 1) * 100) AS mape, string_agg(DISTINCT m.ev, '+' ORDER BY m.ev) AS evidence_class
                  FROM (SELECT p.*, unnest([struct_pack(model := '{backtest.B0}', f := {b0}, ev := '{n0}'), struct_pack(model := '{B1}', f := {b1}, ev := '{n1}'), struct_pack(model := '{B2}', f := 1.0::DOUBLE, ev := 'P3_CARRY_FORWARD'),
                               struct_pack(model := '{B3}', f := CASE WHEN ew IS NOT NULL AND cw IS NOT NULL THEN sqrt(ew * cw) ELSE coalesce(cw, ew, gw) END,
                                 ev := CASE WHEN ew IS NOT NULL AND cw IS NOT NULL THEN 'P4_ECONOMY_AND_CATEGORY' WHEN cw IS NOT NULL THEN 'P4_CATEGORY_PEERS' WHEN ew IS NOT NULL THEN 'P4_ECONOMY_CONTEXT' ELSE 'P5_GLOBAL_FALLBACK' END)]) AS m
                        FROM {prefix}pool p JOIN {level} e0 ON e0.period = p.origin JOIN {level} e1 ON e1.period = p.target) GROUP BY ALL) JOIN {prefix}truth USING (target)""",
                 f"{prefix}pool", f"{prefix}truth", level)


_case_parts("b", "vwhole", "hlevel")
_case_parts("f", "fvwhole", "fhlevel")


def inputs(spark, sf_dir, first_vintage=False):
    """Base-year relatives in months without a hole, headline relatives and the weights (always those of the final vintage)."""
    final = cut(tables.observations(spark, sf_dir, by="region"))
    weights = cut(tables.weights_of(final))
    obs = cut(tables.observations(spark, sf_dir, by="region", first_vintage=True)) if first_vintage else final
    panel = aggregates.annual_base_relatives(obs, BASE_YEAR, ["economy", "category"]).select(
        "economy", "category", "period", (100 * F.col("relative")).alias("price_relative"))
    headline = aggregates.annual_base_relatives(tables.headline_of(obs), BASE_YEAR, ["economy"]).select("economy", "period", "relative")
    return cut(checks.only_whole_months(panel, weights)), cut(headline), weights


def cases(spark, sf_dir, with_headline=True, first_vintage=False):
    panel, headline, weights = inputs(spark, sf_dir, first_vintage)
    return cut(backtest.completion_backtest(panel, weights, HORIZONS, WINDOW, headline if with_headline else None))


def rounded(df, **places):
    return df.withColumns({name: r(F.col(name), n) for name, n in places.items()})


_CASE_SQL = f"""SELECT case_id, scenario, masked_group, origin, target, horizon, economy, category, model, {rnd('truth')} AS truth, {rnd('estimate')} AS estimate, {rnd('error')} AS error,
    {rnd('bps', 4)} AS bps, {rnd('mape', 4)} AS mape, evidence_class FROM """


@query("mask_groups", sql("""
    WITH_ SELECT 'SINGLE_CELL' AS scenario, economy || '|' || category AS masked_group, economy, category FROM rweights UNION ALL SELECT 'ECONOMY_OUTAGE', economy, economy, category FROM rweights
    UNION ALL SELECT 'CATEGORY_OUTAGE', category, economy, category FROM rweights""".replace("WITH_ ", ""), "rweights"))
def mask_groups(spark, sf_dir):
    return backtest.mask_groups(tables.observations(spark, sf_dir, by="region"))


@query("completion_backtest", sql(_CASE_SQL + "bcase", "bcase"))
def completion_backtest(spark, sf_dir):
    return rounded(cases(spark, sf_dir, with_headline=False), truth=6, estimate=6, error=6, bps=4, mape=4)


@query("headline_backtest", sql(_CASE_SQL + "bhcase", "bhcase"))
def headline_backtest(spark, sf_dir):
    return rounded(cases(spark, sf_dir), truth=6, estimate=6, error=6, bps=4, mape=4)


_METRIC_PLACES = dict(mae=6, rmse=6, bias=6, mean_bps=4, p95_bps=4, mape=4)
_METRIC_SQL = f"""count(*) AS case_count, {rnd('avg(abs(error))')} AS mae, {rnd('sqrt(avg(error * error))')} AS rmse, {rnd('avg(error)')} AS bias, {rnd('avg(bps)', 4)} AS mean_bps,
    {rnd('quantile_cont(bps, 0.95)', 4)} AS p95_bps, {rnd('avg(mape)', 4)} AS mape"""


@query("backtest_metrics", sql("\nUNION ALL ".join(
    f"SELECT model, '{name}' AS dimension, CAST({name} AS VARCHAR) AS label, {_METRIC_SQL} FROM bhcase GROUP BY model, {name}" for name in ("scenario", "horizon", "economy", "category", "evidence_class")), "bhcase"))
def backtest_metrics(spark, sf_dir):
    rows = cases(spark, sf_dir)
    found = None
    for name in ("scenario", "horizon", "economy", "category", "evidence_class"):
        part = backtest.case_metrics(rows, ["model", name]).withColumn("dimension", F.lit(name)).withColumnRenamed(name, "label")
        part = part.withColumn("label", F.col("label").cast("string"))
        found = part if found is None else found.unionByName(part)
    return rounded(found, **_METRIC_PLACES)


@query("construction_sensitivity", sql(f"""
    SELECT period, {rnd('f')} AS full_index, {rnd('e')} AS equal_cell_index, {rnd('c')} AS category_equal_index, {rnd('(e / f - 1) * 10000', 4)} AS equal_cell_bps, {rnd('(c / f - 1) * 10000', 4)} AS category_equal_bps
    FROM (SELECT period, sum(p) AS f, sum(t) / sum(n) AS e, sum(w * a) AS c FROM (SELECT period, economy, sum(weight * price_relative) AS p, sum(price_relative) AS t, count(*) AS n, sum(weight) AS w, avg(price_relative) AS a
      FROM vwhole WHERE period BETWEEN '{WINDOW[0]}' AND '{WINDOW[1]}' GROUP BY 1, 2) GROUP BY 1)""", "vwhole"))
def construction_sensitivity(spark, sf_dir):
    panel, _, weights = inputs(spark, sf_dir)
    rows = backtest.construction_sensitivity(panel, weights, WINDOW)
    return rounded(rows, full_index=6, equal_cell_index=6, category_equal_index=6, equal_cell_bps=4, category_equal_bps=4)


base.add("bwide", f"""
    SELECT case_id, scenario, masked_group, origin, target, horizon, economy, category, max(bps) FILTER (WHERE model = '{backtest.B0}') AS b0, max(bps) FILTER (WHERE model = '{B1}') AS b1, max(bps) FILTER (WHERE model = '{B2}') AS b2,
           max(bps) FILTER (WHERE model = '{B3}') AS b3 FROM bhcase GROUP BY ALL""", "bhcase")
base.add("bdelta", """
    SELECT *, challenger - baseline AS delta, CASE WHEN round(challenger - baseline, 8) < 0 THEN 'IMPROVEMENT' WHEN round(challenger - baseline, 8) > 0 THEN 'REGRESSION' ELSE 'TIE' END AS outcome
    FROM (SELECT case_id, scenario, horizon, economy, category, p.pair_id AS pair_id, p.x AS challenger, p.y AS baseline FROM (SELECT *, unnest([struct_pack(pair_id := 'B1_VS_B0', x := b1, y := b0),
      struct_pack(pair_id := 'B3_VS_B0', x := b3, y := b0), struct_pack(pair_id := 'B3_VS_B1', x := b3, y := b1), struct_pack(pair_id := 'B3_VS_B2', x := b3, y := b2)]) AS p FROM bwide))""", "bwide")


@query("paired_deltas", sql(f"SELECT case_id, pair_id, {rnd('challenger', 4)} AS challenger, {rnd('baseline', 4)} AS baseline, {rnd('delta', 4)} AS delta, outcome FROM bdelta", "bdelta"))
def paired_deltas(spark, sf_dir):
    rows = backtest.paired_deltas(cases(spark, sf_dir))
    return rounded(rows, challenger=4, baseline=4, delta=4).select("case_id", "pair_id", "challenger", "baseline", "delta", "outcome")


def _strata_sql(table, aggregate, where=""):
    parts = []
    for fields in backtest.DIMENSIONS:
        label = " || ' | ' || ".join(f"'{f}=' || CAST({f} AS VARCHAR)" for f in fields)
        blank = " AND ".join(f"CAST({f} AS VARCHAR) <> ''" for f in fields)
        parts.append(f"SELECT '{'+'.join(fields)}' AS dimension, {label} AS label, {aggregate} FROM {table} WHERE {blank}{where} GROUP BY {', '.join(fields)}")
    return "\nUNION ALL ".join(parts)


@query("top_error_sources", sql(f"""
    SELECT dimension, label, case_count, {rnd('mean_bps', 4)} AS mean_bps, {rnd('p95_bps', 4)} AS p95_bps, {rnd('mape', 4)} AS mape FROM (SELECT *, row_number() OVER (PARTITION BY dimension ORDER BY mean_bps DESC, p95_bps DESC, label DESC) AS k FROM (
      {_strata_sql('bhcase', 'count(*) AS case_count, avg(bps) AS mean_bps, quantile_cont(bps, 0.95) AS p95_bps, avg(mape) AS mape', f" AND model = '{B3}'")}) WHERE case_count >= 100) WHERE k = 1""", "bhcase"))
def top_error_sources(spark, sf_dir):
    return rounded(backtest.top_error_sources(cases(spark, sf_dir), 100), mean_bps=4, p95_bps=4, mape=4)


_DELTA_SQL = """count(*) AS case_count, avg(delta) AS mean_delta, quantile_cont(delta, 0.95) AS p95_delta, count(*) FILTER (WHERE round(delta, 8) > 0) / count(*) AS regression_rate, avg(challenger) AS mean_challenger, avg(baseline) AS mean_baseline"""


@query("priority_regressions", sql(f"""
    SELECT priority, rank::INTEGER AS rank, dimension, label, case_count, {rnd('mean_delta', 4)} AS mean_delta, {rnd('p95_delta', 4)} AS p95_delta, {rnd('regression_rate')} AS regression_rate, {rnd('mean_challenger', 4)} AS mean_challenger,
           {rnd('mean_baseline', 4)} AS mean_baseline
    FROM (SELECT *, row_number() OVER (PARTITION BY priority ORDER BY -abs(mean_delta), CASE WHEN mean_delta > 0 THEN -regression_rate ELSE regression_rate END, dimension, label) AS rank
          FROM (SELECT *, CASE WHEN mean_delta > 0 THEN 'MEAN_REGRESSION' ELSE 'MEAN_IMPROVEMENT' END AS priority FROM ({_strata_sql('bdelta', _DELTA_SQL, " AND pair_id = 'B3_VS_B2'")})
                WHERE case_count >= 100 AND mean_delta <> 0)) WHERE rank <= 3""", "bdelta"))
def priority_regressions(spark, sf_dir):
    rows = backtest.priority_regressions(backtest.paired_deltas(cases(spark, sf_dir)), 100)
    return rounded(rows, mean_delta=4, p95_delta=4, regression_rate=6, mean_challenger=4, mean_baseline=4)


_MATCH = " ".join(
    f"CASE WHEN {' AND '.join(f'{n} = ' + (str(v) if n == 'horizon' else repr(v)) for n, v in (('category', x.category), ('scenario', x.scenario), ('horizon', x.horizon)) if v is not None)} THEN '{x.rule_id}' END," for x in POLICY.rules).rstrip(",")
_SPLIT = f"CASE WHEN target BETWEEN '{POLICY.development[0]}' AND '{POLICY.development[1]}' THEN 'DEVELOPMENT' WHEN target BETWEEN '{POLICY.holdout[0]}' AND '{POLICY.holdout[1]}' THEN 'HOLDOUT' END"


def _safeguard_parts(prefix, wide):
    base.add(f"{prefix}match", f"SELECT *, {_SPLIT} AS split, list_filter([{_MATCH}], lambda x: x IS NOT NULL) AS matched FROM {wide}", wide)
    base.add(f"{prefix}act", f"""
        SELECT rule_id, case_count, mean_delta, regression_rate, why = '' AS activated, CASE WHEN why = '' THEN 'ALL_DEVELOPMENT_CRITERIA_MET' ELSE why END AS reasons FROM (SELECT *, concat_ws('|',
            CASE WHEN case_count < {POLICY.minimum_cases} THEN 'INSUFFICIENT_DEVELOPMENT_CASES' END, CASE WHEN mean_delta <= {POLICY.mean_delta_above} THEN 'MEAN_REGRESSION_THRESHOLD_NOT_MET' END,
            CASE WHEN regression_rate < {POLICY.regression_rate_from} THEN 'REGRESSION_RATE_THRESHOLD_NOT_MET' END) AS why
          FROM (SELECT q.rule_id, count(d.rule_id) AS case_count, coalesce(avg(delta), 0) AS mean_delta, coalesce(count(*) FILTER (WHERE round(delta, 8) > 0) / nullif(count(d.rule_id), 0), 0) AS regression_rate
                FROM (SELECT unnest([{', '.join(repr(x.rule_id) for x in POLICY.rules)}]) AS rule_id) q LEFT JOIN (SELECT unnest(matched) AS rule_id, b3 - b2 AS delta FROM {prefix}match WHERE split = 'DEVELOPMENT') d
                ON d.rule_id = q.rule_id GROUP BY 1))""", f"{prefix}match")
    base.add(f"{prefix}four", f"""
        SELECT *, CASE WHEN len(active) > 0 THEN '{B2}' ELSE '{B3}' END AS selected_model, CASE WHEN len(active) > 0 THEN b2 ELSE b3 END AS b4
        FROM (SELECT *, list_filter(matched, lambda x: list_contains(chosen, x)) AS active FROM {prefix}match, (SELECT coalesce(list(rule_id), []) AS chosen FROM {prefix}act WHERE activated))""", f"{prefix}match", f"{prefix}act")


_safeguard_parts("s", "bwide")


@query("activate_rules", sql(f"SELECT rule_id, case_count, {rnd('mean_delta', 4)} AS mean_delta, {rnd('regression_rate')} AS regression_rate, activated, reasons FROM sact", "sact"))
def activate_rules(spark, sf_dir):
    return rounded(backtest.activate_rules(cases(spark, sf_dir), POLICY), mean_delta=4, regression_rate=6)


def safeguarded(spark, sf_dir, first_vintage=False):
    rows = cases(spark, sf_dir, first_vintage=first_vintage)
    active = cut(backtest.activate_rules(rows, POLICY))
    return rows, active, cut(backtest.safeguarded_model(rows, active, POLICY))


@query("safeguarded_model", sql(f"""
    SELECT case_id, split, array_to_string(matched, '|') AS matched, array_to_string(active, '|') AS active, selected_model, {rnd('b4', 4)} AS b4_bps, {rnd('b4 - b1', 4)} AS b4_minus_b1,
           {rnd('b4 - b2', 4)} AS b4_minus_b2, {rnd('b4 - b3', 4)} AS b4_minus_b3 FROM sfour""", "sfour"))
def safeguarded_model(spark, sf_dir):
    rows = safeguarded(spark, sf_dir)[2]
    out = rows.select("case_id", "split", F.array_join("matched", "|").alias("matched"), F.array_join("active", "|").alias("active"), "selected_model", "b4_bps", "b4_minus_b1", "b4_minus_b2", "b4_minus_b3")
    return rounded(out, b4_bps=4, b4_minus_b1=4, b4_minus_b2=4, b4_minus_b3=4)


_HOLD = ", ".join([f"{rnd(f'avg(b{i})', 4)} AS mean_b{i}" for i in (1, 2, 3, 4)] + [f"{rnd(f'avg(b4 - b{i})', 4)} AS mean_b4_minus_b{i}" for i in (1, 2, 3)]
                  + [f"{rnd(f'count(*) FILTER (WHERE round(b4 - b{i}, 8) < 0) / count(*)')} AS improvement_rate_b{i}, {rnd(f'count(*) FILTER (WHERE round(b4 - b{i}, 8) > 0) / count(*)')} AS regression_rate_b{i}" for i in (1, 3)])


@query("holdout_evaluation", sql(f"""
    SELECT m.*, CASE WHEN scope = 'ALL' THEN '' WHEN NOT activated THEN 'INACTIVE_FROM_DEVELOPMENT' WHEN split <> 'HOLDOUT' THEN '' WHEN mean_b4_minus_b3 < 0 THEN 'HOLDOUT_MEAN_IMPROVEMENT_VS_B3'
           WHEN mean_b4_minus_b3 > 0 THEN 'HOLDOUT_MEAN_REGRESSION_VS_B3' ELSE 'HOLDOUT_MEAN_TIE_VS_B3' END AS status
    FROM (SELECT split, scope, count(*) AS case_count, count(*) FILTER (WHERE selected_model = '{B2}') AS selected_b2, {_HOLD} FROM (SELECT *, unnest(list_concat(['ALL'], matched)) AS scope FROM sfour WHERE split IS NOT NULL) GROUP BY 1, 2) m
    LEFT JOIN sact ON rule_id = scope""", "sfour", "sact"))
def holdout_evaluation(spark, sf_dir):
    _, active, four = safeguarded(spark, sf_dir)
    rows = backtest.holdout_evaluation(four, active)
    places = {n: 4 for n in rows.columns if n.startswith("mean_")} | {n: 6 for n in rows.columns if "_rate_" in n}
    return rounded(rows, **places)
