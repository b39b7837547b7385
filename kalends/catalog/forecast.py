"""Forecasts of first-published values before their release."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import base, query
from kalends.catalog.backtest import rounded
from kalends.catalog.base import rnd, sql
from kalends.functions.months import temporal_split
from kalends.operators import aggregates
from kalends.plans import forecast
from kalends.plans.forecast import P0, P1, P2, P3, P4
from kalends.session import cut
from kalends.sources import tables

HORIZONS, WINDOW, BASE_YEAR = (1, 3, 6, 12), ("1998-01", "2000-12"), 1996
DEVELOPMENT, HOLDOUT = ("1998-01", "1998-12"), ("1999-01", "2000-12")
_SPLIT = f"CASE WHEN target BETWEEN '{DEVELOPMENT[0]}' AND '{DEVELOPMENT[1]}' THEN 'DEVELOPMENT' ELSE 'HOLDOUT' END"
_BACK = lambda name: f"strftime(CAST({name} || '-01' AS DATE) - INTERVAL 12 MONTH, '%Y-%m')"

base.add("fpairs", f"""
    SELECT m.* FROM pairs_months m JOIN calendar a ON a.period = m.origin JOIN calendar b ON b.period = m.target
    WHERE a.release_date < b.release_date AND {_BACK('m.target')} <= m.origin AND {_BACK('m.target')} IN (SELECT period FROM fvcells) AND {_BACK('m.origin')} IN (SELECT period FROM fvcells)""", "pairs_months", "calendar", "fvcells")
base.add("fc", f"""
    SELECT origin, target, horizon, economy, category, weight, truth, m.model AS model, m.f AS forecast, m.s AS source_periods FROM (SELECT *, unnest([struct_pack(model := '{P2}', f := now, s := origin), struct_pack(model := '{P3}', f := seasonal, s := three),
           struct_pack(model := '{P4}', f := 0.5 * now + 0.5 * seasonal, s := three)]) AS m
      FROM (SELECT p.*, o.economy, o.category, o.weight, o.price_relative AS now, t.price_relative AS truth, s.price_relative * (o.price_relative / y.price_relative) AS seasonal,
                   array_to_string(list_sort(list_distinct([p.origin, {_BACK('p.target')}, {_BACK('p.origin')}])), '|') AS three
            FROM fpairs p JOIN fvcells o ON o.period = p.origin JOIN fvcells t ON t.period = p.target AND t.economy = o.economy AND t.category = o.category
            JOIN fvcells s ON s.period = {_BACK('p.target')} AND s.economy = o.economy AND s.category = o.category JOIN fvcells y ON y.period = {_BACK('p.origin')} AND y.economy = o.economy AND y.category = o.category))""", "fpairs", "fvcells")
base.add("frel", """
    SELECT economy, period, 100 * unit_price / base_value AS value FROM fheadline JOIN (SELECT economy, avg(unit_price) AS base_value FROM fheadline WHERE period LIKE '1996-%' GROUP BY 1 HAVING count(*) = 12) USING (economy)""", "fheadline")
base.add("fe", f"""
    SELECT origin, target, horizon, economy, model, sum(weight * forecast) / sum(weight) AS forecast, sum(weight * truth) / sum(weight) AS truth FROM fc GROUP BY ALL
    UNION ALL SELECT p.origin, p.target, p.horizon, h.economy, '{P1}', h.value, t.truth FROM fpairs p JOIN frel h ON h.period = p.origin
      JOIN (SELECT target, economy, origin, horizon, sum(weight * truth) / sum(weight) AS truth FROM fc WHERE model = '{P2}' GROUP BY ALL) t ON t.origin = p.origin AND t.target = p.target AND t.horizon = p.horizon AND t.economy = h.economy""", "fc", "fpairs", "frel")
base.add("fg", f"""
    SELECT *, (forecast / truth - 1) * 10000 AS signed_bps, abs(forecast / truth - 1) * 10000 AS bps, {_SPLIT} AS split FROM (
      SELECT origin, target, horizon, model, sum(weight * forecast) AS forecast, sum(weight * truth) AS truth, any_value(source_periods) AS source_periods FROM fc GROUP BY 1, 2, 3, 4
      UNION ALL SELECT p.origin, p.target, p.horizon, m.model, m.f, t.truth, p.origin FROM fpairs p JOIN (SELECT period, unnest([struct_pack(model := '{P0}', f := avg(value)), struct_pack(model := '{P1}', f := sum(value * w))]) AS m FROM frel
        JOIN (SELECT economy, sum(weight) AS w FROM rweights GROUP BY 1) USING (economy) GROUP BY period) l ON l.period = p.origin
      JOIN (SELECT origin, target, sum(weight * truth) AS truth FROM fc WHERE model = '{P2}' GROUP BY 1, 2) t ON t.origin = p.origin AND t.target = p.target)""", "fc", "fpairs", "frel", "rweights")


def inputs(spark, sf_dir):
    """Cell forecasts, weights, headline relatives and pairs; each written once."""
    final = cut(tables.observations(spark, sf_dir, by="region"))
    first = cut(tables.observations(spark, sf_dir, by="region", first_vintage=True))
    panel = cut(aggregates.annual_base_relatives(first, BASE_YEAR, ["economy", "category"]).select("economy", "category", "period", (100 * F.col("relative")).alias("value")))
    headline = cut(aggregates.annual_base_relatives(tables.headline_of(first), BASE_YEAR, ["economy"]).select("economy", "period", (100 * F.col("relative")).alias("value")))
    pairs = cut(forecast.forecast_pairs(panel, tables.release_calendar(final), HORIZONS, WINDOW))
    return cut(forecast.forecast_cells(panel, pairs)), cut(tables.weights_of(final)), headline, pairs


def with_split(df):
    return df.withColumn("split", temporal_split(F.col("target"), DEVELOPMENT, HOLDOUT))


def global_cases(spark, sf_dir):
    return cut(with_split(forecast.forecast_global(*inputs(spark, sf_dir))))


@query("forecast_cells", sql(f"""
    SELECT origin, target, horizon, economy, category, model, {rnd('forecast')} AS forecast, {rnd('truth')} AS truth, {rnd('abs(forecast / truth - 1) * 10000', 4)} AS bps, source_periods FROM fc""", "fc"))
def forecast_cells(spark, sf_dir):
    rows = inputs(spark, sf_dir)[0]
    return rounded(rows, forecast=6, truth=6, bps=4).withColumn("source_periods", F.array_join("source_periods", "|"))


@query("forecast_economies", sql(f"""
    SELECT origin, target, horizon, economy, model, {rnd('forecast')} AS forecast, {rnd('truth')} AS truth, {rnd('abs(forecast / truth - 1) * 10000', 4)} AS bps FROM fe""", "fe"))
def forecast_economies(spark, sf_dir):
    return rounded(forecast.forecast_economies(*inputs(spark, sf_dir)), forecast=6, truth=6, bps=4)


@query("forecast_global", sql(f"""
    SELECT origin, target, horizon, model, {rnd('forecast')} AS forecast, {rnd('truth')} AS truth, {rnd('signed_bps', 4)} AS signed_bps, {rnd('bps', 4)} AS bps, CASE WHEN model IN ('{P0}', '{P1}') THEN origin ELSE source_periods END AS source_periods, split FROM fg""", "fg"))
def forecast_global(spark, sf_dir):
    return rounded(global_cases(spark, sf_dir), forecast=6, truth=6, signed_bps=4, bps=4)


_ALL = "SELECT unnest([split, 'ALL']) AS split, horizon, {0} FROM {1}"
base.add("fgm", """
    SELECT split, horizon, model, count(*) AS case_count, avg(bps) AS mean_bps, quantile_disc(bps, 0.95) AS p95_bps, max(bps) AS max_bps, avg(signed_bps) AS mean_signed_bps
    FROM (SELECT split, unnest([CAST(horizon AS VARCHAR), 'ALL']) AS horizon, model, bps, signed_bps FROM (SELECT unnest([split, 'ALL']) AS split, horizon, model, bps, signed_bps FROM fg)) GROUP BY 1, 2, 3""", "fg")
_METRICS = f"case_count, {rnd('mean_bps', 4)} AS mean_bps, {rnd('p95_bps', 4)} AS p95_bps, {rnd('max_bps', 4)} AS max_bps"


def global_metrics(spark, sf_dir):
    return forecast.forecast_metrics(global_cases(spark, sf_dir), forecast.SPLIT_SCOPES, ["model"], signed=True)


@query("forecast_metrics", sql(f"SELECT split, horizon, model, {_METRICS}, {rnd('mean_signed_bps', 4)} AS mean_signed_bps FROM fgm", "fgm"))
def forecast_metrics(spark, sf_dir):
    return rounded(global_metrics(spark, sf_dir), mean_bps=4, p95_bps=4, max_bps=4, mean_signed_bps=4)


def _slice_sql(name, source):
    return f"""SELECT split, {name}, model, count(*) AS case_count, avg(bps) AS mean_bps, quantile_disc(bps, 0.95) AS p95_bps, max(bps) AS max_bps
        FROM (SELECT unnest([{_SPLIT}, 'ALL']) AS split, {name}, model, abs(forecast / truth - 1) * 10000 AS bps FROM {source}) GROUP BY 1, 2, 3"""


base.add("fem", _slice_sql("economy", "fe"), "fe")
base.add("fcm", _slice_sql("category", "fc"), "fc")


def economy_metrics(spark, sf_dir):
    return forecast.forecast_metrics(with_split(forecast.forecast_economies(*inputs(spark, sf_dir))), ((), ("split",)), ["economy", "model"])


def category_metrics(spark, sf_dir):
    return forecast.forecast_metrics(with_split(inputs(spark, sf_dir)[0]), ((), ("split",)), ["category", "model"])


@query("forecast_metrics_by_economy", sql(f"SELECT split, economy, model, {_METRICS} FROM fem", "fem"))
def forecast_metrics_by_economy(spark, sf_dir):
    return rounded(economy_metrics(spark, sf_dir), mean_bps=4, p95_bps=4, max_bps=4)


@query("forecast_metrics_by_category", sql(f"SELECT split, category, model, {_METRICS} FROM fcm", "fcm"))
def forecast_metrics_by_category(spark, sf_dir):
    return rounded(category_metrics(spark, sf_dir), mean_bps=4, p95_bps=4, max_bps=4)


_PAIR_LIST = ", ".join(f"('{a}', '{b}')" for a, b in forecast.PAIRS)


@query("forecast_paired", sql(f"""
    SELECT split, horizon, challenger, baseline, count(*) AS case_count, {rnd('avg(d)', 4)} AS mean_delta, {rnd('quantile_cont(d, 0.5)', 4)} AS median_delta, {rnd('quantile_disc(d, 0.95)', 4)} AS p95_delta, {rnd('max(d)', 4)} AS worst_regression,
           {rnd('min(d)', 4)} AS best_improvement, {rnd('avg(sd)', 4)} AS mean_signed_delta, {rnd('count(*) FILTER (WHERE round(d, 8) < 0) / count(*)')} AS improvement_rate, {rnd('count(*) FILTER (WHERE round(d, 8) > 0) / count(*)')} AS regression_rate,
           {rnd('count(*) FILTER (WHERE round(d, 8) = 0) / count(*)')} AS tie_rate
    FROM (SELECT unnest([split, 'ALL']) AS split, horizon, challenger, baseline, d, sd FROM (SELECT a.split, unnest([CAST(a.horizon AS VARCHAR), 'ALL']) AS horizon, challenger, baseline, a.bps - b.bps AS d, a.signed_bps - b.signed_bps AS sd
      FROM (VALUES {_PAIR_LIST}) v(challenger, baseline) JOIN fg a ON a.model = challenger JOIN fg b ON b.model = baseline AND b.origin = a.origin AND b.target = a.target)) GROUP BY 1, 2, 3, 4""", "fg"))
def forecast_paired(spark, sf_dir):
    rows = forecast.forecast_paired(global_cases(spark, sf_dir))
    return rounded(rows, mean_delta=4, median_delta=4, p95_delta=4, worst_regression=4, best_improvement=4, mean_signed_delta=4, improvement_rate=6, regression_rate=6, tie_rate=6)


base.add("frank", "SELECT *, row_number() OVER (PARTITION BY split, horizon ORDER BY mean_bps, p95_bps, model)::INTEGER AS rank FROM fgm", "fgm")


@query("model_ranking", sql(f"SELECT split, horizon, rank, model, {_METRICS} FROM frank", "frank"))
def model_ranking(spark, sf_dir):
    rows = forecast.model_ranking(global_metrics(spark, sf_dir))
    return rounded(rows, mean_bps=4, p95_bps=4, max_bps=4).select("split", "horizon", "rank", "model", "case_count", "mean_bps", "p95_bps", "max_bps")


@query("ranking_stability", sql("""
    SELECT horizon, d AS development_ranking, h AS holdout_ranking, d <> h AS ranking_changed, split_part(d, '|', 1) <> split_part(h, '|', 1) AS winner_changed
    FROM (SELECT horizon, string_agg(model, '|' ORDER BY rank) FILTER (WHERE split = 'DEVELOPMENT') AS d, string_agg(model, '|' ORDER BY rank) FILTER (WHERE split = 'HOLDOUT') AS h FROM frank GROUP BY 1)""", "frank"))
def ranking_stability(spark, sf_dir):
    return forecast.ranking_stability(cut(forecast.model_ranking(global_metrics(spark, sf_dir))))


@query("focus_ranking", sql(f"""
    SELECT focus, row_number() OVER (PARTITION BY focus ORDER BY mean_bps, p95_bps, model)::INTEGER AS rank, model, {_METRICS} FROM (
      SELECT 'EUROPE' AS focus, model, case_count, mean_bps AS mean_bps, p95_bps, max_bps FROM fem WHERE split = 'HOLDOUT' AND economy = 'EUROPE'
      UNION ALL SELECT 'PROMO', model, case_count, mean_bps, p95_bps, max_bps FROM fcm WHERE split = 'HOLDOUT' AND category = 'PROMO'
      UNION ALL SELECT 'TWELVE_MONTHS', model, case_count, mean_bps, p95_bps, max_bps FROM fgm WHERE split = 'HOLDOUT' AND horizon = '12') q""", "fem", "fcm", "fgm"))
def focus_ranking(spark, sf_dir):
    rows = forecast.focus_ranking((
        ("EUROPE", economy_metrics(spark, sf_dir).filter("economy = 'EUROPE'")), ("PROMO", category_metrics(spark, sf_dir).filter("category = 'PROMO'")),
        ("TWELVE_MONTHS", global_metrics(spark, sf_dir).filter("horizon = '12'"))))
    return rounded(rows, mean_bps=4, p95_bps=4, max_bps=4)
