"""First against final vintage: first values leave returned lines out."""

from __future__ import annotations

from pyspark.sql import functions as F

from kalends.catalog import backtest as cases_of
from kalends.catalog import base, query
from kalends.catalog.backtest import POLICY, _SPLIT, rounded
from kalends.catalog.base import rnd, sql
from kalends.plans import backtest, vintage
from kalends.session import cut
from kalends.sources import tables


def vintages(spark, sf_dir):
    """Final observations, first observations, calendar and weights, each written once."""
    final = cut(tables.observations(spark, sf_dir, by="region"))
    first = cut(tables.observations(spark, sf_dir, by="region", first_vintage=True))
    return final, first, cut(tables.release_calendar(final)), cut(tables.weights_of(final))


def first_panel(spark, sf_dir):
    final, first, calendar, weights = vintages(spark, sf_dir)
    return vintage.first_published_panel((first, tables.headline_of(first)), (final, tables.headline_of(final)), calendar, weights, cases_of.BASE_YEAR)


@query("publication_availability", sql(f"""
    SELECT economy, period, unit_price, strftime(release_date, '%Y-%m-%d') AS release_date, date_diff('day', last_day(CAST(period || '-01' AS DATE)), release_date)::INTEGER AS lag_days
    FROM rheadline JOIN calendar USING (period)""", "rheadline", "calendar"))
def publication_availability(spark, sf_dir):
    obs = cut(tables.observations(spark, sf_dir, by="region"))
    rows = vintage.publication_availability(tables.headline_of(obs), tables.release_calendar(obs))
    return rows.withColumn("release_date", F.date_format("release_date", "yyyy-MM-dd"))


def _base_year(source, keys):
    return f"SELECT s.*, unit_price / base_value AS relative FROM {source} s JOIN (SELECT {keys}, avg(unit_price) AS base_value FROM {source} WHERE period LIKE '1996-%' GROUP BY ALL HAVING count(*) = 12) USING ({keys})"


base.add("fpanel", f"""
    SELECT a.economy, a.category, a.period, a.relative AS first_relative, b.relative AS final_relative, (a.relative - b.relative) * 10000 AS revision_bps, w.weight
    FROM (SELECT economy, category, period, relative FROM ({_base_year('fobs', 'economy, category')}) UNION ALL SELECT economy, 'HEADLINE', period, relative FROM ({_base_year('fheadline', 'economy')})) a
    JOIN (SELECT economy, category, period, relative FROM ({_base_year('robs', 'economy, category')}) UNION ALL SELECT economy, 'HEADLINE', period, relative FROM ({_base_year('rheadline', 'economy')})) b USING (economy, category, period)
    JOIN (SELECT * FROM rweights UNION ALL SELECT economy, 'HEADLINE', sum(weight) FROM rweights GROUP BY 1) w USING (economy, category)""", "fobs", "fheadline", "robs", "rheadline", "rweights")


@query("first_published_panel", sql(f"""
    SELECT economy, category, period, strftime(release_date, '%Y-%m-%d') AS available_from, {rnd('first_relative', 8)} AS first_relative, {rnd('final_relative', 8)} AS final_relative, {rnd('revision_bps', 5)} AS revision_bps,
           {rnd('weight', 9)} AS weight FROM fpanel JOIN calendar USING (period)""", "fpanel", "calendar"))
def first_published_panel(spark, sf_dir):
    rows = rounded(first_panel(spark, sf_dir), first_relative=8, final_relative=8, revision_bps=5, weight=9)
    return rows.drop("economy_weight").withColumn("available_from", F.date_format("available_from", "yyyy-MM-dd"))


@query("first_published_index", sql(f"""
    SELECT period, {rnd("100 * avg(first_relative) FILTER (WHERE category = 'HEADLINE')")} AS equal_headline, {rnd("100 * sum(first_relative * weight) FILTER (WHERE category = 'HEADLINE')")} AS weighted_headline,
           {rnd("100 * sum(first_relative * weight) FILTER (WHERE category <> 'HEADLINE')")} AS category_index FROM fpanel GROUP BY 1""", "fpanel"))
def first_published_index(spark, sf_dir):
    return rounded(vintage.first_published_index(first_panel(spark, sf_dir)), equal_headline=6, weighted_headline=6, category_index=6)


@query("revision_summary", sql(f"""
    SELECT count(*) AS observations, count(*) FILTER (WHERE round(abs(revision_bps), 8) <> 0) AS revised, count(*) FILTER (WHERE round(abs(revision_bps), 8) = 0) AS unchanged, {rnd('avg(abs(revision_bps))', 5)} AS mean_revision,
           {rnd('max(abs(revision_bps))', 5)} AS max_revision, {rnd('quantile_disc(abs(revision_bps), 0.95)', 5)} AS p95_revision FROM fpanel""", "fpanel"))
def revision_summary(spark, sf_dir):
    return rounded(vintage.revision_summary(cut(first_panel(spark, sf_dir))), mean_revision=5, max_revision=5, p95_revision=5)


base.add("fwide", f"""
    SELECT case_id, scenario, masked_group, origin, target, horizon, economy, category, max(bps) FILTER (WHERE model = '{backtest.B0}') AS b0, max(bps) FILTER (WHERE model = '{backtest.B1}') AS b1, max(bps) FILTER (WHERE model = '{backtest.B2}') AS b2,
           max(bps) FILTER (WHERE model = '{backtest.B3}') AS b3 FROM fhcase GROUP BY ALL""", "fhcase")
cases_of._safeguard_parts("f", "fwide")
for _prefix, _cases in (("s", "bhcase"), ("f", "fhcase")):
    base.add(f"{_prefix}err", f"""
        SELECT case_id, scenario, origin, target, horizon, economy, category, model, bps FROM {_cases}
        UNION ALL SELECT case_id, scenario, origin, target, horizon, economy, category, '{backtest.B4}', b4 FROM {_prefix}four""", _cases, f"{_prefix}four")


def errors(spark, sf_dir, first_vintage):
    rows, _, four = cases_of.safeguarded(spark, sf_dir, first_vintage=first_vintage)
    return vintage.model_errors(rows, four)


@query("release_time_backtest", sql(f"""
    SELECT split, model, count(*) AS case_count, {rnd('avg(bps)', 4)} AS mean_bps, {rnd('quantile_disc(bps, 0.95)', 4)} AS p95_bps, {rnd('max(bps)', 4)} AS max_bps
    FROM (SELECT model, bps, {_SPLIT} AS split FROM ferr UNION ALL SELECT model, bps, 'ALL' FROM ferr) WHERE split IS NOT NULL GROUP BY 1, 2""", "ferr"))
def release_time_backtest(spark, sf_dir):
    rows = vintage.split_metrics(errors(spark, sf_dir, True), POLICY.split())
    return rounded(rows, mean_bps=4, p95_bps=4, max_bps=4)


@query("release_time_cases", sql(f"""
    SELECT case_id, model, {rnd('bps', 4)} AS bps, strftime(a.release_date, '%Y-%m-%d') AS origin_available_from, strftime(b.release_date, '%Y-%m-%d') AS as_of
    FROM ferr JOIN calendar a ON a.period = origin JOIN calendar b ON b.period = target""", "ferr", "calendar"))
def release_time_cases(spark, sf_dir):
    calendar = tables.release_calendar(cut(tables.observations(spark, sf_dir, by="region")))
    rows = vintage.release_time_cases(errors(spark, sf_dir, True), calendar)
    day = lambda name: F.date_format(name, "yyyy-MM-dd").alias(name)
    return rounded(rows, bps=4).select("case_id", "model", "bps", day("origin_available_from"), day("as_of"))


base.add("vsens", "\nUNION ALL ".join(f"""
    SELECT model, '{name}' AS dimension, {label} AS label, count(*) AS case_count, avg(a) AS first_mean, avg(b) AS final_mean, avg(a - b) AS mean_delta, quantile_disc(a, 0.95) AS first_p95, quantile_disc(b, 0.95) AS final_p95,
           count(*) FILTER (WHERE round(a - b, 8) < 0) / count(*) AS first_better_rate, count(*) FILTER (WHERE round(a - b, 8) > 0) / count(*) AS first_worse_rate
    FROM (SELECT f.*, f.bps AS a, s.bps AS b FROM ferr f JOIN serr s USING (case_id, model)) WHERE {label} <> '' GROUP BY 1, 2, 3"""
    for name, label in (("overall", "'ALL'"), ("scenario", "scenario"), ("horizon", "CAST(horizon AS VARCHAR)"), ("economy", "economy"), ("category", "category"))), "ferr", "serr")


def sensitivity(spark, sf_dir):
    return vintage.vintage_sensitivity(errors(spark, sf_dir, True), errors(spark, sf_dir, False))


@query("vintage_sensitivity", sql(f"""
    SELECT model, dimension, label, case_count, {rnd('first_mean', 4)} AS first_mean, {rnd('final_mean', 4)} AS final_mean, {rnd('mean_delta', 4)} AS mean_delta, {rnd('first_p95', 4)} AS first_p95, {rnd('final_p95', 4)} AS final_p95,
           {rnd('first_better_rate')} AS first_better_rate, {rnd('first_worse_rate')} AS first_worse_rate FROM vsens""", "vsens"))
def vintage_sensitivity(spark, sf_dir):
    return rounded(sensitivity(spark, sf_dir), first_mean=4, final_mean=4, mean_delta=4, first_p95=4, final_p95=4, first_better_rate=6, first_worse_rate=6)


@query("vintage_ranking", sql("""
    SELECT model, first_position, final_position, final_position - first_position AS position_change FROM (SELECT model, row_number() OVER (ORDER BY first_mean, model)::INTEGER AS first_position,
           row_number() OVER (ORDER BY final_mean, model)::INTEGER AS final_position FROM vsens WHERE dimension = 'overall')""", "vsens"))
def vintage_ranking(spark, sf_dir):
    return vintage.vintage_ranking(sensitivity(spark, sf_dir))
