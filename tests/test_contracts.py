"""Pipelines stop at bad tables, incomplete months stay visible, texts fold whatever their range."""

import json
import random

import pytest
from pyspark.sql import functions as F

from kalends.functions import classes, text
from kalends.operators import aggregates, checks, ranks, windows
from kalends.plans import audit, backtest, completion, index, weights
from kalends.sources import ingest


def values(spark, texts, function):
    df = spark.createDataFrame(list(enumerate(texts)), "k int, t string")
    return [r.v for r in df.select("k", function(F.col("t")).alias("v")).orderBy("k").collect()]


def test_names_fold_over_the_whole_code_range(spark):
    given = ["Ⅳ quarter", "½ share", "⑩ items", "㎡ area", "𝐀𝐁", "ŀl", "ＦＵＬＬ wíde", None, ""]
    assert values(spark, given, text.normalize_name) == ["iv quarter", "1 2 share", "10 items", "m2 area", "ab", "l l", "full wide", None, ""]


def test_references_are_read_once(spark):
    given = ["&#150;", "&#0;", "&copy 2020", "&#38;amp; and &amp;lt;", "&unknown; &", None]
    assert values(spark, given, text.unescape) == ["–", "�", "© 2020", "&amp; and &lt;", "&unknown; &", None]


def test_signatures_look_at_whole_bodies(spark):
    rows = [(1, ".html", "text/html", "", "x" * 5000 + "<p>"), (2, ".json", "", "", " \n" * 2000 + "[1]"), (3, ".html", "", "", "none"), (4, ".json", "", "", "x{")]
    docs = spark.createDataFrame(rows, "doc_id int, suffix string, content_type string, expected_type string, body string")
    assert {r.doc_id: r.reason for r in audit.content_signature(docs).collect()} == {1: "", 2: "", 3: "INVALID_HTML_SIGNATURE", 4: "INVALID_JSON_SIGNATURE"}


def test_rule_tables_can_be_replaced(spark):
    assert values(spark, ["PPP", "Expenditure, real", "x", None], classes.measure_kind) == ["PPP", "REAL_EXPENDITURE", "OTHER", "OTHER"]
    own = (classes.Rule("MINE", some=(classes.Test("label", "word", ("x",)),)),)
    assert values(spark, ["PPP", "a x b", "xx"], lambda c: classes.measure_kind(c, own)) == ["OTHER", "MINE", "OTHER"]


def test_sensitivity_scenarios_stay_consistent():
    found = completion.sensitivity_policies(completion.Policy(minimum_region_donors=1, minimum_world_donors=12, maximum_donors=12))
    assert set(found) == {"BASELINE", "REGION_DONORS_PLUS_ONE", "WORLD_DONORS_MINUS_ONE", "WORLD_DONORS_PLUS_ONE"}
    assert found["WORLD_DONORS_PLUS_ONE"].maximum_donors == 13
    assert completion.sensitivity_policies(completion.Policy())["MAX_DONORS_REDUCED"].maximum_donors == 10


SERIES = "series_id string, economy string, target_categories array<string>, evidence_class string, source_priority int, enabled boolean"


def test_rebasing_stops_at_bad_tables(spark):
    series = spark.createDataFrame([("a", "E", ["x"], "P1", 1, True)], SERIES)
    obs = [("a", "2020-01", 2.0), ("a", "2020-02", 3.0)]
    make = lambda rows: spark.createDataFrame(rows, "series_id string, period string, value double")
    assert {r.price_relative for r in index.normalize_prices(series, make(obs), "2020-01").collect()} == {100.0, 150.0}
    for rows, reason in ((obs + obs[:1], "repeated series-months"), ([*obs, ("b", "2020-01", 1.0)], "unknown series")):
        with pytest.raises(Exception, match=reason):
            index.normalize_prices(series, make(rows), "2020-01").collect()
    with pytest.raises(Exception, match="repeated series definitions"):
        index.normalize_prices(series.unionAll(series), make(obs), "2020-01").collect()
    off = series.withColumn("enabled", F.lit(False))
    assert index.normalize_prices(off, make(obs), "2020-01").collect() == []
    with pytest.raises(Exception, match="unknown series"):
        index.normalize_prices(off, make([("b", "2020-01", 1.0)]), "2020-01").count()


def test_separation_stops_at_bad_tables(spark):
    cells = spark.createDataFrame([("E", "x", p, 1.0, 100.0) for p in ("2020-01", "2020-02")], "economy string, category string, period string, weight double, price_relative double")
    held = spark.createDataFrame([("E", "USD", "2020-01", "")], "economy string, currency string, effective_from string, effective_to string")
    rates = [("USD", "2020-01", 1.1, 1.0), ("USD", "2020-02", 1.2, 1.0)]
    make = lambda rows: spark.createDataFrame(rows, "currency string, period string, rate double, redenomination double")
    assert {r.status for r in index.fx_separation(cells, held, make(rates), "2020-01")["index"].collect()} == {"COMPLETE"}
    second = spark.createDataFrame([("E", "EUR", "2020-02", "")], held.schema)
    for c, h, f, reason in (
        (cells.unionAll(cells), held, make(rates), "repeated cells"), (cells, held, make([*rates, rates[0]]), "repeated exchange rates"),
        (cells, held, make([rates[0], ("USD", "2020-02", -1.0, 1.0)]), "not positive"), (cells, held.unionAll(second), make(rates), "overlapping")):
        with pytest.raises(Exception, match=reason):
            index.fx_separation(c, h, f, "2020-01")["index"].collect()


def test_separation_needs_one_universe_basis_and_convention(spark):
    schema = "economy string, category string, period string, weight double, price_relative double"
    whole = [(e, "x", p, 0.5, 100.0) for e in ("A", "B") for p in ("2020-01", "2020-02")]
    held = spark.createDataFrame([("A", "USD", "2020-01", ""), ("B", "EUR", "2020-01", "")], "economy string, currency string, effective_from string, effective_to string")
    fx = spark.createDataFrame([("USD", p, 1.1, 1.0) for p in ("2020-01", "2020-02")], "currency string, period string, rate double, redenomination double")
    run = lambda rows, rates=fx, reference="2020-01", **more: index.fx_separation(
        spark.createDataFrame(rows, schema).withColumns(more), held, rates, reference)["index"].collect()
    assert {r.status for r in run(whole)} == {"COMPLETE"}
    assert {r.status for r in run(whole, fx.withColumn("convention", F.lit(index.RATE_CONVENTION)), price_basis=F.lit(index.PRICE_BASIS))} == {"COMPLETE"}
    unpublished = fx.withColumn("rate", F.when(F.col("period") == "2020-01", F.col("rate")))
    assert {(r.period, r.status, r.common_index) for r in run(whole, unpublished)} == {("2020-01", "COMPLETE", 100.0), ("2020-02", "INCOMPLETE_FX", None)}
    for rows, reason in ((whole[:-1], "months with holes"), ([*whole, ("C", "x", "2020-02", 0.1, 1.0)], "cells without a weight"), ([*whole[:3], (*whole[3][:3], 0.4, 100.0)], "weights that change"),
                         ([(*r[:3], 0.4, 100.0) for r in whole], "sum up to 1"), (whole[1:2] + whole[3:], "cells without a weight")):
        with pytest.raises(Exception, match=reason):
            run(rows)
    with pytest.raises(Exception, match="another convention"):
        run(whole, fx.withColumn("convention", F.lit("EUR_PER_CURRENCY")))
    with pytest.raises(Exception, match="converted twice"):
        run(whole, price_basis=F.lit("COMMON_CURRENCY_RELATIVE"))


def test_separation_keeps_months_with_holes_of_a_given_universe(spark):
    schema = "economy string, category string, period string, weight double, price_relative double"
    cells = [("A", "x", "2020-01", 0.75, 100.0), ("B", "x", "2020-01", 0.25, 100.0), ("A", "x", "2020-02", 0.75, 120.0)]
    universe = spark.createDataFrame([("A", "x", 0.75), ("B", "x", 0.25)], "economy string, category string, weight double")
    held = spark.createDataFrame([(e, "EUR", "2020-01", "") for e in "AB"], "economy string, currency string, effective_from string, effective_to string")
    fx = spark.createDataFrame([], "currency string, period string, rate double, redenomination double")
    run = lambda rows, u=universe: index.fx_separation(spark.createDataFrame(rows, schema), held, fx, "2020-01", u)["index"].collect()
    got = {r.period: (r.status, r.local_index, r.common_index, r.missing_weight) for r in run(cells)}
    assert got == {"2020-01": ("COMPLETE", 100.0, 100.0, 0.0), "2020-02": ("INCOMPLETE_FX", 90.0, None, 0.25)}
    for rows, reason in (([*cells, cells[0]], "repeated cells"), ([*cells, ("C", "x", "2020-02", 0.1, 1.0)], "cells without a weight"), ([*cells[:2], (*cells[2][:3], 0.7, 1.0)], "weights that change")):
        with pytest.raises(Exception, match=reason):
            run(rows)
    with pytest.raises(Exception, match="sum up to 1"):
        run(cells[:1], universe.limit(1))


def test_a_partial_last_month_has_no_value(spark):
    rows = [("I", p, "E", c, 0.5, v, "P1_OFFICIAL_CATEGORY") for p, c, v in (("2020-01", "x", 100.0), ("2020-01", "y", 100.0), ("2020-02", "x", 110.0), ("2020-02", "y", None))]
    grid = spark.createDataFrame(rows, "index_id string, period string, economy string, category string, weight double, price_relative double, evidence_class string")
    got = {r.period: (r.status, r.value) for r in aggregates.fixed_weight_index(grid, ("index_id", "period")).select("period", "status", "value").collect()}
    assert got["2020-01"] == ("COMPLETE", 100.0) and got["2020-02"] == ("INCOMPLETE", None)


def test_cycles_between_cycles_are_told_apart(spark):
    # two cycles, a bridge between them that lies on none, a loop of one and a long open chain
    links = {"a": ["b"], "b": ["a", "m"], "m": ["n"], "n": ["x"], "x": ["y"], "y": ["z"], "z": ["x"], "s": ["s", "a"], **{f"c{k}": [f"c{k + 1}"] for k in range(8)}}
    df = spark.createDataFrame(list(links.items()), "series_id string, fallback_series array<string>")
    assert sorted(r.series_id for r in checks.fallback_cycles(df).collect()) == ["a", "b", "s", "x", "y", "z"]
    assert checks.fallback_cycles(df.limit(0)).count() == 0


def on_cycles(links):
    """Brute force: nodes that reach themselves."""
    def reached(start):
        seen, todo = set(), list(links.get(start, ()))
        while todo:
            if (x := todo.pop()) not in seen:
                seen.add(x)
                todo += links.get(x, ())
        return seen
    return sorted(x for x in links if x in reached(x))


@pytest.mark.parametrize("seed", (0, 3))
def test_cycles_equal_brute_force(spark, seed):
    rng = random.Random(seed)
    n = 40
    links = {f"s{k}": sorted({f"s{rng.randrange(n + 5)}" for _ in range(rng.choice((0, 1, 1, 1, 2, 3) if seed < 3 else (2, 3)))}) for k in range(n)}
    df = spark.createDataFrame(list(links.items()), "series_id string, fallback_series array<string>")
    assert sorted(r.series_id for r in checks.fallback_cycles(df).collect()) == on_cycles(links)


def test_long_cycle_takes_few_rounds(spark, monkeypatch):
    calls = []
    monkeypatch.setattr(checks, "written", lambda df, kept=checks.written: calls.append(1) or kept(df))
    n = 1000
    links = {f"s{k}": [f"s{(k + 1) % n}"] for k in range(n)} | {f"t{k}": [f"t{k + 1}"] for k in range(n)}  # a circle and an open chain
    df = spark.createDataFrame(list(links.items()), "series_id string, fallback_series array<string>")
    assert sorted(r.series_id for r in checks.fallback_cycles(df).collect()) == sorted(f"s{k}" for k in range(n))
    assert len(calls) <= 25


def test_overlaps_name_their_partner(spark):
    spans = spark.createDataFrame([("A", "X", "2020-01", "2020-12"), ("A", "Y", "2020-02", "2020-03"), ("A", "Z", "2020-06", "")], "economy string, currency string, effective_from string, effective_to string")
    assert [(r.currency, r.earlier_currency) for r in checks.interval_overlaps(spans).orderBy("currency").collect()] == [("Y", "X"), ("Z", "X")]


def test_gate_reads_how_the_validation_was_made(spark):
    shares = spark.createDataFrame([(0.1, 0.0, 1.0)], "estimated_share double, class_e_share double, metric_coverage double")
    make = lambda *facts: spark.createDataFrame([(20, 200, 0.1, 0.9, *facts)], "economies int, predictions int, mape double, coverage double, leave_one_out boolean, result_driven_donor_selection boolean, monetary_release_allowed boolean")
    limits = {"estimated_share": 0.2, "class_e_share": 0.05, "metric_coverage": 1.0, "economies": 10, "predictions": 100, "mape": 0.3, "coverage": 0.8}
    grid = spark.createDataFrame([(False,)], "hole boolean")
    passed = lambda *facts: {r.check for r in weights.weight_release_gate(shares, make(*facts), grid, limits).collect() if not r.passed}
    assert passed(True, False, False) == set()
    assert passed(False, True, None) == {"leave_one_out_validation", "result_driven_donor_selection_disabled", "validation_monetary_release_blocked"}


def test_aggregates_by_code_or_name(spark):
    wide = spark.createDataFrame([("Q", "h", 1.0)], "economy string, heading string, ppp double")
    registry = spark.createDataFrame([("A1", False), ("world total", False), ("Q", False), ("P", True)], "economy string, participating boolean")
    got = {r.economy: r.status for r in weights.entity_status(wide, registry, ("world",), ("h",), ("d",), ("A1",)).collect()}
    assert got == {"A1": "AGGREGATE", "world total": "AGGREGATE", "Q": "OFFICIALLY_IMPUTED_AGGREGATE_ONLY", "P": "PARTICIPATING"}


def test_order_statistics_split_heavy_keys(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = spark.range(4000).select(F.lit("hot").alias("k"), (F.col("id") % 1000).cast("double").alias("v"), F.lit(1.0).alias("w"))
        found = ranks.weighted_quantile(df, ["k"], "v", "w", {"q": 0.25, "m": 0.5})
        plan = found._jdf.queryExecution().executedPlan().toString()
        assert [(r.q, r.m) for r in found.collect()] == [(249.0, 499.0)]
        assert "_salt" in plan
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_leave_out_factors_keep_columns_and_reject_unknown_scenarios(spark):
    df = spark.createDataFrame([("o", "t", "A", "x", 1.0, 0.5, 7), ("o", "t", "A", "y", 2.0, 0.5, 8)], "origin string, target string, economy string, category string, factor double, weight double, extra int")
    rows = {(r.category, r.scenario): (r.extra, r.global_equal, r.category_weighted) for r in windows.leave_out_factors(df, ("SINGLE_CELL", "ECONOMY_OUTAGE")).collect()}
    assert rows == {("x", "SINGLE_CELL"): (7, 2.0, None), ("y", "SINGLE_CELL"): (8, 1.0, None), ("x", "ECONOMY_OUTAGE"): (7, None, None), ("y", "ECONOMY_OUTAGE"): (8, None, None)}
    with pytest.raises(ValueError, match="unknown scenario"):
        windows.leave_out_factors(df, "NONE")


def test_selection_stops_at_repeated_candidates(spark):
    rows = [("s", "E", "x", "2020-01", 100.0, "P1_OFFICIAL_CATEGORY", 1)]
    make = lambda r: spark.createDataFrame(r, "series_id string, economy string, category string, period string, price_relative double, evidence_class string, source_priority int")
    assert windows.select_best_price(make(rows)).count() == 1
    with pytest.raises(Exception, match="repeated candidates"):
        windows.select_best_price(make(rows * 2)).collect()


def test_rebasing_keeps_provenance(spark):
    series = spark.createDataFrame([("a", "E", ["x"], "P1", 1, True)], SERIES)
    obs = spark.createDataFrame([("a", "2020-01", 2.0, "office"), ("a", "2020-02", 3.0, "bureau")], "series_id string, period string, value double, provider string")
    assert {(r.period, r.provider) for r in index.normalize_prices(series, obs, "2020-01").collect()} == {("2020-01", "office"), ("2020-02", "bureau")}


def test_completion_backtest_and_imputation_stop_at_bad_tables(spark):
    levels = spark.createDataFrame([("A", "x", "2020-01", 1.0, "P1")], "economy string, category string, period string, level double, evidence_class string")
    headline = spark.createDataFrame([("A", "2020-01", 1.0)], "economy string, period string, level double")
    profiles = spark.createDataFrame([("A", "r")], "economy string, region string")
    none = spark.createDataFrame([], "economy string, category string, weight double")
    bad = levels.withColumn("level", F.lit(-1.0))
    for lv, hd, pf, cats, reason in (
        (levels.unionAll(levels), headline, profiles, ["x"], "repeated cells"), (levels, headline.unionAll(headline), profiles, ["x"], "repeated headline"),
        (levels, headline, profiles.unionAll(profiles), ["x"], "repeated profiles"), (bad, headline, profiles, ["x"], "not positive"), (levels, headline, profiles, ["y"], "unknown category")):
        with pytest.raises(Exception, match=reason):
            completion.predict_rates(lv, hd, pf, none, cats, {"S": completion.Policy()}).collect()
    panel = spark.createDataFrame([("A", "x", "2020-01", 100.0), ("B", "x", "2020-01", 100.0)], "economy string, category string, period string, price_relative double")
    weight = lambda *rows: spark.createDataFrame(rows, "economy string, category string, weight double")
    for pn, wt, reason in (
        (panel.unionAll(panel), weight(("A", "x", 0.5), ("B", "x", 0.5)), "repeated cells"), (panel, weight(("A", "x", 0.5), ("B", "x", 0.4)), "sum up to 1"),
        (panel, weight(("A", "x", 1.5), ("B", "x", -0.5)), "not positive"), (panel, weight(("A", "x", 1.0)), "cells without a weight")):
        with pytest.raises(Exception, match=reason):
            backtest.completion_backtest(pn, wt, (1,), ("2020-01", "2020-12")).collect()
    cells = spark.createDataFrame([("A", "x", 1.0, 0.5, 2.0, "A_X")], "economy string, category string, central double, lower double, upper double, evidence_class string")
    policy = weights.ImputationPolicy(("x",))
    for cl, pf, reason in ((cells.unionAll(cells), profiles, "repeated cells"), (cells, profiles.unionAll(profiles), "repeated profiles"), (cells.withColumn("lower", F.lit(1.5)), profiles, "bounds")):
        with pytest.raises(Exception, match=reason):
            weights.impute_grid(cl, pf, None, policy).collect()


def test_cubes_carry_flags_and_broken_ones_raise(spark):
    cube = {"id": ["geo", "time"], "size": [2, 2], "dimension": {"geo": {"category": {"index": ["A", "B"]}}, "time": {"category": {"index": {"2020-02": 1, "2020-01": 0}}}}, "value": [1.0, None, 3.0, 4.0]}
    read = lambda c, **more: ingest.flatten_cube(spark.createDataFrame([(json.dumps(c) if isinstance(c, dict) else c,)], "body string"), ("geo", "time"), **more).collect()
    for status, want in ((["p", "", "", "e"], {"p", "", "e"}), ({"0": "p", "3": "e"}, {"p", "", "e"}), (None, {""})):
        rows = read(cube | ({"status": status} if status else {}))
        assert {(r.geo, r.time, r.value) for r in rows} == {("A", "2020-01", 1.0), ("B", "2020-01", 3.0), ("B", "2020-02", 4.0)} and {r.status for r in rows} == want
    broken = [cube | {"size": [2]}, cube | {"size": [2, 3]}, cube | {"id": ["geo", "unit"]}, "no cube", {k: v for k, v in cube.items() if k != "value"}]
    for bad in broken:
        with pytest.raises(Exception, match="PROVIDER_SCHEMA_UNRESOLVED"):
            read(bad)
    with pytest.raises(Exception, match="INVALID_PRICE_VALUE"):
        read(cube | {"value": [1.0, 2.0, 3.0, 0.0]})
    assert len(read(cube | {"value": [1.0, 2.0, 3.0, 0.0]}, keep={"geo": ["A"]})) == 2
