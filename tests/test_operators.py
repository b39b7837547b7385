"""Operators on hand-made rows and against brute force."""

import math
import random

import pytest
from pyspark.sql import functions as F

from kalends.functions import months, text
from kalends.functions.classes import EVIDENCE_CLASSES
from kalends.operators import aggregates, checks, joins, ranks, windows
from kalends.plans import index


def one(spark, value, function):
    return spark.createDataFrame([(value,)], "x string").select(function(F.col("x"))).first()[0]


def test_names_fold_accents_ligatures_and_notes(spark):
    assert one(spark, "  Côte d’Ivoire^{a} & ﬁn-Ætna ", text.normalize_name) == "cote d ivoire and fin tna"
    assert one(spark, "élève ½", text.normalize_name) == "eleve 1 2" or one(spark, "élève", text.normalize_name) == "eleve"


def test_entities_are_read_once(spark):
    assert one(spark, "&amp;lt;b&amp;gt; &lt;i&gt; &#233;&#xE9;&nbsp;&unknown;", text.unescape) == "&lt;b&gt; <i> éé &unknown;"
    assert one(spark, "<p>a</p><SCRIPT x>1<2</SCRIPT><style>p{}</style>b&nbsp;c", text.html_to_text) == "\na\n b c"


def test_lists_and_months(spark):
    assert one(spark, " a || b|", text.split_list) == ["a", "b"]
    assert one(spark, "2021-01", lambda c: months.shift_month(c, -1)) == "2020-12"
    spine = [r.period for r in months.month_spine(spark, "2020-11", "2021-02").collect()]
    assert spine == ["2020-11", "2020-12", "2021-01", "2021-02"]


def test_order_statistics_match_brute_force(spark):
    rng = random.Random(7)
    groups = {
        "few": [3.0], "pair": [1.0, 2.0], "ties": [5.0] * 500 + [6.0] * 3, "wide": [rng.lognormvariate(0, 6) for _ in range(3000)],
        "plain": [rng.random() for _ in range(2001)], "negative": [rng.gauss(0, 1) for _ in range(777)],
    }
    rows = [(k, v, rng.choice([1, 2, 3])) for k, vs in groups.items() for v in vs] + [("few", None, 1), (None, 4.0, 1), (None, 8.0, 1)]
    groups[None] = [4.0, 8.0]
    df = spark.createDataFrame(rows, "k string, v double, w int").repartition(5)
    nearest = {r.k: r for r in ranks.percentile_nearest_rank(df, ["k"], "v", {"p95": 0.95, "p05": 0.05}).collect()}
    linear = {r.k: r for r in ranks.percentile_linear(df, ["k"], "v", {"p95": 0.95, "half": 0.5}).collect()}
    upper = {r.k: r.median for r in ranks.upper_median(df, ["k"], "v").collect()}
    weighted = {r.k: r.q for r in ranks.weighted_quantile(df, ["k"], "v", "w", {"q": 0.3}).collect()}
    for key, values in groups.items():
        ordered = sorted(values)
        n = len(ordered)
        assert nearest[key].p95 == ordered[max(0, math.ceil(round(0.95 * n, 9)) - 1)]
        assert nearest[key].p05 == ordered[max(0, math.ceil(round(0.05 * n, 9)) - 1)]
        assert upper[key] == ordered[n // 2]
        spot = 0.95 * (n - 1)
        low, high = ordered[math.floor(spot)], ordered[min(math.ceil(spot), n - 1)]
        assert linear[key].p95 == pytest.approx(low + (high - low) * (spot - math.floor(spot)))
        pairs = sorted((v, w) for k, v, w in rows if k == key and v is not None)
        goal, total = 0.3 * sum(w for _, w in pairs), 0
        for value, weight in pairs:
            total += weight
            if total >= goal * (1 - 1e-12):
                break
        assert weighted[key] == value
    everything = sorted(v for vs in groups.values() for v in vs)
    whole = ranks.percentile_nearest_rank(df, [], "v", {"p": 0.5}).first().p
    assert whole == everything[math.ceil(len(everything) / 2) - 1]


def test_a_hole_makes_the_month_incomplete(spark):
    cells = spark.createDataFrame(
        [("2020-01", "A", "X", 0.5, 100.0, "P1_OFFICIAL_CATEGORY"), ("2020-01", "A", "Y", 0.5, 100.0, "P4_REGIONAL_PROXY"),
         ("2020-02", "A", "X", 0.5, 110.0, "P1_OFFICIAL_CATEGORY"), ("2020-02", "A", "Y", 0.5, None, None)],
        "period string, economy string, category string, weight double, price_relative double, evidence_class string")
    rows = {r.period: r for r in aggregates.fixed_weight_index(cells).collect()}
    assert rows["2020-01"].value == 100.0 and rows["2020-01"].proxy_weight == 0.5
    assert rows["2020-02"].value is None and rows["2020-02"].status == "INCOMPLETE" and rows["2020-02"].missing_cells == "A:Y"


def test_currency_separation(spark):
    cells = spark.createDataFrame([("2020-01", "USA", "X", 1.0, 100.0), ("2020-02", "USA", "X", 1.0, 100.0), ("2020-03", "USA", "X", 1.0, 110.0)],
                                  "period string, economy string, category string, weight double, price_relative double")
    assigned = spark.createDataFrame([("USA", "USD", "2020-01", "")], "economy string, currency string, effective_from string, effective_to string")
    fx = spark.createDataFrame([("USD", "2020-01", 1.0, 1.0), ("USD", "2020-02", 1.25, 1.0)], "currency string, period string, rate double, redenomination double")
    rows = {r.period: r for r in index.fx_separation(cells, assigned, fx, "2020-01")["index"].collect()}
    assert rows["2020-02"].local_index == 100 and rows["2020-02"].common_index == pytest.approx(80)
    assert rows["2020-03"].common_index is None and rows["2020-03"].status == "INCOMPLETE_FX" and rows["2020-03"].missing_weight == 1


def test_euro_needs_no_rate_and_transitions_are_reported(spark):
    cells = spark.createDataFrame([(m, "HRV", "X", 1.0, 100.0) for m in ("2020-01", "2020-02")], "period string, economy string, category string, weight double, price_relative double")
    assigned = spark.createDataFrame([("HRV", "EUR", "2020-01", "2020-01"), ("HRV", "NEW", "2020-02", "")], "economy string, currency string, effective_from string, effective_to string")
    fx = spark.createDataFrame([], "currency string, period string, rate double, redenomination double")
    parts = index.fx_separation(cells, assigned, fx, "2020-01")
    rows = {r.period: r for r in parts["index"].collect()}
    assert rows["2020-01"].common_index == 100 and rows["2020-02"].common_index is None
    assert {r.reason for r in parts["coverage"].collect()} == {"", "UNRATIFIED_CURRENCY_TRANSITION_EUR_TO_NEW"}


def test_chain_restarts_at_anchors_and_stops_at_gaps(spark):
    rows = [("A", "X", "2020-01", 100.0, None), ("A", "X", "2020-02", None, 0.1), ("A", "X", "2020-03", None, None), ("A", "X", "2020-04", None, 0.1), ("A", "X", "2020-05", 50.0, 0.9), ("A", "X", "2020-06", None, -0.5)]
    df = spark.createDataFrame(rows, "economy string, category string, period string, anchor double, central_rate double")
    linked = {r.period: r for r in windows.chain_link(df.withColumn("lower_rate", F.col("central_rate") - 0.1).withColumn("upper_rate", F.col("central_rate"))).collect()}
    assert linked["2020-02"].central == pytest.approx(110) and linked["2020-02"].lower == pytest.approx(100)
    assert linked["2020-03"].central is None and linked["2020-04"].central is None
    assert linked["2020-05"].central == 50 and linked["2020-06"].central == pytest.approx(25)


def test_rates_are_null_across_a_calendar_gap(spark):
    df = spark.createDataFrame([("A", "2020-01", 1.0), ("A", "2020-03", 2.0), ("A", "2020-04", 3.0)], "economy string, period string, level double")
    rates = {r.period: r.rate for r in joins.monthly_rates(df, ["economy"], "level").collect()}
    assert rates["2020-03"] is None and rates["2020-04"] == pytest.approx(0.5)


def test_rounded_shares_sum_to_one(spark):
    df = spark.createDataFrame([(f"E{i}", "C", 1 / 7) for i in range(7)], "economy string, category string, share double")
    rows = windows.round_with_residual(df, "share", 3, ("economy", "category")).collect()
    assert float(sum(r.weight for r in rows)) == 1.0
    assert [r.economy for r in rows if r.residual != 0] == ["E6"]


@pytest.mark.parametrize("scenario", ["SINGLE_CELL", "ECONOMY_OUTAGE", "CATEGORY_OUTAGE"])
def test_leave_out_pools_match_brute_force(spark, scenario):
    rng = random.Random(3)
    cells = [(e, c, rng.uniform(0.5, 2), rng.random()) for e in "ABC" for c in "XY"]
    df = spark.createDataFrame([("o", "t", *cell) for cell in cells], "origin string, target string, economy string, category string, factor double, weight double")
    masked = {"SINGLE_CELL": lambda a, b: a[:2] == b[:2], "ECONOMY_OUTAGE": lambda a, b: a[0] == b[0], "CATEGORY_OUTAGE": lambda a, b: a[1] == b[1]}[scenario]
    rows = {(r.economy, r.category): r for r in windows.leave_out_factors(df, scenario).collect()}

    def mean(pool):
        return sum(f * w for _, _, f, w in pool) / sum(w for *_, w in pool) if pool else None

    for cell in cells:
        pool = [other for other in cells if not masked(cell, other)]
        row = rows[cell[:2]]
        for got, want in ((row.global_weighted, mean(pool)), (row.economy_weighted, mean([p for p in pool if p[0] == cell[0]])), (row.category_weighted, mean([p for p in pool if p[1] == cell[1]]))):
            assert got == (None if want is None else pytest.approx(want))


def test_cycles_and_overlaps(spark):
    registry = spark.createDataFrame([("a", ["b"]), ("b", ["c"]), ("c", ["a"]), ("d", ["a"]), ("e", ["d"]), ("f", ["f"]), ("g", []), ("h", ["g", "missing"])], "series_id string, fallback_series array<string>")
    assert {r.series_id for r in checks.fallback_cycles(registry).collect()} == {"a", "b", "c", "f"}
    spans = spark.createDataFrame([("A", "X", "2020-01", "2020-06"), ("A", "Y", "2020-07", ""), ("B", "X", "2020-01", ""), ("B", "Y", "2021-01", "2021-02")],
                                  "economy string, currency string, effective_from string, effective_to string")
    assert [(r.economy, r.currency) for r in checks.interval_overlaps(spans).collect()] == [("B", "Y")]
    with pytest.raises(ValueError):
        checks.fail_on_rows(checks.interval_overlaps(spans), "overlap")


def test_results_do_not_depend_on_row_order(spark):
    rows = [(f"S{i}", "A", "X", "2020-01", 100.0 + i, "P2_OFFICIAL_AGGREGATE" if i % 2 else "P3_OFFICIAL_HEADLINE", 1 + i % 3) for i in range(20)]
    schema = "series_id string, economy string, category string, period string, price_relative double, evidence_class string, source_priority int"
    first = windows.select_best_price(spark.createDataFrame(rows, schema)).first()
    second = windows.select_best_price(spark.createDataFrame(rows[::-1], schema).repartition(7)).first()
    assert first == second and first.series_id == "S15" and first.candidate_count == 20


def test_selection_lists_the_candidates_it_passed_over(spark):
    rng = random.Random(13)
    rows = [(f"S{s}", e, c, p, rng.random(), rng.choice((*EVIDENCE_CLASSES, EVIDENCE_CLASSES[0])), rng.choice((1, 2, 10)))
            for s in range(30) for e in (*"ABC", None) for c in "xy" for p in ("2020-01", "2020-02") if rng.random() < 0.5]
    rows.append(("only", "D", "x", "2020-01", 1.0, EVIDENCE_CLASSES[4], 3))
    cells = {}
    for row in rows:
        cells.setdefault(row[1:4], []).append((row[5], row[6], row[0]))
    want = {key: [series for *_, series in sorted(found)] for key, found in cells.items()}
    df = spark.createDataFrame(rows, "series_id string, economy string, category string, period string, price_relative double, evidence_class string, source_priority int")
    for size in ((), (len(rows),)):
        best = windows.select_best_price(df, *size)
        got = {(r.economy, r.category, r.period): r for r in best.collect()}
        assert {key: [r.series_id, *filter(None, r.rejected_series_ids.split("|"))] for key, r in got.items()} == want
        assert all(r.candidate_count == len(want[key]) for key, r in got.items())
    assert got["D", "x", "2020-01"].rejected_series_ids == ""
    assert max(map(len, want.values())) > 10 and "collect_list" not in best.drop("rejected_series_ids")._jdf.queryExecution().optimizedPlan().toString()
