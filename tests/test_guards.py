"""Guards inside plans, months folded to bitmaps, overlapping intervals and what donors may be."""

import itertools
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from kalends.catalog import indices
from kalends.operators import checks, windows
from kalends.plans import backtest, completion

PANEL = "economy string, category string, period string, price_relative double"
WEIGHTS = "economy string, category string, weight double"
MONTHS = ("2020-01", "2020-02", "2020-03")


def panel_rows():
    return [(e, c, p, 100.0 + k) for e in "AB" for c in "xy" for k, p in enumerate(MONTHS)]


def test_a_hole_in_any_month_stops_the_backtest(spark):
    weights = spark.createDataFrame([(e, c, 0.25) for e in "AB" for c in "xy"], WEIGHTS)
    run = lambda rows: backtest.completion_backtest(spark.createDataFrame(rows, PANEL), weights, (1,), ("2020-02", "2020-03")).collect()
    assert len(run(panel_rows())) == 2 * 8 * 4
    for k in range(12):
        with pytest.raises(Exception, match="months with holes"):
            run(panel_rows()[:k] + panel_rows()[k + 1 :])
    for bad in (None, 0.0, float("nan"), float("inf")):
        with pytest.raises(Exception, match="prices that are not positive"):
            run([*panel_rows()[1:], ("A", "x", "2020-01", bad)])
    with pytest.raises(Exception, match="cells without a weight"):
        run([*panel_rows(), ("C", "x", "2020-01", 1.0)])


def test_whole_months_are_kept(spark):
    rows = [r for r in panel_rows() if r[:3] != ("B", "y", "2020-02")]
    cells = spark.createDataFrame([(e, c, 0.25) for e in "AB" for c in "xy"], WEIGHTS)
    kept = checks.only_whole_months(spark.createDataFrame(rows, PANEL), cells).collect()
    assert Counter(r.period for r in kept) == {"2020-01": 4, "2020-03": 4}


def test_months_folded_to_bitmaps_equal_brute_force(spark):
    rng = random.Random(3)
    cells = [(f"E{e}", f"c{c}", 1.0) for e in range(300) for c in range(130)]  # more than one bitmap holds
    rows = [(*cells[rng.randrange(len(cells))][:2], MONTHS[rng.randrange(3)], float(k)) for k in range(4000)]
    found = checks.month_cells(spark.createDataFrame(rows, PANEL).repartition(4), spark.createDataFrame(cells, WEIGHTS), points=F.col("price_relative") * F.col("weight")).collect()
    for r in found:
        own = [x for x in rows if x[2] == r.period]
        assert (r.rows, r.held, r.wanted, r.points) == (len(own), len({x[:2] for x in own}), len(cells), sum(x[3] for x in own))
    numbers = checks.numbered(spark.createDataFrame(cells, WEIGHTS), ("economy", "category")).select("number").collect()
    assert sorted(r.number for r in numbers) == list(range(1, len(cells) + 1))


def test_a_guard_stays_under_a_join_and_a_later_filter(spark):
    left = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    right = spark.createDataFrame([(1, True)], "k int, enabled boolean")
    guarded = checks.stop_where(left.join(right.withColumn("known", F.lit(True)), "k", "left"), F.col("known").isNull(), "unknown", "k")
    for use in (lambda df: df.filter("enabled").collect(), lambda df: df.filter("enabled").count(), lambda df: df.select("v").filter("v = 'a'").collect()):
        with pytest.raises(Exception, match='unknown: {"k":2}'):
            use(guarded)
    assert checks.stop_where(left, F.lit(None).cast("boolean"), "never").count() == 2


def test_repeats_are_found_with_nulls_and_without_an_order(spark):
    make = lambda rows: spark.createDataFrame(rows, "a string, b int")
    rows = [("x", 1), ("x", 2), ("x", None), (None, 1), (None, None)]
    assert checks.unrepeated(make(rows), ["a"], ["b"], "again").count() == 5
    for k in range(5):
        with pytest.raises(Exception, match="again"):
            checks.unrepeated(make(rows + rows[k : k + 1]), ["a"], ["b"], "again").count()
    with pytest.raises(Exception, match="again"):
        checks.unrepeated(make(rows), ["a"], [], "again").count()


def test_every_overlapping_pair_is_found(spark):
    rng = random.Random(5)
    month = lambda k: f"{2000 + k // 12}-{k % 12 + 1:02d}"
    rows = []
    for e in "ABCD":
        for k in range(25):
            start = rng.randrange(60)
            rows.append((e, f"C{k % 7}", month(start), month(start + rng.randrange(-2, 20)) if k % 6 else ""))
    rows += rows[:3]
    found = checks.interval_overlaps(spark.createDataFrame(rows, "economy string, currency string, effective_from string, effective_to string")).collect()
    want = Counter()
    spans = sorted((e, f, t or "9999-12", c) for e, c, f, t in rows)
    for a, b in itertools.combinations(spans, 2):
        if a[0] == b[0] and a[1] <= a[2] and a[2] >= b[1]:
            want[b[0], b[3], b[1], b[2], a[3], a[1], a[2]] += 1
    assert Counter(map(tuple, found)) == want and len(want) > 300


def test_donors_need_direct_evidence_and_bring_their_headline_sources(spark):
    rows = []
    for k, e in enumerate("ABCD"):
        for t, p in enumerate(MONTHS):
            evidence = completion.HEADLINE_CLASS if e == "B" and t == 2 else completion.DIRECT_CLASSES[k % 2]
            rows.append((e, "x", p, 100.0 + t * (k + 1), evidence, f"cat_{e}"))
    levels = spark.createDataFrame(rows, "economy string, category string, period string, level double, evidence_class string, source_id string")
    headline = spark.createDataFrame([(e, p, 100.0 + t, f"head_{e}" if e != "D" else None) for e in "ABCD" for t, p in enumerate(MONTHS)], "economy string, period string, level double, source_id string")
    profiles = spark.createDataFrame([(e, "r", "HIGH", ["a"], {"m": 1.0}) for e in "ABCD"], "economy string, region string, income_group string, characteristics array<string>, covariates map<string,double>")
    weights = spark.createDataFrame([(e, "x", 0.25) for e in "ABCD"], WEIGHTS)
    got = {(r.economy, r.period): (r.donors, r.sources) for r in completion.predict_rates(
        levels, headline, profiles, weights, ["x"], {"S": completion.Policy(minimum_region_donors=1)}).collect()}
    assert got["A", "2020-02"] == ("B|C|D", "cat_B|cat_C|cat_D|head_B|head_C")
    assert got["A", "2020-03"] == ("C|D", "cat_C|cat_D|head_C")
    assert got["B", "2020-03"] == ("A|C|D", "cat_A|cat_C|cat_D|head_A|head_C")


def test_building_a_guarded_query_runs_few_jobs(spark):
    series = spark.createDataFrame([("a", "E", ["x"], "P1_OFFICIAL_CATEGORY", 1, True)], "series_id string, economy string, target_categories array<string>, evidence_class string, source_priority int, enabled boolean")
    obs = spark.createDataFrame([("a", p, 2.0) for p in MONTHS], "series_id string, period string, value double")
    spark.sparkContext.setJobGroup("building", "building")
    best = windows.select_best_price(indices.index.normalize_prices(series, obs, MONTHS[0]))
    spark.sparkContext.setJobGroup("action", "action")
    assert best.count() == 3
    assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("building")) == 0


def test_history_quantiles_equal_brute_force(spark):
    rng = random.Random(11)
    months = [f"20{18 + k // 12}-{k % 12 + 1:02d}" for k in range(30)]
    donors = [f"D{k}" for k in range(9)]
    residual = [(d, c, m, rng.choice([0.0, 0.1, -0.1, rng.gauss(0, 1)]), True) for d in donors for c in "xy" for m in months if rng.random() < 0.7]
    pairs = [(t, d, rng.choice([0.0, 0.5, 0.25, rng.random()])) for t in donors for d in donors if t != d]
    wanted = [(t, c, m, lo, 0.9) for t in donors[:4] for c in "xyz" for m in months for lo in (0.1, 0.25)]
    found = completion.history_spread(
        spark.createDataFrame(residual, "donor string, category string, period string, residual double, direct boolean"), spark.createDataFrame(pairs, "target string, donor string, similarity double"),
        spark.createDataFrame(wanted, "economy string, category string, period string, q_lo double, q_hi double"))
    got = {tuple(r)[:5]: (r.past_lo, r.past_hi) for r in found.select("economy", "category", "period", "q_lo", "q_hi", "past_lo", "past_hi").collect()}
    weight = {(t, d): w for t, d, w in pairs}
    checked = 0
    for t, c, m, lo, hi in wanted:
        rows = sorted((x, weight[t, d]) for d, k, p, x, _ in residual if k == c and p <= m and d != t)
        total = sum(w for _, w in rows)
        if not total:
            assert (t, c, m, lo, hi) not in got
            continue
        for q, value in zip((lo, hi), got[t, c, m, lo, hi]):
            cum = 0.0
            for x, w in rows:
                cum += w
                if cum >= total * q * (1 - 1e-12):
                    break
            # where a level is met exactly, the order of summing decides between neighbours of one value
            assert value == x or abs(cum - total * q) < 1e-9
            checked += 1
    assert checked > 400 and "collect_list" not in found._jdf.queryExecution().toString()
