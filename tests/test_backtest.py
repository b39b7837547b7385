"""Holdout hygiene and identities of the backtest on a small synthetic panel."""

import math

import pytest
from pyspark.sql import functions as F

from kalends.operators import checks
from kalends.plans import backtest
from kalends.plans.backtest import B2, B3, MODELS, Rule, Safeguard

ECONOMIES, CATEGORIES = ("A", "B", "C"), ("X", "Y")
MONTHS = [f"{y}-{m:02d}" for y in (2019, 2020) for m in range(1, 13)]
POLICY = Safeguard((Rule("X_RULE", category="X"), Rule("OUTAGE", scenario="ECONOMY_OUTAGE", horizon=1)), ("2020-01", "2020-06"), ("2020-07", "2020-12"),
                   minimum_cases=3, mean_delta_above=-1e9, regression_rate_from=0.0)


@pytest.fixture(scope="module")
def cases(spark):
    value = lambda i, j, t: 100 + t * (1 + i) + 5 * math.sin(t + j + 2 * i)
    panel = spark.createDataFrame([(e, c, m, value(i, j, t)) for i, e in enumerate(ECONOMIES) for j, c in enumerate(CATEGORIES) for t, m in enumerate(MONTHS)],
                                  "economy string, category string, period string, price_relative double")
    weights = spark.createDataFrame([(e, c, 1 / 6) for e in ECONOMIES for c in CATEGORIES], "economy string, category string, weight double")
    rows = backtest.completion_backtest(panel, weights, (1, 3), ("2020-01", "2020-12"))
    return spark.createDataFrame(rows.collect(), rows.schema).cache()


def test_every_mask_pair_and_model_has_one_case(cases):
    pairs = sum(1 for o in range(11, 23) for h in (1, 3) if 12 <= o + h <= 23)
    assert cases.count() == pairs * (6 + 3 + 2) * len(MODELS)
    assert checks.sample_mismatch(cases, len(MODELS)).count() == 0
    assert checks.duplicate_keys(cases, ["case_id", "model"]).count() == 0


def test_carry_forward_error_is_the_masked_growth(cases):
    row = cases.filter((F.col("model") == B2) & (F.col("case_id") == "SINGLE_CELL|A|X|2019-12|2020-01|H01")).first()
    level = lambda t: 100 + t + 5 * math.sin(t)
    assert row.error == pytest.approx((level(11) - level(12)) / 6)
    assert row.estimate == pytest.approx(row.truth + row.error)


def test_activation_reads_development_cases_only(cases):
    spoiled = cases.withColumn("bps", F.when(F.col("target") >= "2020-07", F.col("bps") * 50 + F.length("model")).otherwise(F.col("bps")))
    plain = {r.rule_id: r for r in backtest.activate_rules(cases, POLICY).collect()}
    other = {r.rule_id: r for r in backtest.activate_rules(spoiled, POLICY).collect()}
    assert plain == other and plain["X_RULE"].activated


def test_safeguard_takes_the_fallback_where_a_rule_is_active(cases):
    active = backtest.activate_rules(cases, POLICY)
    rows = backtest.safeguarded_model(cases, active, POLICY).collect()
    for row in rows:
        matched = row.category == "X" or (row.scenario == "ECONOMY_OUTAGE" and row.horizon == 1)
        assert row.selected_model == (B2 if matched else B3)
        assert row.b4_bps == (row.b2_bps if matched else row.b3_bps)
