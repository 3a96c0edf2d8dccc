"""Exact sums of doubles against fractions."""

import math
import random
from fractions import Fraction

import pytest

from tidemark.operators.exact_sums import exact_sums, exact_sums_sql
from tidemark.plans.gold import sql_over


def expected(values):
    found = [v for v in values if v is not None]
    if not found:
        return None
    if any(math.isnan(v) for v in found) or (math.inf in found and -math.inf in found):
        return math.nan
    for bound in (math.inf, -math.inf):
        if bound in found:
            return bound
    total = sum(map(Fraction, found), Fraction(0))
    try:
        return float(total)
    except OverflowError:
        return math.inf if total > 0 else -math.inf


def same(a, b):
    return a is b is None or (a is not None and b is not None and (a == b or (math.isnan(a) and math.isnan(b))))


def groups():
    rng = random.Random(11)
    out = {
        "nan": [math.nan, 2.0], "inf": [math.inf, 1.0, -1e308], "both": [math.inf, -math.inf], "minus": [-math.inf, None], "nulls": [None, None], "zero": [0.0, -0.0],
        "tiny": [4e-7] * 1000, "large": [1e25, 1.0, -1e25], "cancel": [1e300, 1e-300, -1e300], "nothing": [1e16, 1.0, -1e16, -1.0], "subnormal": [5e-324] * 3 + [2.0**-1070],
        "overflow": [1.7e308] * 3, "back": [1.7e308, 1.7e308, -1.7e308], "negative": [-1e10, 3.5, -2.0**-40], "tie": [2.0**53, 1.0], "above": [2.0**53, 1.0, 2.0**-60], "below": [2.0**53, 3.0, -(2.0**-60)],
        "powers": [2.0**k for k in range(-1074, 1000, 37)] + [-(2.0**k) for k in range(-1000, 1020, 41)]}
    for k in range(25):
        wide = rng.choice([3, 40, 300])
        out[f"random{k}"] = [rng.choice([-1, 1]) * rng.random() * 10.0 ** rng.uniform(-wide, wide if wide < 300 else 307) for _ in range(rng.randrange(1, 60))]
    return out


def test_any_magnitude_and_order(spark):
    want = {k: expected(v) for k, v in groups().items()}
    rows = [(k, v) for k, values in groups().items() for v in values]
    for seed in (1, 2):
        random.Random(seed).shuffle(rows)
        df = spark.createDataFrame(rows, "k string, v double").repartition(3 + seed)
        got = {r.k: r.s for r in exact_sums(df, ["k"], "v", "s").collect()}
        assert got.keys() == want.keys()
        assert [k for k in want if not same(got[k], want[k])] == []
    text = f"FROM IDENTIFIER(:rows) |> {exact_sums_sql(df.schema['v'].dataType, 'v', 's', ['k'])}"
    assert [r.k for r in sql_over(spark, text, rows=df).collect() if not same(r.s, want[r.k])] == []


def test_digits_half_up_as_the_amounts_do(spark):
    rows = [("a", 0.15), ("b", 1234567.85), ("c", 0.05), ("c", 0.1), ("d", -2.25), ("e", math.nan), ("f", 2.0), ("f", 0.04), ("g", 159472840665.1456), ("h", 1e305), ("i", 0.4499999)]
    df = spark.createDataFrame(rows, "k string, v double")
    got = {r.k: r.s for r in exact_sums(df, ["k"], "v", "s", 1).collect()}
    assert math.isnan(got.pop("e"))
    assert got == {"a": 0.2, "b": 1234567.9, "c": 0.2, "d": -2.3, "f": 2.0, "g": 159472840665.1, "h": 1e305, "i": 0.4}


def test_a_million_small_values_in_one_group(spark):
    df = spark.range(1_000_000).selectExpr("1 AS k", "4e-7D AS v")
    assert exact_sums(df, ["k"], "v", "s").first().s == float(Fraction(4e-7) * 1_000_000)


@pytest.mark.parametrize("kind", ["decimal(20,2)", "bigint"])
def test_columns_that_are_exact_already(spark, kind):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", None)], "k string, v long").selectExpr("k", f"CAST(v AS {kind}) AS v")
    assert {r.k: r.s for r in exact_sums(df, ["k"], "v", "s", 1).collect()} == {"a": 3.0, "b": None}


def test_empty_table_and_hot_key_plan(spark):
    df = spark.createDataFrame([], "k string, v double")
    sums = exact_sums(df, ["k"], "v", "s")
    assert sums.collect() == []
    plan = sums._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Window" not in plan
