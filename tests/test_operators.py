import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.operators.aggregates import exact_rounded_sum, freshness, run_summary, summary_stats
from tidemark.operators.cdc import latest_per_key, publish, scd1_merge
from tidemark.operators.changes import classify_changes, collapse_duplicates, duplicate_content
from tidemark.operators.joins import Dim, assert_unique, sparse_dim_join, star_join
from tidemark.operators.quality import Rule, expect, expect_or_drop, quarantine, rule_metrics, violations_by_rule
from tidemark.operators.ranking import flag_best, top_row_per_group


def test_rule_passes_only_when_true(spark):
    # A NULL predicate result fails the rule.
    df = spark.createDataFrame([(1,), (None,), (-1,)], "x int")
    kept = expect_or_drop(df, [Rule("positive", "x > 0")])
    assert [r.x for r in kept.collect()] == [1]


def test_quarantine_keeps_every_row(spark):
    df = spark.createDataFrame([(1, "Q01"), (None, "Q06"), (1900, "Q05"), (2500, "Q01")], "year int, period string")
    rules = [Rule("valid_year", "year IS NOT NULL"), Rule("plausible_year", "year BETWEEN 1900 AND 2100"),
             Rule("valid_period", "period RLIKE '^Q0[1-5]$'")]
    clean, rejected = quarantine(df, rules)
    assert clean.count() + rejected.count() == df.count()
    failed = {tuple(r._failed_rules) for r in rejected.collect()}
    assert ("valid_year", "plausible_year", "valid_period") in failed
    by_rule = {r.rule: r.n for r in violations_by_rule(df, rules).collect()}
    assert by_rule == {"valid_year": 1, "plausible_year": 3, "valid_period": 1}


def test_expect_warn_counts_through_observation(spark):
    df = spark.createDataFrame([("a",), (None,), ("b",)], "s string")
    observed, obs = expect(df, [Rule("not_null", "s IS NOT NULL")])
    assert observed.count() == 3
    assert obs.get == {"rows": 3, "not_null": 1}
    assert rule_metrics(df, [Rule("not_null", "s IS NOT NULL")]).first().asDict() == {"rows": 3, "not_null": 1}


def test_latest_per_key_ties_are_deterministic(spark):
    # One key twice in one file (same sequence) -> payload decides, always the same row.
    rows = [("S1", "20260909T163000Z", 2.0, "a"), ("S1", "20260909T163000Z", 3.0, "b"), ("S1", "20260101T000000Z", 9.0, "c")]
    for perm in itertools.permutations(rows):
        df = spark.createDataFrame(list(perm), "k string, ts string, v double, f string")
        out = latest_per_key(df, ["k"], ["ts"], ["v", "f"]).first()
        assert (out.v, out.f) == (3.0, "b")


def test_scd1_merge_is_order_and_replay_independent(spark):
    # C4: any split, order or replay of the batches converges to the same table.
    base = [("S1", 1, 1.0), ("S1", 2, 2.0), ("S2", 1, 5.0), ("S3", 3, 7.0), ("S2", 4, None)]
    batches = [spark.createDataFrame([r], "k string, seq int, v double") for r in base]
    expected = {("S1", 2.0), ("S2", None), ("S3", 7.0)}
    for order in [(0, 1, 2, 3, 4), (4, 3, 2, 1, 0), (2, 0, 4, 1, 3, 1, 0)]:
        state = None
        for i in order:
            state = scd1_merge(state, batches[i], ["k"], ["seq"], ["v"])
        got = {(r.k, r.v) for r in publish(state, ["seq"]).collect()}
        assert got == expected


def test_scd1_no_deletes(spark):
    # A key missing from a later batch keeps its row.
    s = scd1_merge(None, spark.createDataFrame([("a", 1, 1.0), ("b", 1, 2.0)], "k string, seq int, v double"), ["k"], ["seq"], ["v"])
    s = scd1_merge(s, spark.createDataFrame([("a", 2, 3.0)], "k string, seq int, v double"), ["k"], ["seq"], ["v"])
    assert {(r.k, r.v) for r in s.collect()} == {("a", 3.0), ("b", 2.0)}


def test_flag_best_rounding_tie_earliest_year(spark):
    # T5: rounded sums tie -> earliest year flagged; exactly one flag per series.
    df = spark.createDataFrame(
        [("S", 2000, "Q01", 1.04), ("S", 2000, "Q02", 1.0), ("S", 2001, "Q01", 2.01), ("S", 2002, "Q01", 0.5)],
        "series_id string, year int, period string, value double",
    )
    yearly = df.groupBy("series_id", "year").agg(exact_rounded_sum(df, "value", 1).alias("s"))
    flagged = flag_best(yearly, ["series_id"], [F.col("s").desc(), F.col("year").asc()], "best")
    best = [(r.year, r.s) for r in flagged.filter("best").collect()]
    assert best == [(2000, 2.0)]
    assert flagged.count() == 3


def test_exact_rounded_sum_half_up_and_annual_excluded(spark):
    df = spark.createDataFrame(
        [("PRS30006011", 1995, p, v) for p, v in [("Q01", 2.6), ("Q02", 2.1), ("Q03", 0.9), ("Q04", 0.1), ("Q05", 1.4)]]
        + [("X", 1, "Q01", 2.25)],
        "series_id string, year int, period string, value double",
    )
    out = {
        (r.series_id): r.s
        for r in df.filter(F.col("period") != "Q05").groupBy("series_id").agg(exact_rounded_sum(df, "value", 1).alias("s")).collect()
    }
    assert out == {"PRS30006011": 5.7, "X": 2.3}


def test_top_row_per_group(spark):
    df = spark.createDataFrame([("a", 1, 10), ("a", 3, 11), ("a", 3, 12), ("b", 2, 20)], "g string, ts int, id int")
    got = {(r.g, r.id) for r in top_row_per_group(df, ["g"], ["ts", "id"], ["id"]).collect()}
    assert got == {("a", 12), ("b", 20)}


def test_classify_changes(spark):
    prev = spark.createDataFrame([("a", "h1"), ("b", "h2"), ("c", "h3")], "k string, fp string")
    cur = spark.createDataFrame([("a", "h1"), ("b", "h9"), ("d", "h4")], "k string, fp string")
    got = {(r.k, r.status) for r in classify_changes(cur, prev, "k", "fp").collect()}
    assert got == {("a", "UNCHANGED"), ("b", "CHANGED"), ("c", "REMOVED"), ("d", "ADDED")}


def test_duplicate_content(spark):
    df = spark.createDataFrame([(1, "x"), (2, "y"), (3, "x"), (4, "x")], "doc_id int, text string")
    row = duplicate_content(df, "doc_id", "text").first()
    assert (row.first_doc_id, row.copies) == (1, 3)
    assert sorted(r.doc_id for r in collapse_duplicates(df, "doc_id", "text").collect()) == [1, 2]


def test_assert_unique_guards_fan_out(spark):
    # A join key that repeats would multiply fact rows.
    pop = spark.createDataFrame([(2019, 1), (2019, 2)], "year int, population bigint")
    with pytest.raises(ValueError):
        assert_unique(pop, ["year"])
    facts = spark.createDataFrame([(2019,)], "year int")
    with pytest.raises(ValueError):
        sparse_dim_join(facts, pop, ["year"])


def test_star_join_left_and_renamed_keys(spark):
    series = spark.createDataFrame([("S1", "01", "S"), ("S2", "99", None)], "series_id string, measure_code string, seasonal string")
    measure = spark.createDataFrame([("01", "Labor productivity")], "measure_code string, measure_text string")
    seasonal = spark.createDataFrame([("S", "Seasonally adjusted")], "seasonal_code string, seasonal_text string")
    out = star_join(series, [
        Dim(measure, "measure_code", "measure_code", ("measure_text",)),
        Dim(seasonal, "seasonal", "seasonal_code", ("seasonal_text",)),
    ])
    got = {(r.series_id, r.measure_text, r.seasonal_text) for r in out.collect()}
    assert got == {("S1", "Labor productivity", "Seasonally adjusted"), ("S2", None, None)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan  # small dims: Spark broadcasts after its own size check


def test_summary_stats_single_row(spark):
    df = spark.createDataFrame([(2013, 10), (2014, 20), (2020, 99)], "year int, population bigint")
    r = summary_stats(df, "population", "year", 2013, 2018).first()
    assert r.year_count == 2 and r.population_mean == 15.0 and r.population_stddev_pop == 5.0


def test_run_summary_and_freshness(spark):
    df = spark.createDataFrame([("r1", "FETCHED"), ("r1", "ERROR"), ("r2", "UNCHANGED")], "run string, status string")
    got = {r.run: (r.had_error, r.n, r.n_fetched) for r in run_summary(df, "run", "status", "ERROR", ("FETCHED",)).collect()}
    assert got == {"r1": (True, 2, 1), "r2": (False, 1, 0)}
    ev = spark.sql("SELECT 'a' AS g, timestamp '2024-01-01 00:00:00' AS ts UNION ALL SELECT 'b', timestamp '2024-02-01 00:00:00'")
    stale = {r.g: r.is_stale for r in freshness(ev, "g", "ts", "2024-01-15 00:00:00").collect()}
    assert stale == {"a": True, "b": False}


def test_latest_per_key_with_unorderable_payload(spark):
    df = spark.sql("""
        SELECT * FROM VALUES ('a', 1, map('x', 1), parse_json('{"n": 1}')),
                             ('a', 2, map('x', 2), parse_json('{"n": 2}')),
                             ('b', 1, map('y', 3), parse_json('{"n": 3}')) AS t(k, seq, m, v)""")
    got = {r.k: (r.m, r.v.toPython()) for r in latest_per_key(df, ["k"], ["seq"], ["m", "v"]).collect()}
    assert got == {"a": ({"x": 2}, {"n": 2}), "b": ({"y": 3}, {"n": 3})}


def test_join_merge_equals_union_merge(spark):
    from tidemark.operators.cdc import scd1_merge_join

    rows = [("S1", 1, 1.0), ("S1", 2, 2.0), ("S2", 1, 5.0), ("S3", 3, 7.0), ("S2", 4, None), ("S1", 2, 3.0), ("S4", 0, 1.0)]
    batches = [spark.createDataFrame(rows[i:i + 2], "k string, seq int, v double") for i in range(0, len(rows), 2)]
    for order in [(0, 1, 2, 3), (3, 1, 0, 2, 1)]:
        a = b = None
        for i in order:
            a = scd1_merge(a, batches[i], ["k"], ["seq"], ["v"])
            b = scd1_merge_join(b, batches[i], ["k"], ["seq"], ["v"])
        assert sorted(map(tuple, a.collect())) == sorted(map(tuple, b.select(*a.columns).collect()))
