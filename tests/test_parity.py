"""Multiset parity by bucket fingerprints."""

import pytest
from pyspark.sql import DataFrame

from tidemark.operators.parity import bucket_fingerprints, differing_buckets, multiset_difference
from tidemark.plans.gold import twin_difference

SCHEMA = "k int, v double, t string"
ROWS = [(k % 50, float(k % 7), None if k % 5 == 0 else f"t{k % 3}") for k in range(600)]


def frame(spark, rows, parts=3):
    return spark.createDataFrame(rows, SCHEMA).repartition(parts)


def test_equal_frames_compare_no_rows(spark, monkeypatch):
    def never(*_):
        raise AssertionError("rows were compared")

    classic = type(frame(spark, ROWS))
    monkeypatch.setattr(classic, "exceptAll", never)
    assert multiset_difference(frame(spark, ROWS), frame(spark, ROWS[::-1], 5)) is None
    assert twin_difference(frame(spark, []), frame(spark, [])) == (0, 0)
    with pytest.raises(AssertionError, match="rows were compared"):  # negative control
        multiset_difference(frame(spark, ROWS), frame(spark, ROWS[1:]))


def test_one_changed_value_and_multiplicities(spark):
    changed = [(1, 99.0, "x"), *ROWS[1:]]
    lost, new = multiset_difference(frame(spark, ROWS), frame(spark, changed))
    assert [tuple(r) for r in lost.collect()] == [ROWS[0]] and [tuple(r) for r in new.collect()] == [changed[0]]
    assert len(differing_buckets(frame(spark, ROWS), frame(spark, changed))) <= 2
    twice = [*ROWS, ROWS[3], ROWS[3]]
    assert twin_difference(frame(spark, ROWS), frame(spark, twice)) == (0, 2)
    assert twin_difference(frame(spark, twice), frame(spark, [])) == (602, 0)


def test_zero_signs_and_swapped_columns(spark):
    assert twin_difference(frame(spark, [(1, 0.0, None)]), frame(spark, [(1, -0.0, None)])) == (0, 0)  # as exceptAll has it
    nan = float("nan")
    assert twin_difference(frame(spark, [(1, nan, "a"), (None, nan, None)]), frame(spark, [(None, nan, None), (1, nan, "a")])) == (0, 0)
    with pytest.raises(ValueError):
        twin_difference(frame(spark, []), frame(spark, []).select("v", "k", "t"))


def test_only_sums_are_shuffled(spark):
    plan = bucket_fingerprints(frame(spark, ROWS).select("k", "v"))._jdf.queryExecution().executedPlan().toString()
    assert "partial_sum" in plan and isinstance(frame(spark, ROWS), DataFrame)
