"""Broadcast hints need few rows and few bytes."""

from tidemark.operators.joins import checked_dimension, row_bytes, sized_broadcast


def hinted(df):
    return "broadcast" in df._jdf.queryExecution().logical().toString().lower()


def test_few_long_rows_are_not_hinted(spark):
    df = spark.createDataFrame([(k, "x" * 1000) for k in range(50)], "k int, t string")
    assert hinted(sized_broadcast(df)) and hinted(checked_dimension(df, ["k"])) and hinted(checked_dimension(df))
    assert not hinted(sized_broadcast(df, max_bytes=40_000)) and not hinted(sized_broadcast(df, max_rows=49))
    assert not hinted(checked_dimension(df, ["k"], max_bytes=40_000)) and not hinted(checked_dimension(df, max_bytes=40_000))
    assert hinted(sized_broadcast(df.limit(0)))


def test_row_bytes_by_type(spark):
    df = spark.createDataFrame([(1, "é", [1, 2], None), (2, None, None, bytearray(b"abc"))], "a int, t string, l array<int>, b binary")
    assert [r[0] for r in df.select(row_bytes(df)).collect()] == [64 + 2 + len('{"l":[1,2]}'), 64 + len("{}") + 3]
