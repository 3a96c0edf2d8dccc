"""A key holding a third of all rows: right answers, and plans that pre-aggregate before shuffling."""

from pyspark.sql import functions as F

from tidemark.operators.cdc import latest_per_key
from tidemark.operators.changes import collapse_duplicates, duplicate_content
from tidemark.operators.ranking import top_row_per_group

N = 30_000


def skewed(spark):
    # Key 0 holds a third of all rows; the rest are spread over 1000 keys.
    return spark.range(N).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 1000 + 1).alias("k"),
        F.col("id").alias("seq"),
        (F.col("id") * 7 % 101).alias("v"),
        F.when(F.col("id") % 3 == 0, F.lit("same text")).otherwise(F.concat(F.lit("t"), F.col("id").cast("string"))).alias("text"),
    ).repartition(8)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_latest_per_key_hot_key(spark):
    df = skewed(spark)
    out = latest_per_key(df, ["k"], ["seq"], ["v"])
    hot = out.filter("k = 0").first()
    assert hot.v == (N - 3) * 7 % 101  # largest seq of key 0 is N - 3
    plan = plan_of(out)
    assert "partial_max" in plan and "Window" not in plan


def test_top_row_per_group_hot_key(spark):
    out = top_row_per_group(skewed(spark), ["k"], ["seq"], ["seq", "v"])
    assert out.count() == 1001
    assert "partial_max" in plan_of(out)


def test_duplicate_collapse_hot_content(spark):
    df = skewed(spark)
    dup = duplicate_content(df.withColumnRenamed("seq", "doc_id"), "doc_id", "text").first()
    assert (dup.first_doc_id, dup.copies) == (0, N // 3)
    kept = collapse_duplicates(df.withColumnRenamed("seq", "doc_id"), "doc_id", "text")
    assert kept.count() == N - N // 3 + 1
    assert "partial_min" in plan_of(kept)
