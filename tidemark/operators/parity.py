"""Whether two frames hold the same rows, without moving the rows.

Rows are dealt to ``BUCKETS`` by a hash and each bucket is summed up, inside its tasks, as a count and the sums of two 64-bit row hashes: an order-free
fingerprint of the bucket's rows with their multiplicities. Equal frames differ in no bucket, and only these few sums are shuffled. Where
buckets differ, the rows of just these are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BUCKETS = 4096


def _hash(df: DataFrame, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), *(F.col(f"`{c}`") for c in df.columns))


def bucket_fingerprints(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n, one, two: ``buckets`` rows at most."""
    hashed = df.select(_hash(df, 1).alias("h"), _hash(df, 2).alias("g"))
    total = lambda c: F.sum(F.col(c).cast("decimal(28,0)"))
    return hashed.groupBy(F.pmod("h", F.lit(buckets)).alias("bucket")).agg(F.count(F.lit(1)).alias("n"), total("h").alias("one"), total("g").alias("two"))


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """The buckets whose rows differ, at most ``buckets`` numbers."""
    x, y = bucket_fingerprints(a, buckets), bucket_fingerprints(b, buckets)
    same = x.select("bucket", "n", "one", "two").intersect(y.select("bucket", "n", "one", "two"))
    every = x.select("bucket").union(y.select("bucket")).distinct()
    return sorted(r["bucket"] for r in every.join(same, "bucket", "left_anti").collect())


def multiset_difference(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> tuple[DataFrame, DataFrame] | None:
    """(rows of ``a`` that ``b`` lacks, rows of ``b`` that ``a`` lacks) with multiplicities; None if there are none.

    Rows are equal as ``exceptAll`` has it: NULL equals NULL, and values that only print alike differ. Columns must agree in
    number and type.
    """
    b = b.toDF(*a.columns)
    differ = differing_buckets(a, b, buckets)
    if not differ:
        return None
    some = a.sparkSession.createDataFrame([(k,) for k in differ], "differing_bucket long")

    def held(df: DataFrame) -> DataFrame:
        return df.join(F.broadcast(some), F.pmod(_hash(df, 1), F.lit(buckets)) == some["differing_bucket"], "left_semi")

    left, right = held(a), held(b)
    return left.exceptAll(right), right.exceptAll(left)
