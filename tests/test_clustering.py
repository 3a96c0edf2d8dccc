"""Clustering on several keys: same rows, narrow files in each key, keys from statistics."""

import pytest
from pyspark.sql import functions as F

from tidemark.sinks.clustering import choose_keys, cluster, clustered, file_ranges, files_read
from tidemark.sinks.keyed import KeyedTable
from tidemark.sinks.packing import file_listing
from tidemark.sinks.tables import VersionedTable


@pytest.fixture(scope="module")
def points(spark):
    n = 40000
    x, y = F.pmod(F.xxhash64("id"), F.lit(1000)), F.pmod(F.xxhash64("id", F.lit(7)), F.lit(1000))
    df = spark.range(n).select("id", x.alias("x"), y.alias("y"), (x * 3 + 5).alias("x3"), F.lit(1).alias("one"), F.repeat(F.sha2(F.col("id").cast("string"), 256), 3).alias("body"))
    return df.cache()


def stored(spark, df, path):
    df.write.parquet(path)
    return spark.read.parquet(path)


def test_keys_leave_out_constants_contents_and_what_rises_together(points):
    keys = choose_keys(points.drop("id"))
    assert set(keys) == {"x", "y"} or set(keys) == {"x3", "y"}


def test_a_filter_on_either_key_or_both_reads_a_share_of_the_files(spark, scratch, points):
    z = file_ranges(stored(spark, clustered(points, ["x", "y"], 64), f"{scratch}/z"), ["x", "y"])
    one = file_ranges(stored(spark, points.repartitionByRange(64, "x", "y").sortWithinPartitions("x", "y"), f"{scratch}/one"), ["x", "y"])
    assert files_read(z, x=(500, 550)) <= 0.4 and files_read(z, y=(500, 550)) <= 0.4
    assert files_read(z, x=(500, 550), y=(500, 550)) <= 0.1
    assert files_read(one, y=(500, 550)) == 1.0  # the order by x alone does not serve y


def test_cluster_commits_the_same_rows(spark, scratch, points):
    table = VersionedTable(spark, f"{scratch}/t")
    table.commit(points.drop("x3", "id"))
    size = file_listing(spark, [table.version_path(0)]).agg(F.sum("length")).first()[0]
    version, keys = cluster(table, target_file_bytes=size // 64)
    assert version == 1 and "x" in keys and "y" in keys
    assert table.read().schema == table.read(0).schema
    assert table.read().exceptAll(table.read(0)).isEmpty() and table.read().count() == 40000


def test_a_hot_value_is_spread_over_files(spark, scratch):
    df = spark.range(30000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.lit(2.5).alias("v"))
    sizes = [r["rows"] for r in file_ranges(stored(spark, clustered(df, ["k", "v"], 10), f"{scratch}/hot"), ["k"]).collect()]
    assert sum(sizes) == 30000 and max(sizes) <= 6000


@pytest.mark.parametrize("column", ["date", "timestamp", "timestamp_ntz", "double", "float", "decimal(20,3)", "string", "int", "long"])
def test_files_are_ranges_of_keys_of_any_type(spark, scratch, column):
    raw = F.when(F.col("id") % 50 > 0, F.col("id") - 4000)
    value = {"date": F.date_add(F.lit("2020-01-01").cast("date"), raw.cast("int")), "timestamp": F.timestamp_seconds(raw * 3600),
             "timestamp_ntz": F.timestamp_seconds(raw * 3600).cast("timestamp_ntz"), "string": F.concat(F.lit("key-"), F.lpad((raw + 4000).cast("string"), 6, "0"))}.get(column, raw.cast(column))
    df = spark.range(8000).select(value.cast(column).alias("k k"), F.col("id").alias("__place2"))
    out = stored(spark, clustered(df, ["k k"], 8).withColumnRenamed("k k", "k"), f"{scratch}/typed")
    rows = sorted((r["low_k"], r["high_k"]) for r in file_ranges(out, ["k"]).where("low_k is not null").collect())
    assert out.count() == 8000 and len(rows) >= 7
    inner = sum(b[0] < a[1] for a, b in zip(rows, rows[1:]))
    assert inner <= 3  # nulls lie at ordinal 0, buckets may be shared by two neighbours


def test_infinities_empty_tables_and_tables_without_a_key(spark, scratch):
    odd = spark.createDataFrame([(float("nan"), 1), (float("inf"), 2), (float("-inf"), 3), (None, 4), (1e300, 5), (-0.0, 6)], "v double, n long")
    assert sorted(r.n for r in clustered(odd, ["v", "n"], 3).collect()) == [1, 2, 3, 4, 5, 6]
    empty = VersionedTable(spark, f"{scratch}/empty")
    empty.commit(spark.range(0).toDF("k"))
    assert cluster(empty)[1] == [] and empty.read().count() == 0
    assert clustered(spark.range(0).toDF("k"), ["k"], 4).count() == 0
    maps = VersionedTable(spark, f"{scratch}/maps")
    maps.commit(spark.range(10).select(F.create_map("id", "id").alias("m")))
    assert cluster(maps)[1] == [] and maps.read().count() == 10
    with pytest.raises(ValueError, match="own order"):
        cluster(KeyedTable(spark, f"{scratch}/keyed", ["k"]))
