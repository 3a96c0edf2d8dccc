"""Upserts that rewrite only touched files: same rows as the plain merge, fewer files, any key."""

import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators.cdc import scd1_merge
from tidemark.sinks.keyed import KeyedTable, dyadic, file_cells
from tidemark.sinks.maintenance import compact, retain
from tidemark.sinks.tables import CommitConflict

LONG = st.integers(-(1 << 63), (1 << 63) - 1)


def rows(df):
    return sorted(str(tuple(r)) for r in df.select(*sorted(df.columns)).collect())


@given(LONG, LONG, LONG)
def test_a_place_lies_in_one_cell_of_its_range_and_in_none_outside(a, b, x):
    low, high = min(a, b), max(a, b)
    cells = list(dyadic(low, high))
    assert len(cells) < 128 and sum(1 << level for level, _ in cells) == high - low + 1
    assert sum(x >> level == cell for level, cell in cells) == (low <= x <= high)


@given(st.tuples(st.integers(-4, 4), LONG), st.tuples(st.integers(-4, 4), LONG), st.tuples(st.integers(-5, 5), LONG))
def test_file_cells_hold_places_between_the_ends(a, b, x):
    low, high = min(a, b), max(a, b)
    held = sum(x[0] >> o == c and (h == 64 or x[1] >> h == d) for o, c, h, d in file_cells(low, high))
    assert held == (low <= x <= high)


def base(spark, n=8_000):
    return spark.range(n).select(F.col("id").alias("k"), F.lit(1).alias("seq"), (F.col("id") * 3).alias("v"))


def used(table, version):
    return {(r["folder"], r["file"]) for r in table.files(version).collect()}


def test_a_small_batch_rewrites_a_share_of_the_files_and_a_scattered_one_all(spark, scratch):
    table = KeyedTable(spark, f"{scratch}/t", ["k"], rows_per_file=200)
    start = table.commit(base(spark))
    local = spark.range(7000, 7080).select(F.col("id").alias("k"), F.lit(2).alias("seq"), F.lit(0).cast("long").alias("v"))
    table.upsert(local, ["seq"], batch_id=1, stream="s")
    before, after = used(table, start), used(table, start + 1)
    assert len(before) >= 35 and 1 <= len(before - after) <= 3  # 1 % of the keys
    assert rows(table.read()) == rows(scd1_merge(base(spark), local, ["k"], ["seq"]))
    assert rows(table.read(start)) == rows(base(spark)) and table.committed_batch(1, "s")
    scattered = spark.range(0, 8000, 40).select(F.col("id").alias("k"), F.lit(3).alias("seq"), F.lit(9).cast("long").alias("v"))
    table.upsert(scattered, ["seq"])
    assert len(after & used(table, start + 2)) <= 2  # nothing to spare: the control
    again = used(table, start + 2)
    table.upsert(local, ["seq"])  # late: loses, changes nothing
    assert rows(table.read(start + 3)) == rows(table.read(start + 2)) and len(again - used(table, start + 3)) <= 3


def test_inserts_inside_ranges_touch_hardly_any_file(spark, scratch):
    table = KeyedTable(spark, f"{scratch}/t", ["k"], rows_per_file=200)
    even = base(spark).withColumn("k", F.col("k") * 2)
    start = table.commit(even)
    odd = spark.range(0, 8000, 160).select((F.col("id") * 2 + 1).alias("k"), F.lit(1).alias("seq"), F.col("id").alias("v"))
    table.upsert(odd, ["seq"])
    assert len(used(table, start) - used(table, start + 1)) <= 4  # the filters; by ranges alone all of them
    assert rows(table.read()) == rows(even.unionByName(odd))


def test_a_hot_first_key_is_split_over_files(spark, scratch):
    keyed = spark.range(8000).select(
        F.when(F.col("id") < 6000, "PRS30006").otherwise(F.concat(F.lit("PRS3"), F.lpad(F.col("id").cast("string"), 6, "0"))).alias("series"),
        F.col("id").cast("int").alias("year"), F.lit(1).alias("seq"), F.lit(1.5).alias("v"))
    table = KeyedTable(spark, f"{scratch}/t", ["series", "year"], rows_per_file=250)
    start = table.commit(keyed)
    assert table.files().agg(F.max("rows")).first()[0] < 1000
    batch = spark.createDataFrame([("PRS30006", 17, 2, 2.5), ("PRS3007001", 7001, 2, 2.5), (None, 1, 2, 2.5), ("A", None, 2, 2.5), ("PRS30006", 99_999, 2, 2.5)], "series string, year int, seq int, v double")
    table.upsert(batch, ["seq"])
    assert len(used(table, start) - used(table, start + 1)) <= 3
    table.upsert(batch, ["seq"])  # replay, null keys too
    assert rows(table.read()) == rows(scd1_merge(keyed, batch, ["series", "year"], ["seq"]))


@pytest.mark.parametrize("kind", ["date", "timestamp", "double", "decimal(38,2)", "boolean", "binary", "string"])
def test_keys_of_any_type(spark, scratch, kind):
    made = {"date": "date_add(date'1960-01-01', cast(id * 40 as int))", "timestamp": "timestamp_micros(id * 1000003 - 5000000)", "double": "case id when 3 then double('NaN') when 0 then double('-0.0') else id * 1e300 end",
            "decimal(38,2)": "cast(id as decimal(38,2)) * 1e30bd", "boolean": "id % 2 = 0", "binary": "cast(cast(id as string) as binary)", "string": "concat('ключ-', id)"}[kind]
    df = spark.range(400).selectExpr(f"cast({made} as {kind}) as k", "1 as seq", "id as v").groupBy("k").agg(F.max("seq").alias("seq"), F.max("v").alias("v"))
    table = KeyedTable(spark, f"{scratch}/t", ["k"], rows_per_file=50)
    table.commit(df)
    batch = df.where("v % 40 < 4").withColumn("seq", F.lit(2)).withColumn("v", -F.col("v"))
    if kind == "double":
        batch = batch.withColumn("k", F.col("k") + 0.0)  # no negative zero
    table.upsert(batch, ["seq"])
    out = scd1_merge(df, batch, ["k"], ["seq"])
    assert rows(table.read()) == rows(out) and table.log().orderBy("version").collect()[-1]["rows"] == out.count()


def test_empty_batches_new_and_missing_columns_and_races(spark, scratch):
    table, other = (KeyedTable(spark, f"{scratch}/t", ["k"], rows_per_file=500) for _ in range(2))
    assert table.read() is None
    table.upsert(base(spark, 0), ["seq"])
    assert table.read().count() == 0
    table.upsert(base(spark, 2000), ["seq"])
    table.upsert(base(spark, 0), ["seq"], batch_id=7, stream="s")
    assert table.read().count() == 2000 and other.committed_batch(7, "s") and used(table, 1) == used(table, 2)
    table.upsert(spark.createDataFrame([(5, 2, "new")], "k int, seq int, note string"), ["seq"])  # narrower key, v missing, note new
    got = {r["k"]: (r["v"], r["note"]) for r in table.read().where("k < 7").collect()}
    assert got[5] == (None, "new") and got[6] == (18, None) and table.read().count() == 2000
    late = other.prepare_upsert(base(spark, 3), ["seq"], current=3)
    table.upsert(base(spark, 10).withColumn("seq", F.lit(9)), ["seq"])
    with pytest.raises(CommitConflict):
        other.publish(late)
    assert table.read().where("seq = 9").count() == 10


def test_compaction_and_sweep_keep_what_a_version_names(spark, scratch):
    table = KeyedTable(spark, f"{scratch}/t", ["k"], rows_per_file=500)
    table.commit(base(spark, 4000))
    for i in range(3):
        table.upsert(base(spark, 4000).where(f"k between {i * 1000} and {i * 1000 + 9}").withColumn("seq", F.lit(2 + i)), ["seq"])
    table.prepare(base(spark, 5))  # an attempt that is never published
    want = rows(table.read())
    assert table.sweep(0).count() == 1  # all files belong to some version, but the attempt's
    assert retain(table, 0, dry_run=False) == [0, 1, 2]
    gone = table.sweep(0, dry_run=False)
    assert gone.count() > 1 and table.sweep(0).count() == 0 and rows(table.read()) == want
    compact(table)
    retain(table, 0, dry_run=False)
    table.sweep(0, dry_run=False)
    assert rows(table.read()) == want and table.files().count() <= 9
