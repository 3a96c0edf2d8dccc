"""The recorded schema of append-only tables: additive, versioned, read in place of footers, followed by running streams."""

import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tests.test_pipeline import DATA, FIRST, S1, S2, SECOND, SID, VAL, expected_after_both, land, silver_values
from tidemark.plans.series_specs import pr_data
from tidemark.sinks.keyed import KeyedTable
from tidemark.sinks.schema_log import SchemaConflict, SchemaLog, widened
from tidemark.sinks.tables import AppendOnlyTable, write_landing_text
from tidemark.streaming.bronze import refresh_bronze
from tidemark.streaming.silver import read_silver, refresh_silver, start_silver


def test_schema_only_grows(spark):
    one, two = StructType.fromDDL("a int, b string"), StructType.fromDDL("c date, a int")
    assert widened(widened(None, one), two).simpleString() == "struct<a:int,b:string,c:date>"
    for bad in ("a long", "A int"):
        with pytest.raises(SchemaConflict):
            widened(one, StructType.fromDDL(bad))
    assert widened(one, StructType.fromDDL("A int"), case_sensitive=True).names == ["a", "b", "A"]


def test_batches_with_fewer_and_more_columns(spark, scratch):
    table = AppendOnlyTable(spark, f"{scratch}/t")
    assert table.schemas.schema() is None
    table.write_batch(spark.createDataFrame([(1, "x")], "a int, b string"), 0)
    table.write_batch(spark.createDataFrame([(2,)], "a int"), 1)
    assert table.schemas.version() == 0  # nothing new
    table.write_batch(spark.createDataFrame([(3, 2.5)], "a int, c double"), 2)
    table.write_batch(spark.createDataFrame([(3, 2.5)], "a int, c double"), 2)  # replay
    assert table.schemas.version() == 1 and table.schemas.schema(0).names == ["a", "b"]
    assert [tuple(r) for r in table.read().orderBy("a").collect()] == [(1, "x", None, 0), (2, None, None, 1), (3, None, 2.5, 2)]
    with pytest.raises(SchemaConflict):
        table.write_batch(spark.createDataFrame([("y",)], "a string"), 3)
    assert table.read().count() == 3


def test_the_schema_comes_without_opening_old_batches(spark, scratch):
    table = AppendOnlyTable(spark, f"{scratch}/t")
    table.write_batch(spark.range(3), 0)
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(f"{table.path}/batch=0")
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for status in fs.listStatus(root):  # spoil the footers: whoever opens one fails
        if status.getPath().getName().endswith(".parquet"):
            out = fs.create(status.getPath(), True)
            out.write(bytearray(b"not a footer"))
            out.close()
    assert AppendOnlyTable(spark, table.path).read().schema.names == ["id", "batch"]
    table.write_batch(spark.range(5), 1)
    assert table.read().where("batch = 1").count() == 5
    with pytest.raises(Exception):
        spark.read.option("mergeSchema", True).parquet(table.path)  # the control


def test_writers_that_widen_at_once_both_count(spark, scratch):
    out, gate = [], threading.Barrier(4)

    def widen(k):
        log = SchemaLog(spark, f"{scratch}/t")
        gate.wait()
        out.append(log.cover(StructType.fromDDL(f"a int, c{k} string")))

    threads = [threading.Thread(target=widen, args=(k,)) for k in range(4)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(SchemaLog(spark, f"{scratch}/t").schema().names) == ["a", "c0", "c1", "c2", "c3"] and len(out) == 4


def test_bronze_keeps_known_columns_and_one_spelling(spark, layout):
    land(spark, layout, FIRST, S1)
    table = refresh_bronze(spark, DATA, layout)
    lines = ["\t".join(("period", "Series_ID".ljust(17), "year", VAL, "note", "YEAR")), "\t".join(("Q01", "PRS30006019", "2003", "9.0", "extra", "again"))]
    write_landing_text(spark.createDataFrame([("\n".join(lines),)], "value string"), layout.landing, layout.source, DATA.dataset, S2, "drift")
    table = refresh_bronze(spark, DATA, layout)
    assert table.schemas.version() == 1
    assert [n for n in table.schema().names if not n.startswith("_")] == [SID, "year", "period", VAL, "footnote_codes", "note"]
    row = table.read().where("note = 'extra'").first()
    assert (row[SID], row["year"], row["footnote_codes"]) == ("PRS30006019", "2003", None) and "again" in row["_rescued_data"]


def test_running_silver_sees_a_new_column(spark, layout):
    short = (SID, "year", "period", VAL)
    land(spark, layout, [r[:4] for r in FIRST], S1, header=short)
    refresh_bronze(spark, DATA, layout)
    q, target = start_silver(spark, pr_data(2100), layout, DATA.table, rows_per_file=2, trigger={"processingTime": "0 seconds"})
    try:
        q.processAllAvailable()
        assert read_silver(target).where("footnote_codes is not null").count() == 0
        land(spark, layout, SECOND, S2)
        refresh_bronze(spark, DATA, layout)
        q.processAllAvailable()
    finally:
        q.stop()
    assert silver_values(target) == expected_after_both()
    assert [r[0] for r in read_silver(target).where(F.col("footnote_codes") == "P").select("value").collect()] == [3.6]


def test_keyed_silver_agrees(spark, layout):
    for rows, stamp in ((FIRST, S1), (SECOND, S2)):
        land(spark, layout, rows, stamp)
        refresh_bronze(spark, DATA, layout)
        table = refresh_silver(spark, pr_data(2100), layout, DATA.table, rows_per_file=2)
    assert isinstance(table, KeyedTable) and silver_values(table) == expected_after_both()
