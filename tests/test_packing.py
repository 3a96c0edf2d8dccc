"""Compaction of append-only and versioned tables in every layer."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans.series_specs import pr_data
from tidemark.sinks import packing
from tidemark.sinks.keyed import KeyedTable
from tidemark.sinks.manifest import append_manifest
from tidemark.sinks.packing import file_listing, layer_tables, maintain_layers, pack_appends, pack_version, packing_session, sweep_packed
from tidemark.sinks.tables import AppendOnlyTable, CommitConflict, VersionedTable, write_landing_snapshot
from tidemark.streaming.bronze import SourceSpec, refresh_bronze
from tidemark.streaming.silver import read_quarantine, read_silver, refresh_silver

SID, VAL = "series_id".ljust(17), "value".rjust(12)


def filled(spark, path, batches=5, rows=40):
    table = AppendOnlyTable(spark, path)
    for b in range(batches):
        table.write_batch(spark.range(b * rows, (b + 1) * rows, numPartitions=4).toDF("id"), b)
    return table


def rows_of(table):
    return sorted(map(tuple, table.read().collect()))


def files_of(table):
    return file_listing(table.spark, table.live_paths()).count()


def test_small_files_are_packed_across_batches_and_read_the_same(spark, scratch):
    table = filled(spark, f"{scratch}/t")
    want, before = rows_of(table), files_of(table)
    assert pack_appends(table) == 0
    assert (before, files_of(table)) == (20, 1)
    assert rows_of(table) == want and table.read().columns == ["id", "batch"]
    assert pack_appends(table) is None  # nothing to gain


def test_later_batches_join_the_small_folder_and_large_ones_stay(spark, scratch):
    table = filled(spark, f"{scratch}/t")
    pack_appends(table)
    table.write_batch(spark.range(1000, 1040, numPartitions=4).withColumn("new", F.lit("x")).toDF("id", "new"), 5)
    table.write_batch(spark.range(10**6, 10**6 + 200000, numPartitions=1).select("id", F.sha2(F.col("id").cast("string"), 256).alias("new")), 6)
    want = sorted(map(str, table.read().collect()))
    assert pack_appends(table, target_file_bytes=1_000_000) == 1
    at, entry = table.packed()
    assert len(entry["folders"]) == 1 and entry["covered"] == [[0, 5]]  # batch 6 is left as it is
    assert sorted(map(str, table.read().collect())) == want
    assert files_of(table) == 2


def test_bins_follow_the_target_without_a_shuffle(spark, scratch):
    table = AppendOnlyTable(spark, f"{scratch}/t")
    for b in range(4):
        table.write_batch(spark.range(b * 40000, (b + 1) * 40000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("h")), b)
    size = file_listing(spark, table.live_paths()).agg(F.sum("length")).first()[0]
    plan = packing_session(spark, size // 4).read.parquet(table.path)
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    assert 4 <= plan.rdd.getNumPartitions() <= 8
    pack_appends(table, size // 4)
    assert 4 <= files_of(table) <= 9 and table.read().select("id").distinct().count() == 160000


def test_replay_of_a_packed_batch_changes_nothing_and_a_new_batch_is_seen(spark, scratch):
    table = filled(spark, f"{scratch}/t")
    want = rows_of(table)
    pack_appends(table)
    table.write_batch(spark.range(3).toDF("id"), 2)
    assert rows_of(table) == want
    table.write_batch(spark.range(3).toDF("id"), 5)
    assert table.read().count() == len(want) + 3


def test_unfinished_batches_are_not_packed(spark, scratch):
    table = filled(spark, f"{scratch}/t", batches=3)
    jvm = spark.sparkContext._jvm
    marker = jvm.org.apache.hadoop.fs.Path(f"{table.path}/batch=1/_SUCCESS")
    marker.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(marker, False)
    want = rows_of(table)
    pack_appends(table)
    assert table.covered() == {0, 2} and rows_of(table) == want


def test_a_batch_written_again_while_it_is_packed_is_not_swapped(spark, scratch, monkeypatch):
    table = filled(spark, f"{scratch}/t", batches=3)
    want, session = rows_of(table), packing.packing_session

    def meanwhile(*args):
        table.write_batch(spark.range(40, 80, numPartitions=3).toDF("id"), 1)
        return session(*args)

    monkeypatch.setattr(packing, "packing_session", meanwhile)
    with pytest.raises(CommitConflict):
        pack_appends(table)
    assert table.packed() == (None, None) and rows_of(table) == want


def test_of_two_packings_one_is_published(spark, scratch, monkeypatch):
    table = filled(spark, f"{scratch}/t", batches=3)
    want, session = rows_of(table), packing.packing_session

    def meanwhile(*args):
        monkeypatch.setattr(packing, "packing_session", session)
        pack_appends(AppendOnlyTable(spark, table.path))
        return session(*args)

    monkeypatch.setattr(packing, "packing_session", meanwhile)
    with pytest.raises(CommitConflict):
        pack_appends(table)
    assert table.packed()[0] == 0 and rows_of(table) == want


def test_sweep_keeps_what_readers_take_and_is_recorded(spark, scratch):
    table = filled(spark, f"{scratch}/t")
    assert sweep_packed(table, 0) == []
    want = rows_of(table)
    pack_appends(table)
    first = table.packed()[1]["folders"][0]
    table.write_batch(spark.range(1000, 1010, numPartitions=2).toDF("id"), 5)
    pack_appends(table)
    spark.range(3).write.parquet(f"{table.path}/_packed/p-cut-short")
    assert sweep_packed(table, 168, dry_run=False) == [] and not table.swept()
    dead = sweep_packed(table, 0)
    assert dead[:6] == [f"batch={b}" for b in range(6)] and set(dead[6:]) == {f"_packed/{first}", "_packed/p-cut-short"}
    assert sweep_packed(table, 0, dry_run=False) == dead and sweep_packed(table, 0) == []
    assert table.swept() and rows_of(table) == sorted(want + [(i, 5) for i in range(1000, 1010)])
    assert table.packs.removed().count() == len(dead)


def test_a_packed_ledger_still_refuses_another_runs_sequence(spark, scratch):
    ledger = AppendOnlyTable(spark, f"{scratch}/ledger")

    def run(name):
        return spark.createDataFrame([("s", "d", "20260101T000000Z", "FETCHED", 200, "ab", None, 1, "u", "/p", name, None)],
                                     "source string, dataset string, ingest_ts string, status string, http_status int, content_sha256 string, last_modified string, "
                                     "bytes bigint, source_url string, landing_path string, run_id string, error_message string").withColumn("fetched_at", F.current_timestamp())

    for seq in range(3):
        append_manifest(ledger, run(f"r{seq}"), seq)
    pack_appends(ledger)
    sweep_packed(ledger, 0, dry_run=False)
    append_manifest(ledger, run("r1"), 1)  # a replay
    with pytest.raises(ValueError, match="another run"):
        append_manifest(ledger, run("r9"), 1)
    assert sorted(r.run_id for r in ledger.read().collect()) == ["r0", "r1", "r2"]


def land(spark, layout, stamp, rows):
    df = spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in (SID, "year", "period", VAL, "footnote_codes")))
    write_landing_snapshot(df, layout.landing, layout.source, "pr.data.1.AllData", stamp)


def test_streams_go_on_over_packed_and_swept_layers(spark, layout):
    spec = SourceSpec("pr.data.1.AllData", "pr_data_1_alldata")
    for k in range(2):
        land(spark, layout, f"2026010{k + 1}T000000Z", [("A", "2001", "Q01", f"{k}.5", ""), ("B", "2001", "Q09", "1", "")])
        refresh_bronze(spark, spec, layout)
        refresh_silver(spark, pr_data(2100), layout, spec.table)
    done = {(r.layer, r.table_name): r for r in maintain_layers(spark, layout.tables).collect()}
    assert {k[0] for k in done} == {"bronze", "silver", "quarantine", "_expectations"}
    assert done["bronze", spec.table].outcome == "packed" and done["bronze", spec.table].n_rows == 4
    assert done["quarantine", "pr_data"].n_rows == 2
    bronze = AppendOnlyTable(spark, layout.table_path("bronze", spec.table))
    sweep_packed(bronze, 0, dry_run=False)
    land(spark, layout, "20260103T000000Z", [("A", "2001", "Q01", "9.5", ""), ("C", "2001", "Q02", "2.5", "")])
    refresh_bronze(spark, spec, layout)
    silver = read_silver(refresh_silver(spark, pr_data(2100), layout, spec.table))
    assert {(r.series_id, r.value) for r in silver.collect()} == {("A", 9.5), ("C", 2.5)}
    assert read_quarantine(spark, layout, "pr_data").count() == 2 and bronze.read().count() == 6
    other = type(layout)(layout.landing, layout.tables, f"{layout.checkpoints}-lost", layout.source)
    with pytest.raises(RuntimeError, match="swept"):
        refresh_silver(spark, pr_data(2100), other, spec.table)


def test_versioned_keyed_and_empty_tables(spark, scratch):
    plain = VersionedTable(spark, f"{scratch}/gold/plain")
    plain.commit(spark.range(100, numPartitions=10).toDF("k"))
    KeyedTable(spark, f"{scratch}/silver/keyed", ["k"]).commit(spark.range(10).toDF("k"))
    AppendOnlyTable(spark, f"{scratch}/bronze/none").write_batch(spark.range(0).toDF("id"), 0)
    assert pack_version(VersionedTable(spark, f"{scratch}/gold/absent")) is None
    got = {r.table_name: r for r in maintain_layers(spark, scratch).collect()}
    assert (got["plain"].outcome, got["plain"].files_before, got["plain"].files_after, got["plain"].n_rows) == ("packed", 10, 1, 100)
    assert got["keyed"].kind == "keyed" and got["keyed"].n_rows == 10
    assert (got["none"].outcome, got["none"].n_rows) == ("nothing to gain", 0)
    assert [t[:3] for t in layer_tables(spark, scratch)] == [("bronze", "none", "append-only"), ("gold", "plain", "versioned"), ("silver", "keyed", "versioned")]
    assert plain.read(0).count() == plain.read().count() == 100 and plain.current_version() == 1
