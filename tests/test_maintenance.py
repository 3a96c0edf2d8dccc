import pytest
from pyspark.sql import functions as F

from tidemark.sinks import maintenance
from tidemark.sinks.maintenance import compact, file_stats, retain, retention_plan
from tidemark.sinks.manifest import ERROR, FETCHED, UNCHANGED, manifest_rows
from tidemark.sinks.tables import AppendOnlyTable, CommitConflict, VersionedTable, write_landing_snapshot
from tidemark.sources.delimited import read_delimited


def test_versioned_table_ignores_uncommitted_version(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/t")
    t.commit(spark.range(5))
    # A crash after writing data but before the log row leaves v=1 uncommitted.
    spark.range(100).write.parquet(t.version_path(1))
    assert t.current_version() == 0 and t.read().count() == 5
    t.commit(spark.range(7))  # the retry overwrites the orphan
    assert t.current_version() == 1 and t.read().count() == 7


def test_compaction_same_rows_fewer_files(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/c")
    t.commit(spark.range(1000).repartition(20))
    before, _ = file_stats(t.read())
    compact(t, cluster_by=["id"])
    after, _ = file_stats(t.read())
    assert after < before and t.read().count() == 1000


def test_retention_dry_run_then_delete(spark, scratch):
    t = VersionedTable(spark, f"{scratch}/r")
    for n in (3, 4, 5):
        t.commit(spark.range(n))
    assert sorted(r.version for r in retention_plan(t, 0).collect()) == [0, 1]
    assert retain(t, 0, dry_run=True) == [0, 1]
    assert retain(t, 168, dry_run=True) == []
    retain(t, 0, dry_run=False)
    assert t.read().count() == 5


def test_append_only_table_replay_and_guard(spark, scratch):
    a = AppendOnlyTable(spark, f"{scratch}/a")
    a.write_batch(spark.range(3), 0)
    a.write_batch(spark.range(3), 0)  # replay of batch 0
    a.write_batch(spark.range(2), 1)
    assert a.read().count() == 5
    try:
        a.overwrite(spark.range(1))
        raise AssertionError("overwrite must be refused")
    except PermissionError:
        pass


def test_manifest_null_rules(spark):
    rows = spark.createDataFrame(
        [
            ("bls_pr", "pr.class", "20260909T163000Z", FETCHED, 200, "abc", "Tue", 102, "u", "/p", "local", None, None),
            ("bls_pr", "pr.series", "20260909T163000Z", UNCHANGED, 304, None, "Mon", 5, "u", "/p", "local", None, None),
            ("bls_pr", "_directory_listing", "20260909T163000Z", ERROR, None, "x", "y", 1, "u", "/p", "local", None, "boom"),
        ],
        "source string, dataset string, ingest_ts string, status string, http_status int, content_sha256 string, "
        "last_modified string, bytes bigint, source_url string, landing_path string, run_id string, "
        "fetched_at timestamp, error_message string",
    ).withColumn("fetched_at", F.current_timestamp())
    got = {r.status: r for r in manifest_rows(rows).collect()}
    assert got[FETCHED].bytes == 102 and got[FETCHED].landing_path == "/p"
    assert got[UNCHANGED].last_modified == "Mon" and got[UNCHANGED].bytes is None and got[UNCHANGED].landing_path is None
    e = got[ERROR]
    assert (e.content_sha256, e.last_modified, e.bytes, e.landing_path, e.error_message) == (None, None, None, None, "boom")
    assert len(manifest_rows(rows).columns) == 13


def test_compaction_does_not_replace_a_commit_made_meanwhile(spark, scratch, monkeypatch):
    table = VersionedTable(spark, f"{scratch}/raced")
    table.commit(spark.range(10).toDF("k"))
    stats = maintenance.file_stats

    def overtaken(df):
        table.commit(spark.range(25).toDF("k"))
        return stats(df)

    monkeypatch.setattr(maintenance, "file_stats", overtaken)
    with pytest.raises(CommitConflict):
        maintenance.compact(table)
    assert table.current_version() == 1 and table.read().count() == 25


def test_landing_keeps_commas_quotes_and_padding_and_rejects_breaks(spark, scratch):
    rows = [("k1", "Smith, John"), ("k2", 'say "hi", \\ and \\n'), ("k3", "  padded  "), ("k4", ""), ("k5", "#1, 'x'")]
    write_landing_snapshot(spark.createDataFrame(rows, "key string, name string"), scratch, "s", "d", "20260101T000000Z")
    got = read_delimited(spark, f"{scratch}/s/d/d__20260101T000000Z").select("key", "name", "_rescued_data").collect()
    assert sorted(map(tuple, got)) == [(*r, None) for r in rows]
    for k, value in enumerate(("a\tb", "a\nb", "a\rb", "a\x00b", "a\x01b")):
        with pytest.raises(Exception, match="separator or a line break"):
            write_landing_snapshot(spark.createDataFrame([("k", value)], "key string, name string"), scratch, "s", f"bad{k}", "20260101T000000Z")
