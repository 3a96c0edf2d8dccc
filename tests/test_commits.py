"""Commits that cannot replace committed data, log checkpoints, swapped refreshes and retention."""

import threading

import pytest
from pyspark.sql import functions as F

from tidemark.sinks import commits
from tidemark.sinks.maintenance import abandoned_attempts, compact, retain
from tidemark.sinks.tables import CommitConflict, VersionedTable, materialize
from tidemark.session import path_exists


def rows(spark, n):
    return spark.range(n).toDF("k")


def test_late_writer_cannot_replace_committed_rows(spark, scratch):
    table, other = VersionedTable(spark, f"{scratch}/t"), VersionedTable(spark, f"{scratch}/t")
    start = table.commit(rows(spark, 10))
    late = table.prepare(rows(spark, 3), current=start)
    assert other.commit(rows(spark, 25), current=start) == 1
    with pytest.raises(CommitConflict):
        table.publish(late)
    assert table.current_version() == 1 and table.read().count() == 25 and table.read(0).count() == 10
    assert [r["rows"] for r in table.log().orderBy("version").collect()] == [10, 25]
    with pytest.raises(CommitConflict):  # overtaken before the write
        table.commit(rows(spark, 4), current=start)


def test_of_many_writers_one_publishes(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t")
    start = table.commit(rows(spark, 1))
    attempts = [table.prepare(rows(spark, 100 + k), current=start) for k in range(6)]
    out, gate = [], threading.Barrier(6)

    def publish(attempt):
        gate.wait()
        try:
            out.append(table.publish(attempt))
        except CommitConflict:
            out.append(None)

    threads = [threading.Thread(target=publish, args=(a,)) for a in attempts]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert sorted(out, key=str) == [1] + [None] * 5
    assert table.log().count() == 2 and table.read().count() == table.commits.entry(1)["rows"]


def test_independent_refreshes_all_stay(spark, scratch):
    first = VersionedTable(spark, f"{scratch}/t")
    late = first.prepare(rows(spark, 5))
    first.commit(rows(spark, 6))
    assert first.publish(late) == 1 and first.read().count() == 5 and first.read(0).count() == 6


def test_refresh_swaps_and_may_read_itself(spark, scratch):
    before = materialize(rows(spark, 5), f"{scratch}/g")
    after = materialize(before.withColumn("k", F.col("k") + 1), f"{scratch}/g")
    assert sorted(r.k for r in before.collect()) == [0, 1, 2, 3, 4]  # not overwritten under its reader
    assert sorted(r.k for r in after.collect()) == [1, 2, 3, 4, 5]
    with pytest.raises(Exception):
        materialize(after.withColumn("k", F.raise_error(F.lit("fails"))), f"{scratch}/g")
    assert VersionedTable(spark, f"{scratch}/g").read().count() == 5


def test_checkpoints_keep_the_whole_log(spark, scratch, monkeypatch):
    monkeypatch.setattr(commits, "CHECKPOINT_EVERY", 3)
    table = VersionedTable(spark, f"{scratch}/t")
    for k in range(8):
        table.commit(rows(spark, k), batch_id=k, stream="s")
    assert [(r["version"], r["rows"], r["batch_id"]) for r in table.log().orderBy("version").collect()] == [(k, k, k) for k in range(8)]
    opened = {f.rsplit("/", 2)[-2] if "/checkpoint-0" in f else f.rsplit("/", 1)[-1] for f in table.log().inputFiles()}
    assert opened == {"checkpoint-0000000006", "0000000007.json"}
    assert table.committed_batch(2, "s") and not table.committed_batch(2, "other") and not table.committed_batch(9, "s")


def test_retention_sweeps_once_and_records(spark, scratch):
    table = VersionedTable(spark, f"{scratch}/t")
    for k in range(3):
        table.commit(rows(spark, 10 + k))
    lost = table.prepare(rows(spark, 99), current=2)
    table.commit(rows(spark, 13), current=2)
    assert abandoned_attempts(table, 0) == [lost.entry["folder"]] and abandoned_attempts(table, 1) == []
    assert retain(table, 0) == [0, 1, 2] and retain(table, 168) == []
    old = table.version_path(1)
    assert retain(table, 0, dry_run=False) == [0, 1, 2]
    assert not path_exists(spark, old) and not path_exists(spark, f"{table.path}/{lost.entry['folder']}")
    assert retain(table, 0) == [] == retain(table, 0, dry_run=False) and abandoned_attempts(table, 0) == []
    assert sorted(((r["version"], r["folder"].split("-")[0]) for r in table.commits.removed().collect()), key=str) == [(0, "v=0"), (1, "v=1"), (2, "v=2"), (None, "v=3")]
    assert table.read().count() == 13
    compact(table)
    assert table.read().count() == 13 and retain(table, 0) == [3]
