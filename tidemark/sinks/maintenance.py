"""Compaction and retention of versioned tables.

Compaction writes a new version with the same rows in fewer, larger files
(optionally range-clustered on keys); retention marks versions that are
no longer current and older than a cutoff, sweeps them together with folders that no log
entry names (lost races, crashed attempts), and records what it removed. Both go through
:class:`VersionedTable`, so readers always see a committed version, and a
compaction that another commit has overtaken fails with ``CommitConflict``.
"""

from __future__ import annotations

import math
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.tables import BucketedVersionedTable, VersionedTable

DEFAULT_TARGET_FILE_BYTES = 128 * 1024 * 1024


def file_stats(df: DataFrame) -> tuple[int, int]:
    """(number of files, total bytes) behind a file-based DataFrame."""
    files = df.select("_metadata.file_path", "_metadata.file_size").distinct()
    row = files.agg(F.count(F.lit(1)).alias("n"), F.sum("file_size").alias("b")).first()
    return int(row["n"] or 0), int(row["b"] or 0)


def compact(table: VersionedTable, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES, cluster_by: list[str] | None = None) -> int:
    """Rewrite the current version into ceil(bytes / target) files; returns the new version.

    With ``cluster_by`` rows are range-partitioned and sorted on those keys
    (so later scans prune by min/max statistics); otherwise rows are
    redistributed round-robin.
    """
    version = table.current_version()
    if version is None:
        raise ValueError(f"{table.path} has no committed version")
    current = table.read(version)
    _, size = file_stats(current)
    n_files = max(1, math.ceil(size / target_file_bytes))
    if cluster_by:
        out = current.repartitionByRange(n_files, *cluster_by).sortWithinPartitions(*cluster_by)
    else:
        out = current.repartition(n_files)
    return table.commit(out, note="compact", current=version)


def _cutoff(older_than_hours: float):
    return F.current_timestamp() - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), F.lit(float(older_than_hours) * 3600))


def retention_plan(table: VersionedTable, older_than_hours: float) -> DataFrame:
    """Versions that retention would remove: not current, committed before now - hours, not removed before."""
    log = table.log()
    if log is None:
        raise ValueError(f"{table.path} has no commits")
    old = log.filter((F.col("version") != table.current_version()) & (F.col("committed_at") < _cutoff(older_than_hours)))
    return old.join(table.commits.removed().select("folder").distinct(), "folder", "left_anti").select(
        "version", "committed_at", F.concat(F.lit(table.path + "/"), "folder").alias("path"), "rows", "folder", "catalog_table"
    )


def abandoned_attempts(table: VersionedTable, older_than_hours: float) -> list[str]:
    """Data folders that no log entry names and that were last changed before now - hours.

    A writer that needs longer than that for one commit would lose its attempt, so keep the cutoff above the longest write.
    Only folder names reach the driver.
    """
    spark = table.spark
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(table.path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    bound = (time.time() - older_than_hours * 3600) * 1000
    found = [s.getPath().getName() for s in fs.listStatus(root) if s.isDirectory() and s.getPath().getName().startswith("v=") and s.getModificationTime() <= bound]
    log = table.log()
    if log is None or not found:
        return sorted(found)
    known = spark.createDataFrame([(f,) for f in found], "folder string").join(log.select("folder"), "folder", "left_anti")
    return sorted(r["folder"] for r in known.collect())


def retain(table: VersionedTable, older_than_hours: float = 168, dry_run: bool = True) -> list[int]:
    """Remove old non-current versions and abandoned attempts (dry run by default). Returns the versions selected.

    A version is recorded as removed after its folder is gone: a run that
    is cut short is finished by the next, and a finished one selects nothing twice. Deletion goes through the Hadoop FileSystem of the table
    path, so it works on any storage Spark can write to.
    """
    plan = retention_plan(table, older_than_hours).select("version", "folder", "catalog_table").collect()
    if not dry_run:
        spark = table.spark
        jvm = spark.sparkContext._jvm
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        doomed = [(r["version"], r["folder"], r["catalog_table"]) for r in plan]
        doomed += [(None, folder, None) for folder in abandoned_attempts(table, older_than_hours)]
        for version, folder, catalog_table in doomed:
            if catalog_table:  # a bucketed version's, under its own or its attempt's name
                for t in (f"{table.database}.{table.name}_v{version}" if isinstance(table, BucketedVersionedTable) else catalog_table, catalog_table):
                    spark.sql("DROP TABLE IF EXISTS IDENTIFIER(:t)", args={"t": t})
            p = jvm.org.apache.hadoop.fs.Path(f"{table.path}/{folder}")
            p.getFileSystem(conf).delete(p, True)
            table.commits.record_removal(version, folder)
    return sorted(int(r["version"]) for r in plan)
