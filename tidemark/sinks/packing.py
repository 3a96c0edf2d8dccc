"""Compaction of every layer: small files are packed by size, and the result is published by swap.

*Packing.* The scan itself is the bin packing: read with splits of the target size and no cost per file, Spark puts many small files into one task, and each task writes
one file. There is no shuffle, so rows keep the order they have in their files.

*Append-only tables.* Batches whose files are small are packed across batches into a folder under ``_packed``; the batch id becomes a column of the files. A log entry,
created only if absent, names the folders and the batches they stand for: readers take those folders and the batch directories that no entry covers.
The directories stay, so a stream that has yet to read them does, and one that has read them sees no new file. A replay of a covered batch writes nothing. Large batches are
left where they are; a folder that is itself still small is packed again with the next one, so each run rewrites less than one target size of packed rows.

*Versioned tables* get a new version of the same rows; a commit made meanwhile wins, and the table is packed at the next run.

*Sweeping* (:func:`sweep_packed`) removes covered directories and folders that no entry since the cutoff names. It is off by default: after it, a new stream cannot start from the table's
beginning (it is refused), a catalog table over the directories sees only the rest, and a stream that lags more than the cutoff would lose its input.

Defined cases: batches without a success marker (being written, or cut short) are never packed; empty tables, empty batches and columns that older batches lack are kept as they
read; packing a packed table changes nothing.
"""

from __future__ import annotations

import math
import time
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sinks.maintenance import DEFAULT_TARGET_FILE_BYTES
from tidemark.sinks.schema_log import SCHEMA_DIR
from tidemark.sinks.tables import LOG_DIR, PACK_DIR, AppendOnlyTable, CommitConflict, VersionedTable

OUTCOME = "layer string, table_name string, kind string, outcome string, files_before long, files_after long, bytes long, n_rows long"


def file_listing(spark: SparkSession, paths: list[str]) -> DataFrame:
    """path, length, modificationTime of the data files below ``paths``, from the listing alone."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet").load(paths)
    return files.select("path", "length", "modificationTime")


def _state(listing: DataFrame) -> tuple[int, int, int]:
    """(files, bytes, a hash of names, sizes and times)."""
    row = listing.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("b"), F.coalesce(F.bit_xor(F.xxhash64("path", "length", "modificationTime")), F.lit(0)).alias("h")).first()
    return int(row["n"]), int(row["b"]), int(row["h"])


def packing_session(spark: SparkSession, target_file_bytes: int) -> SparkSession:
    """A session like ``spark`` whose scans fill each task with files of about the target size."""
    packing = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            packing.conf.set(key, value)
    packing.conf.set("spark.sql.files.maxPartitionBytes", int(target_file_bytes))
    packing.conf.set("spark.sql.files.openCostInBytes", 0)
    packing.conf.set("spark.sql.files.minPartitionNum", 1)
    return packing


def _needless(files: int, size: int, target: int) -> bool:
    """Would packing hardly lessen the files? Packing in order of size leaves bins at least half full."""
    return files <= 1 + 2 * (size // target)


def _small(sizes: dict, target: int) -> list:
    return sorted(k for k, (files, size) in sizes.items() if size < files * target / 2)


def _sizes(listing: DataFrame, name: str) -> dict:
    """Per batch or folder (files, bytes); one row of each reaches the driver, as in any listing of a table."""
    key = F.regexp_extract("path", name, 1)
    rows = listing.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"), F.sum("length").alias("b")).collect()
    return {r["k"]: (int(r["n"]), int(r["b"])) for r in rows}


def pack_appends(table: AppendOnlyTable, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES) -> int | None:
    """Pack the small batches of an append-only table; returns the entry's number, None where there is nothing to gain.

    Raises :class:`CommitConflict` if another packing was published meanwhile, or if a batch was written again while it was read.
    """
    spark, target = table.spark, int(target_file_bytes)
    at, entry = table.packed()
    covered = table.covered(entry)
    done = {b: p for b, p in table.finished_batches().items() if b not in covered}
    batches = _sizes(file_listing(spark, sorted(done.values())), r"/batch=(\d+)/") if done else {}
    small = [int(b) for b in _small({int(k): v for k, v in batches.items()}, target)]
    folders = _sizes(file_listing(spark, table.packed_paths(entry)), rf"/{PACK_DIR}/([^/]+)/") if entry and entry["folders"] else {}
    again = _small(folders, target)
    chosen = [batches[str(b)] for b in small] + [folders[f] for f in again]
    if not small or _needless(sum(f for f, _ in chosen), sum(b for _, b in chosen), target):
        return None
    paths = [done[b] for b in small]
    before = _state(file_listing(spark, paths))
    session = packing_session(spark, target)
    source = session.read.schema(table.schema()).option("basePath", table.path).parquet(*paths)
    if again:
        source = table.read_packed(session, again).unionByName(source)
        if sum(b for _, b in chosen) <= target:
            source = source.coalesce(1)  # each side of the union has a bin of its own
    folder = f"p-{uuid.uuid4().hex}"
    source.write.mode("errorifexists").parquet(f"{table.path}/{PACK_DIR}/{folder}")
    rows = table.read_packed(spark, [folder]).count()
    if rows != source.count() or _state(file_listing(spark, paths)) != before:
        raise CommitConflict(f"{table.path}: a batch was written again while it was packed")
    kept = [f for f in (entry["folders"] if entry else []) if f not in again]
    version = 0 if at is None else at + 1
    row = {"folder": folder, "rows": rows, "note": "pack", "folders": [*kept, folder], "covered": AppendOnlyTable.as_ranges(covered | set(small))}
    if not table.packs.publish(version, row):
        raise CommitConflict(f"{table.path}: packing {version} was published by another run")
    return version


def pack_version(table: VersionedTable, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES) -> int | None:
    """A new version of the same rows in fewer files; None where there is nothing to gain."""
    version = table.current_version()
    if version is None:
        return None
    path = table.version_path(version)
    files, size, _ = _state(file_listing(table.spark, [path]))
    if _needless(files, size, int(target_file_bytes)):
        return None
    return table.commit(packing_session(table.spark, target_file_bytes).read.parquet(path), note="compact", current=version)


def sweep_packed(table: AppendOnlyTable, older_than_hours: float = 168, dry_run: bool = True) -> list[str]:
    """Folders, below the table's, that are read by no one who started after the cutoff; removed and recorded unless ``dry_run``.

    These are batch directories that an entry older than the cutoff covers, and packed folders that neither the entry current at the cutoff nor a later one
    names (also those of packings cut short).
    """
    spark = table.spark
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    latest = table.packs.latest()
    if latest is None:
        return []
    bound = time.time() - older_than_hours * 3600
    log = table.packs.frame().select("version", F.unix_micros("committed_at").alias("us"))
    old = log.where(F.col("us") <= int(bound * 1e6)).agg(F.max("version").alias("v")).first()["v"]
    if old is None:
        return []
    named = {f for v in range(old, latest + 1) for f in table.packs.entry(v)["folders"]}
    covered = table.covered(table.packs.entry(old))
    root = jvm.org.apache.hadoop.fs.Path(f"{table.path}/{PACK_DIR}")
    fs = root.getFileSystem(conf)
    stored = [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("p-") and s.getModificationTime() <= bound * 1000]
    dead = [f"batch={b}" for b in sorted(set(table.finished_batches()) & covered)] + sorted(f"{PACK_DIR}/{f}" for f in stored if f not in named)
    for folder in [] if dry_run else dead:
        fs.delete(jvm.org.apache.hadoop.fs.Path(f"{table.path}/{folder}"), True)
        table.packs.record_removal(None, folder)
    return dead


# ---------------------------------------------------------------- every layer

def layer_tables(spark: SparkSession, tables_root: str) -> list[tuple[str, str, str, str]]:
    """(layer, table, kind, path) of every table below the root, told by what lies in its folder; a table right below the root is of layer ``ledger``."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def folders(path: str) -> list[str]:
        p = jvm.org.apache.hadoop.fs.Path(path)
        fs = p.getFileSystem(conf)
        return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory()) if fs.exists(p) else []

    def kind(names: list[str]) -> str | None:
        if LOG_DIR in names:
            return "versioned"
        return "append-only" if SCHEMA_DIR in names or any(n.startswith("batch=") for n in names) else None

    found = []
    for layer in folders(tables_root):
        inner = folders(f"{tables_root}/{layer}")
        if kind(inner):
            found.append(("ledger", layer, kind(inner), f"{tables_root}/{layer}"))
            continue
        for name in inner:
            k = kind(folders(f"{tables_root}/{layer}/{name}"))
            if k:
                found.append((layer, name, k, f"{tables_root}/{layer}/{name}"))
    return found


def _maintain(spark: SparkSession, layer: str, name: str, kind: str, path: str, target: int) -> tuple:
    if kind == "append-only":
        table = AppendOnlyTable(spark, path)

        def data() -> list[str]:
            return table.live_paths()

        pack = pack_appends
    else:
        table = VersionedTable(spark, path)
        version = table.current_version()
        entry = table.commits.entry(version) if version is not None else None
        if entry is None or entry.get("layout") or entry.get("catalog_table"):
            # The files of these carry an index or a bucketing, which a plain rewrite would lose.
            own = "empty" if entry is None else "keyed" if entry.get("layout") else "bucketed"
            return (layer, name, own, "left as it is", None, None, None, int(entry["rows"]) if entry else 0)

        def data() -> list[str]:
            return [table.version_path(table.current_version())]

        pack = pack_version

    def files() -> tuple[int, int]:
        paths = data()
        return _state(file_listing(spark, paths))[:2] if paths else (0, 0)

    before, _ = files()
    try:
        outcome = "nothing to gain" if pack(table, target) is None else "packed"
    except CommitConflict:
        outcome = "overtaken"
    after, size = files()
    return (layer, name, kind, outcome, before, after, size, table.read().count() if after else 0)


def maintain_layers(spark: SparkSession, tables_root: str, target_file_bytes: int = DEFAULT_TARGET_FILE_BYTES, layers: tuple[str, ...] | None = None, side_by_side: int = 4) -> DataFrame:
    """Pack every table of every layer (or of ``layers``); one row a table: what was done, files before and after, bytes, rows.

    Tables are worked on ``side_by_side`` at a time. Keyed and bucketed tables are left to ``maintenance.compact``, which knows their keys.
    """
    found = [t for t in layer_tables(spark, tables_root.rstrip("/")) if layers is None or t[0] in layers]
    with ThreadPoolExecutor(side_by_side) as pool:
        rows = list(pool.map(lambda t: _maintain(spark, *t, int(target_file_bytes)), found))
    return spark.createDataFrame(rows, OUTCOME)
