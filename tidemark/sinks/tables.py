"""Table writers: landing snapshots, append-only tables, versioned snapshots.

All tables are parquet directories on shared storage; nothing is kept on
the driver or on an executor's local disk.

* Landing snapshot — a new directory per dataset and run,
  ``<base>/<source>/<dataset>/<file>__<stamp>``, never overwritten.
* Append-only table — one sub-directory per micro-batch, ``batch=<id>``;
  a replayed batch overwrites only its own directory, so replays never
  duplicate rows, and nothing can overwrite the table as a whole. Small
  batches may be packed (:mod:`tidemark.sinks.packing`).
* Versioned table — each version is a complete snapshot in a folder of the
  attempt that wrote it; a commit log (:mod:`tidemark.sinks.commits`) names
  the folder of every committed version and the batch ids it consumed. The
  data is written first and the log entry last, and only if no other writer
  has taken the version: a crash or a lost race leaves a folder that no
  reader is led to and that retention sweeps.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from tidemark.functions.text import INGEST_TS_SUFFIX_SEP
from tidemark.session import path_exists
from tidemark.sinks.commits import CommitLog
from tidemark.sinks.schema_log import SchemaLog


# ---------------------------------------------------------------- landing

# The CSV writer gets whole lines as its only field: its own separator and quote are characters that no line has.
_NO_FIELD, _NO_QUOTE = "\x01", "\x00"


def snapshot_lines(df: DataFrame, sep: str = "\t", extra_field: str | None = None):
    """The data lines of a delimited snapshot as one column named by the header line.

    A line has no quoting, so a value with the separator, a line break or a
    control character of the writer cannot be told from other fields: it fails the write.
    """
    header = [c for c in df.columns if c != extra_field]
    breaking = "[" + "".join(rf"\x{{{ord(ch):x}}}" for ch in f"{sep}\r\n{_NO_QUOTE}{_NO_FIELD}") + "]"

    def field(name: str):
        text = F.coalesce(F.col(f"`{name}`").cast("string"), F.lit(""))
        return F.when(text.rlike(breaking), F.raise_error(F.lit(f"{name.strip()}: a value holds a separator or a line break"))).otherwise(text)

    values = [field(c) for c in header]
    if extra_field is not None:
        values.append(F.col(f"`{extra_field}`"))  # concat_ws skips it where NULL
    return F.concat_ws(sep, *values).alias(sep.join(header))


def write_landing_snapshot(
    df: DataFrame,
    base: str,
    source: str,
    dataset: str,
    stamp: str,
    filename: str | None = None,
    sep: str = "\t",
    extra_field: str | None = None,
) -> str:
    """Write ``df`` as a delimited snapshot: header row, values verbatim, no quoting.

    Column names are written exactly as given (padding included), NULL as an
    empty field. ``extra_field`` names a column that is not part of the
    header: where it is not NULL its value is appended to the row, which
    makes that row longer than the header (a malformed row).
    Every part file starts with the header. Returns the snapshot path;
    refuses to write where a snapshot already exists.
    """
    path = f"{base.rstrip('/')}/{source}/{dataset}/{filename or dataset}{INGEST_TS_SUFFIX_SEP}{stamp}"
    line = snapshot_lines(df, sep, extra_field)
    (
        df.select(line).write.mode("errorifexists")
        .option("header", True)
        .option("sep", _NO_FIELD)
        .option("quote", "")
        .option("escape", "")
        .option("emptyValue", "")
        .option("nullValue", "")
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path


def write_landing_text(df: DataFrame, base: str, source: str, dataset: str, stamp: str, filename: str) -> str:
    """Write a single-column text frame (e.g. JSON documents, one per line) as a landing snapshot."""
    path = f"{base.rstrip('/')}/{source}/{dataset}/{filename}{INGEST_TS_SUFFIX_SEP}{stamp}"
    df.write.mode("errorifexists").text(path)
    return path


# ---------------------------------------------------------------- append-only

# Packed batches and the log that names them; hidden, like the logs, from any scan of the table root.
PACK_DIR = "_packed"
PACK_LOG_DIR = "_packs"


class AppendOnlyTable:
    """Parquet table that only ever grows by whole micro-batches; its schema is recorded beside them."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schemas = SchemaLog(spark, self.path)
        self.packs = CommitLog(spark, f"{self.path}/{PACK_LOG_DIR}")

    def write_batch(self, df: DataFrame, batch_id: int) -> None:
        if int(batch_id) in self.covered():
            return  # a replay of a batch whose rows have been packed
        self.schemas.cover(df.schema)
        # Overwrite is scoped to this batch's own directory: a replay of the
        # same batch id replaces its earlier attempt instead of adding rows.
        df.write.mode("overwrite").parquet(f"{self.path}/batch={int(batch_id)}")

    def exists(self) -> bool:
        return path_exists(self.spark, self.path)

    def schema(self) -> StructType:
        """The recorded schema; of a table written without a record, all footers merged."""
        recorded = self.schemas.schema()
        return recorded if recorded is not None else self.spark.read.option("mergeSchema", True).parquet(self.path).schema

    def packed(self) -> tuple[int | None, dict | None]:
        """(number, entry) of the last packing."""
        at = self.packs.latest()
        return at, None if at is None else self.packs.entry(at)

    def covered(self, entry: dict | None = None) -> set[int]:
        """Batches that packed folders stand for, by an entry or the last one."""
        entry = entry or self.packed()[1]
        return {b for low, high in entry["covered"] for b in range(low, high + 1)} if entry else set()

    @staticmethod
    def as_ranges(batches: set[int]) -> list[list[int]]:
        ranges: list[list[int]] = []
        for b in sorted(batches):
            if ranges and ranges[-1][1] == b - 1:
                ranges[-1][1] = b
            else:
                ranges.append([b, b])
        return ranges

    def _batches(self, pattern: str, up: int) -> dict[int, str]:
        jvm = self.spark.sparkContext._jvm
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        found = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).globStatus(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{pattern}")) or []
        names = [(s.getPath().getParent() if up else s.getPath()).getName() for s in found]
        return {int(n.removeprefix("batch=")): f"{self.path}/{n}" for n in names}

    def finished_batches(self) -> dict[int, str]:
        """Batch id → directory of the batches that were written whole."""
        return self._batches("batch=*/_SUCCESS", 1)

    def packed_paths(self, entry: dict | None) -> list[str]:
        return [f"{self.path}/{PACK_DIR}/{f}" for f in entry["folders"]] if entry else []

    def live_paths(self) -> list[str]:
        """The folders a reader takes: packed ones and the batch directories that they do not cover."""
        entry = self.packed()[1]
        covered = self.covered(entry) if entry else set()
        return self.packed_paths(entry) + [p for b, p in sorted(self._batches("batch=*", 0).items()) if b not in covered]

    def swept(self) -> bool:
        """Have directories of covered batches been removed?"""
        return bool(self.covered() - set(self._batches("batch=*", 0)))

    def read_packed(self, spark: SparkSession, folders: list[str]) -> DataFrame:
        """Packed folders by the newest schema, the batch id last, as in a read of directories."""
        return spark.read.schema(StructType([*self.schema().fields, StructField("batch", IntegerType())])).parquet(*[f"{self.path}/{PACK_DIR}/{f}" for f in folders])

    def read(self) -> DataFrame:
        entry = self.packed()[1]
        if entry is None:
            return self.spark.read.schema(self.schema()).parquet(self.path)
        rows = self.read_packed(self.spark, entry["folders"])
        covered = self.covered(entry)
        rest = [p for b, p in sorted(self._batches("batch=*", 0).items()) if b not in covered]
        return rows.unionByName(self.read_files(rest)) if rest else rows

    def read_batch(self, batch_id: int) -> DataFrame | None:
        """The rows of one batch, None if the table has none of that id."""
        if int(batch_id) in self.covered():
            return self.read().where(F.col("batch") == int(batch_id))
        path = f"{self.path}/batch={int(batch_id)}"
        return self.read_files([path]) if path_exists(self.spark, path) else None

    def read_files(self, paths: list[str]) -> DataFrame:
        """Some files of the table by its newest schema."""
        return self.spark.read.schema(self.schema()).option("basePath", self.path).parquet(*paths)

    def overwrite(self, *_args, **_kwargs):
        raise PermissionError(f"{self.path} is append-only")


# ---------------------------------------------------------------- versioned snapshots

# The leading underscore hides the log from any read of the table root
# (partition discovery over v=<...>).
LOG_DIR = "_commits"


class CommitConflict(RuntimeError):
    """Another writer committed a version since the one that this commit was derived from."""


@dataclass(frozen=True)
class Attempt:
    """Written data that is not published yet."""

    version: int
    derived: bool  # from the version before; else it may take any number
    entry: dict


@dataclass
class VersionedTable:
    """A table whose every version is a complete snapshot, committed by a log entry."""

    spark: SparkSession
    path: str

    def __post_init__(self):
        self.path = self.path.rstrip("/")

    @property
    def log_path(self) -> str:
        return f"{self.path}/{LOG_DIR}"

    @property
    def commits(self) -> CommitLog:
        return CommitLog(self.spark, self.log_path)

    def log(self) -> DataFrame | None:
        return self.commits.frame()

    def state(self, batch_id: int | None = None, stream: str = "") -> tuple[int | None, bool]:
        """(current version, whether ``stream``'s ``batch_id`` is already committed).

        The version comes from the entries' names; the replay guard is one
        aggregate over the log, of which one row reaches the driver.
        """
        version = self.commits.latest()
        if version is None or batch_id is None:
            return version, False
        done = (F.col("batch_id") == F.lit(int(batch_id))) & (F.col("stream") == F.lit(stream))
        return version, bool(self.log().agg(F.bool_or(done).alias("done")).first()["done"])

    def current_version(self) -> int | None:
        return self.state()[0]

    def committed_batch(self, batch_id: int, stream: str = "") -> bool:
        """Has this stream's micro-batch already been committed (replay guard)?"""
        return self.state(batch_id, stream)[1]

    def version_path(self, version: int) -> str:
        """Where a committed version lies; a version without an entry has no data of its own yet."""
        entry = self.commits.entry(version)
        return f"{self.path}/{entry['folder'] if entry else f'v={version}'}"

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.current_version() if version is None else version
        if v is None:
            return None
        return self.spark.read.parquet(self.version_path(v))

    def _expected(self, current: int | None) -> int | None:
        """The current version, which must be ``current`` unless that is -1."""
        now = self.current_version()
        if current not in (-1, now):
            raise CommitConflict(f"{self.path}: derived from version {current}, but the table is at {now}")
        return now

    def _write(self, df: DataFrame, folder: str, attempt: str) -> str | None:
        """Write ``df`` to the attempt's own folder; returns the name of its catalog table, if any."""
        df.write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        return None

    def prepare(self, df: DataFrame, batch_id: int = -1, stream: str = "", note: str = "", current: int | None = -1) -> Attempt:
        """Write ``df``, derived from version ``current``, to a folder of its own; no reader sees it before :meth:`publish`.

        The row count is observed during the write itself.
        """
        now = self._expected(current)
        name = uuid.uuid4().hex
        obs = Observation(f"commit_{name}")
        version = 0 if now is None else now + 1
        folder = f"v={version}-{name}"
        table = self._write(df.observe(obs, F.count(F.lit(1)).alias("rows")), folder, name)
        entry = {"batch_id": int(batch_id), "stream": stream, "note": note, "rows": int(obs.get.get("rows", 0)), "folder": folder, "catalog_table": table}
        return Attempt(version, current != -1, entry)

    def publish(self, attempt: Attempt) -> int:
        """Make an attempt the next version (the commit point), or raise :class:`CommitConflict` with committed data untouched.

        An attempt that was derived from no version takes the next free number instead.
        """
        version = attempt.version
        while not self.commits.publish(version, attempt.entry):
            if attempt.derived:
                raise CommitConflict(f"{self.path}: version {version} was committed by another writer")
            version = self.commits.latest() + 1
        return version

    def commit(self, df: DataFrame, batch_id: int = -1, stream: str = "", note: str = "", current: int | None = -1) -> int:
        """Write ``df`` and publish it as the next version.

        ``current`` is the version ``df`` was derived from. If the table has
        moved on since, before, during or after the write, nothing is published
        and :class:`CommitConflict` is raised. With -1, ``df`` replaces whatever version there is.
        """
        return self.publish(self.prepare(df, batch_id, stream, note, current))


class BucketedVersionedTable(VersionedTable):
    """A :class:`VersionedTable` whose versions are bucketed and sorted on the key.

    Each version is also a catalog table ``<database>.<name>_v<n>`` (external,
    at the version's folder) carrying the bucketing, so a join or aggregation on
    the key reads it without an exchange (see ``cdc.scd1_merge_join``). Until it
    is published, an attempt's table has a name of its own.
    Where the catalog does not know a version (e.g. a new session on an
    in-memory catalog), it is read from its path, unbucketed.
    """

    def __init__(self, spark: SparkSession, path: str, database: str, name: str, keys: list[str], buckets: int):
        super().__init__(spark, path)
        self.database, self.name, self.keys, self.buckets = database, name, list(keys), int(buckets)

    def _table(self, version: int) -> str:
        return f"{self.database}.{self.name}_v{version}"

    def publish(self, attempt: Attempt) -> int:
        version = super().publish(attempt)
        # Only the writer whose entry was taken comes here; if it dies now, the version is read by the attempt's name.
        self.spark.sql(f"ALTER TABLE {attempt.entry['catalog_table']} RENAME TO {self._table(version)}")
        return version

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.current_version() if version is None else version
        if v is None:
            return None
        for table in (self._table(v), (self.commits.entry(v) or {}).get("catalog_table")):
            if table and self.spark.catalog.tableExists(table):
                return self.spark.table(table)
        return self.spark.read.parquet(self.version_path(v))

    def _write(self, df: DataFrame, folder: str, attempt: str) -> str | None:
        table = f"{self.database}.{self.name}_{attempt}"
        (
            df.write.mode("errorifexists")
            .bucketBy(self.buckets, *self.keys).sortBy(*self.keys)
            .option("path", f"{self.path}/{folder}")
            .saveAsTable(table)
        )
        return table


# ---------------------------------------------------------------- batch materialisation

def materialize(df: DataFrame, path: str) -> DataFrame:
    """Full-recompute view: commit ``df`` as the next version of the table and return the stored result.

    Readers of the version before go on undisturbed, ``df`` may be derived from it, and a failed
    refresh leaves it current.
    """
    table = VersionedTable(df.sparkSession, path)
    return table.read(table.commit(df, note="refresh"))
