"""A versioned table whose upserts rewrite only the files that hold a changed key.

A version is a list of data files (its manifest); files are shared between versions and never changed. An upsert looks its keys up in
an index of the files, reads and rewrites those that may hold one of them, and commits a manifest of the new files and all others.

*Clustering.* Rows lie in ranges of a place (ordinal of the first key, hash of all keys): the ordinal keeps neighbouring keys in one file, the hash
splits an ordinal that many keys share (a hot series) over files. Order only decides how many files a batch touches, never the result.

*Ranges.* The places of a file are a range, stored as dyadic cells: aligned intervals of ``2**level`` ordinals (or hashes, at the two ends). A place lies in one
cell of each level, so the files whose range holds a key are found by an equality join on (level, cell); there is no join by inequality.
Cells of many keys are salted.

*Bloom filter.* Each file has a filter of 512-bit blocks, a key sets 8 bits in one block. The blocks are rows of (file, block), so building is a
partial ``bit_or`` and testing an equality join; nothing is broadcast or brought to the driver. A key that no file holds (an insert) rarely touches one.

*Limits.* A batch whose keys lie all over the table rewrites all of it, as any table of this kind does. Rows inserted by many batches overlap in range
until :func:`tidemark.sinks.maintenance.compact` clusters the table anew. The driver sees the paths of the files it reads, as a scan does anyway.

Defined cases: keys may be null (null equals null); an empty batch commits its batch id and rewrites nothing; columns that a
batch brings anew are null in older files; a batch without a column of the table leaves it null in the rows it wins.
"""

from __future__ import annotations

import json
import math
import os
import time
import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DataType, DateType, DecimalType, FractionalType, NumericType, StringType, StructType, TimestampType

from tidemark.operators.cdc import latest_per_key, scd1_merge
from tidemark.sinks.tables import Attempt, VersionedTable

DEFAULT_ROWS_PER_FILE = 1_000_000
KEYS_PER_BLOCK = 32  # 512 bits: 16 bits a key, about 0.2 % of foreign keys pass
ANY = 64  # level of a cell that holds every hash
SALT = 16

_MANIFEST = "folder string, file string, rows long"
_CELLS = "folder string, file string, ord_level int, ord_cell long, hash_level int, hash_cell long"
_WORDS = [f"w{i}" for i in range(8)]
_BLOCKS = "folder string, file string, block long, " + ", ".join(f"{w} long" for w in _WORDS)
_AT = ["folder", "file"]


def dyadic(low: int, high: int) -> Iterator[tuple[int, int]]:
    """The whole range low..high as (level, cell) of aligned intervals, fewer than 128."""
    while low <= high:
        aligned = (low & -low).bit_length() - 1 if low else 63
        level = min(aligned, (high - low + 1).bit_length() - 1, 63)
        yield level, low >> level
        low += 1 << level


def file_cells(low: tuple[int, int], high: tuple[int, int]) -> Iterator[tuple[int, int, int, int]]:
    """(ord_level, ord_cell, hash_level, hash_cell) of all places from low to high, each in one cell."""
    least, most = -(1 << 63), (1 << 63) - 1
    if low[0] == high[0]:
        ends = [(low[0], low[1], high[1])]
    else:
        ends = [(low[0], low[1], most), (high[0], least, high[1])]
        for level, cell in dyadic(low[0] + 1, high[0] - 1):
            yield level, cell, ANY, 0
    for ordinal, first, last in ends:
        for level, cell in dyadic(first, last):
            yield 0, ordinal, level, cell


def _celled(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    names = [c.split()[0] for c in _CELLS.split(", ")]
    for frame in frames:
        out = [(r.folder, r.file, *cell) for r in frame.itertuples() for cell in file_cells((r.low_ord, r.low_hash), (r.high_ord, r.high_hash))]
        yield pd.DataFrame(out, columns=names)


def ordinal(name: str, kind: DataType, prefix: str) -> Column:
    """A long that keeps the order of a key as far as its type allows; strings by 7 bytes after the common ``prefix``."""
    key = F.col(f"`{name}`")
    if isinstance(kind, StringType):
        tail = F.substring(F.encode(F.substr(key, F.lit(len(prefix) + 1)), "UTF-8"), 1, 7)
        value = F.when(key.startswith(prefix), F.conv(F.rpad(F.hex(tail), 14, "0"), 16, 10).cast("long")).when(key < prefix, F.lit(-1)).otherwise(F.lit(1 << 56))
    elif isinstance(kind, DateType):
        value = F.unix_date(key).cast("long")
    elif isinstance(kind, TimestampType):
        value = F.unix_micros(key)
    elif isinstance(kind, (NumericType, BooleanType)):
        value = key.try_cast("long")
    else:
        value = F.lit(0).cast("long")  # the hash alone
    return F.coalesce(value, F.lit(0).cast("long"))


def _masks() -> list[Column]:
    """The bit a key sets in each word of its block, from a second hash."""
    return [F.expr(f"shiftleft(1L, cast(shiftright(again, {6 * i}) & 63L as int))") for i in range(8)]


class KeyedTable(VersionedTable):
    """A :class:`VersionedTable` of one row per key, stored as indexed files of about ``rows_per_file`` rows."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], rows_per_file: int = DEFAULT_ROWS_PER_FILE):
        super().__init__(spark, path)
        self.keys, self.rows_per_file = list(keys), int(rows_per_file)

    # ---------------------------------------------------------------- reading

    def _layout(self, version: int) -> dict:
        """schema, prefix and blocks of a committed version."""
        return json.loads(self.commits.entry(version)["layout"])

    def files(self, version: int | None = None) -> DataFrame:
        """folder, file, rows of a version's data files."""
        v = self.current_version() if version is None else version
        return self.spark.read.schema(_MANIFEST).parquet(self.version_path(v))

    def _rows(self, schema: StructType, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame | None:
        v = self.current_version() if version is None else version
        if v is None:
            return None
        return self._rows(StructType.fromJson(self._layout(v)["schema"]), self._paths(self.files(v)))

    def _paths(self, files: DataFrame) -> list[str]:
        return sorted(f"{self.path}/{r['folder']}/rows/{r['file']}" for r in files.select(*_AT).collect())

    def _place(self, df: DataFrame, layout: dict) -> DataFrame:
        schema = StructType.fromJson(layout["schema"])
        # Grouping takes -0.0 and 0.0 for one key, a hash does not.
        values = [F.col(f"`{k}`") + F.lit(0.0) if isinstance(schema[k].dataType, FractionalType) and not isinstance(schema[k].dataType, DecimalType) else F.col(f"`{k}`") for k in self.keys]
        return df.withColumns({"__ord": ordinal(self.keys[0], schema[self.keys[0]].dataType, layout["prefix"]), "__hash": F.xxhash64(*values), "__again": F.xxhash64(F.lit("again"), *values)})

    def touched(self, changes: DataFrame, version: int) -> DataFrame:
        """folder, file, rows of the files of a version that may hold a key of ``changes`` (of the table's types)."""
        layout, files = self._layout(version), self.files(version)
        folders = [r["folder"] for r in files.select("folder").distinct().collect()]
        if not folders:
            return files
        cells = self.spark.read.schema(_CELLS).parquet(*[f"{self.path}/{f}/cells" for f in folders]).join(files, _AT, "left_semi")
        blocks = self.spark.read.schema(_BLOCKS).parquet(*[f"{self.path}/{f}/blocks" for f in folders])
        used = sorted(tuple(r) for r in cells.select("ord_level", "hash_level").distinct().collect())  # fewer than 130
        levels = F.expr("array(" + ", ".join(f"struct({a} as a, {b} as b)" for a, b in used) + ")")
        shifts = (f"transform(levels, l -> struct(l.a as ord_level, shiftright(__ord, l.a) as ord_cell, l.b as hash_level, "
                  f"if(l.b = {ANY}, 0L, shiftright(__hash, l.b)) as hash_cell))")
        keys = self._place(changes.select(*[f"`{k}`" for k in self.keys]), layout).withColumn("levels", levels).select(
            F.col("__hash").alias("hash"), F.col("__again").alias("again"), F.explode(F.expr(shifts)).alias("probe")).select("hash", "again", "probe.*")
        on = ["ord_level", "ord_cell", "hash_level", "hash_cell", "salt"]
        salted = cells.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
        near = keys.withColumn("salt", F.pmod("again", F.lit(SALT)).cast("int")).join(salted, on).select(
            *_AT, F.pmod("hash", F.lit(layout["blocks"])).alias("block"), *[m.alias(f"m{i}") for i, m in enumerate(_masks())])
        held = near.join(blocks, [*_AT, "block"])
        for i, word in enumerate(_WORDS):
            held = held.where(F.col(word).bitwiseAND(F.col(f"m{i}")) != 0)
        return files.join(held.select(*_AT).distinct(), _AT, "left_semi")

    # ---------------------------------------------------------------- writing

    def _store(self, df: DataFrame, folder: str) -> tuple[DataFrame, int]:
        """``df`` written beside the attempt's files, so that it is computed once, with its row count."""
        obs = Observation(uuid.uuid4().hex)
        path = f"{self.path}/{folder}/staged-{uuid.uuid4().hex}"
        df.observe(obs, F.count(F.lit(1)).alias("rows")).write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path), int(obs.get.get("rows", 0))

    def _add(self, df: DataFrame, rows: int, folder: str, layout: dict) -> DataFrame:
        """Write ``df`` as clustered, indexed files of ``folder``; returns their manifest rows."""
        if not rows:
            return self.spark.createDataFrame([], _MANIFEST)
        place = ["__ord", "__hash"]
        out = self._place(df, layout).repartitionByRange(max(1, math.ceil(rows / self.rows_per_file)), *place).sortWithinPartitions(*place)
        out.drop(*place, "__again").write.parquet(f"{self.path}/{folder}/rows")
        stored = self.spark.read.schema(df.schema).parquet(f"{self.path}/{folder}/rows")
        at = self._place(stored.select(*[f"`{k}`" for k in self.keys], F.col("_metadata.file_name").alias("__file")), layout).select(
            F.lit(folder).alias("folder"), F.col("__file").alias("file"), F.struct(F.col("__ord").alias("ord"), F.col("__hash").alias("hash")).alias("place"),
            F.col("__hash").alias("hash"), F.col("__again").alias("again"))
        ends = at.groupBy(*_AT).agg(F.count(F.lit(1)).alias("rows"), F.min("place").alias("low"), F.max("place").alias("high"))
        ends.write.parquet(f"{self.path}/{folder}/files")
        ends = self.spark.read.parquet(f"{self.path}/{folder}/files")
        ends.select(*_AT, F.col("low.ord").alias("low_ord"), F.col("low.hash").alias("low_hash"), F.col("high.ord").alias("high_ord"), F.col("high.hash").alias("high_hash")).mapInPandas(
            _celled, _CELLS).write.parquet(f"{self.path}/{folder}/cells")
        bits = at.select(*_AT, F.pmod("hash", F.lit(layout["blocks"])).alias("block"), *[m.alias(w) for w, m in zip(_WORDS, _masks())])
        bits.groupBy(*_AT, "block").agg(*[F.bit_or(w).alias(w) for w in _WORDS]).write.parquet(f"{self.path}/{folder}/blocks")
        return ends.select(*_AT, "rows")

    def _attempt(self, manifest: DataFrame, version: int, derived: bool, name: str, layout: dict, batch_id: int, stream: str, note: str) -> Attempt:
        folder = f"v={version}-{name}"
        self._discard_staged(f"data-{name}")
        obs = Observation(uuid.uuid4().hex)
        manifest.observe(obs, F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).write.mode("errorifexists").parquet(f"{self.path}/{folder}")
        entry = {"batch_id": int(batch_id), "stream": stream, "note": note, "rows": int(obs.get.get("rows", 0) or 0), "folder": folder, "catalog_table": None, "layout": json.dumps(layout)}
        return Attempt(version, derived, entry)

    def _discard_staged(self, folder: str) -> None:
        root = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}")
        fs = root.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.listStatus(root):
            if status.getPath().getName().startswith("staged-"):
                fs.delete(status.getPath(), True)

    def prepare(self, df: DataFrame, batch_id: int = -1, stream: str = "", note: str = "", current: int | None = -1) -> Attempt:
        """All of ``df`` (one row per key) as a version of its own, clustered anew."""
        now = self._expected(current)
        name = uuid.uuid4().hex
        staged, rows = self._store(df, f"data-{name}")
        layout = {"schema": df.schema.jsonValue(), "prefix": "", "blocks": max(1, self.rows_per_file // KEYS_PER_BLOCK)}
        if isinstance(df.schema[self.keys[0]].dataType, StringType):
            ends = staged.agg(F.min(f"`{self.keys[0]}`").alias("low"), F.max(f"`{self.keys[0]}`").alias("high")).first()
            layout["prefix"] = os.path.commonprefix([ends["low"] or "", ends["high"] or ""])
        manifest = self._add(staged, rows, f"data-{name}", layout)
        return self._attempt(manifest, 0 if now is None else now + 1, current != -1, name, layout, batch_id, stream, note)

    def prepare_upsert(self, changes: DataFrame, sequence: list[str], payload: list[str] | None = None, batch_id: int = -1, stream: str = "", note: str = "upsert",
                       current: int | None = -1) -> Attempt:
        """The current version with the rows of ``changes`` that win by (sequence, payload), as ``cdc.scd1_merge`` has it; only touched files are read and written."""
        now = self._expected(current)
        latest = latest_per_key(changes, self.keys, sequence, payload, keep_sequence=True)
        if now is None:
            return self.prepare(latest, batch_id, stream, note, None)
        name = uuid.uuid4().hex
        layout = self._layout(now)
        schema = StructType.fromJson(layout["schema"])
        known = set(schema.names)
        for field in latest.schema.fields:
            if field.name not in known:
                schema = schema.add(field.name, field.dataType, True)
        layout = layout | {"schema": schema.jsonValue()}
        have = set(latest.columns)
        latest = latest.select(*[(F.col(f"`{f.name}`") if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.fields])
        latest, changed = self._store(latest, f"data-{name}")
        files = self.files(now)
        if not changed:
            return self._attempt(files, now + 1, True, name, layout, batch_id, stream, note)
        hit = self.touched(latest, now).collect()  # paths of the scan that follows
        old = self._rows(schema, [f"{self.path}/{r['folder']}/rows/{r['file']}" for r in hit])
        wanted = [c for c in schema.names if c not in self.keys and c not in sequence]
        merged = scd1_merge(old, latest, self.keys, sequence, wanted).select(*[f"`{c}`" for c in schema.names])
        merged = merged.to(StructType([type(f)(f.name, f.dataType, True) for f in schema.fields]))
        added = self._add(merged, sum(r["rows"] for r in hit) + changed, f"data-{name}", layout)
        kept = files
        if hit:
            gone = self.spark.createDataFrame([(r["folder"], r["file"]) for r in hit], "folder string, file string")
            kept = files.join(gone, _AT, "left_anti")
        return self._attempt(kept.unionByName(added), now + 1, True, name, layout, batch_id, stream, note)

    def upsert(self, changes: DataFrame, sequence: list[str], payload: list[str] | None = None, batch_id: int = -1, stream: str = "", current: int | None = -1) -> int:
        """:meth:`prepare_upsert`, published as the next version; :class:`~tidemark.sinks.tables.CommitConflict` if another writer was first."""
        return self.publish(self.prepare_upsert(changes, sequence, payload, batch_id, stream, current=current))

    # ---------------------------------------------------------------- reachability

    def sweep(self, older_than_hours: float = 168, dry_run: bool = True) -> DataFrame:
        """folder, file of data that no kept version names and that is older than the cutoff (file null: the whole folder); removed unless ``dry_run``.

        Versions go first, by ``maintenance.retain``. A folder that no version names at all (an attempt that lost or died) goes whole.
        """
        jvm, conf = self.spark.sparkContext._jvm, self.spark.sparkContext._jsc.hadoopConfiguration()
        root = jvm.org.apache.hadoop.fs.Path(self.path)
        fs = root.getFileSystem(conf)
        bound = (time.time() - older_than_hours * 3600) * 1000
        old = [s.getPath().getName() for s in fs.listStatus(root) if s.getPath().getName().startswith("data-") and s.getModificationTime() <= bound]
        kept_folders = self.log().join(self.commits.removed().select("folder").distinct(), "folder", "left_anti").select("folder").collect()
        named = self.spark.read.schema(_MANIFEST).parquet(*[f"{self.path}/{r['folder']}" for r in kept_folders]).select(*_AT).distinct()
        live = {r["folder"] for r in named.select("folder").distinct().collect()}
        dead = [(f, None) for f in old if f not in live]
        partly = [f for f in old if f in live]
        if partly:
            present = self.spark.read.parquet(*[f"{self.path}/{f}/files" for f in partly]).select(*_AT)
            rest = present.join(named, _AT, "left_anti").collect()
            dead += [(r["folder"], r["file"]) for r in rest if fs.exists(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{r['folder']}/rows/{r['file']}"))]
        for folder, file in [] if dry_run else dead:
            fs.delete(jvm.org.apache.hadoop.fs.Path(f"{self.path}/{folder}" if file is None else f"{self.path}/{folder}/rows/{file}"), True)
            self.commits.record_removal(None, folder if file is None else f"{folder}/rows/{file}")
        return self.spark.createDataFrame(dead, "folder string, file string")

