"""Delimited files whose fields may be quoted: any text round-trips, and files stay splittable.

A field in quotes may hold the separator, line breaks and (doubled) quotes, so a line break ends a record only outside quotes,
and whether it is outside depends on everything before it in the file. Reading takes two passes over lines:

1. Every split of a file is reduced to a transition: the state after it (inside or outside quotes) for either state before it.
   Transitions compose associatively, so the state at the start of each split follows from a few bits per split.
2. Every split cuts its lines into records from its own start state. What is open at its ends, at most two pieces a split, is
   put together by file and offset.

A quote opens a field only at the field's beginning; elsewhere it is a character of the field. The first record of a file is its
header. Values are matched to columns by name, per file; values without a (first) header name go to ``_rescued_data``. An unquoted empty
field is NULL, a quoted one the empty string. Split planning of the two passes is compared: a split that the first pass did not see fails the read.

Defined cases: an empty file has no records; a file that ends inside quotes ends its last record; ``\\r\\n`` ends records too; blank lines are
skipped unless the file has one column, where they are NULL; columns of any file are columns of the result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import INGEST_TS_SUFFIX_SEP

QUOTE = '"'
BROADCAST_SPLITS = 200_000
RESCUED = "_rescued_data"


def quoted_lines(df: DataFrame, sep: str = "\t") -> DataFrame:
    """One column ``value``: a row as quoted fields, NULL as nothing."""
    fields = [F.coalesce(F.concat(F.lit(QUOTE), F.replace(F.col(f"`{c}`").cast("string"), F.lit(QUOTE), F.lit(QUOTE * 2)), F.lit(QUOTE)), F.lit("")) for c in df.columns]
    return df.select(F.concat_ws(sep, *fields).alias("value"))


def write_quoted_snapshot(df: DataFrame, base: str, source: str, dataset: str, stamp: str, sep: str = "\t") -> str:
    """A landing snapshot that holds any text; every file begins with the header. An existing path is never overwritten."""
    header = sep.join(QUOTE + c.replace(QUOTE, QUOTE * 2) + QUOTE for c in df.columns)

    def headed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_pydict({"value": pa.array([header], pa.string())})
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"value": batch.column(0)})

    path = f"{base.rstrip('/')}/{source}/{dataset}/{dataset}{INGEST_TS_SUFFIX_SEP}{stamp}"
    quoted_lines(df, sep).mapInArrow(headed, "value string").write.mode("errorifexists").text(path)
    return path


def _closing(line: str, at: int) -> int:
    """Where the quoted field that is open at ``at`` closes, -1 if not in this line."""
    while True:
        at = line.find(QUOTE, at)
        if at < 0 or line[at + 1 : at + 2] != QUOTE:
            return at
        at += 2


def state_after(line: str, inside: bool, sep: str) -> bool:
    """Whether the end of a line is inside quotes, if its beginning is (``inside``) or is not."""
    if QUOTE not in line:
        return inside
    at = 0
    while True:
        if inside:
            close = _closing(line, at)
            if close < 0:
                return True
            at = close + 1
        elif at == 0 and line.startswith(QUOTE):
            at, inside = 1, True
            continue
        opening = line.find(sep + QUOTE, at)
        if opening < 0:
            return False
        at, inside = opening + len(sep) + 1, True


def fields(record: str, sep: str) -> list[str | None]:
    """The fields of a whole record."""
    out: list[str | None] = []
    at = 0
    while True:
        if record.startswith(QUOTE, at):
            close = _closing(record, at + 1)
            close = len(record) if close < 0 else close
            end = record.find(sep, close)
            value: str | None = record[at + 1 : close].replace(QUOTE * 2, QUOTE)
            rest = record[close + 1 : end if end >= 0 else len(record)].removesuffix("\r" if end < 0 else "")
            out.append(value + rest)
        else:
            end = record.find(sep, at)
            out.append((record[at:end] if end >= 0 else record[at:].removesuffix("\r")) or None)
        if end < 0:
            return out
        at = end + len(sep)


def _lines(spark: SparkSession, files: list[str]) -> DataFrame:
    rows = spark.read.option("lineSep", "\n").text(files)
    return rows.select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))


def _transitions(sep: str) -> Callable:
    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], list[bool]] = {}  # the splits of one task
        for batch in batches:
            for line, file, block in zip(*(batch.column(i).to_pylist() for i in range(3))):
                ends = found.setdefault((file, block), [False, True])
                ends[:] = [state_after(line, s, sep) for s in ends]
        yield pa.RecordBatch.from_pydict({
            "file": pa.array([f for f, _ in found], pa.string()), "block": pa.array([b for _, b in found], pa.int64()),
            "after_outside": pa.array([e[0] for e in found.values()], pa.bool_()), "after_inside": pa.array([e[1] for e in found.values()], pa.bool_())})

    return reduce


def split_states(spark: SparkSession, files: list[str], sep: str = "\t") -> DataFrame:
    """file, block, inside: the state at the start of every split."""

    def compose(splits: pd.DataFrame) -> pd.DataFrame:  # of one file, a row for each split
        splits = splits.sort_values("block", ignore_index=True)
        inside, states = False, []
        for outside_to, inside_to in zip(splits["after_outside"], splits["after_inside"]):
            states.append(inside)
            inside = bool(inside_to if inside else outside_to)
        return splits[["file", "block"]].assign(inside=states)

    reduced = _lines(spark, files).mapInArrow(_transitions(sep), "file string, block long, after_outside boolean, after_inside boolean")
    return reduced.groupBy("file").applyInPandas(compose, "file string, block long, inside boolean")


_PIECES = "file string, block long, first boolean, record string, opens boolean, closes boolean"


def _cut(sep: str) -> Callable:
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Records of each split; ``opens`` / ``closes`` is False for a piece without its beginning / end."""
        here, held, out = None, [], []
        inside = opened = first = False

        def piece(closes: bool) -> None:
            out.append((*here, first, "\n".join(held), opened, closes))
            held.clear()

        for batch in batches:
            for line, file, block, start in zip(*(batch.column(i).to_pylist() for i in range(4))):
                if (file, block) != here:
                    if held:
                        piece(False)
                    if start is None:
                        raise ValueError(f"{file} was split differently in the two passes (offset {block})")
                    here, inside = (file, block), start
                    opened, first = not inside, block == 0
                held.append(line)
                inside = state_after(line, inside, sep)
                if not inside:
                    piece(True)
                    opened, first = True, False
            if out:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema)
                out.clear()
        if held:
            piece(False)
        if out:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, row)) for row in out], schema)

    schema = pa.schema([("file", pa.string()), ("block", pa.int64()), ("first", pa.bool_()), ("record", pa.string()), ("opens", pa.bool_()), ("closes", pa.bool_())])
    return cut


def quoted_records(spark: SparkSession, files: list[str], sep: str = "\t") -> DataFrame:
    """file, first (the file's header), fields (array of string) of every record."""
    states = split_states(spark, files, sep)
    lines = _lines(spark, files)
    on = ["file", "block"]
    if states.count() <= BROADCAST_SPLITS:  # a broadcast join keeps the order of the lines
        placed = lines.join(F.broadcast(states), on, "left").select("value", "file", "block", "inside")
    else:
        numbered = lines.withColumn("line", F.monotonically_increasing_id())
        placed = numbered.join(states, on, "left").repartition(*on).sortWithinPartitions(*on, "line").select("value", "file", "block", "inside")
    pieces = placed.mapInArrow(_cut(sep), _PIECES)
    whole = pieces.where("opens and closes").select("file", "first", "record")

    def joined(parts: pd.DataFrame) -> pd.DataFrame:  # of one file, at most two for each split
        parts = parts.sort_values(["block", "opens"], ignore_index=True)  # the end of an earlier record comes before a beginning
        number = parts["opens"].cumsum()
        out = parts.groupby(number).agg(file=("file", "first"), first=("first", "first"), record=("record", "\n".join))
        return out[["file", "first", "record"]]

    across = pieces.where("not (opens and closes)").groupBy("file").applyInPandas(joined, "file string, first boolean, record string")

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            split = [fields(r, sep) for r in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(split, pa.list_(pa.string()))], ["file", "first", "fields"])

    return whole.unionByName(across).mapInArrow(parse, "file string, first boolean, fields array<string>")


def read_quoted(spark: SparkSession, path: str, sep: str = "\t") -> DataFrame:
    """The columns of all headers, as strings, in order of first appearance by file name, and ``_rescued_data`` (JSON, NULL if nothing was left over)."""
    files = sorted(spark.read.text(path).inputFiles())  # both passes read these
    if not files:
        return spark.createDataFrame([], f"{RESCUED} string")
    records = quoted_records(spark, files, sep)
    headers = records.where("first").select("file", F.col("fields").alias("header"))
    # Names, not files, reach the driver: each once, with the first file and place it has.
    named = headers.select("file", F.posexplode("header").alias("place", "name")).where("name is not null and name <> ''")
    names = [r["name"] for r in named.groupBy("name").agg(F.min(F.struct("file", "place")).alias("at")).orderBy("at").collect()]
    data = records.where("not first").join(headers, "file")
    data = data.where("size(header) = 1 or size(fields) > 1 or fields[0] is not null")
    at = {name: F.array_position("header", F.lit(name)) for name in names}
    columns = [F.when(at[n] > 0, F.try_element_at("fields", at[n].cast("int"))).alias(n) for n in names]
    left = F.filter(
        F.transform("fields", lambda v, i: F.struct(i.alias("place"), v.alias("value"))),
        lambda x: x["value"].isNotNull() & ~F.coalesce(
            (F.get("header", x["place"]) != "") & (F.array_position("header", F.get("header", x["place"])) == x["place"] + 1), F.lit(False)),
    )
    rescued = F.when(F.size(left) > 0, F.to_json(left)).alias(RESCUED)
    return data.select(*columns, rescued)
