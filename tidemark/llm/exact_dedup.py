"""Exact deduplication by two-pass Bloom filtering.

Texts are equal when they are identical after deleting every blank (space and
U+0009 to U+000D). Pass one sets bits for every text hash and keeps, next to
the bits seen once, those seen by a second, different part of the data. Pass
two tests every row: a hash whose bits were not all seen twice is certainly
unique, and its row passes straight through. Only the others are shuffled.

The pair of bit arrays is a monoid: ``(a, b) + (c, d) = (a | c, b | d | a & c)``.
Tasks fill their own pair, and a tree of group-bys merges them segment by
segment, 64 partial results at a time, so no task holds more than a few MB.
The filter has 16 bits a row, between 2**20 and ``max_bits`` in all (2**28:
32 MB, the most that is ever sent to the executors). Beyond that bound more
unique rows are shuffled with the repeated ones; the result stays the same.

Defined cases: a null text counts as empty; an empty table gives an empty
result; of repeated rows, texts and ids alike, one row stays; a null id loses
against any other and, alone, keeps itself; other columns are never looked at,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import BLANKS, fresh_name, stored, table

SEGMENT_BITS = 1 << 20
PROBES = 4
FAN_IN = 64
SEGMENT_SCHEMA = "part long, segment int, once binary, twice binary"


def normalised(text: str | Column) -> Column:
    return F.translate(F.coalesce(text, F.lit("")), BLANKS, "")


def bit_positions(hashes: np.ndarray, bits: int) -> np.ndarray:
    """``PROBES`` positions for each 64-bit hash, one row each."""
    h = hashes.astype(np.uint64)
    low, high = h & np.uint64(0xFFFFFFFF), (h >> np.uint64(32)) | np.uint64(1)
    steps = np.arange(PROBES, dtype=np.uint64)
    return ((low[:, None] + steps * high[:, None]) % np.uint64(bits)).astype(np.int64)


def filter_bits(rows: int, max_bits: int = 1 << 28) -> int:
    bits = SEGMENT_BITS
    while bits < min(16 * rows, max_bits):
        bits *= 2
    return bits


def _fill(bits: int):
    def fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        once, twice, seen = np.zeros(bits, bool), np.zeros(bits, bool), False
        for batch in batches:
            hashes, counts = np.unique(batch.column(0).to_numpy(zero_copy_only=False), return_counts=True)
            at, seen = bit_positions(hashes, bits), seen or len(hashes) > 0
            # Equal hashes of an earlier batch have set all their bits before; those of this one are counted.
            earlier = once[at].all(axis=1) | (counts > 1)
            twice[at[earlier].ravel()] = True
            once[at.ravel()] = True
        if seen:
            part = TaskContext.get().partitionId()
            for k in range(bits // SEGMENT_BITS):
                s = slice(k * SEGMENT_BITS, (k + 1) * SEGMENT_BITS)
                yield pa.RecordBatch.from_pydict({
                    "part": pa.array([part], pa.int64()), "segment": pa.array([k], pa.int32()),
                    "once": pa.array([np.packbits(once[s]).tobytes()], pa.binary()), "twice": pa.array([np.packbits(twice[s]).tobytes()], pa.binary()),
                })

    return fill


def _merge(group: pd.DataFrame) -> pd.DataFrame:
    once = twice = None
    for o, t in zip(group["once"], group["twice"]):
        o, t = np.frombuffer(o, np.uint8), np.frombuffer(t, np.uint8)
        once, twice = (o, t) if once is None else (once | o, twice | t | (once & o))
    return pd.DataFrame({"part": [group["part"].iloc[0] // FAN_IN], "segment": [group["segment"].iloc[0]], "once": [once.tobytes()], "twice": [twice.tobytes()]})


def repeated_bits(hashes: DataFrame, max_bits: int = 1 << 28) -> np.ndarray:
    """Pass one over a one-column frame of 64-bit hashes: the packed bits that were seen twice (``max_bits`` at most)."""
    bits = filter_bits(hashes.count(), max_bits)
    parts = max(1, hashes.rdd.getNumPartitions())
    level = hashes.mapInArrow(_fill(bits), SEGMENT_SCHEMA)
    while parts > 1:
        level = level.groupBy("segment", F.expr(f"part div {FAN_IN}").alias("up")).applyInPandas(_merge, SEGMENT_SCHEMA)
        parts = -(-parts // FAN_IN)
    out = np.zeros(bits // 8, np.uint8)
    for row in level.select("segment", "twice").collect():
        out[row["segment"] * SEGMENT_BITS // 8 : (row["segment"] + 1) * SEGMENT_BITS // 8] = np.frombuffer(row["twice"], np.uint8)
    return out


def maybe_repeated(spark: SparkSession, twice: np.ndarray):
    """Pass two, as a column function: False for hashes that certainly occur once."""
    shared, bits = spark.sparkContext.broadcast(twice), len(twice) * 8

    @F.pandas_udf("boolean")
    def probe(hashes: pd.Series) -> pd.Series:
        at = bit_positions(hashes.to_numpy(), bits)
        return pd.Series(((shared.value[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1).all(axis=1))

    return probe


def dedup_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    The texts are read once, for their hashes; nothing but ids, lengths and hashes is stored or shuffled.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    slim = stored(docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.sha2(normalised(text_col), 256).alias("text_sha256"),
        F.length(text).alias("chars"), F.monotonically_increasing_id().alias("row")), "exact-hashes")
    slim = slim.withColumn("hash", F.xxhash64("text_sha256"))
    probe = maybe_repeated(spark, repeated_bits(slim.select("hash"), max_bits))
    marked = stored(slim.withColumn("maybe", probe("hash")).drop("hash"), "exact-marked")
    alone = marked.where("not maybe").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "text_sha256")
    rows = marked.where("maybe")
    # Longest original text, then smallest id; a null sorts below every value.
    best = F.max(F.struct("chars", (-F.col("doc_id")).alias("least"), (-F.col("row")).alias("first")))
    groups = rows.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size"))
    grouped = rows.join(groups, "text_sha256").select(
        "doc_id", (-F.col("best.least")).alias("keep_id"), "group_size", (F.col("row") == -F.col("best.first")).alias("kept"), "text_sha256")
    return alone.unionByName(grouped)


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = 1 << 28) -> DataFrame:
    """The rows of ``docs`` that stay, all their columns.

    Rows that occur once are not shuffled; of the others, each task first reduces its own copies of a text to one.
    """
    spark, columns = docs.sparkSession, docs.columns
    sha, whole = fresh_name(docs, "text_sha256"), fresh_name(docs, "whole_row")
    hashes = docs.select(F.xxhash64(F.sha2(normalised(text_col), 256)).alias("hash"))
    probe = maybe_repeated(spark, repeated_bits(hashes, max_bits))
    keyed = docs.withColumn(sha, F.sha2(normalised(text_col), 256))
    test = probe(F.xxhash64(F.col(sha)))
    rank = F.struct(F.length(F.coalesce(F.col(text_col), F.lit(""))), -F.col(id_col).cast("long"))
    grouped = keyed.where(test).groupBy(sha).agg(F.max_by(F.struct(*columns), rank).alias(whole))
    return keyed.where(~test).select(*columns).unionByName(grouped.select(f"{whole}.*"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup_report(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, length(coalesce(text, '')) AS chars,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents)
SELECT doc_id,
       first_value(doc_id) OVER w AS keep_id,
       count(*) OVER (PARTITION BY text_sha256) AS group_size,
       row_number() OVER w = 1 AS kept,
       text_sha256
FROM t WINDOW w AS (PARTITION BY text_sha256 ORDER BY chars DESC, doc_id
                    ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)
"""
