"""Shared pieces of the training-data operators."""

from __future__ import annotations

import gc

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

# The characters that separate words: space and U+0009 to U+000D. ``bytes.split()``
# without arguments splits on exactly these.
BLANKS = " \t\n\x0b\x0c\r"
WORD = r"[^\x20\x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once below the shared checkpoint folder and read back: cuts lineage, survives executors."""
    path = scratch_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner drop the shuffle files of finished, already stored steps."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def bounded_batches(spark: SparkSession, rows: int = 1024) -> None:
    """Texts can be long, so Python workers get at most ``rows`` of them at a time (unless set lower already)."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if int(spark.conf.get(key, "10000") or 0) not in range(1, rows + 1):
        spark.conf.set(key, str(rows))


def word_count(text: str | Column) -> Column:
    """Number of words, 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def utf8(column: pa.Array) -> list[bytes]:
    """The strings of an Arrow column as UTF-8, null as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def with_column(batch: pa.RecordBatch, extra: dict[str, pa.Array]) -> pa.RecordBatch:
    """``batch`` followed by new columns."""
    arrays, names = list(batch.columns), list(batch.schema.names)
    return pa.RecordBatch.from_arrays(arrays + list(extra.values()), names + list(extra))


def fresh_name(df: DataFrame, name: str) -> str:
    """``name``, or that with underscores before it until it clashes with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name
