"""Bronze: incremental, append-only ingestion of landed files.

Each refresh is a triggered Structured Streaming run
(``trigger(availableNow=True)``): the file source's checkpoint remembers
every path already ingested, so each landed file is read exactly once, and
a file re-landed under a new stamped path is read again as a new snapshot.
The micro-batch is handled in ``foreachBatch`` with the drift-tolerant
reader and written as its own ``batch=<id>`` directory (replay-safe).

A config-driven registry turns N source specs into N bronze tables; each
table's checkpoint is derived from its name, never set by hand.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import ingest_ts_from_path
from tidemark.operators.quality import Rule, expect
from tidemark.session import path_exists
from tidemark.sinks.tables import AppendOnlyTable
from tidemark.sources.delimited import INGEST_TS, INGESTED_AT, RESCUED, SOURCE_FILE, read_delimited_lines

DEFAULT_TIMEOUT_S = None  # a triggered query runs until it has drained its source
# Files per micro-batch: bounds the per-file header table each batch collects
# and broadcasts; availableNow still drains every landed file.
DEFAULT_MAX_FILES_PER_TRIGGER = 1000

# Warn-only expectations of bronze tables: rows are always kept; failures
# are counted per micro-batch into the table's expectation log.
DELIMITED_RULES = (Rule("no_rescued_data", "_rescued_data IS NULL"),)
JSON_RULES = (Rule("value_present", "value IS NOT NULL"),)


@dataclass(frozen=True)
class SourceSpec:
    """One landed dataset → one bronze table.

    ``fmt`` is 'delimited' (header row, all STRING) or 'json' (one VARIANT
    document per file).
    """

    dataset: str
    table: str
    fmt: str = "delimited"
    sep: str = "\t"
    comment: str = ""


@dataclass(frozen=True)
class Layout:
    """Where landing, tables and checkpoints live (all below one shared root)."""

    landing: str
    tables: str
    checkpoints: str
    source: str = "landing"

    def landing_dir(self, spec: SourceSpec) -> str:
        return f"{self.landing}/{self.source}/{spec.dataset}"

    def table_path(self, layer: str, table: str) -> str:
        return f"{self.tables}/{layer}/{table}"

    def checkpoint(self, layer: str, table: str) -> str:
        return f"{self.checkpoints}/{layer}/{table}"


def _discover(spark: SparkSession, spec: SourceSpec, directory: str, max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.option("maxFilesPerTrigger", max_files or DEFAULT_MAX_FILES_PER_TRIGGER)
    if spec.fmt == "delimited":
        return (
            reader.format("text")
            .option("recursiveFileLookup", "true")
            .load(directory)
            .select("value", "_metadata")
        )
    if spec.fmt == "json":
        return (
            reader.format("json")
            .option("multiLine", "true")
            .option("singleVariantColumn", "value")
            .option("recursiveFileLookup", "true")
            .load(directory)
            .select("value", F.col("_metadata.file_path").alias(SOURCE_FILE))
        )
    raise ValueError(f"unknown format {spec.fmt}")


def _bronze_batch(spec: SourceSpec, table: AppendOnlyTable, expectations: AppendOnlyTable):
    rules = list(DELIMITED_RULES if spec.fmt == "delimited" else JSON_RULES)

    def handle(batch: DataFrame, batch_id: int) -> None:
        if spec.fmt == "delimited":
            known = table.schemas.schema()
            existing = [n for n in known.names if n not in (RESCUED, SOURCE_FILE, INGEST_TS, INGESTED_AT)] if known else None
            out = read_delimited_lines(batch, spec.sep, existing)
        else:
            out = batch.withColumn(INGEST_TS, ingest_ts_from_path(F.col(SOURCE_FILE)))
        # The rule counts ride along with the write (no second pass over the batch).
        observed, obs = expect(out.withColumn(INGESTED_AT, F.current_timestamp()), rules, f"{spec.table}_{batch_id}")
        table.write_batch(observed, batch_id)
        metrics = obs.get
        expectations.write_batch(
            batch.sparkSession.createDataFrame(
                [(int(batch_id), r.name, int(metrics.get(r.name, 0)), int(metrics.get("rows", 0))) for r in rules],
                "batch_id long, rule string, failed long, n_rows long",
            ),
            batch_id,
        )

    return handle


def expectation_log(spark: SparkSession, layout: "Layout", table: str) -> DataFrame:
    """Per micro-batch and rule: rows that failed a warn-only bronze expectation."""
    return AppendOnlyTable(spark, layout.table_path("_expectations", table)).read()


def start_bronze(
    spark: SparkSession,
    spec: SourceSpec,
    layout: Layout,
    max_files_per_trigger: int | None = None,
):
    """Start the triggered ingest of one dataset; returns (query, table)."""
    table = AppendOnlyTable(spark, layout.table_path("bronze", spec.table))
    checkpoint = layout.checkpoint("bronze", spec.table)
    if table.exists() and not path_exists(spark, checkpoint):
        # Without its checkpoint the stream would re-ingest every landed file
        # into a table that already holds them: refuse instead of duplicating.
        raise RuntimeError(f"bronze table {spec.table} has data but no checkpoint at {checkpoint}")
    stream = _discover(spark, spec, layout.landing_dir(spec), max_files_per_trigger)
    expectations = AppendOnlyTable(spark, layout.table_path("_expectations", spec.table))
    writer = stream.writeStream.foreachBatch(_bronze_batch(spec, table, expectations)).option("checkpointLocation", checkpoint)
    return writer.trigger(availableNow=True).queryName(f"bronze_{spec.table}").start(), table


def await_query(q, timeout_s: int | None = DEFAULT_TIMEOUT_S) -> None:
    """Wait for a triggered query to drain; raise its failure or a timeout."""
    if timeout_s is None:
        q.awaitTermination()
    elif not q.awaitTermination(timeout_s):
        q.stop()
        raise TimeoutError(f"{q.name} did not finish in {timeout_s}s")
    if q.exception() is not None:
        raise RuntimeError(f"{q.name}: {q.exception()}")


def await_all(queries: list, timeout_s: int | None = DEFAULT_TIMEOUT_S) -> None:
    """Wait for queries that run side by side; when one fails the others are stopped, not left running."""
    try:
        for q in queries:
            await_query(q, timeout_s)
    finally:
        for q in queries:
            if q.isActive:  # another one failed
                q.stop()


def refresh_bronze(
    spark: SparkSession,
    spec: SourceSpec,
    layout: Layout,
    timeout_s: int | None = DEFAULT_TIMEOUT_S,
    max_files_per_trigger: int | None = None,
) -> AppendOnlyTable:
    """Ingest every file landed since the last refresh into the bronze table."""
    q, table = start_bronze(spark, spec, layout, max_files_per_trigger)
    await_query(q, timeout_s)
    return table


def refresh_registry(
    spark: SparkSession, specs: list[SourceSpec], layout: Layout, timeout_s: int | None = DEFAULT_TIMEOUT_S
) -> dict[str, AppendOnlyTable]:
    """Refresh one bronze table per spec, all streams running concurrently (own checkpoint each)."""
    started = [(spec, *start_bronze(spark, spec, layout)) for spec in specs]
    await_all([q for _, q, _ in started], timeout_s)
    return {spec.table: table for spec, _, table in started}
