"""Silver: typed, quality-gated, SCD type 1 tables kept current from bronze.

Two ways to run the upsert, same result:

* :func:`refresh_silver` — a triggered stream over the bronze table; each
  micro-batch is typed, gated (failing rows go to a quarantine table with
  the rule names) and merged into the versioned silver table in
  ``foreachBatch``: new state = latest per key over (current ∪ batch).
  A batch id already committed is skipped, so a replayed batch changes nothing.
* :func:`refresh_silver_stateful` — the stream keeps the latest row per key
  in Spark's state store (``groupBy(keys).agg(max(struct(seq, payload)))``,
  update mode) and each micro-batch merges only the keys it changed.

Sequence: (``_ingest_ts`` — the run stamp in the landed path, then
``_ingested_at``), so two snapshots ingested in one micro-batch (equal
``_ingested_at``) are still ordered by when they were landed. The payload
breaks remaining ties. Rows are gated before the upsert: a restatement that
fails a rule never replaces the current value.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.cleaning import TableSpec, project_spec
from tidemark.functions.variant import variant_array, variant_field
from tidemark.operators.cdc import latest_per_key, publish, scd1_merge, scd1_merge_join
from tidemark.operators.quality import FAILED_RULES, failed_rules, quarantine
from tidemark.session import path_exists
from tidemark.sinks.keyed import KeyedTable
from tidemark.sinks.tables import AppendOnlyTable, BucketedVersionedTable, VersionedTable
from tidemark.sources.delimited import INGEST_TS, INGESTED_AT, SOURCE_FILE
from tidemark.streaming.bronze import DEFAULT_TIMEOUT_S, Layout, await_query

SEQUENCE = [INGEST_TS, INGESTED_AT]
BRONZE_FILE = "_bronze_file"


def typed_batch(raw: DataFrame, spec: TableSpec) -> DataFrame:
    """Bronze rows → spec columns + sequence columns (headers resolved per name).

    For a VARIANT document table the array at ``spec.variant_path`` is
    exploded first; fields are read with ``try_variant_get`` (bracket path for
    names with spaces), so a malformed value is NULL for the rules to catch.
    """
    keep = [*SEQUENCE, *([SOURCE_FILE] if SOURCE_FILE in raw.columns else [])]
    if spec.variant_path is None:
        return project_spec(raw, spec, keep=tuple(keep))
    items = raw.select(F.explode(variant_array("value", spec.variant_path)).alias("__item"), *keep)
    return items.select(
        *[variant_field("__item", cs.raw or cs.name, cs.type_name).alias(cs.name) for cs in spec.columns], *keep
    )


def gate(typed: DataFrame, spec: TableSpec) -> tuple[DataFrame, DataFrame]:
    """(clean rows, quarantined rows with ``_failed_rules``)."""
    return quarantine(typed, list(spec.rules))


def payload_columns(spec: TableSpec) -> list[str]:
    return [c.name for c in spec.columns if c.name not in spec.keys]


def _run(q, name: str, timeout_s: int) -> None:
    del name  # the query carries its own name
    await_query(q, timeout_s)


def _bronze_stream(spark: SparkSession, bronze_path: str, max_files: int | None, checkpoint: str) -> DataFrame:
    """The bronze table as a stream by its recorded schema: no footer of an old batch is opened.

    A stream that has not begun cannot read batches whose directories have been swept after packing: it is refused.
    """
    bronze = AppendOnlyTable(spark, bronze_path)
    if not path_exists(spark, checkpoint) and bronze.swept():
        raise RuntimeError(f"{bronze_path}: batches have been swept, a stream without a checkpoint would miss them")
    reader = spark.readStream.schema(bronze.schema())
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(bronze_path)


def with_new_columns(batch: DataFrame, bronze: AppendOnlyTable) -> DataFrame:
    """A micro-batch (with ``_bronze_file``) by the newest schema: a stream keeps the one it started with, so where columns
    have come since, the batch's files are read again. Their paths reach the driver, as in the listing that found them."""
    if set(bronze.schema().names) <= set(batch.columns):
        return batch.drop(BRONZE_FILE)
    files = [r[0] for r in batch.select(BRONZE_FILE).distinct().collect()]
    return bronze.read_files(files) if files else batch.drop(BRONZE_FILE)


def _merge(target: VersionedTable, rows: DataFrame, keys: list[str], sequence: list[str], payload: list[str], batch_id: int, stream: str, current: int | None) -> None:
    """Upsert ``rows`` into the target by the way it is stored and commit."""
    if isinstance(target, KeyedTable):
        target.upsert(rows, sequence, payload, batch_id, stream, current)
        return
    merge = scd1_merge_join if isinstance(target, BucketedVersionedTable) else scd1_merge
    state = merge(target.read(current) if current is not None else None, rows, keys, sequence, payload)
    target.commit(state, batch_id, stream, current=current)


def start_silver(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    bronze_table: str,
    max_files_per_trigger: int | None = None,
    bucketed: tuple[str, int] | None = None,
    rows_per_file: int | None = None,
    trigger: dict | None = None,
):
    """Start the triggered upsert of one silver table; returns (query, table).

    ``bucketed=(database, buckets)`` keeps the state bucketed on the key and
    merges with a join that shuffles only the batch (``scd1_merge_join``);
    ``rows_per_file`` keeps it as a :class:`KeyedTable`, of which a batch rewrites only the files it touches.
    ``trigger`` is ``availableNow`` unless given.
    """
    if rows_per_file is not None:
        target = KeyedTable(spark, layout.table_path("silver", spec.name), list(spec.keys), rows_per_file)
    elif bucketed is None:
        target = VersionedTable(spark, layout.table_path("silver", spec.name))
    else:
        database, buckets = bucketed
        target = BucketedVersionedTable(
            spark, layout.table_path("silver", spec.name), database, spec.name, list(spec.keys), buckets
        )
    bronze = AppendOnlyTable(spark, layout.table_path("bronze", bronze_table))
    rejected_table = AppendOnlyTable(spark, layout.table_path("quarantine", spec.name))
    stream_name = f"silver_{spec.name}"
    keys, payload = list(spec.keys), payload_columns(spec)

    def handle(batch: DataFrame, batch_id: int) -> None:
        current, done = target.state(batch_id, stream_name)
        if done:
            return
        # The typed batch feeds two writes (quarantine, merge): persist it for
        # the duration of the batch so bronze is read and parsed once. Lost
        # cached blocks are recomputed from the batch's files.
        flagged = typed_batch(with_new_columns(batch, bronze), spec).withColumn(FAILED_RULES, failed_rules(list(spec.rules)))
        flagged.persist(StorageLevel.MEMORY_AND_DISK)
        try:
            rejected_table.write_batch(flagged.filter(F.size(FAILED_RULES) > 0), batch_id)
            clean = flagged.filter(F.size(FAILED_RULES) == 0).drop(FAILED_RULES, SOURCE_FILE)
            _merge(target, clean, keys, SEQUENCE, payload, batch_id, stream_name, current)
        finally:
            flagged.unpersist()

    q = (
        _bronze_stream(spark, bronze.path, max_files_per_trigger, layout.checkpoint("silver", spec.name))
        .withColumn(BRONZE_FILE, F.col("_metadata.file_path"))
        .writeStream.foreachBatch(handle)
        .option("checkpointLocation", layout.checkpoint("silver", spec.name))
        .trigger(**(trigger or {"availableNow": True}))
        .queryName(stream_name)
        .start()
    )
    return q, target


def refresh_silver(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    bronze_table: str,
    timeout_s: int = DEFAULT_TIMEOUT_S,
    max_files_per_trigger: int | None = None,
    bucketed: tuple[str, int] | None = None,
    rows_per_file: int | None = None,
) -> VersionedTable:
    """Bring the silver SCD1 table up to date with everything in bronze."""
    q, target = start_silver(spark, spec, layout, bronze_table, max_files_per_trigger, bucketed, rows_per_file)
    _run(q, q.name, timeout_s)
    return target


def refresh_silver_stateful(
    spark: SparkSession,
    spec: TableSpec,
    layout: Layout,
    bronze_table: str,
    timeout_s: int = DEFAULT_TIMEOUT_S,
    max_files_per_trigger: int | None = None,
) -> VersionedTable:
    """Same table via a stateful streaming aggregate (latest per key in the state store)."""
    target = VersionedTable(spark, layout.table_path("silver_state", spec.name))
    stream_name = f"silver_state_{spec.name}"
    keys, payload = list(spec.keys), payload_columns(spec)
    raw = _bronze_stream(spark, layout.table_path("bronze", bronze_table), max_files_per_trigger, layout.checkpoint("silver_state", spec.name))
    clean = typed_batch(raw, spec).filter(
        F.size(F.array_compact(F.array(*[F.when(~r.passes(), F.lit(r.name)) for r in spec.rules]))) == 0
        if spec.rules else F.lit(True)
    )
    latest = latest_per_key(clean.drop(SOURCE_FILE), keys, SEQUENCE, payload, keep_sequence=True)

    def handle(changed: DataFrame, batch_id: int) -> None:
        current, done = target.state(batch_id, stream_name)
        if done:
            return
        prev = target.read(current) if current is not None else None
        target.commit(scd1_merge(prev, changed, keys, SEQUENCE, payload), batch_id, stream_name, current=current)

    q = (
        latest.writeStream.outputMode("update")
        .foreachBatch(handle)
        .option("checkpointLocation", layout.checkpoint("silver_state", spec.name))
        .trigger(availableNow=True)
        .queryName(stream_name)
        .start()
    )
    _run(q, stream_name, timeout_s)
    return target


def read_silver(table: VersionedTable) -> DataFrame | None:
    """The published SCD1 table (sequence columns dropped)."""
    state = table.read()
    return None if state is None else publish(state, SEQUENCE)


def read_quarantine(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    return AppendOnlyTable(spark, layout.table_path("quarantine", name)).read()


def upsert_stream(
    stream: DataFrame,
    keys: list[str],
    sequence: list[str],
    payload: list[str],
    target: VersionedTable,
    checkpoint: str,
    name: str,
    stateful: bool = False,
    timeout_s: int = DEFAULT_TIMEOUT_S,
) -> VersionedTable:
    """Generic SCD1 upsert of any streaming DataFrame into a versioned table.

    ``stateful=False``: each micro-batch is merged with the table (stateless
    stream). ``stateful=True``: the latest row per key is kept in the state
    store and only changed keys are merged.
    """
    source = latest_per_key(stream, keys, sequence, payload, keep_sequence=True) if stateful else stream

    def handle(batch: DataFrame, batch_id: int) -> None:
        current, done = target.state(batch_id, name)
        if done:
            return
        _merge(target, batch, keys, sequence, payload, batch_id, name, current)

    writer = source.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    if stateful:
        writer = writer.outputMode("update")
    _run(writer.trigger(availableNow=True).queryName(name).start(), name, timeout_s)
    return target
