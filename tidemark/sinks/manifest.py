"""Append-only audit ledger: one row per item per run.

Outcomes are rows (a DataFrame), so a run over many items is one Spark job,
and a partial failure of one item is a row with status ERROR, not an
exception. NULL rules by status:

=========  ==============  ====================  ================  =====  ============
status     content_sha256  last_modified         bytes             landing_path
=========  ==============  ====================  ================  =====  ============
FETCHED    digest          validator as given    byte length       path
UNCHANGED  digest if known prior validator       NULL              NULL
ERROR      NULL            NULL                  NULL              NULL
=========  ==============  ====================  ================  =====  ============
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.sinks.tables import AppendOnlyTable

# Item statuses of a fetch run.
FETCHED, UNCHANGED, ERROR = "FETCHED", "UNCHANGED", "ERROR"
# The dataset name recorded when a listing (not an item) fails.
LISTING_DATASET = "_directory_listing"

# The ledger's columns and types, in order.
MANIFEST_COLUMNS = (
    ("source", "string"),
    ("dataset", "string"),
    ("ingest_ts", "string"),
    ("status", "string"),
    ("http_status", "int"),
    ("content_sha256", "string"),
    ("last_modified", "string"),
    ("bytes", "bigint"),
    ("source_url", "string"),
    ("landing_path", "string"),
    ("run_id", "string"),
    ("fetched_at", "timestamp"),
    ("error_message", "string"),
)


def manifest_rows(outcomes: DataFrame) -> DataFrame:
    """Normalise outcome rows to the 13 ledger columns with the NULL rules above.

    ``outcomes`` must carry every column of ``MANIFEST_COLUMNS`` (any may be
    NULL); values that the status rules forbid are nulled here.
    """
    st = F.col("status")
    rules = {
        "content_sha256": F.when(st.isin(FETCHED, UNCHANGED), F.col("content_sha256")),
        "last_modified": F.when(st.isin(FETCHED, UNCHANGED), F.col("last_modified")),
        "bytes": F.when(st == FETCHED, F.col("bytes")),
        "landing_path": F.when(st == FETCHED, F.col("landing_path")),
        "error_message": F.when(st == ERROR, F.col("error_message")),
    }
    return outcomes.select(
        *[rules.get(name, F.col(name)).cast(t).alias(name) for name, t in MANIFEST_COLUMNS]
    )


def append_manifest(table: AppendOnlyTable, rows: DataFrame, run_seq: int) -> None:
    """Append one run's rows (replaying the same run id replaces only that run).

    A sequence number that already holds another run's rows is refused: the ledger only grows.
    """
    earlier = table.read_batch(run_seq)
    if earlier is not None:
        stored = earlier.select("run_id").distinct()
        if not stored.exceptAll(rows.select(F.col("run_id").cast("string")).distinct()).isEmpty():
            raise ValueError(f"run sequence {run_seq} of {table.path} belongs to another run")
    table.write_batch(manifest_rows(rows), run_seq)


def last_known_state(manifest: DataFrame, source: str) -> DataFrame:
    """Latest FETCHED row per dataset of one source (sha, validator, stamp).

    The run stamp is fixed-width UTC text, so its order is time order.
    """
    from tidemark.operators.ranking import top_row_per_group

    fetched = manifest.filter((F.col("source") == source) & (F.col("status") == FETCHED))
    return top_row_per_group(
        fetched, ["dataset"], ["ingest_ts", "fetched_at"], ["ingest_ts", "content_sha256", "last_modified"]
    )


def snapshot_fingerprint(snapshot: DataFrame, sep: str = "\t", ordered: bool = False) -> DataFrame:
    """One row (content_sha256, bytes) for a delimited snapshot, computed in tasks.

    The fingerprint covers the header and the data lines, and no snapshot is ever gathered into one task. By default
    it is one of the rows as a multiset (sum of 64-bit line hashes and line count, combined map-side): a DataFrame has no row order of its own,
    so equal rows in another order are the same content. With ``ordered`` it is a tree of digests over the lines in
    their order (:func:`ordered_fingerprint`): reordered lines differ, as they do in the bytes of a file.
    """
    from tidemark.operators.fingerprints import ordered_fingerprint
    from tidemark.sinks.tables import snapshot_lines

    line = snapshot_lines(snapshot, sep)
    header = sep.join(snapshot.columns)
    header_bytes = F.lit(len(header.encode("utf-8")) + 1)
    if ordered:
        found = ordered_fingerprint(snapshot.select(line.alias("line")), head=header)
        return found.select("content_sha256", (F.col("bytes") + header_bytes).alias("bytes"))
    agg = snapshot.select(line.alias("line")).agg(
        F.sum(F.xxhash64("line").cast("decimal(38,0)")).alias("h"),
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("line") + 1).alias("bytes"),
    )
    return agg.select(
        F.sha2(F.concat_ws(":", F.lit(header), F.coalesce(F.col("h"), F.lit(0)).cast("string"), F.col("n").cast("string")), 256)
        .alias("content_sha256"),
        (F.coalesce(F.col("bytes"), F.lit(0)) + header_bytes).cast("long").alias("bytes"),
    )


ROW_SCHEMA = (
    "source string, dataset string, ingest_ts string, status string, http_status int, content_sha256 string, "
    "last_modified string, bytes bigint, source_url string, landing_path string, run_id string, error_message string"
)


def land_item(
    spark,
    snapshot: DataFrame,
    landing_base: str,
    source: str,
    dataset: str,
    stamp: str,
    known_sha: str | None,
    run_id: str = "local",
    source_url: str | None = None,
    ordered: bool = False,
) -> tuple:
    """Fingerprint one snapshot and land it unless unchanged; returns its ledger row (a tuple).

    Equal to ``known_sha`` (the last FETCHED fingerprint) → UNCHANGED, nothing
    landed; otherwise (or on first sighting) the snapshot is landed → FETCHED.
    """
    from tidemark.sinks.tables import write_landing_snapshot

    fp = snapshot_fingerprint(snapshot, ordered=ordered).first()
    unchanged = known_sha is not None and known_sha == fp["content_sha256"]
    path = None if unchanged else write_landing_snapshot(snapshot, landing_base, source, dataset, stamp)
    return (source, dataset, stamp, UNCHANGED if unchanged else FETCHED, 200, fp["content_sha256"], None,
            fp["bytes"], source_url or f"{source}/{dataset}", path, run_id, None)


def error_row(source: str, dataset: str, stamp: str, message: str, http_status: int | None = None,
              run_id: str = "local", source_url: str | None = None) -> tuple:
    """Ledger row of an item (or a listing, dataset ``_directory_listing``) that could not be fetched."""
    return (source, dataset, stamp, ERROR, http_status, None, None, None, source_url or f"{source}/{dataset}",
            None, run_id, message)


def record_run(
    spark,
    items: list,
    landing_base: str,
    source: str,
    stamp: str,
    manifest: AppendOnlyTable,
    run_seq: int,
    run_id: str = "local",
    listing_error: str | None = None,
    after_landing=None,
    ordered: bool = False,
) -> DataFrame:
    """One fetch run: land every item, then append the run's ledger rows (data first, audit rows last).

    ``items`` are (dataset, snapshot DataFrame) pairs, or (dataset, Exception)
    for an item whose fetch failed; a failed item becomes an ERROR row and
    never stops the others. ``listing_error`` records a failed listing as
    one ERROR row for ``_directory_listing``. ``after_landing`` is called
    after all landings and before the ledger append (tests inject failures
    there). ``ordered`` makes the order of a snapshot's lines part of its content (see :func:`snapshot_fingerprint`). Returns the run summary: had_error, n and counts per status.
    """
    from tidemark.operators.aggregates import run_summary

    known = {}
    if manifest.exists():
        known = {r["dataset"]: r["content_sha256"] for r in last_known_state(manifest.read(), source).collect()}
    rows = []
    if listing_error is not None:
        rows.append(error_row(source, LISTING_DATASET, stamp, listing_error, run_id=run_id))
    for dataset, item in items:
        if isinstance(item, Exception):
            rows.append(error_row(source, dataset, stamp, str(item), run_id=run_id))
            continue
        try:
            rows.append(land_item(spark, item, landing_base, source, dataset, stamp, known.get(dataset), run_id, ordered=ordered))
        except Exception as exc:  # noqa: BLE001 - per-item isolation: record and continue
            rows.append(error_row(source, dataset, stamp, f"{type(exc).__name__}: {exc}", run_id=run_id))
    if after_landing is not None:
        after_landing(rows)
    run_rows = spark.createDataFrame(rows, ROW_SCHEMA).withColumn("fetched_at", F.current_timestamp())
    append_manifest(manifest, run_rows, run_seq)
    return run_summary(manifest_rows(run_rows), "run_id", "status", ERROR, (FETCHED, UNCHANGED, ERROR))


def record_landing(
    spark,
    snapshot: DataFrame,
    landing_base: str,
    source: str,
    dataset: str,
    stamp: str,
    manifest: AppendOnlyTable,
    run_seq: int,
    run_id: str = "local",
    source_url: str | None = None,
    after_landing=None,
) -> str | None:
    """A run of one item (see :func:`record_run`); returns its landing path, or None when unchanged."""
    record_run(spark, [(dataset, snapshot)], landing_base, source, stamp, manifest, run_seq, run_id,
               after_landing=after_landing)
    row = manifest.read().filter((F.col("ingest_ts") == stamp) & (F.col("dataset") == dataset)).first()
    return row["landing_path"]
