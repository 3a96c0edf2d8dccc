import pytest
from pyspark.sql import functions as F

from tidemark.plans.medallion import Namespace
from tidemark.plans.series_specs import pr_data
from tidemark.sinks.manifest import record_landing
from tidemark.sinks.tables import AppendOnlyTable
from tidemark.sources.tables import bootstrap_namespace, list_layer_tables, register_table, temporary_view
from tidemark.streaming.bronze import SourceSpec, expectation_log, refresh_bronze
from tidemark.streaming.silver import read_silver, refresh_silver

SID, VAL = "series_id".ljust(17), "value".rjust(12)


def test_namespace_bootstrap_is_idempotent_and_lists_tables(spark, scratch):
    dbs = bootstrap_namespace(spark, "tm", "dev", f"{scratch}/tables")
    assert bootstrap_namespace(spark, "tm", "dev", f"{scratch}/tables") == dbs
    spark.range(3).write.parquet(f"{scratch}/tables/gold/t1")
    register_table(spark, "tm_dev_gold", "t1", f"{scratch}/tables/gold/t1")
    temporary_view(spark.range(1), "tm_scratch_view")
    got = {(r.database, r.table) for r in list_layer_tables(spark, dbs).collect()}
    assert got == {("tm_dev_gold", "t1")}
    assert spark.table("tm_dev_gold.t1").count() == 3


def test_namespace_from_session_conf(spark, scratch):
    spark.conf.set("tidemark.env", "prod")
    try:
        ns = Namespace.from_session(spark, scratch)
        assert ns.database("silver") == "tidemark_prod_silver"
        assert ns.layout.tables.endswith("/tidemark_prod/tables")
    finally:
        spark.conf.unset("tidemark.env")


def test_data_first_audit_row_last(spark, layout):
    # A crash between landing and the manifest append; the rerun converges.
    snap = spark.createDataFrame(
        [("PRS1", "2001", "Q01", "1.5", ""), ("PRS2", "2001", "Q01", "2.5", "")],
        ", ".join(f"`{h}` string" for h in (SID, "year", "period", VAL, "footnote_codes")),
    )
    manifest = AppendOnlyTable(spark, f"{layout.tables}/source_manifest")

    def crash(_path):
        raise RuntimeError("injected failure after landing")

    with pytest.raises(RuntimeError):
        record_landing(spark, snap, layout.landing, layout.source, "pr.data.1.AllData", "20260909T163000Z",
                       manifest, 1, after_landing=crash)
    assert not manifest.exists()
    record_landing(spark, snap, layout.landing, layout.source, "pr.data.1.AllData", "20260909T170000Z", manifest, 1)
    rows = manifest.read().collect()
    assert [(r.status, r.ingest_ts) for r in rows] == [("FETCHED", "20260909T170000Z")]
    assert len(rows[0].content_sha256) == 64 and rows[0].bytes > 0
    spec = SourceSpec("pr.data.1.AllData", "pr_data_1_alldata")
    refresh_bronze(spark, spec, layout)
    assert refresh_bronze(spark, spec, layout).read().count() == 4  # both landings ingested
    silver = read_silver(refresh_silver(spark, pr_data(2100), layout, spec.table))
    assert {(r.series_id, r.value) for r in silver.collect()} == {("PRS1", 1.5), ("PRS2", 2.5)}
    log = expectation_log(spark, layout, spec.table).agg(F.sum("failed"), F.sum("n_rows")).first()
    assert tuple(log) == (0, 4)


def test_unchanged_snapshot_is_not_landed_again(spark, layout):
    # Equal fingerprint -> UNCHANGED row, nothing landed; a change lands again.
    cols = ", ".join(f"`{h}` string" for h in (SID, "year", "period", VAL, "footnote_codes"))
    a = spark.createDataFrame([("PRS1", "2001", "Q01", "1.5", ""), ("PRS2", "2001", "Q01", "2.5", "")], cols)
    a_reordered = spark.createDataFrame([("PRS2", "2001", "Q01", "2.5", ""), ("PRS1", "2001", "Q01", "1.5", "")], cols)
    b = spark.createDataFrame([("PRS1", "2001", "Q01", "1.6", ""), ("PRS2", "2001", "Q01", "2.5", "")], cols)
    m = AppendOnlyTable(spark, f"{layout.tables}/source_manifest")
    ds = "pr.data.1.AllData"
    assert record_landing(spark, a, layout.landing, layout.source, ds, "20260101T000000Z", m, 1) is not None
    assert record_landing(spark, a_reordered, layout.landing, layout.source, ds, "20260201T000000Z", m, 2) is None
    assert record_landing(spark, b, layout.landing, layout.source, ds, "20260301T000000Z", m, 3) is not None
    got = [(r.ingest_ts, r.status, r.landing_path is None) for r in m.read().orderBy("ingest_ts").collect()]
    assert got == [("20260101T000000Z", "FETCHED", False), ("20260201T000000Z", "UNCHANGED", True),
                   ("20260301T000000Z", "FETCHED", False)]


def test_run_isolates_item_errors_and_listing_failure(spark, layout):
    # Three items, one fails -> 3 rows, 2 landed, run had an error; a failed listing is its own row.
    from tidemark.sinks.manifest import record_run

    cols = ", ".join(f"`{h}` string" for h in ("class_code", "class_text"))
    snap = spark.createDataFrame([("01", "All workers")], cols)
    other = spark.createDataFrame([("02", "Employees")], cols)
    m = AppendOnlyTable(spark, f"{layout.tables}/source_manifest")
    summary = record_run(spark, [("pr.class", snap), ("pr.contacts", RuntimeError("HTTP 500")), ("pr.sector", other)],
                         layout.landing, layout.source, "20260909T163000Z", m, 1).first()
    assert (summary.had_error, summary.n, summary.n_fetched, summary.n_error) == (True, 3, 2, 1)
    rows = {r.dataset: r for r in m.read().collect()}
    assert rows["pr.contacts"].status == "ERROR" and rows["pr.contacts"].error_message == "HTTP 500"
    assert rows["pr.contacts"].landing_path is None and rows["pr.class"].landing_path is not None
    # Listing failure: one ERROR row for the listing plus whatever items were fetched.
    summary = record_run(spark, [("pr.class", snap)], layout.landing, layout.source, "20260910T000000Z", m, 2,
                         listing_error="listing timed out").first()
    assert (summary.had_error, summary.n, summary.n_unchanged) == (True, 2, 1)
    assert m.read().filter("dataset = '_directory_listing'").count() == 1
