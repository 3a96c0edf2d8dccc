"""Bronze → silver on FIXTURES-shaped snapshots (padded TSV, restatements, drift, malformed rows)."""

import pytest
from pyspark.sql import functions as F

from tidemark.plans.series_specs import POPULATION, pr_data
from tidemark.sinks.tables import write_landing_snapshot, write_landing_text
from tidemark.streaming.bronze import Layout, SourceSpec, refresh_bronze
from tidemark.streaming.silver import read_quarantine, read_silver, refresh_silver, refresh_silver_stateful

SID, VAL = "series_id".ljust(17), "value".rjust(12)
DATA = SourceSpec("pr.data.1.AllData", "pr_data_1_alldata")
S1, S2 = "20260101T000000Z", "20260909T163000Z"


def snapshot(spark, rows, header=(SID, "year", "period", VAL, "footnote_codes")):
    return spark.createDataFrame(rows, ", ".join(f"`{h}` string" for h in header))


def land(spark, layout, rows, stamp, header=(SID, "year", "period", VAL, "footnote_codes"), extra=None):
    df = snapshot(spark, rows, header)
    if extra is not None:
        df = df.withColumn("__x", extra)
    write_landing_snapshot(df, layout.landing, layout.source, DATA.dataset, stamp, extra_field="__x" if extra is not None else None)


FIRST = [
    ("PRS30006011     ", "1995", "Q01", "         2.6", ""),
    ("PRS30006011     ", "1995", "Q02", "         2.1", ""),
    ("PRS30006011     ", "1995", "Q03", "         0.9", ""),
    ("PRS30006011     ", "1995", "Q04", "         0.1", ""),
    ("PRS30006011     ", "1995", "Q05", "         1.4", ""),
    ("PRS30006012     ", "1996", "Q01", "         5.0", ""),   # missing later (T13)
    ("PRS30006013     ", "1996", "Q01", "         4.0", ""),   # later restated to '-' (T25)
]
SECOND = [
    ("PRS30006011     ", "1995", "Q01", "         3.6", "P"),  # restated
    ("PRS30006011     ", "1995", "Q02", "         2.1", ""),
    ("PRS30006013     ", "1996", "Q01", "           -", ""),
    ("PRS30006014     ", "1899", "Q01", "         1.0", ""),   # implausible year
    ("PRS30006014     ", "2001", "Q06", "         1.0", ""),   # bad period
    ("PRS30006014     ", "20x1", "Q01", "         1.0", ""),   # malformed year (T2)
    ("PRS30006014     ", "2001", "Q01", "            ", ""),   # blank value
    ("PRS30006014     ", "2001", "   ", "         1.0", ""),   # blank period
    ("PRS30006014     ", "2101", "Q01", "         1.0", ""),   # after the year bound (parameter)
    ("PRS30006015     ", "2002", "Q01", "         7.0", ""),   # one key twice in one file (T26):
    ("PRS30006015     ", "2002", "Q01", "         8.0", ""),   # the larger payload wins, always
]


def silver_values(table):
    return {(r.series_id, r.year, r.period): r.value for r in read_silver(table).collect()}


def expected_after_both():
    return {
        ("PRS30006011", 1995, "Q01"): 3.6,
        ("PRS30006011", 1995, "Q02"): 2.1,
        ("PRS30006011", 1995, "Q03"): 0.9,
        ("PRS30006011", 1995, "Q04"): 0.1,
        ("PRS30006011", 1995, "Q05"): 1.4,
        ("PRS30006012", 1996, "Q01"): 5.0,
        ("PRS30006013", 1996, "Q01"): 4.0,
        ("PRS30006015", 2002, "Q01"): 8.0,
    }


def test_two_snapshots_in_one_micro_batch(spark, layout):
    # Both snapshots arrive in one micro-batch (equal _ingested_at): the path stamp orders them.
    land(spark, layout, SECOND, S2)
    land(spark, layout, FIRST, S1)
    bronze = refresh_bronze(spark, DATA, layout).read()
    assert bronze.select("_ingested_at").distinct().count() == 1
    assert set(bronze.columns) >= {SID, VAL, "_ingest_ts", "_source_file", "_rescued_data"}
    table = refresh_silver(spark, pr_data(2100), layout, DATA.table)
    assert silver_values(table) == expected_after_both()
    rejected = read_quarantine(spark, layout, "pr_data")
    assert rejected.count() == 7  # six malformed rows + the '-' restatement
    failed = {tuple(r._failed_rules) for r in rejected.collect()}
    assert ("plausible_year",) in failed and ("valid_period",) in failed and ("valid_value",) in failed


def test_two_snapshots_in_two_runs_and_replay(spark, layout):
    land(spark, layout, FIRST, S1)
    refresh_bronze(spark, DATA, layout)
    refresh_silver(spark, pr_data(2100), layout, DATA.table)
    land(spark, layout, SECOND, S2)
    refresh_bronze(spark, DATA, layout)
    table = refresh_silver(spark, pr_data(2100), layout, DATA.table)
    assert silver_values(table) == expected_after_both()
    # A refresh with nothing new changes nothing (no new version).
    v = table.current_version()
    refresh_bronze(spark, DATA, layout)
    refresh_silver(spark, pr_data(2100), layout, DATA.table)
    assert table.current_version() == v


def test_stateful_variant_agrees(spark, layout):
    land(spark, layout, FIRST, S1)
    land(spark, layout, SECOND, S2)
    refresh_bronze(spark, DATA, layout, max_files_per_trigger=1)
    a = refresh_silver(spark, pr_data(2100), layout, DATA.table, max_files_per_trigger=1)
    b = refresh_silver_stateful(spark, pr_data(2100), layout, DATA.table, max_files_per_trigger=1)
    assert silver_values(a) == silver_values(b) == expected_after_both()


def test_drift_maps_by_name_not_position(spark, layout):
    # The later snapshot adds a column in the middle and reorders.
    land(spark, layout, [("PRS1", "2001", "Q01", "1.5", "")], S1)
    land(spark, layout, [("PRS1", "X", "Q02", "2001", "2.5", "")], S2,
         header=(SID, "new_col", "period", "year", VAL, "footnote_codes"))
    bronze = refresh_bronze(spark, DATA, layout).read()
    rows = {(r["period"], r["year"], r[VAL], r["new_col"]) for r in bronze.collect()}
    assert rows == {("Q01", "2001", "1.5", None), ("Q02", "2001", "2.5", "X")}


def test_rescued_overlong_rows(spark, layout):
    # A row with one value too many keeps its columns, the surplus is rescued.
    land(spark, layout, [("PRS1", "2001", "Q01", "1.5", ""), ("PRS2", "2001", "Q01", "2.5", "")], S1,
         extra=F.when(F.col(SID) == "PRS2", F.lit("surplus")))
    bronze = refresh_bronze(spark, DATA, layout).read()
    got = {r[SID]: r["_rescued_data"] for r in bronze.collect()}
    assert got["PRS1"] is None and '"surplus"' in got["PRS2"]


def test_bronze_refuses_missing_checkpoint(spark, layout):
    # A populated bronze table without its checkpoint would be re-ingested.
    land(spark, layout, FIRST, S1)
    refresh_bronze(spark, DATA, layout)
    moved = Layout(layout.landing, layout.tables, layout.checkpoints + "_gone", layout.source)
    with pytest.raises(RuntimeError):
        refresh_bronze(spark, DATA, moved)


def test_population_document(spark, layout):
    # JSON document -> VARIANT -> exploded typed rows; 'x' population quarantined.
    pop_layout = Layout(layout.landing, layout.tables, layout.checkpoints, "datausa_population")
    doc = ('{"data": [{"Nation ID": "01000US", "Nation": "United States", "Year": 2019, "Population": 328239523},'
           '{"Nation ID": "01000US", "Nation": "United States", "Year": 2021, "Population": 331893745.0},'
           '{"Nation ID": null, "Nation": "United States", "Year": 2022, "Population": "x"}]}')
    write_landing_text(spark.createDataFrame([(doc,)], "value string"), pop_layout.landing, pop_layout.source,
                       "population", S2, "population.json")
    refresh_bronze(spark, SourceSpec("population", "population", fmt="json"), pop_layout)
    table = refresh_silver(spark, POPULATION, pop_layout, "population")
    got = {(r.nation_id, r.year): r.population for r in read_silver(table).collect()}
    assert got == {("01000US", 2019): 328239523, ("01000US", 2021): 331893745}


def test_bucketed_silver_state_agrees(spark, layout):
    from tidemark.sources.tables import bootstrap_namespace

    (db,) = bootstrap_namespace(spark, "tm", "pipe", layout.tables + "_db", layers=("silver",))
    land(spark, layout, FIRST, S1)
    refresh_bronze(spark, DATA, layout)
    refresh_silver(spark, pr_data(2100), layout, DATA.table, bucketed=(db, 8))
    land(spark, layout, SECOND, S2)
    refresh_bronze(spark, DATA, layout)
    table = refresh_silver(spark, pr_data(2100), layout, DATA.table, bucketed=(db, 8))
    assert silver_values(table) == expected_after_both()
    assert spark.catalog.tableExists(f"{db}.pr_data_v1")
