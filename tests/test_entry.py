"""Driver contract: entry(), queries() and oracle_sql() agree at a small scale."""

import datetime
import decimal
import math

import duckdb
import pytest

import __spark_entry__ as entry
from tidemark.plans import registry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
ROWS_ONLY = {"retain_versions"}
# Quick keys compared here; the full set runs in scripts/check_oracle.py.
FAST_KEYS = [
    "agg_value_per_year", "value_per_quarter", "population_stats", "best_year_report", "scd1_latest",
    "latest_per_group", "change_detection", "listing_links", "quarantine_by_rule", "star_label_join",
    "variant_explode", "expect_all_or_drop", "ingest_schema_evolution", "manifest_append",
]


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(norm(x) for x in v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    c.execute("SET TimeZone='UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
    assert "summed_value" in df.columns and "is_best_year" in df.columns


def test_every_query_has_an_oracle_unless_rows_only():
    assert set(registry.QUERIES) - set(registry.ORACLES) == ROWS_ONLY
    assert set(registry.ORACLES) <= set(registry.QUERIES)


@pytest.mark.parametrize("name", FAST_KEYS)
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF)
    cols = sorted(df.columns)
    got = sorted((tuple(norm(r[c]) for c in cols) for r in df.collect()), key=repr)
    cur = con.execute(entry.oracle_sql()[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    want = sorted((tuple(norm(r[i]) for i in idx) for r in cur.fetchall()), key=repr)
    assert got == want
