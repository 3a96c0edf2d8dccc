import datetime
import hashlib

import pytest
from pyspark.sql import functions as F

from tidemark.functions.cleaning import decode_flag, sentinel_to_null, strip_column_names, trim_strings
from tidemark.functions.keys import null_safe_surrogate_key, surrogate_key, with_audit_columns
from tidemark.functions.labels import compose_label
from tidemark.functions.text import ingest_ts, ingest_ts_from_path, landing_path, listing_links, table_name_from_dataset
from tidemark.functions.variant import path_for, variant_field


def test_surrogate_key_is_the_digest_of_the_separated_parts(spark):
    rows = [("north", 7, None), ("north", 7, None), ("nort", 7, "h"), ("", 7, "north"), ("north7", None, None), ("7", None, "north")]
    df = spark.createDataFrame(rows, "region string, n int, note string")
    keys = [r[0] for r in df.select(surrogate_key("region", "n", "note")).collect()]
    expected = [hashlib.sha256("\u2016".join("" if x is None else str(x) for x in r).encode()).hexdigest() for r in rows]
    assert keys == expected and len(set(keys)) == len(set(rows))


def test_surrogate_key_null_equals_empty_but_null_safe_variant_differs(spark):
    # NULL -> '' collides with '' (kept), the null-safe variant does not.
    df = spark.createDataFrame([(None,), ("",)], "k string")
    assert df.select(surrogate_key("k")).distinct().count() == 1
    assert df.select(null_safe_surrogate_key("k")).distinct().count() == 2


def test_surrogate_key_needs_a_column():
    with pytest.raises(ValueError):
        surrogate_key()


def test_audit_columns_keep_the_rows(spark):
    out = with_audit_columns(spark.range(3), "nightly load").collect()
    assert sorted(r["id"] for r in out) == [0, 1, 2]
    assert {r["_source"] for r in out} == {"nightly load"} and all(r["_insert_update_ts"] for r in out)


def test_sentinel_to_null_never_zero_and_never_raises(spark):
    # P4/T2: '-' and blank are NULL; padded numbers parse; malformed text is NULL under ANSI.
    df = spark.createDataFrame([("-",), ("",), ("   ",), ("  2.6",), ("x1",), (None,)], "v string")
    got = [r[0] for r in df.select(sentinel_to_null("v", "double")).collect()]
    assert got == [None, None, None, 2.6, None, None]


def test_flag_decode_has_no_otherwise_branch(spark):
    # T -> true, F -> false, anything else -> NULL.
    df = spark.createDataFrame([("T",), ("F",), ("X",), (None,)], "f string")
    assert [r[0] for r in df.select(decode_flag("f")).collect()] == [True, False, None, None]


def test_strip_column_names(spark):
    df = spark.createDataFrame([(1, 2)], ["series_id        ", "       value"])
    assert strip_column_names(df).columns == ["series_id", "value"]
    with pytest.raises(ValueError):
        strip_column_names(spark.createDataFrame([(1, 2)], ["a ", " a"]))


def test_trim_is_spaces_only(spark):
    # Values are trimmed of spaces; a trailing TAB survives.
    df = spark.createDataFrame([("  a  ", "b\t")], "x string, y string")
    row = trim_strings(df).first()
    assert row["x"] == "a" and row["y"] == "b\t"


def test_compose_label_null_rules(spark):
    # Concat is NULL if a part is NULL, concat_ws skips NULLs, all NULL gives ''.
    df = spark.createDataFrame(
        [
            ("Business", "Labor productivity", "Index", "All workers", "Seasonally adjusted"),
            ("Business", "Labor productivity", None, "All workers", None),
            (None, None, None, None, None),
        ],
        "sector_name string, measure_text string, duration_text string, class_text string, seasonal_text string",
    )
    got = [r[0] for r in df.select(compose_label()).collect()]
    assert got == [
        "Business, Labor productivity (Index), All workers, Seasonally adjusted",
        "Business, All workers",
        "",
    ]


def test_ingest_ts_utc_and_offset(spark):
    df = spark.createDataFrame(
        [(datetime.datetime(2026, 9, 9, 16, 30, 0),)], "ts timestamp"
    )
    assert df.select(ingest_ts("ts")).first()[0] == "20260909T163000Z"
    off = spark.sql("SELECT to_utc_timestamp(timestamp '2026-09-09 16:30:00', 'GMT-05:00') AS ts")
    assert off.select(ingest_ts("ts")).first()[0] == "20260909T213000Z"


def test_landing_path_and_stamp_round_trip(spark):
    df = spark.createDataFrame([("bls_pr", "pr.series", "pr.series")], "s string, d string, f string")
    p = df.select(landing_path("/base", "s", "d", "f", F.lit("20260909T163000Z")).alias("p")).first()["p"]
    assert p == "/base/bls_pr/pr.series/pr.series__20260909T163000Z"
    df2 = spark.createDataFrame([(p,), (p + "/part-0000.csv",), ("/x/no_stamp",)], "p string")
    assert [r[0] for r in df2.select(ingest_ts_from_path("p")).collect()] == ["20260909T163000Z", "20260909T163000Z", None]


def test_population_landing_path(spark):
    df = spark.createDataFrame([("datausa_population", "population", "population.json")], "s string, d string, f string")
    p = df.select(landing_path("/b", "s", "d", "f", F.lit("20260909T163000Z"))).first()[0]
    assert p == "/b/datausa_population/population/population.json__20260909T163000Z"


def test_table_name_from_dataset(spark):
    df = spark.createDataFrame([("pr.data.1.AllData",)], "d string")
    assert df.select(table_name_from_dataset("d")).first()[0] == "pr_data_1_alldata"


def test_listing_links_by_page(spark):
    pages = [
        (1, "<ul><li><A class=x HREF='' >none</A><li><a HREF=\"/data/2020/wages.csv\">w</a></ul>".replace("''", '""')),
        (2, '<pre><a href="?sort=size">Size</a> <a href="/">Root</a>\n<a href="notes.txt">notes</a> <a href="old/">old/</a></pre>'),
        (3, None),
        (4, "no link here"),
    ]
    got = listing_links(spark.createDataFrame(pages, "page_id int, html string"), keep=("page_id",)).collect()
    assert sorted(map(tuple, got)) == [(1, "wages.csv"), (2, "notes.txt")]


def test_variant_bracket_path_and_safe_casts(spark):
    assert path_for("Nation ID") == '$["Nation ID"]' and path_for("Year") == "$.Year"
    df = spark.sql("""SELECT parse_json('{"Nation ID": "01000US", "Population": 1.5, "Year": "x"}') AS v""")
    row = df.select(
        variant_field("v", "Nation ID", "string").alias("n"),
        variant_field("v", "Population", "bigint").alias("p"),
        variant_field("v", "Year", "int").alias("y"),
    ).first()
    # A float becomes its integer part, a non-number becomes NULL (no error).
    assert row["n"] == "01000US" and row["p"] == 1 and row["y"] is None
