import json

import pytest
from pyspark.sql import functions as F

from tidemark.operators.joins import Dim, prepare_side, star_join
from tidemark.operators.ranking import top_row_per_group_window
from tidemark.plans.series_specs import pr_data
from tidemark.sinks.manifest import ROW_SCHEMA, append_manifest
from tidemark.sinks.tables import AppendOnlyTable, write_landing_snapshot
from tidemark.sources.delimited import read_delimited
from tidemark.sources.tables import load_fixture


def test_read_delimited_batch_mixed_headers(spark, scratch):
    a = spark.createDataFrame([("1", "x")], "`id ` string, name string")
    b = spark.createDataFrame([("y", "2", "extra")], "name string, `id ` string, more string")
    write_landing_snapshot(a, scratch, "src", "ds", "20260101T000000Z")
    write_landing_snapshot(b, scratch, "src", "ds", "20260201T000000Z")
    df = read_delimited(spark, f"{scratch}/src/ds/*")
    got = {(r["id "], r["name"], r["more"], r["_ingest_ts"]) for r in df.collect()}
    assert got == {("1", "x", None, "20260101T000000Z"), ("2", "y", "extra", "20260201T000000Z")}
    assert df.filter(F.col("_ingested_at").isNull()).count() == 0


def test_values_under_blank_and_repeated_headers_are_rescued(spark, scratch):
    lines = ["a\t b\ta\t\t", "1\t2\t3\tSECRET\t", "4\t5\t\t\t", "6\t7\t8\t9\t10\t11", "12"]
    spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.text(f"{scratch}/ds__20260101T000000Z")
    df = read_delimited(spark, f"{scratch}/ds__20260101T000000Z")
    assert df.columns[:2] == ["a", " b"] and df.columns[2] == "_rescued_data"
    got = {r["a"]: (r[" b"], json.loads(r["_rescued_data"])["_extra_values"] if r["_rescued_data"] else None) for r in df.collect()}
    assert got == {"1": ("2", ["3", "SECRET"]), "4": ("5", None), "6": ("7", ["8", "9", "10", "11"]), "12": (None, None)}


def test_ledger_refuses_the_sequence_number_of_another_run(spark, scratch):
    table = AppendOnlyTable(spark, f"{scratch}/ledger")

    def rows(run, n):
        values = [("src", f"d{k}", "20260101T000000Z", "ERROR", 500, None, None, None, "u", None, run, "no") for k in range(n)]
        return spark.createDataFrame(values, ROW_SCHEMA).withColumn("fetched_at", F.current_timestamp())

    append_manifest(table, rows("run-A", 2), 1)
    append_manifest(table, rows("run-A", 3), 1)
    with pytest.raises(ValueError):
        append_manifest(table, rows("run-B", 1), 1)
    append_manifest(table, rows("run-B", 1), 2)
    assert sorted(r["run_id"] for r in table.read().collect()) == ["run-A"] * 3 + ["run-B"]


def test_years_after_the_current_one_are_not_plausible(spark):
    rule = next(r for r in pr_data().rules if r.name == "plausible_year")
    now = spark.sql("SELECT year(current_date())").first()[0]
    years = spark.createDataFrame([(1899,), (1900,), (now,), (now + 1,), (2050,)], "year int")
    assert [r.year for r in years.where(rule.predicate).collect()] == [1900, now]


def test_load_fixture_json_and_tsv(spark, scratch):
    spark.createDataFrame([(1, "a")], "k int, v string").write.json(f"{scratch}/fx.json")
    assert load_fixture(spark, f"{scratch}/fx.json", "k int, v string").collect()[0].v == "a"
    spark.createDataFrame([("1", "b")], "k string, v string").write.option("header", True).option("sep", "\t").csv(f"{scratch}/fx.tsv")
    assert load_fixture(spark, f"{scratch}/fx.tsv").collect()[0].v == "b"


def test_top_row_window_mixed_directions(spark):
    df = spark.createDataFrame([("s", 2000, 5.0), ("s", 2001, 5.0), ("s", 2002, 4.0)], "g string, y int, v double")
    out = top_row_per_group_window(df, ["g"], [F.col("v").desc(), F.col("y").asc()]).collect()
    assert [(r.g, r.y) for r in out] == [("s", 2000)]


def test_counted_broadcast_policy(spark):
    facts = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "one")], "k int, t string")
    out = star_join(facts, [Dim(dim, "k", "k", ("t",))], policy="counted")
    assert {(r.k, r.t) for r in out.collect()} == {(1, "one"), (2, None)}
    assert "BroadcastHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    big = prepare_side(spark.range(10), "counted", max_rows=5)
    assert "ResolvedHint" not in big._jdf.queryExecution().analyzed().toString()


def test_bucketed_tables_join_without_exchange(spark, scratch):
    from tidemark.sources.tables import bootstrap_namespace, write_bucketed

    (db,) = bootstrap_namespace(spark, "tm", "bucket", f"{scratch}/tables", layers=("silver",))
    li = spark.read.parquet("/root/testdata/sf0.001/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_quantity")
    od = spark.read.parquet("/root/testdata/sf0.001/orders.parquet").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_orderpriority"
    )
    a = write_bucketed(li, db, "lineitem_b", f"{scratch}/tables/silver/lineitem_b", ["l_orderkey"], 8)
    b = write_bucketed(od, db, "orders_b", f"{scratch}/tables/silver/orders_b", ["l_orderkey"], 8)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # force the shuffle-join path
    try:
        joined = a.join(b, "l_orderkey", "left")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Exchange" not in plan
        assert joined.count() == li.count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_bucketed_state_merge_shuffles_only_the_batch(spark, scratch):
    from tidemark.operators.cdc import scd1_merge_join
    from tidemark.sinks.tables import BucketedVersionedTable
    from tidemark.sources.tables import bootstrap_namespace

    (db,) = bootstrap_namespace(spark, "tm", "state", f"{scratch}/tables", layers=("silver",))
    t = BucketedVersionedTable(spark, f"{scratch}/tables/silver/s", db, "s", ["k"], 8)
    first = spark.createDataFrame([(i % 50, i, float(i)) for i in range(200)], "k int, seq int, v double")
    t.commit(scd1_merge_join(None, first, ["k"], ["seq"], ["v"]))
    batch = spark.createDataFrame([(1, 999, -1.0), (77, 5, 2.0)], "k int, seq int, v double")
    merged = scd1_merge_join(t.read(), batch, ["k"], ["seq"], ["v"])
    plan = merged._jdf.queryExecution().executedPlan().toString()
    lines = plan.splitlines()
    scan = next(i for i, ln in enumerate(lines) if "FileScan" in ln and "Bucketed: true" in ln)

    def depth(ln):
        return len(ln) - len(ln.lstrip(" :+-"))

    # Walk from the bucketed state scan up to the join: no Exchange on the way.
    path, level = [], depth(lines[scan])
    for ln in reversed(lines[:scan]):
        if depth(ln) < level:
            path.append(ln.strip(" :+-"))
            level = depth(ln)
            if ln.strip(" :+-").startswith("SortMergeJoin"):
                break
    assert path and path[-1].startswith("SortMergeJoin"), plan
    assert not any(p.startswith("Exchange") for p in path), path
    assert "Exchange" in plan  # the batch side is shuffled
    t.commit(merged)
    got = {r.k: r.v for r in t.read().collect()}
    assert got[1] == -1.0 and got[77] == 2.0 and len(got) == 51
