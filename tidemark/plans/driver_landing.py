"""Land the driver tables as the product's raw snapshots (padded TSV and a JSON document).

Used by registered queries and tests to drive the real bronze → silver →
gold path over data that grows with the driver tables.

* ``pr.data.1.AllData``: the quarterly facts of :mod:`driver_star`, landed
  twice. The earlier snapshot holds stale values (value + 1); the later one
  restates every value and adds malformed rows (year 1899, period Q06,
  non-numeric year) that the silver rules must quarantine.
* ``pr.series`` from supplier ⟕ nation, ``pr.sector`` from region,
  ``pr.measure`` from nation, ``pr.duration`` from suppliers with a positive
  balance (so other series lose the "measure (duration)" label part).
* ``population``: one JSON document ``{"data": [...]}`` of orders per year.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import driver_star as star
from tidemark.plans.medallion import POPULATION_SOURCE, SERIES_SOURCE
from tidemark.sinks.tables import write_landing_snapshot, write_landing_text
from tidemark.streaming.bronze import Layout

STALE_STAMP = "20260101T000000Z"
CURRENT_STAMP = "20260909T163000Z"

# Header padding as the source publishes it: series_id right-padded to a
# fixed width, value left-padded.
SERIES_ID_HEADER = "series_id".ljust(17)
VALUE_HEADER = "value".rjust(12)


def _series_text(col: str = "series_id") -> F.Column:
    return F.rpad(F.col(col).cast("string"), 17, " ")


def pr_data_snapshot(facts: DataFrame, value_shift: float = 0.0) -> DataFrame:
    value = F.col("value") + F.lit(value_shift).cast("decimal(20,2)") if value_shift else F.col("value")
    return facts.select(
        _series_text().alias(SERIES_ID_HEADER),
        F.col("year").cast("string").alias("year"),
        F.col("period").alias("period"),
        F.lpad(value.cast("decimal(20,2)").cast("string"), 12, " ").alias(VALUE_HEADER),
        F.lit("").alias("footnote_codes"),
    )


def malformed_rows(supplier: DataFrame) -> DataFrame:
    """Three rows per series that fail a silver rule (implausible year, bad period, bad year)."""
    bad = F.explode(F.array(
        F.struct(F.lit("1899").alias("y"), F.lit("Q01").alias("p")),
        F.struct(F.lit("2001").alias("y"), F.lit("Q06").alias("p")),
        F.struct(F.lit("x").alias("y"), F.lit("Q02").alias("p")),
    )).alias("b")
    return supplier.select(F.col("s_suppkey").alias("series_id"), bad).select(
        _series_text().alias(SERIES_ID_HEADER),
        F.col("b.y").alias("year"),
        F.col("b.p").alias("period"),
        F.lpad(F.lit("1.0"), 12, " ").alias(VALUE_HEADER),
        F.lit("").alias("footnote_codes"),
    )


def land_series_product(spark: SparkSession, sf_dir: str, layout: Layout) -> None:
    li = star.read(spark, sf_dir, "lineitem")
    sup = star.read(spark, sf_dir, "supplier")
    nat = star.read(spark, sf_dir, "nation")
    reg = star.read(spark, sf_dir, "region")
    facts = star.quarterly_facts(li)
    base = layout.landing

    write_landing_snapshot(pr_data_snapshot(facts, 1.0), base, SERIES_SOURCE, "pr.data.1.AllData", STALE_STAMP)
    write_landing_snapshot(
        pr_data_snapshot(facts).unionByName(malformed_rows(sup)), base, SERIES_SOURCE, "pr.data.1.AllData", CURRENT_STAMP
    )

    series = sup.join(nat, sup["s_nationkey"] == nat["n_nationkey"], "left").select(
        _series_text("s_suppkey").alias(SERIES_ID_HEADER),
        F.lpad(F.col("n_regionkey").cast("string"), 2, "0").alias("sector_code"),
        F.lit("").alias("class_code"),
        F.lpad(F.col("s_nationkey").cast("string"), 2, "0").alias("measure_code"),
        F.col("s_suppkey").cast("string").alias("duration_code"),
        F.lit("S").alias("seasonal"),
        F.lit("-").alias("base_year"),
        F.lit("").alias("footnote_codes"),
        F.lit("1995").alias("begin_year"),
        F.lit("Q01").alias("begin_period"),
        F.lit("2001").alias("end_year"),
        F.lit("Q04").alias("end_period"),
    )
    write_landing_snapshot(series, base, SERIES_SOURCE, "pr.series", CURRENT_STAMP)

    sector = reg.select(
        F.lpad(F.col("r_regionkey").cast("string"), 2, "0").alias("sector_code"),
        F.col("r_name").alias("sector_name"),
        F.lit("0").alias("display_level"),
        F.lit("T").alias("selectable"),
        (F.col("r_regionkey") + 1).cast("string").alias("sort_sequence"),
    )
    write_landing_snapshot(sector, base, SERIES_SOURCE, "pr.sector", CURRENT_STAMP)

    measure = nat.select(
        F.lpad(F.col("n_nationkey").cast("string"), 2, "0").alias("measure_code"),
        F.col("n_name").alias("measure_text"),
        F.lit("1").alias("display_level"),
        F.lit("F").alias("selectable"),
        (F.col("n_nationkey") + 1).cast("string").alias("sort_sequence"),
    )
    write_landing_snapshot(measure, base, SERIES_SOURCE, "pr.measure", CURRENT_STAMP)

    duration = sup.filter(F.col("s_acctbal") > 0).select(
        F.col("s_suppkey").cast("string").alias("duration_code"),
        F.col("s_name").alias("duration_text"),
        F.lit("2").alias("display_level"),
        F.lit("X").alias("selectable"),
        F.col("s_suppkey").cast("string").alias("sort_sequence"),
    )
    write_landing_snapshot(duration, base, SERIES_SOURCE, "pr.duration", CURRENT_STAMP)

    land_population(spark, sf_dir, layout, CURRENT_STAMP)


def population_document(orders: DataFrame) -> DataFrame:
    """One JSON document (a single row) of orders per year; years are few, so it is small."""
    pop = star.orders_population(orders)
    item = F.struct(
        F.lit("01000US").alias("Nation ID"),
        F.lit("United States").alias("Nation"),
        F.col("year").alias("Year"),
        F.col("population").alias("Population"),
    )
    return pop.agg(F.to_json(F.struct(F.sort_array(F.collect_list(item)).alias("data"))).alias("value"))


def land_population(spark: SparkSession, sf_dir: str, layout: Layout, stamp: str) -> str:
    doc = population_document(star.read(spark, sf_dir, "orders"))
    return write_landing_text(doc, layout.landing, POPULATION_SOURCE, "population", stamp, "population.json")
