"""Silver-shaped star built from the driver's TPC-H style tables.

Mapping (so the gold analyses run unchanged on /root/testdata):

* series     = supplier (series_id = s_suppkey)
* period     = ship quarter ``Q01``..``Q04`` of lineitem; ``Q05`` = the year's
               average of the four quarter sums (an annual average like the source's)
* value      = exact DECIMAL sum of l_extendedprice per (series, year, quarter)
* labels     = supplier ⟕ nation ⟕ region: sector = region name, measure = nation
               name, duration = supplier name (only for suppliers with a positive
               balance, so some labels lose their "measure (duration)" part);
               class and seasonal texts have no source here and stay NULL
* population = orders per order year, covering 1996..2000 except 1998 (sparse)
"""

from __future__ import annotations

import weakref

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.joins import Dim, star_join
from tidemark.plans.gold import GoldInputs

POPULATION_YEARS = (1996, 2000)
POPULATION_GAP_YEAR = 1998


# Per session (weakly held, so a stopped session's frames go with it): path → DataFrame.
_TABLES: "weakref.WeakKeyDictionary[SparkSession, dict[str, DataFrame]]" = weakref.WeakKeyDictionary()


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The driver table as a DataFrame, resolved once per session (the files are immutable).

    Resolving a parquet path lists files and reads a footer; reusing the
    DataFrame reuses that work, as a catalog table would.
    """
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    tables = _TABLES.setdefault(spark, {})
    if path not in tables:
        tables[path] = spark.read.parquet(path)
    return tables[path]


def quarterly_facts(lineitem: DataFrame) -> DataFrame:
    """(series_id, year, period, value DECIMAL(20,2)); Q01..Q04 sums plus the Q05 average."""
    q4 = lineitem.groupBy(
        F.col("l_suppkey").alias("series_id"),
        F.year("l_shipdate").alias("year"),
        F.concat(F.lit("Q0"), F.quarter("l_shipdate").cast("string")).alias("period"),
    ).agg(F.sum(F.round(F.col("l_extendedprice") * 100).cast("long")).alias("cents"))
    # Exact: prices carry two decimals, summed as integer cents.
    q4 = q4.select("series_id", "year", "period", (F.col("cents").cast("decimal(38,0)") / 100).cast("decimal(20,2)").alias("value"))
    annual = q4.groupBy("series_id", "year").agg(
        F.round(F.avg(F.col("value").cast("double")), 0).cast("decimal(20,2)").alias("value")
    ).select("series_id", "year", F.lit("Q05").alias("period"), "value")
    return q4.unionByName(annual)


def supplier_labels(supplier: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    series = supplier.select(
        F.col("s_suppkey").alias("series_id"), "s_nationkey",
        F.when(F.col("s_acctbal") > 0, F.col("s_name")).alias("duration_text"),
    )
    labelled = star_join(
        series,
        [
            Dim(nation, "s_nationkey", "n_nationkey", ("n_name", "n_regionkey")),
            Dim(region, "n_regionkey", "r_regionkey", ("r_name",)),
        ],
    )
    return labelled.select(
        "series_id",
        F.col("r_name").alias("sector_name"),
        F.col("n_name").alias("measure_text"),
        F.lit(None).cast("string").alias("class_text"),
        "duration_text",
        F.lit(None).cast("string").alias("seasonal_text"),
    )


def orders_population(orders: DataFrame) -> DataFrame:
    lo, hi = POPULATION_YEARS
    yr = F.year("o_orderdate")
    return (
        orders.filter(yr.between(lo, hi) & (yr != POPULATION_GAP_YEAR))
        .groupBy(yr.alias("year"))
        .agg(F.count(F.lit(1)).alias("population"))
    )


def gold_inputs(spark: SparkSession, sf_dir: str) -> GoldInputs:
    return GoldInputs(
        facts=quarterly_facts(read(spark, sf_dir, "lineitem")),
        labels=supplier_labels(read(spark, sf_dir, "supplier"), read(spark, sf_dir, "nation"), read(spark, sf_dir, "region")),
        population=orders_population(read(spark, sf_dir, "orders")),
    )


# DuckDB text of the same star, shared by the oracle queries.
ORACLE_STAR_CTE = """
q4 AS (SELECT l_suppkey AS series_id, CAST(year(l_shipdate) AS INTEGER) AS year,
              'Q0' || CAST(quarter(l_shipdate) AS VARCHAR) AS period,
              CAST(sum(CAST(l_extendedprice AS DECIMAL(18,2))) AS DECIMAL(20,2)) AS value
       FROM lineitem GROUP BY 1, 2, 3),
facts AS (SELECT series_id, year, period, value FROM q4
          UNION ALL
          SELECT series_id, year, 'Q05', CAST(round(avg(CAST(value AS DOUBLE)), 0) AS DECIMAL(20,2)) FROM q4 GROUP BY 1, 2),
labels AS (SELECT s_suppkey AS series_id, r_name AS sector_name, n_name AS measure_text,
                  CAST(NULL AS VARCHAR) AS class_text,
                  CASE WHEN s_acctbal > 0 THEN s_name END AS duration_text,
                  CAST(NULL AS VARCHAR) AS seasonal_text
           FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
                         LEFT JOIN region ON n_regionkey = r_regionkey),
population AS (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS population FROM orders
               WHERE year(o_orderdate) BETWEEN 1996 AND 2000 AND year(o_orderdate) <> 1998 GROUP BY 1)
"""

# DuckDB label: || yields NULL when a part is NULL, like Spark's concat.
ORACLE_LABEL = (
    "concat_ws(', ', sector_name, measure_text || ' (' || duration_text || ')', class_text, seasonal_text)"
)
