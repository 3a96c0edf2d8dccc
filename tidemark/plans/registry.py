"""Registered queries (Spark) and their DuckDB oracle SQL, keyed alike.

Each query takes (spark, sf_dir) and returns a DataFrame over the whole
driver tables. Column names match the oracle's aliases exactly.
"""

from __future__ import annotations

import weakref

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans import driver_star as star
from tidemark.plans import gold
from tidemark.session import apply_defaults

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn: Callable[[SparkSession, str], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            apply_defaults(spark)
            return fn(spark, sf_dir)

        run.__name__ = name
        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if oracle is not None:
            ORACLES[name] = oracle.strip()
        return fn

    return deco


def _with(cte: str, body: str) -> str:
    return f"WITH {cte.strip()}\n{body}"


# ====================================================================== gold analyses

@register(
    "agg_value_per_year",
    _with(star.ORACLE_STAR_CTE, f"""
, yearly AS (SELECT series_id, year, CAST(round(sum(value), 1) AS DOUBLE) AS summed_value
             FROM facts WHERE period <> 'Q05' GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY summed_value DESC, year ASC) = 1 AS is_best_year
           FROM yearly)
SELECT r.series_id, l.sector_name, l.measure_text, l.class_text, l.duration_text, l.seasonal_text,
       {star.ORACLE_LABEL} AS label, r.year, r.summed_value, r.is_best_year, p.population
FROM ranked r LEFT JOIN labels l ON r.series_id = l.series_id LEFT JOIN population p ON r.year = p.year
"""),
)
def q_agg_value_per_year(spark, sf_dir):
    """G2 flagship: SQL twin (primary) over the driver star."""
    return gold.agg_value_per_year_sql(spark, star.gold_inputs(spark, sf_dir))


def _q(spark, sf_dir, name):
    return star.read(spark, sf_dir, name)


@register(
    "value_per_quarter",
    _with(star.ORACLE_STAR_CTE, f"""
, ranked AS (SELECT series_id, year, period, CAST(value AS DOUBLE) AS value,
                    row_number() OVER (PARTITION BY series_id, period ORDER BY CAST(value AS DOUBLE) DESC, year ASC) = 1
                        AS best_year_per_quarter
             FROM facts WHERE period <> 'Q05')
SELECT r.series_id, l.sector_name, l.measure_text, l.class_text, l.duration_text, l.seasonal_text,
       {star.ORACLE_LABEL} AS label, r.year, r.period, r.value, r.best_year_per_quarter, p.population
FROM ranked r LEFT JOIN labels l ON r.series_id = l.series_id LEFT JOIN population p ON r.year = p.year
"""),
)
def q_value_per_quarter(spark, sf_dir):
    """Per (series, year, quarter) value with best year per slot (SQL twin)."""
    return gold.value_per_quarter_sql(spark, star.gold_inputs(spark, sf_dir))


@register(
    "population_stats",
    _with(star.ORACLE_STAR_CTE, """
SELECT count(year) AS year_count, round(avg(population), 6) AS population_mean,
       round(stddev_samp(population), 6) AS population_stddev_samp,
       round(stddev_pop(population), 6) AS population_stddev_pop
FROM population WHERE year BETWEEN 1996 AND 2000
"""),
)
def q_population_stats(spark, sf_dir):
    """G1: summary statistics of the sparse population over an inclusive window."""
    pop = star.orders_population(_q(spark, sf_dir, "orders"))
    out = gold.population_stats_df(pop, 1996, 2000)
    return out.select("year_count", *[F.round(c, 6).alias(c) for c in out.columns if c != "year_count"])


@register(
    "best_year_report",
    _with(star.ORACLE_STAR_CTE, f"""
, yearly AS (SELECT series_id, year, CAST(round(sum(value), 1) AS DOUBLE) AS summed_value
             FROM facts WHERE period <> 'Q05' GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY summed_value DESC, year ASC) AS rn FROM yearly)
SELECT r.series_id, l.sector_name, l.measure_text, l.class_text, l.duration_text, l.seasonal_text,
       {star.ORACLE_LABEL} AS label, r.year, r.summed_value, true AS is_best_year, p.population
FROM ranked r LEFT JOIN labels l ON r.series_id = l.series_id LEFT JOIN population p ON r.year = p.year
WHERE rn = 1
"""),
)
def q_best_year_report(spark, sf_dir):
    """One row per series, its best year."""
    return gold.best_year_report(star.gold_inputs(spark, sf_dir))


@register(
    "series_vs_population",
    _with(star.ORACLE_STAR_CTE, f"""
SELECT f.series_id, {star.ORACLE_LABEL} AS label, f.year, f.period, CAST(f.value AS DOUBLE) AS value, p.population
FROM facts f LEFT JOIN labels l ON f.series_id = l.series_id LEFT JOIN population p ON f.year = p.year
WHERE f.period = 'Q01'
"""),
)
def q_series_vs_population(spark, sf_dir):
    """Every series' first-quarter values next to that year's population."""
    return gold.series_vs_population(star.gold_inputs(spark, sf_dir), "Q01")


@register(
    "twin_parity",
    _with(star.ORACLE_STAR_CTE, """
SELECT 'agg_value_per_year' AS analysis, (SELECT count(*) FROM (SELECT DISTINCT series_id, year FROM facts WHERE period <> 'Q05')) AS n_rows,
       CAST(0 AS BIGINT) AS sql_only, CAST(0 AS BIGINT) AS df_only
UNION ALL
SELECT 'population_stats', 1, 0, 0
UNION ALL
SELECT 'value_per_quarter', (SELECT count(*) FROM facts WHERE period <> 'Q05'), 0, 0
"""),
)
def q_twin_parity(spark, sf_dir):
    """SQL and DataFrame twins agree (rows only in one of them, both directions)."""
    inp = star.gold_inputs(spark, sf_dir)
    pop = star.orders_population(_q(spark, sf_dir, "orders"))
    pairs = {
        "agg_value_per_year": (gold.agg_value_per_year_sql(spark, inp), gold.agg_value_per_year_df(inp)),
        "value_per_quarter": (gold.value_per_quarter_sql(spark, inp), gold.value_per_quarter_df(inp)),
        "population_stats": (gold.population_stats_sql(spark, pop, 1996, 2000), gold.population_stats_df(pop, 1996, 2000)),
    }
    parts = []
    for name, (s, d) in pairs.items():
        if s.schema.simpleString() != d.schema.simpleString():
            raise ValueError(f"{name}: twin schemas differ")
        tagged = (
            s.select(F.lit(1).alias("n_rows"), F.lit(0).alias("sql_only"), F.lit(0).alias("df_only"))
            .unionByName(s.exceptAll(d).select(F.lit(0).alias("n_rows"), F.lit(1).alias("sql_only"), F.lit(0).alias("df_only")))
            .unionByName(d.exceptAll(s).select(F.lit(0).alias("n_rows"), F.lit(0).alias("sql_only"), F.lit(1).alias("df_only")))
        )
        parts.append(
            tagged.agg(*[F.sum(c).cast("long").alias(c) for c in ("n_rows", "sql_only", "df_only")])
            .select(F.lit(name).alias("analysis"), "n_rows", "sql_only", "df_only")
        )
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


# ====================================================================== aggregation / window / filters

@register(
    "grouped_rounded_sum",
    """
SELECT l_suppkey AS series_id, CAST(year(l_shipdate) AS INTEGER) AS year,
       round(CAST(sum(CAST(round(l_extendedprice * 100) AS HUGEINT)) AS DOUBLE) / 100, 1) AS summed_value
FROM lineitem GROUP BY 1, 2
""",
)
def q_grouped_rounded_sum(spark, sf_dir):
    """A1: exact sum of doubles rounded to one digit per (series, year)."""
    from tidemark.operators.exact_sums import exact_sums

    li = _q(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("series_id"), F.year("l_shipdate").alias("year"), "l_extendedprice")
    return exact_sums(li, ["series_id", "year"], "l_extendedprice", "summed_value", 1)


@register(
    "exact_double_sums",
    """
SELECT l_returnflag, l_linestatus, count(*) AS n, round(CAST(sum(CAST(l_extendedprice * CASE l_linenumber % 3 WHEN 0 THEN 1024 WHEN 1 THEN 1 ELSE -1.0 / 1048576 END
       * pow(2, 66) AS HUGEINT)) AS DOUBLE) / pow(2, 66), 2) AS total
FROM lineitem GROUP BY 1, 2
""",
)
def q_exact_double_sums(spark, sf_dir):
    """A1: exact sums of doubles whose magnitudes differ by 2**30; the oracle adds them as 128-bit integers."""
    from tidemark.operators.exact_sums import exact_sums

    keys = ["l_returnflag", "l_linestatus"]
    factor = F.when(F.col("l_linenumber") % 3 == 0, 1024.0).when(F.col("l_linenumber") % 3 == 1, 1.0).otherwise(-1.0 / 1048576)
    li = _q(spark, sf_dir, "lineitem").select(*keys, (F.col("l_extendedprice") * factor).alias("v"))
    return li.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).join(exact_sums(li, keys, "v", "total", 2), keys)


@register(
    "exclude_annual_period",
    _with(star.ORACLE_STAR_CTE, """
SELECT series_id, year, period, CAST(value AS DOUBLE) AS value FROM facts WHERE period <> 'Q05'
"""),
)
def q_exclude_annual_period(spark, sf_dir):
    """The annual-average period is excluded (NULL periods drop too)."""
    facts = star.quarterly_facts(_q(spark, sf_dir, "lineitem"))
    return facts.filter(F.col("period") != gold.ANNUAL_PERIOD).withColumn("value", F.col("value").cast("double"))


@register(
    "best_year_flag",
    _with(star.ORACLE_STAR_CTE, """
, yearly AS (SELECT series_id, year, CAST(round(sum(value), 1) AS DOUBLE) AS summed_value
             FROM facts WHERE period <> 'Q05' GROUP BY 1, 2)
SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY summed_value DESC, year ASC) = 1 AS is_best_year FROM yearly
"""),
)
def q_best_year_flag(spark, sf_dir):
    """All rows kept, exactly one flagged per series; ties → earliest year."""
    from tidemark.operators.exact_sums import exact_sums
    from tidemark.operators.ranking import flag_best

    facts = star.quarterly_facts(_q(spark, sf_dir, "lineitem"))
    yearly = exact_sums(facts.filter(F.col("period") != "Q05"), ["series_id", "year"], "value", "summed_value", 1)
    return flag_best(yearly, ["series_id"], [F.col("summed_value").desc(), F.col("year").asc()], "is_best_year")


@register(
    "latest_per_group",
    """
SELECT event_type, user_id, event_id, ts FROM (
  SELECT *, row_number() OVER (PARTITION BY event_type, user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type <> 'error') t WHERE rn = 1
""",
)
def q_latest_per_group(spark, sf_dir):
    """Newest row per (type, user) among non-error events."""
    from tidemark.operators.ranking import top_row_per_group

    ev = _q(spark, sf_dir, "events").filter(F.col("event_type") != "error")
    return top_row_per_group(ev, ["event_type", "user_id"], ["ts", "event_id"], ["event_id", "ts"])


@register(
    "run_summary",
    """
SELECT user_id, bool_or(event_type = 'error') AS had_error, count(*) AS n,
       count(*) FILTER (WHERE event_type = 'view') AS n_view
FROM events GROUP BY user_id
""",
)
def q_run_summary(spark, sf_dir):
    """A3: per run (user): any error, items, items of one status."""
    from tidemark.operators.aggregates import run_summary

    return run_summary(_q(spark, sf_dir, "events"), "user_id", "event_type", "error", ("view",))


@register(
    "freshness_check",
    """
SELECT event_type, max(ts) AS latest_ts, max(ts) < TIMESTAMP '2024-01-30 22:00:00' AS is_stale
FROM events GROUP BY event_type
""",
)
def q_freshness_check(spark, sf_dir):
    """Latest arrival per dataset against a cutoff."""
    from tidemark.operators.aggregates import freshness

    return freshness(_q(spark, sf_dir, "events"), "event_type", "ts", "2024-01-30 22:00:00")


# ====================================================================== quality gates

# Rule texts are valid in both Spark SQL and DuckDB, so the oracles reuse them.
ORDER_RULES = {
    "has_price": "o_totalprice IS NOT NULL",
    "plausible_year": "year(o_orderdate) BETWEEN 1996 AND 2000",
    "valid_status": "o_orderstatus IN ('F', 'O')",
}


@register(
    "expectation_metrics",
    """
SELECT count(*) AS rows,
       count(*) FILTER (WHERE NOT coalesce(regexp_matches(o_orderpriority, '^[1-3]-'), false)) AS valid_priority,
       count(*) FILTER (WHERE NOT coalesce(o_totalprice IS NOT NULL, false)) AS has_price
FROM orders
""",
)
def q_expectation_metrics(spark, sf_dir):
    """Warn-only rules; rows kept, failures counted per rule (one global aggregate)."""
    from tidemark.operators.quality import Rule, rule_metrics

    rules = [Rule("valid_priority", "o_orderpriority RLIKE '^[1-3]-'"), Rule("has_price", "o_totalprice IS NOT NULL")]
    return rule_metrics(_q(spark, sf_dir, "orders"), rules)


@register(
    "expect_or_drop",
    """
SELECT c_custkey, c_name, c_acctbal FROM customer WHERE coalesce(c_acctbal >= 0, false)
""",
)
def q_expect_or_drop(spark, sf_dir):
    """One rule; failing rows removed."""
    from tidemark.operators.quality import Rule, expect_or_drop

    cust = _q(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    return expect_or_drop(cust, [Rule("non_negative_balance", "c_acctbal >= 0")])


@register(
    "expect_all_or_drop",
    "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate FROM orders WHERE "
    + " AND ".join(f"coalesce({p}, false)" for p in ORDER_RULES.values()),
)
def q_expect_all_or_drop(spark, sf_dir):
    """A row is kept only when every rule is TRUE."""
    from tidemark.operators.quality import expect_or_drop, rules_from

    o = _q(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
    return expect_or_drop(o, rules_from(ORDER_RULES))


@register(
    "quarantine_by_rule",
    "SELECT rule, n FROM (\n"
    + "\nUNION ALL\n".join(
        f"SELECT '{k}' AS rule, count(*) AS n FROM orders WHERE NOT coalesce({p}, false)" for k, p in ORDER_RULES.items()
    )
    + "\n) t WHERE n > 0",
)
def q_quarantine_by_rule(spark, sf_dir):
    """D3: failures per rule name (rules with no failure are omitted)."""
    from tidemark.operators.quality import rules_from, violations_by_rule

    return violations_by_rule(_q(spark, sf_dir, "orders"), rules_from(ORDER_RULES))


@register(
    "quarantined_rows",
    "SELECT o_orderkey, "
    + "list_filter(["
    + ", ".join(f"CASE WHEN NOT coalesce({p}, false) THEN '{k}' END" for k, p in ORDER_RULES.items())
    + "], lambda x: x IS NOT NULL) AS _failed_rules FROM orders WHERE NOT ("
    + " AND ".join(f"coalesce({p}, false)" for p in ORDER_RULES.values())
    + ")",
)
def q_quarantined_rows(spark, sf_dir):
    """D3: rejected rows kept aside with the names of the rules they failed."""
    from tidemark.operators.quality import quarantine, rules_from

    _, rejected = quarantine(_q(spark, sf_dir, "orders"), rules_from(ORDER_RULES))
    return rejected.select("o_orderkey", "_failed_rules")


# ====================================================================== joins

@register(
    "star_label_join",
    """
SELECT l_orderkey, l_linenumber, l_suppkey,
       concat_ws(', ', s_name, p_brand || ' (' || p_type || ')', o_orderpriority) AS label
FROM lineitem
LEFT JOIN supplier ON l_suppkey = s_suppkey AND s_acctbal > 0
LEFT JOIN part ON l_partkey = p_partkey AND p_size > 10
LEFT JOIN orders ON l_orderkey = o_orderkey
""",
)
def q_star_label_join(spark, sf_dir):
    """Fact ⟕ several dimensions; each broadcast only when proven small."""
    from tidemark.operators.joins import Dim, star_join

    li = _q(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_suppkey", "l_partkey")
    out = star_join(
        li,
        [
            Dim(_q(spark, sf_dir, "supplier"), "l_suppkey", "s_suppkey", ("s_name",), F.col("s_acctbal") > 0),
            Dim(_q(spark, sf_dir, "part"), "l_partkey", "p_partkey", ("p_brand", "p_type"), F.col("p_size") > 10),
            Dim(_q(spark, sf_dir, "orders"), "l_orderkey", "o_orderkey", ("o_orderpriority",)),
        ],
    )
    label = F.concat_ws(", ", "s_name", F.concat("p_brand", F.lit(" ("), "p_type", F.lit(")")), "o_orderpriority")
    return out.select("l_orderkey", "l_linenumber", "l_suppkey", label.alias("label"))


@register(
    "join_renamed_key",
    """
SELECT s_suppkey, s_name, n_name FROM supplier LEFT JOIN nation ON s_nationkey = n_nationkey
""",
)
def q_join_renamed_key(spark, sf_dir):
    """Join on differently named keys (series.seasonal = seasonal.seasonal_code style)."""
    from tidemark.operators.joins import Dim, star_join

    sup = _q(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    return star_join(sup, [Dim(_q(spark, sf_dir, "nation"), "s_nationkey", "n_nationkey", ("n_name",))]).select(
        "s_suppkey", "s_name", "n_name"
    )


@register(
    "sparse_dim_join",
    _with(star.ORACLE_STAR_CTE, """
SELECT f.series_id, f.year, f.period, CAST(f.value AS DOUBLE) AS value, p.population
FROM facts f LEFT JOIN population p ON f.year = p.year
"""),
)
def q_sparse_dim_join(spark, sf_dir):
    """Facts ⟕ a dimension covering a few years; misses stay NULL, key asserted unique."""
    from tidemark.operators.joins import sparse_dim_join

    facts = star.quarterly_facts(_q(spark, sf_dir, "lineitem")).withColumn("value", F.col("value").cast("double"))
    pop = star.orders_population(_q(spark, sf_dir, "orders"))
    return sparse_dim_join(facts, pop, ["year"]).select("series_id", "year", "period", "value", "population")


# Change detection between two snapshots of the documents table, both whole:
# previous = documents as stored; current = a revision in which exact copies
# are collapsed to their first doc_id (the rest REMOVED), runs of spaces/tabs
# are collapsed to one space (CHANGED where that alters the text), and the
# benchmark items are published as new items (ADDED).
WS_RUN = "[ \t]+"


def documents_revision(spark, sf_dir):
    from tidemark.operators.changes import collapse_duplicates

    docs = _q(spark, sf_dir, "documents").select("doc_id", "text")
    kept = collapse_duplicates(docs, "doc_id", "text").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("item"),
        F.regexp_replace("text", WS_RUN, " ").alias("text"),
    )
    added = _q(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("bench-"), F.col("item_id").cast("string")).alias("item"), "text"
    )
    return kept.unionByName(added)


ORACLE_DOC_SNAPSHOTS = """
prev AS (SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS item, sha256(text) AS fp FROM documents),
cur AS (SELECT 'doc-' || CAST(min(doc_id) AS VARCHAR) AS item,
               sha256(regexp_replace(text, '[ \t]+', ' ', 'g')) AS fp FROM documents GROUP BY text
        UNION ALL
        SELECT 'bench-' || CAST(item_id AS VARCHAR), sha256(text) FROM benchmark)
"""


@register(
    "change_detection",
    _with(ORACLE_DOC_SNAPSHOTS, """
SELECT coalesce(cur.item, prev.item) AS item,
       CASE WHEN prev.item IS NULL THEN 'ADDED' WHEN cur.item IS NULL THEN 'REMOVED'
            WHEN cur.fp = prev.fp THEN 'UNCHANGED' ELSE 'CHANGED' END AS status,
       prev.fp AS previous_fingerprint, cur.fp AS current_fingerprint
FROM cur FULL OUTER JOIN prev ON cur.item = prev.item
"""),
)
def q_change_detection(spark, sf_dir):
    """ADDED / CHANGED / UNCHANGED / REMOVED between two whole snapshots.

    Only fingerprints are shuffled: every text is hashed inside its scan
    task (raw and whitespace-normalised), the copy collapse groups 64-byte
    hashes, and the full outer join pairs items by key.
    """
    from tidemark.operators.changes import classify_changes

    docs = _q(spark, sf_dir, "documents")
    item = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    prev = docs.select(item.alias("item"), F.sha2("text", 256).alias("fp"))
    kept = (
        docs.select(
            "doc_id",
            F.sha2("text", 256).alias("raw_fp"),
            F.sha2(F.regexp_replace("text", WS_RUN, " "), 256).alias("fp"),
        )
        .groupBy("raw_fp")
        .agg(F.min("doc_id").alias("doc_id"), F.min("fp").alias("fp"))
        .select(F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("item"), "fp")
    )
    added = _q(spark, sf_dir, "benchmark").select(
        F.concat(F.lit("bench-"), F.col("item_id").cast("string")).alias("item"), F.sha2("text", 256).alias("fp")
    )
    return classify_changes(kept.unionByName(added), prev, "item", "fp")


@register(
    "duplicate_content",
    """
SELECT sha256(text) AS content_sha256, min(doc_id) AS first_doc_id, count(*) AS copies
FROM documents GROUP BY 1 HAVING count(*) > 1
""",
)
def q_duplicate_content(spark, sf_dir):
    """Identical content landed more than once (whole-text hash)."""
    from tidemark.operators.changes import duplicate_content

    return duplicate_content(_q(spark, sf_dir, "documents"), "doc_id", "text")


@register(
    "content_hash",
    "SELECT doc_id, sha256(text) AS content_sha256, octet_length(encode(text)) AS bytes FROM documents",
)
def q_content_hash(spark, sf_dir):
    """R2: fingerprint (sha-256, UTF-8 byte count) of every whole document."""
    from tidemark.functions.text import content_fingerprint

    sha, n = content_fingerprint("text")
    return _q(spark, sf_dir, "documents").select("doc_id", sha.alias("content_sha256"), n.cast("long").alias("bytes"))


# ====================================================================== SCD1

@register(
    "scd1_latest",
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
         ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC) AS rn
  FROM lineitem) t WHERE rn = 1
""",
)
def q_scd1_latest(spark, sf_dir):
    """Latest version per composite key; sequence column not published."""
    from tidemark.operators.cdc import latest_per_key

    li = _q(spark, sf_dir, "lineitem")
    return latest_per_key(
        li, ["l_orderkey", "l_linenumber"], ["l_shipdate"], ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice"]
    )


# ====================================================================== projections and scalar functions

@register(
    "sentinel_to_null",
    """
SELECT l_orderkey, l_linenumber,
       CASE WHEN trim(x) IN ('-', '') THEN NULL ELSE try_cast(trim(x) AS DOUBLE) END AS v
FROM (SELECT l_orderkey, l_linenumber,
             CASE WHEN l_linenumber = 1 THEN ' - ' WHEN l_linenumber = 2 THEN '  '
                  ELSE lpad(CAST(l_quantity AS VARCHAR), 12, ' ') END AS x FROM lineitem) t
""",
)
def q_sentinel_to_null(spark, sf_dir):
    """P4: '-' and blank become NULL (never 0); padded numbers parse."""
    from tidemark.functions.cleaning import sentinel_to_null

    li = _q(spark, sf_dir, "lineitem")
    raw = F.when(F.col("l_linenumber") == 1, " - ").when(F.col("l_linenumber") == 2, "  ").otherwise(
        F.lpad(F.col("l_quantity").cast("string"), 12, " ")
    )
    return li.select("l_orderkey", "l_linenumber", sentinel_to_null(raw, "double").alias("v"))


@register(
    "flag_decode",
    """
SELECT l_orderkey, l_linenumber, l_linestatus,
       CASE WHEN trim(l_linestatus) = 'T' THEN true WHEN trim(l_linestatus) = 'F' THEN false END AS flag
FROM lineitem
""",
)
def q_flag_decode(spark, sf_dir):
    """P5: T → true, F → false, anything else → NULL."""
    from tidemark.functions.cleaning import decode_flag

    li = _q(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", "l_linestatus", decode_flag("l_linestatus").alias("flag"))


def _customer_as_raw_text(spark, sf_dir):
    """customer with every value as padded text under padded, capitalised headers."""
    c = _q(spark, sf_dir, "customer")
    return c.select(
        F.lpad(F.col("c_custkey").cast("string"), 12, " ").alias("c_custkey        "),
        F.concat(F.col("c_name"), F.lit("  ")).alias("  C_Name"),
        F.col("c_nationkey").cast("string").alias("c_nationkey"),
        F.lpad(F.col("c_acctbal").cast("string"), 14, " ").alias("       c_acctbal"),
        F.col("c_mktsegment").alias("c_mktsegment "),
    )


def _customer_spec():
    from tidemark.functions.cleaning import ColumnSpec, TableSpec

    return TableSpec(
        "customer",
        (
            ColumnSpec("c_custkey", "bigint"),
            ColumnSpec("c_name", "string"),
            ColumnSpec("c_nationkey", "int"),
            ColumnSpec("c_acctbal", "double", "sentinel"),
            ColumnSpec("c_mktsegment", "string"),
        ),
        keys=("c_custkey",),
    )


@register("typed_projection", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_typed_projection(spark, sf_dir):
    """Padded text → typed columns by a spec (headers resolved by stripped, folded name)."""
    from tidemark.functions.cleaning import project_spec

    return project_spec(_customer_as_raw_text(spark, sf_dir), _customer_spec())


@register("strip_headers", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_strip_headers(spark, sf_dir):
    """Whitespace-padded header names stripped in one projection."""
    from tidemark.functions.cleaning import strip_column_names

    c = _q(spark, sf_dir, "customer")
    padded = c.toDF(*[f"  {n}     " if i % 2 else f"{n}        " for i, n in enumerate(c.columns)])
    return strip_column_names(padded)


@register(
    "trim_columns",
    "SELECT c_custkey, trim('  ' || c_name || '   ') AS c_name, trim(' ' || c_mktsegment) AS c_mktsegment FROM customer",
)
def q_trim_columns(spark, sf_dir):
    """Spaces trimmed from every string column."""
    from tidemark.functions.cleaning import trim_strings

    c = _q(spark, sf_dir, "customer").select(
        "c_custkey",
        F.concat(F.lit("  "), "c_name", F.lit("   ")).alias("c_name"),
        F.concat(F.lit(" "), "c_mktsegment").alias("c_mktsegment"),
    )
    return trim_strings(c)


@register(
    "code_preservation",
    "SELECT c_custkey, lpad(CAST(c_nationkey AS VARCHAR), 3, '0') AS nation_code FROM customer",
)
def q_code_preservation(spark, sf_dir):
    """Identifier codes stay text, leading zeros kept."""
    from tidemark.functions.cleaning import typed

    c = _q(spark, sf_dir, "customer").select("c_custkey", F.lpad(F.col("c_nationkey").cast("string"), 3, "0").alias("raw"))
    return c.select("c_custkey", typed("raw", "string").alias("nation_code"))


@register(
    "variant_extract",
    "SELECT event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def q_variant_extract(spark, sf_dir):
    """Typed field of a VARIANT (NULL when absent or not castable)."""
    from tidemark.functions.variant import variant_field

    ev = _q(spark, sf_dir, "events")
    return ev.select("event_id", variant_field(F.parse_json("props"), "k", "int").alias("k"))


@register(
    "variant_explode",
    "SELECT user_id, event_id, CAST(json_extract(props, '$.k') AS INTEGER) AS k FROM events",
)
def q_variant_explode(spark, sf_dir):
    """JSON documents {"data": [...]} exploded to one row per element.

    Events are packed into documents of at most 64 elements (per user and
    event-id block), then parsed as VARIANT and exploded; the key with a
    space is read with the bracket path.
    """
    from tidemark.functions.variant import variant_array, variant_field

    ev = _q(spark, sf_dir, "events")
    item = F.to_json(F.struct(F.col("event_id").alias("Event ID"), F.get_json_object("props", "$.k").cast("int").alias("k")))
    docs = ev.groupBy("user_id", F.floor(F.col("event_id") / 64).alias("block")).agg(
        F.concat(F.lit('{"data":['), F.array_join(F.collect_list(item), ","), F.lit("]}")).alias("doc")
    )
    items = docs.select("user_id", F.explode(variant_array(F.parse_json("doc"), "$.data")).alias("item"))
    return items.select(
        "user_id", variant_field("item", "Event ID", "bigint").alias("event_id"), variant_field("item", "k", "int").alias("k")
    )


@register(
    "surrogate_key",
    "SELECT c_custkey, sha256(concat_ws('‖', coalesce(CAST(c_custkey AS VARCHAR), ''), coalesce(c_name, ''))) AS sk FROM customer",
)
def q_surrogate_key(spark, sf_dir):
    """Deterministic SHA-256 key of the business key columns."""
    from tidemark.functions.keys import surrogate_key

    return _q(spark, sf_dir, "customer").select("c_custkey", surrogate_key("c_custkey", "c_name").alias("sk"))


@register("audit_columns", "SELECT s_suppkey, 'supplier' AS _source, true AS has_ts FROM supplier")
def q_audit_columns(spark, sf_dir):
    """Audit stamp (_insert_update_ts, _source)."""
    from tidemark.functions.keys import with_audit_columns

    s = with_audit_columns(_q(spark, sf_dir, "supplier").select("s_suppkey"), "supplier")
    return s.select("s_suppkey", "_source", F.col("_insert_update_ts").isNotNull().alias("has_ts"))


RUN_STAMP = "20260909T163000Z"


@register(
    "landing_path",
    f"""
SELECT doc_id, '/landing/' || source || '/doc-' || CAST(doc_id AS VARCHAR) || '/doc-' || CAST(doc_id AS VARCHAR)
       || '.txt__{RUN_STAMP}' AS landing_path
FROM documents
""",
)
def q_landing_path(spark, sf_dir):
    """K6: immutable per-run landing path <base>/<source>/<dataset>/<file>__<stamp>."""
    from tidemark.functions.text import landing_path

    d = _q(spark, sf_dir, "documents")
    ds = F.concat(F.lit("doc-"), F.col("doc_id").cast("string"))
    return d.select(
        "doc_id", landing_path("/landing", "source", ds, F.concat(ds, F.lit(".txt")), F.lit(RUN_STAMP)).alias("landing_path")
    )


@register("ingest_ts_format", "SELECT event_id, strftime(ts, '%Y%m%dT%H%M%SZ') AS ingest_ts FROM events")
def q_ingest_ts_format(spark, sf_dir):
    """Run stamp format of a UTC timestamp."""
    from tidemark.functions.text import ingest_ts

    return _q(spark, sf_dir, "events").select("event_id", ingest_ts("ts").alias("ingest_ts"))


@register(
    "table_name_from_dataset",
    "SELECT DISTINCT 'pr.' || p_type AS dataset, replace(lower('pr.' || p_type), '.', '_') AS table_name FROM part",
)
def q_table_name_from_dataset(spark, sf_dir):
    """S2 naming: dataset name → identifier (lower case, dots → underscores)."""
    from tidemark.functions.text import table_name_from_dataset

    ds = _q(spark, sf_dir, "part").select(F.concat(F.lit("pr."), "p_type").alias("dataset")).distinct()
    return ds.select("dataset", table_name_from_dataset("dataset").alias("table_name"))


@register(
    "listing_links",
    """
SELECT page_id, file_name FROM (
  SELECT page_id, h, list_extract(string_split(h, '/'), -1) AS file_name
  FROM (SELECT page_id, unnest(regexp_extract_all(html, '<[aA] [^>]*?[hH][rR][eE][fF]="([^"]*)"', 1)) AS h FROM pages) x
) y WHERE h <> '' AND NOT starts_with(h, '?') AND NOT ends_with(h, '/')
""",
)
def q_listing_links(spark, sf_dir):
    """File links of listing pages (no sort links, no directories), basename only."""
    from tidemark.functions.text import listing_links

    return listing_links(_q(spark, sf_dir, "pages"), "html", keep=("page_id",))


# ====================================================================== scans

@register("table_scan_project", "SELECT s_suppkey, s_name FROM supplier")
def q_table_scan_project(spark, sf_dir):
    """Batch scan with projection (ReadSchema pruned to two columns)."""
    _q(spark, sf_dir, "supplier").createOrReplaceTempView("tidemark_supplier")
    return spark.table("tidemark_supplier").select("s_suppkey", "s_name")


@register(
    "param_scan",
    "SELECT event_id, user_id, value FROM events WHERE event_type = 'purchase' AND value >= 10.0",
)
def q_param_scan(spark, sf_dir):
    """Parameterised SQL — values bound, never interpolated."""
    return spark.sql(
        "SELECT event_id, user_id, value FROM {events} WHERE event_type = :event_type AND value >= :min_value",
        args={"event_type": "purchase", "min_value": 10.0},
        events=_q(spark, sf_dir, "events"),
    )


# ====================================================================== ingest, streams and sinks
# These queries write landing files and tables below the session's shared
# checkpoint folder (``spark.checkpoint.dir``), each in a fresh directory.

def _layout(spark, name):
    from tidemark.session import scratch_path
    from tidemark.streaming.bronze import Layout

    root = scratch_path(spark, name)
    return Layout(landing=f"{root}/landing", tables=f"{root}/tables", checkpoints=f"{root}/_checkpoints", source="drv")


CUSTOMER_PADDED = {
    "c_custkey": "c_custkey        ",
    "c_name": "  c_name",
    "c_nationkey": "c_nationkey",
    "c_acctbal": "     c_acctbal",
    "c_mktsegment": "c_mktsegment ",
}


def _customer_text(spark, sf_dir, cols=("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")):
    c = _q(spark, sf_dir, "customer").withColumn("c_acctbal", F.col("c_acctbal").cast("decimal(12,2)"))
    return c.select(*[F.col(n).cast("string").alias(CUSTOMER_PADDED[n]) for n in cols])


def _bronze_stripped(table):
    from tidemark.functions.cleaning import strip_column_names

    return strip_column_names(table.read())


CUSTOMER_AS_TEXT = """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(c_nationkey AS VARCHAR) AS c_nationkey,
       CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal, c_mktsegment
FROM customer
"""


@register("ingest_delimited", CUSTOMER_AS_TEXT)
def q_ingest_delimited(spark, sf_dir):
    """Incremental TSV ingest (header row, everything STRING) via a triggered stream."""
    from tidemark.sinks.tables import write_landing_snapshot
    from tidemark.streaming.bronze import SourceSpec, refresh_bronze

    lay = _layout(spark, "ingest_delimited")
    spec = SourceSpec("customer.tsv", "customer")
    write_landing_snapshot(_customer_text(spark, sf_dir), lay.landing, lay.source, spec.dataset, RUN_STAMP)
    bronze = _bronze_stripped(refresh_bronze(spark, spec, lay))
    return bronze.select("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


@register(
    "ingest_padded_header",
    "SELECT " + ", ".join(
        f'{expr} AS "{CUSTOMER_PADDED[n]}"'
        for n, expr in [
            ("c_custkey", "CAST(c_custkey AS VARCHAR)"),
            ("c_name", "c_name"),
            ("c_acctbal", "CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR)"),
        ]
    ) + " FROM customer",
)
def q_ingest_padded_header(spark, sf_dir):
    """Bronze keeps the raw header names, padding included."""
    from tidemark.sinks.tables import write_landing_snapshot
    from tidemark.streaming.bronze import SourceSpec, refresh_bronze

    lay = _layout(spark, "ingest_padded_header")
    spec = SourceSpec("customer.tsv", "customer")
    text = _customer_text(spark, sf_dir, ("c_custkey", "c_name", "c_acctbal"))
    write_landing_snapshot(text, lay.landing, lay.source, spec.dataset, RUN_STAMP)
    bronze = refresh_bronze(spark, spec, lay).read()
    return bronze.select(*[F.col(f"`{CUSTOMER_PADDED[n]}`") for n in ("c_custkey", "c_name", "c_acctbal")])


@register(
    "ingest_registry",
    """
SELECT 'customer.tsv' AS dataset, 'customer_tsv' AS table_name, count(*) AS n_rows FROM customer
UNION ALL SELECT 'supplier.tsv', 'supplier_tsv', count(*) FROM supplier
UNION ALL SELECT 'part.tsv', 'part_tsv', count(*) FROM part
""",
)
def q_ingest_registry(spark, sf_dir):
    """N source specs → N bronze tables, each with its own checkpoint."""
    from tidemark.sinks.tables import write_landing_snapshot
    from tidemark.streaming.bronze import SourceSpec, refresh_registry

    lay = _layout(spark, "ingest_registry")
    specs = [SourceSpec(f"{t}.tsv", f"{t}_tsv") for t in ("customer", "supplier", "part")]
    for spec, t in zip(specs, ("customer", "supplier", "part")):
        write_landing_snapshot(_q(spark, sf_dir, t), lay.landing, lay.source, spec.dataset, RUN_STAMP)
    tables = refresh_registry(spark, specs, lay)
    out = None
    for spec in specs:
        part = tables[spec.table].read().agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(spec.dataset).alias("dataset"), F.lit(spec.table).alias("table_name"), "n_rows"
        )
        out = part if out is None else out.unionByName(part)
    return out


@register(
    "ingest_schema_evolution",
    """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR) AS c_acctbal,
       CAST(NULL AS VARCHAR) AS c_mktsegment, '20260101T000000Z' AS _ingest_ts FROM customer
UNION ALL
SELECT CAST(c_custkey AS VARCHAR), c_name, CAST(CAST(c_acctbal AS DECIMAL(12,2)) AS VARCHAR), c_mktsegment,
       '20260909T163000Z' FROM customer
""",
)
def q_ingest_schema_evolution(spark, sf_dir):
    """A later snapshot adds a column in the middle; values map by name, old rows NULL."""
    from tidemark.sinks.tables import write_landing_snapshot
    from tidemark.streaming.bronze import SourceSpec, refresh_bronze

    lay = _layout(spark, "ingest_schema_evolution")
    spec = SourceSpec("customer.tsv", "customer")
    v1 = _customer_text(spark, sf_dir, ("c_custkey", "c_name", "c_acctbal"))
    v2 = _customer_text(spark, sf_dir, ("c_custkey", "c_mktsegment", "c_name", "c_acctbal"))
    write_landing_snapshot(v1, lay.landing, lay.source, spec.dataset, "20260101T000000Z")
    write_landing_snapshot(v2, lay.landing, lay.source, spec.dataset, "20260909T163000Z")
    bronze = _bronze_stripped(refresh_bronze(spark, spec, lay))
    return bronze.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment", "_ingest_ts")


@register(
    "ingest_rescued",
    """
SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, c_name, c_acctbal < 0 AS has_rescued,
       CASE WHEN c_acctbal < 0 THEN c_mktsegment END AS rescued_value
FROM customer
""",
)
def q_ingest_rescued(spark, sf_dir):
    """Over-long rows keep their columns; the surplus values go to _rescued_data."""
    from tidemark.sinks.tables import write_landing_snapshot
    from tidemark.streaming.bronze import SourceSpec, refresh_bronze

    lay = _layout(spark, "ingest_rescued")
    spec = SourceSpec("customer.tsv", "customer")
    raw = _q(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("string").alias("c_custkey"),
        "c_name",
        F.col("c_acctbal").cast("decimal(12,2)").cast("string").alias("c_acctbal"),
        # Rows of customers with a negative balance carry one value too many.
        F.when(F.col("c_acctbal") < 0, F.col("c_mktsegment")).alias("__extra"),
    )
    write_landing_snapshot(raw, lay.landing, lay.source, spec.dataset, RUN_STAMP, extra_field="__extra")
    bronze = _bronze_stripped(refresh_bronze(spark, spec, lay))
    return bronze.select(
        "c_custkey", "c_name",
        F.col("_rescued_data").isNotNull().alias("has_rescued"),
        F.get_json_object("_rescued_data", "$._extra_values[0]").alias("rescued_value"),
    )


@register(
    "ingest_provenance",
    """
SELECT 'supplier.tsv' AS dataset, '20260101T000000Z' AS _ingest_ts, count(*) AS n_rows, true AS has_source_file FROM supplier
UNION ALL
SELECT 'supplier.tsv', '20260909T163000Z', count(*), true FROM supplier
""",
)
def q_ingest_provenance(spark, sf_dir):
    """Every bronze row knows its file and the run stamp of that file."""
    from tidemark.sinks.tables import write_landing_snapshot
    from tidemark.streaming.bronze import SourceSpec, refresh_bronze

    lay = _layout(spark, "ingest_provenance")
    spec = SourceSpec("supplier.tsv", "supplier")
    sup = _q(spark, sf_dir, "supplier")
    for stamp in ("20260101T000000Z", "20260909T163000Z"):
        write_landing_snapshot(sup, lay.landing, lay.source, spec.dataset, stamp)
    bronze = refresh_bronze(spark, spec, lay).read()
    return bronze.groupBy("_ingest_ts").agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.bool_and(F.col("_source_file").contains(F.lit(spec.dataset + "__"))).alias("has_source_file"),
    ).select(F.lit(spec.dataset).alias("dataset"), "_ingest_ts", "n_rows", "has_source_file")


ORACLE_POPULATION = """
SELECT '01000US' AS nation_id, 'United States' AS nation, CAST(year(o_orderdate) AS INTEGER) AS year, count(*) AS population
FROM orders WHERE year(o_orderdate) BETWEEN 1996 AND 2000 AND year(o_orderdate) <> 1998 GROUP BY 3
"""


@register("ingest_variant_json", ORACLE_POPULATION)
def q_ingest_variant_json(spark, sf_dir):
    """A JSON document per file → one VARIANT row → exploded, typed silver rows."""
    from tidemark.plans.driver_landing import land_population
    from tidemark.plans.series_specs import POPULATION
    from tidemark.streaming.bronze import Layout, SourceSpec, refresh_bronze
    from tidemark.streaming.silver import read_silver, refresh_silver

    lay0 = _layout(spark, "ingest_variant_json")
    lay = Layout(lay0.landing, lay0.tables, lay0.checkpoints, "datausa_population")
    land_population(spark, sf_dir, lay, RUN_STAMP)
    refresh_bronze(spark, SourceSpec("population", "population", fmt="json"), lay)
    return read_silver(refresh_silver(spark, POPULATION, lay, "population"))


@register("stream_table_read", "SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def q_stream_table_read(spark, sf_dir):
    """Incremental read of an upstream table into an append-only sink."""
    from tidemark.sinks.tables import AppendOnlyTable
    from tidemark.streaming.silver import _run

    lay = _layout(spark, "stream_table_read")
    src = f"{lay.tables}/events_src"
    ev = _q(spark, sf_dir, "events")
    ev.repartition(4).write.parquet(src)  # round-robin: no hot type in one task
    sink = AppendOnlyTable(spark, f"{lay.tables}/events_copy")
    q = (
        spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
        .writeStream.foreachBatch(lambda b, i: sink.write_batch(b, i))
        .option("checkpointLocation", f"{lay.checkpoints}/events_copy")
        .trigger(availableNow=True).start()
    )
    _run(q, "stream_table_read", 1800)
    return sink.read().groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@register("stream_append_idempotent", "SELECT 2 AS refreshes, count(*) AS n_rows FROM customer")
def q_stream_append_idempotent(spark, sf_dir):
    """K1/T-2: a second refresh over the same landed files adds nothing."""
    from tidemark.sinks.tables import write_landing_snapshot
    from tidemark.streaming.bronze import SourceSpec, refresh_bronze

    lay = _layout(spark, "stream_append_idempotent")
    spec = SourceSpec("customer.tsv", "customer")
    write_landing_snapshot(_customer_text(spark, sf_dir), lay.landing, lay.source, spec.dataset, RUN_STAMP)
    refresh_bronze(spark, spec, lay)
    table = refresh_bronze(spark, spec, lay)
    return table.read().agg(F.lit(2).alias("refreshes"), F.count(F.lit(1)).alias("n_rows"))


@register("mv_refresh", ORACLES["agg_value_per_year"])
def q_mv_refresh(spark, sf_dir):
    """K4: full-recompute materialisation (overwrite), run twice, read back."""
    from tidemark.sinks.tables import materialize

    lay = _layout(spark, "mv_refresh")
    path = f"{lay.tables}/gold/agg_value_per_year"
    inp = star.gold_inputs(spark, sf_dir)
    materialize(gold.agg_value_per_year_sql(spark, inp), path)
    return materialize(gold.agg_value_per_year_sql(spark, inp), path)


# Manifest of two fetch runs over the documents "source": run 1 lands every
# document; run 2 classifies the revision against run 1 (ADDED/CHANGED →
# FETCHED, UNCHANGED → UNCHANGED; REMOVED items are not fetched, so no row).
RUN1_STAMP, RUN2_STAMP = "20260101T000000Z", "20260909T163000Z"


def manifest_outcomes(spark, sf_dir):
    from tidemark.operators.changes import classify_changes

    docs = _q(spark, sf_dir, "documents").select(
        F.concat(F.lit("doc-"), F.col("doc_id").cast("string")).alias("item"), "text"
    )
    rev = documents_revision(spark, sf_dir)

    def outcome(df, stamp, status, run):
        return df.select(
            F.lit("documents").alias("source"),
            F.col("item").alias("dataset"),
            F.lit(stamp).alias("ingest_ts"),
            status.alias("status"),
            F.when(status == "FETCHED", F.lit(200)).otherwise(F.lit(304)).alias("http_status"),
            F.sha2("text", 256).alias("content_sha256"),
            F.lit(None).cast("string").alias("last_modified"),
            F.octet_length("text").cast("long").alias("bytes"),
            F.concat(F.lit("/source/"), F.col("item")).alias("source_url"),
            F.concat(F.lit("/landing/documents/"), F.col("item"), F.lit("/"), F.col("item"), F.lit("__" + stamp)).alias("landing_path"),
            F.lit(run).alias("run_id"),
            F.lit(f"{stamp[0:4]}-{stamp[4:6]}-{stamp[6:8]} {stamp[9:11]}:{stamp[11:13]}:{stamp[13:15]}").cast("timestamp").alias("fetched_at"),
            F.lit(None).cast("string").alias("error_message"),
        )

    run1 = outcome(docs, RUN1_STAMP, F.lit("FETCHED"), "run-1")
    prev = docs.select("item", F.sha2("text", 256).alias("fp"))
    cur = rev.select("item", "text", F.sha2("text", 256).alias("fp"))
    changes = classify_changes(cur.select("item", "fp"), prev, "item", "fp").filter(F.col("status") != "REMOVED")
    run2_in = cur.join(changes.select("item", "status"), "item")
    st = F.when(F.col("status") == "UNCHANGED", F.lit("UNCHANGED")).otherwise(F.lit("FETCHED"))
    run2 = outcome(run2_in, RUN2_STAMP, st, "run-2")
    return run1, run2


ORACLE_MANIFEST = _with(ORACLE_DOC_SNAPSHOTS, """
, curtext AS (SELECT 'doc-' || CAST(min(doc_id) AS VARCHAR) AS item, regexp_replace(text, '[ \t]+', ' ', 'g') AS text
              FROM documents GROUP BY text
              UNION ALL SELECT 'bench-' || CAST(item_id AS VARCHAR), text FROM benchmark),
run1 AS (SELECT 'doc-' || CAST(doc_id AS VARCHAR) AS item, text, 'FETCHED' AS status,
                '20260101T000000Z' AS stamp, 'run-1' AS run_id, TIMESTAMP '2026-01-01 00:00:00' AS fetched_at FROM documents),
run2 AS (SELECT c.item, c.text,
                CASE WHEN p.fp = sha256(c.text) THEN 'UNCHANGED' ELSE 'FETCHED' END AS status,
                '20260909T163000Z' AS stamp, 'run-2' AS run_id, TIMESTAMP '2026-09-09 16:30:00' AS fetched_at
         FROM curtext c LEFT JOIN prev p ON c.item = p.item),
runs AS (SELECT * FROM run1 UNION ALL SELECT * FROM run2)
SELECT 'documents' AS source, item AS dataset, stamp AS ingest_ts, status,
       CAST(CASE WHEN status = 'FETCHED' THEN 200 ELSE 304 END AS INTEGER) AS http_status,
       sha256(text) AS content_sha256, CAST(NULL AS VARCHAR) AS last_modified,
       CASE WHEN status = 'FETCHED' THEN CAST(octet_length(encode(text)) AS BIGINT) END AS bytes,
       '/source/' || item AS source_url,
       CASE WHEN status = 'FETCHED' THEN '/landing/documents/' || item || '/' || item || '__' || stamp END AS landing_path,
       run_id, fetched_at, CAST(NULL AS VARCHAR) AS error_message
FROM runs
""")


def _manifest_table(spark, sf_dir):
    from tidemark.sinks.manifest import append_manifest
    from tidemark.sinks.tables import AppendOnlyTable

    lay = _layout(spark, "manifest")
    table = AppendOnlyTable(spark, f"{lay.tables}/source_manifest")
    run1, run2 = manifest_outcomes(spark, sf_dir)
    append_manifest(table, run1, 1)
    append_manifest(table, run2, 2)
    append_manifest(table, run2, 2)  # replaying a run replaces it, never duplicates
    return table


@register("manifest_append", ORACLE_MANIFEST)
def q_manifest_append(spark, sf_dir):
    """Append-only ledger, one row per item per run, NULL rules by status."""
    from tidemark.sinks.manifest import MANIFEST_COLUMNS

    ledger = _manifest_table(spark, sf_dir).read()
    # fetched_at is UTC; returned as its UTC wall-clock value so the result
    # does not depend on the time zone of whoever collects it.
    return ledger.select(*[F.col(n).cast("timestamp_ntz").alias(n) if n == "fetched_at" else n for n, _ in MANIFEST_COLUMNS])


@register(
    "manifest_last_known",
    ORACLE_MANIFEST.rsplit("SELECT 'documents' AS source", 1)[0]
    + """
, m AS (SELECT item AS dataset, stamp AS ingest_ts, status, sha256(text) AS content_sha256 FROM runs)
SELECT dataset, ingest_ts, content_sha256, CAST(NULL AS VARCHAR) AS last_modified FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset ORDER BY ingest_ts DESC) AS rn FROM m WHERE status = 'FETCHED') t
WHERE rn = 1
""",
)
def q_manifest_last_known(spark, sf_dir):
    """Latest FETCHED state per dataset, read back from the ledger."""
    from tidemark.sinks.manifest import last_known_state

    return last_known_state(_manifest_table(spark, sf_dir).read(), "documents")


@register("compact_table", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_compact_table(spark, sf_dir):
    """K7/K9: same rows in fewer files, range-clustered on a key."""
    from tidemark.sinks.maintenance import compact, file_stats
    from tidemark.sinks.tables import VersionedTable

    lay = _layout(spark, "compact_table")
    table = VersionedTable(spark, f"{lay.tables}/events")
    table.commit(_q(spark, sf_dir, "events").repartition(50))
    before, _ = file_stats(table.read())
    compact(table, cluster_by=["event_type", "ts"])
    after, _ = file_stats(table.read())
    if not after < before:
        raise AssertionError(f"compaction did not reduce files: {before} → {after}")
    return table.read()


@register("auto_cluster_table", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_auto_cluster_table(spark, sf_dir):
    """K9: keys chosen from column statistics, rows along a curve over them; a filter on either of two keys, or both, skips most files."""
    from tidemark.sinks.clustering import cluster, file_ranges, files_read
    from tidemark.sinks.packing import file_listing
    from tidemark.sinks.tables import VersionedTable

    lay = _layout(spark, "auto_cluster_table")
    table = VersionedTable(spark, f"{lay.tables}/events")
    table.commit(_q(spark, sf_dir, "events"))
    size = file_listing(spark, [table.version_path(table.current_version())]).agg(F.sum("length")).first()[0]
    _, keys = cluster(table, target_file_bytes=max(1, size // 64))
    two = ["event_id" if k == "ts" else k for k in keys[:2]]  # times rise with the ids, so either is served by the other
    ranges = file_ranges(table.read(), two)
    edges = table.read().agg(*[F.percentile_approx(k, [0.45, 0.5]).alias(k) for k in two]).first()
    spans = {k: tuple(edges[k]) for k in two}
    shares = [files_read(ranges, **{k: spans[k]}) for k in two] + [files_read(ranges, **spans)]
    if not (max(shares[:2]) <= 0.6 and shares[2] <= 0.25):
        raise AssertionError(f"clustering on {keys}: shares of files read {shares}")
    return table.read()


@register("ingest_text_roundtrip", "SELECT doc_id, text, lang, source, n_chars FROM documents")
def q_ingest_text_roundtrip(spark, sf_dir):
    """Texts with tabs, quotes and line breaks land as quoted fields and are read back as they were."""
    from tidemark.sources.quoted import read_quoted, write_quoted_snapshot

    lay = _layout(spark, "ingest_text_roundtrip")
    docs = _q(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source", "n_chars")
    read = read_quoted(spark, write_quoted_snapshot(docs, lay.landing, "corpus", "documents", "20260101T000000Z"))
    return read.select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang", "source", F.col("n_chars").cast("long").alias("n_chars"))


@register(
    "ordered_fingerprint",
    """
WITH lines AS (SELECT coalesce(text, '') AS line, row_number() OVER (ORDER BY doc_id) - 1 AS i FROM documents),
one AS (SELECT i // 4096 AS i, sha256(string_agg(sha256(line), '' ORDER BY i)) AS h FROM lines GROUP BY 1),
two AS (SELECT sha256(string_agg(h, '' ORDER BY i)) AS h FROM one)
SELECT h AS content_sha256, (SELECT count(*) FROM lines) AS n_lines, (SELECT CAST(sum(octet_length(encode(line)) + 1) AS BIGINT) FROM lines) AS bytes FROM two
""",
)
def q_ordered_fingerprint(spark, sf_dir):
    """R2: one digest of all texts in the order of their ids (two levels hold 16 million lines, as the oracle does)."""
    from tidemark.operators.fingerprints import ordered_fingerprint

    docs = _q(spark, sf_dir, "documents").orderBy("doc_id")
    return ordered_fingerprint(docs.select("text"), "text")


@register(
    "changed_rows",
    """
SELECT side, event_id, value FROM (
  SELECT 'before' AS side, event_id, value FROM events WHERE event_id % 1000 = 7 AND value IS NOT NULL
  UNION ALL SELECT 'after', event_id, value + 1 FROM events WHERE event_id % 1000 = 7 AND value IS NOT NULL) x
""",
)
def q_changed_rows(spark, sf_dir):
    """Two copies of the events, one with changed values: only rows of buckets whose fingerprints differ are compared."""
    from tidemark.operators.parity import multiset_difference

    before = _q(spark, sf_dir, "events").select("event_id", "ts", "user_id", "event_type", "value")
    after = before.withColumn("value", F.when(F.col("event_id") % 1000 == 7, F.col("value") + 1).otherwise(F.col("value")))
    lost, new = multiset_difference(before, after)
    rows = lost.withColumn("side", F.lit("before")).unionByName(new.withColumn("side", F.lit("after")))
    return rows.select("side", "event_id", "value")


@register("commit_race", "SELECT event_id, ts, user_id, event_type, value, props FROM events")
def q_commit_race(spark, sf_dir):
    """K2: two writers start from one version; the first to publish keeps every row, the other is refused."""
    from tidemark.sinks.tables import CommitConflict, VersionedTable

    lay = _layout(spark, "commit_race")
    table = VersionedTable(spark, f"{lay.tables}/events")
    ev = _q(spark, sf_dir, "events")
    start = table.commit(ev.filter("event_type = 'error'"))
    late = table.prepare(ev.limit(0), current=start)
    VersionedTable(spark, table.path).commit(ev, current=start)
    try:
        table.publish(late)
    except CommitConflict:
        return table.read()
    raise AssertionError("a stale commit was accepted")


@register(
    "retention_outcome",
    "SELECT version, count(*) AS rows, version < 3 AS removed, CAST(0 AS BIGINT) AS selected_again FROM events, (SELECT unnest([0, 1, 2, 3])::INTEGER AS version) GROUP BY 1",
)
def q_retention_outcome(spark, sf_dir):
    """K8: old versions and an abandoned attempt are swept and recorded; a second run selects nothing."""
    from tidemark.sinks.maintenance import abandoned_attempts, retain
    from tidemark.sinks.tables import VersionedTable

    lay = _layout(spark, "retention_outcome")
    table = VersionedTable(spark, f"{lay.tables}/events")
    ev = _q(spark, sf_dir, "events")
    for _ in range(4):
        table.commit(ev)
    ev.write.parquet(f"{table.path}/v=4-lost")
    retain(table, older_than_hours=0, dry_run=False)
    again = len(retain(table, older_than_hours=0)) + len(abandoned_attempts(table, 0))
    gone = table.commits.removed().select("version", F.lit(True).alias("removed"))
    log = table.log().select("version", "rows").join(gone, "version", "left").withColumn("removed", F.coalesce("removed", F.lit(False)))
    if table.read().count() != log.where("not removed").first()["rows"]:
        raise AssertionError("the current version lost rows")
    return log.withColumn("selected_again", F.lit(again).cast("long"))


@register("retain_versions")
def q_retain_versions(spark, sf_dir):
    """K8: versions retention would remove (dry run): every non-current version."""
    from tidemark.sinks.maintenance import retain, retention_plan
    from tidemark.sinks.tables import VersionedTable

    lay = _layout(spark, "retain_versions")
    table = VersionedTable(spark, f"{lay.tables}/events")
    ev = _q(spark, sf_dir, "events")
    for _ in range(3):
        table.commit(ev)
    retain(table, older_than_hours=0, dry_run=True)
    return retention_plan(table, older_than_hours=0).select("version", "path")


# ====================================================================== SCD1 convergence (replay, stream state)

LATEST_EVENT_PER_USER = """
SELECT user_id, event_type, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) t
WHERE rn = 1
"""
# The events table split into micro-batches by event type, applied in this
# order and then replayed in reverse: a merge that is a maximum per key
# converges to the same table whatever the order and however often replayed.
REPLAY_ORDER = ("view", "error", "signup", "click", "purchase")


@register("scd1_replay", LATEST_EVENT_PER_USER)
def q_scd1_replay(spark, sf_dir):
    """Out-of-order and replayed batches converge; every merge is a committed version."""
    from tidemark.operators.cdc import publish, scd1_merge
    from tidemark.sinks.tables import VersionedTable

    lay = _layout(spark, "scd1_replay")
    table = VersionedTable(spark, f"{lay.tables}/latest_event")
    ev = _q(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    seq, payload = ["ts", "event_id"], ["event_type", "value"]
    types = list(REPLAY_ORDER)
    known = [r[0] for r in ev.select("event_type").distinct().collect()]
    types += sorted(t for t in known if t not in types)  # any other type still gets merged
    for i, etype in enumerate(types + types[::-1]):
        batch = ev.filter(F.col("event_type") == etype)
        table.commit(scd1_merge(table.read(), batch, ["user_id"], seq, payload), batch_id=i, stream="replay")
    return publish(table.read(), seq)


@register("scd1_stream_state", LATEST_EVENT_PER_USER)
def q_scd1_stream_state(spark, sf_dir):
    """Latest row per key kept in the streaming state store, one file per micro-batch."""
    from tidemark.operators.cdc import publish
    from tidemark.sinks.tables import VersionedTable
    from tidemark.streaming.silver import upsert_stream

    lay = _layout(spark, "scd1_stream_state")
    src = f"{lay.tables}/events_src"
    ev = _q(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    ev.repartition(5).write.parquet(src)  # round-robin: no hot type in one task
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(src)
    table = VersionedTable(spark, f"{lay.tables}/latest_event")
    upsert_stream(stream, ["user_id"], ["ts", "event_id"], ["event_type", "value"], table,
                  f"{lay.checkpoints}/latest_event", "scd1_stream_state", stateful=True)
    return publish(table.read(), ["ts", "event_id"])


@register("scd1_stream_merge", LATEST_EVENT_PER_USER)
def q_scd1_stream_merge(spark, sf_dir):
    """Stateless stream, each micro-batch merged into the versioned table in foreachBatch."""
    from tidemark.operators.cdc import publish
    from tidemark.sinks.tables import VersionedTable
    from tidemark.streaming.silver import upsert_stream

    lay = _layout(spark, "scd1_stream_merge")
    src = f"{lay.tables}/events_src"
    ev = _q(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    ev.repartition(5).write.parquet(src)  # round-robin: no hot type in one task
    stream = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 2).parquet(src)
    table = VersionedTable(spark, f"{lay.tables}/latest_event")
    upsert_stream(stream, ["user_id"], ["ts", "event_id"], ["event_type", "value"], table,
                  f"{lay.checkpoints}/latest_event", "scd1_stream_merge", stateful=False)
    return publish(table.read(), ["ts", "event_id"])


# ====================================================================== the product end to end

# Per session (weakly held) and driver-table folder: the refreshed layout.
_MEDALLION: "weakref.WeakKeyDictionary" = weakref.WeakKeyDictionary()


def _medallion(spark, sf_dir):
    """Land the driver tables as raw snapshots, then refresh bronze → silver → gold once per process."""
    from tidemark.plans.driver_landing import land_series_product
    from tidemark.plans.medallion import refresh_everything

    from tidemark.plans.medallion import SERIES_SOURCE
    from tidemark.streaming.bronze import Layout

    runs = _MEDALLION.setdefault(spark, {})
    if sf_dir not in runs:
        scratch = _layout(spark, "medallion")
        lay = Layout(scratch.landing, scratch.tables, scratch.checkpoints, SERIES_SOURCE)
        land_series_product(spark, sf_dir, lay)
        refresh_everything(spark, lay, stats_years=star.POPULATION_YEARS)
        runs[sf_dir] = lay
    return runs[sf_dir]


@register(
    "medallion_agg_value_per_year",
    _with(star.ORACLE_STAR_CTE, f"""
, yearly AS (SELECT series_id, year, CAST(round(sum(value), 1) AS DOUBLE) AS summed_value
             FROM facts WHERE period <> 'Q05' GROUP BY 1, 2),
ranked AS (SELECT *, row_number() OVER (PARTITION BY series_id ORDER BY summed_value DESC, year ASC) = 1 AS is_best_year
           FROM yearly)
SELECT CAST(r.series_id AS VARCHAR) AS series_id, l.sector_name, l.measure_text, l.class_text, l.duration_text, l.seasonal_text,
       {star.ORACLE_LABEL} AS label, CAST(r.year AS INTEGER) AS year, r.summed_value, r.is_best_year, p.population
FROM ranked r LEFT JOIN labels l ON r.series_id = l.series_id LEFT JOIN population p ON r.year = p.year
"""),
)
def q_medallion_agg_value_per_year(spark, sf_dir):
    """Landing → bronze → silver (gated SCD1 over two restated snapshots) → gold, end to end."""
    from tidemark.plans.medallion import gold_table

    lay = _medallion(spark, sf_dir)
    return gold_table(spark, lay, "agg_value_per_year")


@register(
    "medallion_value_per_quarter",
    _with(star.ORACLE_STAR_CTE, f"""
, ranked AS (SELECT series_id, year, period, CAST(value AS DOUBLE) AS value,
                    row_number() OVER (PARTITION BY series_id, period ORDER BY CAST(value AS DOUBLE) DESC, year ASC) = 1
                        AS best_year_per_quarter
             FROM facts WHERE period <> 'Q05')
SELECT CAST(r.series_id AS VARCHAR) AS series_id, l.sector_name, l.measure_text, l.class_text, l.duration_text, l.seasonal_text,
       {star.ORACLE_LABEL} AS label, CAST(r.year AS INTEGER) AS year, r.period, r.value, r.best_year_per_quarter, p.population
FROM ranked r LEFT JOIN labels l ON r.series_id = l.series_id LEFT JOIN population p ON r.year = p.year
"""),
)
def q_medallion_value_per_quarter(spark, sf_dir):
    """G3 over the refreshed silver tables."""
    from tidemark.plans.medallion import gold_table

    lay = _medallion(spark, sf_dir)
    return gold_table(spark, lay, "value_per_quarter")


@register(
    "medallion_quarantine",
    """
SELECT rule, n FROM (
  SELECT 'plausible_year' AS rule, 2 * count(*) AS n FROM supplier
  UNION ALL SELECT 'valid_period', count(*) FROM supplier
  UNION ALL SELECT 'valid_year', count(*) FROM supplier) t
""",
)
def q_medallion_quarantine(spark, sf_dir):
    """D3: rows the silver gate rejected, counted per failed rule."""
    from tidemark.streaming.silver import read_quarantine

    lay = _medallion(spark, sf_dir)
    rejected = read_quarantine(spark, lay, "pr_data")
    return rejected.select(F.explode("_failed_rules").alias("rule")).groupBy("rule").agg(F.count(F.lit(1)).alias("n"))


@register("medallion_population_stats", ORACLES["population_stats"])
def q_medallion_population_stats(spark, sf_dir):
    """G1 over the refreshed silver population (VARIANT document → exploded → SCD1)."""
    from tidemark.plans.medallion import gold_table

    lay = _medallion(spark, sf_dir)
    out = gold_table(spark, lay, "population_stats")
    return out.select("year_count", *[F.round(c, 6).alias(c) for c in out.columns if c != "year_count"])


# Rows of every table of the end-to-end run, by layer.
ORACLE_LAYERS = _with(star.ORACLE_STAR_CTE, """
, best AS (SELECT count(*) AS years FROM (SELECT DISTINCT series_id, year FROM facts WHERE period <> 'Q05') y),
layers AS (
  SELECT 'bronze' AS layer, 'pr_data_1_alldata' AS "table", 2 * (SELECT count(*) FROM facts) + 3 * (SELECT count(*) FROM supplier) AS n_rows
  UNION ALL SELECT 'bronze', 'pr_series', count(*) FROM supplier
  UNION ALL SELECT 'bronze', 'pr_sector', count(*) FROM region
  UNION ALL SELECT 'bronze', 'pr_measure', count(*) FROM nation
  UNION ALL SELECT 'bronze', 'pr_duration', count(*) FROM supplier WHERE s_acctbal > 0
  UNION ALL SELECT 'bronze', 'population', 1
  UNION ALL SELECT 'silver', 'pr_data', count(*) FROM facts
  UNION ALL SELECT 'silver', 'pr_series', count(*) FROM supplier
  UNION ALL SELECT 'silver', 'pr_sector', count(*) FROM region
  UNION ALL SELECT 'silver', 'pr_measure', count(*) FROM nation
  UNION ALL SELECT 'silver', 'pr_duration', count(*) FROM supplier WHERE s_acctbal > 0
  UNION ALL SELECT 'silver', 'population', count(*) FROM population
  UNION ALL SELECT 'gold', 'agg_value_per_year', years FROM best
  UNION ALL SELECT 'gold', 'value_per_quarter', count(*) FROM facts WHERE period <> 'Q05'
  UNION ALL SELECT 'gold', 'population_stats', 1)
""")


@register("list_layer_tables", ORACLE_LAYERS + "SELECT * FROM layers")
def q_list_layer_tables(spark, sf_dir):
    """Layer databases bootstrapped idempotently; tables listed (temporary views skipped) with row counts."""
    import uuid

    from tidemark.sinks.tables import VersionedTable
    from tidemark.sources.tables import bootstrap_namespace, list_layer_tables, register_table
    from tidemark.session import path_exists

    lay = _medallion(spark, sf_dir)
    env = f"run{uuid.uuid4().hex[:8]}"
    dbs = bootstrap_namespace(spark, "tidemark", env, lay.tables, layers=("bronze", "silver", "gold"))
    bootstrap_namespace(spark, "tidemark", env, lay.tables, layers=("bronze", "silver", "gold"))  # idempotent
    for name in ("pr_data_1_alldata", "pr_series", "pr_sector", "pr_measure", "pr_duration", "population"):
        if path_exists(spark, lay.table_path("bronze", name)):
            register_table(spark, dbs[0], name, lay.table_path("bronze", name))
    for name in ("pr_data", "pr_series", "pr_sector", "pr_measure", "pr_duration", "population"):
        t = VersionedTable(spark, lay.table_path("silver", name))
        v = t.current_version()
        if v is not None:
            register_table(spark, dbs[1], name, t.version_path(v))
    for name in ("agg_value_per_year", "value_per_quarter", "population_stats"):
        g = VersionedTable(spark, lay.table_path("gold", name))
        register_table(spark, dbs[2], name, g.version_path(g.current_version()))
    listed = list_layer_tables(spark, dbs).collect()
    counts = None
    for r in listed:
        part = spark.table(f"{r.database}.{r.table}").agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(r.database.rsplit("_", 1)[-1]).alias("layer"), F.lit(r.table).alias("table"), "n_rows"
        )
        counts = part if counts is None else counts.unionByName(part)
    return counts


@register(
    "maintain_layers",
    ORACLE_LAYERS + f"""
SELECT layer, "table" AS table_name, n_rows, TRUE AS packed FROM layers
UNION ALL SELECT 'quarantine', 'pr_data', 3 * count(*), TRUE FROM supplier
UNION ALL SELECT 'quarantine', t, 0, TRUE FROM (SELECT unnest(['pr_series', 'pr_sector', 'pr_measure', 'pr_duration', 'population']) AS t) q
UNION ALL SELECT 'ledger', 'source_manifest', count(*), TRUE FROM ({ORACLE_MANIFEST.strip()}) m
""",
)
def q_maintain_layers(spark, sf_dir):
    """K7: small files of every layer packed and swapped; rows as they were, files at most twice what the target size asks for."""
    from tidemark.sinks.manifest import append_manifest
    from tidemark.sinks.packing import maintain_layers
    from tidemark.sinks.tables import AppendOnlyTable

    lay = _medallion(spark, sf_dir)
    ledger = AppendOnlyTable(spark, f"{lay.tables}/source_manifest")
    for seq, run in enumerate(manifest_outcomes(spark, sf_dir), 1):
        append_manifest(ledger, run, seq)
    target = 32 * 1024 * 1024
    done = maintain_layers(spark, lay.tables, target, layers=("bronze", "quarantine", "silver", "gold", "ledger"))
    return done.select("layer", "table_name", "n_rows", (F.col("files_after") <= 1 + 2 * F.floor(F.col("bytes") / target)).alias("packed"))


@register(
    "medallion_expectations",
    _with(star.ORACLE_STAR_CTE, """
SELECT 'pr_data_1_alldata' AS table_name, 'no_rescued_data' AS rule, CAST(0 AS BIGINT) AS failed,
       2 * (SELECT count(*) FROM facts) + 3 * (SELECT count(*) FROM supplier) AS n_rows
UNION ALL SELECT 'pr_series', 'no_rescued_data', 0, (SELECT count(*) FROM supplier)
UNION ALL SELECT 'pr_sector', 'no_rescued_data', 0, (SELECT count(*) FROM region)
UNION ALL SELECT 'pr_measure', 'no_rescued_data', 0, (SELECT count(*) FROM nation)
UNION ALL SELECT 'pr_duration', 'no_rescued_data', 0, (SELECT count(*) FROM supplier WHERE s_acctbal > 0)
UNION ALL SELECT 'population', 'value_present', 0, 1
"""),
)
def q_medallion_expectations(spark, sf_dir):
    """D1 in the pipeline: warn-only bronze expectations, counted per micro-batch, summed per table and rule."""
    from tidemark.plans.medallion import layout_for
    from tidemark.plans.series_specs import BRONZE_SOURCES
    from tidemark.session import path_exists
    from tidemark.streaming.bronze import expectation_log

    lay = _medallion(spark, sf_dir)
    out = None
    for spec in BRONZE_SOURCES:
        blay = layout_for(lay, spec)
        if not path_exists(spark, blay.table_path("_expectations", spec.table)):
            continue
        part = expectation_log(spark, blay, spec.table).groupBy("rule").agg(
            F.sum("failed").cast("long").alias("failed"), F.sum("n_rows").cast("long").alias("n_rows")
        ).select(F.lit(spec.table).alias("table_name"), "rule", "failed", "n_rows")
        out = part if out is None else out.unionByName(part)
    return out


@register("scd1_bucketed_merge", LATEST_EVENT_PER_USER)
def q_scd1_bucketed_merge(spark, sf_dir):
    """C1/C4 at scale: state kept bucketed on the key; each merge shuffles only the batch.

    Same batches, order and replay as ``scd1_replay``; the merge is a full
    outer join of the bucketed state with the batch's latest rows.
    """
    import uuid

    from tidemark.operators.cdc import publish, scd1_merge_join
    from tidemark.sinks.tables import BucketedVersionedTable
    from tidemark.sources.tables import bootstrap_namespace

    lay = _layout(spark, "scd1_bucketed_merge")
    (db,) = bootstrap_namespace(spark, "tidemark", f"b{uuid.uuid4().hex[:8]}", lay.tables, layers=("silver",))
    table = BucketedVersionedTable(spark, f"{lay.tables}/latest_event", db, "latest_event", ["user_id"], 16)
    ev = _q(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    seq, payload = ["ts", "event_id"], ["event_type", "value"]
    types = list(REPLAY_ORDER)
    known = [r[0] for r in ev.select("event_type").distinct().collect()]
    types += sorted(t for t in known if t not in types)
    for i, etype in enumerate(types + types[::-1]):
        batch = ev.filter(F.col("event_type") == etype)
        table.commit(scd1_merge_join(table.read(), batch, ["user_id"], seq, payload), batch_id=i, stream="replay")
    return publish(table.read(), seq)


@register("scd1_pruned_merge", LATEST_EVENT_PER_USER)
def q_scd1_pruned_merge(spark, sf_dir):
    """C1/C4 with a file index: each merge rewrites only the files that may hold a changed key; same batches, order and replay as ``scd1_replay``."""
    from tidemark.operators.cdc import publish
    from tidemark.sinks.keyed import KeyedTable

    lay = _layout(spark, "scd1_pruned_merge")
    table = KeyedTable(spark, f"{lay.tables}/latest_event", ["user_id"])
    ev = _q(spark, sf_dir, "events").select("user_id", "ts", "event_id", "event_type", "value")
    seq, payload = ["ts", "event_id"], ["event_type", "value"]
    known = {r[0] for r in ev.select("event_type").distinct().collect()}
    types = [*REPLAY_ORDER, *sorted(known - set(REPLAY_ORDER))]
    for i, etype in enumerate(types + types[::-1]):
        table.upsert(ev.filter(F.col("event_type") == etype), seq, payload, batch_id=i, stream="replay")
    return publish(table.read(), seq)
