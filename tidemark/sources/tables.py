"""Catalog access: layer namespaces, table registration, listing, fixtures.

Open Spark has no ``CREATE CATALOG``; a namespace ``<prefix>_<env>`` maps to
one database per layer, ``<prefix>_<env>_<layer>``, each located under the
shared table root, so every statement here is idempotent.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

LAYERS = ("bronze", "silver", "gold", "quarantine")


def bootstrap_namespace(spark: SparkSession, prefix: str, env: str, tables_root: str, layers: tuple[str, ...] = LAYERS) -> list[str]:
    """``CREATE DATABASE IF NOT EXISTS`` for every layer; safe to run any number of times."""
    names = []
    for layer in layers:
        db = f"{prefix}_{env}_{layer}"
        spark.sql(
            "CREATE DATABASE IF NOT EXISTS IDENTIFIER(:db) LOCATION :loc",
            args={"db": db, "loc": f"{tables_root.rstrip('/')}/{layer}"},
        )
        names.append(db)
    return names


def register_table(spark: SparkSession, database: str, table: str, path: str) -> str:
    """Expose a parquet directory as ``database.table`` (external table, no data moved)."""
    fqn = f"{database}.{table}"
    spark.sql(
        "CREATE TABLE IF NOT EXISTS IDENTIFIER(:t) USING parquet LOCATION :p",
        args={"t": fqn, "p": path},
    )
    if any(c.isPartition for c in spark.catalog.listColumns(fqn)):
        # Partitioned layout (e.g. bronze batch=<id>): register the existing partitions.
        spark.catalog.recoverPartitions(fqn)
    spark.sql("REFRESH TABLE IDENTIFIER(:t)", args={"t": fqn})
    return fqn


def list_layer_tables(spark: SparkSession, databases: list[str]) -> DataFrame:
    """(database, table) for every persistent table of the given layers; temporary views skipped."""
    rows = [
        (db, t.name)
        for db in databases
        for t in spark.catalog.listTables(db)
        if not t.isTemporary
    ]
    return spark.createDataFrame(rows, "database string, table string")


def temporary_view(df: DataFrame, name: str) -> DataFrame:
    """Pipeline-internal, non-materialised view: registered by name, returned unchanged."""
    df.createOrReplaceTempView(name)
    return df


def load_fixture(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """Small JSON (one object per line) or CSV (header row) fixture → DataFrame."""
    reader = spark.read.schema(schema) if schema else spark.read
    if path.endswith(".json") or path.endswith(".jsonl"):
        return reader.json(path)
    if path.endswith(".csv") or path.endswith(".tsv"):
        return reader.option("header", True).option("sep", "\t" if path.endswith(".tsv") else ",").csv(path)
    raise ValueError(f"unsupported fixture format: {path}")


def write_bucketed(df: DataFrame, database: str, table: str, path: str, keys: list[str], buckets: int) -> DataFrame:
    """Store ``df`` bucketed and sorted on ``keys`` as ``database.table`` (files at ``path``).

    Two tables bucketed on the same keys into the same number of buckets are
    joined on those keys without an exchange on either side, so a large
    fact-to-fact join pays its shuffle once, at write time, instead of at
    every query. Returns the table as a DataFrame.
    """
    fqn = f"{database}.{table}"
    (
        df.write.mode("overwrite")
        .bucketBy(buckets, *keys)
        .sortBy(*keys)
        .option("path", path)
        .saveAsTable(fqn)
    )
    return df.sparkSession.table(fqn)
