"""The schema of an append-only table as a versioned, additive record kept with the table.

Readers take the schema from the newest entry instead of opening the footers of all batches. A writer publishes a wider schema before the data that
needs it, so the record always covers the files; of two writers that widen it at once, the second merges with the first and takes the next number.

Defined cases: a batch may lack columns of the record (null when read); a column keeps its first place and type, another type under its
name fails the write; names that differ only in case count as one where the session is case-insensitive, and fail too.
"""

from __future__ import annotations

import json

from pyspark.sql import SparkSession
from pyspark.sql.types import StructField, StructType

from tidemark.sinks.commits import CommitLog

SCHEMA_DIR = "_schema"


class SchemaConflict(ValueError):
    """A batch brings a column of the record with another type, or with another spelling of its name."""


def widened(known: StructType | None, new: StructType, case_sensitive: bool = False) -> StructType:
    """The columns of ``known``, then those only ``new`` has; all nullable."""
    fields = list(known.fields) if known else []

    def name(text: str) -> str:
        return text if case_sensitive else text.lower()

    have = {name(f.name): f for f in fields}
    for f in new.fields:
        old = have.get(name(f.name))
        if old is None:
            have[name(f.name)] = StructField(f.name, f.dataType, True)
            fields.append(have[name(f.name)])
        elif old.name != f.name or old.dataType.simpleString() != f.dataType.simpleString():
            raise SchemaConflict(f"column {f.name} {f.dataType.simpleString()}: the table has {old.name} {old.dataType.simpleString()}")
    return StructType(fields)


class SchemaLog:
    def __init__(self, spark: SparkSession, table_path: str):
        self.spark = spark
        self.log = CommitLog(spark, f"{table_path.rstrip('/')}/{SCHEMA_DIR}")

    def version(self) -> int | None:
        return self.log.latest()

    def schema(self, version: int | None = None) -> StructType | None:
        """The recorded schema, the newest by default; None before the first batch."""
        v = self.log.latest() if version is None else version
        return None if v is None else StructType.fromJson(json.loads(self.log.entry(v)["schema"]))

    def cover(self, new: StructType) -> StructType:
        """Make the record cover ``new``; returns the newest schema."""
        sensitive = self.spark.conf.get("spark.sql.caseSensitive", "false") == "true"
        while True:
            v = self.log.latest()
            known = None if v is None else self.schema(v)
            schema = widened(known, new, sensitive)
            if known is not None and len(schema) == len(known):
                return known
            if self.log.publish(0 if v is None else v + 1, {"schema": schema.json()}):
                return schema
