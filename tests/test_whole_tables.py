"""Registered queries work on whole driver tables."""

from conftest import SF_SMALL
from tidemark.plans import registry


def test_retain_versions_keeps_every_event_in_each_version(spark):
    events = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    plan = registry.QUERIES["retain_versions"](spark, SF_SMALL).collect()
    assert sorted(r.version for r in plan) == [0, 1]
    assert [spark.read.parquet(r.path).count() for r in plan] == [events, events]
