"""tidemark: medallion refinement operators on Spark.

Public entry points (everything is plain DataFrame / SQL / Structured Streaming):

* ``tidemark.functions``  — Column helpers (cleaning, keys, labels, text, variant)
* ``tidemark.operators``  — quality gates, SCD1, ranking, joins, aggregates, change detection
* ``tidemark.sources``    — drift-tolerant delimited reads, catalog helpers
* ``tidemark.sinks``      — landing writer, append-only and versioned tables, manifest, maintenance
* ``tidemark.streaming``  — bronze and silver refresh streams
* ``tidemark.plans``      — gold analyses (SQL + DataFrame twins) and the end-to-end product
"""

__version__ = "0.1.0"
