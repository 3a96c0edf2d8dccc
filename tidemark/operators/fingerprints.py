"""Ordered content fingerprints: a tree of SHA-256 digests over lines, the same however the lines are spread over tasks.

Leaves are the digests of the lines in order. ``FAN`` neighbours at a time are hashed into one digest, level by level, until one is left
(two levels at least), so no task holds more than ``FAN`` digests and the number of levels grows with the logarithm of the lines. Moving,
changing, adding or removing a line changes the root; dealing the same lines to other partitions does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import scratch_path

FAN = 4096
_POSITION_BITS = 33  # of monotonically_increasing_id


def ordered_fingerprint(lines: DataFrame, line: str = "line", head: str = "") -> DataFrame:
    """One row (content_sha256, n_lines, bytes) for the lines of a DataFrame in the order of its partitions and rows.

    ``bytes`` counts the UTF-8 bytes with a line break after each line. A NULL line counts as empty; without lines the digest is that of nothing. ``head``,
    a header line for instance, enters the root. A DataFrame whose row order is not fixed must be sorted first.
    """
    spark = lines.sparkSession
    path = scratch_path(spark, "fingerprint")
    number = F.monotonically_increasing_id()
    text = F.coalesce(F.col(line).cast("string"), F.lit(""))
    hashed = lines.select(
        F.shiftright(number, _POSITION_BITS).cast("int").alias("part"), number.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)).alias("at"),
        F.sha2(text, 256).alias("h"), F.octet_length(text).alias("size"),
    )
    # Stored once: where a line stands and where its partition begins must come from one run.
    hashed.write.parquet(path)
    stored = spark.read.parquet(path)
    sizes = stored.groupBy("part").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))  # a row for each partition
    starts = sizes.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("start"))
    total = sizes.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n_lines"), (F.coalesce(F.sum("bytes"), F.lit(0)) + F.coalesce(F.sum("n"), F.lit(0))).alias("bytes"))
    left = total.first()["n_lines"]
    level = stored.join(starts, "part").select((F.col("start") + F.col("at")).alias("i"), "h")
    levels = 0
    while left > 1 or levels < 2:
        ordered = F.sort_array(F.collect_list(F.struct((F.col("i") % FAN).alias("place"), "h")))
        level = level.groupBy(F.expr(f"i div {FAN}").alias("i")).agg(F.sha2(F.concat_ws("", ordered.getField("h")), 256).alias("h"))
        left, levels = -(-left // FAN), levels + 1
    root = level.agg(F.coalesce(F.max("h"), F.sha2(F.lit(""), 256)).alias("h"))
    return root.crossJoin(total).select(  # one row each
        (F.sha2(F.concat(F.lit(head + "\n"), "h"), 256) if head else F.col("h")).alias("content_sha256"), "n_lines", F.col("bytes").cast("long").alias("bytes"))


def file_digests(spark, path: str) -> DataFrame:
    """path, content_sha256, bytes of every file below ``path``: the plain SHA-256 of its bytes, each file in a task (2 GB at most, as Spark reads it).

    Spark reads no row from an empty file, so those have none here.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    return files.select("path", F.sha2("content", 256).alias("content_sha256"), F.col("length").alias("bytes"))
