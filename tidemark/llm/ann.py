"""Approximate nearest neighbours by an adaptive dimension scan of probed lists.

Largest inner product becomes smallest distance by one more dimension,
sqrt(M**2 - |x|**2) with M the largest norm (0 for queries). The vectors are then
rotated by a random orthogonal matrix, so that any leading dimensions are a
fair sample of a distance.

*Lists.* A k-means over a bounded sample (``SAMPLE`` vectors) gives the centres;
every vector is put in the list of its nearest. A query probes the ``probe`` share
of the lists that are nearest.
*Scan.* Within a list, vectors are stored in blocks of columns. A candidate is
scanned block by block; after each, the partial distance, scaled up to all
dimensions, is tested against the query's distance to beat: if it is larger
by more than chance allows (``EPSILON``), the candidate is abandoned. The test never
hits those near enough with noticeable probability; what is left gets its exact
inner product in double precision over the original vector.

Lists are cut into cells of about ``CELL`` vectors, and their queries into cells of
``QUERY_CELL``, each pair of cells one small task, so a list that holds a third of
all vectors is spread. The distance to beat comes from a first pass over each query's
nearest list, by one cell of it. Nothing but sample, centres and rotation
(``SAMPLE`` vectors at most) reaches the driver.

Defined cases: vectors that are null, zero, hold null or non-finite
components, or have another length than most (ties: the longer) take no part, as query or as
candidate; repeated ids are candidates of each other's but not of their own id; equal scores are
ranked by the smaller id; fewer candidates than k give fewer rows; an empty
table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

SAMPLE = 16_384
CELL = 4_096
QUERY_CELL = 512
BLOCK = 16
EPSILON = 2.1
SEED = 20240307


@dataclass
class Index:
    """What every task needs: centres and rotation (bounded by SAMPLE), and the largest norm."""

    centres: np.ndarray
    rotation: np.ndarray
    norm: float


def valid_vectors(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """vec_id, v (array of double): the vectors that take part."""
    v = F.col("v")
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = rows.where("vec_id is not null and v is not null and size(v) > 0").where(
        F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False))) & F.exists(v, lambda x: x != 0))
    length = fine.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).first()
    return fine.where(F.size("v") == (length["n"] if length else 0))


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 1))


def fit(valid: DataFrame, lists: int | None = None) -> Index | None:
    """Centres and rotation from a bounded sample, lowest hashes of the id first; None for no vectors."""
    norm2 = F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x)
    total, largest = valid.agg(F.count("*"), F.max(norm2)).first()
    if not total:
        return None
    rows = valid.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("v").collect()
    x = np.array([r["v"] for r in rows], float)
    norm = float(np.sqrt(largest))
    rng = np.random.Generator(np.random.PCG64(SEED))
    d = x.shape[1] + 1
    rotation = np.linalg.qr(rng.standard_normal((d, d)))[0]
    z = augmented(x, norm) @ rotation
    k = lists or max(1, min(1024, int(np.sqrt(total) / 2)))
    k = min(k, len(z))
    centres = z[rng.choice(len(z), k, replace=False)]
    for _ in range(8):
        near = nearest_lists(z, centres, 1)[:, 0]
        sums, counts = np.zeros_like(centres), np.bincount(near, minlength=k)
        np.add.at(sums, near, z)
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return Index(centres, rotation, norm)


def augmented(x: np.ndarray, norm: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(norm * norm - (x * x).sum(axis=1), 0.0))])


def nearest_lists(z: np.ndarray, centres: np.ndarray, n: int) -> np.ndarray:
    """The ``n`` nearest centres of each row, nearest first."""
    far = (centres * centres).sum(axis=1) - 2 * z @ centres.T
    if n >= len(centres):
        return np.argsort(far, axis=1, kind="stable")
    some = np.argpartition(far, n - 1, axis=1)[:, :n]
    return np.take_along_axis(some, np.argsort(np.take_along_axis(far, some, 1), axis=1, kind="stable"), 1)


def _rotated(index: Index):
    """vec_id, v, z, list of candidates."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            z = augmented(_matrix(b.column(1)), index.norm) @ index.rotation
            near = nearest_lists(z, index.centres, 1)[:, 0]
            yield pa.RecordBatch.from_pydict({"vec_id": b.column(0), "v": b.column(1), "list": pa.array(near, pa.int32())})

    return rows


def _probes(index: Index, probe: int):
    """vec_id, v, list, place of queries: one row for each list to probe."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if not b.num_rows:
                continue
            x = _matrix(b.column(1))
            z = np.column_stack([x, np.zeros(len(x))]) @ index.rotation
            near = nearest_lists(z, index.centres, probe)
            ids = b.column(0).to_numpy()
            yield pa.RecordBatch.from_pydict({
                "query_id": pa.array(np.repeat(ids, near.shape[1]), pa.int64()), "list": pa.array(near.ravel(), pa.int32()),
                "place": pa.array(np.tile(np.arange(near.shape[1]), len(ids)), pa.int32())})

    return rows


def scan(queries: np.ndarray, candidates: np.ndarray, limits: np.ndarray) -> np.ndarray:
    """Adaptive scan: which (query, candidate) pairs survive every test of their partial distances.

    Rows are rotated vectors; ``limits`` are squared distances to beat.
    """
    d = queries.shape[1]
    alive_q, alive_c = np.divmod(np.arange(len(queries) * len(candidates)), len(candidates))
    partial = np.zeros(len(alive_q))
    for start in range(0, d, BLOCK):
        end = min(start + BLOCK, d)
        q, c = queries[:, start:end], candidates[:, start:end]
        if start == 0:
            partial = ((q * q).sum(axis=1)[:, None] + (c * c).sum(axis=1)[None, :] - 2 * q @ c.T).ravel()
        else:
            gap = q[alive_q] - c[alive_c]
            partial = partial + (gap * gap).sum(axis=1)
        slack = (1 + EPSILON / np.sqrt(end)) ** 2 if end < d else 1 + 1e-9
        stay = partial * (d / end) <= limits[alive_q] * slack + 1e-9
        alive_q, alive_c, partial = alive_q[stay], alive_c[stay], partial[stay]
        if not len(alive_q):
            break
    return alive_q, alive_c


def _search(index: Index, k: int):
    """Best k of one cell of candidates for one cell of queries."""

    def cell(key: tuple, queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"query_id": pd.Series(dtype="int64"), "vec_id": pd.Series(dtype="int64"), "score": pd.Series(dtype="float64")})
        if not len(queries) or not len(candidates):
            return none
        q, x = np.vstack(queries["v"].to_numpy()).astype(float), np.vstack(candidates["x"].to_numpy()).astype(float)
        ids, own = candidates["vec_id"].to_numpy(), queries["query_id"].to_numpy()
        zq, zx = np.column_stack([q, np.zeros(len(q))]) @ index.rotation, augmented(x, index.norm) @ index.rotation
        # score to beat -> squared distance: |q|^2 + M^2 - 2 score
        beat = queries["beat"].to_numpy(float)
        limits = np.where(np.isnan(beat), np.inf, (q * q).sum(axis=1) + index.norm**2 - 2 * beat)
        out = []
        for s in range(0, len(q), 64):
            at_q, at_c = scan(zq[s : s + 64], zx, limits[s : s + 64])
            at_q = at_q + s
            other = ids[at_c] != own[at_q]
            at_q, at_c = at_q[other], at_c[other]
            score = np.einsum("ij,ij->i", q[at_q], x[at_c])
            order = np.lexsort((ids[at_c], -score, at_q))
            at_q, at_c, score = at_q[order], at_c[order], score[order]
            first = np.searchsorted(at_q, at_q, "left")
            best = np.arange(len(at_q)) - first < k
            out.append(pd.DataFrame({"query_id": own[at_q[best]], "vec_id": ids[at_c[best]], "score": score[best]}))
        return pd.concat(out) if out else none

    return cell


def _ranked(found: DataFrame, k: int) -> DataFrame:
    """The k best of each query by partial aggregates of at most k rows each."""
    from pyspark.sql import Window

    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, queries: Column, k: int = 20, probe: float = 0.85, lists: int | None = None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """query_id, rank, vec_id, score: the k best found for each row for which ``queries`` (of ``vec_id``) holds.

    ``probe`` is the share of the lists that a query probes, ``lists`` their number (default: half the root of the
    number of vectors, 1024 at most).
    """
    spark = vectors.sparkSession
    empty = "query_id long, rank int, vec_id long, score double"
    valid = stored(valid_vectors(vectors, id_col, vector_col), "ann-valid")
    index = fit(valid, lists)
    if index is None:
        return spark.createDataFrame([], empty)
    n_probe = max(1, int(np.ceil(probe * len(index.centres))))
    listed = stored(valid.mapInArrow(_rotated(index), "vec_id long, v array<double>, list int"), "ann-lists")
    asked = listed.where(queries).select(F.col("vec_id").alias("query_id"), "v")
    sizes = listed.groupBy("list").agg(F.count("*").alias("n")).select("list", (F.ceil(F.col("n") / CELL)).cast("long").alias("cells"))
    cells = listed.join(F.broadcast(sizes), "list").withColumn("cell", F.pmod(F.xxhash64("vec_id"), "cells"))  # at most 1024 rows
    probes = asked.mapInArrow(_probes(index, n_probe), "query_id long, list int, place int")
    n_queries = F.lit(max(1, asked.count() // QUERY_CELL + 1))
    probes = stored(probes.join(F.broadcast(sizes), "list").withColumn("part", F.pmod(F.xxhash64("query_id"), n_queries)), "ann-probes")

    def scanned(chosen: DataFrame, beat: DataFrame | None) -> DataFrame:
        met = chosen.join(asked, "query_id")
        met = met.withColumn("beat", F.lit(None).cast("double")) if beat is None else met.join(beat, "query_id", "left")
        left = met.select("query_id", "v", "list", "cell", "part", "beat")
        parts = left.select("list", "cell", "part").distinct()
        right = cells.join(parts, ["list", "cell"]).select("vec_id", "v", "list", "cell", "part").toDF("vec_id", "x", "x_list", "x_cell", "x_part")
        return left.groupBy("list", "cell", "part").cogroup(right.groupBy("x_list", "x_cell", "x_part")).applyInPandas(_search(index, k), "query_id long, vec_id long, score double")

    home = probes.where("place = 0").withColumn("cell", F.pmod(F.xxhash64("query_id"), "cells"))
    first = stored(scanned(home, None), "ann-first")
    beat = first.groupBy("query_id").agg(F.min("score").alias("beat"), F.count("*").alias("n")).where(F.col("n") >= k).select("query_id", "beat")
    every = probes.withColumn("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)))
    rest = every.where("place > 0 or cell <> pmod(xxhash64(query_id), cells)")
    found = stored(first.unionByName(scanned(rest, beat)), "ann-found")
    return _ranked(found, k)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)
