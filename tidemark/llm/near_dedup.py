"""MinHash near-duplicate detection by a signature-coordinate inverted join.

Texts become sets of shingles (``SHINGLE`` lower-cased words), and each distinct
set a signature of ``COORDINATES`` minima. A set is posted under each of its
(coordinate, value) pairs; two sets that agree in at least ``MATCHES`` of them
are candidates, which full sets then confirm.

*Prefix.* Values that one set alone has cannot collide and are dropped first.
A set's remaining values are ordered by how many sets share them, rarest first;
sets with fewer than ``MATCHES`` of them have no candidate. Two sets that agree
in ``MATCHES`` values meet in the first ``m - MATCHES + 1`` of their ``m``, so
only these are merged.
*Skip.* The other lists, the long ones among them, are never merged: whether
they hold a candidate is read off its signature.
*Threshold.* Sets with Jaccard similarity J agree in a coordinate with
probability J. At 0.75 and 64 coordinates fewer than 32 matches come with
probability below 1e-5, and at higher similarity far more rarely still.

Large groups are not expanded to pairs. In every list, members are first
compared with one pivot, the member whose values are shared most; what is
confirmed is contracted to components, and each class takes the pivot it collides with
that is shared most as its leader. What is left to compare are members of
*different* components. Under one leader they are compared in cells of ``CELL`` by
``CELL`` sets, each a small task that counts common shingles as a matrix product and
returns one link for each two components it finds linked. Members of different leaders meet in the lists.
So no link between components is lost, and no group's pairs become rows.

The same sets (and so all copies) are one class from the start. Classes are named by
64 bits of a hash of the set; shingles are compared as 64-bit hashes.

Defined cases: null text and text without words give the empty set, linked with
nothing, its own component; shorter texts are one shingle; repeated rows and ids
each get a row (a repeated id with other text is linked by its text, and named by its
id); a null id gets a component of what it is linked with, null if that has no id; rows without any id link others too;
empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, fresh_name, release_shuffles, stored, table, utf8
from tidemark.llm.components import components

SHINGLE = 5
COORDINATES = 64
MATCHES = 32
PERCENT = 75
CELL = 256
SMALL = 64
VOCABULARY = 4096
_RNG = np.random.Generator(np.random.PCG64(20240229))
_ODD = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_ADD = _RNG.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)
_STEP = _RNG.integers(0, 1 << 63, SHINGLE, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def shingle_set(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of a text; lower-cases A-Z only."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    n = len(h) - size + 1
    if n < 1:  # the whole sequence, told apart from others by its length
        total = np.uint64(len(h))
        for k in range(len(h)):
            total = _mixed(np.array([total + h[k] * _STEP[k % SHINGLE]], np.uint64))[0]
        return np.array([total], np.uint64)
    steps = _STEP if size == SHINGLE else _mixed(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    total = h[:n] * steps[0]
    for k in range(1, size):
        total += h[k : n + k] * steps[k]
    return np.unique(_mixed(total))


def signature(shingles: np.ndarray) -> np.ndarray:
    """The upper 32 bits of the minimum of each coordinate."""
    low = np.full(COORDINATES, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(shingles), 2048):
        part = shingles[i : i + 2048]
        np.minimum(low, (part[None, :] * _ODD[:, None] + _ADD[:, None]).min(axis=1), out=low)
    return (low >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            sizes, names, signs = [], [], []
            for text in utf8(batch.column(1)):
                s = shingle_set(text)
                sizes.append(len(s))
                names.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                signs.append(signature(s) if len(s) else None)
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column(0), "row": batch.column(2), "n": pa.array(sizes, pa.int64()), "c": pa.array(names, pa.int64()),
                "sign": pa.array(signs, pa.list_(pa.int32()))})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            names, sets = [], []
            for text in utf8(batch.column(0)):
                s = shingle_set(text)
                names.append(xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63))
                sets.append(s.view(np.int64))
            yield pa.RecordBatch.from_pydict({"c": pa.array(names, pa.int64()), "shingles": pa.array(sets, pa.list_(pa.int64()))})


def prefix_postings(classes: DataFrame, matches: int = MATCHES) -> DataFrame:
    """e, c, weight: the rarest (coordinate, value) pairs of each class that still have to be merged.

    ``classes``: c, sign. ``weight`` is how often the values of the class are shared, over all coordinates.
    """
    posted = classes.select("c", F.posexplode("sign")).select("c", (F.shiftleft(F.col("pos").cast("long"), 32) + F.col("col").cast("long").bitwiseAND(F.lit(0xFFFFFFFF).cast("long"))).alias("e"))
    shared = posted.groupBy("e").agg(F.count("*").alias("lists")).where("lists > 1")
    common = posted.join(shared, "e")
    # 64 values at most for each class
    by_class = common.groupBy("c").agg(F.sort_array(F.collect_list(F.struct("lists", "e"))).alias("values"), F.sum("lists").alias("weight")).where(F.size("values") >= matches)
    first = F.slice("values", F.lit(1), F.size("values") - (matches - 1))
    return by_class.select("c", "weight", F.explode(first.getField("e")).alias("e"))


def _collisions(pairs: DataFrame, classes: DataFrame, matches: int) -> DataFrame:
    """The pairs (a, b) whose signatures agree in at least ``matches`` coordinates."""
    signs = classes.select("c", "sign")
    met = pairs.join(signs.withColumnsRenamed({"c": "a", "sign": "sign_a"}), "a").join(signs.withColumnsRenamed({"c": "b", "sign": "sign_b"}), "b")
    agree = F.aggregate(F.zip_with("sign_a", "sign_b", lambda x, y: (x == y).cast("int")), F.lit(0), lambda s, x: s + x)
    return met.where(agree >= matches).select("a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    met = pairs.join(sets.withColumnsRenamed({"c": "a", "shingles": "set_a"}), "a").join(sets.withColumnsRenamed({"c": "b", "shingles": "set_b"}), "b")
    both = F.size(F.array_intersect("set_a", "set_b"))
    return met.select("a", "b", both.alias("both"), (F.size("set_a") + F.size("set_b") - both).alias("either")).where(F.col("both") * 100 >= F.col("either") * percent).select("a", "b")


def class_components(classes: DataFrame, docs: DataFrame, percent: int = PERCENT, matches: int = MATCHES) -> DataFrame:
    """c, root for classes that are linked with others.

    ``classes``: c, rep, row, sign; ``docs``: doc_id, text, row. The text of a class is that of its ``rep`` (null if no row of
    it has an id) and ``row``.
    """
    spark = classes.sparkSession
    postings = stored(prefix_postings(classes, matches), "near-postings")
    release_shuffles(spark)
    signs = stored(classes.join(postings.select("c").distinct(), "c", "left_semi"), "near-signs")
    reps = signs.select("rep", F.col("row").alias("of"))
    needed = docs.join(reps, docs["doc_id"].eqNullSafe(reps["rep"]) & (docs["row"] == reps["of"]), "left_semi").select("text")
    sets = stored(needed.mapInArrow(_sets, "c long, shingles array<long>").dropDuplicates(["c"]), "near-sets")
    release_shuffles(spark)
    pivots = postings.groupBy("e").agg(F.max(F.struct("weight", "c")).alias("p"), F.count("*").alias("listed")).where("listed > 1")
    star = postings.join(pivots, "e").where("c <> p.c").select(F.col("c").alias("a"), F.col("p.c").alias("b")).distinct()
    star = stored(_collisions(star, signs, matches), "near-star")
    links = stored(_confirmed(star, sets, percent), "near-links")
    roots = stored(components(links), "near-roots")
    placed = postings.join(roots.withColumnRenamed("node", "c"), "c", "left").select("e", "c", F.coalesce("root", "c").alias("root"))
    placed = stored(placed.join(_leaders(star, postings), "c", "left").withColumn("leader", F.coalesce("leader", "c")), "near-placed")
    # Lists whose members are not all in one component, of members of different leaders.
    mixed = placed.groupBy("e").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min("leader").alias("one"), F.max("leader").alias("other"))
    open_lists = placed.join(mixed.where("low < high and one < other").select("e"), "e", "left_semi")
    x, y = (open_lists.withColumnsRenamed({"c": k, "root": f"root_{k}", "leader": f"leader_{k}"}) for k in "ab")
    across = x.join(y, "e").where("a < b and root_a <> root_b and leader_a <> leader_b").select("a", "b").distinct()
    across = _confirmed(_collisions(across, signs, matches), sets, percent)
    more = stored(across.unionByName(_cell_links(placed.select("c", "root", "leader").distinct(), sets, percent)), "near-links")
    if more.isEmpty():
        return roots
    return stored(components(links.unionByName(more)), "near-roots")


def _leaders(star: DataFrame, postings: DataFrame, hops: int = 3) -> DataFrame:
    """c, leader: the colliding pivot whose values are shared most, or its leader, a few hops up."""
    weights = postings.select(F.col("c").alias("b"), "weight").distinct()
    up = stored(star.join(weights, "b").groupBy(F.col("a").alias("c")).agg(F.max_by("b", F.struct("weight", "b")).alias("leader")), "near-leaders")
    for _ in range(hops - 1):
        top = up.select(F.col("c").alias("leader"), F.col("leader").alias("top"))
        up = stored(up.join(top, "leader", "left").select("c", F.coalesce("top", "leader").alias("leader")), "near-leaders")
    return up


def _linked(one: pd.DataFrame, two: pd.DataFrame, percent: int) -> list[tuple[int, int]]:
    """One link for each two components with linked members in ``one`` and ``two`` (c, root, shingles)."""
    sets = [*one["shingles"], *two["shingles"]]
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    values, at, count = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = (count > 1)[at]
    owner, at = owner[shared], (np.cumsum(count > 1) - 1)[at[shared]]
    n, both = len(one), np.zeros((len(one), len(two)))
    order = np.argsort(at, kind="stable")
    owner, at = owner[order], at[order]
    for low in range(0, int(at[-1]) + 1 if len(at) else 0, VOCABULARY):
        s = slice(*np.searchsorted(at, [low, low + VOCABULARY]))
        has = np.zeros((len(sets), VOCABULARY), np.float32)
        has[owner[s], at[s] - low] = 1
        both += has[:n] @ has[n:].T
    roots_1, roots_2 = one["root"].to_numpy(), two["root"].to_numpy()
    enough = 100 * both >= percent * (sizes[:n, None] + sizes[None, n:] - both)
    i, j = np.nonzero(enough & (roots_1[:, None] != roots_2[None, :]))
    pairs = np.sort(np.column_stack([roots_1[i], roots_2[j]]), axis=1)
    return [tuple(p) for p in np.unique(pairs, axis=0).tolist()]


def _cell_links(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """a, b: links between components (by their roots) of members of one leader. ``members``: c, root, leader."""
    groups = members.groupBy("leader").agg(F.count("*").alias("n"), F.min("root").alias("low"), F.max("root").alias("high")).where("low < high")
    met = members.join(groups.select("leader", "n"), "leader")
    blocks = F.ceil(F.col("n") / CELL).cast("long")
    mine = met.withColumn("mine", F.when(F.col("n") > SMALL, F.pmod(F.xxhash64("c"), blocks)).otherwise(0)).withColumn(
        "theirs", F.explode(F.when(F.col("n") > SMALL, F.sequence(F.lit(0).cast("long"), blocks - 1)).otherwise(F.array(F.lit(0).cast("long")))))
    cells = mine.select("c", "root", "leader", "mine", F.least("mine", "theirs").alias("i"), F.greatest("mine", "theirs").alias("j"), (F.col("n") <= SMALL).alias("small"))
    # Small groups share a task, some hundred sets in each.
    tasks = F.lit(max(1, groups.where(F.col("n") <= SMALL).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0] // 256))
    cells = cells.withColumn("task", F.when(F.col("small"), F.pmod(F.xxhash64("leader"), tasks)).otherwise(F.col("leader")))

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        out = []
        for (_, i, j), cell in group.groupby(["leader", "i", "j"]):
            sides = (cell, cell) if i == j else (cell[cell["mine"] == i], cell[cell["mine"] == j])
            if len(sides[0]) and len(sides[1]) and cell["root"].nunique() > 1:
                out += _linked(*sides, percent)
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return cells.join(sets, "c").groupBy("small", "task", "i", "j").applyInPandas(compare, "a long, b long")


def near_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, matches: int = MATCHES) -> DataFrame:
    """doc_id, n_shingles, component_id, kept for every document; then ``c``, the name of its set, ``root``, that of its component (null without words), and ``row``."""
    bounded_batches(docs.sparkSession, 512)
    # A row is told from others with its id, or without one, by a hash of its text.
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("row", F.xxhash64("text"))
    signed = stored(slim.mapInArrow(_sign, "doc_id long, row long, n long, c long, sign array<int>"), "near-signed")
    some = signed.where("n > 0")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row"))
    classes = some.groupBy("c").agg(first.alias("first"), F.any_value("sign").alias("sign"))
    classes = stored(classes.select("c", F.col("first.doc_id").alias("rep"), F.col("first.row").alias("row"), "sign"), "near-classes")
    release_shuffles(docs.sparkSession)
    roots = class_components(classes, slim, percent, matches)
    named = classes.select("c", "rep").join(roots.withColumnRenamed("node", "c"), "c", "left").select("c", "rep", F.coalesce("root", "c").alias("root"))
    low = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    place = named.join(low, "root").select("c", "root", "component_id")
    linked = some.select("doc_id", "row", "n", "c").join(place, "c").select("doc_id", F.col("n").alias("n_shingles"), "component_id", "c", "root", "row")
    empty = signed.where("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"), "c", F.lit(None).cast("long").alias("root"), "row")
    return linked.unionByName(empty).select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"), "c", "root", "row")


def near_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each group, all columns: of the rows with the smallest id (or without any) one; a document without words
    is its own group, of whose equal rows one stays."""
    groups = stored(near_groups(docs, id_col, text_col), "near-groups")
    name, row = fresh_name(docs, "gone"), fresh_name(docs, "row_hash")
    rows = groups.groupBy("doc_id", "row", "root").agg(F.count("*").alias("times"))
    first = rows.where("root is not null").groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("first"))
    first = first.select(F.col("first.doc_id").alias("id"), F.col("first.row").alias("its"))
    same = F.col("doc_id").eqNullSafe(F.col("id")) & (F.col("row") == F.col("its"))
    gone = rows.where("root is not null").join(first, same, "left_anti").select(F.col("doc_id").alias(name), F.col("row").alias(row))

    def met(frame: DataFrame, keys: DataFrame, how: str) -> DataFrame:
        return frame.join(keys, frame[id_col].cast("long").eqNullSafe(keys[name]) & (F.xxhash64(frame[text_col].cast("string")) == keys[row]), how)

    left = met(docs, gone, "left_anti")
    twice = stored(rows.where("times > 1").select(F.col("doc_id").alias(name), F.col("row").alias(row)), "near-twice")
    if twice.isEmpty():
        return left
    copies = met(left, twice, "left_semi")
    whole = fresh_name(docs, "whole_row")
    kept = copies.groupBy(id_col, text_col).agg(F.max(F.struct(*docs.columns)).alias(whole)).select(f"{whole}.*")
    return met(left, twice, "left_anti").unionByName(kept)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_groups(table(spark, sf_dir, "documents")).drop("c", "root", "row")


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t),
x AS (SELECT doc_id, md5_number(unnest(g)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
      WHERE 100 * met >= 75 * (len(sa.g) + len(sb.g) - met)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b)
SELECT s.doc_id, len(s.g) AS n_shingles, least(s.doc_id, m.root) AS component_id, s.doc_id = least(s.doc_id, m.root) AS kept
FROM s JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) m USING (doc_id)
"""
