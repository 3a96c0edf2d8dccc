"""N-gram Jaccard join: all texts whose shingle sets are similar, found in size-banded tiles of bitmap signatures.

Texts become sorted sets of 64-bit shingle hashes (``near_dedup.shingle_set``). Rows with equal sets are one class from the start;
a class has a number (of its stored row) and is told apart by 128 bits of a hash of its set.

*Lists.* Two sets with Jaccard similarity of ``percent`` share at least ``percent`` of the larger one, so they share one of the
first ``n - ceil(percent*n) + 1`` shingles of each in any order common to all. A class is listed under these only. The order is by
hash, with the shingles that more than ``HOT`` classes listed at first (a line or passage that many texts share) put last; classes that held
such a shingle are listed anew, from a spare of ``SPARE`` times as many shingles or, where that holds too many hot ones, from the
full set. What stays in long lists are texts made up mostly of shared passages.
*Contraction.* In each list every member is first compared with one pivot, the class that shares most; linked ones become one component.
Only members of different components are compared further, so groups of copies are not expanded.
*Tiles.* A short list is cut by size: a set meets those up to ``100/percent`` of its size. A long list is dealt to bands of sizes, each set to its own and
as a guest to the next, and a band to tiles of ``TILE`` by ``TILE`` sets; each tile is a task of its own. Texts in long lists have a leader, the pivot that shares most; texts of one
leader meet in the tiles of that leader, once, and only texts of different leaders in the tiles of the lists.
*Bitmaps.* A signature holds one bit for each residue of the shingles, set if an odd number of them falls there, so two
signatures differ in at most as many bits as the sets do: ``overlap <= (n + m - differing bits) / 2``. It has about ``n`` bits, ``HIGH_BITS`` at most,
and a wider one folds to a narrower one. Pairs that the bound rules out never become rows.
*Intersection.* The remaining pairs are confirmed on full sets, as the intersection of sorted arrays: pairs of short lists (at most ``HOT / 2`` for a row) by a
join, those of a tile of a long list inside the tile, to which the sets of the members that have such a pair are sent; it returns one link for two components.

All of it is exact: no link between two components is lost at any size of list. Quadratic work (as bitmap comparisons within tiles, not rows) is left in one case: a long list of texts
that share mostly hot passages but are not linked with its pivot.

Defined cases: null text and text without words give the empty set, linked with nothing, its own component; shorter texts are one
shingle; repeated rows and ids each get a row (a repeated id with other text is linked by its text, and named by its id); a null id gets
a component of what it is linked with, null if that has no id; rows without any id link others too; an empty table gives no row; a very long text is
one set, held whole by its task; other columns are not looked at.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, release_shuffles, stored, table, utf8
from tidemark.llm.components import components
from tidemark.llm.near_dedup import shingle_set

PERCENT = 80
HOT = 64
TILE = 256
SPARE = 2
LOW_BITS, HIGH_BITS = 64, 4096
TASK_ROWS = 8192
PAIRS = 1 << 19  # compared at once in a task


def prefix_length(n: int, percent: int) -> int:
    return n + (-percent * n // 100) + 1


def width(n: int) -> int:
    return min(HIGH_BITS, max(LOW_BITS, 1 << (n - 1).bit_length()))


def bitmap(shingles: np.ndarray) -> bytes:
    """One bit for each residue of the set, set where an odd number of shingles falls."""
    bits = width(len(shingles))
    odd = np.bincount((shingles & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(maps: list[bytes], bits: int) -> np.ndarray:
    """Signatures of at least ``bits`` bits as rows of 64-bit words, folded to ``bits``."""
    rows = np.zeros((len(maps), bits // 64), np.uint64)
    for size in {len(m) for m in maps}:
        at = [i for i, m in enumerate(maps) if len(m) == size]
        words = np.frombuffer(b"".join(maps[i] for i in at), np.uint64).reshape(len(at), -1, bits // 64)
        rows[at] = np.bitwise_xor.reduce(words, axis=1)
    return rows


def possible(n: np.ndarray, m: np.ndarray, differing: np.ndarray, percent: int) -> np.ndarray:
    """Whether the bound of the bit counts lets a pair of sizes n and m reach the similarity."""
    overlap = (n + m - differing.astype(np.int64)) // 2
    return 100 * overlap >= percent * (n + m - overlap)


def similar(one: np.ndarray, two: np.ndarray, percent: int) -> bool:
    """Exact, on sorted distinct arrays."""
    both = np.sort(np.concatenate([one, two]), kind="stable")  # merges the two sorted runs
    overlap = int((both[1:] == both[:-1]).sum())
    return 100 * overlap >= percent * (len(one) + len(two) - overlap)


def _name(shingles: np.ndarray) -> bytes:
    return xxhash.xxh3_128_digest(shingles.tobytes())


def _described(percent: int) -> Callable:
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                sets = [shingle_set(text) for text in utf8(batch.column(1))]
                keep = pa.array([len(s) > 0 for s in sets], pa.bool_())
                sets = [s for s in sets if len(s)]
                listed = [prefix_length(len(s), percent) for s in sets]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": batch.column(0).filter(keep), "row": batch.column(2).filter(keep), "n": pa.array(map(len, sets), pa.int64()),
                    "name": pa.array(map(_name, sets), pa.binary()), "listed": pa.array(listed, pa.int32()),
                    "first": pa.array([s[: SPARE * m].view(np.int64) for s, m in zip(sets, listed)], pa.list_(pa.int64())), "bits": pa.array(map(bitmap, sets), pa.binary())})

    return rows


def _named(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            sets = [shingle_set(text) for text in utf8(batch.column(1))]
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "n_shingles": pa.array(map(len, sets), pa.int64()), "name": pa.array(map(_name, sets), pa.binary())})


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    with np.errstate(over="ignore"):
        for batch in batches:
            sets = [shingle_set(text).view(np.int64) for text in utf8(batch.column(1))]
            yield pa.RecordBatch.from_pydict({"k": batch.column(0), "shingles": pa.array(sets, pa.list_(pa.int64()))})


def class_texts(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """k, text of the ``wanted`` (k) classes, from their first row; more than once if that row is repeated."""
    reps = classes.join(wanted, "k", "left_semi").select("k", "rep", F.col("row").alias("its"))
    return docs.join(reps, docs["doc_id"].eqNullSafe(reps["rep"]) & (docs["row"] == reps["its"])).select("k", "text")


def class_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame) -> DataFrame:
    """k, shingles (sorted) of the ``wanted`` (k) classes."""
    return class_texts(docs, classes, wanted).mapInArrow(_sets, "k long, shingles array<long>")


def _relisted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """k, n, listed, shingles (the first ones, or all), hot -> the first ``listed`` in the order that puts hot ones last; null if more are needed to know."""
    for batch in batches:
        out = []
        for n, m, shingles, hot in zip(*(batch.column(i) for i in (1, 2, 3, 4))):
            s = shingles.values.to_numpy().view(np.uint64)
            late = np.isin(s, hot.values.to_numpy().view(np.uint64)) if hot.is_valid else np.zeros(len(s), bool)
            known = len(s) == n.as_py() or (~late).sum() >= m.as_py()
            out.append(np.concatenate([s[~late], s[late]])[: m.as_py()].view(np.int64) if known else None)
        yield pa.RecordBatch.from_pydict({"k": batch.column(0), "first": pa.array(out, pa.list_(pa.int64()))})


def class_lists(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """h, k, size: every class under its first shingles that at least two classes list."""
    firsts = classes.select("k", F.slice("first", F.lit(1), F.col("listed")).alias("first"))
    posted = firsts.select("k", F.explode("first").alias("h"))
    hot = stored(posted.groupBy("h").agg(F.count("*").alias("n")).where(F.col("n") > HOT).select("h"), "join-hot")
    release_shuffles(docs.sparkSession)
    if not hot.isEmpty():
        touched = stored(posted.join(hot, "h", "left_semi").select("k").distinct(), "join-touched")

        def again(sets: DataFrame) -> DataFrame:
            held = sets.select("k", F.explode("shingles").alias("h")).join(hot, "h").groupBy("k").agg(F.collect_set("h").alias("hot"))  # of one text each
            return sets.join(held, "k", "left").select("k", "n", "listed", "shingles", "hot").mapInArrow(_relisted, "k long, first array<long>")

        spare = stored(again(classes.join(touched, "k", "left_semi").select("k", "n", "listed", F.col("first").alias("shingles"))), "join-firsts")
        deep = spare.where("first is null").select("k")
        whole = class_sets(docs, classes, deep).join(classes.select("k", "n", "listed"), "k").dropDuplicates(["k"])
        fresh = stored(spare.where("first is not null").unionByName(again(stored(whole, "join-deep"))), "join-firsts")
        firsts = firsts.join(touched, "k", "left_anti").unionByName(fresh)
        release_shuffles(docs.sparkSession)
    posted = firsts.select("k", F.explode("first").alias("h"))
    shared = posted.groupBy("h").agg(F.count("*").alias("size")).where("size > 1")
    return stored(posted.join(shared, "h").select("h", "k", "size"), "join-lists")


def _bounded(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the bitmaps do not rule out."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = (batch.column(i).to_numpy() for i in (2, 3))
            sizes = [[len(x) * 8 for x in batch.column(i).to_pylist()] for i in (4, 5)]
            bits = np.minimum(*np.array(sizes, np.int64).reshape(2, -1))
            keep = np.zeros(batch.num_rows, bool)
            for size in np.unique(bits):
                at = np.flatnonzero(bits == size)
                one, two = (folded(batch.column(i).take(pa.array(at)).to_pylist(), int(size)) for i in (4, 5))
                keep[at] = possible(n[at], m[at], np.bitwise_count(one ^ two).sum(axis=1), percent)
            keep &= (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
            yield batch.select([0, 1]).filter(pa.array(keep))

    one, two = (classes.select(F.col("k").alias(k), F.col("n").alias(f"n_{k}"), F.col("bits").alias(f"bits_{k}")) for k in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "n_a", "n_b", "bits_a", "bits_b").mapInArrow(rows, "a long, b long")


def _confirmed(pairs: DataFrame, docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar. Texts travel: they take less room than their sets."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                known, keep = {}, []  # a pivot meets many
                for a, b, x, y in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), utf8(batch.column(3))):
                    for k, text in ((a, x), (b, y)):
                        if k not in known:
                            known[k] = shingle_set(text)
                    keep.append(similar(known[a], known[b], percent))
                yield batch.select([0, 1]).filter(pa.array(keep, pa.bool_()))

    wanted = pairs.select(F.col("a").alias("k")).unionByName(pairs.select(F.col("b").alias("k"))).distinct()
    texts = stored(class_texts(docs, classes, wanted).dropDuplicates(["k"]), "join-texts")
    release_shuffles(docs.sparkSession)
    one, two = (texts.select(F.col("k").alias(k), F.col("text").alias(f"text_{k}")) for k in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "text_a", "text_b").mapInArrow(rows, "a long, b long")


def _met(tile: pd.DataFrame, percent: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Positions of the pairs of a tile (h, k, n, root, leader, bits, home, mine, i, j) that are to be confirmed; sorted by h and n."""
    h = np.unique(tile["h"].to_numpy(), return_inverse=True)[1]
    n, root, leader, home, mine = (tile[c].to_numpy() for c in ("n", "root", "leader", "home", "mine"))
    whole = (tile["i"] == tile["j"]).to_numpy()
    maps = list(tile["bits"])
    bits = np.array([8 * len(m) for m in maps])
    step = int(n.max()) * 100 // percent + 2
    key = h * step + n
    last = np.searchsorted(key, h * step + 100 * n // percent, "right")
    count = last - np.arange(len(tile)) - 1
    for size in np.unique(bits):
        rows = np.flatnonzero((bits >= size) & (bits <= 2 * size))
        words, place = folded([maps[r] for r in rows], int(size)), np.full(len(tile), -1)
        place[rows] = np.arange(len(rows))
        mine_here = np.flatnonzero(bits == size)
        ends = np.cumsum(count[mine_here])
        low = 0
        while low < len(mine_here):
            before = ends[low - 1] if low else 0
            high = max(low + 1, int(np.searchsorted(ends, before + PAIRS, "right")))
            some = mine_here[low:high]
            x = np.repeat(some, count[some])
            y = x + 1 + np.arange(len(x)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            fine = (root[x] != root[y]) & (leader[x] != leader[y]) & home[y] & (whole[x] | (mine[x] != mine[y]))
            x, y = x[fine], y[fine]
            fine = possible(n[x], n[y], np.bitwise_count(words[place[x]] ^ words[place[y]]).sum(axis=1), percent)
            yield x[fine], y[fine]
            low = high


_PAIRS = "a long, b long"
_MEMBERS = "k long, h long, band int, i long, j long, mine long, home boolean, root long, leader long"


def _paired(percent: int) -> Callable:
    """The pairs of whole short lists that remain."""

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values(["h", "n", "k"], kind="stable", ignore_index=True)
        k = tile["k"].to_numpy()
        found = [np.unique(np.sort(np.column_stack([k[x], k[y]]), axis=1), axis=0) for x, y in _met(tile, percent)]
        ids = np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)
        return pd.DataFrame({"a": ids[:, 0], "b": ids[:, 1]})

    return compare


def _remaining(percent: int) -> Callable:
    """The members of a tile that have a pair left."""

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values(["h", "n", "k"], kind="stable", ignore_index=True)
        left = np.zeros(len(tile), bool)
        for x, y in _met(tile, percent):
            left[x] = left[y] = True
        return tile.loc[left, [c.split()[0] for c in _MEMBERS.split(", ")]]

    return compare


def _intersected(percent: int) -> Callable:
    """One link for each two components with similar members in a tile."""

    def compare(tile: pd.DataFrame) -> pd.DataFrame:
        sets = [np.asarray(s, np.int64).view(np.uint64) for s in tile["shingles"]]
        tile = tile.assign(n=[len(s) for s in sets], bits=[bitmap(s) for s in sets], at=range(len(sets))).sort_values(["h", "n", "k"], kind="stable", ignore_index=True)
        k, root, at = (tile[c].to_numpy() for c in ("k", "root", "at"))
        linked, out = set(), []
        for x, y in _met(tile, percent):
            for p, q in zip(x, y):
                both = (min(root[p], root[q]), max(root[p], root[q]))
                if both not in linked and similar(sets[at[p]], sets[at[q]], percent):
                    linked.add(both)
                    out.append((k[p], k[q]))
        return pd.DataFrame(out, columns=["a", "b"], dtype="int64")

    return compare


def _tiles(members: DataFrame, percent: int) -> DataFrame:
    """Members (h, k, root, leader, n, bits) of long lists dealt to tiles (h, band, i, j)."""
    # A little wider than the similarity asks for, so that rounding cannot put linked sizes two bands apart.
    own = F.floor(F.log(F.col("n").cast("double")) / float(np.log(101 / percent))).cast("int")
    banded = members.withColumn("own", own).withColumn("band", F.explode(F.array("own", F.col("own") + 1))).withColumn("home", F.col("own") == F.col("band"))
    sizes = banded.groupBy("h", "band").agg(F.count("*").alias("in_band"), F.max("home").alias("any_home")).where("any_home and in_band > 1")
    sizes = sizes.select("h", "band", F.ceil(F.col("in_band") / TILE).cast("long").alias("blocks"))
    dealt = banded.join(sizes, ["h", "band"]).withColumn("mine", F.pmod(F.xxhash64("k"), "blocks"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    return dealt.select("h", "k", "root", "leader", "n", "bits", "band", "home", "mine", F.least("mine", "other").alias("i"), F.greatest("mine", "other").alias("j"))


def _long_links(placed: DataFrame, pivots: DataFrame, docs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """a, b: links between components of members of long lists. ``placed``: h, k, root of these; ``pivots``: h, p."""
    lead = placed.join(pivots, "h").groupBy("k").agg(F.max("p").getField("k").alias("leader"))
    led = stored(placed.join(lead, "k"), "join-led")
    sized = classes.select("k", "n", "bits")
    # All of one leader meet once; in a list, those of different leaders.
    of_leader = led.select(F.col("leader").alias("h"), "k", "root").distinct()
    differ = of_leader.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
    one = of_leader.join(differ, "h", "left_semi").join(sized, "k").withColumn("leader", F.col("k"))
    mixed = led.groupBy("h").agg(F.min("leader").alias("low"), F.max("leader").alias("high")).where("low < high").select("h")
    two = led.join(mixed, "h", "left_semi").join(sized, "k")
    found = None
    for members in (one, two):
        left = stored(_tiles(members, percent).groupBy("h", "band", "i", "j").applyInPandas(_remaining(percent), _MEMBERS), "join-remaining")
        sets = stored(class_sets(docs, classes, left.select("k").distinct()).dropDuplicates(["k"]), "join-sets")
        links = stored(left.join(sets, "k").groupBy("h", "band", "i", "j").applyInPandas(_intersected(percent), _PAIRS), "join-links")
        release_shuffles(docs.sparkSession)
        found = links if found is None else found.unionByName(links)
    return found


def class_components(docs: DataFrame, classes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """k, root for classes that are linked with others. ``classes``: k, rep, row, n, listed, first, bits; ``docs``: doc_id, text, row."""
    listed = class_lists(docs, classes)
    release_shuffles(docs.sparkSession)
    weights = listed.groupBy("k").agg(F.sum("size").alias("weight"))
    pivots = stored(listed.join(weights, "k").groupBy("h").agg(F.max(F.struct("weight", "k")).alias("p")), "join-pivots")
    star = listed.join(pivots, "h").where("k <> p.k").select(F.least("k", "p.k").alias("a"), F.greatest("k", "p.k").alias("b")).distinct()
    star = stored(_bounded(star, classes, percent), "join-star")
    release_shuffles(docs.sparkSession)
    links = stored(_confirmed(star, docs, classes, percent), "join-links")
    release_shuffles(docs.sparkSession)
    roots = stored(components(links), "join-roots")
    placed = listed.join(roots.withColumnRenamed("node", "k"), "k", "left").select("h", "k", "size", F.coalesce("root", "k").alias("root"))
    mixed = placed.groupBy("h").agg(F.min("root").alias("low"), F.max("root").alias("high")).where("low < high").select("h")
    placed = stored(placed.join(mixed, "h", "left_semi"), "join-placed")
    release_shuffles(docs.sparkSession)
    short = placed.where(F.col("size") <= HOT)
    tasks = short.count() // TASK_ROWS + 1
    whole = F.lit(0).cast("long")
    dealt = short.join(classes.select("k", "n", "bits"), "k").select(
        "h", "k", "root", F.col("k").alias("leader"), "n", "bits", F.lit(True).alias("home"), whole.alias("mine"), whole.alias("i"), whole.alias("j"), F.pmod(F.xxhash64("h"), F.lit(tasks)).alias("task"))
    pairs = dealt.groupBy("task").applyInPandas(_paired(percent), _PAIRS).distinct()
    pairs = stored(pairs.join(star, ["a", "b"], "left_anti"), "join-pairs")  # the pivots' pairs are known
    release_shuffles(docs.sparkSession)
    more = _confirmed(pairs, docs, classes, percent).unionByName(_long_links(placed.where(F.col("size") > HOT).drop("size"), pivots, docs, classes, percent))
    more = stored(more, "join-links")
    if more.isEmpty():
        return roots
    return stored(components(links.unionByName(more)), "join-roots")


def jaccard_components(docs: DataFrame, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id for every document."""
    bounded_batches(docs.sparkSession, 512)
    # A row is told from others with its id, or without one, by a hash of its text.
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("row", F.xxhash64("text"))
    described = slim.mapInArrow(_described(percent), "doc_id long, row long, n long, name binary, listed int, first array<long>, bits binary")
    lowest = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "row")).alias("lowest")
    classes = described.groupBy("name").agg(lowest, *(F.any_value(c).alias(c) for c in ("n", "listed", "first", "bits")))
    classes = stored(classes.select(F.monotonically_increasing_id().alias("k"), "name", F.col("lowest.doc_id").alias("rep"), F.col("lowest.row").alias("row"), "n", "listed", "first", "bits"), "join-classes")
    release_shuffles(docs.sparkSession)
    roots = class_components(slim, classes, percent)
    named = classes.select("k", "name", "rep").join(roots.withColumnRenamed("node", "k"), "k", "left").select("name", "rep", F.coalesce("root", "k").alias("root"))
    low = named.groupBy("root").agg(F.min("rep").alias("component_id"))
    place = named.join(low, "root").select("name", "component_id")
    rows = stored(slim.select("doc_id", "text").mapInArrow(_named, "doc_id long, n_shingles long, name binary"), "join-rows")
    linked = rows.where("n_shingles > 0").join(place, "name").select("doc_id", "n_shingles", "component_id")
    return linked.unionByName(rows.where("n_shingles = 0").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH RECURSIVE t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
         ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS g FROM t),
x AS (SELECT doc_id, md5_number(unnest(g)) AS h FROM s),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS met FROM x a JOIN x b ON a.h = b.h AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN s sa ON sa.doc_id = a JOIN s sb ON sb.doc_id = b
      WHERE 100 * met >= 80 * (len(sa.g) + len(sb.g) - met)),
r(doc_id, root) AS (SELECT doc_id, doc_id FROM s UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.doc_id WHERE r.root < e.b)
SELECT s.doc_id, len(s.g) AS n_shingles, least(s.doc_id, m.root) AS component_id
FROM s JOIN (SELECT doc_id, min(root) AS root FROM r GROUP BY doc_id) m USING (doc_id)
"""
