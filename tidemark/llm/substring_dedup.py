"""Substring deduplication by de Bruijn compaction.

Runs of ``WINDOW`` words (k-mers) are the edges of a de Bruijn graph whose nodes
are their overlaps; a document is a path. An edge is repeated if it starts at
more than one place, and its source is the first of them (smallest document,
then smallest start). Every later place duplicates it.

1. *Whole paths.* Documents with the same words are one path; later copies are
   duplicates from end to end and take no further part.
2. *Anchors.* Of the ``ANCHOR``-word runs in a window, that with the smallest hash
   is its anchor. Equal windows have equal anchors, so a window whose anchor
   stands at one place only is not repeated. Neighbouring windows share
   anchors, so there are about eight times fewer of these than windows; they alone
   are counted over the whole corpus.
3. *Edges.* Windows with a repeated anchor become edges (hash, document, start). An
   aggregate gives the source of each, and a join brings it to its other places.
4. *Compaction.* Duplicated edges that follow one another in a document and whose
   sources follow one another too form a nonbranching path: one span with a
   source span.
5. *Verification.* Both spans are cut from the texts by their coordinates, and their
   words must be equal (SHA-256); only then are they removed.

The texts of step 3 to 5 come from one table bucketed by document, so joins with
what is known of a document never shuffle texts again. Groups: an anchor or edge
that very many documents share is reduced by partial aggregates first, and
its join partition can be split.

Defined cases: null text has no words; shorter documents than ``WINDOW`` words lose
nothing; repeated rows (one id, one text) count as copies of the first, in any order; rows with
one id and different texts are told apart by a hash of their words, the smaller first; a null id comes first;
empty tables give empty results; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, release_shuffles, stored, table, utf8
from tidemark.session import scratch_path

WINDOW = 20
ANCHOR = 6
_RNG = np.random.Generator(np.random.PCG64(20240302))
_STEP = _RNG.integers(0, 1 << 63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
EMPTY = hashlib.sha256(b"").hexdigest()


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def run_hashes(h: np.ndarray, size: int) -> np.ndarray:
    """A 64-bit hash of every run of ``size`` words."""
    n = max(0, len(h) - size + 1)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total += h[k : n + k] * _STEP[k]
    return _mixed(total)


def window_anchors(anchors: np.ndarray, span: int) -> np.ndarray:
    """The smallest of every ``span`` neighbouring values, by doubling."""
    low, width = anchors, 1
    while width < span:
        step = min(width, span - width)
        low = np.minimum(low[:-step], low[step:]) if len(low) > step else low[:0]
        width += step
    return low


def _anchors_of(h: np.ndarray) -> np.ndarray:
    """The anchor of each window."""
    return window_anchors(run_hashes(h, ANCHOR), WINDOW - ANCHOR + 1)


def _path_name(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


def _paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Number of words and a hash of them for every document; documents too short for a window with their words."""
    for batch in batches:
        words = [t.split() for t in utf8(batch.column(1))]
        yield pa.RecordBatch.from_pydict({
            "doc_id": batch.column(0), "n_words": pa.array([len(w) for w in words], pa.int64()),
            "path": pa.array([_path_name(w) for w in words], pa.binary()),
            "text": pa.array([b" ".join(w) if len(w) < WINDOW else None for w in words], pa.binary())})


def _path_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = utf8(batch.column(1))
        yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "path": pa.array([_path_name(t.split()) for t in texts], pa.binary()), "text": pa.array(texts, pa.binary())})


def _anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct anchors of each document; one that windows apart share counts twice, as it may repeat within."""
    with np.errstate(over="ignore"):
        for batch in batches:
            docs, values = [], []
            for doc, text in zip(batch.column(0).to_pylist(), utf8(batch.column(1))):
                h = word_hashes(text.split())
                if len(h) < WINDOW:
                    continue
                a = np.unique(_anchors_of(h))
                own = np.sort(run_hashes(h, ANCHOR))
                often = np.unique(own[1:][own[1:] == own[:-1]])
                docs += [doc] * (len(a) + len(again := np.intersect1d(a, often)))
                values += [a, again]
            out = np.concatenate(values) if values else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_pydict({"d": pa.array(docs, pa.int64()), "a": pa.array(out.view(np.int64), pa.int64())})


def _compacted(at: np.ndarray, source: np.ndarray, begin: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where nonbranching paths begin, and their numbers of edges: places and sources that follow one another."""
    new = np.flatnonzero(np.r_[True, (np.diff(at) != 1) | (np.diff(source) != 0) | (np.diff(begin) != 1)]) if len(at) else np.zeros(0, np.int64)
    return new, np.diff(np.r_[new, len(at)])


def _edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Windows with a repeated anchor, the first place of each in the document: e, at, and ``edges`` 0.

    Later places of a window in its own document are duplicates wherever else it stands; they come as spans already:
    at, from, edges, and no e.
    """
    with np.errstate(over="ignore"):
        for batch in batches:
            out = {k: [] for k in ("d", "e", "at", "from", "edges")}
            none = []
            for doc, text, anchors in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
                h = word_hashes(text.split())
                known = np.sort(np.array(anchors, np.int64).view(np.uint64))
                mine = _anchors_of(h)
                place = np.minimum(np.searchsorted(known, mine), len(known) - 1)
                at = np.flatnonzero(known[place] == mine)
                e = run_hashes(h, WINDOW)[at]
                _, low, back = np.unique(e, return_index=True, return_inverse=True)
                first = np.zeros(len(at), bool)
                first[low] = True
                again, source = at[~first], at[low][back][~first]
                new, edges = _compacted(again, np.zeros(len(again)), source)
                out["d"].append(np.full(len(low) + len(new), doc, np.int64))
                out["e"] += [e[first].view(np.int64), np.zeros(len(new), np.int64)]
                out["at"] += [at[first], again[new]]
                out["from"] += [np.zeros(len(low), np.int64), source[new]]
                out["edges"] += [np.zeros(len(low), np.int64), edges]
                none += [np.zeros(len(low), bool), np.ones(len(new), bool)]
            columns = {k: np.concatenate(v) if v else np.zeros(0, np.int64) for k, v in out.items()}
            yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.int64(), mask=np.concatenate(none) if none and k == "e" else None) for k, v in columns.items()})


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Duplicated edges of a document, compacted: start and number of edges, source document and start."""
    for batch in batches:
        out = {k: [] for k in ("d", "start", "edges", "source", "from")}
        for doc, places in zip(batch.column(0).to_pylist(), batch.column(1)):
            places = places.values
            at, source, begin = (places.field(k).to_numpy(zero_copy_only=False) for k in range(3))
            order = np.argsort(at, kind="stable")
            at, source, begin = at[order], source[order], begin[order]
            new, edges = _compacted(at, source, begin)
            out["d"].append(np.full(len(new), doc, np.int64))
            out["start"].append(at[new])
            out["edges"].append(edges)
            out["source"].append(source[new])
            out["from"].append(begin[new])
        yield pa.RecordBatch.from_pydict({k: pa.array(np.concatenate(v) if v else np.zeros(0, np.int64), pa.int64()) for k, v in out.items()})


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A digest of the words of each asked-for span."""
    for batch in batches:
        out = {"d": [], "start": [], "edges": [], "digest": []}
        for doc, text, spans in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), batch.column(2).to_pylist()):
            words = text.split()
            for s in spans:
                out["d"].append(doc)
                out["start"].append(s["start"])
                out["edges"].append(s["edges"])
                out["digest"].append(hashlib.sha256(b" ".join(words[s["start"] : s["start"] + s["edges"] + WINDOW - 1])).digest())
        yield pa.RecordBatch.from_pydict({k: pa.array(v, pa.binary() if k == "digest" else pa.int64()) for k, v in out.items()})


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What is left of each document."""
    for batch in batches:
        counts, texts = [], []
        for text, spans in zip(utf8(batch.column(1)), batch.column(2).to_pylist()):
            words = text.split()
            if spans:
                gone = np.zeros(len(words) + 1, np.int64)
                for s in spans:
                    gone[s["start"]] += 1
                    gone[s["start"] + s["edges"] + WINDOW - 1] -= 1
                left = np.flatnonzero(np.cumsum(gone)[:-1] == 0).tolist()
                counts.append(len(words) - len(left))
                words = [words[i] for i in left]
            else:
                counts.append(0)
            texts.append(b" ".join(words))
        yield pa.RecordBatch.from_pydict({"d": batch.column(0), "n_removed": pa.array(counts, pa.int64()), "text": pa.array(texts, pa.binary())})


def _bucketed(df: DataFrame, key: str, buckets: int, name: str) -> DataFrame:
    """``df`` written once as a table bucketed by ``key``, so that joins on it do not shuffle this side."""
    spark = df.sparkSession
    full = f"llm_{name}_{uuid.uuid4().hex[:12]}"
    df.repartition(buckets, key).write.bucketBy(buckets, key).option("path", scratch_path(spark, f"llm-{name}")).saveAsTable(full)
    return spark.table(full)


def repeated_edges(texts: DataFrame) -> DataFrame:
    """d, e, at, from, edges: windows that may be repeated (see ``_edges``); ``texts``: d, text, bucketed by d."""
    anchors = texts.select("d", "text").mapInArrow(_anchors, "d long, a long")
    often = anchors.groupBy("a").agg(F.count("*").alias("places")).where("places > 1").select("a")
    by_doc = stored(anchors.join(often, "a").groupBy("d").agg(F.collect_set("a").alias("anchors")), "sub-repeated")
    release_shuffles(texts.sparkSession)
    return texts.join(by_doc, "d").select("d", "text", "anchors").mapInArrow(_edges, "d long, e long, at long, `from` long, edges long")


def duplicate_spans(texts: DataFrame) -> DataFrame:
    """d, start, edges, source, from: verified spans of windows that start earlier too, at the source."""
    spark = texts.sparkSession
    edges = stored(repeated_edges(texts), "sub-edges")
    # One place of an edge in each document is enough to find its source and to tell whether it is later.
    single = edges.where("e is not null").select("d", "e", "at")
    sources = single.groupBy("e").agg(F.min(F.struct("d", "at")).alias("s"), F.count("*").alias("docs"))
    shared = sources.where("docs > 1").select("e", F.col("s.d").alias("source"), F.col("s.at").alias("from"))
    places = single.join(shared, "e").where("d <> source").groupBy("d").agg(F.collect_list(F.struct("at", "source", "from")).alias("places"))
    across = places.mapInArrow(_spans, "d long, start long, edges long, source long, `from` long")
    within = edges.where("e is null").select("d", F.col("at").alias("start"), "edges", F.col("d").alias("source"), "from")
    spans = stored(across.unionByName(within), "sub-spans")
    release_shuffles(spark)
    asked = spans.select("d", "start", "edges").unionByName(spans.select(F.col("source").alias("d"), F.col("from").alias("start"), "edges")).distinct()
    asked = asked.groupBy("d").agg(F.collect_list(F.struct("start", "edges")).alias("spans"))
    digests = stored(texts.join(asked, "d").select("d", "text", "spans").mapInArrow(_digests, "d long, start long, edges long, digest binary"), "sub-digests")
    theirs = digests.withColumnsRenamed({"d": "source", "start": "from", "digest": "there"})
    met = spans.join(digests, ["d", "start", "edges"]).join(theirs, ["source", "from", "edges"])
    return met.where("digest = there").select("d", "start", "edges", "source", "from")


def _first_texts(slim: DataFrame, paths: DataFrame, firsts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``texts`` (d, text) of the first document of each path, and ``names`` (d, doc_id, n_words); d sorts as ids do."""
    buckets = int(slim.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ids = paths.agg(F.count("*"), F.count("doc_id"), F.count_distinct("doc_id")).first()
    if ids[0] == ids[2]:  # every row has an id of its own
        names = firsts.select(F.col("first.doc_id").alias("d"), F.col("first.doc_id").alias("doc_id"), "n_words")
        texts = slim.withColumnRenamed("doc_id", "d").join(names.select("d"), "d", "left_semi")
        return _bucketed(texts, "d", buckets, "texts"), names
    # Ids are missing or repeated: number the paths in order of id, then of their hash.
    order = firsts.select(F.col("first.doc_id").alias("doc_id"), "path", "n_words").sort(F.col("doc_id").asc_nulls_first(), "path")
    names = stored(order.withColumn("d", F.monotonically_increasing_id()), "sub-names")
    hashed = slim.mapInArrow(_path_texts, "doc_id long, path binary, text binary")
    met = hashed.alias("t").join(names.alias("m"), F.expr("t.path = m.path and t.doc_id <=> m.doc_id"))
    texts = met.groupBy("d").agg(F.first(F.col("t.text").cast("string")).alias("text"))
    return _bucketed(texts, "d", buckets, "texts"), names.select("d", "doc_id", "n_words")


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digests: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and what is left of every document.

    What is left: ``text``, the words that stay joined by one space, or with ``digests`` only ``kept_sha256``.
    """
    spark = docs.sparkSession
    bounded_batches(spark, 512)
    left = F.sha2(F.col("text"), 256).alias("kept_sha256") if digests else F.col("text").cast("string").alias("text")
    name = "kept_sha256" if digests else "text"
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    paths = slim.mapInArrow(_paths, "doc_id long, n_words long, path binary, text binary")
    paths = stored(paths.withColumn("row", F.monotonically_increasing_id()), "sub-paths")
    long_paths = paths.where(f"n_words >= {WINDOW}")
    firsts = long_paths.groupBy("path", "n_words").agg(F.min(F.struct("doc_id", "row")).alias("first"))
    firsts = stored(firsts, "sub-firsts")
    texts, names = _first_texts(slim, paths, firsts)
    release_shuffles(spark)
    spans = duplicate_spans(texts).groupBy("d").agg(F.collect_list(F.struct("start", "edges")).alias("spans"))
    rest = texts.join(spans, "d", "left").select("d", "text", "spans").mapInArrow(_kept, "d long, n_removed long, text binary")
    first_rows = rest.select("d", "n_removed", left).join(names, "d").select("doc_id", "n_words", "n_removed", name)
    short = paths.where(f"n_words < {WINDOW}").select("doc_id", "n_words", F.lit(0).cast("long").alias("n_removed"), left)
    again = long_paths.join(firsts.select("path", F.col("first.row").alias("first")), "path").where("row <> first")
    copies = again.select("doc_id", "n_words", F.col("n_words").alias("n_removed"), F.lit(EMPTY if digests else "").alias(name))
    return first_rows.unionByName(short).unionByName(copies)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(table(spark, sf_dir, "documents"), digests=True)


ORACLE = r"""
WITH t AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM t WHERE len(w) >= 20),
k AS (SELECT doc_id, pos, md5_number(array_to_string(w[pos:pos + 19], ' ')) AS h FROM s),
d AS (SELECT doc_id, pos FROM k QUALIFY row_number() OVER (PARTITION BY h ORDER BY doc_id, pos) > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS i FROM d),
r AS (SELECT doc_id, count(*) AS n, list(i) AS gone FROM g GROUP BY doc_id),
p AS (SELECT doc_id, w, unnest(range(1, len(w) + 1)) AS i FROM t WHERE len(w) > 0),
l AS (SELECT p.doc_id, string_agg(p.w[p.i], ' ' ORDER BY p.i) AS left_text
      FROM p ANTI JOIN g ON g.doc_id = p.doc_id AND g.i = p.i GROUP BY p.doc_id)
SELECT t.doc_id, len(w) AS n_words, coalesce(r.n, 0) AS n_removed, sha256(coalesce(l.left_text, '')) AS kept_sha256
FROM t LEFT JOIN r USING (doc_id) LEFT JOIN l USING (doc_id)
"""
