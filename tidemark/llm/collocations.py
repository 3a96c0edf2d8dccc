"""Phrase collocations from sorted count streams.

*Counting.* Phrases of 1 to ``WORDS`` words are counted length by length. A phrase can only reach ``LEAST``
occurrences if both phrases one word shorter inside it do, so a task looks only at places where a bitmap of the
frequent shorter phrases lets both through. The bitmap has 2 hashed bits for each phrase and grows with their number up
to ``FILTER_BITS``; it has false positives only, and every phrase it lets through is counted exactly, as a string, by a
partial and a final aggregate. A fuller bitmap lets more rows into the count, never fewer.

*Streams.* The frequent phrases of all lengths become one stream of counts, ranged and sorted by their words: first
from the last word backwards (suffix order), then from the first word (prefix order). In such an order a phrase
follows the phrases it begins with, so one pass that keeps the open path (at most ``WORDS`` rows) in lockstep with the
stream meets the counts of all parts and the largest count one word longer. No table of phrases is built or hashed.
The suffix pass gives every phrase the counts of its last words and its left extension; these ride along into the
prefix pass, which adds the first words and the right extension. A range of the stream can begin inside a path: its
splitters are fixed beforehand, and the at most ``WORDS - 1`` phrases that are open at each are sent to every range they reach
into. What they meet there is folded back by a join with these few rows.

A phrase that lies inside a longer candidate lies inside one that is one word longer and at least as frequent, so the
two extensions decide whether it is dropped.

Defined cases: null and empty texts have no words; a null language is ``und``; repeated rows and ids count each time; ties go by
phrase; an empty table gives no row; a very long text is read in pieces of ``CHUNK`` bytes with the last words carried
over; other columns are not looked at.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, release_shuffles, stored, table, utf8

WORDS = 4
LEAST = 30
TOP = 2000
FACTOR = 2_000_000
INSIDE_PERCENT = 80
NO_LANG = "und"
CHUNK = 1 << 22
BUFFER = 1 << 20  # words counted together in a task
ITEM_BITS = 16
FILTER_BITS = 1 << 28
RANGE_ROWS = 250_000
BUCKET = 32_768  # bits of one bitmap of Spark's bitmap aggregate
_BREAK = b"\xff"  # in no UTF-8 text
_TABLE = bytes(255 if x in b".,;:!?\x0a\x0b\x0c\x0d" else x + 32 if 65 <= x <= 90 else 32 if x == 9 else x for x in range(256))
_STEPS = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]


def tokens(text: bytes, keep: int = 0) -> Iterator[list[bytes]]:
    """The words of a text in lists, with ``_BREAK`` between pieces; each list but the first begins with the ``keep`` last of the one before."""
    last: list[bytes] = []
    at = 0
    while at < len(text):
        end = min(len(text), at + CHUNK)
        if end < len(text):  # a word is never cut
            blank = re.compile(rb"[ \t]").search(text, end)
            end = blank.start() if blank else len(text)
        found = last + text[at:end].translate(_TABLE).replace(_BREAK, b" \xff ").split()
        yield found
        last, at = found[max(0, len(found) - keep) :] if keep else [], end


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return h ^ (h >> np.uint64(29))


def _phrase_hash(lang: bytes, words: list[np.ndarray]) -> np.ndarray:
    total = np.full(len(words[0]), xxhash.xxh3_64_intdigest(lang), np.uint64)
    for word, step in zip(words, _STEPS):
        total = _mixed(total + word * step)
    return total


def _positions(h: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
    mask = np.uint64(bits - 1)
    return (h & mask).astype(np.int64), ((h >> np.uint64(32)) & mask).astype(np.int64)


class _Buffer:
    """Word numbers of the texts of one task, counted when ``BUFFER`` words are there."""

    def __init__(self, size: int, passed: np.ndarray | None):
        self.size, self.passed = size, passed
        self.clear()

    def clear(self) -> None:
        self.numbers: dict[bytes, int] = defaultdict()
        self.numbers.default_factory = self.numbers.__len__
        self.numbers[_BREAK]  # number 0
        self.langs: dict[bytes, list[np.ndarray]] = {}
        self.held = 0

    def add(self, lang: bytes, found: list[bytes]) -> None:
        ids = np.fromiter(map(self.numbers.__getitem__, found), np.int64, len(found))
        self.langs.setdefault(lang, []).extend((ids, np.zeros(1, np.int64)))
        self.held += len(found)

    def rows(self) -> Iterator[pa.RecordBatch]:
        words = list(self.numbers)
        names = pa.array([b"" if w == _BREAK else w for w in words], pa.binary())
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        for lang, parts in self.langs.items():
            ids = np.concatenate(parts)
            at = self.places(lang, ids, hashes)
            if not len(at):
                continue
            code, columns = ids[at], [ids[at]]
            for k in range(1, self.size):
                columns.append(ids[at + k])
                code = np.unique(code, return_inverse=True)[1] * len(words) + columns[-1]
            _, first, count = np.unique(code, return_index=True, return_counts=True)
            text = [names.take(pa.array(c[first])) for c in columns]
            phrase = pc.binary_join_element_wise(*text, pa.scalar(b" ", pa.binary())) if self.size > 1 else text[0]
            for i in range(0, len(first), 65_536):
                s = slice(i, i + 65_536)
                n = len(first[s])
                yield pa.RecordBatch.from_pydict({
                    "lang": pa.array([lang] * n, pa.binary()).cast(pa.string()), "phrase": phrase[s].cast(pa.string()), "n": pa.array(count[s], pa.int64())})

    def places(self, lang: bytes, ids: np.ndarray, hashes: np.ndarray) -> np.ndarray:
        """Where phrases of ``size`` words begin whose two shorter phrases may be frequent."""
        size = self.size
        if len(ids) < size:
            return np.zeros(0, np.int64)
        word = ids > 0
        if size == 1:
            return np.flatnonzero(word)
        n = len(ids) - size + 2  # shorter phrases
        whole = np.logical_and.reduce([word[k : k + n] for k in range(size - 1)])
        at = np.flatnonzero(whole)
        one, two = _positions(_phrase_hash(lang, [hashes[ids[at + k]] for k in range(size - 1)]), 8 * len(self.passed))
        bit = lambda p: (self.passed[p >> 3] >> (p & 7).astype(np.uint8)) & 1
        whole[at] = (bit(one) & bit(two)).astype(bool)
        return np.flatnonzero(whole[:-1] & whole[1:])


def _counter(size: int, passed) -> Callable:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            held = _Buffer(size, None if passed is None else passed.value)
            for batch in batches:
                for lang, text in zip(utf8(batch.column(0)), utf8(batch.column(1))):
                    for found in tokens(text, size - 1):
                        held.add(lang, found)
                        if held.held >= BUFFER:
                            yield from held.rows()
                            held.clear()
            yield from held.rows()

    return count


def _bitmap(frequent: DataFrame):
    """A broadcast bitmap of frequent phrases (lang, phrase), None if there are none: ``ITEM_BITS`` bits each, a power of two, ``FILTER_BITS`` at most."""
    spark = frequent.sparkSession
    n = frequent.count()
    if not n:
        return None
    bits = min(FILTER_BITS, max(BUCKET, 1 << (ITEM_BITS * n - 1).bit_length()))

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        with np.errstate(over="ignore"):
            for batch in batches:
                out = []
                for lang, phrase in zip(utf8(batch.column(0)), utf8(batch.column(1))):
                    words = [np.array([xxhash.xxh3_64_intdigest(w)], np.uint64) for w in phrase.split(b" ")]
                    out += [int(p[0]) + 1 for p in _positions(_phrase_hash(lang, words), bits)]
                yield pa.RecordBatch.from_pydict({"place": pa.array(out, pa.int64())})

    placed = frequent.select("lang", "phrase").mapInArrow(places, "place long")
    maps = placed.groupBy(F.bitmap_bucket_number("place").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("place")).alias("bits")).toArrow()
    passed = np.zeros(bits // 8, np.uint8)
    for bucket, part in zip(maps["bucket"].to_pylist(), maps["bits"].to_pylist()):
        passed[(bucket - 1) * BUCKET // 8 :][: len(part)] = np.frombuffer(part, np.uint8)
    return spark.sparkContext.broadcast(passed)


def phrase_counts(docs: DataFrame, words: int = WORDS, least: int = LEAST, lang_col: str = "lang", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(lang, phrase, a) of the phrases of 1 to ``words`` words with at least ``least`` occurrences, and (lang, n) of all words."""
    spark = docs.sparkSession
    bounded_batches(spark, 512)
    slim = docs.select(F.coalesce(F.col(lang_col).cast("string"), F.lit(NO_LANG)).alias("lang"), F.col(text_col).cast("string").alias("text"))
    found, totals, passed = [], None, None
    for size in range(1, words + 1):
        counted = slim.mapInArrow(_counter(size, passed), "lang string, phrase string, n long").groupBy("lang", "phrase").agg(F.sum("n").alias("a"))
        if size == 1:
            counted = stored(counted, "phrase-words")
            totals = counted.groupBy("lang").agg(F.sum("a").alias("n"))
        frequent = stored(counted.where(F.col("a") >= least), "phrase-counts")
        release_shuffles(spark)
        found.append(frequent)
        passed = _bitmap(frequent)
        if passed is None:
            break
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    return every, totals


def _key(lang: bytes, phrase: bytes, backwards: bool) -> tuple[bytes, ...]:
    words = phrase.split(b" ")
    return (lang, *(reversed(words) if backwards else words))


def _splitters(counts: DataFrame, backwards: bool) -> list[tuple[bytes, ...]]:
    """Keys that cut the stream into ranges of about ``RANGE_ROWS``, from some 32 hashed samples a range."""
    ranges = -(-counts.count() // RANGE_ROWS)
    if ranges < 2:
        return []
    some = counts.where(F.pmod(F.xxhash64("lang", "phrase"), F.lit(RANGE_ROWS // 32)) == 0).select("lang", "phrase").toArrow()
    keys = sorted(_key(lang.encode(), phrase.encode(), backwards) for lang, phrase in zip(some["lang"].to_pylist(), some["phrase"].to_pylist()))
    return sorted({keys[i * len(keys) // ranges] for i in range(1, ranges)}) if keys else []


def _ranged(splitters: list[tuple[bytes, ...]], backwards: bool) -> Callable:
    """Each row in its range, and once more, without ``own``, in every further range that phrases beginning with it reach."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, part, own, keys = [], [], [], []
            for i, (lang, phrase) in enumerate(zip(utf8(batch.column(0)), utf8(batch.column(1)))):
                key = _key(lang, phrase, backwards)
                low = bisect_right(splitters, key)
                for p in range(low, bisect_right(splitters, (*key, _BREAK)) + 1):
                    at.append(i)
                    part.append(p)
                    own.append(p == low)
                    keys.append([w.decode() for w in key])
            rows = batch.take(pa.array(at, pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, pa.array(part, pa.int32()), pa.array(own, pa.bool_()), pa.array(keys, pa.list_(pa.string()))], [*rows.schema.names, "part", "own", "sorted_key"])

    return place


def _walk(fields: list[str], counts_name: str, longer_name: str) -> Callable:
    """Follows the sorted stream with its open path; each row leaves with the counts of its parts and the largest count one word longer."""

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path: list[list] = []  # [key, row, counts of its parts, longer]
        done: list[tuple] = []
        here = None

        def close(depth: int) -> None:
            while len(path) > depth:
                _, row, parts, longer = path.pop()
                done.append((*row, parts, longer))

        def flushed() -> pa.RecordBatch:
            columns = list(zip(*done))
            arrays = {name: pa.array(columns[i], schema.field(name).type) for i, name in enumerate(fields)}
            return pa.RecordBatch.from_pydict(arrays | {counts_name: pa.array(columns[-2], pa.list_(pa.int64())), longer_name: pa.array(columns[-1], pa.int64())})

        for batch in batches:
            schema = batch.schema
            columns = [batch.column(batch.schema.get_field_index(name)).to_pylist() for name in fields]
            parts = batch.column(batch.schema.get_field_index("part")).to_pylist()
            keys = batch.column(batch.schema.get_field_index("sorted_key")).to_pylist()
            count = fields.index("a")
            for part, key, *row in zip(parts, keys, *columns):
                if part != here:
                    close(0)
                    here = part
                depth = len(path)
                while depth and path[depth - 1][0] != key[: len(path[depth - 1][0])]:
                    depth -= 1
                close(depth)
                if path:
                    path[-1][3] = max(path[-1][3], row[count])
                path.append([key, row, [entry[1][count] for entry in path], 0])
            if len(done) >= 8192:
                yield flushed()
                done.clear()
        close(0)
        if done:
            yield flushed()

    return walk


def stream_pass(counts: DataFrame, backwards: bool, counts_name: str, longer_name: str) -> DataFrame:
    """``counts`` (lang, phrase, a, others) with the counts of the parts that a phrase begins with (``backwards``: ends with),
    shortest first, and the largest count of a phrase one word longer at its other end (0 if none)."""
    splitters = _splitters(counts, backwards)
    fields = [*counts.columns, "part", "own"]
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in counts.schema)
    placed = counts.mapInArrow(_ranged(splitters, backwards), f"{types}, part int, own boolean, sorted_key array<string>")
    ordered = placed.repartitionById(len(splitters) + 1, F.col("part")).sortWithinPartitions("part", "sorted_key")
    walked = ordered.mapInArrow(_walk(fields, counts_name, longer_name), f"{types}, part int, own boolean, {counts_name} array<long>, {longer_name} long")
    walked = stored(walked, "phrase-stream")
    # At most WORDS - 1 rows for each splitter; every other row has its whole path in its own range.
    beyond = walked.where("not own").groupBy("lang", "phrase").agg(F.max(longer_name).alias("beyond"))
    own = walked.where("own").join(F.broadcast(beyond), ["lang", "phrase"], "left")
    return own.select(*counts.columns, "part", counts_name, F.greatest(longer_name, F.coalesce("beyond", F.lit(0))).alias(longer_name))


def _scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for a, firsts, lasts in zip(*(batch.column(i).to_pylist() for i in (2, 3, 4))):
            # Python integers: the products cannot overflow.
            cuts = [(FACTOR * a // (left + right), k, left, right) for k, (left, right) in enumerate(zip(firsts, reversed(lasts)))]
            out.append(min(cuts))
        names = ["lang", "phrase", "a", "part"]
        arrays = [batch.column(0), batch.column(1), batch.column(2), batch.column(5)]
        for i, name in ((2, "l"), (3, "r"), (0, "score")):
            names.append(name)
            arrays.append(pa.array([x[i] for x in out], pa.int64()))
        yield pa.RecordBatch.from_arrays(arrays, names)


def collocations(docs: DataFrame, words: int = WORDS, least: int = LEAST, top: int = TOP, inside: int = INSIDE_PERCENT, lang_col: str = "lang", text_col: str = "text") -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the ``top`` best phrases of 2 to ``words`` words of each language."""
    counts, totals = phrase_counts(docs, words, least, lang_col, text_col)
    lasts = stored(stream_pass(counts, True, "lasts", "longer_left").drop("part"), "phrase-lasts")
    both = stream_pass(lasts, False, "firsts", "longer_right")
    kept = both.where(F.size("firsts") > 0).where(100 * F.greatest("longer_left", "longer_right") < inside * F.col("a"))
    scored = kept.select("lang", "phrase", "a", "firsts", "lasts", "part").mapInArrow(_scored, "lang string, phrase string, a long, part int, l long, r long, score long")
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # The best of a language are among the best of its ranges, and these among the best of every 64th range.
    for few in (F.col("part"), F.col("part") % 64):
        place = F.row_number().over(Window.partitionBy("lang", few).orderBy(*best))
        scored = scored.withColumn("place", place).where(F.col("place") <= top).drop("place")
    ranked = scored.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH p AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS ws FROM p),
t AS (SELECT lang, sum(len(ws))::BIGINT AS n FROM w GROUP BY lang),
s AS (SELECT lang, ws, unnest(range(1, len(ws) + 1)) AS i FROM w),
c AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS phrase, ws[i:i + k - 1] AS g, count(*) AS a
      FROM s, (SELECT unnest([1, 2, 3, 4]) AS k) WHERE i + k - 1 <= len(ws) GROUP BY ALL HAVING count(*) >= 30),
cut AS (SELECT lang, phrase, k, a, unnest(range(1, k)) AS cutting, g FROM c WHERE k > 1),
sc AS (SELECT cut.lang, cut.phrase, cut.k, cut.a, cutting, x.a AS l, y.a AS r, (2000000::HUGEINT * cut.a) // (x.a + y.a) AS score FROM cut
       JOIN c x ON x.lang = cut.lang AND x.phrase = array_to_string(cut.g[1:cutting], ' ')
       JOIN c y ON y.lang = cut.lang AND y.phrase = array_to_string(cut.g[cutting + 1:cut.k], ' ')),
low AS (SELECT * FROM sc QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cutting) = 1),
inner_words AS (SELECT DISTINCT c.lang, array_to_string(c.g[i:j], ' ') AS phrase, c.a FROM c,
       (SELECT unnest(range(1, 5)) AS i), (SELECT unnest(range(1, 5)) AS j) WHERE i <= j AND j <= c.k AND j - i + 1 < c.k),
most AS (SELECT lang, phrase, max(a) AS longer FROM inner_words GROUP BY ALL),
kept AS (SELECT low.* FROM low LEFT JOIN most USING (lang, phrase) WHERE longer IS NULL OR 100 * longer < 80 * low.a)
SELECT kept.lang, (row_number() OVER (PARTITION BY kept.lang ORDER BY score DESC, a DESC, phrase))::INTEGER AS rank, phrase, a, l, r, n, score::BIGINT AS score
FROM kept JOIN t ON t.lang = kept.lang QUALIFY rank <= 2000
"""
