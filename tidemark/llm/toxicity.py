"""Toxicity by compression distance.

Two zstandard dictionaries stand for ordinary and for toxic text. A text is cut into windows of ``WINDOW`` words (runs of
letters, lower-cased in ASCII), and each is compressed with either; what it gains from the toxic dictionary is
its distance. The gains of a document, calibrated on labelled documents
that the dictionaries had not seen, give a score.

Only the ordinary dictionary is trained by zstandard. The toxic one is a selected word list, spelled as codes, before the
same ordinary content; dictionaries trained on toxic windows do worse on held-out documents (figures in the README).

*Spelling.* A word is spelled as a code of ``CODE`` bytes, so that a short word is as long a match as a long one
and parts of other words match nothing. A word with a telling beginning is spelled as two codes, of that beginning and of itself.
*Ordinary dictionary*: zstandard's trainer over windows of ordinary documents.
*Toxic dictionary*: the codes of words and beginnings that tell toxic text from ordinary text,
before the same ordinary content. They stand in ``ODDS`` times more different neighbourhoods
(previous and next word) in toxic documents than in ordinary ones, too many for
chance; a copy of a document adds no neighbourhood. Because both
dictionaries end alike, an ordinary window costs the same bytes in both: a window without a telling code
gains next to nothing (a byte or two, by other offsets) and is not compressed. So a document
whose toxic words are all too rare, or as usual in ordinary text, scores nothing.

The fit reads a bounded, reproducible sample of labelled rows: at most
``FIT_TOXIC`` toxic and ``FIT_ORDINARY`` ordinary documents (lowest hashes of
doc_id) and ``FIT_BYTES`` of text for the dictionaries (a document that does not fit in what is left is passed over), and
``CALIBRATE`` documents for the calibration. Every document is then scored over its whole text.

Defined cases: null and empty texts have no window and get the score of no
gain; without toxic labels every score is 0; a document with several labels is
toxic if one says so, null labels are ignored; equal texts get equal scores; an
empty table gives an empty result; other columns are never read, and
``drop_toxic`` returns them unchanged whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import compress

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bounded_batches, table

WINDOW = 20
CODE = 16
TOP = 3
FOLDS = 5
FIT_TOXIC, FIT_ORDINARY, CALIBRATE = 2_000, 4_000, 4_000
FIT_BYTES = 14 << 20
ORDINARY_BYTES, TOXIC_BYTES = 8_192, 16_384
PREFIXES = (4, 5, 6, 7, 8)
ODDS = 30
# The search that finds the cheapest parse, with a window and tables that hold every position of either dictionary.
SEARCH = dict(window_log=16, chain_log=17, hash_log=16, search_log=6, min_match=5, target_length=256, strategy=zstandard.STRATEGY_BTULTRA2)
MEMO = 1 << 18
_WORDS = re.compile(rb"[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


@dataclass
class Model:
    """What a fit keeps: dictionary contents and the weights of the calibrated score."""

    ordinary: bytes
    segments: bytes
    beginnings: frozenset[bytes]
    weights: tuple[float, ...]


def fold(doc_id: str | Column) -> Column:
    """crc32 of the id as text, mod 5; fold 0 is held out."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id) % FOLDS


# -- the fit ------------------------------------------------------------------------------


def _neighbourhoods(texts: list[bytes], prefix: int = 0) -> tuple[np.ndarray, np.ndarray, int]:
    """Hashes of words (or of their beginnings), in how many different places (previous, next word) each stands, and the words' number."""
    keys, places, total = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
    for text in texts:
        words = _WORDS.findall(text.lower())
        total += len(words)
        h = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        place = np.r_[np.uint64(1), h[:-1]] * np.uint64(0x9E3779B97F4A7C15) + np.r_[h[1:], np.uint64(1)] * np.uint64(0xC2B2AE3D27D4EB4F) if len(h) else h
        if prefix:
            longer = [i for i, w in enumerate(words) if len(w) > prefix]
            h, place = np.fromiter((xxhash.xxh3_64_intdigest(words[i][:prefix]) for i in longer), np.uint64, len(longer)), place[longer]
        keys.append(h)
        places.append(place)
    key, place = np.concatenate(keys), np.concatenate(places)
    order = np.lexsort((place, key))
    key, place = key[order], place[order]
    new = np.r_[True, (key[1:] != key[:-1]) | (place[1:] != place[:-1])] if len(key) else np.zeros(0, bool)
    return *np.unique(key[new], return_counts=True), total


def _telling(toxic: list[bytes], ordinary: list[bytes], prefix: int = 0) -> dict[int, int]:
    """Words (or beginnings) that toxic texts have far more often: number of places by hash."""
    key, a, n_toxic = _neighbourhoods(toxic, prefix)
    usual, count, n_ordinary = _neighbourhoods(ordinary, prefix)
    if not len(key):
        return {}
    at = np.minimum(np.searchsorted(usual, key), max(len(usual) - 1, 0))
    b = np.where(usual[at] == key, count[at], 0) if len(usual) else np.zeros(len(key), np.int64)
    share = min(0.9, n_toxic / (n_toxic + n_ordinary + 1))
    p = a / (a + b)
    odds = a * (1 - share) / ((b + 0.5) * share)
    # Of as many words that tell nothing, less than one is kept by chance.
    chance = a * np.log(share / p) + b * np.log((1 - share) / np.maximum(1 - p, 1e-12))
    good = (a >= 4) & (odds >= ODDS) & (chance < -np.log(len(key) + 1))
    return dict(zip(key[good].tolist(), a[good].tolist()))


def code(part: bytes) -> bytes:
    return xxhash.xxh3_128_digest(part)


def beginning_of(word: bytes, beginnings: frozenset[bytes]) -> bytes | None:
    """The shortest telling beginning of a word."""
    return next((word[:k] for k in PREFIXES if len(word) > k and word[:k] in beginnings), None) if beginnings else None


def spelled(word: bytes, beginnings: frozenset[bytes]) -> bytes:
    begin = beginning_of(word, beginnings)
    return code(word) if begin is None else code(b"^" + begin) + code(word)


def toxic_segments(toxic: list[bytes], ordinary: list[bytes], limit: int = TOXIC_BYTES) -> tuple[bytes, frozenset[bytes]]:
    """Codes of words and beginnings that tell toxic text, most frequent last; and those beginnings."""
    telling = _telling(toxic, ordinary)
    by_size = {k: _telling(toxic, ordinary, k) for k in PREFIXES}
    words = {w for text in toxic for w in _WORDS.findall(text.lower())}
    places: dict[bytes, int] = {}
    beginnings: set[bytes] = set()
    for w in words:
        h = xxhash.xxh3_64_intdigest(w)
        if len(w) > 2 and h in telling:
            places[w] = telling[h]
        for k in PREFIXES:
            if len(w) > k and (n := by_size[k].get(xxhash.xxh3_64_intdigest(w[:k]))):
                beginnings.add(w[:k])
                places[b"^" + w[:k]] = n
                break
    kept = sorted(places, key=lambda w: (-places[w], w))[: limit // CODE]
    # The most frequent nearest, where offsets cost least.
    return b"".join(code(w) for w in reversed(kept)), frozenset(beginnings.intersection(w[1:] for w in kept if w[:1] == b"^"))


def ordinary_dictionary(texts: list[bytes], beginnings: frozenset[bytes], size: int = ORDINARY_BYTES) -> bytes:
    """What the windows of ordinary texts have in common, by zstandard's trainer."""
    parts = []
    for text in texts:
        words = _WORDS.findall(text.lower())
        parts += [words[i : i + WINDOW] for i in range(0, len(words), WINDOW)]
    samples = [b"".join(spelled(w, beginnings) for w in part) for part in parts[:: max(1, len(parts) // 20_000)]]
    try:
        return zstandard.train_dictionary(4 * size, samples).as_bytes()[-size:]
    except zstandard.ZstdError:  # too few samples to choose from
        return b"".join(samples)[-size:]


class Scorer:
    """Gains of the windows of a text."""

    def __init__(self, model: Model):
        def compressor(content: bytes) -> Callable[[bytes], bytes]:
            params = zstandard.ZstdCompressionParameters(write_checksum=0, write_content_size=0, write_dict_id=0, **SEARCH)
            shared = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
            shared.precompute_compress(compression_params=params)
            return zstandard.ZstdCompressor(dict_data=shared, compression_params=params).compress

        self.segments, self.beginnings = model.segments, model.beginnings
        self.known: dict[bytes, bool] = {}
        if self.segments:
            ordinary = model.ordinary or b" the the"
            self.plain, self.toxic = compressor(ordinary), compressor(model.segments + ordinary)
            self.codes = {model.segments[i : i + CODE] for i in range(0, len(model.segments), CODE)}

    def tells(self, word: bytes) -> bool:
        """Whether the spelling of a word has a code of the toxic dictionary; remembered for frequent words."""
        found = self.known.get(word)
        if found is None:
            if len(self.known) >= MEMO:
                self.known.clear()
            begin = beginning_of(word, self.beginnings)
            found = self.known[word] = code(word) in self.codes or begin is not None and code(b"^" + begin) in self.codes
        return found

    def gain(self, words: list[bytes]) -> int:
        window = b"".join(spelled(w, self.beginnings) for w in words)
        return len(self.plain(window)) - len(self.toxic(window))

    def features(self, text: bytes) -> tuple[int, int]:
        """Largest gain of a window, and the sum of the ``TOP`` largest."""
        if not self.segments:
            return 0, 0
        words = _WORDS.findall(text.lower())
        near = {i // WINDOW for i in compress(range(len(words)), map(self.tells, words))}
        gains = sorted((max(0, self.gain(words[k * WINDOW : (k + 1) * WINDOW])) for k in near), reverse=True)
        return max(gains, default=0), sum(gains[:TOP])


def design(best: np.ndarray, top: np.ndarray) -> np.ndarray:
    """The features as the score sees them: gains in codes, none of which grows without bound or falls with a text's length."""
    best, top = (np.asarray(x, float) for x in (best, top))
    return np.column_stack([np.ones(len(best)), best > 0, best > CODE, np.minimum(best / CODE, 4), np.minimum(np.log1p(top / CODE), 3)])


def score_of(weights: tuple[float, ...], best, top) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(design(best, top) @ np.asarray(weights), -30, 30)))


def calibrate(x: np.ndarray, y: np.ndarray, penalty: float = 0.05) -> tuple[float, ...]:
    """Logistic regression by Newton's method; the penalty keeps it finite where classes separate."""
    w = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        slope = x.T @ (y - p) - penalty * w
        curve = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(curve, slope)
        w += step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def trained(toxic: list[bytes], ordinary: list[bytes], weights: tuple[float, ...] = ()) -> Model:
    segments, beginnings = toxic_segments(toxic, ordinary)
    return Model(ordinary_dictionary(ordinary, beginnings), segments, beginnings, weights)


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from a bounded sample of labelled rows whose fold is not 0; None without toxic ones."""
    spark = docs.sparkSession
    marks = labels.where("toxic is not null and doc_id is not null").groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    marks = marks.withColumns({"fold": fold("doc_id"), "order": F.xxhash64(F.col("doc_id").cast("string"))}).where("fold > 0")

    def lowest(rows: DataFrame, n: int) -> DataFrame:
        return rows.orderBy("order").limit(n)

    train, held = marks.where("fold > 1"), marks.where("fold = 1")
    sample = lowest(train.where("toxic = 1"), FIT_TOXIC).unionByName(lowest(train.where("toxic = 0"), FIT_ORDINARY)).unionByName(lowest(held, CALIBRATE))
    chosen = {r["doc_id"]: (r["toxic"], r["fold"], r["order"]) for r in sample.collect()}  # 10 000 rows at most
    if not any(t == 1 and f > 1 for t, f, _ in chosen.values()):
        return None
    ids = F.broadcast(spark.createDataFrame([(i,) for i in chosen], "doc_id long"))
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    # Whole documents in order of their hashes, as many as FIT_BYTES hold; one that does not fit is passed over.
    sizes = known.groupBy("doc_id").agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).collect()
    total, taken = 0, set()
    for _, doc, size in sorted((chosen[r["doc_id"]][2], r["doc_id"], r["size"]) for r in sizes):
        if total + size <= FIT_BYTES:
            total += size
            taken.add(doc)
    learn = F.broadcast(spark.createDataFrame([(i,) for i in sorted(taken)], "doc_id long"))
    texts: tuple[list, list] = ([], [])
    for r in sorted(known.join(learn, "doc_id", "left_semi").collect(), key=lambda r: (chosen[r["doc_id"]][2], r["text"] or "")):
        toxic, its_fold, _ = chosen[r["doc_id"]]
        texts[toxic].append(((r["text"] or "").encode("utf-8", "surrogatepass"), its_fold))
    # Calibrated on fold 1 with dictionaries of the others; the dictionaries that score then learn fold 1 too.
    part = [[t for t, f in side if f > 1] for side in texts]
    model = trained(part[1], part[0])
    rows = gains(known.where(fold("doc_id") == 1), model).select("doc_id", "best", "top").collect()
    y = np.array([chosen[r["doc_id"]][0] for r in rows], float)
    x = design(*([r[c] for r in rows] for c in ("best", "top"))) if rows else np.zeros((0, 5))
    if not len(y) or y.min() == y.max():  # nothing to calibrate on: any gain is the threshold
        weights = (-3.0, 4.0, 0.0, 0.0, 0.0)
    else:
        weights = calibrate(x, y)
    whole = [[t for t, _ in side] for side in texts]
    return trained(whole[1], whole[0], weights)


# -- scoring --------------------------------------------------------------------------------


def _features(model: Model):
    @F.pandas_udf("best long, top long")
    def features(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(model)
        for texts in batches:
            rows = [scorer.features((t or "").encode("utf-8", "surrogatepass")) for t in texts]
            yield pd.DataFrame(rows, columns=["best", "top"]).astype("int64")

    return features


def gains(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id with the features of its whole text."""
    bounded_batches(docs.sparkSession)
    return docs.select("doc_id", _features(model)("text").alias("f")).select("doc_id", "f.*")


def scorer(model: Model | None):
    """A column function from whole text to score."""
    if model is None:
        return lambda text: F.lit(0.0)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        of = Scorer(model)
        for texts in batches:
            rows = np.array([of.features((t or "").encode("utf-8", "surrogatepass")) for t in texts], float).reshape(-1, 2)
            yield pd.Series(score_of(model.weights, rows[:, 0], rows[:, 1]))

    return score


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document."""
    score = scorer(fit(docs, labels))
    bounded_batches(docs.sparkSession)
    rows = docs.select("doc_id", (fold("doc_id") == 0).alias("held_out"), score("text").alias("score"))
    return rows.withColumn("predicted", F.when(F.col("score") >= 0.5, 1).otherwise(0))


def drop_toxic(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that score below 0.5, all columns."""
    score = scorer(fit(docs, labels))
    bounded_batches(docs.sparkSession)
    return docs.where(score("text") < 0.5)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
