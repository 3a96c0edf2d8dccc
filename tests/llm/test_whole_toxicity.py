"""Toxicity: every code of the dictionary is found, and no document ends the sample of the fit."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import toxicity


@pytest.mark.parametrize("size", [50, 200, 500, toxicity.TOXIC_BYTES // toxicity.CODE])
def test_every_code_of_the_dictionary_gains(size):
    rng = random.Random(size)
    toxic = [b"toxic%d" % k for k in range(size)]
    ordinary = b"".join(toxicity.code(b"word%d" % k) for k in range(toxicity.ORDINARY_BYTES // toxicity.CODE))
    scorer = toxicity.Scorer(toxicity.Model(ordinary, b"".join(map(toxicity.code, toxic)), frozenset(), ()))
    windows = [[b"other%d" % rng.randrange(10**9) for _ in range(toxicity.WINDOW - 1)] + [word] for word in toxic]
    assert not [w[-1] for w in windows if scorer.gain(w) <= 0]


def test_one_long_document_does_not_end_the_sample(spark, monkeypatch):
    monkeypatch.setattr(toxicity, "FIT_BYTES", 200_000)
    rng = random.Random(8)
    calm = "the a day was fine and rain fell on our town while we sat near it all".split()

    def prose(toxic):
        return " ".join(rng.choice(["blockhead", "nitwit"]) if toxic and rng.random() < 0.15 else rng.choice(calm) for _ in range(60))

    ids = range(200)
    marks = spark.createDataFrame([(k,) for k in ids], "doc_id long").select("doc_id", F.xxhash64(F.col("doc_id").cast("string")).alias("order"), toxicity.fold("doc_id").alias("fold"))
    first = next(r.doc_id for r in marks.orderBy("order").collect() if r.fold > 1 and r.doc_id % 4)
    rows = [(k, "fine day " * 30_000 if k == first else prose(k % 4 == 0)) for k in ids]
    assert len(rows[first][1]) > toxicity.FIT_BYTES
    labels = spark.createDataFrame([(k, int(k % 4 == 0)) for k in ids], "doc_id long, toxic int")
    kept = {r.doc_id for r in toxicity.drop_toxic(spark.createDataFrame(rows, "doc_id long, text string"), labels).collect()}
    assert kept == {k for k in ids if k % 4}


def test_windows_that_are_not_compressed_would_gain_next_to_nothing():
    rng = random.Random(2)
    calm = [b"calm%d" % k for k in range(900)]
    ordinary = b"".join(map(toxicity.code, calm[: toxicity.ORDINARY_BYTES // toxicity.CODE]))
    scorer = toxicity.Scorer(toxicity.Model(ordinary, b"".join(toxicity.code(b"toxic%d" % k) for k in range(1024)), frozenset(), ()))
    windows = [rng.choices(calm, k=toxicity.WINDOW) for _ in range(500)]
    assert not any(scorer.tells(w) for words in windows for w in words)
    assert max(abs(scorer.gain(words)) for words in windows) < toxicity.CODE // 2
