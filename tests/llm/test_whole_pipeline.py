"""Every stage of the pipeline, as run() calls it, against brute force."""

import hashlib
import random

import corpus_pipeline
import numpy as np
import tiktoken
from tidemark.llm import bpe
from tidemark.llm.common import stored
from test_dedup import near_expected

CALM = "the a day was fine and rain fell on our town while we sat near it all".split()


def test_stages_and_rows(spark, tmp_path, monkeypatch):
    rng = random.Random(8)

    def prose(toxic):
        return " ".join(rng.choice(["blockhead", "nitwit"]) if toxic and rng.random() < 0.15 else rng.choice(CALM) + rng.choice(["", "", "s", "ly"]) for _ in range(60))

    text = {k: prose(k % 4 == 0) for k in range(200)}
    text |= {300 + k: text[k] for k in (1, 2, 3)} | {400 + k: "other " + text[k] for k in (5, 6, 7)}
    rows = [(k, t, "abc"[k % 3]) for k, t in text.items()]
    spark.createDataFrame(rows, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(k, int(k % 4 == 0)) for k in range(200)], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    seen = {}

    def watched(name, stage):
        def call(*args):
            out = stored(stage(*args), "watched")
            seen[name] = out.collect()
            return out

        return name, call

    monkeypatch.setattr(corpus_pipeline, "STAGES", [watched(*s) for s in corpus_pipeline.STAGES])
    final = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert list(seen) == ["toxicity", "exact dedup", "near dedup", "mixing", "byte bpe"]
    clean = {k: t for k, t in text.items() if not (k < 200 and k % 4 == 0)}
    assert sorted((r.doc_id, r.text) for r in seen["toxicity"]) == sorted(clean.items())
    first = {}
    for k, t in sorted(clean.items()):
        first.setdefault(t, k)
    assert sorted((r.doc_id, r.text) for r in seen["exact dedup"]) == sorted((k, t) for t, k in first.items())
    near = [k for k, _, c in near_expected([(k, t) for t, k in first.items()]) if k == c]
    assert sorted(r.doc_id for r in seen["near dedup"]) == sorted(near) and len(near) == 150
    # The mix draws at random: whole rows of the stage before, each at most three times.
    mixed = [(r.doc_id, r.text, r.source) for r in seen["mixing"]]
    assert mixed and set(mixed) <= {(k, text[k], "abc"[k % 3]) for k in near} and max(map(mixed.count, mixed)) <= 3
    library = tiktoken.Encoding("own", pat_str=bpe.public_ranks()[1], mergeable_ranks=bpe.Codec.load(*bpe.public_ranks()).ranks, special_tokens={})
    expected = [(k, hashlib.sha256(np.array(library.encode_ordinary(t), "<u4").tobytes()).hexdigest(), hashlib.sha256(t.encode()).hexdigest()) for k, t, _ in mixed]
    assert sorted((r.doc_id, r.ids_sha256, r.decoded_sha256) for r in final) == sorted(expected)
    assert sorted(map(tuple, final)) == sorted(map(tuple, seen["byte bpe"]))
