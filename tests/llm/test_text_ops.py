"""Extraction, chat, tokens, toxicity, mixing, archives, search: brute force, round trips, held-out accuracy."""

import base64
import gzip
import hashlib
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import ann, bpe, chat, html_text, mixing, toxicity, warc
from tidemark.llm.common import table

SF = "/root/testdata/sf0.01"


# -- extraction -------------------------------------------------------------------------


PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body><nav><ul><li><a href=/a>Menu</a></li></ul></nav>
<div class="ad">Buy this now please do</div><article><h1>Head &amp; more</h1><p>First <b>bo</b>ld.<br><p>Second&nbsp; line
<script>var a = "</p>";</script><div class="comments"><p>I disagree</p></div><form><input>Name</form><p>Last.</article><footer>&copy; x</footer>"""


def test_extract_leaves_out_what_is_not_the_article(spark):
    rows = [(1, "u", PAGE, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", "<p>only &lt;this&gt; here", "x"), (5, "u", "plain < text", "x"), (1, "u", PAGE, "y"), (None, "u", "<!-- open", "z")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {(r.page_id, r.text, r.n_chars) for r in html_text.extract_pages(pages).collect()}
    text = "Head & more First bold. Second line Last."
    assert got == {(1, text, len(text)), (2, "", 0), (3, "", 0), (4, "only <this> here", 16), (5, "plain < text", 12), (None, "", 0)}
    assert html_text.extract_pages(pages.limit(0)).count() == 0


def test_best_run_is_the_maximum_of_all_runs():
    rng = random.Random(3)
    for _ in range(200):
        s = [rng.randint(-5, 5) for _ in range(rng.randint(0, 12))]
        first, last = html_text.best_run([float(x) for x in s])
        best = max([sum(s[a:b]) for a in range(len(s)) for b in range(a + 1, len(s) + 1)] + [0])
        assert sum(s[first : last + 1]) == best


# -- chat ---------------------------------------------------------------------------------


def test_reply_tree_paths_and_round_trip(spark):
    hard = ["<|im_end|>", "<<||x", "|> <", "", None, "a\nb<|im_start|>assistant\nok", "\\n <|"]
    rows = [("t", 1, None, 0.0, "us\ner\\n<|", hard[0]), ("t", 2, 1, 1.0, "assistant", hard[1]), ("t", 3, 1, 5.0, "assistant", hard[2]),
            ("t", 4, 2, 9.0, None, hard[3]), ("t", 5, 4, None, "assistant", hard[4]), ("t", 6, 3, 2.0, "user", hard[5]),
            ("u", 1, 99, 0.0, "assistant", hard[6]), ("v", 1, 2, 0.0, "user", "loop"), ("v", 2, 1, 0.0, "user", "loop")]
    messages = spark.createDataFrame(rows, "tree string, msg long, parent long, score double, role string, text string")
    paths = chat.reply_paths(messages)
    found = {}
    for r in paths.collect():
        found.setdefault((r.tree, r.leaf), []).append((-r.up, r.msg))
    assert {k: [m for _, m in sorted(v)] for k, v in found.items()} == {("t", 5): [1, 2, 4, 5], ("t", 6): [1, 3, 6], ("u", 1): [1]}
    ranked = chat.ranked_branches(messages, paths)
    assert {(r.tree, r.leaf): r.branch for r in ranked.collect()} == {("t", 5): 1, ("t", 6): 2, ("u", 1): 1}
    done = chat.format_paths(messages, paths, ranked).withColumn("turns", chat.read_turns(F.col("formatted"))).withColumn("loss", chat.loss_text(F.col("turns")))
    back = {(r.tree, r.leaf): ([(t.role, t.text) for t in r.turns], r.loss) for r in done.collect()}
    assert back[("t", 5)] == ([("us\ner\\n<|", hard[0]), ("assistant", hard[1]), ("", ""), ("assistant", "")], hard[1])
    assert back[("t", 6)] == ([("us\ner\\n<|", hard[0]), ("assistant", hard[2]), ("user", hard[5])], hard[2])
    assert back[("u", 1)] == ([("assistant", hard[6])], hard[6])


def test_long_and_tied_conversations(spark):
    rows = [(1, k, "user" if k % 2 else "assistant", f"m{k}") for k in range(300)] + [(2, 0, "user", "b"), (2, 0, "user", "a"), (3, None, None, None)]
    messages = chat.conversation_messages(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string"))
    paths = chat.reply_paths(messages)
    best = chat.ranked_branches(messages, paths).where("branch = 1")
    out = {r.tree.conv_id: r.formatted for r in chat.format_paths(messages, paths, best).collect()}
    assert out[1] == "".join(f"<|im_start|>{r}\n{t}<|im_end|>\n" for _, _, r, t in rows[:300])
    assert out[2] == "<|im_start|>user\na<|im_end|>\n<|im_start|>user\nb<|im_end|>\n"
    assert out[3] == "<|im_start|>\n<|im_end|>\n"
    assert chat.reply_paths(messages.limit(0)).count() == 0


# -- tokens ----------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec.load(*bpe.public_ranks())


@pytest.fixture(scope="module")
def library(codec):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=bpe.public_ranks()[1], mergeable_ranks=codec.ranks, special_tokens={})


def test_tokens_equal_the_library(codec, library, monkeypatch):
    rng = random.Random(1)
    parts = ["a", "b", "the", " ", "  ", "\n", "\t", "'s", "'", "l", "é", "中", "1", "23", "!", "\xa0", " ", "\x1c", "​", "<", "\U0001f600", "ing", "\r\n", "\0"]
    for leaf_chars, leaf_bytes in ((8, 6), (16_384, 96)):
        monkeypatch.setattr(bpe, "LEAF_CHARS", leaf_chars)
        monkeypatch.setattr(bpe, "LEAF_BYTES", leaf_bytes)
        codec.cache.clear()
        codec.known.clear()
        texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
        texts += ["a" * 5000, "ab" * 3000, "the" * 999, "é" * 3001, "".join(rng.choice("abcdefg") for _ in range(4000)), " " * 999, "x y " * 20_000]
        for text, ids in zip(texts, codec.encode_many(texts)):
            assert np.frombuffer(ids, "<u4").tolist() == library.encode_ordinary(text)
            assert codec.decode(ids) == text.encode()


def test_encode_and_decode_documents(spark, library):
    rows = [(1, "some text", "n"), (2, None, "n"), (3, "", "n"), (1, "some text", "n"), (None, "x " * 50_000, "n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    encoded = bpe.encode_documents(docs, *bpe.public_ranks())
    for r in encoded.collect():
        assert r.n_tokens == len(r.ids)
    back = bpe.decode_documents(encoded, *bpe.public_ranks()).collect()
    assert sorted((str(r.doc_id), bytes(r.text)) for r in back) == sorted((str(i), (t or "").encode()) for i, t, _ in rows)
    for r in bpe.round_trip(docs, *bpe.public_ranks()).where("doc_id = 1").collect():
        assert r.ids_sha256 == hashlib.sha256(np.array(library.encode_ordinary("some text"), "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(b"some text").hexdigest()
    assert bpe.round_trip(docs.limit(0), *bpe.public_ranks()).count() == 0


# -- toxicity ----------------------------------------------------------------------------------


@pytest.mark.skipif(not os.path.isdir("/root/testdata/check_s"), reason="needs the larger tables")
def test_toxicity_on_held_out_documents(spark):
    docs, labels = table(spark, "/root/testdata/check_s", "documents"), table(spark, "/root/testdata/check_s", "labels")
    docs = docs.join(labels.select("doc_id"), "doc_id", "left_semi").where("doc_id % 3 = 0")
    scored = toxicity.score_documents(docs, labels)
    rows = scored.where("held_out").join(labels.select("doc_id", "toxic"), "doc_id").collect()
    toxic, clean = [r for r in rows if r.toxic == 1], [r for r in rows if r.toxic == 0]
    assert sum(r.predicted for r in toxic) >= 0.85 * len(toxic)
    assert sum(r.predicted for r in clean) <= 0.02 * len(clean)
    wins = np.mean([(t.score > c.score) + 0.5 * (t.score == c.score) for t in toxic for c in clean])
    assert wins > 0.93
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_odd_rows(spark):
    labels = spark.createDataFrame([(k, 0, int(k % 4 == 0)) for k in range(200)] + [(None, 0, 1), (3, None, None)], "doc_id long, quality int, toxic int")
    rng = random.Random(8)

    def prose(toxic):
        w = [rng.choice("the a day was fine and rain fell on our town while we sat near it all".split()) + rng.choice(["", "", "s", "ly"]) for _ in range(60)]
        return " ".join(x if not toxic or rng.random() > 0.15 else rng.choice(["blockhead", "nitwit"]) for x in w)

    rows = [(k, prose(k % 4 == 0), "x", 0.5) for k in range(200)]
    rows += [(900, None, "x", 1.0), (901, "", "x", 1.0), (902, "fine day " * 25_000 + "you blockhead, nitwit", "x", 1.0), (None, "the day", "x", 1.0), (900, None, "x", 1.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")
    got = toxicity.score_documents(docs, labels).collect()
    assert len(got) == len(rows)
    kept = toxicity.drop_toxic(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert ids.count(900) == 2 and 901 in ids and 902 not in ids and None in ids
    assert not [k for k in range(200) if (k % 4 == 0) == (k in ids)]
    none = toxicity.score_documents(docs, labels.where("toxic = 0")).collect()
    assert {r.score for r in none} == {0.0}
    assert toxicity.score_documents(docs.limit(0), labels).count() == 0


# -- mixing ---------------------------------------------------------------------------------------


def test_targets_share_what_caps_cut_off(spark):
    units = spark.createDataFrame([(1, "a", 100), (2, "b", 10), (3, "c", 1000), (4, None, 5), (5, "d", 0)], "doc_id long, source string, size long")
    got = {r.source: r.target for r in mixing.source_targets(units, mixing.cyclic_weights()).collect()}
    # weights a 1, b 2, c 3, d 1, null 2; b, d and null are capped at 30, 0 and 15, a at 300 against c
    assert got["b"] == 30 and got["d"] == 0 and got[None] == 15
    assert abs(got["a"] - 267.5) < 1e-6 and abs(got["c"] - 802.5) < 1e-6
    assert abs(sum(got.values()) - 1115) < 1e-6


def test_mix_meets_targets_and_reruns_agree(spark, monkeypatch):
    monkeypatch.setattr(mixing, "BUCKET", 64)
    monkeypatch.setattr(mixing, "FAN_IN", 4)
    rng = random.Random(2)
    rows = [(k, " ".join("w" * rng.randint(1, 80)), rng.choice(["a", "b", "c", None, "hot", "hot", "hot"]), 7) for k in range(3000)]
    rows += [(5000, None, "a", 7), (5001, "", "z", 7), (5002, "x y", "a", 7), (5002, "x y", "a", 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, copies long")
    one = sorted(map(tuple, mixing.mix(docs).collect()), key=str)
    assert one == sorted(map(tuple, mixing.mix(docs.repartition(7)).collect()), key=str)
    taken, target, most = {}, {}, {}
    for source, _, size, _, goal, copies in one:
        taken[source] = taken.get(source, 0) + copies * size
        target[source], most[source] = goal, max(most.get(source, 0), size)
        assert 0 <= copies <= 3
    assert all(abs(taken[s] - target[s]) <= most[s] + 1e-6 for s in taken)
    mixed = mixing.mix_documents(docs)
    assert mixed.columns == docs.columns
    count = {}
    for r in mixed.collect():
        count[r.doc_id] = count.get(r.doc_id, 0) + 1
    expected = {}
    for _, doc, _, _, _, copies in one:
        expected[doc] = expected.get(doc, 0) + copies
    assert count == {k: v for k, v in expected.items() if v}
    assert mixing.mix_documents(docs.limit(0)).count() == 0


def test_pairing_keeps_mass_and_expectation():
    rng = np.random.default_rng(1)
    total = np.zeros(2)
    for _ in range(20_000):
        a, b = [0.3, 5.0], [0.6, 2.0]
        mixing._pair(a, b, rng.random())
        assert abs(a[0] * 5 + b[0] * 2 - 2.7) < 1e-9
        assert a[0] in (0.0, 1.0) or b[0] in (0.0, 1.0)
        total += (a[0], b[0])
    assert np.allclose(total / 20_000, (0.3, 0.6), atol=0.01)


# -- archives --------------------------------------------------------------------------------------


def test_archives_round_trip(spark):
    hard = "a\r\n\r\nWARC/1.1\r\nContent-Length: 3\r\n\r\nabc\0é"
    rows = [(1, "http://www.b.org/x?q=1", hard, "t"), (2, "http://a.org/", hard, "t"), (3, None, None, "t"), (4, "http://a.org:8080/\r\nX: y", "", "t"), (5, "not a url [", "one", "t"), (5, "http://c.org/", "one", "t"), (6, "http://a.org/", "x" * 300_000, "t")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, range string").repartition(3)
    for archive_bytes, range_rows in ((16 << 20, 100_000), (400, 2)):
        got = warc.archived(pages, archive_bytes=archive_bytes, range_rows=range_rows).collect()
        back = sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got)
        sha = lambda t: base64.b32encode(hashlib.sha1((t or "").encode()).digest()).decode()
        expected = [(i, len((t or "").encode()), sha(t), *(("revisit", m) if i < (m := {hard: 2, "": 4, "one": 5}.get(t or "", i)) else ("response", None))) for i, _, t, _ in rows]
        assert back == sorted(expected)
        keys = [(r.url_key, r.timestamp, r.page_id) for r in sorted(got, key=lambda r: (r["range"], r.capture))]
        assert keys == sorted(keys)
    short = warc.archived(pages, least=2).where("page_id in (3, 4)").collect()
    assert {r.record_type for r in short} == {"response"}
    assert warc.archived(pages.limit(0)).count() == 0


def test_loser_tree_merges_any_runs():
    rng = random.Random(4)
    for k in range(0, 12):
        runs = [sorted((rng.randrange(20), r, n) for n in range(rng.randrange(0, 15))) for r in range(k)]
        assert list(warc.merge_runs(runs)) == sorted(x for r in runs for x in r)


def test_records_are_valid_warc():
    data = b"\r\n\r\n".join([warc.record(1, "http://a", b"pay", 3, warc.digest32(b"pay"), None), warc.record(2, "http://a", b"pay", 3, warc.digest32(b"pay"), 1), b""])
    assert gzip.decompress(gzip.compress(data)) == data
    (h1, _, b1), (h2, at, b2) = warc.records(data)
    assert b1.endswith(b"\r\n\r\npay") and b2.endswith(b"\r\n\r\n") and data[at:].startswith(b"WARC/1.1")
    assert (h1["WARC-Type"], h2["WARC-Type"], h2["WARC-Refers-To"]) == ("response", "revisit", "<urn:page:1>")


# -- search ----------------------------------------------------------------------------------------


def brute(rows, k):
    ids = np.array([i for i, _ in rows])
    x = np.array([v for _, v in rows], float)
    out = {}
    for i, v in rows:
        s = x @ np.asarray(v, float)
        other = ids != i
        order = np.lexsort((ids[other], -s[other]))[:k]
        out[i] = ids[other][order].tolist()
    return out


def test_recall_on_the_table(spark):
    vectors = table(spark, SF, "embeddings")
    expected = brute([(r.vec_id, r.embedding) for r in vectors.collect()], 20)
    got = {}
    for r in ann.query(spark, SF).orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert set(got) == {i for i in expected if i % 20 == 0}
    assert sum(len(set(got[q]) & set(expected[q])) for q in got) >= 0.9 * 20 * len(got)


def test_search_odd_vectors_and_ties(spark, monkeypatch):
    monkeypatch.setattr(ann, "CELL", 16)
    monkeypatch.setattr(ann, "QUERY_CELL", 8)
    rng = np.random.default_rng(2)
    rows = [(k, (rng.standard_normal(8) * (1 + k % 5)).tolist()) for k in range(200)] + [(200 + k, [1.0] * 8) for k in range(40)]
    odd = [(900, None), (901, [0.0] * 8), (902, [float("nan")] + [1.0] * 7), (903, [None] + [1.0] * 7), (904, [float("inf")] + [1.0] * 7), (905, [1.0] * 3), (906, []), (None, [1.0] * 8)]
    vectors = spark.createDataFrame([(i, v, 3) for i, v in rows + odd], "vec_id long, embedding array<double>, list int")
    expected = brute(rows, 5)
    found = ann.search(vectors, F.col("vec_id") % 10 == 0, k=5, probe=1.0, lists=4).orderBy("query_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r.query_id, []).append(r.vec_id)
    assert got == {i: v for i, v in expected.items() if i % 10 == 0}
    few = ann.search(vectors.where("vec_id in (0, 1, 2, 901)"), F.col("vec_id") == 0, k=5).collect()
    assert sorted(r["rank"] for r in few) == [1, 2]
    assert ann.search(vectors.limit(0), F.lit(True)).count() == 0
