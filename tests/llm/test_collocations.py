"""Phrase collocations against a count of everything."""

import random
import re
from collections import Counter

import pytest

from tidemark.llm import collocations

SCHEMA = "doc_id long, text string, lang string, phrase string, n long, part int, own boolean"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those that the operator adds."""
    return spark.createDataFrame([(i, t, lang, "x", 1, 2, None) for i, t, lang in rows], SCHEMA)


def expected(rows, words=4, least=30, top=2000):
    f, n = Counter(), Counter()
    for _, text, lang in rows:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lower):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            f.update((lang, tuple(w[i : i + k])) for k in range(1, words + 1) for i in range(len(w) - k + 1))
    found = {x: a for x, a in f.items() if len(x[1]) > 1 and a >= least}
    inner = Counter()
    for (lang, p), a in found.items():
        for i in range(len(p)):
            for j in range(i + 1, len(p) + 1):
                if j - i < len(p):
                    inner[lang, p[i:j]] = max(inner[lang, p[i:j]], a)
    out = {}
    for (lang, p), a in found.items():
        if 100 * inner[lang, p] < 80 * a:
            score, _, left, right = min((2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p)))
            out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), left, right))
    return sorted((lang, rank, p.decode(), -a, left, right, n[lang], -score) for lang, rows in out.items()
                  for rank, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1))


def corpus(seed=3, docs=300):
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(40)] + ["Été", "a\x01b", "\x00", "ß", "NEW", "new"]
    fixed = ["new york city hall", "in spite of", "a\x01b \x00 ß", "w1 w1 w1 w1 w1", "of the of the"]
    rows = []
    for i in range(docs):
        parts = []
        for _ in range(rng.randrange(25)):
            parts.append(rng.choice(fixed) if rng.random() < 0.3 else rng.choice(vocabulary))
            parts.append(rng.choice([" ", " ", " ", "\t", ", ", ".", "\n", "\x0b", "  "]))
        rows.append((i, "".join(parts), rng.choice(["en", "en", "de", None, "und", ""])))
    return rows + [(1, None, "en"), (2, "", None), (3, " ,.", "fr"), (None, "in spite of", "en"), (None, "in spite of", "en")]


def got(df):
    return sorted((r["lang"], r["rank"], r["phrase"], r["a"], r["l"], r["r"], r["n"], r["score"]) for r in df.collect())


@pytest.mark.parametrize(("least", "top", "range_rows"), [(30, 2000, 250_000), (3, 25, 64), (2, 2000, 32)])
def test_every_count_and_rank(spark, monkeypatch, least, top, range_rows):
    monkeypatch.setattr(collocations, "RANGE_ROWS", range_rows)  # paths that begin in an earlier range
    rows = corpus(docs=300 if least > 3 else 150)
    want = expected(rows, least=least, top=top)
    assert len(want) > 20
    assert got(collocations.collocations(frame(spark, rows).repartition(5), least=least, top=top)) == want


def test_full_bitmap_changes_nothing(spark, monkeypatch):
    monkeypatch.setattr(collocations, "ITEM_BITS", 1)
    monkeypatch.setattr(collocations, "BUCKET", 32_768)
    rows = corpus(seed=5, docs=80)
    assert got(collocations.collocations(frame(spark, rows), least=2)) == expected(rows, least=2)


def test_one_phrase_in_most_rows(spark):
    rows = [(i, "over and over again " * 3, "en") for i in range(2000)] + corpus(docs=50)
    assert got(collocations.collocations(frame(spark, rows).repartition(7))) == expected(rows)


def test_empty_table_and_no_candidate(spark):
    assert collocations.collocations(frame(spark, [])).collect() == []
    assert collocations.collocations(frame(spark, [(1, "a b c", "en"), (2, None, None)])).collect() == []


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(collocations, "CHUNK", 7)
    text = b"one two, Three four five six\tseven eight. nine" * 3
    whole = text.translate(collocations._TABLE).replace(b"\xff", b" \xff ").split()
    for size in range(1, 5):
        windows = [tuple(whole[i : i + size]) for i in range(len(whole) - size + 1)]
        pieces = [tuple(p[i : i + size]) for p in collocations.tokens(text, size - 1) for i in range(len(p) - size + 1)]
        assert pieces == windows
