"""The Jaccard join against all pairs of full sets."""

import random
import re

import numpy as np
from tidemark.llm import jaccard_join

SCHEMA = "doc_id long, text string, k long, h long, size long, root long, bits binary"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those that the operator adds."""
    return spark.createDataFrame([(i, t, 1, 2, 3, 4, None) for i, t in rows], SCHEMA)


def shingles(text, size=5):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()


def expected(rows, percent=80):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                root[top(i)] = top(j)
    low = {}
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            low[top(i)] = min(low.get(top(i), doc), doc)
    return sorted(((doc, len(sets[i]), (low.get(top(i)) if sets[i] else doc)) for i, (doc, _) in enumerate(rows)), key=str)


def got(df):
    return sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in df.collect()), key=str)


def edited(rng, words, times):
    words = list(words)
    for _ in range(times):
        at = rng.randrange(len(words))
        words[at : at + rng.randrange(2)] = [f"e{rng.randrange(10**6)}"] * rng.randrange(1, 3)
    return words


def corpus(seed, groups=25):
    """Copies and near copies about the threshold, sizes from one word to hundreds, and a passage that most texts share."""
    rng = random.Random(seed)
    passage = [f"p{k}" for k in range(30)]
    rows = []
    for g in range(groups):
        base = [f"g{rng.randrange(10**5)}" for _ in range(rng.choice([1, 3, 5, 8, 20, 60, 150, 400]))]
        if g % 3:
            at = rng.randrange(len(base) + 1)
            base[at:at] = passage
        for _ in range(rng.randrange(1, 7)):
            rows.append(edited(rng, base, rng.randrange(1 + len(base) // 25)))
        rows.append(base)
    return [(k, " ".join(w)) for k, w in enumerate(rows)]


def template(seed, n):
    """One text with some words of each document's own: similarities from 0.6 to 0.9."""
    rng = random.Random(seed)
    base = [f"t{k}" for k in range(120)]
    return [(1000 + k, " ".join(edited(rng, base, rng.randrange(2, 8)))) for k in range(n)]


ODD = [(900, None), (901, ""), (902, " \t\n "), (903, "One two"), (904, "one  TWO"), (905, "onetwo"), (906, "É a b c d"), (907, "é a b c d"), (None, "x y"), (None, ""), (908, "X y"), (3, "x y z")]


def test_sizes_ids_and_shared_passage(spark):
    rows = corpus(1) + corpus(1)[:20] + ODD
    assert got(jaccard_join.jaccard_components(frame(spark, rows).repartition(5))) == expected(rows)


def test_long_lists_in_tiles(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "HOT", 4)  # most lists are long
    monkeypatch.setattr(jaccard_join, "TILE", 8)
    rows = template(2, 90) + corpus(3, 12)
    want = expected(rows)
    assert len({c for _, _, c in want}) < len(rows) - 10
    assert got(jaccard_join.jaccard_components(frame(spark, rows).repartition(4))) == want


def test_many_copies_and_empty_table(spark):
    rows = [(k, "the same few words in every one of these texts") for k in range(3000)] + [(k, f"only {k} words of its own in text {k}") for k in range(3000, 3100)]
    found = got(jaccard_join.jaccard_components(frame(spark, rows).repartition(6)))
    assert sum(c == 0 for _, _, c in found) == 3000 and len({c for _, _, c in found}) == 101
    assert jaccard_join.jaccard_components(frame(spark, [])).collect() == []
    assert got(jaccard_join.jaccard_components(frame(spark, [(4, None)]))) == [(4, 0, 4)]


def test_chain_through_a_row_without_id(spark):
    words = [f"c{k}" for k in range(60)]
    first, middle, last = words, ["z", *words[1:-1], words[-1]], ["z", *words[1:-1], "y"]
    rows = [(7, " ".join(first)), (None, " ".join(middle)), (9, " ".join([*last[:3], "q", *last[4:]]))]
    assert got(jaccard_join.jaccard_components(frame(spark, rows))) == expected(rows)


def test_bit_counts_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(5)
    ruled = 0
    for _ in range(400):
        n = int(rng.integers(1, 600))
        one = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        two = np.unique(np.concatenate([one[: max(1, int(n * rng.uniform(0.5, 1)))], rng.integers(0, 1 << 63, int(rng.integers(0, n // 3 + 1)), dtype=np.uint64)]))
        one = np.unique(one)
        maps = [jaccard_join.bitmap(one), jaccard_join.bitmap(two)]
        size = min(map(len, maps)) * 8
        a, b = (jaccard_join.folded([m], size) for m in maps)
        may = jaccard_join.possible(np.array([len(one)]), np.array([len(two)]), np.bitwise_count(a ^ b).sum(axis=1), 80)[0]
        both = len(np.intersect1d(one, two))
        real = 100 * both >= 80 * (len(one) + len(two) - both)
        assert jaccard_join.similar(one, two, 80) == real
        assert may or not real
        ruled += not may
    assert ruled > 100
