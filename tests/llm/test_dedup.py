"""Exact, near and substring deduplication against brute force, with odd rows and hot groups."""

import hashlib
import random
import re

import pytest

from tidemark.llm import exact_dedup, near_dedup, substring_dedup

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, text_sha256 string, whole_row long"


def frame(spark, rows):
    """Documents with extra columns whose names clash with those that operators add."""
    return spark.createDataFrame([(i, t, None, "s", None, "x", 1) for i, t in rows], SCHEMA)


def odd_rows():
    long_text = " ".join(f"w{k % 977}" for k in range(30_000))
    return [(1, None), (2, ""), (3, " \t\n "), (4, "One two"), (5, "one  two"), (6, "onetwo"), (7, "a b c d e f"), (8, "A b c d e f"),
            (9, long_text), (10, long_text + " "), (10, long_text + " "), (11, "x"), (None, "x"), (12, " x")]


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def exact_expected(rows):
    groups = {}
    for i, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((i, t or ""))
    out = []
    for norm, members in groups.items():
        keep = max(members, key=lambda m: (len(m[1]), m[0] is not None, -(m[0] or 0)))[0]
        out += [(i, keep, len(members), hashlib.sha256(norm.encode()).hexdigest()) for i, _ in members]
    return sorted(out, key=str)


def test_exact_report(spark):
    rows = odd_rows() + [(100 + k, "copy of a text" + " " * (k % 3)) for k in range(500)]
    got = exact_dedup.dedup_report(frame(spark, rows).repartition(5)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in got], key=str) == exact_expected(rows)
    kept = [r for r in got if r.kept]
    assert len(kept) == len({r.text_sha256 for r in got})  # one row of each group, of repeated rows too
    assert all(r.doc_id == r.keep_id for r in kept)


def test_exact_rows_and_empty_table(spark):
    rows = odd_rows()
    docs = frame(spark, rows)
    got = exact_dedup.exact_dedup(docs)
    assert got.columns == docs.columns
    assert sorted(str(r.doc_id) for r in got.collect()) == sorted({str(k) for _, k, _, _ in exact_expected(rows)})
    assert exact_dedup.exact_dedup(frame(spark, [])).count() == 0
    assert exact_dedup.dedup_report(frame(spark, [])).count() == 0


def test_small_filter_changes_nothing(spark):
    rows = [(k, f"text {k // 2}") for k in range(400)]
    full = exact_dedup.dedup_report(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, r.keep_id, r.group_size, r.text_sha256) for r in full], key=str) == exact_expected(rows)


def shingles(text):
    w = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = words(w)
    if len(w) < 5:
        return {tuple(w)} if w else set()
    return {tuple(w[k : k + 5]) for k in range(len(w) - 4)}


def near_expected(rows):
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            met = len(sets[a] & sets[b])
            if met and 100 * met >= 75 * len(sets[a] | sets[b]):
                root[find(a)] = find(b)
    low = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            low[find(k)] = min(low.get(find(k), i), i)
    return sorted([(i, len(sets[k]), low.get(find(k))) for k, (i, _) in enumerate(rows)], key=str)


def variants(rng, base, n, edits):
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(edits):
            w[rng.randrange(len(w))] = f"v{rng.randrange(10**6)}"
        out.append(" ".join(w))
    return out


def near_rows():
    rng = random.Random(5)
    base = [f"b{rng.randrange(500)}" for _ in range(150)]
    texts = []
    for edits in (1, 2, 3, 4, 5, 6):
        texts += variants(rng, base, 40, edits)
    texts += [" ".join(base)] * 30
    passage = " ".join(f"p{k}" for k in range(60))
    texts += [f"{passage} " + " ".join(f"q{rng.randrange(10**6)}" for _ in range(60)) for _ in range(40)]
    texts += [" ".join(f"r{rng.randrange(10**6)}" for _ in range(80)) for _ in range(60)]
    rng.shuffle(texts)
    return [(1000 + k, t) for k, t in enumerate(texts)]


def test_near_groups(spark):
    rows = near_rows() + odd_rows()
    got = near_dedup.near_groups(frame(spark, rows).repartition(4)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == near_expected(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_cells_find_links_that_stars_miss(spark, monkeypatch):
    monkeypatch.setattr(near_dedup, "SMALL", 4)
    monkeypatch.setattr(near_dedup, "CELL", 16)
    rows = near_rows()
    got = near_dedup.near_groups(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == near_expected(rows)


def test_near_dedup_rows(spark):
    docs = frame(spark, odd_rows())
    got = near_dedup.near_dedup(docs)
    assert got.columns == docs.columns
    ids = [r.doc_id for r in got.collect()]
    assert sorted(i for i in ids if i is not None) == [1, 2, 3, 4, 6, 7, 9, 11, 12]
    assert near_dedup.near_dedup(frame(spark, [])).count() == 0
    assert near_dedup.near_groups(frame(spark, [])).count() == 0


def substring_expected(rows, size=20):
    order = sorted(range(len(rows)), key=lambda k: rows[k][0])
    seen, out = set(), []
    for k in order:
        w = words(rows[k][1])
        gone = [False] * len(w)
        for s in range(len(w) - size + 1):
            run = tuple(w[s : s + size])
            if run in seen:
                gone[s : s + size] = [True] * size
            seen.add(run)
        left = " ".join(x for x, g in zip(w, gone) if not g)
        out.append((rows[k][0], len(w), sum(gone), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


def substring_rows():
    rng = random.Random(7)
    passage = [f"p{k}" for k in range(70)]
    rows = []
    for k in range(120):
        w = [f"x{rng.randrange(10**6)}" for _ in range(rng.randrange(10, 60))]
        if k % 3 == 0:
            cut = rng.randrange(40)
            w[5:5] = passage[cut : cut + rng.randrange(15, 70)]
        rows.append((k, " ".join(w)))
    rows += [(200, "same " * 100), (201, "same " * 50), (202, " ".join(passage * 3)), (203, rows[3][1]), (204, None), (205, ""), (206, "a b")]
    rows += [(300 + k, rows[6][1] + " tail" * k) for k in range(40)]
    return rows


def test_substring(spark):
    rows = substring_rows()
    got = substring_dedup.substring_dedup(frame(spark, rows).repartition(4), digests=True).collect()
    assert sorted(map(tuple, got)) == substring_expected(rows)


def test_substring_repeated_and_missing_ids(spark):
    text = " ".join(f"k{k}" for k in range(40))
    rows = [(1, text), (1, text), (None, text), (2, text + " more"), (2, "other " + text), (3, "short")]
    got = substring_dedup.substring_dedup(frame(spark, rows)).collect()
    assert len(got) == 6
    left = {(r.doc_id, r.n_words): (r.n_removed, r.text) for r in got}
    assert left[(None, 40)] == (0, text)  # a null id comes first
    assert left[(1, 40)] == (40, "")
    assert sorted(r.text for r in got if r.doc_id == 2) == ["more", "other"]
    assert left[(3, 1)] == (0, "short")


def test_substring_empty_table(spark):
    assert substring_dedup.substring_dedup(frame(spark, [])).count() == 0


@pytest.mark.parametrize("span", [1, 2, 3, 7, 15])
def test_window_minimum(span):
    import numpy as np

    values = np.random.default_rng(1).integers(0, 100, 50).astype(np.uint64)
    expected = [values[k : k + span].min() for k in range(50 - span + 1)]
    assert substring_dedup.window_anchors(values, span).tolist() == expected
