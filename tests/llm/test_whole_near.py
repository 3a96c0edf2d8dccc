"""Near dedup of rows whose ids repeat or are missing."""

import random

from tidemark.llm import near_dedup
from test_dedup import near_expected


def text_of(rng, n=60):
    return [f"w{rng.randrange(10**6)}" for _ in range(n)]


def changed(words, at):
    return words[:at] + ["other"] + words[at + 1 :]


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def test_other_texts_of_an_id_stay_and_near_copies_without_id_go(spark):
    rng = random.Random(4)
    a, b, c, d = (text_of(rng) for _ in range(4))
    rows = [(1, a), (5, changed(a, 0)), (5, b), (None, changed(a, 59)), (None, c), (None, changed(c, 0)), (None, c), (7, d), (7, changed(d, 0))]
    rows = [(i, " ".join(t)) for i, t in rows] + [(8, None), (8, ""), (8, ""), (None, "")]
    got = near_dedup.near_dedup(frame(spark, rows).repartition(3)).collect()
    kept = sorted(((r.doc_id, r.text) for r in got), key=str)
    assert (5, " ".join(b)) in kept and (1, " ".join(a)) in kept and len([1 for i, _ in kept if i == 7]) == 1
    near_c = {" ".join(c), " ".join(changed(c, 0))}
    without = [t for i, t in kept if i is None]
    assert len(without) == 2 and len(near_c & set(without)) == 1 and "" in without
    assert sorted(i for i, _ in kept if i is not None) == [1, 5, 7, 8, 8]


def test_chain_through_a_row_without_id(spark):
    base = text_of(random.Random(6))
    steps = [base]
    for at in (0, 59, 1, 58, 2, 57, 3, 56):
        steps.append(changed(steps[-1], at))
    rows = [(1 if k == 0 else 2 if k == 8 else None, " ".join(t)) for k, t in enumerate(steps)]
    got = near_dedup.near_groups(frame(spark, rows)).collect()
    assert sorted([(r.doc_id, r.n_shingles, r.component_id) for r in got], key=str) == near_expected(rows)
    assert {r.component_id for r in got} == {1}
    assert [r.doc_id for r in near_dedup.near_dedup(frame(spark, rows)).collect()] == [1]
