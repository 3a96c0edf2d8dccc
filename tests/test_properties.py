"""Property: any split of the input into micro-batches, in any order, replayed, gives the same SCD1 table."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.operators.cdc import latest_per_key, publish, scd1_merge

ROW = st.tuples(st.integers(0, 4), st.integers(0, 6), st.one_of(st.none(), st.integers(-3, 3)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(ROW, min_size=1, max_size=12), cuts=st.lists(st.integers(0, 12), max_size=3),
       order_seed=st.randoms(use_true_random=False), replay=st.booleans())
def test_scd1_converges(spark, rows, cuts, order_seed, replay):
    schema = "k int, seq int, v int"
    whole = latest_per_key(spark.createDataFrame(rows, schema), ["k"], ["seq"], ["v"])
    want = sorted(tuple(r) for r in whole.collect())
    bounds = sorted({0, len(rows), *[c for c in cuts if c <= len(rows)]})
    batches = [rows[a:b] for a, b in zip(bounds, bounds[1:]) if rows[a:b]]
    order_seed.shuffle(batches)
    if replay:
        batches = batches + batches[:1]
    state = None
    for b in batches:
        state = scd1_merge(state, spark.createDataFrame(b, schema), ["k"], ["seq"], ["v"])
    got = sorted(tuple(r) for r in publish(state, ["seq"]).select("k", "v").collect())
    assert got == [(k, v) for k, v in want]
