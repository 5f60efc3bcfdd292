"""merge_upsert equals a dictionary model of MERGE (matched -> every column
from the staged row, not matched -> insert; null keys never match)."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sysledger.operators import capture

SCHEMA = "k long, v string"
keys = st.sampled_from([1, 2, 3, 4, None])


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(keys, st.sampled_from(["a", "b", None])), max_size=6),
       st.lists(st.tuples(keys, st.sampled_from(["x", "y", None])), max_size=4, unique_by=lambda t: t[0] or object()))
def test_merge_equals_dictionary_model(spark, history, staged):
    staged = [r for r in staged if r[0] is None] + list({r[0]: r for r in staged if r[0] is not None}.values())
    staged_keys = {k for k, _ in staged if k is not None}
    want = [r for r in history if r[0] is None or r[0] not in staged_keys] + staged
    h = spark.createDataFrame(history, SCHEMA)
    s = spark.createDataFrame(staged, SCHEMA)
    got = [tuple(r) for r in capture.merge_upsert(h, s, "k").collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    counts = capture.merge_counts(h, s, "k").first()
    updated = sum(1 for k, _ in history if k is not None and k in staged_keys)
    assert (counts.extracted, counts.updated) == (len(staged), updated)
    assert counts.inserted == sum(1 for k, _ in staged if k is None or k not in {hk for hk, _ in history})
