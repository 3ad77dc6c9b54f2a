"""Operators against plain Python on generated rows, with few keys so that ties and hot keys are common."""

from collections import Counter

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from loyaltide.functions.quantiles import column_quantiles
from loyaltide.operators import clean, drift, skew

few = settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
values = st.lists(st.one_of(st.none(), st.integers(-5, 5).map(float), st.floats(-1e6, 1e6)), min_size=1, max_size=60)
keys = st.lists(st.one_of(st.none(), st.sampled_from(["a", "a", "a", "b", "c"])), min_size=1, max_size=40)


@few
@given(values, st.integers(1, 99))
def test_quantile_is_the_ranked_value(spark, data, percent):
    known = sorted(v for v in data if v is not None)
    rank = max(-(-percent * len(known) // 100), 1)
    df = spark.createDataFrame([(v,) for v in data], "x double")
    found = column_quantiles(df, ["x"], [percent / 100]).first()["quantiles"]
    assert found == ([known[rank - 1]] if known else None)


@few
@given(keys, keys)
def test_salted_join_is_a_join(spark, left, right):
    large = spark.createDataFrame(list(enumerate(left)), "id int, k string")
    small = spark.createDataFrame([(k, i) for i, k in enumerate(right)], "k string, v int")
    got = Counter(tuple(r) for r in skew.salted_join(large, small, "k", "left", min_share=0.3).select("id", "v").collect())
    expected = Counter()
    for i, k in enumerate(left):
        matches = [v for v, other in enumerate(right) if k is not None and k == other] or [None]
        expected.update((i, v) for v in matches)
    assert got == expected


@few
@given(keys, keys)
def test_categorical_drift_is_half_the_share_distance(spark, left, right):
    a, b = (spark.createDataFrame([(k,) for k in side], "c string") for side in (left, right))
    ca, cb = Counter(left), Counter(right)
    expected = sum(abs(ca[k] / len(left) - cb[k] / len(right)) for k in ca.keys() | cb.keys()) / 2
    assert abs(drift.drift_categorical(a, b, ["c"]).first()["distance"] - expected) < 2e-6


@few
@given(st.lists(st.tuples(st.sampled_from("abc"), st.integers(0, 3), st.integers(0, 9)), min_size=1, max_size=40))
def test_latest_row_per_key(spark, data):
    df = spark.createDataFrame(data, "order_id string, order_purchase_timestamp int, v int")
    best = {}
    for k, t, v in data:
        best[k] = min(best.get(k, (1, 0)), (-t, v))
    got = {r.order_id: (-r.order_purchase_timestamp, r.v) for r in clean.dedup_latest(df).collect()}
    assert got == best
