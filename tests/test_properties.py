"""Property tests: Column rules equal their Python string definitions."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from starloom.functions import normalize_key, parse_flag, py_strip

# Python whitespace (str.isspace) plus separators, case pairs from several
# scripts and plain text. Kept to characters whose case mapping is the same
# in the JVM's and Python's Unicode tables.
WHITESPACE = " \t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0        　"
ALPHABET = WHITESPACE + ";,.-'&#" + "abcXYZ019" + "ÀÉÎõüßÇ" + "ΑΒΣσςω" + "ДЖЯжя" + "東京"

texts = st.lists(st.one_of(st.none(), st.text(alphabet=ALPHABET, max_size=12)),
                 min_size=1, max_size=40)


def python_key(v):
    return "unknown" if v is None else v.split(";")[0].strip().lower()


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=texts)
def test_normalize_key_equals_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    got = [r[0] for r in df.select(normalize_key(F.col("c"))).collect()]
    assert got == [python_key(v) for v in values]


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=texts)
def test_strip_and_flag_equal_python(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "c string")
    rows = df.select(py_strip(F.col("c")), parse_flag(F.col("c"))).collect()
    assert [r[0] for r in rows] == [None if v is None else v.strip() for v in values]
    assert [r[1] for r in rows] == [v is not None and v.strip().lower() == "true" for v in values]


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.tuples(st.integers(0, 5), st.text(alphabet="abcxyz", max_size=3)),
                       min_size=1, max_size=300, unique=True),
       parts=st.integers(1, 12))
def test_range_keys_follow_sort_order(spark, values, parts):
    from starloom.operators.keys import dense_keys

    df = spark.createDataFrame(values, "hot int, name string")  # few distinct 'hot' values
    keyed = dense_keys(df, "k", ["hot", "name"], num_partitions=parts)
    got = [(r.hot, r.name) for r in keyed.orderBy("k").collect()]
    assert got == sorted(values)
    assert sorted(r.k for r in keyed.collect()) == list(range(1, len(values) + 1))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(values=st.lists(st.integers(-3, 3) | st.floats(-100, 100, allow_nan=False),
                       min_size=1, max_size=200),
       keep=st.sampled_from([1, 10, 1000]))
def test_exact_quantiles_equal_numpy(spark, values, keep):
    import numpy as np

    from starloom.operators.quantiles import exact_quantiles

    df = spark.createDataFrame([(float(v),) for v in values], "x double")
    probs = [0.0, 0.25, 0.5, 0.9, 1.0]
    got = {r.prob: r.quantile for r in exact_quantiles(
        df, ["x"], probs, keep=keep).collect()}
    for p in probs:
        assert abs(got[p] - np.percentile(values, p * 100)) <= 1e-9 * max(1.0, abs(got[p]))
