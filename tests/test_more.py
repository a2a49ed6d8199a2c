"""Identity, quality, guards, and properties over generated inputs."""

from datetime import date

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from peertide.functions import text
from peertide.operators import identity, quality, series
from peertide.operators.anomaly import flag_readings, median_by_series, run_lengths
from peertide.operators.rolling import last_loaded
from peertide.session import durable, shared_dir, spread
from peertide.sources import feeds


def test_canonical_and_chained(spark):
    df = spark.createDataFrame([("a", "T", 3), ("b", "T", 5), ("c", "U", 1), ("d", None, 9), ("e", None, 8)], "id string, k string, n int")
    m = {r.old: r.new for r in identity.canonical_map(df, [F.col("k")], "id", [-F.col("n")]).collect()}
    assert m == {"a": "b"}
    one = spark.createDataFrame([("a", "b"), ("x", "y")], "old string, new string")
    two = spark.createDataFrame([("b", "c"), ("p", "q"), ("y", "x")], "old string, new string")
    assert {r.old: r.new for r in identity.chained_map(one, two).collect()} == {"a": "c", "b": "c", "p": "q", "y": "x"}


def test_resolve(spark):
    df = spark.createDataFrame([("p", "1"), ("q", "9"), ("k", None), (None, None)], "ip_id string, imdb string")
    by = spark.createDataFrame([("1", "cat1")], "imdb string, id string")
    known = spark.createDataFrame([("k",), ("k",)], "id string")
    got = {(r.ip_id, r.resolved, r.unmapped) for r in identity.resolve(df, by, known).collect()}
    assert got == {("p", "cat1", 0), ("q", None, 1), ("k", "k", 0), (None, None, 1)}


def test_strict_best(spark):
    df = spark.createDataFrame([("a", "x", 2), ("a", "y", 1), ("b", "x", 2), ("b", "y", 2)], "t string, c string, n int")
    assert [(r.t, r.c, r.n) for r in identity.strict_best(df, ["t"], "n", "c").collect()] == [("a", "x", 2)]


def test_decoys_spikes_health(spark):
    rows = [("a", "same")] * 6 + [("b", f"n{i}") for i in range(6)] + [(None, "x"), ("c", None)]
    assert [r.k for r in quality.decoys(spark.createDataFrame(rows, "k string, name string"), "k", "name").collect()] == ["a"]
    d = spark.createDataFrame([("a", 300, 150, 150), ("b", 300, 10, 290), ("c", 50, 50, 0), ("d", 200, 200, 0)], "k string, value long, delta long, previous long")
    assert [r.k for r in quality.spikes(d, "k").collect()] == ["a"]
    h = spark.createDataFrame([(date(2026, 1, 2),), (None,)], "day date")
    assert {r.name: r.ok for r in quality.health(h, "day", F.lit("2026-01-02").cast("date"), least=2).collect()} == {"rows_today": False, "newest": True, "undated": False}


@pytest.mark.parametrize(
    ("name", "title", "want"),
    [
        ("Old.Harbor.1999.720p", "Old Harbor", True), ("Harbor.1999.720p", "Old Harbor", False), ("The Grey Old Harbor Song", "Grey Old Harbor Tune", True),
        ("Grey Harbor", "Grey Old Harbor Tune", False), ("a b1 c1 d1 x", "a1 b1 c1 d1 e1", True), ("x", "", False), ("x", None, None),
    ],
)
def test_name_guard(spark, name, title, want):
    df = spark.createDataFrame([(name, title, 2001, 1999)], "n string, t string, a int, b int")
    got = df.select(text.name_guard(F.col("n"), F.col("t"))).first()[0]
    assert got == want or (want is None and not got)
    assert not df.select(text.name_guard(F.col("n"), F.col("t"), name_year=F.col("a"), title_year=F.col("b"))).first()[0]


def test_last_loaded_ties(spark):
    df = spark.createDataFrame([("a", 1, 5), ("a", 1, 7), ("a", 0, 9), ("b", 2, None), ("b", 1, 3)], "k string, l int, v int")
    assert {r.k: r.value for r in last_loaded(df, {"k": F.col("k")}, F.col("v"), F.col("l")).collect()} == {"a": 7, "b": None}


def test_half_change(spark):
    df = spark.createDataFrame([([0] * 7 + [7] * 7,), ([2] * 7 + [3] * 7,), ([0] * 14,)], "s array<long>")
    assert [r[0] for r in df.select(series.half_change(F.col("s"), 14)).collect()] == [100.0, 50.0, None]


def test_durable_and_spread(spark):
    df = spark.range(100).select("id", F.lit(None).cast("string").alias("s"))
    again = durable(df)
    assert again.dtypes == df.dtypes and sorted(r.id for r in again.collect()) == list(range(100))
    assert any(shared_dir(spark).removeprefix("file:") in f for f in again.inputFiles())
    few = spread(df.coalesce(1))
    assert few.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism and few.count() == 100
    wide = df.repartition(64)
    assert spread(wide) is wide


@settings(max_examples=200, deadline=None)
@given(st.lists(st.booleans(), max_size=40))
def test_run_lengths(flags):
    got = run_lengths(np.array(flags, bool)).tolist()
    runs, start = [], 0
    for i in range(1, len(flags) + 1):
        if i == len(flags) or not flags[i]:
            runs += [i - start] * (i - start)
            start = i
    assert got == runs


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.floats(-5, 5)), min_size=1, max_size=40))
def test_median_by_series(pairs):
    pairs.sort(key=lambda p: p[0])
    s, x = np.array([p[0] for p in pairs]), np.array([p[1] for p in pairs])
    assert np.allclose(median_by_series(x, s), [np.median(x[s == k]) for k in s])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(-3, 60_000), max_size=60))
def test_flags_never_crash(values):
    v = np.array(values, float)
    bound, spike, stuck = flag_readings(v, np.zeros(len(v), int), 50_000, 7, 5.0, 2.0, 3, 6)
    assert len(bound) == len(spike) == len(stuck) == len(v) and not (spike & bound).any() and not spike[v == 0].any()


_VALUE = st.recursive(st.integers() | st.binary(max_size=20), lambda x: st.lists(x, max_size=4) | st.dictionaries(st.binary(max_size=6), x, max_size=4), max_leaves=12)


def encoded(x) -> bytes:
    if isinstance(x, int):
        return b"i%de" % x
    if isinstance(x, bytes):
        return b"%d:%s" % (len(x), x)
    if isinstance(x, list):
        return b"l" + b"".join(map(encoded, x)) + b"e"
    return b"d" + b"".join(encoded(k) + encoded(v) for k, v in x.items()) + b"e"


@settings(max_examples=200, deadline=None)
@given(_VALUE)
def test_bencode_round_trip(x):
    assert feeds.bencode(encoded(x)) == x


def test_category_of_numbers(spark):
    df = spark.createDataFrame([([2045],), ([5070, 2000],), ([5030, 8000],), ([8000],), ([],)], "n array<int>")
    assert [r[0] for r in df.select(text.category_of_numbers(F.col("n"))).collect()] == ["Movies", "Anime", "Series", None, None]
