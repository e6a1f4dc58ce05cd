"""A user's own accumulator: any order of merging, hot keys, nulls."""

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators.combine import Largest, combine_by_key

rows = st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 50)), st.one_of(st.none(), st.integers(0, 5).map(float))), max_size=30)


def _batch(part):
    return pa.RecordBatch.from_pylist([{"i": i, "v": v} for i, v in part], schema=pa.schema([("i", pa.int64()), ("v", pa.float64())]))


@given(rows, st.lists(st.integers(0, 30), max_size=4), st.randoms())
@settings(max_examples=100, deadline=None)
def test_any_split_and_order_of_merging_gives_the_same(data, cuts, rng):
    c = Largest(3, "i", "v")
    edges = [0, *sorted(min(x, len(data)) for x in cuts), len(data)]
    states = [c.add(c.create(), _batch(data[a:b])) for a, b in zip(edges, edges[1:])]
    while len(states) > 1:
        rng.shuffle(states)
        states.append(c.merge(states.pop(), states.pop()))
    assert states[0] == c.add(c.create(), _batch(data))
    assert c.merge(c.create(), states[0]) == states[0] == c.merge(states[0], c.create())


def test_hot_and_null_keys(spark):
    df = spark.range(0, 3000, 1, 6).select(
        F.when(F.col("id") % 10 == 0, F.col("id") % 3).when(F.col("id") % 10 == 1, F.lit(None)).otherwise(99).alias("k"),
        F.when(F.col("id") % 7 != 0, F.col("id")).alias("i"), (F.col("id") % 100).cast("double").alias("v"))
    got = {r.k: list(zip(r.ids, r.vals)) for r in combine_by_key(df, "k", ["i", "v"], Largest(3, "i", "v"), 4).collect()}
    want: dict = {}
    for r in df.where("i is not null").collect():
        want.setdefault(r.k, []).append((r.i, r.v))
    assert got == {k: sorted(x, key=lambda p: (-p[1], p[0]))[:3] for k, x in want.items()}
    assert combine_by_key(df.limit(0), "k", ["i", "v"], Largest(3, "i", "v")).collect() == []


def test_pages_hold_all_values_of_hot_and_null_keys(spark, monkeypatch):
    from tidewater.operators import cogroup
    monkeypatch.setattr(cogroup, "CELL_BITS", 5)
    df = spark.range(0, 1000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 == 1, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        F.when(F.col("id") % 5 != 0, F.col("id")).alias("v"))
    got, want = {}, {}
    for r in cogroup.group_pages(df, "k", "v", 16).collect():
        got.setdefault(r.k, {})[r.page] = r["values"]
    for r in df.collect():
        want.setdefault(r.k, []).append(r.v)
    for k, values in want.items():
        sizes = [len(got[k][p]) for p in range(len(got[k]))]
        assert sizes[:-1] == [16] * (len(sizes) - 1) and sizes[-1] <= 16
        assert sorted((x for p in got[k].values() for x in p), key=str) == sorted(values, key=str)
    assert got.keys() == want.keys() and cogroup.group_pages(df.limit(0), "k", "v", 16).collect() == []
