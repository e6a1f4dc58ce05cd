import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import bitslice as B


@settings(max_examples=60, deadline=None)
@given(st.integers(1, 200), st.integers(1, 6), st.integers(0, 40), st.integers(0, 2**31))
def test_segment_equals_brute_force(rows, width, bits, seed):
    rng = np.random.default_rng(seed)
    top = 1 << min(bits, 20)
    vectors = rng.integers(-top, top + 1, (rows, width))
    ids = rng.permutation(rows * 2)[:rows].astype(np.int64)
    segment = B.Segment(ids, vectors)
    for q in range(min(rows, 5)):
        got_ids, got = segment.top(vectors[q], ids[q], 5)
        scores = vectors @ vectors[q]
        keep = ids != ids[q]
        order = np.lexsort((ids[keep], -scores[keep]))[:5]
        assert got.tolist() == scores[keep][order].tolist() and got_ids.tolist() == ids[keep][order].tolist()


def test_slice_sum_adds():
    rng = np.random.default_rng(1)
    values = rng.integers(0, 1000, 130)
    total = B.SliceSum(3)
    for w in (0, 1, 1, 3, 5, 5, 5):
        for j, s in enumerate(B.to_slices(values, 10)):
            total.add(w + j, s)
    out = sum(np.unpackbits(s.view(np.uint8), bitorder="little")[:130].astype(np.int64) << j
              for j, s in enumerate(total.slices()))
    assert out.tolist() == (values * (1 + 2 + 2 + 8 + 96)).tolist()


def vectors_of(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")


def test_against_sql_with_edge_cases(spark, same_as_sql):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=8)], 0) for i in range(250)]
    rows += [(i, [0.5] * 8, 1) for i in range(250, 330)]  # ties
    rows += [(400, None, 0), (450, [], 0), (500, [1.0, 2.0], 0), (501, [1.0, -2.0], 0),
             (550, [float("nan")] * 8, 0), (600, [float("inf")] + [0.0] * 7, 0), (650, [0.0] * 8, 0), (50, rows[50][1], 9)]
    df = vectors_of(spark, rows)
    got = B.top_k(df, df.where("vec_id % 50 = 0"), segment_rows=100, query_rows=3)
    same_as_sql(got, B.TOPK_SQL, embeddings=df.where("vec_id not in (450)").withColumn("embedding", F.col("embedding")))
    nulls = df.withColumn("embedding", F.expr("array(CAST(NULL AS FLOAT))")).withColumn("id", F.lit(1))
    assert B.top_k(nulls, nulls.where("vec_id % 50 = 0")).collect() == []


def test_empty_and_few(spark):
    df = vectors_of(spark, [])
    assert B.top_k(df, df).collect() == []
    df = vectors_of(spark, [(0, [1.0], 0), (None, [1.0], 0), (3, [2.0], 0)])
    assert [tuple(r) for r in B.top_k(df, df.where("vec_id = 0")).collect()] == [(0, 1, 3, 256 * 512)]


def test_tasks_of_many_cells(spark, same_as_sql, monkeypatch):
    """More cells than tasks, two vector lengths, groups that hold blocks of one length only."""
    monkeypatch.setattr(B, "MOST_TASKS", 3)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.normal(size=4 if i % 3 else 2)], 0) for i in range(700)]
    df = vectors_of(spark, rows)
    got = B.top_k(df, df.where("vec_id % 50 = 0"), segment_rows=40, query_rows=2)
    same_as_sql(got, B.TOPK_SQL, embeddings=df)
