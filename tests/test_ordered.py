"""Skew-safe lead and sessions against brute force, with tiny buckets and a hot key."""

import datetime as dt
import random

import pandas as pd
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.operators import ordered

BASE = dt.datetime(2024, 1, 1)
GAP_MS = 60 * 60_000


def _frame(spark, rows):
    return spark.createDataFrame(rows, "k string, ts timestamp, id long, v double")


def _brute_sessions(rows):
    out = []
    df = pd.DataFrame(rows, columns=["k", "ts", "id", "v"])
    for k, g in df.groupby("k"):
        g = g.sort_values(["ts", "id"])
        cur = None
        for r in g.itertuples(index=False):
            if cur is None or (r.ts - cur["last"]) >= pd.Timedelta(milliseconds=GAP_MS):
                if cur:
                    out.append(cur)
                cur = {"k": k, "start": r.ts, "last": r.ts, "n": 0, "id": r.id}
            if r.ts > cur["last"]:
                cur["id"] = r.id
            cur["last"], cur["n"] = r.ts, cur["n"] + 1
        out.append(cur)
    return sorted((s["k"], s["start"], s["last"], s["n"], s["id"]) for s in out)


def _spark_sessions(spark, rows, bucket_ms):
    s = ordered.sessionize(_frame(spark, rows), "k", "ts", "id", GAP_MS, ["id", "v"], bucket_ms)
    return sorted((r.k, pd.Timestamp(r.session_start), pd.Timestamp(r.last_ts), r.n_events, r.latest.id)
                  for r in s.collect())


def _rows(n, keys, span_min, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n):
        k = "hot" if rnd.random() < 0.5 else rnd.choice(keys)
        rows.append((k, BASE + dt.timedelta(minutes=rnd.randint(0, span_min),
                                            microseconds=rnd.choice([0, 0, 1, 999])), i, float(i)))
    return rows


def test_session_gap_edges(spark):
    t0 = BASE
    rows = [("a", t0, 1, 1.0), ("a", t0 + dt.timedelta(minutes=60), 2, 2.0),
            ("b", t0, 3, 1.0), ("b", t0 + dt.timedelta(minutes=60) - dt.timedelta(microseconds=1), 4, 2.0)]
    got = _spark_sessions(spark, rows, 3_600_000)
    assert [(k, n) for k, _, _, n, _ in got] == [("a", 1), ("a", 1), ("b", 2)]


def test_equal_time_keeps_first(spark):
    rows = [("a", BASE, 5, 1.0), ("a", BASE, 3, 2.0), ("a", BASE, 9, 3.0)]
    got = _spark_sessions(spark, rows, 60_000)
    assert got[0][4] == 3


def test_sessions_hot_key_tiny_buckets(spark):
    rows = _rows(600, ["a", "b", "c"], 24 * 60, seed=7)
    want = _brute_sessions(rows)
    for bucket_ms in (60_000, 7 * 60_000, 3_600_000, 86_400_000):
        assert _spark_sessions(spark, rows, bucket_ms) == want, bucket_ms


@settings(max_examples=12, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 600)), min_size=1, max_size=60),
       st.sampled_from([60_000, 600_000, 3_600_000]))
def test_sessions_property(spark, evs, bucket_ms):
    rows = [(k, BASE + dt.timedelta(minutes=m), i, float(i)) for i, (k, m) in enumerate(evs)]
    assert _spark_sessions(spark, rows, bucket_ms) == _brute_sessions(rows)


def test_lead_hot_key_tiny_buckets(spark):
    rows = _rows(500, ["a", "b"], 600, seed=3)
    df = _frame(spark, rows).withColumn("ms", F.unix_millis("ts"))
    pdf = pd.DataFrame(rows, columns=["k", "ts", "id", "v"]).sort_values(["k", "ts", "id"])
    pdf["nxt"] = pdf.groupby("k")["id"].shift(-1)
    want = {int(r.id): (None if pd.isna(r.nxt) else int(r.nxt)) for r in pdf.itertuples()}
    for bucket_ms in (60_000, 3_600_000):
        got = ordered.lead_within(df, "k", "ts", "id", "id", "nxt", bucket_ms)
        assert {r.id: r.nxt for r in got.collect()} == want


def test_lead_plan_has_one_data_shuffle_per_side(spark):
    df = _frame(spark, _rows(50, ["a"], 100, seed=1))
    plan = ordered.lead_within(df, "k", "ts", "id", "id", "nxt")._jdf.queryExecution().executedPlan().toString()
    assert "Window" in plan


def _partition_shares(df, used="nxt"):
    # Aggregating a computed column keeps the ordering work in the plan.
    rows = df.groupBy(F.spark_partition_id().alias("p")).agg(
        F.count(F.lit(1)).alias("n"), F.max(used).alias("m")).collect()
    counts = [r.n for r in rows]
    return max(counts) / sum(counts), len(counts)


def test_single_hot_key_spreads_over_tasks(spark):
    from tidewater.session import conf_override
    ev = spark.read.parquet("/root/testdata/sf0.01/events.parquet") \
              .select(F.lit("hot").alias("k"), F.col("ts").cast("timestamp").alias("ts"),
                      F.col("event_id").alias("id"), F.unix_millis(F.col("ts").cast("timestamp")).alias("ms"))
    with conf_override(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": 8}):
        led = ordered.lead_within(ev, "k", "ts", "id", "ms", "nxt")
        share, parts = _partition_shares(led)
        assert parts == 8 and share < 0.25
        from pyspark.sql import Window
        naive = ev.withColumn("nxt", F.lead("ms").over(Window.partitionBy("k").orderBy("ts", "id")))
        assert _partition_shares(naive)[0] == 1.0
        assert sorted(r.nxt or 0 for r in led.collect()) == sorted(r.nxt or 0 for r in naive.collect())


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["p", "q", "r"]), st.integers(0, 300)), min_size=1, max_size=50),
       st.sampled_from([60_000, 300_000, 3_600_000]))
def test_lead_property(spark, evs, bucket_ms):
    rows = [(k, BASE + dt.timedelta(minutes=m), i, float(i)) for i, (k, m) in enumerate(evs)]
    got = ordered.lead_within(_frame(spark, rows), "k", "ts", "id", "id", "nxt", bucket_ms)
    pdf = pd.DataFrame(rows, columns=["k", "ts", "id", "v"]).sort_values(["k", "ts", "id"])
    pdf["nxt"] = pdf.groupby("k")["id"].shift(-1)
    want = {int(r.id): (None if pd.isna(r.nxt) else int(r.nxt)) for r in pdf.itertuples()}
    assert {r.id: r.nxt for r in got.collect()} == want


def test_a_hot_slice_of_time_is_spread_and_exact(spark):
    """Nearly all rows are one key's and lie within an hour: narrow cells spread them, results stay exact."""
    from tidewater.session import conf_override
    rnd = random.Random(11)
    rows = [("hot", BASE + dt.timedelta(seconds=rnd.randint(0, 3000), microseconds=rnd.choice([0, 5])), i, float(i))
            for i in range(2000)]
    rows += [("cold", BASE + dt.timedelta(minutes=m), 10_000 + m, 0.0) for m in (0, 30, 200)]
    df = _frame(spark, rows)
    with conf_override(spark, {"spark.sql.adaptive.enabled": "false", "spark.sql.shuffle.partitions": 8}):
        led = ordered.lead_within(df, "k", "ts", "id", "id", "nxt")
        share, _ = _partition_shares(led)
        assert share < 0.5
    pdf = pd.DataFrame(rows, columns=["k", "ts", "id", "v"]).sort_values(["k", "ts", "id"])
    pdf["nxt"] = pdf.groupby("k")["id"].shift(-1)
    want = {int(r.id): (None if pd.isna(r.nxt) else int(r.nxt)) for r in pdf.itertuples()}
    assert {r.id: r.nxt for r in led.collect()} == want
    # Sessions across cells (a gap shorter than the cell and than the spread).
    gap = 20_000
    s = ordered.sessionize(df, "k", "ts", "id", gap, ["id"], 60_000)
    got = sorted((r.k, pd.Timestamp(r.session_start), pd.Timestamp(r.last_ts), r.n_events, r.latest.id)
                 for r in s.collect())
    global GAP_MS
    old, GAP_MS = GAP_MS, gap
    try:
        assert got == _brute_sessions(rows)
    finally:
        GAP_MS = old


def test_lead_of_a_time_equals_lead_of_the_value(spark):
    df = _frame(spark, _rows(300, ["a", "b"], 60, seed=5)).withColumn("ms", F.unix_millis("ts"))
    by_value = ordered.lead_within(df, "k", "ts", "id", "ms", "nxt")
    by_time = ordered.lead_within(df, "k", "ts", "id", None, "nxt", of_time=F.unix_millis)
    assert sorted((r.id, r.nxt or 0) for r in by_value.collect()) == sorted((r.id, r.nxt or 0) for r in by_time.collect())
    plan = by_time._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan


def _next_ids(rows):
    pdf = pd.DataFrame(rows, columns=["k", "ts", "id", "v"]).sort_values(["k", "ts", "id"])
    pdf["nxt"] = pdf.groupby("k")["id"].shift(-1)
    return {int(r.id): (None if pd.isna(r.nxt) else int(r.nxt)) for r in pdf.itertuples()}


def _ranged_sessions(spark, rows, partitions):
    s = ordered.sessionize(_frame(spark, rows), "k", "ts", "id", GAP_MS, ["id", "v"], by_range=True, partitions=partitions)
    return sorted((r.k, pd.Timestamp(r.session_start), pd.Timestamp(r.last_ts), r.n_events, r.latest.id) for r in s.collect())


def test_ranges_give_the_same_lead_and_sessions(spark):
    rows = _rows(400, ["a", "b", "c"], 24 * 60, seed=13)
    for n in (1, 5, 40):
        got = ordered.lead_within(_frame(spark, rows), "k", "ts", "id", "id", "nxt", by_range=True, partitions=n)
        assert {r.id: r.nxt for r in got.collect()} == _next_ids(rows)
        assert _ranged_sessions(spark, rows, n) == _brute_sessions(rows)


def test_a_burst_at_one_instant_is_split(spark):
    """All rows but three are one key's at one instant: no cell holds more than a few times its part."""
    rows = [("hot", BASE, i, float(i)) for i in range(4000)]
    rows += [("cold", BASE, 5000, 0.0), ("hot", BASE + dt.timedelta(minutes=59), 4000, 0.0),
             ("hot", BASE + dt.timedelta(minutes=119), 4001, 0.0)]
    random.Random(2).shuffle(rows)
    cells = ordered.range_cells(_frame(spark, rows), "k", "ts", "id", partitions=8)
    sizes = [r["count"] for r in cells.groupBy(ordered._BKT).count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * len(rows) / 8
    got = ordered.lead_within(_frame(spark, rows), "k", "ts", "id", "id", "nxt", by_range=True, partitions=8)
    assert {r.id: r.nxt for r in got.collect()} == _next_ids(rows)
    assert _ranged_sessions(spark, rows, 8) == _brute_sessions(rows)


def test_ranges_of_nothing_and_of_nulls(spark):
    assert _ranged_sessions(spark, [], 3) == []
    rows = [("a", None, 1, 0.0), ("a", BASE, 2, 0.0), (None, BASE, 3, 0.0), (None, BASE, 4, 0.0)]
    got = ordered.lead_within(_frame(spark, rows), "k", "ts", "id", "id", "nxt", by_range=True, partitions=4)
    assert {r.id: r.nxt for r in got.collect()} == {1: None, 2: None, 3: 4, 4: None}
    assert [x[0] for x in _ranged_sessions(spark, [r for r in rows if r[0]], 4)] == ["a"]
