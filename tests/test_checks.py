"""Fingerprints of multisets of rows, and live metrics of a stream."""

import pytest
from pyspark.sql import functions as F

from tidewater.operators import checks
from tidewater.operators.observe import StreamMetrics
from tidewater.streaming import jobs

DDL = "a string, b string, n bigint"
ROWS = [("x", None, 1), (None, "x", 1), ("x", "y", None), ("x", "y", None), ("", "", 0)]


def test_order_and_partitions_do_not_matter_but_every_row_does(spark):
    df = spark.createDataFrame(ROWS, DDL)
    assert checks.same_rows(spark.createDataFrame(ROWS[::-1], DDL).repartition(3), df)
    other = [ROWS[:-1], ROWS + ROWS[:1], [(None, "x", 1), (None, "x", 1), *ROWS[2:]], [("x", None, None), *ROWS[1:]],
             [*ROWS[:-1], (None, "", 0)], []]
    for rows in other:
        assert not checks.same_rows(spark.createDataFrame(rows, DDL), df), rows
    assert checks.same_rows(df.limit(0), df.limit(0))


def test_parts_add_up(spark):
    df = spark.createDataFrame(ROWS, DDL)
    parts = checks.fingerprint(df.where("n = 1")).union(checks.fingerprint(df.where("n <> 1 or n is null")))
    whole = parts.agg(*[F.sum(c).alias(c) for c in ("n", "h1", "h2")])
    assert whole.collect() == checks.fingerprint(df).collect()


def test_a_mismatch_tells_the_rows(spark):
    df = spark.createDataFrame(ROWS, DDL)
    checks.expect_rows(df, df)
    with pytest.raises(checks.ContentMismatch, match="1 expected rows missing, 0 unexpected"):
        checks.expect_rows(df.where("a is not null"), df)


def test_metrics_of_every_batch(spark, tmp_dir):
    seen, rows, running = StreamMetrics("m"), spark.range(100), []

    def start():
        s = spark.readStream.schema("id long").parquet(jobs.step_files(f"{tmp_dir}/f")).observe(
            "m", F.count(F.lit(1)).alias("n"), F.max("id").alias("most"))
        running.append(s.writeStream.format("noop").option("checkpointLocation", f"{tmp_dir}/c").trigger(**jobs.AT_ONCE).start())
        return running[0]
    spark.streams.addListener(seen)
    try:
        jobs.replay(rows, (F.col("id") / 40).cast("int"), 3, f"{tmp_dir}/f", lambda r, p: r.write.parquet(p), start)
        seen.wait_for(running[0])
    finally:
        spark.streams.removeListener(seen)
    got = seen.table(spark, "n bigint, most bigint").where("n > 0").orderBy("batch_id")
    assert [(r.n, r.most) for r in got.collect()] == [(40, 39), (40, 79), (20, 99)]
