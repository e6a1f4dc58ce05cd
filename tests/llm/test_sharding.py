"""Exact sizes and the law of the shuffle."""

import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidewater.llm import sharding
from tidewater.llm.queries import QUERIES


def test_drawn_rows_fill_the_room_exactly():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 5, 8, 13):
        room = rng.integers(0, 9, n)
        drawn = int(rng.integers(0, room.sum() + 1))
        got = sharding.split_room(room, drawn, rng)
        assert got.sum() == drawn and (got >= 0).all() and (got <= room).all()


def test_drawn_rows_follow_the_hypergeometric_law():
    rng, room = np.random.default_rng(2), np.array([4, 1, 7, 3, 5])
    got = np.array([sharding.split_room(room, 9, rng) for _ in range(20_000)])
    want = np.random.default_rng(3).multivariate_hypergeometric(room, 9, 20_000)
    assert np.allclose(got.mean(axis=0), 9 * room / 20, atol=0.05)
    assert np.allclose(np.cov(got.T), np.cov(want.T), atol=0.06)


@pytest.mark.parametrize("good,bad,drawn", [(50, 30, 20), (7, 900, 400), (5, 3, 8), (0, 4, 2), (600, 1, 600)])
def test_the_sampler_for_large_populations_has_the_same_law(good, bad, drawn):
    rng = np.random.default_rng(4)
    got = np.array([sharding._draw_large(rng, good, bad, drawn) for _ in range(4000)])
    want = rng.hypergeometric(good, bad, drawn, 4000)
    assert abs(got.mean() - want.mean()) < 0.2 + 0.1 * want.std()
    assert abs(got.std() - want.std()) < 0.1 + 0.1 * want.std()


def test_large_populations_are_drawn():
    n = 40 * 10**9
    got = sharding.split_room(np.array([n // 4] * 4), n // 2, np.random.default_rng(5))
    assert got.sum() == n // 2 and (abs(got - n // 8) < 10**6).all() and len(set(got.tolist())) > 1


def test_matrix_has_both_margins_whatever_the_order_of_its_rows():
    cells, blocks = np.array([5, 0, 9, 3, 7, 1]), np.array([6, 6, 6, 7])
    rows = [sharding.Matrix(cells, blocks, 3).row(c) for c in range(6)]
    assert [r.sum() for r in rows] == cells.tolist() and np.sum(rows, axis=0).tolist() == blocks.tolist()
    again = sharding.Matrix(cells, blocks, 3)
    assert all((again.row(c) == rows[c]).all() for c in (4, 0, 5, 2, 1, 3))


def _check(rows, n, shards):
    slots = {}
    for r in rows:
        slots.setdefault(r.shard, []).append(r.slot)
    sizes = [len(slots.get(s, [])) for s in range(shards)]
    assert sum(sizes) == n and max(sizes) - min(sizes) <= 1
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("n,parts,shards,cell,block", [(1003, 5, 8, 64, 20), (1003, 3, 8, 1 << 16, 1 << 15), (5, 4, 8, 2, 3), (64, 1, 4, 7, 5)])
def test_every_row_once_in_shards_of_exact_sizes(spark, n, parts, shards, cell, block):
    rows = spark.range(0, n, 1, parts).withColumnRenamed("id", "doc_id")
    got = sharding.shard_rows(rows, shards, 1, block, cell).collect()
    assert sorted(r.doc_id for r in got) == list(range(n))
    _check(got, n, shards)


def test_rows_meet_blocks_uniformly():
    """Each row is in each block, and two rows are in one block, as often as in a uniform permutation."""
    cells, blocks, runs = np.array([2, 3, 1]), np.array([2, 1, 3]), 6000
    places, pairs = Counter(), 0
    for seed in range(runs):
        matrix = sharding.Matrix(cells, blocks, seed)
        to = np.concatenate([matrix.targets(c) for c in range(3)])
        places.update(enumerate(to.tolist()))
        pairs += to[0] == to[5]
    for i in range(6):
        assert all(abs(places[i, b] - runs * blocks[b] / 6) < 200 for b in range(3))
    assert abs(pairs - runs * (2 * 1 + 3 * 2) / 30) < 200


def test_seeds_give_other_shuffles(spark):
    rows = spark.range(0, 300, 1, 3)
    orders = [tuple((r.shard, r.slot) for r in sharding.shard_rows(rows, 2, s).sort("id").collect()) for s in (1, 2)]
    assert orders[0] != orders[1]


def test_report_over_nulls_repeats_and_clashing_columns(spark, docs_of, tmp_dir):
    rows = [(None, None), (1, ""), (1, ""), (2, "é\x00"), (3, "x" * 100_000)] + [(9, "same")] * 40
    docs = docs_of(rows).withColumn("shard", F.lit("a")).withColumn("place", F.lit(1)).withColumn("Block", F.lit(2))
    got = sharding.shard_report(docs).collect()
    _check(got, len(rows), 8)
    want = Counter((i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == want
    assert {(r.law, r.grown_shard) for r in got} == {("rows", None)}
    whole = sharding.shard_rows(docs)
    assert {r.place for r in whole.collect()} == {1} and whole.columns.count("shard") == 1
    sharding.write_shards(whole, f"{tmp_dir}/shards")
    assert spark.read.parquet(f"{tmp_dir}/shards").count() == len(rows)
    assert sharding.shard_report(docs.limit(0)).collect() == []


def test_a_rerun_of_a_task_gives_the_same_places(spark, docs_of):
    placed = sharding.shard_rows(docs_of([(i, str(i)) for i in range(200)]).repartition(4))
    assert sorted(placed.collect()) == sorted(placed.collect())


def test_query_over_its_table(spark):
    got = QUERIES["op12_sharding"][0](spark, "/root/testdata/sf0.001").collect()
    _check(got, len(got), 8)
