"""Exact ranking against SQL, and the parts of the index against plain versions."""

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import lexical


@given(st.lists(st.integers(0, 2**40)))
@settings(max_examples=60, deadline=None)
def test_varints_round_trip(values):
    data, starts = lexical.varints(np.array(values, dtype=np.int64))
    assert lexical.from_varints(data).tolist() == values and len(starts) == len(values) + 1


@given(st.lists(st.tuples(st.integers(0, 3), st.integers(1, 5), st.integers(1, 9)), min_size=1))
@settings(max_examples=80, deadline=None)
def test_fronts_bound_every_score_of_their_block(rows):
    rows.sort()
    block, tf, n = (np.array(x) for x in zip(*rows))
    block = np.unique(block, return_inverse=True)[1]
    best = lexical._fronts(block, tf, n)
    score = lexical.impact(tf, 10 + 7 * n)
    for b in np.unique(block):
        assert score[block == b].max() == score[best[block[best] == b]].max()


def test_pieces_cut_outside_of_terms(monkeypatch):
    monkeypatch.setattr(lexical, "PIECE_BYTES", 10)
    raw = ("word " * 9 + "x" * 40 + " é" * 9).encode()
    parts = list(lexical.pieces(raw))
    assert b"".join(parts) == raw and len(parts) > 3
    split = [t for p in parts for t in lexical._TERM_BYTES.findall(p)]
    assert split == lexical._TERM_BYTES.findall(raw)


def _docs(n, words=40, seed=0):
    rng = np.random.default_rng(seed)
    return [(i, " ".join(f"w{x}" for x in np.minimum(rng.zipf(1.3, rng.integers(1, words)), 300))) for i in range(n)]


@pytest.mark.parametrize("rows,pairs", [(1 << 17, 1 << 15), (40, 8)])
def test_ranking_is_that_of_sql(spark, docs_of, same_as_sql, monkeypatch, rows, pairs):
    monkeypatch.setattr(lexical, "SEGMENT_ROWS", rows)
    docs = docs_of(_docs(600) + [(None, "w1 w2"), (None, None), (7, ""), (3, "w1 w2"), (3, "w1 w2")] + [(9, "w5 w6 w7")] * 30)
    asked = [(1, "w1 w2 w3"), (2, "W5, w6-w7 w7"), (3, None), (4, ""), (5, "absent"), (6, "w1"), (6, "w200 w150 w1 w2 w3 w4"), (6, "w1"), (None, "w9")]
    items = spark.createDataFrame(asked, "item_id long, text string")
    got = lexical.search(lexical.build_index(docs.repartition(3)), items, query_pairs=pairs)
    same_as_sql(got, lexical.SEARCH_SQL, documents=docs, benchmark=items)


def test_lists_left_over_are_not_decompressed(monkeypatch):
    """A common term's blocks without a candidate stay compressed."""
    segment = lexical.Segment(0)
    for i in range(2000):
        segment.add(i, "common " * (1 + i % 3) + ("rare rarer" if i % 500 == 7 else "") + " filler" * (i % 5))
    rows = [r for b in segment.batches() for r in b.to_pylist()]
    counts = lexical.Counts(rows[0]["df"], rows[0]["total"])
    m = counts.norm(np.frombuffer(rows[0]["packed"], dtype=np.int64))
    lists = {r["term"]: lexical.Postings(w, r["heads"], r["fronts"], r["packed"], m, counts)
             for r in rows[1:] for w in [{"common": 1, "rare": 6000, "rarer": 6000}.get(r["term"], 0)]}
    read = []
    monkeypatch.setattr(lexical.Postings, "_decoded", lambda self, lo, hi, plain=lexical.Postings._decoded:
                        read.extend([(self.w, b) for b in range(lo, hi)]) or plain(self, lo, hi))
    docs, score = lexical.best_in_segment(list(lists.values()), 2000, 3)
    assert set(docs.tolist()) <= {7, 507, 1007, 1507} and len(docs) >= 3
    assert 0 < sum(w == 1 for w, _ in read) <= 4 < len(lists["common"].last)


def test_terms_keep_what_is_beyond_ascii(spark, docs_of, same_as_sql):
    docs = docs_of([(1, "É été_2x ﬁ"), (2, "été"), (3, " x2"), (4, "a\x00b"), (5, "word" * 5000)])
    items = spark.createDataFrame([(1, "été É"), (2, "B 2X"), (3, "word" * 5000)], "item_id long, text string")
    same_as_sql(lexical.search(lexical.build_index(docs), items), lexical.SEARCH_SQL, documents=docs, benchmark=items)


def test_empty_tables_and_clashing_columns(spark, docs_of):
    docs, items = docs_of(_docs(5)), spark.createDataFrame([(1, "w1")], "item_id long, text string")
    more = docs.withColumn("segment", F.lit("x")).withColumn("term", F.lit("y"))
    asked = items.withColumn("item", F.lit("z")).withColumn("terms", F.lit(0)).withColumn("rank", F.lit(0))
    assert lexical.search(lexical.build_index(more), asked).count() > 0
    assert lexical.search(lexical.build_index(docs.limit(0)), items).collect() == []
    assert lexical.search(lexical.build_index(docs), items.limit(0)).collect() == []
