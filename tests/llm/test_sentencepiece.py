import functools
import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import sentencepiece_unigram as S

EDGE = ["a  b   c", "   ", "\n\n x", "▁▁ y", "é🙂日本語\x00 z", "x" * 300, " lead", "tail ", "", "\t", "ﬀ\u200b", "word\nword", "🙂" * 40]


@functools.lru_cache
def vocabulary():
    return S.load_vocabulary()


def encode(text):
    return np.frombuffer(S.Encoder(vocabulary()).encode([text])[0], "<i4").tolist()


def decode(ids):
    return S.Decoder(vocabulary()).decode(np.array(ids, dtype=np.int64))


def test_trie_holds_exactly_the_pieces():
    trie = vocabulary().trie
    for i in list(range(259, 2000)) + [31999]:
        node = np.zeros(1, dtype=np.int64)
        for b in S.MARKER.encode()[:0] + vocabulary().pieces[i].encode():
            node = trie.step(node, np.array([b]))
            assert node[0] > 0
        assert trie.value[node[0]] == i + 1


def best_path(text):
    """The best score over all segmentations, by plain recursion over characters."""
    pieces = {p: s for p, s, k in zip(vocabulary().pieces, vocabulary().scores, vocabulary().kinds) if k == S.NORMAL}
    marked = S.MARKER + text.replace(" ", S.MARKER)
    best = [0.0] + [-np.inf] * len(marked)
    for e in range(1, len(marked) + 1):
        for s in range(max(0, e - 20), e):
            if marked[s:e] in pieces:
                best[e] = max(best[e], best[s] + pieces[marked[s:e]])
        if marked[e - 1] not in pieces:
            best[e] = max(best[e], best[e - 1] + vocabulary().penalty)
    return best[-1]


def score(ids):
    """The score of ids; a run of byte pieces counts once per character."""
    v, total, raw = vocabulary(), 0.0, b""
    for i in ids:
        if v.kinds[i] == S.BYTE:
            raw += bytes([int(v.pieces[i][1:-1], 16)])
        else:
            total += v.scores[i]
    return total + v.penalty * len(raw.decode())


@pytest.mark.parametrize("text", [t for t in EDGE if t] + ["the quick brown fox", "Straße über", "ciónasbo menteta"])
def test_the_path_is_the_best(text):
    assert score(encode(text)) == best_path(text)


@settings(max_examples=200, deadline=None)
@given(st.text(max_size=60))
def test_round_trip(text):
    assert decode(encode(text)) == text.replace(S.MARKER, " ")


def plain(text):
    """Ids of a chunk by the side-by-side search alone."""
    return S.viterbi(vocabulary(), [text.encode()])[0].tolist()


@settings(max_examples=150, deadline=None)
@given(st.text(alphabet="abExx=/+0é日🙂▁", max_size=400))
def test_long_chunks_by_parts_and_by_walking_equal_the_search(text):
    if text:
        data = np.frombuffer(text.encode() + b"\0", dtype=np.uint8)
        assert S.segment_long(vocabulary(), text.encode()).tolist() == plain(text)
        assert S.walk(vocabulary(), data).tolist() == plain(text)


def test_blocks_of_any_size_give_the_same(monkeypatch):
    rng = np.random.default_rng(1)
    text = "".join(rng.choice(list("abcdeXYZ019+/é日🙂"), 1500)) + "x" * 900 + "information" * 100
    want = plain(text)
    for block in (1 << 18, 64, 7, 1):
        monkeypatch.setattr(S, "BLOCK", block)
        assert S.segment_long(vocabulary(), text.encode()).tolist() == want
        assert S.walk(vocabulary(), np.frombuffer(text.encode() + b"\0", dtype=np.uint8)).tolist() == want


@pytest.mark.parametrize("letters", ["abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/", "x", "日本語文字", "ab"])
def test_two_megabytes_without_a_space(letters):
    text = "".join(np.random.default_rng(2).choice(list(letters), 2_000_000 // len(letters[0].encode())))
    began = time.perf_counter()
    ids = encode(text)
    assert time.perf_counter() - began < 20
    assert decode(ids) == text


def test_unused_pieces_are_never_written(monkeypatch):
    listed = [("<unk>", 0.0, S.UNKNOWN), ("a", -1.0, S.NORMAL), ("b", -1.5, S.NORMAL), ("ab", -1.0, S.UNUSED),
              ("ba", -2.25, S.NORMAL), (S.MARKER, -0.5, S.NORMAL)]
    monkeypatch.setattr(S, "read_pieces", lambda path: listed)
    small = S.load_vocabulary("any")
    ids = np.frombuffer(S.Encoder(small).encode(["abab"])[0], "<i4").tolist()
    assert [listed[i][0] for i in ids] == [S.MARKER, "a", "ba", "b"]


def test_tables(spark, docs_of):
    docs = docs_of([(i, t) for i, t in enumerate(EDGE)] + [(None, None), (1, EDGE[1]), (99, "long text " * 100_000)])
    coded = S.encode_table(docs, vocabulary())
    rows = coded.collect()
    assert len(rows) == len(EDGE) + 3
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<i4").tolist()
        assert r.n_tokens == len(ids)
        if r.doc_id is not None and r.doc_id < len(EDGE):
            assert ids == encode(EDGE[r.doc_id]) and r.round_trip == (S.MARKER not in EDGE[r.doc_id])
    clash = docs.withColumn("ids", F.lit("x")).withColumn("n_tokens", F.lit(0))
    back = S.round_trip(clash, vocabulary())
    assert back.columns == [*docs.columns, "ids", "token_ids", "n_tokens", "round_trip"]
    assert back.where("text is null").first().n_tokens == 0
    assert {r.doc_id: r.text for r in back.collect() if r.doc_id in range(len(EDGE))} == dict(enumerate(EDGE))
    assert back.where("doc_id = 99").first().n_tokens == len(encode("long text " * 100_000))
    assert S.round_trip(docs_of([]), vocabulary()).collect() == []
