import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidewater.llm import langid as L
from tidewater.sources import table

TRAIN = [(1, "the cat sat on the mat and the dog", "en"), (2, "with that and this", "en"),
         (3, "der hund und die katze", "de"), (4, "über die straße und", "de"), (5, None, "fr"), (6, "nobody knows", None)]


@pytest.fixture
def trained(spark):
    docs = spark.createDataFrame(TRAIN, "doc_id long, text string, lang string")
    return L.train(docs, order=2)


def brute_bits(lang, text, order=2):
    """Code length by plain dictionaries: method C, no exclusion, uniform bytes below order 0."""
    seen = {}
    for _, t, la in TRAIN:
        if la == lang and t:
            data = t.encode()
            for k in range(order + 1):
                for i in range(k, len(data)):
                    seen.setdefault(data[i - k:i], {}).setdefault(data[i], 0)
                    seen[data[i - k:i]][data[i]] += 1
    data, bits = text.encode(), 0.0
    for i, b in enumerate(data):
        for k in range(min(order, i), -1, -1):
            counts = seen.get(data[i - k:i])
            if not counts:
                continue
            n, d = sum(counts.values()), len(counts)
            if b in counts:
                bits -= math.log2(counts[b] / (n + d))
                break
            bits -= math.log2(d / (n + d))
        else:
            bits += 8
    return bits


@pytest.mark.parametrize("text", ["the dog and the cat", "die katze über dem hund", "x", "日本 the", "zzzz\x00", "und that"])
def test_code_lengths_equal_a_plain_coder(trained, text):
    data = np.frombuffer(text.encode(), np.uint8)
    bits = L.code_lengths(trained, data, np.array([0, len(data)]), block=5)[0]
    assert trained.languages == ["de", "en"]
    for lang, b in zip(trained.languages, bits):
        assert b == pytest.approx(brute_bits(lang, text))


def test_edge_cases(spark, trained, docs_of):
    rows = [(1, "the cat"), (2, "die straße"), (3, None), (4, ""), (5, "12 34 !?"), (None, "and the"), (1, "the cat"),
            (6, "the cat and the dog " * 50_000)]
    docs = docs_of(rows).withColumn("lang_pred", F.lit("x")).withColumn("score", F.lit(2))
    got = sorted(((r.doc_id, r.lang_pred) for r in L.identify(docs, trained).collect()), key=repr)
    assert got == sorted([(1, "en"), (2, "de"), (3, "und"), (4, "und"), (5, "und"), (None, "en"), (1, "en"), (6, "en")], key=repr)
    scores = [r.score for r in L.identify(docs, trained).collect()]
    assert all(0 <= s <= 1 for s in scores)
    kept = L.keep_identified(docs, trained)
    assert kept.columns == docs.columns and kept.count() == 5


def test_nothing_learned(spark, docs_of):
    model = L.train(docs_of([(1, "text without a language")]))
    assert [r.lang_pred for r in L.identify(docs_of([(1, "abc")]), model).collect()] == ["und"]
    assert L.identify(docs_of([]), model).collect() == []


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    out = L.held_out(F.col("doc_id"))
    found = L.identify(docs.where(out), L.train(docs.where(~out)))
    both = found.join(docs.select("doc_id", "lang"), "doc_id")
    assert both.where("lang = lang_pred").count() >= 0.99 * both.count() > 0


def test_slices_do_not_matter(trained):
    texts = pa.array(["the cat", None, "", "die katze und", "that"] * 50)
    one = L.classify(trained, texts)
    parts = [L.classify(trained, texts.slice(i, 7)) for i in range(0, len(texts), 7)]
    assert one[0] == [n for p in parts for n in p[0]]


def test_no_language_evicts_another(spark):
    often = [(i, f"{i * 7919} frequent words {i * 104729} of one language {i * 1299709}", "en") for i in range(300)]
    rare = [(1000, "der hund und die katze", "de"), (1001, "die straße und der hund", "de")]
    schema = "doc_id long, text string, lang string"
    both = L.train(spark.createDataFrame(often + rare, schema), max_nodes=200)
    alone = L.train(spark.createDataFrame(rare, schema), max_nodes=200)
    data = np.frombuffer("und der hund die straße".encode(), np.uint8)
    ends = np.array([0, len(data)])
    assert both.languages == ["de", "en"]
    assert L.code_lengths(both, data, ends)[0][0] == pytest.approx(L.code_lengths(alone, data, ends)[0][0])


def test_all_languages_are_learned(spark):
    rows = [(i, chr(0x4E00 + 7 * i) * 5, f"l{i:03}") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = L.identify(docs, L.train(docs)).join(docs, "doc_id")
    assert found.where("lang_pred = lang").count() == 300


def test_sparse_model_gives_the_same_code_lengths(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    full = L.train(docs, max_nodes=3000)
    monkeypatch.setattr(L.build_model, "__defaults__", (0,))
    sparse = L.train(docs, max_nodes=3000)
    assert isinstance(sparse, L.SparseModel) and isinstance(full, L.Model) and sparse.languages == full.languages
    texts = [r.text or "" for r in docs.limit(50).collect()] + ["", "日本 the", "zzzz\x00", "é"]
    data = [t.encode() for t in texts]
    ends = np.cumsum([0] + [len(d) for d in data])
    raw = np.frombuffer(b"".join(data), np.uint8)
    assert L.code_lengths(sparse, raw, ends, block=1000) == pytest.approx(L.code_lengths(full, raw, ends))
