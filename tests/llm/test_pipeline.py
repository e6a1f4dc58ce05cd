import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_minhash import brute as components_of
from tidewater.llm import decontaminate, langid, linededup, sentencepiece_unigram as S

SHARED = "this very line stands in several of the documents"
ITEM = "which of these twelve plain words makes the question hard to answer well"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def body(seed, n=60):
    rng = np.random.default_rng(seed)
    return " ".join(rng.choice([f"word{i}" for i in range(500)], n))


def corpus():
    rows = [(i, body(i), "en") for i in range(20)]
    rows += [(30 + i, body(5) + f" tail{i}", "en") for i in range(3)]  # near copies of 5
    rows += [(40 + i, f"{SHARED}\n{body(40 + i)}", "en") for i in range(4)]
    rows += [(50, f"{body(50)} {ITEM} {body(51)}", "en"), (51, body(52) + "\n" + ITEM.upper(), "en")]
    rows += [(60, None, "en"), (61, "", None), (62, "12 34 !!", "en"), (63, "der hund und die straße " + body(63), "de")]
    rows += [(70, body(70), None), (70, body(70), None), (None, body(71), "en"), (71, "é🙂 " + body(72), "en")]
    return rows


def brute(rows, model):
    """The stages in plain Python."""
    import pyarrow as pa
    names, scores = langid.classify(model, pa.array([t for _, t, _ in rows], pa.string()))
    rows = [r for r, n, s in zip(rows, names, scores) if n != "und" and s >= 0.5]
    holders = {}
    for i, t, _ in rows:
        for line in t.split("\n"):
            key = line.strip(" \t\n\x0b\x0c\r").lower()
            if len(key) >= 20 and i is not None:
                holders.setdefault(key, set()).add(i)

    def kept(i, line):
        docs = holders.get(line.strip(" \t\n\x0b\x0c\r").lower(), ())
        return i is None or len(docs) < 3 or i == max(docs)
    rows = [(i, "\n".join(x for x in t.split("\n") if kept(i, x)), la) for i, t, la in rows]
    known = {i: t for i, t, _ in rows if i is not None}
    stays = {i for i, (_, c) in components_of(list(known.items()), 5).items() if i == c}
    rows = [(i, t) for i, t in known.items() if i in stays] + [(i, t) for i, t, _ in rows if i is None]
    item = ITEM.split()

    def holds(t):
        words = t.lower().split()
        code = {w: n for n, w in enumerate(sorted(set(words + item)))}
        return decontaminate.best_fit(np.array([code[w] for w in item]), np.array([code[w] for w in words])) <= 2
    return sorted(((i, t) for i, t in rows if i is None or not holds(t)), key=repr)


def test_pipeline_equals_brute_force(spark, tmp_path, docs_of):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, la, "s", 7) for i, t, la in rows], "doc_id long, text string, lang string, source string, n_chars long")
    d = str(tmp_path / "sf")
    docs.write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(1, ITEM), (2, "short")], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    out = P.run(spark, d)
    assert out.columns == COLUMNS + ["token_ids", "n_tokens", "round_trip"]
    got = out.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == brute(rows, model)
    encoder = S.Encoder(S.load_vocabulary())
    for r in got:
        assert r.token_ids == np.frombuffer(encoder.encode([r.text])[0], "<i4").tolist() and r.round_trip
        assert r.n_chars == len(r.text) and r.n_tokens == len(r.token_ids)


def test_stages_keep_the_columns_and_take_empty_tables(spark, tmp_path, docs_of):
    d = str(tmp_path / "sf")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = docs_of([])
    for name, stage in P.STAGES[:-1]:
        docs = stage(spark, docs, d)
        assert docs.columns == COLUMNS and docs.count() == 0
    assert [n for n, _ in P.STAGES][-1] == "sentencepiece" and linededup.WORD_BITS == 32


def test_registered():
    import __spark_entry__ as E
    q = E.queries()
    assert "pipeline" in q and {n.split("_")[0] for n in q if n.startswith("op") and n[2].isdigit()} == {f"op{i}" for i in range(1, 14)}
    assert all(len([n for n in q if n.startswith(f"op{i}_")]) == 1 for i in range(1, 14))
