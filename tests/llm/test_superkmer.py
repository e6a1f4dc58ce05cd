import hashlib

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import superkmer as S

SPACES = " \t\n\x0b\x0c\r"


def split(text):
    for c in SPACES[1:]:
        text = (text or "").replace(c, " ")
    return [w for w in (text or "").split(" ") if w]


def brute(rows, window):
    """(words, removed, hash) per row, every window compared."""
    texts = [split(t) for _, t in rows]
    places = {}
    for r, words in enumerate(texts):
        for p in range(len(words) - window + 1):
            places.setdefault(tuple(words[p:p + window]), []).append((r, p))
    gone = {(r, p + i) for where in places.values() if len(where) > 1 for r, p in where for i in range(window)}
    out = []
    for r, (i, _) in enumerate(rows):
        kept = " ".join(w for p, w in enumerate(texts[r]) if (r, p) not in gone)
        out.append((i, len(texts[r]), len(texts[r]) - len(split(kept)), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    rows = df.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("h")).collect()
    return sorted((tuple(r) for r in rows), key=repr)


PASSAGE = " ".join(f"p{i}" for i in range(50))
ROWS = [(1, f"intro one {PASSAGE} end"), (2, f"{PASSAGE}\tand more"), (3, None), (4, ""), (5, "\n \x0b"), (6, "short text"),
        (7, " ".join(["same"] * 80)), (8, " ".join(f"u{i}" for i in range(100))), (9, " ".join(f"é{i % 37}" for i in range(120))),
        (None, PASSAGE), (None, None), (11, PASSAGE.upper()), (12, "x " * 34), (13, "x " * 35), (13, "x " * 35)]


def test_edge_cases_equal_brute_force(docs_of):
    assert found(S.dedup_substrings(docs_of(ROWS))) == brute(ROWS, S.WINDOW)


def test_against_sql(docs_of, same_as_sql):
    docs = docs_of([r for r in ROWS[:-1] if r[0]])
    got = S.dedup_substrings(docs).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))
    same_as_sql(got, S.REPEATS_SQL, documents=docs)


def test_empty_table_and_clashing_columns(docs_of):
    assert S.dedup_substrings(docs_of([])).collect() == []
    docs = docs_of(ROWS).withColumn("row", F.lit(1)).withColumn("mark", F.lit(2)).withColumn("spans", F.lit(3))
    assert found(S.dedup_substrings(docs)) == brute(ROWS, S.WINDOW)


def test_very_long_text(docs_of):
    rows = [(1, " ".join(f"w{i}" for i in range(300_000))), (2, " ".join(f"w{i}" for i in range(1000, 1040)))]
    got = {r.doc_id: (r.n_words, r.n_removed) for r in S.dedup_substrings(docs_of(rows)).collect()}
    assert got == {1: (300_000, 40), 2: (40, 40)}


@pytest.mark.parametrize("same_id", [7, None])
def test_a_thousand_copies_of_one_row(spark, docs_of, same_id):
    text = " ".join(f"c{i}" for i in range(400))
    rows = [(same_id, text)] * 1000 + [(1, f"before {text[:900]} after"), (2, " ".join(f"d{i}" for i in range(90)))]
    docs = docs_of(rows).repartition(4)
    named = docs.select(F.coalesce("doc_id", F.lit(-1)).alias("row"), F.xxhash64("text").alias("mark"), "text")
    spans = {r.row: len(r.spans) for r in S.repeated_windows(named).collect()}
    assert max(spans.values()) < 400
    assert found(S.dedup_substrings(docs)) == brute(rows, S.WINDOW)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from("ab"), max_size=40), min_size=1, max_size=8))
def test_small_windows_over_few_words(docs_of, texts):
    rows = [(i, " ".join(t)) for i, t in enumerate(texts)]
    assert found(S.dedup_substrings(docs_of(rows), window=6, m=2)) == brute(rows, 6)
