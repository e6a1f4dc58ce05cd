import itertools

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewater.llm import components, minhash as M


def shingles(text, k):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return frozenset()
    return frozenset(tuple(words[i:i + k]) for i in range(max(1, len(words) - k + 1)))


def brute(rows, k, percent=80):
    """doc -> (size, component), every pair compared."""
    sets = {i: shingles(t, k) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i
    for a, b in itertools.combinations(sets, 2):
        x, y = sets[a], sets[b]
        if x and y and 100 * len(x & y) >= percent * len(x | y):
            lo, hi = sorted((root(a), root(b)))
            parent[hi] = lo
    return {i: (len(sets[i]), root(i)) for i in sets}


def found(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


BASE = [f"w{i}" for i in range(60)]


def edited(n, at=0):
    out = list(BASE)
    for i in range(n):
        out[(at + 7 * i) % 60] = f"x{at}-{i}"
    return " ".join(out)


ROWS = ([(0, None), (1, ""), (2, " \n\t"), (3, "one"), (4, "ONE"), (5, "one two"), (6, "two one"), (7, "é x y")]
        + [(10 + i, edited(i, i)) for i in range(8)] + [(40, " ".join(BASE).upper()), (41, " ".join(BASE[:50]))])


@pytest.mark.parametrize("k", [2, 5])
def test_components_equal_brute_force(docs_of, k):
    assert found(M.near_duplicates(docs_of(ROWS), k=k)) == brute(ROWS, k)


def test_against_sql(docs_of, same_as_sql):
    docs = docs_of(ROWS)
    same_as_sql(M.near_duplicates(docs, k=2), M.LINKS_SQL, documents=docs)


def test_links_between_components_of_a_bucket(docs_of):
    # a chain: neighbours are similar, ends are not, and the smallest id is an end
    words = [f"v{i}" for i in range(100)]
    rows = [(i, " ".join(words[4 * i:] + [f"y{j}" for j in range(4 * i)])) for i in range(12)]
    rows = [(r[0] * 37 % 101, r[1]) for r in rows]
    assert found(M.near_duplicates(docs_of(rows), k=2)) == brute(rows, 2)


def test_null_and_repeated_ids(docs_of):
    rows = [(None, edited(0)), (5, edited(0)), (None, "alone in the world"), (9, "a b c"), (9, "d e f"), (7, "d e f")]
    got = [(r.doc_id, r.component_id, r.kept) for r in M.near_duplicates(docs_of(rows)).collect()]
    assert sorted(got, key=repr) == sorted([(None, 5, False), (5, 5, True), (None, None, True), (9, 7, False),
                                            (9, 7, False), (7, 7, True)], key=repr)


def test_one_per_group_decides_per_text_of_an_id(docs_of):
    rows = [(None, edited(0)), (5, edited(0)), (9, "a b c"), (9, "d e f"), (9, "d e f"), (7, "d e f"), (9, None), (9, ""),
            (2, edited(1)), (2, "x y z"), (11, "g h i"), (11, "G H I"), (12, "only here"), (12, "only here")]
    got = [(r.doc_id, r.text) for r in M.one_per_group(docs_of(rows).repartition(3)).collect()]
    variant = [x for x in got if x[0] == 11]
    assert len(variant) == 1 and variant[0][1].lower() == "g h i"
    assert sorted(set(got) - set(variant), key=repr) == sorted(
        [(None, edited(0)), (9, "a b c"), (7, "d e f"), (9, None), (9, ""), (2, edited(1)), (2, "x y z"), (12, "only here")], key=repr)
    assert len(got) == 9


@pytest.mark.parametrize("ids, want", [((5, 3), {(5, 5), (3, 3), (8, 5), (9, 9)}), ((None, 3), {(None, None), (3, 3), (8, 8), (9, 9)}),
                                       ((None, None), {(None, None), (8, 8), (9, 9)})])
def test_a_thousand_copies_of_two_rows_that_meet_without_a_link(docs_of, ids, want):
    # one minimum a band: sets of similarity 0.6 are sure to share buckets
    texts = edited(0), edited(7)
    rows = [(i, t) for i, t in zip(ids, texts) for _ in range(1000)] + [(8, edited(1)), (9, "apart from all")]
    assert not M.sets_agree(*(next(M.shingle_sets(pa.array([t]), 2)).tobytes() for t in texts), 80)
    got = M.near_duplicates(docs_of(rows).repartition(4), k=2, bands=200, rows=1).collect()
    assert len(got) == 2002 and {(r.doc_id, r.component_id) for r in got} == want


def test_sizes_of_linked_sets_are_at_most_one_class_apart(spark):
    for percent in (50, 80, 95, 100):
        pairs = [(n, -(-n * percent // 100)) for n in range(1, 3000)]
        df = spark.createDataFrame(pairs, "n long, least long")
        apart = F.abs(M.size_class(F.col("n"), percent) - M.size_class(F.col("least"), percent))
        assert df.agg(F.max(apart)).first()[0] <= 1


@pytest.mark.parametrize("repeat", [False, True])
def test_one_per_group_with_clashing_columns(docs_of, repeat):
    rows = ROWS + ([(10, "another text"), (10, edited(0))] if repeat else [])
    names = ["one", "two", "id", "number", "doc", "kept", "_one", "_kept", "Number", "id_of", "number_of"][:9 if repeat else None]
    docs = docs_of(rows)
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("text")) for n in names if n.lower() not in ("number",) or n == "number"})
    out = M.one_per_group(wide)
    assert out.columns == wide.columns
    plain_ = sorted(((r.doc_id, r.text) for r in M.one_per_group(docs).collect()), key=repr)
    got = out.collect()
    assert sorted(((r.doc_id, r.text) for r in got), key=repr) == plain_
    assert all(r[n] == (None if r.text is None else n + r.text) for r in got for n in out.columns[5:])


def test_empty_table(docs_of):
    assert M.near_duplicates(docs_of([])).collect() == []
    assert M.one_per_group(docs_of([])).collect() == []


def test_one_per_group_keeps_columns(docs_of):
    docs = docs_of(ROWS + [(10, edited(0))]).withColumn("node", F.lit(1)).withColumn("key", F.lit("k"))
    out = M.one_per_group(docs)
    assert out.columns == docs.columns
    want = {i for i, (_, c) in brute(ROWS, 5).items() if i == c}
    assert sorted(r.doc_id for r in out.collect()) == sorted(want)


def test_very_long_text(docs_of):
    long = " ".join(f"word{i}" for i in range(60_000))
    rows = [(1, long), (2, long + " end"), (3, "short " + long[:1000])]
    got = found(M.near_duplicates(docs_of(rows)))
    assert got[1] == (59_996, 1) and got[2][1] == 1 and got[3][1] == 3


def test_bitmap_bound_never_rules_out_a_link(spark, docs_of):
    import numpy as np
    import pyarrow as pa
    texts = [edited(i, i) for i in range(8)]
    batch = pa.record_batch([pa.array(range(8)), pa.array(texts)], names=["a", "b"])
    sets = next(M._sets(2, 200)([batch])).to_pylist()
    for x, y in itertools.combinations(sets, 2):
        only = sum((a & ~b & (2**64 - 1)).bit_count() for a, b in zip(x["bits"], y["bits"]))
        both = len(np.intersect1d(np.frombuffer(x["shingles"], np.uint64), np.frombuffer(y["shingles"], np.uint64)))
        assert both <= x["n"] - only


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=40))
def test_components_of_any_graph(spark, edges):
    parent = {}

    def root(i):
        while parent.setdefault(i, i) != i:
            i = parent[i]
        return i
    for a, b in edges:
        lo, hi = sorted((root(a), root(b)))
        parent[hi] = lo
    df = spark.createDataFrame(edges, "x long, y long")
    got = {r.node: r.component for r in components.components(df, "x", "y").collect()}
    assert got == {i: root(i) for a, b in edges if a != b for i in (a, b)}
