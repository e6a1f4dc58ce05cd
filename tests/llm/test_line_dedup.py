import hashlib

from pyspark.sql import functions as F

from tidewater.llm import linededup as L

LINE = "this line is long enough to count"
EDGES = [(1, f"{LINE}\nother line {LINE}\n"), (2, f"  {LINE.upper()}\t\n\nshort"), (3, LINE), (4, None), (5, ""),
         (6, f"{LINE}\n{LINE}"), (7, "short\nshort"), (8, "short"), (9, "ÀÉ" * 12), (10, "àé" * 12), (11, "ÀÉ" * 12),
         (12, "ÀÉ" * 12 + "\x0b")]


def test_edge_cases_against_sql(spark, docs_of, same_as_sql):
    docs = docs_of(EDGES)
    same_as_sql(L.line_report(docs), L.LINES_SQL, documents=docs)


def test_what_stays(docs_of):
    rows = {r.doc_id: r for r in L.line_report(docs_of(EDGES)).collect()}
    assert rows[6].n_dropped == 0  # the largest holder keeps both of its lines
    assert rows[1].n_dropped == rows[2].n_dropped == rows[3].n_dropped == 1
    assert rows[4].n_lines == rows[5].n_lines == 1
    assert rows[9].n_dropped == 1 and rows[10].n_dropped == 0 and rows[12].n_dropped == 0
    assert rows[3].kept_sha256 == hashlib.sha256(b"").hexdigest()


def test_two_documents_are_not_enough_and_repeated_ids_count_once(docs_of):
    rows = L.line_report(docs_of([(1, LINE), (1, LINE), (2, LINE), (None, LINE)])).collect()
    assert len(rows) == 4 and all(r.n_dropped == 0 for r in rows)


def test_empty_table(docs_of):
    assert L.line_report(docs_of([])).collect() == []


def test_bitmap_of_a_long_text(spark, docs_of):
    body = "\n".join(LINE if i % 3 == 0 else f"a line of its own number {i} here" for i in range(1000))
    docs = docs_of([(1, body), (2, LINE), (3, LINE)])
    maps = L.drop_bitmaps(docs).where("doc = 1").first()
    bits = {32 * w.word + b for w in maps.drops for b in range(32) if w.bits >> b & 1}
    assert bits == set(range(0, 1000, 3))
    text = L.dedup_text(docs).where("doc_id = 1").first().text
    assert text == "\n".join(x for x in body.split("\n") if x != LINE)


def test_other_columns_with_clashing_names(docs_of):
    docs = docs_of(EDGES).withColumn("doc", F.lit("x")).withColumn("pos", F.lit(1)).withColumn("h1", F.lit(0))
    out = L.dedup_text(docs)
    assert out.columns == docs.columns and out.count() == len(EDGES)
    assert out.where("doc_id = 4").first().text is None


def test_helper_names_as_columns(docs_of):
    docs = docs_of(EDGES)
    names = ["lines", "kept", "drops", "_lines", "_kept", "_doc", "_drops", "Doc"]
    wide = docs.withColumns({n: F.concat(F.lit(n), F.col("text")) for n in names})
    out = L.dedup_text(wide)
    assert out.columns == wide.columns
    want = {r.doc_id: (r.text, t.text) for r in L.dedup_text(docs).collect() for t in docs.collect() if t.doc_id == r.doc_id}
    for r in out.collect():
        text, before = want[r.doc_id]
        assert r.text == text and all(r[n] == (None if before is None else n + before) for n in names)


def test_a_hot_line_is_spread_over_slices(spark, docs_of):
    docs = docs_of([(i, LINE if i % 3 else f"a line of its own number {i}") for i in range(300)])
    report = L.line_report(docs)
    assert report.where("n_dropped > 0").count() == 199
    plan = L.repeated_lines(L.line_hashes(docs, "doc_id", "text", 20), 3)._jdf.queryExecution().executedPlan().toString()
    assert "rangepartitioning(h1" in plan and "slice" in plan
