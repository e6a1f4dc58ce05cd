import gzip
import os

import pytest
from pyspark.sql import functions as F

from tidewater.llm import warc as W

BIG, SMALL = "ä" * 600, "s" * 999
PAGES = [(1, "http://a/", BIG), (2, "http://b/", BIG), (7, None, BIG), (3, "x", SMALL), (4, "y", SMALL), (5, "z", None),
         (6, "w", ""), (8, "v\r\nInjected: 1", "unique " * 300), (9, "u", "\r\n\r\n" + "b" * 2000), (None, "t", BIG),
         (10, "long", "l" * 3_000_000)]


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_against_sql(spark, same_as_sql):
    pages = pages_of(spark, [p for p in PAGES if p[0]])
    same_as_sql(W.archived_pages(pages), W.WARC_SQL, pages=pages)


def test_revisits(spark):
    rows = W.archived_pages(pages_of(spark, PAGES)).collect()
    got = {r.page_id: (r.record_type, r.refers_to) for r in rows}
    assert len(rows) == len(PAGES)
    assert got[1] == got[2] == ("revisit", 7) and got[7] == ("response", None)
    assert got[3] == got[4] == ("response", None) and got[None] == ("response", None)


def test_repeated_rows_and_empty_table(spark):
    assert W.archived_pages(pages_of(spark, [])).collect() == []
    rows = W.archived_pages(pages_of(spark, [(1, "a", BIG), (1, "a", BIG), (2, "b", BIG), (2, "b", BIG)])).collect()
    assert sorted((r.page_id, r.record_type) for r in rows) == [(1, "revisit")] * 2 + [(2, "response")] * 2


@pytest.fixture
def archive(spark, tmp_path):
    path = str(tmp_path / "archive")
    docs = pages_of(spark, PAGES).withColumn("digest", F.lit(1)).withColumn("holder", F.lit(2))
    W.write_archives(W.page_records(docs).repartition(3), path)
    return path


def test_round_trip_of_payloads_and_headers(spark, archive):
    rows = W.read_archives(spark, archive).where("record_type = 'response'").collect()
    by_id = {r.record_id: r for r in rows}
    for i, url, html in PAGES:
        if i in (1, 2, None):
            continue
        r = by_id[f"<urn:page:{i}>"]
        assert bytes(r.payload) == (html or "").encode()
        assert r.target_uri == (None if url is None else url.replace("\r\n", " "))
        assert int(r.payload_length) == len((html or "").encode())


def test_filters_reach_the_reader_and_payloads_stay_packed(spark, archive):
    df = W.read_archives(spark, archive, payload=False).where("record_type = 'revisit' and refers_to is not null")
    assert df.count() == 2  # pages 1 and 2; the page without an id is a response
    assert all(r.payload is None for r in df.collect())
    reader = W.WarcReader({"path": archive})
    from pyspark.sql.datasource import EqualTo, GreaterThan, In
    left = list(reader.pushFilters([EqualTo(("record_type",), "revisit"), GreaterThan(("date",), "x"),
                                    In(("record_id",), ("<urn:page:1>",))]))
    assert [type(f) for f in left] == [GreaterThan]
    inflated = []

    class Counting(W.GzipRecords):
        def _more(self, most=0):
            out = super()._more(most)
            inflated.append(len(out))
            return out
    W_records, W.GzipRecords = W.GzipRecords, Counting
    try:
        rows = [b.num_rows for p in reader.partitions() for b in reader.read(p)]
    finally:
        W.GzipRecords = W_records
    assert sum(rows) == 1
    assert sum(inflated) < 200_000  # the 3 MB payload was stepped over


def test_partitions_are_planned_by_size(spark, archive):
    assert len(W.WarcReader({"path": archive, "readBytes": "1"}).partitions()) == 3
    assert len(W.WarcReader({"path": archive}).partitions()) == 1


def test_other_writers_archives(spark, tmp_path):
    recs = [W.record({"WARC-Type": "response", "WARC-Record-ID": f"<{i}>"}, b"x" * n) for i, n in enumerate([0, 5, 100_000])]
    os.makedirs(tmp_path / "other")
    (tmp_path / "other" / "a.warc.gz").write_bytes(b"".join(map(gzip.compress, recs)))
    (tmp_path / "other" / "b.warc").write_bytes(b"".join(recs))
    rows = W.read_archives(spark, str(tmp_path / "other")).collect()
    assert sorted((r.record_id, len(r.payload)) for r in rows) == [("<0>", 0)] * 2 + [("<1>", 5)] * 2 + [("<2>", 100_000)] * 2
    assert b"".join(map(W.gzip_member, recs)) and gzip.decompress(b"".join(map(W.gzip_member, recs))) == b"".join(recs)
