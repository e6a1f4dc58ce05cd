from pyspark.sql import functions as F

from tidewater.llm import hostreputation as H
from tidewater.llm import queries
from tidewater.llm.hostreputation import URLS_SQL

PAGES = [(1, "https://A.Example.ORG/es/x?y#z"), (2, "http://example.org/en/12"), (3, "http://example.org"),
         (4, "http://badexample.org/es/"), (5, "ftp://x.com/fr/a"), (6, "http://com/de/a"), (7, "http://a.com?x=://b/c"),
         (8, None), (9, ""), (10, "no scheme/at/all"), (11, "http:///path"), (12, "http://a.net/p#q?r"),
         (13, "x://y://z/w"), (14, "http://user@a.com:80/de/"), (15, "http://a.com/FR/"), (15, "http://a.com/FR/")]


def _tables(spark, labels):
    pages = spark.createDataFrame([(i, u, "<p>") for i, u in PAGES] + [
        (100 + i, f"http://{'bad' if i % 2 else 'good'}.site{i % 3}.net/p{i}", None) for i in range(60)],
        "page_id long, url string, html string")
    return pages, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


LABELS = [(100 + i, 0 if i % 2 else 1, 0) for i in range(0, 54)] + [(1, None, None), (2, 1, None), (None, 0, 1), (3, 1, 1), (3, 1, 0)]


def test_against_sql(spark, same_as_sql):
    pages, labels = _tables(spark, LABELS)
    got = H.judge_urls(pages, labels).select("page_id", "host", "path", "rule", "verdict")
    same_as_sql(got.distinct(), URLS_SQL.replace("SELECT parts.page_id", "SELECT DISTINCT parts.page_id"),
                pages=pages.distinct(), labels=labels)


def test_rules_and_reputation(spark):
    pages, labels = _tables(spark, LABELS)
    rows = {r.page_id: r for r in H.judge_urls(pages, labels).collect()}
    assert (rows[1].host, rows[1].path, rows[1].rule, rows[1].verdict) == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert rows[2].rule == "example.org/en/1" and rows[3].rule is None and rows[4].rule == "org/"
    assert rows[5].verdict == "allow" and rows[6].rule == "com/de/" and rows[7].host == "a.com" and rows[7].path == ""
    for i in (8, 9, 10):
        assert (rows[i].host, rows[i].path, rows[i].rule, rows[i].verdict) == ("", "", None, "allow")
    assert rows[11].host == "" and rows[11].path == "/path" and rows[13].host == "y:"
    assert rows[101].verdict == "block" and rows[100].verdict == "allow"
    # an unlabelled host takes after its domain
    assert rows[101].alpha < rows[101].beta


def test_without_labels_and_empty(spark):
    pages, labels = _tables(spark, [])
    assert {r.verdict for r in H.judge_urls(pages, labels).where("rule is null").collect()} == {"allow"}
    assert H.judge_urls(pages.limit(0), labels).collect() == []


def test_clashing_columns_and_no_python(spark):
    pages, labels = _tables(spark, LABELS)
    pages = pages.withColumn("host", F.lit("h")).withColumn("n", F.lit(1)).withColumn("mu", F.lit(2))
    out = H.judge_urls(pages, labels.withColumn("page", F.lit(1)))
    assert out.count() == len(PAGES) + 60
    assert "Python" not in out._jdf.queryExecution().executedPlan().toString()
    assert "op3_host_reputation" in queries.queries()
