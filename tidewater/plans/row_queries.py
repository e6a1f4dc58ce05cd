"""JSON rows, routing and co-group queries over events and the TPC-H-like tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from .. import sources
from ..operators import cogroup as C
from ..operators import rows as R
from .registry import query


@query("json_parse", "PRJ6", sql=r"""
SELECT event_id, json_extract(props, '$.k')::BIGINT AS k,
       (json_extract(props, '$.k') IS NULL) AS missing_k
FROM events
""")
def json_parse(spark, sf_dir):
    ev = sources.table(spark, sf_dir, "events")
    parsed = R.parse_json(ev, "props", "k bigint", keep=["event_id"])
    good = R.good_rows(parsed)
    return good.select("event_id", F.col("row.k").alias("k"), F.col("row.k").isNull().alias("missing_k"))


@query("json_format", "PRJ8", sql=r"""
SELECT to_json(struct_pack(event_id := event_id, event_type := event_type, value := value,
                           user_id := user_id)) AS value
FROM events
""")
def json_format(spark, sf_dir):
    ev = sources.table(spark, sf_dir, "events")
    return R.to_json_text(ev, ["event_id", "event_type", "value", "user_id"])


# JSON rows of three shapes: customers carry only `id` (search), orders carry
# `id` and `id2` (result; `id` is present but null for status 'P'), line items
# carry only `id2` (choice). Returned line items (flag 'R') are cut short, so they
# are not JSON objects and must land in the reject output.
def _route_rows(spark, sf_dir):
    cust = sources.table(spark, sf_dir, "customer").select(
        F.to_json(F.struct(F.col("c_custkey").cast("string").alias("id"),
                           F.col("c_name").alias("name"))).alias("value"))
    orders = sources.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate").select(
        F.to_json(F.struct(
            F.when(F.col("o_orderstatus") != "P", F.col("o_custkey").cast("string")).alias("id"),
            F.col("o_orderkey").cast("string").alias("id2"),
            F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("timestamp")),
            {"ignoreNullFields": "false"}).alias("value"))
    li = sources.table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_returnflag").select(
        F.to_json(F.struct(F.col("l_orderkey").cast("string").alias("id2"),
                           F.col("l_linenumber").alias("choice"))).alias("value"),
        F.col("l_returnflag"))
    li = li.select(F.when(F.col("l_returnflag") == "R",
                          F.expr("substr(value, 1, length(value) - 1)")).otherwise(F.col("value")).alias("value"))
    return cust.unionByName(orders).unionByName(li)


@query("route_kinds", "RTE1 PRJ6 PRJ9", sql=r"""
SELECT kind, count(*)::BIGINT AS n, coalesce(sum(idv), 0)::BIGINT AS sum_id
FROM (
  SELECT 'search' AS kind, c_custkey AS idv FROM customer
  UNION ALL
  SELECT 'result', CASE WHEN o_orderstatus <> 'P' THEN o_custkey END FROM orders
  UNION ALL
  SELECT CASE WHEN l_returnflag = 'R' THEN '_rejected' ELSE 'choice' END, NULL FROM lineitem
)
GROUP BY kind
""")
def route_kinds(spark, sf_dir):
    parsed = R.parse_json(_route_rows(spark, sf_dir), "value")
    rows = R.route_with_rejects(parsed).select("kind", F.col("row")["id"].cast("bigint").alias("idv"))
    return rows.groupBy("kind").agg(F.count(F.lit(1)).alias("n"),
                                    F.coalesce(F.sum("idv"), F.lit(0)).cast("bigint").alias("sum_id"))


@query("cogroup2", "JON1", sql=r"""
SELECT key, tag, value, count(*) OVER (PARTITION BY key, tag)::BIGINT AS n FROM (
  SELECT c_custkey AS key, 'names' AS tag, c_name AS value FROM customer
  UNION ALL SELECT o_custkey, 'orders', o_orderkey::VARCHAR FROM orders)
""")
def cogroup2(spark, sf_dir):
    """The long form: every value keeps its row, with the number of its key's values from the same input."""
    cust = sources.table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    orders = sources.table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey")
    keys = {"names": "c_custkey", "orders": "o_custkey"}
    long = C.cogroup({"names": cust, "orders": orders}, keys)
    values = long.select("key", "tag", F.coalesce(F.col("names.c_name"), F.col("orders.o_orderkey").cast("string")).alias("value"))
    counts = C.cogroup_counts({"names": cust, "orders": orders}, keys)
    n = F.when(F.col("tag") == "names", F.col("n_names")).otherwise(F.col("n_orders"))
    return values.join(counts, "key").select("key", "tag", "value", n.alias("n"))


def _search_result_choice(spark, sf_dir):
    search = sources.table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), "c_name")
    result = sources.table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("id"), F.col("o_orderkey").alias("id2"),
        F.col("o_orderdate").alias("timestamp"))
    choice = sources.table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("id2"), "l_linenumber", "l_quantity")
    return search, result, choice


@query("resolve_ids", "JON2", sql=r"""
SELECT l.l_orderkey AS id2, l.l_linenumber, o.o_custkey AS id
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
""")
def resolve_ids(spark, sf_dir):
    _, result, choice = _search_result_choice(spark, sf_dir)
    resolved, _unmatched = C.resolve_ids(result, choice, "id2", "id", order=["timestamp"])
    return resolved.select("id2", "l_linenumber", "id")


@query("resolve_rejects", "JON2", sql=r"""
SELECT l_orderkey AS id2, l_linenumber
FROM lineitem l WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey AND o.o_orderstatus <> 'F')
""")
def resolve_rejects(spark, sf_dir):
    """Line items whose order is unknown, the orders of one status being left out of the lookup."""
    _, result, choice = _search_result_choice(spark, sf_dir)
    finished = sources.table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("id2"))
    _, unmatched = C.resolve_ids(result.join(finished, "id2", "left_anti"), choice, "id2", "id", order=["timestamp"])
    return unmatched.select("id2", "l_linenumber")


@query("cogroup3", "JON3", sql=r"""
WITH ch AS (SELECT o.o_custkey AS id FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
     u AS (SELECT c_custkey AS id, 'search' AS tag FROM customer
           UNION ALL SELECT o_custkey, 'result' FROM orders
           UNION ALL SELECT id, 'choice' FROM ch)
SELECT id AS key,
       count(*) FILTER (WHERE tag = 'search')::BIGINT AS n_search,
       count(*) FILTER (WHERE tag = 'result')::BIGINT AS n_result,
       count(*) FILTER (WHERE tag = 'choice')::BIGINT AS n_choice
FROM u GROUP BY id
""")
def cogroup3(spark, sf_dir):
    search, result, choice = _search_result_choice(spark, sf_dir)
    resolved, _ = C.resolve_ids(result, choice, "id2", "id", order=["timestamp"])
    return C.cogroup_counts({"search": search, "result": result, "choice": resolved}, "id")


@query("side_input", "JON4 SRC3", sql=r"""
SELECT o_orderkey, o_custkey,
       (SELECT count(*) FROM lineitem)::BIGINT AS total_lines,
       (SELECT max(l_linenumber) FROM lineitem)::BIGINT AS max_linenumber
FROM orders
""")
def side_input(spark, sf_dir):
    orders = sources.table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    li = sources.table(spark, sf_dir, "lineitem")
    one = li.agg(F.count(F.lit(1)).alias("total_lines"),
                 F.max("l_linenumber").cast("bigint").alias("max_linenumber"))
    return C.with_singleton(orders, one)
