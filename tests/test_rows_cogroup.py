import pytest
from pyspark.sql import functions as F

from tidewater import sources
from tidewater.operators import cogroup as C
from tidewater.operators import rows as R

# Own search / result / choice events: two searches (one without results), three results of which two share
# an id2, a tie of times, and a choice that no result explains.
EVENTS = [
    '{"id":"u7","search":"lamps","timestamp":40}',
    '{"id":"u9","search":"chairs","timestamp":41}',
    '{"id":"u7","id2":"k-red","pos":1,"timestamp":50}',
    '{"id":"u8","id2":"k-red","pos":4,"timestamp":50}',
    '{"id":"u7","id2":"k-blue","pos":2,"timestamp":60}',
    '{"id2":"k-blue","choice":"buy"}',
    '{"id2":"k-blue","choice":"look"}',
    '{"id2":"k-red","choice":"look"}',
    '{"id2":"k-none","choice":"buy"}',
]


def test_json_edge_cases(spark):
    df = sources.from_strings(spark, ['{"id":null,"id2":"x"}', "{bad", "{}", "[1,2]", "null"])
    parsed = R.parse_json(df, "value")
    good = R.route_by_presence(R.good_rows(parsed))
    assert sorted(r.kind for r in good.collect()) == ["choice", "result"]
    assert sorted(r._corrupt for r in R.rejected_rows(parsed).collect()) == ["[1,2]", "null", "{bad"]


def test_struct_parse_quarantine(spark):
    df = sources.from_strings(spark, ['{"k": 5}', '{"k": "x"}', "oops"])
    parsed = R.parse_json(df, "value", "k bigint")
    assert [r.row.k for r in R.good_rows(parsed).collect()] == [5]
    assert R.rejected_rows(parsed).count() == 2


def test_route_resolve_and_three_way(spark):
    parsed = R.route_by_presence(R.good_rows(R.parse_json(sources.from_strings(spark, EVENTS), "value")))
    kinds = {r.kind: r["count"] for r in parsed.groupBy("kind").count().collect()}
    assert kinds == {"search": 2, "result": 3, "choice": 4}
    flat = parsed.select("kind", *[F.col("row")[k].alias(k) for k in ("id", "id2", "choice", "timestamp")])
    result = R.routed(flat, "result")
    choice = R.routed(flat, "choice").drop("id")
    search = R.routed(flat, "search")
    resolved, unmatched = C.resolve_ids(result, choice, "id2", "id", order=["timestamp", "id"])
    assert sorted((r.id, r.id2, r.choice) for r in resolved.collect()) == [
        ("u7", "k-blue", "buy"), ("u7", "k-blue", "look"), ("u7", "k-red", "look")]
    assert [r.id2 for r in unmatched.collect()] == ["k-none"]
    counts = C.cogroup_counts({"search": search, "result": result, "choice": resolved}, "id").collect()
    assert sorted((r.key, r.n_search, r.n_result, r.n_choice) for r in counts) == [
        ("u7", 1, 2, 3), ("u8", 0, 1, 0), ("u9", 1, 0, 0)]


def test_null_lines_are_rejects(spark):
    df = spark.createDataFrame([(None,), ('{"id2":"x"}',)], "value string")
    for schema in (None, "id2 string"):
        parsed = R.parse_json(df, "value", schema)
        assert R.good_rows(parsed).count() == 1 and R.rejected_rows(parsed).count() == 1
    kinds = R.route_with_rejects(R.parse_json(df, "value")).groupBy("kind").count().collect()
    assert {r.kind: r["count"] for r in kinds} == {"choice": 1, "_rejected": 1}


def test_unmatched_choice_rejected(spark):
    result = spark.createDataFrame([("1", "A")], "id string, id2 string")
    choice = spark.createDataFrame([("A", "c1"), ("B", "c2")], "id2 string, name string")
    resolved, unmatched = C.resolve_ids(result, choice)
    assert [r.name for r in resolved.collect()] == ["c1"]
    assert [r.name for r in unmatched.collect()] == ["c2"]


def test_cogroup_two_inputs(spark):
    left = spark.createDataFrame([("a", 1), ("b", 2), ("b", 2), ("d", 5)], "name string, value int")
    right = spark.createDataFrame([("b", "x"), ("c", "y"), ("c", "y"), ("c", "z")], "name string, value string")
    g = C.cogroup_lists({"left": left, "right": right}, "name")
    got = {r.key: (len(r.left), len(r.right)) for r in g.collect()}
    assert got == {"a": (1, 0), "b": (2, 1), "c": (0, 3), "d": (1, 0)}
    assert C.cogroup({"left": left, "right": right}, "name").count() == 8


def test_singleton_side_input(spark):
    lines = sources.from_strings(spark, ["line one", "line two"])
    one = spark.createDataFrame([("v1",)], "version string")
    out = C.with_singleton(lines, one).collect()
    assert [r.version for r in out] == ["v1", "v1"]
    two = spark.createDataFrame([("a",), ("b",)], "version string")
    with pytest.raises(Exception, match="exactly one row"):
        C.with_singleton(lines, two).collect()
    none = spark.createDataFrame([], "version string")
    with pytest.raises(Exception, match="exactly one row"):
        C.with_singleton(lines, none).collect()


def test_to_json_and_extract_double(spark):
    df = spark.createDataFrame([("r1", None, "441.000000"), ("r2", 2.5, "bad")],
                               "ride_id string, x double, meter string")
    js = [r.value for r in R.to_json_text(df, ["ride_id", "x"]).collect()]
    assert js == ['{"ride_id":"r1","x":null}', '{"ride_id":"r2","x":2.5}']
    vals = [r.v for r in df.select(R.extract_double("meter").alias("v")).collect()]
    assert vals == [441.0, None]
    keyed = R.key_by(df.withColumn("k", F.lit(None).cast("string")), "k")
    assert R.null_keys(keyed).count() == 2 and R.with_key(keyed).count() == 0


def test_json_lines_source(spark, tmp_dir):
    p = f"{tmp_dir}/in.json"
    with open(p, "w") as f:
        f.write('{"name": "a", "n": 1}\n{broken\n{"name": "b", "n": 2}\n')
    parsed = sources.read_json_lines(spark, p, "name string, n bigint")
    assert sorted(r.row.name for r in R.good_rows(parsed).collect()) == ["a", "b"]
    assert R.rejected_rows(parsed).count() == 1
