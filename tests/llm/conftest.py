import math

import duckdb
import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()),
                     T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()),
                     T.StructField("n_chars", T.LongType())])


@pytest.fixture
def docs_of(spark):
    """A documents table of (doc_id, text) pairs; further columns are null."""
    def make(rows):
        return spark.createDataFrame([(i, t, None, None, None) for i, t in rows], DOCS)
    return make


def _value(v):
    if v is None or v != v:
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return int(v) if v.is_integer() else round(v, 9)
    return v


@pytest.fixture
def same_as_sql(tmp_path):
    """Compare a DataFrame with DuckDB's rows for ``sql`` over small tables."""
    def check(df, sql, **tables):
        con = duckdb.connect()
        for name, t in tables.items():
            path = str(tmp_path / f"{name}.parquet")
            t.toPandas().to_parquet(path) if not t.isEmpty() else t.write.mode("overwrite").parquet(path)
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}{'/*.parquet' if t.isEmpty() else ''}')")
        columns = sorted(df.columns)
        rel = con.execute(sql)
        names = [d[0] for d in rel.description]
        assert sorted(names) == columns
        want = [tuple(_value(dict(zip(names, r))[c]) for c in columns) for r in rel.fetchall()]
        got = [tuple(_value(r[c]) for c in columns) for r in df.collect()]
        assert sorted(got, key=repr) == sorted(want, key=repr)
    return check


__all__ = ["math"]
