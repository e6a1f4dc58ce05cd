"""Semi-structured rows: JSON decode/encode with quarantine, keying, routing, field extraction.

A decoded row is either a typed struct (known schema) or a ``map<string,string>``
(sparse rows where *presence* of a key is the branch test; nested values stay
JSON text). Bad input never disappears: it goes to a reject output.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

CORRUPT = "_corrupt"
ROW = "row"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_json(df: DataFrame, col: str = "value", schema: T.StructType | str | None = None,
               out: str = ROW, keep: Sequence[str] = ()) -> DataFrame:
    """JSON text -> ``out`` (struct, or map<string,string> when ``schema`` is None).

    Adds ``_corrupt``: the raw text for lines that are not a JSON object (bad
    syntax, arrays, ``null``), null otherwise; a null line counts as ``null`` text.
    Use :func:`good_rows` / :func:`rejected_rows` to split.
    """
    raw = F.coalesce(F.col(col), F.lit("null"))
    if schema is None:
        parsed = F.from_json(raw, "map<string,string>")
        bad = parsed.isNull()
        return df.select(*keep, parsed.alias(out), F.when(bad, raw).alias(CORRUPT))
    if isinstance(schema, str):
        ddl = schema
        parsed = F.from_json(raw, f"{ddl}, {CORRUPT} string",
                             {"columnNameOfCorruptRecord": CORRUPT})
    else:
        st = T.StructType(list(schema.fields) + [T.StructField(CORRUPT, T.StringType())])
        parsed = F.from_json(raw, st, {"columnNameOfCorruptRecord": CORRUPT})
    tmp = "__parsed"
    staged = df.select(*keep, parsed.alias(tmp))
    fields = [f for f in staged.schema[tmp].dataType.fieldNames() if f != CORRUPT]
    return staged.select(*keep,
                         F.struct(*[F.col(f"{tmp}.{f}").alias(f) for f in fields]).alias(out),
                         F.col(f"{tmp}.{CORRUPT}").alias(CORRUPT))


def parse_message(df: DataFrame, payload: str = "payload", schema=None, out: str = ROW,
                  keep: Sequence[str] = ()) -> DataFrame:
    """Message bytes (binary payload) -> row, same reject rule as :func:`parse_json`."""
    staged = df.withColumn("__text", F.col(payload).cast("string"))
    return parse_json(staged, "__text", schema, out, keep)


def good_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNull()).drop(CORRUPT)


def rejected_rows(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.col(CORRUPT).isNotNull())


def to_json_text(df: DataFrame, cols: Sequence[str] | None = None, out: str = "value") -> DataFrame:
    """Row -> JSON text; nulls are written as ``null``; on failure the empty string."""
    cols = list(cols) if cols else df.columns
    js = F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"})
    return df.select(F.coalesce(js, F.lit("")).alias(out))


def has_key(map_col, key: str) -> Column:
    """Key presence in a map row (true also when the value is JSON null)."""
    return F.coalesce(F.map_contains_key(_col(map_col), F.lit(key)), F.lit(False))


def key_by(df: DataFrame, key, out: str = "key") -> DataFrame:
    """Add the grouping key column; rows whose key is missing go to :func:`null_keys`."""
    return df.withColumn(out, _col(key))


def null_keys(keyed: DataFrame, key: str = "key") -> DataFrame:
    return keyed.where(F.col(key).isNull())


def with_key(keyed: DataFrame, key: str = "key") -> DataFrame:
    return keyed.where(F.col(key).isNotNull())


def drop_key(df: DataFrame, key: str = "key") -> DataFrame:
    return df.drop(key)


def extract_double(c) -> Column:
    """Number (or number in a string) -> double; null for missing or bad values."""
    return _col(c).try_cast("double")


def route_by_presence(df: DataFrame, map_col: str = ROW, both: Sequence[str] = ("id", "id2"),
                      labels: Mapping[str, str] | None = None, out: str = "kind") -> DataFrame:
    """Three-way routing by key presence: all of ``both`` -> result, first only -> search,
    else -> choice. One scan; each output is ``where(kind == ..)``.
    """
    labels = dict(labels or {"result": "result", "search": "search", "choice": "choice"})
    first, *rest = both
    all_present = has_key(map_col, first)
    for k in rest:
        all_present = all_present & has_key(map_col, k)
    kind = (F.when(all_present, F.lit(labels["result"]))
             .when(has_key(map_col, first), F.lit(labels["search"]))
             .otherwise(F.lit(labels["choice"])))
    return df.withColumn(out, kind)


def route_with_rejects(parsed: DataFrame, map_col: str = ROW, both: Sequence[str] = ("id", "id2"),
                       out: str = "kind", rejected: str = "_rejected") -> DataFrame:
    """Routing of a :func:`parse_json` result in one pass: undecodable rows get the
    ``rejected`` kind instead of a second scan for the reject output.
    """
    routed_rows = route_by_presence(parsed, map_col, both, out=out)
    return routed_rows.withColumn(out, F.when(F.col(CORRUPT).isNotNull(), F.lit(rejected))
                                        .otherwise(F.col(out)))


def routed(df: DataFrame, kind: str, out: str = "kind") -> DataFrame:
    return df.where(F.col(out) == kind)


def keep_with_field(df: DataFrame, field: str) -> DataFrame:
    """Keep rows that carry ``field`` (struct rows: non-null; map rows: key present)."""
    dt = df.schema[ROW].dataType if ROW in df.columns else None
    if isinstance(dt, T.MapType):
        return df.where(has_key(ROW, field))
    return df.where(F.col(field).isNotNull())
