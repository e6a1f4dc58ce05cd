"""Device-log documents: split into sections, pair user actions, complete event times,
attach the action group to rate-change events.

A document is one JSON object with an ``info`` object and five arrays of sparse
objects. Elements are read as ``map<string,string>`` (key presence is the branch
test and nested values stay JSON text). Every section is required: documents that
lack one, or have another type in its place, go to the reject output instead of failing the job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.constants import (ACTION_ID_FIELD, ACTION_NAME_FIELD, DEVICE_LOG_ARRAY_SECTIONS,
                                   DEVICE_LOG_OBJECT_SECTION, EVENT_END_FIELD, EVENT_NAME_FIELD,
                                   EVENT_TIME_FIELD)
from . import ordered
from .cogroup import with_singleton

SECTIONS = (DEVICE_LOG_OBJECT_SECTION,) + DEVICE_LOG_ARRAY_SECTIONS
ELEMENT = "map<string,string>"


def parse_documents(df: DataFrame, col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """JSON document -> ``doc`` struct of the six sections, ``_missing``: the required sections that are absent or of
    the wrong type, an element that is no object included (all of them for non-objects), and ``_document``: the text of a document that lacks any.

    A document is parsed once, into the binary variant form; sections are taken from that, each once. Nested values
    become JSON text, numbers in their shortest form.
    """
    def taken(name):
        kind = ELEMENT if name == DEVICE_LOG_OBJECT_SECTION else f"array<{ELEMENT}>"
        return F.try_variant_get("__whole", f"$.{name}", kind).alias(name)
    whole = df.select(*keep, F.col(col).alias("__text"), F.try_parse_json(F.col(col)).alias("__whole"))
    staged = whole.select(*keep, "__text", F.struct(*[taken(s) for s in SECTIONS]).alias("doc"))

    def absent(name):
        section = F.col(f"doc.{name}")
        # an element that is no object comes out of the variant as null
        return section.isNull() if name == DEVICE_LOG_OBJECT_SECTION else section.isNull() | F.exists(section, lambda e: e.isNull())
    missing = F.filter(F.array(*[F.when(absent(s), F.lit(s)) for s in SECTIONS]), lambda s: s.isNotNull())
    told = staged.select(*keep, "__text", "doc", missing.alias("_missing"))
    return told.select(*keep, "doc", "_missing", F.when(F.size("_missing") > 0, F.col("__text")).alias("_document"))


def valid_documents(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.size("_missing") == 0).drop("_missing", "_document")


def rejected_documents(parsed: DataFrame) -> DataFrame:
    return parsed.where(F.size("_missing") > 0)


def section(docs: DataFrame, name: str, keep: Sequence[str] = (), out: str = "row") -> DataFrame:
    """One row per element of an array section (``row`` map), or the ``info`` object."""
    if name == DEVICE_LOG_OBJECT_SECTION:
        return docs.select(*keep, F.col(f"doc.{name}").alias(out))
    return docs.select(*keep, F.explode(F.col(f"doc.{name}")).alias(out))


def sections_long(parsed: DataFrame, keep: Sequence[str] = (), rejected: str = "_rejected") -> DataFrame:
    """All outputs of the split in one pass: (section, row) for every element of
    every array section plus the ``info`` object; a document with a section missing or of the wrong type
    gives one ``rejected`` row instead, with its text (``document``) and the names of those sections (``missing``).

    One generator over one parse; each output is ``where(section == ..)``.
    """
    def tag(name, c):
        return F.struct(F.lit(name).alias("section"), c.alias("row"))

    def tagger(name):  # one-argument lambda: transform() reads two as (element, index)
        return lambda e: tag(name, e)

    parts = [F.array(tag(DEVICE_LOG_OBJECT_SECTION, F.col(f"doc.{DEVICE_LOG_OBJECT_SECTION}")))]
    parts += [F.transform(F.col(f"doc.{s}"), tagger(s)) for s in DEVICE_LOG_ARRAY_SECTIONS]
    why = F.create_map(F.lit("document"), F.col("_document"), F.lit("missing"), F.array_join("_missing", ","))
    reject = F.array(tag(rejected, why))
    items = F.when(F.size("_missing") == 0, F.concat(*parts)).otherwise(reject)
    return parsed.select(*keep, F.inline(items))


def field(name: str, row: str = "row") -> Column:
    return F.col(row)[name]


def has_field(name: str, row: str = "row") -> Column:
    return F.coalesce(F.map_contains_key(F.col(row), F.lit(name)), F.lit(False))


def pair_actions(actions: DataFrame, id_field: str = ACTION_ID_FIELD,
                 name_field: str = ACTION_NAME_FIELD, order_field: str = "evId",
                 row: str = "row") -> DataFrame:
    """Per action id: the record that has ``name`` (start) and the one without (result).

    Several of a kind: the one with the largest ``order_field`` (as a number)
    wins. One aggregate, partial per map task: a hot id costs one row per task.
    Output: id, type (start's name), parameter (start record), result (record or
    null). Ids without a named record have a null type: see :func:`unpaired`.
    """
    named = has_field(name_field, row)
    order = F.struct(F.col(row)[order_field].try_cast("bigint"), F.col(row)[order_field])
    return (actions.groupBy(F.col(row)[id_field].alias(id_field))
                   .agg(F.max_by(F.col(row), F.when(named, order)).alias("parameter"),
                        F.max_by(F.col(row), F.when(~named, order)).alias("result"))
                   .select(id_field, F.col("parameter")[name_field].alias("type"),
                           "parameter", "result"))


def paired(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("type").isNotNull())


def unpaired(pairs: DataFrame) -> DataFrame:
    return pairs.where(F.col("type").isNull())


def group_sizes(df: DataFrame, key: str, out: str = "n") -> DataFrame:
    """Size of every named group (partial-aggregated count)."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(out))


def only_group(df: DataFrame, key: str, name: str) -> DataFrame:
    """Keep one named group; written before any grouping so it prunes the scan."""
    return df.where(F.col(key) == F.lit(name))


def complete_times(events: DataFrame, name: str = "name", ts: str = "ts",
                   tiebreak: str = "ev_id",
                   out: str = EVENT_END_FIELD, bucket_ms: int = ordered.DEFAULT_BUCKET_MS) -> DataFrame:
    """Sort each name group by time; each event's end = next event's start in epoch ms (last: null).

    Exact per name across all documents, but computed per (name, time bucket), so
    a name holding most events does not meet in one task.
    """
    return ordered.lead_within(events, name, ts, tiebreak, None, out, bucket_ms, F.unix_millis)


def event_rows(events_section: DataFrame, row: str = "row") -> DataFrame:
    """Typed columns of event elements needed for ordering: name, ts, ev_id, t_ms."""
    t_ms = F.col(row)[EVENT_TIME_FIELD].try_cast("bigint")
    return events_section.select("*", F.col(row)[EVENT_NAME_FIELD].alias("name"),
                                 t_ms.alias("t_ms"), F.timestamp_millis(t_ms).alias("ts"),
                                 F.col(row)["evId"].try_cast("bigint").alias("ev_id"))


def attach_group(events: DataFrame, group: DataFrame, summary: Sequence[Column]) -> DataFrame:
    """Attach a one-row summary of ``group`` to every event (broadcast of one row)."""
    return with_singleton(events, group.agg(*summary), "action group")
