"""Substring dedup over words: windows of ``window`` words, by super-k-mers.

Consecutive windows whose smallest m-word hash (the minimiser) stands at the same
place form a run. Equal windows have equal minimisers, so only runs whose
minimiser occurs in more than one run can hold a repeated window. Such a run
travels as one packed string, its words joined by a space, to the bucket of its
minimiser, instead of one string per window. A bucket is dealt out further by the
packed string itself, and equal strings are counted before they travel, so a
passage that a third of all documents share does not meet in one task. Each
task then cuts its strings into windows, sorts them and adds up equal ones; the sums per
window are merged by the windows' 128-bit hashes.

Which windows of a run are repeated fits one bitmap. It goes back by the
packed string's hash to every run, and from there to the documents.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .tables import python_ready, stored
from .wordhash import WordHash, sequences, slices

WINDOW, MINIMISER = 35, 5
#: A run is kept as one number: its first window, and in the low bits its number of windows.
SPAN_BITS = 6


@lru_cache(maxsize=3)
def word_hash(seed: int) -> WordHash:
    return WordHash(seed)


def window_minima(values: np.ndarray, width: int) -> np.ndarray:
    """For each window of ``width`` values the position of its leftmost smallest one, by doubling."""
    at = np.arange(len(values))
    size = 1
    while size < width:
        step = min(size, width - size)
        left, right = at[:len(at) - step], at[step:]
        at = np.where(values[right] < values[left], right, left)
        size += step
    return at


def runs_of(hashes: np.ndarray, bounds: np.ndarray, window: int, m: int) -> tuple[np.ndarray, ...]:
    """(row, first window, number of windows, minimiser) of every run in rows of word hashes."""
    grams, edges = sequences(hashes, m, bounds)
    width = window - m + 1
    counts = np.where(np.diff(bounds) >= window, np.diff(edges) - width + 1, 0)
    before = np.concatenate(([0], np.cumsum(counts)))
    if not before[-1]:
        none = np.zeros(0, dtype=np.int64)
        return none, none, none, none
    row = np.repeat(np.arange(len(counts)), counts)
    at = np.arange(before[-1]) + np.repeat(edges[:-1] - before[:-1], counts)
    place = window_minima(grams, width)[at]
    first = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1]) | (row[1:] != row[:-1]))))
    return (row[first], first - before[row[first]], np.diff(np.append(first, len(place))),
            grams[place[first]].view(np.int64))


def _runs(window: int, m: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch.column(2)):
                hashes = word_hash(201)(part.data, part.starts, part.ends)
                row, first, n, least = runs_of(hashes, part.bounds, window, m)
                place = pa.array(row + part.rows.start)
                yield pa.record_batch([batch.column(0).take(place), batch.column(1).take(place),
                                       pa.array(first << SPAN_BITS | n), pa.array(least)],
                                      names=["row", "mark", "span", "minimiser"])
    return run


def _pack(window: int):
    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            edges = np.asarray(lists.offsets)
            spans, least = (np.asarray(lists.values.field(x)) for x in ("span", "minimiser"))
            start, size = spans >> SPAN_BITS, (spans & (1 << SPAN_BITS) - 1) + window - 1
            for part in slices(batch.column(2)):
                rows, packed = [], []
                lo, hi = edges[part.rows.start], edges[part.rows.stop]
                for r in range(len(part.bounds) - 1):
                    at, stop = part.bounds[r], part.bounds[r + 1]
                    words = [part.data[b:e].tobytes() for b, e in zip(part.starts[at:stop], part.ends[at:stop])]
                    runs = range(edges[part.rows.start + r], edges[part.rows.start + r + 1])
                    rows.extend([part.rows.start + r] * len(runs))
                    packed.extend(b" ".join(words[start[i]:start[i] + size[i]]) for i in runs)
                place = pa.array(rows, pa.int64())
                yield pa.record_batch([
                    batch.column(0).take(place), batch.column(1).take(place), pa.array(spans[lo:hi]),
                    pa.array(least[lo:hi]), pa.array(packed, pa.binary()).cast(pa.string())],
                    names=["row", "mark", "span", "minimiser", "packed"])
    return run


def cut(texts: pa.Array, window: int):
    """(text number, window number, 128-bit hash as two halves) of every window, in slices."""
    for part in slices(texts):
        counts = np.diff(part.bounds) - window + 1
        owner = np.repeat(np.arange(len(counts)), counts)
        number = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(counts)))[:-1], counts)
        hi, lo = (sequences(word_hash(s)(part.data, part.starts, part.ends), window, part.bounds, s)[0].view(np.int64)
                  for s in (301, 401))
        yield owner + part.rows.start, number, hi, lo


def _counted(window: int):
    """Windows of packed strings, sorted, and how often each occurs."""
    def run(batches):
        for batch in batches:
            times = np.asarray(batch.column(1))
            for owner, _, hi, lo in cut(batch.column(0), window):
                order = np.lexsort((lo, hi))
                hi, lo, n = hi[order], lo[order], times[owner[order]]
                first = np.flatnonzero(np.concatenate(([True], (hi[1:] != hi[:-1]) | (lo[1:] != lo[:-1]))))
                yield pa.record_batch([pa.array(hi[first]), pa.array(lo[first]), pa.array(np.add.reduceat(n, first))],
                                      names=["hi", "lo", "times"])
    return run


def _numbered(window: int):
    """Windows of packed strings with the string's number and, in the low bits, their own."""
    def run(batches):
        for batch in batches:
            ids = np.asarray(batch.column(1))
            for owner, number, hi, lo in cut(batch.column(0), window):
                yield pa.record_batch([pa.array(ids[owner] << SPAN_BITS | number), pa.array(hi), pa.array(lo)],
                                      names=["place", "hi", "lo"])
    return run


def repeated_windows(rows: DataFrame, window: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """(row, mark, spans): of every text with a repeated window, the runs with their bitmaps.

    ``rows`` has (row long, mark long, text), the first two naming the text; rows that share
    them hold the same text, one each time, and get one result. ``spans`` is an
    array of (start, flags): bit i of flags says that the window at word
    start + i occurs elsewhere too.
    """
    if not 1 <= m <= window < m + 62:
        raise ValueError("a run's windows must fit a 64-bit bitmap")
    runs = stored(rows.mapInArrow(_runs(window, m), "row long, mark long, span long, minimiser long"), "runs")
    # Stored, so that the join below deals both sides out anew and can split a hot minimiser.
    often = stored(runs.groupBy("minimiser").count().where("count > 1").select("minimiser"), "minimisers")
    shared = runs.join(often, "minimiser", "left_semi")
    # Sets: rows that repeat an id and a text share a name, and their runs are the same.
    by_row = shared.groupBy("row", "mark").agg(F.collect_set(F.struct("span", "minimiser")).alias("runs"))
    packed = stored(rows.join(by_row, ["row", "mark"]).select("row", "mark", "text", "runs").mapInArrow(
        _pack(window), "row long, mark long, span long, minimiser long, packed string"), "superkmers")

    strings = stored(packed.groupBy("minimiser", "packed").agg(F.count(F.lit(1)).alias("times"))
                           .select("packed", "times", F.monotonically_increasing_id().alias("id")), "strings")
    # 128 bits that name a packed string.
    digest = [F.xxhash64("packed").alias("d1"), F.xxhash64(F.lit(1), "packed").alias("d2")]
    # Every window of a string that occurs twice is repeated; of the others, those found in another string too.
    sizes = F.size(F.split("packed", " ")) - (window - 1)
    whole = (strings.where("times > 1").withColumn("n", sizes)
                    .select(*digest, F.expr("shiftleft(1L, n) - 1").alias("flags")))
    counted = strings.select("packed", "times").mapInArrow(_counted(window), "hi long, lo long, times long")
    twice = counted.groupBy("hi", "lo").agg(F.sum("times").alias("times")).where("times > 1").select("hi", "lo")
    windows = strings.where("times = 1").select("packed", "id").mapInArrow(
        _numbered(window), "place long, hi long, lo long")
    low = (1 << SPAN_BITS) - 1
    flags = (windows.join(twice, ["hi", "lo"], "left_semi")
                    .groupBy(F.expr(f"shiftright(place, {SPAN_BITS})").alias("id"))
                    .agg(F.bit_or(F.expr(f"shiftleft(1L, CAST(place & {low} AS INT))")).alias("flags")))
    some = strings.where("times = 1").select("id", *digest).join(flags, "id").select("d1", "d2", "flags")
    found = packed.select("row", "mark", "span", *digest).join(whole.union(some), ["d1", "d2"])
    start = F.expr(f"CAST(shiftright(span, {SPAN_BITS}) AS INT)").alias("start")
    return found.groupBy("row", "mark").agg(F.collect_set(F.struct(start, "flags")).alias("spans"))


def covered(n: int, start: np.ndarray, flags: np.ndarray, window: int) -> np.ndarray:
    """Which of a text's n words a repeated window covers."""
    bits = (flags.view(np.uint64)[:, None] >> np.arange(64, dtype=np.uint64)) & np.uint64(1)
    first = (start[:, None] + np.arange(64))[bits.astype(bool)]
    edge = np.bincount(first, minlength=n + 1) - np.bincount(first + window, minlength=n + 1)
    return np.cumsum(edge[:n]) > 0


def _cut(window: int):
    def run(batches):
        for batch in batches:
            lists = batch.column(3)
            edges = np.asarray(lists.offsets)
            start, flags = (np.asarray(lists.values.field(x)) for x in ("start", "flags"))
            for part in slices(batch.column(2)):
                totals, gone, kept = [], [], []
                for r in range(len(part.bounds) - 1):
                    lo, hi = part.bounds[r], part.bounds[r + 1]
                    mine = slice(edges[part.rows.start + r], edges[part.rows.start + r + 1])
                    stays = ~covered(hi - lo, start[mine], flags[mine], window)
                    totals.append(hi - lo)
                    gone.append(hi - lo - int(stays.sum()))
                    kept.append(b" ".join(part.data[b:e].tobytes() for b, e in
                                          zip(part.starts[lo:hi][stays], part.ends[lo:hi][stays])))
                yield pa.record_batch([
                    batch.column(0).slice(part.rows.start, len(totals)), pa.array(totals, pa.int64()),
                    pa.array(gone, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                    names=["doc_id", "n_words", "n_removed", "kept"])
    return run


def dedup_substrings(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                     window: int = WINDOW, m: int = MINIMISER) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_words, n_removed, kept).

    A word that a window of ``window`` words covers, whose word sequence also
    starts anywhere else, goes. Words are ``[^\\x20\\x09-\\x0D]+``, unchanged.

    Null and empty texts have no words and an empty ``kept``. Texts shorter than a
    window lose nothing. Rows that repeat a doc_id, and rows whose doc_id is null, are
    texts of their own: each starts its windows somewhere else.
    """
    python_ready(docs.sparkSession)
    ids, text = F.col(id_col).cast("long"), F.col(text_col)
    # A row is named by its id and a hash of its text; only equal texts can share both.
    named = docs.select(ids.alias("doc_id"), F.coalesce(ids, F.lit(-1)).cast("long").alias("row"),
                        F.xxhash64(text).alias("mark"), text.alias("text"))
    spans = repeated_windows(named.select("row", "mark", "text"), window, m)
    none = F.array().cast("array<struct<start:int,flags:bigint>>")
    return (named.join(spans, ["row", "mark"], "left")
                 .select("doc_id", "mark", "text", F.coalesce("spans", none).alias("spans"))
                 .mapInArrow(_cut(window), "doc_id long, n_words long, n_removed long, kept string"))


REPEATS_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT doc_id, unnest(range(1, len(words) - 33)) AS p, words FROM w WHERE len(words) >= 35),
k AS (SELECT doc_id, p, array_to_string(words[p:p + 34], ' ') AS win FROM s),
d AS (SELECT doc_id, p FROM (SELECT *, count(*) OVER (PARTITION BY win) AS n FROM k) WHERE n > 1),
g AS (SELECT DISTINCT doc_id, unnest(range(p, p + 35)) AS i FROM d),
a AS (SELECT doc_id, unnest(words) AS word, generate_subscripts(words, 1) AS i FROM w),
m AS (SELECT a.*, g.i IS NOT NULL AS gone FROM a LEFT JOIN g ON a.doc_id = g.doc_id AND a.i = g.i),
t AS (
  SELECT doc_id, count(*) AS n_words, count(*) FILTER (WHERE gone) AS n_removed,
    string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept FROM m GROUP BY doc_id)
SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(n_removed, 0) AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM documents LEFT JOIN t USING (doc_id)
"""
