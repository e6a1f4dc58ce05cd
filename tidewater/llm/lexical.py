"""Ranked lexical search: Block-Max MaxScore over an inverted index in segments.

Index. A task cuts its rows into segments of about ``SEGMENT_BYTES`` of text and inverts each: a row a
term with its postings in blocks of ``BLOCK`` documents, compressed as variable-length gaps and
frequencies. A block's head keeps its last document, its place in the packed bytes, and its best
(frequency, length) pairs, of which one gives the block's largest score whatever the corpus counts
are. So one pass over the texts makes the index, and nothing but per-segment sums meets.

Search. Queries go out in blocks, and every segment meets every query block. For a query, global
bounds (a list's largest score) order the lists. Lists are read from the top until those left over
cannot bring a new document above the k-th best score so far: these are essential. For the other
lists the block maxima at the candidates' places are added first, and candidates that stay below
the threshold go before any of those blocks is decompressed. Ties with the threshold stay, so
the result is exact. Each segment returns k rows a query, and these heaps are merged.

Score of a document for a query: the sum over the query's distinct terms of
``w * ((10**9 * tf) div (1000 * tf + 8 * m))`` in 64-bit integers, with ``w = floor(1000 * ln((2 N + 2) /
(2 df + 1)))`` and ``m = 10 + (90 * n * N) div L`` (N documents with a term, L terms in all, n in the document).
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import ascii_lower, python_ready, stored

SEGMENT_BYTES = 16 << 20
SEGMENT_ROWS = 1 << 17
PIECE_BYTES = 1 << 20
BLOCK = 128
#: Pairs of a query and a term in one query block.
QUERY_PAIRS = 1 << 15

#: Terms are maximal runs of ASCII letters, digits and all other characters beyond ASCII.
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_TERM_BYTES = re.compile(rb"[0-9a-z\x80-\xff]+")
_BREAK = re.compile(rb"[^0-9a-z\x80-\xff]")

INDEX_DDL = "segment long, term string, df long, total long, heads binary, fronts binary, packed binary"


def query_terms(text: Column) -> Column:
    """The distinct terms of a text."""
    return F.array_distinct(F.regexp_extract_all(ascii_lower(text), F.lit(TERM), F.lit(0)))


# ---- building a segment ------------------------------------------------------------

class Codes(dict):
    """Numbers for terms, in the order in which they first come."""

    def __missing__(self, term):
        self[term] = n = len(self)
        return n


def pieces(raw: bytes):
    """A text in pieces of about ``PIECE_BYTES``, cut outside of terms."""
    at = 0
    while len(raw) - at > PIECE_BYTES:
        found = _BREAK.search(raw, at + PIECE_BYTES)
        stop = found.start() if found else len(raw)
        yield raw[at:stop]
        at = stop
    yield raw[at:]


def varints(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Non-negative integers in groups of seven bits, low ones first; and where each begins."""
    sizes = np.ones(len(values), dtype=np.int64)
    for bits in range(7, 63, 7):
        more = values >= 1 << bits
        if not more.any():
            break
        sizes += more
    starts = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(starts[-1], dtype=np.uint8)
    for j in range(int(sizes.max(initial=0))):
        on = sizes > j
        out[starts[:-1][on] + j] = (values[on] >> 7 * j & 127) | np.where(sizes[on] > j + 1, 128, 0)
    return out, starts


def from_varints(data: np.ndarray) -> np.ndarray:
    if not len(data):
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(data < 128)
    starts = np.concatenate(([0], ends[:-1] + 1))
    shift = 7 * (np.arange(len(data)) - np.repeat(starts, ends - starts + 1))
    return np.add.reduceat((data & 127).astype(np.int64) << shift, starts)


def _binaries(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.BinaryArray.from_buffers(pa.binary(), len(offsets) - 1,
                                       [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


class Segment:
    """Documents of one segment while it grows."""

    def __init__(self, number: int):
        self.number, self.bytes = number, 0
        self.codes = Codes()
        self.ids: list[int | None] = []
        self.lengths: list[int] = []
        self.parts: list[np.ndarray] = []

    def add(self, doc_id: int | None, text: str | None) -> None:
        codes, n = self.codes, 0
        raw = text.encode().lower() if text else b""  # bytes.lower() changes A-Z only
        for piece in pieces(raw):
            some = np.array([codes[t] for t in _TERM_BYTES.findall(piece)], dtype=np.int32)
            self.parts.append(some)
            n += len(some)
        self.ids.append(doc_id)
        self.lengths.append(n)
        self.bytes += len(raw)

    def full(self) -> bool:
        return self.bytes >= SEGMENT_BYTES or len(self.ids) >= SEGMENT_ROWS

    def batches(self):
        """One row of documents (term null: ids, which of them are null, lengths), then one row a term."""
        n = np.array(self.lengths, dtype=np.int64)
        ids = np.array([i or 0 for i in self.ids], dtype=np.int64)
        known = np.array([i is not None for i in self.ids], dtype=np.uint8)
        yield pa.record_batch(
            [pa.array([self.number], pa.int64()), pa.array([None], pa.string()), pa.array([int((n > 0).sum())], pa.int64()),
             pa.array([int(n.sum())], pa.int64()), pa.array([ids.tobytes()], pa.binary()),
             pa.array([known.tobytes()], pa.binary()), pa.array([n.tobytes()], pa.binary())],
            names=["segment", "term", "df", "total", "heads", "fronts", "packed"])
        terms = sorted(self.codes)
        if not terms:
            return
        rank = np.empty(len(terms), dtype=np.int64)
        rank[[self.codes[t] for t in terms]] = np.arange(len(terms))
        term = rank[np.concatenate(self.parts)]
        held, tf = np.unique(term * len(n) + np.repeat(np.arange(len(n)), n), return_counts=True)
        term, doc = held // len(n), held % len(n)
        df = np.bincount(term, minlength=len(terms))
        first = np.concatenate(([0], np.cumsum(df)))
        in_list = np.arange(len(held)) - first[term]
        head = in_list % BLOCK == 0
        block = np.cumsum(head) - 1
        starts = np.flatnonzero(head)
        last = doc[np.append(starts[1:], len(held)) - 1]
        blocks = -(-df // BLOCK)
        first_block = np.concatenate(([0], np.cumsum(blocks)))
        gap = np.diff(doc, prepend=0)
        gap[first[:-1]] = doc[first[:-1]]  # a list's first gap counts from document 0
        packed, at = varints(np.stack((gap, tf), axis=1).ravel())
        block_at = at[2 * starts]
        term_at = at[2 * first]
        best = _fronts(block, tf, n[doc])
        fronts = np.bincount(block[best], minlength=len(starts))
        heads = np.stack((last, block_at - np.repeat(term_at[:-1], blocks), fronts), axis=1).astype(np.int32)
        pairs = np.stack((tf[best], n[doc[best]]), axis=1).astype(np.int64)
        front_at = np.concatenate(([0], np.cumsum(fronts)))[first_block]
        columns = [pa.array(np.full(len(terms), self.number)), pa.array(terms, pa.binary()).cast(pa.string()),
                   pa.array(df.astype(np.int64)), pa.array(np.bincount(term, tf, len(terms)).astype(np.int64)),
                   _binaries(heads, first_block * 12), _binaries(pairs, front_at * 16), _binaries(packed, term_at)]
        whole = pa.record_batch(columns, names=["segment", "term", "df", "total", "heads", "fronts", "packed"])
        for lo in range(0, len(terms), 1 << 14):
            yield whole.slice(lo, 1 << 14)


def _fronts(block: np.ndarray, tf: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Postings that no other one of the block beats in both frequency (more) and length (less), by block."""
    order = np.lexsort((n, -tf, block))
    value = n[order] - block[order] * (int(n.max(initial=0)) + 1)  # falls from block to block
    least = np.minimum.accumulate(value)
    return order[np.concatenate(([True], value[1:] < least[:-1]))]


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The inverted index of ``docs``, written to the shared folder.

    Null and empty texts are rows of a segment without terms; a null id is kept as null, and repeated rows are
    documents of their own. Other columns are not read.
    """
    python_ready(docs.sparkSession)

    def run(batches):
        from pyspark import TaskContext
        number = TaskContext.get().partitionId() << 32
        segment = Segment(number)
        for batch in batches:
            texts = batch.column(1)
            for row, doc_id in enumerate(batch.column(0).to_pylist()):
                segment.add(doc_id, texts[row].as_py())
                if segment.full():
                    yield from segment.batches()
                    number += 1
                    segment = Segment(number)
        if segment.ids:
            yield from segment.batches()
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return stored(rows.mapInArrow(run, INDEX_DDL), "lexical")


# ---- searching a segment ------------------------------------------------------------

class Counts:
    """Corpus counts: N documents with a term, L terms."""

    def __init__(self, documents: int, terms: int):
        self.documents, self.terms = documents, terms

    def norm(self, n: np.ndarray) -> np.ndarray:
        """m of each length; in whole Python integers, which do not overflow on the way."""
        lengths, which = np.unique(n, return_inverse=True)
        m = [10 + 90 * x * self.documents // self.terms for x in lengths.tolist()]
        return np.array(m, dtype=np.int64)[which]


def impact(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    return 1_000_000_000 * tf // (1000 * tf + 8 * m)


class Postings:
    """One term's list in a segment: block bounds at once, documents and scores on demand."""

    def __init__(self, w: int, heads: bytes, fronts: bytes, packed: bytes, m: np.ndarray, counts: Counts):
        h = np.frombuffer(heads, dtype=np.int32).reshape(-1, 3).astype(np.int64)
        self.last, self.at, self.w, self.m = h[:, 0], np.append(h[:, 1], len(packed)), w, m
        pairs = np.frombuffer(fronts, dtype=np.int64).reshape(-1, 2)
        best = impact(pairs[:, 0], counts.norm(pairs[:, 1])) * w
        self.bounds = np.maximum.reduceat(best, np.concatenate(([0], np.cumsum(h[:-1, 2]))))
        self.bound = int(self.bounds.max())
        self.packed = np.frombuffer(packed, dtype=np.uint8)
        self.whole: tuple[np.ndarray, np.ndarray] | None = None

    def _decoded(self, lo: int, hi: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents and scores of the blocks lo to hi - 1."""
        values = from_varints(self.packed[self.at[lo]:self.at[hi]])
        docs = np.cumsum(values[0::2]) + (self.last[lo - 1] if lo else 0)
        return docs, impact(values[1::2], self.m[docs]) * self.w

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        if self.whole is None:
            self.whole = self._decoded(0, len(self.last))
        return self.whole

    def block_of(self, docs: np.ndarray) -> np.ndarray:
        """The block in which a document would be; the number of blocks where there is none."""
        return np.searchsorted(self.last, docs)

    def scores(self, docs: np.ndarray, blocks: np.ndarray) -> np.ndarray:
        """The list's scores of some documents, of which ``blocks`` names the blocks; only these are decompressed."""
        out = np.zeros(len(docs), dtype=np.int64)
        wanted = np.unique(blocks[blocks < len(self.last)])
        if self.whole is not None or 2 * len(wanted) > len(self.last):
            runs = [self.all()] if len(wanted) else []
        else:
            cuts = np.flatnonzero(np.diff(wanted) > 1) + 1
            runs = [self._decoded(int(r[0]), int(r[-1]) + 1) for r in np.split(wanted, cuts) if len(r)]
        for found, score in runs:
            place = np.searchsorted(found, docs)
            place[place == len(found)] = 0
            hit = found[place] == docs
            out[hit] = score[place[hit]]
        return out


def kth(scores: np.ndarray, k: int) -> int:
    """The k-th largest of some scores, 0 if there are fewer."""
    return int(np.partition(scores, len(scores) - k)[len(scores) - k]) if len(scores) >= k else 0


def best_in_segment(lists: list[Postings], rows: int, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(documents, scores) of a segment that hold its k best scores above 0, all ties with the k-th included."""
    lists = sorted((x for x in lists if x.bound > 0), key=lambda x: -x.bound)
    left = np.concatenate((np.cumsum([x.bound for x in lists][::-1])[::-1], [0])).astype(np.int64)
    score, threshold, at = np.zeros(rows, dtype=np.int64), 0, 0
    while at < len(lists) and left[at] >= threshold:  # essential: a new document may still get in
        docs, some = lists[at].all()
        score[docs] += some
        at += 1
        threshold = max(threshold, kth(score[score > 0], k))
    docs = np.flatnonzero(score)
    docs = docs[score[docs] + left[at] >= threshold]
    rest = lists[at:]
    blocks = [x.block_of(docs) for x in rest]
    most = [np.append(x.bounds, 0)[b] for x, b in zip(rest, blocks)]
    total = score[docs]
    open_bound = np.sum(most, axis=0, dtype=np.int64) if rest else np.zeros(len(docs), dtype=np.int64)
    for j, postings in enumerate(rest):
        keep = total + open_bound >= threshold
        if not keep.all():
            docs, total, open_bound = docs[keep], total[keep], open_bound[keep]
            blocks, most = [b[keep] for b in blocks], [b[keep] for b in most]
        total = total + postings.scores(docs, blocks[j])
        open_bound = open_bound - most[j]
        threshold = max(threshold, kth(total, k))
    keep = total >= max(threshold, 1)
    return docs[keep], total[keep]


def search_segment(lists: pa.Table, segment: pa.Table, counts: Counts, k: int):
    """The k best rows of a segment for every query of a block, as (item, doc_id, score) columns."""
    items, ids_out, scores_out = [], [], []
    if segment.num_rows:
        row = segment.slice(0, 1).to_pylist()[0]
        ids = np.frombuffer(row["heads"], dtype=np.int64)
        known = np.frombuffer(row["fronts"], dtype=np.uint8)
        m = counts.norm(np.frombuffer(row["packed"], dtype=np.int64))
        postings = {r["term"]: Postings(r["w"], r["heads"], r["fronts"], r["packed"], m, counts)
                    for r in lists.to_pylist()}
        for asked in row["asked"]:
            found = [postings[t] for t in asked["terms"] if t in postings]
            if not found:
                continue
            docs, score = best_in_segment(found, len(ids), k)
            first = np.lexsort((ids[docs], known[docs] == 0, -score))[:k]
            for d, s in zip(docs[first].tolist(), score[first].tolist()):
                items.append(asked["item"])
                ids_out.append(int(ids[d]) if known[d] else None)
                scores_out.append(s)
    return pa.table({"item": pa.array(items, pa.int64()), "doc_id": pa.array(ids_out, pa.int64()),
                     "score": pa.array(scores_out, pa.int64())})


def search(index: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "item_id", text_col: str = "text",
           query_pairs: int = QUERY_PAIRS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best rows of the index for every query, equal scores by doc_id (null last).

    Every distinct (id, text) pair is a query of its own; one without terms, or without a matching
    document, has no rows. Other columns of ``queries`` are not read.
    """
    spark: SparkSession = index.sparkSession
    python_ready(spark)
    asked = queries.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).alias("text")).distinct()
    items = stored(asked.select(F.monotonically_increasing_id().alias("item"), "item_id",
                                query_terms(F.col("text")).alias("terms")).where(F.size("terms") > 0), "queries")
    pairs = items.select("item", F.explode("terms").alias("term"))
    segments = index.where(F.col("term").isNull())
    sums = segments.agg(F.coalesce(F.sum("df"), F.lit(0)), F.coalesce(F.sum("total"), F.lit(0))).first()
    counts = Counts(int(sums[0]), int(sums[1]))
    blocks = max(1, -(-pairs.count() // query_pairs))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * counts.documents + 2.0) / (F.lit(2.0) * F.sum("df") + F.lit(1.0))))
    words = index.where(F.col("term").isNotNull())
    weights = stored(words.select("term", "df").join(pairs.select("term").distinct(), "term")
                          .groupBy("term").agg(weight.cast("long").alias("w")).where(F.col("w") > 0), "weights")
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    # A query block is a bounded list; every segment meets every block.
    asked_of = dealt.groupBy("block").agg(F.collect_list(F.struct("item", "terms")).alias("asked"))
    meets = (segments.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))
                     .select("segment", "block", "heads", "fronts", "packed").join(asked_of, "block"))
    wanted = (dealt.select("block", F.explode("terms").alias("term")).distinct().join(weights, "term"))
    lists = words.select("segment", "term", "heads", "fronts", "packed").join(wanted, "term")
    lists = lists.select(*[F.col(c).alias(c) for c in lists.columns])  # columns of its own, both sides come from the index

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return search_segment(left, right, counts, k)
    heaps = (lists.groupBy("segment", "block").cogroup(meets.groupBy("segment", "block"))
                  .applyInArrow(run, "item long, doc_id long, score long"))
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    merged = heaps.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return merged.join(items.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


SEARCH_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
p AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(terms) AS term FROM d) GROUP BY r, term),
n AS (SELECT r, sum(tf)::BIGINT AS n FROM p GROUP BY r),
s AS (SELECT count(*) AS docs, sum(n)::BIGINT AS total FROM n),
f AS (SELECT term, CAST(floor(1000 * ln((2 * any_value(docs) + 2)::DOUBLE / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY term),
q AS (SELECT DISTINCT i, item_id, unnest(terms) AS term FROM (
        SELECT row_number() OVER () AS i, item_id,
               regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                  '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms
        FROM (SELECT DISTINCT item_id, text FROM benchmark))),
x AS (SELECT i, any_value(item_id) AS item_id, p.r,
             sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // total))))::BIGINT AS score
      FROM q JOIN f USING (term) JOIN p USING (term) JOIN n ON n.r = p.r, s GROUP BY i, p.r)
SELECT item_id, rank, doc_id, score FROM (
  SELECT x.item_id, d.doc_id, score,
         row_number() OVER (PARTITION BY i ORDER BY score DESC, d.doc_id ASC NULLS LAST)::INT AS rank
  FROM x JOIN d ON d.r = x.r WHERE score > 0) WHERE rank <= 10
"""
