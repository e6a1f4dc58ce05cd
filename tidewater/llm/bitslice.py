"""Exact top-k search by inner product over a bit-sliced index.

Index: rows are dealt into segments. A segment keeps, for every attribute
(vector component), bitmaps over its rows: slice j has bit j of the
attribute's quantised value. Quantising keeps the leading bits, so every value
is known up to a remainder, exactly bounded per segment.

Query: the slices of all attributes are added with bitmap arithmetic (carry-save
adders over whole bitmaps), weighted by the query's quantised components. The
sums are again bit slices; walking them from the most significant one down
selects the rows that can be among the top k given the bound on what quantising
cut off. These boundary rows are scored exactly from their stored integers.

Only blocks travel: queries are dealt into blocks and blocks into groups of
about as many rows as a segment. A *cell* is a segment and a group: the segment travels
once to each of its cells, followed by the group's blocks, so its slices are built
once a cell; every block returns k rows per query.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import python_ready, stored

SEGMENT_ROWS = 1 << 15
QUERY_ROWS = 256
#: Tasks at most; a task takes its cells one after the other.
MOST_TASKS = 50_000
#: Leading bits kept of every value, and of every query component.
VALUE_BITS, WEIGHT_BITS = 6, 12


def quantised(vector: Column, scale: float = 256.0) -> Column:
    """floor(scale * x) of every component as long; null unless every component is finite."""
    x = vector.cast("array<double>")
    good = F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return F.when(good, F.transform(x, lambda v: F.floor(v * F.lit(scale))))


# ---- bit slices over one segment -------------------------------------------------

def to_slices(values: np.ndarray, bits: int) -> np.ndarray:
    """(bits, words) bitmaps of non-negative integers; bit r of a bitmap belongs to row r."""
    width = (len(values) + 63) // 64 * 64
    out = np.zeros((bits, width), dtype=bool)
    for j in range(bits):
        out[j, :len(values)] = (values >> j) & 1
    return np.packbits(out, axis=1, bitorder="little").view(np.uint64)


class SliceSum:
    """A running sum of weighted bitmaps, one pending bitmap at most per weight (carry-save)."""

    def __init__(self, words: int):
        self.words = words
        self.pending: list[list[np.ndarray]] = []

    def add(self, weight: int, bitmap: np.ndarray) -> None:
        """Add 2**weight to every row whose bit is set."""
        while len(self.pending) <= weight:
            self.pending.append([])
        held = self.pending[weight]
        held.append(bitmap)
        if len(held) == 3:
            a, b, c = held
            either = a ^ b
            self.pending[weight] = [either ^ c]
            self.add(weight + 1, (a & b) | (either & c))

    def slices(self) -> list[np.ndarray]:
        """The sum's bitmaps, least significant first."""
        out, j = [], 0
        while j < len(self.pending):
            held = self.pending[j]
            if len(held) == 2:
                a, b = held
                self.pending[j] = [a ^ b]
                self.add(j + 1, a & b)
            out.append(self.pending[j][0] if self.pending[j] else np.zeros(self.words, dtype=np.uint64))
            j += 1
        return out


def rows_of(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def count_of(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def kth_largest(slices: list[np.ndarray], valid: np.ndarray, k: int) -> int:
    """The k-th largest sum among the valid rows, read off from the top slice down (at least k rows)."""
    among, need, value = valid, k, 0
    for j in range(len(slices) - 1, -1, -1):
        ones = among & slices[j]
        n = count_of(ones)
        if n >= need:
            among, value = ones, value | 1 << j
        else:
            among, need = among & ~slices[j], need - n
    return value


def at_least(slices: list[np.ndarray], valid: np.ndarray, bound: int) -> np.ndarray:
    """The valid rows whose sum is at least ``bound``, from the top slice down."""
    if bound <= 0:
        return valid
    if bound >> len(slices):
        return np.zeros_like(valid)
    above, equal = np.zeros_like(valid), valid
    for j in range(len(slices) - 1, -1, -1):
        if bound >> j & 1:
            equal = equal & slices[j]
        else:
            above = above | (equal & slices[j])
            equal = equal & ~slices[j]
    return above | equal


class Segment:
    """Bit slices and exact integers of some rows with vectors of one length."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        lowest = vectors.min(axis=0)
        span = int((vectors.max(axis=0) - lowest).max())
        self.shift = max(0, span.bit_length() - VALUE_BITS)
        self.bits = min(span.bit_length(), VALUE_BITS)
        self.lowest = lowest
        self.words = (len(ids) + 63) // 64
        coarse = (vectors - lowest) >> self.shift
        self.attributes = [to_slices(coarse[:, d], self.bits) for d in range(vectors.shape[1])]
        #: The same for 2**bits - 1 - value, which negative weights use.
        self.reverse = [~x for x in self.attributes]
        self.valid = to_slices(np.ones(len(ids), dtype=np.int64), 1)[0]
        #: What the shift cut off each value: 0 to ``cut``.
        self.cut = (1 << self.shift) - 1

    def top(self, query: np.ndarray, own: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(ids, scores) of the k best rows other than ``own``; ties to the smaller id."""
        weight = np.abs(query)
        drop = max(0, int(weight.max(initial=0)).bit_length() - WEIGHT_BITS)
        coarse = weight >> drop
        total = SliceSum(self.words)
        for d in np.flatnonzero(coarse):
            slices = self.attributes[d] if query[d] > 0 else self.reverse[d]
            for b in range(int(coarse[d]).bit_length()):
                if coarse[d] >> b & 1:
                    for j in range(self.bits):
                        total.add(b + j, slices[j])
        sums = total.slices()
        # score = constant + 2**(drop + shift) * sum + error with 0 <= error <= high:
        # weights lose up to 2**drop - 1 times a value, values up to ``cut`` times a weight.
        top = ((1 << self.bits) - 1 << self.shift) + self.cut
        lost = int((weight - (coarse << drop)).sum()) * top
        high = lost + int((coarse << drop).sum()) * self.cut
        unit = 1 << drop + self.shift
        want = k + int((self.ids == own).sum())
        if count_of(self.valid) > want and sums:
            # The wanted-th score is at least the wanted-th sum, so a row further below than ``high`` is out.
            bound = kth_largest(sums, self.valid, want) - high // unit
            rows = rows_of(at_least(sums, self.valid, bound))
        else:
            rows = np.arange(len(self.ids))
        rows = rows[self.ids[rows] != own]
        scores = self.vectors[rows] @ query
        best = np.lexsort((self.ids[rows], -scores))[:k]
        return self.ids[rows[best]], scores[best]


# ---- the same over a table --------------------------------------------------------

def packed(vectors: np.ndarray) -> bytes:
    """The integers as bytes, preceded by their width: 2, 4 or 8 bytes each."""
    for kind in (np.int16, np.int32, np.int64):
        if vectors.min() >= np.iinfo(kind).min and vectors.max() <= np.iinfo(kind).max:
            return bytes([np.dtype(kind).itemsize]) + vectors.astype(kind).tobytes()


def unpacked(data: bytes, width: int) -> np.ndarray:
    return np.frombuffer(data, dtype=f"i{data[0]}", offset=1).astype(np.int64).reshape(-1, width)


def _meet(k: int):
    """Rows come sorted by cell, the segment (block -1) before its query blocks."""
    def run(batches):
        held, segment = None, None
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], dtype=np.int64)
                vectors = unpacked(row["vectors"], row["width"])
                if row["block"] < 0:
                    held, segment = row["cell"], Segment(ids, vectors)
                elif held == row["cell"]:
                    out = [segment.top(v, q, k) for q, v in zip(ids, vectors)]
                    yield pa.record_batch([
                        pa.array(np.repeat(ids, [len(x[0]) for x in out])),
                        pa.array(np.concatenate([x[0] for x in out])), pa.array(np.concatenate([x[1] for x in out]))],
                        names=["query_id", "vec_id", "score"])
    return run


def _pack(most: int):
    """Pack (id, vector) rows into blocks of at most ``most`` rows of one vector length."""
    def run(batches):
        waiting: dict[int, list] = {}

        def block(width, parts):
            ids, vectors = (np.concatenate(x) for x in zip(*parts))
            return pa.record_batch([pa.array([width], pa.int32()), pa.array([ids.tobytes()]),
                                    pa.array([packed(vectors)])], names=["width", "ids", "vectors"])
        for batch in batches:
            lists = batch.column(1)
            widths = np.diff(np.asarray(lists.offsets))
            ids = np.asarray(batch.column(0))
            for width in np.unique(widths[widths > 0]):
                rows = np.flatnonzero(widths == width)
                flat = np.asarray(lists.take(pa.array(rows)).flatten(), dtype=np.int64).reshape(len(rows), width)
                for at in range(0, len(rows), most):
                    held = waiting.setdefault(int(width), [])
                    part = (ids[rows[at:at + most]], flat[at:at + most])
                    if sum(len(x[0]) for x in held) + len(part[0]) > most:
                        yield block(int(width), held)
                        held.clear()
                    held.append(part)
        for width, held in waiting.items():
            if held:
                yield block(width, held)
    return run


def blocks(rows: DataFrame, most: int) -> DataFrame:
    """(width, ids, vectors) blocks of at most ``most`` rows; tasks are filled to about that many rows."""
    n = rows.count()
    parts = max(1, -(-n // most))
    return rows.repartition(parts).mapInArrow(_pack(most), "width int, ids binary, vectors binary")


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id",
          vector_col: str = "embedding", segment_rows: int = SEGMENT_ROWS, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Per query its k highest inner products: (query_id, rank from 1, vec_id, score).

    ``queries`` holds rows of the same kind as ``vectors``; a query is matched
    with every row that has another id. Ties go to the smaller id.

    Rows take no part if the id or the vector is null, or a component is null
    or not finite; nor do empty vectors. Vectors of another length than the
    query's don't match it. A row that repeats id and vector counts once.
    Components are quantised to integers; scores must fit a long.
    """
    spark = vectors.sparkSession
    python_ready(spark)

    def usable(df):
        q = df.select(F.col(id_col).cast("long").alias("id"), quantised(F.col(vector_col)).alias("v"))
        return q.where(F.col("id").isNotNull() & F.col("v").isNotNull() & (F.size("v") > 0)).distinct()
    def numbered(df, most, name):
        """Stored blocks with a gapless number; only the blocks' names go through the numbering window."""
        kept = stored(blocks(usable(df), most).withColumn("name", F.monotonically_increasing_id()), name)
        number = F.row_number().over(Window.orderBy("width", "name")) - 1
        numbers = stored(kept.select("width", "name").select("name", number.cast("long").alias("number")), f"{name}_numbers")
        return kept.join(numbers, "name").drop("name"), numbers.count()
    asked, n_blocks = numbered(queries, query_rows, "queries")
    index, n_segments = numbered(vectors, segment_rows, "segments")
    if not n_blocks or not n_segments:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    # As many groups as make a group's queries a segment's size, or as give every core a cell.
    cores = spark.sparkContext.defaultParallelism
    groups = min(n_blocks, max(-(-n_blocks * query_rows // segment_rows), -(-2 * cores // n_segments)))

    def cell(segment, group):
        return segment * F.lit(groups) + group
    # Segments are numbered by width, so those of a width are a run of numbers: a row per width.
    runs = index.groupBy("width").agg(F.min("number").alias("low"), F.max("number").alias("high"))
    places = asked.select("width", (F.col("number") % groups).alias("group")).distinct()
    sent = index.join(places, "width").select(
        cell(F.col("number"), F.col("group")).alias("cell"), F.lit(-1).cast("long").alias("block"), "width", "ids", "vectors")
    put = asked.join(runs, "width").withColumn("segment", F.explode(F.sequence("low", "high"))).select(
        cell(F.col("segment"), F.col("number") % groups).alias("cell"), F.col("number").alias("block"), "width", "ids", "vectors")
    found = (sent.unionByName(put).repartitionById(min(n_segments * groups, MOST_TASKS), (F.col("cell") % MOST_TASKS).cast("int"))
                 .sortWithinPartitions("cell", "block").mapInArrow(_meet(k), "query_id long, vec_id long, score long"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


TOPK_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id,
    CAST(list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id AND len(q.e) = len(c.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 5
"""
