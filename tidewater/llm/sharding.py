"""A uniform shuffle of a table into shards of exact sizes, by a hypergeometric communication matrix.

Rows lie in cells (runs of at most ``CELL_ROWS`` rows of one written task) and go to blocks (equal
runs of the slots of a shard). In a uniform random permutation the number of rows that go from
each cell to each block follows a multivariate hypergeometric law with the cells' and the
blocks' sizes as margins. That matrix is drawn exactly: the set of cells is halved again and
again, and each time the room of the blocks is split between the halves by a draw seeded by
the half itself. A task so draws the matrix row of its own cell and needs nobody else's.

1. Local permutation: a cell's rows get the blocks of its matrix row in random order.
2. Exchange: one shuffle by block. Every block receives exactly its size, whatever the data.
3. Second permutation: rows of a block are ordered by a seeded 64-bit hash of their place.

A shard is never one task: blocks have ``BLOCK_ROWS`` rows at most. The cells' sizes are all
that meets on the driver (one number a written task).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import python_ready, stored

CELL_ROWS = 1 << 16
BLOCK_ROWS = 1 << 15
#: NumPy's hypergeometric sampler takes fewer rows than this on either side.
SAMPLER_ROWS = 10**9
#: monotonically_increasing_id: the task above, the row within the task in the low bits.
SEAT_BITS = 33


def _draw_large(rng: np.random.Generator, good: int, bad: int, drawn: int) -> int:
    """A hypergeometric number for populations of any size, by inversion around the mode.

    Terms beyond twelve standard deviations weigh less than 1e-30 and are left out.
    """
    least, most = max(0, drawn - bad), min(good, drawn)
    total = good + bad
    mode = min(max((drawn + 1) * (good + 1) // (total + 2), least), most)
    sd = (drawn * (good / total) * (bad / total) * ((total - drawn) / max(total - 1, 1))) ** 0.5
    width = int(12 * sd) + 50
    low, high = max(least, mode - width), min(most, mode + width)
    k = np.arange(low, high, dtype=np.float64)
    # log of the ratio of neighbouring terms; its sums are exact to rounding even for large populations
    ratio = (np.log(good - k) + np.log(drawn - k)) - (np.log(k + 1) + np.log(bad - drawn + k + 1))
    logs = np.concatenate(([0.0], np.cumsum(ratio)))
    weight = np.cumsum(np.exp(logs - logs[mode - low]))
    return low + int(np.searchsorted(weight, rng.random() * weight[-1], "right").clip(0, high - low))


def _draw(rng: np.random.Generator, good: np.ndarray, bad: np.ndarray, drawn: np.ndarray) -> np.ndarray:
    """Hypergeometric numbers, one per place of the arrays."""
    large = (good >= SAMPLER_ROWS) | (bad >= SAMPLER_ROWS)
    out = rng.hypergeometric(np.where(large, 0, good), np.where(large, 0, bad), np.where(large, 0, drawn))
    for i in np.flatnonzero(large):
        out[i] = _draw_large(rng, int(good[i]), int(bad[i]), int(drawn[i]))
    return out


def split_room(room: np.ndarray, drawn: int, rng: np.random.Generator) -> np.ndarray:
    """How many of ``drawn`` rows, taken without replacement, fall to each block of ``room[i]`` rows.

    The blocks are halved from the top; the draws of one level do not depend on each
    other, so a level is one call.
    """
    levels = [room]
    while len(levels[-1]) > 1:
        row = levels[-1]
        row = np.append(row, 0) if len(row) % 2 else row
        levels[-1] = row
        levels.append(row[0::2] + row[1::2])
    taken = np.array([drawn], dtype=np.int64)
    for row in levels[-2::-1]:
        taken = taken[:len(row) // 2]  # a level of odd length was padded by an empty block
        left = _draw(rng, row[0::2], row[1::2], taken)
        both = np.empty(len(row), dtype=np.int64)
        both[0::2], both[1::2] = left, taken - left
        taken = both
    return taken[:len(room)]


class Matrix:
    """The communication matrix of (cells x blocks), row by row, never held as a whole."""

    def __init__(self, cells: np.ndarray, blocks: np.ndarray, seed: int):
        self.before = np.concatenate(([0], np.cumsum(cells)))
        self.blocks, self.seed = blocks, seed
        self.known: dict[tuple[int, int], np.ndarray] = {}

    def rng(self, *which: int) -> np.random.Generator:
        return np.random.Generator(np.random.PCG64(np.random.SeedSequence([self.seed, *which])))

    def row(self, cell: int) -> np.ndarray:
        """How many of a cell's rows go to each block."""
        low, high, room = 0, len(self.before) - 1, self.blocks
        used = {}
        while high - low > 1:
            mid = (low + high) // 2
            left = self.known.get((low, high))
            if left is None:
                left = split_room(room, int(self.before[mid] - self.before[low]), self.rng(low, high))
            used[low, high] = left
            low, high, room = (low, mid, left) if cell < mid else (mid, high, room - left)
        self.known = used  # neighbouring cells share most of the way
        return room

    def targets(self, cell: int) -> np.ndarray:
        """The block of every row of a cell: its matrix row, permuted."""
        to = np.repeat(np.arange(len(self.blocks), dtype=np.int64), self.row(cell))
        return self.rng(cell, cell).permutation(to)


def even(total: int, parts: int) -> np.ndarray:
    """``total`` rows in ``parts`` sizes that differ by one at most, larger ones first."""
    return total // parts + (np.arange(parts) < total % parts).astype(np.int64)


def shard_rows(rows: DataFrame, shards: int = 8, seed: int = 0, block_rows: int = BLOCK_ROWS,
               cell_rows: int = CELL_ROWS) -> DataFrame:
    """``rows`` with ``shard`` (int, from 0) and ``slot`` (long, gapless from 0 within the shard).

    All rows, repeated ones and nulls included, are shuffled uniformly; shard sizes differ by
    one row at most. Columns of ``rows`` with one of the two names are replaced; any other
    column passes through. An empty table gives an empty one. The outcome follows from the
    seed and from the order in which the rows were written once, so a lost task is redone alike;
    a new run on another cluster draws another permutation of the same law.
    """
    spark: SparkSession = rows.sparkSession
    python_ready(spark)
    source = rows.drop("shard", "slot")
    place = _free_name("place", source.columns)
    block = _free_name("block", source.columns)
    held = stored(source.withColumn(place, F.monotonically_increasing_id()), "sharding")
    tasks = held.groupBy(F.shiftright(place, SEAT_BITS).alias("task")).agg(F.count(F.lit(1)).alias("n")).collect()
    in_task = np.zeros(max((t.task for t in tasks), default=-1) + 1, dtype=np.int64)
    for t in tasks:
        in_task[t.task] = t.n
    in_cells = -(-in_task // cell_rows)
    first_cell = np.concatenate(([0], np.cumsum(in_cells)))
    cells = np.full(first_cell[-1], cell_rows, dtype=np.int64)
    last = first_cell[1:][in_task > 0] - 1
    cells[last] = in_task[in_task > 0] - (in_cells[in_task > 0] - 1) * cell_rows
    total = int(in_task.sum())
    in_shard = even(total, shards)
    per_shard = max(1, -(-int(in_shard.max()) // block_rows))
    blocks = np.concatenate([even(int(n), per_shard) for n in in_shard])
    shared = spark.sparkContext.broadcast((first_cell, cells, blocks))

    @F.pandas_udf("long")
    def target(places: Iterator[pd.Series]) -> Iterator[pd.Series]:
        first, sizes, room = shared.value
        matrix, now, to = Matrix(sizes, room, seed), -1, np.zeros(0, dtype=np.int64)
        for some in places:
            at = some.to_numpy()
            seat = at & ((1 << SEAT_BITS) - 1)
            cell = first[at >> SEAT_BITS] + seat // cell_rows
            out = np.empty(len(at), dtype=np.int64)
            for c in np.unique(cell):
                if c != now:
                    now, to = int(c), matrix.targets(int(c))
                mine = cell == c
                out[mine] = to[seat[mine] % cell_rows]
            yield pd.Series(out)

    dealt = held.withColumn(block, target(F.col(place)))
    order = Window.partitionBy(block).orderBy(F.xxhash64(F.lit(seed), F.col(place)), F.col(place))
    shard = F.floor(F.col(block) / per_shard)
    number, size = F.col(block) % per_shard, F.lit(total // shards) + F.when(shard < total % shards, 1).otherwise(0)
    start = number * F.floor(size / per_shard) + F.least(number, size % per_shard)
    return dealt.select(*source.columns, shard.cast("int").alias("shard"),
                        (start + F.row_number().over(order) - 1).cast("long").alias("slot"))


def _free_name(name: str, taken: list[str]) -> str:
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def write_shards(sharded: DataFrame, path: str) -> None:
    """One folder a shard; its files hold runs of slots in order."""
    sharded.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot") \
           .write.partitionBy("shard").parquet(path)


def shard_report(docs: DataFrame, shards: int = 8, seed: int = 0) -> DataFrame:
    """Per document its size (UTF-8 bytes of the text plus 1; a null text has none), CRC-32, shard and slot.

    The law is ``rows``: shard sizes differ by one row at most. Uniform placement cannot tell where a row
    would go with one more shard, so ``grown_shard`` is null.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    placed = shard_rows(docs.select("doc_id", "text"), shards, seed)
    return placed.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"),
                         F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("rows").alias("law"),
                         "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
