"""Benchmark decontamination: CGK embedding, bit-sampling LSH, exact edit verification.

Texts and benchmark items are sequences of words (lower-cased A-Z). The CGK random
walk reads a sequence with a pointer: at step j it writes the word under the
pointer and moves on by one place or stays, by a random bit of (j, word). Two
sequences with few edits get embeddings of small Hamming distance. A repetition
samples a few positions of the embedding; item-sized windows of a text whose sampled
words all equal an item's are candidates.

A window starts at every word of every text, and an item is indexed from each of its
words on, so an occurrence has as many chances per repetition as it has words: each
stretch of about ``STEPS`` / 2 unedited words is one. Every candidate is confirmed by the
exact edit distance, in words, between the item and the best-fitting stretch of
the text around it.

An item of fewer than ``SEEDED`` words is too short for the walk. It is cut into one piece more
than it may have edits, so that a piece is left whole wherever it occurs; every place of
a text that holds a piece is a candidate, and all of them are confirmed the same way.

Benchmark items go to the tasks in blocks of bounded size, one pass over the
texts per block; the texts are never shuffled.
"""

from __future__ import annotations

import logging
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import python_ready, stored
from .wordhash import Slice, WordHash, _odd, mix, slices

#: Share of an item's words that edits may touch, in percent.
EDIT_PERCENT = 20
#: Repetitions, words sampled in each, and steps of the walk they are sampled from.
REPETITIONS, SAMPLES, STEPS = 6, 6, 12
#: Words of benchmark items that go to the tasks at once.
BLOCK_WORDS = 250_000
#: Items of fewer words are found by their pieces instead of the walk.
SEEDED = 10
#: Items of fewer words are not searched; they are counted. A text that holds no word cannot be searched.
MIN_WORDS = 1
#: Candidates of short items that are looked at together.
TOGETHER = 1 << 17


LOG = logging.getLogger(__name__)


def allowed_edits(words: int, percent: int = EDIT_PERCENT) -> int:
    return words * percent // 100


def sampled_steps(repetition: int, samples: int = SAMPLES, steps: int = STEPS) -> list[int]:
    """The positions of the embedding that a repetition looks at: the first and random later ones."""
    rng = np.random.Generator(np.random.PCG64(900 + repetition))
    return [0, *sorted(rng.choice(np.arange(1, steps), samples - 1, replace=False).tolist())]


def walk_prefixes(words: np.ndarray, places: np.ndarray, ends: np.ndarray, repetition: int,
                  samples: int = SAMPLES, steps: int = STEPS):
    """Walk from each place; per sampled step yield (which places go on, hash of the words sampled so far).

    A walk that runs over its sequence's end writes a blank. The receiver sends
    back which of the walks to follow further.
    """
    bits = _odd(1000 + repetition, steps)
    wanted = set(sampled_steps(repetition, samples, steps))
    who, at = np.arange(len(places)), places.copy()
    seen = np.full(len(places), np.uint64(repetition + 1))
    for step in range(steps):
        inside = at < ends[who]
        word = np.where(inside, words[np.minimum(at, len(words) - 1)], np.uint64(0))
        if step in wanted:
            seen = mix(seen * np.uint64(0x9E3779B97F4A7C15) + word)
            keep = yield who, seen
            if keep is not None:
                who, at, seen, word, inside = who[keep], at[keep], seen[keep], word[keep], inside[keep]
        at = at + (inside & (mix(word ^ bits[step]) & np.uint64(1)).astype(bool))


@dataclass
class Index:
    """The items of one block: their words, and per repetition the sampled prefixes of their embeddings."""

    ids: np.ndarray
    words: np.ndarray
    bounds: np.ndarray
    #: Selects the low bits of a hash that the bitmaps go by: some 64 bits for each word.
    low: np.uint64
    #: A bitmap over the low bits of the items' words.
    starts: np.ndarray
    #: Per repetition and sample: a bitmap over the low bits of the prefix hashes.
    filters: list[list[np.ndarray]]
    #: Per repetition: sorted full hashes, and the item and word each starts at.
    keys: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    #: Per length of a piece of the short items: a bitmap, sorted hashes, and the item and word each starts at.
    pieces: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]


def word_hash() -> WordHash:
    global _HASH
    if _HASH is None:
        _HASH = WordHash(501)
    return _HASH


_HASH: WordHash | None = None


def build_index(ids: np.ndarray, words: np.ndarray, bounds: np.ndarray, percent: int = EDIT_PERCENT,
                repetitions: int = REPETITIONS, samples: int = SAMPLES, steps: int = STEPS) -> Index:
    owner = np.repeat(np.arange(len(ids)), np.diff(bounds))
    places = np.flatnonzero(np.diff(bounds)[owner] >= SEEDED)
    owner = owner[places]
    ends = bounds[owner + 1]
    low = np.uint64((1 << max(16, (64 * len(words)).bit_length())) - 1)
    filters, keys = [], []
    for r in range(repetitions):
        masks, last = [], None
        for who, seen in walk_prefixes(words, places, ends, r, samples, steps):
            mask = np.zeros(int(low) + 1, dtype=bool)
            mask[seen & low] = True
            masks.append(mask)
            last = (who, seen)
        who, seen = last
        order = np.argsort(seen, kind="stable")
        filters.append(masks)
        keys.append((seen[order], owner[who[order]], places[who[order]] - bounds[owner[who[order]]]))
    starts = np.zeros(int(low) + 1, dtype=bool)
    starts[words[places] & low] = True
    return Index(ids, words, bounds, low, starts, filters, keys, item_pieces(words, bounds, percent, low))


def piece_hashes(words: np.ndarray, places: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the ``size`` words from each place on."""
    out = np.full(len(places), np.uint64(size))
    for j, factor in enumerate(_odd(1100, size)):
        out += words[places + j] * factor
    return mix(out)


def item_pieces(words: np.ndarray, bounds: np.ndarray, percent: int, low: np.uint64) -> dict:
    """The pieces of the short items, by their length: see ``Index.pieces``."""
    sizes, found = np.diff(bounds), {}
    for n in range(1, SEEDED):
        items = np.flatnonzero(sizes == n)
        count = min(allowed_edits(n, percent) + 1, n)
        cuts = [n * i // count for i in range(count + 1)] if len(items) else []
        for begin, end in zip(cuts, cuts[1:]):
            hashes = piece_hashes(words, bounds[items] + begin, end - begin)
            found.setdefault(end - begin, []).append((hashes, items, np.full(len(items), begin)))
    out = {}
    for size, parts in found.items():
        hashes, items, begin = (np.concatenate(x) for x in zip(*parts))
        mask = np.zeros(int(low) + 1, dtype=bool)
        mask[hashes & low] = True
        order = np.argsort(hashes, kind="stable")
        out[size] = mask, hashes[order], items[order], begin[order]
    return out


def candidates(index: Index, words: np.ndarray, bounds: np.ndarray, samples: int, steps: int):
    """Distinct (place in words, item, word of the item) whose sampled words agree in a repetition."""
    # Every walk writes the word it starts on first: only words of items can start one.
    places = np.flatnonzero(index.starts[words & index.low])
    ends = np.repeat(bounds[1:], np.diff(bounds))[places]
    found = []
    for r, masks in enumerate(index.filters):
        walk = walk_prefixes(words, places, ends, r, samples, steps)
        who, seen = next(walk)
        for mask in masks:
            keep = np.flatnonzero(mask[seen & index.low])
            last = who[keep], seen[keep]
            try:
                who, seen = walk.send(keep)
            except StopIteration:
                break
        who, seen = last
        keys, item, start = index.keys[r]
        lo, hi = np.searchsorted(keys, seen, "left"), np.searchsorted(keys, seen, "right")
        n = hi - lo
        some = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        found.append(np.stack([places[np.repeat(who, n)], item[some], start[some]], axis=1))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 3), dtype=np.int64)


def best_fit(item: np.ndarray, text: np.ndarray) -> int:
    """The exact least edit distance, in words, between the item and any stretch of the text.

    The bit-parallel dynamic programme over the item's words, one step per word of the text.
    """
    n = len(item)
    masks: dict[int, int] = {}
    for i, w in enumerate(item.tolist()):
        masks[w] = masks.get(w, 0) | 1 << i
    full, top = (1 << n) - 1, 1 << n - 1
    plus, minus, score, best = full, 0, n, n
    for w in text.tolist():
        eq = masks.get(w, 0)
        xv = eq | minus
        xh = (((eq & plus) + plus) ^ plus) | eq
        ph, mh = minus | (~(xh | plus) & full), plus & xh
        if ph & top:
            score += 1
        elif mh & top:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        plus, minus = mh | (~(xv | ph) & full), ph & xv
        best = min(best, score)
    return best


def short_fits(items: np.ndarray, texts: np.ndarray, inside: np.ndarray) -> np.ndarray:
    """``best_fit`` of many items of one length, each in its own few words of text; words not ``inside`` equal none."""
    above = np.zeros((texts.shape[1] + 1, len(items)), dtype=np.int8)
    for i in range(items.shape[1]):
        row = np.empty_like(above)
        row[0] = i + 1
        for j in range(texts.shape[1]):
            differs = (items[:, i] != texts[:, j]) | ~inside[:, j]
            row[j + 1] = np.minimum(np.minimum(above[j + 1], row[j]) + 1, above[j] + differs)
        above = row
    return above.min(axis=0)


def short_matches(index: Index, part: Slice, hashes: np.ndarray, percent: int):
    """(row of the slice, item number, distance) of every row and short item it holds."""
    sizes, out = np.diff(index.bounds), {}
    ends = np.repeat(part.bounds[1:], np.diff(part.bounds))
    for size, (mask, keys, items, begins) in index.pieces.items():
        places = np.flatnonzero(np.arange(len(hashes)) + size <= ends)
        seen = piece_hashes(hashes, places, size)
        some = np.flatnonzero(mask[seen & index.low])
        places, seen = places[some], seen[some]
        lo = np.searchsorted(keys, seen, "left")
        n = np.searchsorted(keys, seen, "right") - lo
        places, lo, n = places[n > 0], lo[n > 0], n[n > 0]
        total = np.concatenate(([0], np.cumsum(n)))
        at = 0
        while at < len(places):
            stop = max(at + 1, int(np.searchsorted(total, total[at] + TOGETHER, "right")) - 1)
            m = n[at:stop]
            hit = np.repeat(lo[at:stop] - total[at:stop], m) + np.arange(total[at], total[stop])
            first, item = np.repeat(places[at:stop], m) - begins[hit], items[hit]
            row = np.searchsorted(part.bounds, np.repeat(places[at:stop], m), "right") - 1
            at = stop
            for length in np.unique(sizes[item]).tolist():
                one = np.flatnonzero(sizes[item] == length)
                edits = allowed_edits(length, percent)
                place = first[one, None] + np.arange(-edits, length + edits)
                inside = (place >= part.bounds[row[one], None]) & (place < part.bounds[row[one] + 1, None])
                distance = short_fits(index.words[index.bounds[item[one], None] + np.arange(length)],
                                      hashes[np.clip(place, 0, len(hashes) - 1)], inside)
                good = np.flatnonzero(distance <= edits)
                for r, j, d in zip(row[one[good]].tolist(), item[one[good]].tolist(), distance[good].tolist()):
                    out[r, j] = min(out.get((r, j), d), d)
    return [(r, j, d) for (r, j), d in out.items()]


def matches(index: Index, part: Slice, hashes: np.ndarray, percent: int, samples: int, steps: int):
    """(row of the slice, item number, distance) of every contaminated row and item."""
    short = short_matches(index, part, hashes, percent)
    found = candidates(index, hashes, part.bounds, samples, steps)
    if not len(found):
        return short
    row = np.searchsorted(part.bounds, found[:, 0], "right") - 1
    size = np.diff(index.bounds)[found[:, 1]]
    slack = size * percent // 100
    # The stretch of text that an occurrence through this candidate can take up.
    begin = np.maximum(part.bounds[row], found[:, 0] - found[:, 2] - slack)
    end = np.minimum(part.bounds[row + 1], found[:, 0] - found[:, 2] + size + slack)
    order = np.lexsort((begin, found[:, 1], row))
    out: dict[tuple[int, int], int] = {}
    at = 0
    while at < len(order):
        i = order[at]
        key, stop, upto = (int(row[i]), int(found[i, 1])), at + 1, end[i]
        # Overlapping stretches of one row and item are looked at together.
        while stop < len(order) and (row[order[stop]], found[order[stop], 1]) == key and begin[order[stop]] <= upto:
            upto = max(upto, end[order[stop]])
            stop += 1
        item = index.words[index.bounds[key[1]]:index.bounds[key[1] + 1]]
        text = hashes[begin[i]:upto]
        at = stop
        edits = allowed_edits(len(item), percent)
        # Every word that survives the edits is in the text: most chance candidates end here.
        there = set(text.tolist())
        if sum(w in there for w in item.tolist()) < len(item) - edits:
            continue
        distance = best_fit(item, text)
        if distance <= edits:
            out[key] = min(out.get(key, distance), distance)
    return short + [(r, j, d) for (r, j), d in out.items()]


def item_blocks(items: DataFrame, most_words: int = BLOCK_WORDS):
    """Lists of item rows (number, id, text) of at most ``most_words`` words each (at least one item).

    The rows come to the driver block by block, never all at once: blocks are
    ranges of a running sum of words kept in a table.
    """
    sized = items.select("item", "text", F.size(F.split("text", r"[\x20\x09-\x0D]+")).cast("long").alias("n"))
    # The sum runs within coarse ranges of the hash, so that no task sees all items.
    ranged = sized.withColumn("range", F.pmod(F.xxhash64("item", "text"), F.lit(4096)))
    run = Window.partitionBy("range").orderBy("item", "text").rowsBetween(Window.unboundedPreceding, -1)
    placed = ranged.withColumn("before", F.coalesce(F.sum("n").over(run), F.lit(0)))
    placed = stored(placed.withColumn("part", F.expr(f"before div {most_words}")), "items")
    totals = placed.groupBy("range", "part").agg(F.sum("n").alias("n")).orderBy("range", "part").toLocalIterator()
    group, held = [], 0
    for t in totals:
        if group and held + t["n"] > most_words:
            yield placed.where(_any_of(group))
            group, held = [], 0
        group.append((t["range"], t["part"]))
        held += t["n"]
    if group:
        yield placed.where(_any_of(group))


def _any_of(group):
    by_part: dict[int, list[int]] = {}
    for r, p in group:
        by_part.setdefault(p, []).append(r)
    out = F.lit(False)
    for p, ranges in by_part.items():
        out = out | ((F.col("part") == p) & F.col("range").isin(ranges))
    return out


def left_out(items: DataFrame, item_col: str = "item_id", item_text_col: str = "text",
             min_words: int = MIN_WORDS) -> DataFrame:
    """(item_id, n_words) of the items that are not searched: null ids or texts, and those of fewer than ``min_words`` words."""
    n = F.size(F.regexp_extract_all(F.coalesce(F.col(item_text_col), F.lit("")), F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0)))
    return items.select(F.col(item_col).cast("long").alias("item_id"), n.alias("n_words")).where(
        F.col("item_id").isNull() | (F.col("n_words") < min_words))


def find_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_col: str = "item_id", item_text_col: str = "text", percent: int = EDIT_PERCENT,
                      min_words: int = MIN_WORDS, repetitions: int = REPETITIONS, samples: int = SAMPLES,
                      steps: int = STEPS) -> DataFrame:
    """(doc_id, item_id, distance) for every text that holds an item up to ``percent`` of its words edited.

    Items of fewer than ``min_words`` words, or null ids or texts, are left
    out; the log counts them, and ``left_out`` returns them. Null, empty and wordless texts hold nothing. Rows
    that repeat a doc_id or item_id are judged alike; each pair is returned once,
    with its least distance.
    """
    spark = docs.sparkSession
    python_ready(spark)
    usable = items.where(F.col(item_col).isNotNull() & F.col(item_text_col).isNotNull()).select(
        F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text"))
    source = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    schema = "doc_id long, item_id long, distance int"
    found = spark.createDataFrame([], schema)
    for block in item_blocks(usable):
        rows = block.select("item", "text").toArrow()
        if not rows.num_rows:
            continue
        ids, words, short = [], [], 0
        for part in slices(rows["text"], lower=True):
            hashes = word_hash()(part.data, part.starts, part.ends)
            for r in range(len(part.bounds) - 1):
                mine = hashes[part.bounds[r]:part.bounds[r + 1]]
                if len(mine) >= min_words:
                    ids.append(rows["item"][part.rows.start + r].as_py())
                    words.append(mine)
                else:
                    short += 1
        if short:
            LOG.warning("%d benchmark items of fewer than %d words are not searched", short, min_words)
        if not ids:
            continue
        bounds = np.concatenate(([0], np.cumsum([len(w) for w in words])))
        shared = spark.sparkContext.broadcast((np.array(ids), np.concatenate(words), bounds))
        found = found.union(source.mapInArrow(_search(shared, percent, repetitions, samples, steps), schema))
    return found.groupBy("doc_id", "item_id").agg(F.min("distance").alias("distance"))


_LAST: tuple | None = None


def _index(shared, *how) -> Index:
    """The index of a block of items, built once by each Python worker that needs it."""
    global _LAST
    if _LAST is None or _LAST[0] is not shared.value or _LAST[1] != how:
        _LAST = shared.value, how, build_index(*shared.value, *how)
    return _LAST[2]


def _search(shared, percent: int, repetitions: int, samples: int, steps: int):
    def run(batches):
        index = _index(shared, percent, repetitions, samples, steps)
        for batch in batches:
            ids, rows = batch.column(0), []
            for part in slices(batch.column(1), lower=True):
                hashes = word_hash()(part.data, part.starts, part.ends)
                if len(hashes):
                    rows += [(part.rows.start + r, j, d) for r, j, d in
                             matches(index, part, hashes, percent, samples, steps)]
            at, item, distance = zip(*rows) if rows else ((), (), ())
            yield pa.record_batch([ids.take(pa.array(at, pa.int64())), pa.array(index.ids[list(item)], pa.int64()),
                                   pa.array(distance, pa.int32())], names=["doc_id", "item_id", "distance"])
    return run


def contamination_report(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """Per row of ``docs``: (doc_id, contaminated, item_ids sorted, distance of the closest item)."""
    pairs = find_contaminated(docs, items, id_col, **how)
    by_doc = pairs.groupBy("doc_id").agg(F.sort_array(F.collect_list("item_id")).alias("item_ids"),
                                         F.min("distance").alias("distance"))
    ids = docs.select(F.col(id_col).cast("long").alias("doc_id"))
    out = ids.join(by_doc, "doc_id", "left")
    return out.select("doc_id", F.col("item_ids").isNotNull().alias("contaminated"),
                      F.coalesce("item_ids", F.array().cast("array<bigint>")).alias("item_ids"), "distance")


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", **how) -> DataFrame:
    """``docs`` without the rows that hold a benchmark item; rows with a null id stay."""
    bad = find_contaminated(docs, items, id_col, **how).select(F.col("doc_id").alias("_bad")).distinct()
    return docs.join(bad, docs[id_col] == bad["_bad"], "left_anti")
