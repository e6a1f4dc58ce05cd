"""Language ID: prediction by partial matching over bytes.

Every language has a variable-order tree of byte contexts with escape
probabilities (method C: a context seen n times with d different bytes gives
count / (n + d) to a byte it has seen and d / (n + d) to the escape into the next
shorter context; below order 0 a byte costs 8 bits). The statistics are frozen after
training. A text's score under a language is its exact code length; the
shortest wins.

Training counts the contexts with Spark over a bounded sample of labelled
rows. The model that goes to the tasks is bounded by ``max_nodes`` per language: a language's
statistics come from its own rows alone. In a task, the
longest known contexts of all bytes of a slice are found by gathers in
transition tables, one per order, so no Python runs per byte. A model of many languages
holds only what each of them has seen, and gives the same code lengths.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import python_ready, stored
from .wordhash import slices

#: Longest context in bytes.
ORDER = 3
#: Labelled rows per language that training looks at, whole: a sample by id hash of so many rows on average.
TRAIN_ROWS = 2000
#: Strings of two and more bytes the model keeps of each language, its most frequent ones.
MAX_NODES = 400_000
#: Strings times languages up to which a model is held as full tables.
FULL_CELLS = 1 << 24
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")


@dataclass
class Model:
    """Frozen statistics. Strings of length k + 1 (context and byte) are numbered from 1 at level k."""

    languages: list[str]
    #: next[k][node of the k bytes before, byte] -> node of length k + 1, 0 if unknown.
    next: list[np.ndarray]
    #: cost[k][node] -> bits of the node's last byte after its first k bytes, per language.
    cost: list[np.ndarray]
    #: escape[k][node of length k] -> bits to leave that context, per language (0 where unseen).
    escape: list[np.ndarray]


@dataclass
class SparseModel:
    """The same statistics by what each language has seen; nodes are numbered as in ``Model``."""

    languages: list[str]
    #: next[k] -> sorted keys, 256 times the node before plus the byte, of the nodes 1, 2 and so on.
    next: list[np.ndarray]
    #: Per level: where a node's entries start, and their languages and bits.
    cost: list[tuple[np.ndarray, np.ndarray, np.ndarray]]
    #: Per level: where a context's entries start, and their languages and bits to leave it.
    escape: list[tuple[np.ndarray, np.ndarray, np.ndarray]]


def count_strings(docs: DataFrame, lang_col: str, text_col: str, order: int) -> DataFrame:
    """(lang, gram, n): counts of byte strings of 1 to ``order`` + 1 bytes inside each text."""
    def run(batches):
        for batch in batches:
            langs = np.array(batch.column(0).to_pylist(), dtype=object)
            for part in slices(batch.column(1)):
                if not len(part.data):
                    continue
                names, code = np.unique(langs[part.rows].astype(str), return_inverse=True)
                code = np.repeat(code, np.diff(part.offsets)).astype(np.int64)
                packed = np.zeros(len(part.data), dtype=np.int64)
                start = np.repeat(part.offsets[:-1], np.diff(part.offsets))
                at = np.arange(len(part.data))
                for k in range(order + 1):
                    packed = packed.copy()
                    packed[k:] += part.data[:len(packed) - k].astype(np.int64) << (8 * k)
                    inside = at - start >= k
                    grams, n = np.unique(packed[inside] | (code[inside] << 40), return_counts=True)
                    yield pa.record_batch([
                        pa.array(names[grams >> 40], pa.string()), pa.array(np.full(len(grams), k, np.int32)),
                        pa.array(grams & ((1 << 40) - 1)), pa.array(n.astype(np.int64))],
                        names=["lang", "order", "gram", "n"])
    counted = docs.select(F.col(lang_col).cast("string"), text_col).mapInArrow(
        run, "lang string, order int, gram long, n long")
    return counted.groupBy("lang", "order", "gram").agg(F.sum("n").alias("n"))


def training_rows(docs: DataFrame, id_col: str, lang_col: str, text_col: str, rows: int) -> DataFrame:
    """About ``rows`` rows per language (all, if it has fewer), chosen by id hash; those without id or lang are left out.

    Only counts per language meet, pre-aggregated; each row decides for itself.
    """
    usable = docs.where(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    counts = usable.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    place = F.pmod(F.xxhash64("id"), F.lit(1 << 30)) / float(1 << 30)
    return usable.join(F.broadcast(counts), "lang").where(place * F.col("n") < rows).select("lang", "text")


def train(docs: DataFrame, id_col: str = "doc_id", lang_col: str = "lang", text_col: str = "text",
          rows: int = TRAIN_ROWS, order: int = ORDER, max_nodes: int = MAX_NODES) -> Model:
    """Learn a model from the labelled rows of ``docs`` (no rows: a model without languages)."""
    python_ready(docs.sparkSession)
    counted = stored(count_strings(training_rows(docs, id_col, lang_col, text_col, rows), "lang", "text", order), "strings")
    kept = most_frequent(counted, max_nodes)
    top = kept.groupBy("order", "gram").agg(F.collect_list(F.struct("lang", "n")).alias("by_lang"))
    return build_model(top.select("order", "gram", "by_lang").toArrow(), order)


def most_frequent(counted: DataFrame, max_nodes: int) -> DataFrame:
    """Per language its strings of one byte, and of the longer ones the most frequent, at most ``max_nodes``.

    Strings of equal count stay or go together, so whatever stays has its contexts. Only the numbers of
    strings per count meet by language.
    """
    longer = counted.where(F.col("order") > 0).groupBy("lang", "n").agg(F.count(F.lit(1)).alias("strings"))
    so_far = F.sum("strings").over(Window.partitionBy("lang").orderBy(F.desc("n")))
    least = longer.withColumn("so_far", so_far).where(F.col("so_far") <= max_nodes).groupBy("lang").agg(F.min("n").alias("least"))
    return (counted.join(F.broadcast(least), "lang", "left")
                   .where((F.col("order") == 0) | (F.col("n") >= F.col("least"))).drop("least"))


def build_model(table: pa.Table, order: int, full_cells: int = FULL_CELLS) -> Model | SparseModel:
    """Freeze counted strings: number the nodes per level, then costs from short to long contexts."""
    table = table.combine_chunks()
    level = np.asarray(table["order"].to_numpy(), dtype=np.int64)
    gram = np.asarray(table["gram"].to_numpy(), dtype=np.int64)
    lists = table["by_lang"].combine_chunks()
    owner = np.repeat(np.arange(len(gram)), np.diff(np.asarray(lists.offsets)))
    names = lists.values.field("lang").to_pylist()
    languages = sorted(set(names))
    index = {x: i for i, x in enumerate(languages)}
    if len(gram) * len(languages) > full_cells:
        who = np.array([index[x] for x in names], dtype=np.int64)
        return build_sparse(languages, level[owner], gram[owner], who, np.asarray(lists.values.field("n")), order)
    n = np.zeros((len(gram), len(languages)))
    n[owner, [index[x] for x in names]] = np.asarray(lists.values.field("n"))
    model, width = Model(languages, [], [], []), len(languages)
    known = {0: 0}  # packed context -> node, of the level before; the empty context is node 0
    for k in range(order + 1):
        pick = np.flatnonzero(level == k)
        pick = pick[np.argsort(gram[pick], kind="stable")]
        context, byte = gram[pick] >> 8, gram[pick] & 255
        parent = np.array([known.get(int(c), -1) for c in context], dtype=np.int64)
        pick, context, byte, parent = (x[parent >= 0] for x in (pick, context, byte, parent))
        size = 1 if k == 0 else len(model.cost[k - 1])
        step = np.zeros((size, 256), dtype=np.int32)
        step[parent, byte] = np.arange(1, len(pick) + 1)
        seen = np.zeros((size, width))
        kinds = np.zeros((size, width))
        np.add.at(seen, parent, n[pick])
        np.add.at(kinds, parent, n[pick] > 0)
        with np.errstate(divide="ignore", invalid="ignore"):
            leave = np.where(kinds > 0, -np.log2(kinds / (seen + kinds)), 0.0)
            own = -np.log2(n[pick] / (seen[parent] + kinds[parent]))
        if k == 0:
            shorter = 8.0
        else:
            # The same string without its first byte, one level down; if unknown there, further down.
            shorter = _without_first(model, gram[pick], k)
        cost = np.zeros((len(pick) + 1, width))
        cost[1:] = np.where(n[pick] > 0, own, leave[parent] + shorter)
        model.next.append(step)
        model.cost.append(cost)
        model.escape.append(leave)
        known = {int(g): i + 1 for i, g in enumerate(gram[pick])}
    return model


def build_sparse(languages: list[str], level: np.ndarray, gram: np.ndarray, who: np.ndarray, n: np.ndarray,
                 order: int) -> SparseModel:
    """Freeze counted strings given as one entry for each string and language."""
    model, width = SparseModel(languages, [], [], []), len(languages)
    before = np.zeros(1, dtype=np.int64)  # packed contexts of the level, sorted
    for k in range(order + 1):
        pick = np.flatnonzero(level == k)
        pick = pick[np.lexsort((who[pick], gram[pick]))]
        grams, node = np.unique(gram[pick], return_inverse=True)
        parent = np.searchsorted(before, gram[pick] >> 8) + (k > 0)
        pairs, at = np.unique(parent * width + who[pick], return_inverse=True)
        kinds, seen = np.bincount(at, minlength=len(pairs)), np.bincount(at, n[pick], len(pairs))
        model.next.append((np.searchsorted(before, grams >> 8) + (k > 0)) * 256 + (grams & 255))
        model.cost.append((np.searchsorted(node, np.arange(-1, len(grams) + 1)), who[pick].astype(np.int32),
                           -np.log2(n[pick] / (seen + kinds)[at])))
        model.escape.append((np.searchsorted(pairs // width, np.arange(len(before) + 2)), (pairs % width).astype(np.int32),
                             -np.log2(kinds / (seen + kinds))))
        before = grams
    return model


def _entries(starts: np.ndarray, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(place in ``nodes``, entry) of every entry of the nodes."""
    n = starts[nodes + 1] - starts[nodes]
    return np.repeat(np.arange(len(nodes)), n), np.arange(n.sum()) + np.repeat(starts[nodes] - np.cumsum(n) + n, n)


def sparse_bits(model: SparseModel, data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """``byte_bits`` of a sparse model: from the empty context on, a language that has seen a context leaves
    it or has the byte in it."""
    out = np.full((len(data), len(model.languages)), 8.0)
    context = np.zeros(len(data), dtype=np.int64)
    for k, keys in enumerate(model.next):
        there = np.flatnonzero((context > 0) | (k == 0))
        wanted = context[there] * 256 + data[there]
        at = np.searchsorted(keys, wanted)
        found = (at < len(keys)) & (keys[np.minimum(at, len(keys) - 1)] == wanted) if len(keys) else np.zeros(len(at), bool)
        starts, who, bits = model.escape[k]
        place, entry = _entries(starts, context[there])
        out[there[place], who[entry]] += bits[entry]
        starts, who, bits = model.cost[k]
        place, entry = _entries(starts, at[found] + 1)
        out[there[found][place], who[entry]] = bits[entry]
        node = np.zeros(len(data), dtype=np.int64)
        node[there[found]] = at[found] + 1
        context[1:] = node[:-1]
        context[0] = 0
        context[first] = 0
    return out


def _without_first(model: Model, grams: np.ndarray, k: int) -> np.ndarray:
    """Bits of the last byte of each string of k + 1 bytes in the context of its k - 1 bytes before it."""
    grams = grams & ((1 << (8 * k)) - 1)
    shift = [(grams >> (8 * i)) & 255 for i in range(k)]  # shift[0] is the last byte
    nodes = []
    for length in range(k):  # node of the string of length + 1 last bytes, found from its first byte on
        node = np.zeros(len(grams), dtype=np.int64)
        for j in range(length, -1, -1):
            level = length - j
            node = np.where((level == 0) | (node > 0), model.next[level][node, shift[j]], 0)
        nodes.append(node)
    contexts = []
    for length in range(k):  # node of the ``length`` bytes before the last one
        node = np.zeros(len(grams), dtype=np.int64)
        for j in range(length, 0, -1):
            level = length - j
            node = np.where((level == 0) | (node > 0), model.next[level][node, shift[j]], 0)
        contexts.append(node)
    return _bits(model, nodes, contexts)


def _bits(model: Model, nodes: list[np.ndarray], contexts: list[np.ndarray]) -> np.ndarray:
    """Code lengths, per language: nodes[k] ends with the byte after k bytes, contexts[k] ends before it."""
    out = np.full((len(nodes[0]), len(model.languages)), 8.0)
    for k, (node, context) in enumerate(zip(nodes, contexts)):
        known = node > 0
        if k == 0:
            out = np.where(known[:, None], model.cost[0][node], model.escape[0][0] + 8.0)
            continue
        lost = ~known & (context > 0)
        out[lost] += model.escape[k][context[lost]]
        out[known] = model.cost[k][node[known]]
    return out


def byte_bits(model: Model, data: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Bits of every byte per language; ``first`` marks where a text begins."""
    if isinstance(model, SparseModel):
        return sparse_bits(model, data, first)
    nodes = [model.next[0][0, data]]
    contexts = [np.zeros(len(data), dtype=np.int32)]
    for k in range(1, len(model.next)):
        context = np.zeros_like(nodes[-1])
        context[1:] = nodes[-1][:-1]
        context[first] = 0
        contexts.append(context)
        nodes.append(np.where(context > 0, model.next[k][context, data], 0))
    # Where the longest string is known it decides; else the escapes are added up.
    bits = model.cost[-1][nodes[-1]]
    rest = np.flatnonzero(nodes[-1] == 0)
    bits[rest] = _bits(model, [x[rest] for x in nodes], [x[rest] for x in contexts])
    return bits


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray, block: int = 1 << 18) -> np.ndarray:
    """Bits of every text (rows of ``offsets`` into ``data``) under every language, in blocks of bytes."""
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    if not model.languages:
        return out
    block = min(block, max((1 << 20) // len(model.languages), 1 << 10))
    starts = np.unique(offsets[:-1][np.diff(offsets) > 0])
    for lo in range(0, len(data), block):
        hi, back = min(lo + block, len(data)), max(lo - len(model.next) + 1, 0)
        first = np.zeros(hi - back, dtype=bool)
        first[starts[(starts >= back) & (starts < hi)] - back] = True
        bits = byte_bits(model, data[back:hi], first)[lo - back:]
        pieces = np.unique(np.concatenate(([lo], starts[(starts >= lo) & (starts < hi)])))
        rows = np.searchsorted(offsets, pieces, "right") - 1
        np.add.at(out, rows, np.add.reduceat(bits, pieces - lo, axis=0))
    return out


def classify(model: Model, texts: pa.Array) -> tuple[list, list]:
    """Per text the language of the shortest code and its posterior probability (0 to 1)."""
    names, scores = [], []
    for part in slices(texts, most=1 << 19):
        bits = code_lengths(model, part.data, part.offsets)
        for r in range(len(bits)):
            raw = part.data[part.offsets[r]:part.offsets[r + 1]].tobytes()
            if not model.languages or not LETTER.search(raw.decode("utf-8", "replace")):
                names.append(UNKNOWN)
                scores.append(0.0)
                continue
            best = int(np.argmin(bits[r]))  # ties: the first language in alphabetical order
            names.append(model.languages[best])
            scores.append(float(1 / np.exp2(np.minimum(0, bits[r][best] - bits[r])).sum()))
    return names, scores


def identify(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: (doc_id, lang_pred, score).

    ``und`` with score 0 for null texts, texts without a letter, and if nothing
    was learned. The whole text is coded; repeated rows are judged alike.
    """
    spark: SparkSession = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            names, scores = classify(shared.value, batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(names, pa.string()), pa.array(scores, pa.float64())],
                                  names=["doc_id", "lang_pred", "score"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, lang_pred string, score double")


def keep_identified(docs: DataFrame, model: Model, text_col: str = "text", min_score: float = 0.5) -> DataFrame:
    """``docs`` without the rows whose language cannot be told: ``und``, or a score under ``min_score``."""
    python_ready(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text_col)

    def run(batches):
        for batch in batches:
            names, scores = classify(shared.value, batch.column(at))
            keep = [n != UNKNOWN and s >= min_score for n, s in zip(names, scores)]
            yield batch.filter(pa.array(keep, pa.bool_()))
    return docs.mapInArrow(run, docs.schema)


def held_out(id_col):
    """Whether crc32 of the id as text leaves remainder 2 modulo 4 (false for a null id)."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % 4 == 2, F.lit(False))
