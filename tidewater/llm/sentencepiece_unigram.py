"""SentencePiece encoding and decoding: unigram Viterbi over a double-array trie.

The vocabulary is a SentencePiece model file (a parameter; it is read on the
driver and sent to the tasks, its size is that of a vocabulary). Nothing is trained.
Its pieces with their log scores go into a double-array trie over bytes. The best
segmentation of a text is the path of highest total score (Viterbi); on ties the
longer last piece wins, as the path from the earlier start was there first. A character that
no piece covers scores ``UNKNOWN_PENALTY`` below the worst piece and is written as its
UTF-8 bytes' pieces. Spaces are written as the marker U+2581, one is
put before the text, and no white space is normalised.

No piece spans a marker that follows another character, and none holds a line end,
so a text splits there into chunks that are segmented on their own. Tasks segment
every distinct chunk of a batch once, all of them side by side in NumPy arrays.

A long chunk (text without spaces) is cut first: all pieces that occur in it are
found at once, and where none of them spans a place every path stops there, so
what lies between two such places is segmented on its own. What stays long after that
(a run of one letter) is walked through once, match by match, in blocks.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .tables import python_ready

MODEL_FILE = "/opt/tokenizers/piece_bpe_32k.model"
MARKER = "▁"
UNKNOWN_PENALTY = 10.0
#: SentencePiece's piece types.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
CHUNK = re.compile("▁*[^▁\n]+|▁+|\n")
#: Distinct chunks that are segmented side by side, and that a task remembers.
SIDE_BY_SIDE, REMEMBERED = 1 << 15, 1 << 18
#: Bytes from which a chunk is cut, and from which a part of it is walked through on its own; bytes looked at at once.
LONG, WALKED, BLOCK = 128, 512, 1 << 18


def read_pieces(path: str) -> list[tuple[str, float, int]]:
    """(piece, score, type) of every id of a SentencePiece model file."""
    import sentencepiece as sp
    m = sp.SentencePieceProcessor(model_file=path)

    def kind(i):
        for test, k in ((m.is_unknown, UNKNOWN), (m.is_control, CONTROL), (m.is_byte, BYTE), (m.is_unused, UNUSED)):
            if test(i):
                return k
        return NORMAL
    return [(m.id_to_piece(i), m.get_score(i), kind(i)) for i in range(m.get_piece_size())]


class DoubleArray:
    """A trie over bytes in two arrays: node s goes by byte c to t = base[s] + c if check[t] = s.

    Node 0 is the root; ``value`` holds a key's number + 1 at its last node, else 0.
    """

    def __init__(self, keys: list[bytes]):
        order = sorted(range(len(keys)), key=lambda i: keys[i])
        self.base = np.zeros(1 << 16, dtype=np.int32)
        self.check = np.full(1 << 16, -1, dtype=np.int32)
        self.value = np.zeros(1 << 16, dtype=np.int32)
        self.check[0] = 0
        todo = [(0, 0, len(order), 0)]
        single, several = 1, 1  # where the search for room begins, for one and for several children
        while todo:
            node, lo, hi, depth = todo.pop()
            while lo < hi and len(keys[order[lo]]) == depth:
                self.value[node] = self.value[node] or order[lo] + 1
                lo += 1
            children, at = [], lo
            while at < hi:
                byte, stop = keys[order[at]][depth], at + 1
                while stop < hi and keys[order[stop]][depth] == byte:
                    stop += 1
                children.append((byte, at, stop))
                at = stop
            if not children:
                continue
            labels = np.array([c[0] for c in children])
            if len(labels) == 1:
                base = single = self._fit(labels, single)
            else:
                base = self._fit(labels, several)
                several = max(several, base - 256)
            self.base[node] = base
            self.check[base + labels] = node
            todo.extend((base + byte, a, b, depth + 1) for byte, a, b in children)
        self._room(int(self.base.max()) + 512)

    def _fit(self, labels: np.ndarray, base: int) -> int:
        """The first base from ``base`` on whose places for the labels are free."""
        while True:
            self._room(base + 2048)
            free = (self.check[base + np.arange(1024)[:, None] + labels] < 0).all(axis=1)
            at = int(free.argmax())
            if free[at]:
                return base + at
            base += 1024

    def _room(self, n: int) -> None:
        while n > len(self.check):
            more = len(self.check)
            self.base = np.concatenate((self.base, np.zeros(more, np.int32)))
            self.check = np.concatenate((self.check, np.full(more, -1, np.int32)))
            self.value = np.concatenate((self.value, np.zeros(more, np.int32)))

    def step(self, nodes: np.ndarray, data: np.ndarray) -> np.ndarray:
        """The node after each byte, -1 where there is none."""
        to = self.base[nodes] + data
        return np.where((self.check[to] == nodes) & (self.base[nodes] > 0), to, -1)


@dataclass
class Vocabulary:
    pieces: list[str]
    kinds: list[int]
    scores: np.ndarray
    trie: DoubleArray
    #: Id of each byte's piece, and of the unknown piece.
    bytes: np.ndarray
    unknown: int
    penalty: float
    #: Whether chunks may be segmented on their own.
    splits: bool
    #: Bytes of each piece, and of the longest in the trie.
    lengths: np.ndarray
    longest: int


def load_vocabulary(path: str = MODEL_FILE) -> Vocabulary:
    listed = read_pieces(path)
    pieces, scores, kinds = (list(x) for x in zip(*listed))
    own = [i for i, k in enumerate(kinds) if k in (NORMAL, USER_DEFINED)]  # unused pieces are never written
    trie = DoubleArray([pieces[i].encode() for i in own])
    trie.value = np.where(trie.value > 0, np.array([-1, *own])[trie.value] + 1, 0)
    by_byte = np.full(256, -1)
    for i, k in enumerate(kinds):
        if k == BYTE:
            by_byte[int(pieces[i][1:-1], 16)] = i
    scores = np.array(scores, dtype=np.float64)
    splits = all(MARKER not in pieces[i].lstrip(MARKER) and "\n" not in pieces[i] for i in own)
    return Vocabulary(pieces, kinds, scores, trie, by_byte, kinds.index(UNKNOWN) if UNKNOWN in kinds else 0,
                      scores[own].min() - UNKNOWN_PENALTY, splits, np.array([len(p.encode()) for p in pieces]),
                      max(len(pieces[i].encode()) for i in own))


#: Bytes of the character that a byte begins.
WIDTH = np.ones(256, dtype=np.int64)
WIDTH[0xC0:0xE0], WIDTH[0xE0:0xF0], WIDTH[0xF0:] = 2, 3, 4


def matches(vocabulary: Vocabulary, data: np.ndarray, lo: int, hi: int) -> tuple[np.ndarray, ...]:
    """(start, end, id) of every piece that begins at lo to hi - 1, by start; id -1: a character that is no piece.

    ``data`` ends with a zero byte that belongs to no chunk.
    """
    first = np.flatnonzero((data[lo:hi] & 0xC0) != 0x80) + lo
    start, node, at = first, np.zeros(len(first), dtype=np.int64), first
    values, found = vocabulary.trie.value, []
    while len(start):
        node = vocabulary.trie.step(node, data[at])
        on = np.flatnonzero(node >= 0)
        start, node, at = start[on], node[on], at[on] + 1
        ends = np.flatnonzero(values[node] > 0)
        found.append((start[ends], at[ends], values[node[ends]] - 1))
    starts, ends, ids = (np.concatenate(x) for x in zip(*found)) if found else (first[:0],) * 3
    alone = np.setdiff1d(first, starts[ends - starts == WIDTH[data[starts]]], assume_unique=True)
    starts, ends = np.concatenate((starts, alone)), np.concatenate((ends, alone + WIDTH[data[alone]]))
    ids = np.concatenate((ids, np.full(len(alone), -1)))
    order = np.argsort(starts, kind="stable")
    return starts[order], ends[order], ids[order]


def cuts(vocabulary: Vocabulary, data: np.ndarray) -> np.ndarray:
    """The places of a chunk (0 and its end among them) that no piece and no character spans."""
    n = len(data) - 1
    spanned = np.zeros(n + 1, dtype=bool)
    for lo in range(0, n, BLOCK):
        hi = min(lo + BLOCK, n)
        start, end, _ = matches(vocabulary, data, lo, hi)
        size = hi - lo + vocabulary.longest + 4
        over = np.cumsum(np.bincount(start - lo + 1, minlength=size) - np.bincount(end - lo, minlength=size))
        stop = min(n + 1, lo + size)
        spanned[lo:stop] |= over[:stop - lo] > 0
    return np.flatnonzero(~spanned)


def walk(vocabulary: Vocabulary, data: np.ndarray) -> np.ndarray:
    """The ids of the best segmentation of one chunk, match by match from left to right.

    What is kept of the whole chunk is the best last piece at every byte, in 32 bits.
    """
    n, reach = len(data) - 1, vocabulary.longest + 4
    last = np.full(n + 1, -1, dtype=np.int32)
    scores = np.append(vocabulary.scores, vocabulary.penalty)  # -1 is the unknown character
    best, piece = [0.0], [-1]
    for lo in range(0, n, BLOCK):
        hi = min(lo + BLOCK, n)
        best += [-np.inf] * (hi - lo + reach - len(best))
        piece += [-1] * (hi - lo + reach - len(piece))
        start, end, ids = matches(vocabulary, data, lo, hi)
        for s, e, p, score in zip((start - lo).tolist(), (end - lo).tolist(), ids.tolist(), scores[ids].tolist()):
            total = best[s] + score
            if total > best[e]:
                best[e], piece[e] = total, p
        last[lo:hi] = piece[:hi - lo]
        best, piece = best[hi - lo:], piece[hi - lo:]
    last[n] = piece[0]
    lengths, at, found = vocabulary.lengths, n, []
    while at > 0:
        p = int(last[at])
        before = at - (int(lengths[p]) if p >= 0 else 1)
        while p < 0 and data[before] & 0xC0 == 0x80:
            before -= 1
        found.append((p,) if p >= 0 else _fallback(vocabulary, data[before:at]))
        at = before
    return np.array([i for ids in reversed(found) for i in ids], dtype=np.int32)


def segment_long(vocabulary: Vocabulary, chunk: bytes) -> np.ndarray:
    """The ids of the best segmentation of one long chunk, part by part."""
    data = np.frombuffer(chunk + b"\0", dtype=np.uint8)
    at, found = cuts(vocabulary, data), []
    for i in range(0, len(at) - 1, SIDE_BY_SIDE):
        edges = at[i:i + SIDE_BY_SIDE + 1].tolist()
        parts = [chunk[a:b] for a, b in zip(edges[:-1], edges[1:])]
        known = {p: walk(vocabulary, np.frombuffer(p + b"\0", dtype=np.uint8)) for p in set(parts) if len(p) >= WALKED}
        short = list({p for p in parts if len(p) < WALKED})
        known.update(zip(short, viterbi(vocabulary, short)))
        found += [known[p] for p in parts]
    return np.concatenate(found).astype(np.int32)


def viterbi(vocabulary: Vocabulary, chunks: list[bytes]) -> list[np.ndarray]:
    """The ids of the best segmentation of each chunk, all chunks side by side."""
    order = np.argsort([len(c) for c in chunks], kind="stable")[::-1]
    sizes = np.array([len(chunks[i]) for i in order], dtype=np.int64)
    offsets = np.concatenate(([0], np.cumsum(sizes + 1)))
    data = np.frombuffer(b"\0".join(chunks[i] for i in order) + b"\0", dtype=np.uint8)
    best = np.full(offsets[-1], -np.inf)
    best[offsets[:-1]] = 0.0
    came = np.full(offsets[-1], -1, dtype=np.int32)   # start of the best piece that ends here
    piece = np.full(offsets[-1], -1, dtype=np.int32)  # its id, -1 for an unknown character
    char = (data & 0xC0) != 0x80
    width = WIDTH
    trie, scores, values = vocabulary.trie, vocabulary.scores, vocabulary.trie.value
    for s in range(int(sizes.max(initial=0))):
        live = int(np.searchsorted(-sizes, -s))  # chunks are sorted from long to short: those longer than s
        at = offsets[:live] + s
        at = at[char[at]]
        here = best[at]
        single = np.zeros(len(at), dtype=bool)
        # Pieces from s on, byte by byte.
        who, node, pos = np.arange(len(at)), np.zeros(len(at), dtype=np.int64), at.copy()
        while len(who):
            node = trie.step(node, data[pos])
            on = np.flatnonzero(node >= 0)
            who, node, pos = who[on], node[on], pos[on] + 1
            ends = np.flatnonzero(values[node] > 0)
            if len(ends):
                w, p, to = who[ends], values[node[ends]] - 1, pos[ends]
                score = here[w] + scores[p]
                better = score > best[to]
                w, p, to = w[better], p[better], to[better]
                best[to], came[to], piece[to] = score[better], at[w], p
                single[who[ends][pos[ends] == at[who[ends]] + width[data[at[who[ends]]]]]] = True
        # Where no piece is exactly the character at s, it may stand as unknown.
        left = np.flatnonzero(~single)
        to = at[left] + width[data[at[left]]]
        score = here[left] + vocabulary.penalty
        better = score > best[to]
        left, to = left[better], to[better]
        best[to], came[to], piece[to] = score[better], at[left], -1
    # Back from the ends, all chunks at once.
    rows, at = np.arange(len(sizes)), offsets[1:] - 1
    found: list[tuple[np.ndarray, ...]] = []
    while True:
        on = at > offsets[:-1][rows]
        rows, at = rows[on], at[on]
        if not len(rows):
            break
        found.append((rows, at, piece[at]))
        at = came[at].astype(np.int64)
    if not found:
        return [np.zeros(0, dtype=np.int32) for _ in chunks]
    rows, ends, ids = (np.concatenate(x) for x in zip(*found))
    put = np.lexsort((ends, rows))
    rows, ends, ids = rows[put], ends[put], ids[put]
    bounds = np.searchsorted(rows, np.arange(len(sizes) + 1))
    out: list = [None] * len(chunks)
    for r, i in enumerate(order):
        mine = ids[bounds[r]:bounds[r + 1]]
        if (mine < 0).any():
            stops = ends[bounds[r]:bounds[r + 1]]
            starts = np.concatenate(([offsets[r]], stops[:-1]))
            mine = np.concatenate([[p] if p >= 0 else _fallback(vocabulary, data[a:b])
                                   for p, a, b in zip(mine, starts, stops)]).astype(np.int32)
        out[i] = mine
    return out


def _fallback(vocabulary: Vocabulary, raw: np.ndarray) -> np.ndarray:
    ids = vocabulary.bytes[raw]
    return ids if (ids >= 0).all() else np.array([vocabulary.unknown])


class Encoder:
    """Encodes texts; remembers the segmentations of the chunks it met last."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.known: dict[str, bytes] = {}

    def chunks(self, text: str) -> list[str]:
        if not text:
            return []
        marked = MARKER + text.replace(" ", MARKER)
        return CHUNK.findall(marked) if self.vocabulary.splits else [marked]

    def learn(self, chunks) -> None:
        new, long = [], []
        for c in chunks:
            if c not in self.known:
                (long if len(c) >= LONG else new).append(c)
        for c in long:
            self.known[c] = segment_long(self.vocabulary, c.encode()).astype("<i4").tobytes()
        for at in range(0, len(new), SIDE_BY_SIDE):
            some = new[at:at + SIDE_BY_SIDE]
            for c, ids in zip(some, viterbi(self.vocabulary, [c.encode() for c in some])):
                self.known[c] = ids.astype("<i4").tobytes()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Per text its ids as little-endian 32-bit integers; null or empty: none."""
        if len(self.known) > REMEMBERED:
            self.known.clear()
        split = [self.chunks(t) if t else [] for t in texts]
        self.learn({c for s in split for c in s})
        known = self.known
        out = [b"".join([known[c] for c in s]) for s in split]
        for c in [c for s in split for c in s if len(c) >= LONG]:
            known.pop(c, None)  # too long to be held for later
        return out


class Decoder:
    def __init__(self, vocabulary: Vocabulary):
        hidden = (CONTROL,)
        self.bytes = [b"" if k in hidden else bytes([int(p[1:-1], 16)]) if k == BYTE
                      else (" ⁇ " if k == UNKNOWN else p.replace(MARKER, " ")).encode()
                      for p, k in zip(vocabulary.pieces, vocabulary.kinds)]

    def decode(self, ids: np.ndarray) -> str:
        """The text of ids: markers are spaces, the first one goes, byte pieces join to UTF-8."""
        table = self.bytes
        raw = b"".join([table[i] for i in ids.tolist()])
        return (raw[1:] if raw.startswith(b" ") else raw).decode("utf-8", "replace")


def groups(batch_rows: int, sizes: np.ndarray, most: int = 1 << 20):
    """Ranges of rows of about ``most`` bytes."""
    lo, held = 0, 0
    for r in range(batch_rows):
        if r > lo and held + sizes[r] > most:
            yield lo, r
            lo, held = r, 0
        held += int(sizes[r])
    if lo < batch_rows:
        yield lo, batch_rows


def _sizes(texts: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.binary_length(texts), 0))


def encode_table(docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """Per row: (doc_id, ids, n_tokens, n_bytes, decoded, round_trip); ``ids`` are little-endian 32-bit integers.

    n_bytes counts byte-fallback pieces; ``decoded`` is the decoded text. Null
    and empty texts have no pieces and decode to the empty text. Every row is
    encoded by itself, whatever its id.
    """
    spark: SparkSession = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(vocabulary)

    def run(batches):
        encoder, decoder = Encoder(shared.value), Decoder(shared.value)
        is_byte = np.array(shared.value.kinds) == BYTE
        for batch in batches:
            texts = batch.column(1)
            for lo, hi in groups(batch.num_rows, _sizes(texts)):
                some = texts.slice(lo, hi - lo).to_pylist()
                coded = encoder.encode(some)
                arrays = [np.frombuffer(c, dtype="<i4") for c in coded]
                decoded = [decoder.decode(a) for a in arrays]
                yield pa.record_batch([
                    batch.column(0).slice(lo, hi - lo), pa.array(coded, pa.binary()),
                    pa.array([len(a) for a in arrays], pa.int64()),
                    pa.array([int(is_byte[a].sum()) for a in arrays], pa.int64()),
                    pa.array(decoded, pa.string()),
                    pa.array([(a or "") == b for a, b in zip(some, decoded)], pa.bool_())],
                    names=["doc_id", "ids", "n_tokens", "n_bytes", "decoded", "round_trip"])
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(
        run, "doc_id long, ids binary, n_tokens long, n_bytes long, decoded string, round_trip boolean")


def round_trip(docs: DataFrame, vocabulary: Vocabulary, text_col: str = "text") -> DataFrame:
    """``docs`` with each text encoded and decoded again and three more columns.

    token_ids (array<int>), n_tokens (long) and round_trip (whether the decoded text is the
    text). The text itself stays as it is, also where it decodes to another one, as the marker U+2581 does (to
    a space). A null text has no tokens. Columns of ``docs`` with one of the three names are replaced.
    """
    spark: SparkSession = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(vocabulary)
    source = docs.drop("token_ids", "n_tokens", "round_trip")
    at, names = source.columns.index(text_col), [*source.columns, "token_ids", "n_tokens", "round_trip"]
    schema = T.StructType([*source.schema.fields, T.StructField("token_ids", T.ArrayType(T.IntegerType())),
                           T.StructField("n_tokens", T.LongType()), T.StructField("round_trip", T.BooleanType())])

    def run(batches):
        encoder, decoder = Encoder(shared.value), Decoder(shared.value)
        for batch in batches:
            texts = batch.column(at)
            for lo, hi in groups(batch.num_rows, _sizes(texts)):
                some = texts.slice(lo, hi - lo).to_pylist()
                arrays = [np.frombuffer(c, dtype="<i4") for c in encoder.encode(some)]
                decoded = [None if t is None else decoder.decode(a) for t, a in zip(some, arrays)]
                edges = np.concatenate(([0], np.cumsum([len(a) for a in arrays]))).astype(np.int32)
                columns = [c.slice(lo, hi - lo) for c in batch.columns]
                yield pa.record_batch([
                    *columns, pa.ListArray.from_arrays(pa.array(edges), pa.array(np.concatenate(arrays))),
                    pa.array(np.diff(edges).astype(np.int64)),
                    pa.array([a == b for a, b in zip(some, decoded)], pa.bool_())],
                    names=names)
    return source.mapInArrow(run, schema)
