"""Alignment of two tokenisers' tokens by merge-path partitioning.

Both tokenisers cut the same bytes, so their token ends are two sorted lists. Where both have an
end, a group ends; tokens of one group are linked. The lists are merged by merge path: diagonals of the merge
grid cut the work into pieces of equally many ends, a binary search along each diagonal finds
where it crosses the path, and every piece is merged by itself. A piece emits the common ends it
finds, that is the overlaps it can close; the group that is open at a piece's edge is stitched to the next
piece's first common end. A slice of documents is one pair of lists, as all documents end in both.

A pair's count over the corpus needs all documents. Slices send each pair of theirs once, with the number
of documents holding it; the sums go back to the slices that hold the pair and are looked up there. So a
pair that every document holds costs one row a slice, not one a document.

Tokenisers are not trained here. Their files are read on the driver and sent to the tasks as they are.
"""

from __future__ import annotations

import hashlib
import itertools
import json
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import python_ready, stored

A_FILE, B_FILE = "/opt/tokenizers/byte_bpe_50k.json", "/opt/tokenizers/piece_bpe_32k.model"
SLICE_BYTES = 2 << 20
SLICE_ROWS = 1 << 16
#: Ends in one piece of a merge.
PIECE_ENDS = 1 << 15
#: Links that are unfolded at a time.
LINKS_AT_ONCE = 1 << 18

MARKER = "▁"
#: A space after a letter, a digit or a printable ASCII sign, but for the last character: no token of either kind spans it.
WORD_EDGE = re.compile(r"(?<=[\w!-~]) (?=.)", re.DOTALL)

# The pattern by which byte-level BPE cuts a text before merging.
BYTE_LEVEL_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
# Bytes that stand for themselves in byte-level vocabularies; the others are written as U+0100 and up, in order.
VISIBLE_BYTES = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]


@dataclass(frozen=True)
class TokenizerFiles:
    a: bytes
    b: bytes


def read_tokenizers(a_path: str = A_FILE, b_path: str = B_FILE) -> TokenizerFiles:
    with open(a_path, "rb") as a, open(b_path, "rb") as b:
        return TokenizerFiles(a.read(), b.read())


def byte_level_tokens(vocabulary: dict[str, int]) -> dict[bytes, int]:
    """The tokens of a byte-level vocabulary as the bytes they stand for."""
    hidden = [b for b in range(256) if b not in set(VISIBLE_BYTES)]
    byte = {chr(b): b for b in VISIBLE_BYTES} | {chr(256 + i): b for i, b in enumerate(hidden)}
    return {bytes(byte[c] for c in token): i for token, i in vocabulary.items()}


class SideA:
    """Byte-level BPE of a tokenizer.json file, run by the merge ranks in it."""

    def __init__(self, raw: bytes):
        whole = json.loads(raw)
        model, added = whole["model"], {x["content"] for x in whole.get("added_tokens", [])}
        ranks = byte_level_tokens({t: i for t, i in model["vocab"].items() if t not in added})
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        if any(model["vocab"]["".join(m)] != 256 + i for i, m in enumerate(merges)):
            raise ValueError("this byte-level vocabulary does not number its tokens in the order of its merges")
        import tiktoken
        self.encoding = tiktoken.Encoding("a", pat_str=BYTE_LEVEL_PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.bytes = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.bytes[i] = token

    def encode(self, words: list[str]) -> list[list[int]]:
        one = self.encoding.encode_ordinary
        return [one(" " + w) for w in words]


class SideB:
    """A SentencePiece model; it puts the space before a text itself."""

    def __init__(self, raw: bytes):
        import sentencepiece as sp
        self.model = sp.SentencePieceProcessor(model_proto=raw)
        m, n = self.model, self.model.get_piece_size()
        pieces = [m.id_to_piece(i) for i in range(n)]
        self.bytes = [bytes([int(p[3:-1], 16)]) if m.is_byte(i) else b"" if m.is_control(i) else
                      p.replace(MARKER, " ").encode() for i, p in enumerate(pieces)]
        #: Whether a text may be encoded word by word: no piece holds a space after another character.
        self.splits = all(MARKER not in p.lstrip(MARKER) for p in pieces)

    def encode(self, words: list[str]) -> list[list[int]]:
        return self.model.encode(words, num_threads=1)


class Coder:
    """Both tokenisers. Words are encoded once a slice."""

    def __init__(self, files: TokenizerFiles):
        self.a, self.b = SideA(files.a), SideB(files.b)
        self.sizes = [np.array([len(x) for x in s.bytes], dtype=np.int64) for s in (self.a, self.b)]
        self.group_text = GroupText((len(self.a.bytes), len(self.b.bytes)))

    def words(self, text: str) -> list[str]:
        return WORD_EDGE.split(text) if self.b.splits else [text]

    def encode(self, texts: list[str | None]):
        """Token ids of both sides, end to end, and how many each text has: (a, n_a, b, n_b).

        A null or empty text has none, nor has one whose tokens do not join to a space and the text.
        """
        split = [self.words(t) if t else [] for t in texts]
        number: dict[str, int] = {}
        for words in split:
            for w in words:
                number.setdefault(w, len(number))
        distinct = list(number)
        coded_a, coded_b = self.a.encode(distinct), self.b.encode(distinct)
        table_a, table_b = self.a.bytes, self.b.bytes
        good = np.array([b"".join([table_a[i] for i in x]) == b"".join([table_b[i] for i in y]) == (" " + w).encode()
                         for x, y, w in zip(coded_a, coded_b, distinct)], dtype=bool)
        flat = np.array([number[w] for words in split for w in words], dtype=np.int64)
        in_text = np.array([len(words) for words in split], dtype=np.int64)
        text_of = np.repeat(np.arange(len(split)), in_text)
        whole = np.bincount(text_of, ~good[flat] if len(distinct) else None, len(split)) == 0
        for r in np.flatnonzero(~whole):  # words may differ in a way that cancels out in the whole text
            joined = [b"".join([t[i] for w in split[r] for i in c[number[w]]]) for t, c in ((table_a, coded_a), (table_b, coded_b))]
            whole[r] = joined[0] == joined[1] == (" " + texts[r]).encode()
        keep = whole[text_of]
        out = []
        for coded in (coded_a, coded_b):
            lengths = np.array([len(c) for c in coded], dtype=np.int64)
            ids = np.fromiter(itertools.chain.from_iterable(coded), dtype=np.int32, count=int(lengths.sum()))
            out += [gather(ids, lengths, flat[keep]),
                    np.bincount(text_of[keep], lengths[flat[keep]], len(split)).astype(np.int64)]
        return out


def gather(values: np.ndarray, lengths: np.ndarray, which: np.ndarray) -> np.ndarray:
    """The runs ``which`` of ``values``, whose runs have these lengths, end to end."""
    starts = np.concatenate(([0], np.cumsum(lengths)))[:-1] if len(lengths) else np.zeros(0, dtype=np.int64)
    some = lengths[which]
    ends = np.cumsum(some)
    return values[np.repeat(starts[which] - (ends - some), some) + np.arange(int(some.sum()))]


# ---- merge path --------------------------------------------------------------------

def path_crossings(a: np.ndarray, b: np.ndarray, diagonals: np.ndarray) -> np.ndarray:
    """How many of the first d ends of the merge of sorted ``a`` and ``b`` come from ``a``, for each diagonal d.

    Equal ends: the one of ``a`` comes first. All binary searches run side by side.
    """
    low, high = np.maximum(0, diagonals - len(b)), np.minimum(diagonals, len(a))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        # a[mid] is among the first d if it does not come after b[d - 1 - mid]
        before = a[np.minimum(mid, len(a) - 1)] <= b[np.clip(diagonals - 1 - mid, 0, max(len(b) - 1, 0))]
        low, high = np.where(open_ & before, mid + 1, low), np.where(open_ & ~before, mid, high)
    return low


def merge_pieces(a: np.ndarray, b: np.ndarray, ends: int = PIECE_ENDS):
    """(a from, a to, b from, b to) of pieces with ``ends`` ends each; equal ends are never torn apart."""
    if not len(a) or not len(b):
        return []
    diagonals = np.append(np.arange(0, len(a) + len(b), ends), len(a) + len(b))
    i = path_crossings(a, b, diagonals)
    j = diagonals - i
    inner = (i > 0) & (j < len(b))
    torn = np.zeros(len(i), dtype=bool)
    torn[inner] = a[i[inner] - 1] == b[j[inner]]
    j = j + torn
    return list(zip(i[:-1].tolist(), i[1:].tolist(), j[:-1].tolist(), j[1:].tolist()))


def common_ends(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in one piece's ``a`` and ``b`` that hold the same end."""
    both = np.concatenate((a, b))
    order = np.argsort(both, kind="stable")  # a merge of two sorted runs; a's end comes first among equals
    same = np.flatnonzero(both[order][:-1] == both[order][1:])
    return order[same], order[same + 1] - len(a)


def group_sizes(a: np.ndarray, b: np.ndarray, ends: int = PIECE_ENDS) -> tuple[np.ndarray, np.ndarray]:
    """How many tokens of each side every group has, the groups of all pieces stitched together."""
    cuts_a, cuts_b = [np.array([-1])], [np.array([-1])]
    for a0, a1, b0, b1 in merge_pieces(a, b, ends):
        in_a, in_b = common_ends(a[a0:a1], b[b0:b1])
        cuts_a.append(in_a + a0)
        cuts_b.append(in_b + b0)
    # a group that is open at a piece's edge ends at the next cut, whichever piece found it
    return np.diff(np.concatenate(cuts_a)), np.diff(np.concatenate(cuts_b))


def align(coder: Coder, texts: list[str | None]) -> dict[str, np.ndarray]:
    """Tokens and groups of some texts, end to end: a, b (ids), ga, gb (tokens of each group), n_a, n_b, n_groups (of each text)."""
    a, n_a, b, n_b = coder.encode(texts)
    ends_a, ends_b = np.cumsum(coder.sizes[0][a]), np.cumsum(coder.sizes[1][b])
    ga, gb = group_sizes(ends_a, ends_b)
    last = np.cumsum(ga) - 1
    text_of = np.repeat(np.arange(len(texts)), n_a)
    n_groups = np.bincount(text_of[last], minlength=len(texts)) if len(last) else np.zeros(len(texts), dtype=np.int64)
    return {"a": a, "b": b, "ga": ga, "gb": gb, "n_a": n_a, "n_b": n_b, "n_groups": n_groups}


# ---- links --------------------------------------------------------------------------

def _distinct(group: np.ndarray, ids: np.ndarray, n_groups: int):
    """Distinct (group, id) by group, how often each stands there, and where each group's begin."""
    key, times = np.unique(group << np.int64(32) | ids, return_counts=True)
    group = key >> np.int64(32)
    return key & 0xFFFFFFFF, times, np.searchsorted(group, np.arange(n_groups + 1))


def document_pairs(held: dict[str, np.ndarray]):
    """(text, a * 2**32 + b, links): every distinct pair linked in each text, and by how many links, sorted by text and pair.

    Equal tokens of a group are counted before they are crossed, and groups are crossed in runs of
    bounded size, one with very many tokens in several.
    """
    groups = np.arange(len(held["ga"]))
    text_of = np.repeat(np.arange(len(held["n_groups"])), held["n_groups"])
    ia, ta, sa = _distinct(np.repeat(groups, held["ga"]), held["a"].astype(np.int64), len(groups))
    ib, tb, sb = _distinct(np.repeat(groups, held["gb"]), held["b"].astype(np.int64), len(groups))
    of_a = np.repeat(groups, np.diff(sa))
    partners = np.diff(sb)[of_a]  # every distinct a of a group meets each distinct b of it
    done = np.concatenate(([0], np.cumsum(partners)))
    parts: list[tuple[np.ndarray, ...]] = []
    lo = 0
    while lo < len(ia):
        hi = max(lo + 1, int(np.searchsorted(done, done[lo] + LINKS_AT_ONCE, "right")) - 1)
        n = partners[lo:hi]
        left = np.repeat(np.arange(lo, hi), n)
        right = np.arange(int(n.sum())) - np.repeat(done[lo:hi] - done[lo], n) + sb[of_a[left]]
        parts.append(_added(text_of[of_a[left]], ia[left] << np.int64(32) | ib[right], ta[left] * tb[right]))
        lo = hi
    if not parts:
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3))
    return parts[0] if len(parts) == 1 else _added(*(np.concatenate(x) for x in zip(*parts)))


def _added(text: np.ndarray, pair: np.ndarray, links: np.ndarray):
    """Equal (text, pair) added up, in order."""
    order = np.lexsort((pair, text))
    text, pair, links = text[order], pair[order], links[order]
    first = np.flatnonzero(np.concatenate(([True], (text[1:] != text[:-1]) | (pair[1:] != pair[:-1]))))
    return text[first], pair[first], np.add.reduceat(links, first)


class GroupText:
    """Groups written as ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, sizes: tuple[int, int]):
        self.places = np.array([f"{i}{end}" for n in sizes for end in ",|;" for i in range(n)], dtype=object)
        self.sizes = sizes

    def write(self, held: dict[str, np.ndarray]) -> list[str]:
        n_a, n_b = self.sizes
        ga, gb = held["ga"], held["gb"]
        ends_a, ends_b = np.cumsum(ga) - 1, np.cumsum(gb) - 1
        a, b = held["a"].astype(np.int64), held["b"] + np.int64(3 * n_a)
        a[ends_a] += n_a          # "|" after a group's last a
        b[ends_b] += 2 * n_b      # ";" after its last b
        place = np.empty(len(a) + len(b), dtype=np.int64)
        place[np.arange(len(a)) + np.repeat(np.cumsum(gb) - gb, ga)] = a
        place[np.arange(len(b)) + np.repeat(np.cumsum(ga), gb)] = b
        words, out, at = self.places[place], [], 0
        for n in (held["n_a"] + held["n_b"]).tolist():
            out.append("".join(words[at:at + n].tolist())[:-1] if n else "")
            at += n
        return out


def _lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType = pa.int32()) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum(lengths))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def _by_slices(docs: DataFrame, files: TokenizerFiles, id_col: str, text_col: str, ddl: str, give) -> DataFrame:
    """``give(slice number, ids, what :func:`align` gives, vocabulary sizes)`` for every slice of the texts."""
    spark: SparkSession = docs.sparkSession
    python_ready(spark)
    shared = spark.sparkContext.broadcast(files)

    def run(batches):
        from pyspark import TaskContext
        coder, number = None, TaskContext.get().partitionId() << 32
        ids: list = []
        texts: list = []
        size = 0
        for batch in batches:
            coder = coder or Coder(shared.value)
            column = batch.column(1)
            for row, doc_id in enumerate(batch.column(0).to_pylist()):
                text = column[row].as_py()
                ids.append(doc_id)
                texts.append(text)
                size += len(text or "")
                if size >= SLICE_BYTES or len(ids) >= SLICE_ROWS:
                    yield give(number, ids, align(coder, texts), coder)
                    number, ids, texts, size = number + 1, [], [], 0
        if ids:
            yield give(number, ids, align(coder, texts), coder)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, ddl)


def align_table(docs: DataFrame, files: TokenizerFiles | None = None, id_col: str = "doc_id",
                text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, a and b (token ids), ga and gb (tokens of each side in each group, in order) and
    ``groups`` (the same as text, see :class:`GroupText`).

    Texts that are null, empty or do not survive a tokeniser have empty lists. Repeated rows and null ids are
    rows of their own; other columns are not read.
    """
    def give(number, ids, held, coder):
        lists = [_lists(held[k], held[n]) for k, n in (("a", "n_a"), ("b", "n_b"), ("ga", "n_groups"), ("gb", "n_groups"))]
        return pa.record_batch([pa.array(ids, pa.int64()), *lists, pa.array(coder.group_text.write(held), pa.string())],
                               names=["doc_id", "a", "b", "ga", "gb", "groups"])
    return _by_slices(docs, files or read_tokenizers(), id_col, text_col,
                      "doc_id long, a array<int>, b array<int>, ga array<int>, gb array<int>, groups string", give)


LINKED_DDL = ("slice long, doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, "
              "pair array<int>, times array<long>, slice_a array<int>, slice_b array<int>, slice_n array<long>")


def _linked(number: int, ids: list, held: dict[str, np.ndarray], coder: Coder) -> pa.RecordBatch:
    """A row per document, its pairs by their numbers in the slice, and one row with the slice's pairs and the documents holding each."""
    rows = len(ids)
    text, pair, links = document_pairs(held)
    distinct, which = np.unique(pair, return_inverse=True)
    of_row = np.bincount(text, minlength=rows)
    n_links = np.zeros(rows, dtype=np.int64)
    np.add.at(n_links, text, links)
    digests = [hashlib.sha256(t.encode()).hexdigest() if t else "" for t in coder.group_text.write(held)]

    def then_null(values: pa.Array) -> pa.Array:
        return pa.concat_arrays([values, pa.nulls(1, values.type)])

    def null_then(values: np.ndarray, kind: pa.DataType) -> pa.Array:
        return pa.concat_arrays([pa.nulls(rows, pa.list_(kind)), _lists(values, np.array([len(values)]), kind)])
    return pa.record_batch([
        pa.array(np.full(rows + 1, number)), then_null(pa.array(ids, pa.int64())),
        *(then_null(pa.array(held[k].astype(np.int64))) for k in ("n_a", "n_b", "n_groups")), then_null(pa.array(n_links)),
        then_null(pa.array(digests, pa.string())), then_null(_lists(which, of_row)), then_null(_lists(links, of_row, pa.int64())),
        null_then(distinct >> np.int64(32), pa.int32()), null_then(distinct & 0xFFFFFFFF, pa.int32()),
        null_then(np.bincount(which, minlength=len(distinct)), pa.int64())],
        names=[f.split()[0] for f in LINKED_DDL.split(", ")])


def pair_counts(pairs: DataFrame) -> DataFrame:
    """(a, b, count, best): in how many documents a pair is linked, and whether no other pair of its a is in more.

    An a has as many partners as the other vocabulary has tokens, at most.
    """
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    return counts.withColumn("best", F.col("count") == F.max("count").over(Window.partitionBy("a")))


def alignment_report(docs: DataFrame, files: TokenizerFiles | None = None, id_col: str = "doc_id",
                     text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 (of the groups' text, see
    :class:`GroupText`).

    Rows whose texts have no tokens hold zeros and an empty digest. Null ids, repeated rows and other columns: as
    in :func:`align_table`.
    """
    held = stored(_by_slices(docs, files or read_tokenizers(), id_col, text_col, LINKED_DDL, _linked), "aligned")
    of_docs = held.where(F.col("slice_n").isNull())
    numbered = F.posexplode(F.arrays_zip("slice_a", "slice_b", "slice_n")).alias("number", "x")
    pairs = held.where(F.col("slice_n").isNotNull()).select(F.col("slice").alias("slice"), numbered).select(
        "slice", "number", F.col("x.slice_a").alias("a"), F.col("x.slice_b").alias("b"), F.col("x.slice_n").alias("n"))
    known = pairs.select("slice", "number", "a", "b").join(pair_counts(pairs), ["a", "b"]).select("slice", "number", "count", "best")

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        count, best = (np.zeros(right.num_rows, dtype=np.int64) for _ in range(2))
        number = np.asarray(right.column("number"))
        count[number], best[number] = np.asarray(right.column("count")), np.asarray(right.column("best"))
        sums: list[list[int]] = [[], []]
        for batch in left.to_batches():
            pair, times = (np.asarray(batch.column(c).flatten()) for c in ("pair", "times"))
            row = np.repeat(np.arange(batch.num_rows), np.asarray(batch.column("pair").value_lengths()))
            for out, worth in zip(sums, (best, count)):
                added = np.zeros(batch.num_rows, dtype=np.int64)
                np.add.at(added, row, times * worth[pair])
                out += added.tolist()
        columns = {c: left.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")}
        return pa.table({**columns, "n_best": pa.array(sums[0], pa.int64()), "count_sum": pa.array(sums[1], pa.int64()),
                         "groups_sha256": left.column("groups_sha256")})
    return (of_docs.groupBy("slice").cogroup(known.groupBy("slice"))
                   .applyInArrow(run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, "
                                      "count_sum long, groups_sha256 string"))
