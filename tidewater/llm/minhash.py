"""MinHash near-dedup: universal hash minima, banding, verification, components.

1. One pass over the texts gives every document its shingle set's size, a
   128-bit digest of the set, and band keys over many universal hash minima.
   Documents with equal sets are one class from here on, represented by the
   smallest doc_id (a pre-aggregated minimum; no copies are paired).
2. Within each band bucket the classes are compared with the smallest one
   (star pairs), never all with all. A pair is first judged by its signatures,
   then confirmed on the full sets.
3. Components by alternating large-star and small-star. Where a bucket still
   holds several components, the pairs between its components may hold links.
   A bitmap of each set bounds a pair's intersection from above; only pairs
   that the bound leaves open come out of the join and are verified, so no link
   that banding proposes between components is lost.

With b bands of r minima two sets of similarity s share a bucket with
probability 1 - (1 - s^r)^b: 1 - 1.3e-7 at s = 0.8 for b = 40, r = 5.
"""

from __future__ import annotations

import math
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import components
from .tables import free_names, python_ready, stored
from .wordhash import WordHash, _odd, mix, sequences, slices

BANDS, ROWS = 40, 5
#: Standard deviations that the share of equal minima may lie below the threshold.
SLACK = 6.0
SET_BLOCK = 2048
#: 64-bit words of the bitmap of a set.
BITMAP_WORDS = 32


@lru_cache(maxsize=1)
def word_hash() -> WordHash:
    return WordHash(101)


@lru_cache(maxsize=1)
def hash_family(n: int) -> tuple[np.ndarray, np.ndarray]:
    """n functions x -> a x + b over 64-bit integers, of which the upper half counts."""
    rng = np.random.Generator(np.random.PCG64(7))
    return _odd(5, n)[:, None], rng.integers(0, 2**64, n, dtype=np.uint64)[:, None]


def signature(shingles: np.ndarray, n: int) -> np.ndarray:
    """The n minima of a non-empty set; in blocks, so that memory is bounded for any text."""
    a, b = hash_family(n)
    least = np.full(n, np.iinfo(np.uint64).max)
    for at in range(0, len(shingles), SET_BLOCK):
        values = a * shingles[at:at + SET_BLOCK]
        values += b
        np.minimum(least, values.min(axis=1), out=least)
    return (least >> np.uint64(32)).astype(np.uint32)


def shingle_sets(texts: pa.Array, k: int):
    """Per text its distinct shingle hashes, sorted."""
    for part in slices(texts, lower=True):
        shingles, bounds = sequences(word_hash()(part.data, part.starts, part.ends), k, part.bounds)
        for lo, hi in zip(bounds[:-1], bounds[1:]):
            yield np.unique(shingles[lo:hi])


def band_keys(sig: np.ndarray, bands: int, rows: int) -> np.ndarray:
    grid = sig.reshape(bands, rows).astype(np.uint64)
    return mix((grid * _odd(21, rows)).sum(axis=1, dtype=np.uint64) + _odd(22, bands)).view(np.int64)


def _features(k: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            ids, sizes, his, los, keys = batch.column(0), [], [], [], []
            for found in shingle_sets(batch.column(1), k):
                sizes.append(len(found))
                his.append(mix(found ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64))
                los.append(mix(found + np.uint64(0x14057B7EF767814F)).sum(dtype=np.uint64))
                keys.append(band_keys(signature(found, bands * rows), bands, rows) if len(found) else ())
            counts = np.array([len(x) for x in keys], dtype=np.int32)
            flat = np.concatenate([np.empty(0, np.int64), *(x for x in keys if len(x))])
            offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
            yield pa.record_batch([
                ids, pa.array(sizes, pa.int64()), pa.array(np.array(his, np.uint64).view(np.int64)),
                pa.array(np.array(los, np.uint64).view(np.int64)),
                pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat, pa.int64()))],
                names=["doc", "n_shingles", "hi", "lo", "bands"])
    return run


def _sets(k: int, n: int):
    def run(batches):
        for batch in batches:
            sigs, sets, bits = [], [], []
            for found in shingle_sets(batch.column(1), k):
                bitmap = np.zeros(64 * BITMAP_WORDS, dtype=bool)
                bitmap[found % np.uint64(len(bitmap))] = True
                bits.append(np.packbits(bitmap, bitorder="little").view(np.int64))
                sigs.append(signature(found, n).tobytes() if len(found) else b"")
                sets.append(found.tobytes())
            flat = pa.array(np.concatenate([np.empty(0, np.int64), *bits]))
            edges = pa.array(np.arange(len(sets) + 1, dtype=np.int32) * BITMAP_WORDS)
            yield pa.record_batch([batch.column(0), pa.array(sigs, pa.binary()), pa.array(sets, pa.binary()),
                                   pa.array([len(x) // 8 for x in sets], pa.int32()),
                                   pa.ListArray.from_arrays(edges, flat)],
                                  names=["node", "sig", "shingles", "n", "bits"])
    return run


def signatures_agree(a: bytes, b: bytes, percent: int) -> bool:
    """Whether the share of equal minima does not rule the pair out."""
    x, y = np.frombuffer(a, np.uint32), np.frombuffer(b, np.uint32)
    p = percent / 100
    return (x == y).mean() >= p - SLACK * (p * (1 - p) / len(x)) ** 0.5


def sets_agree(a: bytes, b: bytes, percent: int) -> bool:
    """100 * intersection >= percent * union on the full sets."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    small, large = (x, y) if len(x) < len(y) else (y, x)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(x) + len(y) - both)


def _verify(percent: int):
    def run(batches):
        for batch in batches:
            a, b, sig_a, sig_b, set_a, set_b = batch.columns
            ok = [signatures_agree(sig_a[i].as_py(), sig_b[i].as_py(), percent)
                  and sets_agree(set_a[i].as_py(), set_b[i].as_py(), percent) for i in range(batch.num_rows)]
            keep = pa.array(ok, pa.bool_())
            yield pa.record_batch([a.filter(keep), b.filter(keep)], names=["a", "b"])
    return run


def may_agree(n_a: str, bits_a: str, n_b: str, bits_b: str, percent: int):
    """Whether the bitmaps leave it open that the sets are similar enough.

    Each bit that only a's bitmap has certifies an element that b lacks, so
    n_a less their number bounds the intersection; likewise for b.
    """
    def only(x, y):
        return " + ".join(f"bit_count({x}[{i}] & ~{y}[{i}])" for i in range(BITMAP_WORDS))
    most = f"least({n_a} - ({only(bits_a, bits_b)}), {n_b} - ({only(bits_b, bits_a)}))"
    return F.expr(f"{100 + percent} * {most} >= {percent} * ({n_a} + {n_b})")


def size_class(n: Column, percent: int) -> Column:
    """The class of a set's size, in powers of a little more than 100 / percent: linked sets are at most one apart."""
    width = 1.000001 * max(math.log(100 / percent), 0.01)
    return F.floor(F.log(n.cast("double")) / F.lit(width)).cast("int")


def across_components(members: DataFrame, found: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(a, b) pairs of a bucket in different components that the bitmaps do not rule out.

    In each bucket the nodes outside its most frequent component meet all of them,
    which leaves out only pairs within that component. Sets so similar differ in size by
    less than one ``size_class``: a node meets its own class and the two beside it.
    """
    placed = stored(members.select("key", "node").join(found, "node", "left")
                           .select("key", "node", F.coalesce("component", "node").alias("component")), "placed")
    counts = placed.groupBy("key", "component").count()
    mixed = (counts.groupBy("key").agg(F.count(F.lit(1)).alias("components"),
                                       F.max(F.struct("count", "component")).alias("most"))
                   .where("components > 1").select("key", F.col("most.component").alias("main")))
    open_ = placed.join(mixed, "key").join(sets.select("node", "n", "bits"), "node")
    near = F.explode(F.array(*[size_class(F.col("n"), percent) + i for i in (-1, 0, 1)]))
    left = open_.where(F.col("component") != F.col("main")).select(
        "key", near.alias("size"), F.col("node").alias("a"), F.col("component").alias("ca"),
        F.col("n").alias("na"), F.col("bits").alias("x"))
    right = open_.select("key", size_class(F.col("n"), percent).alias("size"), F.col("node").alias("b"),
                         F.col("component").alias("cb"), F.col("n").alias("nb"), F.col("bits").alias("y"))
    met = left.join(right, (left["key"] == right["key"]) & (left["size"] == right["size"])
                    & (F.col("ca") != F.col("cb")) & may_agree("na", "x", "nb", "y", percent))
    return met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of distinct (a, b) pairs those whose sets are similar enough."""
    sets = sets.select("node", "sig", "shingles")
    both = (pairs.join(sets.toDF("a", "sig_a", "set_a"), "a")
                 .join(sets.toDF("b", "sig_b", "set_b"), "b")
                 .select("a", "b", "sig_a", "sig_b", "set_a", "set_b"))
    return both.mapInArrow(_verify(percent), "a long, b long")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5,
                    percent: int = 80, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """Per row of ``docs``: (doc_id, n_shingles, component_id, kept).

    Words are lower-cased (A-Z); a set holds the distinct k-word shingles, or
    the whole sequence if it is shorter. Rows are linked if
    100 * intersection >= percent * union.

    * Null or empty texts and texts without words: size 0, linked with nothing.
    * Rows repeating a doc_id are one document: their links are joined.
    * A null doc_id is never the smallest; alone in its class, ``component_id``
      is null. ``kept`` is ``doc_id <=> component_id``.
    """
    spark = docs.sparkSession
    python_ready(spark)
    source = docs.select(F.col(id_col).cast("long").alias("doc"), F.col(text_col).alias("text"))
    features = stored(source.mapInArrow(
        _features(k, bands, rows), "doc long, n_shingles long, hi long, lo long, bands array<long>"), "minhash")
    filled = features.where(F.col("n_shingles") > 0)
    # Equal sets have equal band keys: a class carries them once, however many rows it has.
    grouped = stored(filled.groupBy("hi", "lo").agg(F.min("doc").alias("node"), F.any_value("bands").alias("bands")), "classes")
    classes = grouped.select("hi", "lo", "node")
    nodes = grouped.where(F.col("node").isNotNull()).select("node", F.explode("bands").alias("key"))
    buckets = (nodes.groupBy("key").agg(F.min("node").alias("centre"), F.max("node").alias("last"))
                    .where(F.col("centre") < F.col("last")).select("key", "centre"))
    # An id with several texts may meet itself in a bucket: one row of each suffices.
    members = stored(nodes.join(buckets, "key").select("key", "node", "centre").distinct(), "members")
    candidates = members.select("node").distinct()
    # One set per id and text, named by 128 bits, however often the row is repeated.
    sets = stored(source.join(candidates, source["doc"] == candidates["node"], "left_semi")
                        .withColumns({f"h{i}": F.xxhash64(F.lit(i), "text") for i in (1, 2)})
                        .dropDuplicates(["doc", "h1", "h2"]).select("doc", "text").mapInArrow(_sets(k, bands * rows), "node long, sig binary, shingles binary, n int, bits array<long>"), "sets")

    star = members.where(F.col("node") != F.col("centre")).select(
        F.col("centre").alias("a"), F.col("node").alias("b")).distinct()
    again = filled.groupBy("doc").count().where("count > 1").select("doc")
    same = (filled.select("doc", "hi", "lo").join(again, "doc", "left_semi").join(classes, ["hi", "lo"])
                  .select(F.col("node").alias("a"), F.col("doc").alias("b")))
    links = stored(verified(star, sets, percent).union(same), "links")
    found = components(links, "a", "b")

    across = across_components(members, found, sets, percent)
    more = stored(verified(across, sets, percent), "links")
    if not more.isEmpty():
        found = components(found.select(F.col("node").alias("a"), F.col("component").alias("b")).union(more), "a", "b")

    by_class = classes.join(found, "node", "left").select(
        "hi", "lo", F.coalesce("component", "node").alias("component"))
    rows_ = features.select("doc", "n_shingles", "hi", "lo").join(by_class, ["hi", "lo"], "left")
    component = F.when(F.col("n_shingles") > 0, F.col("component")).otherwise(F.col("doc"))
    return rows_.select(F.col("doc").alias("doc_id"), "n_shingles", component.alias("component_id"),
                        F.col("doc").eqNullSafe(component).alias("kept"))


def one_per_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """``docs`` with one document of each group of near duplicates: the smallest doc_id.

    Of rows that repeat a doc_id and a text one stays. Rows that repeat a doc_id with different texts
    are documents of their own, told apart by 128-bit hashes of their texts. Rows with a null id cannot
    be told apart by it and all stay.
    """
    one, two, own_id, number, doc, kept_ = free_names(docs, "one", "two", "id", "number", "doc", "kept")
    marked = docs.withColumns({n: F.xxhash64(F.lit(i), F.col(text_col).isNull(), F.col(text_col))
                               for i, n in ((1, one), (2, two))})
    ids = F.col(id_col).cast("long")
    marks = marked.where(F.col(id_col).isNotNull()).groupBy(ids.alias(own_id)).agg(
        *[f(c).alias(f"{f.__name__}_{i}") for i, c in ((1, one), (2, two)) for f in (F.min, F.max)])
    mixed = stored(marks.where("min_1 <> max_1 OR min_2 <> max_2").select(own_id), "mixed")
    rest = docs.where(F.col(id_col).isNull())
    if mixed.isEmpty():
        kept = near_duplicates(docs, id_col, text_col, **how).where("kept").select(F.col("doc_id").alias(kept_)).distinct()
        return docs.join(kept, docs[id_col] == kept[kept_], "left_semi").dropDuplicates([id_col]).union(rest)
    # Texts of one id get numbers above all ids, in the order of id and hash.
    own = marked.select(ids.alias(own_id), one, two).join(mixed, own_id).distinct()
    most = docs.agg(F.max(ids)).scalar()
    own = stored(own.orderBy(own_id, one, two).withColumn(number, most + 1 + F.monotonically_increasing_id()), "texts")
    named = own.toDF("id_of", "one_of", "two_of", "number_of")
    numbered = marked.join(named, (marked[id_col].cast("long") == named["id_of"]) & (marked[one] == named["one_of"])
                           & (marked[two] == named["two_of"]), "left").select(
        marked["*"], F.coalesce(named["number_of"], marked[id_col].cast("long")).alias(doc))
    found = near_duplicates(numbered, doc, text_col, **how).where("doc_id IS NOT NULL").select(
        F.col("doc_id").alias("number_of"), "component_id").distinct().join(named, "number_of", "left")
    first = F.min(F.struct(F.coalesce("id_of", "number_of").alias("id"), "one_of", "two_of", "number_of"))
    kept = found.groupBy("component_id").agg(first.alias("first")).select(F.col("first.number_of").alias(kept_))
    stays = numbered.join(kept, numbered[doc] == kept[kept_], "left_semi").dropDuplicates([doc])
    return stays.select(*docs.columns).union(rest)


#: Every pair that shares a shingle, and components by the smallest label reachable.
LINKS_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS words FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(words) >= 2
    THEN list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])
    ELSE words END) AS shingle FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS shared
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (
  SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * shared >= 80 * (x.n + y.n - shared)),
g AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (
  SELECT doc_id AS node, doc_id AS reach FROM documents
  UNION SELECT g.b, r.reach FROM r JOIN g ON g.a = r.node)
SELECT doc_id, coalesce(n.n, 0) AS n_shingles, c.component_id, doc_id = c.component_id AS kept
FROM (SELECT node AS doc_id, min(reach) AS component_id FROM r GROUP BY node) c LEFT JOIN n USING (doc_id)
"""
