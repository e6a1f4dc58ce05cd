"""Line dedup across documents: range-partitioned line hashes, keep bitmaps out.

Lines of all documents become (hash, document, position) rows. They are
range-partitioned by (hash, slice of the document id) and sorted by
(hash, slice, document descending, position), so a window streams over each
run and marks the first occurrence of a hash in every document. One summary row
per run (documents, largest document) is merged per hash; a hash repeated in
enough documents keeps its lines only in its largest document. What comes back
is not text but, per document, a bitmap of its lines.

The slice spreads a line that a third of all documents hold over as many
ranges as there are shuffle partitions: no task gathers one line's rows, and
what meets per hash are the summaries, pre-aggregated by each task.
Built-in functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .tables import SPACES, ascii_lower, free_names, stored

WORD_BITS = 32


def lines_of_text(text: Column) -> Column:
    """The lines of a whole text: split at ``\\n`` only; null or empty is one empty line."""
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    """A line's key: white space stripped at both ends, A-Z lower-cased."""
    return ascii_lower(F.btrim(line, F.lit(SPACES)))


def line_hashes(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """(h1, h2, doc, pos) of every line whose key has at least ``min_chars`` code points."""
    lines = docs.where(F.col(id_col).isNotNull()).select(
        F.col(id_col).alias("doc"), F.posexplode(lines_of_text(F.col(text_col))).alias("pos", "line"))
    keyed = lines.select("doc", "pos", line_key(F.col("line")).alias("key")).where(F.length("key") >= min_chars)
    return keyed.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "pos")


def repeated_lines(hashes: DataFrame, min_docs: int) -> DataFrame:
    """One row per hash found in at least ``min_docs`` documents: (h1, h2, keeper)."""
    spark = hashes.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sliced = (hashes.withColumn("slice", F.pmod(F.xxhash64("doc"), F.lit(parts)))
                    .repartitionByRange(parts, "h1", "h2", "slice"))
    run = Window.partitionBy("h1", "h2", "slice").orderBy(F.desc("doc"), "pos")
    first = F.lag("doc").over(run).isNull() | (F.lag("doc").over(run) != F.col("doc"))
    firsts = sliced.withColumn("first", first).where("first")
    return (firsts.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("docs"), F.max("doc").alias("keeper"))
                  .where(F.col("docs") >= min_docs).select("h1", "h2", "keeper"))


def drop_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document that loses lines: (``doc``, ``drops``), a compressed bitmap of its lines.

    ``drops`` is an array of (word, bits): bit b of word w is line 32 w + b;
    words without a dropped line are left out, every other bit means keep.

    A document is a ``doc_id``: rows that repeat one count as one document.
    Rows with a null id neither count nor lose lines; null and empty texts
    have one empty line, which is shorter than any sensible ``min_chars``.
    """
    hashes = line_hashes(docs, id_col, text_col, min_chars)
    # Stored, so that the join deals both sides out anew and can split a hot line.
    keepers = stored(repeated_lines(hashes, min_docs), "keepers")
    lost = (hashes.join(keepers, ["h1", "h2"]).where(F.col("doc") != F.col("keeper"))
                  .select("doc", F.col("pos")).repartition("doc"))
    words = (lost.groupBy("doc", F.expr(f"pos div {WORD_BITS}").cast("int").alias("word"))
                 .agg(F.bit_or(F.expr(f"shiftleft(1L, pos % {WORD_BITS})")).alias("bits")))
    return words.groupBy("doc").agg(F.collect_list(F.struct("word", "bits")).alias("drops"))


def dropped_positions(drops: Column) -> Column:
    """The dropped line numbers of a bitmap (null: none)."""
    bits = F.sequence(F.lit(0), F.lit(WORD_BITS - 1))
    one = F.transform(drops, lambda w: F.transform(
        F.filter(bits, lambda b: F.getbit(w["bits"], b) == 1), lambda b: w["word"] * WORD_BITS + b))
    return F.coalesce(F.flatten(one), F.array().cast("array<int>"))


def kept_lines(lines: Column, drops: Column) -> Column:
    """The lines that a bitmap keeps, in order."""
    positions = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), dropped_positions(drops))
    return F.when(drops.isNull(), lines).otherwise(F.transform(positions, lambda i: F.get(lines, i)))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 20,
                min_docs: int = 3, lines: str = "_lines", kept: str = "_kept") -> DataFrame:
    """``docs`` with two more columns, ``lines`` (all lines) and ``kept`` (those that stay), every row kept.

    The other columns pass through untouched, whatever their names, but for those two.
    """
    maps = drop_bitmaps(docs, id_col, text_col, min_chars, min_docs)
    doc, drops = free_names(docs.select("*", F.lit(0).alias(lines), F.lit(0).alias(kept)), "doc", "drops")
    maps = maps.select(F.col("doc").alias(doc), F.col("drops").alias(drops))
    joined = docs.join(maps, docs[id_col] == maps[doc], "left").drop(doc)
    split = joined.withColumn(lines, lines_of_text(F.col(text_col)))
    return split.withColumn(kept, kept_lines(F.col(lines), F.col(drops))).drop(drops)


def dedup_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """``docs`` with the repeated lines taken out of ``text``; a null text stays null. Columns may have any names."""
    lines, kept = free_names(docs, "lines", "kept")
    out = dedup_lines(docs, id_col, text_col, min_chars, min_docs, lines, kept)
    text = F.when(F.col(text_col).isNotNull(), F.array_join(kept, "\n"))
    return out.withColumn(text_col, text).select(*docs.columns)


def line_report(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_chars: int = 20, min_docs: int = 3) -> DataFrame:
    """Per document row: id, lines before, lines dropped, SHA-256 of the kept text."""
    out = dedup_lines(docs.select(id_col, text_col), id_col, text_col, min_chars, min_docs)
    return out.select(
        F.col(id_col).alias("doc_id"), F.size("_lines").cast("long").alias("n_lines"),
        (F.size("_lines") - F.size("_kept")).cast("long").alias("n_dropped"),
        F.sha2(F.array_join("_kept", "\n").cast("binary"), 256).alias("kept_sha256"))


LINES_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents),
k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l),
d AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
m AS (
  SELECT k.doc_id, pos, line, (d.key IS NOT NULL AND k.doc_id <> d.keeper) AS gone
  FROM k LEFT JOIN d ON k.key = d.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""
