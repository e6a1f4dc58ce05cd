"""A training corpus from raw documents: five stages, each one operator of ``tidewater.llm``.

``STAGES`` lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame. Each stage's result is written as Parquet to the shared folder and
read again as the next stage's ``docs``, so a lost executor never costs more than a stage.

Texts go to Python in Arrow batches of ``BATCH_ROWS`` rows and ``BATCH_BYTES`` bytes at most (one row at least): a stage sets
this for its session, so a worker's memory does not follow Spark's default of 10,000 rows of any length.

All stages but the last return the columns of ``documents``. A null in any column is
passed on; rows without an id are never compared by id and stay.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm import decontaminate, langid, linededup, minhash, sentencepiece_unigram
from tidewater.llm.tables import stored
from tidewater.sources import table


BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def _small_batches(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a recognisable language: no letter, or no language above even odds.

    The model learns from the labelled rows that are not held out.
    """
    _small_batches(spark)
    model = langid.train(docs.where(~langid.held_out(F.col("doc_id"))))
    return langid.keep_identified(docs, model)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines that three or more documents share out of all but the last; n_chars follows the text."""
    out = linededup.dedup_text(docs)
    return out.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars"))
                          .otherwise(F.length("text").cast("long"))).select(*docs.columns)


def dedup_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document of each group of near duplicates (5-word shingles, similarity 0.8)."""
    _small_batches(spark)
    return minhash.one_per_group(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that hold a benchmark item."""
    _small_batches(spark)
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encode every text to ids and decode it again; adds token_ids, n_tokens and round_trip."""
    _small_batches(spark)
    return sentencepiece_unigram.round_trip(docs, sentencepiece_unigram.load_vocabulary())


STAGES = [
    ("language_id", identify_languages),
    ("line_dedup", dedup_lines),
    ("near_dedup", dedup_documents),
    ("decontaminate", drop_benchmark),
    ("sentencepiece", tokenize),
]

#: SQL can express neither the trained language model nor the unigram segmentation; tests/llm
#: holds the pipeline against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
