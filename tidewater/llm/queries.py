"""One query per operator over its whole table, with production parameters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..sources import table
from . import (bitslice, decontaminate, hostreputation, langid, lexical, licenses, linededup, minhash,
               sentencepiece_unigram, sharding, superkmer, tokenalign, warc)
from .registry import QUERIES, query


def queries():
    return {name: fn for name, (fn, _) in QUERIES.items()}


def oracle_sql():
    return {name: sql for name, (_, sql) in QUERIES.items() if sql is not None}


@query("op2_line_dedup", linededup.LINES_SQL)
def op2_line_dedup(spark, sf_dir):
    return linededup.line_report(table(spark, sf_dir, "documents"))


#: 2-word shingles are this query's contract; the operator's own default is 5 words.
@query("op1_minhash_dedup", minhash.LINKS_SQL)
def op1_minhash_dedup(spark, sf_dir):
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), k=2)


@query("op3_host_reputation", hostreputation.URLS_SQL)
def op3_host_reputation(spark, sf_dir):
    judged = hostreputation.judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


#: No SQL: checked against a brute-force coder, and by accuracy on the held-out documents.
@query("op9_langid_ppm")
def op9_langid_ppm(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    found = langid.identify(docs, langid.train(docs.where(~out)))
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score")


@query("op7_bitslice_topk", bitslice.TOPK_SQL)
def op7_bitslice_topk(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings")
    return bitslice.top_k(rows, rows.where(F.col("vec_id") % 50 == 0))


@query("op10_superkmer_dedup", superkmer.REPEATS_SQL)
def op10_superkmer_dedup(spark, sf_dir):
    cut = superkmer.dedup_substrings(table(spark, sf_dir, "documents"))
    return cut.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


#: No SQL: checked against a brute-force edit distance on small tables.
@query("op4_cgk_decontaminate")
def op4_cgk_decontaminate(spark, sf_dir):
    return decontaminate.contamination_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: No SQL: checked against a plain best-path search over short texts, and by exact round trips.
@query("op6_sentencepiece")
def op6_sentencepiece(spark, sf_dir):
    coded = sentencepiece_unigram.encode_table(
        table(spark, sf_dir, "documents"), sentencepiece_unigram.load_vocabulary())
    return coded.select("doc_id", "n_tokens", "n_bytes", F.sha2("ids", 256).alias("ids_sha256"),
                        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"), "round_trip")


@query("op5_warc", warc.WARC_SQL)
def op5_warc(spark, sf_dir):
    return warc.archived_pages(table(spark, sf_dir, "pages"))


#: No SQL for the trained classifier: checked against held-out notices and a recomputation on a small table.
@query("op8_license_scan")
def op8_license_scan(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return licenses.license_report(docs, licenses.train(docs))


#: No SQL for two tokenisers: checked against the tokenisers' own libraries and a plain merge over short texts.
@query("op11_token_alignment")
def op11_token_alignment(spark, sf_dir):
    return tokenalign.alignment_report(table(spark, sf_dir, "documents"))


#: No SQL for a random permutation: checked by exact sizes, gapless slots, and the law of the draws.
@query("op12_sharding")
def op12_sharding(spark, sf_dir):
    return sharding.shard_report(table(spark, sf_dir, "documents"))


@query("op13_lexical_search", lexical.SEARCH_SQL)
def op13_lexical_search(spark, sf_dir):
    index = lexical.build_index(table(spark, sf_dir, "documents"))
    return lexical.search(index, table(spark, sf_dir, "benchmark"))
