"""The registered queries of this package and, where SQL can say them, their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from wearline.llm import (conversation_repair, hard_negatives, html_text, line_dedup, packing, piece_codec, quality_mil,
                          quality_rules, simhash, suffix_dedup, toxicity, vector_search, warc)
from wearline.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {
    "op1_toxicity": lambda spark, sf_dir: toxicity.score(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op2_best_fit_packing": lambda spark, sf_dir: packing.pack(table(spark, sf_dir, "documents")),
    "op3_suffix_dedup": lambda spark, sf_dir: suffix_dedup.digest(table(spark, sf_dir, "documents")),
    "op4_simhash_near_dedup": lambda spark, sf_dir: simhash.digest(table(spark, sf_dir, "documents")),
    "op5_line_dedup": lambda spark, sf_dir: line_dedup.digest(table(spark, sf_dir, "documents")),
    "op6_sentencepiece": lambda spark, sf_dir: piece_codec.digest(table(spark, sf_dir, "documents")),
    "op7_html_text": lambda spark, sf_dir: html_text.extracted(table(spark, sf_dir, "pages")),
    "op8_quality_rules": lambda spark, sf_dir: quality_rules.judged(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op9_exact_top_k": lambda spark, sf_dir: vector_search.search(table(spark, sf_dir, "embeddings")),
    "op10_quality_classifier": lambda spark, sf_dir: quality_mil.score(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op11_conversation_repair": lambda spark, sf_dir: conversation_repair.digest(table(spark, sf_dir, "conversations")),
    "op12_warc": lambda spark, sf_dir: warc.digest(table(spark, sf_dir, "pages")),
    "op13_hard_negatives": lambda spark, sf_dir: hard_negatives.digest(table(spark, sf_dir, "embeddings")),
}

ORACLES: dict[str, str] = {
    "op9_exact_top_k": vector_search.SEARCH_SQL,
    "op11_conversation_repair": conversation_repair.DIGEST_SQL,
    "op12_warc": warc.DIGEST_SQL,
    "op13_hard_negatives": hard_negatives.DIGEST_SQL,
}
