"""The queries of the operators and of the corpus pipeline, with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from cohortlab.llm import (
    op01_lm_scoring,
    op02_suffix_dedup,
    op03_sharding,
    op04_warc,
    op05_quality,
    op06_decontaminate,
    op07_simhash_dedup,
    op08_exact_dedup,
    op09_sentencepiece,
    op10_url_filter,
    op11_prefix_trie,
    op12_jaccard_join,
    op13_structure_repair,
)

Query = Callable[[SparkSession, str], DataFrame]


def registry() -> dict[str, Query]:
    return {
        "op1_lm_scoring": op01_lm_scoring.query,
        "op2_suffix_dedup": op02_suffix_dedup.query,
        "op3_sharding": op03_sharding.query,
        "op4_warc": op04_warc.query,
        "op5_quality": op05_quality.query,
        "op6_decontaminate": op06_decontaminate.query,
        "op7_simhash_dedup": op07_simhash_dedup.query,
        "op8_exact_dedup": op08_exact_dedup.query,
        "op9_sentencepiece": op09_sentencepiece.query,
        "op10_url_filter": op10_url_filter.query,
        "op11_prefix_trie": op11_prefix_trie.query,
        "op12_jaccard_join": op12_jaccard_join.query,
        "op13_structure_repair": op13_structure_repair.query,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op4_warc": op04_warc.SQL,
        "op8_exact_dedup": op08_exact_dedup.SQL,
        "op10_url_filter": op10_url_filter.SQL,
    }
