"""The registered training-data queries and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from sunset_engine.llm import alignment, binary_codes, chat_windows, fill_middle, ngram_join, segment_search, url_filter, warc
from sunset_engine.llm.binary_codes import op1_binary_codes
from sunset_engine.llm.bpe_table import op10_bpe_table
from sunset_engine.llm.byte_gru import op3_byte_gru
from sunset_engine.llm.ngram_join import op2_ngram_jaccard
from sunset_engine.llm.ordinal_quality import op6_ordinal_quality
from sunset_engine.llm.packing import op7_best_fit_packing
from sunset_engine.llm.pii import op8_feistel_pseudonyms
from sunset_engine.llm.segment_search import op5_segment_search

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_binary_codes": op1_binary_codes,
    "op2_ngram_jaccard": op2_ngram_jaccard,
    "op3_byte_gru": op3_byte_gru,
    "op4_warc_chunks": warc.op4_warc_chunks,
    "op5_segment_search": op5_segment_search,
    "op6_ordinal_quality": op6_ordinal_quality,
    "op7_best_fit_packing": op7_best_fit_packing,
    "op8_feistel_pseudonyms": op8_feistel_pseudonyms,
    "op9_url_model_ratio": url_filter.op9_url_model_ratio,
    "op10_bpe_table": op10_bpe_table,
    "op11_fill_middle": fill_middle.op11_fill_middle,
    "op12_alignment": alignment.op12_alignment,
    "op13_chat_windows": chat_windows.op13_chat_windows,
    "pipeline": corpus_pipeline.run,
}

ORACLE: dict[str, str] = {
    "op1_binary_codes": binary_codes.ORACLE,
    "op2_ngram_jaccard": ngram_join.ORACLE,
    "op4_warc_chunks": warc.ORACLE,
    "op5_segment_search": segment_search.ORACLE,
    "op9_url_model_ratio": url_filter.oracle(),
    "op11_fill_middle": fill_middle.ORACLE,
    "op13_chat_windows": chat_windows.ORACLE,
}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return {k: v for k, v in ORACLE.items() if k in QUERIES}
