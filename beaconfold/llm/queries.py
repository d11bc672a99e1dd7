"""The training-data operators as queries, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from beaconfold.llm import (
    best_fit_packing, chat_formatting, exact_dedup, fill_in_middle, huffman_ids, line_cleaning, page_text, prob_minhash, source_mixing,
    spot_signatures, suffix_dedup, url_filter, whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, Query]:
    found = [
        chat_formatting.op1_chat_formatting,
        url_filter.op2_url_filter,
        suffix_dedup.op3_suffix_dedup,
        source_mixing.op4_source_mixing,
        page_text.op5_page_text,
        line_cleaning.op6_line_cleaning,
        huffman_ids.op7_huffman_ids,
        exact_dedup.op8_exact_dedup,
        best_fit_packing.op9_best_fit_packing,
        prob_minhash.op10_prob_minhash,
        whitening.op11_whitening,
        spot_signatures.op12_spot_signatures,
        fill_in_middle.op13_fill_in_middle,
    ]
    return {f.__name__: f for f in found} | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return {
        "op1_chat_formatting": chat_formatting.OP1_SQL,
        "op8_exact_dedup": exact_dedup.OP8_SQL,
        "op13_fill_in_middle": fill_in_middle.OP13_SQL,
    }
