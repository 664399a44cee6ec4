"""Queries of the llm operators and their DuckDB SQL, where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from featurewright.llm import byte_bpe, exact_dedup, language_id, line_dedup, mixing, near_dedup, packing, repeats, secrets, token_alignment, token_counts, topk_search, whitening

QueryFn = Callable[[SparkSession, str], DataFrame]


def queries() -> dict[str, QueryFn]:
    return {f.__name__: f for f in (
        packing.op1_pack_sum_of_squares,
        secrets.op2_secret_battery,
        near_dedup.op3_minhash_tensored,
        mixing.op4_mix_sources,
        repeats.op5_suffix_repeats,
        line_dedup.op6_line_dedup,
        token_counts.op7_token_counts,
        language_id.op8_language_id,
        topk_search.op9_topk_search,
        exact_dedup.op10_exact_dedup,
        token_alignment.op11_token_alignment,
        byte_bpe.op12_byte_bpe,
        whitening.op13_feast_whitening,
    )}


def oracle_sql() -> dict[str, str]:
    return {"op4_mix_sources": mixing.SQL, "op6_line_dedup": line_dedup.SQL, "op9_topk_search": topk_search.SQL, "op10_exact_dedup": exact_dedup.SQL}
