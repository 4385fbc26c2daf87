"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from marketloom.llm import (
    decontaminate,
    html_text,
    language_id,
    line_chunks,
    lm_score,
    near_dups,
    packing,
    phrases,
    pii,
    quality,
    ranked_search,
    suffixes,
    url_filter,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_lm_score": lm_score.op1,
    "op2_personal_data": pii.op2,
    "op3_near_duplicates": near_dups.op3,
    "op4_benchmark_leaks": decontaminate.op4,
    "op5_page_text": html_text.op5,
    "op6_best_fit_packing": packing.op6,
    "op7_line_chunks": line_chunks.op7,
    "op8_repeated_bytes": suffixes.op8,
    "op9_quality_rules": quality.op9,
    "op10_url_filter": url_filter.op10,
    "op11_language_id": language_id.op11,
    "op12_ranked_search": ranked_search.op12,
    "op13_phrases": phrases.op13,
}

SQL: dict[str, str] = {
    "op3_near_duplicates": near_dups.OP3_SQL,
    "op10_url_filter": url_filter.OP10_SQL,
    "op12_ranked_search": ranked_search.OP12_SQL,
    "op13_phrases": phrases.OP13_SQL,
}
