"""The queries of this subpackage and their DuckDB SQL, for ``__spark_entry__``."""

from __future__ import annotations

import corpus_pipeline

from . import bpe, decontaminate, hard_negatives, html_text, jaccard_join, periodic_runs, pii, quality, substring_dedup, suffix_dedup, token_count, topk, url_reputation

QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_bpe": bpe.op1_bpe,
    "op2_quality": quality.op2_quality,
    "op3_jaccard_join": jaccard_join.op3_jaccard_join,
    "op4_token_counts": token_count.op4_token_counts,
    "op5_decontaminate": decontaminate.op5_decontaminate,
    "op6_pii": pii.op6_pii,
    "op7_topk": topk.op7_topk,
    "op8_substring_dedup": substring_dedup.op8_substring_dedup,
    "op9_html_text": html_text.op9_html_text,
    "op10_url_reputation": url_reputation.op10_url_reputation,
    "op11_suffix_dedup": suffix_dedup.op11_suffix_dedup,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {name: sql for name, sql in {"pipeline": corpus_pipeline.ORACLE_SQL}.items() if sql} | {
    "op7_topk": topk.ORACLE,
    "op10_url_reputation": url_reputation.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
}
