"""Queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import decontam, hmm, htmltext, licenses, mixing, neardup, quality, repair, topk, warc


def queries() -> dict:
    return {
        "op1_quality": quality.query,
        "op2_decontaminate": decontam.query,
        "op3_token_shards": repair.query,
        "op4_warc_archives": warc.query,
        "op5_main_text": htmltext.query,
        "op6_hmm_score": hmm.query,
        "op7_mix_sources": mixing.query,
        "op8_license_scan": licenses.query,
        "op9_near_duplicates": neardup.query,
        "op10_topk_search": topk.query,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op2_decontaminate": decontam.ORACLE,
        "op4_warc_archives": warc.ORACLE,
        "op9_near_duplicates": neardup.ORACLE,
        "op10_topk_search": topk.ORACLE,
    }
