"""The operators' registered queries and, where SQL can express one, its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from clinistar.llm import align, ann, bpe, chat, html_text, jaccard, mix, phrases, quality, simhash, token_count, toxicity, warc


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_mix": mix.op1_mix,
        "op2_token_counts": token_count.op2_token_counts,
        "op3_bpe": bpe.op3_bpe,
        "op4_nearest": ann.op4_nearest,
        "op5_warc": warc.op5_warc,
        "op6_html_text": html_text.op6_html_text,
        "op7_jaccard": jaccard.op7_jaccard,
        "op8_quality": quality.op8_quality,
        "op9_toxicity": toxicity.op9_toxicity,
        "op10_chat": chat.op10_chat,
        "op11_simhash": simhash.op11_simhash,
        "op12_phrases": phrases.op12_phrases,
        "op13_align": align.op13_align,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mix": mix.ORACLE, "op4_nearest": ann.ORACLE, "op7_jaccard": jaccard.ORACLE, "op12_phrases": phrases.ORACLE}
