"""The numbered operators' queries and their SQL by name."""

from __future__ import annotations

from dialoom.llm import align, chat, decontaminate, html, jaccard, lm, mixing, quality, repeats, resample, tokens, toxicity, urls


def queries() -> dict:
    return {
        "op1_mixing": mixing.op1_mixing,
        "op2_host_rules": quality.op2_host_rules,
        "op3_url_filter": urls.op3_url_filter,
        "op4_token_ids": tokens.op4_token_ids,
        "op5_lm_scoring": lm.op5_lm_scoring,
        "op6_decontamination": decontaminate.op6_decontamination,
        "op7_toxicity": toxicity.op7_toxicity,
        "op8_jaccard_join": jaccard.op8_jaccard_join,
        "op9_html_text": html.op9_html_text,
        "op10_chat_format": chat.op10_chat_format,
        "op11_importance_resampling": resample.op11_importance_resampling,
        "op12_suffix_dedup": repeats.op12_suffix_dedup,
        "op13_tokenizer_alignment": align.op13_tokenizer_alignment,
    }


def oracle_sql() -> dict[str, str]:
    return {"op1_mixing": mixing.ORACLE, "op2_host_rules": quality.ORACLE, "op10_chat_format": chat.ORACLE, "op11_importance_resampling": resample.ORACLE, "op12_suffix_dedup": repeats.ORACLE}
