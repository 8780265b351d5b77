"""Operators for large training corpora, with their queries and the SQL these are checked against."""

from __future__ import annotations

from nestmetrics.llm import (
    bpe, chat, embeddings, exact_dedup, hard_negatives, html_text, licenses, packing, simhash, spelling, suffix_dedup, toxicity, url_filter,
)


def queries():
    return {
        "op1_url_filter": url_filter.op1_url_filter,
        "op2_exact_dedup": exact_dedup.op2_exact_dedup,
        "op3_simhash": simhash.op3_simhash,
        "op4_packing": packing.op4_packing,
        "op5_bpe": bpe.op5_bpe,
        "op6_suffix_dedup": suffix_dedup.op6_suffix_dedup,
        "op7_html_text": html_text.op7_html_text,
        "op8_toxicity": toxicity.op8_toxicity,
        "op9_licenses": licenses.op9_licenses,
        "op10_embeddings": embeddings.op10_embeddings,
        "op11_chat_format": chat.op11_chat_format,
        "op12_hard_negatives": hard_negatives.op12_hard_negatives,
        "op13_spelling": spelling.op13_spelling,
    }


def oracle_sql():
    return {
        "op1_url_filter": url_filter.OP1_SQL,
        "op2_exact_dedup": exact_dedup.OP2_SQL,
        "op9_licenses": licenses.OP9_SQL,
        "op11_chat_format": chat.OP11_SQL,
        "op12_hard_negatives": hard_negatives.OP12_SQL,
        "op13_spelling": spelling.OP13_SQL,
    }
