"""Registered queries of the training-data operators, with DuckDB oracles where SQL can express them."""

from __future__ import annotations

from tidemark.llm import ann, bpe, chat, collocations, exact_dedup, html_text, jaccard_join, mixing, near_dedup, substring_dedup, toxicity, warc, whitening

QUERIES = {
    "op1_minhash_near_dedup": near_dedup.query,
    "op2_substring_dedup": substring_dedup.query,
    "op3_html_extraction": html_text.query,
    "op4_exact_dedup": exact_dedup.query,
    "op5_nearest_neighbours": ann.query,
    "op6_mix_sources": mixing.query,
    "op7_warc_index": warc.query,
    "op8_chat_format": chat.query,
    "op9_toxicity": toxicity.query,
    "op10_byte_bpe": bpe.query,
    "op11_embedding_whitening": whitening.query,
    "op12_jaccard_join": jaccard_join.query,
    "op13_phrase_collocations": collocations.query,
}
ORACLES = {
    "op1_minhash_near_dedup": near_dedup.ORACLE,
    "op2_substring_dedup": substring_dedup.ORACLE,
    "op3_html_extraction": html_text.ORACLE,
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op8_chat_format": chat.ORACLE,
    "op12_jaccard_join": jaccard_join.ORACLE,
    "op13_phrase_collocations": collocations.ORACLE,
}
