"""Queries of the training-data operators and, where SQL can state them, their SQL."""

from __future__ import annotations

from tessera.llm import (
    op1_toxicity,
    op2_topk,
    op3_pii,
    op4_quality,
    op5_mixing,
    op6_warc,
    op7_licences,
    op8_minhash,
    op9_decontaminate,
    op10_html,
    op11_prefix_trie,
    op12_hard_negatives,
    op13_substring,
)

QUERIES = {
    "op1_toxicity": op1_toxicity.op1_toxicity,
    "op2_topk": op2_topk.op2_topk,
    "op3_pii": op3_pii.op3_pii,
    "op4_quality": op4_quality.op4_quality,
    "op5_mixing": op5_mixing.op5_mixing,
    "op6_warc": op6_warc.op6_warc,
    "op7_licences": op7_licences.op7_licences,
    "op8_near_duplicates": op8_minhash.op8_near_duplicates,
    "op9_decontaminate": op9_decontaminate.op9_decontaminate,
    "op10_html": op10_html.op10_html,
    "op11_prefix_trie": op11_prefix_trie.op11_prefix_trie,
    "op12_hard_negatives": op12_hard_negatives.op12_hard_negatives,
    "op13_substring_dedup": op13_substring.op13_substring_dedup,
}

ORACLES = {
    "op2_topk": op2_topk.ORACLE,
    "op5_mixing": op5_mixing.ORACLE,
    "op6_warc": op6_warc.ORACLE,
    "op7_licences": op7_licences.ORACLE,
    "op8_near_duplicates": op8_minhash.ORACLE,
    "op9_decontaminate": op9_decontaminate.ORACLE,
    "op11_prefix_trie": op11_prefix_trie.ORACLE,
    "op12_hard_negatives": op12_hard_negatives.ORACLE,
    "op13_substring_dedup": op13_substring.ORACLE,
}
