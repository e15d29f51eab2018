"""The queries of this package and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from ticketloom.llm import (
    bpe, conversations, embeddings, exact_dedup, licenses, negatives, packing, pii, quality, simhash, substrings, toxicity, urls)

QUERIES = {
    "op1_quality_classifier": quality.op1_quality_classifier,
    "op2_byte_bpe": bpe.op2_byte_bpe,
    "op3_embedding_dedup": embeddings.op3_embedding_dedup,
    "op4_exact_dedup": exact_dedup.op4_exact_dedup,
    "op5_simhash_dedup": simhash.op5_simhash_dedup,
    "op6_lexical_packing": packing.op6_lexical_packing,
    "op7_toxicity": toxicity.op7_toxicity,
    "op8_license_scan": licenses.op8_license_scan,
    "op9_pii_surrogates": pii.op9_pii_surrogates,
    "op10_substring_dedup": substrings.op10_substring_dedup,
    "op11_url_rules": urls.op11_url_rules,
    "op12_hard_negatives": negatives.op12_hard_negatives,
    "op13_conversation_repair": conversations.op13_conversation_repair,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op4_exact_dedup": exact_dedup.ORACLE,
    "op11_url_rules": urls.ORACLE,
    "op12_hard_negatives": negatives.ORACLE,
    "op13_conversation_repair": conversations.ORACLE,
}
