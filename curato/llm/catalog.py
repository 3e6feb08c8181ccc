"""The training-data queries, one per operator, and their DuckDB statements."""

from __future__ import annotations

import corpus_pipeline
from curato.llm import (decontaminate, exact_dedup, hard_negatives, html_extract, language_id, near_dedup,
                        prefix_trie, quality_classifier, quality_rules, sentencepiece_bpe, source_mix, toxicity,
                        url_filter)

QUERIES = {
    "op1_exact_dedup": exact_dedup.op1_exact_dedup,
    "op2_quality_classifier": quality_classifier.op2_quality_classifier,
    "op3_source_mix": source_mix.op3_source_mix,
    "op4_language_id": language_id.op4_language_id,
    "op5_quality_rules": quality_rules.op5_quality_rules,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_url_filter": url_filter.op7_url_filter,
    "op8_sentencepiece": sentencepiece_bpe.op8_sentencepiece,
    "op9_html_extract": html_extract.op9_html_extract,
    "op10_near_dedup": near_dedup.op10_near_dedup,
    "op11_decontaminate": decontaminate.op11_decontaminate,
    "op12_hard_negatives": hard_negatives.op12_hard_negatives,
    "op13_prefix_trie": prefix_trie.op13_prefix_trie,
    "pipeline": corpus_pipeline.run,
}

ORACLE = {
    "op1_exact_dedup": exact_dedup.ORACLE,
    "op3_source_mix": source_mix.ORACLE,
    "op5_quality_rules": quality_rules.ORACLE,
    "op7_url_filter": url_filter.ORACLE,
    "op11_decontaminate": decontaminate.ORACLE,
    "op12_hard_negatives": hard_negatives.ORACLE,
    "op13_prefix_trie": prefix_trie.ORACLE,
}
