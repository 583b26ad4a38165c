"""Driver queries of this folder, one for each operator, and the SQL of those that SQL can express."""

from __future__ import annotations

from tidemark.llm import bpe, collocations, conversations, language, licences, ngram_join, packing, quality, scoring, substrings, suffixes, topk, warc

QUERIES = {
    "op1_language_id": language.op1_language_id,
    "op2_license_scan": licences.op2_license_scan,
    "op3_lm_score": scoring.op3_lm_score,
    "op4_quality_rules": quality.op4_quality_rules,
    "op5_bpe": bpe.op5_bpe,
    "op6_exact_topk": topk.op6_exact_topk,
    "op7_best_fit_packing": packing.op7_best_fit_packing,
    "op8_warc": warc.op8_warc,
    "op9_ngram_join": ngram_join.op9_ngram_join,
    "op10_suffix_dedup": suffixes.op10_suffix_dedup,
    "op11_substring_dedup": substrings.op11_substring_dedup,
    "op12_collocations": collocations.op12_collocations,
    "op13_conversation_repair": conversations.op13_conversation_repair,
}

SQL = {
    "op6_exact_topk": topk.SQL,
    "op8_warc": warc.SQL,
    "op11_substring_dedup": substrings.op11_substring_dedup,
    "op12_collocations": collocations.SQL,
}
