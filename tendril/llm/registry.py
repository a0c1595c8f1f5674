"""The queries of this subpackage, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from tendril.llm import centroids, decontamination, html_text, language_id, language_model, packing, prefix_trie, quality_model, quality_rules, sharding, simhash_dedup, suffix_dedup, warc

QUERIES = {
    "op1_packing": packing.op1_packing,
    "op2_warc_round_trip": warc.op2_warc_round_trip,
    "op3_html_main_text": html_text.op3_html_main_text,
    "op4_quality_model": quality_model.op4_quality_model,
    "op5_line_quality_rules": quality_rules.op5_line_quality_rules,
    "op6_simhash_near_duplicates": simhash_dedup.op6_simhash_near_duplicates,
    "op7_language_codes": language_id.op7_language_codes,
    "op8_suffix_array_dedup": suffix_dedup.op8_suffix_array_dedup,
    "op9_benchmark_containment": decontamination.op9_benchmark_containment,
    "op10_kd_sharding": sharding.op10_kd_sharding,
    "op11_backoff_automaton": language_model.op11_backoff_automaton,
    "op12_conversation_trie": prefix_trie.op12_conversation_trie,
    "op13_lookup_table_clusters": centroids.op13_lookup_table_clusters,
}

ORACLE_SQL: dict[str, str] = {
    "op5_line_quality_rules": quality_rules.OP5_SQL,
    "op9_benchmark_containment": decontamination.OP9_SQL,
    "op12_conversation_trie": prefix_trie.OP12_SQL,
    "op13_lookup_table_clusters": centroids.OP13_SQL,
}
