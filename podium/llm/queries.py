"""Registered queries and oracle SQL of the corpus operators."""

from __future__ import annotations

from podium.llm import chat_format, decontaminate, jaccard_join, license_scan, line_dedup, mixing, periodic_runs, personal_data, quality_rules, token_store, url_filters, vector_codes, warc

QUERIES = {
    "op1_mixing": mixing.op1_mixing,
    "op2_token_store": token_store.op2_token_store,
    "op3_chat_format": chat_format.op3_chat_format,
    "op4_warc": warc.op4_warc,
    "op5_jaccard_join": jaccard_join.op5_jaccard_join,
    "op6_url_filters": url_filters.op6_url_filters,
    "op7_license_scan": license_scan.op7_license_scan,
    "op8_decontaminate": decontaminate.op8_decontaminate,
    "op9_line_dedup": line_dedup.op9_line_dedup,
    "op10_quality_rules": quality_rules.op10_quality_rules,
    "op11_vector_codes": vector_codes.op11_vector_codes,
    "op12_personal_data": personal_data.op12_personal_data,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}

ORACLE_SQL = {
    "op1_mixing": mixing.ORACLE,
    "op3_chat_format": chat_format.ORACLE,
    "op4_warc": warc.ORACLE,
    "op5_jaccard_join": jaccard_join.ORACLE,
    "op6_url_filters": url_filters.ORACLE,
    "op11_vector_codes": vector_codes.ORACLE,
    "op13_periodic_runs": periodic_runs.ORACLE,
}
