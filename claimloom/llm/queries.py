"""The queries of this subpackage, by name, and DuckDB SQL where it can express them."""

from __future__ import annotations

from claimloom.llm import decontamination, filter_audit, language_id, licenses, line_dedup, packing, progressive_jpeg, sharding, simhash, threshold_search, token_counts, token_output, warc

QUERIES = {
    "op1_simhash": simhash.op1_simhash,
    "op2_line_dedup": line_dedup.op2_line_dedup,
    "op3_token_counts": token_counts.op3_token_counts,
    "op4_token_ids": token_output.op4_token_ids,
    "op5_decontamination": decontamination.op5_decontamination,
    "op6_warc_revisits": warc.op6_warc_revisits,
    "op7_progressive_jpeg": progressive_jpeg.op7_progressive_jpeg,
    "op8_packing": packing.op8_packing,
    "op9_language_id": language_id.op9_language_id,
    "op10_sharding": sharding.op10_sharding,
    "op11_license_scan": licenses.op11_license_scan,
    "op12_filter_audit": filter_audit.op12_filter_audit,
    "op13_threshold_search": threshold_search.op13_threshold_search,
}

ORACLE_SQL: dict[str, str] = {
    "op6_warc_revisits": warc.ORACLE,
    "op11_license_scan": licenses.ORACLE,
    "op12_filter_audit": filter_audit.ORACLE,
    "op13_threshold_search": threshold_search.ORACLE,
}
