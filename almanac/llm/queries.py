"""The subpackage's queries by name, and their SQL where SQL can express them."""

from __future__ import annotations

from almanac.llm import decontaminate, fingerprint, license_scan, line_dedup, near_dup, packing, quality, sql, substring_dedup, suffix_dedup, toxicity

QUERIES = {
    "op1_license_scan": license_scan.op1,
    "op2_packing": packing.op2,
    "op3_decontaminate": decontaminate.op3,
    "op4_substring_dedup": substring_dedup.op4,
    "op5_suffix_dedup": suffix_dedup.op5,
    "op6_near_dup": near_dup.op6,
    "op7_toxicity": toxicity.op7,
    "op8_quality": quality.op8,
    "op9_fingerprint": fingerprint.op9,
    "op10_line_dedup": line_dedup.op10,
}
ORACLE_SQL = sql.ORACLE_SQL
