"""The queries of this package, by name, and the SQL of those that SQL can express."""

from __future__ import annotations

from . import decontamination, fill_in_middle, line_dedup, media, packing, pii, quality_rules, simhash, suffix_dedup, token_archive, toxicity, warc, whitening


def queries() -> dict:
    return {"op1_token_archive": token_archive.query, "op2_warc": warc.query, "op3_line_dedup": line_dedup.query, "op4_suffix_dedup": suffix_dedup.query, "op5_packing": packing.query, "op6_toxicity": toxicity.query, "op7_decontamination": decontamination.query, "op8_simhash": simhash.query, "op9_media": media.query, "op10_pii": pii.query, "op11_whitening": whitening.query, "op12_fill_in_middle": fill_in_middle.query, "op13_quality_rules": quality_rules.query}


def oracle_sql() -> dict[str, str]:
    return {"op2_warc": warc.ORACLE, "op3_line_dedup": line_dedup.ORACLE, "op7_decontamination": decontamination.ORACLE}
