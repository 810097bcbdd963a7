"""The registered queries of this folder and their SQL."""

from __future__ import annotations

from spendlens.llm import (
    decontaminate, extract, fill_middle, language, licences, mixing, near_dedup, neighbours, resampling, simhash, token_counts, token_output, toxicity,
)

QUERIES = {
    "op10_token_counts": token_counts.query,
    "op1_licence_scan": licences.query,
    "op6_html_extraction": extract.query,
    "op7_language": language.query,
    "op5_simhash": simhash.query,
    "op4_mixing": mixing.query,
    "op3_toxicity": toxicity.query,
    "op2_decontamination": decontaminate.query,
    "op8_token_output": token_output.query,
    "op9_minhash_near_dedup": near_dedup.query,
    "op11_resampling": resampling.query,
    "op12_nearest_neighbours": neighbours.query,
    "op13_fill_in_middle": fill_middle.query,
}

ORACLE_SQL = {
    "op1_licence_scan": licences.sql(),
    "op4_mixing": mixing.sql(),
    "op2_decontamination": decontaminate.SQL,
    "op9_minhash_near_dedup": near_dedup.SQL,
    "op13_fill_in_middle": fill_middle.SQL,
}
