"""The registered queries of this folder and their DuckDB oracles."""

from __future__ import annotations

from strata.llm import (
    decontaminate, exact, fim, importance, langid, licenses, linededup, mixing, packing, pii,
    quality, simhash, toxicity,
)

QUERIES = {
    "op1_language_id": langid.query,
    "op2_pii": pii.query,
    "op3_quality_rules": quality.query,
    "op4_line_dedup": linededup.query,
    "op5_toxicity": toxicity.query,
    "op6_packing": packing.query,
    "op7_simhash": simhash.query,
    "op8_license_scan": licenses.query,
    "op9_mixing": mixing.query,
    "op10_exact_dedup": exact.query,
    "op11_decontamination": decontaminate.query,
    "op12_fill_in_middle": fim.query,
    "op13_importance_resampling": importance.query,
}

ORACLES = {
    "op8_license_scan": licenses.ORACLE,
    "op10_exact_dedup": exact.ORACLE,
    "op11_decontamination": decontaminate.ORACLE,
    "op12_fill_in_middle": fim.ORACLE,
    "op13_importance_resampling": importance.ORACLE,
}
