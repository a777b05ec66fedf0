"""Queries of the operators: name -> (build, oracle SQL or None)."""

from __future__ import annotations

from tidemark.llm import bpe, decontaminate, hardnegatives, langid, lm, neighbours, packing, periodic, pii, quality, simhash, suffixes, urlfilter

QUERIES = {
    "op1_pii": (pii.query, None),
    "op2_url_filter": (urlfilter.query, urlfilter.SQL),
    "op3_packing": (packing.query, None),
    "op4_bpe": (bpe.query, None),
    "op5_simhash": (simhash.query, None),
    "op6_quality_rules": (quality.query, None),
    "op7_repeated_passages": (suffixes.query, None),
    "op8_language_id": (langid.query, None),
    "op9_lm_scores": (lm.query, None),
    "op10_decontamination": (decontaminate.query, None),
    "op11_neighbours": (neighbours.query, None),
    "op12_periodic_runs": (periodic.query, None),
    "op13_hard_negatives": (hardnegatives.query, hardnegatives.SQL),
}
