"""Registered queries of this subpackage and their DuckDB SQL where it can express them."""
from __future__ import annotations

from . import (decontamination, fingerprints, hmm_scoring, language_id, ngram_join, packing, periodic_runs, piece_coding, pii, quality,
               token_counts, url_filter, whitening)
from .common import shipped


def registered() -> dict:
    queries = {
        "op10_hmm_scoring": hmm_scoring.op10_hmm_scoring,
        "op11_whitening": whitening.op11_whitening,
        "op12_periodic_runs": periodic_runs.op12_periodic_runs,
        "op13_piece_coding": piece_coding.op13_piece_coding,
        "op1_decontamination": decontamination.op1_decontamination,
        "op2_quality": quality.op2_quality,
        "op3_ngram_join": ngram_join.op3_ngram_join,
        "op4_packing": packing.op4_packing,
        "op5_fingerprints": fingerprints.op5_fingerprints,
        "op6_pii": pii.op6_pii,
        "op7_language_id": language_id.op7_language_id,
        "op8_url_filter": url_filter.op8_url_filter,
        "op9_token_counts": token_counts.op9_token_counts,
    }
    return {name: shipped(query) for name, query in queries.items()}


def sql() -> dict[str, str]:
    return {"op8_url_filter": url_filter.SQL}
