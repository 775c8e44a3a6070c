"""Queries of this subpackage and their SQL, for the entry module."""

from __future__ import annotations

from . import divergence, jaccard, linededup, mixing, pieces, quality, resample, sharding, simhash, substrings, tokencounts, topk, toxicity


def queries() -> dict:
    return {
        "op1_sharding": sharding.op1_sharding,
        "op2_jaccard": jaccard.op2_jaccard,
        "op3_quality": quality.op3_quality,
        "op4_tokencounts": tokencounts.op4_tokencounts,
        "op5_topk": topk.op5_topk,
        "op6_toxicity": toxicity.op6_toxicity,
        "op7_lines": linededup.op7_lines,
        "op8_substrings": substrings.op8_substrings,
        "op9_pieces": pieces.op9_pieces,
        "op10_mixing": mixing.op10_mixing,
        "op11_divergence": divergence.op11_divergence,
        "op12_resample": resample.op12_resample,
        "op13_simhash": simhash.op13_simhash,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard": jaccard.OP2_SQL, "op5_topk": topk.OP5_SQL, "op7_lines": linededup.OP7_SQL, "op10_mixing": mixing.op10_sql(), "op11_divergence": divergence.OP11_SQL, "op12_resample": resample.OP12_SQL}
