"""Queries of this subpackage and the SQL of those that SQL can express."""

from __future__ import annotations

import corpus_pipeline
from fleetpulse.llm import bpe, context_mixing, decontam, exact_dedup, licenses, merkle, near_dedup, pieces, quality, toxicity, urls, warc, whitening


def queries() -> dict:
    return {
        "op1_url_markov": urls.q_url_markov,
        "op2_warc_merge": warc.q_warc,
        "op3_context_mixing": context_mixing.q_context_mixing,
        "op4_license_scan": licenses.q_licenses,
        "op5_compression_quality": quality.q_quality,
        "op6_chosen_path": near_dedup.q_near_dedup,
        "op7_byte_bpe": bpe.q_byte_bpe,
        "op8_winnowing": decontam.q_winnowing,
        "op9_exact_dedup": exact_dedup.q_exact_dedup,
        "op10_ordinal_toxicity": toxicity.q_toxicity,
        "op11_bidiagonal_whitening": whitening.q_whitening,
        "op12_sentencepiece": pieces.q_pieces,
        "op13_merkle_manifest": merkle.q_merkle,
        "pipeline": corpus_pipeline.run,
    }


def oracle_sql() -> dict[str, str]:
    return {"op2_warc_merge": warc.SQL, "op8_winnowing": decontam.SQL, "op9_exact_dedup": exact_dedup.SQL, "op13_merkle_manifest": merkle.SQL}
