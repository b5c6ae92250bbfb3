"""Queries of the text operators and their SQL, as ``__spark_entry__`` registers them."""

from __future__ import annotations

from ledgerhawk.llm import cdc, chat, decontam, glr, licenses, merkle, pfp, pii, quality, simhash, toxicity, viterbi, warc

QUERIES = {
    "op1_role_repair": chat.op1,
    "op2_prefix_free_parsing": pfp.op2,
    "op3_pii_candidates": pii.op3,
    "op4_toxic_segments": toxicity.op4,
    "op5_benchmark_decontamination": decontam.op5,
    "op6_quality_rules": quality.op6,
    "op7_sentencepiece": viterbi.op7,
    "op8_content_defined_chunks": cdc.op8,
    "op9_simhash_near_dedup": simhash.op9,
    "op10_legacy_archives": warc.op10,
    "op11_glr_repair": glr.op11,
    "op12_merkle_manifest": merkle.op12,
    "op13_license_join": licenses.op13,
}
ORACLE = {
    "op5_benchmark_decontamination": decontam.ORACLE,
    "op10_legacy_archives": warc.ORACLE,
    "op11_glr_repair": glr.ORACLE,
    "op12_merkle_manifest": merkle.ORACLE,
    "op13_license_join": licenses.ORACLE,
}
