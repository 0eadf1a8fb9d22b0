"""Registered queries of the corpus operators and their plain-SQL twins."""

from __future__ import annotations

from holdsift.llm import bpe, htmlmain, linededup, merkle, mixing, neardup, phrases, pii, quality, tokencounts, toxicity, warc, winnow

QUERIES = {
    "op1_pii": pii.op1_pii,
    "op2_mix": mixing.op2_mix,
    "op3_bpe": bpe.op3_bpe,
    "op4_near_duplicates": neardup.op4_near_duplicates,
    "op5_warc_derivatives": warc.op5_warc_derivatives,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_fingerprints": winnow.op7_fingerprints,
    "op8_main_text": htmlmain.op8_main_text,
    "op9_quality": quality.op9_quality,
    "op10_line_dedup": linededup.op10_line_dedup,
    "op11_collocations": phrases.op11_collocations,
    "op12_token_counts": tokencounts.op12_token_counts,
    "op13_merkle": merkle.op13_merkle,
}

SQL = {
    "op2_mix": mixing.SQL,
    "op4_near_duplicates": neardup.SQL,
    "op11_collocations": phrases.SQL,
    "op13_merkle": merkle.SQL,
}
