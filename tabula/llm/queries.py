"""Queries of this folder: name -> builder, and the DuckDB SQL where there is one."""

from __future__ import annotations

import corpus_pipeline
from tabula.llm import (chat, exact_dedup, hmm, langid, packing, periodic, quality, secrets, simhash, substrings,
                        tokens, warc, whitening)

QUERIES = {
    "op1_simhash": simhash.op1,
    "op2_exact_dedup": exact_dedup.op2,
    "op3_packing": packing.op3,
    "op4_secrets": secrets.op4,
    "op5_quality": quality.op5,
    "op6_byte_bpe": tokens.op6,
    "op7_hmm_score": hmm.op7,
    "op8_language_id": langid.op8,
    "op9_chat": chat.op9,
    "op10_warc": warc.op10,
    "op11_whitening": whitening.op11,
    "op12_periodic_runs": periodic.op12,
    "op13_substrings": substrings.op13,
}

QUERIES["pipeline"] = corpus_pipeline.run

ORACLES: dict[str, str] = {
    "op2_exact_dedup": exact_dedup.OP2_SQL,
    "op4_secrets": secrets.oracle(),
    "op9_chat": chat.OP9_SQL,
    "op10_warc": warc.OP10_SQL,
}
