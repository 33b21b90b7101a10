"""The queries of this subpackage and the SQL that must agree with them."""

from __future__ import annotations

import corpus_pipeline
from trackmill.llm import (
    decontaminate,
    language,
    line_dedup,
    merkle,
    neighbours,
    ngram_join,
    packing,
    periodic,
    quality,
    suffix,
    toxicity,
    warc,
    wavelet,
)

QUERIES = {
    "op5_neighbours": neighbours.op5_neighbours,
    "op6_toxicity": toxicity.op6_toxicity,
    "op7_decontaminate": decontaminate.op7_decontaminate,
    "op4_line_dedup": line_dedup.op4_line_dedup,
    "op3_ngram_join": ngram_join.op3_ngram_join,
    "op1_suffix": suffix.op1_suffix,
    "op2_wavelet": wavelet.op2_wavelet,
    "op8_packing": packing.op8_packing,
    "op9_quality": quality.op9_quality,
    "op10_warc": warc.op10_warc,
    "op11_periodic": periodic.op11_periodic,
    "op12_language": language.op12_language,
    "op13_merkle": merkle.op13_merkle,
    "pipeline": corpus_pipeline.run,
}

ORACLES = {
    "op10_warc": warc.OP10_SQL,
    "op11_periodic": periodic.OP11_SQL,
    "op13_merkle": merkle.OP13_SQL,
}
