"""Queries of this subpackage by name."""

from __future__ import annotations

from .curves import op7_hilbert_neighbours
from .minhash import op3_document_fingerprints
from .mixing import op6_mix_sources
from .packing import op4_best_fit_packing
from .passages import op10_compact_windows
from .secrets import op5_secret_scan
from .simhash import op1_simhash_near_dedup
from .suffix_dedup import op9_suffix_array_dedup
from .suffix_tree_lm import op2_suffix_tree_lm
from .toxicity import op8_toxicity_chain

QUERIES = {
    "op1_simhash_near_dedup": op1_simhash_near_dedup,
    "op2_suffix_tree_lm": op2_suffix_tree_lm,
    "op3_document_fingerprints": op3_document_fingerprints,
    "op4_best_fit_packing": op4_best_fit_packing,
    "op5_secret_scan": op5_secret_scan,
    "op6_mix_sources": op6_mix_sources,
    "op7_hilbert_neighbours": op7_hilbert_neighbours,
    "op8_toxicity_chain": op8_toxicity_chain,
    "op9_suffix_array_dedup": op9_suffix_array_dedup,
    "op10_compact_windows": op10_compact_windows,
}
SQL: dict[str, str] = {}


def pipeline(spark, sf_dir):
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES["pipeline"] = pipeline
