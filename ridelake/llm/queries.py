"""The registered queries of the subpackage and their DuckDB statements."""

from __future__ import annotations

from . import oracle
from .byte_bpe import op11_byte_bpe
from .decontam import op3_spaced_seed_decontam
from .fill_middle import op12_fill_in_middle
from .licenses import op5_license_scan
from .lm_scoring import op8_masked_lm_scores
from .merkle import op13_merkle_manifest
from .packing import op1_vector_packing
from .quality_classifier import op10_weak_label_classifier
from .quality_rules import op6_compression_bands
from .sharding import op9_shard_documents
from .simhash import op2_simhash_near_dedup
from .suffix_dedup import op4_suffix_dedup
from .url_filter import op7_url_filter

QUERIES = {
    "op1_vector_packing": op1_vector_packing,
    "op2_simhash_near_dedup": op2_simhash_near_dedup,
    "op3_spaced_seed_decontam": op3_spaced_seed_decontam,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_compression_bands": op6_compression_bands,
    "op7_url_filter": op7_url_filter,
    "op8_masked_lm_scores": op8_masked_lm_scores,
    "op9_shard_documents": op9_shard_documents,
    "op10_weak_label_classifier": op10_weak_label_classifier,
    "op11_byte_bpe": op11_byte_bpe,
    "op12_fill_in_middle": op12_fill_in_middle,
    "op13_merkle_manifest": op13_merkle_manifest,
}

ORACLE = oracle.ORACLE
