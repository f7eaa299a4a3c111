"""Registered queries of the training-data operators, and their SQL where SQL can say it."""

from __future__ import annotations

from marketlens.llm.byte_pairs import op13_byte_pairs
from marketlens.llm.decontamination import op9_decontamination
from marketlens.llm.language_id import op7_language_id
from marketlens.llm.license_scan import op2_license_scan
from marketlens.llm.ngram_join import op5_ngram_jaccard
from marketlens.llm.oracles import ORACLES
from marketlens.llm.packing import op8_length_buckets
from marketlens.llm.quality_rules import op3_quality_rules
from marketlens.llm.spelling_variants import op12_spelling_variants
from marketlens.llm.substring_dedup import op4_substring_dedup
from marketlens.llm.suffix_array_dedup import op10_suffix_array_dedup
from marketlens.llm.token_counts import op1_token_counts
from marketlens.llm.warc import op6_warc_index
from marketlens.llm.whitening import op11_whitening

QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_license_scan, op3_quality_rules, op4_substring_dedup, op5_ngram_jaccard,
    op6_warc_index, op7_language_id, op8_length_buckets, op9_decontamination, op10_suffix_array_dedup,
    op11_whitening, op12_spelling_variants, op13_byte_pairs)}

__all__ = ["ORACLES", "QUERIES"]
