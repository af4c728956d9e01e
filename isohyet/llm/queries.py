"""Queries of this subpackage, by name, and the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from importlib import import_module

from .oracles import SQL

#: query: module that has it
MODULES = {
    "op1_url_filters": "url_filters",
    "op2_nearest_neighbours": "nearest",
    "op3_substring_dedup": "substring_dedup",
    "op4_quality_classifier": "quality",
    "op5_packing": "packing",
    "op6_sharding": "sharding",
    "op7_sentencepiece": "sentencepiece_codec",
    "op8_ngram_jaccard_join": "jaccard_join",
    "op9_suffix_array_dedup": "suffix_dedup",
    "op10_document_fingerprints": "fingerprints",
}


def queries() -> dict:
    return {name: getattr(import_module(f"{__package__}.{module}"), name) for name, module in MODULES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
