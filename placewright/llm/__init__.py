"""Operators for large training-text corpora; nothing else of the library imports them."""

from __future__ import annotations

from importlib import import_module

#: Modules with QUERIES (name -> function of session and data folder) and ORACLES (name -> DuckDB SQL).
MODULES = ["ngram_join", "suffix_dedup", "media", "mixing", "piece_codec", "url_lists", "warc", "knn", "language_id", "sharding"]


def queries() -> dict:
    return {k: v for m in MODULES for k, v in import_module(f"placewright.llm.{m}").QUERIES.items()}


def oracles() -> dict:
    return {k: v for m in MODULES for k, v in import_module(f"placewright.llm.{m}").ORACLES.items()}
