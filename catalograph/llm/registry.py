"""Queries of the training-data operators and their SQL twins."""

from __future__ import annotations

import importlib

MODULES = ("toxicity_queries", "warc_queries", "token_count_queries", "near_duplicate_queries", "piece_queries", "neighbour_queries", "fingerprint_queries", "pii_queries", "packing_queries",
           "quality_queries", "byte_pair_queries", "conversation_trie_queries",
           "centroid_queries")


def load() -> tuple[dict, dict]:
    queries: dict = {}
    oracles: dict = {}
    for name in MODULES:
        module = importlib.import_module(f"catalograph.llm.{name}")
        queries |= module.QUERIES
        oracles |= module.ORACLES
    pipeline = importlib.import_module("corpus_pipeline")
    queries["pipeline"] = pipeline.run
    if pipeline.ORACLE_SQL:
        oracles["pipeline"] = pipeline.ORACLE_SQL
    return queries, oracles
