"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

import importlib

MODULES = ["ball_tree", "pii", "suffix_dedup", "line_quality", "mixing", "bpe", "jaccard_join", "toxicity", "sharding", "secrets",
           "source_divergence", "periodic_runs", "snapshot_dedup"]


def _modules():
    return [importlib.import_module(f"flowcube.llm.{m}") for m in MODULES]


def queries():
    return {k: v for m in _modules() for k, v in m.QUERIES.items()}


def oracle_sql():
    return {k: v for m in _modules() for k, v in m.ORACLE.items()}
