"""All registered queries and their oracle SQL."""

from __future__ import annotations

import importlib

DOMAINS = ["olap", "quality", "cadence", "text", "events", "concentration", "planning", "facts"]


def _modules():
    return [importlib.import_module(f"flowcube.plans.{d}") for d in DOMAINS]


def queries():
    out = {}
    for m in _modules():
        out.update(m.QUERIES)
    return out


def oracle_sql():
    out = {}
    for m in _modules():
        out.update(m.ORACLE)
    return out
