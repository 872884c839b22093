"""Registered queries over the scale-factor tables, each with its SQL twin."""

from __future__ import annotations

import importlib

_MODULES = ["text", "cardinality", "evaluation", "lsh", "graph", "streams", "reshape"]


def registry():
    queries, oracles = {}, {}
    for name in _MODULES:
        mod = importlib.import_module(f"tessera.plans.{name}")
        queries.update(mod.QUERIES)
        oracles.update(mod.ORACLES)
    return queries, oracles
