"""Registered queries with the SQL that checks them."""

from __future__ import annotations

import importlib

FAMILIES = (
    "association",
    "cleaning",
    "aggregates",
    "evaluation",
    "scorecard",
    "preparation",
    "sources",
    "stream",
    "graphs",
    "mining",
    "training",
)


def load():
    from linkscore.catalog import registry

    for name in FAMILIES:
        importlib.import_module(f"linkscore.catalog.{name}")
    return registry.QUERIES, registry.ORACLES
