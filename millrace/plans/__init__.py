"""Queries of the engine by domain."""

from __future__ import annotations

import importlib

MODULES = ("stocks", "contracts", "bills", "lobbying", "finance", "news", "landing", "reports", "streams", "extensions")


def load():
    """Import the modules, which registers their queries."""
    for m in MODULES:
        importlib.import_module(f"{__name__}.{m}")
    from .registry import QUERIES, SQL

    return QUERIES, SQL
