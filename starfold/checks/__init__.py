"""Registered queries with their reference SQL."""

from __future__ import annotations

import importlib
import pkgutil


def load_all():
    """(queries, oracle SQL) of every check module."""
    from .registry import ORACLES, QUERIES
    for m in pkgutil.iter_modules(__path__):
        importlib.import_module(f"{__name__}.{m.name}")
    return QUERIES, ORACLES
