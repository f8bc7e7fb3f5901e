"""Merge of all registered queries and their oracle SQL."""

from __future__ import annotations

import importlib

MODULES = ["core", "dictionary", "cube", "store", "explore", "quality", "analytics", "trailing", "books", "mixed_books", "folders"]


def _mods():
    return [importlib.import_module(f"panelkit.registry.{m}") for m in MODULES]


def all_queries():
    out = {}
    for m in _mods():
        out.update(m.QUERIES)
    return out


def all_oracle():
    out = {}
    for m in _mods():
        out.update(m.ORACLE)
    return out
