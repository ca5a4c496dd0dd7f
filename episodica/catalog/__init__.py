"""Registered queries by operator id; see ``registry``."""

from __future__ import annotations

import importlib

MODULES = ("statistics", "splits", "merging", "evaluation", "checkpoints", "files", "validation")


def _load():
    from episodica.catalog import registry

    for name in MODULES:
        importlib.import_module(f"episodica.catalog.{name}")
    return registry


def queries():
    return dict(_load().QUERIES)


def oracles():
    return dict(_load().ORACLES)
