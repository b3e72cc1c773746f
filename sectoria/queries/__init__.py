"""Registered queries: each operator on the given tables, with independent SQL where SQL can express it."""

from __future__ import annotations

from importlib import import_module

from .registry import REGISTRY

for _module in ("scores", "profiles", "cleaning", "places", "coverage", "statistics", "sources"):
    import_module(f"{__name__}.{_module}")

__all__ = ["REGISTRY"]
