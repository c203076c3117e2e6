"""Registry of checked queries: name -> (Spark function, DuckDB SQL or None)."""

from __future__ import annotations

REGISTRY: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"duplicate query {name}")
        REGISTRY[name] = (fn, sql)
        return fn
    return add
