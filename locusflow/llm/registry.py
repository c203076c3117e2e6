"""The dealt queries: name -> (Spark function, DuckDB SQL or None)."""

from __future__ import annotations

REGISTRY: dict = {}


def query(name: str, sql: str | None = None):
    def add(fn):
        REGISTRY[name] = (fn, sql)
        return fn
    return add


def documents(spark, sf_dir: str):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def table(spark, sf_dir: str, name: str):
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
