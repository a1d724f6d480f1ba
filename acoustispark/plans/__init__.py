"""Registered named queries: ``name -> (spark_fn(spark, sf_dir) -> DataFrame, duckdb_sql | None)``.

Each query reads the supplied tables (or views Spark derives from them) and runs an operator of the
library over the whole of them. The SQL is the DuckDB oracle for the same result.
"""

from __future__ import annotations

import importlib

MODULES = ["grids", "calibration", "tracks", "cleaning", "summaries", "scalars", "control", "streams", "io", "stores", "live"]


def registry() -> dict:
    out: dict = {}
    for m in MODULES:
        mod = importlib.import_module(f"acoustispark.plans.{m}")
        for k, v in mod.REGISTRY.items():
            if k in out:
                raise ValueError(f"duplicate query name {k}")
            out[k] = v
    return out
