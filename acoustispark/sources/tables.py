"""Scans of the supplied parquet tables.

Every double/float column is projected through ``NaN -> NULL`` at the scan, so all operators can treat
NULL as the single "missing" marker (Spark treats NaN as a value: it counts it and averages it).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def nan_to_null(df: DataFrame) -> DataFrame:
    """Replace NaN by NULL in every floating column (top level and float arrays)."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(~F.isnan(c), c).alias(f.name)
        elif isinstance(f.dataType, T.ArrayType) and isinstance(f.dataType.elementType, (T.DoubleType, T.FloatType)):
            c = F.transform(c, lambda x: F.when(~F.isnan(x), x)).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """``spark.read.parquet`` of one supplied table with the NaN->NULL projection on top.

    The projection is a plain Project, so Catalyst still prunes columns and pushes filters into the scan.
    """
    return nan_to_null(spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet"))
