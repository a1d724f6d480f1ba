"""Helpers shared by the registered queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F, types as T

DIGITS = 6


def rounded(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every floating column to ``digits`` decimals (sums are added in a different order by each engine)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f.name), digits).alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)
