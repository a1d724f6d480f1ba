"""Small plan helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _fill(df: DataFrame, keys, day: str, order, col: str, out: str, forward: bool) -> DataFrame:
    """Nearest non-NULL ``col`` at-or-before (forward) / at-or-after (backward) each row within ``keys``.

    Window partitions are (keys, day), so none holds more than one day of one key; what a day cannot answer
    comes from a per-(key, day) summary carried across days by a window over the small day table. Backward is
    forward in the reversed order: a frame that ends at the last row would be read again for every row.
    """
    from pyspark.sql import Window

    order_s = F.struct(*[F.col(o) for o in order])
    to = (lambda c: F.col(c).asc()) if forward else (lambda c: F.col(c).desc())
    w = Window.partitionBy(*keys, day).orderBy(*[to(o) for o in order])
    in_day = F.last(col, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    summary = (F.max_by if forward else F.min_by)(F.col(col), F.when(F.col(col).isNotNull(), order_s))
    wd = Window.partitionBy(*keys).orderBy(to(day)).rowsBetween(Window.unboundedPreceding, -1)
    carry = F.last("_d", ignorenulls=True).over(wd)
    days = df.groupBy(*keys, day).agg(summary.alias("_d"))
    carried = days.select(*keys, day, carry.alias("_carry"))
    return (df.withColumn("_in", in_day).join(carried, [*keys, day], "left")
            .withColumn(out, F.coalesce(F.col("_in"), F.col("_carry"))).drop("_in", "_carry"))


def fill_forward(df: DataFrame, keys, day: str, order, col: str, out: str) -> DataFrame:
    return _fill(df, keys, day, order, col, out, True)


def fill_backward(df: DataFrame, keys, day: str, order, col: str, out: str) -> DataFrame:
    return _fill(df, keys, day, order, col, out, False)


def fill_forward_many(df: DataFrame, keys, day: str, order, cols: list[str]) -> DataFrame:
    """``fill_forward`` of several columns at once, in place: one window inside (keys, day), one over the days."""
    from pyspark.sql import Window

    order_s = F.struct(*[F.col(o) for o in order])
    w = Window.partitionBy(*keys, day).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    wd = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, -1)
    days = df.groupBy(*keys, day).agg(*[F.max_by(F.col(c), F.when(F.col(c).isNotNull(), order_s)).alias(c) for c in cols])
    carried = days.select(*keys, day, *[F.last(c, ignorenulls=True).over(wd).alias(f"_c_{c}") for c in cols])
    inside = df.select(*[c for c in df.columns if c not in cols], *[F.last(c, ignorenulls=True).over(w).alias(c) for c in cols])
    j = inside.join(carried, [*keys, day], "left")
    return j.select(*[c for c in df.columns if c not in cols], *[F.coalesce(c, f"_c_{c}").alias(c) for c in cols])


def spread_groups(df: DataFrame, *keys: str) -> DataFrame:
    """Hash-partition by the group keys into an explicit number of partitions before a grouped pandas step.

    AQE coalesces small shuffles (right for JVM operators), which would run all Python groups in one or two
    tasks; an explicit partition count is kept by AQE, and the following ``groupBy(keys)`` reuses this
    partitioning (no second shuffle). The count is the larger of the session's shuffle partitions and twice
    the cluster's default parallelism.
    """
    spark = df.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 2 * spark.sparkContext.defaultParallelism)
    return df.repartition(n, *keys)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write to the shared scratch folder and read back."""
    from acoustispark.session import scratch_path
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
