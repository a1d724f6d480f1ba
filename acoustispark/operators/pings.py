"""The ping grain: one row per (platform, segment, channel, ping) with the samples as arrays.

Element ``i`` of every array belongs to range sample ``i`` (missing samples are NULL elements). Operators that look along
the range work inside a row; operators that look along time use windows over pings, which all share one partitioning
by segment, so a chain of them shuffles once and joins nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

#: Sample-level columns, when present.
ARRAYS = ("sv", "echo_range", "depth", "angle_along", "angle_athwart", "angle_alongship", "angle_athwartship", "range_axis")


def segment_keys(df: DataFrame) -> tuple[str, ...]:
    """Columns that identify a segment: its name repeats between platforms, and between days where a day is known."""
    return tuple(c for c in ("platform", "day", "segment") if c in df.columns)


def array_columns(df: DataFrame) -> list[str]:
    return [c for c in ARRAYS if c in df.columns]


def to_pings(samples: DataFrame) -> DataFrame:
    """Long samples -> ping rows. Range samples that have no row become NULL elements."""
    arrays = array_columns(samples)
    keys = [c for c in samples.columns if c not in arrays and c != "range_sample"]
    one = F.struct("range_sample", *arrays)
    grouped = samples.groupBy(*keys).agg(F.array_sort(F.collect_list(one)).alias("_a"), (F.max("range_sample") + 1).alias("_n"))
    dense = F.when(F.size("_a") == F.col("_n"), F.col("_a")).otherwise(F.transform(
        F.sequence(F.lit(0), F.col("_n") - 1), lambda i: F.get(F.filter("_a", lambda x: x["range_sample"] == i), F.lit(0))))
    grouped = grouped.withColumn("_a", dense)
    return grouped.select(*keys, *[F.col("_a")[c].alias(c) for c in arrays])


def to_samples(pings: DataFrame) -> DataFrame:
    """Ping rows -> long samples (``range_sample`` from the array of that name if there is one, else the place)."""
    arrays = array_columns(pings)
    own = "range_sample" in pings.columns
    keys = [c for c in pings.columns if c not in arrays and c != "range_sample"]
    z = F.arrays_zip(*arrays, *(["range_sample"] if own else []))
    out = pings.select(*keys, F.posexplode(z).alias("_i", "_z"))
    i = F.col("_z.range_sample") if own else F.col("_i").cast("int")
    return out.select(*keys, i.alias("range_sample"), *[F.col(f"_z.{c}").alias(c) for c in arrays])


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def median(values: Column) -> Column:
    """Interpolated median of the present elements; NULL without any."""
    def of(s: Column) -> Column:
        n = F.size(s)
        mid = F.floor(n / 2).cast("int")
        return F.when(n % 2 == 1, F.get(s, mid)).otherwise((F.get(s, mid - 1) + F.get(s, mid)) / 2)
    return let(F.array_sort(F.filter(values, lambda x: x.isNotNull())), of)


def bin_sums(items: Column) -> Column:
    """Array of ``struct(b, v)`` -> dense array over bins 0, 1, ... of ``struct(s, n)``; NULL for empty bins.

    Items are sorted by bin and folded once; negative bins are left out.
    """
    empty = F.expr("cast(array() as array<struct<s:double,n:bigint>>)")
    start = F.struct(empty.alias("out"), F.lit(-1).cast("bigint").alias("b"), F.lit(0.0).alias("s"), F.lit(0).cast("bigint").alias("n"))

    def close(acc: Column) -> Column:
        gap = F.expr("cast(null as struct<s:double,n:bigint>)")
        full = F.concat(acc["out"], F.array_repeat(gap, (acc["b"] - F.size(acc["out"])).cast("int")),
                        F.array(F.struct(acc["s"].alias("s"), acc["n"].alias("n"))))
        return F.when(acc["b"] < 0, acc["out"]).otherwise(full)

    def step(acc: Column, x: Column) -> Column:
        same = F.struct(acc["out"].alias("out"), acc["b"].alias("b"), (acc["s"] + x["v"]).alias("s"), (acc["n"] + 1).alias("n"))
        new = F.struct(close(acc).alias("out"), x["b"].alias("b"), x["v"].alias("s"), F.lit(1).cast("bigint").alias("n"))
        return F.when(acc["b"] == x["b"], same).otherwise(new)

    ordered = F.array_sort(F.filter(items, lambda x: x["b"].isNotNull() & x["v"].isNotNull() & (x["b"] >= 0)))
    return F.aggregate(ordered, start, step, close)


def with_ping_index(pings: DataFrame) -> DataFrame:
    """0-based position of the ping within its segment (all channels of a ping share it)."""
    if "ping_index" in pings.columns:
        return pings
    w = Window.partitionBy(*segment_keys(pings)).orderBy("ping_time")
    return pings.withColumn("ping_index", (F.dense_rank().over(w) - 1).cast("long"))


def around(pings: DataFrame, before: int, after: int) -> Window:
    """Frame of the pings ``ping_index - before .. ping_index + after`` of the same channel (numbers, not rows)."""
    return Window.partitionBy(*segment_keys(pings), "channel").orderBy("ping_index").rangeBetween(-before, after)
