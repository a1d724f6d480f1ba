"""Gridded products: MVBS, NASC and echogram rasters.

All three are hash aggregations with map-side partial aggregation: the samples table is never shuffled
whole, only one partial row per (task, cell). Bin widths are job parameters (strings with units, as the
configuration writes them: ``"0.5m"``, ``"10s"``, ``"0.5nmi"``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from acoustispark.functions import scalars as fn

SEGMENT_KEYS = ("platform", "segment")


def _seconds(text: str) -> float:
    v, unit = fn.parse_bin(text)
    scale = {"": 1, "s": 1, "S": 1, "min": 60, "T": 60, "h": 3600, "H": 3600}.get(unit)
    if scale is None:
        raise ValueError(f"unsupported time bin unit: {text!r}")
    return v * scale


def _meters(text: str) -> float:
    v, unit = fn.parse_bin(text)
    if unit not in ("", "m"):
        raise ValueError(f"unsupported range bin unit: {text!r}")
    return v


def _nmi(text: str) -> float:
    v, unit = fn.parse_bin(text)
    if unit not in ("", "nmi"):
        raise ValueError(f"unsupported distance bin unit: {text!r}")
    return v


def time_bin_start(ts_col: str, seconds: float):
    """Start of the tumbling window (anchored at the epoch) holding ``ts_col``."""
    return F.window(ts_col, f"{int(seconds * 1_000_000)} microseconds").start


def mvbs(samples: DataFrame, range_bin: str = "0.5m", ping_time_bin: str = "10s",
         keys: tuple[str, ...] = SEGMENT_KEYS + ("channel",), range_col: str = "echo_range") -> DataFrame:
    """Mean volume backscattering strength [lit: MacLennan et al. 2002].

    Cells are half-open ``[a, b)`` bins anchored at the epoch (time) and at 0 m (range) [def]; the mean is taken
    in the linear domain and returned in dB. Missing samples do not count; a cell without any valid sample is
    absent. Output: ``keys, ping_time, <range_col>, sv, n_samples``.
    """
    rb = _meters(range_bin)
    tb = _seconds(ping_time_bin)
    return (samples.where(F.col("sv").isNotNull() & F.col(range_col).isNotNull())
            .groupBy(*keys, time_bin_start("ping_time", tb).alias("ping_time"),
                     F.floor(F.col(range_col) / F.lit(rb)).alias("_rbin"))
            .agg(F.avg(fn.db_to_linear("sv")).alias("_lin"), F.count("sv").alias("n_samples"))
            .select(*keys, "ping_time", (F.col("_rbin") * F.lit(rb)).alias(range_col),
                    fn.linear_to_db("_lin").alias("sv"), "n_samples"))


def ping_distance(pings: DataFrame, keys: tuple[str, ...] = SEGMENT_KEYS, ts: str = "ping_time") -> DataFrame:
    """Cumulative sailed distance (nmi) per ping along the track, 0 at the first located ping of each key.

    ``pings`` holds one row per (keys, ts) with ``lat``/``lon``; the window is bounded by the key (a segment).
    """
    w = Window.partitionBy(*keys).orderBy(ts)
    step = fn.haversine_nmi(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))
    located = pings.where(F.col("lat").isNotNull() & F.col("lon").isNotNull())
    return (located.withColumn("_step", F.coalesce(step, F.lit(0.0)))
            .withColumn("distance", F.sum("_step").over(w.rowsBetween(Window.unboundedPreceding, 0)))
            .drop("_step"))


def nasc(samples: DataFrame, range_bin: str = "10m", dist_bin: str = "0.5nmi",
         keys: tuple[str, ...] = SEGMENT_KEYS, range_col: str = "echo_range") -> DataFrame:
    """Nautical area scattering coefficient per (channel, distance bin, range bin) [lit: MacLennan et al. 2002]:
    ``NASC = 4*pi*1852^2 * mean(sv_linear) * range_bin``, ``NASC_log = 10*log10(NASC)``.

    Samples are pre-aggregated to (ping, range bin) before they meet the per-ping distance table, so the join
    and the final aggregation see (range bins x pings) rows, not samples. Without positions the result is empty.
    """
    rb = _meters(range_bin)
    db = _nmi(dist_bin)
    per_ping = (samples.groupBy(*keys, "ping_time")
                .agg(F.max("lat").alias("lat"), F.max("lon").alias("lon")))
    dist = ping_distance(per_ping, keys).select(*keys, "ping_time", F.floor(F.col("distance") / F.lit(db)).alias("_dbin"))
    cells = (samples.where(F.col("sv").isNotNull() & F.col(range_col).isNotNull())
             .groupBy(*keys, "channel", "ping_time", F.floor(F.col(range_col) / F.lit(rb)).alias("_rbin"))
             .agg(F.sum(fn.db_to_linear("sv")).alias("_lin"), F.count("sv").alias("_n")))
    out = (cells.join(dist, [*keys, "ping_time"])
           .groupBy(*keys, "channel", "_dbin", "_rbin")
           .agg((F.sum("_lin") / F.sum("_n")).alias("_mean"), F.sum("_n").alias("n_samples")))
    nasc_v = F.lit(fn.FOUR_PI_NMI2) * F.col("_mean") * F.lit(rb)
    return out.select(*keys, "channel", (F.col("_dbin") * F.lit(db)).alias("distance"),
                      (F.col("_rbin") * F.lit(rb)).alias(range_col), nasc_v.alias("nasc"),
                      fn.linear_to_db(nasc_v).alias("nasc_log"), "n_samples")
