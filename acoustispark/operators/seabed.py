"""Seabed detection and masking on ping rows.

Detection adds ``seabed_depth`` to every ping (NULL without a line). The maxSv / deltaSv / composite rules and the
morphological variant are our definitions [def] (the methods are named, not specified, by the processing configuration);
the split-beam variant follows Blackwell et al. 2019 in a simplified form. Work along the range happens inside a row,
work along time in a window over the pings of one channel of a segment, the mask inside a row: nothing is joined. With
``regions`` the two mask methods keep connected regions only (``operators.regions``), which joins rows of runs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from acoustispark.operators import regions as rg
from acoustispark.operators.pings import let, median, segment_keys, with_ping_index


def _valid(max_range: float, depth_col: str) -> Column:
    """Present samples within ``max_range`` as ``struct(sv, depth)``, in range order."""
    z = F.zip_with("sv", depth_col, lambda s, d: F.struct(s.alias("sv"), d.alias("d")))
    return F.filter(z, lambda x: x["sv"].isNotNull() & (x["d"] <= F.lit(max_range)))


def _pings_around(df: DataFrame, half: int):
    return Window.partitionBy(*segment_keys(df), "channel").orderBy("ping_time").rowsBetween(-half, half)


def _shallowest(mask: Column, depth_col: str) -> Column:
    return F.array_min(F.zip_with(mask, depth_col, lambda m, d: F.when(m, d)))


def _maxsv(max_range: float, threshold: float, depth_col: str) -> Column:
    best = F.array_max(F.transform(_valid(max_range, depth_col), lambda x: F.struct(x["sv"].alias("sv"), (-x["d"]).alias("nd"))))
    return F.when(best["sv"] > F.lit(threshold), -best["nd"])


def _deltasv(max_range: float, delta: float, depth_col: str) -> Column:
    v = _valid(max_range, depth_col)
    jumps = F.zip_with(v, F.slice(v, 2, F.greatest(F.size(v), F.lit(1))), lambda a, b: F.when(b["sv"] - a["sv"] > F.lit(delta), b["d"]))
    return F.array_min(jumps)


def maxsv(pings: DataFrame, max_range: float = 1000.0, threshold: float = -40.0, depth_col: str = "depth") -> DataFrame:
    """Depth of the strongest sample of each ping within ``max_range``, when it is stronger than ``threshold``;
    ties go to the shallowest sample."""
    return pings.withColumn("seabed_depth", _maxsv(max_range, threshold, depth_col))


def deltasv(pings: DataFrame, max_range: float = 1000.0, delta: float = 20.0, depth_col: str = "depth") -> DataFrame:
    """Shallowest sample whose Sv exceeds the previous (shallower) valid sample by more than ``delta`` dB."""
    return pings.withColumn("seabed_depth", _deltasv(max_range, delta, depth_col))


def ariza(pings: DataFrame, threshold: float = -60.0, erode_samples: int = 1, dilate_pings: int = 1,
          max_range: float = 1000.0, depth_col: str = "depth", regions: bool = False) -> DataFrame:
    """Morphological variant: mask ``sv > threshold``; erosion along range (minimum of the mask over
    +-``erode_samples``), then dilation across pings (maximum over +-``dilate_pings`` at the same range sample);
    the line is the shallowest masked sample of each ping. With ``regions`` it is the shallowest sample of the channel's largest
    connected region (most pings): fish and bubbles above the bottom are smaller regions of their own [def]."""
    in_range = F.filter(F.zip_with("sv", depth_col, lambda s, d: F.struct(s.alias("sv"), d.alias("d"))), lambda x: x["d"] <= F.lit(max_range))
    s = pings.withColumn("_z", in_range).withColumn("_m", F.transform("_z", lambda x: F.coalesce(x["sv"] > F.lit(threshold), F.lit(False))))

    def eroded(m: Column, i: Column) -> Column:
        out = m
        for k in range(1, erode_samples + 1):
            out = out & F.coalesce(F.get("_m", i + k), F.lit(True)) & F.when(i < k, F.lit(True)).otherwise(F.coalesce(F.get("_m", i - k), F.lit(True)))
        return out

    s = s.withColumn("_e", F.transform("_m", eroded))
    s = s.withColumn("_w", F.collect_list("_e").over(_pings_around(s, dilate_pings)))
    grown = F.transform("_e", lambda e, i: F.exists("_w", lambda x: F.coalesce(F.get(x, i), F.lit(False))))
    if regions:
        s = with_ping_index(s).withColumn("_g", grown)
        s = s.withColumn("_r", F.transform(rg.runs(F.col("_g")), lambda r: F.struct(r["a"].alias("a"), r["b"].alias("b"), F.get("_z", r["a"])["d"].alias("d"))))
        keys = [*segment_keys(s), "channel"]
        return rg.with_line(pings, rg.largest(rg.label_regions(s, "_r", ["d"]), keys), "d")
    line = F.array_min(F.zip_with(grown, "_z", lambda m, x: F.when(m, x["d"])))
    return s.withColumn("seabed_depth", line).drop("_z", "_m", "_e", "_w")


def composite(pings: DataFrame, max_range: float = 1000.0, threshold: float = -40.0, delta: float = 20.0,
              depth_col: str = "depth") -> DataFrame:
    """The shallower of the maxSv and deltaSv lines where both exist, else the one present."""
    return pings.withColumn("seabed_depth", F.least(_maxsv(max_range, threshold, depth_col), _deltasv(max_range, delta, depth_col)))


def blackwell(pings: DataFrame, angle_threshold: float = 2.0, half_pings: int = 2, half_samples: int = 2,
              max_range: float = 1000.0, depth_col: str = "depth", regions: bool = False) -> DataFrame:
    """Split-beam variant [lit: Blackwell et al. 2019, simplified]: a sample is a candidate when the mean squared
    along+athwart angle over a (2*half_pings+1) x (2*half_samples+1) frame exceeds ``angle_threshold`` squared and
    its Sv exceeds the median Sv of all candidates of the same ping; the line is the shallowest candidate.
    With ``regions``, connected regions of Sv above that median count where an angle candidate lies in them, and the line
    is their shallowest sample. Needs ``angle_alongship``/``angle_athwartship``: without them it is an error, which a job records as a status."""
    if not {"angle_alongship", "angle_athwartship"} <= set(pings.columns):
        raise ValueError("seabed method blackwell needs split-beam angles")
    z = F.filter(F.arrays_zip(F.col("sv"), F.col(depth_col).alias("d"), F.col("angle_alongship").alias("al"), F.col("angle_athwartship").alias("at")),
                 lambda x: x["d"] <= F.lit(max_range))
    s = pings.withColumn("_z", z).withColumn("_a2", F.transform("_z", lambda x: x["al"] * x["al"] + x["at"] * x["at"]))

    def mean(part: Column) -> Column:
        zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).alias("n"))
        return F.aggregate(part, zero, lambda acc, x: F.when(x.isNull(), acc).otherwise(F.struct((acc["s"] + x).alias("s"), (acc["n"] + 1).alias("n"))),
                           lambda acc: F.when(acc["n"] > 0, acc["s"] / acc["n"]))

    first = lambda i: F.greatest(i - half_samples, F.lit(0))
    s = s.withColumn("_r", F.transform("_a2", lambda a, i: mean(F.slice("_a2", first(i) + 1, i + half_samples + 1 - first(i)))))
    s = s.withColumn("_w", F.collect_list("_r").over(_pings_around(s, half_pings)))
    s = s.withColumn("_f", F.transform("_r", lambda r, i: mean(F.transform("_w", lambda x: F.get(x, i))) > F.lit(angle_threshold ** 2)))
    s = s.withColumn("_k", F.zip_with("_f", "_z", lambda f, x: F.when(f, x)))
    s = s.withColumn("_med", median(F.transform("_k", lambda x: x["sv"])))
    if regions:
        s = with_ping_index(s).withColumn("_g", F.transform("_z", lambda x: F.coalesce(x["sv"] > F.col("_med"), F.lit(False))))
        s = s.withColumn("_q", F.transform(rg.runs(F.col("_g")), lambda r: F.struct(
            r["a"].alias("a"), r["b"].alias("b"), F.get("_z", r["a"])["d"].alias("d"),
            F.exists(F.slice("_f", r["a"] + 1, r["b"] - r["a"] + 1), lambda f: F.coalesce(f, F.lit(False))).alias("hit"))))
        return rg.with_line(pings, rg.touched(rg.label_regions(s, "_q", ["d", "hit"]), "hit"), "d")
    # the optimiser puts the median where its name stands: inside the lambda it would be found anew for every sample
    line = let(F.col("_med"), lambda med: F.array_min(F.transform("_k", lambda x: F.when(x["sv"] > med, x["d"]))))
    return s.withColumn("seabed_depth", line).drop("_z", "_a2", "_r", "_w", "_f", "_k", "_med")


# Method names as the configuration writes them; compared without regard to case.
METHODS = {"maxsv": maxsv, "deltasv": deltasv, "ariza": ariza, "composite": composite, "blackwell": blackwell}


def detect_seabed(pings: DataFrame, method: str = "ariza", max_range: float = 1000.0, **kw) -> DataFrame:
    """Add ``seabed_depth`` by the named method (``maxSv`` and ``maxsv`` are the same name)."""
    found = METHODS.get((method or "").strip().lower())
    if found is None:
        raise ValueError(f"unknown seabed method: {method}")
    return found(pings, max_range=max_range, **kw)


def mask_seabed(pings: DataFrame, depth_col: str = "depth") -> DataFrame:
    """Samples at or below ``seabed_depth`` become missing; pings without a line are unchanged."""
    keep = lambda s, d: F.when(F.col("seabed_depth").isNull() | (d < F.col("seabed_depth")), s)
    return pings.withColumn("sv", F.zip_with("sv", depth_col, keep))
