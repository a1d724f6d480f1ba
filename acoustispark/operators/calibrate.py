"""Calibration and Sv enrichment: channel defaults, the sonar equation, depth, split-beam angles,
empty-ping removal and the echo-range correction.

The sonar equation and split-beam conversion follow Demer et al. 2015 [lit]; the depth projection and the
angle defaults are ours [def].
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from acoustispark.operators.pings import segment_keys

# Fixed values that must equal the reference's behaviour ----------------------------------------------------
# Channel defaults used when the service sends the field missing *or zero* (Python ``x or default``).
CHANNEL_DEFAULTS = {
    "frequency": 200000.0,
    "pulse_length": 0.001024,
    "sample_interval": 0.000016,
    "gain": 25.0,
    "sa_correction": 0.0,
    "equivalent_beam_angle": -20.7,
    "beamwidth_alongship": 7.0,
    "beamwidth_athwartship": 7.0,
}
TRANSDUCER_DEFAULT = "WBT"
# Per-ping defaults, same rule.
PING_DEFAULTS = {
    "transmit_power": 100.0,
    "sound_velocity": 1500.0,
    "absorption_coefficient": 0.0,
}
# -------------------------------------------------------------------------------------------------------------

# split-beam angle conversion: electrical angle counts span 180 degrees over 128 steps [lit]
ANGLE_STEP_DEG = 180.0 / 128.0


def channel_cal(raw_cal: DataFrame) -> DataFrame:
    """Calibration dimension with defaults: a numeric field that is NULL *or 0* takes its default, an empty or
    NULL transducer name becomes ``WBT``. Other columns pass through."""
    out = raw_cal
    for name, d in {**CHANNEL_DEFAULTS, **PING_DEFAULTS}.items():
        if name in raw_cal.columns:
            out = out.withColumn(name, F.coalesce(F.nullif(F.col(name).cast("double"), F.lit(0.0)), F.lit(d)))
        else:
            out = out.withColumn(name, F.lit(d))
    tn = F.col("transducer_name") if "transducer_name" in raw_cal.columns else F.lit(None).cast("string")
    return out.withColumn("transducer_name", F.coalesce(F.nullif(tn, F.lit("")), F.lit(TRANSDUCER_DEFAULT)))


def join_channel_cal(pings: DataFrame, cal: DataFrame) -> DataFrame:
    """Attach per-channel parameters; pings of an unknown channel are dropped (inner join).

    A plain join: Spark's byte threshold and AQE decide how the calibration side travels.
    """
    return pings.join(cal, "channel_id", "inner")


def explode_samples(pings: DataFrame, array_col: str = "samples", value_col: str = "raw") -> DataFrame:
    """Array payload -> one row per range sample (``range_sample`` = 0-based position); split-beam counts beside the
    payload come along."""
    along = [c for c in ("angle_along", "angle_athwart") if c in pings.columns]
    keep = [c for c in pings.columns if c not in (array_col, *along)]
    out = pings.select(*keep, F.posexplode(F.arrays_zip(F.col(array_col).alias(value_col), *along)).alias("range_sample", "_z"))
    return out.select(*keep, F.col("range_sample").cast("int").alias("range_sample"), *[F.col(f"_z.{c}").alias(c) for c in (value_col, *along)])


def sv_from_power(raw, r, c, f, pt, tau, eba, gain, sa, alpha):
    """Sv (dB) of one int16 power sample at range ``r`` [lit: Demer et al. 2015, CW power data].

    ``Pr = raw*10*log10(2)/256``;
    ``Sv = Pr + 20log10(R) + 2*alpha*R - 10log10(Pt*lambda^2*c*tau*psi*G^2/(32*pi^2)) - 2*sa``
    with ``lambda = c/f``, ``psi = 10^(eba/10)``, ``G = 10^(gain/10)``. NULL where R <= 0.
    """
    pr = raw.cast("double") * F.lit(10.0 * math.log10(2.0) / 256.0)
    lam = c / f
    psi = F.pow(F.lit(10.0), eba / F.lit(10.0))
    g = F.pow(F.lit(10.0), gain / F.lit(10.0))
    denom = pt * lam * lam * c * tau * psi * g * g / F.lit(32.0 * math.pi ** 2)
    sv = pr + F.lit(20.0) * F.log10(r) + F.lit(2.0) * alpha * r - F.lit(10.0) * F.log10(denom) - F.lit(2.0) * sa
    return F.when(r > 0, sv)


def compute_sv(pings: DataFrame, cal: DataFrame) -> DataFrame:
    """``pings(platform, channel_id, ping_time, samples ARRAY<SMALLINT>, ...)`` + calibration -> long Sv table
    ``(..., channel_id, ping_time, range_sample, echo_range, sv, frequency_nominal)``.

    Exploding happens after the join, so the join moves one row per ping, not per sample. Split-beam counts stay.
    """
    j = join_channel_cal(pings, cal)
    x = explode_samples(j)
    r = F.col("sound_velocity") * F.col("sample_interval") * F.col("range_sample") / F.lit(2.0)
    x = x.withColumn("echo_range", F.when(r > 0, r))
    sv = sv_from_power(F.col("raw"), F.col("echo_range"), F.col("sound_velocity"), F.col("frequency"),
                       F.col("transmit_power"), F.col("pulse_length"), F.col("equivalent_beam_angle"),
                       F.col("gain"), F.col("sa_correction"), F.col("absorption_coefficient"))
    base = [c for c in pings.columns if c not in ("samples",)]
    extra = [c for c in ("angle_along", "angle_athwart") if c in base]
    base = [c for c in base if c not in extra]
    return x.select(*base, "range_sample", "echo_range", sv.alias("sv"), F.col("frequency").alias("frequency_nominal"), *extra)


def add_depth(pings: DataFrame, depth_offset: float = 0.0, tilt: float = 0.0, downward: bool = True,
              range_col: str = "echo_range") -> DataFrame:
    """``depth = depth_offset + echo_range * cos(tilt) * (+1 downward / -1 upward)`` [def], on ping rows."""
    k = F.lit(math.cos(math.radians(tilt)) * (1.0 if downward else -1.0))
    return pings.withColumn("depth", F.transform(range_col, lambda r: F.lit(float(depth_offset)) + r * k))


# calibration columns of the angle conversion
ANGLE_CAL = ("angle_sensitivity_alongship", "angle_sensitivity_athwartship", "angle_offset_alongship", "angle_offset_athwartship")


def add_splitbeam_angle(pings: DataFrame, cal: DataFrame) -> DataFrame:
    """Along/athwart-ship physical angles (degrees) from the ping rows' electrical angle counts ``angle_along`` and
    ``angle_athwart`` [lit: Demer et al. 2015]: ``count * 180/128 / sensitivity - offset``. Without the counts or the
    calibration columns the input passes through; pings of an unknown channel get no angles."""
    if not {"angle_along", "angle_athwart"} <= set(pings.columns) or not set(ANGLE_CAL) <= set(cal.columns):
        return pings
    key = "channel_id" if "channel_id" in pings.columns else "channel"
    j = pings.join(cal.select(F.col("channel_id").alias(key), *ANGLE_CAL), key, "left")
    deg = lambda c, side: F.transform(c, lambda x: x * F.lit(ANGLE_STEP_DEG) / F.col(f"angle_sensitivity_{side}") - F.col(f"angle_offset_{side}"))
    return j.withColumn("angle_alongship", deg("angle_along", "alongship")).withColumn(
        "angle_athwartship", deg("angle_athwart", "athwartship")).drop(*ANGLE_CAL, "angle_along", "angle_athwart")


def drop_empty_pings(pings: DataFrame) -> DataFrame:
    """Keep a ping when *any* channel has *any* non-missing sample (``dropna(how='all')`` along ping_time): a row-local
    test, spread over the channels of a ping by a window."""
    w = Window.partitionBy(*segment_keys(pings), "ping_time")
    live = F.exists("sv", lambda x: x.isNotNull())
    return pings.withColumn("_live", F.max(live).over(w)).where(F.col("_live")).drop("_live")


def correct_echo_range(pings: DataFrame, depth_offset: float | None, range_col: str = "echo_range") -> DataFrame:
    """Range axis of the first channel (smallest ``channel_index``) at the first ping, plus ``depth_offset``,
    applied to every channel and ping of the segment; samples whose axis value is missing are removed.

    Adds ``range_axis`` and ``range_sample`` (arrays of the samples kept); adds ``depth`` = ``range_axis`` when the input
    has no depth. Without an offset or without the range column the input passes through. The axis comes from a window
    over the pings of the segment; the rest is row-local.
    """
    if depth_offset is None or range_col not in pings.columns:
        return pings
    from acoustispark.operators.pings import array_columns
    w = Window.partitionBy(*segment_keys(pings)).orderBy("channel_index", "ping_time").rowsBetween(
        Window.unboundedPreceding, Window.unboundedFollowing)
    out = pings.withColumn("_axis", F.first(range_col).over(w))
    arrays = [c for c in array_columns(pings) if c != "range_axis"]
    z = F.transform(F.arrays_zip(*arrays), lambda x, i: F.struct(
        *[x[c].alias(c) for c in arrays], (F.get("_axis", i) + F.lit(float(depth_offset))).alias("range_axis"), i.alias("range_sample")))
    out = out.withColumn("_z", F.filter(z, lambda x: x["range_axis"].isNotNull()))
    for c in (*arrays, "range_axis", "range_sample"):
        out = out.withColumn(c, F.col("_z")[c])
    if "depth" not in pings.columns:
        out = out.withColumn("depth", F.col("range_axis"))
    return out.drop("_axis", "_z")


def _trimmed(c: Column) -> Column:
    """Without trailing missing elements."""
    last = F.array_max(F.transform(c, lambda x, i: F.when(x.isNotNull(), i + 1)))
    return F.slice(c, F.lit(1), F.coalesce(last, F.lit(0)))


def depth_axis(pings: DataFrame) -> DataFrame:
    """1-D vertical axis per channel for plotting, taken at the channel's *first ping*: ``depth`` if it has more than one
    value there (trailing missing ones trimmed), else ``echo_range`` by the same rule; channels with neither are
    dropped. Output: ``keys, channel, range_sample, axis``."""
    keys = (*segment_keys(pings), "channel")
    first = pings.groupBy(*keys).agg(F.min_by(F.struct("depth", "echo_range"), F.col("ping_time")).alias("f"))
    d, r = _trimmed(F.col("f.depth")), _trimmed(F.col("f.echo_range"))
    axis = F.when(F.size(d) > 1, d).when(F.size(r) > 1, r)
    return first.select(*keys, F.posexplode(axis).alias("range_sample", "axis"))


def product_select(pings: DataFrame) -> DataFrame:
    """Rows of the first channel (smallest ``channel_index``) of each segment."""
    w = Window.partitionBy(*segment_keys(pings))
    return pings.withColumn("_c", F.min("channel_index").over(w)).where(F.col("channel_index") == F.col("_c")).drop("_c")
