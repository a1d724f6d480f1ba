"""Noise removal on ping rows: background (De Robertis & Higginbottom 2007), transient, impulse and attenuated signal
(Ryan et al. 2015), and the configurable chain.

Every method reduces a ping to a short array of vertical cells inside its row, looks at the cells of the neighbouring
pings through a window over ping numbers, and clears samples inside the row again. All windows are partitioned by
(a prefix of) platform, segment and channel, so the chain reads its source once, shuffles once and joins nothing.

Input: ping rows (see ``operators.pings``) with ``channel``, ``ping_time``, ``sv``, ``echo_range`` and ``depth``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window, functions as F

from acoustispark.functions import scalars as fn
from acoustispark.operators.pings import around, bin_sums, median, segment_keys, with_ping_index


@dataclass
class DenoiseParams:
    """Parameters and defaults of the four methods (the configuration's names in comments)."""
    # background_*
    ping_window: int = 50
    range_window: int = 20
    num_side_pings: int = 25
    snr_threshold: float = 3.0
    noise_max: float | None = None      # -999 in the configuration means "none"
    mode: str = "block"                 # "block": blocks of ping_window; "sliding": num_side_pings on either side
    # transient_*
    transient_exclude_above: float = 250.0
    transient_depth_bin: float = 5.0
    transient_n_pings: int = 20
    transient_threshold_db: float = 6.0
    # impulse_*
    impulse_threshold_db: float = 10.0
    impulse_num_lags: int = 3
    impulse_vertical_bin: float = 2.0
    impulse_ping_lags: list[int] = field(default_factory=lambda: [1])
    # attenuation_*
    attenuation_threshold: float = 0.8
    attenuation_upper_limit: float = 180.0
    attenuation_lower_limit: float = 280.0
    attenuation_side_pings: int = 15


#: What a frequency table may set: thresholds, and how many pings a window reaches to either side.
FREQUENCY_PARAMS = ("snr_threshold", "noise_max", "transient_threshold_db", "impulse_threshold_db", "attenuation_threshold")
FREQUENCY_WINDOWS = ("num_side_pings", "transient_n_pings", "attenuation_side_pings")


def with_frequency_params(pings: DataFrame, table: DataFrame, pulse_length: str | None = None) -> DataFrame:
    """Attach the parameter set of each ping's ``frequency_nominal`` (and of ``pulse_length``, if the table has that
    column): columns ``param_<name>``, NULL where the table says nothing, so the common value holds. A window's column says
    in its metadata how wide it gets, as a frame's bounds must be known to the plan (one small read of the table)."""
    t = table
    if "pulse_length" in t.columns:
        t = t.where(F.col("pulse_length").eqNullSafe(F.lit(pulse_length))).drop("pulse_length")
    names = [c for c in FREQUENCY_PARAMS if c in t.columns]
    wide = [c for c in FREQUENCY_WINDOWS if c in t.columns]
    most = t.agg(F.lit(0).alias("_"), *[F.max(c).alias(c) for c in wide]).first() if wide else {}
    t = t.groupBy("frequency_nominal").agg(*[F.max(c).alias(f"param_{c}") for c in names], *[
        F.max(c).cast("int").alias(f"param_{c}", metadata={"most": int(most[c] or 0)}) for c in wide])
    return pings.join(t, "frequency_nominal", "left")


def _side_by_side(pings: DataFrame, name: str, side: int, value: str) -> Column:
    """``value`` of the pings numbered within the window of ``name`` on either side: a frame as wide as any frequency's, of which
    a ping takes its own frequency's part. Without a column of that name the window is ``side`` pings for all."""
    col = f"param_{name}"
    if col not in pings.columns:
        return F.collect_list(value).over(around(pings, side, side))
    most = max(side, pings.schema[col].metadata.get("most", 0))
    near = F.collect_list(F.struct(F.col("ping_index").alias("i"), F.col(value).alias("v"))).over(around(pings, most, most))
    own = F.coalesce(F.col(col), F.lit(side))
    return F.transform(F.filter(near, lambda x: F.abs(x["i"] - F.col("ping_index")) <= own), lambda x: x["v"])


def _param(pings: DataFrame, name: str, value) -> Column:
    common = F.lit(None).cast("double") if value is None else F.lit(float(value))
    return F.coalesce(F.col(f"param_{name}"), common) if f"param_{name}" in pings.columns else common


def _alpha(absorption) -> Column:
    return F.col(absorption) if isinstance(absorption, str) else F.lit(float(absorption or 0.0))


def tvg(r: Column, alpha: Column) -> Column:
    """Time-varied gain of Sv: ``20log10(max(R,1)) + 2*alpha*R``."""
    return F.lit(20.0) * F.log10(F.greatest(r, F.lit(1.0))) + F.lit(2.0) * alpha * r


def background(pings: DataFrame, p: DenoiseParams = DenoiseParams(), absorption=0.0) -> DataFrame:
    """Background noise removal [lit: De Robertis & Higginbottom 2007].

    ``P = sv - TVG``; mean of linear P per block of ``range_window`` samples over the pings of a block of ``ping_window``
    (mode ``block``) or over ``num_side_pings`` pings on either side (mode ``sliding``) [def]; noise (dB) = the smallest
    of these means over the range, capped at ``noise_max``; ``sv' = 10log10(10^(sv/10) - 10^((noise+TVG)/10))``, NULL where
    the difference is <= 0 or ``sv' - (noise + TVG) < snr_threshold``. Adds ``noise``; replaces ``sv``.
    """
    s = with_ping_index(pings)
    a = _alpha(absorption)
    block = F.transform(F.arrays_zip("sv", "echo_range"), lambda z, i: F.struct(
        F.floor(i / F.lit(p.range_window)).alias("b"), fn.db_to_linear(z["sv"] - tvg(z["echo_range"], a)).alias("v")))
    s = s.withColumn("_c", bin_sums(block))
    if p.mode == "sliding":
        s = s.withColumn("_w", _side_by_side(s, "num_side_pings", p.num_side_pings, "_c"))
    elif p.mode == "block":
        s = s.withColumn("_pb", F.floor(F.col("ping_index") / F.lit(p.ping_window)))
        s = s.withColumn("_w", F.collect_list("_c").over(Window.partitionBy(*segment_keys(s), "channel", "_pb")))
    else:
        raise ValueError(f"unknown background mode: {p.mode}")
    size = F.array_max(F.transform("_w", lambda x: F.size(x)))
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("bigint").alias("n"))

    def mean_db(j: Column) -> Column:
        total = F.aggregate("_w", zero, lambda acc, x: F.struct(
            (acc["s"] + F.coalesce(F.get(x, j)["s"], F.lit(0.0))).alias("s"), (acc["n"] + F.coalesce(F.get(x, j)["n"], F.lit(0))).alias("n")),
            lambda acc: F.when(acc["n"] > 0, acc["s"] / acc["n"]))
        return fn.linear_to_db(total)

    noise = F.when(size > 0, F.array_min(F.transform(F.sequence(F.lit(0), size - 1), mean_db)))
    cap = _param(s, "noise_max", p.noise_max)
    s = s.withColumn("noise", F.when(noise.isNotNull(), F.least(noise, cap)))  # least skips NULL
    snr = _param(s, "snr_threshold", p.snr_threshold)

    def corrected(sv: Column, r: Column) -> Column:
        floor_db = F.col("noise") + tvg(r, a)
        diff = fn.db_to_linear(sv) - fn.db_to_linear(floor_db)
        out = F.when(diff > 0, F.lit(10.0) * F.log10(diff))
        return F.when(F.col("noise").isNull(), sv).when(out - floor_db >= snr, out)

    return s.withColumn("sv", F.zip_with("sv", "echo_range", corrected)).drop("_c", "_w", "_pb")


def _cells(bin_size: float, first: int, depth_col: str) -> Column:
    """Mean Sv (linear mean, in dB) per vertical bin, from bin ``first`` on."""
    items = F.zip_with("sv", depth_col, lambda s, d: F.struct(
        (F.floor(d / F.lit(bin_size)) - F.lit(first)).alias("b"), fn.db_to_linear(s).alias("v")))
    return F.transform(bin_sums(items), lambda x: fn.linear_to_db(x["s"] / x["n"]))


def _clear(flags: str, bin_size: float, first: int, depth_col: str) -> Column:
    """``sv`` without the samples of flagged bins."""
    def keep(s: Column, d: Column) -> Column:
        i = (F.floor(d / F.lit(bin_size)) - F.lit(first)).cast("int")
        bad = F.coalesce(i >= 0, F.lit(False)) & F.coalesce(F.get(F.col(flags), i), F.lit(False))
        return F.when(~bad, s)
    return F.zip_with("sv", depth_col, keep)


def transient(pings: DataFrame, p: DenoiseParams = DenoiseParams(), depth_col: str = "depth") -> DataFrame:
    """Transient noise [lit: Ryan et al. 2015, window form; edges and thresholds def]: per (channel, depth bin, ping) the
    mean Sv is compared with the median of the same bin over the pings numbered within ``n_pings`` on either side; bins
    starting at or below ``exclude_above`` m depth that exceed it by more than the threshold are removed."""
    s = with_ping_index(pings)
    size = p.transient_depth_bin
    first = int(-(-p.transient_exclude_above // size))
    s = s.withColumn("_c", _cells(size, first, depth_col))
    s = s.withColumn("_w", _side_by_side(s, "transient_n_pings", p.transient_n_pings, "_c"))
    limit = _param(s, "transient_threshold_db", p.transient_threshold_db)
    s = s.withColumn("_f", F.transform("_c", lambda m, j: m - median(F.transform("_w", lambda x: F.get(x, j))) > limit))
    return s.withColumn("sv", _clear("_f", size, first, depth_col)).drop("_c", "_w", "_f")


def impulse(pings: DataFrame, p: DenoiseParams = DenoiseParams(), depth_col: str = "depth") -> DataFrame:
    """Impulse noise [lit: Ryan et al. 2015]: per (channel, vertical bin) the bin mean of a ping is compared with the
    same bin of the pings numbered ``k`` before and after, for every lag k of ``ping_lags`` (1..num_lags when empty); a bin
    exceeding both by more than the threshold for any lag is removed. A missing neighbour gives no verdict."""
    s = with_ping_index(pings)
    size = p.impulse_vertical_bin
    s = s.withColumn("_c", _cells(size, 0, depth_col))
    limit = _param(s, "impulse_threshold_db", p.impulse_threshold_db)
    lags = list(p.impulse_ping_lags) or list(range(1, p.impulse_num_lags + 1))
    for k in lags:
        s = s.withColumn(f"_b{k}", F.first("_c").over(around(s, k, -k))).withColumn(f"_n{k}", F.first("_c").over(around(s, -k, k)))
    flag = F.lit(False)

    def high(m: Column, j: Column) -> Column:
        out = flag
        for k in lags:
            out = out | F.coalesce((m - F.get(F.col(f"_b{k}"), j) > limit) & (m - F.get(F.col(f"_n{k}"), j) > limit), F.lit(False))
        return out

    s = s.withColumn("_f", F.transform("_c", high))
    return s.withColumn("sv", _clear("_f", size, 0, depth_col)).drop("_c", "_f", *[f"_{x}{k}" for k in lags for x in "bn"])


def attenuation(pings: DataFrame, p: DenoiseParams = DenoiseParams(), depth_col: str = "depth") -> DataFrame:
    """Attenuated signal [lit: Ryan et al. 2015]: the median Sv (dB) of each ping inside the
    ``upper_limit..lower_limit`` layer is compared with the median of those ping medians over the pings numbered within
    ``side_pings`` on either side; when that exceeds the ping's by more than the threshold the whole ping (of that
    channel) is removed."""
    s = with_ping_index(pings)
    layer = F.zip_with("sv", depth_col, lambda x, d: F.when(d.between(p.attenuation_upper_limit, p.attenuation_lower_limit), x))
    s = s.withColumn("_pm", median(layer))
    if "param_attenuation_side_pings" in s.columns:
        s = s.withColumn("_bm", median(_side_by_side(s, "attenuation_side_pings", p.attenuation_side_pings, "_pm")))
    else:
        s = s.withColumn("_bm", F.percentile("_pm", F.lit(0.5)).over(around(s, p.attenuation_side_pings, p.attenuation_side_pings)))
    bad = F.coalesce(F.col("_bm") - F.col("_pm") > _param(s, "attenuation_threshold", p.attenuation_threshold), F.lit(False))
    return s.withColumn("sv", F.when(bad, F.transform("sv", lambda x: F.lit(None).cast("double"))).otherwise(F.col("sv"))).drop("_pm", "_bm")


METHODS = {
    "background": lambda df, p, kw: background(df, p, kw.get("absorption", 0.0)),
    "transient": lambda df, p, kw: transient(df, p),
    "impulse": lambda df, p, kw: impulse(df, p),
    "attenuation": lambda df, p, kw: attenuation(df, p),
}

DEFAULT_METHODS = "background,transient,impulse,attenuation"


def parse_methods(text: str) -> list[str]:
    names = [m.strip() for m in (text or "").split(",") if m.strip()]
    unknown = [m for m in names if m not in METHODS]
    if unknown:
        raise ValueError(f"unknown denoise method(s): {', '.join(unknown)}")
    return names


def denoise(pings: DataFrame, methods: str = DEFAULT_METHODS, p: DenoiseParams = DenoiseParams(), **kw) -> DataFrame:
    """Apply the named methods in list order; an unknown name is an error."""
    out = with_ping_index(pings)
    for m in parse_methods(methods):
        out = METHODS[m](out, p, kw)
    return out


def denoise_chain(pings: DataFrame, methods: str = DEFAULT_METHODS, p: DenoiseParams = DenoiseParams(),
                  **kw) -> tuple[DataFrame, str]:
    """``denoise`` with its outcome: ``(frame, "ok")``, or the undenoised input and ``error: ...`` when a name is unknown
    or a step cannot be planned (the processing goes on, as the configuration's chain does)."""
    try:
        return denoise(pings, methods, p, **kw), "ok"
    except Exception as e:
        return pings, f"error: {e}"
