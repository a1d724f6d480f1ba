"""Per-segment, per-file and per-run summaries; instrument metadata statistics; echogram rasters.

All are grouped aggregations with map-side partial aggregation; ``collect_set`` is only used on columns with
few distinct values per group (channels, frequencies).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from acoustispark.functions import scalars as fn
from acoustispark.operators.pings import segment_keys

SEG = ("platform", "segment")

# Fixed values that must equal the reference's behaviour --------------------------------------------------------
# standard channel names by nominal frequency (Hz), in this order; ties of the nearest search go to the first
STANDARD_CHANNELS = [(18000, "freq_18_kHz"), (38000, "freq_38_kHz"), (70000, "freq_70_kHz"),
                     (120000, "freq_120_kHz"), (200000, "freq_200_kHz")]
# variables looked up for every channel (missing ones are reported as null)
METADATA_VARIABLES = [
    "frequency_nominal", "beam_type", "gpt_software_version", "transceiver_software_version",
    "transmit_frequency_start", "transmit_frequency_stop", "beam_stabilisation", "non_quantitative_processing",
    "channel", "sample_interval", "transmit_bandwidth", "transmit_power", "sample_time_offset",
    "transmit_duration_nominal", "slope", "channel_mode", "data_type", "transmit_type",
]
# variables never summarised
EXCLUDED_VARIABLES = ["ping_time", "range_sample", "Sv", "echo_range", "latitude", "longitude", "depth",
                      "source_filenames"]
# echogram colour limits (dB): all-channel plots and the per-channel plotter
ECHOGRAM_DB_RANGE = (-80.0, -30.0)
CHANNEL_PLOT_DB_RANGE = (-80.0, -50.0)
# -----------------------------------------------------------------------------------------------------------------


def standard_channel(freq) -> Column:
    """Nearest standard channel name of a frequency; a tie goes to the lower standard frequency.

    A pure Column expression: the nearest-key search over the sorted list is a chain of midpoint tests, so no
    join (and no cross product) is needed.
    """
    f = fn._c(freq)
    expr = None
    for (lo, name), (hi, _) in zip(STANDARD_CHANNELS, STANDARD_CHANNELS[1:]):
        mid = (lo + hi) / 2.0
        expr = F.when(f <= F.lit(mid), F.lit(name)) if expr is None else expr.when(f <= F.lit(mid), F.lit(name))
    return F.when(f.isNull(), F.lit(None)).otherwise(expr.otherwise(F.lit(STANDARD_CHANNELS[-1][1])))


def segment_summary(pings: DataFrame, freq_col: str = "frequency_nominal") -> DataFrame:
    """One row per segment of ping rows: ping and channel counts, time span, depth/lat/lon ranges, mean Sv, channels
    and their frequencies (paired, in channel order).

    ``sv_mean_db`` is the arithmetic mean of the dB values rounded half-even to 1 decimal; the depth range uses
    ``echo_range`` when the segment has any, else ``depth``; lat/lon ranges ignore zeros, each on its own. Pings are
    rolled up to (segment, ping time) first, so nothing is counted distinct.
    """
    keys = segment_keys(pings)
    arr = lambda c: F.col(c) if c in pings.columns else F.lit(None).cast("array<double>")
    one = lambda c: F.col(c) if c in pings.columns else F.lit(None).cast("double")
    zero = F.struct(F.lit(0.0).alias("s"), F.lit(0).cast("long").alias("n"))
    sv = F.aggregate("sv", zero, lambda a, x: F.when(x.isNull(), a).otherwise(
        F.struct((a["s"] + x).alias("s"), (a["n"] + 1).alias("n"))))
    ch = F.struct("channel_index", "channel", one(freq_col).cast("double").alias("frequency"))
    rows = pings.select(
        *keys, "ping_time", sv.alias("_sv"), ch.alias("_ch"),
        F.array_min(arr("echo_range")).alias("_r0"), F.array_max(arr("echo_range")).alias("_r1"),
        F.array_min(arr("depth")).alias("_d0"), F.array_max(arr("depth")).alias("_d1"),
        F.nullif(one("lat"), F.lit(0.0)).alias("_lat"), F.nullif(one("lon"), F.lit(0.0)).alias("_lon"))
    low, high = {"_r0": "_r0", "_d0": "_d0", "_a0": "_lat", "_o0": "_lon"}, {"_r1": "_r1", "_d1": "_d1", "_a1": "_lat", "_o1": "_lon"}
    per_time = rows.groupBy(*keys, "ping_time").agg(
        *[F.min(c).alias(n) for n, c in low.items()], *[F.max(c).alias(n) for n, c in high.items()],
        F.sum("_sv.s").alias("_s"), F.sum("_sv.n").alias("_n"), F.collect_set("_ch").alias("_chs"))
    agg = per_time.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_pings"), F.min("ping_time").alias("start_time"), F.max("ping_time").alias("end_time"),
        *[F.min(n).alias(n) for n in low], *[F.max(n).alias(n) for n in high],
        fn.round1(F.sum("_s") / F.nullif(F.sum("_n"), F.lit(0))).alias("sv_mean_db"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set(F.array_sort("_chs"))))).alias("_chs"))
    use_range = F.col("_r0").isNotNull()
    return agg.select(
        *keys, "n_pings", F.size("_chs").cast("long").alias("n_channels"), "start_time", "end_time",
        F.when(use_range, F.col("_r0")).otherwise(F.col("_d0")).alias("depth_min"),
        F.when(use_range, F.col("_r1")).otherwise(F.col("_d1")).alias("depth_max"),
        F.col("_a0").alias("lat_min"), F.col("_a1").alias("lat_max"), F.col("_o0").alias("lon_min"), F.col("_o1").alias("lon_max"),
        "sv_mean_db", F.col("_chs.channel").alias("channels"),
        F.filter("_chs.frequency", lambda x: x.isNotNull()).alias("frequencies_hz"),
        *([] if "day" in keys else [fn.segment_day("start_time").alias("day")]), fn.segment_name("start_time", "end_time").alias("segment_name"))


def file_summary(samples: DataFrame, keys=("file",), freq_col: str = "frequency_nominal") -> DataFrame:
    """Per raw file: ping and sample counts, time span and duration, frequency list, first/last range and
    first/last position (by ping time; ties broken by ping, range sample and the value)."""
    o0 = F.struct("ping_time", "ping", "range_sample")
    return samples.groupBy(*keys).agg(
        F.count_distinct("ping_time").alias("file_npings"),
        (F.max("range_sample") + 1).alias("file_nsamples"),
        F.min("ping_time").alias("start_time"), F.max("ping_time").alias("end_time"),
        F.concat_ws(",", F.array_sort(F.collect_set(F.col(freq_col).cast("bigint").cast("string")))).alias("file_freqs"),
        F.min("echo_range").alias("start_depth"), F.max("echo_range").alias("end_depth"),
        F.min_by("lat", F.struct(o0, "lat")).alias("start_lat"), F.max_by("lat", F.struct(o0, "lat")).alias("end_lat"),
        F.min_by("lon", F.struct(o0, "lon")).alias("start_lon"), F.max_by("lon", F.struct(o0, "lon")).alias("end_lon"),
    ).withColumn("duration_s", (F.unix_micros(F.col("end_time").cast("timestamp"))
                                - F.unix_micros(F.col("start_time").cast("timestamp"))) / F.lit(1e6))


def run_summary(results: DataFrame, run_key=("campaign",)) -> DataFrame:
    """Per run: ok / failed / skipped / total file counts, pings over ok files, sorted distinct frequencies of
    ok files."""
    ok = F.col("status") == "ok"
    freqs = (results.where(ok).select(*run_key, F.explode("frequencies").alias("_f"))
             .groupBy(*run_key).agg(F.array_sort(F.collect_set("_f")).alias("frequencies")))
    counts = results.groupBy(*run_key).agg(
        F.count_if(ok).alias("n_ok"), F.count_if(F.col("status") == "error").alias("n_failed"),
        F.count_if(F.col("status") == "skipped").alias("n_skipped"), F.count(F.lit(1)).alias("n_total"),
        F.coalesce(F.sum(F.when(ok, F.col("n_pings"))), F.lit(0)).alias("total_pings"))
    return counts.join(freqs, list(run_key), "left")


def _has(c: Column, text: str) -> Column:
    return F.coalesce(F.instr(c, text) > 0, F.lit(False))


def quality_notes(results: DataFrame, run_key=("campaign",)) -> DataFrame:
    """Data-quality lines of a run: failed files, skipped files, then warnings of ok files (denoise or seabed
    errors, NASC skipped). The section exists only when the run has a failed or skipped file.

    Output ``run_key, kind (1 failed / 2 skipped / 3 warning), source_file, note``.
    """
    st = F.col("stage_status")
    den, nasc, sea = st["denoise"], st["nasc"], st["seabed"]
    warn = F.array_compact(F.array(
        F.when((den != "ok") & _has(den, "error"), F.concat(F.lit("denoise: "), den)),
        F.when(_has(nasc, "skipped"), F.concat(F.lit("NASC: "), nasc)),
        F.when((sea != "ok") & _has(sea, "error"), F.concat(F.lit("seabed: "), sea))))
    rows = results.select(
        *run_key, "source_file",
        F.when(F.col("status") == "error", F.lit(1)).when(F.col("status") == "skipped", F.lit(2))
         .when(F.col("status") == "ok", F.lit(3)).alias("kind"),
        F.when(F.col("status") == "error", F.concat(F.lit("Failed — "), F.coalesce("error", F.lit("unknown error"))))
         .when(F.col("status") == "skipped", F.concat(F.lit("Skipped — "), F.coalesce("reason", F.lit(""))))
         .when(F.col("status") == "ok", F.when(F.size(warn) > 0, F.array_join(warn, "; "))).alias("_note"))
    gate = (results.groupBy(*run_key)
            .agg(F.count_if(F.col("status").isin("error", "skipped")).alias("_bad")).where(F.col("_bad") > 0))
    return (rows.where(F.col("_note").isNotNull()).join(gate.select(*run_key), list(run_key), "left_semi")
            .select(*run_key, "kind", "source_file",
                    F.concat(F.lit("- **"), F.coalesce("source_file", F.lit("?")), F.lit("**: "), F.col("_note")).alias("note")))


# ---- instrument metadata ------------------------------------------------------------------------------------------

def variable_stats(values: DataFrame, keys=("channel", "variable")) -> DataFrame:
    """Summary of each variable of each channel from a long table ``keys, ndim, value``.

    One value -> ``scalar`` (the value); 1-D and all values equal and present -> ``scalar``; 1-D ->
    ``range`` [min, max, mean, population std]; N-D -> ``moments`` [mean, population std]. Missing values are
    skipped by the statistics.
    """
    agg = values.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.count("value").alias("_nv"), F.max("ndim").alias("ndim"),
        F.min("value").alias("_mn"), F.max("value").alias("_mx"), F.avg("value").alias("_avg"),
        F.stddev_pop("value").alias("_sd"), F.first("value", ignorenulls=False).alias("_one"))
    scalar_one = F.col("n") == 1
    const = (F.col("ndim") == 1) & (F.col("_nv") == F.col("n")) & (F.col("_mn") == F.col("_mx"))
    kind = F.when(scalar_one | const, F.lit("scalar")).when(F.col("ndim") == 1, F.lit("range")).otherwise(F.lit("moments"))
    return agg.select(
        *keys, "n", kind.alias("kind"),
        F.when(scalar_one, F.col("_one")).when(const, F.col("_mn")).alias("value"),
        F.when(kind == "range", F.col("_mn")).alias("v_min"), F.when(kind == "range", F.col("_mx")).alias("v_max"),
        F.when(kind != "scalar", F.col("_avg")).alias("v_mean"), F.when(kind != "scalar", F.col("_sd")).alias("v_std"))


def instrument_metadata(stats: DataFrame, channels: DataFrame) -> DataFrame:
    """Variable statistics keyed by standard channel name: every channel gets the fixed variable list (missing
    ones null) plus every summarised variable that is not excluded. Two channels mapping to one name: the later
    channel (larger ``channel_index``) wins.

    ``channels``: ``channel, channel_index, frequency_nominal``; ``stats``: output of ``variable_stats``.
    """
    ch = channels.select("channel", "channel_index", standard_channel("frequency_nominal").alias("standard_channel"))
    usable = stats.where(~F.col("variable").isin(EXCLUDED_VARIABLES))
    listed = ch.select("channel", "channel_index", "standard_channel",
                       F.explode(F.array(*[F.lit(v) for v in METADATA_VARIABLES])).alias("variable"))
    extra = usable.select("channel", "variable").join(ch, "channel")
    names = listed.unionByName(extra.select("channel", "channel_index", "standard_channel", "variable")).distinct()
    rows = names.join(usable, ["channel", "variable"], "left")
    val = F.struct("kind", "value", "v_min", "v_max", "v_mean", "v_std")
    return (rows.groupBy("standard_channel", "variable")
            .agg(F.max_by(val, F.col("channel_index")).alias("_v"))
            .select("standard_channel", "variable", "_v.*"))


def numeric_stats(df: DataFrame, keys, col: str) -> DataFrame:
    """mean, min, max and population std of a numeric column per key."""
    return df.groupBy(*keys).agg(F.avg(col).alias("mean"), F.min(col).alias("min"), F.max(col).alias("max"),
                                 F.stddev_pop(col).alias("std"))


def categorical_stats(df: DataFrame, keys, col: str) -> DataFrame:
    """Every value of a column per key with its count, as rows, beside the most frequent value of the key (ties ->
    smallest value [def]) and its count."""
    c = df.groupBy(*keys, F.col(col).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    top = c.groupBy(*keys).agg(F.min_by(F.col("value"), F.struct((-F.col("n")).alias("n"), F.col("value").alias("v"))).alias("most_frequent"),
                               F.max("n").alias("most_count"))
    return c.join(top, list(keys))


# ---- echogram raster ------------------------------------------------------------------------------------------------

def _scaled(sv: Column, db_range) -> Column:
    lo, hi = db_range
    return (F.least(F.greatest(sv, F.lit(lo)), F.lit(hi)) - F.lit(lo)) / F.lit(hi - lo)


def echogram_raster(pings: DataFrame, width: int = 64, height: int = 32, depth_col: str = "depth") -> DataFrame:
    """An echogram as a table of (column, row) cells per channel: time is cut into ``width`` equal bins between
    the channel's first and last ping with data, depth into ``height`` equal bins between its shallowest and deepest
    sample; a cell holds the linear-domain mean Sv (dB), clamped and scaled to 0..1 [def] by the limits of the
    all-channel plot (``value``) and of the per-channel plot (``value_channel``). Bounds come from a window over pings.
    """
    keys = (*segment_keys(pings), "channel")
    w = Window.partitionBy(*keys)
    at = F.filter(F.zip_with("sv", depth_col, lambda s, d: F.struct(s.alias("sv"), d.alias("d"))), lambda x: x["sv"].isNotNull())
    p = pings.select(*keys, F.unix_micros(F.col("ping_time").cast("timestamp")).alias("_t"), at.alias("_z")).where(F.size("_z") > 0)
    p = p.withColumn("_lo", F.array_min(F.col("_z.d"))).withColumn("_hi", F.array_max(F.col("_z.d")))
    for name, e in (("_t0", F.min("_t")), ("_t1", F.max("_t")), ("_d0", F.min("_lo")), ("_d1", F.max("_hi"))):
        p = p.withColumn(name, e.over(w))
    x = F.when(F.col("_t1") == F.col("_t0"), F.lit(0)).otherwise(F.least(
        F.floor((F.col("_t") - F.col("_t0")) * F.lit(width) / (F.col("_t1") - F.col("_t0"))), F.lit(width - 1)))
    s = p.select(*keys, x.alias("x"), "_d0", "_d1", F.explode("_z").alias("_s"))
    y = F.when(F.col("_d1") == F.col("_d0"), F.lit(0)).otherwise(F.least(
        F.floor((F.col("_s.d") - F.col("_d0")) * F.lit(height) / (F.col("_d1") - F.col("_d0"))), F.lit(height - 1)))
    cells = s.groupBy(*keys, "x", y.alias("y")).agg(fn.linear_to_db(F.avg(fn.db_to_linear(F.col("_s.sv")))).alias("sv"))
    return cells.withColumn("value", _scaled(F.col("sv"), ECHOGRAM_DB_RANGE)).withColumn("value_channel", _scaled(F.col("sv"), CHANNEL_PLOT_DB_RANGE))


def mvbs_raster(mvbs: DataFrame, keys=SEG) -> DataFrame:
    """MVBS cells of the first channel (smallest ``channel_index``), scaled to 0..1 by the all-channel limits."""
    first = Window.partitionBy(*keys)
    return (mvbs.withColumn("_c", F.min("channel_index").over(first)).where(F.col("channel_index") == F.col("_c")).drop("_c")
            .withColumn("value", _scaled(F.col("sv"), ECHOGRAM_DB_RANGE)))


def nasc_raster(nasc: DataFrame, keys=SEG) -> DataFrame:
    """NASC cells of the first channel (first name where no index is known), scaled to 0..1 by the 95th percentile of
    that channel's NASC (values above it clamp to 1)."""
    by = "channel_index" if "channel_index" in nasc.columns else "channel"
    first = nasc.groupBy(*keys).agg(F.min(by).alias(by))
    one = nasc.join(first, [*keys, by], "left_semi")
    p95 = one.groupBy(*keys).agg(F.percentile("nasc", F.lit(0.95)).alias("_p95"))
    j = one.join(p95, list(keys))
    return j.withColumn("value", F.when(F.col("_p95") > 0, F.least(F.col("nasc") / F.col("_p95"), F.lit(1.0)))
                        .otherwise(F.lit(0.0))).drop("_p95")
