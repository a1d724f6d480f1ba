"""Sonar-shaped tables derived from the supplied parquet tables.

Every view is a closed-form function of the given tables, so its size grows with them and the same
view can be written in any SQL engine (the DuckDB forms live in ``acoustispark.plans.oracle_views``).

pings          Sv ping rows, one per (channel, ping) with arrays, from ``embeddings``
samples        the same as a long table, one row per (channel, ping, range_sample)
ping_fixes     navigation fixes of the ping platforms, from ``events``
raw_pings      compact wire form, one row per (channel, ping) holding ARRAY<SMALLINT> power counts
samples_big    large long table for grid benchmarks, from ``lineitem``
channel_cal    calibration dimension, one channel per ``supplier`` row
nav            navigation fixes per platform, from ``events`` (zeros, out-of-range and missing latitudes)
fixes/targets  as-of join inputs, from ``events``
file_results   per-file outcome rows, from ``orders``
config_patches device-twin patch log, from ``events``
messages       JSON ping messages, from ``events`` (info messages, unknown channels, malformed JSON)
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acoustispark.operators.config_log import CONFIG_FIELDS
from acoustispark.operators.pings import to_samples
from acoustispark.sources.tables import read_table

EPOCH_2024 = "2024-01-01 00:00:00"
PINGS_START = "2024-01-01 23:59:30"


def _ts_ntz(s: str) -> Column:
    return F.to_timestamp_ntz(F.lit(s))


def _div(col: str, k: int) -> Column:
    return F.expr(f"{col} div {k}")


def pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ping rows: 4 channels, one ping per 4 embedding vectors, one sample per vector element.

    Blocks of 25 pings cycle over three platforms, and segment names repeat between them; the first segment crosses
    midnight; two channels (``ch0``, ``ch4``) have one frequency. Every 41st ping is empty and the one after it has
    spikes, other samples are missing at a scattered rule. ``lat``/``lon`` are a straight line; ``angle_*`` are counts.
    """
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    ping = _div("vec_id", 4)
    ci = (F.col("vec_id") % 4).cast("int")
    missing = lambda i: ((ping % 41) == 0) | (((F.col("vec_id") * 31 + i * 17) % 97) == 0)
    spike = lambda i: F.when(((ping % 41) == 1) & ((i % 16) == 5), F.lit(30.0)).otherwise(F.lit(0.0))
    sv = lambda x, i: F.when(~missing(i), F.lit(-70.0) + F.lit(40.0) * x.cast("double") + spike(i))
    steps = F.transform("embedding", lambda x, i: i * F.lit(5.0))
    return e.select(
        F.concat(F.lit("p"), (_div("vec_id", 100) % 3).cast("string")).alias("platform"),
        F.concat(F.lit("s"), _div("vec_id", 600).cast("string")).alias("segment"),
        F.concat(F.lit("ch"), F.when(ci == 3, 4).otherwise(ci).cast("string")).alias("channel"),
        ci.alias("channel_index"),
        ping.alias("ping"),
        (_ts_ntz(PINGS_START) + F.make_dt_interval(secs=(ping * 2).cast("decimal(18,6)"))).alias("ping_time"),
        (F.lit(40.0) + ping * F.lit(5e-4)).alias("lat"),
        (F.lit(-70.0) + ping * F.lit(3e-4)).alias("lon"),
        F.transform("embedding", sv).alias("sv"), steps.alias("echo_range"), steps.alias("depth"),
        F.transform("embedding", lambda x: F.floor(x.cast("double") * 60).cast("double")).alias("angle_along"),
        F.transform("embedding", lambda x, i: F.floor(x.cast("double") * 40 - i).cast("double")).alias("angle_athwart"),
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ping rows as long samples (without the angle counts)."""
    return to_samples(pings(spark, sf_dir).drop("angle_along", "angle_athwart"))


def ping_fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation fixes of the ping platforms, 50 ms apart, from ``events``."""
    ev = read_table(spark, sf_dir, "events")
    return ev.select(
        F.concat(F.lit("p"), (F.col("user_id") % 3).cast("string")).alias("platform"), "event_id",
        (_ts_ntz(PINGS_START) + F.make_dt_interval(secs=(F.col("event_id") * F.lit("0.05").cast("decimal(18,6)")).cast("decimal(18,6)"))).alias("ts"),
        (F.lit(40.0) + F.col("value") / F.lit(1e3)).alias("lat"), (F.lit(-70.0) - F.col("value") / F.lit(2e3)).alias("lon"))


def pings_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ping rows of many short segments, from ``events``: two channels, five platforms, up to 40 pings a segment. In one block
    of seven a ping of platform ``v2`` has a range too few, in one of nine a sample of ``v3`` is infinite; in one block of
    eleven platform ``v1`` hears nothing."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "value")
    eid, block, ping = F.col("event_id"), _div("event_id", 400), _div("event_id", 2)
    of = ping % 5
    steps = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: i * F.lit(5.0))
    odd = eid % 100 == 44
    silent = (of == 1) & (block % 11 == 5)

    def sv(i: Column) -> Column:
        plain = F.lit(-60.0) - F.col("value") % F.lit(30.0) + i * F.lit(0.5)
        return F.when(silent | ((eid + i) % 13 == 0), F.lit(None)).when((of == 3) & (block % 9 == 4) & (eid % 100 == 47) & (i == 3), F.lit(float("inf"))).otherwise(plain)

    return ev.select(
        F.concat(F.lit("v"), of.cast("string")).alias("platform"), F.concat(F.lit("b"), block.cast("string")).alias("segment"),
        F.concat(F.lit("ch"), (eid % 2).cast("string")).alias("channel"), (eid % 2).cast("int").alias("channel_index"), ping.alias("ping"),
        (_ts_ntz(EPOCH_2024) + F.make_dt_interval(secs=(ping * 120).cast("decimal(18,6)"))).alias("ping_time"),
        (F.lit(40.0) + ping * F.lit(1e-4)).alias("lat"), (F.lit(-70.0) + ping * F.lit(1e-4)).alias("lon"),
        F.transform(F.sequence(F.lit(0), F.lit(11)), sv).alias("sv"),
        F.when((of == 2) & (block % 7 == 3) & odd, F.slice(steps, 1, 11)).otherwise(steps).alias("echo_range"), steps.alias("depth"))


def frequency_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-frequency thresholds, from ``supplier``: the largest of each frequency's rows; some say nothing."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 4
    return s.where(k != 2).groupBy(F.when(k == 0, 38000.0).when(k == 1, 70000.0).otherwise(28000.0).alias("frequency_nominal")).agg(
        F.max(F.when(k != 3, k + 1.0)).cast("double").alias("snr_threshold"),
        F.max(F.when(k == 1, 4.0)).alias("impulse_threshold_db"), F.max(k * 0.25 + 0.5).cast("double").alias("attenuation_threshold"))


def frequency_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-frequency window sizes, from ``supplier``; 120 kHz has none of its own and 28 kHz lacks one."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 4
    return s.where(k != 2).groupBy(F.when(k == 0, 38000.0).when(k == 1, 70000.0).otherwise(28000.0).alias("frequency_nominal")).agg(
        F.max(k * 4 + 3).cast("int").alias("num_side_pings"), F.max(k * 2 + 3).cast("int").alias("transient_n_pings"),
        F.max(F.when(k != 3, k * 5 + 2)).cast("int").alias("attenuation_side_pings"))


def raw_pings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Compact ping messages: int16 power counts per (channel, ping), same vectors as ``samples``."""
    e = read_table(spark, sf_dir, "embeddings")
    ping = _div("vec_id", 4)
    return e.select(
        F.lit("p0").alias("platform"),
        F.concat(F.lit("ch"), (F.col("vec_id") % 4).cast("string")).alias("channel_id"),
        ping.alias("ping"),
        (_ts_ntz(EPOCH_2024) + F.make_dt_interval(secs=(ping * 2).cast("decimal(18,6)"))).alias("ping_time"),
        F.transform("embedding", lambda x: (F.floor(x.cast("double") * 4000) - 6000).cast("smallint")).alias("samples"),
    )


def samples_big(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Large long table for grid benchmarks. (ping, range_sample) is not unique: grouped operators only."""
    li = read_table(spark, sf_dir, "lineitem")
    return li.select(
        F.lit("p0").alias("platform"),
        F.date_format("l_shipdate", "yyyy").alias("segment"),
        F.concat(F.lit("ch"), F.col("l_returnflag")).alias("channel"),
        F.col("l_orderkey").alias("ping"),
        F.col("l_shipdate").alias("ping_time"),
        (F.col("l_linenumber") - 1).alias("range_sample"),
        (F.col("l_linenumber") * 50.0).alias("echo_range"),
        (F.lit(-90.0) + F.col("l_quantity")).alias("sv"),
        (F.lit(40.0) + F.col("l_partkey") * F.lit(1e-4)).alias("lat"),
        (F.lit(-70.0) + F.col("l_suppkey") * F.lit(1e-3)).alias("lon"),
    )


def channel_cal_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibration rows as a sonar service would send them: zeros and NULLs stand for "not set".

    One channel per supplier, ``ch<suppkey>``; frequency cycles 38/70/120/28 kHz (28 kHz is the tie between the
    18 and 38 kHz standard channels), gain cycles 0 / 23.5 / NULL / 27 (0 and NULL must fall back to the default).
    """
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 4
    return s.select(
        F.concat(F.lit("ch"), F.col("s_suppkey").cast("string")).alias("channel_id"),
        F.when(k == 3, F.lit("")).otherwise(F.concat(F.lit("ES"), F.col("s_nationkey").cast("string"))).alias("transducer_name"),
        F.when(k == 0, 38000.0).when(k == 1, 70000.0).when(k == 2, 120000.0).otherwise(28000.0).alias("frequency"),
        F.when(F.col("s_suppkey") % 5 == 0, 0.0).otherwise(F.col("s_acctbal") / 10.0 + 100.0).alias("transmit_power"),
        F.when(k == 1, 0.000512).alias("pulse_length"),
        F.when(k == 2, 0.0).otherwise(1.6e-5).alias("sample_interval"),
        F.when(k == 0, 0.0).when(k == 1, 23.5).when(k == 3, 27.0).alias("gain"),
        F.when(k == 1, -0.5).alias("sa_correction"),
        F.when(k == 3, -21.0).alias("equivalent_beam_angle"),
        F.when(k == 2, 6.5).alias("beamwidth_alongship"),
        F.when(k == 2, 6.6).alias("beamwidth_athwartship"),
        F.when(k != 0, 1480.0 + k * 5.0).alias("sound_velocity"),
        F.when(k == 0, 0.0).otherwise(k * 0.01).alias("absorption_coefficient"),
    )


def angle_cal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Split-beam calibration of every channel, from ``supplier``."""
    s = read_table(spark, sf_dir, "supplier")
    k = F.col("s_suppkey") % 4
    return s.select(F.concat(F.lit("ch"), F.col("s_suppkey").cast("string")).alias("channel_id"),
                    (F.lit(20.0) + k).alias("angle_sensitivity_alongship"), (F.lit(18.0) + k).alias("angle_sensitivity_athwartship"),
                    (k * 0.5).cast("double").alias("angle_offset_alongship"), (k * -0.25).cast("double").alias("angle_offset_athwartship"))


def _event_hours(ts: Column) -> Column:
    """Microseconds since 2024-01-01 (``ts`` reads as TIMESTAMP_NTZ; cast keeps the wall clock in UTC)."""
    return F.unix_micros(ts.cast("timestamp")) - F.lit(1704067200000000)


def nav(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Navigation fixes: platform per event user, ``segment`` = the ISO week of the fix."""
    ev = read_table(spark, sf_dir, "events")
    h = _event_hours(F.col("ts"))
    eid = F.col("event_id")
    lat = (F.when(eid % 53 == 0, F.lit(0.0)).when(eid % 101 == 0, F.lit(95.0)).when(eid % 59 == 0, F.lit(None))
           .otherwise(F.lit(40.0) + h / F.lit(3.6e11) + (F.col("value") - 50) / F.lit(1e5)))
    lon = F.when(eid % 53 == 0, F.lit(0.0)).otherwise(F.lit(-70.0) + h / F.lit(2.88e11) - (eid % 7) / F.lit(1e5))
    return ev.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("platform"),
        F.date_format(F.date_trunc("week", F.col("ts")), "yyyy-MM-dd").alias("segment"),
        F.col("event_id"),
        F.col("ts"),
        lat.cast("double").alias("lat"),
        lon.cast("double").alias("lon"),
        ((F.col("event_id") * 7) % 360).cast("double").alias("heading"),
    )


def fixes(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") == "signup")
    return ev.select(
        F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("platform"),
        "event_id", "ts",
        (F.lit(40.0) + F.col("value") / F.lit(1e3)).alias("lat"),
        (F.lit(-70.0) - F.col("value") / F.lit(2e3)).alias("lon"),
    )


def targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = read_table(spark, sf_dir, "events").where(F.col("event_type") != "signup")
    return ev.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("platform"), "event_id", "ts")


def file_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-file outcomes of a file-mode run: status, ping count and per-stage statuses."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    status = F.when(k % 17 == 0, "error").when(k % 23 == 0, "skipped").otherwise("ok")
    nasc = (F.when(F.col("o_orderpriority") == "1-URGENT", "error: window")
            .when(F.col("o_orderpriority") == "5-LOW", "skipped: no GPS").otherwise("ok"))
    mvbs = F.when(k % 29 == 0, "error: empty grid").otherwise("ok")
    denoise = F.when(k % 31 == 0, "error: singular block").otherwise("ok")
    seabed = F.when(k % 37 == 0, "error: no bottom").otherwise("ok")
    ok = status == "ok"
    base = F.concat(F.date_format("o_orderdate", "yyyy-MM-dd"), F.lit("/f"), k.cast("string"))
    return o.select(
        k.alias("file_id"),
        F.concat(F.lit("f"), k.cast("string"), F.lit(".raw")).alias("source_file"),
        F.to_date("o_orderdate").alias("day"),
        status.alias("status"),
        F.when(status == "error", F.concat(F.lit("convert failed: order "), k.cast("string"))).alias("error"),
        F.when(status == "skipped", F.lit("no valid pings")).alias("reason"),
        F.when(ok, F.concat(F.lit("seg"), (k % 40).cast("string"))).alias("segment"),
        (k % 5000).alias("n_pings"),
        (k % 3 + 1).cast("int").alias("n_channels"),
        F.when(ok & (k % 4 != 0), F.lit(40.0) + k % 100 / 100.0).alias("lat_min"), F.when(ok & (k % 4 != 0), F.lit(41.0) + k % 100 / 100.0).alias("lat_max"),
        F.when(ok & (k % 6 != 0), F.lit(-70.0) - k % 10 / 8.0).alias("lon_min"), F.when(ok & (k % 6 != 0), F.lit(-69.5) - k % 10 / 8.0).alias("lon_max"),
        F.when(ok, F.concat(F.lit("processed/"), base, F.lit("/sv"))).alias("sv_path"),
        F.when(ok & (k % 5 != 0), F.concat(F.lit("/data/store/echodata/"), base, F.lit(".zarr"))).alias("echodata_path"),
        F.when(ok, F.when(k % 2 == 0, F.array(F.lit("sv"), F.lit("mvbs"))).otherwise(F.array(F.lit("sv")))).alias("products"),
        F.when(ok & (k % 8 == 0), F.array(F.concat(F.lit("echograms/"), base, F.lit("/sv_38kHz.png")),
                                          F.concat(F.lit("echograms/"), base, F.lit("/mvbs_echogram.png")))).alias("echogram_files"),
        F.array_sort(F.array_distinct(F.array(
            F.lit(38000.0), F.when(k % 2 == 0, F.lit(120000.0)).otherwise(F.lit(70000.0)),
            F.when(k % 3 == 0, F.lit(200000.0)).otherwise(F.lit(38000.0))))).alias("frequencies"),
        F.create_map(F.lit("mvbs"), mvbs, F.lit("nasc"), nasc, F.lit("denoise"), denoise,
                     F.lit("seabed"), seabed).alias("stage_status"),
        (k % 997 * 13 + 250).alias("processing_time_ms"),
        (k % 997 * 13 + 900).alias("total_time_ms"),
        F.col("o_custkey").alias("campaign"),
    )


#: Fields that the patch log writes, by type.
PATCH_FIELDS = {k: [n for n, t, _ in CONFIG_FIELDS if t == k] for k in ("str", "bool", "int", "float")}


def config_patches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twin patch log: one (key, raw JSON value) per event. Exercises unwrap, bad integers, null booleans,
    the ``Log_Level`` rename and unknown ``$`` keys."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    k = F.get_json_object("props", "$.k")
    pick = lambda kind: F.element_at(F.array(*[F.lit(n) for n in PATCH_FIELDS[kind]]), (eid % len(PATCH_FIELDS[kind]) + 1).cast("int"))
    key = (F.when(F.col("event_type") == "view", pick("str")).when(F.col("event_type") == "signup", pick("bool"))
           .when(F.col("event_type") == "click", pick("int")).when(F.col("event_type") == "error", "Log_Level")
           .when(eid % 3 == 0, "$version").otherwise(pick("float")))
    signup = (F.when(eid % 4 == 0, F.lit("false")).when(eid % 4 == 1, F.lit('{"value":"off"}'))
              .when(eid % 4 == 2, F.lit("null")).otherwise(F.lit("1")))
    click = (F.when(eid % 3 == 0, F.lit('"abc"')).when(eid % 7 == 0, F.lit('"99999999999999999999"'))
             .when(eid % 11 == 0, F.lit("1e22")).when(eid % 13 == 0, F.lit("1e60")).otherwise(k))
    other = F.concat(F.lit('{"value":"'), k, F.lit('"}'))
    raw = (F.when(F.col("event_type") == "signup", signup).when(F.col("event_type") == "click", click).otherwise(other))
    return ev.select(
        F.col("ts"), eid.alias("event_id"), (F.col("user_id") % 5).alias("device"),
        key.alias("key"), raw.alias("raw_json"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON ping messages: every 11th is ``info``; users divisible by 7 send from an unknown channel;
    every 97th message is cut short (malformed), every 89th has no time, every 83rd an offset, every 79th a sample
    outside 16 bits."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    typ = F.when(eid % 11 == 0, "info").otherwise("sample_data")
    ch = F.when(F.col("user_id") % 7 == 0, F.lit("chX")).otherwise(
        F.concat(F.lit("ch"), (F.col("user_id") % 5).cast("string")))
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    when = F.when(eid % 89 == 0, F.lit("not a time")).when(eid % 83 == 0, F.concat(iso, F.lit("+02:00"))).otherwise(iso)
    body = F.when(eid % 97 == 0, F.expr("substring(to_json_body, 1, length(to_json_body) - 5)")).otherwise(F.col("to_json_body"))
    return (ev.select(eid.alias("event_id"), F.col("user_id"), F.col("ts"),
                      F.to_json(F.struct(typ.alias("type"), ch.alias("channel_id"), when.alias("time"),
                                         F.array(F.when(eid % 79 == 0, F.lit(40000)).otherwise((F.floor(F.col("value") * 10) - 6000).cast("int")),
                                                 (F.floor(F.col("value")) - 5000).cast("int"),
                                                 (eid % 1000 - 7000).cast("int")).alias("samples"))).alias("to_json_body"))
            .select("event_id", F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("platform"), "ts",
                    body.alias("value")))


def commands(spark: SparkSession, sf_dir: str) -> DataFrame:
    """On-demand command messages: one per event; the event type picks the command (``error`` events send an
    unknown command). Some have no paths, an invalid date or an empty configuration."""
    ev = read_table(spark, sf_dir, "events")
    eid = F.col("event_id")
    et = F.col("event_type")
    cmd = (F.when(et == "click", "process_raw_files").when(et == "view", "process_day").when(et == "signup", "get_status")
           .when(et == "purchase", "set_config").otherwise("reboot"))
    paths = F.when(et == "click", F.when(eid % 4 == 0, F.array().cast("array<string>")).otherwise(
        F.array(F.concat(F.lit("raw/f"), eid.cast("string"), F.lit(".raw")),
                F.concat(F.lit("raw/g"), eid.cast("string"), F.lit(".raw")))))
    date = F.when(et == "view", F.when(eid % 11 == 0, F.lit("yesterday")).otherwise(
        F.concat(F.lit("199"), (eid % 7 + 2).cast("string"), F.lit("-0"), (eid % 9 + 1).cast("string"), F.lit("-1"),
                 (eid % 10).cast("string"))))
    cfg = F.when(et == "purchase", F.when(eid % 5 == 0, F.lit("{}")).otherwise(
        F.concat(F.lit('{"mvbs_range_bin": "'), F.get_json_object("props", "$.k"), F.lit('", "Log_Level": "DEBUG"}'))))
    return ev.select(eid.alias("command_id"), F.col("ts"), cmd.alias("command"), paths.alias("paths"),
                     date.alias("date"), cfg.alias("config_json"))
