"""Registered queries: what the stores hold after a write, and the processing jobs."""

from __future__ import annotations

from pyspark.sql import functions as F

from acoustispark.operators import jobs
from acoustispark.operators import summary as sm
from acoustispark.operators.pings import to_samples
from acoustispark.plans import cleaning as cl
from acoustispark.plans.common import rounded
from acoustispark.plans.oracle_views import with_views
from acoustispark.plans.summaries import SEGMENT_SUMMARY_CTE, _pings_with_freq
from acoustispark.session import scratch_path
from acoustispark.sources import catalog as ct
from acoustispark.sources import fixtures as fx
from acoustispark.sources import sinks

OUT = ["platform", "segment", "channel", "ping", "range_sample", "sv"]
DAY_SQL = "min(ping_time::date) over (partition by platform, segment)"


def _pings(spark, sf_dir):
    return fx.pings(spark, sf_dir).drop("angle_along", "angle_athwart")


def q_scan_samples(spark, sf_dir):
    """Store the Sv product, then scan one day of it."""
    root = scratch_path(spark, "scan")
    p = sinks.with_batch_day(_pings(spark, sf_dir)).withColumn("campaign", F.lit("c1")).withColumn("product", F.lit("sv"))
    sinks.sink_product(p, root)
    back = ct.read_product(spark, root, p.schema, campaign="c1", product="sv", day="2024-01-01")
    return rounded(to_samples(back.drop("campaign", "product", "day")).select(*OUT))


SCAN_SAMPLES_SQL = with_views(["samples"], f"""
select platform, segment, channel, ping, range_sample, round(sv, 6) as sv
from (select *, {DAY_SQL} as day from samples) where day = date '2024-01-01'""")


def q_sink_day_append(spark, sf_dir):
    """Append the platforms one after the other, one of them twice, and count what each day and segment holds."""
    root = scratch_path(spark, "days")
    p = _pings(spark, sf_dir)
    for name in ("p0", "p1", "p2", "p0"):
        sinks.sink_day_append(p.where(F.col("platform") == name), root)
    back = spark.read.schema(p.withColumn("day", F.current_date()).schema).parquet(root)
    return rounded(back.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "platform", "segment").agg(
        F.count("*").alias("n_rows"), F.min("ping").alias("first_ping"), F.max("ping").alias("last_ping"),
        F.sum(F.aggregate("sv", F.lit(0.0), lambda a, x: a + F.coalesce(x, F.lit(0.0)))).alias("sv_sum")), 5)


SINK_DAY_APPEND_SQL = with_views(["samples"], f"""
select strftime(day, '%Y-%m-%d') as day, platform, segment, count(distinct (ping, channel)) as n_rows, min(ping) as first_ping,
       max(ping) as last_ping, round(sum(sv), 5) as sv_sum from (select *, {DAY_SQL} as day from samples) group by all""")

CFG = {"sonar_model": "EK60", "nasc_enabled": True, "seabed_enabled": False, "use_gpu": False}


def q_sink_metadata_json(spark, sf_dir):
    """Write the manifests as JSON and read them back as a table."""
    root = scratch_path(spark, "manifests")
    m = sinks.manifest(sm.segment_summary(_pings_with_freq(spark, sf_dir)), CFG)
    sinks.sink_metadata_json(m, root)
    b = spark.read.schema(m.schema).json(root)
    text = lambda c: F.array_join(F.transform(c, lambda x: F.format_string("%.4f", x)), ",")
    return b.select(
        "platform", F.date_format("day", "yyyy-MM-dd").alias("day"), "segment", "file", "start_time", "end_time", "n_pings", "n_channels",
        F.array_join("channels", ",").alias("channels"), text("frequencies_hz").alias("frequencies"), F.array_join("products", ",").alias("products"),
        F.size("echogram_files").alias("n_echograms"), "processing_time_ms", text("depth_range_m").alias("depth_range"),
        text("lat_range").alias("lat_range"), text("lon_range").alias("lon_range"), "sv_mean_db",
        "config.sonar_model", "config.waveform_mode", "config.denoise_enabled", "config.denoise_methods", "config.mvbs_enabled",
        "config.mvbs_range_bin", "config.mvbs_ping_time_bin", "config.nasc_enabled", "config.nasc_range_bin", "config.nasc_dist_bin",
        "config.seabed_enabled", "config.use_gpu")


SINK_METADATA_JSON_SQL = with_views(["samples", "channel_cal_raw"], f"""
with {SEGMENT_SUMMARY_CTE}
select platform, day, segment, segment_name as file, start_time, end_time, n_pings, n_channels, channels,
       array_to_string(list_transform(string_split(frequencies_hz, ','), lambda f: printf('%.4f', f::double)), ',') as frequencies,
       'sv' as products, 0 as n_echograms, 0::bigint as processing_time_ms, printf('%.4f,%.4f', depth_min, depth_max) as depth_range,
       printf('%.4f,%.4f', lat_min, lat_max) as lat_range, printf('%.4f,%.4f', lon_min, lon_max) as lon_range, sv_mean_db,
       'EK60' as sonar_model, 'CW' as waveform_mode, true as denoise_enabled, 'background,transient,impulse,attenuation' as denoise_methods,
       true as mvbs_enabled, '0.5' as mvbs_range_bin, '10s' as mvbs_ping_time_bin, true as nasc_enabled, '10' as nasc_range_bin,
       '0.5' as nasc_dist_bin, false as seabed_enabled, false as use_gpu from summary""")

JOB_CFG = {"survey_id": "HB1907", "denoise_enabled": True, "seabed_enabled": True, "seabed_method": "maxSv", "mvbs_range_bin": "20",
           "mvbs_ping_time_bin": "20s", "nasc_enabled": True, "nasc_dist_bin": "0.05", "absorption": cl.ALPHA, "plot_echogram": False}


def q_job_process_segment(spark, sf_dir):
    """Statuses of all segments, with what the job stored: Sv pings, and MVBS cells of the denoised and masked data."""
    root = scratch_path(spark, "job")
    status = jobs.process_segments(spark, _pings(spark, sf_dir), JOB_CFG, root)
    wide = status.groupBy("platform", "day", "segment").pivot(
        "stage", ["sv", "denoise", "seabed", "mvbs", "nasc", "metadata", "report"]).agg(F.max("status"))
    sv = spark.read.parquet(f"{root}/products/sv").groupBy("platform", "segment").agg(F.count("*").alias("n_sv_rows"))
    mvbs = spark.read.parquet(f"{root}/products/mvbs").groupBy("platform", "segment").agg(
        F.count("*").alias("n_mvbs_cells"), F.sum("n_samples").alias("n_mvbs_samples"), F.sum("sv").alias("mvbs_sum"))
    out = wide.join(sv, ["platform", "segment"], "left").join(mvbs, ["platform", "segment"], "left")
    return rounded(out.withColumn("day", F.date_format("day", "yyyy-MM-dd")), 4)


JOB_PROCESS_SEGMENT_SQL = with_views(["samples"], f"""
with live as (select * from samples s where exists (select 1 from samples t where t.sv is not null and t.platform = s.platform
         and t.segment = s.segment and t.ping_time = s.ping_time)),
{cl.indexed_sql('live', 'si')},
{cl.background_sql('si', 'bg')},
{cl.transient_sql('bg', 'tr')},
{cl.impulse_sql('tr', 'im')},
{cl.attenuation_sql('im', 'att')},
{cl.MAXSV_CTE.replace('from samples', 'from att').replace(repr(cl.TH), '-40.0')},
masked as (select a.* exclude (sv), case when m.seabed_depth is null or a.depth < m.seabed_depth then sv end as sv
           from att a left join maxsv m using (platform, segment, channel, ping_time)),
cells as (select platform, segment, channel, time_bucket(interval '20 seconds', ping_time) as t, floor(echo_range / 20.0) as r,
                 10 * log10(avg(pow(10, sv / 10))) as sv, count(sv) as n from masked where sv is not null group by all),
c as (select platform, segment, count(*) as n_mvbs_cells, sum(n)::bigint as n_mvbs_samples, sum(sv) as mvbs_sum from cells group by all),
d as (select platform, segment, strftime(min(day), '%Y-%m-%d') as day from (select *, {DAY_SQL} as day from samples) group by all),
n as (select platform, segment, count(distinct (ping, channel)) as n_sv_rows from live group by all)
select platform, segment, day, 'ok' as sv, 'ok' as denoise, 'ok' as seabed, 'ok' as mvbs, 'ok' as nasc, 'ok' as metadata, 'ok' as report,
       n_sv_rows, n_mvbs_cells, n_mvbs_samples, round(mvbs_sum, 4) as mvbs_sum
from d left join n using (platform, segment) left join c using (platform, segment)""")


def q_job_process_files(spark, sf_dir):
    """Files of ten pings; every seventh cannot be decoded, and some hold no valid ping."""
    p = _pings(spark, sf_dir).withColumn("_f", F.expr("ping div 10"))
    p = p.withColumn("source_file", F.concat(F.lit("f"), F.col("_f").cast("string"), F.lit(".raw")))
    catalog = p.select("source_file", "_f").distinct()
    failures = catalog.where(F.col("_f") % 7 == 3).select("source_file", F.concat(F.lit("cannot decode "), F.col("source_file")).alias("error"))
    decoded = p.where(F.col("_f") % 7 != 3).withColumn("sv", F.when(F.col("_f") % 7 == 5, F.transform("sv", lambda x: F.lit(None).cast("double"))).otherwise(F.col("sv")))
    cfg = {"denoise_methods": "impulse", "mvbs_range_bin": "20", "plot_echogram": False, "platform_name": "p"}
    out = jobs.process_files(spark, catalog, decoded.drop("_f").withColumn("platform", F.lit("ship")), cfg, scratch_path(spark, "files"), failures)
    return out.select("source_file", "status", "error", "reason", F.date_format("day", "yyyy-MM-dd").alias("day"), "n_pings",
                      F.col("stage_status")["denoise"].alias("denoise"), F.col("stage_status")["mvbs"].alias("mvbs"))


JOB_PROCESS_FILES_SQL = with_views(["samples"], """
with f as (select *, ping // 10 as f from samples),
live as (select f, count(distinct ping_time) as n, min(ping_time)::date as day from (
           select f, ping_time, bool_or(sv is not null) as live from f where f % 7 not in (3, 5) group by all) where live group by all),
d as (select f, min(ping_time)::date as day from f group by all)
select 'f' || d.f || '.raw' as source_file, case when d.f % 7 = 3 then 'error' when n is null then 'skipped' else 'ok' end as status,
       case when d.f % 7 = 3 then 'cannot decode f' || d.f || '.raw' end as error,
       case when d.f % 7 <> 3 and n is null then 'no valid pings' end as reason,
       case when n is not null then strftime(d.day, '%Y-%m-%d') end as day, n as n_pings,
       case when n is not null then 'ok' end as denoise, case when n is not null then 'ok' end as mvbs
from d left join live using (f)""")

MANY_CFG = {"survey_id": "HB1907", "denoise_enabled": False, "mvbs_range_bin": "20", "mvbs_ping_time_bin": "600s", "plot_echogram": False}


def _cells_of(df):
    return df.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "platform", "segment").agg(
        F.count("*").alias("n_mvbs_cells"), F.sum("n_samples").alias("n_mvbs_samples"), F.sum("sv").alias("mvbs_sum"))


def q_job_process_many(spark, sf_dir):
    """Many segments at once, some with a faulty ping and some without a valid one, each with its statuses and products."""
    root = scratch_path(spark, "many")
    status = jobs.process_segments(spark, fx.pings_events(spark, sf_dir), MANY_CFG, root)
    wide = status.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "platform", "segment").pivot("stage", ["sv", "mvbs", "metadata", "report"]).agg(F.max("status"))
    sv = spark.read.parquet(f"{root}/products/sv").groupBy("platform", "segment").agg(F.count("*").alias("n_sv_rows"))
    out = wide.join(sv, ["platform", "segment"], "left").join(_cells_of(spark.read.parquet(f"{root}/products/mvbs")), ["day", "platform", "segment"], "left")
    return rounded(out, 4)


MANY_CTE = """
seg as (select platform, segment, strftime(min(ping_time), '%Y-%m-%d') as day,
  platform = 'v2' and any_value(block) % 7 = 3 and bool_or(event_id % 100 = 44) as short,
  platform = 'v3' and any_value(block) % 9 = 4 and bool_or(event_id % 100 = 47 and range_sample = 3 and (event_id + 3) % 13 <> 0) as endless,
  bool_or(sv is not null) as valid from samples_events group by platform, segment),
sta as (select *, case when short then 'error: 12 samples against 11 of echo_range' when endless then 'error: infinite sv'
  when not valid then 'skipped: no valid pings' else 'ok' end as sv from seg),
live as (select s.* exclude (block), a.day from samples_events s join sta a using (platform, segment) where a.sv = 'ok'
  and exists (select 1 from samples_events t where t.sv is not null and t.platform = s.platform and t.segment = s.segment and t.ping_time = s.ping_time))"""

JOB_PROCESS_MANY_SQL = with_views(["samples_events"], f"""
with {MANY_CTE},
cells as (select platform, segment, channel, time_bucket(interval '600 seconds', ping_time) as t, floor(echo_range / 20.0) as r,
  10 * log10(avg(pow(10, sv / 10))) as v, count(sv) as n from live where sv is not null group by all),
c as (select platform, segment, count(*) as n_mvbs_cells, sum(n)::bigint as n_mvbs_samples, round(sum(v), 4) as mvbs_sum from cells group by all),
n as (select platform, segment, count(distinct (ping, channel)) as n_sv_rows from live group by all)
select day, platform, segment, sv, case when sv = 'ok' then 'ok' end as mvbs, case when sv = 'ok' then 'ok' end as metadata,
  case when sv = 'ok' then 'ok' end as report, n_sv_rows, n_mvbs_cells, n_mvbs_samples, mvbs_sum
from sta left join n using (platform, segment) left join c using (platform, segment)""")

AGAIN_DAY = "2024-01-01"


def q_job_reprocess_day(spark, sf_dir):
    """Process all days, then one day again from the store, with coarser cells: that day's MVBS is replaced, the others stay."""
    root = scratch_path(spark, "again")
    p = sinks.with_batch_day(fx.pings_events(spark, sf_dir))
    jobs.process_segments(spark, p, MANY_CFG, root)
    schema = p.withColumn("product", F.lit("sv")).withColumn("campaign", F.lit("HB1907")).schema
    jobs.reprocess_day(spark, f"{root}/products/sv", AGAIN_DAY, ["mvbs"], MANY_CFG | {"mvbs_range_bin": "40"}, root, schema)
    return rounded(_cells_of(spark.read.parquet(f"{root}/products/mvbs")), 4)


JOB_REPROCESS_DAY_SQL = with_views(["samples_events"], f"""
with {MANY_CTE},
cells as (select day, platform, segment, channel, time_bucket(interval '600 seconds', ping_time) as t,
  floor(echo_range / case when day = '{AGAIN_DAY}' then 40.0 else 20.0 end) as r,
  10 * log10(avg(pow(10, sv / 10))) as v, count(sv) as n from live where sv is not null group by all)
select day, platform, segment, count(*) as n_mvbs_cells, sum(n)::bigint as n_mvbs_samples, round(sum(v), 4) as mvbs_sum from cells group by all""")

REGISTRY = {
    "job_process_many": (q_job_process_many, JOB_PROCESS_MANY_SQL),
    "job_reprocess_day": (q_job_reprocess_day, JOB_REPROCESS_DAY_SQL),
    "scan_samples": (q_scan_samples, SCAN_SAMPLES_SQL),
    "sink_day_append": (q_sink_day_append, SINK_DAY_APPEND_SQL),
    "sink_metadata_json": (q_sink_metadata_json, SINK_METADATA_JSON_SQL),
    "job_process_segment": (q_job_process_segment, JOB_PROCESS_SEGMENT_SQL),
    "job_process_files": (q_job_process_files, JOB_PROCESS_FILES_SQL),
}
