"""Registered queries: segment/file/run summaries, quality notes, instrument metadata, statistics, rasters."""

from __future__ import annotations

from pyspark.sql import functions as F

from acoustispark.functions import scalars as fn
from acoustispark.operators import calibrate as cal
from acoustispark.operators import summary as sm
from acoustispark.plans.common import rounded
from acoustispark.plans.oracle_views import with_views
from acoustispark.sources import fixtures as fx
from acoustispark.sources.tables import read_table

CAL_FREQ_SQL = """cal as (select channel_id as channel,
        coalesce(nullif(frequency, 0), 200000.0::double) as frequency_nominal from channel_cal_raw)"""


def _with_freq(spark, sf_dir):
    c = cal.channel_cal(fx.channel_cal_raw(spark, sf_dir)).select(F.col("channel_id").alias("channel"),
                                                                   F.col("frequency").alias("frequency_nominal"))
    return fx.samples(spark, sf_dir).join(c, "channel")


def _freq_list(c):
    return F.array_join(F.transform(c, lambda x: x.cast("bigint").cast("string")), ",")


def _pings_with_freq(spark, sf_dir):
    c = cal.channel_cal(fx.channel_cal_raw(spark, sf_dir)).select(F.col("channel_id").alias("channel"),
                                                                   F.col("frequency").alias("frequency_nominal"))
    return fx.pings(spark, sf_dir).drop("angle_along", "angle_athwart").join(c, "channel")


def q_segment_summary(spark, sf_dir):
    s = sm.segment_summary(_pings_with_freq(spark, sf_dir))
    return rounded(s.select("platform", "segment", "n_pings", "n_channels", "start_time", "end_time", "depth_min",
                            "depth_max", "lat_min", "lat_max", "lon_min", "lon_max", "sv_mean_db",
                            F.array_join("channels", ",").alias("channels"),
                            _freq_list("frequencies_hz").alias("frequencies_hz"),
                            F.date_format("day", "yyyy-MM-dd").alias("day"), "segment_name"))


SEGMENT_SUMMARY_CTE = CAL_FREQ_SQL + """,
s as (select * from samples join cal using (channel)),
chs as (select platform, segment, string_agg(channel, ',' order by channel_index) as channels,
               string_agg(frequency_nominal::bigint::varchar, ',' order by channel_index) as frequencies_hz, count(*) as n_channels
        from (select distinct platform, segment, channel_index, channel, frequency_nominal from s) group by all),
a as (select platform, segment, count(distinct ping_time) as n_pings,
             min(ping_time) as start_time, max(ping_time) as end_time, bool_or(echo_range is not null) as hr,
             min(echo_range) as r0, max(echo_range) as r1, min(depth) as d0, max(depth) as d1,
             min(nullif(lat, 0)) as lat_min, max(nullif(lat, 0)) as lat_max,
             min(nullif(lon, 0)) as lon_min, max(nullif(lon, 0)) as lon_max, round_even(avg(sv), 1) as sv_mean_db
      from s group by all),
summary as (
select platform, segment, n_pings, n_channels, start_time, end_time,
       round(case when hr then r0 else d0 end, 6) as depth_min, round(case when hr then r1 else d1 end, 6) as depth_max,
       round(lat_min, 6) as lat_min, round(lat_max, 6) as lat_max, round(lon_min, 6) as lon_min,
       round(lon_max, 6) as lon_max, round(sv_mean_db, 6) as sv_mean_db, channels, frequencies_hz,
       strftime(start_time, '%Y-%m-%d') as day, strftime(start_time, '%H-%M-%S') || '__' || strftime(end_time, '%H-%M-%S')
       as segment_name
from a join chs using (platform, segment))"""

SEGMENT_SUMMARY_SQL = with_views(["samples", "channel_cal_raw"], f"""
with {SEGMENT_SUMMARY_CTE}
select * from summary""")


FREQ_OF_FLAG = "case channel when 'chA' then 38000.0 when 'chN' then 70000.0 else 120000.0 end"


def q_file_summary(spark, sf_dir):
    s = fx.samples_big(spark, sf_dir).withColumn("file", F.col("segment")).withColumn(
        "frequency_nominal", F.expr(FREQ_OF_FLAG).cast("double"))
    return rounded(sm.file_summary(s))


FILE_SUMMARY_SQL = with_views(["samples_big"], f"""
select segment as file, count(distinct ping_time) as file_npings, max(range_sample) + 1 as file_nsamples,
       min(ping_time) as start_time, max(ping_time) as end_time,
       array_to_string(list_sort(list_distinct(list(({FREQ_OF_FLAG})::double::bigint::varchar))), ',') as file_freqs,
       round(min(echo_range), 6) as start_depth, round(max(echo_range), 6) as end_depth,
       round(arg_min(lat, (ping_time, ping, range_sample, lat)), 6) as start_lat,
       round(arg_max(lat, (ping_time, ping, range_sample, lat)), 6) as end_lat,
       round(arg_min(lon, (ping_time, ping, range_sample, lon)), 6) as start_lon,
       round(arg_max(lon, (ping_time, ping, range_sample, lon)), 6) as end_lon,
       round((epoch_us(max(ping_time)) - epoch_us(min(ping_time))) / 1e6, 6) as duration_s
from samples_big group by all""")


def q_run_summary(spark, sf_dir):
    r = sm.run_summary(fx.file_results(spark, sf_dir))
    return rounded(r.select("campaign", "n_ok", "n_failed", "n_skipped", "n_total", "total_pings",
                            F.array_join(F.transform("frequencies", lambda f: fn.fmt_freq(f)), ", ").alias("frequencies")))


RUN_SUMMARY_CTE = """c as (select campaign, count(*) filter (where status = 'ok') as n_ok, count(*) filter (where status = 'error') as n_failed,
                  count(*) filter (where status = 'skipped') as n_skipped, count(*) as n_total,
                  coalesce(sum(n_pings) filter (where status = 'ok'), 0)::bigint as total_pings
           from file_results group by all),
f as (select campaign, list_sort(list_distinct(list(fr))) as fl
      from (select campaign, unnest(frequencies) as fr from file_results where status = 'ok') group by all)"""

RUN_SUMMARY_SQL = with_views(["file_results"], f"""
with {RUN_SUMMARY_CTE}
select c.*, array_to_string(list_transform(fl, lambda x: case when x >= 1000 then floor(x / 1000)::bigint::varchar || ' kHz'
                                                         else x::bigint::varchar || ' Hz' end), ', ') as frequencies
from c left join f using (campaign)""")


def q_quality_notes(spark, sf_dir):
    return sm.quality_notes(fx.file_results(spark, sf_dir))


QUALITY_NOTES_CTE = """r as (
  select campaign, source_file,
         case status when 'error' then 1 when 'skipped' then 2 when 'ok' then 3 end as kind,
         case when status = 'error' then 'Failed — ' || coalesce(error, 'unknown error')
              when status = 'skipped' then 'Skipped — ' || coalesce(reason, '')
              when status = 'ok' then nullif(concat_ws('; ',
                   case when denoise_status <> 'ok' and contains(denoise_status, 'error') then 'denoise: ' || denoise_status end,
                   case when contains(nasc_status, 'skipped') then 'NASC: ' || nasc_status end,
                   case when seabed_status <> 'ok' and contains(seabed_status, 'error') then 'seabed: ' || seabed_status end), '')
         end as note
  from file_results),
g as (select campaign from file_results group by all having count(*) filter (where status in ('error', 'skipped')) > 0),
notes as (select campaign, kind, source_file, '- **' || coalesce(source_file, '?') || '**: ' || note as note
from r where note is not null and campaign in (select campaign from g))"""

QUALITY_NOTES_SQL = with_views(["file_results"], f"""
with {QUALITY_NOTES_CTE}
select * from notes""")


def _variables(spark, sf_dir):
    s = _with_freq(spark, sf_dir)
    per_ping = s.select("channel", "ping", "lat", "frequency_nominal").distinct()
    a = per_ping.select("channel", F.lit("ping_lat").alias("variable"), F.lit(1).alias("ndim"), F.col("lat").alias("value"))
    b = per_ping.select("channel", F.lit("transmit_power"), F.lit(1), F.lit(100.0))
    c = per_ping.select("channel", F.lit("noise_level"), F.lit(1),
                        F.when(F.col("ping") % 3 != 0, F.lit(-120.0) + F.col("ping") * F.lit(0.1)))
    d = per_ping.select("channel", "frequency_nominal").distinct().select(
        "channel", F.lit("frequency_nominal"), F.lit(1), F.col("frequency_nominal"))
    e = s.select("channel", F.lit("sv_cells"), F.lit(2), F.col("sv"))
    f = s.select("channel", F.lit("Sv"), F.lit(2), F.col("sv"))
    return a.unionAll(b).unionAll(c).unionAll(d).unionAll(e).unionAll(f)


VARS_SQL = """vars as (
  select channel, 'ping_lat' as variable, 1 as ndim, lat as value from pp
  union all select channel, 'transmit_power', 1, 100.0::double from pp
  union all select channel, 'noise_level', 1, case when ping % 3 <> 0 then -120.0::double + ping * 0.1::double end from pp
  union all select distinct channel, 'frequency_nominal', 1, frequency_nominal from pp
  union all select channel, 'sv_cells', 2, sv from s
  union all select channel, 'Sv', 2, sv from s),
stats as (
  select channel, variable, n,
         case when n = 1 or (nd = 1 and nv = n and mn = mx) then 'scalar' when nd = 1 then 'range' else 'moments' end as kind,
         case when n = 1 then one when nd = 1 and nv = n and mn = mx then mn end as value,
         mn, mx, av, sd
  from (select channel, variable, count(*) as n, count(value) as nv, max(ndim) as nd, min(value) as mn, max(value) as mx,
               avg(value) as av, stddev_pop(value) as sd, first(value) as one from vars group by all))"""


def q_variable_stats(spark, sf_dir):
    return rounded(sm.variable_stats(_variables(spark, sf_dir)))


VARIABLE_STATS_SQL = with_views(["samples", "channel_cal_raw"], f"""
with {CAL_FREQ_SQL},
s as (select * from samples join cal using (channel)),
pp as (select distinct channel, ping, lat, frequency_nominal from s),
{VARS_SQL}
select channel, variable, n, kind, round(value, 6) as value,
       round(case when kind = 'range' then mn end, 6) as v_min, round(case when kind = 'range' then mx end, 6) as v_max,
       round(case when kind <> 'scalar' then av end, 6) as v_mean, round(case when kind <> 'scalar' then sd end, 6) as v_std
from stats""")


STD_CTE = f"""std(f_std, name) as (values {', '.join(f"({f}, '{n}')" for f, n in sm.STANDARD_CHANNELS)})"""


def _std_sql(f: str) -> str:
    """The name at the smallest distance, the lower frequency on a tie."""
    return f"(select arg_min(name, (abs({f} - f_std), f_std)) from std)"


def q_instrument_metadata(spark, sf_dir):
    stats = sm.variable_stats(_variables(spark, sf_dir))
    chans = _with_freq(spark, sf_dir).select("channel", "channel_index", "frequency_nominal").distinct()
    return rounded(sm.instrument_metadata(stats, chans))


INSTRUMENT_METADATA_SQL = with_views(["samples", "channel_cal_raw"], f"""
with {CAL_FREQ_SQL},
s as (select * from samples join cal using (channel)),
pp as (select distinct channel, ping, lat, frequency_nominal from s),
{VARS_SQL},
{STD_CTE},
ch as (select channel, channel_index, {_std_sql('frequency_nominal')} as standard_channel from (select distinct channel, channel_index, frequency_nominal from s)),
usable as (select * from stats where variable not in ({', '.join(repr(v) for v in sm.EXCLUDED_VARIABLES)})),
names as (select channel, channel_index, standard_channel, unnest([{', '.join(repr(v) for v in sm.METADATA_VARIABLES)}]) as variable
          from ch
          union select ch.channel, channel_index, standard_channel, variable from usable join ch using (channel)),
rows as (select n.*, u.kind, u.value, case when u.kind = 'range' then u.mn end as v_min,
                case when u.kind = 'range' then u.mx end as v_max, case when u.kind <> 'scalar' then u.av end as v_mean,
                case when u.kind <> 'scalar' then u.sd end as v_std
         from names n left join usable u using (channel, variable))
select standard_channel, variable, arg_max(kind, channel_index) as kind, round(arg_max(value, channel_index), 6) as value,
       round(arg_max(v_min, channel_index), 6) as v_min, round(arg_max(v_max, channel_index), 6) as v_max,
       round(arg_max(v_mean, channel_index), 6) as v_mean, round(arg_max(v_std, channel_index), 6) as v_std
from rows group by all""")


def q_standard_channel(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", (F.col("p_size") * F.lit(4000.0)).alias("frequency"),
                    sm.standard_channel(F.col("p_size") * F.lit(4000.0)).alias("standard_channel"))


STANDARD_CHANNEL_SQL = f"""
with {STD_CTE}
select p_partkey, p_size * 4000.0::double as frequency, {_std_sql('p_size * 4000.0::double')} as standard_channel from part"""


def q_numeric_stats(spark, sf_dir):
    return rounded(sm.numeric_stats(fx.samples(spark, sf_dir), ["platform", "segment", "channel"], "sv"))


NUMERIC_STATS_SQL = with_views(["samples"], """
select platform, segment, channel, round(avg(sv), 6) as mean, round(min(sv), 6) as min, round(max(sv), 6) as max,
       round(stddev_pop(sv), 6) as std from samples group by all""")


def q_categorical_stats(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return sm.categorical_stats(ev, ["user_id"], "event_type")


CATEGORICAL_STATS_SQL = """
with c as (select user_id, event_type as value, count(*) as n from events group by all)
select user_id, value, n, first_value(value) over w as most_frequent, first_value(n) over w as most_count
from c window w as (partition by user_id order by n desc, value rows between unbounded preceding and unbounded following)"""


def q_echogram_raster(spark, sf_dir):
    return rounded(sm.echogram_raster(fx.pings(spark, sf_dir)))


ECHOGRAM_RASTER_SQL = with_views(["samples"], """
with s as (select * from samples where sv is not null),
b as (select platform, segment, channel, epoch_us(min(ping_time)) as t0, epoch_us(max(ping_time)) as t1,
             min(depth) as d0, max(depth) as d1 from s group by all),
c as (select s.platform, s.segment, s.channel,
             case when t1 = t0 then 0 else least(floor((epoch_us(ping_time) - t0) * 64 / (t1 - t0)), 63) end as x,
             case when d1 = d0 then 0 else least(floor((depth - d0) * 32 / (d1 - d0)), 31) end as y,
             case when avg(pow(10.0, sv / 10.0)) > 0 then 10.0 * log10(avg(pow(10.0, sv / 10.0))) end as sv
      from s join b using (platform, segment, channel) group by all)
select platform, segment, channel, x::bigint as x, y::bigint as y, round(sv, 6) as sv,
       round((least(greatest(sv, -80.0), -30.0) - -80.0) / 50.0, 6) as value,
       round((least(greatest(sv, -80.0), -50.0) - -80.0) / 30.0, 6) as value_channel from c""")

GRID_KEYS = ("platform", "segment", "channel", "channel_index")


def q_echogram_raster_mvbs(spark, sf_dir):
    from acoustispark.operators import grid
    return rounded(sm.mvbs_raster(grid.mvbs(fx.samples(spark, sf_dir), "20m", "20s", keys=GRID_KEYS)).drop("channel_index"))


ECHOGRAM_RASTER_MVBS_SQL = with_views(["samples"], """
with m as (select platform, segment, channel, channel_index, time_bucket(interval '20 seconds', ping_time) as ping_time,
                  floor(echo_range / 20.0)::double * 20.0 as echo_range, 10 * log10(avg(pow(10, sv / 10))) as sv, count(sv) as n_samples
           from samples where sv is not null and echo_range is not null group by all)
select platform, segment, channel, ping_time, echo_range, round(sv, 6) as sv, n_samples,
       round((least(greatest(sv, -80.0), -30.0) + 80.0) / 50.0, 6) as value
from m where channel_index = (select min(channel_index) from m x where x.platform = m.platform and x.segment = m.segment)""")


def q_echogram_raster_nasc(spark, sf_dir):
    from acoustispark.operators import grid
    return rounded(sm.nasc_raster(grid.nasc(fx.samples(spark, sf_dir), "10m", "0.05nmi")).select(
        "platform", "segment", "channel", "distance", "echo_range", "value"))


def _nasc_raster_sql():
    from acoustispark.plans.grids import NASC_SQL
    exact = NASC_SQL.strip().replace("round(4 * pi() * 1852.0 * 1852.0 * m * 10.0, 6) as nasc", "4 * pi() * 1852.0 * 1852.0 * m * 10.0 as nasc")
    return f"""
with n as ({exact}),
f as (select * from n where channel = (select min(channel) from n x where x.platform = n.platform and x.segment = n.segment)),
p as (select platform, segment, quantile_cont(nasc, 0.95) as p95 from f group by all)
select platform, segment, channel, distance, echo_range, round(case when p95 > 0 then least(nasc / p95, 1.0) else 0.0 end, 6) as value
from f join p using (platform, segment)"""


ECHOGRAM_RASTER_NASC_SQL = _nasc_raster_sql()


REGISTRY = {
    "segment_summary": (q_segment_summary, SEGMENT_SUMMARY_SQL),
    "file_summary": (q_file_summary, FILE_SUMMARY_SQL),
    "run_summary": (q_run_summary, RUN_SUMMARY_SQL),
    "quality_notes": (q_quality_notes, QUALITY_NOTES_SQL),
    "variable_stats": (q_variable_stats, VARIABLE_STATS_SQL),
    "instrument_metadata": (q_instrument_metadata, INSTRUMENT_METADATA_SQL),
    "standard_channel": (q_standard_channel, STANDARD_CHANNEL_SQL),
    "numeric_stats": (q_numeric_stats, NUMERIC_STATS_SQL),
    "categorical_stats": (q_categorical_stats, CATEGORICAL_STATS_SQL),
    "echogram_raster": (q_echogram_raster, ECHOGRAM_RASTER_SQL),
    "echogram_raster_mvbs": (q_echogram_raster_mvbs, ECHOGRAM_RASTER_MVBS_SQL),
    "echogram_raster_nasc": (q_echogram_raster_nasc, ECHOGRAM_RASTER_NASC_SQL),
}
