"""Registered queries: calibration, sonar equation and Sv enrichment."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from acoustispark.operators import calibrate as cal
from acoustispark.operators.pings import to_samples
from acoustispark.plans.common import rounded
from acoustispark.plans.oracle_views import with_views
from acoustispark.sources import fixtures as fx

PR_K = repr(10.0 * math.log10(2.0) / 256.0)
EQ_K = repr(32.0 * math.pi ** 2)
COS10 = repr(math.cos(math.radians(10.0)))

CAL_SQL_BODY = """
select channel_id, coalesce(nullif(transducer_name, ''), 'WBT') as transducer_name,
       coalesce(nullif(frequency, 0), 200000.0::double) as frequency,
       coalesce(nullif(transmit_power, 0), 100.0::double) as transmit_power,
       coalesce(nullif(pulse_length, 0), 0.001024::double) as pulse_length,
       coalesce(nullif(sample_interval, 0), 0.000016::double) as sample_interval,
       coalesce(nullif(gain, 0), 25.0::double) as gain,
       coalesce(nullif(sa_correction, 0), 0.0::double) as sa_correction,
       coalesce(nullif(equivalent_beam_angle, 0), -20.7::double) as equivalent_beam_angle,
       coalesce(nullif(beamwidth_alongship, 0), 7.0::double) as beamwidth_alongship,
       coalesce(nullif(beamwidth_athwartship, 0), 7.0::double) as beamwidth_athwartship,
       coalesce(nullif(sound_velocity, 0), 1500.0::double) as sound_velocity,
       coalesce(nullif(absorption_coefficient, 0), 0.0::double) as absorption_coefficient
from channel_cal_raw"""


def _cal(spark, sf_dir):
    return cal.channel_cal(fx.channel_cal_raw(spark, sf_dir))


def q_channel_cal(spark, sf_dir):
    return rounded(_cal(spark, sf_dir))


CHANNEL_CAL_SQL = with_views(["channel_cal_raw"], f"""
with c as ({CAL_SQL_BODY})
select channel_id, transducer_name, round(frequency, 6) as frequency, round(transmit_power, 6) as transmit_power,
       round(pulse_length, 6) as pulse_length, round(sample_interval, 6) as sample_interval, round(gain, 6) as gain,
       round(sa_correction, 6) as sa_correction, round(equivalent_beam_angle, 6) as equivalent_beam_angle,
       round(beamwidth_alongship, 6) as beamwidth_alongship, round(beamwidth_athwartship, 6) as beamwidth_athwartship,
       round(sound_velocity, 6) as sound_velocity, round(absorption_coefficient, 6) as absorption_coefficient
from c""")


def q_join_channel_cal(spark, sf_dir):
    j = cal.join_channel_cal(fx.raw_pings(spark, sf_dir).drop("samples"), _cal(spark, sf_dir))
    return rounded(j.select("platform", "channel_id", "ping", "ping_time", "frequency", "gain", "sound_velocity",
                            "transmit_power", "transducer_name"))


JOIN_CHANNEL_CAL_SQL = with_views(["raw_pings", "channel_cal_raw"], f"""
with c as ({CAL_SQL_BODY})
select platform, channel_id, ping, ping_time, round(frequency, 6) as frequency, round(gain, 6) as gain,
       round(sound_velocity, 6) as sound_velocity, round(transmit_power, 6) as transmit_power, transducer_name
from raw_pings join c using (channel_id)""")


def q_explode_samples(spark, sf_dir):
    return cal.explode_samples(fx.raw_pings(spark, sf_dir))


EXPLODE_SAMPLES_SQL = with_views(["raw_samples"], """
select platform, channel_id, ping, ping_time, range_sample, raw from raw_samples""")


def _sv(spark, sf_dir):
    return cal.compute_sv(fx.raw_pings(spark, sf_dir), _cal(spark, sf_dir))


def q_compute_sv(spark, sf_dir):
    return rounded(_sv(spark, sf_dir))


SV_SQL_BODY = f"""
select platform, channel_id, ping, ping_time, range_sample, echo_range,
       case when echo_range > 0 then
         raw::double * {PR_K} + 20.0 * log10(echo_range) + 2.0 * absorption_coefficient * echo_range
         - 10.0 * log10(transmit_power * (sound_velocity / frequency) * (sound_velocity / frequency) * sound_velocity
                        * pulse_length * pow(10.0, equivalent_beam_angle / 10.0) * pow(10.0, gain / 10.0)
                        * pow(10.0, gain / 10.0) / {EQ_K})
         - 2.0 * sa_correction end as sv,
       frequency as frequency_nominal
from (select s.*, c.*,
             case when sound_velocity * sample_interval * range_sample / 2.0 > 0
                  then sound_velocity * sample_interval * range_sample / 2.0 end as echo_range
      from raw_samples s join c using (channel_id))"""

COMPUTE_SV_SQL = with_views(["raw_samples", "channel_cal_raw"], f"""
with c as ({CAL_SQL_BODY}), sv as ({SV_SQL_BODY})
select platform, channel_id, ping, ping_time, range_sample, round(echo_range, 6) as echo_range, round(sv, 6) as sv,
       round(frequency_nominal, 6) as frequency_nominal
from sv""")


def _pings(spark, sf_dir):
    return fx.pings(spark, sf_dir).drop("angle_along", "angle_athwart")


def q_add_depth(spark, sf_dir):
    s = _pings(spark, sf_dir).drop("depth")
    return rounded(to_samples(cal.add_depth(s, depth_offset=5.0, tilt=10.0, downward=True))
                   .select("channel", "ping", "range_sample", "depth"))


ADD_DEPTH_SQL = with_views(["samples"], f"""
select channel, ping, range_sample, round(5.0::double + echo_range * {COS10}, 6) as depth from samples""")


def q_drop_empty_pings(spark, sf_dir):
    return rounded(to_samples(cal.drop_empty_pings(_pings(spark, sf_dir))).select("channel", "ping", "range_sample", "sv"))


DROP_EMPTY_PINGS_SQL = with_views(["samples"], """
select channel, ping, range_sample, round(sv, 6) as sv from samples s
where exists (select 1 from samples t where t.sv is not null and t.platform = s.platform and t.segment = s.segment
              and t.ping_time = s.ping_time)""")


def q_correct_echo_range(spark, sf_dir):
    s = cal.drop_empty_pings(_pings(spark, sf_dir))
    return rounded(to_samples(cal.correct_echo_range(s, depth_offset=5.0))
                   .select("segment", "channel", "ping", "range_sample", "range_axis", "sv"))


CORRECT_ECHO_RANGE_SQL = with_views(["samples"], """
with live as (
  select * from samples s where exists (select 1 from samples t where t.sv is not null and t.platform = s.platform
        and t.segment = s.segment and t.ping_time = s.ping_time)),
first as (select platform, segment, min(channel_index) as ci from live group by all),
first2 as (select l.platform, l.segment, f.ci, min(l.ping_time) as t0
           from live l join first f using (platform, segment) where l.channel_index = f.ci group by all),
axis as (select l.platform, l.segment, range_sample, echo_range + 5.0 as range_axis
         from live l join first2 f on l.platform = f.platform and l.segment = f.segment
         where l.channel_index = f.ci and l.ping_time = f.t0)
select l.segment, channel, ping, range_sample, round(range_axis, 6) as range_axis, round(sv, 6) as sv
from live l join axis a using (platform, segment, range_sample) where range_axis is not null""")


def q_depth_axis(spark, sf_dir):
    """Depth is empty at the first ping of ch1, has one value there in ch2, and both axes end early."""
    s = _pings(spark, sf_dir)
    first = F.col("ping") % 25 == 0
    d = F.transform("depth", lambda x, i: F.when(~(first & (F.col("channel_index") == 1)) & ~(first & (F.col("channel_index") == 2) & (i > 0)), x))
    r = F.transform("echo_range", lambda x, i: F.when(i < 60 - F.col("channel_index") * 7, x))
    return rounded(cal.depth_axis(s.withColumn("depth", d).withColumn("echo_range", r)))


DEPTH_AXIS_SQL = with_views(["samples"], """
with s as (select platform, segment, channel, ping_time, range_sample,
                  case when not (ping % 25 = 0 and channel_index = 1) and not (ping % 25 = 0 and channel_index = 2 and range_sample > 0)
                       then depth end as depth,
                  case when range_sample < 60 - channel_index * 7 then echo_range end as echo_range from samples),
f as (select platform, segment, channel, min(ping_time) as ping_time from s group by all),
a as (select s.* from s join f using (platform, segment, channel, ping_time)),
l as (select platform, segment, channel, coalesce(max(range_sample) filter (depth is not null), -1) as ld,
             coalesce(max(range_sample) filter (echo_range is not null), -1) as lr from a group by all)
select platform, segment, channel, range_sample, round(case when ld > 0 then depth else echo_range end, 6) as axis
from a join l using (platform, segment, channel)
where range_sample <= case when ld > 0 then ld when lr > 0 then lr else -1 end""")


def q_product_select(spark, sf_dir):
    s = _pings(spark, sf_dir).withColumn("channel_index", (F.col("channel_index") + 3) % 4)
    return rounded(to_samples(cal.product_select(s)).select("segment", "channel", "ping", "range_sample", "sv"))


PRODUCT_SELECT_SQL = with_views(["samples"], """
with s as (select *, (channel_index + 3) % 4 as ci from samples)
select segment, channel, ping, range_sample, round(sv, 6) as sv from s
where ci = (select min(ci) from s s2 where s2.platform = s.platform and s2.segment = s.segment)""")


def q_add_splitbeam_angle(spark, sf_dir):
    p = cal.add_splitbeam_angle(fx.pings(spark, sf_dir), fx.angle_cal(spark, sf_dir))
    return rounded(to_samples(p).select("platform", "channel", "ping", "range_sample", "angle_alongship", "angle_athwartship"))


ADD_SPLITBEAM_ANGLE_SQL = with_views(["samples", "angle_cal"], """
select platform, channel, ping, range_sample,
       round(angle_along * (180.0::double / 128.0::double) / angle_sensitivity_alongship - angle_offset_alongship, 6) as angle_alongship,
       round(angle_athwart * (180.0::double / 128.0::double) / angle_sensitivity_athwartship - angle_offset_athwartship, 6) as angle_athwartship
from samples left join angle_cal on angle_cal.channel_id = samples.channel""")


REGISTRY = {
    "channel_cal": (q_channel_cal, CHANNEL_CAL_SQL),
    "join_channel_cal": (q_join_channel_cal, JOIN_CHANNEL_CAL_SQL),
    "explode_samples": (q_explode_samples, EXPLODE_SAMPLES_SQL),
    "compute_sv": (q_compute_sv, COMPUTE_SV_SQL),
    "add_depth": (q_add_depth, ADD_DEPTH_SQL),
    "drop_empty_pings": (q_drop_empty_pings, DROP_EMPTY_PINGS_SQL),
    "correct_echo_range": (q_correct_echo_range, CORRECT_ECHO_RANGE_SQL),
    "depth_axis": (q_depth_axis, DEPTH_AXIS_SQL),
    "product_select": (q_product_select, PRODUCT_SELECT_SQL),
    "add_splitbeam_angle": (q_add_splitbeam_angle, ADD_SPLITBEAM_ANGLE_SQL),
}


def q_enrich_sv(spark, sf_dir):
    from acoustispark.operators.jobs import enrich_sv
    s = fx.pings(spark, sf_dir).drop("depth", "lat", "lon")
    out = enrich_sv(s, depth_offset=5.0, fixes=fx.ping_fixes(spark, sf_dir), cal_df=fx.angle_cal(spark, sf_dir))
    return rounded(to_samples(out).select("platform", "segment", "channel", "ping", "range_sample", "depth", "range_axis", "sv", "lat", "lon",
                                          "angle_alongship", "angle_athwartship"))


_FRAC = "(case when nts = pts then 0.0 else (epoch_us(ping_time) - epoch_us(pts)) / (epoch_us(nts) - epoch_us(pts)) end)"
ENRICH_SV_SQL = with_views(["samples", "ping_fixes", "angle_cal"], f"""
with live as (select * exclude (depth, lat, lon), 5.0::double + echo_range * 1.0 as depth from samples s
  where exists (select 1 from samples t where t.sv is not null and t.platform = s.platform
         and t.segment = s.segment and t.ping_time = s.ping_time)),
first as (select platform, segment, min(channel_index) as ci from live group by all),
first2 as (select l.platform, l.segment, f.ci, min(l.ping_time) as t0
           from live l join first f using (platform, segment) where l.channel_index = f.ci group by all),
axis as (select l.platform, l.segment, range_sample, echo_range + 5.0 as range_axis
         from live l join first2 f on l.platform = f.platform and l.segment = f.segment
         where l.channel_index = f.ci and l.ping_time = f.t0),
tp as (select distinct platform, ping_time from live),
p as (select tp.*, f.ts as pts, f.lat as plat, f.lon as plon from tp asof left join ping_fixes f
      on f.platform = tp.platform and tp.ping_time >= f.ts),
q as (select p.*, f.ts as nts, f.lat as nlat, f.lon as nlon from p asof left join ping_fixes f
      on f.platform = p.platform and p.ping_time < f.ts),
loc as (select platform, ping_time, case when pts is not null and nts is not null then plat + (nlat - plat) * {_FRAC} end as lat,
               case when pts is not null and nts is not null then plon + (nlon - plon) * {_FRAC} end as lon from q)
select l.platform, l.segment, l.channel, ping, range_sample, round(depth, 6) as depth, round(range_axis, 6) as range_axis,
       round(sv, 6) as sv, round(loc.lat, 6) as lat, round(loc.lon, 6) as lon,
       round(angle_along * (180.0::double / 128.0::double) / angle_sensitivity_alongship - angle_offset_alongship, 6) as angle_alongship,
       round(angle_athwart * (180.0::double / 128.0::double) / angle_sensitivity_athwartship - angle_offset_athwartship, 6) as angle_athwartship
from live l join axis a using (platform, segment, range_sample) join loc on loc.platform = l.platform and loc.ping_time = l.ping_time
left join angle_cal c on c.channel_id = l.channel where range_axis is not null""")

REGISTRY["enrich_sv"] = (q_enrich_sv, ENRICH_SV_SQL)
