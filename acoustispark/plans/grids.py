"""Registered queries: MVBS and NASC grids."""

from __future__ import annotations


from acoustispark.operators import grid
from acoustispark.plans.common import rounded
from acoustispark.plans.oracle_views import with_views
from acoustispark.sources import fixtures as fx


def q_mvbs(spark, sf_dir):
    return rounded(grid.mvbs(fx.samples(spark, sf_dir), "0.5m", "10s"))


MVBS_SQL = with_views(["samples"], """
select platform, segment, channel, time_bucket(interval '10 seconds', ping_time) as ping_time,
       floor(echo_range / 0.5)::double * 0.5 as echo_range,
       round(10 * log10(avg(pow(10, sv / 10))), 6) as sv, count(sv) as n_samples
from samples where sv is not null and echo_range is not null
group by all""")


def q_mvbs_big(spark, sf_dir):
    return rounded(grid.mvbs(fx.samples_big(spark, sf_dir), "100m", "1h"))


MVBS_BIG_SQL = with_views(["samples_big"], """
select platform, segment, channel, time_bucket(interval '1 hour', ping_time) as ping_time,
       floor(echo_range / 100.0)::double * 100.0 as echo_range,
       round(10 * log10(avg(pow(10, sv / 10))), 6) as sv, count(sv) as n_samples
from samples_big where sv is not null and echo_range is not null
group by all""")


def q_nasc(spark, sf_dir):
    return rounded(grid.nasc(fx.samples(spark, sf_dir), "10m", "0.05nmi"))


NASC_SQL = with_views(["samples"], """
with per_ping as (
  select platform, segment, ping_time, max(lat) as lat, max(lon) as lon from samples group by all),
steps as (
  select *, coalesce(2 * 6371.0088 / 1.852 * asin(sqrt(
            pow(sin((radians(lat) - radians(lag(lat) over w)) / 2), 2)
          + cos(radians(lag(lat) over w)) * cos(radians(lat))
            * pow(sin((radians(lon) - radians(lag(lon) over w)) / 2), 2))), 0) as step
  from per_ping where lat is not null and lon is not null
  window w as (partition by platform, segment order by ping_time)),
dist as (
  select platform, segment, ping_time,
         floor(sum(step) over (partition by platform, segment order by ping_time
                               rows between unbounded preceding and current row) / 0.05) as dbin
  from steps),
cells as (
  select platform, segment, channel, ping_time, floor(echo_range / 10.0) as rbin,
         sum(pow(10, sv / 10)) as lin, count(sv) as n
  from samples where sv is not null and echo_range is not null group by all),
agg as (
  select c.platform, c.segment, channel, dbin, rbin, sum(lin) / sum(n) as m, sum(n)::bigint as n_samples
  from cells c join dist d using (platform, segment, ping_time) group by all)
select platform, segment, channel, round(dbin * 0.05, 6) as distance, rbin * 10.0 as echo_range,
       round(4 * pi() * 1852.0 * 1852.0 * m * 10.0, 6) as nasc,
       round(case when m > 0 then 10 * log10(4 * pi() * 1852.0 * 1852.0 * m * 10.0) end, 6) as nasc_log, n_samples
from agg""")


REGISTRY = {
    "mvbs": (q_mvbs, MVBS_SQL),
    "mvbs_big": (q_mvbs_big, MVBS_BIG_SQL),
    "nasc": (q_nasc, NASC_SQL),
}
