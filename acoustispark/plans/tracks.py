"""Registered queries: GPS tracks, as-of location joins, navigation."""

from __future__ import annotations

from pyspark.sql import functions as F

from acoustispark.functions import scalars as fn
from acoustispark.operators import track as tr
from acoustispark.plans.common import rounded
from acoustispark.plans.oracle_views import with_views
from acoustispark.sources import fixtures as fx

HAV_K = repr(2 * fn.EARTH_RADIUS_KM / fn.KM_PER_NMI)


def hav_sql(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    """The haversine expression of ``fn.haversine_nmi`` in DuckDB SQL, same operation order."""
    return (f"({HAV_K} * asin(sqrt(pow(sin((radians({lat2}) - radians({lat1})) / 2), 2) + "
            f"cos(radians({lat1})) * cos(radians({lat2})) * pow(sin((radians({lon2}) - radians({lon1})) / 2), 2))))")


W = "(partition by platform, segment order by ts, event_id)"
VALID_SQL = "select * from nav where lat is not null and lon is not null and lat between -90 and 90 and lon between -180 and 180"


def _fit_sql(col: str) -> str:
    """Value at t of the least-squares quadratic through the 11 points around (or at the end of) the track, from the
    normal equations in centred time u = -5..5, whose power sums are 11, 110 and 1958."""
    det = "(11.0::double * 1958.0 - 110.0 * 110.0)"
    a = f"((1958.0::double * sum({col}) - 110.0 * sum({col} * u * u)) / {det})"
    b = f"(sum({col} * u) / 110.0::double)"
    c = f"((11.0::double * sum({col} * u * u) - 110.0 * sum({col})) / {det})"
    return f"{a} + {b} * any_value(t) + {c} * any_value(t) * any_value(t)"


SMOOTH_CTE = f"""
valid as ({VALID_SQL}),
numbered as (select *, row_number() over {W} - 1 as i, count(*) over (partition by platform, segment) as n from valid),
centred as (select *, greatest(5, least(i, n - 6)) as mid from numbered where n > 11),
smooth as (
  select platform, segment, event_id, ts, {_fit_sql('plat')} as lat, {_fit_sql('plon')} as lon
  from (select x.platform, x.segment, x.event_id, x.ts, x.i - x.mid as t, p.i - x.mid as u, p.lat as plat, p.lon as plon
        from centred x join numbered p on p.platform = x.platform and p.segment = x.segment and p.i between x.mid - 5 and x.mid + 5)
  group by platform, segment, event_id, ts
  union all
  select platform, segment, event_id, ts, lat, lon from numbered where n <= 11)"""

DIST_CTE = SMOOTH_CTE + f""",
dist as (select *, coalesce({hav_sql(f'lag(lat) over {W}', f'lag(lon) over {W}', 'lat', 'lon')}, 0.0) as distance,
                (epoch_us(ts) - epoch_us(lag(ts) over {W})) / 1e6 as dts from smooth),
speed as (select platform, segment, event_id, ts, lat, lon, distance,
                 case when dts <> 0 then distance / dts * 3600.0 end as knt from dist)"""


def _nav(spark, sf_dir):
    return fx.nav(spark, sf_dir)


def q_gps_valid(spark, sf_dir):
    return rounded(tr.gps_valid(_nav(spark, sf_dir)).select("platform", "event_id", "lat", "lon"))


GPS_VALID_SQL = with_views(["nav"], f"""
select platform, event_id, round(lat, 6) as lat, round(lon, 6) as lon from ({VALID_SQL})""")


def q_gps_nonzero(spark, sf_dir):
    return rounded(tr.gps_nonzero(_nav(spark, sf_dir)))


GPS_NONZERO_SQL = with_views(["nav"], """
select platform, segment, round(min(nullif(lat, 0)), 6) as lat_min, round(max(nullif(lat, 0)), 6) as lat_max,
       round(min(nullif(lon, 0)), 6) as lon_min, round(max(nullif(lon, 0)), 6) as lon_max
from nav group by all""")


def _smooth(spark, sf_dir):
    return tr.track_smooth(tr.gps_valid(_nav(spark, sf_dir)))


def q_track_smooth(spark, sf_dir):
    return rounded(_smooth(spark, sf_dir).select("platform", "segment", "event_id", "lat", "lon"))


TRACK_SMOOTH_SQL = with_views(["nav"], f"""
with {SMOOTH_CTE}
select platform, segment, event_id, round(lat, 6) as lat, round(lon, 6) as lon from smooth""")


def _speed(spark, sf_dir):
    return tr.track_speed(tr.track_distance(_smooth(spark, sf_dir)))


def q_track_distance(spark, sf_dir):
    return rounded(_speed(spark, sf_dir).select("platform", "segment", "event_id", "distance"))


TRACK_DISTANCE_SQL = with_views(["nav"], f"""
with {DIST_CTE}
select platform, segment, event_id, round(distance, 6) as distance from speed""")


def q_track_speed(spark, sf_dir):
    return rounded(_speed(spark, sf_dir).select("platform", "segment", "event_id", "knt"), 5)


TRACK_SPEED_SQL = with_views(["nav"], f"""
with {DIST_CTE}
select platform, segment, event_id, round(knt, 5) as knt from speed""")


def q_speed_filter(spark, sf_dir):
    return rounded(tr.speed_filter(_speed(spark, sf_dir)).select("platform", "segment", "event_id", "lat", "lon"))


SPEED_FILTER_SQL = with_views(["nav"], f"""
with {DIST_CTE}
select platform, segment, event_id, round(lat, 6) as lat, round(lon, 6) as lon from speed where knt < 100""")


def q_track_thin_distance(spark, sf_dir):
    return rounded(tr.track_thin_distance(tr.gps_valid(_nav(spark, sf_dir))).select("platform", "segment", "event_id",
                                                                                   "lat", "lon"))


TRACK_THIN_DISTANCE_SQL = with_views(["nav"], f"""
with recursive pts as (select platform, segment, event_id, lat, lon, row_number() over {W} as i from ({VALID_SQL})),
walk as (
  select platform, segment, i, event_id, lat as klat, lon as klon, true as keep from pts where i = 1
  union all
  select p.platform, p.segment, p.i, p.event_id,
         case when {hav_sql('w.klat', 'w.klon', 'p.lat', 'p.lon')} >= 0.01 then p.lat else w.klat end,
         case when {hav_sql('w.klat', 'w.klon', 'p.lat', 'p.lon')} >= 0.01 then p.lon else w.klon end,
         {hav_sql('w.klat', 'w.klon', 'p.lat', 'p.lon')} >= 0.01
  from walk w join pts p on p.platform = w.platform and p.segment = w.segment and p.i = w.i + 1)
select platform, segment, event_id, round(klat, 6) as lat, round(klon, 6) as lon from walk where keep""")


# Simplification in SQL: intervals (lo, hi) of a track are split at their farthest point while that is beyond epsilon.
# Equal ends (numpy.allclose with its default tolerances) use the distance to the first end.
_CLOSE = "(abs(a.lat - b.lat) <= 1e-8 + 1e-5 * abs(b.lat) and abs(a.lon - b.lon) <= 1e-8 + 1e-5 * abs(b.lon))"
_LEN = "sqrt((b.lat - a.lat) * (b.lat - a.lat) + (b.lon - a.lon) * (b.lon - a.lon))"
_PROJ = f"greatest(0.0, least(1.0, (((p.lat - a.lat) / {_LEN}) * ((b.lat - a.lat) / {_LEN}) + ((p.lon - a.lon) / {_LEN}) * ((b.lon - a.lon) / {_LEN}))))"
_DIST = f"""case when {_CLOSE} then sqrt((p.lat - a.lat) * (p.lat - a.lat) + (p.lon - a.lon) * (p.lon - a.lon))
  else sqrt(pow(p.lat - (a.lat + {_PROJ} * (b.lat - a.lat)), 2) + pow(p.lon - (a.lon + {_PROJ} * (b.lon - a.lon)), 2)) end"""

SETTLED_CTE = DIST_CTE.replace("from smooth)", "from settled)").replace("dist as (", "settled as (select * replace (round(lat, 9) as lat, round(lon, 9) as lon) from smooth),\ndist as (", 1)

FILTERED_CTE = SETTLED_CTE + f""",
pts as (select *, row_number() over {W} - 1 as i, count(*) over (partition by platform, segment) as n from speed where knt < 100),
iv as (
  select platform, segment, 0::bigint as lo, max(n) - 1 as hi, false as split from pts group by platform, segment
  union all
  select platform, segment, case when side = 0 then lo else k end, case when side = 0 then k else hi end, false
  from (select v.platform, v.segment, v.lo, v.hi, arg_max(p.i, ({_DIST}, -p.i)) as k, max({_DIST}) as d
        from iv v join pts a on a.platform = v.platform and a.segment = v.segment and a.i = v.lo
        join pts b on b.platform = v.platform and b.segment = v.segment and b.i = v.hi
        join pts p on p.platform = v.platform and p.segment = v.segment and p.i > v.lo and p.i < v.hi
        group by v.platform, v.segment, v.lo, v.hi having max({_DIST}) > {tr.RDP_EPSILON!r}), (select unnest([0, 1]) as side)),
ends as (select distinct platform, segment, lo as i from iv union select distinct platform, segment, hi from iv),
kept as (select p.*, (select min(q.i) from pts q where q.platform = p.platform and q.segment = p.segment and q.lat = p.lat and q.lon = p.lon) as src
         from pts p join ends e on e.platform = p.platform and e.segment = p.segment and e.i = p.i),
rdp as (select k.platform, k.segment, k.i as pos, s.event_id, s.ts, s.lat, s.lon, s.knt
        from kept k join pts s on s.platform = k.platform and s.segment = k.segment and s.i = k.src)"""

THIN_CTE = FILTERED_CTE + f""",
num as (select *, row_number() over (partition by platform, segment order by pos) as r from rdp),
walk as (
  select platform, segment, r, event_id, ts, lat, lon, knt, lat as klat, lon as klon, true as keep from num where r = 1
  union all
  select p.platform, p.segment, p.r, p.event_id, p.ts, p.lat, p.lon, p.knt,
         case when {hav_sql('w.klat', 'w.klon', 'p.lat', 'p.lon')} >= 0.01 then p.lat else w.klat end,
         case when {hav_sql('w.klat', 'w.klon', 'p.lat', 'p.lon')} >= 0.01 then p.lon else w.klon end,
         {hav_sql('w.klat', 'w.klon', 'p.lat', 'p.lon')} >= 0.01
  from walk w join num p on p.platform = w.platform and p.segment = w.segment and p.r = w.r + 1),
track as (select platform, segment, event_id, ts, round(lat, 6) as lat, round(lon, 6) as lon, round(knt, 6) as knt from walk where keep)"""


def q_track_simplify_rdp(spark, sf_dir):
    t = tr.track_speed(tr.track_distance(tr.settled(_smooth(spark, sf_dir))))
    return rounded(tr.simplify_rdp(tr.speed_filter(t)))


TRACK_SIMPLIFY_RDP_SQL = with_views(["nav"], f"""
with recursive {FILTERED_CTE.strip()}
select platform, segment, event_id, ts, round(lat, 6) as lat, round(lon, 6) as lon, round(knt, 6) as knt from rdp""")


def q_extract_track(spark, sf_dir):
    return rounded(tr.extract_track(_nav(spark, sf_dir)))


EXTRACT_TRACK_SQL = with_views(["nav"], f"""
with recursive {THIN_CTE.strip()}
select * from track""")


def q_sample_track_points(spark, sf_dir):
    return rounded(tr.sample_track_points(tr.gps_valid(_nav(spark, sf_dir)), 5)
                   .select("platform", "segment", "event_id", "lat", "lon"))


SAMPLE_TRACK_POINTS_SQL = with_views(["nav"], f"""
select platform, segment, event_id, round(lat, 6) as lat, round(lon, 6) as lon from (
  select *, row_number() over {W} - 1 as i, count(*) over (partition by platform, segment) as t from ({VALID_SQL}))
where t <= 5 or (i % greatest(t // 5, 1) = 0 and i // greatest(t // 5, 1) < 5)""")


def q_location_messages(spark, sf_dir):
    return tr.location_messages(rounded(tr.extract_track(_nav(spark, sf_dir))), 5)


ISO_SQL = "case when epoch_us(ts) % 1000000 = 0 then strftime(ts, '%Y-%m-%dT%H:%M:%S') else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') end"
MESSAGE_SQL = f"json_object('location', json_object('lat', lat, 'lon', lon), 'timestamp', {ISO_SQL}, 'speed_knots', knt)::varchar"

LOCATION_MESSAGES_SQL = with_views(["nav"], f"""
with recursive {THIN_CTE.strip()},
t as (select *, row_number() over {W} - 1 as i, count(*) over (partition by platform, segment) as c from track)
select platform, segment, event_id, {MESSAGE_SQL} as message from t
where c <= 5 or (i % greatest(c // 5, 1) = 0 and i // greatest(c // 5, 1) < 5)""")


def q_add_location(spark, sf_dir):
    return rounded(tr.add_location(fx.targets(spark, sf_dir), fx.fixes(spark, sf_dir)))


ADD_LOCATION_SQL = with_views(["fixes", "targets"], """
with p as (
  select t.platform, t.ts, t.event_id, f.ts as fix_ts, f.lat as fix_lat, f.lon as fix_lon
  from targets t asof left join fixes f on t.platform = f.platform and t.ts >= f.ts),
q as (
  select p.*, n.ts as nts, n.lat as nlat, n.lon as nlon
  from p asof left join fixes n on p.platform = n.platform and p.ts < n.ts)
select platform, ts, event_id, round(fix_lat, 6) as fix_lat, round(fix_lon, 6) as fix_lon, fix_ts,
       round(case when fix_ts is not null and nts is not null then fix_lat + (nlat - fix_lat) *
             (case when epoch_us(nts) = epoch_us(fix_ts) then 0.0
                   else (epoch_us(ts) - epoch_us(fix_ts)) / (epoch_us(nts) - epoch_us(fix_ts)) end) end, 6) as lat,
       round(case when fix_ts is not null and nts is not null then fix_lon + (nlon - fix_lon) *
             (case when epoch_us(nts) = epoch_us(fix_ts) then 0.0
                   else (epoch_us(ts) - epoch_us(fix_ts)) / (epoch_us(nts) - epoch_us(fix_ts)) end) end, 6) as lon
from q""")


def q_nav_carry_forward(spark, sf_dir):
    return rounded(tr.nav_carry_forward(_nav(spark, sf_dir)).select("platform", "event_id", "lat_cf", "lon_cf"))


NAV_CARRY_FORWARD_SQL = with_views(["nav"], """
select platform, event_id,
       round(coalesce(last(nullif(lat, 0) ignore nulls) over w, 0.0), 6) as lat_cf,
       round(coalesce(last(nullif(lon, 0) ignore nulls) over w, 0.0), 6) as lon_cf
from nav window w as (partition by platform order by ts, event_id rows between unbounded preceding and current row)""")


def q_nav_stream(spark, sf_dir):
    return rounded(tr.nav_poll(_nav(spark, sf_dir), 5))


NAV_STREAM_SQL = with_views(["nav"], """
select platform, time_bucket(interval '5 seconds', ts) as bucket,
       arg_min(ts, (ts, event_id)) as ts, arg_min(event_id, (ts, event_id)) as event_id,
       round(arg_min(lat, (ts, event_id)), 6) as lat, round(arg_min(lon, (ts, event_id)), 6) as lon,
       round(arg_min(heading, (ts, event_id)), 6) as heading
from nav group by all""")


def q_gps_lookup_back(spark, sf_dir):
    fixes = tr.gps_valid(_nav(spark, sf_dir)).withColumn("lat", F.round("lat", 2)).withColumn("lon", F.round("lon", 2)) \
        .withColumn("knt", F.col("heading"))
    points = fixes.select("platform", "segment", "lat", "lon").distinct()
    return rounded(tr.gps_lookup_back(points, fixes))


GPS_LOOKUP_BACK_SQL = with_views(["nav"], f"""
with f as (select platform, segment, event_id, ts, round(lat, 2) as lat, round(lon, 2) as lon, heading as knt
           from ({VALID_SQL}))
select platform, segment, round(lat, 6) as lat, round(lon, 6) as lon, ts, event_id, round(knt, 6) as knt from (
  select *, row_number() over (partition by platform, segment, lat, lon order by ts, event_id) as r from f) where r = 1""")


def q_ping_order(spark, sf_dir):
    return tr.ping_order(fx.samples(spark, sf_dir))


PING_ORDER_SQL = with_views(["samples"], """
select platform, segment, ping_time, row_number() over (partition by platform, segment order by ping_time) - 1 as ping_index
from (select distinct platform, segment, ping_time from samples)""")


def q_fn_haversine(spark, sf_dir):
    n = _nav(spark, sf_dir)
    return rounded(n.select("event_id", fn.haversine_nmi(F.lit(40.0), F.lit(-70.0), "lat", "lon").alias("nmi")))


FN_HAVERSINE_SQL = with_views(["nav"], f"""
select event_id, round({hav_sql('40.0', '-70.0', 'lat', 'lon')}, 6) as nmi from nav""")


def q_fn_location_message(spark, sf_dir):
    """Every second time has no fraction; the heading stands for the speed."""
    n = rounded(tr.gps_valid(_nav(spark, sf_dir)), 4)
    ts = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts").cast("timestamp_ntz")).otherwise(F.col("ts"))
    return n.select("event_id", fn.location_message("lat", "lon", ts, F.col("heading") + 0.5).alias("message"))


FN_LOCATION_MESSAGE_SQL = with_views(["nav"], f"""
with v as ({VALID_SQL}),
t as (select event_id, round(lat, 4) as lat, round(lon, 4) as lon, heading + 0.5 as knt,
             case when event_id % 2 = 0 then date_trunc('second', ts) else ts end as ts from v)
select event_id, {MESSAGE_SQL} as message from t""")


REGISTRY = {
    "gps_valid": (q_gps_valid, GPS_VALID_SQL),
    "gps_nonzero": (q_gps_nonzero, GPS_NONZERO_SQL),
    "track_smooth": (q_track_smooth, TRACK_SMOOTH_SQL),
    "track_distance": (q_track_distance, TRACK_DISTANCE_SQL),
    "track_speed": (q_track_speed, TRACK_SPEED_SQL),
    "speed_filter": (q_speed_filter, SPEED_FILTER_SQL),
    "track_thin_distance": (q_track_thin_distance, TRACK_THIN_DISTANCE_SQL),
    "track_simplify_rdp": (q_track_simplify_rdp, TRACK_SIMPLIFY_RDP_SQL),
    "extract_track": (q_extract_track, EXTRACT_TRACK_SQL),
    "sample_track_points": (q_sample_track_points, SAMPLE_TRACK_POINTS_SQL),
    "location_messages": (q_location_messages, LOCATION_MESSAGES_SQL),
    "add_location": (q_add_location, ADD_LOCATION_SQL),
    "nav_carry_forward": (q_nav_carry_forward, NAV_CARRY_FORWARD_SQL),
    "nav_stream": (q_nav_stream, NAV_STREAM_SQL),
    "gps_lookup_back": (q_gps_lookup_back, GPS_LOOKUP_BACK_SQL),
    "ping_order": (q_ping_order, PING_ORDER_SQL),
    "fn_haversine": (q_fn_haversine, FN_HAVERSINE_SQL),
    "fn_location_message": (q_fn_location_message, FN_LOCATION_MESSAGE_SQL),
}
