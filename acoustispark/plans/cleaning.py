"""Registered queries: denoise methods and chain, seabed detection and mask."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import functions as F

from acoustispark.operators import calibrate as cal
from acoustispark.operators import denoise as dn
from acoustispark.operators.pings import to_samples
from acoustispark.plans.common import rounded
from acoustispark.plans.oracle_views import with_views
from acoustispark.sources import fixtures as fx

P = dn.DenoiseParams()
ALPHA = 0.01
SEGC = "platform, segment, channel"
OUT_COLS = "platform, segment, channel, ping, range_sample, round(sv, 5) as sv"


def _pings(spark, sf_dir):
    return fx.pings(spark, sf_dir).drop("angle_along", "angle_athwart")


def _out(pings):
    return rounded(to_samples(pings).select("platform", "segment", "channel", "ping", "range_sample", "sv"), 5)


def indexed_sql(src: str, name: str) -> str:
    return f"""{name} as (
  select s.*, i.ping_index from {src} s join (
    select platform, segment, ping_time, row_number() over (partition by platform, segment order by ping_time) - 1
           as ping_index from (select distinct platform, segment, ping_time from {src})) i
  using (platform, segment, ping_time))"""


def background_sql(src: str, name: str, snr: str = repr(P.snr_threshold)) -> str:
    return f"""{name}_s as (
  select *, 20.0 * log10(greatest(echo_range, 1.0)) + 2.0 * {ALPHA!r} * echo_range as tvg,
         floor(ping_index / {P.ping_window}) as pb, floor(range_sample / {P.range_window}) as rb from {src}),
{name}_b as (select {SEGC}, pb, rb, avg(pow(10.0, (sv - tvg) / 10.0)) as m from {name}_s where sv is not null
             group by all),
{name}_n as (select {SEGC}, pb, min(case when m > 0 then 10.0 * log10(m) end) as noise from {name}_b group by all),
{name}_j as (select s.*, n.noise, pow(10.0, s.sv / 10.0) - pow(10.0, (n.noise + s.tvg) / 10.0) as diff
             from {name}_s s left join {name}_n n using (platform, segment, channel, pb)),
{name} as (
  select * exclude (sv, tvg, pb, rb, diff),
         case when noise is null then sv
              when diff > 0 and 10.0 * log10(diff) - (noise + tvg) >= {snr} then 10.0 * log10(diff) end as sv
  from {name}_j)"""


def sliding_background_sql(src: str, name: str) -> str:
    """Noise from the pings numbered within num_side_pings, by a range join on ping numbers."""
    return f"""{name}_s as (
  select *, 20.0 * log10(greatest(echo_range, 1.0)) + 2.0 * {ALPHA!r} * echo_range as tvg, floor(range_sample / {P.range_window}) as rb from {src}),
{name}_c as (select {SEGC}, ping_index, rb, sum(pow(10.0, (sv - tvg) / 10.0)) as s, count(sv) as n from {name}_s where sv is not null group by all),
{name}_p as (select distinct {SEGC}, ping_index from {src}),
{name}_m as (select p.platform, p.segment, p.channel, p.ping_index, c.rb, sum(c.s) / sum(c.n) as m from {name}_p p join {name}_c c
             on c.platform = p.platform and c.segment = p.segment and c.channel = p.channel
             and c.ping_index between p.ping_index - {P.num_side_pings} and p.ping_index + {P.num_side_pings} group by all),
{name}_n as (select {SEGC}, ping_index, min(case when m > 0 then 10.0 * log10(m) end) as noise from {name}_m group by all),
{name}_j as (select s.*, n.noise, pow(10.0, s.sv / 10.0) - pow(10.0, (n.noise + s.tvg) / 10.0) as diff
             from {name}_s s left join {name}_n n using (platform, segment, channel, ping_index)),
{name} as (
  select * exclude (sv, tvg, rb, diff),
         case when noise is null then sv
              when diff > 0 and 10.0 * log10(diff) - (noise + tvg) >= {P.snr_threshold!r} then 10.0 * log10(diff) end as sv
  from {name}_j)"""


def _cells_sql(src: str, bin_expr: str) -> str:
    return f"""select {SEGC}, ping_time, ping_index, {bin_expr} as bn,
         case when avg(pow(10.0, sv / 10.0)) > 0 then 10.0 * log10(avg(pow(10.0, sv / 10.0))) end as m
  from {src} where sv is not null group by all"""


def transient_sql(src: str, name: str) -> str:
    b = f"floor(depth / {P.transient_depth_bin!r})"
    return f"""{name}_c as ({_cells_sql(src, b)}),
{name}_m as (select *, quantile_cont(m, 0.5) over (partition by {SEGC}, bn order by ping_index
             range between {P.transient_n_pings} preceding and {P.transient_n_pings} following) as med from {name}_c),
{name}_bad as (select {SEGC}, ping_time, bn from {name}_m
               where bn * {P.transient_depth_bin!r} >= {P.transient_exclude_above!r} and m - med > {P.transient_threshold_db!r}),
{name} as (
  select s.* exclude (sv), case when b.bn is null then s.sv end as sv
  from {src} s left join {name}_bad b on s.platform = b.platform and s.segment = b.segment and s.channel = b.channel
       and s.ping_time = b.ping_time and {b.replace('depth', 's.depth')} = b.bn)"""


def impulse_sql(src: str, name: str) -> str:
    """Neighbours by a self join on the ping number, not by position."""
    b = f"floor(depth / {P.impulse_vertical_bin!r})"
    lags = P.impulse_ping_lags or list(range(1, P.impulse_num_lags + 1))
    t = repr(P.impulse_threshold_db)
    same = "x.platform = c.platform and x.segment = c.segment and x.channel = c.channel and x.bn = c.bn"
    found = " union ".join(
        f"""select c.platform, c.segment, c.channel, c.ping_time, c.bn from {name}_c c
      join {name}_c p on {same.replace('x.', 'p.')} and p.ping_index = c.ping_index - {k}
      join {name}_c n on {same.replace('x.', 'n.')} and n.ping_index = c.ping_index + {k}
      where c.m - p.m > {t} and c.m - n.m > {t}""" for k in lags)
    return f"""{name}_c as ({_cells_sql(src, b)}),
{name}_bad as ({found}),
{name} as (
  select s.* exclude (sv), case when b.bn is null then s.sv end as sv
  from {src} s left join {name}_bad b on s.platform = b.platform and s.segment = b.segment and s.channel = b.channel
       and s.ping_time = b.ping_time and {b.replace('depth', 's.depth')} = b.bn)"""


def attenuation_sql(src: str, name: str) -> str:
    return f"""{name}_p as (
  select {SEGC}, ping_time, ping_index, quantile_cont(sv, 0.5) as pm from {src}
  where sv is not null and depth between {P.attenuation_upper_limit!r} and {P.attenuation_lower_limit!r} group by all),
{name}_b as (select *, quantile_cont(pm, 0.5) over (partition by {SEGC} order by ping_index
             range between {P.attenuation_side_pings} preceding and {P.attenuation_side_pings} following) as bm
             from {name}_p),
{name}_bad as (select {SEGC}, ping_time from {name}_b where bm - pm > {P.attenuation_threshold!r}),
{name} as (
  select s.* exclude (sv), case when b.ping_time is null then s.sv end as sv
  from {src} s left join {name}_bad b using (platform, segment, channel, ping_time))"""


def q_denoise_background(spark, sf_dir):
    return _out(dn.background(_pings(spark, sf_dir), P, absorption=ALPHA))


DENOISE_BACKGROUND_SQL = with_views(["samples"], f"""
with {indexed_sql('samples', 'si')},
{background_sql('si', 'bg')}
select {OUT_COLS} from bg""")


def q_denoise_transient(spark, sf_dir):
    return _out(dn.transient(_pings(spark, sf_dir), P))


DENOISE_TRANSIENT_SQL = with_views(["samples"], f"""
with {indexed_sql('samples', 'si')},
{transient_sql('si', 'tr')}
select {OUT_COLS} from tr""")


def q_denoise_impulse(spark, sf_dir):
    return _out(dn.impulse(_pings(spark, sf_dir), P))


DENOISE_IMPULSE_SQL = with_views(["samples"], f"""
with {indexed_sql('samples', 'si')},
{impulse_sql('si', 'im')}
select {OUT_COLS} from im""")


def q_denoise_attenuation(spark, sf_dir):
    return _out(dn.attenuation(_pings(spark, sf_dir), P))


DENOISE_ATTENUATION_SQL = with_views(["samples"], f"""
with {indexed_sql('samples', 'si')},
{attenuation_sql('si', 'att')}
select {OUT_COLS} from att""")


def q_denoise_chain(spark, sf_dir):
    return _out(dn.denoise(_pings(spark, sf_dir), dn.DEFAULT_METHODS, P, absorption=ALPHA))


DENOISE_CHAIN_SQL = with_views(["samples"], f"""
with {indexed_sql('samples', 'si')},
{background_sql('si', 'bg')},
{transient_sql('bg', 'tr')},
{impulse_sql('tr', 'im')},
{attenuation_sql('im', 'att')}
select {OUT_COLS} from att""")


def q_denoise_background_sliding(spark, sf_dir):
    return _out(dn.background(_pings(spark, sf_dir), replace(P, mode="sliding"), absorption=ALPHA))


DENOISE_BACKGROUND_SLIDING_SQL = with_views(["samples"], f"""
with {indexed_sql('samples', 'si')},
{sliding_background_sql('si', 'bg')}
select {OUT_COLS} from bg""")


def _frequencies(spark, sf_dir):
    return cal.channel_cal(fx.channel_cal_raw(spark, sf_dir)).select(
        F.col("channel_id").alias("channel"), F.col("frequency").alias("frequency_nominal"))


def q_denoise_freq_params(spark, sf_dir):
    pings = _pings(spark, sf_dir).join(_frequencies(spark, sf_dir), "channel")
    pings = dn.with_frequency_params(pings, fx.frequency_params(spark, sf_dir))
    return _out(dn.denoise(pings, "background,impulse,attenuation", P, absorption=ALPHA))


# thresholds of a channel's frequency; the common value where the table says nothing
_FREQ_SRC = f"""si as (
  select x.*, coalesce(f.snr_threshold, {P.snr_threshold!r}) as p_snr, coalesce(f.impulse_threshold_db, {P.impulse_threshold_db!r}) as p_imp,
         coalesce(f.attenuation_threshold, {P.attenuation_threshold!r}) as p_att
  from si0 x join (select channel_id as channel, coalesce(nullif(frequency, 0), 200000.0::double) as fr from channel_cal_raw) c using (channel)
  left join frequency_params f on f.frequency_nominal = c.fr),
par as (select distinct channel, p_imp, p_att from si)"""

DENOISE_FREQ_PARAMS_SQL = with_views(["samples", "channel_cal_raw", "frequency_params"], f"""
with {indexed_sql('samples', 'si0')},
{_FREQ_SRC},
{background_sql('si', 'bg', 'p_snr')},
{impulse_sql('bg', 'im').replace(f'> {P.impulse_threshold_db!r}', '> (select p_imp from par where par.channel = c.channel)')},
{attenuation_sql('im', 'att').replace(f'> {P.attenuation_threshold!r}', '> (select p_att from par where par.channel = att_b.channel)')}
select {OUT_COLS} from att""")


def q_denoise_freq_windows(spark, sf_dir):
    """Window sizes of each channel's frequency: the sliding noise window, the transient and the attenuation medians."""
    pings = _pings(spark, sf_dir).join(_frequencies(spark, sf_dir), "channel")
    pings = dn.with_frequency_params(pings, fx.frequency_windows(spark, sf_dir))
    return _out(dn.denoise(pings, "background,transient,attenuation", WINDOWS_P, absorption=ALPHA))


WINDOWS_P = replace(P, mode="sliding", transient_exclude_above=100.0, transient_threshold_db=3.0)


def _own_windows(sql: str) -> str:
    """The oracle of one width, with a channel's own width instead: windows become joins on ping numbers."""
    side = f"{P.num_side_pings}"
    own = lambda c, alias: f"(select {c} from width where width.channel = {alias}.channel)"
    sql = sql.replace(f"p.ping_index - {side} and p.ping_index + {side}", f"p.ping_index - {own('num_side', 'p')} and p.ping_index + {own('num_side', 'p')}")
    tr = f"(select *, quantile_cont(m, 0.5) over (partition by {SEGC}, bn order by ping_index\n             range between {P.transient_n_pings} preceding and {P.transient_n_pings} following) as med from tr_c)"
    assert tr in sql
    sql = sql.replace(tr, f"""(select c.*, (select quantile_cont(x.m, 0.5) from tr_c x where x.platform = c.platform and x.segment = c.segment
      and x.channel = c.channel and x.bn = c.bn and abs(x.ping_index - c.ping_index) <= w.tr_side) as med from tr_c c join width w using (channel))""")
    at = f"(select *, quantile_cont(pm, 0.5) over (partition by {SEGC} order by ping_index\n             range between {P.attenuation_side_pings} preceding and {P.attenuation_side_pings} following) as bm\n             from att_p)"
    assert at in sql
    return sql.replace(at, """(select c.*, (select quantile_cont(x.pm, 0.5) from att_p x where x.platform = c.platform and x.segment = c.segment
      and x.channel = c.channel and abs(x.ping_index - c.ping_index) <= w.at_side) as bm from att_p c join width w using (channel))""")


DENOISE_FREQ_WINDOWS_SQL = with_views(["samples", "channel_cal_raw", "frequency_windows"], f"""
with {indexed_sql('samples', 'si')},
width as (select c.channel, coalesce(num_side_pings, {P.num_side_pings}) as num_side, coalesce(transient_n_pings, {P.transient_n_pings}) as tr_side,
  coalesce(attenuation_side_pings, {P.attenuation_side_pings}) as at_side
  from (select channel_id as channel, coalesce(nullif(frequency, 0), 200000.0::double) as fr from channel_cal_raw) c
  left join frequency_windows f on f.frequency_nominal = c.fr),
known as (select s.* from si s where channel in (select channel from width)),
""" + _own_windows(f"""{sliding_background_sql('known', 'bg')},
{transient_sql('bg', 'tr').replace(f'>= {P.transient_exclude_above!r}', '>= 100.0').replace(f'> {P.transient_threshold_db!r}', '> 3.0')},
{attenuation_sql('tr', 'att')}
select {OUT_COLS} from att"""))


REGISTRY = {
    "denoise_freq_windows": (q_denoise_freq_windows, DENOISE_FREQ_WINDOWS_SQL),
    "denoise_background": (q_denoise_background, DENOISE_BACKGROUND_SQL),
    "denoise_transient": (q_denoise_transient, DENOISE_TRANSIENT_SQL),
    "denoise_impulse": (q_denoise_impulse, DENOISE_IMPULSE_SQL),
    "denoise_attenuation": (q_denoise_attenuation, DENOISE_ATTENUATION_SQL),
    "denoise_chain": (q_denoise_chain, DENOISE_CHAIN_SQL),
    "denoise_background_sliding": (q_denoise_background_sliding, DENOISE_BACKGROUND_SLIDING_SQL),
    "denoise_freq_params": (q_denoise_freq_params, DENOISE_FREQ_PARAMS_SQL),
}

# ---- seabed ------------------------------------------------------------------------------------------------

from acoustispark.operators import seabed as sb  # noqa: E402

PINGK = "platform, segment, channel, ping_time"
TH = -60.0

MAXSV_CTE = f"""maxsv as (
  select {PINGK}, min(depth) filter (where sv = mx) as seabed_depth, max(mx) as mx from (
    select *, max(sv) over (partition by {PINGK}) as mx from samples where sv is not null and depth <= 1000.0)
  group by all having max(mx) > {TH!r})"""

DELTASV_CTE = f"""deltasv as (
  select {PINGK}, min(depth) as seabed_depth from (
    select *, sv - lag(sv) over (partition by {PINGK} order by range_sample) as g
    from samples where sv is not null and depth <= 1000.0)
  where g > 20.0 group by all)"""


def _line(df):
    return rounded(df.where(F.col("seabed_depth").isNotNull()).select("platform", "segment", "channel", "ping_time", "seabed_depth"))


def q_seabed_maxsv(spark, sf_dir):
    return _line(sb.maxsv(_pings(spark, sf_dir), threshold=TH))


SEABED_MAXSV_SQL = with_views(["samples"], f"""
with {MAXSV_CTE}
select {PINGK}, round(seabed_depth, 6) as seabed_depth from maxsv""")


def q_seabed_deltasv(spark, sf_dir):
    return _line(sb.deltasv(_pings(spark, sf_dir)))


SEABED_DELTASV_SQL = with_views(["samples"], f"""
with {DELTASV_CTE}
select {PINGK}, round(seabed_depth, 6) as seabed_depth from deltasv""")


def q_seabed_ariza(spark, sf_dir):
    return _line(sb.ariza(_pings(spark, sf_dir), threshold=TH))


SEABED_ARIZA_SQL = with_views(["samples"], f"""
with s as (select *, coalesce((sv > {TH!r})::int, 0) as m from samples where depth <= 1000.0),
e as (select *, min(m) over (partition by {PINGK} order by range_sample rows between 1 preceding and 1 following) as e
      from s),
d as (select *, max(e) over (partition by platform, segment, channel, range_sample order by ping_time
                             rows between 1 preceding and 1 following) as d from e)
select {PINGK}, round(min(depth), 6) as seabed_depth from d where d = 1 group by all""")


def q_seabed_composite(spark, sf_dir):
    return _line(sb.composite(_pings(spark, sf_dir), threshold=TH))


SEABED_COMPOSITE_SQL = with_views(["samples"], f"""
with {MAXSV_CTE}, {DELTASV_CTE}
select {PINGK}, round(coalesce(least(a.seabed_depth, b.seabed_depth), a.seabed_depth, b.seabed_depth), 6) as seabed_depth
from maxsv a full join deltasv b using (platform, segment, channel, ping_time)""")


def q_seabed_mask(spark, sf_dir):
    return rounded(to_samples(sb.mask_seabed(sb.detect_seabed(_pings(spark, sf_dir), "maxSv", threshold=TH)).drop("seabed_depth")).select(
        "platform", "segment", "channel", "ping", "range_sample", "sv"))


SEABED_MASK_SQL = with_views(["samples"], f"""
with {MAXSV_CTE}
select s.platform, s.segment, s.channel, ping, range_sample,
       round(case when m.seabed_depth is null or s.depth < m.seabed_depth then sv end, 6) as sv
from samples s left join maxsv m using (platform, segment, channel, ping_time)""")


def q_seabed_blackwell(spark, sf_dir):
    pings = cal.add_splitbeam_angle(fx.pings(spark, sf_dir), fx.angle_cal(spark, sf_dir))
    return _line(sb.blackwell(pings, angle_threshold=ANGLE_TH))


ANGLE_TH = 1.0
SEABED_BLACKWELL_SQL = with_views(["samples", "angle_cal"], f"""
with a as (select s.*, angle_along * (180.0::double / 128.0::double) / angle_sensitivity_alongship - angle_offset_alongship as al,
                  angle_athwart * (180.0::double / 128.0::double) / angle_sensitivity_athwartship - angle_offset_athwartship as aw
           from samples s left join angle_cal c on c.channel_id = s.channel where depth <= 1000.0),
r as (select *, avg(al * al + aw * aw) over (partition by {PINGK} order by range_sample rows between 2 preceding and 2 following) as r from a),
f as (select *, avg(r) over (partition by platform, segment, channel, range_sample order by ping_time
                             rows between 2 preceding and 2 following) as f from r),
k as (select * from f where f > {ANGLE_TH * ANGLE_TH!r}),
m as (select {PINGK}, quantile_cont(sv, 0.5) as med from k where sv is not null group by all)
select {PINGK}, round(min(depth), 6) as seabed_depth from k join m using ({PINGK}) where sv > med group by all""")


REGISTRY.update({
    "seabed_blackwell": (q_seabed_blackwell, SEABED_BLACKWELL_SQL),
    "seabed_maxsv": (q_seabed_maxsv, SEABED_MAXSV_SQL),
    "seabed_deltasv": (q_seabed_deltasv, SEABED_DELTASV_SQL),
    "seabed_ariza": (q_seabed_ariza, SEABED_ARIZA_SQL),
    "seabed_composite": (q_seabed_composite, SEABED_COMPOSITE_SQL),
    "seabed_mask": (q_seabed_mask, SEABED_MASK_SQL),
})


# ---- connected regions -----------------------------------------------------------------------------------------

def _regions_sql(mask: str, keep: str) -> str:
    """Runs of a 0/1 column ``m`` of ``mask`` (with ``hit``), linked over neighbouring pings; ``keep`` chooses the regions."""
    return f"""ix as (select platform, segment, ping_time, row_number() over (partition by platform, segment order by ping_time) as pi
  from (select distinct platform, segment, ping_time from samples)),
cellr as (select *, range_sample - row_number() over (partition by {PINGK} order by range_sample) as grp from {mask} where m = 1),
runr as (select {PINGK}, grp, min(range_sample) as a, max(range_sample) as b, min(depth) as d, bool_or(hit) as hit from cellr group by all),
node as (select r.*, pi, row_number() over () as id from runr r join ix using (platform, segment, ping_time)),
link as (select x.id as u, y.id as v from node x join node y on x.platform = y.platform and x.segment = y.segment and x.channel = y.channel
  and abs(x.pi - y.pi) = 1 and x.a <= y.b and y.a <= x.b),
reach as (select id as u, id as v from node union select r.u, l.v from reach r join link l on l.u = r.v),
root as (select u as id, min(v) as region from reach group by u),
lab as (select node.*, region from node join root using (id)),
size as (select platform, segment, channel, region, count(distinct pi) as p, sum(b - a + 1) as n, min((pi, a)) as first, bool_or(hit) as hit from lab group by all),
kept as ({keep})
select {PINGK}, round(min(d), 6) as seabed_depth from lab join kept using (region) group by all"""


REGION_TH = -72.0


def q_seabed_ariza_regions(spark, sf_dir):
    return _line(sb.ariza(_pings(spark, sf_dir), threshold=REGION_TH, regions=True))


SEABED_ARIZA_REGIONS_SQL = with_views(["samples"], f"""
with recursive s as (select *, coalesce((sv > {REGION_TH!r})::int, 0) as t from samples where depth <= 1000.0),
e as (select *, min(t) over (partition by {PINGK} order by range_sample rows between 1 preceding and 1 following) as e from s),
mk as (select * exclude (e), max(e) over (partition by platform, segment, channel, range_sample order by ping_time
  rows between 1 preceding and 1 following) as m, false as hit from e),
{_regions_sql("mk", "select region from size qualify row_number() over (partition by platform, segment, channel order by p desc, n desc, first) = 1")}""")


def q_seabed_blackwell_regions(spark, sf_dir):
    pings = cal.add_splitbeam_angle(fx.pings(spark, sf_dir), fx.angle_cal(spark, sf_dir))
    return _line(sb.blackwell(pings, angle_threshold=ANGLE_TH, regions=True))


_CANDIDATES = SEABED_BLACKWELL_SQL[SEABED_BLACKWELL_SQL.index("a as (select s.*"):SEABED_BLACKWELL_SQL.index("\nselect platform, segment, channel, ping_time, round(min(depth)")]
SEABED_BLACKWELL_REGIONS_SQL = with_views(["samples", "angle_cal"], f"""
with recursive {_CANDIDATES},
mk as (select f.*, coalesce((f.sv > m.med)::int, 0) as m, coalesce(f.f > {ANGLE_TH * ANGLE_TH!r}, false) as hit from f left join m using ({PINGK})),
{_regions_sql("mk", "select region from size where hit")}""")

REGISTRY.update({
    "seabed_ariza_regions": (q_seabed_ariza_regions, SEABED_ARIZA_REGIONS_SQL),
    "seabed_blackwell_regions": (q_seabed_blackwell_regions, SEABED_BLACKWELL_REGIONS_SQL),
})
