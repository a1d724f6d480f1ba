"""DuckDB forms of the derived fixtures (see ``acoustispark.sources.fixtures``), used by the oracle SQL.

``with_views(["samples"], "select ...")`` prefixes a query with the CTEs it needs (dependencies included).
"""

from __future__ import annotations

from acoustispark.operators.config_log import CONFIG_FIELDS

VIEWS: dict[str, str] = {
    "samples": """
select 'p' || (vec_id // 100 % 3)::varchar as platform, 's' || (vec_id // 600)::varchar as segment,
       'ch' || (case when vec_id % 4 = 3 then 4 else vec_id % 4 end)::varchar as channel, (vec_id % 4)::int as channel_index,
       vec_id // 4 as ping, timestamp '2024-01-01 23:59:30' + to_seconds((vec_id // 4) * 2) as ping_time,
       (pos - 1)::int as range_sample, ((pos - 1) * 5.0)::double as echo_range, ((pos - 1) * 5.0)::double as depth,
       case when (vec_id // 4) % 41 = 0 or (vec_id * 31 + (pos - 1) * 17) % 97 = 0 then null
            else (-70.0)::double + (40.0)::double * x::double
                 + (case when (vec_id // 4) % 41 = 1 and (pos - 1) % 16 = 5 then 30.0 else 0.0 end)::double end as sv,
       (40.0)::double + (vec_id // 4) * 5e-4 as lat, (-70.0)::double + (vec_id // 4) * 3e-4 as lon,
       floor(x::double * 60) as angle_along, floor(x::double * 40 - (pos - 1)) as angle_athwart
from (select vec_id, unnest(embedding) as x, generate_subscripts(embedding, 1) as pos from embeddings)""",
    "samples_events": """
select 'v' || (event_id // 2 % 5)::varchar as platform, 'b' || (event_id // 400)::varchar as segment, event_id // 400 as block, event_id,
       'ch' || (event_id % 2)::varchar as channel, event_id // 2 as ping, timestamp '2024-01-01 00:00:00' + to_seconds((event_id // 2) * 120) as ping_time,
       i::int as range_sample, (i * 5.0)::double as echo_range,
       case when (event_id // 2 % 5 = 1 and event_id // 400 % 11 = 5) or (event_id + i) % 13 = 0 then null
            else (-60.0)::double - value % 30.0::double + i * 0.5::double end as sv
from events, range(12) r(i)""",
    "ping_fixes": """
select 'p' || (user_id % 3)::varchar as platform, event_id, timestamp '2024-01-01 23:59:30' + to_milliseconds(event_id * 50) as ts,
       40.0::double + value / 1e3 as lat, -70.0::double - value / 2e3 as lon from events""",
    "frequency_params": """
select case s_suppkey % 4 when 0 then 38000.0 when 1 then 70000.0 else 28000.0 end::double as frequency_nominal,
       max(case when s_suppkey % 4 <> 3 then s_suppkey % 4 + 1.0 end)::double as snr_threshold,
       max(case when s_suppkey % 4 = 1 then 4.0 end)::double as impulse_threshold_db,
       max((s_suppkey % 4) * 0.25 + 0.5)::double as attenuation_threshold
from supplier where s_suppkey % 4 <> 2 group by all""",
    "frequency_windows": """
select case s_suppkey % 4 when 0 then 38000.0 when 1 then 70000.0 else 28000.0 end::double as frequency_nominal,
       max(s_suppkey % 4 * 4 + 3) as num_side_pings, max(s_suppkey % 4 * 2 + 3) as transient_n_pings,
       max(case when s_suppkey % 4 <> 3 then s_suppkey % 4 * 5 + 2 end) as attenuation_side_pings
from supplier where s_suppkey % 4 <> 2 group by all""",
    "angle_cal": """
select 'ch' || s_suppkey::varchar as channel_id, 20.0::double + s_suppkey % 4 as angle_sensitivity_alongship,
       18.0::double + s_suppkey % 4 as angle_sensitivity_athwartship, ((s_suppkey % 4) * 0.5)::double as angle_offset_alongship,
       ((s_suppkey % 4) * -0.25)::double as angle_offset_athwartship from supplier""",
    "raw_pings": """
select 'p0' as platform, 'ch' || (vec_id % 4)::varchar as channel_id, vec_id // 4 as ping,
       timestamp '2024-01-01 00:00:00' + to_seconds((vec_id // 4) * 2) as ping_time,
       list_transform(embedding, lambda x: (floor(x::double * 4000) - 6000)::smallint) as samples
from embeddings""",
    "raw_samples": """
select platform, channel_id, ping, ping_time, (pos - 1)::int as range_sample, raw
from (select platform, channel_id, ping, ping_time, unnest(samples) as raw, generate_subscripts(samples, 1) as pos
      from raw_pings)""",
    "samples_big": """
select 'p0' as platform, strftime(l_shipdate, '%Y') as segment, 'ch' || l_returnflag as channel, l_orderkey as ping, l_shipdate as ping_time,
       l_linenumber - 1 as range_sample, l_linenumber * (50.0)::double as echo_range, (-90.0)::double + l_quantity as sv,
       (40.0)::double + l_partkey * 1e-4 as lat, (-70.0)::double + l_suppkey * 1e-3 as lon
from lineitem""",
    "channel_cal_raw": """
select 'ch' || s_suppkey::varchar as channel_id,
       case when s_suppkey % 4 = 3 then '' else 'ES' || s_nationkey::varchar end as transducer_name,
       case s_suppkey % 4 when 0 then 38000.0 when 1 then 70000.0 when 2 then 120000.0 else 28000.0 end::double as frequency,
       case when s_suppkey % 5 = 0 then 0.0::double else s_acctbal / 10.0::double + 100.0::double end as transmit_power,
       case when s_suppkey % 4 = 1 then 0.000512::double end as pulse_length,
       case when s_suppkey % 4 = 2 then 0.0::double else 1.6e-5 end as sample_interval,
       case s_suppkey % 4 when 0 then 0.0::double when 1 then 23.5::double when 3 then 27.0::double end as gain,
       case when s_suppkey % 4 = 1 then -0.5::double end as sa_correction,
       case when s_suppkey % 4 = 3 then -21.0::double end as equivalent_beam_angle,
       case when s_suppkey % 4 = 2 then 6.5::double end as beamwidth_alongship,
       case when s_suppkey % 4 = 2 then 6.6::double end as beamwidth_athwartship,
       case when s_suppkey % 4 <> 0 then 1480.0::double + (s_suppkey % 4) * 5.0::double end as sound_velocity,
       case when s_suppkey % 4 = 0 then 0.0::double else (s_suppkey % 4) * 0.01::double end as absorption_coefficient
from supplier""",
    "nav": """
select 'u' || user_id::varchar as platform, strftime(date_trunc('week', ts), '%Y-%m-%d') as segment, event_id, ts,
       (case when event_id % 53 = 0 then 0.0::double when event_id % 101 = 0 then 95.0::double
             when event_id % 59 = 0 then null
             else 40.0::double + (epoch_us(ts) - 1704067200000000) / 3.6e11 + (value - 50) / 1e5 end)::double as lat,
       (case when event_id % 53 = 0 then 0.0::double
             else -70.0::double + (epoch_us(ts) - 1704067200000000) / 2.88e11 - (event_id % 7) / 1e5 end)::double as lon,
       ((event_id * 7) % 360)::double as heading
from events""",
    "fixes": """
select 'u' || user_id::varchar as platform, event_id, ts, 40.0::double + value / 1e3 as lat, -70.0::double - value / 2e3 as lon
from events where event_type = 'signup'""",
    "targets": """
select 'u' || user_id::varchar as platform, event_id, ts from events where event_type <> 'signup'""",
    "file_results": """
select o_orderkey as file_id, 'f' || o_orderkey::varchar || '.raw' as source_file, o_orderdate::date as day, status,
       case when status = 'error' then 'convert failed: order ' || o_orderkey::varchar end as error,
       case when status = 'skipped' then 'no valid pings' end as reason,
       case when ok then 'seg' || (o_orderkey % 40)::varchar end as segment, o_orderkey % 5000 as n_pings, (o_orderkey % 3 + 1)::int as n_channels,
       case when ok and o_orderkey % 4 <> 0 then 40.0::double + o_orderkey % 100 / 100.0::double end as lat_min,
       case when ok and o_orderkey % 4 <> 0 then 41.0::double + o_orderkey % 100 / 100.0::double end as lat_max,
       case when ok and o_orderkey % 6 <> 0 then -70.0::double - o_orderkey % 10 / 8.0::double end as lon_min,
       case when ok and o_orderkey % 6 <> 0 then -69.5::double - o_orderkey % 10 / 8.0::double end as lon_max,
       case when ok then 'processed/' || base || '/sv' end as sv_path,
       case when ok and o_orderkey % 5 <> 0 then '/data/store/echodata/' || base || '.zarr' end as echodata_path,
       case when ok then (case when o_orderkey % 2 = 0 then ['sv', 'mvbs'] else ['sv'] end) end as products,
       case when ok and o_orderkey % 8 = 0 then ['echograms/' || base || '/sv_38kHz.png', 'echograms/' || base || '/mvbs_echogram.png'] end
            as echogram_files,
       list_sort(list_distinct([38000.0::double,
            case when o_orderkey % 2 = 0 then 120000.0::double else 70000.0::double end,
            case when o_orderkey % 3 = 0 then 200000.0::double else 38000.0::double end])) as frequencies,
       case when o_orderkey % 29 = 0 then 'error: empty grid' else 'ok' end as mvbs_status,
       case when o_orderpriority = '1-URGENT' then 'error: window' when o_orderpriority = '5-LOW' then 'skipped: no GPS'
            else 'ok' end as nasc_status,
       case when o_orderkey % 31 = 0 then 'error: singular block' else 'ok' end as denoise_status,
       case when o_orderkey % 37 = 0 then 'error: no bottom' else 'ok' end as seabed_status,
       o_orderkey % 997 * 13 + 250 as processing_time_ms, o_orderkey % 997 * 13 + 900 as total_time_ms,
       o_custkey as campaign
from (select *, status = 'ok' as ok, strftime(o_orderdate, '%Y-%m-%d') || '/f' || o_orderkey::varchar as base
      from (select *, case when o_orderkey % 17 = 0 then 'error' when o_orderkey % 23 = 0 then 'skipped' else 'ok' end as status from orders))""",
    "config_patches": """
select ts, event_id, user_id % 5 as device,
       case when event_type = 'view' then @str[event_id % len(@str) + 1] when event_type = 'signup' then @bool[event_id % len(@bool) + 1]
            when event_type = 'click' then @int[event_id % len(@int) + 1] when event_type = 'error' then 'Log_Level'
            when event_id % 3 = 0 then '$version' else @float[event_id % len(@float) + 1] end as key,
       case when event_type = 'signup' then
                 case event_id % 4 when 0 then 'false' when 1 then '{"value":"off"}' when 2 then 'null' else '1' end
            when event_type = 'click' then case when event_id % 3 = 0 then '"abc"' when event_id % 7 = 0 then '"99999999999999999999"'
                 when event_id % 11 = 0 then '1e22' when event_id % 13 = 0 then '1e60' else json_extract_string(props, '$.k') end
            else '{"value":"' || json_extract_string(props, '$.k') || '"}' end as raw_json
from events""",
    "commands": """
select event_id as command_id, ts,
       case event_type when 'click' then 'process_raw_files' when 'view' then 'process_day' when 'signup' then 'get_status'
            when 'purchase' then 'set_config' else 'reboot' end as command,
       case when event_type = 'click' then (case when event_id % 4 = 0 then []::varchar[]
            else ['raw/f' || event_id || '.raw', 'raw/g' || event_id || '.raw'] end) end as paths,
       case when event_type = 'view' then (case when event_id % 11 = 0 then 'yesterday'
            else '199' || (event_id % 7 + 2) || '-0' || (event_id % 9 + 1) || '-1' || (event_id % 10) end) end as date,
       case when event_type = 'purchase' then (case when event_id % 5 = 0 then '{}'
            else '{"mvbs_range_bin": "' || json_extract_string(props, '$.k') || '", "Log_Level": "DEBUG"}' end) end
            as config_json
from events""",
}

for _kind in ("str", "bool", "int", "float"):
    VIEWS["config_patches"] = VIEWS["config_patches"].replace(
        f"@{_kind}", "[" + ", ".join(f"'{n}'" for n, t, _ in CONFIG_FIELDS if t == _kind) + "]")

DEPENDS: dict[str, list[str]] = {
    "raw_samples": ["raw_pings"],
}


def with_views(names: list[str], body: str) -> str:
    """``WITH`` the named fixture views (and what they depend on) in front of ``body``."""
    order: list[str] = []

    def add(n: str) -> None:
        for d in DEPENDS.get(n, []):
            add(d)
        if n not in order:
            order.append(n)

    for n in names:
        add(n)
    ctes = ",\n".join(f"{n} as ({VIEWS[n].strip()})" for n in order)
    body = body.strip()
    if body[:15].lower() == "with recursive ":
        return f"with recursive {ctes},\n{body[15:]}"
    if body[:5].lower() == "with ":  # merge the body's own CTEs into one WITH list
        return f"with {ctes},\n{body[5:]}"
    return f"with {ctes}\n{body}"
