"""Registered queries: sources (catalogue, file events, messages, store listings), message payloads, reports."""

from __future__ import annotations

from pyspark.sql import functions as F

from acoustispark.functions import scalars as fn
from acoustispark.operators import calibrate as cal
from acoustispark.plans.common import rounded
from acoustispark.operators import report as rp
from acoustispark.operators import summary as sm
from acoustispark.plans.oracle_views import with_views
from acoustispark.sources import catalog as ct
from acoustispark.sources import fixtures as fx
from acoustispark.sources import messages as ms
from acoustispark.sources.sinks import message_rows
from acoustispark.sources.tables import read_table

CFG = {"survey_id": "HB1907", "survey_name": "Autumn leg", "input_dir": "/data/raw", "sonar_model": "EK60", "processing_mode": "file", "use_gpu": False,
       "depth_offset": 5.0, "denoise_enabled": True, "mvbs_enabled": True, "nasc_enabled": True,
       "seabed_enabled": False}


def q_limit_files(spark, sf_dir):
    """The first files by name of the catalogue; the limit is the feature."""
    r = fx.file_results(spark, sf_dir)
    c = r.select(F.col("source_file").alias("name"), (F.col("n_pings") * 1000).alias("size"), F.concat(F.lit("raw/"), F.col("source_file")).alias("path"))
    return ct.limit_files(c, 25)


LIMIT_FILES_SQL = with_views(["file_results"], """
select source_file as name, n_pings * 1000 as size, 'raw/' || source_file as path from file_results order by name, path limit 25""")


def _catalog_from_results(spark, sf_dir):
    return fx.file_results(spark, sf_dir).select(F.concat(F.lit("raw/"), F.col("source_file")).alias("path"))


def _file_events(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select("event_id", F.when(F.col("event_id") % 5 == 0, F.lit("filedelete")).otherwise(F.lit("fileadd")).alias("event"),
                     F.concat(F.lit("raw/f"), (F.col("event_id") % 20000).cast("string"), F.lit(".raw")).alias("file_added_path"))


def q_new_file_events(spark, sf_dir):
    return ct.new_file_events(_file_events(spark, sf_dir), _catalog_from_results(spark, sf_dir))


NEW_FILE_EVENTS_SQL = with_views(["file_results"], """
with ev as (select event_id, case when event_id % 5 = 0 then 'filedelete' else 'fileadd' end as event,
                   'raw/f' || (event_id % 20000) || '.raw' as file_added_path from events),
cat as (select distinct 'raw/' || source_file as p from file_results)
select event_id, event, file_added_path,
       case when event <> 'fileadd' then 'skipped' when cat.p is null then 'error' else 'queued' end as status,
       case when event <> 'fileadd' then 'ignored event: ' || event
            when cat.p is null then 'file not found: ' || file_added_path end as reason
from ev left join cat on ev.file_added_path = cat.p""")


def q_parse_messages(spark, sf_dir):
    p = ms.parse_messages(fx.messages(spark, sf_dir))
    return p.select("event_id", "valid", "type", "channel_id", "time",
                    _texts("samples").alias("samples"))


def _texts(c):
    return F.array_join(F.transform(c, lambda x: x.cast("string")), ",", "null")


MESSAGES_CTE = """m as (
  select event_id, 'u' || user_id::varchar as platform, ts,
         case when event_id % 97 = 0 then substring(j, 1, length(j) - 5) else j end as value
  from (select *, json_object('type', case when event_id % 11 = 0 then 'info' else 'sample_data' end,
                              'channel_id', case when user_id % 7 = 0 then 'chX' else 'ch' || (user_id % 5)::varchar end,
                              'time', case when event_id % 89 = 0 then 'not a time' else strftime(ts, '%Y-%m-%dT%H:%M:%S.%f')
                                           || (case when event_id % 83 = 0 then '+02:00' else '' end) end,
                              'samples', [case when event_id % 79 = 0 then 40000 else (floor(value * 10) - 6000)::int end, (floor(value) - 5000)::int,
                                          (event_id % 1000 - 7000)::int])::varchar as j from events)),
p as (select event_id, platform, json_valid(value) as valid,
             case when json_valid(value) then json_extract_string(value, '$.type') end as type,
             case when json_valid(value) then json_extract_string(value, '$.channel_id') end as channel_id,
             case when json_valid(value) then json_extract_string(value, '$.time') end as time,
             case when json_valid(value) then list_transform(json_extract(value, '$.samples')::bigint[],
                  lambda x: case when x between -32768 and 32767 then x end) end as samples from m),
good as (select p.*, case when time like '%+02:00' then try_cast(substr(time, 1, 26) as timestamp) - interval 2 hour
                          else try_cast(time as timestamp) end as ping_time
         from p where valid and type = 'sample_data' and not list_contains(list_transform(samples, lambda x: x is null), true))"""
SAMPLES_TEXT = "array_to_string(list_transform(samples, lambda x: coalesce(x::varchar, 'null')), ',')"

PARSE_MESSAGES_SQL = f"""
with {MESSAGES_CTE}
select event_id, valid, type, channel_id, time, {SAMPLES_TEXT} as samples from p"""


def q_ping_stream(spark, sf_dir):
    c = cal.channel_cal(fx.channel_cal_raw(spark, sf_dir))
    s = ms.ping_stream(fx.messages(spark, sf_dir), c)
    return s.select("event_id", "platform", "channel_id", "ping_time", "frequency",
                    _texts("samples").alias("samples"))


PING_STREAM_SQL = with_views(["channel_cal_raw"], f"""
with {MESSAGES_CTE}
select event_id, platform, channel_id, ping_time,
       coalesce(nullif(c.frequency, 0), 200000.0::double) as frequency, {SAMPLES_TEXT} as samples
from good join channel_cal_raw c using (channel_id) where ping_time is not null""")


def _store_paths(spark, sf_dir):
    r = fx.file_results(spark, sf_dir)
    k = F.col("file_id")
    day = F.when(k % 11 == 0, F.lit("notadate")).otherwise(F.date_format("day", "yyyy-MM-dd"))
    return r.select(F.concat(F.lit("c"), (F.col("campaign") % 10).cast("string"), F.lit("/processed/"), day,
                             F.lit("/segments/s"), (k % 7).cast("string"), F.lit("/"),
                             F.when(k % 2 == 0, F.lit("sv")).otherwise(F.lit("mvbs")), F.lit(".zarr/part-"),
                             k.cast("string")).alias("path"))


STORE_PATHS_CTE = """paths as (
  select 'c' || (campaign % 10) || '/processed/' || case when file_id % 11 = 0 then 'notadate' else strftime(day, '%Y-%m-%d') end
         || '/segments/s' || (file_id % 7) || '/' || case when file_id % 2 = 0 then 'sv' else 'mvbs' end
         || '.zarr/part-' || file_id as path from file_results)"""

DAYS_SQL = "try_strptime(regexp_extract(path, '(?:^|/)([0-9]{4}-[0-9]{2}-[0-9]{2})(?:/|$)', 1), '%Y-%m-%d')::date"


def q_list_days(spark, sf_dir):
    return ct.list_days(_store_paths(spark, sf_dir)).orderBy("day").select(F.date_format("day", "yyyy-MM-dd").alias("day"))


LIST_DAYS_SQL = with_views(["file_results"], f"""
with {STORE_PATHS_CTE}
select distinct strftime({DAYS_SQL}, '%Y-%m-%d') as day from paths where {DAYS_SQL} is not null""")


def q_list_segments(spark, sf_dir):
    return ct.list_segments(_store_paths(spark, sf_dir)).orderBy("day", "segment")


LIST_SEGMENTS_SQL = with_views(["file_results"], f"""
with {STORE_PATHS_CTE}
select distinct regexp_extract(path, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/segments/([^/]+)', 1) as day,
       regexp_extract(path, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/segments/([^/]+)', 2) as segment
from paths where regexp_extract(path, '([0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}})/segments/([^/]+)', 2) <> ''""")


def q_store_exists(spark, sf_dir):
    keys = fx.commands(spark, sf_dir).where(F.col("command") == "process_day").select("command_id", F.col("date").alias("day"))
    return ct.store_exists(keys, _store_paths(spark, sf_dir))


STORE_EXISTS_SQL = with_views(["commands", "file_results"], f"""
with {STORE_PATHS_CTE},
d as (select distinct strftime({DAYS_SQL}, '%Y-%m-%d') as k from paths where {DAYS_SQL} is not null)
select command_id, date as day, d.k is not null as exists
from commands left join d on commands.date = d.k where command = 'process_day'""")


def q_list_stores(spark, sf_dir):
    return ct.list_stores(_store_paths(spark, sf_dir)).orderBy("store")


LIST_STORES_SQL = with_views(["file_results"], f"""
with {STORE_PATHS_CTE}
select distinct regexp_extract(path, '^(.*?\\.zarr)(/|$)', 1) as store from paths
where regexp_extract(path, '^(.*?\\.zarr)(/|$)', 1) <> ''""")


def q_union_sources(spark, sf_dir):
    c = cal.channel_cal(fx.channel_cal_raw(spark, sf_dir))
    rt = ms.ping_stream(fx.messages(spark, sf_dir), c).select("platform", "channel_id", "ping_time",
                                                               F.lit("realtime").alias("source"))
    files = fx.raw_pings(spark, sf_dir).select("platform", "channel_id", "ping_time", "ping",
                                               F.lit("file").alias("source"))
    return rt.unionByName(files, allowMissingColumns=True)


UNION_SOURCES_SQL = with_views(["channel_cal_raw", "raw_pings"], f"""
with {MESSAGES_CTE}
select platform, channel_id, ping_time, 'realtime' as source, null::bigint as ping
from good join channel_cal_raw c using (channel_id) where ping_time is not null
union all
select platform, channel_id, ping_time, 'file' as source, ping from raw_pings""")


def q_sink_messages(spark, sf_dir):
    r = fx.file_results(spark, sf_dir).select("file_id", "source_file", "status", "n_pings")
    return message_rows(r, "output1").drop("message_id")


SINK_MESSAGES_SQL = with_views(["file_results"], """
select 'output1' as output,
       json_object('file_id', file_id, 'source_file', source_file, 'status', status, 'n_pings', n_pings)::varchar as body
from file_results""")


def q_ml_payload(spark, sf_dir):
    return rp.ml_payload(fx.file_results(spark, sf_dir), CFG["survey_id"], CFG["depth_offset"])


ML_PAYLOAD_SQL = with_views(["file_results"], f"""
select source_file as file_name, sv_path as sv_zarr_path, '{CFG['survey_id']}' as campaign_id,
       regexp_replace(source_file, '\\.[^.]*$', '') as dataset_id, {CFG['depth_offset']!r}::double as depth_offset,
       coalesce(strftime(day, '%Y-%m-%d'), '') as date
from file_results where sv_path is not null""")


def q_telemetry_rows(spark, sf_dir):
    payload = rp.telemetry_rows(fx.file_results(spark, sf_dir), CFG)[0]
    payload = payload.withColumn("day", F.date_format("day", "yyyy-MM-dd"))
    return payload.select("file_id", "source_file", "day", "status", "n_pings", "processing_time_ms", "campaign_id", "sonar_model", "processing_mode", "use_gpu")


TELEMETRY_ROWS_SQL = with_views(["file_results"], f"""
select file_id, source_file, strftime(day, '%Y-%m-%d') as day, status, n_pings, processing_time_ms, '{CFG['survey_id']}' as campaign_id, '{CFG['sonar_model']}' as sonar_model,
       '{CFG['processing_mode']}' as processing_mode, {str(CFG['use_gpu']).lower()} as use_gpu from file_results""")


def q_telemetry_last(spark, sf_dir):
    return rp.telemetry_rows(fx.file_results(spark, sf_dir), CFG)[1]


TELEMETRY_LAST_SQL = with_views(["file_results"], f"""
select campaign, strftime(arg_max(day, (day, file_id)), '%Y-%m-%d') as last_processed_day,
       arg_max(processing_time_ms, (day, file_id)) as last_processing_time_ms,
       arg_max(n_pings, (day, file_id)) as last_n_pings, '{CFG['processing_mode']}' as processing_mode,
       {str(CFG['use_gpu']).lower()} as gpu_enabled
from file_results group by all""")


def _alt_sql(p: str) -> str:
    """Title case of the file stem, restarting after every character that is no letter."""
    stem = f"replace(regexp_extract({p}, '([^/]*?)([.][^./]*)?$', 1), '_', ' ')"
    return (f"array_to_string(list_transform(range(1, length({stem}) + 1), lambda i: case when i = 1 or not "
            f"regexp_matches({stem}[i - 1], '[A-Za-z]') then upper({stem}[i]) else lower({stem}[i]) end), '')")


def _store_sql(p: str) -> str:
    folders = " ".join(f"when contains({p}, '{d}') then substr({p}, strpos({p}, '{d}'))" for d in fn.STORAGE_FOLDERS)
    return f"(case when starts_with({p}, '/') then (case {folders} else {p} end) else {p} end)"


def _images_sql(title: str, closing: int) -> str:
    return (f"case when coalesce(len(echogram_files), 0) > 0 then list_concat(['{title}', ''], flatten(list_transform(echogram_files, "
            f"lambda p: ['![' || {_alt_sql('p')} || '](' || {_store_sql('p')} || ')', '']))) {'|| ' + repr([''] * closing) if closing else ''} else [] end")


def _freqs_sql(c: str) -> str:
    return (f"array_to_string(list_transform({c}, lambda f: case when f >= 1000 then floor(f / 1000)::bigint || ' kHz' "
            f"else trunc(f)::bigint || ' Hz' end), ', ')")


def _range_sql(label: str, x: str) -> str:
    return f"case when {x}_min is not null then printf('- **{label}**: [%.4f, %.4f]', {x}_min, {x}_max) end"


def _one(lines) -> str:
    return f"list_filter([{', '.join(lines)}], lambda x: x is not null)"


def q_segment_report(spark, sf_dir):
    from acoustispark.plans.summaries import _pings_with_freq
    s = sm.segment_summary(_pings_with_freq(spark, sf_dir))
    p = F.col("platform")
    s = s.withColumn("processing_time_ms", F.lit(1234)) \
        .withColumn("products", F.when(p == "p0", F.array(F.lit("sv"), F.lit("mvbs"))).otherwise(F.array(F.lit("sv"), F.lit("sv_denoised")))) \
        .withColumn("mvbs_status", F.when(p != "p0", F.lit("error: no bins"))).withColumn("nasc_status", F.lit("skipped: no GPS")) \
        .withColumn("frequencies_hz", F.when(p == "p1", F.slice("frequencies_hz", 1, 2)).when(p == "p2", F.expr("cast(array() as array<double>)")).otherwise(F.col("frequencies_hz"))) \
        .withColumn("echogram_files", F.when(p == "p1", F.array(F.lit("/data/echograms/s0/sv_38kHz.png"), F.lit("echograms/s0/mvbs_echogram.png"))))
    return rp.segment_report(rounded(s), CFG).drop("day")


def _segment_report_sql() -> str:
    from acoustispark.plans.summaries import SEGMENT_SUMMARY_CTE
    iso = lambda c: f"case when epoch_us({c}) % 1000000 = 0 then strftime({c}, '%Y-%m-%dT%H:%M:%S') else strftime({c}, '%Y-%m-%dT%H:%M:%S.%f') end"
    head = ["'# Segment Report: ' || segment_name", "''",
            "'> Day: ' || day || ' | Pings: ' || format('{:,}', n_pings) || ' | Channels: ' || n_channels || ' | Processing: 1234ms'", "''"]
    cover = ["'## Data Coverage'", "''", f"'- **Time**: ' || {iso('start_time')} || ' → ' || {iso('end_time')}",
             "printf('- **Depth**: %.1fm → %.1fm', depth_min, depth_max)", _range_sql("Latitude", "lat"), _range_sql("Longitude", "lon"),
             "'- **Mean Sv**: ' || sv_mean_db || ' dB'", "''", "'## Products'", "''"]
    done = lambda k: f"list_contains(products, '{k}')"
    prods = [f"case when {done('sv')} then '- sv.zarr ✅' else '- sv.zarr ⏭' end",
             f"case when {done('sv_denoised')} then '- sv_denoised.zarr ✅' else '- sv_denoised.zarr ⏭' end",
             "'- sv_seabed.zarr ⏭ (not enabled)'",
             f"case when {done('mvbs')} then '- mvbs.zarr ✅' else '- mvbs.zarr ❌ (error: no bins)' end", "'- nasc.zarr ⏭'", "''"]
    conf = ["'## Configuration'", "''", "'- **Sonar**: EK60, CW, power'", "'- **Denoise**: background,transient,impulse,attenuation'",
            "'- **MVBS**: range_bin=0.5m, ping_time_bin=10s'", "'- **NASC**: range_bin=10m, dist_bin=0.5nmi'", "'- **GPU**: disabled'", "''"]
    return f"""
with {SEGMENT_SUMMARY_CTE},
x as (select * exclude (frequencies_hz), string_split(channels, ',') as ch,
             case platform when 'p1' then list_transform(string_split(frequencies_hz, ','), lambda f: f::double)[1:2] when 'p2' then []::double[]
                  else list_transform(string_split(frequencies_hz, ','), lambda f: f::double) end as fr,
             case when platform = 'p0' then ['sv', 'mvbs'] else ['sv', 'sv_denoised'] end as products,
             case when platform = 'p1' then ['/data/echograms/s0/sv_38kHz.png', 'echograms/s0/mvbs_echogram.png'] end as echogram_files from summary),
l as (select platform, segment, list_concat({_one(head)},
        list_concat(list_concat(['## Channels & Frequencies', ''],
          case when len(ch) = len(fr) then list_transform(range(1, len(ch) + 1), lambda i: '- ' || ch[i] || ': ' || {_freqs_sql('[fr[i]]')})
               when len(fr) > 0 then ['- Frequencies: ' || {_freqs_sql('list_sort(fr)')}] else list_transform(ch, lambda c: '- ' || c) end), ['']),
        {_one(cover)}, {_one(prods)}, {_one(conf)}, {_images_sql('## Echograms', 0)}) as lines from x)
select platform, segment, unnest(lines) as text, unnest(range(0, len(lines)))::int as line_no from l"""


SEGMENT_REPORT_SQL = with_views(["samples", "channel_cal_raw"], _segment_report_sql())


def q_run_report(spark, sf_dir):
    r = fx.file_results(spark, sf_dir)
    return rp.run_report(r, sm.run_summary(r), sm.quality_notes(r), CFG)


def _run_report_sql() -> str:
    from acoustispark.plans.summaries import QUALITY_NOTES_CTE, RUN_SUMMARY_CTE
    head = ["'# Processing Report: HB1907'", "''", "'## Summary'", "''", "'- **Survey ID**: HB1907'", "'- **Survey name**: Autumn leg'",
            "'- **Input directory**: `/data/raw`'",
            "'- **Files processed**: ' || n_ok || ' ok, ' || n_failed || ' failed, ' || n_skipped || ' skipped (of ' || n_total || ' total)'",
            "'- **Total pings**: ' || format('{:,}', total_pings)", "'- **Sonar model**: EK60'",
            f"case when len(fl) > 0 then '- **Frequencies**: ' || {_freqs_sql('fl')} end",
            "printf('- **Total processing time**: %.1fs', total_s)", "''", "'## Pipeline Configuration'", "''", "'- **Waveform mode**: CW'",
            "'- **Encode mode**: power'", "'- **Depth offset**: 5.0 m'", "'- **GPU acceleration**: disabled'",
            "'- **Denoise**: enabled (background,transient,impulse,attenuation)'", "'- **MVBS**: enabled (range_bin=0.5m, ping_time_bin=10s)'",
            "'- **NASC**: enabled (range_bin=10m, dist_bin=0.5nmi)'", "'- **Seabed detection**: disabled'", "'- **Echograms**: enabled'", "''",
            "'## Files Processed'", "''"]
    time = "'- **Processing time**: ' || total_time_ms || ' ms'"
    good = ["'### ' || source_file", "''", "'- **Status**: ✅ OK'", "'- **Day**: ' || strftime(day, '%Y-%m-%d')", "'- **Segment**: ' || segment",
            "'- **Pings**: ' || format('{:,}', n_pings)", "'- **Channels**: ' || n_channels", f"'- **Frequencies**: ' || {_freqs_sql('frequencies')}",
            _range_sql("Latitude", "lat"), _range_sql("Longitude", "lon"), time, "'- **Products**: ' || array_to_string(products, ', ')",
            f"'- **Echodata**: `' || {_store_sql('echodata_path')} || '`'", f"'- **Sv data**: `' || {_store_sql('sv_path')} || '`'", "''"]
    bad = ["'### ' || source_file", "''", "'- **Status**: ❌ FAILED'", "'- **Error**: ' || error", time, "''"]
    skip = ["'### ' || source_file", "''", "'- **Status**: ⏭ Skipped — ' || reason", "''"]
    arts = ["## Output Artifacts", "", "- **Echodata (converted)**: `converted/`", "- **Processed products**: `processed/`",
            "- **Echograms**: `echograms/`", "- **This report**: `reports/`", ""]
    return f"""
with {RUN_SUMMARY_CTE}, {QUALITY_NOTES_CTE},
t as (select campaign, (sum(total_time_ms) + 50) // 100 / 10.0::double as total_s from file_results group by all),
l1 as (select campaign, {_one(head)} as lines from c left join f using (campaign) join t using (campaign)),
l2 as (select campaign, source_file, file_id, case status when 'error' then {_one(bad)} when 'skipped' then {_one(skip)}
         else list_concat({_one(good)}, {_images_sql('#### Echograms', 1)}) end as lines from file_results)
select campaign, 1 as section, '' as source_file, 0::bigint as file_id, unnest(range(0, len(lines)))::int as line_no, unnest(lines) as text from l1
union all select campaign, 2, source_file, file_id, unnest(range(0, len(lines)))::int, unnest(lines) from l2
union all select campaign, 3, '', 0, unnest([0, 1]), unnest(['## Data Quality Notes', '']) from (select distinct campaign from notes)
union all select campaign, 3, source_file, null, kind + 1, note from notes
union all select campaign, 4, '', 0, unnest(range(0, {len(arts)}))::int, unnest({arts!r}) from c"""


RUN_REPORT_SQL = with_views(["file_results"], _run_report_sql())


REGISTRY = {
    "limit_files": (q_limit_files, LIMIT_FILES_SQL),
    "new_file_events": (q_new_file_events, NEW_FILE_EVENTS_SQL),
    "parse_messages": (q_parse_messages, PARSE_MESSAGES_SQL),
    "ping_stream": (q_ping_stream, PING_STREAM_SQL),
    "list_days": (q_list_days, LIST_DAYS_SQL),
    "list_segments": (q_list_segments, LIST_SEGMENTS_SQL),
    "store_exists": (q_store_exists, STORE_EXISTS_SQL),
    "list_stores": (q_list_stores, LIST_STORES_SQL),
    "union_sources": (q_union_sources, UNION_SOURCES_SQL),
    "sink_messages": (q_sink_messages, SINK_MESSAGES_SQL),
    "ml_payload": (q_ml_payload, ML_PAYLOAD_SQL),
    "telemetry_rows": (q_telemetry_rows, TELEMETRY_ROWS_SQL),
    "telemetry_last": (q_telemetry_last, TELEMETRY_LAST_SQL),
    "segment_report": (q_segment_report, SEGMENT_REPORT_SQL),
    "run_report": (q_run_report, RUN_REPORT_SQL),
}
