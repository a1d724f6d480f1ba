"""Registered queries: configuration folding and as-of, commands, store status."""

from __future__ import annotations

from pyspark.sql import functions as F

from acoustispark.operators import commands as cm
from acoustispark.operators import config_log as cl
from acoustispark.plans.oracle_views import with_views
from acoustispark.plans.scalars import UNWRAP_SQL, _bool_sql, _float_sql, _int_sql
from acoustispark.sources import fixtures as fx

FIELDS = [n for n, _, _ in cl.CONFIG_FIELDS]


def _in(names):
    return "(" + ", ".join(repr(n) for n in names) + ")"


def _str_sql(j: str) -> str:
    return (f"case json_type({j}) when 'VARCHAR' then json_extract_string({j}, '$') "
            f"when 'BOOLEAN' then (case when lower({j}) = 'true' then 'True' else 'False' end) "
            f"when 'NULL' then 'None' else {j} end")


def _typed_sql() -> str:
    by = {t: [n for n, tt, _ in cl.CONFIG_FIELDS if tt == t] for t in ("bool", "int", "float", "str")}
    return (f"case when field in {_in(by['bool'])} then ({_bool_sql('j', 'true')})::varchar "
            f"when field in {_in(by['int'])} then ({_int_sql('j')})::varchar "
            f"when field in {_in(by['float'])} then ({_float_sql('j')})::varchar "
            f"when field in {_in(by['str'])} then {_str_sql('j')} end")


WRITES_CTE = f"""
w0 as (select device, ts, event_id, case key when 'Log_Level' then 'log_level' else key end as field,
              {UNWRAP_SQL} as j from config_patches),
writes as (select device, ts, event_id, field, {_typed_sql()} as value from w0
           where field in {_in(list(cl.FIELD_TYPES))})"""

WIDE_CTE = WRITES_CTE + f""",
events_of as (select distinct device, ts, event_id from config_patches),
wide as (select e.device, e.ts, e.event_id, {', '.join(f"max(case when field = '{f}' then value end) as {f}" for f in FIELDS)}
         from events_of e left join writes using (device, ts, event_id) group by all),
folded as (select device, ts, event_id, {', '.join(f"coalesce(last({f} ignore nulls) over w, '{cl.FIELD_DEFAULTS[f]}') as {f}" for f in FIELDS)}
           from wide window w as (partition by device order by ts, event_id rows between unbounded preceding and current row))"""


def q_config_fold(spark, sf_dir):
    return cl.config_fold(fx.config_patches(spark, sf_dir))


CONFIG_FOLD_SQL = with_views(["config_patches"], f"""
with {WIDE_CTE}
select * from folded""")


def _batches(spark, sf_dir):
    ev = fx.read_table(spark, sf_dir, "events")
    return ev.select((F.col("user_id") % 6).alias("device"), "ts", "event_id")


def q_config_as_of(spark, sf_dir):
    return cl.config_as_of(_batches(spark, sf_dir), fx.config_patches(spark, sf_dir))


# the state of a device at a time is its last version of that time; device 5 has no patches
CONFIG_AS_OF_SQL = with_views(["config_patches"], f"""
with {WIDE_CTE},
states as (select * from folded qualify row_number() over (partition by device, ts order by event_id desc) = 1),
b as (select user_id % 6 as device, ts, event_id from events)
select b.device, b.ts, b.event_id, {', '.join(f"coalesce(s.{f}, '{cl.FIELD_DEFAULTS[f]}') as {f}" for f in FIELDS)}
from b asof left join states s on b.device = s.device and b.ts >= s.ts""")


def _store_days(spark, sf_dir):
    return fx.file_results(spark, sf_dir).where(F.col("status") == "ok").select("day")


def q_commands_dispatch(spark, sf_dir):
    return cm.commands_dispatch(fx.commands(spark, sf_dir), _store_days(spark, sf_dir))


DISPATCH_CTE = """
days as (select distinct day from file_results where status = 'ok'),
c as (select c.*, try_strptime(date, '%Y-%m-%d')::date as pd, d.day is not null as has
      from commands c left join days d on try_strptime(c.date, '%Y-%m-%d')::date = d.day),
acks as (
select command_id, command,
       case command when 'process_raw_files' then (case when coalesce(len(paths), 0) = 0 then 'error' else 'accepted' end)
                    when 'process_day' then (case when pd is null or not has then 'error' else 'accepted' end)
                    when 'get_status' then 'ok'
                    when 'set_config' then (case when coalesce(len(json_keys(config_json)), 0) <= 0 then 'error' else 'ok' end)
                    else 'error' end as status,
       case when command = 'process_raw_files' then (case when coalesce(len(paths), 0) = 0 then 'no paths specified' end)
            when command = 'process_day' then (case when pd is null then 'invalid date: ' || coalesce(date, '')
                                                    when not has then 'no segments for ' || coalesce(date, '') end)
            when command = 'set_config' then (case when coalesce(len(json_keys(config_json)), 0) <= 0 then 'no config provided' end)
            when command not in ('process_raw_files', 'process_day', 'get_status', 'set_config') or command is null
                 then 'unknown command: ' || coalesce(command, '') end as reason,
       case when command = 'process_raw_files' and coalesce(len(paths), 0) > 0 then len(paths) end as files_queued,
       case when command = 'set_config' then array_to_string(json_keys(config_json), ',') end as updated_keys
from c)"""

COMMANDS_DISPATCH_SQL = with_views(["commands", "file_results"], f"""
with {DISPATCH_CTE}
select * from acks""")


def q_store_status(spark, sf_dir):
    cmds = fx.commands(spark, sf_dir)
    days = _store_days(spark, sf_dir)
    acks = cm.commands_dispatch(cmds, days)
    s = cm.store_status(days, cm.command_jobs(cmds, acks))
    return s.select("processing_mode", "n_days", F.array_join("days_with_data", ",").alias("days_with_data"), "jobs_pending")


STORE_STATUS_SQL = with_views(["commands", "file_results"], f"""
with {DISPATCH_CTE},
jobs as (select command_id from acks a join commands c using (command_id, command), unnest(c.paths) t(p)
         where a.status = 'accepted' and command = 'process_raw_files'
         union all select command_id from acks where status = 'accepted' and command = 'process_day')
select 'both' as processing_mode, (select count(distinct day) from days) as n_days,
       (select string_agg(strftime(day, '%Y-%m-%d'), ',' order by day) from days) as days_with_data,
       (select count(*) from jobs) as jobs_pending""")


REGISTRY = {
    "config_fold": (q_config_fold, CONFIG_FOLD_SQL),
    "config_as_of": (q_config_as_of, CONFIG_AS_OF_SQL),
    "commands_dispatch": (q_commands_dispatch, COMMANDS_DISPATCH_SQL),
    "store_status": (q_store_status, STORE_STATUS_SQL),
}
