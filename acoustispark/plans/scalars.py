"""Registered queries: the scalar functions of ``acoustispark.functions.scalars`` over columns of the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from acoustispark.functions import scalars as fn
from acoustispark.plans.common import rounded
from acoustispark.plans.oracle_views import with_views
from acoustispark.sources import fixtures as fx
from acoustispark.sources.tables import read_table

STRIP = "regexp_replace({x}, '^-+|-+$', '', 'g')"


def _sanitize_sql(x: str) -> str:
    t = f"regexp_replace(regexp_replace(lower({x}), '[^a-z0-9-]', '-', 'g'), '-{{2,}}', '-', 'g')"
    t = STRIP.format(x=f"substring({STRIP.format(x=t)}, 1, 63)")
    t = f"case when {x} is null or {x} = '' or {t} = '' then 'default' else {t} end"
    return f"case when length({t}) < 3 then rpad({t}, 3, '0') else {t} end"


def q_fn_sanitize_container(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", fn.sanitize_container("url").alias("container"),
                    fn.sanitize_container(F.substring("url", 9, 2)).alias("short_container"))


FN_SANITIZE_CONTAINER_SQL = f"""
select page_id, {_sanitize_sql('url')} as container, {_sanitize_sql('substring(url, 9, 2)')} as short_container from pages"""


def _patches(spark, sf_dir):
    return fx.config_patches(spark, sf_dir).withColumn("value_json", fn.unwrap_value("raw_json"))


UNWRAP_SQL = ("case when json_type(raw_json) = 'OBJECT' and json_exists(raw_json, '$.value') "
              "then json_extract(raw_json, '$.value')::varchar else raw_json end")


def q_fn_unwrap_value(spark, sf_dir):
    return _patches(spark, sf_dir).select("event_id", "raw_json", "value_json")


FN_UNWRAP_VALUE_SQL = with_views(["config_patches"], f"""
select event_id, raw_json, {UNWRAP_SQL} as value_json from config_patches""")


def _bool_sql(j: str, default: str = "true") -> str:
    return (f"case when {j} is null or json_type({j}) = 'NULL' then {default} "
            f"when json_type({j}) = 'BOOLEAN' then json_extract({j}, '$')::boolean "
            f"when json_type({j}) in ('BIGINT', 'UBIGINT', 'DOUBLE') then json_extract({j}, '$')::double <> 0 "
            f"when json_type({j}) = 'VARCHAR' then lower(json_extract_string({j}, '$')) not in "
            f"({', '.join(repr(s) for s in fn.FALSE_STRINGS)}) else {default} end")


def q_fn_parse_bool(spark, sf_dir):
    return _patches(spark, sf_dir).select("event_id", fn.parse_bool("value_json", True).alias("flag"),
                                          fn.parse_bool("value_json", False).alias("flag_default_false"))


FN_PARSE_BOOL_SQL = with_views(["config_patches"], f"""
with u as (select event_id, {UNWRAP_SQL} as v from config_patches)
select event_id, {_bool_sql('v', 'true')} as flag, {_bool_sql('v', 'false')} as flag_default_false from u""")


def _int_sql(j: str) -> str:
    return (f"case when json_type({j}) in ('BIGINT', 'UBIGINT', 'DOUBLE') then (case when abs(json_extract({j}, '$')::double) < 1e38 "
            f"then trunc(json_extract({j}, '$')::double)::decimal(38, 0) end) "
            f"when json_type({j}) = 'BOOLEAN' then json_extract({j}, '$')::boolean::int::decimal(38, 0) "
            f"when json_type({j}) = 'VARCHAR' and regexp_full_match(json_extract_string({j}, '$'), '\\s*[+-]?[0-9]+\\s*') "
            f"then try_cast(trim(json_extract_string({j}, '$')) as decimal(38, 0)) end")


def _float_sql(j: str) -> str:
    num = r"\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|inf|infinity|nan)\s*"
    return (f"case when json_type({j}) in ('BIGINT', 'UBIGINT', 'DOUBLE') then json_extract({j}, '$')::double "
            f"when json_type({j}) = 'BOOLEAN' then json_extract({j}, '$')::boolean::int::double "
            f"when json_type({j}) = 'VARCHAR' and regexp_full_match(lower(json_extract_string({j}, '$')), '{num}') "
            f"then trim(json_extract_string({j}, '$'))::double end")


def q_fn_coerce_typed(spark, sf_dir):
    return rounded(_patches(spark, sf_dir).select("event_id", fn.coerce_int("value_json").cast("string").alias("as_int"),
                                                  fn.coerce_float("value_json").alias("as_float")))


FN_COERCE_TYPED_SQL = with_views(["config_patches"], f"""
with u as (select event_id, {UNWRAP_SQL} as v from config_patches)
select event_id, ({_int_sql('v')})::varchar as as_int, round({_float_sql('v')}, 6) as as_float from u""")


def q_fn_split_list(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    s = F.concat(F.regexp_replace("p_name", " ", " , ,"), F.lit(","))
    return p.select("p_partkey", F.array_join(fn.split_list(s), "|").alias("items"),
                    F.array_join(fn.split_int_list(F.concat_ws(",", F.col("p_size").cast("string"), F.lit(" 3"),
                                                                F.lit(""))), "|").alias("lags"))


FN_SPLIT_LIST_SQL = """
select p_partkey,
       array_to_string(list_filter(list_transform(string_split(replace(p_name, ' ', ' , ,') || ',', ','), lambda x: trim(x)),
                                   lambda x: x <> ''), '|') as items,
       array_to_string(list_transform(list_filter(list_transform(string_split(p_size::varchar || ', 3,', ','), lambda x: trim(x)),
                                                  lambda x: x <> ''), lambda x: x::int), '|') as lags
from part"""


def q_fn_sentinel_null(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return rounded(li.select("l_orderkey", "l_linenumber",
                             fn.sentinel_null(F.col("l_quantity") * F.lit(-25.0)).alias("noise_max"),
                             fn.empty_null(F.when(F.col("l_linenumber") % 3 == 0, F.lit("")).otherwise(F.col("l_returnflag")))
                             .alias("pulse_key")))


FN_SENTINEL_NULL_SQL = """
select l_orderkey, l_linenumber, round(case when l_quantity * -25.0 > -999.0 then l_quantity * -25.0 end, 6) as noise_max,
       nullif(case when l_linenumber % 3 = 0 then '' else l_returnflag end, '') as pulse_key from lineitem"""


def q_fn_parse_bin(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    txt = F.concat(F.format_string("%.1f", F.col("p_size") / F.lit(10.0)),
                   F.when(F.col("p_size") % 3 == 0, F.lit("m")).when(F.col("p_size") % 3 == 1, F.lit("nmi")).otherwise(F.lit("s")))
    txt = F.when(F.col("p_partkey") % 13 == 0, F.lit("wide")).when(F.col("p_partkey") % 17 == 0, F.lit("1.2.3m")).otherwise(txt)
    return rounded(p.select("p_partkey", txt.alias("text"), fn.parse_bin_value(txt).alias("value"),
                            fn.parse_bin_unit(txt).alias("unit")))


FN_PARSE_BIN_SQL = """
with t as (select p_partkey, case when p_partkey % 13 = 0 then 'wide' when p_partkey % 17 = 0 then '1.2.3m' else printf('%.1f', p_size / 10.0) ||
                  case p_size % 3 when 0 then 'm' when 1 then 'nmi' else 's' end end as text from part)
select p_partkey, text, round(try_cast(regexp_extract(text, '^\\s*([0-9.]+)\\s*([A-Za-z]*)\\s*$', 1) as double), 6) as value,
       regexp_extract(text, '^\\s*([0-9.]+)\\s*([A-Za-z]*)\\s*$', 2) as unit from t"""


FREQ_EXPR = "case when s_suppkey % 3 = 0 then null when s_suppkey % 3 = 1 then s_acctbal * 40.0 else s_acctbal end"
NAME_EXPR = "case when s_suppkey % 2 = 0 then 'WBT 400528-15 ES' || (s_nationkey + 18) || '-7_ES' else s_name || ' / x' end"


def q_fn_freq_label(spark, sf_dir):
    s = read_table(spark, sf_dir, "supplier")
    f = F.expr(FREQ_EXPR)
    n = F.expr(NAME_EXPR)
    return s.select("s_suppkey", fn.freq_label(f, n).alias("label"),
                    F.when(f.isNotNull(), fn.fmt_freq(f)).alias("fmt"))


FN_FREQ_LABEL_SQL = f"""
with s as (select s_suppkey, {FREQ_EXPR} as f, {NAME_EXPR} as n from supplier)
select s_suppkey,
       case when f is not null then (case when f >= 1000 then floor(f / 1000)::bigint::varchar || 'kHz'
                                          else trunc(f)::bigint::varchar || 'Hz' end)
            when regexp_extract(n, 'ES(\\d+)', 1) <> '' then regexp_extract(n, 'ES(\\d+)', 1) || 'kHz'
            else substring(translate(n, ' /', '__'), 1, 30) end as label,
       case when f is not null then (case when f >= 1000 then floor(f / 1000)::bigint::varchar || ' kHz'
                                          else trunc(f)::bigint::varchar || ' Hz' end) end as fmt
from s"""


def q_fn_fmt_freq(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return li.select("l_orderkey", "l_linenumber", fn.fmt_freq(F.col("l_extendedprice")).alias("fmt"))


FN_FMT_FREQ_SQL = """
select l_orderkey, l_linenumber, case when l_extendedprice >= 1000 then floor(l_extendedprice / 1000)::bigint::varchar || ' kHz'
       else trunc(l_extendedprice)::bigint::varchar || ' Hz' end as fmt from lineitem"""


def q_fn_channel_short(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", fn.channel_short(F.concat_ws("  ", "p_type", "p_name")).alias("short"))


FN_CHANNEL_SHORT_SQL = """
select p_partkey, array_to_string(list_slice(list_filter(regexp_split_to_array(trim(p_type || '  ' || p_name), '\\s+'),
                                                          lambda w: w <> ''), 1, 3), '_') as short from part"""


PATH_EXPR = ("case page_id % 4 when 0 then '/mnt/x/processed/' || page_id || '/echograms/sv.zarr' "
             "when 1 then 'echograms/' || page_id || '.png' when 2 then '/tmp/reports/echodata/' || page_id "
             "else '/a/b/c' || page_id end")


def q_fn_storage_path(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", fn.storage_path(F.expr(PATH_EXPR)).alias("path"))


def _storage_sql(p: str) -> str:
    parts = " ".join(f"when instr({p}, '{d}') > 0 then substring({p}, instr({p}, '{d}'))" for d in fn.STORAGE_FOLDERS)
    return f"case when starts_with({p}, '/') then (case {parts} else {p} end) else {p} end"


FN_STORAGE_PATH_SQL = f"""
select page_id, {_storage_sql(f'({PATH_EXPR})')} as path from pages"""


def q_fn_path_split(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", fn.path_container("url").alias("container"), fn.path_rest("url").alias("rest"),
                    fn.path_name("url").alias("name"), fn.path_stem("url").alias("stem"))


FN_PATH_SPLIT_SQL = """
select page_id, split_part(url, '/', 1) as container, regexp_replace(url, '^[^/]*/', '') as rest,
       regexp_extract(url, '([^/]*)$', 1) as name,
       regexp_extract(regexp_extract(url, '([^/]*)$', 1), '^(.+?)(\\.[^.]*)?$', 1) as stem from pages"""


ALT_SRC = "concat('sv_', p_size, 'khz_', replace(lower(p_type), ' ', '_'), '_', p_brand)"


def q_fn_alt_text(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select("p_partkey", fn.alt_text(F.expr(ALT_SRC)).alias("alt"))


FN_ALT_TEXT_SQL = f"""
with t as (select p_partkey, replace({ALT_SRC}, '_', ' ') as s from part)
select p_partkey, array_to_string(list_transform(generate_series(1, length(s)), lambda i:
         case when i = 1 or not regexp_matches(substring(s, i - 1, 1), '[A-Za-z]') then upper(substring(s, i, 1))
              else lower(substring(s, i, 1)) end), '') as alt from t"""


def q_fn_segment_name(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    g = ev.groupBy("user_id").agg(F.min("ts").alias("t0"), F.max("ts").alias("t1"))
    return g.select("user_id", fn.segment_name("t0", "t1").alias("segment"),
                    F.date_format(fn.segment_day("t0"), "yyyy-MM-dd").alias("day"))


FN_SEGMENT_NAME_SQL = """
select user_id, strftime(min(ts), '%H-%M-%S') || '__' || strftime(max(ts), '%H-%M-%S') as segment,
       strftime(min(ts), '%Y-%m-%d') as day from events group by all"""


DAY_TEXT = "case when event_id % 13 = 0 then 'day-' || event_id when event_id % 17 = 0 then '' else strftime(ts, '%Y-%m-%d') end"


def q_fn_segment_day(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    txt = F.when(F.col("event_id") % 13 == 0, F.concat(F.lit("day-"), F.col("event_id").cast("string"))) \
        .when(F.col("event_id") % 17 == 0, F.lit("")).otherwise(F.date_format("ts", "yyyy-MM-dd"))
    return ev.select("event_id", txt.alias("text"), F.date_format(fn.parse_day(txt), "yyyy-MM-dd").alias("day"))


FN_SEGMENT_DAY_SQL = f"""
select event_id, {DAY_TEXT} as text, strftime(try_strptime({DAY_TEXT}, '%Y-%m-%d'), '%Y-%m-%d') as day from events"""


def q_fn_prefix(spark, sf_dir):
    r = fx.file_results(spark, sf_dir)
    stem = F.when(F.col("file_id") % 2 == 0, F.regexp_replace("source_file", r"\.raw$", ""))
    camp = fn.sanitize_container(F.concat(F.lit("Survey "), F.col("campaign").cast("string")))
    return r.select("file_id", fn.product_prefix(camp, F.lit("processed"), "day", F.lit("00-00-00__01-00-00"), stem)
                    .alias("prefix"))


FN_PREFIX_SQL = with_views(["file_results"], f"""
select file_id, case when file_id % 2 = 0
                     then concat_ws('/', {_sanitize_sql("'Survey ' || campaign")}, 'processed', regexp_replace(source_file, '\\.raw$', ''))
                     else concat_ws('/', {_sanitize_sql("'Survey ' || campaign")}, 'processed', strftime(day, '%Y-%m-%d'),
                                    'segments', '00-00-00__01-00-00') end as prefix
from file_results""")


def q_fn_db_linear(spark, sf_dir):
    s = fx.samples(spark, sf_dir)
    lin = fn.db_to_linear("sv")
    return rounded(s.select("channel", "ping", "range_sample", (lin * F.lit(1e9)).alias("lin_e9"),
                            fn.linear_to_db(lin).alias("back_db")))


FN_DB_LINEAR_SQL = with_views(["samples"], """
select channel, ping, range_sample, round(pow(10.0, sv / 10.0) * 1e9, 6) as lin_e9,
       round(case when pow(10.0, sv / 10.0) > 0 then 10.0 * log10(pow(10.0, sv / 10.0)) end, 6) as back_db from samples""")


def q_fn_round1(spark, sf_dir):
    li = read_table(spark, sf_dir, "lineitem")
    return rounded(li.groupBy("l_suppkey").agg(fn.round1(F.avg(F.col("l_discount") * 100 - 70.0)).alias("mean_db")))


FN_ROUND1_SQL = """
select l_suppkey, round(round_even(avg(l_discount * 100 - 70.0), 1), 6) as mean_db from lineitem group by all"""


def q_fn_thousands(spark, sf_dir):
    o = read_table(spark, sf_dir, "orders")
    return o.select("o_orderkey", fn.thousands(F.col("o_orderkey") * 37).alias("text"))


FN_THOUSANDS_SQL = """select o_orderkey, format('{:,}', o_orderkey * 37) as text from orders"""


def q_fn_to_native(spark, sf_dir):
    """Values that are NaN, infinite or missing, and times with and without a fraction."""
    ev = read_table(spark, sf_dir, "events")
    v = (F.when(F.col("event_id") % 5 == 0, F.lit(float("nan"))).when(F.col("event_id") % 7 == 0, F.lit(float("inf")))
         .when(F.col("value") > 5, F.floor("value").cast("double") + 0.5))
    ts = F.when(F.col("event_id") % 2 == 0, F.date_trunc("second", "ts").cast("timestamp_ntz")).otherwise(F.col("ts"))
    d = ev.select("event_id", ts.alias("ts"), F.col("user_id").alias("n"), v.alias("v"))
    return d.select("event_id", fn.to_native(d, ["event_id", "ts", "n", "v"]).alias("json"))


FN_TO_NATIVE_SQL = """
with e as (select event_id, user_id, case when event_id % 2 = 0 then date_trunc('second', ts) else ts end as t,
                  case when event_id % 5 <> 0 and event_id % 7 <> 0 and value > 5 then floor(value) + 0.5 end as v from events)
select event_id, json_object('event_id', event_id,
         'ts', case when epoch_us(t) % 1000000 = 0 then strftime(t, '%Y-%m-%dT%H:%M:%S') else strftime(t, '%Y-%m-%dT%H:%M:%S.%f') end,
         'n', user_id, 'v', v)::varchar as json from e"""


REGISTRY = {
    "fn_sanitize_container": (q_fn_sanitize_container, FN_SANITIZE_CONTAINER_SQL),
    "fn_parse_bool": (q_fn_parse_bool, FN_PARSE_BOOL_SQL),
    "fn_unwrap_value": (q_fn_unwrap_value, FN_UNWRAP_VALUE_SQL),
    "fn_coerce_typed": (q_fn_coerce_typed, FN_COERCE_TYPED_SQL),
    "fn_split_list": (q_fn_split_list, FN_SPLIT_LIST_SQL),
    "fn_sentinel_null": (q_fn_sentinel_null, FN_SENTINEL_NULL_SQL),
    "fn_parse_bin": (q_fn_parse_bin, FN_PARSE_BIN_SQL),
    "fn_freq_label": (q_fn_freq_label, FN_FREQ_LABEL_SQL),
    "fn_fmt_freq": (q_fn_fmt_freq, FN_FMT_FREQ_SQL),
    "fn_channel_short": (q_fn_channel_short, FN_CHANNEL_SHORT_SQL),
    "fn_storage_path": (q_fn_storage_path, FN_STORAGE_PATH_SQL),
    "fn_path_split": (q_fn_path_split, FN_PATH_SPLIT_SQL),
    "fn_alt_text": (q_fn_alt_text, FN_ALT_TEXT_SQL),
    "fn_segment_name": (q_fn_segment_name, FN_SEGMENT_NAME_SQL),
    "fn_segment_day": (q_fn_segment_day, FN_SEGMENT_DAY_SQL),
    "fn_prefix": (q_fn_prefix, FN_PREFIX_SQL),
    "fn_db_linear": (q_fn_db_linear, FN_DB_LINEAR_SQL),
    "fn_round1": (q_fn_round1, FN_ROUND1_SQL),
    "fn_thousands": (q_fn_thousands, FN_THOUSANDS_SQL),
    "fn_to_native": (q_fn_to_native, FN_TO_NATIVE_SQL),
}
