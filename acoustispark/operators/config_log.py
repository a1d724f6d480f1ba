"""Configuration as data: a log of device-twin patches folded into the effective configuration per version,
and the as-of look-up of the configuration a batch ran under.

Patch values are JSON texts. Folding = unwrap ``{"value": x}`` -> rename ``Log_Level`` -> drop unknown keys
(``$version`` ...) -> typed coercion by field type -> last successful write wins per key, absent keys keep their
value (defaults before the first write). A failed int/float conversion is "no change"; a NULL boolean becomes
``true`` (the parser's default, even for fields whose configured default is false).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from acoustispark.functions import scalars as fn
from acoustispark.operators.util import spread_groups, staged

# Fixed values that must equal the reference's behaviour ------------------------------------------------------------
# (field, type, default) of the processing configuration, in declaration order
CONFIG_FIELDS = [
    ("sonar_model", "str", "EK80"), ("waveform_mode", "str", "CW"), ("encode_mode", "str", "power"),
    ("depth_offset", "float", "0.0"),
    ("survey_id", "str", ""), ("survey_name", "str", ""), ("platform_type", "str", ""), ("platform_name", "str", ""),
    ("platform_code_ICES", "str", ""),
    ("processing_mode", "str", "both"),
    ("ek80_service_url", "str", "http://localhost:8050"), ("ek80_host", "str", ""), ("ek80_port", "str", "0"),
    ("realtime_buffer_seconds", "int", "1800"), ("realtime_buffer_pings", "int", "100"),
    ("realtime_min_pings", "int", "50"),
    ("use_gpu", "bool", "true"),
    ("denoise_enabled", "bool", "true"), ("mvbs_enabled", "bool", "true"), ("nasc_enabled", "bool", "false"),
    ("plot_echogram", "bool", "true"),
    ("denoise_methods", "str", "background,transient,impulse,attenuation"),
    ("denoise_use_frequency_specific", "bool", "false"), ("denoise_pulse_length", "str", ""),
    ("background_num_side_pings", "int", "25"), ("background_range_window", "int", "20"),
    ("background_ping_window", "int", "50"), ("background_snr_threshold", "float", "3.0"),
    ("background_noise_max", "float", "-999.0"),
    ("transient_a", "float", "2.0"), ("transient_n", "int", "5"), ("transient_exclude_above", "float", "250.0"),
    ("transient_depth_bin", "float", "5.0"), ("transient_n_pings", "int", "20"),
    ("transient_threshold_db", "float", "6.0"),
    ("impulse_threshold_db", "float", "10.0"), ("impulse_num_lags", "int", "3"),
    ("impulse_vertical_bin", "float", "2.0"), ("impulse_ping_lags", "str", "1"),
    ("attenuation_threshold", "float", "0.8"), ("attenuation_upper_limit", "float", "180.0"),
    ("attenuation_lower_limit", "float", "280.0"), ("attenuation_side_pings", "int", "15"),
    ("seabed_enabled", "bool", "false"), ("seabed_method", "str", "ariza"), ("seabed_max_range", "float", "1000.0"),
    ("mvbs_range_bin", "str", "0.5"), ("mvbs_ping_time_bin", "str", "10s"),
    ("nasc_range_bin", "str", "10"), ("nasc_dist_bin", "str", "0.5"),
    ("storage_backend", "str", "azure-blob-edge"), ("output_base_path", "str", "/app/processed"),
    ("converted_container", "str", "converted"), ("echogram_container", "str", "echograms"),
    ("processed_container", "str", "processed"), ("pdf_output_path", "str", "/app/pdf_output"),
    ("log_level", "str", "INFO"),
]
# patch keys that differ from field names
KEY_RENAMES = {"Log_Level": "log_level"}
# -----------------------------------------------------------------------------------------------------------------------

FIELD_TYPES = {n: t for n, t, _ in CONFIG_FIELDS}
FIELD_DEFAULTS = {n: d for n, _, d in CONFIG_FIELDS}


def _field_name(key: Column) -> Column:
    expr = key
    for k, v in KEY_RENAMES.items():
        expr = F.when(key == k, F.lit(v)).otherwise(expr)
    return expr


def typed_value(field: Column, j: Column, parts: tuple[Column, Column, Column] | None = None) -> Column:
    """Coerced value as text by the field's type; NULL = the write does not change the field."""
    by_type = {t: [n for n, tt, _ in CONFIG_FIELDS if tt == t] for t in ("bool", "int", "float", "str")}
    return (F.when(field.isin(by_type["bool"]), fn.parse_bool(j, True, parts).cast("string"))
            .when(field.isin(by_type["int"]), fn.coerce_int(j, parts).cast("string"))
            .when(field.isin(by_type["float"]), fn.coerce_float(j, parts).cast("string"))
            .when(field.isin(by_type["str"]), fn.coerce_str(j, parts)))


def typed_writes(patches: DataFrame) -> DataFrame:
    """``device, ts, event_id, _field, _value`` of every patch. The value is unwrapped, parsed and typed step by step, each a
    column that the next one mentions: in one expression the parsing is inlined so often that it does not compile."""
    rows = patches.select("device", "ts", "event_id", "key", fn.unwrap_value("raw_json").alias("_j"))
    rows = rows.withColumn("_v", F.try_parse_json("_j")).withColumn("_t", F.schema_of_variant("_v"))
    kind = (F.when(F.col("_v").isNull(), F.lit(None)).when(F.col("_t") == "VOID", "null").when(F.col("_t") == "BOOLEAN", "boolean")
            .when(F.col("_t") == "STRING", "string").when(F.col("_t").startswith("OBJECT"), "object").when(F.col("_t").startswith("ARRAY"), "array").otherwise("number"))
    rows = rows.withColumns({"_k": kind, "_s": F.try_variant_get("_v", "$", "string"), "_field": _field_name(F.col("key"))})
    return rows.select("device", "ts", "event_id", "_field", typed_value(F.col("_field"), F.col("_j"), (F.col("_k"), F.col("_v"), F.col("_s"))).alias("_value"))


def _events(patches: DataFrame, fields: list[str]) -> DataFrame:
    """One row per (device, ts, event_id) with the map of what it writes; written, as it is read twice."""
    typed = typed_writes(spread_groups(patches, "device", "ts", "event_id"))
    one = F.when(F.col("_field").isin(fields) & F.col("_value").isNotNull(), F.struct("_field", "_value"))
    # an event that writes a field twice keeps the largest text, as before
    writes = F.map_from_entries(F.sort_array(F.collect_set(one)))
    return staged(typed.groupBy("device", "ts", "event_id").agg(writes.alias("_w")), "config-events")


def _before(events: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """(device, _day, a column a field): what the days before have left. Rows are (device, day, field) - a day's last write, then
    the last one of the days before - so no value is carried through a column a field."""
    last = events.select("device", "_day", *order, F.explode_outer("_w").alias("_field", "_value")).groupBy("device", "_day", "_field").agg(
        F.max_by("_value", F.struct(*order)).alias("_value"))
    each = F.explode(F.array(*[F.lit(f) for f in fields])).alias("_field")
    grid = last.select("device", "_day").distinct().select("device", "_day", each)
    w = Window.partitionBy("device", "_field").orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    carried = grid.join(last, ["device", "_day", "_field"], "left").withColumn("_left", F.last("_value", ignorenulls=True).over(w))
    left = carried.groupBy("device", "_day").agg(F.map_from_entries(F.collect_list(F.when(F.col("_left").isNotNull(), F.struct("_field", "_left")))).alias("_c"))
    return left.select("device", "_day", *[F.col("_c")[f].alias(f"_c_{f}") for f in fields])


def _folded(events: DataFrame, order: list[str], fields: list[str]) -> DataFrame:
    """Every field's value at each event: the last write of its day up to it, else what the days before have left, else the
    default."""
    d = events.withColumn("_day", F.to_date(order[0]))
    w = Window.partitionBy("device", "_day").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    rest = [c for c in d.columns if c != "_w"]
    run = spread_groups(d, "device", "_day").select(*rest, *[F.last(F.col("_w")[f], ignorenulls=True).over(w).alias(f) for f in fields])
    out = run.join(_before(d, order, fields), ["device", "_day"], "left")
    return out.select(*[c for c in rest if c != "_day"], *[F.coalesce(F.col(f), F.col(f"_c_{f}"), F.lit(FIELD_DEFAULTS[f])).alias(f) for f in fields])


def config_fold(patches: DataFrame, fields: list[str] | None = None) -> DataFrame:
    """Effective configuration after every patch event: ``device, ts, event_id`` and one text column per field.

    An event is one row; the last written value of every field is carried forward by one window per (device, day) and
    one over the days.
    """
    fields = fields or [n for n, _, _ in CONFIG_FIELDS]
    return _folded(_events(patches, fields), ["ts", "event_id"], fields)


def config_as_of(batches: DataFrame, patches: DataFrame, fields: list[str] | None = None, ts: str = "ts") -> DataFrame:
    """The configuration each batch ran under: one snapshot per batch, the state after the last patch at or
    before the batch start (defaults when there is none). ``batches``: ``device, ts, event_id``."""
    fields = fields or [n for n, _, _ in CONFIG_FIELDS]
    w = _events(patches, fields).withColumnRenamed("ts", ts).withColumn("_side", F.lit(0))
    b = batches.select("device", ts, "event_id", F.lit(1).alias("_side"))
    u = _folded(w.unionByName(b, allowMissingColumns=True), [ts, "_side", "event_id"], fields)
    return u.where(F.col("_side") == 1).select("device", ts, "event_id", *fields)


def settings(row) -> dict:
    """A folded configuration row (a ``Row`` or dict of texts) as typed job settings."""
    d = row.asDict() if hasattr(row, "asDict") else dict(row)
    kinds = {"bool": lambda x: x == "true", "int": int, "float": float, "str": str}
    return {n: kinds[t](d[n] if d.get(n) is not None else default) for n, t, default in CONFIG_FIELDS}
