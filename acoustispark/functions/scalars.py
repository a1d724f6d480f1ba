"""Column-level scalar functions. All of them are built-in Spark expressions (JVM side, whole-stage codegen).

Arguments are Columns or column names; every function returns a Column.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

# Fixed values that must equal the reference's behaviour -------------------------------------------------
# strings that parse as boolean False (compared after lower-casing, without trimming)
FALSE_STRINGS = ["false", "0", "no", "off", ""]
# container sub-folders searched, in this priority, to shorten absolute storage paths
STORAGE_FOLDERS = ["echograms/", "echodata/", "processed/", "reports/"]
# container-name rules: maximum and minimum length, fallback name
CONTAINER_MAX_LEN = 63
CONTAINER_MIN_LEN = 3
CONTAINER_DEFAULT = "default"
# great-circle distance: mean Earth radius in km and km per nautical mile
EARTH_RADIUS_KM = 6371.0088
KM_PER_NMI = 1.852
# -------------------------------------------------------------------------------------------------------


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


# ---- naming / paths -----------------------------------------------------------------------------------

def _strip_dashes(c: Column) -> Column:
    return F.regexp_replace(c, r"^-+|-+$", "")


def sanitize_container(name) -> Column:
    """Blob container name: lower-case, ``[^a-z0-9-]`` -> ``-``, dashes collapsed and stripped, at most 63
    characters, ``default`` when nothing is left, right-padded with ``0`` to 3 characters."""
    s = _c(name)
    t = F.regexp_replace(F.regexp_replace(F.lower(s), r"[^a-z0-9-]", "-"), r"-{2,}", "-")
    t = _strip_dashes(F.substring(_strip_dashes(t), 1, CONTAINER_MAX_LEN))
    t = F.when(s.isNull() | (s == "") | (t == ""), F.lit(CONTAINER_DEFAULT)).otherwise(t)
    return F.when(F.length(t) < CONTAINER_MIN_LEN, F.rpad(t, CONTAINER_MIN_LEN, "0")).otherwise(t)


def freq_label(freq, channel_name=None) -> Column:
    """``38kHz`` / ``500Hz`` from the nominal frequency (truncating); without a frequency, ``ES<n>`` in the
    channel name gives ``<n>kHz``; otherwise the name with spaces and ``/`` replaced by ``_``, first 30 chars."""
    f = _c(freq)
    by_freq = F.when(f >= 1000, F.concat(F.floor(f / 1000).cast("bigint").cast("string"), F.lit("kHz"))) \
        .otherwise(F.concat(f.cast("bigint").cast("string"), F.lit("Hz")))
    if channel_name is None:
        return F.when(f.isNotNull(), by_freq)
    n = _c(channel_name)
    es = F.regexp_extract(n, r"ES(\d+)", 1)
    fallback = F.substring(F.translate(n, " /", "__"), 1, 30)
    return (F.when(f.isNotNull(), by_freq)
            .when(es != "", F.concat(es, F.lit("kHz")))
            .otherwise(fallback))


def fmt_freq(hz) -> Column:
    """``38 kHz`` / ``500 Hz`` (truncating)."""
    f = _c(hz)
    return F.when(f >= 1000, F.concat(F.floor(f / 1000).cast("bigint").cast("string"), F.lit(" kHz"))) \
        .otherwise(F.concat(f.cast("bigint").cast("string"), F.lit(" Hz")))


def channel_short(name) -> Column:
    """First three whitespace-separated words joined by ``_``."""
    words = F.filter(F.split(F.trim(_c(name)), r"\s+"), lambda w: w != "")
    return F.array_join(F.slice(words, 1, 3), "_")


def storage_path(path) -> Column:
    """Relative paths as they are; absolute ones cut at the first container folder found (priority order)."""
    p = _c(path)
    cut = F.coalesce(*[F.when(F.instr(p, d) > 0, F.regexp_extract(p, r"^.*?(" + d + r".*)$", 1))
                       for d in STORAGE_FOLDERS], p)
    return F.when(F.startswith(p, F.lit("/")), cut).otherwise(p)


def path_container(path) -> Column:
    """``container/rest`` -> ``container``."""
    return F.split_part(_c(path), F.lit("/"), F.lit(1))


def path_rest(path) -> Column:
    """``container/rest`` -> ``rest`` (the container stripped)."""
    return F.regexp_replace(_c(path), r"^[^/]*/", "")


def path_name(path) -> Column:
    """Last path component."""
    return F.regexp_extract(_c(path), r"([^/]*)$", 1)


def path_stem(path) -> Column:
    """Last path component without its final suffix (``a/b.tar.gz`` -> ``b.tar``; ``.hidden`` stays)."""
    return F.regexp_extract(path_name(path), r"^(.+?)(\.[^.]*)?$", 1)


def alt_text(stem) -> Column:
    """``stem.replace('_', ' ').title()``: title case restarts after every non-letter (``38khz`` -> ``38Khz``)."""
    s = F.regexp_replace(_c(stem), "_", " ")
    parts = F.split(s, r"(?<=[^A-Za-z])")
    return F.array_join(F.transform(parts, lambda x: F.initcap(x)), "")


def segment_name(t0, t1) -> Column:
    """``HH-MM-SS__HH-MM-SS`` of the first and last ping."""
    return F.concat(F.date_format(_c(t0), "HH-mm-ss"), F.lit("__"), F.date_format(_c(t1), "HH-mm-ss"))


def segment_day(t0) -> Column:
    return F.to_date(_c(t0))


def parse_day(s) -> Column:
    """ISO ``yyyy-MM-dd`` -> DATE, NULL when it does not parse (caller turns NULL into an error status)."""
    return F.to_date(F.try_to_timestamp(_c(s), F.lit("yyyy-MM-dd")))


def product_prefix(campaign, processed, day, segment, file_stem=None) -> Column:
    """``{campaign}/{processed}/{day}/segments/{segment}`` in real-time mode, ``{campaign}/{processed}/{stem}`` in file mode."""
    rt = F.concat_ws("/", _c(campaign), _c(processed), F.date_format(_c(day), "yyyy-MM-dd"), F.lit("segments"), _c(segment))
    if file_stem is None:
        return rt
    fs = _c(file_stem)
    return F.when(fs.isNotNull(), F.concat_ws("/", _c(campaign), _c(processed), fs)).otherwise(rt)


# ---- typed config values (JSON text in, typed value out) -----------------------------------------------

def json_kind(j) -> Column:
    """JSON type of a JSON text: null / boolean / number / string / object / array, NULL when malformed."""
    v = F.try_parse_json(_c(j))
    t = F.schema_of_variant(v)
    return (F.when(v.isNull(), F.lit(None))
            .when(t == "VOID", "null").when(t == "BOOLEAN", "boolean").when(t == "STRING", "string")
            .when(t.startswith("OBJECT"), "object").when(t.startswith("ARRAY"), "array")
            .otherwise("number"))


def json_string_value(j) -> Column:
    """The decoded text of a JSON string literal (``"a\\"b"`` -> ``a"b``)."""
    return F.try_variant_get(F.try_parse_json(_c(j)), "$", "string")


def unwrap_value(j) -> Column:
    """``{"value": X}`` -> X (as JSON text, type preserved); anything else unchanged."""
    j = _c(j)
    has = F.coalesce(F.array_contains(F.json_object_keys(j), "value"), F.lit(False))
    return F.when(has, F.to_json(F.variant_get(F.try_parse_json(j), "$.value", "variant"))).otherwise(j)


def json_parts(j) -> tuple[Column, Column, Column]:
    """(kind, variant, decoded string) of a JSON text, as the functions below take them. Where several are used on one text,
    compute these as columns first: inlined, they are parsed again at every mention."""
    return json_kind(j), F.try_parse_json(_c(j)), json_string_value(j)


def parse_bool(j, default: bool = True, parts: tuple[Column, Column, Column] | None = None) -> Column:
    """Python-truthiness of a JSON value: null -> default; bool as is; number != 0; string false iff its
    lower-case form is one of FALSE_STRINGS (no trimming); objects/arrays -> default."""
    j = _c(j)
    k, v, s = parts or json_parts(j)
    return (F.when(k.isNull() | (k == "null"), F.lit(default))
            .when(k == "boolean", F.try_variant_get(v, "$", "boolean"))
            .when(k == "number", F.try_variant_get(v, "$", "double") != 0)
            .when(k == "string", ~F.lower(s).isin(FALSE_STRINGS))
            .otherwise(F.lit(default)))


def coerce_int(j, parts: tuple[Column, Column, Column] | None = None) -> Column:
    """``int(value)`` as DECIMAL(38,0): integer strings parse, ``"3.7"`` does not, 3.7 truncates to 3, booleans are 0/1;
    NULL = the conversion fails or has more than 38 digits (the caller keeps the old value)."""
    j = _c(j)
    k, v, s = parts or json_parts(j)
    d = F.try_variant_get(v, "$", "double")
    whole = r"^\s*[+-]?[0-9]+\s*$"
    return (F.when((k == "number") & j.rlike(whole), F.trim(j).try_cast("decimal(38,0)"))
            .when(k == "number", (d - d % F.lit(1.0)).try_cast("decimal(38,0)"))
            .when(k == "boolean", F.try_variant_get(v, "$", "boolean").cast("int").cast("decimal(38,0)"))
            .when((k == "string") & s.rlike(whole), F.trim(s).try_cast("decimal(38,0)")))


def coerce_float(j, parts: tuple[Column, Column, Column] | None = None) -> Column:
    """``float(value)``; NULL = the conversion fails."""
    j = _c(j)
    k, v, s = parts or json_parts(j)
    num = r"^\s*[+-]?(([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?|inf|infinity|nan)\s*$"
    return (F.when(k == "number", F.try_variant_get(v, "$", "double"))
            .when(k == "boolean", F.try_variant_get(v, "$", "boolean").cast("double"))
            .when((k == "string") & F.lower(s).rlike(num), F.trim(s).try_cast("double")))


def coerce_str(j, parts: tuple[Column, Column, Column] | None = None) -> Column:
    """``str(value)`` for non-string fields: strings as they are, other JSON values as their text."""
    j = _c(j)
    k, _, s = parts or json_parts(j)
    return F.when(k == "string", s) \
        .when(k == "boolean", F.when(F.lower(j) == "true", "True").otherwise("False")) \
        .when(k == "null", F.lit("None")).otherwise(j)


def split_list(s) -> Column:
    """Comma list -> trimmed, non-empty items."""
    return F.filter(F.transform(F.split(_c(s), ","), lambda x: F.trim(x)), lambda x: x != "")


def split_int_list(s) -> Column:
    """Comma list -> integers; an item that is none gives a NULL element."""
    return F.transform(split_list(s), lambda x: x.try_cast("int"))


def sentinel_null(x, sentinel: float = -999.0) -> Column:
    """Numbers at or below the sentinel mean "not set"."""
    c = _c(x)
    return F.when(c > sentinel, c)


def empty_null(s) -> Column:
    return F.nullif(_c(s), F.lit(""))


def parse_bin_value(s) -> Column:
    """``"0.5m"`` -> 0.5, ``"10s"`` -> 10.0, ``"0.5nmi"`` -> 0.5; NULL without a number."""
    return F.regexp_extract(_c(s), r"^\s*([0-9.]+)\s*([A-Za-z]*)\s*$", 1).try_cast("double")


def parse_bin_unit(s) -> Column:
    return F.regexp_extract(_c(s), r"^\s*([0-9.]+)\s*([A-Za-z]*)\s*$", 2)


def parse_bin(text: str) -> tuple[float, str]:
    """Driver-side form for parameters (a bin width is a job parameter, not data)."""
    import re
    m = re.match(r"^\s*([0-9.]+)\s*([A-Za-z]*)\s*$", text)
    if not m:
        raise ValueError(f"bad bin width: {text!r}")
    return float(m.group(1)), m.group(2)


# ---- numbers ---------------------------------------------------------------------------------------------

def db_to_linear(x) -> Column:
    return F.pow(F.lit(10.0), _c(x) / 10.0)


def linear_to_db(x) -> Column:
    """10*log10(x); NULL for x <= 0."""
    c = _c(x)
    return F.when(c > 0, F.lit(10.0) * F.log10(c))


def haversine_nmi(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in nautical miles."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dphi = p2 - p1
    dl = F.radians(_c(lon2)) - F.radians(_c(lon1))
    a = F.pow(F.sin(dphi / 2), 2) + F.cos(p1) * F.cos(p2) * F.pow(F.sin(dl / 2), 2)
    return F.lit(2 * EARTH_RADIUS_KM / KM_PER_NMI) * F.asin(F.sqrt(a))


def round1(x) -> Column:
    """Python ``round(x, 1)``: half-even."""
    return F.bround(_c(x), 1)


def thousands(n) -> Column:
    """``12,345``."""
    return F.format_number(_c(n), 0)


def iso_text(ts) -> Column:
    """ISO text of a timestamp: six decimals of a second, none when they are zero."""
    t = _c(ts)
    fine = F.date_format(t, "SSSSSS")
    base = F.date_format(t, "yyyy-MM-dd'T'HH:mm:ss")
    return F.when(fine == "000000", base).otherwise(F.concat(base, F.lit("."), fine))


def to_native(df, columns: list[str]) -> Column:
    """JSON text of the named columns as plain values: NaN and infinities become null, timestamps ISO text, and NULL
    fields stay as null."""
    parts = []
    for name in columns:
        kind = df.schema[name].dataType.typeName()
        c = F.col(name)
        parts.append((finite(c) if kind in ("double", "float") else iso_text(c) if kind.startswith("timestamp") else c).alias(name))
    return F.to_json(F.struct(*parts), {"ignoreNullFields": "false"})


def finite(x) -> Column:
    """NULL for NaN and infinities."""
    c = _c(x)
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def location_message(lat, lon, ts, knots) -> Column:
    """``{"location":{"lat":..,"lon":..},"timestamp":ISO,"speed_knots":..}`` as JSON text."""
    return F.to_json(F.struct(
        F.struct(_c(lat).alias("lat"), _c(lon).alias("lon")).alias("location"),
        iso_text(ts).alias("timestamp"), _c(knots).alias("speed_knots")))


FOUR_PI_NMI2 = 4.0 * math.pi * 1852.0 ** 2
