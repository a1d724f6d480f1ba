"""Message parsing and the ping stream: JSON messages -> typed pings of known channels."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acoustispark.operators.calibrate import join_channel_cal

#: ISO date, or date and time with optional fraction and offset, as the stream's clock writes them.
ISO_TIME = r"^\d{4}-\d{2}-\d{2}([T ]\d{2}:\d{2}(:\d{2}([.]\d{1,6})?)?([+-]\d{2}:\d{2}|Z)?)?$"


def parse_messages(messages: DataFrame, value_col: str = "value") -> DataFrame:
    """JSON text -> ``type, channel_id, time, samples``; malformed JSON gives NULL fields and ``valid = false``
    (dropped downstream). A sample outside the 16-bit range is a NULL element."""
    v = F.try_parse_json(value_col)
    return messages.select(
        *[c for c in messages.columns if c != value_col],
        v.isNotNull().alias("valid"),
        F.try_variant_get(v, "$.type", "string").alias("type"),
        F.try_variant_get(v, "$.channel_id", "string").alias("channel_id"),
        F.try_variant_get(v, "$.time", "string").alias("time"),
        F.try_variant_get(v, "$.samples", "array<smallint>").alias("samples"))


def ping_time(text: str | Column) -> Column:
    """ISO text -> naive UTC timestamp (an offset is shifted); NULL when it is no time."""
    t = F.col(text) if isinstance(text, str) else text
    return F.when(t.rlike(ISO_TIME), t.try_cast("timestamp").cast("timestamp_ntz"))


def ping_stream(messages: DataFrame, cal: DataFrame, value_col: str = "value") -> DataFrame:
    """Accept only ``sample_data`` messages of a known channel whose time and samples can be read; attach channel
    parameters. One bad ping is skipped, the others go on. Works on a batch or a streaming frame."""
    p = parse_messages(messages, value_col)
    ok = p.where(F.col("valid") & (F.col("type") == "sample_data")).withColumn("ping_time", ping_time("time"))
    ok = ok.where(F.col("ping_time").isNotNull() & F.col("samples").isNotNull() & ~F.exists("samples", lambda x: x.isNull()))
    return join_channel_cal(ok, cal)
