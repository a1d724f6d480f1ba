"""Structured Streaming forms of navigation polling, MVBS, the running configuration, file events and messages.

Event-time operators hold their state no longer than the watermark asks for (the latest event time of the earlier
micro-batches less the allowed delay). A row whose cell, bucket or moment was behind the watermark of the micro-batch before
its own comes too late - its result is out - and is dropped [def]; everything else counts, in whatever order it arrives. Each
result row is emitted once. A row without a platform is a
time mark: it moves the watermark and is no data, so a session can end with one and leave nothing open.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from acoustispark.functions import scalars as fn
from acoustispark.operators import config_log as cl
from acoustispark.operators.grid import SEGMENT_KEYS, _meters, _seconds
from acoustispark.operators.util import spread_groups
from acoustispark.sources.catalog import new_file_events
from acoustispark.sources.sinks import sink_messages

#: Events of a device that are one block of results.
OUT_ROWS = 4096
#: Events of a device that go to Python at once, each time with the device's state.
IN_ROWS = 1 << 20
#: Bytes that a landing file holds for one reading task.
LANDING_BYTES = 4 << 20


def _event_time(ts: str) -> Column:
    return F.col(ts).cast("timestamp")


def _is_data(keys) -> Column:
    """Whether a group is data and no mark; an aggregate, as a filter on the key itself would be moved before the watermark
    and keep the marks from it."""
    return F.max(F.col(keys[0]).isNotNull()).alias("_data")


def nav_poll_stream(nav: DataFrame, delay: str, seconds: int = 5, keys=("platform",), ts: str = "ts") -> DataFrame:
    """``nav_poll`` on a stream: the first fix by time of each tumbling bucket, once its bucket is behind the watermark."""
    rows = nav.withColumn("_at", _event_time(ts)).withWatermark("_at", delay)
    first = rows.groupBy(*keys, F.window("_at", f"{seconds} seconds").alias("_w")).agg(
        F.min_by(F.struct(ts, "event_id", "lat", "lon", "heading"), F.struct(ts, "event_id")).alias("_f"), _is_data(keys))
    return first.where("_data").select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("bucket"), "_f.*")


def mvbs_stream(samples: DataFrame, delay: str, range_bin: str = "0.5m", ping_time_bin: str = "10s",
                keys: tuple[str, ...] = SEGMENT_KEYS + ("channel",), range_col: str = "echo_range") -> DataFrame:
    """``mvbs`` on a stream: cells are (sum, count) partials that merge over micro-batches, emitted when the cell's time is
    behind the watermark."""
    rb = _meters(range_bin)
    rows = samples.withColumn("_at", _event_time("ping_time")).withWatermark("_at", delay)
    mark = F.col(keys[0]).isNull()
    cells = rows.where(mark | (F.col("sv").isNotNull() & F.col(range_col).isNotNull())).groupBy(
        *keys, F.window("_at", f"{int(_seconds(ping_time_bin) * 1_000_000)} microseconds").alias("_w"), F.floor(F.col(range_col) / F.lit(rb)).alias("_rbin")).agg(
        F.sum(fn.db_to_linear("sv")).alias("_sum"), F.count("sv").alias("n_samples"), _is_data(keys))
    return cells.where("_data").select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("ping_time"), (F.col("_rbin") * F.lit(rb)).alias(range_col),
                                     fn.linear_to_db(F.col("_sum") / F.col("n_samples")).alias("sv"), "n_samples")


#: A row's ``slot`` is the number of the field that it writes, or one of these.
BATCH, NO_WRITE = -1, -2


def config_as_of_stream(batches: DataFrame, patches: DataFrame, delay: str, fields: list[str] | None = None) -> DataFrame:
    """``config_as_of`` over two streams: ``batches`` (device, ts, event_id) with the configuration each one ran under.

    A device's state is its folded configuration and, as Arrow bytes, the events that are not behind the watermark yet. These are taken in
    event-time order - patches before batches of one time, then by event_id - as the watermark passes them, however patches
    and batches are interleaved on arrival. The end of a session is a mark: a patch with a null ``key`` and a late time.

    Few devices may send many events. So a device's task only sorts: what it gives out are blocks of ``OUT_ROWS`` events with the
    configuration before them, and these are dealt to all tasks, which write out the fields of each batch. ``run_available`` is
    best told ``IN_ROWS``.
    """
    fields = fields or [n for n, _, _ in cl.CONFIG_FIELDS]
    slot = F.when(F.col("_value").isNull(), F.lit(NO_WRITE)).otherwise(F.coalesce(F.array_position(F.lit(fields), F.col("_field")).cast("int") - 1, F.lit(-1)))
    p = cl.typed_writes(spread_groups(patches, "device", "ts", "event_id")).select("device", "ts", "event_id", F.when(slot >= 0, slot).otherwise(F.lit(NO_WRITE)).alias("slot"), F.col("_value").alias("value"))
    b = batches.select("device", "ts", "event_id", F.lit(BATCH).alias("slot"), F.lit(None).cast("string").alias("value"))
    rows = p.unionByName(b).withColumn("at", _event_time("ts")).withWatermark("at", delay)
    rows = rows.select("device", "at", F.unix_micros("at").alias("us"), F.coalesce("event_id", F.lit(0)).cast("long").alias("event_id"), "slot", "value")
    device = T.StructField("device", batches.schema["device"].dataType)
    count = len(fields)

    def fold(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        config, waiting = (json.loads(state.get[0]), [_rows_of(state.get[1])]) if state.exists else ([None] * count, [])
        if not state.hasTimedOut:
            for pdf in pdfs:
                some = pdf.astype({"us": "int64"})[pdf["slot"] != NO_WRITE]  # an event without a time is an error
                waiting.append(pa.table({"us": some["us"].to_numpy(), "event_id": some["event_id"].to_numpy(), "slot": some["slot"].to_numpy().astype("int32"),
                                         "value": pa.array(some["value"], pa.string(), from_pandas=True)}))
        wait = pa.concat_tables(waiting).combine_chunks() if waiting else None
        if wait is None or not wait.num_rows:
            if not state.exists:
                return
            return state.update((state.get[0], state.get[1]))
        us, event, at = (wait.column(c).to_numpy() for c in ("us", "event_id", "slot"))
        order = np.lexsort((event, at == BATCH, us))
        wait = wait.take(pa.array(order))
        n = int(np.searchsorted(us[order], state.getCurrentWatermarkMs() * 1000))
        for i in range(0, n, OUT_ROWS):
            block = wait.slice(i, min(OUT_ROWS, n - i))
            slots = block.column("slot").to_numpy()
            if (slots == BATCH).any():
                yield pd.DataFrame([(k[0], i // OUT_ROWS, json.dumps(config), _bytes_of(block))], columns=["device", "block", "config", "events"])
            for s, v in zip(slots.tolist(), block.column("value").to_pylist()):
                if s != BATCH:
                    config[s] = v
        rest = wait.slice(n)
        state.update((json.dumps(config), _bytes_of(rest)))
        if rest.num_rows:
            state.setTimeoutTimestamp(max(rest.column("us")[0].as_py() // 1000, state.getCurrentWatermarkMs()) + 1)

    def told(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            for i in range(part.num_rows):
                config, block = json.loads(part.column(2)[i].as_py()), _rows_of(part.column(3)[i].as_py())
                slots, values = block.column("slot").to_numpy(), block.column("value").combine_chunks()
                batch = np.flatnonzero(slots == BATCH)
                columns = [pa.repeat(part.column(0)[i], len(batch)), *[block.column(c).combine_chunks().take(pa.array(batch)) for c in ("us", "event_id")]]
                for f, name in enumerate(fields):
                    writes = np.flatnonzero(slots == f)
                    before = cl.FIELD_DEFAULTS[name] if config[f] is None else config[f]
                    known = pa.concat_arrays([pa.array([before], pa.string()), values.take(pa.array(writes))])
                    columns.append(known.take(pa.array(np.searchsorted(writes, batch))))
                yield pa.RecordBatch.from_arrays(columns, names=["device", "us", "event_id", *fields])

    out = [T.StructField("block", T.LongType()), T.StructField("config", T.StringType()), T.StructField("events", T.BinaryType())]
    blocks = rows.groupBy("device").applyInPandasWithState(fold, T.StructType([device, *out]), "config string, wait binary", "append", GroupStateTimeout.EventTimeTimeout)
    each = [T.StructField("us", T.LongType()), T.StructField("event_id", T.LongType()), *[T.StructField(f, T.StringType()) for f in fields]]
    # the column is computed, as rows of Arrow batches cannot be dealt out as they are
    blocks = blocks.select("device", F.xxhash64("device", "block").alias("block"), "config", "events")
    found = spread_groups(blocks, "block").mapInArrow(told, T.StructType([device, *each]))
    return found.select("device", F.timestamp_micros("us").cast("timestamp_ntz").alias("ts"), "event_id", *fields)


def _bytes_of(rows: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, rows.schema) as w:
        w.write_table(rows)
    return sink.getvalue().to_pybytes()


def _rows_of(stored: bytes) -> pa.Table:
    return pa.ipc.open_stream(pa.py_buffer(bytes(stored))).read_all()


def file_event_batches(read_catalog: Callable[[SparkSession], DataFrame], write: Callable[[DataFrame, int], None]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function for file notifications: the catalogue is read anew for every micro-batch, so a file that
    appeared since the last one is found. ``write`` gets the rows with their status, and the epoch."""
    def process(events: DataFrame, epoch: int) -> None:
        write(new_file_events(events, read_catalog(events.sparkSession)), epoch)

    return process


def message_batches(outputs: dict[str, Column | None], path: str, key: list[str]) -> Callable[[DataFrame, int], None]:
    """A ``foreachBatch`` function that fans rows out to several named outputs; a replayed epoch replaces itself."""
    def process(rows: DataFrame, epoch: int) -> None:
        sink_messages(rows, outputs, path, key, epoch)

    return process


def run_available(stream: DataFrame, checkpoint: str, path: str | None = None, each: Callable[[DataFrame, int], None] | None = None,
                  rows: int | None = None) -> None:
    """Work off what has arrived, from the checkpoint on, and stop: into a Parquet table (written exactly once), or through
    ``each`` for every micro-batch. ``rows`` of a group go to Python at once: Spark sends the group's state along each time."""
    w = stream.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
    w = w.foreachBatch(each) if each is not None else w.format("parquet").option("path", path).outputMode("append")
    conf, name = stream.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = conf.get(name)
    if rows is not None:
        conf.set(name, str(rows))
    try:
        query = w.start()  # with the settings of this moment
    finally:
        conf.set(name, before)
    query.awaitTermination()


def land(arrivals: DataFrame, folder: str, slices: int, at: str = "slice") -> Iterator[int]:
    """Put the rows of slice 0, 1, ... into ``folder``, a file each, in this order; yields after each so that a stream can run
    in between. ``at`` numbers the slices and is not stored. The rows are made once, by all tasks, and a file's row groups are
    small, so that many tasks can read it."""
    from acoustispark.session import scratch_path
    path = scratch_path(arrivals.sparkSession, "arrivals")
    arrivals.write.partitionBy(at).parquet(path)
    made = arrivals.sparkSession.read.schema(arrivals.schema).parquet(path)
    for i in range(slices):
        made.where(F.col(at) == i).select(*[c for c in arrivals.columns if c != at]).coalesce(1).write.mode("append").option(
            "parquet.block.size", str(LANDING_BYTES)).parquet(folder)
        yield i


def arriving(spark: SparkSession, folder: str, schema, files: int = 1) -> DataFrame:
    """The folder as a stream, ``files`` files a micro-batch in order of arrival."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(folder)
