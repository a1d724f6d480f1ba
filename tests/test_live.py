"""Streaming forms: event time, late rows, replays, rows of two streams; small tables with hand-made arrival."""

import datetime as dt
import tempfile

import pytest
from pyspark.sql import functions as F

from acoustispark.operators import config_log as cl
from acoustispark.operators import grid
from acoustispark.operators.pings import to_samples
from acoustispark.operators.track import nav_poll
from acoustispark.sources import fixtures as fx
from acoustispark.sources import sinks
from acoustispark.streaming import live
from acoustispark.streaming import stream as st
from acoustispark.streaming.trigger import TriggerParams

from .conftest import SF


def _dir():
    return tempfile.mkdtemp(prefix="acsp-live-")


def _run(spark, rows, schema, build, batches, **sink):
    """``rows[i]`` arrives with micro-batch ``i``; the stream is stopped and started again after each."""
    folder, checkpoint, out = _dir(), _dir(), _dir()
    for some in rows:
        spark.createDataFrame(some, schema).coalesce(1).write.mode("append").parquet(folder)
        live.run_available(build(live.arriving(spark, folder, spark.createDataFrame([], schema).schema)), checkpoint, out if not sink else None, **sink)
    return None if sink else spark.read.parquet(out)


NAV = "platform string, event_id bigint, ts timestamp_ntz, lat double, lon double, heading double"


def test_a_bucket_is_emitted_once_and_a_late_fix_is_dropped(spark):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    fix = lambda e, s: ("a", e, t(s), 1.0 * e, 0.0, 0.0)
    rows = [[fix(1, 7), fix(2, 3)], [fix(3, 1), fix(4, 60)], [fix(5, 8), fix(6, 61)], [fix(7, 2), fix(8, 62)], [(None, None, t(4000), None, None, None)]]
    got = _run(spark, rows, NAV, lambda s: live.nav_poll_stream(s, "10 seconds"), 1).collect()
    assert sorted((r.bucket.second, r.bucket.minute, r.event_id) for r in got) == [(0, 0, 3), (0, 1, 4), (5, 0, 1)]


def test_polling_does_not_depend_on_the_order_of_arrival(spark):
    nav = fx.nav(spark, SF).select("platform", "event_id", "ts", "lat", "lon", "heading").limit(400).collect()
    nav = [tuple(r) for r in nav]
    mark = [(None, None, dt.datetime(2030, 1, 1), None, None, None)]
    want = {(r.platform, r.bucket, r.event_id) for r in nav_poll(spark.createDataFrame(nav, NAV)).collect()}
    for parts in ([nav[::-1], mark], [nav[1::2], nav[::2], mark]):
        got = _run(spark, parts, NAV, lambda s: live.nav_poll_stream(s, "100 days"), 1).collect()
        assert {(r.platform, r.bucket, r.event_id) for r in got} == want and len(got) == len(want)


def test_cells_shared_by_micro_batches(spark):
    pings = fx.pings(spark, SF).drop("angle_along", "angle_athwart").where("ping < 20")
    rows = [tuple(r) for r in pings.collect()]
    at = pings.columns.index("ping_time")
    mark = [tuple(dt.datetime(2030, 1, 1) if i == at else [0.0] if isinstance(v, list) else None for i, v in enumerate(rows[0]))]
    got = _run(spark, [rows[::2], rows[1::2], mark], pings.schema, lambda s: live.mvbs_stream(to_samples(s), "1 hour", "20m", "20s"), 1)
    want = grid.mvbs(to_samples(pings), "20m", "20s")
    key = lambda df: {(r.platform, r.segment, r.channel, r.ping_time, r.echo_range): (round(r.sv, 9), r.n_samples) for r in df.collect()}
    assert key(got) == key(want) and got.count() == want.count()


def test_a_patch_that_arrives_after_its_batch_still_counts(spark):
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    schema = "device string, ts timestamp_ntz, event_id bigint, key string, raw_json string, side int"
    patch = lambda e, s, k, v: ("d", t(s), e, k, v, 0)
    batch = lambda e, s: ("d", t(s), e, None, None, 1)
    rows = [[batch(10, 5), patch(1, 1, "survey_id", '"A"')], [batch(11, 20), patch(2, 5, "survey_id", '"B"'), patch(3, 6, "nasc_enabled", "null")],
            [patch(4, 30, "survey_id", '"C"'), batch(12, 3)], [("d", t(9000), None, None, None, 0)]]

    def build(s):
        return live.config_as_of_stream(s.where("side = 1").select("device", "ts", "event_id"), s.where("side = 0").drop("side"), "60 seconds", ["survey_id", "nasc_enabled"])

    got = {r.event_id: (r.survey_id, r.nasc_enabled) for r in _run(spark, rows, schema, build, 1).collect()}
    assert got == {12: ("A", "false"), 10: ("B", "false"), 11: ("B", "true")}
    flat = [r for part in rows for r in part]
    p = spark.createDataFrame([r[:5] for r in flat if r[5] == 0 and r[3]], "device string, ts timestamp_ntz, event_id bigint, key string, raw_json string")
    b = spark.createDataFrame([r[:3] for r in flat if r[5] == 1], "device string, ts timestamp_ntz, event_id bigint")
    assert got == {r.event_id: (r.survey_id, r.nasc_enabled) for r in cl.config_as_of(b, p, ["survey_id", "nasc_enabled"]).collect()}


def test_the_catalogue_is_read_anew_for_every_micro_batch(spark):
    catalog, out, folder, checkpoint = _dir() + "/c", _dir() + "/o", _dir(), _dir()
    schema = "event_id bigint, event string, file_added_path string"
    each = live.file_event_batches(lambda s: s.read.schema("path string").parquet(catalog), lambda df, e: df.write.mode("append").parquet(out))
    spark.createDataFrame([("a",)], "path string").write.parquet(catalog)
    for i, name in enumerate(["a", "b"]):
        spark.createDataFrame([(i, "fileadd", "b"), (i + 10, "fileadd", "a")], schema).coalesce(1).write.mode("append").parquet(folder)
        live.run_available(live.arriving(spark, folder, spark.createDataFrame([], schema).schema), checkpoint, each=each)
        spark.createDataFrame([("b",)], "path string").write.mode("append").parquet(catalog)
    assert {r.event_id: r.status for r in spark.read.parquet(out).collect()} == {0: "error", 10: "queued", 1: "queued", 11: "queued"}


def test_a_replayed_epoch_adds_no_message(spark):
    path = _dir()
    df = spark.createDataFrame([(1, "ok"), (2, "error")], "file_id bigint, status string")
    outputs = {"output1": None, "outputml": F.col("status") == "ok"}
    for epoch in (0, 1, 1, 0):
        sinks.sink_messages(df, outputs, path, ["file_id"], epoch)
    got = spark.read.schema("output string, epoch bigint, message_id string, body string").json(path).collect()
    assert sorted((r.output, r.epoch) for r in got) == [("output1", 0)] * 2 + [("output1", 1)] * 2 + [("outputml", 0), ("outputml", 1)]
    assert len({r.message_id for r in got}) == 6


@pytest.mark.parametrize("cut", [3, 6, 8])
def test_the_end_of_a_session_flushes_or_drops(spark, cut):
    """Nine pings, at most four a segment and at least two: 4, 4 and a rest of one that is dropped; a second session starts anew."""
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    one = [("a", t(i), i, False) for i in range(9)] + [("a", t(9), None, True)]
    two = [("a", t(20 + i), 20 + i, False) for i in range(3)] + [("a", t(30), None, True)]
    rows = [one[:cut], one[cut:] + two[:1], two[1:]]
    got = _run(spark, rows, "platform string, ts timestamp_ntz, event_id bigint, ends boolean",
               lambda s: st.segment_stream(s, TriggerParams(4, 1e9, 2), ends="ends"), 1).collect()
    sizes = {}
    for r in got:
        sizes.setdefault(r.segment_start.second, []).append(r.event_id)
    assert {k: sorted(v) for k, v in sizes.items()} == {0: [0, 1, 2, 3], 4: [4, 5, 6, 7], 20: [20, 21, 22]}


# ---- the store the streams write ---------------------------------------------------------------------------------

def _segments(spark, names, value, day=1):
    rows = [("p", n, dt.datetime(2024, 1, day, 1, 0, i), value) for n in names for i in range(3)]
    return spark.createDataFrame(rows, "platform string, segment string, ping_time timestamp_ntz, v int")


def _files(spark, root):
    return spark.read.parquet(root).select(F.input_file_name()).distinct().count()


def test_files_follow_bytes_and_not_segments(spark):
    root = _dir()
    sinks.sink_day_append(_segments(spark, [f"s{i}" for i in range(200)], 0), root)
    assert _files(spark, root) == 1
    for i in range(3):
        sinks.sink_day_append(_segments(spark, [f"t{i}"], 0), root)
    assert _files(spark, root) == 4 and sinks.compact(spark, root, sinks.DAY_DIRS) == 1 and _files(spark, root) == 1
    sinks.sink_day_append(_segments(spark, ["s7", "new"], 5).unionByName(_segments(spark, ["other"], 6, 2)), root)
    back = spark.read.parquet(root)
    assert back.count() == 3 * 205 and _files(spark, root) == 2 and sinks.compact(spark, root, sinks.DAY_DIRS) == 0
    assert {(r.segment, r.v) for r in back.where("v > 0").distinct().collect()} == {("s7", 5), ("new", 5), ("other", 6)}


def test_a_long_segment_goes_over_several_files(spark, monkeypatch):
    monkeypatch.setattr(sinks, "FILE_BYTES", 2000)
    root = _dir()
    rows = spark.range(5000).select(F.lit("p").alias("platform"), F.lit("s").alias("segment"),
                                    F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id")).cast("timestamp_ntz").alias("ping_time"), F.rand(1).alias("v"))
    sinks.sink_day_append(rows, root)
    assert _files(spark, root) > 3 and spark.read.parquet(root).count() == 5000


def test_named_directories_are_the_only_ones_read(spark):
    from acoustispark.sources import catalog as ct
    root = _dir()
    p = _segments(spark, ["a"], 1).unionByName(_segments(spark, ["b"], 2, 2))
    p = sinks.with_batch_day(p).withColumn("campaign", F.lit("c")).withColumn("product", F.lit("sv"))
    sinks.sink_product(p, root)
    one = ct.read_product(spark, root, p.schema, campaign="c", product="sv", day="2024-01-02")
    assert {r.segment for r in one.collect()} == {"b"} and len(one.inputFiles()) == 1 and one.columns == p.columns
    assert ct.read_product(spark, root, p.schema, campaign="c", product="sv", day="2024-02-02").count() == 0


def test_results_of_a_device_leave_in_parts(spark, monkeypatch):
    monkeypatch.setattr(live, "OUT_ROWS", 3)
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    schema = "device string, ts timestamp_ntz, event_id bigint, key string, raw_json string, side int"
    rows = [("d", t(3 * i), i, "survey_id", f'"{i // 2}"', 0) for i in range(5)] + [("d", t(2 * i), 100 + i, None, None, 1) for i in range(8)]

    def build(s):
        out = live.config_as_of_stream(s.where("side = 1").select("device", "ts", "event_id"), s.where("side = 0").drop("side"), "60 seconds", ["survey_id", "mvbs_enabled"])
        assert "MapType" not in out._jdf.queryExecution().analyzed().toString()  # a map is searched once a field and row
        return out

    got = {r.event_id: (r.survey_id, r.mvbs_enabled) for r in _run(spark, [rows, [("d", t(9000), None, None, None, 0)]], schema, build, 1).collect()}
    assert got == {100 + i: (str(2 * i // 3 // 2), "true") for i in range(8)}


def test_messages_are_written_without_a_sort_by_output(spark):
    def told(batches):
        from pyspark import TaskContext
        for b in batches:
            b["status"] = TaskContext.get().getLocalProperty("spark.sql.maxConcurrentOutputFileWriters")
            yield b

    path = _dir()
    df = spark.createDataFrame([(1, "ok"), (2, "error")], "file_id bigint, status string").mapInPandas(told, "file_id bigint, status string")
    sinks.sink_messages(df, {"output1": None, "outputml": F.col("file_id") == 1}, path, ["file_id"], 0)
    got = spark.read.schema("output string, epoch bigint, body string").json(path).collect()
    assert sorted((r.output, r.body) for r in got) == [("output1", '{"file_id":1,"status":"2"}'), ("output1", '{"file_id":2,"status":"2"}'), ("outputml", '{"file_id":1,"status":"2"}')]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"


def test_platforms_share_groups_and_segments_share_frames(spark):
    """A call of Python, and a frame of results, for each platform or segment made the time follow their number: 300 platforms of
    two segments each come in no more batches of results than there are partitions and micro-batches."""
    from acoustispark.streaming import stream
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    names = [f"v{i}" for i in range(300)] + [None]
    rows = [[(n, t(i), i, False) for n in names for i in range(0, 6)], [(n, t(i), i, False) for n in names for i in range(6, 9)] + [(n, t(9), None, True) for n in names]]
    schema = "platform string, ts timestamp_ntz, event_id bigint, ends boolean"
    got = _run(spark, rows, schema, lambda s: st.segment_stream(s, TriggerParams(4, 1e9, 2), ends="ends"), 1).collect()
    want = {(n, i, 0 if i < 4 else 4, 4) for n in names for i in range(8)}
    assert len(got) == len(want) and {(r.platform, r.event_id, r.segment_start.second, r.n_segment_pings) for r in got} == want
    empty = spark.createDataFrame([], schema)
    plan = st.segment_stream(empty, TriggerParams(4, 1e9, 2), ends="ends")._jdf.queryExecution().optimizedPlan().toString()
    assert "xxhash64(platform" in plan and f", {stream.GROUPS})" in plan
    assert "xxhash64" not in st.segment_stream(empty, TriggerParams(4, 1e9, 2), flush_after="3 seconds")._jdf.queryExecution().optimizedPlan().toString()


def test_fields_are_written_out_by_more_tasks_than_there_are_devices(spark):
    """One device: its task sorts, and the blocks that it gives out are dealt to others, with every kind of write in a block."""
    import random
    t = lambda s: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=s)
    rnd, schema = random.Random(3), "device string, ts timestamp_ntz, event_id bigint, key string, raw_json string, side int"
    keys = [("survey_id", lambda: f'"{rnd.randrange(9)}"'), ("impulse_num_lags", lambda: rnd.choice(['"abc"', '"7"', '{"value":"12"}'])), ("use_gpu", lambda: rnd.choice(["null", '"off"'])),
            ("Log_Level", lambda: '"DEBUG"'), ("$version", lambda: "3")]
    n = 3 * live.OUT_ROWS
    rows = [("d", t(i // 3), i, *(lambda k: (k[0], k[1]()))(rnd.choice(keys)), 0) if rnd.random() < 0.4 else ("d", t(i // 3), i, None, None, 1) for i in range(n)]
    rnd.shuffle(rows)
    fields = ["survey_id", "impulse_num_lags", "use_gpu", "log_level", "seabed_method"]

    def build(s):
        out = live.config_as_of_stream(s.where("side = 1").select("device", "ts", "event_id"), s.where("side = 0").drop("side"), "100 days", fields)
        return out.withColumn("task", F.spark_partition_id())

    got = _run(spark, [rows[:n // 2], rows[n // 2:], [("d", t(10**8), None, None, None, 0)]], schema, build, 1)
    assert got.select("task").distinct().count() > 1
    p = spark.createDataFrame([r[:5] for r in rows if r[5] == 0], "device string, ts timestamp_ntz, event_id bigint, key string, raw_json string")
    b = spark.createDataFrame([r[:3] for r in rows if r[5] == 1], "device string, ts timestamp_ntz, event_id bigint")
    want = cl.config_as_of(b, p, fields).collect()
    assert sorted(tuple(r)[:-1] for r in got.collect()) == sorted(map(tuple, want)) and len(want) > n // 2


def test_rows_that_arrive_are_made_once(spark):
    """Each slice came from a run of its own over the whole source, in one task."""
    made = spark.sparkContext.accumulator(0)

    def told(batches):
        for b in batches:
            made.add(len(b))
            yield b

    rows = spark.range(100, numPartitions=4).selectExpr("id", "cast(nullif(id % 5, 4) as int) as slice").mapInPandas(told, "id bigint, slice int")
    folder, seen = _dir(), []
    for i in live.land(rows, folder, 3):
        back = spark.read.parquet(folder)
        seen.append((i, back.count(), _files(spark, folder), back.columns))
    assert seen == [(0, 20, 1, ["id"]), (1, 40, 2, ["id"]), (2, 60, 3, ["id"])] and made.value == 100


def test_a_devices_state_is_sent_once_with_many_events(spark):
    """Spark sends the whole state with each batch of a group's rows: 25,000 rows came in three, each with it."""
    from pyspark.sql.streaming.state import GroupStateTimeout
    import pandas as pd

    def fold(k, pdfs, state):
        yield pd.DataFrame([(k[0], sum(1 for _ in pdfs))], columns=["device", "frames"])

    folder = _dir()
    spark.range(25_000).selectExpr("'d' as device", "id").coalesce(1).write.mode("append").parquet(folder)
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    found = []
    for rows in (None, live.IN_ROWS):
        out = _dir()
        s = live.arriving(spark, folder, "device string, id bigint").groupBy("device").applyInPandasWithState(fold, "device string, frames int", "x int", "append", GroupStateTimeout.NoTimeout)
        live.run_available(s.select("*"), _dir(), out, rows=rows)
        found += [r.frames for r in spark.read.parquet(out).collect()]
    assert found == [3, 1] and spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == before
