"""Stores, jobs and streams: what goes in is what is kept."""

import datetime as dt
import json
import os
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from acoustispark.operators import config_log, jobs, report, summary
from acoustispark.operators.pings import to_samples
from acoustispark.sources import catalog, fixtures as fx, sinks
from acoustispark.streaming import stream as st
from acoustispark.streaming.trigger import TriggerParams, segment_trigger

from .conftest import SF


def _dir():
    return tempfile.mkdtemp(prefix="acsp-")


def _pings(spark):
    return fx.pings(spark, SF).drop("angle_along", "angle_athwart")


def _product(df, name="sv"):
    return sinks.with_batch_day(df).withColumn("campaign", F.lit("c")).withColumn("product", F.lit(name))


def test_product_replaces_its_segments_only(spark):
    root = _dir()
    p = _product(_pings(spark))
    sinks.sink_product(p, root)
    sinks.sink_product(p.where("platform = 'p0'").withColumn("lat", F.lit(-1.0)), root)
    back = catalog.read_product(spark, root, p.schema, product="sv")
    assert back.count() == p.count() and back.where("platform = 'p0' and lat <> -1").count() == 0 and back.where("platform <> 'p0' and lat = -1").count() == 0
    missing = catalog.read_product(spark, root + "/nope", p.schema)
    assert missing.count() == 0 and missing.columns == back.columns


def test_one_name_on_two_platforms_and_two_days(spark):
    """Two platforms share a segment name, one of them has it on two days, and one segment crosses midnight."""
    root = _dir()
    t = lambda day, h, m: dt.datetime(2024, 1, day, h, m)
    rows = [("a", "s", t(1, 10, 0)), ("a", "s", t(1, 10, 5)), ("a", "s", t(2, 10, 0)), ("a", "s", t(2, 10, 5)), ("b", "s", t(1, 10, 0)),
            ("a", "night", t(1, 23, 55)), ("a", "night", t(2, 0, 5))]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, platform string, segment string, ping_time timestamp_ntz")
    days = {r.id: r.day.day for r in sinks.with_batch_day(df).collect()}
    assert days == {0: 1, 1: 1, 2: 2, 3: 2, 4: 1, 5: 1, 6: 1}
    for part in ("platform = 'a' and id < 4", "platform = 'b'", "id >= 5", "id >= 5"):
        sinks.sink_day_append(df.where(part), root)
    back = spark.read.parquet(root)
    assert back.count() == len(rows)
    assert sorted({(r.day.day, r.platform, r.segment) for r in back.collect()}) == [(1, "a", "night"), (1, "a", "s"), (1, "b", "s"), (2, "a", "s")]


def test_converted_groups_keep_the_error(spark):
    good = _product(_pings(spark)).drop("campaign", "product")
    out = sinks.sink_converted({"beam": good, "bad": good.withColumn("lat", F.expr("cast('x' as int)"))}, _dir(), ["day", "platform"])
    assert out["beam"][0] and out["beam"][1] == "" and out["bad"][0] == "" and "CAST_INVALID_INPUT" in out["bad"][1]
    assert spark.read.parquet(out["beam"][0]).count() == good.count()


def test_report_files_hold_the_lines_in_order(spark):
    s = summary.segment_summary(_pings(spark)).withColumn("processing_time_ms", F.lit(1)).withColumn("products", F.array(F.lit("sv")))
    lines = report.segment_report(s, {})
    root = _dir()
    sinks.sink_reports(lines, root, ["day", "platform", "segment"], ["line_no"])
    want = [r.text for r in lines.where("platform = 'p0'").orderBy("line_no").collect()]
    got = spark.read.text(root).where("platform = 'p0'").select("value").collect()
    assert [r.value for r in got] == want and want[0].startswith("# Segment Report: ")


def test_report_pairs_channels_with_their_frequency(spark):
    freq = F.when(F.col("channel") == "ch0", 38000.0).when(F.col("channel") == "ch1", 70000.0).when(F.col("channel") == "ch2", 120000.0).otherwise(38000.0)
    s = summary.segment_summary(_pings(spark).withColumn("frequency_nominal", freq)).withColumn("processing_time_ms", F.lit(1)).withColumn("products", F.array(F.lit("sv")))
    text = [r.text for r in report.segment_report(s, {}).where("platform = 'p1'").collect()]
    assert [x for x in text if x.startswith("- ch")] == ["- ch0: 38 kHz", "- ch1: 70 kHz", "- ch2: 120 kHz", "- ch4: 38 kHz"]


CFG = {"survey_id": "S1", "denoise_enabled": True, "mvbs_enabled": True, "nasc_enabled": True, "seabed_enabled": True,
       "seabed_method": "maxSv", "mvbs_range_bin": "20", "mvbs_ping_time_bin": "20s", "nasc_dist_bin": "0.05", "absorption": 0.01}


def _status(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.stage, set()).add(r.status)
    return out


@pytest.fixture(scope="module")
def done(spark):
    root = _dir()
    return root, jobs.process_segments(spark, _pings(spark), CFG, root)


def test_job_stores_every_product(spark, done):
    root, status = done
    st_ = _status(status)
    assert set(st_) == {"sv", "denoise", "seabed", "mvbs", "nasc", "echograms", "metadata", "report"} and all(v == {"ok"} for v in st_.values()), st_
    read = lambda p: spark.read.parquet(f"{root}/products/{p}")
    assert read("sv").count() == read("sv_denoised").count() == read("sv_seabed").count() > 0
    assert all(read(p).count() for p in ("mvbs", "nasc", "echogram", "echogram_mvbs", "echogram_nasc"))
    m = spark.read.json(f"{root}/metadata")
    assert m.count() == 3 and set(m.first().products) == {"sv", "sv_denoised", "sv_seabed", "mvbs", "nasc"} and len(m.first().config) == 12
    assert spark.read.text(f"{root}/reports").where(F.col("value").startswith("# Segment Report")).count() == 3


def test_grids_see_the_masked_data(spark, done):
    root, _ = done
    deepest = spark.read.parquet(f"{root}/products/sv_seabed").where("seabed_depth is not null").withColumn(
        "d", F.array_max(F.zip_with("sv", "depth", lambda s, d: F.when(s.isNotNull(), d))))
    assert deepest.where("d >= seabed_depth").count() == 0 and deepest.count() > 0
    masked = to_samples(spark.read.parquet(f"{root}/products/sv_seabed").drop("seabed_depth")).where("sv is not null").count()
    assert spark.read.parquet(f"{root}/products/mvbs").agg(F.sum("n_samples")).first()[0] == masked


def test_reprocess_into_its_own_store(spark, done):
    root, _ = done
    sv = spark.read.parquet(f"{root}/products/sv")
    before = sv.count()
    schema = _product(_pings(spark)).schema
    again = jobs.reprocess_day(spark, f"{root}/products/sv", "2024-01-02", ["denoise", "mvbs"], CFG | {"denoise_methods": "impulse"}, root, schema)
    assert _status(again) == {"sv": {"ok"}, "denoise": {"ok"}, "mvbs": {"ok"}, "metadata": {"ok"}, "report": {"ok"}}
    assert spark.read.parquet(f"{root}/products/sv").count() == before


def test_parameters_come_from_the_configuration():
    d = jobs.denoise_params({"background_ping_window": "7", "background_snr_threshold": 1, "background_noise_max": -999.0,
                             "impulse_ping_lags": "1, 2", "transient_n_pings": 3, "attenuation_side_pings": 4})
    assert (d.ping_window, d.snr_threshold, d.noise_max, d.impulse_ping_lags, d.transient_n_pings, d.attenuation_side_pings) == (7, 1.0, None, [1, 2], 3, 4)
    assert jobs.denoise_params({"background_noise_max": -120.0}).noise_max == -120.0
    assert config_log.settings({"nasc_enabled": "true", "realtime_buffer_pings": "7"})["nasc_enabled"] is True


def test_a_bad_setting_fails_its_stage_only(spark):
    out = _status(jobs.process_segments(spark, _pings(spark), CFG | {
        "mvbs_range_bin": "wide", "seabed_method": "bogus", "denoise_methods": "bogus", "nasc_range_bin": "x", "plot_echogram": False}, _dir()))
    assert out["sv"] == {"ok"} and out["metadata"] == {"ok"}
    assert all("error" in s for k in ("denoise", "seabed", "mvbs") for s in out[k]) and next(iter(out["nasc"])).startswith("skipped: ")


def test_one_bad_segment_does_not_fail_the_others(spark):
    p = _pings(spark).where("ping < 75")
    src = sinks.with_batch_day(p)

    def build(df):
        return df.withColumn("bad", F.when(F.col("platform") == "p1", F.raise_error(F.lit("broken segment"))).otherwise(F.lit("")))

    root = _dir()
    found = jobs._guarded(src, build, lambda df: sinks.sink_product(df.withColumn("campaign", F.lit("c")).withColumn("product", F.lit("x")), root))
    segs = src.select("platform", "day", "segment").distinct()
    got = {(r.platform): s for which, s in found for r in segs.where(which).collect()}
    assert got["p0"] == got["p2"] == "ok" and "broken segment" in got["p1"]
    assert {r.platform for r in spark.read.parquet(root).select("platform").distinct().collect()} == {"p0", "p2"}


def test_segments_that_no_hash_bit_tells_apart_fail_alone(spark, monkeypatch):
    monkeypatch.setattr(jobs, "MAX_HALVINGS", 0)
    src = sinks.with_batch_day(_pings(spark).where("ping < 75"))
    done = []

    def build(df):
        return df.withColumn("bad", F.when(F.col("platform") == "p1", F.raise_error(F.lit("broken segment"))).otherwise(F.lit("")))

    found = jobs._guarded(src, build, lambda df: done.append({(r.platform, r.bad) for r in df.collect()}))
    segs = src.select("platform", "day", "segment").distinct()
    got = [(r.platform, s) for which, s in found for r in segs.where(which).collect()]
    assert len(got) == segs.count() and {p for p, s in got if s == "ok"} == {"p0", "p2"} == {p for d in done for p, _ in d}


def test_faulty_segments_cost_one_read_of_the_source(spark):
    """A thousand of ten thousand segments have a faulty ping: the source is read twice at most, the others are stored."""
    folder = _dir()

    def watched(batches):
        import os
        import uuid
        n = 0
        for b in batches:
            n += b.num_rows
            yield b
        with open(os.path.join(folder, f"{n}-{uuid.uuid4().hex}"), "w"):
            pass

    n = 10_000
    ids = spark.range(n, numPartitions=4)
    arr = F.array(F.lit(-60.0), F.lit(-50.0))
    src = ids.select(F.lit("p").alias("platform"), F.concat(F.lit("s"), F.col("id")).alias("segment"), F.lit("ch0").alias("channel"), F.lit(0).alias("channel_index"),
                     F.col("id").alias("ping"), F.lit("2024-01-01 00:00:00").cast("timestamp_ntz").alias("ping_time"), F.to_date(F.lit("2024-01-01")).alias("day"),
                     F.when(F.col("id") % 10 == 3, F.array(F.lit(-60.0))).otherwise(arr).alias("sv"), F.array(F.lit(0.0), F.lit(5.0)).alias("echo_range"),
                     F.array(F.lit(0.0), F.lit(5.0)).alias("depth"))
    src = src.mapInArrow(watched, src.schema)
    root = _dir()
    cfg = {"denoise_enabled": False, "mvbs_enabled": False, "plot_echogram": False, "reports_enabled": False}
    out = jobs.process_segments(spark, src, cfg, root)
    import os
    read = sum(int(f.split("-")[0]) for f in os.listdir(folder))
    assert read <= 2 * n, read
    told = {(r.stage, r.status): r["count"] for r in out.groupBy("stage", "status").count().collect()}
    assert told == {("sv", "ok"): 9000, ("sv", "error: 1 samples against 2 of echo_range"): 1000}
    assert spark.read.parquet(f"{root}/products/sv").count() == 9000


def test_a_broken_worker_is_no_error_of_a_segment(spark):
    src = sinks.with_batch_day(_pings(spark).where("ping < 75"))

    def dies(batches):
        import os
        for b in batches:
            os._exit(1)
            yield b

    with pytest.raises(Exception) as e:
        jobs._guarded(src, lambda df: df.mapInArrow(dies, df.schema), lambda df: df.write.format("noop").mode("overwrite").save())
    assert not jobs.caused_by_data(e.value)


def test_faults_of_a_ping(spark):
    t = dt.datetime(2024, 1, 1)
    rows = [(0, t, "c", [1.0], [0.0], [0.0]), (1, None, "c", [1.0], [0.0], [0.0]), (2, t, None, [1.0], [0.0], [0.0]), (3, t, "c", None, [0.0], [0.0]),
            (4, t, "c", [1.0, None], [0.0, 1.0], [0.0]), (5, t, "c", [float("inf")], [0.0], [0.0]), (6, t, "c", [1.0], [float("inf")], [0.0]), (7, t, "c", [], [], []), (8, t, "c", [None], [None], [None])]
    df = spark.createDataFrame(rows, "id int, ping_time timestamp_ntz, channel string, sv array<double>, echo_range array<double>, depth array<double>")
    got = {r.id: r.f for r in df.select("id", jobs.row_fault(df).alias("f")).collect()}
    assert got == {0: None, 1: "ping without a time", 2: "ping without a channel", 3: "ping without samples", 4: "2 samples against 1 of depth",
                   5: "infinite sv", 6: "infinite echo_range", 7: None, 8: None}


def test_no_valid_pings(spark):
    p = _pings(spark).where("ping < 50").withColumn("sv", F.when(F.col("platform") == "p0", F.transform("sv", lambda x: F.lit(None).cast("double"))).otherwise(F.col("sv")))
    out = jobs.process_segments(spark, p, {"denoise_enabled": False, "mvbs_enabled": False, "plot_echogram": False}, _dir())
    assert {(r.platform, r.stage, r.status) for r in out.collect()} == {
        ("p0", "sv", "skipped: no valid pings"), ("p1", "sv", "ok"), ("p1", "metadata", "ok"), ("p1", "report", "ok")}


# ---- streams -----------------------------------------------------------------------------------------------------

P = TriggerParams(buffer_pings=20, buffer_seconds=259200.0, min_pings=5)


def _events(spark):
    return spark.read.parquet(f"{SF}/events.parquet").select(
        F.concat(F.lit("u"), (F.col("user_id") % 3).cast("string")).alias("platform"), "ts", "event_id", F.col("value").alias("depth_m"))


def _in_parts(ev, n):
    """A folder with ``n`` time-ordered files, each a micro-batch."""
    src = _dir()
    lo, hi = ev.agg(F.min("ts"), F.max("ts")).collect()[0]
    for i in range(n):
        a, b = lo + (hi - lo) / n * i, lo + (hi - lo) / n * (i + 1)
        ev.where((F.col("ts") >= a) & ((F.col("ts") < b) if i < n - 1 else F.lit(True))).coalesce(1).write.parquet(f"{src}/b{i}")
        time.sleep(0.05)
    return src


def _reader(spark, ev, src):
    return spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", "true").parquet(src)


@pytest.mark.parametrize("parts", [1, 4])
def test_stream_hands_over_whole_segments(spark, parts):
    """Segments that span micro-batches reach the daily store once and whole, equal to the batch form; a restart from the
    checkpoint adds nothing."""
    ev = _events(spark)
    src, root, ck = _in_parts(ev, parts), _dir(), _dir()
    for _ in range(2):
        closed = st.segment_stream(_reader(spark, ev, src), P, payload=["depth_m"])
        q = st.segment_pipeline(closed, lambda df, epoch: st.day_accumulate(df, root), ck)
        assert q.awaitTermination(120)
    stored = spark.read.parquet(root)
    batch = segment_trigger(ev, P, chunk_rows=64)
    last = batch.groupBy("platform").agg(F.max("segment_rn").alias("segment_rn"))
    whole = {r.event_id: (r.platform, r.segment_start, r.n_segment_pings) for r in batch.collect()}
    got = {r.event_id: (r.platform, r.segment_start, r.n_segment_pings) for r in stored.collect()}
    assert stored.count() == len(got) and got.items() <= whole.items()
    tail = {r.event_id for r in batch.join(last, ["platform", "segment_rn"]).collect()}
    assert set(whole) - set(got) <= tail  # only the last, still open segments are missing
    depth = {r.event_id: r.depth_m for r in ev.collect()}
    assert all(json.loads(r.payload)["depth_m"] == depth[r.event_id] for r in stored.limit(50).collect())


def test_stream_flush_equals_batch(spark):
    """After a silence the open pings are flushed if they are enough and dropped otherwise, as at the end of a batch."""
    ev = _events(spark).where("event_id < 160")
    src, ck = _in_parts(ev, 2), _dir()
    closed = st.segment_stream(_reader(spark, ev, src), P, flush_after="3 seconds")
    q = closed.writeStream.format("memory").queryName("flushed").outputMode("append").option("checkpointLocation", ck).trigger(processingTime="1 second").start()
    want = {(r.event_id, r.segment_start, r.n_segment_pings) for r in segment_trigger(ev, P).collect()}
    try:
        for _ in range(60):
            time.sleep(1)
            got = {(r.event_id, r.segment_start, r.n_segment_pings) for r in spark.sql("select * from flushed").collect()}
            if got == want:
                break
    finally:
        q.stop()
    assert got == want


def test_documents_are_written_by_many_tasks_and_replaced(spark):
    lines = spark.range(40).select(F.lit("2024-01-01").alias("day"), F.concat(F.lit("p"), F.col("id") % 4).alias("platform"),
                                   F.concat(F.lit("s"), F.col("id")).alias("segment"), F.explode(F.sequence(F.lit(0), F.lit(3))).alias("line_no"))
    lines = lines.withColumn("text", F.concat_ws(" ", "segment", "line_no"))
    root = _dir()
    keys = ["day", "platform", "segment"]
    sinks.sink_reports(lines, root, keys, ["line_no"])
    files = spark.read.text(root).select(*keys, F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == 40  # a file a document
    assert len({r.f.rsplit("/", 1)[1].split("-")[1] for r in files}) > 4  # and not all by one task
    sinks.sink_reports(lines.where("segment < 's2'").withColumn("text", F.concat(F.lit("new "), "text")), root, keys, ["line_no"])
    back = spark.read.text(root)
    assert back.count() == 160 and back.where("value like 'new %'").count() == back.where("segment < 's2'").count() == 48
    assert [r.value for r in back.where("segment = 's3'").collect()] == [f"s3 {i}" for i in range(4)]


def test_documents_are_as_sparks_writer_makes_them(spark):
    """Hadoop's local file system starts a process for each file, its checksum and each directory: there are no checksums here."""
    rows = [("2024-01-01", "a b/c", "s", 0, "first"), ("2024-01-01", "a b/c", "s", 1, None), ("2024-01-01", "", "s{%}", 0, 'ü "x"'), (None, None, "s", 0, ""), ("2024-01-02", "p=1", "", 0, "x")]
    df = spark.createDataFrame(rows, "day string, platform string, segment string, line_no int, text string")
    keys, root, plain = ["day", "platform", "segment"], _dir(), _dir()

    def held(top):
        out = {}
        for at, _, names in os.walk(top):
            for n in names:
                if n.startswith("part-"):
                    with open(f"{at}/{n}", encoding="utf-8") as f:
                        out[os.path.relpath(at, top)] = f.read()
        return out

    sinks.sink_reports(df, f"{root}/r", keys, ["line_no"])
    one = df.repartition(3, *keys).sortWithinPartitions(*keys, "line_no").select(*keys, "text")
    one.write.partitionBy(*keys).text(f"{plain}/r")
    assert held(f"{root}/r") == held(f"{plain}/r") and len(held(f"{root}/r")) == 4
    m = df.where("line_no = 0").select(F.col("day").alias("_day"), F.col("segment").alias("_s"), "*", F.to_timestamp_ntz(F.lit("2024-01-01 00:00:01")).alias("t"), F.lit(1.5).alias("x"))
    sinks._write_documents(m, f"{root}/m", ["_day", "_s"], [], "json", **sinks.JSON_OPTIONS)
    m.repartition(3, "_day", "_s").write.partitionBy("_day", "_s").options(**sinks.JSON_OPTIONS).json(f"{plain}/m")
    assert held(f"{root}/m") == held(f"{plain}/m") and len(held(f"{root}/m")) == 4
    assert not [n for at, _, names in os.walk(root) for n in names if n.startswith(".part-")]


def test_a_document_that_cannot_be_written_is_no_fault_of_the_data(spark):
    df = spark.createDataFrame([("d", "p", "s" * 300, 0, "x")], "day string, platform string, segment string, line_no int, text string")
    with pytest.raises(OSError) as e:
        sinks.sink_reports(df, f"{_dir()}/r", ["day", "platform", "segment"], ["line_no"])
    from acoustispark.operators import jobs
    assert "too long" in str(e.value) and not jobs.caused_by_data(e.value)


def test_days_are_written_by_many_tasks(spark):
    rows = spark.range(400).select(F.lit("p").alias("platform"), F.concat(F.lit("s"), F.col("id")).alias("segment"),
                                   F.timestamp_seconds(F.lit(1_704_067_200) + F.col("id") % 40 * 86_400).cast("timestamp_ntz").alias("ping_time"))
    root = _dir()
    sinks.sink_day_append(rows, root)
    files = spark.read.parquet(root).select(F.input_file_name().alias("f")).distinct().collect()
    assert len(files) == 40 and len({r.f.rsplit("/", 1)[1].split("-")[1] for r in files}) > 2 and spark.read.parquet(root).count() == 400
