"""Registered queries that run as streams: the tables arrive in slices, the stream is stopped and started again from its
checkpoint half-way, and the result is held against the SQL of the whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from acoustispark.operators.calibrate import channel_cal
from acoustispark.operators.config_log import CONFIG_FIELDS
from acoustispark.operators.pings import to_samples
from acoustispark.plans.common import rounded
from acoustispark.plans.control import CONFIG_AS_OF_SQL
from acoustispark.plans.io import PING_STREAM_SQL, _texts
from acoustispark.plans.oracle_views import with_views
from acoustispark.plans.streams import P, WALK_SQL
from acoustispark.session import scratch_path
from acoustispark.sources import fixtures as fx
from acoustispark.sources.messages import ping_stream
from acoustispark.sources.tables import read_table
from acoustispark.streaming import live
from acoustispark.streaming import stream as st

SLICES = 4


def _sliced(df, arrival):
    """``slice``: which of ``SLICES`` equal spans of arrival time (microseconds) a row comes in."""
    us = df.withColumn("_us", arrival)
    lo, hi = us.agg(F.min("_us"), F.max("_us")).first()
    lo, hi = lo or 0, hi or 0
    return us.withColumn("slice", F.least(F.lit(SLICES - 1), F.floor((F.col("_us") - lo) * SLICES / max(1, hi - lo))).cast("int")).drop("_us")


def _us(ts="ts"):
    return F.unix_micros(F.col(ts).cast("timestamp"))


def _in_two_runs(spark, arrivals, build, **sink):
    """Half of the slices arrive and are worked off, then the other half, by a new stream on the same checkpoint."""
    folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    schema = arrivals.drop("slice").schema
    for i in live.land(arrivals, folder, SLICES):
        if i % 2:
            live.run_available(build(live.arriving(spark, folder, schema)), checkpoint, **sink)


# ---- segments ----------------------------------------------------------------------------------------------------

def _segment_store(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("platform"), "ts", "event_id",
                                                   F.col("value").alias("depth_m"), F.lit(False).alias("ends"))
    ends = ev.groupBy("platform").agg((F.max("ts") + F.expr("interval 1 second")).alias("ts")).select(
        "platform", "ts", F.lit(None).cast(ev.schema["event_id"].dataType).alias("event_id"), F.lit(None).cast("double").alias("depth_m"), F.lit(True).alias("ends"))
    arrivals = _sliced(ev, _us()).unionByName(ends.withColumn("slice", F.lit(SLICES - 1)))
    root = scratch_path(spark, "days")
    _in_two_runs(spark, arrivals, lambda s: st.segment_stream(s, P, payload=["depth_m"], ends="ends"), each=lambda df, epoch: st.day_accumulate(df, root))
    return spark.read.parquet(root)


def q_segment_pipeline(spark, sf_dir):
    kept = _segment_store(spark, sf_dir)
    return rounded(kept.select("platform", "event_id", "segment_start", "n_segment_pings", F.get_json_object("payload", "$.depth_m").cast("double").alias("depth_m")))


SEGMENT_PIPELINE_SQL = WALK_SQL + f"""
select w.platform, w.event_id, w.sts as segment_start, s.size as n_segment_pings, round(e.value, 6) as depth_m
from walk w join seg s using (platform, srn) join events e using (event_id) where s.closed or s.size >= {P.min_pings}"""


def q_day_accumulate(spark, sf_dir):
    kept = _segment_store(spark, sf_dir)
    return kept.groupBy(F.date_format("day", "yyyy-MM-dd").alias("day"), "platform", "segment").agg(
        F.count("*").alias("n_pings"), F.count_distinct("event_id").alias("n_events"), F.min("ping_time").alias("first_ping"), F.max("ping_time").alias("last_ping"))


DAY_ACCUMULATE_SQL = WALK_SQL + f"""
select strftime(sts, '%Y-%m-%d') as day, platform, strftime(min(ts), '%H-%M-%S') || '__' || strftime(max(ts), '%H-%M-%S') as segment,
       count(*) as n_pings, count(distinct event_id) as n_events, min(ts) as first_ping, max(ts) as last_ping
from walk w join seg s using (platform, srn) where s.closed or s.size >= {P.min_pings} group by platform, srn, sts"""


# ---- event time --------------------------------------------------------------------------------------------------

#: Fixes arrive up to a day late and out of order; every 97th comes with the last slice.
NAV_DELAY_S = 86_400


def q_nav_stream_live(spark, sf_dir):
    nav = fx.nav(spark, sf_dir).select("platform", "event_id", "ts", "lat", "lon", "heading")
    late = F.col("event_id") % 97 == 5
    shuffled = _sliced(nav.where(~late), _us() + (F.col("event_id") * 7919 % NAV_DELAY_S) * 1_000_000)
    mark = nav.agg((F.max("ts") + F.expr("interval 30 days")).alias("ts")).select(
        F.lit(None).cast("string").alias("platform"), F.lit(None).cast(nav.schema["event_id"].dataType).alias("event_id"), "ts",
        *[F.lit(None).cast("double").alias(c) for c in ("lat", "lon", "heading")], F.lit(SLICES).alias("slice"))
    arrivals = shuffled.unionByName(nav.where(late).withColumn("slice", F.lit(SLICES - 1))).unionByName(mark)
    folder, checkpoint, out = scratch_path(spark, "landing"), scratch_path(spark, "stream"), scratch_path(spark, "nav")
    schema = arrivals.drop("slice").schema
    for i in live.land(arrivals, folder, SLICES + 1):
        if i in (1, SLICES):
            live.run_available(live.nav_poll_stream(live.arriving(spark, folder, schema), f"{NAV_DELAY_S} seconds"), checkpoint, out)
    return rounded(spark.read.parquet(out))


# a late fix counts only if its bucket ends after the watermark that the micro-batch before it had: of the slices before that one
NAV_STREAM_LIVE_SQL = with_views(["nav"], f"""
with a as (select *, event_id % 97 = 5 as late, epoch_us(ts) + (event_id * 7919 % {NAV_DELAY_S}) * 1000000 as us from nav),
r as (select min(us) as lo, max(us) as hi from a where not late),
s as (select a.*, least({SLICES - 1}, floor((us - lo) * {SLICES} / greatest(1, hi - lo))) as slice from a, r),
w as (select max(ts) - to_seconds({NAV_DELAY_S}) as wm from s where not late and slice < {SLICES - 2}),
k as (select s.* from s, w where not late or wm is null or time_bucket(interval '5 seconds', ts) + interval '5 seconds' > wm)
select platform, time_bucket(interval '5 seconds', ts) as bucket,
       arg_min(ts, (ts, event_id)) as ts, arg_min(event_id, (ts, event_id)) as event_id,
       round(arg_min(lat, (ts, event_id)), 6) as lat, round(arg_min(lon, (ts, event_id)), 6) as lon,
       round(arg_min(heading, (ts, event_id)), 6) as heading
from k group by all""")


def q_mvbs_live(spark, sf_dir):
    """Channels arrive up to 40 s apart, so cells are shared by micro-batches."""
    pings = fx.pings(spark, sf_dir).drop("angle_along", "angle_athwart")
    arrivals = _sliced(pings, _us("ping_time") + F.pmod(F.xxhash64("channel", "ping"), F.lit(40)) * 1_000_000)
    mark = pings.agg((F.max("ping_time") + F.expr("interval 1 day")).alias("ping_time")).select(
        *[F.col(f.name) if f.name == "ping_time" else (F.array(F.lit(0.0)) if f.name in ("sv", "echo_range", "depth") else F.lit(None)).cast(f.dataType).alias(f.name)
          for f in pings.schema], F.lit(SLICES).alias("slice"))
    folder, checkpoint, out = scratch_path(spark, "landing"), scratch_path(spark, "stream"), scratch_path(spark, "mvbs")
    for i in live.land(arrivals.unionByName(mark), folder, SLICES + 1):
        if i in (1, SLICES):
            stream = to_samples(live.arriving(spark, folder, pings.schema))
            live.run_available(live.mvbs_stream(stream, "60 seconds", "20m", "20s"), checkpoint, out)
    return rounded(spark.read.parquet(out))


MVBS_LIVE_SQL = with_views(["samples"], """
select platform, segment, channel, time_bucket(interval '20 seconds', ping_time) as ping_time, floor(echo_range / 20.0)::double * 20.0 as echo_range,
       round(10 * log10(avg(pow(10, sv / 10))), 6) as sv, count(sv) as n_samples
from samples where sv is not null and echo_range is not null group by all""")


#: Patches and batches arrive up to twelve hours apart from their times.
CONFIG_DELAY_S = 43_200


def q_config_as_of_live(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    batches = ev.select((F.col("user_id") % 6).alias("device"), "ts", "event_id").withColumn("key", F.lit("batch")).withColumn("raw_json", F.lit(None).cast("string"))
    patches = fx.config_patches(spark, sf_dir).withColumn("side", F.lit(0))
    both = patches.unionByName(batches.withColumn("side", F.lit(1)).select(*patches.columns))
    shuffled = _sliced(both, _us() + F.pmod(F.xxhash64("event_id", "side"), F.lit(CONFIG_DELAY_S)) * 1_000_000)
    mark = both.groupBy("device").agg(F.lit(None).cast("timestamp_ntz").alias("_")).select("device").crossJoin(F.broadcast(both.agg((F.max("ts") + F.expr("interval 30 days")).alias("ts"))))
    mark = mark.select(*[F.col(f.name) if f.name in ("device", "ts") else F.lit(0 if f.name == "side" else None).cast(f.dataType).alias(f.name) for f in both.schema],
                       F.lit(SLICES).alias("slice"))
    folder, checkpoint, out = scratch_path(spark, "landing"), scratch_path(spark, "stream"), scratch_path(spark, "configs")
    for i in live.land(shuffled.unionByName(mark), folder, SLICES + 1):
        if i in (1, SLICES):
            rows = live.arriving(spark, folder, both.schema)
            told = live.config_as_of_stream(rows.where("side = 1").select("device", "ts", "event_id"), rows.where("side = 0").drop("side"), f"{CONFIG_DELAY_S} seconds")
            live.run_available(told, checkpoint, out, rows=live.IN_ROWS)
    return spark.read.parquet(out).select("device", "ts", "event_id", *[n for n, _, _ in CONFIG_FIELDS])


# ---- files, messages -----------------------------------------------------------------------------------------------

def q_new_file_events_live(spark, sf_dir):
    """Files of odd orders appear half-way; half of the events of each slice name a file of the other kind."""
    o = read_table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    path = F.concat(F.lit("raw/f"), k.cast("string"), F.lit(".raw"))
    events = o.select(k.alias("event_id"), F.when(k % 9 == 0, "filedelete").otherwise("fileadd").alias("event"), path.alias("file_added_path"),
                      (F.expr("o_orderkey div 8") % SLICES).cast("int").alias("slice"))
    catalog, out = scratch_path(spark, "catalog"), scratch_path(spark, "events")
    files = o.where(k % 5 != 0).select(path.alias("path"), (k % 2).alias("late"))
    each = live.file_event_batches(lambda s: s.read.schema("path string").parquet(catalog),
                                   lambda df, epoch: df.withColumn("epoch", F.lit(epoch)).write.mode("overwrite").partitionBy("epoch").parquet(out))
    folder, checkpoint = scratch_path(spark, "landing"), scratch_path(spark, "stream")
    files.where("late = 0").select("path").write.parquet(catalog)
    for i in live.land(events, folder, SLICES):
        if i == SLICES // 2:
            files.where("late = 1").select("path").write.mode("append").parquet(catalog)
        if i % 2:
            live.run_available(live.arriving(spark, folder, events.drop("slice").schema), checkpoint, each=each)
    return spark.read.parquet(out).select("event_id", "event", "file_added_path", "status", "reason", F.col("epoch").cast("int").alias("epoch"))


# the first half of the slices is worked off before the odd files appear
NEW_FILE_EVENTS_LIVE_SQL = f"""
with e as (select o_orderkey as event_id, case when o_orderkey % 9 = 0 then 'filedelete' else 'fileadd' end as event,
  'raw/f' || o_orderkey || '.raw' as file_added_path, (o_orderkey // 8 % {SLICES})::int as epoch,
  o_orderkey % 5 <> 0 and (o_orderkey % 2 = 0 or (o_orderkey // 8 % {SLICES}) >= {SLICES // 2}) as known from orders)
select event_id, event, file_added_path, case when event <> 'fileadd' then 'skipped' when not known then 'error' else 'queued' end as status,
  case when event <> 'fileadd' then 'ignored event: ' || event when not known then 'file not found: ' || file_added_path end as reason, epoch from e"""


def q_ping_stream_live(spark, sf_dir):
    cal = channel_cal(fx.channel_cal_raw(spark, sf_dir))
    out = scratch_path(spark, "pings")
    _in_two_runs(spark, _sliced(fx.messages(spark, sf_dir), _us()), lambda s: ping_stream(s, cal), path=out)
    return spark.read.parquet(out).select("event_id", "platform", "channel_id", "ping_time", "frequency", _texts("samples").alias("samples"))


def q_sink_messages_live(spark, sf_dir):
    """Two outputs; every epoch is written twice, as after a crash between the sink and the checkpoint."""
    r = fx.file_results(spark, sf_dir).select("file_id", "source_file", "status", "n_pings", (F.col("file_id") % SLICES).cast("int").alias("slice"))
    path = scratch_path(spark, "messages")
    once = live.message_batches({"output1": None, "outputml": F.col("status") == "ok"}, path, ["file_id"])

    def twice(df, epoch):
        once(df, epoch)
        once(df, epoch)

    _in_two_runs(spark, r, lambda s: s, each=twice)
    back = spark.read.schema("output string, epoch bigint, message_id string, body string").json(path)
    return back.select("output", "epoch", "message_id", "body")


SINK_MESSAGES_LIVE_SQL = with_views(["file_results"], f"""
with m as (select o.output, (file_id % {SLICES})::bigint as epoch, json_object('file_id', file_id)::varchar as own,
  json_object('file_id', file_id, 'source_file', source_file, 'status', status, 'n_pings', n_pings)::varchar as body
  from file_results, (values ('output1'), ('outputml')) o(output) where output = 'output1' or status = 'ok')
select output, epoch, sha256(output || '|' || epoch || '|' || own) as message_id, body from m""")


REGISTRY = {
    "segment_pipeline": (q_segment_pipeline, SEGMENT_PIPELINE_SQL),
    "day_accumulate": (q_day_accumulate, DAY_ACCUMULATE_SQL),
    "nav_stream_live": (q_nav_stream_live, NAV_STREAM_LIVE_SQL),
    "mvbs_live": (q_mvbs_live, MVBS_LIVE_SQL),
    "config_as_of_live": (q_config_as_of_live, CONFIG_AS_OF_SQL),
    "new_file_events_live": (q_new_file_events_live, NEW_FILE_EVENTS_LIVE_SQL),
    "ping_stream_live": (q_ping_stream_live, PING_STREAM_SQL),
    "sink_messages_live": (q_sink_messages_live, SINK_MESSAGES_LIVE_SQL),
}
