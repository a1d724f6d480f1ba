"""Registered queries: dual-trigger segmentation (batch form) and the end-of-stream flush."""

from __future__ import annotations

from pyspark.sql import functions as F

from acoustispark.sources.tables import read_table
from acoustispark.streaming.trigger import TriggerParams, segment_trigger

# a trigger that fits the event platforms (about 67 pings each at sf0.01)
P = TriggerParams(buffer_pings=20, buffer_seconds=259200.0, min_pings=5)


def _pings(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events")
    return ev.select(F.concat(F.lit("u"), F.col("user_id").cast("string")).alias("platform"), "ts", "event_id")


def _trigger(spark, sf_dir):
    return segment_trigger(_pings(spark, sf_dir), P)


def q_segment_trigger(spark, sf_dir):
    return _trigger(spark, sf_dir).select("platform", "event_id", "segment_start", "n_segment_pings")


def q_segment_trigger_chunks(spark, sf_dir):
    """The same with chunks not much longer than a segment, so that platforms span several and their maps are composed."""
    return segment_trigger(_pings(spark, sf_dir), P, chunk_rows=P.longest + 8).select("platform", "event_id", "segment_start", "n_segment_pings")


WALK_SQL = f"""
with recursive p as (
  select 'u' || user_id::varchar as platform, ts, event_id,
         row_number() over (partition by user_id order by ts, event_id) as rn from events),
walk as (
  select platform, rn, ts, event_id, rn as srn, ts as sts, 1 as cnt, false as closed from p where rn = 1
  union all
  select platform, rn, ts, event_id, srn, sts, cnt,
         (cnt >= {P.buffer_pings} or epoch_us(ts) - epoch_us(sts) >= {int(P.buffer_seconds * 1e6)}) and cnt >= {P.min_pings}
  from (select p.platform, p.rn, p.ts, p.event_id,
               case when w.closed then p.rn else w.srn end as srn, case when w.closed then p.ts else w.sts end as sts,
               case when w.closed then 1 else w.cnt + 1 end as cnt
        from walk w join p on p.platform = w.platform and p.rn = w.rn + 1)),
seg as (select platform, srn, max(cnt) as size, bool_or(closed) as closed from walk group by all)"""

SEGMENT_TRIGGER_SQL = WALK_SQL + f"""
select w.platform, w.event_id, w.sts as segment_start, s.size as n_segment_pings
from walk w join seg s using (platform, srn) where s.closed or s.size >= {P.min_pings}"""


def q_segment_flush(spark, sf_dir):
    last = _trigger(spark, sf_dir).groupBy("platform").agg(F.count(F.lit(1)).alias("kept"))
    total = _pings(spark, sf_dir).groupBy("platform").agg(F.count(F.lit(1)).alias("n_pings"))
    return total.join(last, "platform", "left").select(
        "platform", "n_pings", F.coalesce("kept", F.lit(0)).alias("kept"),
        (F.col("n_pings") - F.coalesce("kept", F.lit(0))).alias("dropped_at_end"))


SEGMENT_FLUSH_SQL = WALK_SQL + f""",
kept as (select platform, count(*) as kept from walk w join seg s using (platform, srn)
         where s.closed or s.size >= {P.min_pings} group by all),
total as (select platform, count(*) as n_pings from p group by all)
select platform, n_pings, coalesce(kept, 0) as kept, n_pings - coalesce(kept, 0) as dropped_at_end
from total left join kept using (platform)"""


REGISTRY = {
    "segment_trigger": (q_segment_trigger, SEGMENT_TRIGGER_SQL),
    "segment_trigger_chunks": (q_segment_trigger_chunks, SEGMENT_TRIGGER_SQL),
    "segment_flush": (q_segment_flush, SEGMENT_FLUSH_SQL),
}
