"""Structured Streaming forms: stateful segmentation, and the per-micro-batch segment pipeline.

The open pings of a platform are the state (at most ``longest`` of them, with their payload; platforms share one of
``GROUPS`` groups): they leave it together when the trigger closes their segment, or by a timeout when the stream falls silent. So a sink only ever sees complete segments,
however the pings are spread over micro-batches, and a restart goes on from the checkpointed state.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from acoustispark.functions import scalars as fn
from acoustispark.sources.sinks import sink_day_append
from acoustispark.streaming.trigger import TriggerParams

OUT_SCHEMA = ("platform string, ts timestamp_ntz, event_id bigint, segment_start timestamp_ntz, "
              "n_segment_pings bigint, payload string")
STATE_SCHEMA = "platform array<string>, n array<int>, t array<bigint>, seq array<bigint>, payload array<string>"
#: Groups that platforms are dealt to by their hash: calling Python for a group costs far more than a platform's fold. A
#: checkpoint holds the state of so many groups, so the number must not change under it.
GROUPS = 1024
#: Pings of closed segments that a platform's task hands over at once.
OUT_ROWS = 4096
_COLUMNS = ["platform", "ts", "event_id", "segment_start", "n_segment_pings", "payload"]


def _end(t: np.ndarray, i: int, p: TriggerParams) -> int:
    """Position of the ping that closes the segment starting at ``i``, or -1: the first one from the minimum count on
    where the count or the time since the first ping is reached."""
    low = i + p.min_pings - 1
    if low >= len(t):
        return -1
    late = np.flatnonzero(t[low:] - t[i] >= p.buffer_seconds * 1e6)
    by_time = low + int(late[0]) if len(late) else len(t)
    end = min(i + p.longest - 1, by_time)
    return end if end < len(t) else -1


def segment_stream(pings: DataFrame, p: TriggerParams = TriggerParams(), key: str = "platform", ts: str = "ts",
                   seq: str = "event_id", payload: list[str] | None = None, flush_after: str | None = None, ends: str | None = None) -> DataFrame:
    """Streaming dual trigger. Emits the pings of a segment when it closes, each with the segment's start and size and
    the named ``payload`` columns as JSON text. Within a micro-batch pings are taken in (time, seq) order; a ping older than
    the open segment joins it [def]. With ``flush_after`` (a duration such as ``10 minutes``), a platform that sends nothing
    for so long is flushed: its open pings are emitted if there are at least ``min_pings``, else dropped. ``ends`` names a
    boolean column: a row where it is true is no ping but the end of the platform's session, which flushes it the same way."""
    wait = int(pd.Timedelta(flush_after).total_seconds() * 1000) if flush_after else None

    def rows(closed: list) -> pd.DataFrame:
        """Segments (platform, times, numbers, payloads) as one frame: a frame a segment costs more than its pings do."""
        sizes = [len(x[1]) for x in closed]
        return pd.DataFrame({"platform": np.repeat(np.array([x[0] for x in closed], dtype=object), sizes),
                             "ts": np.concatenate([x[1] for x in closed]).view("datetime64[us]"), "event_id": np.concatenate([x[2] for x in closed]),
                             "segment_start": np.repeat(np.array([x[1][0] for x in closed], dtype=np.int64), sizes).view("datetime64[us]"),
                             "n_segment_pings": np.repeat(sizes, sizes), "payload": [y for x in closed for y in x[3]]}, columns=_COLUMNS)

    def fold(k, pdfs: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        names, sizes, t, s, load = state.get if state.exists else ([], [], [], [], [])
        t, s, at = np.array(t, dtype=np.int64), np.array(s, dtype=np.int64), np.cumsum([0, *sizes]).tolist()
        held = {name: (t[a:b], s[a:b], load[a:b]) for name, a, b in zip(names, at, at[1:])}
        if state.hasTimedOut:
            state.remove()
            flushed = [(name, *x) for name, x in held.items() if len(x[0]) >= p.min_pings]
            if flushed:
                yield rows(flushed)
            return
        parts = list(pdfs)
        joined = lambda c: parts[0][c].to_numpy() if len(parts) == 1 else np.concatenate([x[c].to_numpy() for x in parts])
        code, names = pd.factorize(joined("platform"), use_na_sentinel=False)
        when, ids, is_end, text = joined("ts").astype("datetime64[us]"), joined("event_id"), joined("ends").astype(bool), joined("payload")
        order = np.lexsort((ids, is_end, when, code))
        us, ids, is_end, text = when[order].astype(np.int64), ids[order], is_end[order], text[order]
        edges = np.searchsorted(code[order], np.arange(len(names) + 1)).tolist()
        closed, n = [], 0
        for name, at, to in zip(names, edges, edges[1:]):
            name = name if isinstance(name, str) else None
            t, s, load = held.pop(name, (us[:0], us[:0], []))
            for stop in [*(at + np.flatnonzero(is_end[at:to])).tolist(), to]:
                last = stop < to
                t, s, load = np.concatenate([t, us[at:stop]]), np.concatenate([s, ids[at:stop].astype(np.int64)]), load + text[at:stop].tolist()
                at, i = stop + 1, 0
                while i < len(t) and (end := _end(t, i, p)) >= 0:
                    closed.append((name, t[i:end + 1], s[i:end + 1], load[i:end + 1]))
                    n += end + 1 - i
                    i = end + 1
                    if n >= OUT_ROWS:
                        yield rows(closed)
                        closed, n = [], 0
                if last and len(t) - i >= max(1, p.min_pings):
                    closed.append((name, t[i:], s[i:], load[i:]))
                t, s, load = (t[:0], s[:0], []) if last else (t[i:], s[i:], load[i:])
            if len(t):
                held[name] = t, s, load
        lists = list(held.values())
        state.update((list(held), [len(x[0]) for x in lists], [y for x in lists for y in x[0].tolist()], [y for x in lists for y in x[1].tolist()],
                      [y for x in lists for y in x[2]]))
        if wait is not None:
            state.setTimeoutDuration(wait)
        if closed:
            yield rows(closed)

    carried = F.to_json(F.struct(*payload)) if payload else F.lit(None).cast("string")
    src = pings.select(F.col(key).cast("string").alias("platform"), F.col(ts).alias("ts"), F.col(seq).cast("long").alias("event_id"),
                       carried.alias("payload"), F.coalesce(F.col(ends), F.lit(False)).alias("ends") if ends else F.lit(False).alias("ends"))
    timeout = GroupStateTimeout.ProcessingTimeTimeout if flush_after else GroupStateTimeout.NoTimeout
    # silence is a platform's own, so with a timeout each has a group of its own
    group = F.col("platform") if flush_after else F.pmod(F.xxhash64("platform"), F.lit(GROUPS))
    return src.withColumn("group", group).groupBy("group").applyInPandasWithState(fold, OUT_SCHEMA, STATE_SCHEMA, "append", timeout)


def named_segments(closed: DataFrame) -> DataFrame:
    """Closed pings with ``ping_time`` and their segment's name (of its first and last ping)."""
    w = Window.partitionBy("platform", "segment_start")
    return closed.withColumn("segment", fn.segment_name("segment_start", F.max("ts").over(w))).withColumnRenamed("ts", "ping_time")


def day_accumulate(closed: DataFrame, root: str) -> None:
    """Add complete segments to the daily store (by day of their first ping, platform and name)."""
    sink_day_append(named_segments(closed), root)


def segment_pipeline(labelled: DataFrame, process: Callable[[DataFrame, int], None], checkpoint: str,
                     trigger: dict | None = None):
    """Run ``process(batch_df, epoch_id)`` on every micro-batch of closed pings (``foreachBatch``): the batch frame holds
    whole segments only, grouped downstream by segment - no per-segment driver loop. A replayed epoch holds the same
    segments, so a writer with dynamic partition overwrite is idempotent."""
    w = labelled.writeStream.foreachBatch(process).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()
