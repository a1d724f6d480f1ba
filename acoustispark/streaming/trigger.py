"""Dual-trigger segmentation of a ping stream.

Rule (per platform, pings in (time, seq) order): a segment that started at ping ``s`` closes at the first ping
``j`` where ``(count >= buffer_pings or t_j - t_s >= buffer_seconds) and count >= min_pings``
(``count = j - s + 1``); the next ping starts a new segment. At the end of the input the open segment is kept
iff it holds at least ``min_pings`` pings (flush), otherwise dropped. Pings are counted as accepted messages [def].

Batch form (``segment_trigger``), exact and without any per-platform group:
  1. global ping numbers per platform from per-(platform, day) counts (prefix sums over the small day table);
  2. the numbered pings are cut into chunks of ``chunk_rows``; every chunk also receives the ``longest - 1``
     pings on each side of it. A segment holds at most ``longest = max(buffer_pings, min_pings)`` pings, so the segment
     open at the chunk's first ping started at one of ``longest`` positions: each chunk computes, for every such entry, which
     segment is open at the next chunk's first ping (a transition map, one array a chunk);
  3. the maps are composed along each platform by joins of chunk-level rows that double their reach (no platform is
     gathered anywhere);
  4. every chunk labels its own pings from its now known entry.
Steps 2 and 4 walk sorted Arrow batches and work on many chunks at once; a task holds one batch and one chunk.
Streaming form (``segment_stream``): the same fold with O(1) state per platform in ``applyInPandasWithState``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window, functions as F, types as T

from acoustispark.operators.util import spread_groups, staged


@dataclass(frozen=True)
class TriggerParams:
    # realtime_buffer_pings / realtime_buffer_seconds / realtime_min_pings of the configuration
    buffer_pings: int = 100
    buffer_seconds: float = 1800.0
    min_pings: int = 50

    @property
    def longest(self) -> int:
        """Most pings of a segment: the count closes it when both minimum and buffer are reached."""
        return max(self.buffer_pings, self.min_pings)


#: Pings that a task works on at once; a longer chunk is taken whole.
BATCH_ROWS = 1 << 16


def _next_start(t_us: np.ndarray, ends: np.ndarray, p: TriggerParams) -> np.ndarray:
    """For every position i of chunks laid end to end (``ends``: the position after the last one of i's chunk): the position
    after the end of a segment starting at i, or -1 when that segment does not close inside its chunk."""
    i = np.arange(len(t_us))
    # the first ping late enough is looked for between the minimum and the longest count only, by halving
    lo, hi = i + max(p.min_pings, 1) - 1, i + p.longest - 1
    wait, last = int(round(p.buffer_seconds * 1e6)), ends - 1
    for _ in range(int(p.longest).bit_length()):
        mid = (lo + hi) // 2
        late = (mid > last) | (t_us[np.clip(mid, 0, last)] - t_us >= wait)
        open_ = lo < hi
        lo, hi = np.where(open_ & ~late, mid + 1, lo), np.where(open_ & late, mid, hi)
    return np.where(lo < ends, lo + 1, -1)


def _whole_chunks(pdfs: Iterator[pd.DataFrame], key: str) -> Iterator[pd.DataFrame]:
    """Frames sorted by chunk, cut anew so that no chunk is in two of them."""
    held, n, enough = [], 0, BATCH_ROWS
    for pdf in pdfs:
        held.append(pdf)
        n += len(pdf)
        if n >= enough:
            both = pd.concat(held, ignore_index=True)
            cut = int(_first_rows(both, key)[-1])
            if cut:
                yield both.iloc[:cut].reset_index(drop=True)
            held = [both.iloc[cut:]]
            n = len(both) - cut
            enough = max(BATCH_ROWS, 2 * n)
    if n:
        yield pd.concat(held, ignore_index=True)


def _first_rows(pdf: pd.DataFrame, key: str) -> np.ndarray:
    """Where each chunk begins in a frame sorted by chunk: at another chunk number, or another key."""
    k, c = pdf[key].to_numpy(), pdf["_chunk"].to_numpy()
    return np.flatnonzero(np.concatenate([[True], (c[1:] != c[:-1]) | (k[1:] != k[:-1])]))


def _number(pings: DataFrame, key: str, ts: str, seq: str) -> DataFrame:
    """Global 0-based position per key, computed from per-(key, day) counts: windows never span more than a day."""
    d = pings.withColumn("_day", F.to_date(ts))
    counts = d.groupBy(key, "_day").agg(F.count(F.lit(1)).alias("_cnt"))
    wd = Window.partitionBy(key).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(key, "_day", F.coalesce(F.sum("_cnt").over(wd), F.lit(0)).alias("_off"),
                            F.sum("_cnt").over(Window.partitionBy(key)).alias("_n"))
    w = Window.partitionBy(key, "_day").orderBy(ts, seq)
    return (d.withColumn("_r", F.row_number().over(w) - 1).join(offsets, [key, "_day"])
            .withColumn("rn", F.col("_off") + F.col("_r")).drop("_r", "_off", "_day"))


def _with_halo(numbered: DataFrame, key: str, chunk_rows: int, halo: int) -> DataFrame:
    """Every ping in its own chunk (``_own``) plus copies into the neighbouring chunk(s) it is within ``halo`` of."""
    c = F.floor(F.col("rn") / F.lit(chunk_rows))
    off = F.col("rn") - c * F.lit(chunk_rows)
    targets = F.array_compact(F.array(
        c, F.when(off >= F.lit(chunk_rows - halo), c + 1), F.when(off < F.lit(halo), c - 1)))
    return numbered.select("*", F.explode(targets).alias("_chunk")).where(F.col("_chunk") >= 0) \
        .withColumn("_own", F.col("_chunk") == c)


def _entries(tmaps: DataFrame, key: str, halo: int) -> DataFrame:
    """(key, _chunk, _entry): where the segment open at every chunk's first ping starts, following the transition maps
    from chunk 0; as its distance from the first place it can have, ``halo`` pings before the chunk.

    Maps that jump 2^k chunks come from joining a map with itself; the places reached from the start at all distances
    come from applying the jumps from the longest to the shortest. Every step is a join of chunk-level rows, written to
    the scratch folder so that plans do not grow; none is broadcast, as maps are small on disk and large in memory.
    """
    tmaps = staged(tmaps, "chunk-maps")
    last = tmaps.agg(F.max("_chunk").alias("m")).first()["m"]
    reached = tmaps.where("_chunk = 0").select(key, "_chunk", F.lit(halo).alias("_entry"))
    jumps, span = [tmaps.select(key, "_chunk", (F.col("_chunk") + 1).alias("to"), "exits")], 1
    while 2 * span <= (last or 0):
        j = jumps[-1]
        on = j.join(j.select(key, F.col("_chunk").alias("to"), F.col("to").alias("to2"), F.col("exits").alias("exits2")).hint("merge"), [key, "to"])
        jumps.append(staged(on.select(key, "_chunk", F.col("to2").alias("to"), F.transform("exits", lambda x: F.get("exits2", x)).alias("exits")), "chunk-maps"))
        span *= 2
    for j in reversed(jumps):
        hop = reached.join(j.hint("merge"), [key, "_chunk"]).select(key, F.col("to").alias("_chunk"), F.get("exits", F.col("_entry")).alias("_entry"))
        reached = staged(reached.unionByName(hop), "chunk-entries")
    return reached


def segment_trigger(pings: DataFrame, p: TriggerParams = TriggerParams(), key: str = "platform", ts: str = "ts",
                    seq: str = "event_id", chunk_rows: int = 200_000) -> DataFrame:
    """Label every ping with its segment (``segment_start`` = time of the segment's first ping,
    ``segment_rn`` = its position) and ``n_segment_pings``; pings of a dropped final segment are removed."""
    if chunk_rows < p.longest:
        raise ValueError("chunk_rows must be at least the longest segment")
    halo = p.longest - 1
    numbered = staged(_number(pings.select(key, ts, seq), key, ts, seq), "numbered")  # maps and labels both read it
    parts = _with_halo(numbered, key, chunk_rows, halo).withColumn("_t", F.unix_micros(F.col(ts).cast("timestamp")))
    key_type, seq_type = pings.schema[key].dataType, pings.schema[seq].dataType

    def transitions(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _whole_chunks(pdfs, key):
            first = _first_rows(pdf, key)
            sizes = np.diff(first, append=len(pdf))
            rn, hi = pdf["rn"].to_numpy(), (pdf["_chunk"].to_numpy() + 1) * chunk_rows
            nxt = _next_start(pdf["_t"].to_numpy(), np.repeat(first + sizes, sizes), p)
            i = np.arange(len(pdf))
            follow = rn + (nxt - i)  # the ping number of the next segment's start
            # a segment that does not close before ``hi`` is the one open there; every start jumps on to that one
            at = np.where((nxt < 0) | (follow >= hi), i, nxt)
            while (at[at] != at).any():
                at = at[at]
            exits = np.where((nxt[at] >= 0) & (follow[at] == hi), hi, rn[at]) - (hi - halo)
            # entries are the halo before the chunk and its first ping; chunk 0 has ping 0 only (pings without a time are
            # counted but not there: a platform that has some has no ping 0, and no segments)
            chunk = pdf["_chunk"].to_numpy()
            first = first[(chunk[first] > 0) | (rn[first] == 0)]
            maps = [exits[f:f + halo + 1] if c else np.full(halo + 1, exits[f]) for f, c in zip(first.tolist(), chunk[first].tolist())]
            if maps:
                yield pd.DataFrame({key: pdf[key].to_numpy()[first], "_chunk": chunk[first], "exits": maps})

    tmap_schema = T.StructType([T.StructField(key, key_type), T.StructField("_chunk", T.LongType()),
                                T.StructField("exits", T.ArrayType(T.IntegerType()))])
    # a map leads into the next chunk, so a platform's last chunk has none; its first one is entered at its first ping
    leading = parts.where((F.col("_chunk") + 1) * chunk_rows < F.col("_n")).select(key, "rn", "_t", "_chunk")
    tmaps = spread_groups(leading, key, "_chunk").sortWithinPartitions(key, "_chunk", "rn").mapInPandas(transitions, tmap_schema)
    entered = _entries(tmaps, key, halo).where("_chunk > 0")
    start = F.col("_chunk") * chunk_rows - halo + F.col("_entry")
    placed = parts.join(entered, [key, "_chunk"], "left").withColumn("_entry", F.when(F.col("_chunk") == 0, F.lit(0).cast("long")).otherwise(start))
    placed = placed.where(F.col("_entry").isNotNull())

    def label(pdfs: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in _whole_chunks(pdfs, key):
            first = _first_rows(pdf, key)
            rows = np.diff(first, append=len(pdf))
            rn, n_total = pdf["rn"].to_numpy(), pdf["_n"].to_numpy()
            nxt = _next_start(pdf["_t"].to_numpy(), np.repeat(first + rows, rows), p).tolist()
            starts, lens = [], []
            for base, to, i in zip(first.tolist(), (first + rows).tolist(), (first + pdf["_entry"].to_numpy()[first] - rn[first]).tolist()):
                while base <= i < to:
                    j = nxt[i]
                    if j < 0:               # open at the end of the input: flushed iff long enough
                        if n_total[i] - rn[i] >= p.min_pings:
                            starts.append(i)
                            lens.append(int(n_total[i] - rn[i]))
                        break
                    starts.append(i)        # closes inside the chunk and its halo
                    lens.append(j - i)
                    i = j
            begin, size, i = np.array(starts, dtype=np.int64), np.array(lens, dtype=np.int64), np.arange(len(pdf))
            seg = np.searchsorted(begin, i, side="right") - 1
            sel = np.flatnonzero((seg >= 0) & pdf["_own"].to_numpy())
            at = begin[seg[sel]] if len(begin) else sel
            kept = (sel < at + size[seg[sel]]) & (at >= np.repeat(first, rows)[sel]) if len(begin) else sel < 0
            sel, at = sel[kept], at[kept]
            out = pdf.loc[sel, [key, ts, seq, "rn"]].copy()
            out["segment_rn"] = rn[at]
            out["segment_start"] = pdf[ts].to_numpy()[at]
            out["n_segment_pings"] = size[seg[sel]] if len(sel) else at
            yield out

    label_schema = T.StructType([
        T.StructField(key, key_type), T.StructField(ts, T.TimestampNTZType()), T.StructField(seq, seq_type), T.StructField("rn", T.LongType()),
        T.StructField("segment_rn", T.LongType()), T.StructField("segment_start", T.TimestampNTZType()), T.StructField("n_segment_pings", T.LongType())])
    return spread_groups(placed.select(key, ts, seq, "rn", "_t", "_chunk", "_own", "_entry", "_n"), key, "_chunk") \
        .sortWithinPartitions(key, "_chunk", "rn").mapInPandas(label, label_schema)
