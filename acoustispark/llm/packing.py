"""Packing by minimum bin slack: a bitset subset-sum picks the multiset of remaining lengths that fills a window best.

Documents become pieces (full windows and one rest) in the tasks that tokenise them. Only the histogram of piece
lengths, at most ``window`` x salts numbers, reaches the driver; there every pattern of lengths is found once and used
as often as its counts allow. Pieces are ranked inside their length by Spark and look their place up from the rank.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acoustispark.llm.bpe import encoder
from acoustispark.llm.common import dense_rank_within, shuffle_width, staged

PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def pieces(docs: DataFrame, path: str, window: int, doc_id: str = "doc_id", text: str = "text",
           payload: bool = False) -> DataFrame:
    """Token ids of every document (then id 0) cut at multiples of ``window``; ``payload`` adds the ids themselves."""
    names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"] + (["ids"] if payload else [])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(path).encode
        for b in batches:
            keys, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            for lo in range(0, len(texts), 256):
                rows: list[list] = [[] for _ in names]
                for k, ids in zip(keys[lo:lo + 256], encode(texts[lo:lo + 256])):
                    raw = ids.astype("<u4").tobytes() + b"\0\0\0\0"
                    n = len(raw) // 4
                    for s in range(0, n, window):
                        part = raw[4 * s:4 * (s + window)]
                        for r, v in zip(rows, (k, s, len(part) // 4, zlib.crc32(part), n, part)):
                            r.append(v)
                arrays = [pa.array(r, type=pa.int64()) for r in rows[:5]] + [pa.array(r, type=pa.binary()) for r in rows[5:]]
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select(F.col(doc_id).cast("long"), text).mapInArrow(run, PIECES + (", ids binary" if payload else ""))


def best_fill(counts: np.ndarray, lengths: list[int], room: int) -> dict[int, int]:
    """Lengths (with how often) whose sum comes closest to ``room`` from below; each at most ``counts`` times.

    ``reach`` is a bitset: bit s is set when some multiset sums to s. Its states before each length are kept, and
    the counts are read back from them.
    """
    full = (1 << (room + 1)) - 1
    reach, seen = 1, []
    for n in lengths:
        k = min(int(counts[n]), room // n)
        if not k:
            continue
        seen.append((n, k, reach))
        step = 1
        while k:  # binary splitting of the count
            take = min(step, k)
            reach |= reach << (take * n) & full
            k -= take
            step *= 2
        if reach >> room & 1:
            break
    total, used = reach.bit_length() - 1, {}
    for n, k, before in reversed(seen):
        j = next(j for j in range(k + 1) if total >= j * n and before >> (total - j * n) & 1)
        if j:
            used[n] = j
            total -= j * n
    return used


def plan(histogram: np.ndarray, window: int) -> list[tuple[dict[int, int], int]]:
    """(lengths of one window, number of such windows) until every piece is placed."""
    left, out = histogram.copy(), []
    while left.any():
        lengths = [int(n) for n in np.flatnonzero(left)[::-1]]
        top = lengths[0]
        left[top] -= 1
        used = best_fill(left, lengths, window - top) if top < window else {}
        left[top] += 1
        used[top] = used.get(top, 0) + 1
        times = min(int(left[n]) // k for n, k in used.items())
        for n, k in used.items():
            left[n] -= k * times
        out.append((used, times))
    return out


def pack(docs: DataFrame, path: str, window: int = 1024, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset of every piece.

    A null or empty text is the single id 0. Repeated rows are packed as often as they occur; other columns are not
    read; a null id stays null; an empty table gives no pieces. Ties are broken by doc_id, start and checksum.
    """
    spark = docs.sparkSession
    cut = staged(pieces(docs, path, window, doc_id, text), "pieces")
    salts = max(64, shuffle_width(spark))
    ranked, counts = dense_rank_within(cut, "length", ["doc_id", "start", "ids_crc32", "doc_tokens"], salts)
    table = np.zeros((window + 1, salts), dtype=np.int64)
    for r in counts:
        table[r["length"], r["salt"]] = r["count"]
    before = np.cumsum(table, axis=1) - table
    starts: dict[int, list] = {}
    used_so_far, sequence = np.zeros(window + 1, dtype=np.int64), 0
    for used, times in plan(table.sum(axis=1), window):
        at = 0
        for n, k in sorted(used.items(), reverse=True):
            starts.setdefault(n, []).append((int(used_so_far[n]), k, sequence, at))
            used_so_far[n] += k * times
            at += n * k
        sequence += times
    places = {n: np.array(v, dtype=np.int64) for n, v in starts.items()}

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, salt, rank = (b.column(i).to_numpy(zero_copy_only=False) for i in (2, 5, 6))
            rank = rank + before[length, salt]
            seq, off = np.empty(len(rank), dtype=np.int64), np.empty(len(rank), dtype=np.int64)
            for n in np.unique(length):
                here, p = np.flatnonzero(length == n), places[int(n)]
                row = p[np.searchsorted(p[:, 0], rank[here], side="right") - 1]
                nth, slot = np.divmod(rank[here] - row[:, 0], row[:, 1])
                seq[here], off[here] = row[:, 2] + nth, row[:, 3] + slot * n
            yield pa.RecordBatch.from_arrays(b.columns[:5] + [pa.array(seq), pa.array(off)],
                                             names=b.schema.names[:5] + ["sequence_id", "offset"])

    return ranked.mapInArrow(place, PIECES + ", sequence_id long, offset long")
