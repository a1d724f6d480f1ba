"""Training-order materialisation: a keyed Feistel permutation with cycle-walking gives every sequence a global slot,
and range partitions of the slots write fixed-stride shards that are read sequentially and resumed at any slot."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acoustispark.llm.common import freed_shuffles, shuffle_width, staged
from acoustispark.llm.packing import PIECES, pieces

ROUNDS = 6
#: Text bytes of a task that numbers sequences, on average.
TASK_BYTES = 128 << 20
SHARD = ("shard_id long, first_slot long, n_sequences int, stride int, payload binary, doc_ids array<long>, "
         "starts array<long>, lengths array<int>")


def _mix(x: np.ndarray, key: int) -> np.ndarray:
    """64-bit finaliser (xor-shift-multiply) as the round function."""
    x = (x ^ np.uint64(key & 0xFFFFFFFFFFFFFFFF)) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _feistel(x: np.ndarray, half: int, key: int, back: bool) -> np.ndarray:
    mask, h = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> h, x & mask
    for r in (range(ROUNDS - 1, -1, -1) if back else range(ROUNDS)):
        k = (key * 0x9E3779B97F4A7C15 + r * 0xD1342543DE82EF95) & 0xFFFFFFFFFFFFFFFF
        if back:
            left, right = right ^ (_mix(left, k) & mask), left
        else:
            left, right = right, left ^ (_mix(right, k) & mask)
    return left << h | right


def permute(index: np.ndarray, n: int, key: int, back: bool = False) -> np.ndarray:
    """The permutation of 0..n-1 (``back``: its inverse): walk the cycle of the power-of-four domain until below n."""
    half = max(1, (max(n - 1, 1).bit_length() + 1) // 2)
    out = np.asarray(index).astype(np.uint64)
    with np.errstate(over="ignore"):
        out = _feistel(out, half, key, back)
        while (high := out >= np.uint64(n)).any():
            out[high] = _feistel(out[high], half, key, back)
    return out.astype(np.int64)


def sequences(docs: DataFrame, path: str, seq_len: int, doc_id: str, text: str) -> DataFrame:
    """The pieces with their ids as 16-bit payload, numbered by (doc_id, hash of the text, start): documents are ranged by
    id and hash before they are tokenised, so the numbers follow from the rows and not from how the input was split.
    Only rows equal in id and text are told apart by their place in the input, which changes nothing as their sequences
    are equal; it lets many of them spread over tasks. Written once, so nothing is numbered twice."""
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    size = rows.agg(F.sum(F.octet_length("text")).alias("b")).first()["b"] or 0
    by = ["doc_id", "mark", "copy"]
    rows = rows.withColumn("mark", F.xxhash64("text")).withColumn("copy", F.monotonically_increasing_id())
    ranged = rows.repartitionByRange(max(shuffle_width(docs.sparkSession), size // TASK_BYTES), *by).sortWithinPartitions(*by)
    cut = pieces(ranged, path, seq_len, "doc_id", "text", payload=True)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for b in batches:
            small = [np.frombuffer(x, "<u4").astype("<u2").tobytes() for x in b.column(5).to_pylist()]
            nth = np.arange(at, at + b.num_rows)
            at += b.num_rows
            yield pa.RecordBatch.from_arrays(
                b.columns[:5] + [pa.array(small, pa.binary()), pa.array(np.full(b.num_rows, part, dtype=np.int32)), pa.array(nth)],
                names=b.schema.names[:5] + ["ids", "part", "nth"])

    return staged(cut.mapInArrow(number, PIECES + ", ids binary, part int, nth long"), "sequences")


def shards(docs: DataFrame, path: str, key: int = 20260, seq_len: int = 1024, shard_sequences: int = 256,
           doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per shard: ``shard_sequences`` sequences in slot order, each ``stride`` bytes (16-bit ids, zero padded),
    with the doc ids, starts and lengths of its sequences. Vocabularies must have at most 65,536 ids.

    Null and empty texts are one sequence (the end id alone); repeated rows get a slot each; other columns are not
    read; an empty table has no shards. Slot = permutation of the
    sequence's number in the order of (doc_id, hash of the text, start).
    """
    spark = docs.sparkSession
    seqs = sequences(docs, path, seq_len, doc_id, text)
    sizes = {r["part"]: r["n"] for r in seqs.groupBy("part").agg(F.count("*").alias("n")).collect()}
    base, total = {}, 0
    for p in sorted(sizes):
        base[p], total = total, total + sizes[p]
    stride = 2 * seq_len

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            first = np.array([base[p] for p in b.column("part").to_pylist()], dtype=np.int64)
            s = permute(first + b.column("nth").to_numpy(), total, key)
            yield pa.RecordBatch.from_arrays(b.columns[:4] + [pa.array(s), pa.array(s // shard_sequences)],
                                             names=["doc_id", "start", "length", "ids", "slot", "shard_id"])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def row(sh: int, held: list) -> pa.RecordBatch:
            payload = b"".join(x[3].ljust(stride, b"\0") for x in held)
            return pa.RecordBatch.from_arrays(
                [pa.array([v], t) for v, t in ((sh, pa.int64()), (held[0][4], pa.int64()), (len(held), pa.int32()),
                 (stride, pa.int32()), (payload, pa.binary()), ([x[0] for x in held], pa.list_(pa.int64())),
                 ([x[1] for x in held], pa.list_(pa.int64())), ([x[2] for x in held], pa.list_(pa.int32())))],
                names=["shard_id", "first_slot", "n_sequences", "stride", "payload", "doc_ids", "starts", "lengths"])
        cur, held = None, []
        for b in batches:
            for x in zip(*(c.to_pylist() for c in b.columns)):
                if held and x[5] != cur:
                    yield row(cur, held)
                    held = []
                cur = x[5]
                held.append(x)
        if held:
            yield row(cur, held)

    placed = seqs.select("doc_id", "start", "length", "ids", "part", "nth").mapInArrow(
        slot, "doc_id long, start long, length long, ids binary, slot long, shard_id long")
    ranged = placed.repartitionByRange(shuffle_width(spark), "shard_id").sortWithinPartitions("slot")
    return ranged.mapInArrow(build, SHARD)


def write_shards(docs: DataFrame, path: str, out: str, **options) -> DataFrame:
    """Write the shards as Parquet in slot order under ``out`` and return the written table."""
    made = shards(docs, path, **options)
    with freed_shuffles(docs.sparkSession):
        made.write.option("compression", "zstd").parquet(out)
    return docs.sparkSession.read.schema(made.schema).parquet(out)


def read_slots(written: DataFrame, first: int, last: int) -> DataFrame:
    """slot, doc_id, start, length, ids (unpadded payload) of the slots ``first`` <= slot < ``last``, in ascending order: a
    reader resumes anywhere, as shard and byte offset follow from the slot. Only the shards that hold these slots are read and put in order."""
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for r in b.to_pylist():
                rows = [(s, d, a, n, r["payload"][i * r["stride"]:i * r["stride"] + 2 * n])
                        for i, (d, a, n) in enumerate(zip(r["doc_ids"], r["starts"], r["lengths"]))
                        if first <= (s := r["first_slot"] + i) < last]
                cols = list(zip(*rows)) or [()] * 5
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.binary()])],
                                                 names=["slot", "doc_id", "start", "length", "ids"])
    near = written.where((F.col("first_slot") < last) & (F.col("first_slot") + F.col("n_sequences") > first)).orderBy("first_slot")
    return near.mapInArrow(cut, "slot long, doc_id long, start long, length long, ids binary")


def digests(written: DataFrame) -> DataFrame:
    """doc_id, start, length, slot, shard_id, byte_offset, ids_crc32 of every stored sequence, from the payload."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "start", "length", "slot", "shard_id", "byte_offset", "ids_crc32"]
        for b in batches:
            for r in b.to_pylist():
                rows = []
                for i, (d, a, n) in enumerate(zip(r["doc_ids"], r["starts"], r["lengths"])):
                    at = i * r["stride"]
                    ids = np.frombuffer(r["payload"], "<u2", count=n, offset=at).astype("<u4").tobytes()
                    rows.append((d, a, n, r["first_slot"] + i, r["shard_id"], at, zlib.crc32(ids)))
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows)], names=names)
    return written.mapInArrow(run, "doc_id long, start long, length long, slot long, shard_id long, byte_offset long, ids_crc32 long")
