"""Token counts, packing and training order against the tokenizer library and plain Python."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from acoustispark.llm import bpe, order, packing
from acoustispark.llm.queries import BYTE_BPE, op2_training_order, op7_packing, op10_token_counts

from ..conftest import SF

ODD = ["", None, "a  b   c\n\n\n d\t e ", "aaaa" * 5000, "x<|endoftext|>y <|endoftext|> ", "²½ é́ 日本語テスト 👍🏽\x1c\x85　 z", " " * 1000,
       "don't I'll we'Ve 's", "'s", "'sun's 're!'s\n's x's", "<|endoftext|>", "<|endoftext|><|endoftext|>'t", "'", "\n", "'ll'l'vex",
       "word " * 60_000]


@pytest.fixture(scope="module")
def library():
    tok = Tokenizer.from_file(BYTE_BPE)
    return lambda t: tok.encode(t or "", add_special_tokens=False).ids


@pytest.fixture(scope="module")
def own():
    return bpe.Encoder(BYTE_BPE, most=500)  # forgets often


def test_ids_equal_the_library(own, library):
    assert [x.tolist() for x in own.encode(ODD)] == [library(t) for t in ODD]
    assert own.counts(ODD).tolist() == [len(library(t)) for t in ODD]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list(" \n\t  'stremvld'aAé1²-.!日\x1c\xa0<|>")), max_size=40), max_size=6))
def test_ids_equal_the_library_on_any_text(own, library, texts):
    assert [x.tolist() for x in own.encode(texts)] == [library(t) for t in texts]


def test_counts_edge_rows(spark, library):
    rows = [(i, t, 7) for i, t in enumerate(ODD)] + [(None, "twice", 1), (None, "twice", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_tokens int")
    got = bpe.token_counts(df, BYTE_BPE).collect()
    assert sorted((r.doc_id is None, r.doc_id or 0, r.n_bytes, r.n_tokens, r.over_limit) for r in got) == sorted(
        (i is None, i or 0, len((t or "").encode()), len(library(t)), len(library(t)) > 512) for i, t, _ in rows)
    assert bpe.token_counts(df.limit(0), BYTE_BPE).count() == 0


def test_counts_query(spark, library):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = op10_token_counts(spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in got} == {i: len(library(t)) for i, t in docs.items()} and len(got) == len(docs)


def _check_packing(rows, texts, library, window):
    want = {}
    for i, t in texts:
        want.setdefault(i, []).append(np.array(library(t) + [0], dtype="<u4"))
    for i, all_ids in want.items():
        mine = [r for r in rows if r.doc_id == i]
        assert sum(r.length for r in mine) == sum(map(len, all_ids))
        assert sorted((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in mine) == sorted(
            (s, len(ids[s:s + window]), zlib.crc32(ids[s:s + window].tobytes()), len(ids)) for ids in all_ids for s in range(0, len(ids), window))
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in by.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))]
        assert sum(n for _, n in parts) <= window
    return sum(n for p in by.values() for _, n in p) / (window * len(by))


def test_packing_edge_rows(spark, library):
    rows = [(i, t, "x") for i, t in enumerate(ODD)] + [(99, "twice", "x"), (99, "twice", "x")] + [(200 + i, "same text", "x") for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id long, text string, offset string")
    got = packing.pack(df, BYTE_BPE, window=64).collect()
    _check_packing(got, [(i, t) for i, t, _ in rows], library, 64)
    assert packing.pack(df.limit(0), BYTE_BPE).count() == 0
    assert packing.pack(spark.createDataFrame([(None, "no id")], "doc_id long, text string"), BYTE_BPE).first().doc_id is None


def test_packing_query_pads_little(spark, library):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    assert _check_packing(op7_packing(spark, SF).collect(), texts, library, 1024) > 0.97


@settings(max_examples=40, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 5), min_size=1, max_size=6), st.integers(30, 60))
def test_best_fill_is_optimal(counts, room):
    table = np.zeros(64, dtype=np.int64)
    for n, k in counts.items():
        table[n] = k
    used = packing.best_fill(table, sorted(counts, reverse=True), room)
    sums = {0}
    for n, k in counts.items():
        sums = {s + j * n for s in sums for j in range(k + 1) if s + j * n <= room}
    assert sum(n * k for n, k in used.items()) == max(sums) and all(k <= counts[n] for n, k in used.items())


@pytest.mark.parametrize("n", [1, 2, 3, 5, 16, 17, 1000, 4097])
def test_feistel_is_a_permutation(n):
    out = order.permute(np.arange(n), n, 42)
    assert sorted(out.tolist()) == list(range(n))
    assert order.permute(out, n, 42, back=True).tolist() == list(range(n))
    assert n < 100 or order.permute(np.arange(n), n, 43).tolist() != out.tolist()


def test_shards_round_trip_and_resume(spark, library, tmp_path):
    rows = [(i, t) for i, t in enumerate(ODD)] + [(None, "no id"), (5, "twice"), (5, "twice")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = order.write_shards(df, BYTE_BPE, str(tmp_path / "a"), seq_len=32, shard_sequences=16)
    total = kept.selectExpr("sum(n_sequences) n").first().n
    read = order.read_slots(kept, 0, total).collect()
    assert sorted(r.slot for r in read) == list(range(total))
    pieces = sorted((-1 if r.doc_id is None else r.doc_id, r.start, np.frombuffer(r.ids, "<u2").tolist()) for r in read)
    want = []
    for i, t in rows:
        ids = library(t) + [0]
        want += [(-1 if i is None else i, s, ids[s:s + 32]) for s in range(0, len(ids), 32)]
    assert pieces == sorted(want)
    later = order.read_slots(kept, 100, 150).collect()
    assert sorted(r.slot for r in later) == list(range(100, 150))
    shard = kept.orderBy("shard_id").first()
    assert len(shard.payload) == shard.n_sequences * shard.stride
    assert order.write_shards(df.limit(0), BYTE_BPE, str(tmp_path / "b")).count() == 0


def test_slots_follow_from_the_rows(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").limit(300)
    odd = spark.createDataFrame([(None, f"text {i}") for i in range(40)] + [(4, "twice"), (4, "twice"), (4, None), (4, "")], "doc_id long, text string")
    rows = spark.createDataFrame(docs.unionByName(odd).collect(), "doc_id long, text string")
    seen = []
    for n in (3, 11):
        kept = order.write_shards(rows.repartition(n), BYTE_BPE, str(tmp_path / str(n)), seq_len=64, shard_sequences=8)
        total = kept.selectExpr("sum(n_sequences) n").first().n
        got = [(r.slot, r.doc_id, r.start, bytes(r.ids)) for r in order.read_slots(kept, 0, total).toLocalIterator()]
        assert [g[0] for g in got] == list(range(total))
        part = [r.slot for r in order.read_slots(kept, 21, 203).collect()]
        assert part == list(range(21, 203))
        seen.append(got)
    assert seen[0] == seen[1]


def test_order_ignores_clashing_columns(spark, tmp_path):
    rows = spark.createDataFrame([(i, f"some text {i}", 1, 2, 3, "x") for i in range(20)],
                                 "doc_id long, text string, mark int, copy int, part int, ids string")
    kept = order.write_shards(rows, BYTE_BPE, str(tmp_path / "c"), seq_len=32, shard_sequences=16)
    plain = order.write_shards(rows.select("doc_id", "text"), BYTE_BPE, str(tmp_path / "d"), seq_len=32, shard_sequences=16)
    assert sorted(map(str, kept.collect())) == sorted(map(str, plain.collect()))


def test_order_query(spark, library):
    got = op2_training_order(spark, SF).collect()
    assert sorted(r.slot for r in got) == list(range(len(got)))
    docs = {r.doc_id: np.array(library(r.text) + [0], dtype="<u4") for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert len(got) == sum(-(-len(x) // 1024) for x in docs.values())
    assert all(r.ids_crc32 == zlib.crc32(docs[r.doc_id][r.start:r.start + 1024].tobytes()) for r in got)


def test_a_staged_table_keeps_no_shuffle_files(spark):
    from acoustispark.llm.common import staged
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

    def told(batches):
        from pyspark import TaskContext
        for b in batches:
            b["freed"] = TaskContext.get().getLocalProperty(name)
            yield b

    before = spark.conf.get(name)
    out = staged(spark.range(100).repartition(4, "id").mapInPandas(told, "id long, freed string"), "freed")
    assert {r.freed for r in out.collect()} == {"true"} and out.count() == 100 and spark.conf.get(name) == before
