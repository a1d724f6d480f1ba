"""Substring deduplication by repeated-phrase automata.

Documents are cut into shards by ranges of their id, so places of words have one global order: shard, then place in it.

1. Passages: in every window of ``window`` words the phrase of ``anchor`` words with the smallest hash is its anchor; two
   equal windows have the same one. Fragments of the hashes confirm the phrases that occur more than once anywhere. One
   shard speaks for each: it gives the words, and the fragments hand them to every shard that may hold the phrase.
2. Automata: every shard compiles the phrases that it was handed into an Aho-Corasick automaton and streams all its
   documents through it. What repeats, and where, is known from its occurrences alone.
3. A window around an occurrence that the shard has already seen is a later one. The first of each kind in a shard goes
   to the fragment of its key, which tells all shards but the earliest that theirs comes later too. So a window that is
   in every document is one entry a shard.
4. Shards remove the words that later windows cover.
"""

from __future__ import annotations

import re
from collections.abc import Callable

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from acoustispark.llm.bytewords import runs, word_hashes
from acoustispark.llm.common import shuffle_width, staged

_BYTES_WORD = re.compile(rb"[^\x20\x09-\x0D]+")
#: Text bytes of a shard, on average.
SHARD_BYTES = 24 << 20
#: Text bytes whose keys make a fragment, on average.
FRAGMENT_BYTES = 64 << 20
#: Turns the words of a window into other numbers, for the second part of its key.
_SECOND = np.uint64(0x5851F42D4C957F2D)


class Shard:
    """The documents of one shard in order of id, as one flat array of word hashes."""

    def __init__(self, t: pa.Table, id_at: int, text_at: int):
        ids, texts = t.column(id_at).to_pylist(), t.column(text_at).to_pylist()
        self.order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i] or ""))
        self.raws = [(texts[i] or "").encode() for i in self.order]
        self.words, self.lens = word_hashes(self.raws)
        self.firsts = np.cumsum(self.lens) - self.lens

    def valid_starts(self, n: int) -> np.ndarray:
        """Whether a run of ``n`` words starts at a place without leaving its document."""
        out = np.zeros(max(0, len(self.words) - n + 1), dtype=bool)
        for a, k in zip(self.firsts, self.lens):
            if k >= n:
                out[a:a + k - n + 1] = True
        return out

    def phrases(self, places: np.ndarray, n: int) -> list[bytes]:
        """The ``n`` words from each place on, joined by a blank; the places must not leave their documents."""
        doc = np.searchsorted(self.firsts, places, side="right") - 1
        out: list[bytes] = [b""] * len(places)
        order = np.argsort(doc, kind="stable")
        cur, words = -1, []
        for i, d, p in zip(order.tolist(), doc[order].tolist(), (places - self.firsts[doc])[order].tolist()):
            if d != cur:
                cur, words = d, self.raws[d].split()
            out[i] = b" ".join(words[p:p + n])
        return out


def _raw(keys: np.ndarray) -> bytes:
    return keys.astype("<u8").tobytes()


def _steps(places: np.ndarray) -> bytes:
    """Ascending places as differences."""
    return np.diff(places, prepend=0).astype("<u4").tobytes()


def _bits(packed: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8))[:n].astype(bool)


def _seen_before(keys: np.ndarray, tails: np.ndarray) -> np.ndarray:
    """Whether an equal (key, tail) stands further left."""
    order = np.lexsort((tails, keys))  # equal ones stay in order
    k, e = keys[order], tails[order]
    out = np.zeros(len(keys), dtype=bool)
    out[order[1:]] = (k[1:] == k[:-1]) & (e[1:] == e[:-1])
    return out


def anchors(words: np.ndarray, valid: np.ndarray, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, keys) of the anchors of all valid windows: the leftmost smallest phrase hash of each."""
    grams = runs(words, anchor)
    span = window - anchor + 1
    starts = np.flatnonzero(valid)
    if not len(starts):
        return starts, grams[:0]
    low, at = grams[starts], starts.copy()
    for i in range(1, span):
        here = grams[starts + i]
        less = here < low
        low = np.where(less, here, low)
        at[less] = starts[less] + i
    places = np.unique(at)
    return places, grams[places]


def _by_fragment(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    where = ((keys >> np.uint64(24)) % np.uint64(parts)).astype(np.uint32)
    order = np.argsort(where, kind="stable")
    return order, np.searchsorted(where[order], np.arange(parts + 1))


def _spell(words: np.ndarray, alphabet: np.ndarray) -> tuple[str, np.ndarray]:
    """(the words as characters, where each begins). A word of the alphabet is three characters, one from each of three
    sets of 64, so a state has few successors and no match can start inside a word; all others are one further character."""
    at = np.minimum(np.searchsorted(alphabet, words), len(alphabet) - 1)
    known = alphabet[at] == words
    at %= 64 ** 3  # beyond that, words share a spelling: more places are found, and step 3 sorts them out
    spelled = np.stack([0x100 + (at >> 12), 0x200 + (at >> 6 & 63), 0x300 + (at & 63)], axis=1).astype("<u4")
    spelled[~known, 0] = 0x50
    inside = np.ones(spelled.shape, dtype=bool)
    inside[~known, 1:] = False
    width = np.where(known, 3, 1)
    return spelled[inside].tobytes().decode("utf-32-le"), np.cumsum(width) - width


def occurrences(words: np.ndarray, phrases: np.ndarray) -> np.ndarray:
    """Last places of all occurrences of the phrases (a row of word hashes each), by an automaton."""
    if not len(phrases) or not len(words):
        return np.empty(0, dtype=np.int64)
    alphabet, size = np.unique(phrases), 3 * phrases.shape[1]
    machine = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
    patterns, _ = _spell(phrases.ravel(), alphabet)
    for p in range(0, len(patterns), size):
        machine.add_word(patterns[p:p + size])
    machine.make_automaton()
    text, first = _spell(words, alphabet)
    ends = np.fromiter((end for end, _ in machine.iter(text)), dtype=np.int64)
    return np.searchsorted(first, ends, side="right") - 1


def candidate_windows(words: np.ndarray, valid: np.ndarray, ends: np.ndarray, window: int, anchor: int) -> np.ndarray:
    """Starts of the valid windows that hold an occurrence ending at one of ``ends``."""
    step = np.zeros(len(valid) + 1, dtype=np.int64)
    np.add.at(step, np.clip(ends - window + 1, 0, len(valid)), 1)
    np.add.at(step, np.clip(ends - anchor + 2, 0, len(valid)), -1)
    return np.flatnonzero((np.cumsum(step[:-1]) > 0) & valid)


def remove_repeats(docs: DataFrame, window: int = 20, anchor: int = 8, doc_id: str = "doc_id", text: str = "text",
                   keep: list[str] | None = None, one_blank: bool = True,
                   find: Callable[[np.ndarray, np.ndarray], np.ndarray] = occurrences) -> DataFrame:
    """``keep`` columns (default: all but the text), n_words, n_removed and kept: the text without every word that is covered by a
    ``window`` of words whose sequence starts earlier (smaller id, or the same document). Windows are judged on the
    input. ``one_blank``: kept words are joined by one blank; else each keeps the white space before it.

    Words are runs other than blanks and 09-0D; null texts have none. Of rows that share an id the smaller text is
    earlier, and a repeated row counts as later; a null id counts as larger than all others. Columns named like the
    new ones are replaced. An empty table gives an empty result. ``find`` looks for phrases in the words of a shard.

    Windows are equal if 96 bits of hashes are: of m different windows two agree with a chance of about m * m / 2^97
    (1e-4 at 4e12 windows). Phrases are confirmed by 64 bits; where two share them one may be missed.
    """
    spark = docs.sparkSession
    new = ("n_words", "n_removed", "kept")
    keep = [c for c in docs.columns if c != text and c not in new] if keep is None else keep
    size = docs.agg(F.sum(F.octet_length(text)).alias("b")).first()["b"] or 0
    parts = min(65536, max(shuffle_width(spark), size // FRAGMENT_BYTES))
    shards = max(shuffle_width(spark), -(-size // SHARD_BYTES))
    cuts = docs.agg(F.percentile_approx(doc_id, [i / shards for i in range(1, shards)], 20 * shards).alias("c")).first()["c"] or []
    cuts = sorted({int(c) for c in cuts})
    shard = F.expr(f"size(filter(array({','.join(f'{c}L' for c in cuts)}), c -> __id > c))") if cuts else F.lit(0)
    src = docs.select(*[F.col(c).alias(f"k{i}") for i, c in enumerate(keep)], F.col(doc_id).cast("long").alias("__id"), F.col(text).alias("__text"))
    src = src.withColumn("shard", F.when(F.col("__id").isNull(), F.lit(len(cuts))).otherwise(shard).cast("int"))
    # one exchange of the texts; the four steps below read it
    sharded = src.repartition(shards, "shard")
    id_at, text_at, shard_at = len(keep), len(keep) + 1, len(keep) + 2

    def emit_anchors(t: pa.Table) -> pa.Table:
        s = Shard(t, id_at, text_at)
        _, keys = anchors(s.words, s.valid_starts(window), window, anchor)
        keys, n = np.unique(keys, return_counts=True)
        order, edge = _by_fragment(keys, parts)
        rows = []
        for f in np.flatnonzero(np.diff(edge)):
            some = order[edge[f]:edge[f + 1]]
            rows.append((int(f), t.column(shard_at)[0].as_py(), _raw(keys[some]), np.packbits(n[some] > 1).tobytes()))
        return _table(rows, [("fragment", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("often", pa.binary())])

    def confirm(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["shard"])
        held = [np.frombuffer(r["keys"], "<u8") for r in rows]
        often = [_bits(r["often"], len(k)) for r, k in zip(rows, held)]
        keys, again = np.concatenate(held), np.concatenate(often)
        _, first, inverse, n = np.unique(keys, return_index=True, return_inverse=True, return_counts=True)
        good = n > 1
        good[inverse[again]] = True
        out, at = [], 0
        for r, k in zip(rows, held):
            kind = inverse[at:at + len(k)]
            mine = good[kind]
            if mine.any():
                speaks = first[kind] == np.arange(at, at + len(k))
                out.append((r["fragment"], r["shard"], _raw(k[mine]), np.packbits(speaks[mine]).tobytes()))
            at += len(k)
        return _table(out, [("fragment", pa.int32()), ("shard", pa.int32()), ("keys", pa.binary()), ("speaks", pa.binary())])

    def speak(t: pa.Table, told: pa.Table) -> pa.Table:
        kinds = [("fragment", pa.int32()), ("keys", pa.binary()), ("phrases", pa.binary())]
        mine = [np.frombuffer(r["keys"], "<u8")[_bits(r["speaks"], len(r["keys"]) // 8)] for r in told.to_pylist()]
        wanted = np.unique(np.concatenate(mine)) if mine else np.empty(0, dtype=np.uint64)
        if not t.num_rows or not len(wanted):
            return _table([], kinds)
        s = Shard(t, id_at, text_at)
        places, keys = anchors(s.words, s.valid_starts(window), window, anchor)
        keys, first = np.unique(keys, return_index=True)
        some = np.isin(keys, wanted)
        keys, places = keys[some], places[first[some]]
        texts = s.phrases(places, anchor)
        order, edge = _by_fragment(keys, parts)
        rows = []
        for f in np.flatnonzero(np.diff(edge)):
            here = order[edge[f]:edge[f + 1]]
            rows.append((int(f), _raw(keys[here]), b" ".join([texts[i] for i in here.tolist()])))
        return _table(rows, kinds)

    def hand_out(spoken: pa.Table, holders: pa.Table) -> pa.Table:
        keys, texts = [np.empty(0, dtype=np.uint64)], []
        for r in spoken.to_pylist():
            keys.append(np.frombuffer(r["keys"], "<u8"))
            words = r["phrases"].split()
            texts += [b" ".join(words[i:i + anchor]) for i in range(0, len(words), anchor)]
        known = np.concatenate(keys)
        order = np.argsort(known)
        ranked, out = known[order], []
        for r in holders.to_pylist():
            at = order[np.searchsorted(ranked, np.frombuffer(r["keys"], "<u8"))]
            out.append((r["shard"], b" ".join([texts[i] for i in at.tolist()])))
        return _table(out, [("shard", pa.int32()), ("phrases", pa.binary())])

    window_kinds = [("fragment", pa.int32()), ("shard", pa.int32()), ("places", pa.binary()), ("keys", pa.binary()), ("tails", pa.binary())]

    def emit_windows(t: pa.Table, handed: pa.Table) -> pa.Table:
        if not t.num_rows or not handed.num_rows:
            return _table([], window_kinds)
        s = Shard(t, id_at, text_at)
        phrases, _ = word_hashes([x for x in handed.column("phrases").to_pylist()])
        ends = find(s.words, phrases.reshape(-1, anchor))
        starts = candidate_windows(s.words, s.valid_starts(window), ends, window, anchor)
        if not len(starts):
            return _table([], window_kinds)
        keys = runs(s.words, window)[starts]
        tails = (runs(s.words ^ _SECOND, window)[starts] & np.uint64(0xFFFFFFFF)).astype("<u4")
        repeat = _seen_before(keys, tails)
        nr = t.column(shard_at)[0].as_py()
        rows = [(nr % parts, nr, _steps(starts[repeat]), b"", b"")]  # later ones of this shard go straight to step 4
        starts, keys, tails = starts[~repeat], keys[~repeat], tails[~repeat]
        order, edge = _by_fragment(keys, parts)
        for f in np.flatnonzero(np.diff(edge)):
            some = order[edge[f]:edge[f + 1]]
            rows.append((int(f), nr, _steps(starts[some]), _raw(keys[some]), tails[some].tobytes()))
        return _table(rows, window_kinds)

    def later(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["shard"])
        out = [(r["shard"], r["places"]) for r in rows if not r["keys"] and r["places"]]
        rows = [r for r in rows if r["keys"]]
        if rows:
            repeat = _seen_before(np.concatenate([np.frombuffer(r["keys"], "<u8") for r in rows]),
                                  np.concatenate([np.frombuffer(r["tails"], "<u4") for r in rows]))
            at = 0
            for r in rows:
                mine = repeat[at:at + len(r["tails"]) // 4]
                at += len(mine)
                if mine.any():
                    out.append((r["shard"], _steps(np.cumsum(np.frombuffer(r["places"], "<u4").astype(np.int64))[mine])))
        return _table(out, [("shard", pa.int32()), ("places", pa.binary())])

    kept_schema = src.select(*[f"k{i}" for i in range(len(keep))]).schema
    arrow = to_arrow_schema(kept_schema)
    for name, kind in (("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.string())):
        arrow = arrow.append(pa.field(name, kind))

    def cut(t: pa.Table, told: pa.Table) -> pa.Table:
        if not t.num_rows:
            return arrow.empty_table()
        s = Shard(t, id_at, text_at)
        step = np.zeros(len(s.words) + 1, dtype=np.int64)
        for raw in told.column("places").to_pylist():
            at = np.cumsum(np.frombuffer(raw, "<u4").astype(np.int64))
            step[at] += 1  # places of one row differ
            step[at + window] -= 1
        gone = np.cumsum(step[:-1]) > 0
        lens, removed, kept = s.lens.tolist(), [], []
        for raw, a, k in zip(s.raws, s.firsts.tolist(), lens):
            mask = gone[a:a + k]
            n = int(mask.sum())
            removed.append(n)
            if one_blank:
                words = raw.split()  # splits bytes at the same six characters
                kept.append(b" ".join(words if not n else [w for w, g in zip(words, mask.tolist()) if not g]))
            elif not n:
                kept.append(raw)
            else:
                pieces, end = [], 0
                for m, g in zip(_BYTES_WORD.finditer(raw), mask.tolist()):
                    if not g:
                        pieces.append(raw[end:m.end()])
                    end = m.end()
                kept.append(b"".join(pieces).lstrip())
        picked = t.take(pa.array(s.order, pa.int64()))
        cols = [picked.column(i) for i in range(len(keep))]
        cols += [pa.array(lens, pa.int64()), pa.array(removed, pa.int64()), pa.array([k.decode() for k in kept], pa.string())]
        return pa.Table.from_arrays([c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in cols], schema=arrow)

    key = F.col("shard")
    confirmed = staged(sharded.groupBy(key).applyInArrow(emit_anchors, "fragment int, shard int, keys binary, often binary").groupBy(
        "fragment").applyInArrow(confirm, "fragment int, shard int, keys binary, speaks binary"), "confirmed")
    spoken = sharded.groupBy(key).cogroup(confirmed.groupBy("shard")).applyInArrow(speak, "fragment int, keys binary, phrases binary")
    handed = spoken.groupBy("fragment").cogroup(confirmed.groupBy("fragment")).applyInArrow(hand_out, "shard int, phrases binary")
    windows = sharded.groupBy(key).cogroup(handed.groupBy("shard")).applyInArrow(
        emit_windows, "fragment int, shard int, places binary, keys binary, tails binary")
    told = windows.groupBy("fragment").applyInArrow(later, "shard int, places binary")
    schema = kept_schema
    for f in spark.createDataFrame([], "n_words long, n_removed long, kept string").schema:
        schema = schema.add(f)
    out = sharded.groupBy(key).cogroup(told.groupBy("shard")).applyInArrow(cut, schema)
    return out.select(*[F.col(f"k{i}").alias(c) for i, c in enumerate(keep)], *new)


def _table(rows: list[tuple], kinds: list[tuple]) -> pa.Table:
    cols = list(zip(*rows)) or [()] * len(kinds)
    return pa.Table.from_arrays([pa.array(c, k) for c, (_, k) in zip(cols, kinds)], names=[n for n, _ in kinds])
