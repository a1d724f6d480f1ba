"""Token counts and token ids by rank-synchronous array merging.

The pre-tokens of a batch of texts are found, hashed and made distinct as arrays. New ones are held as one ragged numpy
array of symbol ids. In every round each sequence finds its own lowest-ranked adjacent pair, all sequences apply theirs
at once (all occurrences, left to right), and sequences without a ranked pair leave the array; what survives of a
sequence are its tokens.
"""

from __future__ import annotations

import functools
import json
import re
from collections.abc import Iterator

import numpy as np
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acoustispark.llm.bytewords import mix
from acoustispark.llm.common import map_texts

# The contractions of the public byte-level tokenizers' pre-token pattern; the rest of that pattern is
# an optional blank before a run of letters, of numbers or of other signs, and white space.
CONTRACTIONS = ("s", "t", "re", "ve", "m", "ll", "d")

OTHER, LETTER, NUMBER, SPACE = 0, 1, 2, 3
_NONE = np.iinfo(np.int32).max
_RNG = np.random.default_rng(50256)
_STEP = np.uint64(0x9E3779B97F4A7C15)


@functools.cache
def _classes() -> np.ndarray:
    """The class of every code point."""
    out = np.full(0x110000, OTHER, dtype=np.uint8)
    everything = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    for kind, rule in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (SPACE, r"\s+")):
        for m in regex.finditer(rule, everything):
            a, b = ord(m.group()[0]), ord(m.group()[-1])
            out[a:b + 1] = kind
    out[0xD800:0xE000] = OTHER
    return out


@functools.cache
def _code_hash() -> np.ndarray:
    with np.errstate(over="ignore"):
        return mix(np.arange(0x110000, dtype=np.uint64) * _STEP + np.uint64(77)) | np.uint64(1)


@functools.lru_cache(maxsize=1)
def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.full(n, _STEP, dtype=np.uint64))


def ragged(starts: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... (lens[0] of them), starts[1], ..."""
    ends = np.cumsum(lens)
    return np.repeat(starts - (ends - lens), lens) + np.arange(ends[-1] if len(ends) else 0)


def pretoken_starts(points: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Places where a pre-token starts in the code points of texts that start at ``firsts`` (none empty).

    A run of one class is a pre-token and takes one blank before it; white space before anything else gives its last
    character away, to that run if it is a blank, else as a pre-token of its own; an apostrophe that starts a
    pre-token and a contraction after it are one.
    """
    n = len(points)
    kind = _classes()[points]
    first = np.zeros(n + 1, dtype=bool)
    first[firsts] = True
    first[n] = True
    change = np.ones(n, dtype=bool)
    change[1:] = kind[1:] != kind[:-1]
    change |= first[:n]
    space, blank = kind == SPACE, points == 0x20
    after_blank = np.zeros(n, dtype=bool)
    after_blank[1:] = blank[:-1]
    after_blank &= ~first[:n]
    start = change & (space | ~after_blank)
    gives = np.zeros(n, dtype=bool)  # last of a white-space run before something else in the same text
    gives[:-1] = space[:-1] & ~space[1:] & ~first[1:n]
    start |= gives
    quote = np.flatnonzero((points == 0x27) & start & ~after_blank)
    for q in quote[quote + 1 < n]:
        if first[q + 1]:
            continue
        ahead = points[q + 1:q + 3]
        for c in CONTRACTIONS:
            end = q + 1 + len(c)
            if len(ahead) >= len(c) and all(ahead[i] == ord(c[i]) for i in range(len(c))) and not first[q + 2:end].any():
                start[q + 1] = False
                if end < n:
                    start[end] = True
                break
    return np.flatnonzero(start)


class PairTable:
    """Merge ranks of symbol pairs by hashing, for whole arrays of pairs."""

    def __init__(self, codes: np.ndarray):
        self.levels, left, bits = [], np.arange(len(codes)), 20
        while len(left):
            mul = np.uint64(int(_RNG.integers(1 << 62)) * 2 + 1)
            slot = self._slot(codes[left], mul, bits)
            key, rank = np.full(1 << bits, -1, dtype=np.int64), np.full(1 << bits, _NONE, dtype=np.int32)
            key[slot[::-1]], rank[slot[::-1]] = codes[left][::-1], left[::-1]
            self.levels.append((mul, bits, key, rank))
            left = left[key[slot] != codes[left]]
            bits = max(8, bits - 4)

    @staticmethod
    def _slot(codes: np.ndarray, mul: np.uint64, bits: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return (codes.astype(np.uint64) * mul) >> np.uint64(64 - bits)

    def ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        code = left.astype(np.int64) << 20 | right
        out = np.full(len(code), _NONE, dtype=np.int32)
        for mul, bits, key, rank in self.levels:
            slot = self._slot(code, mul, bits)
            np.copyto(out, rank[slot], where=key[slot] == code)
        return out


def byte_symbols() -> list[str]:
    """The printable stand-in of every byte in the vocabulary file: visible Latin-1 bytes stand for themselves,
    the others take the code points from 256 on, in order."""
    visible = set(range(0x21, 0x7F)) | set(range(0xA1, 0xAD)) | set(range(0xAE, 0x100))
    spare = iter(range(256, 512))
    return [chr(b) if b in visible else chr(next(spare)) for b in range(256)]


class ByteBpe:
    """Merges of a byte-level tokenizer file, applied to whole batches of byte strings."""

    def __init__(self, path: str):
        spec = json.load(open(path, encoding="utf-8"))
        vocab, merges = spec["model"]["vocab"], spec["model"]["merges"]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.byte_ids = np.array([vocab[s] for s in byte_symbols()], dtype=np.int32)
        self.table = PairTable(np.array([vocab[a] << 20 | vocab[b] for a, b in pairs], dtype=np.int64))
        self.merged = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("(" + "|".join(map(re.escape, sorted(self.special, key=len, reverse=True))) + ")")

    def _ranks(self, flat: np.ndarray, at: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Ranks of the pairs that start at ``at``; none where a sequence ends."""
        nxt = np.minimum(at + 1, len(flat) - 1)
        out = self.table.ranks(flat[at], flat[nxt])
        out[last[at]] = _NONE
        return out

    def merge(self, raw: bytes, lens: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all sequences, tokens of each) for sequences of ``lens`` > 0 bytes."""
        flat = self.byte_ids[np.frombuffer(raw, dtype=np.uint8)]
        ids, done = np.arange(len(lens)), []
        last = np.zeros(len(flat), dtype=bool)
        last[np.cumsum(lens) - 1] = True
        rank = self._ranks(flat, np.arange(len(flat)), last)
        while len(ids):
            starts = np.cumsum(lens) - lens
            low = np.minimum.reduceat(rank, starts)
            alive = low < _NONE
            if not alive.all():  # finished sequences leave the array
                stay = np.repeat(alive, lens)
                done.append((ids[~alive], flat[~stay], lens[~alive]))
                flat, rank, last, ids, lens, low = flat[stay], rank[stay], last[stay], ids[alive], lens[alive], low[alive]
                if not len(ids):
                    break
            seq_low = np.repeat(low, lens)
            hit = np.flatnonzero(rank == seq_low)
            apart = np.ones(len(hit), dtype=bool)
            apart[1:] = hit[1:] != hit[:-1] + 1
            run = np.maximum.accumulate(np.where(apart, np.arange(len(hit)), 0))
            hit = hit[(np.arange(len(hit)) - run) % 2 == 0]  # of overlapping equal pairs every second one
            flat[hit] = self.merged[rank[hit]]
            last[hit] = last[hit + 1]
            keep = np.ones(len(flat), dtype=bool)
            keep[hit + 1] = False
            ends = np.cumsum(lens)
            lens = lens - np.bincount(np.searchsorted(ends, hit, side="right"), minlength=len(ids))
            now = hit - np.arange(len(hit))  # places of the merged symbols in the shorter array
            flat, rank, last = flat[keep], rank[keep], last[keep]
            touched = np.concatenate([now, now[(now > 0)] - 1])
            touched = touched[~last[touched]]
            rank[now] = _NONE
            rank[touched] = self._ranks(flat, touched, last)
        order = np.concatenate([d[0] for d in done])
        all_flat, all_lens = np.concatenate([d[1] for d in done]), np.concatenate([d[2] for d in done])
        place = np.empty(len(order), dtype=np.int64)
        place[order] = np.arange(len(order))
        starts = np.cumsum(all_lens) - all_lens
        return all_flat[ragged(starts[place], all_lens[place])], all_lens[place]


class Encoder:
    """Token ids of batches of texts; the tokens of up to ``most`` distinct pre-tokens are kept between batches."""

    def __init__(self, path: str, most: int = 1_500_000):
        self.bpe, self.most = ByteBpe(path), most
        self._forget()

    def _forget(self) -> None:
        self.known = np.empty(0, dtype=np.uint64)  # sorted hashes of pre-tokens
        self.at, self.n = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        self.pool, self.filled = np.empty(1 << 16, dtype=np.int32), 0

    def _learn(self, hashes: np.ndarray, points: np.ndarray, starts: np.ndarray, lens: np.ndarray) -> None:
        chars = points[ragged(starts, lens)]
        wide = 1 + (chars >= 0x80) + (chars >= 0x800) + (chars >= 0x10000)
        n_bytes = np.add.reduceat(wide, np.cumsum(lens) - lens)
        flat, n = self.bpe.merge(chars.astype("<u4").tobytes().decode("utf-32-le").encode(), n_bytes)
        need = self.filled + len(flat)
        if need > len(self.pool):
            grown = np.empty(2 * need, dtype=np.int32)
            grown[:self.filled] = self.pool[:self.filled]
            self.pool = grown
        self.pool[self.filled:need] = flat
        at = self.filled + np.cumsum(n) - n
        self.filled = need
        where = np.searchsorted(self.known, hashes)
        self.known = np.insert(self.known, where, hashes)
        self.at, self.n = np.insert(self.at, where, at), np.insert(self.n, where, n)

    def _plain(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Non-empty texts: (pool row of every pre-token, their number of tokens, number of pre-tokens of each text)."""
        points = np.frombuffer("".join(texts).encode("utf-32-le"), dtype="<u4")
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        firsts = np.cumsum(sizes) - sizes
        starts = pretoken_starts(points, firsts)
        lens = np.diff(starts, append=len(points))
        place = np.arange(len(points)) - np.repeat(starts, lens)
        top = 1 << int(lens.max() - 1).bit_length()
        with np.errstate(over="ignore"):
            term = _code_hash()[points] * _powers(top)[place]
            h = mix(np.add.reduceat(term, starts) + lens.astype(np.uint64))
        distinct, sample, inverse = np.unique(h, return_index=True, return_inverse=True)
        if len(self.known) + len(distinct) > self.most:
            self._forget()
        where = np.searchsorted(self.known, distinct)
        new = np.ones(len(distinct), dtype=bool)
        inside = where < len(self.known)
        new[inside] = self.known[where[inside]] != distinct[inside]
        if new.any():
            self._learn(distinct[new], points, starts[sample[new]], lens[sample[new]])
            where = np.searchsorted(self.known, distinct)
        per_text = np.diff(np.searchsorted(starts, firsts), append=len(starts))
        return self.at[where][inverse], self.n[where][inverse], per_text

    def _pieces(self, texts: list) -> Iterator[tuple[list[int], list[str]]]:
        """Groups of (owner, piece), cut at special strings; a special string is a piece of its own."""
        owners, held, size = [], [], 0
        for i, t in enumerate(texts):
            if not t:
                continue
            cut = self.bpe.special_re.split(t) if any(s in t for s in self.bpe.special) else [t]
            for p in cut:
                if p:
                    owners.append(i)
                    held.append(p)
                    size += len(p)
            if size >= 1 << 21:
                yield owners, held
                owners, held, size = [], [], 0
        if held:
            yield owners, held

    def _groups(self, texts: list):
        for owners, held in self._pieces(texts):
            special = np.array([p in self.bpe.special for p in held])
            plain = [p for p, s in zip(held, special) if not s]
            at, n, per = self._plain(plain) if plain else (np.empty(0, np.int64),) * 3
            yield np.array(owners), held, special, at, n, per

    def counts(self, texts: list) -> np.ndarray:
        out = np.zeros(len(texts), dtype=np.int64)
        for owners, _, special, _, n, per in self._groups(texts):
            np.add.at(out, owners[special], 1)
            if len(per):
                ends = np.cumsum(per)
                np.add.at(out, owners[~special], np.add.reduceat(n, ends - per))
        return out

    def encode(self, texts: list) -> list[np.ndarray]:
        """Token ids of every text (null: none)."""
        out: list = [np.empty(0, dtype=np.int32)] * len(texts)
        for owners, held, special, at, n, per in self._groups(texts):
            flat = self.pool[ragged(at, n)]
            ends = np.cumsum(per)
            tokens = np.add.reduceat(n, ends - per) if len(per) else per
            parts = iter(np.split(flat, np.cumsum(tokens)[:-1])) if len(per) else iter(())
            for i, p, s in zip(owners, held, special):
                ids = np.array([self.bpe.special[p]], dtype=np.int32) if s else next(parts)
                out[i] = ids if not len(out[i]) else np.concatenate([out[i], ids])
        return out


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One a worker process, so that tasks share what it has learned."""
    return Encoder(path)


def token_counts(docs: DataFrame, path: str, text: str = "text", limit: int = 512) -> DataFrame:
    """All columns of ``docs`` except those replaced, with n_bytes, n_tokens and over_limit (n_tokens > ``limit``).

    Null and empty texts have no bytes and no tokens. Rows are independent: repeated rows repeat their counts,
    an empty table gives an empty result, other columns pass through, and one of the three names is replaced.
    """
    keep = [c for c in docs.columns if c not in (text, "n_bytes", "n_tokens", "over_limit")]
    src = docs.withColumn("n_bytes", F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))

    def make():
        own = encoder(path)
        return lambda texts: [own.counts(texts)]

    out = map_texts(src, text, make, "n_tokens long", keep + ["n_bytes"])
    return out.withColumn("over_limit", F.col("n_tokens") > limit)
