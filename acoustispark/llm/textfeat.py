"""Hashed character features of batches of words as ragged numpy arrays, and bounded samples of labelled rows."""

from __future__ import annotations

import itertools
import re
from collections.abc import Callable, Sequence

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of the text classifiers: runs of letters (and letter-like symbols), without digits and underscore.
LETTERS = re.compile(r"[^\W\d_]+")
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _finish(h: np.ndarray, bits: int) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (h >> np.uint64(64 - bits)).astype(np.int64)


def char_features(words: Sequence[str], bits: int, sizes: Sequence[int], affixes: int) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, word numbers), both sorted by word: n-grams of ``sizes`` over the whole lower-cased word with
    end marks, and prefixes and suffixes of 1..``affixes`` characters, hashed to ``bits`` bits."""
    marked = ["\x02" + w.lower() + "\x03" for w in words]
    flat = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    lens = np.fromiter(map(len, marked), dtype=np.int64, count=len(marked))
    ends = np.cumsum(lens)
    starts, owner = ends - lens, np.repeat(np.arange(len(lens)), lens)
    feats, owners = [], []
    with np.errstate(over="ignore"):
        for n in sizes:
            if len(flat) < n:
                continue
            h = np.full(len(flat) - n + 1, n * 7919, dtype=np.uint64)
            for i in range(n):
                h = (h + flat[i:len(flat) - n + 1 + i]) * _MULT
                h ^= h >> np.uint64(31)
            inside = owner[:len(h)] == owner[n - 1:]
            feats.append(_finish(h[inside], bits))
            owners.append(owner[:len(h)][inside])
        for k in range(1, affixes + 1):
            long = np.flatnonzero(lens - 2 >= k)
            for salt, first in ((104729, starts[long] + 1), (1299709, ends[long] - 1 - k)):
                h = np.full(len(long), salt + k, dtype=np.uint64)
                for i in range(k):
                    h = (h + flat[first + i]) * _MULT
                    h ^= h >> np.uint64(31)
                feats.append(_finish(h, bits))
                owners.append(long)
    f, o = np.concatenate(feats), np.concatenate(owners)
    order = np.argsort(o, kind="stable")
    return f[order], o[order]


def word_hash(words: Sequence[str], bits: int) -> np.ndarray:
    """One number a lower-cased word: the hash of all its characters."""
    flat = np.frombuffer("".join(w.lower() for w in words).encode("utf-32-le", "surrogatepass"), dtype="<u4").astype(np.uint64)
    lens = np.fromiter((len(w.lower()) for w in words), dtype=np.int64, count=len(words))
    starts = np.cumsum(lens) - lens
    pos = np.arange(len(flat)) - np.repeat(starts, lens)
    with np.errstate(over="ignore"):
        term = (flat + np.uint64(1)) * ((pos.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _MULT)
        term = (term ^ (term >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return _finish(np.add.reduceat(term, starts), bits)


class WordTable:
    """Rows computed once for each distinct word of a task; forgotten when more than ``most`` words are held."""

    def __init__(self, rows: Callable[[list[str]], np.ndarray], pad: np.ndarray, most: int = 400_000):
        self.rows, self.pad, self.most = rows, pad, most
        self.clear()

    def clear(self) -> None:
        self.ids: dict[str, int] = {}
        self.table = np.repeat(self.pad[None, :], 1024, axis=0)  # row 0 is the padding

    def lookup(self, words: list[str]) -> np.ndarray:
        """The table row of every word; new words are computed together."""
        rows = np.fromiter(map(self.ids.get, words, itertools.repeat(-1)), dtype=np.int64, count=len(words))
        missing = np.flatnonzero(rows < 0)
        if not len(missing):
            return rows
        new = list(dict.fromkeys(words[i] for i in missing))
        if self.ids and len(self.ids) + len(new) > self.most:
            self.clear()
            return self.lookup(words)
        first = len(self.ids) + 1
        need = first + len(new)
        if need > len(self.table):
            grown = np.empty((max(need, 2 * len(self.table)), self.table.shape[1]), dtype=self.table.dtype)
            grown[:first] = self.table[:first]
            self.table = grown
        for lo in range(0, len(new), 50_000):
            some = new[lo:lo + 50_000]
            self.table[first + lo:first + lo + len(some)] = self.rows(some)
        self.ids.update(zip(new, range(first, need)))
        rows[missing] = np.fromiter((self.ids[words[i]] for i in missing), dtype=np.int64, count=len(missing))
        return rows


def hash_share(key: str, salt: int) -> F.Column:
    """A number in [0, 1) that follows from the row's key alone."""
    return F.pmod(F.xxhash64(F.col(key), F.lit(salt)), F.lit(1 << 40)) / float(1 << 40)


def sample_per_class(rows: DataFrame, label: str, key: str, most: dict | int, salt: int) -> tuple[DataFrame, dict]:
    """About ``most`` rows of every class (all, if fewer), chosen by the hash of ``key``, and the classes' counts: a
    class's share follows from its count. Only these counts come to the driver."""
    counts = {r[label]: r["n"] for r in rows.groupBy(label).agg(F.count("*").alias("n")).collect()}
    keep = F.lit(False)
    for c, n in counts.items():
        m = most[c] if isinstance(most, dict) else most
        keep = keep | ((F.col(label) == F.lit(c)) & (hash_share(key, salt) < min(1.0, m / n)))
    return rows.where(keep), counts
