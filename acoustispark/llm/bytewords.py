"""Words of many texts as arrays: 64-bit hashes of the words, taken from the UTF-8 bytes without Python strings."""

from __future__ import annotations

import numpy as np

_SEED = np.random.default_rng(20240229)
_BYTE = _SEED.integers(1 << 62, size=256, dtype=np.uint64) * np.uint64(4) + np.uint64(1)
_STEP = np.uint64(0x9E3779B97F4A7C15)
#: Odd multipliers of the places in a sequence of words.
PLACE = _SEED.integers(1 << 62, size=64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def _powers(n: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return np.multiply.accumulate(np.full(max(n, 1), _STEP, dtype=np.uint64))


def _chunk(raws: list[bytes], lower: bool) -> tuple[np.ndarray, np.ndarray]:
    data = np.frombuffer(b" ".join(raws) + b" ", dtype=np.uint8)
    blank = (data == 32) | ((data - np.uint8(9)) <= 4)
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if len(data) and not blank[0]:
        edge = np.concatenate([[0], edge])
    starts, ends = edge[0::2], edge[1::2]
    doc_ends = np.cumsum([len(r) + 1 for r in raws])
    per_doc = np.diff(np.searchsorted(starts, doc_ends), prepend=0)
    if not len(starts):
        return np.empty(0, dtype=np.uint64), per_doc
    body = data[~blank]
    if lower:
        body = np.where((body >= 65) & (body <= 90), body + np.uint8(32), body)
    lens = ends - starts
    first = np.cumsum(lens) - lens
    place = np.arange(len(body)) - np.repeat(first, lens)
    with np.errstate(over="ignore"):
        term = _BYTE[body] * _powers(int(lens.max()))[place]
        return mix(np.add.reduceat(term, first) + lens.astype(np.uint64)), per_doc


def word_hashes(raws: list[bytes], lower: bool = False, chunk: int = 1 << 21) -> tuple[np.ndarray, np.ndarray]:
    """(hash of every word, number of words of every text). Words are runs of bytes other than 20 and 09-0D;
    ``lower`` maps A-Z to a-z first. Texts are hashed in chunks of about ``chunk`` bytes."""
    hashes, counts, held, size = [], [], [], 0
    for r in raws:
        held.append(r)
        size += len(r)
        if size >= chunk:
            h, n = _chunk(held, lower)
            hashes.append(h)
            counts.append(n)
            held, size = [], 0
    if held:
        h, n = _chunk(held, lower)
        hashes.append(h)
        counts.append(n)
    if not hashes:
        return np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
    return np.concatenate(hashes), np.concatenate(counts).astype(np.int64)


def runs(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` consecutive words of a flat array (runs over text borders are included)."""
    if len(words) < n:
        return np.empty(0, dtype=np.uint64)
    with np.errstate(over="ignore"):
        h = words[:len(words) - n + 1] * PLACE[0]
        for i in range(1, n):
            h = h + words[i:len(words) - n + 1 + i] * PLACE[i]
    return mix(h + np.uint64(n))


def pack48(keys: np.ndarray) -> bytes:
    """The low 48 bits of each key, six bytes each."""
    return np.ascontiguousarray(keys.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :6]).tobytes()


def unpack48(raw: bytes) -> np.ndarray:
    six = np.frombuffer(raw, dtype=np.uint8).reshape(-1, 6)
    out = np.zeros((len(six), 8), dtype=np.uint8)
    out[:, :6] = six
    return out.view("<u8").ravel()
