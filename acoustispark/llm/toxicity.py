"""Toxicity by a bidirectional gated recurrent network with attention pooling, trained in numpy.

A word enters as a hashed word embedding beside the sum of its hashed character n-gram and affix embeddings. All overlapping
windows of a text are scored; a small logistic layer over the sorted window scores gives the document's probability.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acoustispark.llm.common import map_texts
from acoustispark.llm.textfeat import LETTERS, WordTable, char_features, sample_per_class, word_hash

WINDOW, STRIDE = 32, 16
BITS, DIM, HIDDEN, ATTEND = 15, 12, 8, 8
#: Bounds of the training sample: labelled documents of each class, and windows of a document (evenly spaced).
TRAIN_DOCS, TRAIN_WINDOWS, EPOCHS = {1: 1200, 0: 3600}, 12, 5
#: A word or character feature has an embedding of its own if this share of the training documents (and 3) holds it.
LEAST_SHARE = 0.005


def _sig(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


class BiGru:
    """Parameters and the forward and backward passes over (time, window) grids of words."""

    def __init__(self, seed: int = 5):
        rng = np.random.default_rng(seed)
        g = lambda *s, scale=0.1: (rng.standard_normal(s) * scale).astype(np.float32)
        h = HIDDEN
        self.p = {"word": g(1 << BITS, DIM, scale=0.05), "char": g(1 << BITS, DIM, scale=0.05),
                  "wx": g(2 * DIM, 6 * h, scale=0.3), "bx": np.zeros(6 * h, np.float32),
                  "uf": g(h, 3 * h, scale=0.3), "ub": g(h, 3 * h, scale=0.3),
                  "wa": g(2 * h, ATTEND, scale=0.3), "ba": np.zeros(ATTEND, np.float32), "va": g(ATTEND, scale=0.3),
                  "wo": g(2 * h, scale=0.3), "bo": np.full(1, -1.0, np.float32)}
        self.known = {"word": np.ones(1 << BITS, bool), "char": np.ones(1 << BITS, bool)}
        self.doc = np.array([0.0, 1.0, 0.0, 0.0, 0.0])

    def keep_known(self, word: np.ndarray, char: np.ndarray) -> None:
        """Only features that are marked have an embedding; the others stay zero."""
        self.known = {"word": word, "char": char}
        for k, v in self.known.items():
            self.p[k][~v] = 0

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        f, o = char_features(words, BITS, (3, 4), 6)
        return word_hash(words, BITS), f, o

    def feature_lists(self, words: list[str], chunk: int = 20_000) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word hashes, character features of all words one after the other, how many each word has)."""
        parts = []
        for lo in range(0, len(words), chunk):
            some = words[lo:lo + chunk]
            wh, f, o = self.features(some)
            parts.append((wh.astype(np.int32), f.astype(np.int32), np.bincount(o, minlength=len(some))))
        return tuple(np.concatenate(x) for x in zip(*parts))

    def inputs(self, wh: np.ndarray, f: np.ndarray, o: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Word inputs, and the scale of each word's character part."""
        n = np.bincount(o, minlength=len(wh))
        starts = np.cumsum(n) - n
        x = np.empty((len(wh), 2 * DIM), dtype=np.float32)
        x[:, :DIM] = self.p["word"][wh]
        scale = (1 / np.sqrt(np.maximum(n, 1))).astype(np.float32)
        some = n > 0
        x[:, DIM:] = 0
        if some.any():
            x[some, DIM:] = np.add.reduceat(self.p["char"][f], starts[some], axis=0) * scale[some, None]
        return x, scale

    def gates(self, words: list[str]) -> np.ndarray:
        """The input part of both directions' gates of each word; scoring looks it up."""
        return self.inputs(*self.features(words))[0] @ self.p["wx"] + self.p["bx"]

    def _run(self, gx: np.ndarray, u: np.ndarray, real: np.ndarray, steps: range, keep: bool):
        h = HIDDEN
        state = np.zeros((gx.shape[1], h), dtype=np.float32)
        out, past = np.empty((*gx.shape[:2], h), dtype=np.float32), {}
        for t in steps:
            hu = state @ u
            zr = _sig(gx[t, :, :2 * h] + hu[:, :2 * h])
            z, r = zr[:, :h], zr[:, h:]
            cand = np.tanh(gx[t, :, 2 * h:] + r * hu[:, 2 * h:])
            new = cand + z * (state - cand)
            if keep:
                past[t] = (state, z, r, cand, hu[:, 2 * h:])
            state = np.where(real[t][:, None], new, state)
            out[t] = state
        return out, past

    def forward(self, gx: np.ndarray, real: np.ndarray, keep: bool = False):
        """Window logits; with ``keep`` also what the backward pass needs."""
        p, h, steps = self.p, HIDDEN, gx.shape[0]
        hf, pf = self._run(gx[:, :, :3 * h], p["uf"], real, range(steps), keep)
        hb, pb = self._run(gx[:, :, 3 * h:], p["ub"], real, range(steps - 1, -1, -1), keep)
        hh = np.concatenate([hf, hb], axis=2)
        att = np.tanh(hh @ p["wa"] + p["ba"])
        s = np.where(real, att @ p["va"], -1e9)
        a = np.exp(s - s.max(axis=0))
        a /= a.sum(axis=0)
        pooled = (a[:, :, None] * hh).sum(axis=0)
        logit = pooled @ p["wo"] + p["bo"][0]
        return logit, (hh, att, a, pooled, pf, pb)

    def backward(self, gx: np.ndarray, real: np.ndarray, held: tuple, dlogit: np.ndarray) -> tuple[dict, np.ndarray]:
        p, h = self.p, HIDDEN
        hh, att, a, pooled, pf, pb = held
        g = {"wo": pooled.T @ dlogit, "bo": dlogit.sum(keepdims=True)}
        dpool = dlogit[:, None] * p["wo"]
        dhh = a[:, :, None] * dpool
        da = (hh * dpool).sum(axis=2)
        ds = a * (da - (a * da).sum(axis=0))
        datt = ds[:, :, None] * p["va"] * (1 - att ** 2)
        g["va"] = np.einsum("tb,tbk->k", ds, att)
        g["wa"] = np.einsum("tbi,tbk->ik", hh, datt)
        g["ba"] = datt.sum(axis=(0, 1))
        dhh = dhh + datt @ p["wa"].T
        dgx = np.zeros_like(gx)
        for name, past, lo, steps in (("uf", pf, 0, range(gx.shape[0] - 1, -1, -1)), ("ub", pb, 1, range(gx.shape[0]))):
            u, du = p[name], np.zeros_like(p[name])
            carry = np.zeros((gx.shape[1], h), dtype=np.float32)
            for t in steps:
                d = dhh[t, :, lo * h:(lo + 1) * h] + carry
                m = real[t][:, None]
                state, z, r, cand, hun = past[t]
                dc = np.where(m, d, 0)
                dz = dc * (state - cand) * z * (1 - z)
                dn = dc * (1 - z) * (1 - cand ** 2)
                dr = dn * hun * r * (1 - r)
                dhu = np.concatenate([dz, dr, dn * r], axis=1)
                dgx[t, :, 3 * h * lo:3 * h * (lo + 1)] = np.concatenate([dz, dr, dn], axis=1)
                du += state.T @ dhu
                carry = dc * z + dhu @ u.T + np.where(m, 0, d)
            g[name] = du
        return g, dgx

    def probability(self, logits: np.ndarray) -> float:
        """Of a document from its window logits (none: no words)."""
        return float(_sig(np.clip(self.doc[0] + doc_features(logits) @ self.doc[1:], -40, 40)))


def doc_features(logits: np.ndarray) -> np.ndarray:
    """The largest window logit, the mean of the largest four, the share of positive windows, and the log of their number."""
    if not len(logits):
        return np.array([-4.0, -4.0, 0.0, 0.0])
    top = np.sort(logits)[::-1][:4]
    return np.array([top[0], top.mean(), (logits > 0).mean() * 4, np.log1p(len(logits)) / 2])


def spans(n: int) -> list[tuple[int, int]]:
    """All overlapping windows of ``n`` words: every ``STRIDE`` words, until the end is covered."""
    return [(s, min(n, s + WINDOW)) for s in range(0, max(1, n - WINDOW + STRIDE), STRIDE)] if n else []


def fit(samples: Iterable[tuple[int, list[str]]], counts_of: dict | None = None, seed: int = 5) -> BiGru:
    """Train on (label, words of the whole text); ``counts_of`` has how many rows of each class the sample stands for. Windows take their document's label at first; later epochs keep, of a
    positive document, the half of the windows that score highest. Then the document layer is fitted on all windows."""
    model, rng = BiGru(seed), np.random.default_rng(seed)
    number: dict[str, int] = {}
    docs, keys = [], []
    for y, ws in samples:  # numbers take the place of the words at once
        docs.append(np.fromiter((number.setdefault(w, len(number)) for w in ws), dtype=np.int32, count=len(ws)))
        keys.append((int(y), zlib.crc32(" ".join(ws).encode())))
    order = sorted(range(len(docs)), key=keys.__getitem__)  # the same whatever order the rows came in
    docs, labels = [docs[i] for i in order], np.array([keys[i][0] for i in order])
    if not number or len(set(labels.tolist())) < 2:
        model.doc = np.array([-2.0, 0.0, 0.0, 0.0, 0.0])
        return model
    wh, f, counts = model.feature_lists(list(number))
    starts = np.cumsum(counts) - counts
    wins, owner = [], []
    for i, d in enumerate(docs):
        s = spans(len(d))
        for j in range(len(s)) if len(s) <= TRAIN_WINDOWS else [k * len(s) // TRAIN_WINDOWS for k in range(TRAIN_WINDOWS)]:
            wins.append(d[s[j][0]:s[j][1]])
            owner.append(i)
    held = {"word": np.zeros(1 << BITS, np.int64), "char": np.zeros(1 << BITS, np.int64)}
    for d in docs:
        mine = np.unique(d)
        n = counts[mine]
        at = np.repeat(starts[mine] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        held["word"][np.unique(wh[mine])] += 1
        held["char"][np.unique(f[at])] += 1
    least = max(3, LEAST_SHARE * len(docs))
    model.keep_known(held["word"] >= least, held["char"] >= least)
    owner = np.array(owner)
    grid = np.full((WINDOW, len(wins)), -1, dtype=np.int32)
    for j, w in enumerate(wins):
        grid[:len(w), j] = w
    active = np.arange(len(wins))
    state = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in model.p.items()}
    step = 0

    def gates_of(ids: np.ndarray):
        used, inv = np.unique(ids, return_inverse=True)
        n = counts[used]
        at = np.repeat(starts[used] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        fo, oo = f[at], np.repeat(np.arange(len(used)), n)
        x, scale = model.inputs(wh[used], fo, oo)
        return used, inv.reshape(ids.shape), x, scale, fo, oo

    def logits_of(sel: np.ndarray) -> np.ndarray:
        out = np.empty(len(sel), dtype=np.float32)
        for lo in range(0, len(sel), 4096):
            ids = grid[:, sel[lo:lo + 4096]]
            real = ids >= 0
            _, inv, x, *_ = gates_of(np.where(real, ids, 0))
            out[lo:lo + 4096] = model.forward((x @ model.p["wx"] + model.p["bx"])[inv], real)[0]
        return out

    for epoch in range(EPOCHS):
        if epoch >= 2:
            score = logits_of(np.arange(len(wins)))
            keep = labels[owner] == 0
            for i in np.flatnonzero(labels == 1):
                mine = np.flatnonzero(owner == i)
                keep[mine[np.argsort(-score[mine])[:max(1, (len(mine) + 1) // 2)]]] = True
            active = np.flatnonzero(keep)
        order = rng.permutation(active)
        rate = 0.01 if epoch < EPOCHS - 2 else 0.003
        share = max(labels[owner[active]].mean(), 1e-3)
        weight = np.where(labels[owner] == 1, 0.5 / share, 0.5 / (1 - share)).astype(np.float32)
        for lo in range(0, len(order), 512):
            sel = order[lo:lo + 512]
            ids = grid[:, sel]
            real = ids >= 0
            used, inv, x, scale, fo, oo = gates_of(np.where(real, ids, 0))
            gx = (x @ model.p["wx"] + model.p["bx"])[inv]
            logit, held = model.forward(gx, real, True)
            dlogit = ((_sig(logit) - labels[owner[sel]]) * weight[sel] / len(sel)).astype(np.float32)
            grad, dgx = model.backward(gx, real, held, dlogit)
            flat = np.zeros((len(used), dgx.shape[2]), dtype=np.float32)
            np.add.at(flat, inv[real], dgx[real])
            grad["wx"], grad["bx"] = x.T @ flat, flat.sum(axis=0)
            dx = flat @ model.p["wx"].T
            grad["word"] = np.zeros_like(model.p["word"])
            np.add.at(grad["word"], wh[used], dx[:, :DIM])
            grad["char"] = np.stack([np.bincount(fo, (dx[:, DIM + k] * scale)[oo], 1 << BITS) for k in range(DIM)], axis=1)
            for k, known in model.known.items():
                grad[k][~known] = 0
            step += 1
            for k, v in model.p.items():  # Adam
                m, s = state[k]
                m += 0.1 * (grad[k] - m)
                s += 0.001 * (grad[k] ** 2 - s)
                v -= (rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)).astype(v.dtype)
    _fit_documents(model, docs, labels, gates_of)
    if counts_of:  # the sample holds more of the rarer class
        model.doc[0] += np.log(counts_of[1] / counts_of[0]) - np.log(labels.sum() / (len(labels) - labels.sum()))
    return model


def _fit_documents(model: BiGru, docs: list[np.ndarray], labels: np.ndarray, gates_of) -> None:
    """The logistic layer over a document's window logits, by Newton steps with a small ridge."""
    feats = []
    for d in docs:
        s = spans(len(d))
        if not s:
            feats.append(doc_features(np.empty(0)))
            continue
        ids = np.full((WINDOW, len(s)), -1, dtype=np.int64)
        for j, (a, b) in enumerate(s):
            ids[:b - a, j] = d[a:b]
        real = ids >= 0
        _, inv, x, *_ = gates_of(np.where(real, ids, 0))
        feats.append(doc_features(model.forward((x @ model.p["wx"] + model.p["bx"])[inv], real)[0]))
    x = np.column_stack([np.ones(len(feats)), np.array(feats)])
    w = np.zeros(x.shape[1])
    for _ in range(30):
        pr = _sig(x @ w)
        hess = (x * (pr * (1 - pr))[:, None]).T @ x + 0.5 * np.eye(len(w))
        w += np.linalg.solve(hess, x.T @ (labels - pr) - 0.5 * w)
    model.doc = w


def training_sample(docs: DataFrame, labels: DataFrame, usable, doc_id: str, text: str, toxic: str) -> tuple[Iterator, dict]:
    """(label, words) of about ``TRAIN_DOCS`` labelled documents of each class, and the classes' counts; only these
    come to the driver."""
    marks = labels.where(usable & F.col(toxic).isin(0, 1)).groupBy(doc_id).agg(F.max(toxic).alias("y"))
    some, counts = sample_per_class(marks, "y", doc_id, TRAIN_DOCS, 13)
    # the sample is bounded by TRAIN_DOCS, so its ids go to the documents rather than the texts to a shuffle
    rows = docs.select(doc_id, text).join(F.broadcast(some), doc_id)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            words = [LETTERS.findall((t or "").lower()) for t in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(words, pa.list_(pa.string()))], names=["y", "words"])

    got = rows.select(F.col("y").cast("int"), text).mapInArrow(cut, "y int, words array<string>").toLocalIterator()
    return ((r["y"], r["words"]) for r in got), counts


def train(docs: DataFrame, labels: DataFrame, usable, doc_id: str = "doc_id", text: str = "text", toxic: str = "toxic") -> BiGru:
    """Fit on the labelled rows where the column ``usable`` (over ``labels``) holds. A document with several labels
    counts as toxic if one says so; labels other than 0 and 1, and labels without a document, are not used."""
    return fit(*training_sample(docs, labels, usable, doc_id, text, toxic))


def _scorer(model: BiGru, group_chars: int = 1 << 21):
    def make():
        words_of = WordTable(model.gates, np.zeros(6 * HIDDEN, dtype=np.float32))

        def group(found: list[list[str]]) -> list[float]:
            ids = words_of.lookup([w for ws in found for w in ws])
            ends = np.cumsum([len(w) for w in found])
            per, cells = [], []
            for e, ws in zip(ends, found):
                s = spans(len(ws))
                per.append(len(s))
                cells += [(e - len(ws) + a, e - len(ws) + b) for a, b in s]
            logits = np.empty(len(cells), dtype=np.float32)
            for lo in range(0, len(cells), 8192):
                a, b = np.array(cells[lo:lo + 8192], dtype=np.int64).reshape(-1, 2).T
                at = a[None, :] + np.arange(WINDOW)[:, None]
                real = at < b[None, :]
                grid = ids[np.where(real, at, 0)]
                logits[lo:lo + 8192] = model.forward(words_of.table[np.where(real, grid, 0)], real)[0]
            return [model.probability(x) for x in np.split(logits, np.cumsum(per)[:-1])] if per else []

        def work(texts: list) -> list:
            out: list[float] = []
            held, chars = [], 0
            for t in texts:
                held.append(LETTERS.findall(t.lower()) if t else [])
                chars += len(t or "")
                if chars >= group_chars:
                    out += group(held)
                    held, chars = [], 0
            return [out + group(held)]

        return work

    return make


def score(docs: DataFrame, model: BiGru, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns but the text and the two new ones), score and predicted (1 from 0.5 on).

    Every word lies in a scored window, so whole texts count. Null texts and texts without letters get the score of a
    document without windows. Rows are independent: repeated rows agree, an empty table gives an empty result.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c not in (text, "score", "predicted")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    out = map_texts(docs, text, lambda: _scorer(shared.value)(), "score double", keep)
    return out.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
