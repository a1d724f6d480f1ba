"""Text quality by positive-unlabelled learning.

Only documents marked good are trusted; the web text at large is unlabelled. First networks, one
for each half of the sample, tell trusted from unlabelled text; the share of good text among the unlabelled (the class
prior) is the least ratio of the two score tails, each row scored by the network that has not seen it. A last network minimises the non-negative unbiased risk: what the unlabelled part costs as bad text, less what its good share
costs as such, is not let below zero. Its log-odds are the document's quality.
"""

from __future__ import annotations

import pickle
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acoustispark.llm.common import map_texts, staged
from acoustispark.llm.textfeat import hash_share

#: Bounds of the training sample: trusted documents, and unlabelled ones. The prior is estimated over all of both.
TRUSTED, UNLABELLED = 6000, 12_000
HIDDEN, EPOCHS, BATCH, BINS = 24, 40, 512, 400
SYMBOLS = "!?#$%&*|@/_=<>{}\\^~+"
KINDS = 8
WIDTH = KINDS * KINDS + len(SYMBOLS) + 11
_MULT = np.uint64(0x9E3779B97F4A7C15)


def _kind_table() -> np.ndarray:
    """Kind of every code point of the basic plane: lower or caseless letter, capital, digit, blank, line end, sentence mark,
    other ASCII, all else."""
    def kind(c: str) -> int:
        if c in "\n\r":
            return 4
        if c.isspace():
            return 3
        if c.isalpha():
            return 1 if c.isupper() else 0
        if c.isdigit():
            return 2
        return 5 if c in ".,;:?!'\"()-" else 6 if c < "\x80" else 7

    return np.array([kind(chr(i)) for i in range(1 << 16)], dtype=np.int8)


def _runs(inside: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of marked characters; ``first`` marks where a new text begins."""
    before = np.concatenate([[False], inside[:-1]]) & ~first
    after = np.concatenate([inside[1:] & ~first[1:], [False]])
    return np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1


def _hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each run of characters."""
    n = ends - starts
    at = np.repeat(starts - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pos = at - np.repeat(starts, n)
    with np.errstate(over="ignore"):
        term = (flat[at].astype(np.uint64) + np.uint64(1)) * ((pos.astype(np.uint64) * np.uint64(2) + np.uint64(1)) * _MULT)
        term = (term ^ (term >> np.uint64(32))) * np.uint64(0x94D049BB133111EB)
        return np.add.reduceat(term, np.cumsum(n) - n) if len(n) else term


def _distinct(owner: np.ndarray, h: np.ndarray, n_docs: int) -> tuple[np.ndarray, np.ndarray]:
    """How many different hashes each document has, and how often its commonest stands."""
    order = np.lexsort((h, owner))
    o, v = owner[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (o[1:] != o[:-1]) | (v[1:] != v[:-1])])) if len(o) else np.empty(0, np.int64)
    size = np.diff(np.concatenate([new, [len(o)]]))
    most = np.zeros(n_docs)
    np.maximum.at(most, o[new], size)
    return np.bincount(o[new], minlength=n_docs), most


class Features:
    """Numbers of whole texts: shares of neighbouring kinds of characters and of symbols, word lengths, and how much of the
    words, word pairs and lines repeats."""

    def __init__(self):
        self.kinds = _kind_table()

    def __call__(self, texts: list[str]) -> np.ndarray:
        n = len(texts)
        out = np.zeros((n, WIDTH), dtype=np.float32)
        flat = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), dtype="<u4")
        if not len(flat):
            return out
        lens = np.fromiter(map(len, texts), dtype=np.int64, count=n)
        owner = np.repeat(np.arange(n), lens)
        kind = self.kinds[np.minimum(flat, 0xFFFF)].astype(np.int64)
        same = owner[1:] == owner[:-1]
        pair = (owner[1:] * KINDS * KINDS + kind[:-1] * KINDS + kind[1:])[same]
        size = np.maximum(lens, 1)[:, None]
        out[:, :KINDS * KINDS] = np.bincount(pair, minlength=n * KINDS * KINDS).reshape(n, -1) / size
        table = np.zeros(128, dtype=np.int64)
        table[[ord(c) for c in SYMBOLS]] = np.arange(1, len(SYMBOLS) + 1)
        sym = table[np.minimum(flat, 127)] * (flat < 128)
        k = len(SYMBOLS) + 1
        out[:, KINDS * KINDS:KINDS * KINDS + k - 1] = np.bincount(owner * k + sym, minlength=n * k).reshape(n, k)[:, 1:] / size
        first = np.zeros(len(flat), dtype=bool)
        first[(np.cumsum(lens) - lens)[lens > 0]] = True
        ws, we = _runs((kind != 3) & (kind != 4), first)
        ls, le = _runs(kind != 4, first)
        wo, lo = owner[ws], owner[ls]
        words, lines = np.bincount(wo, minlength=n), np.bincount(lo, minlength=n)
        some, long = np.maximum(words, 1), (we - ws).astype(np.float64)
        h = _hashes(flat, ws, we)
        mean = np.bincount(wo, long, n) / some
        kinds, most = _distinct(wo, h, n)
        follow = wo[1:] == wo[:-1]
        with np.errstate(over="ignore"):
            two = (h[:-1] * _MULT + h[1:])[follow]
        pairs = np.maximum(np.bincount(wo[1:][follow], minlength=n), 1)
        extra = [np.log1p(words), np.log1p(mean), np.sqrt(np.maximum(np.bincount(wo, long ** 2, n) / some - mean ** 2, 0)) / 4,
                 kinds / some, most / some, np.bincount(wo[1:][follow & (h[1:] == h[:-1])], minlength=n) / pairs,
                 _distinct(wo[1:][follow], two, n)[0] / pairs, lines / some, _distinct(lo, _hashes(flat, ls, le), n)[0] / np.maximum(lines, 1),
                 np.bincount(wo[kind[we - 1] == 5], minlength=n) / some, np.bincount(wo[kind[we - 1] == 6], minlength=n) / some]
        out[:, -len(extra):] = np.column_stack(extra)
        return out


def with_features(docs: DataFrame, text: str = "text", keep: list[str] | None = None, group_chars: int = 1 << 21) -> DataFrame:
    """``keep`` (default: all columns but the text) and ``features``, 32-bit floats of each whole text as bytes. A null
    text counts as an empty one: all zeros."""
    keep = keep if keep is not None else [c for c in docs.columns if c not in (text, "features")]

    def make():
        numbers = Features()

        def work(texts: list) -> list:
            out: list[bytes] = []
            held, chars = [], 0
            for i, t in enumerate(texts):
                held.append(t or "")
                chars += len(held[-1])
                if chars >= group_chars or i == len(texts) - 1:
                    out += [row.tobytes() for row in numbers(held)]
                    held, chars = [], 0
            return [out]

        return work

    return map_texts(docs, text, make, "features binary", keep)


def softplus(z: np.ndarray) -> np.ndarray:
    return np.logaddexp(0, z)


def _sig(z: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * z))


class Net:
    """One hidden layer over standardised features; the output is a log-odds."""

    def __init__(self, mean: np.ndarray, scale: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.mean, self.scale = mean, scale
        self.p = {"w1": rng.standard_normal((len(mean), HIDDEN)) / np.sqrt(len(mean)), "b1": np.zeros(HIDDEN),
                  "w2": rng.standard_normal(HIDDEN) / np.sqrt(HIDDEN), "b2": np.zeros(1)}

    def standard(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -5, 5)

    def logit(self, z: np.ndarray) -> np.ndarray:
        return np.tanh(z @ self.p["w1"] + self.p["b1"]) @ self.p["w2"] + self.p["b2"][0]

    def gradient(self, z: np.ndarray, d: np.ndarray) -> dict:
        h = np.tanh(z @ self.p["w1"] + self.p["b1"])
        dh = d[:, None] * self.p["w2"] * (1 - h ** 2)
        return {"w1": z.T @ dh, "b1": dh.sum(axis=0), "w2": h.T @ d, "b2": d.sum(keepdims=True)}

    def scores(self, x: np.ndarray) -> np.ndarray:
        return _sig(self.logit(self.standard(x)))


def unbiased_risk(zp: np.ndarray, zu: np.ndarray, prior: float) -> tuple[float, float]:
    """(risk of the trusted as good text, unlabelled risk as bad text less the good share's), by logistic loss."""
    return prior * softplus(-zp).mean(), softplus(zu).mean() - prior * softplus(zp).mean()


def risk_slopes(zp: np.ndarray, zu: np.ndarray, prior: float, least: float = 0.0) -> tuple[np.ndarray, np.ndarray]:
    """How the non-negative risk falls and rises with the log-odds of the trusted and the unlabelled rows. Where the bad
    part has gone below ``-least``, the step goes back up that part alone."""
    back_p, back_u = -prior * _sig(zp) / len(zp), _sig(zu) / len(zu)
    if unbiased_risk(zp, zu, prior)[1] < -least:
        return -back_p, -back_u
    return -prior * _sig(-zp) / len(zp) + back_p, back_u


def _train(xp: np.ndarray, xu: np.ndarray, slopes, seed: int) -> Net:
    """Adam over batches that hold equal shares of the trusted and the unlabelled rows."""
    rng = np.random.default_rng(seed)
    net = Net(xu.mean(axis=0), xu.std(axis=0) + 1e-3, seed)
    zp, zu = net.standard(xp), net.standard(xu)
    state, step = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.p.items()}, 0
    batches = max(1, len(zu) // BATCH)
    for epoch in range(EPOCHS):
        rate = 0.003 if epoch < EPOCHS * 3 // 4 else 0.0005
        for ip, iu in zip(np.array_split(rng.permutation(len(zp)), batches), np.array_split(rng.permutation(len(zu)), batches)):
            if not len(ip) or not len(iu):
                continue
            both = np.concatenate([zp[ip], zu[iu]])
            out = net.logit(both)
            grad = net.gradient(both, np.concatenate(slopes(out[:len(ip)], out[len(ip):])))
            step += 1
            for k, v in net.p.items():
                m, s = state[k]
                g = grad[k] + 1e-4 * v
                m += 0.1 * (g - m)
                s += 0.001 * (g ** 2 - s)
                v -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(s / (1 - 0.999 ** step)) + 1e-8)
    return net


def separate(cells: tuple[list[bytes], list[bytes]], seed: int = 3) -> tuple[Net, ...]:
    """For each half of the rows, the network that has learned from the other half to tell trusted from unlabelled text
    (logistic loss). Equal rows are in one half."""
    halves = [_halves(c) for c in cells]
    xs = [_array(c) for c in cells]
    return tuple(_train(*[x[h != mine] if (h != mine).any() else x for x, h in zip(xs, halves)],
                        lambda zp, zu: (-_sig(-zp) / len(zp), _sig(zu) / len(zu)), seed) for mine in (0, 1))


def _halves(cells: list[bytes]) -> np.ndarray:
    return np.array([zlib.crc32(c) & 1 for c in cells], dtype=np.int64)


def unseen_scores(nets: tuple[Net, ...], cells: list[bytes]) -> np.ndarray:
    x, h, out = _array(cells), _halves(cells), np.empty(len(cells))
    for mine, net in enumerate(nets):
        out[h == mine] = net.scores(x[h == mine])
    return out


def fit(xp: np.ndarray, xu: np.ndarray, prior: float, seed: int = 3) -> Net:
    """The last network: least non-negative risk under the class prior."""
    return _train(xp, xu, lambda zp, zu: risk_slopes(zp, zu, prior), seed)


def class_prior(trusted: np.ndarray, unlabelled: np.ndarray) -> float:
    """The share of good text among the unlabelled, from both histograms of the first networks' scores: above any score lie at
    least ``prior`` times as many unlabelled as trusted ones, so the least ratio of the tails is the best bound. The tails are
    taken with their sampling error (one part in a hundred to be wrong), which keeps empty ones out."""
    p, u = trusted[::-1].cumsum() / max(1, trusted.sum()), unlabelled[::-1].cumsum() / max(1, unlabelled.sum())
    err = np.sqrt(np.log(200) / 2 / max(1, trusted.sum())) + np.sqrt(np.log(200) / 2 / max(1, unlabelled.sum()))
    ok = p > 0
    if not ok.any():
        return 0.5
    at = int(np.argmin((u[ok] + err) / p[ok]))
    return float(np.clip(u[ok][at] / p[ok][at], 0.01, 0.99))


def _array(cells: list) -> np.ndarray:
    return np.frombuffer(b"".join(cells), dtype=np.float32).reshape(-1, WIDTH).astype(np.float64)


def _in_a_task(sample: DataFrame, make) -> object:
    """What ``make(trusted cells, unlabelled cells)`` gives for the bounded sample (kind, features), computed in one
    task; the driver gets the result alone. Rows are sorted, so their order does not matter."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        trusted, web = ([f for k, f in rows if k == kind] for kind in (1, 0))
        made = make(trusted, web) if trusted and web else None
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made)], pa.binary())], names=["model"])

    got = sample.repartition(1).mapInArrow(learn, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else None


def train(feats: DataFrame, labels: DataFrame, usable, doc_id: str = "doc_id", quality: str = "quality") -> tuple[Net | None, float]:
    """(network, class prior) from ``feats`` (``doc_id``, ``usable`` and ``features``). Trusted are the documents that
    ``labels`` marks 1 and no label 0, where the column ``usable`` over ``labels`` holds; the rows of ``feats`` with
    ``usable`` are the unlabelled text. Labels of 0 are not learned from. Without trusted or unlabelled rows there
    is no network."""
    marks = labels.where(usable & F.col(quality).isNotNull()).groupBy(F.col(doc_id).alias("id")).agg(F.min(quality).alias("lo"), F.max(quality).alias("hi"))
    good = marks.where("lo = 1 and hi = 1").select("id")
    web = feats.where(F.col("usable")).select(F.col(doc_id).alias("id"), "features")
    trusted = staged(web.join(good, "id").select("id", "features"), "trusted")
    n_p, n_u = trusted.count(), web.count()
    if not n_p or not n_u:
        return None, 0.5
    some = trusted.where(hash_share("id", 31) < min(1.0, TRUSTED / n_p)).select(F.lit(1).alias("kind"), "features")
    share = F.pmod(F.xxhash64("features", F.lit(37)), F.lit(1 << 40)) / float(1 << 40)  # copies together, ids may repeat
    rest = web.where(F.when(F.col("id").isNull(), share).otherwise(hash_share("id", 37)) < min(1.0, UNLABELLED / n_u))
    sample = staged(some.unionByName(rest.select(F.lit(0).alias("kind"), "features")), "sample")
    first = _in_a_task(sample, lambda p, u: separate((p, u)))
    if first is None:
        return None, 0.5
    shared = feats.sparkSession.sparkContext.broadcast(first)

    def bins(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            s = unseen_scores(shared.value, b.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(np.minimum((s * BINS).astype(np.int32), BINS - 1))], names=["bin"])

    def histogram(df: DataFrame) -> np.ndarray:
        out = np.zeros(BINS)
        for r in df.select("features").mapInArrow(bins, "bin int").groupBy("bin").agg(F.count("*").alias("n")).collect():
            out[r["bin"]] = r["n"]
        return out

    prior = class_prior(histogram(trusted), histogram(web))
    return _in_a_task(sample, lambda p, u: fit(_array(p), _array(u), prior)), prior


def score(feats: DataFrame, model: Net | None, prior: float = 0.5, keep: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """``keep`` (default: all but features and the new columns), score and predicted (1 from ``threshold`` on).

    Null and empty texts have the features of an empty text and its score. Without a network every row has the prior as its
    score. Rows are independent: repeated rows agree, an empty table gives an empty result.
    """
    keep = keep if keep is not None else [c for c in feats.columns if c not in ("features", "score", "predicted")]
    shared = feats.sparkSession.sparkContext.broadcast(model)

    def make():
        net = shared.value
        return lambda cells: [net.scores(_array(cells)).tolist() if net is not None and cells else [prior] * len(cells)]

    return map_texts(feats, "features", make, "score double", keep).withColumn("predicted", (F.col("score") >= threshold).cast("int"))
