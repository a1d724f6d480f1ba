"""Language identification by a linear-chain conditional random field over words.

Affix, n-gram and lexicon features give every word a score for each language; learned transitions join the words of a
chain; forward-backward labels the words of code-switched text. A document's language has the largest mean marginal.
"""

from __future__ import annotations

import pickle
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acoustispark.llm.common import map_texts
from acoustispark.llm.textfeat import LETTERS, WordTable, char_features, sample_per_class, word_hash

BITS, CHAIN = 17, 64
#: Bounds of the training sample: documents of each language, and chains of ``CHAIN`` words of a document.
TRAIN_DOCS, TRAIN_CHAINS, LEXICON, EPOCHS = 400, 4, 2000, 4


class Crf:
    """Weights of hashed features (with a lexicon weight for known words) and transitions between languages."""

    def __init__(self, labels: list[str], lexicon: set[str]):
        self.labels, self.lexicon = labels, lexicon
        n = len(labels)
        self.weights = np.zeros((1 << BITS, n), dtype=np.float32)
        self.lex_weights = np.zeros((1 << 14, n), dtype=np.float32)
        self.trans = np.zeros((n, n), dtype=np.float32)

    def features(self, words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        f, o = char_features(words, BITS, (1, 2, 3), 4)
        known = np.array([i for i, w in enumerate(words) if w.lower() in self.lexicon], dtype=np.int64)
        return f, o, known, word_hash([words[i] for i in known], 14) if len(known) else known

    def scores(self, words: list[str]) -> np.ndarray:
        f, o, known, lex = self.features(words)
        starts = np.searchsorted(o, np.arange(len(words)))
        out = np.add.reduceat(self.weights[f], starts, axis=0)
        out[known] += self.lex_weights[lex]
        return out

    def factors(self, words: list[str]) -> np.ndarray:
        """Word factors, scaled so that the largest is 1."""
        s = self.scores(words)
        return np.exp(np.maximum(s - s.max(axis=1, keepdims=True), -60)).astype(np.float32)

    def marginals(self, factor: np.ndarray, real: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """factor: (time, chain, label); real: (time, chain). Word marginals, and expected transitions."""
        steps, n, k = factor.shape
        move = np.exp(self.trans)
        ahead, back = np.empty_like(factor), np.empty_like(factor)
        a = np.full((n, k), 1.0 / k, dtype=np.float32)
        for t in range(steps):
            a = (a @ move if t else a) * factor[t]
            a /= a.sum(axis=1, keepdims=True)
            ahead[t] = a
        b = np.ones((n, k), dtype=np.float32)
        pairs = np.zeros((k, k))
        for t in range(steps - 1, -1, -1):
            back[t] = b
            if t:
                inner = factor[t] * b
                if self.count_pairs:
                    both = ahead[t - 1][:, :, None] * move[None] * inner[:, None, :]
                    pairs += (both / both.sum(axis=(1, 2), keepdims=True))[real[t]].sum(axis=0)
                b = np.where(real[t][:, None], inner @ move.T, 1.0)
                b /= b.max(axis=1, keepdims=True)
        post = ahead * back
        post /= post.sum(axis=2, keepdims=True)
        return post, pairs

    count_pairs = False


def chains(lens: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For flat words of documents of ``lens`` words: (chain of each word, place in it, first chain of each document)."""
    per = -(-lens // CHAIN)
    first = np.cumsum(per) - per
    pos = np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)
    return np.repeat(first, lens) + pos // CHAIN, pos % CHAIN, first


def layout(ids: np.ndarray, chain: np.ndarray, place: np.ndarray) -> np.ndarray:
    """(time, chain) of word rows; 0 where a chain is shorter."""
    out = np.zeros((CHAIN, int(chain.max()) + 1 if len(chain) else 0), dtype=np.int64)
    out[place, chain] = ids
    return out


def fit(samples: list[tuple[str, list[list[str]]]], seed: int = 7) -> Crf:
    """Train on (language, chains of words): AdaGrad on the chains' log-likelihood. A share of the chains is spliced
    from two documents, so the transitions also see a change of language."""
    labels = sorted({lang for lang, _ in samples})
    counts: dict[str, Counter] = {lang: Counter() for lang in labels}
    for lang, cs in samples:
        counts[lang].update(w.lower() for c in cs for w in c)
    model = Crf(labels, {w for c in counts.values() for w, n in c.most_common(LEXICON) if n > 1})
    data = [(labels.index(lang), c) for lang, cs in samples for c in cs if c]
    if not data:
        return model
    rng = np.random.default_rng(seed)
    vocab = sorted({w for _, c in data for w in c})
    number = {w: i for i, w in enumerate(vocab)}
    lex_of = np.full(len(vocab), -1, dtype=np.int64)
    parts, sizes = [], []
    for lo in range(0, len(vocab), 20_000):  # in pieces, as the features of all words at once are large
        some = vocab[lo:lo + 20_000]
        fs, os_, known, lex = model.features(some)
        parts.append(fs.astype(np.int32))
        sizes.append(np.bincount(os_, minlength=len(some)))
        lex_of[lo + known] = lex
    f = np.concatenate(parts)
    starts = np.concatenate([[0], np.cumsum(np.concatenate(sizes))])
    g2, gl2, gt2 = np.full_like(model.weights, 1e-4), np.full_like(model.lex_weights, 1e-4), np.full_like(model.trans, 1e-2)
    model.count_pairs = True
    for _ in range(EPOCHS):
        order = rng.permutation(len(data))
        for lo in range(0, len(order), 128):
            part = [data[i] for i in order[lo:lo + 128]]
            ids = np.full((CHAIN, len(part)), -1, dtype=np.int64)
            gold = np.zeros((CHAIN, len(part)), dtype=np.int64)
            for j, (lang, c) in enumerate(part):
                words, tags = [number[w] for w in c], [lang] * len(c)
                if j and j % 4 == 0:  # code-switched: the second half comes from another document
                    other = part[j - 1]
                    cut = len(words) // 2
                    tail = [number[w] for w in other[1]][:CHAIN - cut]
                    words, tags = words[:cut] + tail, tags[:cut] + [other[0]] * len(tail)
                ids[:len(words), j], gold[:len(tags), j] = words, tags
            real = ids >= 0
            used, inv = np.unique(ids[real], return_inverse=True)
            lens = starts[used + 1] - starts[used]
            at = np.repeat(starts[used] - (np.cumsum(lens) - lens), lens) + np.arange(lens.sum())
            feats, owner = f[at], np.repeat(np.arange(len(used)), lens)
            score = np.add.reduceat(model.weights[feats], np.cumsum(lens) - lens, axis=0)
            has = lex_of[used] >= 0
            score[has] += model.lex_weights[lex_of[used][has]]
            factor = np.ones((*ids.shape, len(labels)), dtype=np.float32)
            factor[real] = np.exp(np.maximum(score - score.max(axis=1, keepdims=True), -60))[inv]
            post, pairs = model.marginals(factor, real)
            want = np.eye(len(labels), dtype=np.float32)[gold]
            diff = (want - post)[real] / len(part)
            dw = np.stack([np.bincount(inv, diff[:, k], len(used)) for k in range(len(labels))], axis=1)
            seen = np.zeros_like(model.trans)
            follow = real[1:]
            np.add.at(seen, (gold[:-1][follow], gold[1:][follow]), 1.0)
            touched, finv = np.unique(feats, return_inverse=True)
            gw = np.stack([np.bincount(finv, dw[owner, k], len(touched)) for k in range(len(labels))], axis=1)
            g2[touched] += gw ** 2
            model.weights[touched] += 0.2 * gw / np.sqrt(g2[touched])
            np.add.at(gl := np.zeros_like(model.lex_weights), lex_of[used][has], dw[has])
            gl2 += gl ** 2
            model.lex_weights += 0.2 * gl / np.sqrt(gl2)
            gt = (seen - pairs) / len(part)
            gt2 += gt ** 2
            model.trans += (0.1 * gt / np.sqrt(gt2)).astype(np.float32)
    model.count_pairs = False
    return model


def training_sample(docs: DataFrame, usable, doc_id: str, text: str, lang: str) -> DataFrame:
    """(lang, chains): evenly spaced chains of about ``TRAIN_DOCS`` documents of each language."""
    rows = docs.where(usable & F.col(lang).isNotNull() & F.col(text).isNotNull())
    some, _ = sample_per_class(rows.select(doc_id, lang, text), lang, doc_id, TRAIN_DOCS, 11)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for t in b.column(1).to_pylist():
                words = LETTERS.findall(t)
                n = -(-len(words) // CHAIN)
                pick = range(n) if n <= TRAIN_CHAINS else [i * n // TRAIN_CHAINS for i in range(TRAIN_CHAINS)]
                out.append([words[i * CHAIN:(i + 1) * CHAIN] for i in pick])
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(out, pa.list_(pa.list_(pa.string())))], names=["lang", "chains"])

    return some.select(lang, text).mapInArrow(cut, "lang string, chains array<array<string>>")


def _predictor(model: Crf, spans: bool, group_chars: int = 1 << 21):
    def make():
        k = len(model.labels)
        words_of = WordTable(model.factors, np.ones(k, dtype=np.float32)) if k else None

        def group(found: list[list[str]]) -> list:
            lens = np.array([len(w) for w in found], dtype=np.int64)
            some = np.flatnonzero(lens)
            if not len(some) or not k:
                return [None] * len(found)
            ids = words_of.lookup([w for ws in found for w in ws])
            chain, place, first = chains(lens[some])
            grid = layout(ids, chain, place)
            post, _ = model.marginals(words_of.table[grid], grid > 0)
            out: list = [None] * len(found)
            if spans:
                tags = post.argmax(axis=2)[place, chain]
                for i, part in zip(some, np.split(tags, np.cumsum(lens[some])[:-1])):
                    out[i] = part
                return out
            total = (post * (grid > 0)[:, :, None]).sum(axis=0, dtype=np.float64)
            total = np.add.reduceat(total, first, axis=0)
            for i, row in zip(some, total):
                out[i] = (model.labels[int(row.argmax())], min(1.0, float(row.max() / lens[i])))
            return out

        def work(texts: list) -> list:
            out: list = []
            held, chars = [], 0
            for t in texts:
                words = LETTERS.findall(t) if t else []
                if not any(c.isalpha() for w in words for c in w):
                    words = []
                held.append(words)
                chars += len(t or "")
                if chars >= group_chars:
                    out += group(held)
                    held, chars = [], 0
            out += group(held)
            if spans:
                runs = []
                for tags in out:
                    if tags is None:
                        runs.append([])
                        continue
                    cut = np.flatnonzero(np.diff(tags)) + 1
                    edge = [0, *cut.tolist(), len(tags)]
                    runs.append([{"first": a, "last": b - 1, "lang": model.labels[tags[a]]} for a, b in zip(edge, edge[1:])])
                return [runs]
            return [[o[0] if o else "und" for o in out], [o[1] if o else 0.0 for o in out]]

        return work

    return make


def train(docs: DataFrame, usable, doc_id: str = "doc_id", text: str = "text", lang: str = "lang") -> Crf:
    """Fit on the rows where the column ``usable`` holds; only text and non-null language are read. The sample, which is
    bounded, is gathered in one task that trains; the driver gets the model."""
    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = sorted(x for b in batches for x in zip(b.column(0).to_pylist(), b.column(1).to_pylist()))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(fit(rows))], pa.binary())], names=["model"])

    got = training_sample(docs, usable, doc_id, text, lang).repartition(1).mapInArrow(learn, "model binary").collect()
    return pickle.loads(got[0]["model"]) if got else fit([])


def identify(docs: DataFrame, model: Crf, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns but the text and the two new ones), lang_pred and score of every whole text.

    Chains of ``CHAIN`` words cover a text from its first word to its last. A null text, or one without a letter, is
    ``und`` with score 0, as is every text where nothing could be learned. Equal sums go to the first language in
    alphabetical order. Rows are independent, so repeated rows agree and an empty table gives an empty result.
    """
    keep = keep if keep is not None else [c for c in docs.columns if c not in (text, "lang_pred", "score")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, text, lambda: _predictor(shared.value, False)(), "lang_pred string, score double", keep)


def label_spans(docs: DataFrame, model: Crf, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` and ``spans``: runs of words (numbered over the letter words of the text) with their language."""
    keep = keep if keep is not None else [c for c in docs.columns if c not in (text, "spans")]
    shared = docs.sparkSession.sparkContext.broadcast(model)
    return map_texts(docs, text, lambda: _predictor(shared.value, True)(), "spans array<struct<first:int,last:int,lang:string>>", keep)


def fold(doc_id: str, n: int) -> F.Column:
    """crc32 of the id as text, modulo ``n``."""
    return F.crc32(F.col(doc_id).cast("string")) % n
