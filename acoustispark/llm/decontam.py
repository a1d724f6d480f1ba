"""Benchmark decontamination by latent semantic retrieval.

Passages of the benchmark are TF-IDF rows (document frequencies come from the whole corpus, outside of what repeats an
item); a distributed randomised SVD gives their latent space. Every overlapping window of every document is folded in.
Windows near an item's passage in cosine are candidates, and, whatever the weights, windows that repeat its word runs; the
result says which of the two found a row. Windows whose words cannot reach a passage are known by a sum of one number a
word and are not folded in. A candidate counts as a leak if the longest common subsequence of words with the item, and the
item's answer, are found in the document around it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acoustispark.llm.bytewords import runs, word_hashes
from acoustispark.llm.common import map_texts

#: Words of a window, and of the step between windows (a third, so that a window is three steps).
WINDOW, STEP = 48, 16
RANK, OVERSAMPLE, POWER = 256, 16, 2
#: Words of a run that a copy of an item repeats.
RUN = 3
#: Bytes of latent vectors that travel with the tasks, at most; a larger benchmark is judged in parts.
MOST_BYTES = 1 << 30

# Punctuation separates words here, and case does not count, so that quotes and sentence ends do not hide a match.
_NORMAL = bytes(32 if c < 128 and not chr(c).isalnum() else c for c in range(256))
_SENTENCE = re.compile(r"[.!?]+\s+")


@dataclass(frozen=True)
class Params:
    """``cosine``: least similarity of a candidate, and ``cover``: least share of the passage's own length in its direction; ``common``: share of the item's words in common that is a leak by
    itself; ``near``: share that is a leak if also ``answer`` of the answer's words are found; ``stop``: terms in a
    larger share of the documents are common and weigh ``floor``; ``hits``: least other terms in a window, or as many as
    the item with the fewest has; ``runs``: share of an item's word runs that makes a window a candidate by itself."""

    cosine: float = 0.4
    cover: float = 0.45
    common: float = 0.8
    near: float = 0.55
    answer: float = 0.6
    stop: float = 0.1
    hits: int = 3
    floor: float = 0.25
    runs: float = 0.25


def normal_words(texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the lower-cased words of all texts, words of each)."""
    return word_hashes([(t or "").lower().encode().translate(_NORMAL) for t in texts])


def answer_of(text: str) -> str:
    """The last sentence, or of a single sentence the last third of its words."""
    parts = [p for p in _SENTENCE.split(text.strip()) if p.strip()]
    if len(parts) > 1:
        return parts[-1]
    words = text.split()
    return " ".join(words[-max(1, len(words) // 3):])


def lcs(masks: dict[int, int], m: int, words: list[int]) -> int:
    """Longest common subsequence with a pattern of ``m`` words, given as bit masks of its words' places."""
    full = (1 << m) - 1
    v = full
    for w in words:
        u = v & masks.get(w, 0)
        v = ((v + u) | (v - u)) & full
    return m - v.bit_count()


def _masks(words: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, w in enumerate(words):
        out[w] = out.get(w, 0) | 1 << i
    return out


def best_common(masks: dict[int, int], m: int, words: list[int]) -> tuple[int, int]:
    """(largest common subsequence, its start) over stretches of a quarter more words than the pattern has."""
    size = m + m // 4 + 1
    best = (0, 0)
    for a in range(0, max(1, len(words) - size + 1 + max(1, m // 4)), max(1, m // 4)):
        part = words[a:a + size]
        if len(part) > best[0]:
            best = max(best, (lcs(masks, m, part), -a))
    return best[0], -best[1]


class ItemRuns:
    """All runs of ``RUN`` words of the items; an item of fewer words is one run."""

    def __init__(self, items: list[dict]):
        self.tables: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]] = {}
        found: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for j, it in enumerate(items):
            g = min(RUN, len(it["words"]))
            keys = np.unique(runs(np.array(it["words"], dtype=np.uint64), g))
            found.setdefault(g, []).append((keys, np.full(len(keys), j)))
        for g, parts in found.items():
            keys, owners = np.concatenate([k for k, _ in parts]), np.concatenate([o for _, o in parts])
            order = np.lexsort((owners, keys))
            distinct, first = np.unique(keys[order], return_index=True)
            self.tables[g] = (distinct, np.append(first, len(keys)), owners[order])

    def find(self, g: int, words: np.ndarray, lens: np.ndarray, is_term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(first words, rows of the table of ``g``) of the item runs of ``g`` words inside the texts."""
        keys = self.tables[g][0]
        inside = is_term.copy()
        for i in range(1, g):
            inside[:-i] &= is_term[i:]
            inside[-i:] = False
        ends = np.cumsum(lens)
        for i in range(1, g):  # runs that leave their text
            inside[np.maximum(ends - i, 0)[lens >= i]] = False
        at = np.flatnonzero(inside)
        if not len(at):
            return at, at
        own = runs(words[(at[:, None] + np.arange(g)).ravel()], g)[::g]
        row = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
        hit = keys[row] == own
        return at[hit], row[hit]


def document_frequency(docs: DataFrame, text: str, terms: np.ndarray, own: ItemRuns | None = None) -> tuple[np.ndarray, int]:
    """(documents that hold each of the sorted term hashes, number of documents), over all documents. Words in a run of
    ``own`` do not count, so that leaks do not make an item's words common."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df, n = np.zeros(len(terms) + 1, dtype=np.int64), 0
        for b in batches:
            words, lens = normal_words(b.column(0).to_pylist())
            n += b.num_rows
            at = np.minimum(np.searchsorted(terms, words), max(0, len(terms) - 1))
            hit = terms[at] == words if len(terms) else np.zeros(len(words), dtype=bool)
            if own is not None and RUN in own.tables:
                first, _ = own.find(RUN, words, lens, hit)
                hit[(first[:, None] + np.arange(RUN)).ravel()] = False
            pair = np.repeat(np.arange(len(lens)), lens)[hit] * (len(terms) + 1) + at[hit]
            df += np.bincount(np.unique(pair) % (len(terms) + 1), minlength=len(terms) + 1)
        df[-1] = n
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["term", "n"])

    out = np.zeros(len(terms) + 1, dtype=np.int64)
    for r in docs.select(text).mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        out[r["term"]] = r["n"]
    return out[:-1], int(out[-1])


def passages(words: list[int]) -> list[list[int]]:
    """Windows of an item's words, overlapping by half; a short item is one passage."""
    return [words[a:a + WINDOW] for a in range(0, max(1, len(words) - WINDOW // 2), WINDOW // 2)]


def randomised_svd(rows: DataFrame, width: int, rank: int, seed: int = 4) -> np.ndarray:
    """Right singular vectors (width, rank) of the sparse rows (at: array<int>, value: array<double>).

    Every pass multiplies the rows of a partition by the current basis and back; only the (width, rank) sums come to
    the driver, as many as there are partitions.
    """
    rank = min(rank, width)
    cols = min(width, rank + OVERSAMPLE)
    basis = np.linalg.qr(np.random.default_rng(seed).standard_normal((width, cols)))[0]

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((width, cols))
        for b in batches:
            for at, value in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                at, value = np.array(at, dtype=np.int64), np.array(value)
                total[at] += value[:, None] * (value @ basis[at])
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["total"])

    for _ in range(POWER + 1):
        sums = rows.select("at", "value").mapInArrow(gram, "total binary").toLocalIterator()
        z = sum((np.frombuffer(r["total"]).reshape(width, cols) for r in sums), np.zeros((width, cols)))
        before, small = basis, basis.T @ z
        basis = np.linalg.qr(z)[0]
    # Rayleigh-Ritz in the last basis that was multiplied: its leading directions are the singular vectors
    _, turn = np.linalg.eigh((small + small.T) / 2)
    return before @ turn[:, ::-1][:, :rank]


class Retriever:
    """Term weights, latent basis and the benchmark items, as the tasks need them."""

    def __init__(self, terms: np.ndarray, idf: np.ndarray, basis: np.ndarray, items: list[dict], params: Params,
                 common: np.ndarray | None = None, own: ItemRuns | None = None):
        self.terms, self.params, self.runs = terms, params, own or ItemRuns(items)
        self.latent = (idf[:, None] * basis).astype(np.float32)
        rows, self.row_item, norms = [], [], []
        for j, it in enumerate(items):
            for p in passages(it["words"]):
                at = np.searchsorted(terms, np.array(p, dtype=np.uint64))
                v = self.latent[at].sum(axis=0)
                norm = np.linalg.norm(v)
                if norm > 0:
                    rows.append(v / norm)
                    norms.append(norm)
                    self.row_item.append(j)
        self.rows = np.array(rows, dtype=np.float32).reshape(len(rows), basis.shape[1])
        self.row_item, self.norms = np.array(self.row_item, dtype=np.int64), np.array(norms, dtype=np.float32)
        self.weighted = idf > 0 if common is None else ~common
        self.most = self._most()
        told = [int(self.weighted[np.searchsorted(terms, np.unique(np.array(it["words"], dtype=np.uint64)))].sum()) for it in items]
        self.hits = min([params.hits, *told])
        self.need = np.array([max(1, int(params.runs * min(len(it["words"]), WINDOW))) for it in items], dtype=np.int64)
        self.items = [(it["item_id"], _masks(it["words"]), len(it["words"]), _masks(it["answer"]), len(it["answer"])) for it in items]

    def _most(self) -> np.ndarray:
        """For every term the most that one occurrence adds to a window's share of a passage's own length. Their sum over
        a window bounds what it can reach, without a product in the latent space."""
        out = np.zeros(len(self.terms))
        if len(self.rows):
            unit = self.rows / self.norms[:, None]
            for lo in range(0, len(out), 4096):
                out[lo:lo + 4096] = np.maximum((self.latent[lo:lo + 4096] @ unit.T).max(axis=1), 0)
        return out

    def _fold(self, starts: np.ndarray, steps: int, ok2: np.ndarray, ok3: np.ndarray, places: np.ndarray, terms: np.ndarray):
        """A function that gives the latent vectors of windows out of ``starts``; only their steps' words are read."""
        need = np.zeros(steps + 2, dtype=bool)
        for back, ok in ((0, None), (1, ok2), (2, ok3)):
            need[(starts if ok is None else starts[ok[starts]]) + back] = True
        row = np.where(need, np.cumsum(need) - 1, need.sum())  # the last row stays zero
        vec = np.zeros((int(need.sum()) + 1, self.latent.shape[1]), dtype=np.float32)
        inside = need[places]
        places, terms = row[places[inside]], terms[inside]
        edge = np.flatnonzero(np.diff(places, prepend=-1))
        for lo in range(0, len(edge), 4096):
            a, e = edge[lo], edge[lo + 4096] if lo + 4096 < len(edge) else len(places)
            vec[places[edge[lo:lo + 4096]]] = np.add.reduceat(self.latent[terms[a:e]], edge[lo:lo + 4096] - a, axis=0)
        zero = len(vec) - 1
        return lambda s: vec[row[s]] + vec[np.where(ok2[s], row[s + 1], zero)] + vec[np.where(ok3[s], row[s + 2], zero)]

    def repeats(self, words: np.ndarray, lens: np.ndarray, is_term: np.ndarray, owner_step: np.ndarray, text_of: np.ndarray
                ) -> Iterator[tuple[int, int]]:
        """(step, item) of the windows that repeat enough runs of an item, whatever their words weigh."""
        total = len(text_of)
        for g, (_, first, owners) in self.runs.tables.items():
            at, row = self.runs.find(g, words, lens, is_term)
            many, step = first[row + 1] - first[row], owner_step[at]
            before = np.concatenate([[0], np.cumsum(many)])
            lo = 0
            while lo < len(at):  # so many steps at once that their runs' items are a few million
                hi = max(int(np.searchsorted(before, before[lo] + (1 << 21), side="right")) - 1, lo + 1)
                end = int(step[hi - 1]) + 1
                hi = int(np.searchsorted(step, end))
                a = int(np.searchsorted(step, step[lo] - 2))  # windows that start before are counted again, and whole
                n = many[a:hi]
                item = owners[np.repeat(first[row[a:hi]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
                where = np.repeat(step[a:hi], n)
                key, count = np.unique(where * len(self.need) + item, return_counts=True)
                where, item = key // len(self.need), key % len(self.need)
                starts = np.concatenate([where - back for back in range(3)])
                inside = (starts >= 0) & (text_of[np.maximum(starts, 0)] == np.tile(text_of[where], 3))
                window, back = np.unique((starts * len(self.need) + np.tile(item, 3))[inside], return_inverse=True)
                enough = np.bincount(back, np.tile(count, 3)[inside]) >= self.need[window % len(self.need)]
                yield from zip((window[enough] // len(self.need)).tolist(), (window[enough] % len(self.need)).tolist())
                lo = hi

    def candidates(self, words: np.ndarray, lens: np.ndarray) -> Iterator[tuple[int, int, int, float, bool]]:
        """(text, first word of the window, item, cosine, by the latent space) of all windows near an item's passage, and
        then of those with its runs."""
        at = np.minimum(np.searchsorted(self.terms, words), len(self.terms) - 1)
        hit = self.terms[at] == words
        steps = np.maximum(1, -(-lens // STEP))  # steps of each text; a window is three of them
        first_step = np.cumsum(steps) - steps
        pos = np.arange(len(words)) - np.repeat(np.cumsum(lens) - lens, lens)
        owner_step = np.repeat(first_step, lens) + pos // STEP
        total = int(steps.sum())
        text_of = np.repeat(np.arange(len(lens)), steps)
        in_text = np.arange(total) - first_step[text_of]
        left = steps[text_of] - in_text
        ok2, ok3 = left > 1, left > 2
        # a text's last, shorter windows lie inside an earlier one unless the text is that short
        whole = ok3 | (in_text == 0)
        places, terms = owner_step[hit], at[hit]

        def over_window(x: np.ndarray) -> np.ndarray:
            return x[:total] + np.where(ok2, x[1:total + 1], 0) + np.where(ok3, x[2:total + 2], 0)

        hits = over_window(np.bincount(places[self.weighted[terms]], minlength=total + 2))
        reach = over_window(np.bincount(places, self.most[terms], minlength=total + 2))  # 0.1% for rounding
        some = np.flatnonzero(whole & (hits >= self.hits) & (reach >= 0.999 * self.params.cover))
        again = [(step, j) for step, j in self.repeats(words, lens, hit, owner_step, text_of) if whole[step]]
        starts = np.concatenate([some, np.array([step for step, _ in again], dtype=np.int64)])
        window = self._fold(starts, total, ok2, ok3, places, terms)
        for lo in range(0, len(some), 4096):
            s = some[lo:lo + 4096]
            x = window(s)
            along = x @ self.rows.T
            w, r = np.nonzero(along >= self.params.cover * self.norms)
            cos = along[w, r] / np.maximum(np.linalg.norm(x, axis=1)[w], 1e-9)
            for i, j, c in zip(w.tolist(), r.tolist(), cos.tolist()):
                if c >= self.params.cosine:
                    step = int(s[i])
                    yield int(text_of[step]), int(in_text[step]) * STEP, int(self.row_item[j]), c, True
        for step, j in again:
            x = window(np.array([step]))[0]
            lo, hi = np.searchsorted(self.row_item, [j, j + 1])
            cos = float((self.rows[lo:hi] @ x).max() / max(np.linalg.norm(x), 1e-9)) if hi > lo else 0.0
            yield int(text_of[step]), int(in_text[step]) * STEP, j, cos, False

    def leaks(self, texts: list[str | None]) -> Iterator[tuple[int, int, int, float, float, float, str]]:
        """(text, item, first word, cosine, share in common, answer share, path), the best place of each text and item;
        ``path`` is ``latent`` if a window that the latent space found shows the leak, ``runs`` if only word runs did."""
        if not self.items:
            return
        words, lens = normal_words(texts)
        firsts = np.cumsum(lens) - lens
        best: dict[tuple[int, int], tuple] = {}
        tried: set[tuple[int, int, int]] = set()
        path: dict[tuple[int, int], str] = {}
        for text, start, item, cos, latent in self.candidates(words, lens):
            _, masks, m, answer, k = self.items[item]
            if (text, item) in best and best[text, item][0] == 1.0 or (text, item, start - STEP) in tried or (text, item, start) in tried:
                continue  # found whole, or the same or the neighbour's stretch covers this one
            tried.add((text, item, start))
            lo, hi = max(0, start - m), min(int(lens[text]), start + WINDOW + STEP + m)
            near = words[firsts[text] + lo:firsts[text] + hi].tolist()
            common, at = best_common(masks, m, near)
            share = common / m
            around = near[max(0, at - k):at + m + m // 4 + 1 + k]
            told = lcs(answer, k, around) / k if k else 0.0
            p = self.params
            if share >= p.common or (share >= p.near and told >= p.answer):
                best[text, item] = max(best.get((text, item), (0.0,)), (share, told, cos, lo + at))
                path.setdefault((text, item), "latent" if latent else "runs")
        for (text, item), (share, told, cos, at) in best.items():
            yield text, self.items[item][0], at, cos, share, told, path[text, item]


def train(docs: DataFrame, benchmark: DataFrame, params: Params = Params(), text: str = "text", item_id: str = "item_id",
          item_text: str = "text") -> Retriever:
    """The retriever of a benchmark, which must fit the tasks' memory as its terms times ``RANK`` numbers. Items with a
    null id or without words are left out; of repeated ids all texts count."""
    spark = docs.sparkSession
    items = []
    for r in benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(item_text).alias("t")).where(
            "i is not null and t is not null").distinct().orderBy("i", "t").toLocalIterator():
        w, _ = normal_words([r["t"]])
        a, _ = normal_words([answer_of(r["t"])])
        if len(w):
            items.append({"item_id": r["i"], "words": w.tolist(), "answer": a.tolist()})
    terms = np.unique(np.array([w for it in items for w in it["words"]], dtype=np.uint64))
    if not len(terms):
        return Retriever(terms, np.empty(0), np.empty((0, 1)), [], params)
    own = ItemRuns(items)
    df, n = document_frequency(docs, text, terms, own)
    common = df > max(params.stop * n, 2)
    idf = np.where(common, params.floor, np.log((1 + n) / (1 + df)) + 1)
    rows = []
    for it in items:
        for p in passages(it["words"]):
            at, tf = np.unique(np.searchsorted(terms, np.array(p, dtype=np.uint64)), return_counts=True)
            rows.append((at.tolist(), (tf * idf[at]).tolist()))
    frame = spark.createDataFrame(rows, "at array<int>, value array<double>").repartition(4)
    return Retriever(terms, idf, randomised_svd(frame, len(terms), min(RANK, len(rows))), items, params, common, own)


def _broadcast(docs: DataFrame, retriever: Retriever):
    size = retriever.latent.nbytes + retriever.rows.nbytes
    if size > MOST_BYTES:
        raise ValueError(f"the benchmark's latent space takes {size} bytes, more than {MOST_BYTES}: judge it in parts, one retriever each")
    return docs.sparkSession.sparkContext.broadcast(retriever)


def find_leaks(docs: DataFrame, retriever: Retriever, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, item_id, first_word, cosine, common, answer, path: one row for every document and item that leaks into it.

    Null and empty texts leak nothing; rows are judged one by one, so repeated rows repeat their leaks and a null id
    stays null; other columns are not read; an empty table, or an empty benchmark, gives an empty result.
    """
    shared = _broadcast(docs, retriever)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = shared.value
        for b in batches:
            ids, texts = b.column(0).to_pylist(), b.column(1).to_pylist()
            found, held, size, first = [], [], 0, 0
            for i, t in enumerate(texts):
                held.append(t)
                size += len(t or "")
                if size >= 1 << 20 or i == len(texts) - 1:
                    found += [(ids[first + x[0]], *x[1:]) for x in own.leaks(held)]
                    held, size, first = [], 0, i + 1
            cols = list(zip(*found)) or [()] * 7
            kinds = [pa.int64()] * 3 + [pa.float64()] * 3 + [pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["doc_id", "item_id", "first_word", "cosine", "common", "answer", "path"])

    return docs.select(F.col(doc_id).cast("long"), text).mapInArrow(
        run, "doc_id long, item_id long, first_word long, cosine double, common double, answer double, path string")


def count_leaks(docs: DataFrame, retriever: Retriever, text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``keep`` (default: all columns but the text and the new one) and n_leaks, the number of items found, of every row."""
    keep = keep if keep is not None else [c for c in docs.columns if c not in (text, "n_leaks")]
    shared = _broadcast(docs, retriever)

    def work(texts: list) -> list:
        out = np.zeros(len(texts), dtype=np.int64)
        for lo in range(0, len(texts), 256):
            for found in shared.value.leaks(texts[lo:lo + 256]):
                out[lo + found[0]] += 1
        return [out]

    return map_texts(docs, text, lambda: work, "n_leaks long", keep)
