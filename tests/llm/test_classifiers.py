"""Language identification and toxicity: gradients and marginals by brute force, held-out accuracy, odd rows."""

import itertools
import zlib

import numpy as np
import pytest

from acoustispark.llm import langid, textfeat, toxicity
from acoustispark.llm.queries import op5_language_id, op8_toxicity

MID = "/root/testdata/sf0.01"


def test_char_features_are_ragged_and_local():
    f, o = textfeat.char_features(["abc", "é", "Abc"], 12, (1, 2), 2)
    by = [sorted(f[o == i].tolist()) for i in range(3)]
    assert by[0] == by[2] and len(by[0]) == 5 + 4 + 4 and len(by[1]) == 3 + 2 + 2
    assert textfeat.word_hash(["Word", "word", "drow"], 20)[0] == textfeat.word_hash(["word"], 20)[0]


def test_word_table_forgets_and_agrees():
    t = textfeat.WordTable(lambda ws: np.array([[len(w), ord(w[0])] for w in ws], dtype=np.float32), np.zeros(2, np.float32), most=5)
    for words in (["a", "bb", "a"], ["c", "dd", "eee", "a"], ["x", "y", "z", "zz", "zzz", "q"], ["a", "q"]):
        rows = t.lookup(words)
        assert t.table[rows].tolist() == [[len(w), ord(w[0])] for w in words]


def test_marginals_by_enumeration():
    rng = np.random.default_rng(0)
    crf = langid.Crf(["a", "b", "c"], set())
    crf.trans = rng.normal(size=(3, 3)).astype(np.float32)
    factor = np.exp(rng.normal(size=(4, 1, 3))).astype(np.float32)
    real = np.ones((4, 1), dtype=bool)
    real[3] = False
    factor[3] = 1
    crf.count_pairs = True
    post, pairs = crf.marginals(factor, real)
    want, moves, total = np.zeros((3, 3)), np.zeros((3, 3)), 0.0
    for path in itertools.product(range(3), repeat=3):
        p = np.prod([factor[t, 0, k] for t, k in enumerate(path)]) * np.exp(sum(crf.trans[a, b] for a, b in zip(path, path[1:])))
        total += p
        for t, k in enumerate(path):
            want[t, k] += p
        for a, b in zip(path, path[1:]):
            moves[a, b] += p
    assert np.allclose(post[:3, 0], want / total, atol=1e-4) and np.allclose(pairs, moves / total, atol=1e-4)


@pytest.fixture(scope="module")
def languages(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    return langid.train(docs, langid.fold("doc_id", 4) != 2)


def test_language_held_out(spark):
    docs = {r.doc_id: r.lang for r in spark.read.parquet(f"{MID}/documents.parquet").collect()}
    got = op5_language_id(spark, MID).collect()
    assert len(got) == len(docs) and {r.doc_id for r in got} == set(docs)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and 0 <= r.score <= 1 for r in got)
    held = [r for r in got if r.held_out]
    assert np.mean([r.lang_pred == docs[r.doc_id] for r in held]) > 0.98


def test_language_edge_rows(spark, languages):
    rows = [(1, None, "x"), (2, "", "x"), (3, " 12 !!\n", "x"), (4, "²", "x"), (None, "the and of this", None), (6, "der die das und " * 20_000, "en")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang_pred string")
    got = {r.doc_id: (r.lang_pred, r.score) for r in langid.identify(df, languages).collect()}
    assert all(got[i] == ("und", 0.0) for i in (1, 2, 3, 4)) and got[None][0] == "en" and got[6][0] == "de"
    assert langid.identify(df.limit(0), languages).count() == 0
    nothing = langid.train(df.withColumn("lang", df.lang_pred).limit(0), langid.fold("doc_id", 4) != 2)
    assert {r.lang_pred for r in langid.identify(df, nothing).collect()} == {"und"}


def test_code_switched_words(spark, languages):
    df = spark.createDataFrame([(1, "the and this that of in with le les dans pour avec des une"), (2, None)], "doc_id long, text string")
    spans = {r.doc_id: [(s["first"], s["last"], s["lang"]) for s in r.spans] for r in langid.label_spans(df, languages).collect()}
    assert [s[2] for s in spans[1]] == ["en", "fr"] and abs(spans[1][0][1] - 6) <= 1 and spans[1][-1][1] == 13 and spans[2] == []


def test_gru_gradient():
    rng = np.random.default_rng(0)
    net = toxicity.BiGru()
    for k in net.p:
        net.p[k] = net.p[k].astype(np.float64)
    gx = rng.standard_normal((5, 3, 6 * toxicity.HIDDEN))
    real = np.ones((5, 3), bool)
    real[3:, 1] = False
    y = np.array([1, 0, 1.0])

    def loss():
        logit, _ = net.forward(gx, real)
        return np.sum(np.logaddexp(0, logit) - y * logit)
    logit, held = net.forward(gx, real, True)
    grad, dgx = net.backward(gx, real, held, 1 / (1 + np.exp(-logit)) - y)
    for arr, g, at in [(net.p[k], grad[k], (0,) * net.p[k].ndim) for k in ("uf", "ub", "wa", "va", "wo", "ba")] + [
            (gx, dgx, at) for at in ((0, 0, 0), (2, 1, 9), (1, 1, 30), (3, 2, 47))]:
        old = arr[at]
        arr[at] = old + 1e-3
        up = loss()
        arr[at] = old - 1e-3
        down = loss()
        arr[at] = old
        assert abs((up - down) / 2e-3 - g[at]) < 1e-4


@pytest.mark.parametrize("n", [0, 1, 31, 32, 33, 48, 49, 1000])
def test_windows_cover_every_word(n):
    got = toxicity.spans(n)
    assert set().union(*[range(a, b) for a, b in got], set()) == set(range(n))
    assert all(b - a <= toxicity.WINDOW for a, b in got) and all(y[0] - x[0] == toxicity.STRIDE for x, y in zip(got, got[1:]))


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.1"
    marks = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    got = [r for r in op8_toxicity(spark, sf).collect()]
    assert len(got) == spark.read.parquet(f"{sf}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got)
    held = [(r.predicted, marks[r.doc_id]) for r in got if r.held_out and r.doc_id in marks]
    caught = [p for p, y in held if y == 1]
    wrong = [p for p, y in held if y == 0]
    assert np.mean(caught) > 0.85 and np.mean(wrong) < 0.05


def test_toxicity_edge_rows(spark):
    net = toxicity.fit([(1, "you idiot moron clown".split() * 3), (0, "the and of this".split() * 3)] * 20)
    rows = [(1, None, 0), (2, "", 0), (3, "12 !!", 0), (None, "the and", 0), (5, "You IDIOT! moron clown " * 9000, 0), (5, "the of", 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = toxicity.score(df, net).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1
    assert toxicity.score(df.limit(0), net).count() == 0
    nothing = toxicity.fit([])
    assert all(r.predicted == 0 for r in toxicity.score(df, nothing).collect())
