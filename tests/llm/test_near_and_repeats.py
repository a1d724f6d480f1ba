"""Jaccard join and substring deduplication against brute force and SQL."""

import hashlib
import re

import numpy as np
import pytest

from acoustispark.llm import common, jaccard, phrases
from acoustispark.llm.queries import registry
from tools.oracle_check import compare, duck

from ..conftest import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize("name", ["op3_ngram_jaccard", "op6_substring_dedup"])
def test_queries_match_sql(spark, name):
    fn, sql = registry()[name]
    r = compare(spark, duck(SF), name, fn, sql, SF)
    assert r["cols_ok"] and r["hash_ok"] and r["rows"] == r["oracle_rows"], r


def _shingles(text, n):
    w = WORD.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w[i:i + n]) for i in range(len(w) - n + 1)} if len(w) >= n else ({tuple(w)} if w else set())


def _brute(docs, n, percent):
    sets = {i: _shingles(t, n) for i, t in docs}
    comp = {i: i for i in sets}

    def root(i):
        while comp[i] != i:
            i = comp[i]
        return i
    ids = sorted(sets)
    for x, a in enumerate(ids):
        for b in ids[x + 1:]:
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                ra, rb = root(a), root(b)
                comp[max(ra, rb)] = min(ra, rb)
    return sorted((i, len(sets[i]), root(i)) for i in ids)


def _corpus():
    import random
    rnd = random.Random(5)
    words = [f"w{i}" for i in range(400)]
    base = [rnd.choices(words, k=120) for _ in range(6)]
    docs = []
    for b, text in enumerate(base):
        for v in range(25):  # a group of near copies around the threshold, and chains of edits
            t = list(text)
            for _ in range(v % 7):
                t[rnd.randrange(len(t))] = f"x{rnd.randrange(10**6)}"
            docs.append(" ".join(t))
    chain = rnd.choices(words, k=150)
    for v in range(30):
        chain = list(chain)
        for _ in range(2):
            chain[rnd.randrange(150)] = f"y{v}{rnd.random()}"
        docs.append(" ".join(chain))
    docs += [docs[0]] * 20 + [" ".join(rnd.choices(words, k=60)) for _ in range(30)]
    docs += ["", None, "one", "one", "One two", "a b c", "a b c d", "a b c d", "same " * 500, "same " * 700, " \n\t "]
    common_line = " ".join(f"c{i}" for i in range(15))
    docs += [common_line + " " + " ".join(rnd.choices(words, k=5)) for _ in range(40)]
    rnd.shuffle(docs)
    return list(enumerate(docs))


@pytest.mark.parametrize("n, percent", [(4, 85), (5, 80)])
def test_jaccard_brute_force(spark, n, percent):
    docs = _corpus()
    df = spark.createDataFrame([(i, t, "z") for i, t in docs], "doc_id long, text string, component_id string").repartition(5)
    got = jaccard.similar_components(df, n, percent)
    assert sorted(map(tuple, got.collect())) == _brute(docs, n, percent)


def test_jaccard_edge_rows(spark):
    t = " ".join(f"w{i}" for i in range(50))
    df = spark.createDataFrame([(None, t), (None, "x"), (3, t), (3, t), (1, t), (7, None), (8, ""), (9, "x y " * 40_000)], "doc_id long, text string")
    got = sorted(map(tuple, jaccard.similar_components(df).collect()), key=str)
    assert got == sorted([(None, 46, None), (None, 1, None), (3, 46, 1), (3, 46, 1), (1, 46, 1), (7, 0, 7), (8, 0, 8), (9, 2, 9)], key=str)
    assert jaccard.similar_components(df.limit(0)).count() == 0


def _text(seed, change=None):
    words = [f"v{seed}x{i}" for i in range(60)]
    if change is not None:
        words[change] = "changed"
    return " ".join(words)


def test_jaccard_of_several_texts_under_one_id(spark):
    a, b, c = _text(1), _text(2), _text(3)
    rows = [(1, a), (2, a), (2, b), (3, b), (4, _text(3, 20)), (5, c), (5, "short text"), (6, None), (6, ""), (None, a), (7, "x y z"), (7, "x y z")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = sorted(map(tuple, jaccard.similar_components(df).collect()), key=str)
    want = [(1, 56, 1), (2, 56, 1), (2, 56, 1), (3, 56, 1), (4, 56, 4), (5, 56, 4), (5, 1, 4), (6, 0, 6), (6, 0, 6), (None, 56, None), (7, 1, 7), (7, 1, 7)]
    assert got == sorted(want, key=str)


def test_one_of_each_group(spark):
    a, b = _text(1), _text(2)
    rows = [(1, a, "p", 1), (2, a, "q", 1), (2, b, "r", 1), (9, _text(2, 30), "s", 1), (9, _text(4), "u", 1), (None, a, "t", 1), (None, a, "t", 1), (6, None, "n", 1), (7, "x", "z", 1), (7, "x", "y", 1)]
    names = "doc_id long, text string, key string, `a.b` int"
    got = jaccard.one_of_each(spark.createDataFrame(rows, names).repartition(3))
    assert got.columns == ["doc_id", "text", "key", "a.b"]
    assert sorted(r.key for r in got.collect()) == ["n", "p", "s", "t", "t", "u", "y"]
    unique = spark.createDataFrame([r for r in rows if r[0] in (None, 1, 6, 9) and r[2] != "u"] + [(12, a, "w", 1)], names)
    assert sorted(r.key for r in jaccard.one_of_each(unique).collect()) == ["n", "p", "s", "t", "t"]
    assert jaccard.one_of_each(unique.limit(0)).count() == 0


def test_components(spark):
    links = [(9, 4), (4, 7), (7, 2), (11, 10), (20, 20), (13, 12), (12, 11)] + [(100 + i, 101 + i) for i in range(60)] + [(500, i) for i in range(600, 700)]
    got = dict(map(tuple, common.components(spark.createDataFrame(links, "a long, b long")).collect()))
    want = {9: 2, 4: 2, 7: 2, 2: 2, 10: 10, 11: 10, 12: 10, 13: 10} | {100 + i: 100 for i in range(61)} | {i: 500 for i in range(600, 700)} | {500: 500}
    assert got == want
    assert common.components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_near_copies_need_few_jobs(spark):
    """Every plan and its stages are held and planned by the driver, whatever the size of the input."""
    rows = [(i, _text(i // 10, i % 10 or None)) for i in range(80)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    spark.sparkContext.setJobGroup("near-copies", "near copies")
    try:
        kept = jaccard.one_of_each(docs).collect()
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup("near-copies")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert sorted(r.doc_id for r in kept) == list(range(0, 80, 10))
    assert len(jobs) <= 125, len(jobs)


def test_hubs_without_a_link_lose_none(spark, monkeypatch):
    """Members that link to one another but not to the first round's hub are found by the comparison of all that is left."""
    words = [f"u{i}" for i in range(100)]
    texts = [words[:12] + [f"z{d}x{i}" for i in range(88)] for d in range(3)]
    docs = [(d, " ".join(t)) for d, t in enumerate(texts + [words, [*words[:60], "other", *words[61:]], [*words[:61], "else", *words[62:]]])]
    want = _brute(docs, 5, 80)
    for rounds in ((), ((1, 1),), jaccard.ROUNDS):
        monkeypatch.setattr(jaccard, "ROUNDS", rounds)
        got = jaccard.similar_components(spark.createDataFrame(docs, "doc_id long, text string").repartition(2))
        assert sorted(map(tuple, got.collect())) == want


def _kept(docs, window):
    first, out = {}, []
    for i, t in docs:
        w = WORD.findall(t or "")
        gone = set()
        for s in range(len(w) - window + 1):
            key = tuple(w[s:s + window])
            if key in first:
                gone.update(range(s, s + window))
            else:
                first[key] = (i, s)
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def test_repeats_brute_force(spark):
    docs = _corpus()
    long = " ".join(f"p{i}" for i in range(60))
    docs += [(1000 + i, f"start{i} {long}\n end{i}") for i in range(30)] + [(2000, long + " " + long), (2001, "For " * 400), (2002, "For " * 30)]
    df = spark.createDataFrame([(i, t, 5) for i, t in docs], "doc_id long, text string, n_words int").repartition(7)
    got = phrases.remove_repeats(df, window=20).select("doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, got.collect())) == sorted(_kept(sorted(docs), 20))
    got = phrases.remove_repeats(df, window=9, anchor=3).select("doc_id", "n_words", "n_removed", "kept")
    assert sorted(map(tuple, got.collect())) == sorted(_kept(sorted(docs), 9))


def test_repeats_edge_rows(spark):
    t = " ".join(f"w{i}" for i in range(30))
    df = spark.createDataFrame([(None, t, "a"), (3, t, "b"), (3, t, "b"), (4, None, "c"), (5, "", "d"), (6, "short text", "e"), (1, f"x\n {t}\ty", "f")],
                               "doc_id long, text string, kept string")
    got = phrases.remove_repeats(df, one_blank=False).collect()
    assert sorted((r.n_removed, r.kept) for r in got if r.doc_id in (None, 3)) == [(30, "")] * 3
    rest = {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in got if r.doc_id not in (None, 3)}
    assert rest == {4: (0, 0, ""), 5: (0, 0, ""), 6: (2, 0, "short text"), 1: (32, 0, f"x\n {t}\ty")}
    assert phrases.remove_repeats(df.limit(0)).count() == 0
    cut = phrases.remove_repeats(spark.createDataFrame([(1, t), (2, f"a\nb {t} c\td")], "doc_id long, text string"), one_blank=False)
    assert {r.doc_id: r.kept for r in cut.collect()} == {1: t, 2: "a\nb c\td"}


def test_hash_of_kept_words(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    got = {r.doc_id: r.kept_sha256 for r in registry()["op6_substring_dedup"][0](spark, SF).collect()}
    assert got == {i: hashlib.sha256(k.encode()).hexdigest() for i, _, _, k in _kept(sorted(docs), 20)}


def test_repeats_come_from_the_automaton(spark):
    df = spark.createDataFrame([(i, t) for i, t in _corpus()], "doc_id long, text string").repartition(7)
    none = phrases.remove_repeats(df, find=lambda words, wanted: np.empty(0, dtype=np.int64))
    assert none.selectExpr("sum(n_removed)").first()[0] == 0
    half = phrases.remove_repeats(df, find=lambda words, wanted: phrases.occurrences(words, wanted[::2]))
    some, whole = (d.selectExpr("sum(n_removed)").first()[0] for d in (half, phrases.remove_repeats(df)))
    assert 0 < some < whole


def test_occurrences_brute_force():
    rng = np.random.default_rng(3)
    words = rng.integers(5, size=4000).astype(np.uint64) * np.uint64(1 << 60)
    wanted = np.unique(np.array([words[p:p + 4] for p in rng.integers(3900, size=60)] + [[9, 9, 9, 9]], dtype=np.uint64), axis=0)
    got = sorted(phrases.occurrences(words, wanted).tolist())
    rows = {tuple(r) for r in wanted.tolist()}
    assert got == [e for e in range(3, 4000) if tuple(words[e - 3:e + 1].tolist()) in rows]
