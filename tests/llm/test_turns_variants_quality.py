"""Conversation repair, spelling variants and quality: hand-made cases, brute force, odd input, held-out accuracy."""

import hashlib
import itertools
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from acoustispark.llm import quality, queries, turns, variants
from tests.conftest import SF
from tools.oracle_check import compare, duck


@pytest.mark.parametrize("name", ["op12_conversation_repair", "op13_spelling_variants"])
def test_query_equals_sql(spark, name):
    r = compare(spark, duck(SF), name, *queries.registry()[name], SF)
    assert r["cols_ok"] and r["hash_ok"] and r["rows"] == r["oracle_rows"], r


# ---- conversation repair -----------------------------------------------------------------------------------------

def _cheapest(rows):
    """(cost, audit) by trying every edit of every row and every insertion."""
    best = None

    def go(i, out, cost, audit):
        nonlocal best
        if best and cost > best[0]:
            return
        ways = [ins for k in (0, 1, 2) for ins in itertools.product("ua", repeat=k)]
        if i == len(rows):
            for ins in ways:
                if re.fullmatch("(s?(ua)+)?", out + "".join(ins)):
                    found = (cost + 5 * len(ins), audit + "I" * len(ins))
                    best = found if best is None else min(best, found)
            return
        initial, must_go, cut = rows[i]
        go(i + 1, out, cost + 2, audit + "D")
        if not must_go:
            for ins in ways:
                base, put = cost + 5 * len(ins) + 5 * cut, out + "".join(ins)
                go(i + 1, put + initial, base, audit + "I" * len(ins) + "K")
                for c in "ua":
                    go(i + 1, put + c, base + 1, audit + "I" * len(ins) + "R")

    go(0, "", 0, "")
    return best


def _parsed(rows, wait=64):
    p, links = turns.Parse(), []
    p.wait = wait
    for r in rows:
        p.row(*r)
        links += p.agreed()
    cost, rest = p.end()
    return cost, "".join(letters for letters, _ in links + rest), "".join(put for _, put in links + rest)


def test_parse_equals_brute_force():
    rng = random.Random(3)
    for _ in range(200):
        rows = [(rng.choice("ssuuuaaax"), rng.random() < 0.2, rng.random() < 0.2) for _ in range(rng.randint(0, 5))]
        cost, audit, put = _parsed(rows)
        assert (cost, audit) == _cheapest(rows), rows
        assert re.fullmatch("(s?(ua)+)?", put)


def test_settling_rows_early_changes_nothing():
    rng = random.Random(5)
    for _ in range(50):
        rows = [(rng.choice("suuuaaax"), rng.random() < 0.1, rng.random() < 0.1) for _ in range(rng.randint(50, 400))]
        assert _parsed(rows, 4) == _parsed(rows, 10 ** 9)


def test_a_sound_conversation_leaves_memory_while_it_is_read():
    p = turns.Parse()
    for i in range(20_000):
        p.row("ua"[i % 2], False, False)
        p.agreed()
    assert p.open <= 128 and p.end()[0] == 0


SCHEMA = "conv bigint, turn bigint, role string, text string, gone boolean"


def _repaired(spark, rows):
    out = turns.repair(spark.createDataFrame([(*r, False) for r in rows], SCHEMA)).collect()
    return {r.conv: r for r in out}


def test_faults_and_edits_of_small_conversations(spark):
    got = _repaired(spark, [
        (1, 0, "user", "Hi."), (1, 1, "assistant", "Yes."),
        (2, 0, "user", "Hi."), (2, 3, "user", "Hi."), (2, 4, "assistant", "\t "), (2, 5, "assistant", "No"),
        (3, None, "robot", "Hm."), (3, None, "user", "Eh?"),
        (None, 0, "system", "S."), (None, 1, "user", "U."), (None, 1, "user", "V.")])
    r = got[1]
    assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (0, 0, 0, 0, 0, 0, "KK")
    assert r.repaired_sha256 == hashlib.sha256(b"user:Hi.\nassistant:Yes.").hexdigest()
    r = got[2]  # user, its copy, a blank turn, a turn without an end
    assert (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit) == (2, 1, 1, 1, 2, 8, "DDDD")
    assert r.repaired_sha256 == hashlib.sha256(b"").hexdigest()
    r = got[3]
    assert (r.gaps, r.cost, r.audit, r.illegal) == (0, 2, "RR", 1)
    assert r.repaired_sha256 == hashlib.sha256(b"user:Hm.\nassistant:Eh?").hexdigest()
    assert (got[None].cost, got[None].audit) == (1, "KKR")
    rows = spark.createDataFrame([(9, 0, "assistant", "Late.", False)], SCHEMA)
    assert [(r.place, r.role, r.text) for r in turns.repaired_turns(rows).collect()] in ([(0, "user", ""), (1, "assistant", "Late.")], [])


def test_a_dropped_conversation_and_an_empty_table(spark):
    cid = next(c for c in range(1000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0)
    raw = spark.createDataFrame([(cid, 0, "user", "Hi.", 1, "x")], "conv_id bigint, turn bigint, role string, text string, conv int, gone string")
    r = turns.repair(turns.damaged(raw)).collect()
    assert [tuple(x) for x in r] == [(cid, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]
    assert turns.repair(turns.damaged(raw.limit(0))).count() == 0


def test_nulls_and_a_long_conversation(spark):
    rows = [(None, None, None, None), (7, None, None, "A."), (8, 0, "user", None)] + [(5, i, "ua"[i % 2], f"{i}" * 50 + ".") for i in range(3000)]
    raw = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    got = {r.conv: r for r in turns.repair(turns.damaged(raw)).collect()}
    assert set(got) == {None, 5, 7, 8} and got[8].audit in ("D", "") and len(got[5].audit.replace("I", "")) >= 2500


# ---- spelling variants -------------------------------------------------------------------------------------------

def _plain_variants(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            n[run[:h % len(run)] + run[h % len(run) + 1:] if h % 31 == 0 else run] += 1
    n = {w: k for w, k in n.items() if len(w) >= 7 and k >= 2}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        i = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
        return a != b and (a[i + 1:] == b[i + 1:] if len(a) == len(b) else len(b) == len(a) + 1 and a[i:] == b[i + 1:])

    out, form = {}, {}
    for w, k in n.items():
        close = [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(close, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best and n[best] >= 10 * k else None
        out[w] = [k, len(close), form[w], n[form[w]] if form[w] else None]
    for w in out:
        root = w
        while form[root]:
            root = form[root]
        out[w].append(root)
    return {w: tuple(v) for w, v in out.items()}


def _texts(seed, alphabet, n_words):
    rng = random.Random(seed)
    words = ["".join(rng.choice(alphabet) for _ in range(rng.randint(7, 12))) for _ in range(n_words)]
    for w in list(words[:n_words // 2]):
        i = rng.randrange(len(w))
        words += [w[:i] + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i + 1:], w[:i] + rng.choice(alphabet) + w[i:]]
    rows = []
    for d in range(60):
        rows.append((d, " ".join(rng.choices(words, [1 / (i + 1) for i in range(len(words))], k=120)) + ". " + "Straße3" * (d % 2)))
    return rows + [(None, " ".join(words) * 2), (3, None), (4, ""), (5, "A" * 3000 + " " + "A" * 3000 + " " + "A" * 2999 + "É"), (60, rows[0][1]), (60, rows[0][1])]


@pytest.mark.parametrize("alphabet,common,most", [("ab", 4, 10 ** 6), ("abcé", 64, 10 ** 6), ("abcdef", 2, 40), ("abcdefgh", 0, 10 ** 6)])
def test_variants_equal_brute_force(spark, alphabet, common, most):
    rows = _texts(len(alphabet) + common, alphabet, 60)
    docs = spark.createDataFrame([(*r, "z", 1) for r in rows], "doc_id bigint, text string, word string, n int")
    got = variants.variants(docs, common=common, most=most).collect()
    want = _plain_variants(rows)
    assert len(got) == len(want)
    assert {r.word: (r.n, r.n_near, r.form, r.form_n, r.root) for r in got} == want


def test_no_words(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id bigint, text string")
    assert variants.variants(docs).count() == 0 and variants.variants(docs.limit(0)).count() == 0


def test_an_edit_leaves_the_other_grams(spark):
    """The bound holds: one edit changes at most ``affected`` grams, whatever the dictionary."""
    rng = random.Random(2)
    words = ["".join(rng.choice("abc") for _ in range(rng.randint(7, 14))) for _ in range(300)]
    dic = variants.gram_dictionary(spark.createDataFrame([(w,) for w in words], "word string"), common=6)
    assert dic and all(g[:-1] in dic or len(g) == variants.SHORT for g in dic)
    for w in words:
        i, c = rng.randrange(len(w)), rng.choice("abc")
        for other in (w[:i] + w[i + 1:], w[:i] + c + w[i + 1:], w[:i] + c + w[i:]):
            mine, theirs = variants.decompose(w, dic), variants.decompose(other, dic)
            move = len(other) - len(w)
            kept = sum(1 for p, g, _ in mine if any(g == h and q in (p, p + move) for q, h, _ in theirs))
            assert kept >= len(mine) - variants.affected(mine, len(w))


# ---- quality -----------------------------------------------------------------------------------------------------

def test_features_of_a_text_do_not_depend_on_its_neighbours():
    numbers = quality.Features()
    texts = ["", "One two two two.\nOne two.", "A\n\nB###", "x" * 5000, "ÀÉ 12 \U0001F600!", " ", "One two two two.\nOne two."]
    together = numbers(texts)
    assert np.array_equal(together, np.concatenate([numbers([t]) for t in texts]))
    assert not together[0].any() and np.array_equal(together[1], together[6])
    words = "One two two two. One two.".split()
    assert together[1][-11:][3] == pytest.approx(len(set(words)) / 6) and together[1][-11:][4] == pytest.approx(2 / 6)


def test_risk_slopes_are_derivatives():
    rng = np.random.default_rng(1)
    zp, zu, prior = rng.standard_normal(6), rng.standard_normal(8) + 1, 0.3

    def risk(p, u):
        return sum(quality.unbiased_risk(p, u, prior))

    assert quality.unbiased_risk(zp, zu, prior)[1] > 0
    for z, at in ((zp, 0), (zu, 1)):
        for i in range(len(z)):
            e = np.zeros(len(z))
            e[i] = 1e-5
            up, down = ((zp + e, zu), (zp - e, zu)) if at == 0 else ((zp, zu + e), (zp, zu - e))
            assert quality.risk_slopes(zp, zu, prior)[at][i] == pytest.approx((risk(*up) - risk(*down)) / 2e-5, abs=1e-6)
    over = quality.risk_slopes(zp, zu - 50, 0.9)  # the bad part is below zero: it alone is raised again
    assert quality.unbiased_risk(zp, zu - 50, 0.9)[1] < 0 and (over[1] <= 0).all() and (over[0] >= 0).all()


@pytest.mark.parametrize("share", [0.2, 0.6, 0.9])
def test_prior_is_found_on_mixtures(share):
    rng = np.random.default_rng(4)
    xp = rng.normal(1.5, 1, (3000, quality.WIDTH))
    xu = np.where((rng.random(6000) < share)[:, None], rng.normal(1.5, 1, (6000, quality.WIDTH)), rng.normal(-1.5, 1, (6000, quality.WIDTH)))
    cells = tuple([r.tobytes() for r in x.astype(np.float32)] for x in (xp, xu))
    nets = quality.separate(cells)
    hist = [np.bincount(np.minimum((quality.unseen_scores(nets, c) * quality.BINS).astype(int), quality.BINS - 1), minlength=quality.BINS) for c in cells]
    prior = quality.class_prior(*hist)
    assert abs(prior - share) < 0.05
    net = quality.fit(xp, xu, prior)
    assert (net.scores(rng.normal(1.5, 1, (500, quality.WIDTH))) > 0.5).mean() > 0.97
    assert (net.scores(rng.normal(-1.5, 1, (500, quality.WIDTH))) < 0.5).mean() > 0.97


def test_quality_on_held_out_documents(spark):
    sf = SF.replace("0.001", "0.01")
    out = queries.op11_quality_classifier(spark, sf)
    rows = out.join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    good, bad = ([r.score for r in rows if r.quality == q] for q in (1, 0))
    auc = np.mean([(g > b) + 0.5 * (g == b) for g in good for b in bad])
    assert auc > 0.97 and np.mean([r.predicted == r.quality for r in rows]) > 0.93
    assert out.count() == spark.read.parquet(f"{sf}/documents.parquet").count() and out.where("score < 0 or score > 1 or score is null").count() == 0


def test_quality_scores_equal_a_plain_pass_and_take_odd_rows(spark):
    docs = spark.createDataFrame([(1, "Good text, it is.", True, "a"), (2, None, True, "b"), (None, "", True, "c"), (4, "### " * 9000, True, "d"),
                                  (1, "Good text, it is.", True, "e")], "doc_id bigint, text string, usable boolean, lo string")
    labels = spark.createDataFrame([(1, 1), (4, 0), (2, None), (1, 1)], "doc_id bigint, quality int")
    feats = quality.with_features(docs)
    model, prior = quality.train(feats, labels, F.lit(True))
    got = quality.score(feats, model, prior)
    numbers = quality.Features()
    for r in got.collect():
        text = {1: "Good text, it is.", 4: "### " * 9000}.get(r.doc_id, "")
        assert r.score == pytest.approx(float(model.scores(numbers([text]).astype(float))[0]))
        assert r.predicted == int(r.score >= 0.7) and "lo" in got.columns
    none, prior = quality.train(feats, labels.limit(0), F.lit(True))
    assert none is None and {r.score for r in quality.score(feats, none, prior).collect()} == {0.5}
    assert quality.score(feats.limit(0), model, prior).count() == 0
