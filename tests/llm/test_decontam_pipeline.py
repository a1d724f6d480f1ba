"""Decontamination against planted leaks, and the pipeline against a plain version of its stages."""

import numpy as np
import pytest

import corpus_pipeline
from acoustispark.llm import decontam
from acoustispark.llm.queries import op4_decontamination

from ..conftest import SF
from .test_near_and_repeats import _brute, _kept

MID = "/root/testdata/sf0.01"


def _plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row = [0] + [max(row[j] + 1 if x == y else 0, row[j + 1]) for j, y in enumerate(b)]
        for j in range(1, len(row)):
            row[j] = max(row[j], row[j - 1])
    return row[-1]


def test_lcs_by_dynamic_programming():
    rng = np.random.default_rng(1)
    for _ in range(200):
        a, b = rng.integers(0, 6, rng.integers(1, 40)).tolist(), rng.integers(0, 6, rng.integers(0, 60)).tolist()
        assert decontam.lcs(decontam._masks(a), len(a), b) == _plain_lcs(a, b)


def test_randomised_svd_finds_the_leading_space(spark):
    rng = np.random.default_rng(3)
    m = rng.standard_normal((60, 5)) @ rng.standard_normal((5, 90)) + 0.01 * rng.standard_normal((60, 90))
    rows = spark.createDataFrame([(list(range(90)), r.tolist()) for r in m], "at array<int>, value array<double>").repartition(3)
    v = decontam.randomised_svd(rows, 90, 5)
    want = np.linalg.svd(m)[2][:5].T
    assert np.allclose(np.linalg.svd(v.T @ want)[1], 1, atol=1e-4)


def test_answers():
    assert decontam.answer_of("One two three. Four five.") == "Four five."
    assert decontam.answer_of("a b c d e f") == "e f"


def _leaks(texts, bench):
    def norm(t):
        return " ".join(t.lower().split())
    return {(i, k) for i, t in texts for k, b in bench if t and norm(b) in norm(t)}


def test_query_finds_every_planted_item(spark):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{MID}/documents.parquet").collect()]
    bench = [(r.item_id, r.text) for r in spark.read.parquet(f"{MID}/benchmark.parquet").collect()]
    got = {(r.doc_id, r.item_id) for r in op4_decontamination(spark, MID).collect()}
    want = _leaks(texts, bench)
    assert want and want <= got and len(got - want) <= 0.1 * len(want)


def test_paraphrases_and_clean_rows(spark):
    docs = spark.read.parquet(f"{MID}/documents.parquet")
    bench = spark.read.parquet(f"{MID}/benchmark.parquet").orderBy("item_id").collect()
    clean = [r.text for r in docs.where("doc_id < 60").collect()]
    found = {r.doc_id for r in op4_decontamination(spark, MID).collect()}
    clean = [t for i, t in enumerate(clean) if i not in found]
    rng, rows = np.random.default_rng(0), []
    for n, b in enumerate(bench[:30]):  # every sixth word changed or dropped, in the middle of a clean text
        words = [w if k % 6 else ("other" if n % 2 else "") for k, w in enumerate(b.text.split())]
        host = clean[n % len(clean)].split()
        at = int(rng.integers(0, len(host) + 1))
        rows.append((n, " ".join(host[:at] + words + host[at:])))
    rows += [(1000 + i, t) for i, t in enumerate(clean)] + [(2000, None), (2001, ""), (2002, "word " * 80_000), (None, bench[0].text), (2003, bench[1].text), (2003, bench[1].text)]
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, cosine int")
    own = decontam.train(docs, spark.read.parquet(f"{MID}/benchmark.parquet"))
    got = [(r.doc_id, r.item_id) for r in decontam.find_leaks(df, own).collect()]
    assert np.mean([(n, b.item_id) in got for n, b in enumerate(bench[:30])]) >= 0.9
    assert not [g for g in got if g[0] is not None and 1000 <= g[0] <= 2002]
    assert (None, bench[0].item_id) in got and got.count((2003, bench[1].item_id)) == 2
    assert decontam.find_leaks(df.limit(0), own).count() == 0
    empty = decontam.train(docs, spark.createDataFrame([(1, None), (None, "x"), (2, " ")], "item_id long, text string"))
    assert decontam.find_leaks(df, empty).count() == 0


def _hot(spark, item, share, copies):
    """sf0.01 documents with ``item`` planted in every ``share``-th, or in as many copies of one document."""
    rows = spark.read.parquet(f"{MID}/documents.parquet").where("doc_id < 300").select("doc_id", "text").orderBy("doc_id").collect()
    host = next(r.text for r in rows if 100 < len((r.text or "").split()) < 300).split()
    out, planted = [], set()
    for n, r in enumerate(rows):
        if n % share:
            out.append((r.doc_id, r.text))
            continue
        words = host if copies else (r.text or "").split()
        at = len(words) // 2 if copies else n * 7 % (len(words) + 1)
        out.append((r.doc_id, " ".join(words[:at] + item.split() + words[at:])))
        planted.add(r.doc_id)
    return spark.createDataFrame(out, "doc_id long, text string"), planted


@pytest.mark.parametrize("copies", [True, False])
def test_an_item_in_a_third_of_the_rows(spark, copies):
    bench = spark.read.parquet(f"{MID}/benchmark.parquet")
    hot, *others = [r for r in bench.orderBy("item_id").collect()][3:]
    df, planted = _hot(spark, hot.text, 3, copies)
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(df, decontam.train(df, bench)).collect()}
    assert {(i, hot.item_id) for i in planted} <= got
    want = _leaks([(r.doc_id, r.text) for r in df.collect()], [(r.item_id, r.text) for r in others])
    assert want <= got
    assert len({g for g in got if g[1] == hot.item_id}) <= 1.05 * len(planted)


def test_items_of_common_words_and_short_items(spark):
    docs = [(i, f"of the that and in to is {'q%d' % i} it was for on as with his they at be this from") for i in range(60)]
    docs += [(100, "that is to be in the end as it was from the first of this and that on the way to q7"), (101, "zeta eta q1"), (102, "zeta q2 eta")]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([(1, "as it was from the first of this and that on the way"), (2, "zeta eta")], "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in decontam.find_leaks(df, decontam.train(df, bench)).collect()}
    assert {(100, 1), (101, 2)} <= got and not {i for i, _ in got if i < 60}


@pytest.fixture(scope="module")
def table_dir(spark, tmp_path_factory):
    d = str(tmp_path_factory.mktemp("sf"))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = spark.createDataFrame([(9001, None, "en", "s", 0), (9002, "", None, None, None), (9003, "12 34 !", "en", "s", 7), (None, "the and of that", "en", "s", 15),
                                 (9004, "the of and this is", "en", "s", 18), (9004, "the of and this is", "en", "s", 18)], docs.schema)
    docs.unionByName(odd).selectExpr("*", "'x' as lang_pred", "1.5 as kept", "'y' as n_words").write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{SF}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    return d


def test_stages_against_plain_versions(spark, table_dir, tmp_path):
    docs = spark.read.parquet(f"{table_dir}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, table_dir)
        out.write.parquet(str(tmp_path / name))
        after = spark.read.parquet(str(tmp_path / name))
        seen[name] = (docs, after)
        if name != "packing":
            assert after.columns == docs.columns and [f.dataType for f in after.schema] == [f.dataType for f in docs.schema]
        docs = after
    rows = lambda d: sorted(map(tuple, d.select("doc_id", "text").collect()), key=str)
    before, after = seen["language"]
    assert rows(after) == [r for r in rows(before) if r[1] and any(c.isalpha() for c in r[1])]
    before, after = seen["near"]
    named = dict((i, t) for i, t in rows(before) if i is not None)
    stay = {i for i, _, c in _brute(sorted(named.items()), 5, 80) if i == c}
    assert rows(after) == sorted([(i, t) for i, t in named.items() if i in stay] + [r for r in rows(before) if r[0] is None], key=str)
    before, after = seen["substrings"]
    plain = _kept([(i, t) for i, t in sorted(rows(before), key=lambda r: (r[0] is None, r[0] or 0))], 20)
    want = sorted(((i, k) for i, n, g, k in plain if g == 0 or g < n), key=str)
    assert sorted(((i, " ".join(t.split())) for i, t in rows(after)), key=str) == sorted(((i, " ".join(k.split())) for i, k in want), key=str)
    before, after = seen["leaks"]
    own = decontam.train(before, spark.read.parquet(f"{table_dir}/benchmark.parquet"))
    bad = {r.doc_id for r in decontam.find_leaks(before, own).collect()}
    assert rows(after) == [r for r in rows(before) if r[0] not in bad]
    before, after = seen["packing"]
    assert after.groupBy("doc_id").sum("length").count() == before.select("doc_id").distinct().count()


@pytest.mark.parametrize("labelled", ["null", "held out"])
def test_language_keeps_letters_when_nothing_was_learned(spark, table_dir, labelled):
    docs = spark.read.parquet(f"{table_dir}/documents.parquet")
    lang = "cast(null as string)" if labelled == "null" else "if(pmod(crc32(cast(doc_id as string)), 4) = 2, lang, null)"
    out = corpus_pipeline.language(spark, docs.selectExpr("doc_id", "text", f"{lang} as lang"), table_dir)
    want = sorted(r.text for r in docs.collect() if r.text and any(c.isalpha() for c in r.text))
    assert sorted(r.text for r in out.collect()) == want and len(want) > 100


def test_run_gives_the_last_stage(spark, table_dir):
    got = corpus_pipeline.run(spark, table_dir)
    assert got.columns == ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"] and got.count() > 100
    assert [n for n, _ in corpus_pipeline.STAGES] == ["language", "near", "substrings", "leaks", "packing"]


def test_run_on_an_empty_table(spark, table_dir, tmp_path):
    d = str(tmp_path)
    spark.read.parquet(f"{table_dir}/documents.parquet").limit(0).write.parquet(f"{d}/documents.parquet")
    spark.read.parquet(f"{table_dir}/benchmark.parquet").write.parquet(f"{d}/benchmark.parquet")
    assert corpus_pipeline.run(spark, d).count() == 0
