"""URL rules and exact top-k against plain Python; both queries against SQL."""

import re

import duckdb
import numpy as np
import pytest

from acoustispark.llm import topk, urls
from acoustispark.llm.queries import HOST_RULES, PATTERNS, registry
from tools.oracle_check import compare, duck

from ..conftest import SF


@pytest.mark.parametrize("name", ["op1_url_filters", "op9_exact_topk"])
def test_queries_match_sql(spark, name):
    fn, sql = registry()[name]
    r = compare(spark, duck(SF), name, fn, sql, SF)
    assert r["cols_ok"] and r["hash_ok"] and r["rows"] == r["oracle_rows"], r


def _plain(url):
    m = re.search(r"://([^/?#]*)([^?#]*)", url or "", re.S)
    low = "".join(c.lower() if "A" <= c <= "Z" else c for c in url or "")
    host, path = ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")
    fits = [(len(t), t, a) for t, a in HOST_RULES for h, _, p in [t.partition("/")]
            if host and (host == h or host.endswith("." + h)) and path.startswith("/" + p)]
    if fits:
        _, t, a = max(fits)
        return host, path, t, "allow" if a else "block"
    hits = [a for t, a in PATTERNS if re.search("".join({"^": "(?:[^a-z0-9]|^|$)", "*": ".*"}.get(c, c) for c in t), low, re.S)]
    return host, path, None, "block" if hits and not any(hits) else "allow"


def test_urls_edge_rows(spark):
    given = [None, "", "no scheme example.org/x", "http://example.org", "http://EXAMPLE.org/en/15?x#y", "https://a.b.example.org/es/z",
             "http://notexample.org/es/", "http://x.com/fr/", "http://x.com/FR/", "http://x.com/de/1", "ftp://com/de/", "http://casino.net/",
             "http://casino.net/history/", "http://user@casino-win.example.com:80/en/1", "http://org/?q", "http://org/#/x", "://", "http:///p",
             "http://x.org/" + "a/" * 50_000, "http://xcasino.net/", "http://a://b.org/", "http://é.org/ü", "http://x.org\n/y"] * 2
    df = spark.createDataFrame([(i, u, "v") for i, u in enumerate(given)] + [(None, "http://x.org/", "v")], "page_id long, url string, verdict string")
    rules = [urls.host_rule(*r) for r in HOST_RULES] + [urls.pattern(*p) for p in PATTERNS]
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in urls.filter_urls(df, rules).collect()}
    assert got == {i: _plain(u) for i, u in enumerate(given)} | {None: _plain("http://x.org/")}
    assert urls.filter_urls(df.limit(0), rules).count() == 0


def test_rule_tokens_are_whole_tokens():
    assert urls.host_rule("example.org/en/1", False).tokens() == ["example", "org", "en"]
    assert urls.host_rule("com/fr/", True).tokens() == ["com", "fr"]
    assert urls.pattern("^casino^*^history^", True).tokens() == ["casino", "history"]
    assert urls.pattern("casino", True).tokens() == []


def _brute(rows, k):
    good = {}
    for i, v in rows:
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v):
            w = tuple(int(np.floor(64 * float(x))) for x in v)
            good[i] = min(good.get(i, w), w) if i in good else w
    out = []
    for q in good:
        if q % 20 == 0:
            s = sorted((-sum(a * b for a, b in zip(good[q], good[c])), c) for c in good if c != q and len(good[c]) == len(good[q]))
            out += [(q, r + 1, c, -x) for r, (x, c) in enumerate(s[:k])]
    return sorted(out)


@pytest.mark.parametrize("block", [7, 1000])
def test_topk_brute_force(spark, block):
    rng = np.random.default_rng(1)
    rows = [(i, rng.normal(size=6).tolist()) for i in range(130)] + [(i, [0.5] * 6) for i in range(130, 170)]  # ties
    rows += [(180, None), (181, [1.0, None, 1.0, 1.0, 1.0, 1.0]), (182, [float("nan")] * 6), (183, [float("inf")] * 6), (None, [1.0] * 6),
             (200, [1.0, 2.0]), (201, [1.0, 2.0]), (220, []), (240, [1e6] * 6), (5, rows[5][1])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<double>, score int")
    got = topk.exact_topk(df, block=block, query_block=3)
    assert sorted(map(tuple, got.collect())) == _brute(rows, 20)
    assert topk.exact_topk(df.limit(0)).count() == 0


def test_topk_of_repeated_ids_matches_sql(spark, tmp_path):
    rng = np.random.default_rng(4)
    rows = [(i // 3 if i < 90 else i, rng.normal(size=6).tolist()) for i in range(200)]  # three vectors under each of 30 ids
    spark.createDataFrame(rows, "vec_id long, embedding array<double>").write.parquet(f"{tmp_path}/embeddings.parquet")
    fn, sql = registry()["op9_exact_topk"]
    got = sorted(tuple(r) for r in fn(spark, str(tmp_path)).collect())
    with duckdb.connect() as con:
        con.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
        assert got == sorted(con.execute(sql).fetchall())
    assert len({r[0] for r in got}) == len({i for i, _ in rows if i % 20 == 0})


def test_bounds_hold_and_huge_values_do_not_crash():
    rng = np.random.default_rng(2)
    v, q = rng.integers(-900, 900, (200, 5)), rng.integers(-900, 900, (20, 5))
    va = topk.VaFile(np.arange(200), v)
    assert (va.bounds(q) >= q @ v.T).all()
    big = np.array([[1 << 61, 1 << 61]])
    assert topk._scores(big, big[None])[0, 0] == (1 << 63) - 1
