"""URL rules found by their rarest literal token; only the rules a URL's own tokens fetch run a regular expression."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile(r"[a-z0-9]+")
_LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


@dataclass(frozen=True)
class Rule:
    """``host/path`` (``host_rule``): that host and its subdomains, paths that start with ``/path``; or a pattern over
    the whole lower-cased URL, where ``^`` is a separator or an end and ``*`` is anything."""

    text: str
    allow: bool
    host_rule: bool

    def regex(self) -> re.Pattern:
        if self.host_rule:
            host, slash, path = self.text.partition("/")
            return re.compile(r"(?:[^/]*\.)?" + re.escape(host) + (re.escape(slash + path) if slash else "(?=/|$)"), re.S)
        body = "".join({"^": r"(?:[^a-z0-9]|^|$)", "*": ".*"}.get(c, re.escape(c)) for c in self.text)
        return re.compile(".*?" + body, re.S)

    def tokens(self) -> list[str]:
        """Literal tokens that every matching URL has as whole tokens."""
        low = self.text.translate(_LOWER)
        found = []
        for m in TOKEN.finditer(low):
            left = low[m.start() - 1] if m.start() else ("^" if self.host_rule else "*")
            right = low[m.end()] if m.end() < len(low) else ("^" if self.host_rule and "/" not in low else "*")
            if left != "*" and right != "*":
                found.append(m.group())
        return found


def host_rule(text: str, allow: bool) -> Rule:
    return Rule(text, allow, True)


def pattern(text: str, allow: bool) -> Rule:
    return Rule(text, allow, False)


def split_url(url: str | None) -> tuple[str, str]:
    """(host, path); both empty without ``://``."""
    at = url.find("://") if url else -1
    if at < 0:
        return "", ""
    rest = url[at + 3:]
    end = next((i for i, c in enumerate(rest) if c in "/?#"), len(rest))
    cut = next((i for i in range(end, len(rest)) if rest[i] in "?#"), len(rest))
    return rest[:end].translate(_LOWER), rest[end:cut]


def token_frequency(pages: DataFrame, url: str, wanted: set[str]) -> dict[str, int]:
    """How many URLs hold each of the rules' tokens, over all rows; as many numbers as rules have tokens."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n: Counter = Counter()
        for b in batches:
            for u in b.column(0).to_pylist():
                n.update(wanted.intersection(TOKEN.findall((u or "").translate(_LOWER))))
        yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())],
                                         names=["token", "n"])
    rows = pages.select(url).mapInArrow(count, "token string, n long").groupBy("token").agg(F.sum("n").alias("n"))
    return {r["token"]: r["n"] for r in rows.collect()}


def filter_urls(pages: DataFrame, rules: Sequence[Rule], page_id: str = "page_id", url: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, pattern of every row.

    Of the host rules that fit, the longest text wins and gives rule and verdict. Without one, a URL is blocked if a
    block pattern fits and no allow pattern does (``pattern`` names the first that fits, in list order, the allow
    patterns first). The rule list is a parameter of the job: it travels with the tasks. A null URL, or one without
    ``://``, has an empty host and path and is allowed unless a pattern fits. Repeated rows are judged each; other
    columns are not read; an empty table gives an empty result.
    """
    freq = token_frequency(pages, url, {t for r in rules for t in r.tokens()})
    index: dict[str, list[int]] = {}
    always: list[int] = []
    for i, r in enumerate(rules):
        toks = r.tokens()
        if toks:
            index.setdefault(min(toks, key=lambda t: (freq.get(t, 0), t)), []).append(i)
        else:
            always.append(i)  # no whole literal token: tried on every URL

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        compiled = [r.regex() for r in rules]
        for b in batches:
            rows = []
            for u in b.column(1).to_pylist():
                host, path = split_url(u)
                low, place = (u or "").translate(_LOWER), host + path
                found = sorted({i for t in set(TOKEN.findall(low)) for i in index.get(t, ())} | set(always))
                fits = [rules[i] for i in found if compiled[i].match(place if rules[i].host_rule else low)]
                hosts = [r for r in fits if r.host_rule] if host else []
                if hosts:
                    best = max(hosts, key=lambda r: (len(r.text), r.text))
                    rows.append((host, path, best.text, "allow" if best.allow else "block", None))
                    continue
                own = sorted((r for r in fits if not r.host_rule), key=lambda r: not r.allow)
                verdict = "block" if own and not own[0].allow else "allow"
                rows.append((host, path, None, verdict, own[0].text if own else None))
            cols = list(zip(*rows)) or [()] * 5
            yield pa.RecordBatch.from_arrays([b.column(0)] + [pa.array(c, pa.string()) for c in cols],
                                             names=["page_id", "host", "path", "rule", "verdict", "pattern"])

    kind = pages.schema[page_id].dataType.simpleString()
    return pages.select(page_id, url).mapInArrow(
        judge, f"page_id {kind}, host string, path string, rule string, verdict string, pattern string")
