"""The registered queries of the training-data operators and their DuckDB SQL (None where SQL cannot express one)."""

from __future__ import annotations

import uuid

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acoustispark.llm import bpe, decontam, jaccard, langid, order, packing, phrases, quality, topk, toxicity, turns, urls, variants
from acoustispark.llm.common import shared_dir, staged, table

BYTE_BPE = public_tokenizers.path("byte_bpe_50k.json")

# The host rules of the contract.
HOST_RULES = [("org/", True), ("example.org/es/", False), ("example.org/en/1", False), ("com/fr/", True), ("com/de/", False)]
#: Patterns for URLs without a host rule: words of unwanted sites between separators, and an exception.
PATTERNS = [("^casino^", False), ("^bets^", False), ("^pills^", False), ("^poker^", False), ("^viagra^", False),
            ("^porn^", False), ("^escort^", False), ("^casino^*^history^", True)]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = [urls.host_rule(t, a) for t, a in HOST_RULES] + [urls.pattern(t, a) for t, a in PATTERNS]
    return urls.filter_urls(table(spark, sf_dir, "pages"), rules)


def _rule_values() -> str:
    return ", ".join(f"('{t}', '{t.partition('/')[0]}', '/{t.partition('/')[2]}', '{'allow' if a else 'block'}')" for t, a in HOST_RULES)


def _pattern_values() -> str:
    def rx(t: str) -> str:
        return "".join({"^": "(?:[^a-z0-9]|^|$)", "*": "(?s:.*)"}.get(c, c) for c in t)
    ordered = sorted(PATTERNS, key=lambda p: not p[1])
    return ", ".join(f"({i}, '{t}', '{rx(t)}', '{'allow' if a else 'block'}')" for i, (t, a) in enumerate(ordered))


SQL1 = f"""
with rules(rule, rhost, rpath, verdict) as (values {_rule_values()}),
pats(n, pattern, rx, verdict) as (values {_pattern_values()}),
p as (select page_id, url, row_number() over () as rn,
  coalesce(translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as host,
  coalesce(regexp_extract(url, '://[^/?#]*([^?#]*)', 1), '') as path,
  coalesce(translate(url, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') as low from pages),
h as (select rn, arg_max(rule, length(rule)) as rule, arg_max(verdict, length(rule)) as verdict from p join rules
  on (host = rhost or ends_with(host, '.' || rhost)) and starts_with(path, rpath) group by rn),
m as (select rn, arg_min(pattern, n) as pattern, arg_min(verdict, n) as verdict from p join pats on regexp_matches(low, rx) group by rn)
select p.page_id, p.host, p.path, h.rule, coalesce(h.verdict, m.verdict, 'allow') as verdict,
  case when h.rule is null then m.pattern end as pattern
from p left join h using (rn) left join m using (rn)"""


def op2_training_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = f"{shared_dir(spark)}/shards-{uuid.uuid4().hex}"
    return order.digests(order.write_shards(table(spark, sf_dir, "documents"), BYTE_BPE, out))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.similar_components(table(spark, sf_dir, "documents"), n=4, percent=85)


SQL3 = """
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as w from documents),
s as (select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
o as (select a.doc_id as a, b.doc_id as b, count(*) as o from s a join s b on a.g = b.g and a.doc_id <> b.doc_id group by 1, 2),
e as (select a, b from o join n x on x.doc_id = a join n y on y.doc_id = b where 100 * o >= 85 * (x.n + y.n - o)),
r as (select a, b from e union select r.a, e.b from r join e on r.b = e.a),
c as (select a, min(b) as c from r group by a)
select w.doc_id, coalesce(n.n, 0) as n_shingles, least(w.doc_id, coalesce(c.c, w.doc_id)) as component_id
from w left join n using (doc_id) left join c on c.a = w.doc_id"""


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return decontam.find_leaks(docs, decontam.train(docs, table(spark, sf_dir, "benchmark")))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held = langid.fold("doc_id", 4) == 2
    model = langid.train(docs, ~held)
    rows = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    return langid.identify(rows, model, keep=["doc_id", "held_out"])


def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = phrases.remove_repeats(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


SQL6 = """
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') as w from documents),
p as (select doc_id, unnest(range(1, len(w) - 18)) as s, w from w where len(w) >= 20),
h as (select doc_id, s, md5(array_to_string(w[s:s + 19], ' ')) as h from p),
l as (select doc_id, s from h qualify row_number() over (partition by h order by doc_id, s) > 1),
c as (select distinct doc_id, s + k as i from l, range(20) r(k)),
x as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from w),
k as (select x.doc_id, string_agg(case when c.i is null then word end, ' ' order by x.i) as kept, count(c.i) as n_removed
      from x left join c on c.doc_id = x.doc_id and c.i = x.i group by x.doc_id)
select w.doc_id, len(w.w)::bigint as n_words, coalesce(k.n_removed, 0)::bigint as n_removed, sha256(coalesce(k.kept, '')) as kept_sha256
from w left join k using (doc_id)"""


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), BYTE_BPE)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held = langid.fold("doc_id", 5) == 0
    model = toxicity.train(docs, table(spark, sf_dir, "labels").select("doc_id", "toxic"), ~held)
    rows = docs.select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    return toxicity.score(rows, model, keep=["doc_id", "held_out"])


def op9_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.exact_topk(table(spark, sf_dir, "embeddings"))


SQL9 = """
with v as (select vec_id, list_transform(embedding, lambda x: floor(64 * x::double)) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from v q join v c on q.vec_id % 20 = 0 and c.vec_id <> q.vec_id)
select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s
qualify rank <= 20"""


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), BYTE_BPE)


def op11_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    held = langid.fold("doc_id", 4) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", F.coalesce(held, F.lit(False)).alias("held_out"), "text")
    feats = staged(quality.with_features(docs.withColumn("usable", ~F.col("held_out"))), "features")
    model, prior = quality.train(feats, table(spark, sf_dir, "labels").select("doc_id", "quality"), ~held)
    return quality.score(feats, model, prior, keep=["doc_id", "held_out"])


#: crc32 in SQL over a list of bytes; ``crc`` has its table.
CRC_TABLE = """crc as (select list(v order by i) as t from (select i, list_reduce([i] || range(8), lambda c, k:
  case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as v from (select unnest(range(256)) as i)))"""


def _crc(byte_list: str) -> str:
    return f"xor(list_reduce([4294967295] || {byte_list}, lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = turns.damaged(table(spark, sf_dir, "conversations"))
    return turns.repair(rows).withColumnRenamed("conv", "conv_id")


def _moves() -> str:
    """The actions on one row as SQL values: (state, initial, action, new state, cost, letters, initials put out)."""
    put = {("0", "s"): "s", ("0", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    out = [f"('{p}', '', true, '{p}', 2, 'D', '')" for p in "0sua"]
    for p in "0sua":
        for ins in ("", "u", "a"):
            mid = put.get((p, ins)) if ins else p
            for c in "sua":
                new = put.get((mid, c)) if mid else None
                if new:
                    base, i = 5 * len(ins), "I" * len(ins)
                    out.append(f"('{p}', '{c}', false, '{new}', {base}, '{i}K', '{ins}{c}')")
                    if c != "s":
                        out.append(f"('{p}', '', false, '{new}', {base + 1}, '{i}R', '{ins}{c}')")
    return ", ".join(out)


_BLANKS = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
SQL12 = f"""
with recursive {CRC_TABLE},
ids as (select row_number() over (order by conv_id) as g, conv_id from (select distinct conv_id from conversations)),
raw as (select g, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
  coalesce(c.conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as k from conversations c join ids on c.conv_id is not distinct from ids.conv_id),
kind as (select raw.*, {_crc("list_transform(string_split(k, ''), lambda x: ascii(x)::bigint)")} % 20 as kind from raw, crc),
dam as (select g, turn, case when kind = 4 then 'user' else role end as role,
  case kind when 1 then '' when 2 then translate(text, '.!?', '') else text end as text
  from (select *, unnest(case when kind = 3 then [0, 1] else [0] end) as again from kind where kind <> 0)),
once as (select *, row_number() over (partition by g, role, text order by turn nulls first) > 1 as seen from dam),
o as (select *, row_number() over (partition by g order by turn nulls first, role, text, seen) as i, left(role, 1) as r,
  not regexp_matches(text, '[^\\x20\\x09-\\x0D]') as blank, right(rtrim(text, {_BLANKS}), 1) as tail from once),
f as (select *, not blank and seen as dup, not blank and not seen and tail not in ('.', '!', '?') as cut,
  lag(r) over (partition by g order by i) as before from o),
m(p, c, gone, q, cost, letters, put) as (values {_moves()}),
walk as (
  select g, 1::bigint as i, '0' as p, '000000000' as best from ids
  union all
  select w.g, w.i + 1, m.q, min(lpad((w.best[1:9]::bigint + m.cost + case when f.cut and not m.gone then 5 else 0 end)::varchar, 9, '0')
    || w.best[10:] || m.letters)
  from walk w join f on f.g = w.g and f.i = w.i join m on m.p = w.p and (m.c = '' or m.c = f.r) and (m.gone or not (f.blank or f.dup))
  group by w.g, w.i + 1, m.q),
n as (select ids.g, count(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (blank) as blank,
  count(*) filter (dup) as duplicate, count(*) filter (cut) as truncated,
  count(*) filter (before is not null and before || r not in ('su', 'ua', 'au')) as illegal from ids left join f using (g) group by ids.g),
fin as (select g, min(case p when 'u' then lpad((best[1:9]::bigint + 5)::varchar, 9, '0') || best[10:] || 'I'
    when 's' then lpad((best[1:9]::bigint + 10)::varchar, 9, '0') || best[10:] || 'II' else best end) as best
  from walk join n using (g) where i = n + 1 group by g),
ed as (select g, best[10:] as audit, unnest(range(1, length(best) - 8)) as j from fin),
ou as (select g, j, audit[j] as letter, count(*) filter (audit[j] <> 'I') over w as i, count(*) filter (audit[j] <> 'D') over w as k
  from ed window w as (partition by g order by j)),
li as (select ou.g, ou.j, k, letter, f.role, f.text, max(case when k = 1 and letter = 'K' and f.r = 's' then 1 else 0 end) over (partition by ou.g) as off
  from ou left join f on f.g = ou.g and f.i = ou.i and letter <> 'I' where letter <> 'D'),
tx as (select g, string_agg(case when letter = 'K' then role when (k - off) % 2 = 1 then 'user' else 'assistant' end || ':' ||
  coalesce(text, ''), chr(10) order by j) as said from li group by g)
select conv_id, gaps::bigint as gaps, blank, duplicate, truncated, illegal, best[1:9]::bigint as cost, best[10:] as audit,
  sha256(coalesce(said, '')) as repaired_sha256
from ids join n using (g) join fin using (g) left join tx using (g)"""


def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants.variants(table(spark, sf_dir, "documents"))


SQL13 = f"""
with recursive {CRC_TABLE},
low as (select coalesce(doc_id::varchar, '') as id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\u00C0-\u00FF]+')) as run from documents),
run as (select id, run, count(*) as k from low where length(run) >= 7 group by all),
h as (select run, k, {_crc("list_transform(string_split(id || ':', ''), lambda x: ascii(x)::bigint) || flatten(list_transform(string_split(run, ''), lambda x: case when unicode(x) < 128 then [unicode(x)::bigint] else [195, unicode(x)::bigint - 64] end))")} as h from run, crc),
dam as (select case when h % 31 = 0 then left(run, (h % length(run))::int) || substr(run, (h % length(run))::int + 2) else run end as word, k from h),
w as (select word, sum(k)::bigint as n from dam where length(word) >= 7 group by word having sum(k) >= 2),
del as (select word, n, i, left(word, i - 1) || substr(word, i + 1) as rest from (select word, n, unnest(range(1, length(word) + 1)) as i from w)),
near as (select distinct * from (
  select a.word, a.n, b.word as other, b.n as m from del a join del b on a.rest = b.rest and a.i = b.i and a.word <> b.word
  union all select d.word, d.n, w.word, w.n from del d join w on d.rest = w.word
  union all select w.word, w.n, d.word, d.n from del d join w on d.rest = w.word)),
best as (select word, count(*) as n_near, max(m) as m, arg_min(other, (-m, other)) as other from near group by word),
v as (select w.word, w.n, coalesce(n_near, 0) as n_near, case when m >= 10 * w.n then other end as form, case when m >= 10 * w.n then m end as form_n
  from w left join best using (word)),
up as (select word, word as root, form, 0 as d from v union all select up.word, up.form, v.form, d + 1 from up join v on v.word = up.form)
select v.word, v.n, v.n_near, v.form, v.form_n, r.root from v join (select word, arg_max(root, d) as root from up group by word) r using (word)"""


def registry() -> dict:
    return {
        "op1_url_filters": (op1_url_filters, SQL1),
        "op2_training_order": (op2_training_order, None),
        "op3_ngram_jaccard": (op3_ngram_jaccard, SQL3),
        "op4_decontamination": (op4_decontamination, None),
        "op5_language_id": (op5_language_id, None),
        "op6_substring_dedup": (op6_substring_dedup, SQL6),
        "op7_packing": (op7_packing, None),
        "op8_toxicity": (op8_toxicity, None),
        "op9_exact_topk": (op9_exact_topk, SQL9),
        "op10_token_counts": (op10_token_counts, None),
        "op11_quality_classifier": (op11_quality_classifier, None),
        "op12_conversation_repair": (op12_conversation_repair, SQL12),
        "op13_spelling_variants": (op13_spelling_variants, SQL13),
    }
