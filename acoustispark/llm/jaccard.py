"""N-gram Jaccard join by vertical partitioning.

1. Shingles of all texts go to fragments of the key space; each fragment finds the keys that several documents hold and
   tells every document which of its keys those are, and how frequent. A key of one document alone never overlaps, so a
   document whose repeated keys do not reach the threshold of its own size has no partner.
2. The keys of the rest are put in one global order, rarest first. Two sets that link share a key among the first few
   (the prefix). Candidates come from there, and their overlap is counted separately in each fragment of the order and
   summed per pair.
3. Within a key's group candidates are first only the members with one hub; members already connected need no more
   comparisons. After some rounds, or one without a link, all pairs that are still in different components are compared, so
   no link is lost.
"""

from __future__ import annotations

import contextlib
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from acoustispark.llm.bytewords import pack48, runs, unpack48, word_hashes
from acoustispark.llm.common import components, shuffle_width, staged

BLOCK = "fragment int, batch long, head boolean, ids binary, counts binary, keys binary"
#: Rounds before all remaining pairs are compared: hubs of a key's group, and how many of them a member is compared with.
ROUNDS = ((1, 2), (2, 2), (4, 2), (8, 4), (16, 4))
#: Fragments of the global order in which overlaps are counted.
ORDER_FRAGMENTS = 4
_MASK48 = np.uint64((1 << 48) - 1)


def shingle_sets(raws: list[bytes], n: int, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """(48-bit keys of all texts, sorted inside a text; size of each set). A text of fewer than ``n`` words has its whole
    sequence as its only shingle; one without words has none."""
    words, lens = word_hashes(raws, lower)
    at = np.cumsum(lens) - lens
    grams = runs(words, n) & _MASK48
    sets = [np.unique(grams[a:a + k - n + 1]) if k >= n else runs(words[a:a + k], int(k)) & _MASK48 if k else grams[:0]
            for a, k in zip(at, lens)]
    sizes = np.array([len(s) for s in sets], dtype=np.int64)
    return (np.concatenate(sets) if sets else grams[:0]), sizes


def _blocks(docs: DataFrame, doc_id: str, text: str, n: int, parts: int, most: int = 1 << 22) -> DataFrame:
    """Keys of groups of documents, one row a fragment: ids and set sizes in the ``head`` row, which travels along."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth = TaskContext.get().partitionId(), 0
        names = ["fragment", "batch", "head", "ids", "counts", "keys"]

        def flush(ids: list, raws: list) -> pa.RecordBatch:
            batch = part << 32 | nth
            keys, sizes = shingle_sets(raws, n)
            owner = np.repeat(np.arange(len(ids)), sizes)
            where = ((keys >> np.uint64(32)) % np.uint64(parts)).astype(np.uint16)
            order = np.argsort(where, kind="stable")
            edge = np.searchsorted(where[order], np.arange(parts + 1))
            rows = [(nth % parts, batch, True, np.array(ids, dtype="<i8").tobytes(), sizes.astype("<u4").tobytes(), b"")]
            for f in np.flatnonzero(np.diff(edge)):
                some = order[edge[f]:edge[f + 1]]
                rows.append((int(f), batch, False, b"", np.bincount(owner[some], minlength=len(ids)).astype("<u4").tobytes(), pack48(keys[some])))
            kinds = [pa.int32(), pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=names)

        ids, raws, size = [], [], 0
        for b in batches:
            for i, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                ids.append(i)
                raws.append((t or "").encode())
                size += len(raws[-1]) + 64
                if size >= most:
                    yield flush(ids, raws)
                    nth += 1
                    ids, raws, size = [], [], 0
        if ids:
            yield flush(ids, raws)

    return docs.select(F.col(doc_id).cast("long"), text).where(F.col(doc_id).isNotNull()).mapInArrow(run, BLOCK)


def _repeated(t: pa.Table) -> pa.Table:
    """Of one fragment: for every block its keys that occur in more than one document, with their frequency."""
    heads, blocks = [], []
    for r in t.to_pylist():
        (heads if r["head"] else blocks).append(r)
    rows = [(h["batch"], True, h["ids"], h["counts"], b"") for h in heads]
    if blocks:
        held = [unpack48(b["keys"]) for b in blocks]
        keys = np.concatenate(held)
        order = np.argsort(keys)
        ranked = keys[order]
        first = np.flatnonzero(np.concatenate([[True], ranked[1:] != ranked[:-1]]))
        freq = np.empty(len(keys), dtype=np.int64)
        freq[order] = np.repeat(np.diff(first, append=len(keys)), np.diff(first, append=len(keys)))
        at = 0
        for b, k in zip(blocks, held):
            own = freq[at:at + len(k)]
            at += len(k)
            again = own > 1
            if again.any():
                counts = np.frombuffer(b["counts"], "<u4")
                owner = np.repeat(np.arange(len(counts)), counts)[again]
                rows.append((b["batch"], False, np.bincount(owner, minlength=len(counts)).astype("<u4").tobytes(),
                             np.minimum(own[again], 0x7FFF).astype("<u2").tobytes(), pack48(k[again])))
    cols = list(zip(*rows)) or [()] * 5
    kinds = [pa.int64(), pa.bool_(), pa.binary(), pa.binary(), pa.binary()]
    return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)], names=["batch", "head", "ids", "freqs", "keys"])


def _assembler(percent: int):
    """Of one batch: every document with its set size; with its repeated keys, rarest first, if these can reach the
    threshold; with a digest if its whole set is repeated; and with the mean frequency of its repeated keys."""
    def run(t: pa.Table) -> pa.Table:
        rows = t.to_pylist()
        head = next(r for r in rows if r["head"])
        ids, sizes = np.frombuffer(head["ids"], "<i8"), np.frombuffer(head["freqs"], "<u4").astype(np.int64)
        owners, codes = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        for r in rows:
            if not r["head"]:
                counts = np.frombuffer(r["ids"], "<u4")
                owners.append(np.repeat(np.arange(len(counts)), counts))
                codes.append(np.frombuffer(r["freqs"], "<u2").astype(np.int64) << 48 | unpack48(r["keys"]).astype(np.int64))
        owner, code = np.concatenate(owners), np.concatenate(codes)
        order = np.lexsort((code, owner))
        owner, code = owner[order], code[order]
        have = np.bincount(owner, minlength=len(ids))
        ends = np.cumsum(have)
        out, sig, common = [], [], []
        for n, k, e in zip(sizes, have, ends):
            mine = code[e - k:e]
            common.append(float((mine >> 48).mean()) if k else 0.0)
            out.append(mine if n and 100 * k >= percent * n else None)
            sig.append(hashlib.blake2b(np.sort(mine & ((1 << 48) - 1)).tobytes(), digest_size=16).digest() if n and k == n else None)
        return pa.Table.from_arrays([pa.array(ids), pa.array(sizes), pa.array(out, pa.list_(pa.int64())), pa.array(sig, pa.binary()), pa.array(common, pa.float64())],
                                    names=["doc_id", "n", "codes", "sig", "common"])
    return run


def _verify(pairs: DataFrame, segments: DataFrame, percent: int, parts: int) -> DataFrame:
    """The pairs (id, id2) with labels c and c2 whose overlaps, counted fragment by fragment and summed, reach the threshold:
    a, b and their labels ca, cb. A pair is one row through all of it, not one a fragment. Pairs that lie by ``id`` stay so."""
    left = segments.select("id", F.col("segs").alias("sa"), F.col("n").alias("na"))
    right = segments.select(F.col("id").alias("id2"), F.col("segs").alias("sb"), F.col("n").alias("nb"))
    both = pairs.select("id", "id2", "c", "c2").join(left, "id").join(right, "id2")
    counted = [F.size(F.array_intersect(F.col("sa")[i], F.col("sb")[i])) for i in range(parts)]
    overlap = sum(counted[1:], counted[0]).cast("long")  # named once: 100 * overlap >= percent * (na + nb - overlap)
    return both.where(overlap * (100 + percent) >= (F.col("na") + F.col("nb")) * percent).select(
        F.col("id").alias("a"), F.col("id2").alias("b"), F.col("c").alias("ca"), F.col("c2").alias("cb"))


def _merge(labels: DataFrame, links: DataFrame) -> DataFrame:
    """(id, c) of all nodes after links between the labels ``ca`` and ``cb``: every component takes the smallest label beside
    it, and then the label that one took. Nodes of one label are connected; connected labels may stay apart until the exact
    components are found at the end."""
    both = links.select(F.explode(F.array(F.struct("ca", "cb"), F.struct(F.col("cb").alias("ca"), F.col("ca").alias("cb")))).alias("e")).select("e.*")
    hook = both.groupBy("ca").agg(F.least(F.min("cb"), F.first("ca")).alias("m"))
    jump = hook.join(hook.select(F.col("ca").alias("m"), F.col("m").alias("m2")), "m", "left").select(
        F.col("ca").alias("c"), F.least("m", "m2").alias("to")).where("c != to")
    return staged(labels.join(jump, "c", "left").select("id", F.coalesce("to", "c").alias("c")), "labels")


def similar_components(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_shingles, component_id of every row: sets of distinct ``n``-word shingles (A-Z lower-cased), linked
    where 100 * intersection >= ``percent`` * union; a component is named by its smallest id.

    Null and blank texts have no shingles and no links. Equal sets are one node. Rows with a null id have sizes but no
    component. Several texts under one id: each row has its own set and size, what one of them links to is linked to the
    id, and all rows of the id have one component. Other columns are not read, and an empty table gives an empty result.
    Keys are 48 bits of a hash, which also choose the fragment: two of m shingles are taken for one with a chance of about
    m * m / 2^49.
    """
    named = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    rows = _own_keys(named)
    if rows is None:
        out = _row_components(named, n, percent)
    else:
        found = staged(_row_components(rows.select(F.col("key").alias("doc_id"), "text"), n, percent), "rows")
        found = rows.join(found.withColumnRenamed("doc_id", "key"), "key")
        links = found.select(F.col("key").alias("a"), F.col("component_id").alias("b")).unionByName(
            found.select(F.col("key").alias("a"), F.col("doc_id").alias("b"))).where("a != b")
        comp = components(links).withColumnRenamed("node", "doc_id")
        sizes = found.select("doc_id", "text", "n_shingles").join(comp, "doc_id", "left").select(
            "doc_id", "text", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
        out = named.alias("d").join(sizes.alias("s"), (F.col("d.doc_id") == F.col("s.doc_id")) & F.col("d.text").eqNullSafe(F.col("s.text"))).select(
            "d.doc_id", "n_shingles", "component_id")
    return out.unionByName(_without_id(docs, doc_id, text, n))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` without near copies: of every group of linked rows the one with the smallest id stays.

    Rows with a null id all stay and are no one's copies. Rows equal in id and text are one row, the least by the JSON of
    all columns. Of several texts under one id the least comes first, and the others count as larger than every id: they
    stay if no row with an id of its own is their copy.
    """
    none = docs.where(F.col(doc_id).isNull())
    rows = _own_keys(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")))
    if rows is None:
        found = _row_components(docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")), n, percent)
        stay = staged(found.where("doc_id = component_id").select(F.col("doc_id").alias("__stays")), "near")
        return docs.join(stay, F.col(doc_id) == F.col("__stays"), "left_semi").unionByName(none)
    found = _row_components(rows.select(F.col("key").alias("doc_id"), "text"), n, percent)
    stay = staged(found.where("doc_id = component_id").select(F.col("doc_id").alias("key")).join(rows, "key").select(
        F.col("doc_id").alias("i"), F.col("text").alias("t")), "near")
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    once = docs.where(F.col(doc_id).isNotNull()).select(F.col(doc_id).alias("i"), F.col(text).alias("t"), whole.alias("x")).groupBy("i", "t").agg(
        F.min_by("x", F.to_json("x")).alias("x"))
    kept = once.alias("o").join(stay.alias("s"), (F.col("o.i") == F.col("s.i")) & F.col("o.t").eqNullSafe(F.col("s.t")), "left_semi")
    return kept.select("x.*").unionByName(none)


def _own_keys(named: DataFrame) -> DataFrame | None:
    """(key, doc_id, text) of the different rows (doc_id, text) with an id, where some id stands more than once: the least
    text of an id has the id as its key, the others have keys of their own beyond all ids. None where ids are unique."""
    named = named.where(F.col("doc_id").isNotNull())
    if named.groupBy("doc_id").count().where("count > 1").isEmpty():
        return None
    rows = staged(named.distinct(), "distinct")
    first = rows.groupBy("doc_id").agg(F.min(F.struct("text")).alias("least"))
    rows = rows.join(first, "doc_id").withColumn("is_first", F.col("text").eqNullSafe(F.col("least.text"))).drop("least")
    most = rows.agg(F.max("doc_id").alias("m")).first()["m"]
    later = staged(rows.where("not is_first").orderBy("doc_id", "text").select("doc_id", "text", F.monotonically_increasing_id().alias("nth")), "later")
    return staged(rows.where("is_first").select(F.col("doc_id").alias("key"), "doc_id", "text").unionByName(
        later.select((F.col("nth") + F.lit(most + 1)).alias("key"), "doc_id", "text")), "keyed")


def _row_components(named: DataFrame, n: int, percent: int) -> DataFrame:
    """doc_id, n_shingles, component_id of the rows with an id; ids must be unique."""
    spark = named.sparkSession
    parts = min(65536, 2 * shuffle_width(spark))
    blocks = _blocks(named, "doc_id", "text", n, parts)
    told = blocks.repartition(parts, "fragment").groupBy("fragment").applyInArrow(
        _repeated, "batch long, head boolean, ids binary, freqs binary, keys binary")
    sets = staged(told.groupBy("batch").applyInArrow(_assembler(percent), "doc_id long, n long, codes array<long>, sig binary, common double"), "sets")

    equal = staged(sets.where(F.col("sig").isNotNull()).groupBy("sig").agg(F.min("doc_id").alias("rep")), "equal")
    whole = sets.where(F.col("codes").isNotNull())
    near = whole.join(equal, "sig", "left").where(F.col("rep").isNull() | (F.col("rep") == F.col("doc_id")))
    with _no_broadcast(spark):
        comp = _near_components(staged(near.select(F.col("doc_id").alias("id"), "n", "codes", "common"), "nodes"), percent)

    out = sets.select("doc_id", "n", "sig").join(equal, "sig", "left").withColumn("id", F.coalesce("rep", "doc_id"))
    return out.join(comp, "id", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("c", "id").alias("component_id"))


@contextlib.contextmanager
def _no_broadcast(spark: SparkSession) -> Iterator[None]:
    """Joins of the rounds stay on the executors: what they would broadcast grows with the groups of near copies, and
    passes through the driver."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    before = {n: spark.conf.get(n, None) for n in names}
    for n in names:
        spark.conf.set(n, "-1")
    try:
        yield
    finally:
        for n, v in before.items():
            if v is None:
                spark.conf.unset(n)
            else:
                spark.conf.set(n, v)


def _without_id(docs: DataFrame, doc_id: str, text: str, n: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            _, sizes = shingle_sets([(t or "").encode() for t in b.column(0).to_pylist()], n)
            yield pa.RecordBatch.from_arrays([pa.nulls(len(sizes), pa.int64()), pa.array(sizes), pa.nulls(len(sizes), pa.int64())],
                                             names=["doc_id", "n_shingles", "component_id"])
    return docs.where(F.col(doc_id).isNull()).select(text).mapInArrow(run, "doc_id long, n_shingles long, component_id long")


def _near_components(nodes: DataFrame, percent: int) -> DataFrame:
    """(id, c) of the linked nodes among nodes (id, n, codes) with different sets."""
    cuts = nodes.select(F.explode("codes").alias("code")).agg(
        F.percentile_approx("code", [i / ORDER_FRAGMENTS for i in range(1, ORDER_FRAGMENTS)], 1000).alias("c")).first()["c"] or []
    edges = [0, *sorted(set(cuts)), (1 << 63) - 1]
    segs = F.array(*[F.expr(f"filter(codes, x -> x >= {a}L and x < {b}L)") for a, b in zip(edges, edges[1:])])
    segments = nodes.select("id", "n", segs.alias("segs"))

    held = F.size("codes")
    first = held - F.expr(f"ceil({percent} * n / 100)").cast("int") + 1  # the prefix; unrepeated keys come before it
    prefix = nodes.select("id", "n", held.alias("r"), "common", F.posexplode(F.slice("codes", F.lit(1), first)).alias("pos", "key"))
    shared = prefix.groupBy("key").agg(F.count("*").alias("m")).where("m > 1").select("key")
    members = staged(prefix.join(shared, "key"), "prefix")
    labels = None  # (id, c) of all nodes, once some are linked; until then every node is its own label
    every = None

    # sizes allow the overlap that two sets need, and so do the places of the shared key in their orders
    need = f"ceil({percent} * (n + n2) / {100 + percent})"
    possible = F.expr(f"100 * least(n, n2) >= {percent} * greatest(n, n2) and "
                      f"least(pos, pos2) + 1 + least(r - pos, r2 - pos2) - 1 >= {need}")
    # a pair comes up at the first key that both prefixes share, and only if what they share there and what the one
    # whose prefix ends first has left can make up the overlap
    once = F.expr(f"""try_element_at(array_intersect(head, head2), 1) = key and size(array_intersect(head, head2)) + case
        when element_at(head, -1) <= element_at(head2, -1) then r - size(head) else r2 - size(head2) end >= {need}""")
    turn = 0
    while turn <= len(ROUNDS):
        now = members.withColumn("c", F.col("id")) if labels is None else members.join(labels, "id")
        if turn < len(ROUNDS):
            hubs, partners = ROUNDS[turn]
            # hubs of the first round: members whose keys are the most frequent, as an unchanged original's are
            first_of = Window.partitionBy("key").orderBy(F.xxhash64("id", F.lit(turn)) if turn else F.desc("common"), "id")
            hub = now.withColumn("k", F.row_number().over(first_of)).where(F.col("k") <= hubs)
            near = now.join(hub.select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "r", "pos", "c")]), "key").where("c != c2").where(possible)
            # dealt by the member once: its votes, its best hubs and its set meet there
            votes = near.select("id", "id2", "c", "c2").repartition("id").groupBy("id", "id2", "c", "c2").agg(F.count("*").alias("votes"))
            best = Window.partitionBy("id").orderBy(F.col("votes").desc(), "id2")
            pairs = votes.withColumn("k", F.row_number().over(best)).where(F.col("k") <= partners)
        else:
            opened = now.join(now.groupBy("key").agg(F.min("c").alias("lo"), F.max("c").alias("hi")).where("lo < hi").select("key"), "key", "left_semi")
            heads = nodes.select("id", F.slice("codes", F.lit(1), first).alias("head"))
            full = opened.join(heads, "id")
            other = full.select("key", *[F.col(c).alias(f"{c}2") for c in ("id", "n", "r", "pos", "c", "head")])
            pairs = full.join(other, "key").where("id < id2 and c != c2").where(possible).where(once)
        links = staged(_verify(pairs, segments, percent, len(edges) - 1), "links")
        if not links.isEmpty():
            every = links if every is None else every.unionByName(links)
            if turn < len(ROUNDS):
                labels = _merge(nodes.select("id", F.col("id").alias("c")) if labels is None else labels, links)
            turn += 1
        else:  # hubs that nothing links to save no comparisons: on to all that are left
            turn = len(ROUNDS) if turn < len(ROUNDS) else turn + 1
    if every is None:
        return nodes.select("id", F.col("id").alias("c")).limit(0)
    return components(every).select(F.col("node").alias("id"), F.col("component").alias("c"))
