"""Spelling variants grouped over a variable-length gram index.

A gram dictionary holds the grams that many words share; a word's gram at a place grows while it is in the dictionary, so
rare spellings are cut into short grams and common ones into long grams. The end of a gram follows from its own letters
alone: an edit changes just the grams that hold the edited letter. The most grams one letter of a word lies in is the
word's bound: of any ``bound + 1`` grams one survives an edit, so only that many - the rarest - enter the inverted lists.
Lists are merged by gram, place and length, and every candidate is verified by its edit distance.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from acoustispark.llm.common import ascii_lower, staged

#: Words are runs of these, as a pattern; a word has ``LEAST_LETTERS`` code points and ``LEAST_COUNT`` occurrences at least.
RUN, LEAST_LETTERS, LEAST_COUNT = "[A-Za-zÀ-ÿ]", 7, 2
#: Of the runs one in ``DAMAGE`` loses a letter, as the contract says.
DAMAGE = 31
#: Gram lengths, marks before a word, and how many times a gram must occur to be in the dictionary.
SHORT, LONG, MARKS, COMMON = 3, 6, 2, 64
#: The dictionary travels to the tasks: at most so many grams (some 50 MB there). Beyond, only the most frequent ones are
#: in it; grams are then shorter and lists longer, but the result is the same.
MOST_GRAMS = 400_000
#: A variant's standard form occurs at least this many times as often.
TIMES = 10


def word_counts(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n) of all whole texts: maximal runs of letters, lower-cased in A-Z only, one in ``DAMAGE`` of them (by the
    crc32 of id and run) without one of its letters. A null id is an empty one in that crc32; null texts have no words."""
    runs = docs.select(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).alias("id"), F.explode(
        F.regexp_extract_all(F.col(text), F.lit(f"({RUN}{{{LEAST_LETTERS},}})"), F.lit(1))).alias("run"))
    low = runs.select("id", ascii_lower("run").alias("run"))
    h = low.withColumn("h", F.crc32(F.concat("id", F.lit(":"), "run")))
    cut = F.concat(F.expr("substring(run, 1, cast(h % length(run) as int))"), F.expr("substring(run, cast(h % length(run) as int) + 2)"))
    words = h.select(F.when(F.col("h") % DAMAGE == 0, cut).otherwise(F.col("run")).alias("word"))
    words = words.where(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


def marked(word: str) -> str:
    """The word between marks, so that every letter starts a gram and the first letters lie in as many as others."""
    return "\x02" * MARKS + word + "\x03" * (LONG - 1)


def gram_dictionary(words: DataFrame, common: int = COMMON, most: int = MOST_GRAMS) -> dict[str, int]:
    """The grams of ``SHORT`` to ``LONG`` letters in more than ``common`` places of the distinct words, with their counts;
    with every gram its beginnings are in it too. The threshold rises until ``most`` grams are left."""
    places = F.expr(f"flatten(transform(sequence(1, length(m) - {LONG - 1}), p -> transform(sequence({SHORT}, {LONG}), l -> substring(m, p, l))))")
    m = F.concat(F.lit("\x02" * MARKS), F.col("word"), F.lit("\x03" * (LONG - 1)))
    grams = words.select(m.alias("m")).select(F.explode(places).alias("gram"))
    counts = staged(grams.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") > common), "grams")
    if counts.count() > most:
        levels = counts.groupBy("n").agg(F.count("*").alias("k")).orderBy(F.desc("n")).toLocalIterator()
        left, floor = most, None
        for r in levels:  # distinct counts only: few, and no further than the bound
            left -= r["k"]
            if left < 0:
                floor = r["n"]
                break
        counts = counts.where(F.col("n") > floor)
    return {r["gram"]: r["n"] for r in counts.toLocalIterator()}


def decompose(word: str, dictionary: dict[str, int]) -> list[tuple[int, str, int]]:
    """(place, gram, count in the dictionary or 0) for every place of the marked word."""
    m, out = marked(word), []
    for p in range(len(word) + MARKS):
        size = SHORT
        gram = m[p:p + size]
        n = dictionary.get(gram, 0)
        while n and size < LONG:
            size += 1
            gram = m[p:p + size]
            n = dictionary.get(gram, 0)
        out.append((p, gram, n))
    return out


def affected(grams: list[tuple[int, str, int]], letters: int) -> int:
    """The most grams that one edit can change: those over one letter. An inserted letter changes the grams over both of its
    neighbours, which are among those over one of them."""
    over = [0] * (letters + MARKS + LONG)
    for p, g, _ in grams:
        for i in range(p, p + len(g)):
            over[i] += 1
    return max(over[MARKS:MARKS + letters])


def list_entries(words: DataFrame, dictionary: dict[str, int]) -> DataFrame:
    """(word, n, letters, place, gram): the ``affected + 1`` rarest grams of every word. The order - count, then gram, then
    place - is the same for all words, so the first gram that two near words share is listed for both."""
    shared = words.sparkSession.sparkContext.broadcast(dictionary)
    schema = "word string, n bigint, letters int, place int, gram string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows: tuple[list, ...] = ([], [], [], [], [])
            for word, n in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                grams = decompose(word, shared.value)
                for p, g, _ in sorted(grams, key=lambda x: (x[2], x[1], x[0]))[:affected(grams, len(word)) + 1]:
                    for col, v in zip(rows, (word, n, len(word), p, g)):
                        col.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.string()), pa.array(rows[1], pa.int64()), pa.array(rows[2], pa.int32()),
                                              pa.array(rows[3], pa.int32()), pa.array(rows[4], pa.string())],
                                             names=["word", "n", "letters", "place", "gram"])

    return words.select("word", "n").mapInArrow(run, schema)


def near_pairs(words: DataFrame, dictionary: dict[str, int]) -> DataFrame:
    """(a, na, b, nb) of every two words one edit apart, once. A gram left of an edit keeps its place and one right of it
    moves by the change of length, so lists are merged by gram, place and length. The lists' key is a hash; the
    edit distance decides."""
    e = staged(list_entries(words, dictionary), "lists")
    mine = e.select(F.xxhash64("gram", "place", "letters").alias("key"), F.col("word").alias("a"), F.col("n").alias("na"))
    ask = F.array(F.struct(F.xxhash64("gram", "place", "letters").alias("key"), F.lit(True).alias("same")),
                  F.struct(F.xxhash64("gram", "place", F.col("letters") - 1).alias("key"), F.lit(False).alias("same")),
                  F.struct(F.xxhash64("gram", F.col("place") - 1, F.col("letters") - 1).alias("key"), F.lit(False).alias("same")))
    theirs = e.select(F.inline(ask), F.col("word").alias("b"), F.col("n").alias("nb")).where(
        F.col("same") | (F.length("b") > LEAST_LETTERS))
    hit = (mine["key"] == theirs["key"]) & (~theirs["same"] | (mine["a"] < theirs["b"])) & (F.levenshtein(mine["a"], theirs["b"], 1) == 1)
    return mine.join(theirs, hit).select("a", "na", "b", "nb").distinct()


def _roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words with a form: pointers are doubled until none moves. Counts grow tenfold a step, so there
    is no circle and a chain has at most some nineteen steps, five rounds."""
    cur = staged(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = cur.select(F.col("word").alias("root"), F.col("root").alias("further"))
        nxt = staged(cur.join(ahead, "root", "left").select("word", F.coalesce("further", "root").alias("root"),
                                                            F.col("further").isNotNull().alias("moved")), "forms")
        if nxt.where("moved").isEmpty():
            return nxt.select("word", "root")
        cur = nxt.select("word", "root")


def variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", common: int = COMMON, most: int = MOST_GRAMS) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of the texts (see ``word_counts``).

    Near words differ by exactly one inserted, deleted or replaced code point. A word's form is its near word of largest n
    (ties: smallest in code-point order) if that n is ``TIMES`` times the word's own; its root is the end of the chain of
    forms, itself if it has none. Null and empty texts have no words; equal rows count as often as they stand; an empty table
    gives an empty result; other columns are not read. A word has at most some hundred near words a letter (the alphabet),
    so no group grows with the corpus; words of any length are cut the same way.
    """
    words = staged(word_counts(docs, doc_id, text), "words")
    near = staged(near_pairs(words, gram_dictionary(words, common, most)), "near")
    both = near.unionByName(near.select(F.col("b").alias("a"), F.col("nb").alias("na"), F.col("a").alias("b"), F.col("na").alias("nb")))
    best = both.groupBy(F.col("a").alias("word")).agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("nb")).alias("m"), F.col("b").alias("b"))).alias("best"))
    fits = -F.col("best.m") >= TIMES * F.col("n")
    rows = staged(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.b")).alias("form"),
        F.when(fits, -F.col("best.m")).alias("form_n")), "variants")
    roots = _roots(rows.where(F.col("form").isNotNull()))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
