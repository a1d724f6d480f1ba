"""The training-data pipeline: five stages over ``documents``, each written as Parquet and read again.

language    documents in which no language can be told (null texts, texts without a letter) go; without a row to learn
            languages from, every text with a letter counts as one unnamed language
near        of each group of near copies (5-word shingles, Jaccard 0.8 or more) the document with the smallest id stays;
            what happens to repeated ids is said at ``jaccard.one_of_each``
substrings  words covered by a 20-word passage that starts earlier in the corpus go; wholly repeated documents go
leaks       documents with a benchmark item in them go
packing     the rest is tokenised and packed into sequences of 1024 tokens

All but the last stage return the columns of their input. Rows with a null id take part in every stage but are no one's
near copy. Empty input gives empty output; columns beyond those of ``documents`` pass through, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acoustispark.llm import decontam, jaccard, langid, packing, phrases
from acoustispark.llm.common import staged, table
from acoustispark.llm.queries import BYTE_BPE


def _carried(docs: DataFrame) -> DataFrame:
    """The text beside all columns as one, so that no new column can clash with them."""
    return docs.select(F.col("doc_id"), F.col("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = langid.train(docs.select("doc_id", "text", "lang"), langid.fold("doc_id", 4) != 2)
    model = model if model.labels else langid.Crf(["unnamed"], set())  # nothing learned: `und` must still mean no letter
    told = langid.identify(_carried(docs), model, keep=["__row"])
    return told.where(F.col("lang_pred") != "und").select("__row.*")


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard.one_of_each(docs)


def substrings(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    cut = phrases.remove_repeats(_carried(docs), keep=["__row"], one_blank=False)
    left = cut.where((F.col("n_removed") == 0) | (F.col("n_removed") < F.col("n_words")))
    new = {"text": F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("__row.text"))}
    new["n_chars"] = F.when(F.col("n_removed") > 0, F.length("kept")).otherwise(F.col("__row.n_chars")) if "n_chars" in docs.columns else None
    return left.select(*[new[c].cast(docs.schema[c].dataType).alias(c) if c in new else F.col(f"__row.`{c}`") for c in docs.columns])


def leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    retriever = decontam.train(docs.select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    return decontam.count_leaks(_carried(docs), retriever, keep=["__row"]).where("n_leaks = 0").select("__row.*")


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs.select("doc_id", "text"), BYTE_BPE)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", language), ("near", near), ("substrings", substrings), ("leaks", leaks), ("packing", packed)]

#: The trained stages cannot be said in SQL; tests/llm holds the pipeline against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = staged(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
