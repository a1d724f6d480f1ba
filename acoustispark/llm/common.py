"""Helpers shared by the training-data operators: scans, shared staging tables, dense ranks, components."""

from __future__ import annotations

import contextlib
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: A word is a run of anything but blank and the five ASCII white-space controls.
WORD = re.compile(r"[^\x20\x09-\x0D]+")

#: Texts are handed to Python in small Arrow batches, so a batch of long texts stays small.
ROWS_PER_BATCH = 512


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; a private one only where that is unset on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="acoustispark-llm-")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


@contextlib.contextmanager
def freed_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files of what runs inside are removed as each run ends and not when the driver next collects garbage: a
    table that is written is read from then on, so its shuffles have no further use."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def staged(df: DataFrame, name: str) -> DataFrame:
    """Cut lineage: write ``df`` as a Parquet table in the shared folder and read it back."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    with freed_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def shuffle_width(spark: SparkSession) -> int:
    """Partitions of the session's shuffles; block counts follow it, so that a block's size does not grow with the input."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def map_texts(df: DataFrame, text: str, fn: Callable[[list], list], added: str, keep: list[str]) -> DataFrame:
    """``keep`` columns plus what ``fn(list of texts) -> list of equally long columns`` computes, in Arrow batches.

    ``added`` is a DDL string of the new columns. ``fn`` is made once per task by ``fn()`` if it is a factory
    (has ``factory`` set), so caches live as long as a task.
    """
    spark = df.sparkSession
    from pyspark.sql.pandas.types import to_arrow_schema
    probe = spark.createDataFrame([], added).schema
    out = df.select(*keep).schema
    for f in probe:
        out = out.add(f)
    arrow = to_arrow_schema(out)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = fn()
        for b in batches:
            cols = work(b.column(len(keep)).to_pylist())
            arrays = [b.column(i) for i in range(len(keep))] + [
                pa.array(c, type=arrow.field(len(keep) + i).type) for i, c in enumerate(cols)]
            yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return df.select(*keep, F.col(text).alias("__text")).mapInArrow(run, out)


def dense_rank_within(df: DataFrame, key: str, order: list[str], salts: int, rank: str = "rank"
                      ) -> tuple[DataFrame, list]:
    """Rows with a 0-based rank inside (key, salt), and the counts of each (key, salt).

    A key that holds a third of all rows is spread over ``salts`` windows; adding the exclusive running sum of
    the counts over the salts of a key makes the rank dense inside the key. ``key`` must have a bounded number
    of values, as the counts come to the driver.
    """
    salted = df.withColumn("salt", F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"))
    w = Window.partitionBy(key, "salt").orderBy(*order)
    counts = salted.groupBy(key, "salt").count().collect()
    return salted.withColumn(rank, (F.row_number().over(w) - 1).cast("long")), counts


def _mins(edges: DataFrame) -> DataFrame:
    """For every node its smallest neighbour or itself; a hub's neighbours are combined before the shuffle."""
    return edges.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, component): the smallest node that links ``a``-``b`` reach, by alternating large and small stars.

    Both stars are an aggregation with map-side combine and a join that may be split when a hub is hot; nothing
    is gathered in a task or on the driver. Each round is written to the shared folder.
    """
    cur = staged(edges.where(F.col(a) != F.col(b)).select(
        F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct(), "links")
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(_mins(both), "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u != v").distinct()
        small = large.join(_mins(large), "u")
        small = small.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            small.select("u", F.col("m").alias("v"))).where("u != v").distinct()
        nxt = staged(small, "links")
        # a fixed point is a set of stars: nobody is both a leaf and a centre, and every leaf has one centre
        roles = nxt.select(F.explode(F.array(F.struct(F.col("u").alias("node"), F.lit(1).alias("leaf")),
                                             F.struct(F.col("v").alias("node"), F.lit(0).alias("leaf")))).alias("e")).select("e.*")
        roles = roles.groupBy("node").agg(F.sum("leaf").alias("centres"), F.min("leaf").alias("own"))
        if roles.where("centres > 1 or centres = 1 and own = 0").isEmpty():
            break
        cur = nxt
    return nxt.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(
        nxt.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())


def ascii_lower(c: Column | str) -> Column:
    """A-Z only; other letters keep their case."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
