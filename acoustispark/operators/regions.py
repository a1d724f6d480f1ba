"""Connected regions of a mask over pings and range samples.

A ping's masked samples are runs; runs of neighbouring pings that share a sample are linked; linked runs are one region.
Regions are found by alternating large and small stars over the links, with rows of runs and not of samples, and nothing is
gathered: a region may be as long as a survey line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acoustispark.operators.pings import segment_keys
from acoustispark.operators.util import staged


def runs(mask: Column) -> Column:
    """``array<struct<a,b>>``: first and last place of every run of true elements."""
    at = lambda i: F.coalesce(F.get(mask, i), F.lit(False))
    places = F.when(F.size(mask) > 0, F.sequence(F.lit(0), F.size(mask) - 1))
    first = F.filter(places, lambda i: at(i) & ((i == 0) | ~at(F.greatest(i - 1, F.lit(0)))))
    last = F.filter(places, lambda i: at(i) & ~at(i + 1))
    return F.zip_with(first, last, lambda a, b: F.struct(a.alias("a"), b.alias("b")))


def _apart(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that is not broadcast: that passes through the driver, and a small file of links or runs may be
    large when it is unpacked."""
    return df.hint("merge")


def _nearest(links: DataFrame) -> DataFrame:
    """Each node's smallest neighbour, or itself where that is smaller."""
    return links.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))


def components(links: DataFrame) -> DataFrame:
    """(node, root) of every node of ``links`` (u, v): the smallest node that it is connected with. Each round is two
    aggregations with map-side combine and two joins, written to the scratch folder; their number grows with the logarithm of
    the longest path."""
    cur = staged(links.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u != v").distinct(), "links")
    while True:
        both = cur.unionByName(cur.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.where("v > u").join(_apart(_nearest(both)), "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        pulled = large.join(_apart(_nearest(large)), "u")
        small = pulled.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(pulled.select("u", F.col("m").alias("v")))
        nxt = staged(small.where("u != v").distinct(), "links")
        ends = nxt.select(F.col("v").alias("u")).distinct()
        done = nxt.join(_apart(ends), "u", "left_semi").isEmpty() and nxt.groupBy("u").count().where("count > 1").isEmpty()
        cur = nxt
        if done:
            break
    return cur.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        cur.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def label_regions(pings: DataFrame, found: str, keep: list[str]) -> DataFrame:
    """One row per run of ``pings`` (ping rows with ``ping_index`` and the array of runs ``found``, structs with ``a`` and
    ``b``): segment keys, channel, ping_index, ping_time, the runs' fields ``keep``, and ``region``, the first run of its
    region."""
    keys = [*segment_keys(pings), "channel"]
    flat = pings.select(*keys, "ping_index", "ping_time", F.explode(found).alias("_r")).select(*keys, "ping_index", "ping_time", *[F.col("_r")[c].alias(c) for c in ("a", "b", *keep)])
    flat = staged(flat.withColumn("node", F.struct(*keys, "ping_index", "a")), "runs")
    left = flat.select(*keys, (F.col("ping_index") + 1).alias("ping_index"), F.col("node").alias("v"), F.col("a").alias("la"), F.col("b").alias("lb"))
    links = flat.join(_apart(left), [*keys, "ping_index"]).where((F.col("a") <= F.col("lb")) & (F.col("la") <= F.col("b"))).select(F.col("node").alias("u"), "v")
    roots = components(links)
    return flat.join(_apart(roots), "node", "left").withColumn("region", F.coalesce("root", "node")).drop("root", "node")


def largest(labelled: DataFrame, keys: list[str]) -> DataFrame:
    """The runs of each channel's largest region: most pings, then most samples, then the first one [def]."""
    size = labelled.groupBy(*keys, "region").agg(F.count_distinct("ping_index").alias("p"), F.sum(F.col("b") - F.col("a") + 1).alias("n"))
    best = size.groupBy(*keys).agg(F.min(F.struct((-F.col("p")).alias("p"), (-F.col("n")).alias("n"), "region")).alias("_best"))
    return labelled.join(_apart(best.select(F.col("_best.region").alias("region"))), "region", "left_semi")


def touched(labelled: DataFrame, flag: str) -> DataFrame:
    """The runs of all regions with a flagged run."""
    return labelled.join(_apart(labelled.where(F.col(flag)).select("region").distinct()), "region", "left_semi")


def with_line(pings: DataFrame, kept: DataFrame, depth: str) -> DataFrame:
    """``seabed_depth`` of every ping: the shallowest of ``depth`` over its kept runs; NULL without one."""
    keys = [*segment_keys(pings), "channel", "ping_time"]
    return pings.join(_apart(kept.groupBy(*keys).agg(F.min(depth).alias("seabed_depth"))), keys, "left")
