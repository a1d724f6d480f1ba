"""Sinks: product store, daily store, manifests, messages, reports and converted groups.

The Parquet stores have one directory a day (and product). Inside it rows are clustered by platform and segment into files
of about ``FILE_BYTES``, so files and listings grow with bytes and not with segments; footers' ranges let a scan skip the files
of other segments. Names of segments repeat between platforms and between days: a segment is known by (day, platform,
name). New segments are appended; where a write holds segments that are stored already (a retry, a replayed micro-batch, a
reprocessing), their days are written anew with the other segments kept, and replaced as Spark commits them. Writers go
through the DataFrame writer, so Spark's commit protocol makes task retries and lost executors safe; only new documents on a
file system that is mounted are put in place by the tasks themselves, under names that a retried task uses again.
"""

from __future__ import annotations

import math
import os
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from acoustispark.operators.util import spread_groups, staged

#: Directories of a product store, of the daily store, and what tells segments apart inside a directory.
PRODUCT_DIRS, DAY_DIRS, SEGMENT_KEYS = ["campaign", "product", "day"], ["day"], ["platform", "segment"]
#: The documents of a segment (manifests, reports) keep a directory each.
DAY_PARTITIONS = ["day", "platform", "segment"]
FILE_BYTES = 128 << 20
#: Pings of one name further apart than this belong to different segments.
MAX_GAP_HOURS = 12
JSON_OPTIONS = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "ignoreNullFields": "false"}


def _write(df: DataFrame, root: str, partitions: list[str], fmt: str = "parquet", **options) -> None:
    """Cluster by the partition columns (copies keep the columns themselves where the format needs them) and replace."""
    clustered = df.repartition(*partitions).sortWithinPartitions(*partitions)
    w = clustered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partitions)
    for k, v in options.items():
        w = w.option(k, v)
    w.format(fmt).save(root)


#: What Spark's writers escape in the name of a directory, and the name that stands for no value.
ESCAPED = {c: f"%{ord(c):02X}" for c in [*map(chr, range(1, 32)), *"\"#%'*/:=?\\\x7f{[]^"]}
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


def _write_documents(df: DataFrame, root: str, partitions: list[str], order: list[str], fmt: str, **options) -> None:
    """A directory a document (text: a line of ``value`` a row; json: a row a line), replaced where it is there already. Documents
    are small and many, and most of their time goes into making files: so they are dealt to a fixed number of tasks, not to as
    few as their bytes ask for, and tasks put their files in place themselves - without Hadoop's local file system, which
    starts a process for every file and directory that it makes. Only a store that holds documents already has the driver
    replace them, one by one."""
    spark = df.sparkSession
    rows = spread_groups(df.withColumns({c: F.nullif(c, F.lit("")) for c in partitions}), *partitions).sortWithinPartitions(*partitions, *order)
    rows = rows.drop(*[o for o in order if o not in partitions])
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    is_new = not fs.exists(path)  # not even in part
    if is_new and fs.getUri().getScheme() == "file":
        body = F.col("value") if fmt == "text" else F.to_json(F.struct(*[c for c in rows.columns if c not in partitions]), options)
        put = _put_documents(fs.makeQualified(path).toUri().getPath(), partitions, "txt" if fmt == "text" else fmt)
        failed = rows.select(*partitions, body.alias("value")).mapInArrow(put, "error string").collect()
        if failed:
            raise OSError(failed[0].error)
        return fs.create(spark._jvm.org.apache.hadoop.fs.Path(path, "_SUCCESS"), True).close()
    w = rows.write.partitionBy(*partitions).format(fmt).option("mapreduce.fileoutputcommitter.algorithm.version", "2")
    for k, v in options.items():
        w = w.option(k, v)
    if is_new:
        return w.mode("append").save(root)
    w.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(root)


def _put_documents(root: str, partitions: list[str], suffix: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function over sorted rows (``partitions``, ``value``) that writes each document under a hidden name and then gives it its
    own, the same in every attempt of a task. What the file system says is told as a row: it is no fault of the data."""
    job = uuid.uuid4().hex

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        name = f"part-{task.partitionId():05d}-{job}.c000.{suffix}"
        at, folder, out, errors = None, "", None, []
        hidden = f".{name}.{task.taskAttemptId()}"

        def finish() -> None:
            out.close()
            os.replace(f"{folder}/{hidden}", f"{folder}/{name}")

        try:
            for batch in batches:
                *keys, values = [batch.column(i).to_pylist() for i in range(batch.num_columns)]
                for key, value in zip(zip(*keys), values):
                    if key != at:
                        if out is not None:
                            finish()
                        at = key
                        folder = "/".join([root, *[f"{c}={NO_VALUE if v is None else ''.join(ESCAPED.get(x, x) for x in v)}" for c, v in zip(partitions, key)]])
                        os.makedirs(folder, exist_ok=True)
                        out = open(f"{folder}/{hidden}", "w", encoding="utf-8", newline="\n")
                    out.write(f"{'' if value is None else value}\n")
            if out is not None:
                finish()
        except OSError as e:
            errors.append(f"{type(e).__name__}: {e}")
        yield pa.RecordBatch.from_pydict({"error": pa.array(errors, pa.string())})

    return put


def stored(spark: SparkSession, root: str, schema=None) -> DataFrame | None:
    """The store as a frame; None where nothing was written yet."""
    try:
        return (spark.read.schema(schema) if schema is not None else spark.read).parquet(root)
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return None
        raise


def _matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """``rows`` that have (``left_semi``) or have not (``left_anti``) their match in ``keys``; nulls match."""
    other = keys.select(*[F.col(c).alias(f"_k_{c}") for c in keys.columns])
    same = F.lit(True)
    for c in keys.columns:
        same = same & F.col(c).eqNullSafe(F.col(f"_k_{c}"))
    return rows.join(other, same, how)


def _cluster(table: DataFrame, root: str, dirs: list[str], keys: list[str], replace: bool) -> None:
    """Write a staged table into the store: as many files as its bytes ask for, each with a range of segments. A long segment
    goes over several files by its time. Directories are one file at least: where there are more of them than the bytes ask
    for, they are dealt to all tasks that run at once."""
    size = int(str(table._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    order = [*dirs, *keys, *[c for c in ("ping_time",) if c in table.columns]]
    files, tasks = max(1, math.ceil(size / FILE_BYTES)), table.sparkSession.sparkContext.defaultParallelism
    many = table.select(*dirs).distinct().limit(tasks).count() if files < tasks else 0
    if many > files:
        dealt = table.repartitionByRange(many, *(dirs if files == 1 else order))  # one file's worth: no directory is cut
    else:
        dealt = table.repartitionByRange(files, *order)
    rows = dealt.sortWithinPartitions(*order)
    w = rows.write.partitionBy(*dirs)
    (w.mode("overwrite").option("partitionOverwriteMode", "dynamic") if replace else w.mode("append")).parquet(root)


def replace_segments(df: DataFrame, root: str, dirs: list[str], keys: list[str] | None = None) -> None:
    """Put the segments of ``df`` into the store; segments of the same key that it holds already are replaced, the others
    of their day survive."""
    keys = SEGMENT_KEYS if keys is None else keys
    new = staged(df, "store-in")
    old = stored(df.sparkSession, root, new.schema)
    if old is None:
        return _cluster(new, root, dirs, keys, False)
    mine = new.select(*dirs, *keys).distinct()
    known = staged(_matching(old.select(*dirs, *keys), mine, "left_semi").select(*dirs).distinct(), "store-days")
    if known.isEmpty():
        return _cluster(new, root, dirs, keys, False)
    kept = _matching(_matching(old, known, "left_semi"), mine, "left_anti").select(*new.columns)
    again = _matching(new, known, "left_semi")
    _cluster(staged(kept.unionByName(again), "store-days"), root, dirs, keys, True)
    first = staged(_matching(new, known, "left_anti"), "store-in")
    if not first.isEmpty():
        _cluster(first, root, dirs, keys, False)


def compact(spark: SparkSession, root: str, dirs: list[str], keys: list[str] | None = None) -> int:
    """Write the days anew that hold more than twice the files their bytes ask for (many small appends); returns how many."""
    df = stored(spark, root)
    if df is None:
        return 0
    files = df.select(*dirs, F.col("_metadata.file_path").alias("_f"), F.col("_metadata.file_size").alias("_b")).distinct()
    per = files.groupBy(*dirs).agg(F.count("*").alias("_n"), F.sum("_b").alias("_b"))
    many = staged(per.where(F.col("_n") > 2 * F.ceil(F.col("_b") / F.lit(FILE_BYTES))).select(*dirs), "store-days")
    n = many.count()
    if n:
        _cluster(staged(_matching(df, many, "left_semi"), "store-days"), root, dirs, SEGMENT_KEYS if keys is None else keys, True)
    return n


def sink_product(df: DataFrame, root: str) -> None:
    """Replace the written segments of a product (``save_product``/``save_zarr(mode='w')``); segments not in ``df`` survive."""
    replace_segments(df, root, PRODUCT_DIRS)


def with_batch_day(df: DataFrame, ts: str = "ping_time") -> DataFrame:
    """``day`` = date of the *first* ping of the row's segment: a segment crossing midnight stays in one day.

    A segment is known by platform and name, and a name may come again: pings of it more than ``MAX_GAP_HOURS`` after the
    last begin another segment. The dates of a (platform, name) are ordered, not its pings. A ``segment_start`` column,
    where there is one, says it directly.
    """
    if "segment_start" in df.columns:
        return df.withColumn("day", F.to_date("segment_start"))
    key = ["platform", "segment"]
    dates = df.groupBy(*key, F.to_date(ts).alias("_date")).agg(F.min(ts).alias("_t0"), F.max(ts).alias("_t1"))
    w = Window.partitionBy(*key).orderBy("_date")
    gap = F.unix_micros(F.col("_t0").cast("timestamp")) - F.unix_micros(F.lag("_t1").over(w).cast("timestamp"))
    new = F.lag("_t1").over(w).isNull() | (gap > F.lit(MAX_GAP_HOURS * 3_600_000_000))
    starts = dates.withColumn("_s", F.when(new, F.col("_date")))
    starts = starts.withColumn("day", F.last("_s", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    out = df.drop("day").withColumn("_date", F.to_date(ts)).join(starts.select(*key, "_date", "day"), [*key, "_date"])
    return out.drop("_date")


def sink_day_append(df: DataFrame, root: str, ts: str = "ping_time") -> None:
    """Daily store: every segment lands in the day of its first ping, by (day, platform, segment). Re-running a batch (a
    retried micro-batch) replaces its segments instead of duplicating them; other segments of the day stay."""
    replace_segments(with_batch_day(df, ts), root, DAY_DIRS)


def manifest(summary: DataFrame, cfg: dict) -> DataFrame:
    """The manifest row of every segment: what was processed, the products written, and the configuration."""
    conf = F.struct(
        F.lit(cfg.get("sonar_model", "EK80")).alias("sonar_model"), F.lit(cfg.get("waveform_mode", "CW")).alias("waveform_mode"),
        F.lit(bool(cfg.get("denoise_enabled", True))).alias("denoise_enabled"),
        F.lit(cfg.get("denoise_methods", "background,transient,impulse,attenuation")).alias("denoise_methods"),
        F.lit(bool(cfg.get("mvbs_enabled", True))).alias("mvbs_enabled"), F.lit(cfg.get("mvbs_range_bin", "0.5")).alias("mvbs_range_bin"),
        F.lit(cfg.get("mvbs_ping_time_bin", "10s")).alias("mvbs_ping_time_bin"), F.lit(bool(cfg.get("nasc_enabled", False))).alias("nasc_enabled"),
        F.lit(cfg.get("nasc_range_bin", "10")).alias("nasc_range_bin"), F.lit(cfg.get("nasc_dist_bin", "0.5")).alias("nasc_dist_bin"),
        F.lit(bool(cfg.get("seabed_enabled", False))).alias("seabed_enabled"), F.lit(bool(cfg.get("use_gpu", True))).alias("use_gpu"))
    pair = lambda lo, hi: F.when(F.col(lo).isNotNull(), F.array(lo, hi))
    has = lambda c, default: F.col(c) if c in summary.columns else default
    label = F.coalesce(has("file_stem", F.lit(None).cast("string")), F.col("segment_name"))
    return summary.select(
        "platform", "day", "segment", label.alias("file"), F.col("segment_name").alias("name"), "start_time", "end_time", "n_pings", "n_channels",
        "frequencies_hz", "channels", has("processing_time_ms", F.lit(0)).cast("long").alias("processing_time_ms"),
        has("products", F.array(F.lit("sv"))).alias("products"),
        has("echogram_files", F.expr("cast(array() as array<string>)")).alias("echogram_files"), conf.alias("config"),
        pair("depth_min", "depth_max").alias("depth_range_m"), pair("lat_min", "lat_max").alias("lat_range"),
        pair("lon_min", "lon_max").alias("lon_range"), "sv_mean_db")


def sink_metadata_json(manifests: DataFrame, root: str) -> None:
    """One JSON manifest per segment, by day, platform and segment (also readable as a table)."""
    rows = manifests.withColumns({f"_{c}": F.col(c).cast("string") for c in DAY_PARTITIONS})
    _write_documents(rows, root, [f"_{c}" for c in DAY_PARTITIONS], [], "json", **JSON_OPTIONS)


def message_rows(df: DataFrame, output: str, key: list[str] | None = None, epoch: int = 0) -> DataFrame:
    """Payload rows for a named output (``output1``, ``outputml``): ``output, message_id, body`` (JSON). The id follows from
    the output, the epoch and the row's ``key`` columns (all, if none are named), so a replayed epoch has the same ids."""
    own = F.to_json(F.struct(*(key or df.columns)), JSON_OPTIONS)
    return df.select(F.lit(output).alias("output"), F.sha2(F.concat_ws("|", F.lit(output), F.lit(epoch), own), 256).alias("message_id"),
                     F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("body"))


def sink_messages(df: DataFrame, outputs: dict[str, Column | None], path: str, key: list[str] | None = None, epoch: int = 0, fmt: str = "json") -> None:
    """One pass of ``df`` to several named outputs: ``outputs`` maps a name to the condition of its rows (None: all). An epoch
    is a directory of its own below its output and is replaced when it is written again: a replayed micro-batch adds
    no message."""
    named = F.array_compact(F.array(*[F.when(F.lit(True) if c is None else c, F.lit(o)) for o, c in outputs.items()]))
    own = F.to_json(F.struct(*(key or df.columns)), JSON_OPTIONS)
    rows = df.select(F.explode(named).alias("output"), F.lit(epoch).cast("long").alias("epoch"), own.alias("_own"), F.to_json(F.struct(*df.columns), JSON_OPTIONS).alias("body"))
    rows = rows.select("output", "epoch", F.sha2(F.concat_ws("|", "output", "epoch", "_own"), 256).alias("message_id"), "body")
    # a task has one file open for each output: its rows need no sort by output
    spark, name = df.sparkSession, "spark.sql.maxConcurrentOutputFileWriters"
    before = spark.conf.get(name, None)
    spark.conf.set(name, str(len(outputs)))
    try:
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("output", "epoch").format(fmt).save(path)
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)


def sink_reports(lines: DataFrame, root: str, keys: list[str], order: list[str]) -> None:
    """Markdown lines -> text files by ``keys`` (a segment's, or a run's), one line a row, in ``order``: the lines are
    clustered by key and sorted, never gathered into one value."""
    kept = lines.select(*[F.col(k).cast("string").alias(k) for k in keys], *[o for o in order if o not in keys], "text")
    _write_documents(kept.withColumnRenamed("text", "value"), root, keys, order, "text")


def sink_converted(groups: dict[str, DataFrame], root: str, partitions: list[str]) -> dict[str, tuple[str, str]]:
    """Save every group of converted data as its own partitioned table beside the products: ``name -> (path, error)``. A
    failed save only blanks that group's path and keeps the error's text (the processing goes on)."""
    out: dict[str, tuple[str, str]] = {}
    for name, df in groups.items():
        path = f"{root.rstrip('/')}/{name}"
        try:
            _write(df, path, [p for p in partitions if p in df.columns])
            out[name] = (path, "")
        except Exception as e:
            out[name] = ("", str(e))
    return out
