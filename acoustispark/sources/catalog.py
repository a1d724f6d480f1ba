"""File catalogue, file events and product-store listings.

The catalogue reads file *metadata* with the ``binaryFile`` source (``content`` is never selected, so it is
pruned); store listings work on path strings, so they scale with the number of files, not their size.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from acoustispark.functions import scalars as fn

def file_catalog(spark: SparkSession, root: str, suffix: str = ".raw", recursive: bool = True,
                 max_files: int | None = None) -> DataFrame:
    """Inventory of input files: name, folder, size, path, modification time; sorted by name; ``max_files``
    (0/None = all) keeps the first N by name."""
    r = (spark.read.format("binaryFile").option("recursiveFileLookup", str(recursive).lower())
         .option("pathGlobFilter", f"*{suffix}").load(root).select("path", "modificationTime", "length"))
    out = r.select(fn.path_name("path").alias("name"),
                   F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("folder"),
                   F.col("length").alias("size"), "path",
                   F.date_format("modificationTime", "yyyy-MM-dd'T'HH:mm:ss").alias("last_modified"))
    return limit_files(out, max_files)


def limit_files(catalog: DataFrame, max_files: int | None) -> DataFrame:
    """Sort by name; the first ``max_files`` (0/None = all). The limit is the feature (``--max-files``)."""
    out = catalog.orderBy("name", "path")
    return out.limit(max_files) if max_files else out


def new_file_events(events: DataFrame, catalog: DataFrame) -> DataFrame:
    """File notifications -> ``status``: ``skipped`` unless the event is ``fileadd``; ``error`` when the file is
    not in the catalogue; else ``queued``. ``events``: ``event_id, event, file_added_path``."""
    known = catalog.select(F.col("path").alias("_p"), F.lit(True).alias("_exists")).distinct()
    j = events.join(known, F.col("file_added_path") == F.col("_p"), "left")
    status = (F.when(F.col("event") != "fileadd", "skipped").when(F.col("_exists").isNull(), "error")
              .otherwise("queued"))
    reason = (F.when(F.col("event") != "fileadd", F.concat(F.lit("ignored event: "), F.col("event")))
              .when(F.col("_exists").isNull(), F.concat(F.lit("file not found: "), F.col("file_added_path"))))
    return j.select("event_id", "event", "file_added_path", status.alias("status"), reason.alias("reason"))


#: Values that a directory name holds as they are.
SAFE_VALUE = re.compile(r"[A-Za-z0-9_.-]+")
DAY_RE = r"(?:^|/)([0-9]{4}-[0-9]{2}-[0-9]{2})(?:/|$)"


def list_days(paths: DataFrame, path_col: str = "path") -> DataFrame:
    """Distinct ISO dates found as a path component of the store; components that are not valid dates
    are skipped."""
    d = F.to_date(F.try_to_timestamp(F.regexp_extract(path_col, DAY_RE, 1), F.lit("yyyy-MM-dd")))
    return paths.select(d.alias("day")).where(F.col("day").isNotNull()).distinct()


def list_segments(paths: DataFrame, day: str | None = None, path_col: str = "path") -> DataFrame:
    """Distinct segment names (``.../<day>/segments/<name>/...``), of one day when ``day`` is given."""
    seg = F.regexp_extract(path_col, r"([0-9]{4}-[0-9]{2}-[0-9]{2})/segments/([^/]+)", 2)
    dd = F.regexp_extract(path_col, r"([0-9]{4}-[0-9]{2}-[0-9]{2})/segments/([^/]+)", 1)
    out = paths.select(dd.alias("day"), seg.alias("segment")).where(F.col("segment") != "")
    if day is not None:
        out = out.where(F.col("day") == day)
    return out.distinct()


def store_exists(keys: DataFrame, paths: DataFrame, key_col: str = "day", path_col: str = "path") -> DataFrame:
    """For each requested key (a day), whether the store holds data for it (left join to the distinct days)."""
    days = list_days(paths, path_col).select(F.date_format("day", "yyyy-MM-dd").alias("_k"), F.lit(True).alias("_e"))
    return (keys.join(days, F.col(key_col) == F.col("_k"), "left")
            .select(*keys.columns, F.coalesce("_e", F.lit(False)).alias("exists")))


def list_stores(paths: DataFrame, prefix: str = "", path_col: str = "path") -> DataFrame:
    """Distinct store roots (path cut after the first ``.zarr``) under ``prefix``."""
    root = F.regexp_extract(path_col, r"^(.*?\.zarr)(/|$)", 1)
    return (paths.where(F.startswith(F.col(path_col), F.lit(prefix))).select(root.alias("store"))
            .where(F.col("store") != "").distinct())


def read_product(spark: SparkSession, root: str, schema: T.StructType | str, **partitions) -> DataFrame:
    """Scan a product store (Parquet, a directory per campaign/product/day). Leading partition values go into the path, so
    only their directories are listed; other filters prune as usual; a missing store yields an empty frame with the schema,
    not an error; NaN -> NULL."""
    from acoustispark.sources.sinks import PRODUCT_DIRS
    from acoustispark.sources.tables import nan_to_null
    path, named = root.rstrip("/"), 0
    for c in PRODUCT_DIRS:  # the leading directories are named, so the others are never listed
        if c not in partitions or not SAFE_VALUE.fullmatch(str(partitions[c])):
            break
        path, named = f"{path}/{c}={partitions[c]}", named + 1
    try:
        df = spark.read.schema(schema).option("basePath", root).parquet(path)
    except Exception as e:  # path does not exist
        if "PATH_NOT_FOUND" not in str(e) and "does not exist" not in str(e):
            raise
        df = spark.createDataFrame([], schema)
    for k, v in partitions.items():
        df = df.where(F.col(k) == F.lit(v))
    order = spark.createDataFrame([], schema).columns   # partition columns come last in a scan; keep schema order
    return nan_to_null(df.select(*order))
