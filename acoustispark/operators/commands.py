"""On-demand commands as data: validation/acknowledgement, the jobs they queue, and the store status answer."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from acoustispark.functions import scalars as fn

# Fixed values that must equal the reference's behaviour -----------------------------------------------------------
# answer texts
NO_PATHS, BAD_DATE, NO_SEGMENTS = "no paths specified", "invalid date: ", "no segments for "
NO_CONFIG, UNKNOWN = "no config provided", "unknown command: "
COMMANDS = ["process_raw_files", "process_day", "get_status", "set_config"]
# ---------------------------------------------------------------------------------------------------------------------


def commands_dispatch(commands: DataFrame, store_days: DataFrame) -> DataFrame:
    """Acknowledge every command: ``status`` (accepted / ok / error), ``reason``, ``files_queued``.

    ``commands``: ``command_id, command, paths ARRAY<STRING>, date STRING, config_json STRING``;
    ``store_days``: ``day DATE`` of days holding segments (checked by a left join on the parsed date).
    """
    days = store_days.select(F.col("day").alias("_day"), F.lit(True).alias("_has")).distinct()
    c = commands.withColumn("_pd", fn.parse_day("date")).join(days, F.col("_pd") == F.col("_day"), "left")
    n_paths = F.coalesce(F.size("paths"), F.lit(0))
    cfg_keys = F.json_object_keys("config_json")
    cmd = F.col("command")
    status = (F.when(cmd == "process_raw_files", F.when(n_paths == 0, "error").otherwise("accepted"))
              .when(cmd == "process_day", F.when(F.col("_pd").isNull() | F.col("_has").isNull(), "error")
                    .otherwise("accepted"))
              .when(cmd == "get_status", "ok")
              .when(cmd == "set_config", F.when(F.coalesce(F.size(cfg_keys), F.lit(0)) <= 0, "error").otherwise("ok"))
              .otherwise("error"))
    date_txt = F.coalesce(F.col("date"), F.lit(""))
    reason = (F.when(cmd == "process_raw_files", F.when(n_paths == 0, F.lit(NO_PATHS)))
              .when(cmd == "process_day", F.when(F.col("_pd").isNull(), F.concat(F.lit(BAD_DATE), date_txt))
                    .when(F.col("_has").isNull(), F.concat(F.lit(NO_SEGMENTS), date_txt)))
              .when(cmd == "set_config", F.when(F.coalesce(F.size(cfg_keys), F.lit(0)) <= 0, F.lit(NO_CONFIG)))
              .when(~cmd.isin(COMMANDS) | cmd.isNull(), F.concat(F.lit(UNKNOWN), F.coalesce(cmd, F.lit("")))))
    return c.select("command_id", "command", status.alias("status"), reason.alias("reason"),
                    F.when((cmd == "process_raw_files") & (n_paths > 0), n_paths).alias("files_queued"),
                    F.when(cmd == "set_config", F.array_join(cfg_keys, ",")).alias("updated_keys"))


def command_jobs(commands: DataFrame, acks: DataFrame) -> DataFrame:
    """Jobs queued by accepted commands: one ``process_raw`` job per path, one ``process_day`` job per day."""
    ok = commands.join(acks.where(F.col("status") == "accepted").select("command_id"), "command_id", "left_semi")
    files = ok.where(F.col("command") == "process_raw_files").select(
        "command_id", F.lit("process_raw").alias("type"), F.explode("paths").alias("file_path"),
        F.lit(None).cast("date").alias("day"))
    days = ok.where(F.col("command") == "process_day").select(
        "command_id", F.lit("process_day").alias("type"), F.lit(None).cast("string").alias("file_path"),
        fn.parse_day("date").alias("day"))
    return files.unionByName(days)


def store_status(store_days: DataFrame, jobs: DataFrame, processing_mode: str = "both") -> DataFrame:
    """``get_status`` as a table: processing mode, days with data (sorted list and count), pending jobs.
    Host memory / GPU readings are machine internals and are not produced."""
    days = store_days.select(F.date_format("day", "yyyy-MM-dd").alias("_d"), F.lit(None).cast("int").alias("_j"))
    pending = jobs.select(F.lit(None).cast("string").alias("_d"), F.lit(1).alias("_j"))
    return days.unionByName(pending).agg(
        F.count_distinct("_d").alias("n_days"), F.array_sort(F.collect_set("_d")).alias("days_with_data"),
        F.count("_j").alias("jobs_pending")).select(F.lit(processing_mode).alias("processing_mode"), "n_days",
                                                    "days_with_data", "jobs_pending")
