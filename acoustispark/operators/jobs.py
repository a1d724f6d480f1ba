"""Job compositions: Sv enrichment, the per-segment and per-file processing chain, and the reprocessing of a day.

All segments of a job go through the same Spark jobs. What is wrong with a ping is a value of its row, not an exception: the
source is read once, every row with its fault, and a segment with a fault is left out of the stages with the fault as its
status, however many there are. A stage is built and written inside a guard; what it wrote is read back for the next one,
so nothing is computed twice. Should an expression fail on data all the same, the stage's segments are tried again in halves of
their key hashes until the failing ones stand alone. Only errors that the data cause become statuses: a lost executor, a full
disk or a broken worker stops the job, which can be run again.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable
from functools import reduce

from pyspark.errors import PySparkException, PythonException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from acoustispark.functions import scalars as fn
from acoustispark.operators import calibrate as cal
from acoustispark.operators import denoise as dn
from acoustispark.operators import grid
from acoustispark.operators import report as rp
from acoustispark.operators import seabed as sb
from acoustispark.operators import summary as sm
from acoustispark.operators.pings import to_samples
from acoustispark.operators.util import staged
from acoustispark.sources import sinks
from acoustispark.sources.catalog import read_product

SEGMENT = ["platform", "day", "segment"]
#: Halvings of the key hashes, one a bit; segments that still fail together are then tried by their own keys.
MAX_HALVINGS = 64


def enrich_sv(pings: DataFrame, depth_offset: float | None = None, tilt: float = 0.0, downward: bool = True,
              fixes: DataFrame | None = None, cal_df: DataFrame | None = None) -> DataFrame:
    """depth -> location -> split-beam angles -> drop empty pings -> echo-range correction, on ping rows. A stage whose
    input columns are absent passes the frame through (the reference skips a stage that raises)."""
    out = pings
    if "echo_range" in out.columns:
        out = cal.add_depth(out, depth_offset or 0.0, tilt, downward)
    if fixes is not None and {"platform", "ping_time"}.issubset(out.columns):
        from acoustispark.operators.track import add_location
        times = out.select("platform", F.col("ping_time").alias("ts"), F.lit(0).cast("long").alias("event_id")).distinct()
        loc = add_location(times, fixes).select("platform", F.col("ts").alias("ping_time"), "lat", "lon")
        out = out.drop("lat", "lon").join(loc, ["platform", "ping_time"], "left")
    if cal_df is not None:
        out = cal.add_splitbeam_angle(out, cal_df)
    out = cal.drop_empty_pings(out)
    return cal.correct_echo_range(out, depth_offset)


def denoise_params(cfg: dict) -> dn.DenoiseParams:
    """Parameters of the denoise methods from the configuration's fields; a noise maximum at or below -999 is none, and
    the impulse lags are a comma list."""
    d = dn.DenoiseParams()
    top = float(cfg.get("background_noise_max", -999.0))
    lags = [int(x) for x in str(cfg.get("impulse_ping_lags", "1")).split(",") if x.strip()]
    own = {"ping_window": "background_ping_window", "range_window": "background_range_window",
           "num_side_pings": "background_num_side_pings", "snr_threshold": "background_snr_threshold"}
    same = ("transient_exclude_above", "transient_depth_bin", "transient_n_pings", "transient_threshold_db", "impulse_threshold_db",
            "impulse_num_lags", "impulse_vertical_bin", "attenuation_threshold", "attenuation_upper_limit", "attenuation_lower_limit",
            "attenuation_side_pings")
    given = {n: cfg[f] for n, f in {**own, **{n: n for n in same}}.items() if f in cfg}
    kinds = {n: type(getattr(d, n)) for n in given}
    return dn.DenoiseParams(**{n: kinds[n](v) for n, v in given.items()}, noise_max=top if top > -999.0 else None, impulse_ping_lags=lags,
                            mode=cfg.get("background_mode", "block"))


#: Error states of data (values that cannot be converted, divided, indexed) and of errors raised by an expression.
DATA_STATES = re.compile(r"SQLSTATE: (2[12]|38|39|P0)\w{3}\b")


def caused_by_data(e: Exception) -> bool:
    """Whether the data of a segment can be at fault: an error state of data, or an exception of a function on rows."""
    return isinstance(e, PythonException) or (isinstance(e, PySparkException) and DATA_STATES.search(str(e)) is not None)


def row_fault(pings: DataFrame) -> Column:
    """What is wrong with a ping row, as text; NULL for a sound one. Checked without anything that can raise."""
    arrays = [c for c in ("echo_range", "depth") if c in pings.columns]
    endless = lambda c: F.exists(c, lambda x: F.abs(x) >= F.lit(1e12))
    checks = [(F.col("ping_time").isNull(), F.lit("ping without a time")), (F.col("channel").isNull(), F.lit("ping without a channel")),
              (F.col("sv").isNull(), F.lit("ping without samples"))]
    for c in arrays:
        checks += [(F.col(c).isNull(), F.lit(f"ping without {c}")),
                   (F.size("sv") != F.size(c), F.concat(F.size("sv").cast("string"), F.lit(" samples against "), F.size(c).cast("string"), F.lit(f" of {c}"))),
                   (endless(c), F.lit(f"infinite {c}"))]
    checks.append((endless("sv"), F.lit("infinite sv")))
    out = F.lit(None).cast("string")
    for wrong, text in reversed(checks):
        out = F.when(wrong, text).otherwise(out)
    return out


def _guarded(source: DataFrame, build: Callable[[DataFrame], DataFrame], write: Callable[[DataFrame], None],
             failed: str = "error") -> list[tuple[Column, str]]:
    """[(which segments, status)] of building from ``source`` and writing, isolating the segments that fail."""
    try:
        build(source)
    except Exception as e:  # it cannot be planned: the configuration, not a segment, is at fault
        return [(F.lit(True), f"{failed}: {e}")]
    bits = F.xxhash64(*SEGMENT)

    def attempt(which: Column, depth: int) -> list[tuple[Column, str]]:
        try:
            write(build(source.where(which)))
            return [(which, "ok")]
        except Exception as e:
            if not caused_by_data(e):
                raise
            keys = source.where(which).select(*SEGMENT).distinct().limit(2).count()
            if keys < 2:
                return [(which, f"{failed}: {e}")] if keys else []
            if depth == MAX_HALVINGS:  # equal hashes
                own = source.where(which).select(*SEGMENT).distinct().collect()
                alone = [reduce(Column.__and__, [F.col(c).eqNullSafe(F.lit(r[c])) for c in SEGMENT], which) for r in own]
                return [x for one in alone for x in attempt(one, depth)]
            bit = F.shiftright(bits, depth).bitwiseAND(F.lit(1))
            return [x for side in (0, 1) for x in attempt(which & (bit == side), depth + 1)]

    return attempt(F.lit(True), 0)


class _Job:
    """Products of one job under ``root`` and the statuses of its stages."""

    def __init__(self, spark: SparkSession, segments: DataFrame, cfg: dict, root: str):
        self.spark, self.segments, self.cfg, self.root = spark, segments, cfg, root.rstrip("/")
        self.campaign = str(cfg.get("campaign") or cfg.get("survey_id") or "default")
        self.statuses: list[DataFrame] = []

    def save(self, df: DataFrame, product: str) -> None:
        sinks.sink_product(df.withColumn("product", F.lit(product)).withColumn("campaign", F.lit(self.campaign)), f"{self.root}/products/{product}")

    def load(self, like: DataFrame, product: str) -> DataFrame:
        """What this job's segments have of a product (the store may hold others)."""
        schema = like.withColumn("product", F.lit("")).withColumn("campaign", F.lit("")).schema
        back = read_product(self.spark, f"{self.root}/products/{product}", schema, product=product, campaign=self.campaign)
        return back.drop("product", "campaign").join(self.segments, SEGMENT, "left_semi")

    def note(self, stage: str, found: list[tuple[Column, str]]) -> None:
        for which, status in found:
            self.statuses.append(self.segments.where(which).select(*SEGMENT, F.lit(stage).alias("stage"), F.lit(status).alias("status")))

    def run(self, stage: str, product: str, source: DataFrame, build: Callable[[DataFrame], DataFrame], failed: str = "error") -> DataFrame | None:
        """Build a product from ``source`` and store it; returns it as stored, or None if it could not be planned."""
        found = _guarded(source, build, lambda df: self.save(df, product), failed)
        self.note(stage, found)
        return self.load(build(source), product) if any(s == "ok" for _, s in found) else None

    def table(self) -> DataFrame:
        out = self.statuses[0]
        for s in self.statuses[1:]:
            out = out.unionByName(s)
        return out


def process_segments(spark: SparkSession, pings: DataFrame, cfg: dict, out_root: str, save_sv: bool = True,
                     freq_params: DataFrame | None = None) -> DataFrame:
    """Sv -> denoise -> seabed -> MVBS -> NASC -> rasters -> manifest -> report for *all* segments in ``pings`` (ping rows
    with ``platform``, ``segment``, ``channel``, ``channel_index``) at once, as the configuration says. Manifests and reports
    are documents, one each a segment; ``reports_enabled`` false leaves them out.

    Every product is stored by (campaign, product, day, platform, segment); a re-run replaces exactly its segments. Denoised
    and masked data feed the grids; where a stage failed for a segment, its data go on as they were. Returns one row per
    segment and stage: ``platform, day, segment, stage, status``; a segment without a valid ping has the one row
    ``sv`` / ``skipped: no valid pings``, one with a faulty ping ``sv`` / ``error: `` and its first fault.
    """
    began = time.time()
    dated = pings if "day" in pings.columns else sinks.with_batch_day(pings)
    intake = staged(dated.withColumns({"_fault": row_fault(dated), "_valid": F.exists("sv", lambda x: x.isNotNull())}), "intake")
    first = F.min_by("_fault", F.when(F.col("_fault").isNotNull(), F.struct(F.col("ping_time").isNotNull(), "ping_time", "channel")))
    told = staged(intake.groupBy(*SEGMENT).agg(first.alias("fault"), F.max(F.coalesce("_valid", F.lit(False))).alias("valid")), "intake")
    status = F.when(F.col("fault").isNotNull(), F.concat(F.lit("error: "), F.col("fault"))).when(~F.col("valid"), F.lit("skipped: no valid pings")).otherwise(F.lit("ok"))
    told = told.select(*SEGMENT, F.lit("sv").alias("stage"), status.alias("status"))
    job = _Job(spark, told.where("status = 'ok'").select(*SEGMENT), cfg, out_root)
    job.statuses.append(told)
    live = cal.drop_empty_pings(intake.drop("_fault", "_valid").join(job.segments, SEGMENT, "left_semi"))
    if save_sv:
        job.save(live, "sv")
    sv = job.load(live, "sv") if save_sv else live

    def onwards(before: DataFrame, after: DataFrame | None) -> DataFrame:
        """``after`` where a segment has it, else ``before``."""
        if after is None:
            return before
        done = after.select(*SEGMENT).distinct()
        return after.unionByName(before.join(done, SEGMENT, "left_anti"), allowMissingColumns=True)

    cleaned = sv
    if cfg.get("denoise_enabled", True):
        def cleaned_of(df: DataFrame) -> DataFrame:
            src = dn.with_frequency_params(df, freq_params, cfg.get("denoise_pulse_length") or None) \
                if cfg.get("denoise_use_frequency_specific", False) and freq_params is not None else df
            out = dn.denoise(src, cfg.get("denoise_methods", dn.DEFAULT_METHODS), denoise_params(cfg), absorption=cfg.get("absorption", 0.0))
            return out.select(*df.columns)
        cleaned = onwards(cleaned, job.run("denoise", "sv_denoised", cleaned, cleaned_of))
    if cfg.get("seabed_enabled", False):
        source = cleaned
        masked = job.run("seabed", "sv_seabed", source, lambda df: sb.mask_seabed(sb.detect_seabed(
            df, cfg.get("seabed_method", "ariza"), float(cfg.get("seabed_max_range", 1000.0)))))
        cleaned = onwards(source, masked.drop("seabed_depth") if masked is not None else None)
    cells, strata = None, None
    if cfg.get("mvbs_enabled", True):
        cells = job.run("mvbs", "mvbs", cleaned, lambda df: grid.mvbs(
            to_samples(df), str(cfg.get("mvbs_range_bin", "0.5")) + "m", str(cfg.get("mvbs_ping_time_bin", "10s")), keys=(*SEGMENT, "channel", "channel_index")))
    if cfg.get("nasc_enabled", False):
        if {"lat", "lon"} <= set(cleaned.columns):
            strata = job.run("nasc", "nasc", cleaned, lambda df: grid.nasc(
                to_samples(df), str(cfg.get("nasc_range_bin", "10")) + "m", str(cfg.get("nasc_dist_bin", "0.5")) + "nmi", keys=tuple(SEGMENT)), "skipped")
        else:
            job.note("nasc", [(F.lit(True), "skipped: no GPS")])
    rasters = []
    if cfg.get("plot_echogram", True):
        job.run("echograms", "echogram", cleaned, sm.echogram_raster)
        rasters.append("echogram")
        if cells is not None:
            job.run("echograms", "echogram_mvbs", cells, lambda df: sm.mvbs_raster(df, SEGMENT))
            rasters.append("echogram_mvbs")
        if strata is not None:
            job.run("echograms", "echogram_nasc", strata, lambda df: sm.nasc_raster(df, SEGMENT))
            rasters.append("echogram_nasc")

    if not cfg.get("reports_enabled", True):
        return job.table()
    made = {"denoise": "sv_denoised", "seabed": "sv_seabed"}
    wide = job.table().groupBy(*SEGMENT).pivot("stage", ["sv", "denoise", "seabed", "mvbs", "nasc", "echograms"]).agg(F.min("status"))
    stages = ["sv", "denoise", "seabed", "mvbs", "nasc"]
    prefix = F.concat_ws("/", F.lit(job.campaign), F.lit(str(cfg.get("echogram_container", "echograms"))), F.date_format("day", "yyyy-MM-dd"), "platform", "segment")
    summary = sm.segment_summary(sv).join(wide.withColumnsRenamed({s: f"{s}_status" for s in (*stages, "echograms")}), SEGMENT)
    summary = summary.withColumns({
        "products": F.array_compact(F.array(*[F.when(F.col(f"{s}_status") == "ok", F.lit(made.get(s, s))) for s in stages])),
        "echogram_files": F.when(F.col("echograms_status") == "ok", F.array(*[F.concat(prefix, F.lit(f"/{r}")) for r in rasters])) if rasters
        else F.lit(None).cast("array<string>"),
        "processing_time_ms": F.lit(int((time.time() - began) * 1000))})
    if "file_stem" in sv.columns:
        summary = summary.withColumn("file_stem", F.col("segment")).withColumn("segment_name", F.col("segment"))
    try:  # written, as it is read twice
        summary = staged(summary, "summary")
    except Exception as e:
        if not caused_by_data(e):
            raise  # else the failing segments are found as the documents are made
    job.note("metadata", _guarded(summary, lambda df: sinks.manifest(df, cfg), lambda df: sinks.sink_metadata_json(df, f"{job.root}/metadata")))
    job.note("report", _guarded(summary, lambda df: rp.segment_report(df, cfg),
                                lambda df: sinks.sink_reports(df, f"{job.root}/reports", SEGMENT, ["line_no"])))
    return job.table()


def reprocess_day(spark: SparkSession, products_root: str, day: str, stages: list[str], cfg: dict, out_root: str, schema) -> DataFrame:
    """Read one day of the Sv product (partition pruning on ``product`` and ``day``), run the selected stages and replace
    that day's products; the Sv product itself is only read, so the store may be its own target (the reference queues this
    job and answers ``not_implemented``)."""
    sv = read_product(spark, products_root, schema, product="sv", day=day)
    c = dict(cfg) | {f"{k}_enabled": k in stages for k in ("denoise", "mvbs", "nasc", "seabed")} | {"plot_echogram": "echograms" in stages}
    return process_segments(spark, sv.drop("product", "campaign"), c, out_root, save_sv=False)


def process_files(spark: SparkSession, catalog: DataFrame, pings: DataFrame, cfg: dict, out_root: str,
                  failures: DataFrame | None = None) -> DataFrame:
    """A batch over files: one outcome row per file of ``catalog`` (``source_file``), whatever happens to the others.

    ``pings`` are the decoded ping rows with ``source_file``; ``failures`` (``source_file, error``) are the files that could not
    be decoded. A file is a segment named by its stem. Output: ``source_file, status (ok / skipped / error), error, reason, day,
    segment, n_pings, stage_status`` (a map, of files that were processed).
    """
    stem = fn.path_stem("source_file")
    rows = pings.withColumn("segment", stem).withColumn("file_stem", stem)
    status = process_segments(spark, rows.drop("source_file"), cfg, out_root)
    per = status.groupBy(*SEGMENT).agg(F.map_from_entries(F.collect_set(F.struct("stage", "status"))).alias("stage_status"))
    found = sinks.stored(spark, f"{out_root.rstrip('/')}/products/sv")
    times = spark.createDataFrame([], "segment string, n_pings bigint") if found is None else found.join(per, SEGMENT, "left_semi").groupBy("segment").agg(
        F.count_distinct("ping_time").alias("n_pings"))
    done = per.withColumn("_sv", F.col("stage_status")["sv"]).join(times, "segment", "left").withColumn("n_pings", F.when(F.col("_sv") == "ok", F.col("n_pings")))
    bad = failures.groupBy("source_file").agg(F.min("error").alias("error")) if failures is not None else spark.createDataFrame([], "source_file string, error string")
    files = catalog.select("source_file").distinct().withColumn("segment", stem)
    j = files.join(bad, "source_file", "left").join(done, "segment", "left")
    ok = F.col("n_pings").isNotNull()
    j = j.withColumn("error", F.coalesce("error", F.regexp_extract("_sv", "^error: (.*)$", 1))).withColumn("error", F.nullif("error", F.lit("")))
    return j.select(
        "source_file", F.when(F.col("error").isNotNull(), "error").when(ok, "ok").otherwise("skipped").alias("status"), "error",
        F.when(F.col("error").isNull() & ~ok, F.lit("no valid pings")).alias("reason"), F.when(ok, F.col("day")).alias("day"), "segment",
        F.when(ok, F.col("n_pings")).alias("n_pings"), F.when(ok, F.col("stage_status")).alias("stage_status"))
