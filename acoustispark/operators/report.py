"""Result payloads and Markdown reports as rows.

Reports are tables of lines: every line is a Column expression of one result/summary row, sections are arrays of optional
lines (absent ones dropped) and ``posexplode`` numbers them. Ordering keys are data, so nothing is numbered or sorted
across a whole run.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from acoustispark.functions import scalars as fn

# Fixed values that must equal the reference's behaviour: report texts ---------------------------------------------
SEGMENT_TITLE, RUN_TITLE, NO_SURVEY = "# Segment Report: ", "# Processing Report: ", "Standalone Run"
SEC_CHANNELS, SEC_COVERAGE, SEC_PRODUCTS = "## Channels & Frequencies", "## Data Coverage", "## Products"
SEC_CONFIG, SEC_ECHOGRAMS = "## Configuration", "## Echograms"
SEC_SUMMARY, SEC_PIPELINE, SEC_FILES = "## Summary", "## Pipeline Configuration", "## Files Processed"
SEC_FILE_ECHOGRAMS, SEC_NOTES, SEC_ARTIFACTS = "#### Echograms", "## Data Quality Notes", "## Output Artifacts"
DONE, NOT_DONE, NOT_ENABLED, FAILED = "✅", "⏭", "⏭ (not enabled)", "❌"
# products in report order; a product's switch is <stage>_enabled in the configuration
PRODUCTS = ["sv", "sv_denoised", "sv_seabed", "mvbs", "nasc"]
# ---------------------------------------------------------------------------------------------------------------------
#: Stage that makes a product, where its name differs.
STAGE_OF = {"sv_denoised": "denoise", "sv_seabed": "seabed"}


def _switch(cfg: dict, stage: str) -> bool:
    return stage == "sv" or bool(cfg.get(f"{stage}_enabled", stage in ("denoise", "mvbs")))


def ml_payload(results: DataFrame, campaign_id: str, depth_offset: float) -> DataFrame:
    """The 6-field ML message of every result that has an Sv path."""
    return results.where(F.col("sv_path").isNotNull()).select(
        F.col("source_file").alias("file_name"), F.col("sv_path").alias("sv_zarr_path"),
        F.lit(campaign_id).alias("campaign_id"),
        F.regexp_replace("source_file", r"\.[^.]*$", "").alias("dataset_id"),
        F.lit(float(depth_offset)).alias("depth_offset"),
        F.coalesce(F.date_format("day", "yyyy-MM-dd"), F.lit("")).alias("date"))


def telemetry_rows(results: DataFrame, cfg: dict, run_key=("campaign",)) -> tuple[DataFrame, DataFrame]:
    """(payload rows = result + context, "last processed" row per run chosen by ``max_by`` on the day and id)."""
    payload = results.select("*", F.lit(cfg.get("survey_id", "")).alias("campaign_id"),
                             F.lit(cfg.get("sonar_model", "EK80")).alias("sonar_model"),
                             F.lit(cfg.get("processing_mode", "both")).alias("processing_mode"),
                             F.lit(bool(cfg.get("use_gpu", True))).alias("use_gpu"))
    last = (results.groupBy(*run_key)
            .agg(F.max_by(F.struct(F.date_format("day", "yyyy-MM-dd").alias("last_processed_day"),
                                   F.col("processing_time_ms").alias("last_processing_time_ms"),
                                   F.col("n_pings").alias("last_n_pings")),
                          F.struct("day", "file_id")).alias("_l"))
            .select(*run_key, "_l.*", F.lit(cfg.get("processing_mode", "both")).alias("processing_mode"),
                    F.lit(bool(cfg.get("use_gpu", True))).alias("gpu_enabled")))
    return payload, last


def _lines(*parts) -> Column:
    """Array of the lines that are there; a part is a text, a Column, or a Column of lines."""
    out, one = [], []

    def flush() -> None:
        if one:
            out.append(F.array_compact(F.array(*one)))
            one.clear()

    for p in parts:
        if isinstance(p, list):
            flush()
            out.append(F.coalesce(p[0], F.expr("cast(array() as array<string>)")))
        else:
            one.append(F.lit(p) if isinstance(p, str) else p)
    flush()
    return F.concat(*out)


def _fmt(x: Column, digits: int) -> Column:
    return F.format_string(f"%.{digits}f", x)


def _span(label: str, lo: str, hi: str) -> Column:
    return F.when(F.col(lo).isNotNull(), F.concat(F.lit(f"- **{label}**: ["), _fmt(F.col(lo), 4), F.lit(", "), _fmt(F.col(hi), 4), F.lit("]")))


def _freq_text(c: Column) -> Column:
    return F.array_join(F.transform(c, lambda f: fn.fmt_freq(f)), ", ")


def _image(path: Column) -> Column:
    return F.concat(F.lit("!["), fn.alt_text(fn.path_stem(path)), F.lit("]("), fn.storage_path(path), F.lit(")"))


def _images(title: str, closing: bool) -> list:
    """The image section of ``echogram_files``, if there are any: every image is followed by an empty line."""
    body = F.flatten(F.transform("echogram_files", lambda p: F.array(_image(p), F.lit(""))))
    whole = F.concat(F.array(F.lit(title), F.lit("")), body, F.array(*[F.lit("")] * closing) if closing else F.expr("cast(array() as array<string>)"))
    return [F.when(F.size("echogram_files") > 0, whole)]


def _with(df: DataFrame, **kinds: str) -> DataFrame:
    """``df`` with the columns it lacks as NULL."""
    return df.withColumns({n: F.lit(None).cast(k) for n, k in kinds.items() if n not in df.columns})


def segment_report(summary: DataFrame, cfg: dict) -> DataFrame:
    """Markdown report per segment: header, channels & frequencies, coverage, products, configuration, echograms.

    ``summary``: output of ``summary.segment_summary`` plus ``processing_time_ms``, ``products`` (array of product names
    written), and optionally ``<stage>_status`` texts and ``echogram_files``. Lines are ``(keys, line_no, text)``.
    """
    s = _with(summary, echogram_files="array<string>", **{f"{STAGE_OF.get(p, p)}_status": "string" for p in PRODUCTS})
    paired = F.size("channels") == F.size("frequencies_hz")
    ch = (F.when((F.size("channels") > 0) & paired, F.transform(
              F.arrays_zip("channels", "frequencies_hz"), lambda z: F.concat(F.lit("- "), z["channels"], F.lit(": "), fn.fmt_freq(z["frequencies_hz"]))))
          .when(F.size("frequencies_hz") > 0, F.array(F.concat(F.lit("- Frequencies: "), _freq_text(F.array_sort("frequencies_hz")))))
          .when(F.size("channels") > 0, F.transform("channels", lambda c: F.concat(F.lit("- "), c))))
    products = []
    for name in PRODUCTS:
        stage = STAGE_OF.get(name, name)
        status = F.col(f"{stage}_status")
        line = F.when(F.array_contains("products", name), F.lit(f"- {name}.zarr {DONE}"))
        if not _switch(cfg, stage):
            line = line.otherwise(F.lit(f"- {name}.zarr {NOT_ENABLED}"))
        else:
            bad = F.coalesce(F.instr(status, "error") > 0, F.lit(False))
            line = line.when(bad, F.concat(F.lit(f"- {name}.zarr {FAILED} ("), status, F.lit(")"))).otherwise(F.lit(f"- {name}.zarr {NOT_DONE}"))
        products.append(line)
    config = [f"- **Sonar**: {cfg.get('sonar_model', 'EK80')}, {cfg.get('waveform_mode', 'CW')}, {cfg.get('encode_mode', 'power')}"]
    config += [f"- **{label}**: {text}" for label, stage, text in _stage_texts(cfg) if _switch(cfg, stage)]
    config.append(f"- **GPU**: {'enabled' if cfg.get('use_gpu', True) else 'disabled'}")
    text = _lines(
        F.concat(F.lit(SEGMENT_TITLE), F.col("segment_name")), "",
        F.concat(F.lit("> Day: "), F.date_format("day", "yyyy-MM-dd"), F.lit(" | Pings: "), fn.thousands("n_pings"), F.lit(" | Channels: "),
                 F.col("n_channels").cast("string"), F.lit(" | Processing: "), F.col("processing_time_ms").cast("string"), F.lit("ms")), "",
        [F.when(ch.isNotNull(), F.concat(F.array(F.lit(SEC_CHANNELS), F.lit("")), ch, F.array(F.lit(""))))],
        SEC_COVERAGE, "",
        F.concat(F.lit("- **Time**: "), fn.iso_text("start_time"), F.lit(" → "), fn.iso_text("end_time")),
        F.concat(F.lit("- **Depth**: "), _fmt(F.col("depth_min"), 1), F.lit("m → "), _fmt(F.col("depth_max"), 1), F.lit("m")),
        _span("Latitude", "lat_min", "lat_max"), _span("Longitude", "lon_min", "lon_max"),
        F.concat(F.lit("- **Mean Sv**: "), F.col("sv_mean_db").cast("string"), F.lit(" dB")), "",
        SEC_PRODUCTS, "", *products, "", SEC_CONFIG, "", *config, "", _images(SEC_ECHOGRAMS, False))
    keys = [c for c in ("platform", "day", "segment") if c in summary.columns]
    return s.select(*keys, F.posexplode(text).alias("line_no", "text"))


def _stage_texts(cfg: dict) -> list[tuple[str, str, str]]:
    """(label, stage, parameters) of the stages that the configuration can switch."""
    return [("Denoise", "denoise", cfg.get("denoise_methods", "background,transient,impulse,attenuation")),
            ("MVBS", "mvbs", f"range_bin={cfg.get('mvbs_range_bin', '0.5')}m, ping_time_bin={cfg.get('mvbs_ping_time_bin', '10s')}"),
            ("NASC", "nasc", f"range_bin={cfg.get('nasc_range_bin', '10')}m, dist_bin={cfg.get('nasc_dist_bin', '0.5')}nmi"),
            ("Seabed", "seabed", f"method={cfg.get('seabed_method', 'ariza')}, max_range={cfg.get('seabed_max_range', 1000.0)}m")]


def run_report(results: DataFrame, summary: DataFrame, notes: DataFrame, cfg: dict, run_key=("campaign",)) -> DataFrame:
    """Markdown report per run as lines ``(run_key, section, source_file, file_id, line_no, text)``, to be read in that
    order: 1 summary and pipeline configuration, 2 one block per file, 3 data-quality notes (``line_no`` 0, 1 the heading,
    then by kind), 4 artifacts. The generated-at line is left out; the total time is the sum of the files' times, to a tenth [def].
    """
    key = list(run_key)
    on = lambda x: "enabled" if x else "disabled"
    texts = {stage: (label, text) for label, stage, text in _stage_texts(cfg)}

    def switch(stage: str, label: str) -> str:
        return f"- **{label}**: {on(_switch(cfg, stage))}" + (f" ({texts[stage][1]})" if _switch(cfg, stage) else "")

    head = _lines(
        RUN_TITLE + (cfg.get("survey_id") or NO_SURVEY), "", SEC_SUMMARY, "",
        f"- **Survey ID**: {cfg.get('survey_id', '')}",
        *([f"- **Survey name**: {cfg['survey_name']}"] if cfg.get("survey_name") else []),
        f"- **Input directory**: `{cfg.get('input_dir', '')}`",
        F.format_string("- **Files processed**: %d ok, %d failed, %d skipped (of %d total)", "n_ok", "n_failed", "n_skipped", "n_total"),
        F.concat(F.lit("- **Total pings**: "), fn.thousands("total_pings")),
        f"- **Sonar model**: {cfg.get('sonar_model', 'EK80')}",
        F.when(F.size("frequencies") > 0, F.concat(F.lit("- **Frequencies**: "), _freq_text(F.col("frequencies")))),
        F.concat(F.lit("- **Total processing time**: "), _fmt(F.col("_total_s"), 1), F.lit("s")), "",
        SEC_PIPELINE, "", f"- **Waveform mode**: {cfg.get('waveform_mode', 'CW')}", f"- **Encode mode**: {cfg.get('encode_mode', 'power')}",
        f"- **Depth offset**: {float(cfg.get('depth_offset', 0.0))} m", f"- **GPU acceleration**: {on(cfg.get('use_gpu', True))}",
        switch("denoise", "Denoise"), switch("mvbs", "MVBS"), switch("nasc", "NASC"), switch("seabed", "Seabed detection"),
        f"- **Echograms**: {on(cfg.get('plot_echogram', True))}", "", SEC_FILES, "")
    total = results.groupBy(*key).agg((F.floor((F.sum("total_time_ms") + 50) / 100) / F.lit(10.0)).alias("_total_s"))
    none = lambda k: F.lit(None).cast(k)
    at = [F.lit("").alias("source_file"), F.lit(0).cast("long").alias("file_id")]
    heads = summary.join(total, key).select(*key, F.lit(1).alias("section"), *at, F.posexplode(head).alias("line_no", "text"))

    r = _with(results, segment="string", n_channels="int", lat_min="double", lat_max="double", lon_min="double", lon_max="double",
              products="array<string>", echodata_path="string", sv_path="string", echogram_files="array<string>")
    st = F.col("status")
    time = F.concat(F.lit("- **Processing time**: "), F.col("total_time_ms").cast("string"), F.lit(" ms"))
    text = lambda label, c: F.concat(F.lit(f"- **{label}**: "), F.coalesce(c.cast("string"), F.lit("")))
    path = lambda label, c: F.concat(F.lit(f"- **{label}**: `"), fn.storage_path(c), F.lit("`"))
    title = [F.concat(F.lit("### "), F.coalesce("source_file", F.lit("unknown"))), ""]
    bad = _lines(*title, f"- **Status**: {FAILED} FAILED", text("Error", F.coalesce("error", F.lit("unknown"))), time, "")
    skipped = _lines(*title, F.concat(F.lit(f"- **Status**: {NOT_DONE} Skipped — "), F.coalesce("reason", F.lit(""))), "")
    good = _lines(
        *title, f"- **Status**: {DONE} OK", text("Day", F.date_format("day", "yyyy-MM-dd")), text("Segment", F.col("segment")),
        F.concat(F.lit("- **Pings**: "), fn.thousands("n_pings")), text("Channels", F.col("n_channels")),
        F.when(F.size("frequencies") > 0, F.concat(F.lit("- **Frequencies**: "), _freq_text(F.col("frequencies")))),
        _span("Latitude", "lat_min", "lat_max"), _span("Longitude", "lon_min", "lon_max"), time,
        F.when(F.size("products") > 0, F.concat(F.lit("- **Products**: "), F.array_join("products", ", "))),
        path("Echodata", F.col("echodata_path")), path("Sv data", F.col("sv_path")), "", _images(SEC_FILE_ECHOGRAMS, True))
    files = r.select(*key, F.lit(2).alias("section"), F.coalesce("source_file", F.lit("")).alias("source_file"), "file_id",
                     F.posexplode(F.when(st == "error", bad).when(st == "skipped", skipped).otherwise(good)).alias("line_no", "text"))

    found = notes.select(*key).distinct()
    note_head = found.select(*key, F.lit(3).alias("section"), *at, F.posexplode(F.array(F.lit(SEC_NOTES), F.lit(""))).alias("line_no", "text"))
    note_rows = notes.select(*key, F.lit(3).alias("section"), F.coalesce("source_file", F.lit("")).alias("source_file"), none("long").alias("file_id"),
                             (F.col("kind") + 1).alias("line_no"), F.col("note").alias("text"))
    art = [SEC_ARTIFACTS, "", f"- **Echodata (converted)**: `{cfg.get('converted_container', 'converted')}/`",
           f"- **Processed products**: `{cfg.get('processed_container', 'processed')}/`",
           f"- **Echograms**: `{cfg.get('echogram_container', 'echograms')}/`", "- **This report**: `reports/`", ""]
    arts = summary.select(*key, F.lit(4).alias("section"), *at, F.posexplode(F.array(*[F.lit(x) for x in art])).alias("line_no", "text"))
    return heads.unionByName(files).unionByName(note_head).unionByName(note_rows).unionByName(arts)
