"""acoustispark: water-column sonar analytics as Spark DataFrame / SQL / Structured Streaming operators.

Sub-packages
------------
sources    scans of the given tables, derived sonar fixtures, file catalogues, message parsing, sinks
functions  Column-level scalar functions (string, date, math, json, acoustics)
operators  DataFrame -> DataFrame operators (calibration, grids, denoise, seabed, tracks, summaries, reports, config)
streaming  stateful dual-trigger segmentation, batch and Structured Streaming forms
plans      the registered named queries and their DuckDB oracle SQL
"""

from acoustispark.session import get_session, checkpoint_dir

__all__ = ["get_session", "checkpoint_dir"]
