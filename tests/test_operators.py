"""Hand-computed and metamorphic checks of single operators."""

import datetime as dt
import json
import math
import re

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acoustispark.functions import scalars as fn
from acoustispark.operators import calibrate as cal
from acoustispark.operators import denoise as dn
from acoustispark.operators import grid, track
from acoustispark.operators import seabed as sb
from acoustispark.operators.pings import to_pings, to_samples
from acoustispark.sources import fixtures as fx
from acoustispark.sources import messages as ms
from acoustispark.streaming.trigger import TriggerParams, segment_trigger

from .conftest import SF


def _one(spark, expr):
    return spark.range(1).select(expr.alias("v")).collect()[0]["v"]


def test_sanitize_container(spark):
    cases = {"My Survey 2024!": "my-survey-2024", "": "default", "a": "a00", "--x--": "x00", "ÄB": "b00",
             "x" * 70: "x" * 63}
    for inp, out in cases.items():
        assert _one(spark, fn.sanitize_container(F.lit(inp))) == out, inp


def test_alt_text_title_case(spark):
    assert _one(spark, fn.alt_text(F.lit("sv_38khz_ch1"))) == "Sv 38Khz Ch1"
    assert _one(spark, fn.alt_text(F.lit("o'neil_x"))) == "O'Neil X"


def test_parse_bool_and_coerce(spark):
    vals = {'"false"': False, '"Off"': False, '" no"': True, "0": False, "2.5": True, "null": True, '"abc"': True,
            "true": True, "[1]": True}
    for j, out in vals.items():
        assert _one(spark, fn.parse_bool(F.lit(j), True)) is out, j
    assert _one(spark, fn.coerce_int(F.lit('"3.7"'))) is None
    assert _one(spark, fn.coerce_int(F.lit("3.7"))) == 3
    assert _one(spark, fn.coerce_int(F.lit('" 12 "'))) == 12
    assert _one(spark, fn.unwrap_value(F.lit('{"value":"off"}'))) == '"off"'


def test_round1_half_even(spark):
    assert _one(spark, fn.round1(F.lit(-70.25))) == -70.2


def test_mvbs_constant_field(spark):
    s = fx.samples(spark, SF).withColumn("sv", F.when(F.col("sv").isNotNull(), F.lit(-60.0)))
    out = grid.mvbs(s, "10m", "20s").agg(F.min("sv"), F.max("sv")).collect()[0]
    assert abs(out[0] + 60) < 1e-9 and abs(out[1] + 60) < 1e-9


def test_denoise_never_raises_values(spark):
    p = fx.pings(spark, SF)
    out, status = dn.denoise_chain(p, dn.DEFAULT_METHODS, dn.DenoiseParams(), absorption=0.01)
    assert status == "ok"
    j = to_samples(out).select("channel", "ping", "range_sample", F.col("sv").alias("d")).join(
        fx.samples(spark, SF).select("channel", "ping", "range_sample", "sv"), ["channel", "ping", "range_sample"])
    assert j.where(F.col("d") > F.col("sv") + 1e-9).count() == 0
    assert j.where(F.col("d").isNull() & F.col("sv").isNotNull()).count() > 0


def test_denoise_unknown_method(spark):
    p = fx.pings(spark, SF)
    out, status = dn.denoise_chain(p, "background,bogus")
    assert status.startswith("error") and out is p


def _strip(spark, columns, depth=(1.0, 3.0, 5.0), missing=()):
    """Ping rows of one channel from lists of samples; pings numbered in ``missing`` are absent."""
    rows = [("p", "s", "c", 0, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=2 * i), [float(x) if x is not None else None for x in v], list(depth), list(depth))
            for i, v in enumerate(columns) if i not in missing]
    return spark.createDataFrame(rows, "platform string, segment string, channel string, channel_index int, ping_time timestamp_ntz, "
                                       "sv array<double>, echo_range array<double>, depth array<double>")


def _sv(df):
    return [r.sv for r in df.orderBy("ping_time").collect()]


def test_impulse_looks_at_the_neighbouring_pings_only(spark):
    quiet, spike, empty = [-70, -70, -70], [-70, -40, -70], [None, None, None]
    assert _sv(dn.impulse(_strip(spark, [quiet, spike, quiet])))[1] == [-70, None, -70]
    # the ping before is empty: there is nothing to compare with, and older pings do not stand in for it
    assert _sv(dn.impulse(_strip(spark, [quiet, empty, spike, quiet])))[2] == [-70, -40, -70]


def test_transient_frame_counts_pings(spark):
    p = dn.DenoiseParams(transient_exclude_above=0.0, transient_depth_bin=2.0, transient_n_pings=1, transient_threshold_db=6.0)
    quiet, loud, empty = [-70, -70, -70], [-70, -50, -70], [None, None, None]
    assert _sv(dn.transient(_strip(spark, [quiet, quiet, loud, quiet]), p))[2] == [-70, None, -70]
    # between two empty pings a ping is its own median
    assert _sv(dn.transient(_strip(spark, [quiet, empty, loud, empty, quiet]), p))[2] == [-70, -50, -70]


def test_background_modes_and_frequency_parameters(spark):
    strip = _strip(spark, [[-60, -60, -60]] * 3 + [[-90, -60, -60]] * 3)
    block = _sv(dn.background(strip, dn.DenoiseParams(ping_window=6, range_window=1)))
    slide = _sv(dn.background(strip, dn.DenoiseParams(mode="sliding", num_side_pings=0, range_window=1)))
    assert block != slide and len(block) == len(slide) == 6
    table = spark.createDataFrame([(38000.0, 1000.0)], "frequency_nominal double, snr_threshold double")
    strict = dn.background(dn.with_frequency_params(strip.withColumn("frequency_nominal", F.lit(38000.0)), table), dn.DenoiseParams())
    assert all(x is None for v in _sv(strict) for x in v)


def test_ping_rows_round_trip_with_gaps(spark):
    s = spark.createDataFrame([("p", "s", "c", i, float(-i)) for i in (0, 1, 4)], "platform string, segment string, channel string, range_sample int, sv double")
    p = to_pings(s)
    assert p.first().sv == [0.0, -1.0, None, None, -4.0]
    assert [(r.range_sample, r.sv) for r in to_samples(p).orderBy("range_sample").collect()] == [(0, 0.0), (1, -1.0), (2, None), (3, None), (4, -4.0)]


def test_depth_axis_takes_the_first_ping(spark):
    d = _strip(spark, [[1, 1, 1], [1, 1, 1]])
    first = F.col("ping_time") == F.lit(dt.datetime(2024, 1, 1))
    gone = F.transform("depth", lambda x: F.when(~first, x))
    assert [r.axis for r in cal.depth_axis(d.withColumn("depth", gone).withColumn("echo_range", F.transform("echo_range", lambda x: x + 10))).orderBy("range_sample").collect()] == [11, 13, 15]


def test_seabed_method_names(spark):
    d = _strip(spark, [[-70, -30, -20]])
    assert sb.detect_seabed(d, "maxSv").first().seabed_depth == 5.0
    assert sb.detect_seabed(d, "deltaSv").first().seabed_depth == 3.0
    with pytest.raises(ValueError):
        sb.detect_seabed(d, "bogus")
    with pytest.raises(ValueError):
        sb.detect_seabed(d, "blackwell")


def test_bad_input_does_not_abort(spark):
    assert _one(spark, fn.coerce_int(F.lit('"99999999999999999999"'))) == 99999999999999999999
    assert _one(spark, fn.coerce_int(F.lit("1e60"))) is None
    assert _one(spark, fn.parse_bin_value(F.lit("wide"))) is None and _one(spark, fn.parse_bin_value(F.lit("1.2.3m"))) is None
    assert _one(spark, fn.split_int_list(F.lit("1, x, 3"))) == [1, None, 3]
    assert _one(spark, ms.ping_time(F.lit("2024-01-01T02:00:00+02:00"))) == dt.datetime(2024, 1, 1)
    assert _one(spark, ms.ping_time(F.lit("soon"))) is None and _one(spark, ms.ping_time(F.lit("2024"))) is None


def test_location_message_times(spark):
    for t, text in ((dt.datetime(2024, 1, 1, 0, 0, 1), "2024-01-01T00:00:01"), (dt.datetime(2024, 1, 1, 0, 0, 1, 5), "2024-01-01T00:00:01.000005")):
        m = _one(spark, fn.location_message(F.lit(1.0), F.lit(2.0), F.lit(t).cast("timestamp_ntz"), F.lit(3.0)))
        assert json.loads(m) == {"location": {"lat": 1.0, "lon": 2.0}, "timestamp": text, "speed_knots": 3.0}


def test_rdp_properties():
    """Ends stay; every dropped point is within epsilon of the kept line around it; every kept interior point split an
    interval in which it was the farthest, beyond epsilon."""
    def off(p, a, b):
        if np.allclose(a, b):
            return float(np.hypot(*(p - a)))
        t = min(1.0, max(0.0, float((p - a) @ (b - a) / ((b - a) @ (b - a)))))
        return float(np.hypot(*(p - a - t * (b - a))))

    rng = np.random.default_rng(1)
    eps = 1e-4
    for n in (2, 3, 10, 200):
        pts = np.cumsum(rng.normal(0, 1e-3, size=(n, 2)), axis=0)
        kept = track._rdp_indices(pts, eps)
        assert kept[0] == 0 and kept[-1] == n - 1 and kept == sorted(set(kept))
        for a, b in zip(kept, kept[1:]):
            assert all(off(pts[i], pts[a], pts[b]) <= eps * (1 + 1e-9) for i in range(a + 1, b))
        stack = [(0, n - 1)]
        while stack:
            lo, hi = stack.pop()
            inside = [k for k in kept if lo < k < hi]
            if not inside:
                continue
            d = [off(pts[i], pts[lo], pts[hi]) for i in range(lo + 1, hi)]
            k = lo + 1 + int(np.argmax(d))
            assert max(d) > eps and k in inside
            stack += [(lo, k), (k, hi)]


@pytest.mark.parametrize("batch_rows", [1, 7, 1 << 16])
def test_simplify_does_not_depend_on_batches(spark, batch_rows):
    t = track.speed_filter(track.track_speed(track.track_distance(track.gps_valid(fx.nav(spark, SF)))))
    base = sorted(map(tuple, track.simplify_rdp(t, 1e-4, 0.05).collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5" if batch_rows == 7 else "10000")
    try:
        assert sorted(map(tuple, track.simplify_rdp(t, 1e-4, 0.05, batch_rows=batch_rows).collect())) == base
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_savgol_weights_rule():
    t = track.savgol_terms()
    assert t["interior"][0] == [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36] and t["interior"][1] == 429
    nums, den = t["head"][0]
    assert [x * 2145 // den for x in nums][:3] == [1245, 810, 450]


def _trigger_brute(times, p):
    out, start, n = [], 0, 0
    seg = []
    for i, t in enumerate(times):
        if n == 0:
            start = i
        n += 1
        seg.append(i)
        if (n >= p.buffer_pings or t - times[start] >= p.buffer_seconds) and n >= p.min_pings:
            out += [(j, start, n) for j in seg]
            seg, n = [], 0
    if n >= p.min_pings:
        out += [(j, start, n) for j in seg]
    return out


def test_trigger_matches_sequential_fold(spark):
    rng = np.random.default_rng(7)
    times = np.cumsum(rng.exponential(20.0, size=700)).round(3)
    pdf = pd.DataFrame({"platform": "a", "ts": pd.to_datetime(times, unit="s"), "event_id": np.arange(700)})
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    for p, chunks in ((TriggerParams(buffer_pings=30, buffer_seconds=400.0, min_pings=10), (30, 64, 1000)),
                      (TriggerParams(buffer_pings=10, buffer_seconds=1e9, min_pings=15), (15, 50)),
                      (TriggerParams(buffer_pings=10, buffer_seconds=90.0, min_pings=15), (16, 1000))):
        for chunk in chunks:
            got = sorted((r["event_id"], r["segment_rn"], r["n_segment_pings"])
                         for r in segment_trigger(df, p, chunk_rows=chunk).collect())
            assert got == _trigger_brute(list(times), p), (p, chunk)


def test_haversine_known_distance(spark):
    d = _one(spark, fn.haversine_nmi(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(0.0)))
    assert abs(d - 2 * 6371.0088 / 1.852 * math.asin(math.sin(math.radians(0.5)))) < 1e-9


def test_backward_fill_reads_no_frame_again_for_every_row(spark):
    from acoustispark.operators.util import fill_backward
    rows = [("a", 1, 1, None), ("a", 1, 2, 5), ("a", 1, 3, None), ("a", 2, 1, None), ("a", 3, 1, None), ("a", 3, 2, 7), ("b", 1, 1, None), (None, 1, 1, 4), ("a", None, 1, 9)]
    df = spark.createDataFrame(rows, "k string, day int, t int, x int")
    out = fill_backward(df, ("k",), "day", ("t",), "x", "next")
    got = {(r.k, r.day, r.t): r.next for r in out.collect()}
    assert got[("a", 1, 1)] == got[("a", 1, 2)] == 5 and got[("a", 1, 3)] == got[("a", 2, 1)] == got[("a", 3, 1)] == got[("a", 3, 2)] == 7
    assert got[("b", 1, 1)] is None
    plan = out._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "unboundedpreceding" in plan and "unboundedfollowing" not in plan  # such a frame is read to its end at each row


def test_blackwell_finds_a_pings_median_once(spark):
    """A median of all samples inside the pass over the samples made the time grow with the square of their number."""
    from acoustispark.operators import seabed as sb
    n = 40
    rows = [("p", "s", "c", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=k), [float(-90 + i + k) if i % 7 else None for i in range(n)],
             [float(i) for i in range(n)], [3.0 if 20 <= i < 32 else 0.0 for i in range(n)], [0.0] * n) for k in range(4)]
    df = spark.createDataFrame(rows, "platform string, segment string, channel string, ping_time timestamp_ntz, sv array<double>, depth array<double>, "
                                     "angle_alongship array<double>, angle_athwartship array<double>")
    out = sb.blackwell(df, angle_threshold=2.0)
    # samples 20 to 31 and one to each side are candidates (their mean square is over 4), 21 and 28 have no Sv: the median is that of 19..32
    assert [r.seabed_depth for r in out.orderBy("ping_time").collect()] == [26.0] * 4
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    lines = [x for x in plan.splitlines() if "AS seabed_depth" in x]
    assert len(lines) == 1
    inside = re.sub(r".*?(array_min\(.*) AS seabed_depth.*", r"\1", lines[0])
    assert "array_sort" not in inside


def test_trigger_walks_many_chunks_at_once(spark):
    """Short chunks of many platforms, in no Python call for each of them; segments as by the sequential fold."""
    rng = np.random.default_rng(3)
    p = TriggerParams(buffer_pings=9, buffer_seconds=60.0, min_pings=4)
    times = {f"u{k}": np.sort(np.cumsum(rng.exponential(8.0, size=n)).round(0)) for k, n in enumerate([1, 3, 4, 9, 10, 11, 20, *rng.integers(2, 150, 30)])}
    pdf = pd.concat([pd.DataFrame({"platform": k, "ts": pd.to_datetime(t, unit="s"), "event_id": np.arange(len(t))}) for k, t in times.items()])
    df = spark.createDataFrame(pdf).withColumn("ts", F.col("ts").cast("timestamp_ntz"))
    want = sorted((k, *x) for k, t in times.items() for x in _trigger_brute(list(t), p))
    for chunk in (9, 10, 17, 1000):
        out = segment_trigger(df, p, chunk_rows=chunk)
        assert "FlatMapGroups" not in out._jdf.queryExecution().optimizedPlan().toString()
        assert sorted((r["platform"], r["event_id"], r["segment_rn"], r["n_segment_pings"]) for r in out.collect()) == want, chunk


def test_a_platform_with_a_ping_without_time_has_the_same_segments_in_any_chunks(spark):
    """Numbers begin after the pings without a time, so ping 0 is missing: no chunk of the platform is entered."""
    t = lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)
    rows = [(k, t(i), i) for k in "ab" for i in range(60)] + [("a", None, 60), ("a", None, 61)]
    df = spark.createDataFrame(rows, "platform string, ts timestamp_ntz, event_id bigint")
    p = TriggerParams(buffer_pings=9, buffer_seconds=1e9, min_pings=4)
    for chunk in (9, 12, 1000):
        got = segment_trigger(df, p, chunk_rows=chunk).collect()
        assert {r["platform"] for r in got} == {"b"} and len(got) == 60, chunk


def test_batches_are_cut_between_chunks(monkeypatch):
    from acoustispark.streaming import trigger
    rows = pd.DataFrame([("a", c, i) for c, n in enumerate((1, 7, 2, 30, 1)) for i in range(n)] + [("b", 4, i) for i in range(3)], columns=["k", "_chunk", "rn"])
    for step in (1, 4, 100):
        for enough in (1, 5, 1000):
            monkeypatch.setattr(trigger, "BATCH_ROWS", enough)
            got = list(trigger._whole_chunks(iter([rows.iloc[i:i + step] for i in range(0, len(rows), step)]), "k"))
            assert pd.concat(got, ignore_index=True).equals(rows)
            assert sum(len(trigger._first_rows(x, "k")) for x in got) == 6  # no chunk in two frames
