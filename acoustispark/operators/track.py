"""GPS tracks: validity filters, Savitzky-Golay smoothing, distance/speed, Ramer-Douglas-Peucker simplification,
greedy distance thinning, sampling of points, as-of location joins and carry-forward of fixes.

Every window is partitioned by a *track key* (default ``platform, segment``), so a window partition is one
segment of one platform, never a whole platform history. Ties in time are broken by ``event_id``.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from acoustispark.functions import scalars as fn
from acoustispark.operators.util import fill_backward, fill_forward, spread_groups

TRACK = ("platform", "segment")
ORDER = ("ts", "event_id")

# Fixed parameters that must equal the reference's behaviour -------------------------------------------------
SG_WINDOW = 11          # Savitzky-Golay window length (applied only when the track has more points)
SG_ORDER = 2            # polynomial order
MAX_KNOTS = 100.0       # fixes at or above this speed are dropped
RDP_EPSILON = 1e-5      # degrees, planar
MIN_DISTANCE_NMI = 0.01  # greedy thinning distance
ALLCLOSE_RTOL = 1e-5    # numpy.allclose defaults used for "line end points are equal"
ALLCLOSE_ATOL = 1e-8
# --------------------------------------------------------------------------------------------------------------
COORD_DIGITS = 9        # decimals of smoothed positions [def]


def _savgol_weights(window: int = SG_WINDOW, order: int = SG_ORDER) -> list[list[Fraction]]:
    """Least-squares polynomial projection over ``window`` equally spaced points, exact rationals.

    Row ``i`` holds the weights giving the fitted value at position ``i``; the middle row is the convolution
    kernel of the filter, the first/last rows give the end treatment (fit to the end window).
    """
    t = list(range(window))
    X = [[Fraction(x) ** p for p in range(order + 1)] for x in t]
    XtX = [[sum(X[r][a] * X[r][b] for r in range(window)) for b in range(order + 1)] for a in range(order + 1)]
    inv = _inverse(XtX)
    H = [[sum(X[i][a] * inv[a][b] * X[j][b] for a in range(order + 1) for b in range(order + 1))
          for j in range(window)] for i in range(window)]
    return H


def _inverse(m: list[list[Fraction]]) -> list[list[Fraction]]:
    n = len(m)
    a = [row[:] + [Fraction(int(i == j)) for j in range(n)] for i, row in enumerate(m)]
    for c in range(n):
        p = next(r for r in range(c, n) if a[r][c] != 0)
        a[c], a[p] = a[p], a[c]
        piv = a[c][c]
        a[c] = [v / piv for v in a[c]]
        for r in range(n):
            if r != c and a[r][c] != 0:
                f = a[r][c]
                a[r] = [vr - f * vc for vr, vc in zip(a[r], a[c])]
    return [row[n:] for row in a]


SG_H = _savgol_weights()
_HALF = SG_WINDOW // 2


def savgol_terms() -> dict:
    """Integer numerators and denominators of the weights: interior kernel and the head rows 0..half-1.

    Returns ``{"interior": (nums, den), "head": [(nums, den), ...]}``; offsets are relative to the row:
    interior uses offsets -half..half, head row i uses offsets -i..window-1-i, tail row (n-1-m) mirrors head m.
    """
    def as_ints(row):
        den = 1
        for w in row:
            den = den * w.denominator // np.gcd(den, w.denominator)
        return [int(w * den) for w in row], den

    return {"interior": as_ints(SG_H[_HALF]), "head": [as_ints(SG_H[i]) for i in range(_HALF)]}


def gps_valid(df: DataFrame, lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Drop missing positions; keep -90<=lat<=90 and -180<=lon<=180 (zeros are kept)."""
    return df.where(F.col(lat).isNotNull() & F.col(lon).isNotNull()
                    & F.col(lat).between(-90, 90) & F.col(lon).between(-180, 180))


def gps_nonzero(df: DataFrame, keys=TRACK) -> DataFrame:
    """Latitude and longitude ranges per key, each ignoring its own zeros and missing values."""
    lat = F.nullif(F.col("lat"), F.lit(0.0))
    lon = F.nullif(F.col("lon"), F.lit(0.0))
    return df.groupBy(*keys).agg(F.min(lat).alias("lat_min"), F.max(lat).alias("lat_max"),
                                 F.min(lon).alias("lon_min"), F.max(lon).alias("lon_max"))


def _window(keys, order) -> Window:
    return Window.partitionBy(*keys).orderBy(*order)


def _at(col: str, d: int, w: Window) -> Column:
    if d == 0:
        return F.col(col)
    return F.lead(col, d).over(w) if d > 0 else F.lag(col, -d).over(w)


def _weighted(col: str, nums: list[int], den: int, offsets: list[int], w: Window) -> Column:
    acc = None
    for n, d in zip(nums, offsets):
        term = F.lit(float(n)) * _at(col, d, w)
        acc = term if acc is None else acc + term
    return acc / F.lit(float(den))


def track_smooth(df: DataFrame, cols=("lat", "lon"), keys=TRACK, order=ORDER) -> DataFrame:
    """Savitzky-Golay (window 11, order 2) on each column, only for tracks with more than 11 points.

    Interior rows use the symmetric kernel; the first/last 5 rows use the quadratic fitted to the first/last
    11 points (the filter's ``interp`` end treatment). All terms are lag/lead over one window.
    """
    w = _window(keys, order)
    terms = savgol_terms()
    i = F.row_number().over(w) - 1
    n = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    out = df.withColumn("_i", i).withColumn("_n", n)
    for c in cols:
        nums, den = terms["interior"]
        expr = F.when((F.col("_i") >= _HALF) & (F.col("_i") <= F.col("_n") - 1 - _HALF),
                      _weighted(c, nums, den, list(range(-_HALF, _HALF + 1)), w))
        for m, (hn, hd) in enumerate(terms["head"]):
            expr = expr.when(F.col("_i") == m, _weighted(c, hn, hd, [j - m for j in range(SG_WINDOW)], w))
            expr = expr.when(F.col("_i") == F.col("_n") - 1 - m,
                             _weighted(c, hn, hd, [m - j for j in range(SG_WINDOW)], w))
        out = out.withColumn(f"_s_{c}", F.when(F.col("_n") > SG_WINDOW, expr).otherwise(F.col(c)))
    for c in cols:
        out = out.withColumn(c, F.col(f"_s_{c}")).drop(f"_s_{c}")
    return out.drop("_i", "_n")


def track_distance(df: DataFrame, keys=TRACK, order=ORDER) -> DataFrame:
    """``distance``: haversine nmi from the previous fix, 0 for the first one."""
    w = _window(keys, order)
    d = fn.haversine_nmi(F.lag("lat").over(w), F.lag("lon").over(w), F.col("lat"), F.col("lon"))
    return df.withColumn("distance", F.coalesce(d, F.lit(0.0)))


def track_speed(df: DataFrame, keys=TRACK, order=ORDER, ts: str = "ts") -> DataFrame:
    """``knt = distance / dt_seconds * 3600``; NULL for the first fix and where dt is 0."""
    w = _window(keys, order)
    dt = (F.unix_micros(F.col(ts).cast("timestamp")) - F.unix_micros(F.lag(ts).over(w).cast("timestamp"))) / F.lit(1e6)
    return df.withColumn("knt", F.when(dt != 0, F.col("distance") / dt * F.lit(3600.0)))


def speed_filter(df: DataFrame, max_knots: float = MAX_KNOTS) -> DataFrame:
    """Keep ``knt < 100``; NULL speeds fail, so the first fix of a track is always dropped."""
    return df.where(F.col("knt") < F.lit(max_knots))


def track_thin_distance(df: DataFrame, min_distance: float = MIN_DISTANCE_NMI, keys=TRACK, order=ORDER) -> DataFrame:
    """Greedy thinning: keep a fix when it is at least ``min_distance`` nmi from the last *kept* fix; the
    first fix is always kept.

    Tracks are clustered and sorted by Spark and walked once in Arrow batches; what a task remembers is the last kept
    fix, so a long track costs no memory.
    """
    cols = list(keys) + list(order) + ["lat", "lon"]
    n = len(keys)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        track, klat, klon = None, 0.0, 0.0
        for b in batches:
            names = list(zip(*(b.column(i).to_pylist() for i in range(n))))
            lat, lon = b.column(b.num_columns - 2).to_numpy(), b.column(b.num_columns - 1).to_numpy()
            keep, at = [], 0
            while at < len(names):
                if names[at] != track:
                    track, klat, klon = names[at], lat[at], lon[at]
                    keep.append(at)
                    at += 1
                    continue
                end = at + 1
                while end < len(names) and names[end] == track:
                    end += 1
                while at < end:
                    far = np.flatnonzero(_haversine_np(klat, klon, lat[at:end], lon[at:end]) >= min_distance)
                    if not len(far):
                        break
                    at += int(far[0])
                    keep.append(at)
                    klat, klon = lat[at], lon[at]
                    at += 1
                at = end
            yield b.take(pa.array(keep, pa.int64()))

    src = df.select(*cols)
    return spread_groups(src, *keys).sortWithinPartitions(*keys, *order).mapInArrow(run, src.schema)


def _rdp_indices(pts: np.ndarray, eps: float) -> list[int]:
    """Ramer-Douglas-Peucker on planar points, iterative; returns kept indices in order.

    Distance to the segment between the end points (projection clipped to the segment); when the end points
    are ``allclose`` the distance to the first end point. Split at the first index of the strict maximum,
    recurse while the maximum is ``> eps``.
    """
    n = len(pts)
    if n < 3:
        return list(range(n))
    keep = np.zeros(n, dtype=bool)
    stack = [(0, n - 1)]
    while stack:
        a, b = stack.pop()
        keep[a] = keep[b] = True
        if b - a < 2:
            continue
        s, e = pts[a], pts[b]
        mid = pts[a + 1:b]
        if np.allclose(s, e, rtol=ALLCLOSE_RTOL, atol=ALLCLOSE_ATOL):
            d = np.linalg.norm(mid - s, axis=1)
        else:
            v = e - s
            ln = np.linalg.norm(v)
            u = v / ln
            t = np.clip(((mid - s) / ln) @ u, 0, 1)
            d = np.linalg.norm(mid - (s + t[:, None] * v), axis=1)
        k = int(np.argmax(d))
        if d[k] > eps:
            stack.append((a + 1 + k, b))
            stack.append((a, a + 1 + k))
    return [i for i in range(n) if keep[i]]


def _haversine_np(lat1, lon1, lat2, lon2):
    p1, p2 = np.radians(lat1), np.radians(lat2)
    a = np.sin((p2 - p1) / 2) ** 2 + np.cos(p1) * np.cos(p2) * np.sin((np.radians(lon2) - np.radians(lon1)) / 2) ** 2
    return 2 * fn.EARTH_RADIUS_KM / fn.KM_PER_NMI * np.arcsin(np.sqrt(a))


def _simplify_track(lat: np.ndarray, lon: np.ndarray, eps: float, min_distance: float | None) -> list[int]:
    """Places of the kept fixes of one ordered track. A kept position stands for the first fix with that position."""
    idx = _rdp_indices(np.column_stack([lat, lon]), eps)
    pos = lat + 1j * lon
    _, first, inverse = np.unique(pos, return_index=True, return_inverse=True)
    src = first[inverse[idx]]
    if min_distance is None or not len(src):
        return src.tolist()
    kept = [int(src[0])]
    while True:  # the next kept fix is the first one far enough from the last; distances are taken for all at once
        at = np.flatnonzero(src == kept[-1])[-1] if len(kept) == 1 else at
        rest = src[at + 1:]
        far = np.flatnonzero(_haversine_np(lat[kept[-1]], lon[kept[-1]], lat[rest], lon[rest]) >= min_distance)
        if not len(far):
            return kept
        at += 1 + int(far[0])
        kept.append(int(src[at]))


def simplify_rdp(df: DataFrame, epsilon: float = RDP_EPSILON, min_distance: float | None = None,
                 keys=TRACK, batch_rows: int = 1 << 16) -> DataFrame:
    """Ramer-Douglas-Peucker per track, the (lat, lon) look-up of time and speed, then optional greedy thinning.

    Tracks are clustered and sorted by Spark; a task walks its sorted Arrow batches and handles track after track (a
    track is bounded by its key: one segment), so no call is made per group.
    """
    schema = T.StructType([df.schema[k] for k in keys] + [
        T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
        T.StructField("lat", T.DoubleType()), T.StructField("lon", T.DoubleType()), T.StructField("knt", T.DoubleType())])
    cols = list(keys) + ["event_id", "ts", "lat", "lon", "knt"]
    src = df.select(*cols) if "knt" in df.columns else df.withColumn("knt", F.lit(None).cast("double")).select(*cols)
    n = len(keys)

    def whole(t: pa.Table) -> pa.Table:
        """All tracks of a table sorted by track, time and id."""
        parts = [t.column(i).to_numpy(zero_copy_only=False) for i in range(n)]
        change = np.zeros(t.num_rows, dtype=bool)
        for p in parts:
            change[1:] |= p[1:] != p[:-1]
        edge = [0, *np.flatnonzero(change).tolist(), t.num_rows]
        lat, lon = t.column(n + 2).to_numpy(), t.column(n + 3).to_numpy()
        rows = [a + i for a, b in zip(edge, edge[1:]) for i in _simplify_track(lat[a:b], lon[a:b], epsilon, min_distance)]
        return t.take(pa.array(rows, pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for b in batches:
            if not b.num_rows:
                continue
            held.append(b)
            if sum(x.num_rows for x in held) < batch_rows:
                continue
            t = pa.Table.from_batches(held)
            last = [t.column(i)[t.num_rows - 1].as_py() for i in range(n)]
            cut = t.num_rows  # the last track may go on in the next batch
            while cut and [t.column(i)[cut - 1].as_py() for i in range(n)] == last:
                cut -= 1
            if cut:
                yield from whole(t.slice(0, cut)).to_batches()
                held = t.slice(cut).to_batches()
        if held:
            yield from whole(pa.Table.from_batches(held)).to_batches()

    ordered = spread_groups(src, *keys).sortWithinPartitions(*keys, *ORDER)
    return ordered.mapInArrow(run, schema)


def settled(df: DataFrame, digits: int = COORD_DIGITS) -> DataFrame:
    """Positions rounded to ``digits`` decimals (0.1 mm), so that a simplification does not depend on rounding noise
    of the smoothing sums."""
    return df.withColumn("lat", F.round("lat", digits)).withColumn("lon", F.round("lon", digits))


def extract_track(nav: DataFrame, epsilon: float = RDP_EPSILON, min_distance: float = MIN_DISTANCE_NMI,
                  keys=TRACK) -> DataFrame:
    """valid -> smooth -> distance -> speed -> speed filter -> RDP -> look-up -> greedy thinning.

    Output ``keys, event_id, ts, lat, lon, knt``; a track with no fix left after the speed filter yields no rows.
    """
    t = settled(track_smooth(gps_valid(nav), keys=keys))
    t = speed_filter(track_speed(track_distance(t, keys=keys), keys=keys))
    return simplify_rdp(t, epsilon, min_distance, keys)


def sample_track_points(df: DataFrame, n: int, keys=TRACK, order=ORDER) -> DataFrame:
    """All points when a track has at most ``n``; else every ``max(1, total // n)``-th point from the first,
    at most ``n`` of them."""
    w = _window(keys, order)
    total = F.count(F.lit(1)).over(Window.partitionBy(*keys))
    step = F.greatest(F.floor(total / F.lit(n)), F.lit(1))
    i = F.row_number().over(w) - 1
    out = df.withColumn("_i", i).withColumn("_t", total).withColumn("_step", step)
    keep = (F.col("_t") <= n) | (((F.col("_i") % F.col("_step")) == 0) & (F.floor(F.col("_i") / F.col("_step")) < n))
    return out.where(keep).drop("_i", "_t", "_step")


def location_messages(track: DataFrame, n: int = 5, keys=TRACK) -> DataFrame:
    """Track -> ``n`` evenly sampled points -> JSON location messages."""
    pts = sample_track_points(track, n, keys)
    return pts.select(*keys, "event_id", fn.location_message("lat", "lon", "ts", "knt").alias("message"))


def add_location(targets: DataFrame, fixes: DataFrame, key: str = "platform", ts: str = "ts",
                 tie: str = "event_id", interpolate: bool = True) -> DataFrame:
    """As-of join of fixes to targets by ``key`` and time.

    ``fix_lat/fix_lon/fix_ts``: the last fix at or before the target (as-of). With ``interpolate``, ``lat/lon``
    are linearly interpolated in time between that fix and the next later one; outside the fixes' span NULL
    [def]. Both sides are unioned and the nearest fixes found by day-bounded fills (see ``util.fill_forward``):
    one sort by (key, day, time), no pairs, no window over a whole key history.
    """
    f = fixes.select(key, ts, tie, F.lit(0).alias("_side"), F.struct(ts, "lat", "lon").alias("_fix"))
    t = targets.select(key, ts, tie, F.lit(1).alias("_side"), F.lit(None).cast(f.schema["_fix"].dataType).alias("_fix"))
    u = f.unionByName(t).withColumn("_day", F.to_date(ts))
    order = (ts, "_side", tie)
    u = fill_forward(u, (key,), "_day", order, "_fix", "_prev")
    u = fill_backward(u, (key,), "_day", order, "_fix", "_next").where(F.col("_side") == 1)
    out = u.select(key, ts, tie, F.col("_prev.lat").alias("fix_lat"), F.col("_prev.lon").alias("fix_lon"),
                   F.col("_prev")[ts].alias("fix_ts"), "_prev", "_next")
    if interpolate:
        t0 = F.unix_micros(F.col(f"_prev.{ts}").cast("timestamp"))
        t1 = F.unix_micros(F.col(f"_next.{ts}").cast("timestamp"))
        tt = F.unix_micros(F.col(ts).cast("timestamp"))
        frac = F.when(t1 == t0, F.lit(0.0)).otherwise((tt - t0) / (t1 - t0))
        ok = F.col("_prev").isNotNull() & F.col("_next").isNotNull()
        out = out.withColumn("lat", F.when(ok, F.col("_prev.lat") + (F.col("_next.lat") - F.col("_prev.lat")) * frac)) \
                 .withColumn("lon", F.when(ok, F.col("_prev.lon") + (F.col("_next.lon") - F.col("_prev.lon")) * frac))
    return out.drop("_prev", "_next")


def nav_carry_forward(nav: DataFrame, keys=("platform",), order=ORDER, ts: str = "ts") -> DataFrame:
    """Last non-zero latitude/longitude carried forward (each on its own), 0.0 before the first one.

    Day-bounded fills: within (key, day) a running ``last(ignorenulls)``, across days the last value of the
    previous days.
    """
    d = nav.withColumn("_day", F.to_date(ts)) \
        .withColumn("_lat", F.nullif(F.col("lat"), F.lit(0.0))).withColumn("_lon", F.nullif(F.col("lon"), F.lit(0.0)))
    d = fill_forward(d, keys, "_day", order, "_lat", "_lat_cf")
    d = fill_forward(d, keys, "_day", order, "_lon", "_lon_cf")
    return (d.withColumn("lat_cf", F.coalesce(F.col("_lat_cf"), F.lit(0.0)))
            .withColumn("lon_cf", F.coalesce(F.col("_lon_cf"), F.lit(0.0)))
            .drop("_day", "_lat", "_lon", "_lat_cf", "_lon_cf"))


def nav_poll(nav: DataFrame, seconds: int = 5, keys=("platform",), ts: str = "ts") -> DataFrame:
    """Navigation as polled every ``seconds``: the first fix of each tumbling bucket [def]."""
    return (nav.groupBy(*keys, F.window(ts, f"{seconds} seconds").start.alias("bucket"))
            .agg(F.min_by(F.struct(ts, "event_id", "lat", "lon", "heading"), F.struct(ts, "event_id")).alias("_f"))
            .select(*keys, "bucket", "_f.*"))


def gps_lookup_back(points: DataFrame, fixes: DataFrame, keys=TRACK, order=ORDER) -> DataFrame:
    """Time and speed of a simplified point found again by exact (lat, lon) equality: the *first* fix with
    that position wins, so repeated positions all get the earliest time."""
    w = Window.partitionBy(*keys, "lat", "lon").orderBy(*order)
    first = (fixes.withColumn("_r", F.row_number().over(w)).where(F.col("_r") == 1)
             .select(*keys, "lat", "lon", *order, "knt"))
    return points.select(*keys, "lat", "lon").join(first, [*keys, "lat", "lon"], "left")


def ping_order(df: DataFrame, keys=("platform", "segment"), ts: str = "ping_time") -> DataFrame:
    """Positional index of each ping within its segment (0 = first)."""
    pings = df.select(*keys, ts).distinct()
    w = Window.partitionBy(*keys).orderBy(ts)
    return pings.withColumn("ping_index", F.row_number().over(w) - 1)
