"""Connected regions against a flood fill."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from acoustispark.operators import regions as rg
from acoustispark.operators import seabed as sb


def _flood(mask):
    """(ping, sample) -> number of its region, 4-connected, in order of the first cell."""
    label = {}
    for p, row in enumerate(mask):
        for i, m in enumerate(row):
            if m and (p, i) not in label:
                todo, label[p, i] = [(p, i)], (p, i)
                while todo:
                    q, j = todo.pop()
                    for c in ((q - 1, j), (q + 1, j), (q, j - 1), (q, j + 1)):
                        if 0 <= c[0] < len(mask) and 0 <= c[1] < len(mask[c[0]]) and mask[c[0]][c[1]] and c not in label:
                            label[c] = (p, i)
                            todo.append(c)
    return label


def _frame(spark, masks):
    rows = [("p", f"s{k}", "c", p, dt.datetime(2024, 1, 1) + dt.timedelta(seconds=p), row) for k, mask in enumerate(masks) for p, row in enumerate(mask)]
    return spark.createDataFrame(rows, "platform string, segment string, channel string, ping_index bigint, ping_time timestamp_ntz, m array<boolean>")


def test_runs(spark):
    df = spark.createDataFrame([([True, True, False, True],), ([False],), ([],), (None,), ([None, True, None],), ([True],)], "m array<boolean>")
    got = [None if r.r is None else [tuple(x) for x in r.r] for r in df.select(rg.runs(F.col("m")).alias("r")).collect()]
    assert got == [[(0, 1), (3, 3)], [], None, None, [(1, 1)], [(0, 0)]] or got == [[(0, 1), (3, 3)], [], [], None, [(1, 1)], [(0, 0)]]


def test_regions_equal_a_flood_fill(spark):
    rng = random.Random(4)
    masks = [[[rng.random() < share for _ in range(12)] for _ in range(25)] for share in (0.2, 0.5, 0.6, 0.9)]
    snake = [[(i % 2 == 0) or (p == 0 and i % 4 == 1) or (p == 24 and i % 4 == 3) for i in range(12)] for p in range(25)]  # one long way
    masks += [snake, [[False] * 3] * 4]
    df = _frame(spark, masks).withColumn("r", rg.runs(F.col("m")))
    got = {}
    for r in rg.label_regions(df, "r", []).collect():
        for i in range(r.a, r.b + 1):
            got[r.segment, r.ping_index, i] = (r.region.ping_index, r.region.a)
    want = {(f"s{k}", p, i): first for k, mask in enumerate(masks) for (p, i), first in _flood(mask).items()}
    assert got == want


@pytest.mark.parametrize("fish", [False, True])
def test_a_school_above_the_bottom_is_not_the_bottom(spark, fish):
    """A short school in mid-water and a bottom along the whole line: with regions the line is the bottom's."""
    rows = []
    for p in range(12):
        sv = [-90.0] * 30
        for i in range(20, 26):
            sv[i] = -30.0
        if fish and 3 <= p <= 5:
            for i in range(5, 10):
                sv[i] = -40.0
        rows.append(("p", "s", "c", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=p), sv, [float(i) for i in range(30)]))
    df = spark.createDataFrame(rows, "platform string, segment string, channel string, ping_time timestamp_ntz, sv array<double>, depth array<double>")
    plain = [r.seabed_depth for r in sb.ariza(df).orderBy("ping_time").collect()]
    kept = [r.seabed_depth for r in sb.ariza(df, regions=True).orderBy("ping_time").collect()]
    assert kept == [21.0] * 12 and (min(plain) < 20) == fish


def test_regions_send_no_runs_through_the_driver(spark, monkeypatch):
    """No join broadcasts, neither of the rounds nor of what is returned, however small the sides are."""
    plans, write = [], rg.staged
    monkeypatch.setattr(rg, "staged", lambda df, name: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, name))[1])
    masks = [[[(p + i + k) % 3 != 0 for i in range(12)] for p in range(10)] for k in range(2)]
    df = _frame(spark, masks).withColumn("r", rg.runs(F.col("m"))).withColumn("hit", F.lit(True))
    found = rg.label_regions(df, "r", [])
    keys = ["platform", "segment", "channel"]
    kept = rg.touched(rg.largest(found, keys).withColumn("hit", F.lit(True)), "hit").withColumn("d", F.col("a").cast("double"))
    line = rg.with_line(df, kept, "d")
    plans.append(line._jdf.queryExecution().executedPlan().toString())
    assert line.count() == 20 and sum("Join" in x for x in plans) >= 3
    assert not [x for x in plans if "Broadcast" in x]
