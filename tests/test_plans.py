"""What the plans of the heavy operators may hold: scans, exchanges, joins."""

import re

import pytest

from acoustispark.operators import calibrate as cal
from acoustispark.operators import denoise as dn
from acoustispark.operators import seabed as sb
from acoustispark.operators import summary as sm
from acoustispark.sources import fixtures as fx

from .conftest import SF


def _nodes(df) -> dict:
    text = df._jdf.queryExecution().optimizedPlan().toString() + df._jdf.queryExecution().executedPlan().toString()
    plan = df._jdf.queryExecution().executedPlan().toString()
    return {"scans": len(re.findall(r"FileScan", plan)), "joins": len(re.findall(r"Join", plan)), "exchanges": len(re.findall(r"Exchange", plan)),
            "expands": len(re.findall(r"\bExpand\b", text)), "python": len(re.findall(r"InPandas|InArrow|EvalPython", plan))}


CASES = {
    "denoise": lambda p: dn.denoise(p, absorption=0.01),
    "drop_empty": cal.drop_empty_pings,
    "echo_range": lambda p: cal.correct_echo_range(p, 5.0),
    "first_channel": cal.product_select,
    "seabed": lambda p: sb.mask_seabed(sb.ariza(p)),
    "raster": sm.echogram_raster,
    "summary": sm.segment_summary,
}


@pytest.mark.parametrize("name", sorted(CASES))
def test_ping_operators_read_once_and_join_nothing(spark, name):
    n = _nodes(CASES[name](fx.pings(spark, SF)))
    assert n["scans"] == 1 and n["joins"] == 0 and n["python"] == 0 and n["expands"] == 0, n
    assert n["exchanges"] <= 2, n
