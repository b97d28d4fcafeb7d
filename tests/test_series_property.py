"""Blocked series windows equal a brute-force whole-series computation."""

import math

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from pitlane.operators.series import Series, series_pass


def brute_force(rows):
    """Plain per-series loops: the semantics every block layout must reproduce."""
    df = pd.DataFrame(rows, columns=["raceId", "pilot_index", "frameIdentifier", "x", "c"])
    out = {}
    for _, g in df.groupby(["raceId", "pilot_index"], sort=False):
        g = g.sort_values("frameIdentifier")
        xs = [None if (v is None or (isinstance(v, float) and math.isnan(v))) else v for v in g["x"]]
        cs = [None if (v is None or (isinstance(v, float) and math.isnan(v))) else int(v) for v in g["c"]]
        last = None
        for i, key in enumerate(zip(g["raceId"], g["pilot_index"], g["frameIdentifier"])):
            prev = xs[i - 1] if i > 0 else None
            nxt = xs[i + 1] if i + 1 < len(xs) else None
            mean = xs[i] if xs[i] is not None else (None if prev is None or nxt is None else (prev + nxt) / 2)
            if cs[i] is not None:
                last = cs[i]
            nxt_c = next((v for v in cs[i:] if v is not None), None)
            out[key] = (mean, last, nxt_c, prev, nxt, i + 1)
    return out


row = st.tuples(
    st.sampled_from(["a", "b"]),
    st.integers(0, 2),
    st.one_of(st.none(), st.floats(-100, 100, allow_nan=False).map(lambda v: round(v, 2))),
    st.one_of(st.none(), st.integers(0, 5)),
)


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(row, min_size=1, max_size=40),
    width=st.integers(1, 9),
    frames=st.integers(0, 3),
    levels=st.integers(0, 3),
    fan_out=st.integers(1, 4),
)
def test_blocked_equals_brute_force(spark, data, width, frames, levels, fan_out):
    # unique frames per series, spread out by a random stride
    rows = [(r, p, i * (frames + 1), x, c) for i, (r, p, x, c) in enumerate(data)]
    df = spark.createDataFrame(rows, "raceId string, pilot_index int, frameIdentifier bigint, x double, c int")
    prev_next = df.withColumn("x2", df.x)
    out = series_pass(
        prev_next,
        Series(block_frames=width, levels=levels, fan_out=fan_out),
        mean=["x"],
        forward=["c"],
        previous={"p": "x2"},
        following={"n": "x2"},
        number="rn",
    ).join(df.selectExpr("raceId", "pilot_index", "frameIdentifier", "c AS c_raw"), ["raceId", "pilot_index", "frameIdentifier"])
    out = series_pass(out, Series(block_frames=width + 1, levels=levels, fan_out=fan_out + 1), backward=["c_raw"])
    expected = brute_force(rows)
    got = {(r.raceId, r.pilot_index, r.frameIdentifier): (r.x, r.c, r.c_raw, r.p, r.n, r.rn) for r in out.collect()}
    assert got.keys() == expected.keys()
    for k, v in expected.items():
        assert got[k] == v, (k, got[k], v)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    data=st.lists(row, min_size=1, max_size=30),
    width=st.integers(1, 5),
    levels=st.integers(0, 2),
    fan_out=st.integers(1, 3),
)
def test_tiebreak_with_repeated_frames(spark, data, width, levels, fan_out):
    # frames repeat (i // 3); the row index breaks ties, so the order is still total
    rows = [(r, p, i // 3, i, x, c) for i, (r, p, x, c) in enumerate(data)]
    df = spark.createDataFrame(rows, "raceId string, pilot_index int, frameIdentifier bigint, sub int, x double, c int")
    s = Series(tiebreak=("sub",), block_frames=width, levels=levels, fan_out=fan_out)
    out = series_pass(df, s, mean=["x"], forward=["c"], number="rn")
    # brute force over (frame, sub) == order of the row index
    expected = brute_force([(r, p, i, x, c) for (r, p, _, i, x, c) in rows])
    got = {(r.raceId, r.pilot_index, r.sub): (r.x, r.c, r.rn) for r in out.collect()}
    for (race, pilot, i), (mean, last, _, _, _, rn) in expected.items():
        assert got[(race, pilot, i)] == (mean, last, rn)
