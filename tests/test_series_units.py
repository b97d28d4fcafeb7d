"""Hand-made series: the fills, lag/lead and numbering, across block edges."""

import pytest
from pyspark.sql import Row

from pitlane.operators.series import Series, series_pass
from pitlane.operators.impute import chunk

SCHEMA = "raceId string, pilot_index int, frameIdentifier bigint, x double, s string"


def frame(spark, values, race="r1", pilot=0, start=0):
    rows = [(race, pilot, start + i, v, None) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, SCHEMA)


def column(df, c):
    return [r[c] for r in df.orderBy("raceId", "pilot_index", "frameIdentifier").collect()]


BLOCKS = [1, 2, 3, 4, 1 << 16]


@pytest.mark.parametrize("levels", [0, 1, 2, 3])
@pytest.mark.parametrize("width", [1, 2, 3])
def test_levels_agree(spark, width, levels):
    df = frame(spark, [10.0, None, 20.0, None, None, 30.0, None, 5.0, None, 7.0])
    s = Series(block_frames=width, levels=levels, fan_out=2)
    out = series_pass(df, s, mean=["x"], previous={"p": "x"}, number="rn")
    assert column(out, "x") == [10.0, 15.0, 20.0, None, None, 30.0, 17.5, 5.0, 6.0, 7.0]
    assert column(out, "p") == [None, 10.0, None, 20.0, None, None, 30.0, None, 5.0, None]
    assert column(out, "rn") == list(range(1, 11))


@pytest.mark.parametrize("width", BLOCKS)
def test_neighbour_mean(spark, width):
    df = frame(spark, [10.0, None, 20.0, None, None, 30.0, None])
    out = series_pass(df, Series(block_frames=width), mean=["x"])
    assert column(out, "x") == [10.0, 15.0, 20.0, None, None, 30.0, None]


@pytest.mark.parametrize("width", BLOCKS)
def test_forward_and_backward_fill(spark, width):
    rows = [("r", 0, i, None, v) for i, v in enumerate([None, "a", None, None, "b", None, None])]
    df = spark.createDataFrame(rows, SCHEMA)
    fwd = series_pass(df, Series(block_frames=width), forward=["s"])
    bwd = series_pass(df, Series(block_frames=width), backward=["s"])
    assert column(fwd, "s") == [None, "a", "a", "a", "b", "b", "b"]
    assert column(bwd, "s") == ["a", "a", "b", "b", "b", None, None]


@pytest.mark.parametrize("width", BLOCKS)
def test_lag_lead_and_number(spark, width):
    df = frame(spark, [1.0, None, 3.0, 4.0, 5.0])
    out = series_pass(df, Series(block_frames=width), previous={"p": "x"}, following={"n": "x"}, number="rn")
    assert column(out, "p") == [None, 1.0, None, 3.0, 4.0]
    assert column(out, "n") == [None, 3.0, 4.0, 5.0, None]
    assert column(out, "rn") == [1, 2, 3, 4, 5]


def test_series_do_not_mix(spark):
    # same pilot in two races, same frames: separate series
    a = frame(spark, [1.0, None, 3.0], race="r1", pilot=7)
    b = frame(spark, [None, 5.0, None], race="r2", pilot=7)
    out = series_pass(a.unionByName(b), Series(block_frames=2), mean=["x"], number="rn")
    got = {(r.raceId, r.frameIdentifier): (r.x, r.rn) for r in out.collect()}
    assert got[("r1", 1)] == (2.0, 2)
    assert got[("r2", 0)] == (None, 1)
    assert got[("r2", 2)] == (None, 3)


def test_gaps_in_frames_and_empty_blocks(spark):
    # frames 0, 1, 10, 11, 30: blocks of width 4 leave empty blocks between rows
    rows = [("r", 0, f, v, s) for f, v, s in [(0, 1.0, "a"), (1, None, None), (10, 3.0, None), (11, None, "b"), (30, 7.0, None)]]
    df = spark.createDataFrame(rows, SCHEMA)
    out = series_pass(df, Series(block_frames=4), mean=["x"], forward=["s"], number="rn")
    assert column(out, "x") == [1.0, 2.0, 3.0, 5.0, 7.0]
    assert column(out, "s") == ["a", "a", "a", "b", "b"]
    assert column(out, "rn") == [1, 2, 3, 4, 5]


def test_null_series_key_is_a_series(spark):
    rows = [(None, None, i, v, None) for i, v in enumerate([1.0, None, 3.0, None, 5.0])]
    df = spark.createDataFrame(rows, SCHEMA)
    out = series_pass(df, Series(block_frames=2), mean=["x"], number="rn")
    assert column(out, "x") == [1.0, 2.0, 3.0, 4.0, 5.0]
    assert column(out, "rn") == [1, 2, 3, 4, 5]


def test_tiebreak_orders_equal_frames(spark):
    schema = "raceId string, pilot_index int, frameIdentifier bigint, sub int, x double"
    rows = [("r", 0, 0, 1, None), ("r", 0, 0, 0, 1.0), ("r", 0, 1, 0, 3.0)]
    df = spark.createDataFrame(rows, schema)
    out = series_pass(df, Series(tiebreak=("sub",), block_frames=1), mean=["x"])
    got = {(r.frameIdentifier, r.sub): r.x for r in out.collect()}
    assert got[(0, 1)] == 2.0


def test_int_column_becomes_double(spark):
    df = spark.createDataFrame([("r", 0, i, v) for i, v in enumerate([1, None, 2])], "raceId string, pilot_index int, frameIdentifier bigint, g int")
    out = series_pass(df, Series(block_frames=1), mean=["g"])
    assert dict(out.dtypes)["g"] == "double"
    assert column(out, "g") == [1.0, 1.5, 2.0]


@pytest.mark.parametrize("n", [199, 200, 201, 401])
def test_chunk_edges(spark, n):
    df = frame(spark, [float(i) for i in range(n)])
    out = chunk(df, 200, Series(block_frames=64))
    ids = column(out, "chunk_id")
    assert ids == [i // 200 for i in range(n)]
    assert column(out, "row_num") == list(range(1, n + 1))
    assert dict(out.dtypes)["chunk_id"] == "bigint"


def test_fill_sets_must_be_disjoint(spark):
    df = frame(spark, [1.0])
    with pytest.raises(ValueError):
        series_pass(df, forward=["x"], mean=["x"])


def test_columns_and_order_preserved(spark):
    df = frame(spark, [1.0, None, 3.0])
    out = series_pass(df, Series(block_frames=2), mean=["x"], number="rn")
    assert out.columns == df.columns + ["rn"]
    assert out.count() == 3


def test_series_settings_are_checked():
    with pytest.raises(ValueError):
        Series(block_frames=0)
    with pytest.raises(ValueError):
        Series(levels=-1)
    with pytest.raises(ValueError):
        Series(keys=())


def test_outputs_must_be_distinct(spark):
    df = frame(spark, [1.0])
    with pytest.raises(ValueError):
        series_pass(df, mean=["x"], previous={"x": "x"})


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz"])
def test_timestamp_order_key(spark, kind):
    from datetime import datetime, timedelta

    t0 = datetime(2020, 7, 5, 14, 0, 0)
    rows = [("r", 0, t0 + timedelta(seconds=i), v) for i, v in enumerate([1.0, None, 3.0, None, None, 6.0])]
    df = spark.createDataFrame(rows, f"raceId string, pilot_index int, ts {kind}, x double")
    # blocks of two seconds (in microseconds)
    out = series_pass(df, Series(order="ts", block_frames=2_000_000, fan_out=2), mean=["x"], number="rn")
    got = [(r.x, r.rn) for r in out.orderBy("ts").collect()]
    assert got == [(1.0, 1), (2.0, 2), (3.0, 3), (None, 4), (None, 5), (6.0, 6)]


def test_decimal_order_key_keeps_precision(spark):
    from decimal import Decimal

    base = Decimal("1234567890123456.0")  # beyond double precision in the last digit
    rows = [("r", 0, base + i, v) for i, v in enumerate([1.0, None, 3.0])]
    df = spark.createDataFrame(rows, "raceId string, pilot_index int, f decimal(20,1), x double")
    out = series_pass(df, Series(order="f", block_frames=1, fan_out=2), mean=["x"], previous={"p": "x"})
    got = [(r.x, r.p) for r in out.orderBy("f").collect()]
    assert got == [(1.0, None), (2.0, 1.0), (3.0, None)]
