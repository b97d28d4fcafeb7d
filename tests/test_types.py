"""The type lattice: fields, columns, frames that disagree."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DateType, DecimalType, DoubleType, IntegerType, LongType, NullType, StringType, TimestampType

from pitlane.functions import types as T
from pitlane.operators.union import union_widened
from pitlane.sources import files as src
from pitlane.sources.infer import infer_types, observed, type_report

FIELDS = {
    None: 0, "": 0, "  ": 0, "7": T.INT, " -7 ": T.INT, "+0012": T.INT, "2147483647": T.INT, "-2147483648": T.INT,
    "2147483648": T.LONG, "9007199254740992": T.LONG, "9007199254740993": T.WIDE, "-9223372036854775808": T.WIDE,
    "9223372036854775808": T.TEXT, "18274650913827465091": T.TEXT, "7.0": T.DOUBLE, ".5": T.DOUBLE, "5.": T.DOUBLE, "-1e-3": T.DOUBLE, "NaN": T.DOUBLE,
    "1e999": T.TEXT, "1d": T.TEXT, "0x10": T.TEXT, "1,5": T.TEXT, "--1": T.TEXT, "2024-02-29": T.DATE, "2023-02-29": T.TEXT, "2024": T.INT,
    "2024-02-01 10:30": T.TIMESTAMP, "2024-02-01T10:30:01.5Z": T.TIMESTAMP, "2024-02-01 25:00": T.TEXT, "10:30": T.TEXT,
    "true": T.BOOLEAN, "FALSE": T.BOOLEAN, "t": T.TEXT, "soft": T.TEXT, "1/2/3/4": T.TEXT,
}


def test_bits_of_fields(spark):
    df = spark.createDataFrame([(v,) for v in FIELDS], "v string").select("v", T.field_bits(F.col("v")).alias("b"))
    assert {r.v: r.b for r in df.collect()} == FIELDS


@pytest.mark.parametrize(
    "bits, want",
    [
        (0, StringType()), (T.INT, IntegerType()), (T.INT | T.LONG, LongType()), (T.INT | T.WIDE, LongType()), (T.INT | T.DOUBLE, DoubleType()),
        (T.LONG | T.DOUBLE, DoubleType()), (T.WIDE | T.DOUBLE, StringType()), (T.DATE, DateType()), (T.DATE | T.TIMESTAMP, TimestampType()),
        (T.BOOLEAN, BooleanType()), (T.BOOLEAN | T.INT, StringType()), (T.DATE | T.INT, StringType()), (T.INT | T.TEXT, StringType()),
    ],
)
def test_type_of_bits(bits, want):
    assert T.type_of_bits(bits) == want


def test_join_is_a_join():
    """Order and grouping of the merged bits do not matter, and the joined type holds each part's."""
    for a in range(256):
        for b in (T.INT, T.LONG, T.WIDE, T.DOUBLE, T.DATE, T.TIMESTAMP, T.BOOLEAN, T.TEXT):
            joined = T.type_of_bits(a | b)
            assert joined == T.type_of_bits(b | a) == T.type_of_bits(a | b | a)
            assert joined == StringType() or not a or T.join_types([T.type_of_bits(a), joined]) == joined


def test_join_of_types():
    assert T.join_types([IntegerType(), NullType()]) == IntegerType()
    assert T.join_types([DecimalType(10, 2), DecimalType(10, 2)]) == DecimalType(10, 2)
    assert T.join_types([DecimalType(10, 2), IntegerType()]) == DoubleType()
    assert T.join_types([LongType(), StringType()]) == StringType()


def test_inference_is_one_mergeable_aggregate(spark):
    raw = spark.createDataFrame([("1", str(i), "x" if i == 70 else str(i), "") for i in range(100)], "raceId string, a string, `b.c` string, e string").repartition(7)
    assert infer_types(raw) == {"a": IntegerType(), "b.c": StringType(), "e": StringType()}
    plan = observed(raw, ["a", "b.c"])._jdf.queryExecution().executedPlan().toString()
    assert "partial_bit_or" in plan and "Sort" not in plan
    assert infer_types(raw, {"a": DoubleType(), "b.c": StringType(), "e": StringType()})["a"] == DoubleType()


def test_no_pass_over_declared_columns(spark):
    bad = spark.range(3).select(F.raise_error(F.lit("read")).cast("string").alias("a"))
    assert infer_types(bad, {"a": IntegerType()}) == {"a": IntegerType()}


def test_empty_frame_and_groups(spark):
    empty = spark.createDataFrame([], "raceId string, a string")
    assert infer_types(empty) == {"a": StringType()}
    rows = spark.createDataFrame([("1", "5"), ("2", "x"), ("3", None)], "raceId string, a string")
    assert sorted(map(tuple, type_report(rows).collect())) == [("1", "a", "int"), ("2", "a", "string"), ("3", "a", "void")]


def write(path, text):
    with open(path, "w") as f:
        f.write(text)


def test_races_that_disagree_keep_their_fields(spark, workdir):
    write(os.path.join(workdir, "TelemetryData_1.csv"), "pilot_index,frameIdentifier,grip,fuel\n0,1,007,1\n0,2,12,2\n")
    write(os.path.join(workdir, "TelemetryData_2.csv"), "fuel,frameIdentifier,pilot_index,grip\n2.5,1,0,low\n,2,0,\n")
    df = src.telemetry(spark, workdir, infer=True)
    types = dict(df.dtypes)
    assert types["grip"] == "string" and types["fuel"] == "double"
    got = sorted((r.raceId, r.frameIdentifier, r.grip, r.fuel) for r in df.collect())
    assert got == [("1", 1, "007", 1.0), ("1", 2, "12", 2.0), ("2", 1, "low", 2.5), ("2", 2, None, None)]
    write(os.path.join(workdir, "ParticipantData_1.csv"), "pilot_index,age\n0,33\n")
    write(os.path.join(workdir, "ParticipantData_2.csv"), "pilot_index,age\n0,34\n")
    assert dict(src.participants(spark, workdir, infer=True).dtypes)["age"] == "int"
    assert dict(src.participants(spark, workdir).dtypes)["age"] == "string"


def test_union_widened(spark):
    a = spark.createDataFrame([(1, 1, "x", True)], "k int, v int, `t.u` string, only boolean")
    b = spark.createDataFrame([(2.5, 2, 1 << 40)], "v double, `t.u` int, k bigint")
    out = union_widened([a, b, a.limit(0)])
    assert out.dtypes == [("k", "bigint"), ("v", "double"), ("t.u", "string"), ("only", "boolean")]
    assert sorted(map(tuple, out.collect())) == [(1, 1.0, "x", True), (1 << 40, 2.5, "2", None)]
    with pytest.raises(ValueError):
        union_widened([])
