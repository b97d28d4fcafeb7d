"""Cleaning: flags, encoding, unpacking with tolerant casts."""

from pyspark.sql import functions as F

from pitlane.functions import columns as C
from pitlane.functions.roles import DEFAULT_ROLES
from pitlane.operators.clean import clean


def test_unpack_double_cases(spark):
    df = spark.createDataFrame([("1/2/3/4",), ("1/2",), ("a/b/c/d",), (None,), ("",)], "p string")
    got = [r[0] for r in df.select(C.packed_double("p", 3)).collect()]
    assert got == [4.0, None, None, None, None]


def test_unpack_int_cases(spark):
    df = spark.createDataFrame([("0.0",), ("1.9",), ("1e99",), ("x",)], "p string")
    got = [r[0] for r in df.select(C.packed_int("p", 0)).collect()]
    assert got == [0, 1, None, None]


def test_tolerant_under_ansi(spark):
    # the same results whatever the ANSI setting
    prev = spark.conf.get("spark.sql.ansi.enabled")
    try:
        for ansi in ("true", "false"):
            spark.conf.set("spark.sql.ansi.enabled", ansi)
            df = spark.createDataFrame([("1/x",)], "p string")
            r = df.select(C.packed_double("p", 1).alias("a"), C.packed_int("p", 3).alias("b")).first()
            assert (r.a, r.b) == (None, None)
    finally:
        spark.conf.set("spark.sql.ansi.enabled", prev)


def test_flags_and_compound(spark):
    rows = [("pitting", "active", "soft"), ("inPitArea", None, "hard"), (None, "x", "inter"), (None, None, "Soft")]
    df = spark.createDataFrame(rows, "pitStatus string, resultStatus string, actualTyreCompound string")
    out = clean(df).collect()
    assert [(r.inPitArea, r.pitting, r.active, r.actualTyreCompound) for r in out] == [
        (True, True, True, 0),
        (True, False, False, 2),
        (False, False, True, None),
        (False, False, False, None),
    ]
    assert "pitStatus" not in clean(df).columns


def test_full_roles_schema(spark):
    cols = (
        ["pilot_index", "frameIdentifier", "pitStatus", "resultStatus", "actualTyreCompound", "extra"]
        + list(DEFAULT_ROLES.packed_double)
        + list(DEFAULT_ROLES.packed_int)
    )
    df = spark.createDataFrame([tuple("1/2/3/4" if c in DEFAULT_ROLES.packed_double + DEFAULT_ROLES.packed_int else None for c in cols)], ",".join(f"`{c}` string" for c in cols))
    out = clean(df, DEFAULT_ROLES)
    types = dict(out.dtypes)
    assert len([c for c in out.columns if c[:3] in ("FL_", "FR_", "RL_", "RR_")]) == 28
    assert types["FL_surfaceType"] == "int" and types["RR_brakesTemperature"] == "double"
    assert "extra" in out.columns
    for dropped in DEFAULT_ROLES.consumed:
        assert dropped not in out.columns
    assert out.select(F.col("RR_tyresWear")).first()[0] == 4.0


def test_roles_restricted_to_present_columns():
    r = DEFAULT_ROLES.present_in(["speed", "tyresWear", "pitStatus"])
    assert r.packed_double == ("tyresWear",) and r.packed_int == ()
    assert r.mean_fill == ("speed", "FL_tyresWear", "FR_tyresWear", "RL_tyresWear", "RR_tyresWear")
    assert r.status_columns == ("pitStatus",)
    assert len(DEFAULT_ROLES.forward_fill) == 10 and len(DEFAULT_ROLES.mean_fill) == 37
