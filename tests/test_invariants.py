"""Invariants of the operators on view T."""

from pyspark.sql import functions as F

from conftest import SF_SMALL
from pitlane.operators.clean import clean
from pitlane.operators.impute import chunk, impute, prepare
from pitlane.operators.series import backward_fill, forward_fill, neighbour_mean
from pitlane.operators.union import union_all
from pitlane.plans.telemetry_view import T_SERIES, load_t

KEYS = ["raceId", "pilot_index", "frameIdentifier"]


def by_key(df, col):
    return {(r[0], r[1], r[2]): r[3] for r in df.select(*KEYS, col).collect()}


def test_fills_keep_non_null_values(spark):
    c = clean(load_t(spark, SF_SMALL))
    raw = by_key(c, "FL_surfaceType")
    raw_speed = by_key(c, "speed")
    for op, col, src in (
        (forward_fill, "FL_surfaceType", raw),
        (backward_fill, "FL_surfaceType", raw),
        (neighbour_mean, "speed", raw_speed),
    ):
        out = by_key(op(c.select(*KEYS, col), col, series=T_SERIES), col)
        for k, v in src.items():
            if v is not None:
                assert out[k] == v


def test_forward_fill_idempotent(spark):
    c = clean(load_t(spark, SF_SMALL)).select(*KEYS, "actualTyreCompound")
    once = forward_fill(c, "actualTyreCompound", series=T_SERIES)
    twice = forward_fill(once, "actualTyreCompound", series=T_SERIES)
    assert by_key(once, "actualTyreCompound") == by_key(twice, "actualTyreCompound")


def test_forward_fill_only_leading_nulls_remain(spark):
    c = clean(load_t(spark, SF_SMALL)).select(*KEYS, "actualTyreCompound")
    out = forward_fill(c, "actualTyreCompound", series=T_SERIES)
    first_known = c.where(F.col("actualTyreCompound").isNotNull()).groupBy("raceId", "pilot_index").agg(
        F.min("frameIdentifier").alias("first")
    )
    late_nulls = out.join(first_known, ["raceId", "pilot_index"]).where(
        F.col("actualTyreCompound").isNull() & (F.col("frameIdentifier") > F.col("first"))
    )
    assert late_nulls.count() == 0


def test_row_counts_preserved(spark):
    t = load_t(spark, SF_SMALL)
    n = t.count()
    c = clean(t)
    assert c.count() == n
    assert impute(c, series=T_SERIES).count() == n
    assert chunk(t, 200, T_SERIES).count() == n
    assert prepare(t, series=T_SERIES).count() == n


def test_chunks_gap_free_and_sized(spark):
    ch = chunk(load_t(spark, SF_SMALL), 50, T_SERIES)
    per = ch.groupBy("raceId", "pilot_index", "chunk_id").count()
    series = per.groupBy("raceId", "pilot_index").agg(
        F.max("chunk_id").alias("top"), F.count(F.lit(1)).alias("chunks"), F.max("count").alias("biggest")
    )
    assert series.where("top + 1 <> chunks OR biggest > 50").count() == 0
    # every chunk but the last of a series is full
    full = per.join(series, ["raceId", "pilot_index"]).where("chunk_id < top AND count <> 50")
    assert full.count() == 0


def test_union_count_is_sum(spark):
    t = load_t(spark, SF_SMALL)
    parts = [t.where(F.col("raceId") == r) for r in ("click", "view")] + [t.where(~F.col("raceId").isin("click", "view"))]
    assert union_all(parts).count() == sum(p.count() for p in parts) == t.count()


def test_profile_per_race_matches_whole_frame(spark):
    from pitlane.operators.profile import profile

    t = load_t(spark, SF_SMALL)
    whole = {r.column: r.nulls for r in profile(t).collect()}
    per_race = profile(t, by=["raceId"])
    assert per_race.select("raceId").distinct().count() == t.select("raceId").distinct().count()
    summed = {r.column: r.total for r in per_race.groupBy("column").agg(F.sum("nulls").alias("total")).collect()}
    assert summed == {c: n for c, n in whole.items() if c != "raceId"}
