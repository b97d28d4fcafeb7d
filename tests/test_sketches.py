"""Wide profiles: exact columns exactly, sketches within their stated errors, also when merged."""

import random
from bisect import bisect_left, bisect_right
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pitlane.operators import sketches as K

N = 40_000


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(5)
    # a value with a third of all rows, a long tail, and nulls
    return [(f"r{rnd.randrange(3)}", i, rnd.gauss(50, 20) if i % 10 else None, "hot" if i % 3 == 0 else f"v{int(rnd.paretovariate(0.7))}", None) for i in range(N)]


@pytest.fixture(scope="module")
def frame(spark, rows):
    return spark.createDataFrame(rows, "race string, id int, `x.y` double, word string, nothing double").repartition(9)


def check(profile, rows):
    by = {r["column"]: r for r in profile}
    assert {c: (r.type, r["rows"], r.nulls) for c, r in by.items()} == {
        "id": ("int", N, 0), "x.y": ("double", N, N // 10), "word": ("string", N, 0), "nothing": ("double", N, N)
    }
    values = {"id": [r[1] for r in rows], "x.y": [r[2] for r in rows if r[2] is not None], "word": [r[3] for r in rows]}
    for c, v in values.items():
        assert abs(by[c].n_distinct - len(set(v))) < 0.05 * len(set(v))  # three standard errors
    for c in ("id", "x.y"):
        v = sorted(values[c])
        assert float(by[c].minimum) == pytest.approx(v[0]) and float(by[c].maximum) == pytest.approx(v[-1])
        for q, got in by[c].quantiles.items():
            assert bisect_left(v, got) / len(v) - 0.02 <= q <= bisect_right(v, got) / len(v) + 0.02
    exact = Counter(values["word"])
    assert by["word"].frequent[0]["item"] == "hot" and len(by["word"].frequent) == 5
    for f in by["word"].frequent:
        assert abs(f["count"] - exact[f["item"]]) <= 2 * N / K.TRACKED
    nothing = by["nothing"]
    assert nothing.minimum is nothing.maximum is nothing.quantiles is None and nothing.n_distinct == 0 and nothing.frequent == []


def test_profile(frame, rows):
    check(K.profile_wide(frame, ["id", "x.y", "word", "nothing"]).collect(), rows)


def test_merged_profiles_of_groups(frame, rows):
    parts = K.sketch_columns(frame, ["id", "x.y", "word", "nothing"], by=["race"])
    assert parts.count() == 12
    check(K.estimates(K.merge_sketches(parts)).collect(), rows)
    by_race = K.estimates(parts).where("race = 'r1' and column = 'id'").first()
    assert by_race["rows"] == sum(r[0] == "r1" for r in rows)


def test_numbers_compare_as_numbers_when_merged(spark):
    df = spark.createDataFrame([("a", 9), ("b", 10), ("c", -5)], "g string, n int")
    got = K.estimates(K.merge_sketches(K.sketch_columns(df, by=["g"]))).first()
    assert (got.minimum, got.maximum) == ("-5", "10")


def test_one_aggregate_with_partial_sums(frame):
    plan = K.sketch_columns(frame, ["id", "word"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") and plan.count("Exchange") == 2  # the fixture's own and one row a task


def test_other_types_and_empty_frames(spark):
    df = spark.sql("select map('a', 1) as m, array(1, 2) as l, date'2024-01-01' as d, cast(1.5 as decimal(5,2)) as n, true as b")
    got = {r["column"]: r for r in K.profile_wide(df).collect()}
    assert got["d"].minimum == "2024-01-01" and got["n"].quantiles[0.5] == 1.5 and got["m"].minimum is None and got["b"].n_distinct == 1
    empty = K.profile_wide(df.where(F.lit(False))).collect()
    assert {(r["rows"], r.nulls, r.null_pct) for r in empty} == {(0, 0, None)}
