"""The whole preparation on the full telemetry schema (all 47 filled columns)."""

from pitlane.functions.roles import COMPOUND, COMPOUND_CODES, DEFAULT_ROLES, FORWARD_SCALARS, MEAN_SCALARS, ORDER_KEY, SERIES_KEYS
from pitlane.operators.impute import prepare
from pitlane.operators.series import Series
from pitlane.sources.files import TELEMETRY_TYPES


def raw_frame(spark, n=12):
    cols = (
        [*SERIES_KEYS, ORDER_KEY, *DEFAULT_ROLES.status_columns, *FORWARD_SCALARS]
        + list(MEAN_SCALARS)
        + list(DEFAULT_ROLES.packed_double)
        + list(DEFAULT_ROLES.packed_int)
    )
    rows = []
    for i in range(n):
        gap = i % 3 == 1  # every third row has nulls everywhere it can
        row = {
            "raceId": "18274650913827465091",
            "pilot_index": i % 2,
            "frameIdentifier": i,
            "pitStatus": None if gap else "pitting",
            "resultStatus": None if gap else "active",
            "actualTyreCompound": None if gap else [*(name for name, _ in COMPOUND_CODES), "inter"][i % 4],
        }
        for c in FORWARD_SCALARS:
            if c == COMPOUND:
                continue
            row[c] = None if gap else i
        for c in MEAN_SCALARS:
            row[c] = None if gap else float(i)
        for c in DEFAULT_ROLES.packed_double:
            row[c] = None if gap else f"{i}.5/{i}/{i}/{i}"
        for c in DEFAULT_ROLES.packed_int:
            row[c] = None if gap else f"{i}/1/2/3"
        rows.append(tuple(row[c] for c in cols))
    types = {"raceId": "string", **{c: t.simpleString() for c, t in TELEMETRY_TYPES.items()}}
    schema = ", ".join(f"`{c}` {types.get(c, 'string')}" for c in cols)
    return spark.createDataFrame(rows, schema)


def test_prepare_full_schema(spark):
    out = prepare(raw_frame(spark), series=Series(block_frames=2, fan_out=2))
    types = dict(out.dtypes)
    for c in DEFAULT_ROLES.mean_fill:
        assert types[c] == "double", c
    for c in DEFAULT_ROLES.forward_fill:
        assert types[c] == "int", c
    assert types["row_num"] == "bigint" and types["chunk_id"] == "bigint"
    for gone in DEFAULT_ROLES.consumed:
        assert gone not in out.columns
    assert len(DEFAULT_ROLES.mean_fill) == 37 and len(DEFAULT_ROLES.forward_fill) == 10
    rows = {(r.pilot_index, r.frameIdentifier): r for r in out.collect()}
    # pilot 0 has frames 0, 2, 4, ...; frame 4 (i=4, i%3==1) is a gap between 2 and 6
    r = rows[(0, 4)]
    assert r.speed == 4.0 and r.FL_tyresWear == 4.5  # mean of 2.0 / 6.0 and 2.5 / 6.5
    assert r.gear == 2 and r.FL_surfaceType == 2  # carried forward from frame 2
    assert r.actualTyreCompound == 2  # 'hard' at frame 2
    assert r.inPitArea is False and r.pitting is False and r.active is False
    assert r.row_num == 3
