"""DuckDB SQL twins of the driver queries.

Every Spark query over view T has an oracle written the plain way: windows
over whole series, no blocks.  The blocked Spark plans must agree with it.
"""

from __future__ import annotations

from pitlane.functions.roles import COMPOUND_CODES, WHEELS
from pitlane.plans.telemetry_view import T_SQL

SERIES_W = "PARTITION BY raceId, pilot_index ORDER BY frameIdentifier"


def with_t(body: str, extra: str = "") -> str:
    """``WITH t AS (<view T>) [, extra] <body>``."""
    ctes = f"t AS ({T_SQL})"
    if extra:
        ctes += ",\n" + extra
    return f"WITH {ctes}\n{body}"


def packed_double(c: str, i: int) -> str:
    return f"TRY_CAST(string_split({c}, '/')[{i + 1}] AS DOUBLE)"


def packed_int(c: str, i: int) -> str:
    # truncate before the cast: DuckDB rounds a double cast to integer, Spark truncates
    return f"TRY_CAST(trunc({packed_double(c, i)}) AS INTEGER)"


def unpack_cols(c: str, kind: str = "double") -> list[str]:
    fn = packed_double if kind == "double" else packed_int
    return [f"{fn(c, i)} AS {w}_{c}" for i, w in enumerate(WHEELS)]


def compound_code(c: str = "actualTyreCompound") -> str:
    whens = " ".join(f"WHEN '{v}' THEN {k}" for v, k in COMPOUND_CODES)
    return f"CASE {c} {whens} END"


def wheels(c: str) -> list[str]:
    return [f"{w}_{c}" for w in WHEELS]


# Cleaned T: the columns of ``clean(T)``.
CLEAN_SELECT = ",\n  ".join(
    [
        "raceId",
        "pilot_index",
        "frameIdentifier",
        "speed",
        f"{compound_code()} AS actualTyreCompound",
        "pitStatus IS NOT NULL AS inPitArea",
        "coalesce(pitStatus = 'pitting', false) AS pitting",
        "resultStatus IS NOT NULL AS active",
        *unpack_cols("tyresWear", "double"),
        *unpack_cols("surfaceType", "int"),
    ]
)
CLEAN_CTE = f"c AS (SELECT\n  {CLEAN_SELECT}\nFROM t)"
CLEAN_COLUMNS = [
    "raceId",
    "pilot_index",
    "frameIdentifier",
    "speed",
    "actualTyreCompound",
    "inPitArea",
    "pitting",
    "active",
    *wheels("tyresWear"),
    *wheels("surfaceType"),
]
T_FORWARD = [*wheels("surfaceType"), "actualTyreCompound"]
T_MEAN = ["speed", *wheels("tyresWear")]


def ffill(c: str, w: str = SERIES_W) -> str:
    return f"last_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"


def bfill(c: str, w: str = SERIES_W) -> str:
    return f"first_value({c} IGNORE NULLS) OVER ({w} ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"


def nmean(c: str, w: str = SERIES_W) -> str:
    return f"CASE WHEN {c} IS NULL THEN (lag({c}) OVER ({w}) + lead({c}) OVER ({w})) / 2 ELSE {c} END"


def imputed_select(number: bool = False, chunk_size: int | None = None) -> str:
    cols = []
    for c in CLEAN_COLUMNS:
        if c in T_FORWARD:
            cols.append(f"{ffill(c)} AS {c}")
        elif c in T_MEAN:
            cols.append(f"CAST({nmean(c)} AS DOUBLE) AS {c}")
        else:
            cols.append(c)
    if number:
        cols.append(f"row_number() OVER ({SERIES_W}) AS row_num")
    if chunk_size:
        cols.append(f"(row_number() OVER ({SERIES_W}) - 1) // {chunk_size} AS chunk_id")
    return ",\n  ".join(cols)


IMPUTED_CTE = f"i AS (SELECT\n  {imputed_select()}\nFROM c)"
PREPARED_CTE = f"p AS (SELECT\n  {imputed_select(True, 200)}\nFROM c)"
