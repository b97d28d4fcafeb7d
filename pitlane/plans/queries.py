"""Driver queries: every operator run over the shared test tables.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame; most have an
ANSI SQL twin for DuckDB in ``ORACLE`` with the same column names.  Queries
over files first write their inputs, derived from the test tables by Spark,
below the session's shared folder.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType

from pitlane.functions import columns as C
from pitlane.functions.roles import COMPOUND_CODES, WHEELS
from pitlane.operators import profile as prof
from pitlane.operators.clean import clean, with_race_id
from pitlane.operators.index import global_index as indexed
from pitlane.operators.impute import chunk, impute, manifest, prepare
from pitlane.operators.keys import keyed_rows, rejected_rows
from pitlane.operators.series import DEFAULT_SERIES, ordered, series_pass
from pitlane.operators.sequences import chunk_sequences, sequence_rows
from pitlane.operators.sketches import merge_sketches, profile_wide as wide_profile, sketch_columns, estimates
from pitlane.operators.union import empty_like, union_all, union_widened
from pitlane.plans import oracle_sql as O
from pitlane.plans import fixtures as X
from pitlane.plans.pipeline import PipelineConf, run
from pitlane.plans.telemetry_view import K_SQL, T_SERIES, load_k, load_t
from pitlane.session import staging_path
from pitlane.sinks.files import (
    CHUNK_LAYOUT,
    CHUNK_LAYOUT_PER_CHUNK,
    with_chunk_key,
    write_chunks,
    write_flat,
    write_keyed_chunks,
)
from pitlane.sinks.manifest import written_manifest as manifest_of_files
from pitlane.sinks.replace import replace_partitions
from pitlane.sources import files
from pitlane.sources.files import chunks
from pitlane.sources.infer import type_report

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}

KEYS = ["raceId", "pilot_index", "frameIdentifier"]
KEYS_SQL = ", ".join(KEYS)


def query(name: str, sql: str | None = None):
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return register


def t_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(load_t(spark, sf_dir))


# --- projections ------------------------------------------------------------


@query(
    "presence_flags",
    O.with_t(f"SELECT {KEYS_SQL}, pitStatus IS NOT NULL AS inPitArea, resultStatus IS NOT NULL AS active FROM t"),
)
def presence_flags(spark, sf_dir):
    t = load_t(spark, sf_dir)
    return t.select(*KEYS, C.presence_flag("pitStatus").alias("inPitArea"), C.presence_flag("resultStatus").alias("active"))


@query("equals_flag", O.with_t(f"SELECT {KEYS_SQL}, coalesce(pitStatus = 'pitting', false) AS pitting FROM t"))
def equals_flag(spark, sf_dir):
    t = load_t(spark, sf_dir)
    return t.select(*KEYS, C.equals_flag("pitStatus", "pitting").alias("pitting"))


@query("ordinal_encode", O.with_t(f"SELECT {KEYS_SQL}, {O.compound_code()} AS actualTyreCompound FROM t"))
def ordinal_encode(spark, sf_dir):
    t = load_t(spark, sf_dir)
    return t.select(*KEYS, C.ordinal_code("actualTyreCompound", COMPOUND_CODES).alias("actualTyreCompound"))


@query(
    "ordinal_encode_lineitem",
    "SELECT l_orderkey, l_linenumber, l_returnflag, "
    "CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 END AS returnflag_code FROM lineitem",
)
def ordinal_encode_lineitem(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet")
    # 'R' has no code and must come out null
    return li.select(
        "l_orderkey", "l_linenumber", "l_returnflag", C.ordinal_code("l_returnflag", {"A": 0, "N": 1}).alias("returnflag_code")
    )


@query("unpack_double", O.with_t(f"SELECT {KEYS_SQL}, {', '.join(O.unpack_cols('tyresWear'))} FROM t"))
def unpack_double(spark, sf_dir):
    t = load_t(spark, sf_dir)
    return t.select(*KEYS, *[v.alias(k) for k, v in C.unpack("tyresWear", WHEELS, "double").items()])


@query("unpack_int", O.with_t(f"SELECT {KEYS_SQL}, {', '.join(O.unpack_cols('surfaceType', 'int'))} FROM t"))
def unpack_int(spark, sf_dir):
    t = load_t(spark, sf_dir)
    return t.select(*KEYS, *[v.alias(k) for k, v in C.unpack("surfaceType", WHEELS, "int").items()])


_LI_PACKED_SQL = (
    "concat_ws('/', CAST(l_quantity AS VARCHAR), CAST(l_extendedprice AS VARCHAR), "
    "CAST(l_discount AS VARCHAR), CAST(l_tax AS VARCHAR))"
)


def _li_packed() -> F.Column:
    return F.concat_ws("/", *[F.col(c).cast("string") for c in ("l_quantity", "l_extendedprice", "l_discount", "l_tax")])


@query(
    "unpack_lineitem",
    "WITH l AS (SELECT l_orderkey, l_linenumber, " + _LI_PACKED_SQL + " AS amounts FROM lineitem)\n"
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(O.unpack_cols("amounts", "double"))
    + ", "
    + ", ".join(f"{O.packed_int('amounts', i)} AS {w}_amounts_int" for i, w in enumerate(WHEELS))
    + " FROM l",
)
def unpack_lineitem(spark, sf_dir):
    li = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_linenumber", _li_packed().alias("amounts"))
    ints = {f"{k}_int": v for k, v in C.unpack("amounts", WHEELS, "int").items()}
    return li.select(
        "l_orderkey",
        "l_linenumber",
        *[v.alias(k) for k, v in C.unpack("amounts", WHEELS, "double").items()],
        *[v.alias(k) for k, v in ints.items()],
    )


@query(
    "unpack_ragged",
    O.with_t(
        f"SELECT {KEYS_SQL}, {', '.join(O.unpack_cols('tyresWear'))}, {', '.join(O.unpack_cols('surfaceType', 'int'))} FROM r",
        "r AS (SELECT raceId, pilot_index, frameIdentifier,"
        " CASE WHEN frameIdentifier % 17 = 0 THEN array_to_string(string_split(tyresWear, '/')[1:2], '/') ELSE tyresWear END AS tyresWear,"
        " CASE WHEN frameIdentifier % 17 = 0 THEN string_split(surfaceType, '/')[1] ELSE surfaceType END AS surfaceType"
        " FROM t)",
    ),
)
def unpack_ragged(spark, sf_dir):
    t = load_t(spark, sf_dir)
    cut = F.col("frameIdentifier") % 17 == 0
    t = t.select(
        *KEYS,
        F.when(cut, F.substring_index("tyresWear", "/", 2)).otherwise(F.col("tyresWear")).alias("tyresWear"),
        F.when(cut, F.substring_index("surfaceType", "/", 1)).otherwise(F.col("surfaceType")).alias("surfaceType"),
    )
    cols = {**C.unpack("tyresWear", WHEELS, "double"), **C.unpack("surfaceType", WHEELS, "int")}
    return t.select(*KEYS, *[v.alias(k) for k, v in cols.items()])


@query("clean_full", O.with_t("SELECT * FROM c", O.CLEAN_CTE))
def clean_full(spark, sf_dir):
    return t_clean(spark, sf_dir)


LONG_RACE_ID = "18274650913827465091"  # 20 digits: beyond a signed 64-bit integer


@query("race_id_const", O.with_t(f"SELECT '{LONG_RACE_ID}' AS raceId, pilot_index, frameIdentifier, speed FROM t"))
def race_id_const(spark, sf_dir):
    t = load_t(spark, sf_dir).drop("raceId")
    return with_race_id(t, LONG_RACE_ID).select("raceId", "pilot_index", "frameIdentifier", "speed")


# --- series windows ---------------------------------------------------------


@query(
    "lag_lead",
    O.with_t(
        f"SELECT {KEYS_SQL}, speed, lag(speed) OVER ({O.SERIES_W}) AS prev_speed, lead(speed) OVER ({O.SERIES_W}) AS next_speed FROM t"
    ),
)
def lag_lead(spark, sf_dir):
    t = load_t(spark, sf_dir).select(*KEYS, "speed")
    return series_pass(t, DEFAULT_SERIES, previous={"prev_speed": "speed"}, following={"next_speed": "speed"})


@query("neighbour_mean", O.with_t(f"SELECT {KEYS_SQL}, {O.nmean('speed')} AS speed FROM t"))
def neighbour_mean(spark, sf_dir):
    t = load_t(spark, sf_dir).select(*KEYS, "speed")
    return series_pass(t, DEFAULT_SERIES, mean=["speed"])


@query(
    "neighbour_mean_int",
    O.with_t(f"SELECT {KEYS_SQL}, CAST({O.nmean('FL_surfaceType')} AS DOUBLE) AS FL_surfaceType FROM c", O.CLEAN_CTE),
)
def neighbour_mean_int(spark, sf_dir):
    c = t_clean(spark, sf_dir).select(*KEYS, "FL_surfaceType")
    return series_pass(c, DEFAULT_SERIES, mean=["FL_surfaceType"])


_FILL_COLS = ["actualTyreCompound", "FL_surfaceType", "RR_surfaceType"]


@query(
    "forward_fill",
    O.with_t(f"SELECT {KEYS_SQL}, {', '.join(f'{O.ffill(c)} AS {c}' for c in _FILL_COLS)} FROM c", O.CLEAN_CTE),
)
def forward_fill(spark, sf_dir):
    c = t_clean(spark, sf_dir).select(*KEYS, *_FILL_COLS)
    return series_pass(c, DEFAULT_SERIES, forward=_FILL_COLS)


@query(
    "backward_fill",
    O.with_t(f"SELECT {KEYS_SQL}, {', '.join(f'{O.bfill(c)} AS {c}' for c in _FILL_COLS)} FROM c", O.CLEAN_CTE),
)
def backward_fill(spark, sf_dir):
    c = t_clean(spark, sf_dir).select(*KEYS, *_FILL_COLS)
    return series_pass(c, DEFAULT_SERIES, backward=_FILL_COLS)


@query("impute_full", O.with_t("SELECT * FROM i", O.CLEAN_CTE + ",\n" + O.IMPUTED_CTE))
def impute_full(spark, sf_dir):
    return impute(t_clean(spark, sf_dir))


@query("impute_small_blocks", O.with_t("SELECT * FROM i", O.CLEAN_CTE + ",\n" + O.IMPUTED_CTE))
def impute_small_blocks(spark, sf_dir):
    """Blocks of about 200 rows and a fan-out of 2, so that every level has edges at this size."""
    return impute(t_clean(spark, sf_dir), series=T_SERIES)


@query("row_number", O.with_t(f"SELECT {KEYS_SQL}, row_number() OVER ({O.SERIES_W}) AS row_num FROM t"))
def row_number(spark, sf_dir):
    t = load_t(spark, sf_dir).select(*KEYS)
    return series_pass(t, DEFAULT_SERIES, number="row_num")


def _chunk_sql(size: int) -> str:
    return O.with_t(
        f"SELECT {KEYS_SQL}, speed, row_number() OVER ({O.SERIES_W}) AS row_num, "
        f"(row_number() OVER ({O.SERIES_W}) - 1) // {size} AS chunk_id FROM t"
    )


@query("chunk_200", _chunk_sql(200))
def chunk_200(spark, sf_dir):
    return chunk(load_t(spark, sf_dir).select(*KEYS, "speed"), 200)


@query("chunk_50", _chunk_sql(50))
def chunk_50(spark, sf_dir):
    return chunk(load_t(spark, sf_dir).select(*KEYS, "speed"), 50)


_MANIFEST_SQL = O.with_t(
    "SELECT raceId, pilot_index, chunk_id, count(*) AS frames, min(frameIdentifier) AS first_frame, "
    "max(frameIdentifier) AS last_frame FROM k GROUP BY raceId, pilot_index, chunk_id",
    f"k AS (SELECT raceId, pilot_index, frameIdentifier, (row_number() OVER ({O.SERIES_W}) - 1) // 200 AS chunk_id FROM t)",
)


@query("chunk_manifest", _MANIFEST_SQL)
def chunk_manifest(spark, sf_dir):
    return manifest(chunk(load_t(spark, sf_dir).select(*KEYS), 200))


@query(
    "chunk_key",
    O.with_t(
        f"SELECT {KEYS_SQL}, concat_ws('_', raceId, CAST(pilot_index AS VARCHAR), CAST(chunk_id AS VARCHAR)) AS chunk_key FROM k",
        f"k AS (SELECT {KEYS_SQL}, (row_number() OVER ({O.SERIES_W}) - 1) // 200 AS chunk_id FROM t)",
    ),
)
def chunk_key(spark, sf_dir):
    chunked = chunk(load_t(spark, sf_dir).select(*KEYS), 200)
    return with_chunk_key(chunked).select(*KEYS, "chunk_key")


@query("prepare_full", O.with_t("SELECT * FROM p", O.CLEAN_CTE + ",\n" + O.PREPARED_CTE))
def prepare_full(spark, sf_dir):
    return prepare(load_t(spark, sf_dir))


# --- aggregates and filters -------------------------------------------------

_T_COLS = ["raceId", "pilot_index", "frameIdentifier", "speed", "actualTyreCompound", "pitStatus", "resultStatus", "tyresWear", "surfaceType"]


def _null_count_sql(c: str, rel: str = "t") -> str:
    return f"CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS {c}"


@query("null_counts", O.with_t(f"SELECT {', '.join(_null_count_sql(c) for c in _T_COLS)} FROM t"))
def null_counts(spark, sf_dir):
    return prof.null_counts(load_t(spark, sf_dir))


@query(
    "null_share",
    O.with_t(
        "SELECT count(*) AS rows, "
        + ", ".join(f"100.0 * sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*) AS {c}" for c in _T_COLS)
        + " FROM t"
    ),
)
def null_share(spark, sf_dir):
    return prof.null_shares(load_t(spark, sf_dir))


@query(
    "null_counts_by_race",
    O.with_t(
        "SELECT raceId, " + ", ".join(_null_count_sql(c) for c in _T_COLS if c != "raceId") + " FROM t GROUP BY raceId"
    ),
)
def null_counts_by_race(spark, sf_dir):
    return prof.null_counts(load_t(spark, sf_dir), by=["raceId"])


@query(
    "null_counts_after",
    O.with_t(
        f"SELECT {', '.join(_null_count_sql(c) for c in O.CLEAN_COLUMNS)} FROM i",
        O.CLEAN_CTE + ",\n" + O.IMPUTED_CTE,
    ),
)
def null_counts_after(spark, sf_dir):
    return prof.null_counts(impute(t_clean(spark, sf_dir)))


@query("group_count", O.with_t("SELECT FL_surfaceType, count(*) AS count FROM c GROUP BY FL_surfaceType", O.CLEAN_CTE))
def group_count(spark, sf_dir):
    return prof.value_counts(t_clean(spark, sf_dir), "FL_surfaceType")


@query("group_count_orders", "SELECT o_orderstatus, count(*) AS count FROM orders GROUP BY o_orderstatus")
def group_count_orders(spark, sf_dir):
    return prof.value_counts(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderstatus")


@query("distinct_values", O.with_t("SELECT DISTINCT actualTyreCompound FROM t"))
def distinct_values(spark, sf_dir):
    return prof.distinct_values(load_t(spark, sf_dir), "actualTyreCompound")


@query("distinct_part_type", "SELECT DISTINCT p_type FROM part")
def distinct_part_type(spark, sf_dir):
    return prof.distinct_values(spark.read.parquet(f"{sf_dir}/part.parquet"), "p_type")


@query("row_count", O.with_t("SELECT count(*) AS rows FROM t"))
def row_count(spark, sf_dir):
    return prof.row_count(load_t(spark, sf_dir))


@query("null_rows", O.with_t("SELECT * FROM t WHERE speed IS NULL"))
def null_rows(spark, sf_dir):
    return prof.null_rows(load_t(spark, sf_dir), "speed")


@query(
    "profile_long",
    O.with_t(
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", CAST(sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS nulls, "
            f"100.0 * sum(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) / count(*) AS null_pct FROM t"
            for c in _T_COLS
        )
    ),
)
def profile_long(spark, sf_dir):
    return prof.profile(load_t(spark, sf_dir))


@query("ordered_preview", O.with_t(f"SELECT * FROM t ORDER BY {KEYS_SQL} LIMIT 100"))
def ordered_preview(spark, sf_dir):
    return prof.preview(load_t(spark, sf_dir), KEYS, 100)


# --- unions -----------------------------------------------------------------


@query("union_races", O.with_t("SELECT * FROM t"))
def union_races(spark, sf_dir):
    t = load_t(spark, sf_dir)
    # the same rows in three frames with three column orders; stacked by name
    a = t.where(F.col("pilot_index") == 0)
    b = t.where(F.col("pilot_index") == 1).select(*reversed(t.columns))
    c = t.where(F.col("pilot_index") >= 2).select(*sorted(t.columns))
    return union_all([a, b, c], allow_missing=False)


@query(
    "union_missing_cols",
    O.with_t(f"SELECT {KEYS_SQL}, CASE WHEN pilot_index < 2 THEN speed END AS speed, pitStatus FROM t"),
)
def union_missing_cols(spark, sf_dir):
    t = load_t(spark, sf_dir).select(*KEYS, "speed", "pitStatus")
    a = t.where(F.col("pilot_index") < 2)
    b = t.where(F.col("pilot_index") >= 2).drop("speed")
    return union_all([a, b])


@query("empty_typed", O.with_t("SELECT * FROM t"))
def empty_typed(spark, sf_dir):
    t = load_t(spark, sf_dir)
    return union_all([empty_like(spark, t.schema), t])


# --- sources and sinks: files written from T below the shared folder ------------

OVERWRITTEN_RACE = "click"
RACE_NO = X.RACE_NUMBER_SQL.format(c="raceId")


def _race_files(spark: SparkSession, sf_dir: str, *kinds: str) -> str:
    t = load_t(spark, sf_dir)
    makers = {files.TELEMETRY: lambda: t, files.PARTICIPANTS: lambda: X.participants_of(t), files.SESSIONS: lambda: X.sessions_of(t)}
    root = staging_path(spark, "race-files")
    for i, kind in enumerate(kinds):
        X.write_kind(makers[kind](), root, kind, mode="overwrite" if i == 0 else "append")
    return root


@query("race_id_from_file", O.with_t(f"SELECT * REPLACE ({RACE_NO} AS raceId) FROM c", O.CLEAN_CTE))
def race_id_from_file(spark, sf_dir):
    root = _race_files(spark, sf_dir, files.TELEMETRY)
    return clean(files.telemetry(spark, root))


@query("race_id_from_file_uniform", O.with_t(f"SELECT * REPLACE ({RACE_NO} AS raceId) FROM c", O.CLEAN_CTE))
def race_id_from_file_uniform(spark, sf_dir):
    """The same files through the one-glob scan (headers checked by Spark)."""
    root = _race_files(spark, sf_dir, files.TELEMETRY)
    return clean(files.telemetry(spark, root, headers="first"))


def _float_int_files(spark: SparkSession, sf_dir: str) -> str:
    root = staging_path(spark, "float-ints")
    X.write_kind(X.with_float_ints(load_t(spark, sf_dir)), root, files.TELEMETRY, mode="overwrite")
    return root


_FLOAT_INT_TYPES = {**files.TELEMETRY_TYPES, "lapDistance": DoubleType()}
_GEAR_BAD = "(frameIdentifier % 11 = 0 OR frameIdentifier % 13 = 0)"


@query(
    "scan_float_ints",
    O.with_t(
        f"SELECT {RACE_NO} AS raceId, pilot_index, frameIdentifier, speed, "
        f"CASE WHEN NOT {_GEAR_BAD} AND frameIdentifier % 17 <> 0 THEN CAST(frameIdentifier % 8 AS INTEGER) END AS gear, "
        "(frameIdentifier % 1000) / 8.0::DOUBLE AS lapDistance FROM t"
    ),
)
def scan_float_ints(spark, sf_dir):
    """Integers written as ``7.0`` keep their value; a further column takes its declared type."""
    return files.telemetry(spark, _float_int_files(spark, sf_dir), _FLOAT_INT_TYPES)


@query(
    "rejected_fields",
    O.with_t(
        f"SELECT {RACE_NO} AS raceId, c AS \"column\", count(*) FILTER (c = 'gear' AND {_GEAR_BAD}) AS rejected "
        "FROM t, (SELECT unnest(['pilot_index', 'frameIdentifier', 'speed', 'gear', 'lapDistance']) AS c) GROUP BY raceId, c"
    ),
)
def rejected_fields(spark, sf_dir):
    """Fields of each column without a value of its type, by race."""
    raw = files.raw_files(spark, _float_int_files(spark, sf_dir), files.TELEMETRY)
    return files.rejected_fields(raw, _FLOAT_INT_TYPES)


_MIXED_A = "raceId IN (" + ", ".join(f"'{r}'" for r in X.MIXED_FIRST) + ")"
_M = "frameIdentifier"


@query(
    "scan_inferred",
    O.with_t(
        f"SELECT {RACE_NO} AS raceId, pilot_index, {_M}, CAST({_M} % 60 AS INTEGER) AS lap, "
        f"CASE WHEN {_MIXED_A} THEN ({_M} % 1000) / 8.0::DOUBLE ELSE CAST({_M} % 1000 AS DOUBLE) END AS dist, "
        f"CASE WHEN {_MIXED_A} THEN CAST({_M} AS VARCHAR) ELSE 'S' || CAST({_M} % 10 AS VARCHAR) END AS sensor, "
        f"CASE WHEN {_MIXED_A} THEN '2024-01-' || lpad(CAST({_M} % 28 + 1 AS VARCHAR), 2, '0') || ' 00:00:00' "
        f"ELSE '2024-02-01 10:' || lpad(CAST({_M} % 59 + 1 AS VARCHAR), 2, '0') || ':00' END AS stamp, "
        f"CASE WHEN {_MIXED_A} THEN {_M} % 2 = 0 END AS flag, "
        f"CASE WHEN {_MIXED_A} THEN '9' || lpad(CAST({_M} AS VARCHAR), 19, '0') END AS serial, "
        f"CASE WHEN NOT {_MIXED_A} AND {_M} % 3 <> 0 THEN {_M} * 10000000 END AS extra FROM t"
    ),
)
def scan_inferred(spark, sf_dir):
    """Races whose files disagree: types that hold all of a column, from its fields; the time is shown as text."""
    out = files.telemetry(spark, X.write_mixed_races(spark, load_t(spark, sf_dir)), infer=True)
    return out.withColumn("stamp", F.date_format("stamp", "yyyy-MM-dd HH:mm:ss"))


@query(
    "inferred_types",
    O.with_t(
        f"SELECT DISTINCT {RACE_NO} AS raceId, c.name AS \"column\", CASE WHEN {_MIXED_A} THEN c.a ELSE c.b END AS \"type\" FROM t, "
        "(SELECT unnest([{'name': 'lap', 'a': 'int', 'b': 'int'}, {'name': 'dist', 'a': 'double', 'b': 'int'}, "
        "{'name': 'sensor', 'a': 'int', 'b': 'string'}, {'name': 'stamp', 'a': 'date', 'b': 'timestamp'}, "
        "{'name': 'flag', 'a': 'boolean', 'b': 'void'}, {'name': 'serial', 'a': 'string', 'b': 'void'}, "
        "{'name': 'extra', 'a': 'void', 'b': 'bigint'}]) AS c)"
    ),
)
def inferred_types(spark, sf_dir):
    """What each race's own fields would make of the columns."""
    raw = files.raw_files(spark, X.write_mixed_races(spark, load_t(spark, sf_dir)), files.TELEMETRY)
    return type_report(raw, cols=["lap", "dist", "sensor", "stamp", "flag", "serial", "extra"])


@query(
    "union_widened",
    O.with_t(
        f"SELECT raceId, pilot_index, {_M}, "
        f"CASE WHEN raceId = 'click' THEN CAST({_M} % 9 AS DOUBLE) ELSE speed END AS speed, "
        "CASE WHEN raceId = 'click' THEN CAST(pilot_index AS VARCHAR) ELSE resultStatus END AS resultStatus, "
        f"CASE WHEN raceId = 'click' THEN {_M} % 2 = 0 END AS even FROM t"
    ),
)
def union_widened_races(spark, sf_dir):
    """One race with integers where the others have fractions and text, and a column of its own."""
    t = load_t(spark, sf_dir).select(*KEYS, "speed", "resultStatus")
    m, one = F.col(_M), F.col("raceId") == "click"
    other = t.where(one).select(
        (m % 2 == 0).alias("even"), F.col("pilot_index").alias("resultStatus"), (m % 9).cast("int").alias("speed"), *KEYS
    )
    return union_widened([t.where(~one), other])


@query(
    "participants",
    O.with_t(f"SELECT DISTINCT {RACE_NO} AS raceId, pilot_index, 'pilot ' || CAST(pilot_index AS VARCHAR) AS name FROM t"),
)
def participants(spark, sf_dir):
    return files.participants(spark, _race_files(spark, sf_dir, files.PARTICIPANTS))


_SESSIONS_SQL = O.with_t(
    f"SELECT {RACE_NO} AS raceId, trackId, weather FROM s",
    "s AS (SELECT raceId, CAST(count(*) % 22 AS INTEGER) AS trackId, "
    "CASE WHEN max(speed) > 400 THEN 'wet' ELSE 'dry' END AS weather FROM t GROUP BY raceId)",
)


@query("sessions", _SESSIONS_SQL)
def sessions(spark, sf_dir):
    # no session column has a fixed name; this fixture declares its one number
    return files.sessions(spark, _race_files(spark, sf_dir, files.SESSIONS), {"trackId": IntegerType()})


@query(
    "catalogue",
    O.with_t(
        f"SELECT DISTINCT {RACE_NO} AS raceId, true AS has_Telemetry, true AS has_ParticipantData, "
        "true AS has_SessionData, CAST(3 AS BIGINT) AS entries FROM t"
    ),
)
def catalogue(spark, sf_dir):
    return files.catalogue(spark, _race_files(spark, sf_dir, files.TELEMETRY, files.PARTICIPANTS, files.SESSIONS))


# --- the whole pipeline: race files -> run() -> one output read back -------------


def _pipeline(spark: SparkSession, sf_dir: str, output: str) -> str:
    root = _race_files(spark, sf_dir, files.TELEMETRY, files.PARTICIPANTS, files.SESSIONS)
    out = staging_path(spark, "run")
    paths = {f"{k}_path": f"{out}/{k}" for k in ("chunks", "table", "participants", "sessions")}
    return run(spark, PipelineConf(source=root, session_types={"trackId": IntegerType()}, **paths))[output]


def _numbered(sql_tail: str) -> str:
    return O.with_t(sql_tail.format(race=f"{RACE_NO} AS raceId"), O.CLEAN_CTE + ",\n" + O.PREPARED_CTE)


@query("pipeline_full_chunks", _numbered("SELECT * REPLACE ({race}) FROM p"))
def pipeline_full_chunks(spark, sf_dir):
    return spark.read.option("recursiveFileLookup", False).parquet(_pipeline(spark, sf_dir, "chunks")).withColumns(
        {"raceId": F.col("raceId").cast("string"), "pilot_index": F.col("pilot_index").cast("int")}
    )


@query("pipeline_full_table", _numbered("SELECT * EXCLUDE (row_num, chunk_id) REPLACE ({race}) FROM p"))
def pipeline_full_table(spark, sf_dir):
    return spark.read.parquet(_pipeline(spark, sf_dir, "table"))


@query("pipeline_full_participants", ORACLE["participants"])
def pipeline_full_participants(spark, sf_dir):
    return spark.read.parquet(_pipeline(spark, sf_dir, "participants"))


@query("pipeline_full_sessions", _SESSIONS_SQL)
def pipeline_full_sessions(spark, sf_dir):
    return spark.read.parquet(_pipeline(spark, sf_dir, "sessions"))


@query(
    "overwrite_race_table",
    _numbered("SELECT * EXCLUDE (row_num, chunk_id) REPLACE ({race}) FROM p WHERE raceId <> 'click' OR pilot_index < 2"),
)
def overwrite_race_table(spark, sf_dir):
    """A run over all races, then one over a single race with fewer cars: only that race changes."""
    table = staging_path(spark, "table")
    t = load_t(spark, sf_dir)
    for rows in (t, t.where((F.col("raceId") == OVERWRITTEN_RACE) & (F.col("pilot_index") < 2))):
        root = staging_path(spark, "race-files")
        X.write_kind(rows, root, files.TELEMETRY, mode="overwrite")
        run(spark, PipelineConf(source=root, table_path=table, dynamic_overwrite=True))
    return spark.read.parquet(table).withColumn("raceId", F.col("raceId").cast("string"))


def _roundtrip(spark, sf_dir, fmt, layout, chunk_size=200):
    prepared = prepare(load_t(spark, sf_dir), chunk_size=chunk_size)
    path = staging_path(spark, f"chunks-{fmt}")
    write_chunks(prepared, path, fmt=fmt, layout=layout)
    return chunks(spark, path, prepared.schema, fmt)


_PREPARED_SQL = O.with_t("SELECT * FROM p", O.CLEAN_CTE + ",\n" + O.PREPARED_CTE)


@query("parquet_chunks_roundtrip", _PREPARED_SQL)
def parquet_chunks_roundtrip(spark, sf_dir):
    return _roundtrip(spark, sf_dir, "parquet", CHUNK_LAYOUT)


@query("csv_chunks_roundtrip", _PREPARED_SQL)
def csv_chunks_roundtrip(spark, sf_dir):
    # the per-chunk folder layout: raceId=/pilot_index=/chunk_id=
    return _roundtrip(spark, sf_dir, "csv", CHUNK_LAYOUT_PER_CHUNK)


@query("flat_extract_roundtrip", _PREPARED_SQL)
def flat_extract_roundtrip(spark, sf_dir):
    prepared = prepare(load_t(spark, sf_dir))
    path = staging_path(spark, "flat")
    write_flat(prepared, path, max_records_per_file=2000)
    return spark.read.schema(prepared.schema).parquet(path)


@query(
    "overwrite_race",
    O.with_t(
        f"SELECT * REPLACE (CASE WHEN raceId = '{OVERWRITTEN_RACE}' THEN (row_num - 1) // 50 ELSE chunk_id END AS chunk_id) FROM p",
        O.CLEAN_CTE + ",\n" + O.PREPARED_CTE,
    ),
)
def overwrite_race(spark, sf_dir):
    """All races written, then one race re-chunked and replaced alone."""
    t = load_t(spark, sf_dir)
    path = staging_path(spark, "overwrite")
    full = prepare(t)
    write_chunks(full, path)
    one = prepare(t.where(F.col("raceId") == OVERWRITTEN_RACE), chunk_size=50)
    write_chunks(one, path, dynamic=True)
    return chunks(spark, path, full.schema)


@query("global_sort", O.with_t("SELECT * FROM t"))
def global_sort(spark, sf_dir):
    return ordered(load_t(spark, sf_dir))


_NULL_KEY = " OR ".join(f"{k} IS NULL" for k in KEYS)


@query("null_key_rows", O.with_t(f"SELECT * FROM k WHERE {_NULL_KEY}", K_SQL))
def null_key_rows(spark, sf_dir):
    """Rows without a race, car or frame, which no series takes in."""
    return rejected_rows(load_k(spark, sf_dir))


@query(
    "duplicate_frames",
    O.with_t(f"SELECT {KEYS_SQL}, count(*) AS count FROM k WHERE NOT ({_NULL_KEY}) GROUP BY {KEYS_SQL} HAVING count(*) > 1", K_SQL),
)
def duplicate_frames(spark, sf_dir):
    """Frames that occur twice in one series would make the order undefined."""
    return prof.duplicate_keys(keyed_rows(load_k(spark, sf_dir)), KEYS)


@query(
    "keyed_chunks_roundtrip",
    O.with_t(
        "SELECT *, concat_ws('_', raceId, CAST(pilot_index AS VARCHAR), CAST(chunk_id AS VARCHAR)) AS chunk_key FROM p",
        O.CLEAN_CTE + ",\n" + O.PREPARED_CTE,
    ),
)
def keyed_chunks_roundtrip(spark, sf_dir):
    """Flat per-chunk export: one folder per ``<race>_<pilot>_<chunk>``, all columns read back."""
    prepared = prepare(load_t(spark, sf_dir))
    path = staging_path(spark, "keyed")
    write_keyed_chunks(prepared, path)
    return spark.read.parquet(path).select(*prepared.columns, "chunk_key")


# --- profiles with sketches, sequences, indexes, what was written ----------------

_PROFILED = {"raceId": "string", "pilot_index": "int", "frameIdentifier": "bigint", "speed": "double", "resultStatus": "string"}
_PROFILE_SQL = O.with_t(
    " UNION ALL ".join(
        f"SELECT '{c}' AS \"column\", '{t}' AS \"type\", count(*) AS \"rows\", count(*) - count({c}) AS nulls, "
        f"CAST(min({c}) AS VARCHAR) AS minimum, CAST(max({c}) AS VARCHAR) AS maximum, 100.0::DOUBLE * (count(*) - count({c})) / count(*) AS null_pct FROM t"
        for c, t in _PROFILED.items()
    )
)
_PROFILE = ["column", "type", "rows", "nulls", "minimum", "maximum", "null_pct"]


@query("profile_wide", _PROFILE_SQL)
def profile_wide(spark, sf_dir):
    """The exact part of the wide profile; its sketches are tested against exact figures (tests/test_sketches.py)."""
    return wide_profile(load_t(spark, sf_dir), _PROFILED).select(*_PROFILE)


@query("profile_merged", _PROFILE_SQL)
def profile_merged(spark, sf_dir):
    """The same from every car's profile, added up."""
    t = load_t(spark, sf_dir).withColumns({"car": F.col("pilot_index"), "race": F.col("raceId")})
    return estimates(merge_sketches(sketch_columns(t, _PROFILED, by=["race", "car"]))).select(*_PROFILE)


_SEQUENCE = ["speed", "FL_surfaceType"]


@query(
    "chunk_sequences",
    O.with_t(
        "SELECT c.raceId, c.pilot_index, c.chunk_id, CAST(s.position AS INTEGER) AS position, p.row_num IS NOT NULL AS real, "
        "p.speed, CAST(p.FL_surfaceType AS DOUBLE) AS FL_surfaceType "
        "FROM (SELECT DISTINCT raceId, pilot_index, chunk_id FROM p) c, (SELECT unnest(range(200)) AS position) s "
        "LEFT JOIN p ON p.raceId = c.raceId AND p.pilot_index = c.pilot_index AND p.row_num = c.chunk_id * 200 + s.position + 1",
        O.CLEAN_CTE + ",\n" + O.PREPARED_CTE,
    ),
)
def sequences(spark, sf_dir):
    """Chunks as padded arrays, taken apart again place by place."""
    return sequence_rows(chunk_sequences(prepare(load_t(spark, sf_dir)), _SEQUENCE), _SEQUENCE)


@query("global_index", O.with_t(f"SELECT {KEYS_SQL}, row_number() OVER (ORDER BY {KEYS_SQL}) AS row_index FROM t"))
def global_index(spark, sf_dir):
    """Every row's place in the global order."""
    return indexed(load_t(spark, sf_dir).select(*KEYS), *KEYS)


@query(
    "written_manifest",
    O.with_t(
        "SELECT raceId, pilot_index, chunk_id, count(*) AS frames, min(frameIdentifier) AS first_frame, max(frameIdentifier) AS last_frame, "
        "CAST(1 AS BIGINT) AS files, true AS in_one_piece FROM p GROUP BY raceId, pilot_index, chunk_id",
        O.CLEAN_CTE + ",\n" + O.PREPARED_CTE,
    ),
)
def written_manifest(spark, sf_dir):
    """Every chunk as it lies in the files: whole in one of them, its rows side by side."""
    prepared = prepare(load_t(spark, sf_dir))
    path = staging_path(spark, "manifest")
    write_chunks(prepared, path)
    each = manifest_of_files(chunks(spark, path, prepared.schema))
    return each.groupBy("raceId", "pilot_index", "chunk_id").agg(
        F.sum("frames").alias("frames"),
        F.min("first_frame").alias("first_frame"),
        F.max("last_frame").alias("last_frame"),
        F.count(F.lit(1)).alias("files"),
        F.bool_and(F.col("last_row") - F.col("first_row") + 1 == F.col("frames")).alias("in_one_piece"),
    )


@query(
    "catalogue_files",
    O.with_t(
        f"SELECT DISTINCT {RACE_NO} AS raceId, k.kind, CAST(3 AS INTEGER) AS entries, true AS has_bytes, true AS has_time FROM t, "
        f"(SELECT unnest(['{files.TELEMETRY}', '{files.PARTICIPANTS}', '{files.SESSIONS}']) AS kind) k"
    ),
)
def catalogue_files(spark, sf_dir):
    """Each race's files by kind, with sizes and times."""
    root = _race_files(spark, sf_dir, files.TELEMETRY, files.PARTICIPANTS, files.SESSIONS)
    races = files.catalogue_files(files.data_files(spark, root))
    each = races.select("raceId", F.size("entries").alias("entries"), F.explode("files").alias("kind", "files"))
    return each.select(
        "raceId",
        "kind",
        "entries",
        F.forall("files", lambda f: f["bytes"] > 0).alias("has_bytes"),
        F.forall("files", lambda f: f["modified"].isNotNull()).alias("has_time"),
    )


@query(
    "catalogue_changes",
    O.with_t(
        f"SELECT DISTINCT {RACE_NO} AS raceId, '{files.TELEMETRY}' AS kind, "
        "CASE raceId WHEN 'click' THEN 'gone' WHEN 'view' THEN 'changed' ELSE 'new' END AS status "
        "FROM t WHERE raceId IN ('click', 'view', 'purchase')"
    ),
)
def catalogue_changes(spark, sf_dir):
    """Two snapshots of a folder: between them a race went, one shrank and one came."""
    t = load_t(spark, sf_dir).select(*KEYS, "speed")
    race = F.col("raceId")
    snapshots = []
    for rows in (t.where(race != "purchase"), t.where((race != "click") & ((race != "view") | (F.col("pilot_index") < 2)))):
        # entries keep their files' sizes and times only while they stand, so each snapshot has a folder of its own
        root = staging_path(spark, "snapshot")
        X.write_kind(rows.repartition(1, "raceId").sortWithinPartitions(*KEYS), root, files.TELEMETRY, mode="overwrite")
        snapshots.append(files.data_files(spark, root).withColumn("modified", F.lit(None).cast("timestamp")))
    return files.catalogue_changes(*snapshots).select("raceId", "kind", "status")


@query(
    "replace_race_chunks",
    O.with_t(
        f"SELECT * REPLACE (CASE WHEN raceId = '{OVERWRITTEN_RACE}' THEN (row_num - 1) // 50 ELSE chunk_id END AS chunk_id) FROM p",
        O.CLEAN_CTE + ",\n" + O.PREPARED_CTE,
    ),
)
def replace_race_chunks(spark, sf_dir):
    """All races written, then one replaced by write, commit, switch and remove."""
    t = load_t(spark, sf_dir)
    path = staging_path(spark, "replace")
    full = prepare(t)
    write_chunks(full, path)
    one = prepare(t.where(F.col("raceId") == OVERWRITTEN_RACE), chunk_size=50)
    replace_partitions(spark, path, lambda new: write_chunks(one, new))
    return chunks(spark, path, full.schema)
