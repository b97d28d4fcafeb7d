"""View T: telemetry-shaped rows derived from the ``events`` table.

The shared test tables hold no telemetry, so T derives one from ``events``
by fixed rules on ``m = event_id``: a race per event type, a car per
``user_id % 4``, and nulls, unknown compounds and packed wheel strings at
fixed residues of ``m``.  ``T_SQL`` is the same view for DuckDB, used by the
oracle queries.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.operators.series import Series

# --- fixed values: rules of view T -----------------------------------------
T_COMPOUNDS = ((0, "inter"), (3, "soft"), (6, "medium"), (9, "hard"))  # m % 12
T_PIT = ((0, "pitting"), (1, "inPitArea"))  # m % 10
T_SPEED_NULL = 7
T_RESULT_NULL = 50
T_WEAR_NULL = 13
T_SURFACE_NULL = 5
T_PILOTS = 4
# ---------------------------------------------------------------------------

T_COLUMNS = (
    "raceId",
    "pilot_index",
    "frameIdentifier",
    "speed",
    "actualTyreCompound",
    "pitStatus",
    "resultStatus",
    "tyresWear",
    "surfaceType",
)

# Frame numbers of T are event ids shared by 20 series, about 1 row per 20
# frames; 4096 frames give blocks of ~200 rows, several per series at sf0.01,
# and a fan-out of 2 gives the second block level edges of its own.
T_SERIES = Series(block_frames=4096, levels=2, fan_out=2)


def _case(m, pairs, modulus):
    expr = None
    r = m % modulus
    for residue, value in pairs:
        expr = F.when(r == residue, F.lit(value)) if expr is None else expr.when(r == residue, F.lit(value))
    return expr


def telemetry_view(events: DataFrame) -> DataFrame:
    m = F.col("event_id")
    value = F.col("value")
    packed_wear = F.concat_ws(
        "/",
        value.cast("string"),
        (value + 1).cast("string"),
        F.col("user_id").cast("string"),
        (m % 100).cast("string"),
    )
    packed_surface = F.concat_ws("/", *[(m % k).cast("string") for k in (3, 4, 5, 6)])
    return events.select(
        F.col("event_type").alias("raceId"),
        (F.col("user_id") % T_PILOTS).cast("int").alias("pilot_index"),
        m.alias("frameIdentifier"),
        F.when(m % T_SPEED_NULL != 0, value).alias("speed"),
        _case(m, T_COMPOUNDS, 12).alias("actualTyreCompound"),
        _case(m, T_PIT, 10).alias("pitStatus"),
        F.when(m % T_RESULT_NULL != 0, F.lit("active")).alias("resultStatus"),
        F.when(m % T_WEAR_NULL != 0, packed_wear).alias("tyresWear"),
        F.when(m % T_SURFACE_NULL != 0, packed_surface).alias("surfaceType"),
    )


# View K: T with keys that are missing and frames that occur twice in a series.
# --- fixed values: rules of view K ------------------------------------------
K_PILOT_NULL = 97
K_FRAME_NULL = 89
K_COARSE = 3  # of these rows the frame is rounded down to a multiple of
K_STEP = 256
# ---------------------------------------------------------------------------


def load_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = F.col("frameIdentifier")
    frame = F.when(m % K_FRAME_NULL != 0, F.when(m % K_COARSE == 0, m - m % K_STEP).otherwise(m))
    pilot = F.when(m % K_PILOT_NULL != 0, F.col("pilot_index"))
    return load_t(spark, sf_dir).withColumns({"pilot_index": pilot, "frameIdentifier": frame})


# The columns of ``events`` that view T reads, declared: Parquet reads them by
# name and the driver skips inferring a schema from the file footers.
EVENTS_COLUMNS = "event_id bigint, user_id bigint, event_type string, value double"


def load_t(spark: SparkSession, sf_dir: str) -> DataFrame:
    return telemetry_view(spark.read.schema(EVENTS_COLUMNS).parquet(f"{sf_dir}/events.parquet"))


def _sql_case(pairs, modulus):
    whens = " ".join(f"WHEN {r} THEN '{v}'" for r, v in pairs)
    return f"CASE event_id % {modulus} {whens} END"


T_SQL = f"""
SELECT
  event_type AS raceId,
  CAST(user_id % {T_PILOTS} AS INTEGER) AS pilot_index,
  event_id AS frameIdentifier,
  CASE WHEN event_id % {T_SPEED_NULL} <> 0 THEN value END AS speed,
  {_sql_case(T_COMPOUNDS, 12)} AS actualTyreCompound,
  {_sql_case(T_PIT, 10)} AS pitStatus,
  CASE WHEN event_id % {T_RESULT_NULL} <> 0 THEN 'active' END AS resultStatus,
  CASE WHEN event_id % {T_WEAR_NULL} <> 0 THEN concat_ws('/', CAST(value AS VARCHAR), CAST(value + 1 AS VARCHAR),
       CAST(user_id AS VARCHAR), CAST(event_id % 100 AS VARCHAR)) END AS tyresWear,
  CASE WHEN event_id % {T_SURFACE_NULL} <> 0 THEN concat_ws('/', CAST(event_id % 3 AS VARCHAR), CAST(event_id % 4 AS VARCHAR),
       CAST(event_id % 5 AS VARCHAR), CAST(event_id % 6 AS VARCHAR)) END AS surfaceType
FROM events
"""

K_SQL = f"""k AS (SELECT * REPLACE (
  CASE WHEN frameIdentifier % {K_PILOT_NULL} <> 0 THEN pilot_index END AS pilot_index,
  CASE WHEN frameIdentifier % {K_FRAME_NULL} = 0 THEN NULL WHEN frameIdentifier % {K_COARSE} = 0
       THEN frameIdentifier - frameIdentifier % {K_STEP} ELSE frameIdentifier END AS frameIdentifier)
  FROM t)"""
