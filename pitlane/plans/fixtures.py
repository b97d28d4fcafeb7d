"""Race files derived from view T, laid out like the raw dataset.

The file-source queries need per-race CSV files named ``<Kind>_<raceId>.csv``.
They are written by Spark from view T into a fresh folder below the shared
folder (``spark.checkpoint.dir``): one output folder per race and kind, so
their work grows with the test tables.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.session import staging_path
from pitlane.sources.files import PARTICIPANTS, SESSIONS, TELEMETRY

# A race id made of digits, like the real ones (up to 20 digits, beyond a
# signed 64-bit integer): the first 16 hex digits of md5(raceId) in decimal.
RACE_NUMBER_SQL = "CAST(('0x' || substr(md5({c}), 1, 16))::UBIGINT AS VARCHAR)"


def race_number(c: str = "raceId") -> Column:
    return F.conv(F.substring(F.md5(F.col(c)), 1, 16), 16, 10)


def participants_of(t: DataFrame) -> DataFrame:
    """One row per car and race."""
    return t.select("raceId", "pilot_index").distinct().withColumn(
        "name", F.concat(F.lit("pilot "), F.col("pilot_index").cast("string"))
    )


def sessions_of(t: DataFrame) -> DataFrame:
    """One row per race."""
    return t.groupBy("raceId").agg(
        (F.count(F.lit(1)) % 22).cast("int").alias("trackId"),
        F.when(F.max("speed") > 400, F.lit("wet")).otherwise(F.lit("dry")).alias("weather"),
    )


def write_kind(df: DataFrame, root: str, kind: str, mode: str = "append") -> None:
    """Write ``df`` as CSV below ``root``, one folder ``file=<kind>_<raceNumber>.csv`` per race."""
    named = df.withColumn("file", F.concat(F.lit(f"{kind}_"), race_number("raceId"), F.lit(".csv"))).drop("raceId")
    named.write.mode(mode).partitionBy("file").option("header", True).csv(root)


def with_float_ints(t: DataFrame) -> DataFrame:
    """T's keys as an export of columns with gaps writes them (``7.0``), a ``gear`` with fields that are no integers,
    and a column nobody declares."""
    m = F.col("frameIdentifier")
    gear = F.when(m % 11 == 0, F.lit("n/a")).when(m % 13 == 0, F.lit("3.5")).when(m % 17 != 0, F.concat((m % 8).cast("string"), F.lit(".0")))
    return t.select(
        "raceId",
        F.concat(F.col("pilot_index").cast("string"), F.lit(".0")).alias("pilot_index"),
        F.concat(m.cast("string"), F.lit(".0")).alias("frameIdentifier"),
        "speed",
        gear.alias("gear"),
        (m % 1000 / 8).alias("lapDistance"),
    )


# --- fixed values: races whose files disagree -------------------------------
MIXED_FIRST = ("click", "view")  # these races' files have one header, the others' another
# ---------------------------------------------------------------------------


def mixed_races(t: DataFrame) -> tuple[DataFrame, DataFrame]:
    """T's keys with columns nobody declares: the races of MIXED_FIRST and the others list and write them differently."""
    m = F.col("frameIdentifier")
    keys = [F.col("raceId"), F.col("pilot_index"), m]
    first = F.col("raceId").isin(*MIXED_FIRST)
    two = lambda k: F.lpad((m % k + 1).cast("string"), 2, "0")
    a = t.where(first).select(
        *keys,
        (m % 60).alias("lap"),
        (m % 1000 / 8).alias("dist"),
        m.alias("sensor"),
        F.concat(F.lit("2024-01-"), two(28)).alias("stamp"),
        (m % 2 == 0).cast("string").alias("flag"),
        F.concat(F.lit("9"), F.lpad(m.cast("string"), 19, "0")).alias("serial"),
    )
    b = t.where(~first).select(
        F.concat(F.lit("S"), (m % 10).cast("string")).alias("sensor"),
        F.when(m % 3 != 0, m * 10_000_000).alias("extra"),
        F.concat(F.lit("2024-02-01 10:"), two(59), F.lit(":00")).alias("stamp"),
        (m % 1000).alias("dist"),
        (m % 60).alias("lap"),
        *keys,
    )
    return a, b


def write_mixed_races(spark: SparkSession, t: DataFrame) -> str:
    root = staging_path(spark, "mixed-races")
    for df, mode in zip(mixed_races(t), ("overwrite", "append")):
        write_kind(df, root, TELEMETRY, mode)
    return root


def write_race_files(spark: SparkSession, t: DataFrame) -> str:
    """Telemetry, participant and session files of every race in T; returns the root."""
    root = staging_path(spark, "race-files")
    write_kind(t, root, TELEMETRY, mode="overwrite")
    write_kind(participants_of(t), root, PARTICIPANTS)
    write_kind(sessions_of(t), root, SESSIONS)
    return root
