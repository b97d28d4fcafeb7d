"""What a sink has really written, file by file, against what the plan was to write."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitlane.functions.roles import ORDER_KEY, SERIES_KEYS
from pitlane.operators.impute import manifest

KEYS = (*SERIES_KEYS, "chunk_id")


def written_manifest(written: DataFrame, keys: Iterable[str] = KEYS, order: str = ORDER_KEY) -> DataFrame:
    """One row per chunk and file of a Parquet scan: frames, first and last frame, and the rows of the file they lie in.

    ``first_row`` and ``last_row`` count from 0 in the file; a chunk lies in one piece if they
    span as many rows as it has frames.  Only the keys and the order column are read.
    """
    at = written.select(*keys, order, F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("_row"))
    return at.groupBy(*keys, "file").agg(
        F.count(F.lit(1)).alias("frames"),
        F.min(order).alias("first_frame"),
        F.max(order).alias("last_frame"),
        F.min("_row").alias("first_row"),
        F.max("_row").alias("last_row"),
    )


def files_written(written: DataFrame, keys: Iterable[str] = KEYS) -> DataFrame:
    """One row per file of a scan: its size, rows and chunks."""
    at = written.select(*keys, F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_size").alias("bytes"))
    chunks = at.groupBy(*keys, "file").agg(F.count(F.lit(1)).alias("rows"), F.max("bytes").alias("bytes"))
    return chunks.groupBy("file").agg(F.max("bytes").alias("bytes"), F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("chunks"))


def differences(planned: DataFrame, written: DataFrame, keys: Iterable[str] = KEYS, order: str = ORDER_KEY) -> DataFrame:
    """Chunks whose written rows are not the planned ones: frames and their range on both sides, null where a side has none.

    Both sides are one row per chunk before they meet.  Empty when everything was written once.
    """
    keys = list(keys)
    sides = {}
    for name, rows in (("planned", planned), ("written", written)):
        columns = [F.col(c).cast("string").alias(f"_{c}") for c in keys]  # a reader may type partition columns anew
        counted = manifest(rows.select(*columns, order), [f"_{c}" for c in keys], order)
        sides[name] = counted.select(*[f"_{c}" for c in keys], *[F.col(c).alias(f"{name}_{c}") for c in ("frames", "first_frame", "last_frame")]).alias(name)
    same = [F.col(f"planned._{c}").eqNullSafe(F.col(f"written._{c}")) for c in keys]
    on = same[0]
    for s in same[1:]:
        on = on & s
    both = sides["planned"].join(sides["written"], on, "full_outer")
    differ = F.lit(False)
    for c in ("frames", "first_frame", "last_frame"):
        differ = differ | ~F.col(f"planned_{c}").eqNullSafe(F.col(f"written_{c}"))
    names = [F.coalesce(F.col(f"planned._{c}"), F.col(f"written._{c}")).alias(c) for c in keys]
    values = [f"{s}_{c}" for s in sides for c in ("frames", "first_frame", "last_frame")]
    return both.where(differ).select(*names, *values)


def verify(spark: SparkSession, planned: DataFrame, path: str, fmt: str = "parquet", keys: Iterable[str] = KEYS, order: str = ORDER_KEY) -> None:
    """Raise unless ``path`` holds the planned chunks of its races, every row once.

    Races that the plan does not have (other runs' ones) are not looked at.
    """
    keys = list(keys)
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.schema(planned.schema).option("header", True)
    races = planned.select(F.col(keys[0]).cast("string").alias("_race")).distinct()
    written = reader.load(path)
    written = written.join(F.broadcast(races), F.col(keys[0]).cast("string").eqNullSafe(F.col("_race")), "left_semi")  # one row per race
    wrong = differences(planned, written, keys, order).limit(5).collect()
    if wrong:
        raise OSError(f"{path} does not hold the planned chunks: {[r.asDict() for r in wrong]}")
