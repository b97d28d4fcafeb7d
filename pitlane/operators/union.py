"""Stacking frames by column name.

Frames from different files can list their columns in different orders, miss
some, or disagree on a type; stacking is always by name, never by position.
"""

from __future__ import annotations

from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from pitlane.functions.types import join_types


def union_all(frames: Iterable[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union all by name; with ``allow_missing`` absent columns become null."""
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def union_widened(frames: Iterable[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Union all by name, each column in the smallest type that holds it in every frame.

    A column that is a number in one frame and text in another becomes text (a plain union
    would fail on it at run time, or turn it into numbers); int beside double becomes double,
    date beside timestamp becomes timestamp.  Columns stand in the order in which they first occur.
    """
    frames = list(frames)
    if not frames:
        raise ValueError("nothing to union")
    types: dict[str, list] = {}
    for df in frames:
        for f in df.schema.fields:
            types.setdefault(f.name, []).append(f.dataType)
    widest = {c: join_types(t) for c, t in types.items()}

    def widened(df: DataFrame) -> DataFrame:
        kept = [(F.col("`" + f.name.replace("`", "``") + "`"), f) for f in df.schema.fields]
        return df.select(*[(c if f.dataType == widest[f.name] else c.cast(widest[f.name])).alias(f.name) for c, f in kept])

    return union_all(map(widened, frames), allow_missing)


def empty_like(spark: SparkSession, schema: StructType) -> DataFrame:
    """An empty frame with a given schema (a typed seed for a union)."""
    return spark.createDataFrame([], schema)
