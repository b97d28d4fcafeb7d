"""File and JDBC sinks for prepared telemetry.

Chunks are rows with a ``chunk_id`` column, so a chunk is found by a
partition or row-group filter, never by a file name.  Writers stay
parallel: no sink funnels the data through one task.
"""

from __future__ import annotations

import os
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Directory layout of the chunked training set.  Per-race / per-car folders
# with ``chunk_id`` as a sorted column keep files large; the per-chunk layout
# (one folder per 200 rows) is available for consumers that want it.
CHUNK_LAYOUT = ("raceId", "pilot_index")
CHUNK_LAYOUT_PER_CHUNK = ("raceId", "pilot_index", "chunk_id")
CHUNKS_PER_FILE = 5_000  # a million rows of 200-row chunks: files near 128 MB


def with_chunk_key(
    df: DataFrame, parts: Iterable[str] = ("raceId", "pilot_index", "chunk_id"), name: str = "chunk_key"
) -> DataFrame:
    """``<race>_<pilot>_<chunk>``: one flat key per chunk, as a column.

    A null part stays an empty field (``race__3``), so keys never collide.
    """
    return df.withColumn(name, F.concat_ws("_", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in parts]))


def write_keyed_chunks(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One folder per chunk, named by its flat key ``chunk_key=<race>_<pilot>_<chunk>``.

    The flat export of the training set: a chunk is one file in a folder of its own.
    """
    keyed = with_chunk_key(df)
    write_chunks(keyed, path, fmt=fmt, layout=("chunk_key",), mode=mode)


def write_chunks(
    df: DataFrame,
    path: str,
    fmt: str = "parquet",
    layout: Iterable[str] = CHUNK_LAYOUT,
    order: Iterable[str] = ("chunk_id", "frameIdentifier"),
    mode: str = "overwrite",
    dynamic: bool = False,
    options: Mapping[str, str] | None = None,
    chunks_per_file: int = CHUNKS_PER_FILE,
) -> None:
    """Write chunked telemetry partitioned by ``layout``, every chunk whole in one file.

    Rows are brought together by the layout columns and runs of
    ``chunks_per_file`` chunks (a folder per chunk: one file each), sorted
    inside each task by the layout columns and then ``order``, which is also
    the order the partitioned writer needs, so a reader filtering on
    ``chunk_id`` skips row groups.  ``dynamic`` replaces only the partitions
    present in ``df``.
    """
    layout = list(layout)
    order = [c for c in order if c in df.columns and c not in layout]
    runs = []
    if "chunk_id" in df.columns and not {"chunk_id", "chunk_key"} & set(layout):
        runs = [F.floor(F.col("chunk_id") / chunks_per_file)]
    writer = (
        df.repartition(*layout, *runs)
        .sortWithinPartitions(*layout, *order)
        .write.mode(mode)
        .format(fmt)
        .partitionBy(*layout)
    )
    if fmt == "csv":
        writer = writer.option("header", True)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    for k, v in (options or {}).items():
        writer = writer.option(k, v)
    writer.save(path)


def write_flat(
    df: DataFrame,
    path: str,
    max_records_per_file: int = 0,
    mode: str = "overwrite",
    fmt: str = "parquet",
    by: Iterable[str] = (),
    dynamic: bool = False,
) -> None:
    """A folder of files without ``key=value`` directories, or with those of ``by`` only.

    For tools that cannot read deeper partitioned folders.  Every task writes
    its own files (``max_records_per_file`` bounds their size); nothing is
    funnelled into a single task.  ``by=("raceId",)`` gives one folder per
    race, and ``dynamic`` then replaces only the races present in ``df``.
    """
    by = list(by)
    if dynamic and not by:
        raise ValueError("dynamic overwrite needs partition columns")
    writer = df.write.mode(mode).format(fmt)
    if by:
        writer = writer.partitionBy(*by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records_per_file:
        writer = writer.option("maxRecordsPerFile", max_records_per_file)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.save(path)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "overwrite",
    properties: Mapping[str, str] | None = None,
    num_partitions: int | None = None,
    batch_size: int = 10000,
    truncate: bool = False,
    user_env: str = "PITLANE_JDBC_USER",
    password_env: str = "PITLANE_JDBC_PASSWORD",
) -> None:
    """All rows to one relational table.

    ``overwrite`` drops and re-creates the table unless ``truncate``.
    Credentials come from ``properties`` or the named environment variables,
    never from code.  ``num_partitions`` caps concurrent connections.
    """
    props = dict(properties or {})
    if "user" not in props and os.environ.get(user_env):
        props["user"] = os.environ[user_env]
    if "password" not in props and os.environ.get(password_env):
        props["password"] = os.environ[password_env]
    writer = (
        df.write.format("jdbc")
        .option("url", url)
        .option("dbtable", table)
        .option("batchsize", batch_size)
        .option("truncate", truncate)
        .mode(mode)
    )
    if num_partitions:
        writer = writer.option("numPartitions", num_partitions)
    for k, v in props.items():
        writer = writer.option(k, v)
    writer.save()
