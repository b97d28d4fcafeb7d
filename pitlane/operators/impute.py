"""Imputation and chunking of cleaned telemetry.

Both are series window work, done by ``series_pass`` in one shuffle: the
categorical columns are carried forward, the numeric ones take the mean of
their neighbours, and (for ``prepare``) rows are numbered for chunking in the
same pass.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitlane.functions.roles import CHUNK_SIZE, DEFAULT_ROLES, Roles
from pitlane.operators.clean import clean
from pitlane.operators.series import DEFAULT_SERIES, Series, series_pass


def _fill_lists(df: DataFrame, roles: Roles | None) -> tuple[list[str], list[str]]:
    if roles is None:
        have = set(df.columns)
        return (
            [c for c in DEFAULT_ROLES.forward_fill if c in have],
            [c for c in DEFAULT_ROLES.mean_fill if c in have],
        )
    return list(roles.forward_fill), list(roles.mean_fill)


def impute(df: DataFrame, roles: Roles | None = None, series: Series = DEFAULT_SERIES) -> DataFrame:
    """Forward fill of the categorical columns, neighbour mean of the numeric ones.

    With ``roles=None`` the default column lists are restricted to the
    columns present in ``df``.
    """
    forward, mean = _fill_lists(df, roles)
    return series_pass(df, series, forward=forward, mean=mean)


def with_chunks(df: DataFrame, number: str = "row_num", chunk: str = "chunk_id", size: int = CHUNK_SIZE) -> DataFrame:
    """``chunk_id = (row_num - 1) div size`` from an existing row number."""
    if size <= 0:
        raise ValueError("chunk size must be positive")
    # integer division: exact for any row number, and rows are numbered from 1
    return df.withColumn(chunk, F.expr(f"(`{number}` - 1) div {int(size)}").cast("bigint"))


def chunk(
    df: DataFrame,
    size: int = CHUNK_SIZE,
    series: Series = DEFAULT_SERIES,
    number: str = "row_num",
    chunk_col: str = "chunk_id",
) -> DataFrame:
    """Number each series and cut it into chunks of ``size`` consecutive rows.

    The last chunk of a series may be short.  Keeps both ``row_num`` and
    ``chunk_id`` as columns.
    """
    return with_chunks(series_pass(df, series, number=number), number, chunk_col, size)


def prepare(
    df: DataFrame,
    roles: Roles | None = None,
    series: Series = DEFAULT_SERIES,
    chunk_size: int | None = CHUNK_SIZE,
) -> DataFrame:
    """``clean`` then imputation and (optionally) chunking, in one shuffle."""
    return imputed_chunks(clean(df, roles), roles, series, chunk_size)


def imputed_chunks(
    cleaned: DataFrame,
    roles: Roles | None = None,
    series: Series = DEFAULT_SERIES,
    chunk_size: int | None = CHUNK_SIZE,
    previous: Mapping[str, str] | None = None,
) -> DataFrame:
    """Imputation and (optionally) chunking of cleaned rows, in one shuffle; ``previous`` adds lags."""
    forward, mean = _fill_lists(cleaned, roles)
    number = "row_num" if chunk_size else None
    out = series_pass(cleaned, series, forward=forward, mean=mean, previous=previous or {}, number=number)
    return with_chunks(out, size=chunk_size) if chunk_size else out


def manifest(chunked: DataFrame, keys=("raceId", "pilot_index", "chunk_id"), order: str = "frameIdentifier") -> DataFrame:
    """One row per chunk: its number of frames and its first and last frame."""
    return chunked.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("frames"),
        F.min(order).alias("first_frame"),
        F.max(order).alias("last_frame"),
    )
