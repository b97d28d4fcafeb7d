"""Profiles of a frame: null counts, shares, value counts, distinct values.

Each is one aggregate; Spark combines partial results map-side, so a value
holding a large share of the rows costs one counter per task, not a hot
shuffle partition.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _named(c: str) -> Column:
    """Column by its whole name, dots included."""
    return F.col("`" + c.replace("`", "``") + "`")


def _null_count(c: str) -> Column:
    # sum over 0/1, as the original profile does: null (not 0) on an empty frame
    return F.sum(F.when(_named(c).isNull(), 1).otherwise(0))


def _grouped(df: DataFrame, by: Iterable[str]):
    return df.groupBy(*map(_named, by))


def null_counts(df: DataFrame, cols: Iterable[str] | None = None, by: Iterable[str] = ()) -> DataFrame:
    """Number of nulls per column, named like the column: one row, or one per ``by`` group
    (e.g. ``by=["raceId"]`` for the per-race profile)."""
    by = list(by)
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in by]
    return _grouped(df, by).agg(*[_null_count(c).alias(c) for c in cols])


def null_shares(df: DataFrame, cols: Iterable[str] | None = None, by: Iterable[str] = ()) -> DataFrame:
    """Percentage of null values per column, plus ``rows``: one row, or one per ``by`` group."""
    by = list(by)
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in by]
    total = F.count(F.lit(1))
    return _grouped(df, by).agg(
        total.alias("rows"),
        *[(F.lit(100.0) * _null_count(c) / total).alias(c) for c in cols],
    )


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """``col, count``: rows per value, nulls included as one group."""
    return df.groupBy(_named(col)).count()


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    return df.select(_named(col)).distinct()


def row_count(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def null_rows(df: DataFrame, col: str) -> DataFrame:
    """Rows where ``col`` is null."""
    return df.where(_named(col).isNull())


def duplicate_keys(df: DataFrame, keys: Iterable[str]) -> DataFrame:
    """Key values that occur more than once, with their count.

    A series needs a unique frame per car and race for a defined order.
    """
    return df.groupBy(*map(_named, keys)).count().where(F.col("count") > 1)


def profile(df: DataFrame, cols: Iterable[str] | None = None, by: Iterable[str] = ()) -> DataFrame:
    """Long form: one row per column (and ``by`` group) with its null count and share."""
    by = list(by)
    cols = list(cols) if cols is not None else [c for c in df.columns if c not in by]
    total = F.count(F.lit(1)).alias("rows")
    counts = _grouped(df, by).agg(total, *[_null_count(c).alias(f"n{i}") for i, c in enumerate(cols)])
    pairs = [
        F.struct(
            F.lit(c).alias("column"),
            F.col(f"n{i}").cast("bigint").alias("nulls"),
            (F.lit(100.0) * F.col(f"n{i}") / F.col("rows")).alias("null_pct"),
        )
        for i, c in enumerate(cols)
    ]
    return counts.select(*map(_named, by), F.inline(F.array(*pairs)))


def preview(df: DataFrame, order: Iterable[str], n: int = 5) -> DataFrame:
    """First ``n`` rows in an explicit order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)
