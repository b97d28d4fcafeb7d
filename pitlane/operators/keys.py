"""Key hygiene: rows that belong to no series.

A row without a race, car or frame has no place in a series: pooled, such
rows would be numbered and filled as if they were one car.  They are split off
before any window and go to a reject output; the split is a filter, so they
stay wherever they were read.
"""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.operators.series import DEFAULT_SERIES, Series


def keyless(series: Series = DEFAULT_SERIES) -> Column:
    """True for a row with a null series key or order key."""
    return reduce(or_, (F.col(c).isNull() for c in (*series.keys, series.order)))


def keyed_rows(df: DataFrame, series: Series = DEFAULT_SERIES) -> DataFrame:
    """The rows that belong to a series."""
    return df.where(~keyless(series))


def rejected_rows(df: DataFrame, series: Series = DEFAULT_SERIES) -> DataFrame:
    """The rows that belong to none."""
    return df.where(keyless(series))
