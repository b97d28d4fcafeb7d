"""pitlane: Spark-native preparation of racing-car telemetry.

Raw per-race telemetry files in, analysis-ready tables out: status flags,
encoded compounds, unpacked per-wheel readings, gap filling along each car's
time series, 200-frame training chunks, and Parquet / CSV / JDBC sinks.
Everything is DataFrame code on built-in Spark expressions.
"""

from pitlane.functions.roles import DEFAULT_ROLES, Roles
from pitlane.operators.clean import clean, with_race_id
from pitlane.operators.impute import chunk, impute, manifest, prepare, with_chunks
from pitlane.operators.profile import (
    distinct_values,
    duplicate_keys,
    null_counts,
    null_rows,
    null_shares,
    preview,
    profile,
    row_count,
    value_counts,
)
from pitlane.operators.series import (
    DEFAULT_SERIES,
    Series,
    backward_fill,
    forward_fill,
    lag_lead,
    neighbour_mean,
    ordered,
    row_number,
    series_pass,
)
from pitlane.operators.union import empty_like, union_all

__all__ = [
    "DEFAULT_ROLES",
    "DEFAULT_SERIES",
    "Roles",
    "Series",
    "backward_fill",
    "chunk",
    "clean",
    "distinct_values",
    "duplicate_keys",
    "empty_like",
    "forward_fill",
    "impute",
    "lag_lead",
    "manifest",
    "neighbour_mean",
    "null_counts",
    "null_rows",
    "null_shares",
    "ordered",
    "prepare",
    "preview",
    "profile",
    "row_count",
    "row_number",
    "series_pass",
    "union_all",
    "value_counts",
    "with_chunks",
    "with_race_id",
]
