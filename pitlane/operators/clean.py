"""Cleaning: status flags, compound encoding, per-wheel unpacking.

Row-wise projections only, so Spark fuses them into the scan's
whole-stage-codegen span; no shuffle, no sort.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitlane.functions import columns as C
from pitlane.functions.roles import DEFAULT_ROLES, Roles


def clean_columns(roles: Roles) -> dict[str, Column]:
    """The derived columns of ``clean`` as ``{name: expression}``."""
    out: dict[str, Column] = {}
    for name, src in roles.presence_flags:
        out[name] = C.presence_flag(src)
    for name, src, value in roles.equals_flags:
        out[name] = C.equals_flag(src, value)
    if roles.compound:
        out[roles.compound] = C.ordinal_code(roles.compound, roles.compound_codes)
    for c in roles.packed_double:
        out.update(C.unpack(c, roles.wheels, "double", roles.separator))
    for c in roles.packed_int:
        out.update(C.unpack(c, roles.wheels, "int", roles.separator))
    return out


def clean(df: DataFrame, roles: Roles | None = None) -> DataFrame:
    """Flags from status columns, ordinal compound, packed vectors to columns.

    * ``inPitArea`` / ``active``: the status is present.
    * ``pitting``: the pit status equals ``'pitting'``.
    * tyre compound: soft 0, medium 1, hard 2, anything else null.
    * each ``FL/FR/RL/RR`` string becomes four columns ``<wheel>_<name>``;
      a missing or unparsable element becomes null.

    The status and packed columns are dropped; all other columns pass
    through.  With ``roles=None`` the default roles are restricted to the
    columns the frame has.
    """
    roles = roles or DEFAULT_ROLES.present_in(df.columns)
    return df.withColumns(clean_columns(roles)).drop(*roles.consumed)


def with_race_id(df: DataFrame, race_id: str, name: str = "raceId") -> DataFrame:
    """Stamp every row with a race id, kept as a string (ids exceed 64 bits)."""
    return df.withColumn(name, F.lit(str(race_id)))
