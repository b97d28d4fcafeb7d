"""Column expressions of the cleaning step, built-in functions only.

Casts are tolerant whatever ``spark.sql.ansi.enabled`` says: an element
that is missing or does not parse becomes null instead of failing the job.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def presence_flag(c: str | Column) -> Column:
    """True when the value is present, false when it is null (never null)."""
    return _col(c).isNotNull()


def equals_flag(c: str | Column, value) -> Column:
    """True when the value equals ``value``; null compares as false."""
    return F.coalesce(_col(c) == F.lit(value), F.lit(False))


def ordinal_code(c: str | Column, codes: Mapping[str, int] | Iterable[tuple[str, int]]) -> Column:
    """Case-sensitive ordinal encoding; a value outside ``codes`` becomes null."""
    pairs = list(codes.items()) if isinstance(codes, Mapping) else list(codes)
    if not pairs:
        return F.lit(None).cast("int")
    src = _col(c)
    expr = None
    for value, code in pairs:
        cond = src == F.lit(value)
        expr = F.when(cond, F.lit(code)) if expr is None else expr.when(cond, F.lit(code))
    return expr


def packed_element(c: str | Column, index: int, separator: str = "/") -> Column:
    """Element ``index`` (0-based) of a separator-packed string; null when absent."""
    return F.get(F.split(_col(c), re.escape(separator)), index)


def packed_double(c: str | Column, index: int, separator: str = "/") -> Column:
    return packed_element(c, index, separator).try_cast("double")


def packed_int(c: str | Column, index: int, separator: str = "/") -> Column:
    """Integer element: parsed as a double first, so ``'1.9'`` gives 1 and ``'1e99'`` null."""
    return packed_double(c, index, separator).try_cast("int")


def unpack(
    c: str,
    wheels: Iterable[str],
    kind: str = "double",
    separator: str = "/",
) -> dict[str, Column]:
    """``{<wheel>_<c>: element}`` for one packed column, ready for ``withColumns``."""
    fn = packed_double if kind == "double" else packed_int
    return {f"{w}_{c}": fn(c, i, separator) for i, w in enumerate(wheels)}


def race_id_from_name(name: str | Column, pattern: str = r"_(\d+)") -> Column:
    """First ``_<digits>`` group of a name, or null when there is none."""
    return F.nullif(F.regexp_extract(_col(name), pattern, 1), F.lit(""))
