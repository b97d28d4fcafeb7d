"""Types of text columns, learned from all their fields by one aggregate.

``observed`` is one pass over the text with a ``bit_or`` per column: every task sends one
number a column (and group), whatever it read.  Files of all headers are stacked as text before, so the
types hold for every race, and a column that is a number in one race and text in another keeps
the text as it stands.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StringType

from pitlane.functions.types import field_bits, type_of_bits


def _quoted(c: str):
    return F.col("`" + c.replace("`", "``") + "`")


def _text_columns(raw: DataFrame, skip: Iterable[str]) -> list[str]:
    skip = set(skip)
    return [f.name for f in raw.schema.fields if isinstance(f.dataType, StringType) and f.name not in skip]


def observed(raw: DataFrame, cols: Iterable[str], by: Iterable[str] = ()) -> DataFrame:
    """Lattice bits of each column of ``cols`` (named ``b0``, ``b1``, ...): one row, or one per ``by`` group."""
    return raw.groupBy(*map(_quoted, by)).agg(*[F.bit_or(field_bits(_quoted(c))).alias(f"b{i}") for i, c in enumerate(cols)])


def infer_types(raw: DataFrame, declared: Mapping[str, DataType] | None = None, skip: Iterable[str] = ("raceId",)) -> dict[str, DataType]:
    """Types of all text columns of ``raw``; declared ones stay as declared and are not looked at.

    Reads the text once, and not at all when every column is declared; one row reaches the driver.
    """
    declared = dict(declared or {})
    cols = _text_columns(raw, [*declared, *skip])
    if not cols:
        return declared
    bits = observed(raw, cols).first()
    return {**declared, **{c: type_of_bits(bits[f"b{i}"]) for i, c in enumerate(cols)}}


def type_report(raw: DataFrame, by: Iterable[str] = ("raceId",), cols: Iterable[str] | None = None) -> DataFrame:
    """Long form: one row per group and text column with the type that the group's own fields have.

    Shows which races make a column what it is; a group without any field has the type ``void``.
    """
    by = list(by)
    cols = list(cols) if cols is not None else _text_columns(raw, by)
    names = F.create_map(*[F.lit(x) for b in range(1 << 8) for x in (b, type_of_bits(b).simpleString() if b else "void")])
    pairs = [F.struct(F.lit(c).alias("column"), names[F.col(f"b{i}").cast("int")].alias("type")) for i, c in enumerate(cols)]
    return observed(raw, cols, by).select(*map(_quoted, by), F.inline(F.array(*pairs)))
