"""A lattice of column types, for text whose types nobody declared and for frames that disagree.

::

    nothing < int < long < wide long        nothing < date < timestamp        nothing < boolean
                \\      /
                 double                      everything else, and two of these families together: text

A field's place in the lattice is a bit, a column's the bits of its fields put together:
``bit_or`` is the join, so it is computed with partial sums in any order.  The column's type is the
smallest one that holds all of it without loss: integers beyond 2^53 beside fractions, and
integers of more than 64 bits, stay text.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import (
    BooleanType,
    ByteType,
    DataType,
    DateType,
    DecimalType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    NullType,
    ShortType,
    StringType,
    TimestampType,
)

INT, LONG, WIDE, DOUBLE, DATE, TIMESTAMP, BOOLEAN, TEXT = (1 << k for k in range(8))
_FAMILIES = (INT | LONG | WIDE | DOUBLE, DATE | TIMESTAMP, BOOLEAN)

_INTEGER = r"^[+-]?[0-9]+$"
_FRACTION = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"
_DAY = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_MOMENT = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?(Z|[+-][0-9]{2}:[0-9]{2})?$"


def field_bits(c: Column) -> Column:
    """The bit of a text field; an empty or null one has none."""
    text = F.trim(c)
    whole, number = text.try_cast("bigint"), text.try_cast("double")
    integer = (
        F.when(whole.isNull(), TEXT)
        .when(whole.between(-(1 << 31), (1 << 31) - 1), INT)
        .when(whole.between(-(1 << 53), 1 << 53), LONG)
        .otherwise(WIDE)
    )
    return (
        F.when(c.isNull() | (text == ""), 0)
        .when(text.rlike(_INTEGER), integer)
        .when(text.rlike(_FRACTION) & (F.abs(number) < float("inf")), DOUBLE)
        .when(F.lower(text).isin("nan", "inf", "-inf", "infinity", "-infinity"), DOUBLE)
        .when(text.rlike(_DAY) & text.try_cast("date").isNotNull(), DATE)
        .when(text.rlike(_MOMENT) & text.try_cast("timestamp").isNotNull(), TIMESTAMP)
        .when(F.lower(text).isin("true", "false"), BOOLEAN)
        .otherwise(TEXT)
    )


def type_of_bits(bits: int | None) -> DataType:
    """The smallest type that holds fields with all these bits; without any, text."""
    bits = bits or 0
    if bits & TEXT or sum(bool(bits & f) for f in _FAMILIES) != 1:
        return StringType()
    if bits & DOUBLE:
        return StringType() if bits & WIDE else DoubleType()
    if bits & (LONG | WIDE):
        return LongType()
    if bits & INT:
        return IntegerType()
    if bits & _FAMILIES[1]:
        return TimestampType() if bits & TIMESTAMP else DateType()
    return BooleanType()


def _bits_of_type(t: DataType) -> int:
    if isinstance(t, NullType):
        return 0
    for kinds, bit in (
        ((ByteType, ShortType, IntegerType), INT),
        ((LongType,), LONG),
        ((FloatType, DoubleType, DecimalType), DOUBLE),
        ((DateType,), DATE),
        ((TimestampType,), TIMESTAMP),
        ((BooleanType,), BOOLEAN),
    ):
        if isinstance(t, kinds):
            return bit
    return TEXT


def join_types(types: Iterable[DataType]) -> DataType:
    """The smallest type that holds columns of all these types.

    Equal types stay what they are; a long beside a double becomes double (its values are not
    known here), whatever has no common number, time or truth value becomes text.
    """
    known = [t for t in dict.fromkeys(types) if not isinstance(t, NullType)]
    if len(known) == 1:
        return known[0]
    bits = 0
    for t in known:
        bits |= _bits_of_type(t)
    return type_of_bits(bits)
