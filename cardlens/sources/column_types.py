"""Types of text columns, found from all their values.

A value is described by the set of types that can hold it, as bits; a column's
types are the intersection over its values (``bit_and``, one aggregate over all
rows, merged map-side), and the column takes the narrowest type left:

    boolean | bigint < double | date < timestamp_ntz | string

``1`` and ``2.5`` meet in double, a date and a time in timestamp_ntz, ``true``
and ``1`` only in string.  A column without values stays text.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Types in order of preference; bit k stands for entry k.
TYPES = ("boolean", "bigint", "double", "date", "timestamp_ntz")
_BIT = {t: 1 << k for k, t in enumerate(TYPES)}

# The spellings that count as each type.
_BOOLEAN = "^(?i:true|false|t|f)$"
_INTEGER = "^[+-]?[0-9]{1,19}$"
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$|^[+-]?(?i:nan|inf|infinity)$"
_DATE = "^[0-9]{4}-[0-9]{2}-[0-9]{2}$"
_TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}[ T][0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,6})?)?$"


def types_of_value(value: Column) -> Column:
    """Bits of the types that can hold the text ``value``; null for null."""

    def fits(pattern: str, kind: str) -> Column:
        return value.rlike(pattern) & value.try_cast(kind).isNotNull()

    return (F.when(value.isNull(), F.lit(None).cast("int"))
            .when(fits(_INTEGER, "bigint"), F.lit(_BIT["bigint"] | _BIT["double"]))
            .when(fits(_NUMBER, "double"), F.lit(_BIT["double"]))
            .when(value.rlike(_BOOLEAN), F.lit(_BIT["boolean"]))
            .when(fits(_DATE, "date"), F.lit(_BIT["date"] | _BIT["timestamp_ntz"]))
            .when(fits(_TIME, "timestamp_ntz"), F.lit(_BIT["timestamp_ntz"]))
            .otherwise(F.lit(0)))


def types_of_column(name: str) -> Column:
    """The bits that all values of the text column ``name`` share (aggregate)."""
    return F.bit_and(types_of_value(F.col(f"`{name}`")))


def narrowest(bits: int | None) -> str:
    return next((t for t in TYPES if bits and bits & _BIT[t]), "string")
