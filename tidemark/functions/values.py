"""Column functions for decoding and formatting values."""

from __future__ import annotations

from collections.abc import Callable
from decimal import Decimal

from pyspark.sql import Column, DataFrame, functions as F, types as T


def spelled(df: DataFrame, *wanted: str) -> list[str]:
    """How ``df`` spells each wanted column; case does not matter.

    A name that is there as written is taken. All names that are absent, or could mean several columns, are reported
    together.
    """
    found, troubles = [], []
    for name in wanted:
        alike = [c for c in df.columns if c.casefold() == name.casefold()]
        exact = [c for c in alike if c == name]
        if len(exact or alike) == 1:
            found += exact or alike
        else:
            troubles.append(f"{name} is absent" if not alike else f"{name} could be any of {', '.join(alike)}")
    if troubles:
        raise ValueError("; ".join(troubles))
    return found


# Hex digits that conv(), which works on 64 bits, takes at a time, and how many such parts hold any decimal.
_PART, _PARTS = 12, 3

# Up to so many hex digits a number is a long, and so is its negative.
_LONG = 14


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value worked out once a row, however often it is mentioned.

    Spark repeats the expression of a column at each mention below a condition; a lambda's variable is only looked up.
    """
    return F.element_at(F.transform(F.array(value), use), 1)


def decimal_from_base64(text: Column, scale: int) -> Column:
    """Decimal sent as base64 of its big-endian two's complement unscaled value, as text; NULL if not that."""
    def shown(unscaled: Column) -> Column:
        figures = F.lpad(F.abs(unscaled).cast("string"), 40, "0")
        return once(figures, lambda f: F.concat(
            F.when(unscaled < 0, "-").otherwise(""), F.substring(f, 1, 40 - scale), F.lit("."),
            F.substring(f, 41 - scale, max(scale, 1)) if scale else F.lit("0")))

    def decoded(digits: Column) -> Column:
        negative = F.substring(digits, 1, 1) >= "8"
        padded = F.when(negative, F.lpad(digits, _PART * _PARTS, "F")).otherwise(F.lpad(digits, _PART * _PARTS, "0"))
        start = F.when(negative, F.lit(-1)).otherwise(F.lit(0)).cast("decimal(38,0)")
        number = once(padded, lambda p: _unscaled(p, start))
        # conv() to base -10 reads 64 bits as a signed number.
        short = F.conv(F.lpad(digits, 16, F.when(negative, "F").otherwise("0")), 16, -10).cast("bigint")
        return (F.when(F.length(digits).between(2, _LONG), once(short, shown))
                .when(F.length(digits).between(_LONG + 1, _PART * _PARTS), once(number, shown)))

    return once(F.hex(F.try_to_binary(text, F.lit("base64"))), decoded)


def _unscaled(padded: Column, start: Column) -> Column:
    step, unscaled = F.lit(Decimal(16 ** _PART)).cast("decimal(15,0)"), start
    for part in range(_PARTS):
        number = F.conv(F.substring(padded, 1 + part * _PART, _PART), 16, 10).try_cast("decimal(15,0)")
        unscaled = F.try_add(F.try_multiply(unscaled, step).cast("decimal(38,0)"), number).cast("decimal(38,0)")
    return unscaled


#: Text that starts with a letter other than those of infinity and NaN, or ends as padded base64 does, is no number.
_NO_NUMBER = "^[A-HJ-MO-Za-hj-mo-z]|=$"


def _number(text: Column, data_type: T.DataType) -> Column:
    """Text as a number, NULL if it is none. A cast that fails throws an exception inside, so what cannot be one is not cast."""
    if not isinstance(data_type, T.FractionalType):
        return text.try_cast(data_type)
    return F.when(~text.rlike(_NO_NUMBER), text.try_cast(data_type))


def typed_value(text: Column, field: T.StructField) -> Column:
    """JSON text of one field as its declared type; NULL where it does not convert."""
    metadata = field.metadata or {}
    if metadata.get("micros"):
        return F.timestamp_micros(text.try_cast("bigint"))
    if "decimal_scale" in metadata:
        decoded = decimal_from_base64(text, metadata["decimal_scale"]).try_cast(field.dataType)
        return decoded if metadata.get("base64_only") else F.coalesce(_number(text, field.dataType), decoded)
    return text.try_cast(field.dataType)


def as_timestamp(col: Column, data_type: T.DataType) -> Column:
    """Timestamp from a timestamp of either kind or from text; NULL where text does not parse."""
    if isinstance(data_type, T.StringType):
        return F.try_to_timestamp(col)
    return col.cast("timestamp")


def iso_timestamp(col: Column) -> Column:
    """ISO-8601 without zone; the fraction appears, as six digits, only when it is not zero."""
    whole = F.date_format(col, "yyyy-MM-dd'T'HH:mm:ss")
    fraction = F.date_format(col, ".SSSSSS")
    return F.when(fraction == ".000000", whole).otherwise(F.concat(whole, fraction))
