"""Number formatting."""

from pyspark.sql import functions as F


def formatted(number, pattern="0.0"):
    """A number in a decimal pattern, halves rounded to even, no grouping."""
    return F.call_function("format_number", F.col(number), F.lit(pattern))


def hex_text(column, kind="int"):
    """Upper-case hex of binary (`kind="binary"`) or of a 32-bit integer in two's complement; '' for null."""
    value = F.col(column)
    if kind != "binary":
        value = value.cast("bigint").bitwiseAND(F.lit(0xFFFFFFFF))
    return F.coalesce(F.hex(value), F.lit(""))
