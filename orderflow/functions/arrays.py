"""Array and map expressions."""

from pyspark.sql import functions as F


def is_empty(column):
    """True for null and for arrays and maps without elements."""
    return F.coalesce(F.size(column), F.lit(0)) <= 0


def index_of(array, value):
    """Zero-based position of the first equal element, -1 if there is none."""
    at = F.array_position(array, value) - 1
    return F.coalesce(at, F.lit(-1)).cast("int")


def contains(array, value):
    return F.coalesce(F.array_contains(array, value), F.lit(False))


def same_elements(first, second):
    """Both filled, equally long, and every element of `second` is in `first`."""
    same = (F.size(first) > 0) & (F.size(first) == F.size(second)) & (
        F.size(F.array_except(second, first)) == 0
    )
    return F.coalesce(same, F.lit(False))
