"""Date and time expressions."""

from pyspark.sql import functions as F

# Text layouts.
DEFAULT = "yyyy-MM-dd HH:mm:ss"
DAY = "yyyyMMdd"
HOUR = "yyyyMMddHH"
SECOND = "yyyyMMddHHmmss"


def epoch_text(ct, pattern=HOUR, positive_only=False):
    """Text of an epoch-millisecond column; with `positive_only` zero and below give null."""
    text = F.date_format(F.timestamp_millis(ct), pattern)
    return F.when(F.col(ct) > 0, text) if positive_only else text


def date_text(ts, pattern=DEFAULT):
    return F.date_format(ts, pattern)


def text_date(text, pattern=DEFAULT):
    """Timestamp of a text, null when it does not fit the pattern."""
    return F.try_to_timestamp(F.col(text) if isinstance(text, str) else text, F.lit(pattern))


def shift(ts, amount, unit):
    """The timestamp moved by `amount` units (YEAR, MONTH, DAY, HOUR, MINUTE, SECOND)."""
    return F.timestamp_add(unit, F.lit(amount), F.col(ts) if isinstance(ts, str) else ts)


def shift_text(text, amount, unit, pattern, out_pattern=None):
    """A date text moved by `amount` units, written in `out_pattern` or the same pattern."""
    return F.date_format(shift(text_date(text, pattern), amount, unit), out_pattern or pattern)


def over_time(first, second, amount, unit):
    """Whether one calendar field of `first` is ahead of that field of `second` by `amount`.

    Fields are compared on their own (31 January is ahead of 1 March by 30 in DAY). YEAR, MONTH
    and DAY accept equality, HOUR and MINUTE do not. Nulls give false.
    """
    field = {"YEAR": F.year, "MONTH": F.month, "DAY": F.dayofmonth, "HOUR": F.hour, "MINUTE": F.minute}[unit]
    ahead = field(first) - field(second)
    reached = ahead > amount if unit in ("HOUR", "MINUTE") else ahead >= amount
    return F.coalesce(reached, F.lit(False))


def compare_times(first, second):
    """-1, 0 or 1; 1 when either is null."""
    a, b = F.col(first), F.col(second)
    return F.when(a < b, -1).when(a == b, 0).otherwise(1)


def age_from_card(card, today=None):
    """Full years since the birth date inside a 15- or 18-digit identity number, at least 0."""
    today = F.current_date() if today is None else today
    text = F.col(card)
    born = F.when(F.length(text) == 18, F.substring(text, 7, 8)).when(
        F.length(text) == 15, F.concat(F.lit("19"), F.substring(text, 7, 6))
    )
    years = F.floor(F.months_between(today, F.to_date(F.try_to_timestamp(born, F.lit(DAY)))) / 12)
    return F.greatest(F.coalesce(years, F.lit(0)), F.lit(0)).cast("int")
