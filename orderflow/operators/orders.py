"""Order messages to typed rows, with a reject path for messages a strict parser would fail on."""

from pyspark.sql import functions as F

from orderflow.schemas import ORDER_KEYS, ORDER_NUMBERS, WIDE_ORDER_KEYS, WIDE_ORDER_NUMBERS


def _parse(lines, keys, numbers, value, keep=()):
    # A generator keeps later filters above the JSON parse, so each message is parsed once.
    texts = lines.select(value, *keep, F.json_tuple(value, *keys).alias(*keys.values()))
    bad = [
        F.when(F.col(f).try_cast(kind).isNull(), F.lit(f))
        for f, kind in numbers.items()
    ]
    return texts.withColumn("badFields", F.array_compact(F.array(*bad)))


def _good(parsed, keys, numbers, keep=()):
    good = parsed
    for field, kind in numbers.items():
        good = good.filter(F.col(field).try_cast(kind).isNotNull())
    return good.select(*[
        F.col(f).try_cast(numbers[f]).alias(f) if f in numbers else F.coalesce(f, F.lit("")).alias(f)
        for f in keys.values()
    ], *keep)


def parse_orders(lines, value="value", fields=None, keep=()):
    """Order records. Missing or null text fields become ''; rows with unusable numbers are left out.

    With `fields`, only these are taken out of the JSON (the numbers are checked all the same).
    `keep` names columns of `lines` to pass on, such as the arrival order.
    """
    keys = {k: f for k, f in ORDER_KEYS.items() if fields is None or f in fields or f in ORDER_NUMBERS}
    records = _good(_parse(lines, keys, ORDER_NUMBERS, value, keep), keys, ORDER_NUMBERS, keep)
    return records if fields is None else records.select(*fields, *keep)


def reject_orders(lines, value="value"):
    """The messages `parse_orders` leaves out, with the fields at fault."""
    return (
        _parse(lines, ORDER_KEYS, ORDER_NUMBERS, value)
        .filter(F.size("badFields") > 0)
        .select(F.col(value).alias("value"), "badFields")
    )


def parse_wide_orders(lines, value="value"):
    """Order records that already carry their product attributes."""
    keys = {**ORDER_KEYS, **WIDE_ORDER_KEYS}
    return _good(_parse(lines, keys, WIDE_ORDER_NUMBERS, value), keys, WIDE_ORDER_NUMBERS)


def with_event_time(rows, ct="ct", name="ts", late=None):
    """Adds the event timestamp of an epoch-millisecond column, and a watermark when `late` is given."""
    timed = rows.withColumn(name, F.timestamp_millis(F.col(ct)))
    return timed.withWatermark(name, late) if late else timed


def with_hour(rows, ct="ct", name="hourTime"):
    """Adds the yyyyMMddHH text of an epoch-millisecond column."""
    return rows.withColumn(name, F.date_format(F.timestamp_millis(F.col(ct)), "yyyyMMddHH"))


def members():
    """Travellers of an order; blank or non-numeric parts count as none."""
    parts = [
        F.coalesce(F.col(c).try_cast("bigint"), F.lit(0)) for c in ("adult", "yonger", "baby")
    ]
    return parts[0] + parts[1] + parts[2]
