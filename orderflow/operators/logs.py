"""Behaviour-log messages: decoding, filters, projections and quality rules."""

from pyspark.sql import functions as F

from orderflow.schemas import ACTIONS, CLICK, EVENTS, EXTS_KEYS, LOG_FIELDS, LOG_SPELLINGS, PAGE_VIEW, VIEW_LIST_FACT

# Codes the filters look for.
INTERACTIVE = "05"
LAUNCH = "02"
PAGE_ENTER = ("07", "08")
CLICK_EVENT = "02"
VIEW_LIST_EVENTS = ("01", "04")
INTERACTIVE_EVENTS = ("02", "01", "04")
ALL_EVENTS = ("02", "03", "04", "01")


def decode_logs(lines, value="value"):
    """Log records of JSON text; both spellings of the user and longitude fields are read."""
    names = LOG_FIELDS + list(LOG_SPELLINGS)
    found_as = [f"_{n}" for n in LOG_FIELDS] + [f"_other_{n}" for n in LOG_SPELLINGS]
    texts = lines.select(F.json_tuple(value, *names).alias(*found_as))
    second = {field: f"_other_{spelling}" for spelling, field in LOG_SPELLINGS.items()}
    columns = []
    for name in LOG_FIELDS:
        found = F.col(f"_{name}")
        if name in second:
            found = F.coalesce(found, F.col(second[name]))
        if name == "ct":
            found = found.try_cast("bigint")
        columns.append(found.alias(name))
    return texts.select(*columns)


def log_messages(logs):
    """Log records as JSON text."""
    return logs.select(F.to_json(F.struct(*LOG_FIELDS)).alias("value"))


def clicks_only(logs):
    return logs.filter((F.lower("action") == INTERACTIVE) & (F.lower("eventType") == CLICK_EVENT))


def page_views_only(logs):
    return logs.filter(F.lower("action").isin(*PAGE_ENTER))


def list_views_only(logs):
    return logs.filter(
        (F.lower("action") == INTERACTIVE) & F.lower("eventType").isin(*VIEW_LIST_EVENTS)
    )


def launches_only(logs):
    return logs.filter(F.col("action") == LAUNCH)


def events_in(logs, codes=ALL_EVENTS):
    return logs.filter(F.col("eventType").isin(*codes))


def abnormal_duration(low=5, high=50, column="duration"):
    """True where the stay is shorter than `low` or longer than `high`."""
    stay = F.col(column).try_cast("bigint")
    return F.coalesce((stay < low) | (stay > high), F.lit(False))


def _with_exts(logs, keys):
    """Adds one column per `exts` key, '' where it is missing; `exts` is parsed once."""
    names = [f"ext_{k}" for k in keys]
    parsed = logs.select("*", F.json_tuple("exts", *keys).alias(*names))
    return parsed.withColumns({n: F.coalesce(n, F.lit("")) for n in names})


def _projected(rows, schema, renames):
    return rows.select(*[F.col(renames.get(n, n)).alias(n) for n in schema.fieldNames()])


def click_records(logs):
    """Clicks with their target and target type."""
    rows = _with_exts(clicks_only(logs), ["targetID", "eventTargetType"])
    return _projected(rows, CLICK, {"targetId": "ext_targetID", "eventTargetType": "ext_eventTargetType"})


def page_view_records(logs):
    """Page entries with their target."""
    rows = _with_exts(page_views_only(logs), ["targetID"])
    return _projected(rows, PAGE_VIEW, {"targetId": "ext_targetID"})


def list_view_records(logs):
    """One row per product shown in a product list; no list, no rows."""
    keys = [k for k in EXTS_KEYS if k not in ("targetID", "eventTargetType")]
    rows = _with_exts(list_views_only(logs).filter("exts <> ''"), keys)
    shown = rows.withColumn("shown", F.explode(F.from_json("ext_targetIDS", "array<string>")))
    renames = {k: f"ext_{k}" for k in keys}
    return _projected(shown, VIEW_LIST_FACT, {**renames, "targetId": "shown"})


# Quality rules: record kind -> (column, rule) pairs that must hold.
QUALITY_RULES = {
    "click": [("action", "null"), ("eventType", "null")],
    "page_view": [("action", "null"), ("eventType", "null"), ("ct", "zero")],
    "document": [("id", "null")],
    "order_totals": [("productID", "blank"), ("traffic", "blank"), ("ct", "zero")],
}


def quality_problems(kind):
    """Array of messages, one per broken rule of the record kind; empty when the row is fine."""
    tests = {
        "null": lambda c: F.col(c).isNull(),
        "blank": lambda c: F.trim(F.coalesce(F.col(c), F.lit(""))) == "",
        "zero": lambda c: F.coalesce(F.col(c), F.lit(0)) == 0,
    }
    found = [
        F.when(tests[rule](column), F.lit(f"{column} is {rule}"))
        for column, rule in QUALITY_RULES[kind]
    ]
    return F.array_compact(F.array(*found))


def quality_gate(rows, kind):
    """Rows that pass the rules of `kind`, and the others with a `problems` column."""
    checked = rows.withColumn("problems", quality_problems(kind))
    return (
        checked.filter(F.size("problems") == 0).drop("problems"),
        checked.filter(F.size("problems") > 0),
    )


def code_table(spark, rows):
    """A code table as rows of code, name and text."""
    return spark.createDataFrame(rows, "code string, name string, text string")


def _decoded(column, rows, at):
    pairs = [F.lit(part) for row in rows for part in (row[0], row[at])]
    return F.create_map(*pairs)[F.col(column)]


def decode_codes(logs):
    """Adds name and text of the action and event codes; the tables are small enough to be literals."""
    return logs.withColumns({
        "actionName": _decoded("action", ACTIONS, 1), "actionText": _decoded("action", ACTIONS, 2),
        "eventTypeName": _decoded("eventType", EVENTS, 1), "eventTypeText": _decoded("eventType", EVENTS, 2),
    })
