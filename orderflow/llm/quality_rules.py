"""Quality rules: a table of thresholds compiled into one projection of built-in functions.

Defined results: a null text counts as the empty text; an empty table gives no rows; repeated rows are
judged each for itself; columns other than id and text are not read, so their names cannot clash.
"""

from pyspark.sql import functions as F

from orderflow.llm.common import blank_words, filled

# The symbols counted, and words that running text of each language holds.
SYMBOLS = "#*$%&|<>"
STOP_WORDS = (
    "the be to of and that have with in is it for on was as "
    "der die das und ist von zu mit den nicht ein "
    "le la les des et est que une dans pour du "
    "el los las en es por con una para se no del"
).split()
WINDOW = 8

# name, measure, least, most (None: open). A measure is a column of `measured`.
RULES = (
    ("few_words", "n_words", 20, None),
    ("repeats", "repeat_ratio", None, 0.3),
    ("word_length", "mean_word_chars", 1.5, 15.0),
    ("symbols", "symbol_ratio", None, 0.2),
    ("stop_words", "stop_ratio", 0.02, None),
    ("same_lines", "dup_line_ratio", None, 0.5),
    ("cut_lines", "cut_line_ratio", None, 0.5),
    ("bullets", "bullet_ratio", None, 0.9),
)
BASE = ("few_words", "repeats")


def _ratio(part, whole):
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def _covered(starts):
    """Positions covered by windows that start at the ascending positions `starts`."""
    steps = F.transform(
        starts, lambda at, k: F.least(F.lit(WINDOW), F.coalesce(F.get(starts, k + 1), at + WINDOW) - at)
    )
    return F.aggregate(steps, F.lit(0).cast("bigint"), lambda total, x: total + x)


def _paired(step):
    return F.transform("h", lambda h, i: F.xxhash64(h, F.get("h", i + step)))


def measured(docs, id="doc_id", text="text"):
    """The measures of every text. Windows are compared by a 64-bit hash of their words."""
    rows = docs.select(F.col(id).alias("doc_id"), filled(text).alias("text"))
    rows = rows.select(
        "doc_id",
        blank_words(F.col("text")).alias("words"),
        F.split("text", "\n").alias("lines"),
        (F.length("text") - F.length(F.translate("text", SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        F.length(F.translate("text", " \t\n\x0b\x0c\r", "")).cast("bigint").alias("word_chars"),
    )
    # the hash of 8 words from those of 4, of 2 and of single words; hashes that reach past the end are cut off
    rows = rows.withColumn("h", F.transform("words", lambda w: F.xxhash64(w)))
    for step in (1, 2, 4):
        rows = rows.withColumn("h", _paired(step))
    rows = rows.select(
        "doc_id", "n_symbols", "word_chars",
        F.size("words").cast("bigint").alias("n_words"),
        F.slice("h", F.lit(1), F.greatest(F.size("words") - (WINDOW - 1), F.lit(0))).alias("windows"),
        F.size(F.filter("words", lambda w: w.isin(STOP_WORDS))).alias("n_stop"),
        F.filter("lines", lambda x: F.length(F.translate(x, " \t\n\x0b\x0c\r", "")) > 0).alias("lines"),
    )
    rows = rows.select(
        "doc_id", "n_symbols", "word_chars", "n_words", "n_stop",
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.size(F.filter("lines", lambda x: F.rtrim(x).endswith("...") | F.rtrim(x).endswith("…"))).alias("n_cut"),
        F.size(F.filter("lines", lambda x: F.substring(F.ltrim(x), 1, 1).isin("-", "*", "•"))).alias("n_bullets"),
        # most texts repeat no window: only the others are sorted
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), F.sort_array(F.transform(
            "windows", lambda h, i: F.struct(h.alias("h"), i.cast("bigint").alias("i"))
        ))).alias("sorted"),
    )
    twin = lambda x, k: F.get("sorted", k)["h"].eqNullSafe(x["h"])
    repeated = F.filter("sorted", lambda x, k: twin(x, k - 1) | twin(x, k + 1))
    rows = rows.withColumn("starts", F.sort_array(F.transform(repeated, lambda x: x["i"])))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines",
        F.coalesce(_covered(F.col("starts")), F.lit(0)).cast("bigint").alias("n_repeat_words"),
        "n_stop", "n_lines", "n_cut", "n_bullets",
    )


def judged(docs, id="doc_id", text="text", rules=RULES, base=BASE):
    """Per text: the counts, `base_failed` (a rule of `base` fails) and `kept` (no rule fails)."""
    n, lines = F.col("n_words"), F.col("n_lines")
    columns = {
        "n_words": n,
        "repeat_ratio": _ratio(F.col("n_repeat_words"), n),
        "mean_word_chars": _ratio(F.col("word_chars"), n),
        "symbol_ratio": _ratio(F.col("n_symbols"), n),
        # the share of stop words among all words; texts under 100 words may do without
        "stop_ratio": F.when(n >= 100, F.col("n_stop") / n).otherwise(F.lit(1.0)),
        "dup_line_ratio": _ratio(F.col("n_dup_lines"), lines),
        "cut_line_ratio": _ratio(F.col("n_cut"), lines),
        "bullet_ratio": _ratio(F.col("n_bullets"), lines),
    }

    def fails(least, most, value):
        low = F.lit(False) if least is None else value < least
        return low if most is None else low | (value > most)

    found = {name: fails(least, most, columns[measure]) for name, measure, least, most in rules}
    any_of = lambda names: F.array_contains(F.array(*[found[x] for x in names]), True)
    failed = any_of([x for x in found if x in base])
    return measured(docs, id, text).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~any_of(list(found))).alias("kept"),
    )
