"""Fill-in-middle: documents cut into prefix, middle and suffix at token ends, and put in another order.

A text is a sequence of units (runs of letters A-Z and a-z, any other character by itself). One full match of the
repeated unit keeps the ends of all repetitions, so the number of units and the places of both cuts are read off
the match. Everything else are column expressions: draws from a digest of the id, the form, the marked text.

Forms: `psm` is `<P>`prefix`<S>`suffix`<M>`middle, `spm` is `<S>`suffix`<P>`prefix`<M>`middle, `plain` the text
itself. A text that holds a mark stays plain, so the marks of a changed text are unique and `restored` is exact.

Defined results: a null text is the empty text; an empty text is plain with no units; a row without an id draws by
the digest of the seed alone; rows of one id have the same draws; other columns are not read; no rows give no rows.
One text is matched at a time, whatever its length; its unit ends are held in memory, some 40 bytes a unit.
"""

import pyarrow as pa
import regex
from pyspark.sql import functions as F
from pyspark.sql import types as T

from orderflow.llm.common import filled

# Marks, the repeated unit, and shares in percent.
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
UNITS = regex.compile(r"(?>([A-Za-z]+|[^A-Za-z])*)")
SEED = 1
CHANGED = 90
SUFFIX_FIRST = 20

CUT_SCHEMA = T.StructType([T.StructField(c, T.LongType()) for c in ("n", "first", "second")])


def cuts(text, one, other, units=UNITS):
    """Number of units, and where (in characters) the two drawn numbers of units end, the smaller first."""
    ends = units.fullmatch(text).ends(1)
    first, second = sorted((one % (len(ends) + 1), other % (len(ends) + 1)))
    return len(ends), ends[first - 1] if first else 0, ends[second - 1] if second else 0


@F.arrow_udf(CUT_SCHEMA)
def _cut(texts: pa.Array, ones: pa.Array, others: pa.Array) -> pa.Array:
    found = [cuts(t.as_py(), a.as_py(), b.as_py()) for t, a, b in zip(texts, ones, others)]
    columns = zip(*found) if found else ((), (), ())
    return pa.StructArray.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["n", "first", "second"])


def _draw(digest, k):
    """The k-th group of eight digits of a hex digest as an unsigned number."""
    return F.conv(F.substring(digest, 8 * k + 1, 8), 16, 10).cast("bigint")


def infilled(docs, id="doc_id", text="text", seed=SEED, changed=CHANGED, suffix_first=SUFFIX_FIRST):
    """Per row: doc_id, n (units), form, output (the marked text) and the characters of prefix and middle."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id).cast("string"), F.lit(""))), 256)
    rows = docs.select(F.col(id).alias("doc_id"), filled(text).alias("text"), digest.alias("digest"))
    rows = rows.select(
        "doc_id", "text", *[_draw(F.col("digest"), k).alias(f"h{k + 1}") for k in range(4)],
    ).select("*", _cut("text", "h1", "h2").alias("cut"))
    held = F.col("text")
    marked = F.lit(False)
    for mark in (PREFIX, SUFFIX, MIDDLE):
        marked |= F.contains(held, F.lit(mark))
    plain = (held == "") | marked | (F.col("h3") % 100 >= changed)
    form = F.when(plain, "plain").when(F.col("h4") % 100 < suffix_first, "spm").otherwise("psm")
    rows = rows.select("doc_id", "text", form.alias("form"), "cut.*")
    prefix = F.substring(held, F.lit(1), F.col("first").cast("int"))
    middle = F.substring(held, (F.col("first") + 1).cast("int"), (F.col("second") - F.col("first")).cast("int"))
    suffix = F.substring(held, (F.col("second") + 1).cast("int"), F.length(held))
    output = (
        F.when(F.col("form") == "plain", held)
        .when(F.col("form") == "psm", F.concat(F.lit(PREFIX), prefix, F.lit(SUFFIX), suffix, F.lit(MIDDLE), middle))
        .otherwise(F.concat(F.lit(SUFFIX), suffix, F.lit(PREFIX), prefix, F.lit(MIDDLE), middle))
    )
    changed_only = F.col("form") != "plain"
    return rows.select(
        "doc_id", "n", "form", output.alias("output"),
        F.when(changed_only, F.col("first")).alias("prefix_chars"),
        F.when(changed_only, F.col("second") - F.col("first")).alias("middle_chars"),
    )


def restored(output, form):
    """The exact text of a marked text, from its form alone."""
    def after(mark, upto=None):
        begin = F.locate(mark, output) + len(mark)
        size = F.length(output) if upto is None else F.locate(upto, output) - begin
        return F.substring(output, begin, size)

    psm = F.concat(after(PREFIX, SUFFIX), after(MIDDLE), after(SUFFIX, MIDDLE))
    spm = F.concat(after(PREFIX, MIDDLE), after(MIDDLE), after(SUFFIX, PREFIX))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
