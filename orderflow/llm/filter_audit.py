"""How filters of documents act together: what each order of five filters keeps, removes and removes needlessly.

Each document fails some of the filters: a mask of five bits. Documents are counted by cell (part, mask, labels), at
most 128 cells a part. Each cell folds its mask across the array of all orders: `aggregate` walks the five steps of an
order, `transform` goes over the orders, and every step gives a struct weighted by the count of the cell. The 600
structs of the cells of a part are then summed element by element, which costs the same whatever the documents are.

Filters: A under 100 words; B 100 * different words < 80 * words; C 100 * capitals A-Z > 10 * characters; D any of
`#$%&*|`; E the same text as a document with a smaller id, whatever else became of either.

Equal texts are told by their SHA-256 digest, and the least id of each digest comes from a combining aggregate. A
document is the first of its text where (digest, id) is in that list, so a text that fills a third of the table is
spread over tasks by id.

Defined results: a null text is the empty text (no words: fails A only, and E after another empty one); a null part
counts as the empty string; a row without id is in no order with others and neither fails E nor makes others fail, and has no
labels; rows of one id and one text do not make each other fail; of several label rows of an id any that is 1 counts;
other columns are not read; no rows give no rows.
"""

from itertools import permutations

from pyspark.sql import functions as F

from orderflow.llm.common import UPPER, blank_words, filled, written

# The filters and their limits.
FILTERS = "ABCDE"
LEAST_WORDS = 100
LEAST_DIFFERENT = 80
MOST_CAPITALS = 10
SIGNS = "[#$%&*|]"

ORDERS = [" ".join(order) for order in permutations(FILTERS)]
SUMS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(docs, id="doc_id", text="text", part="lang"):
    """Per row: id, part, digest of the text, and a mask of the filters A to D that it fails."""
    rows = docs.select(F.col(id).alias("id"), F.coalesce(F.col(part), F.lit("")).alias("part"), filled(text).alias("text"))
    rows = rows.select("*", blank_words(F.col("text")).alias("words"))
    words, chars = F.size("words"), F.length("text")
    capitals = chars - F.length(F.translate("text", UPPER, ""))
    failed = (
        words < LEAST_WORDS,
        100 * F.size(F.array_distinct("words")) < LEAST_DIFFERENT * words,
        100 * capitals > MOST_CAPITALS * chars,
        F.col("text").rlike(SIGNS),
    )
    mask = sum((F.when(fails, 1 << k).otherwise(0) for k, fails in enumerate(failed)), F.lit(0))
    return rows.select("id", "part", F.unhex(F.sha2("text", 256)).alias("digest"), mask.alias("mask"))


def cells(docs, labels, id="doc_id", text="text", part="lang"):
    """Documents per part, mask of all filters, and label: `n` of each."""
    rows = written(failures(docs, id, text, part), "failures")
    firsts = rows.groupBy("digest").agg(F.min("id").alias("id")).where("id IS NOT NULL")
    firsts = firsts.withColumn("is_first", F.lit(True))
    known = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
    )
    copy = F.col("id").isNotNull() & F.col("is_first").isNull()
    judged = rows.join(firsts, ["digest", "id"], "left").join(known, "id", "left").select(
        "part", (F.col("mask") + F.when(copy, 16).otherwise(0)).alias("mask"),
        *[F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")],
    )
    return judged.groupBy("part", "mask", "good", "toxic").agg(F.count(F.lit(1)).alias("n"))


def _step(state, letter):
    """One filter of an order, on a cell: the state is whether the cell is still there, and the steps so far."""
    bit = F.instr(F.lit(FILTERS), letter) - 1
    fails = F.call_function("getbit", F.col("mask"), bit) == 1
    alone = F.col("mask") == F.call_function("shiftleft", F.lit(1), bit)
    there = state["there"]

    def count(when):
        return F.when(when, F.col("n")).otherwise(F.lit(0).cast("bigint"))

    sums = F.struct(
        count(there & ~fails).alias("kept"), count(there & fails).alias("removed"),
        count(~there & fails).alias("redundant"), count(alone).alias("unique_fails"),
        count(there & fails & F.col("good")).alias("good_lost"), count(there & fails & F.col("toxic")).alias("toxic_lost"),
    )
    return F.struct((there & ~fails).alias("there"), F.concat(state["steps"], F.array(sums)).alias("steps"))


def folded(counted, orders=None):
    """Per cell the structs of all orders and steps, in the order of `orders`."""
    orders = ORDERS if orders is None else orders
    none = F.array().cast(f"array<struct<{','.join(f'{s}:bigint' for s in SUMS)}>>")
    start = F.struct(F.lit(True).alias("there"), none.alias("steps"))

    def walk(order):
        return F.aggregate(F.split(order, " "), start, _step, lambda state: state["steps"])

    array = F.split(F.lit(",".join(orders)), ",")
    return counted.select("part", F.flatten(F.transform(array, walk)).alias("folds"))


def audit(docs, labels, id="doc_id", text="text", part="lang", orders=None):
    """One row per part, order and step, with the counts of `SUMS` and the filter's removals over all orders."""
    orders = ORDERS if orders is None else orders
    rows = folded(cells(docs, labels, id, text, part), orders)
    added = rows.select("part", F.posexplode("folds").alias("place", "fold")).groupBy("part", "place").agg(
        *[F.sum(f"fold.{s}").alias(s) for s in SUMS]
    )
    # one group is the steps of one part, 600 structs
    merged = added.groupBy("part").agg(F.array_sort(F.collect_list(F.struct("place", *SUMS))).alias("steps"))
    letters = F.split(F.lit(" ".join(orders)), " ")
    removals = F.transform(F.split(F.lit(" ".join(FILTERS)), " "), lambda letter: F.aggregate(
        "steps", F.lit(0).cast("bigint"),
        lambda total, s: total + F.when(letters[s["place"]] == letter, s["removed"]).otherwise(0),
    ))
    steps = merged.select("part", removals.alias("removals"), F.inline("steps"))
    names = F.split(F.lit(",".join(o.replace(" ", "") for o in orders)), ",")
    size = len(FILTERS)
    return steps.select(
        "part", names[F.floor(F.col("place") / size).cast("int")].alias("filter_order"),
        (F.col("place") % size + 1).alias("step"), *SUMS,
        F.element_at("removals", F.instr(F.lit(FILTERS), letters[F.col("place")])).alias("shapley"),
    )
