"""License scan: phrases, and an exact set-similarity join of text blocks with licence templates.

A block is a line, or the words around a line end: as many before and after it as a template may spread over,
across further line ends and blank lines. So statements wrapped at any width are blocks. A template fits a block that holds at least `threshold` of the template's different
words. The join orders the templates' words by their frequency over all blocks, rarest first, indexes the
prefixes of templates and blocks, and drops pairs by length and by position before the exact count.

Defined results: a null text is the empty text (no words, no labels, score 0); repeated rows get the same
result each; an empty table gives no rows; only id and text are read.
"""

import math

from pyspark.sql import functions as F

from orderflow.llm.common import ascii_lower, filled, text_list

# Phrases whose words must stand consecutively, and their labels.
PHRASES = {"mit license": "mit", "apache license": "apache", "general public license": "gpl"}
# Licence statements in words.
TEMPLATES = (
    ("mit", "released under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "this work is licensed under the gnu general public license version 3"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc-by", "licensed under cc by 4 0"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license"),
    ("reserved", "all rights reserved"),
)
THRESHOLD = 0.8
# Fixed value: runs that separate words, without the line feed.
GAPS = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"


def _words(templates):
    return [(label, sorted(set(text.split()))) for label, text in templates]


def _least(size, threshold):
    """Shared words that a template of `size` words asks for."""
    return max(1, math.ceil(threshold * size - 1e-9))


def _reach(text, threshold):
    """Words over which a statement may spread, other words among them."""
    return math.floor(len(text.split()) / threshold + 1e-9)


def _around(plain, reach):
    """For each line end of a plain text the words before and after it, at most `reach` each."""
    after = F.lit(r"\n(?=((?:[^ \n]++[ \n]?+){1,%d}))" % reach)
    apart = lambda x: F.trim(F.translate(x, "\n", " "))
    lefts = F.reverse(F.transform(F.regexp_extract_all(F.reverse(plain), after, 1), F.reverse))
    rights = F.regexp_extract_all(plain, after, 1)
    return F.zip_with(lefts, rights, lambda a, b: F.struct(apart(a).alias("left"), apart(b).alias("right")))


def _plain(docs, id, text):
    """Texts in lower case, words apart by one space and lines apart by one line feed."""
    plain = F.regexp_replace(ascii_lower(filled(text)), GAPS, " ")
    plain = F.regexp_replace(F.regexp_replace(plain, " ?\n[ \n]*", "\n"), "^[ \n]+|[ \n]+$", "")
    return docs.select(F.col(id).alias("doc_id"), plain.alias("plain"))


def _places(plain, phrases):
    """Counts and first and last places of the phrases in a plain text."""
    apart = F.concat(F.lit(" "), F.replace(F.translate(plain, "\n", " "), F.lit(" "), F.lit("  ")), F.lit(" "))
    before = lambda part: F.regexp_count(part, F.lit("[^ ]+"))
    counts, firsts, lasts = [], [], []
    for phrase in phrases:
        mark = " " + phrase.replace(" ", "  ") + " "
        count = (F.length(apart) - F.length(F.replace(apart, F.lit(mark), F.lit("")))) / len(mark)
        at = F.instr(apart, mark)
        counts.append(count.cast("bigint"))
        firsts.append(F.when(at > 0, before(F.substring(apart, F.lit(1), at - 1))))
        lasts.append(F.when(at > 0, before(apart) - before(F.substring_index(apart, mark, -1)) - len(phrase.split())))
    return counts, firsts, lasts


def scanned(docs, id="doc_id", text="text", phrases=PHRASES):
    """Per row: words, phrase places and labels; rows without the word all phrases share are cheap."""
    rows = _plain(docs, id, text)
    plain = F.col("plain")
    shared = set.intersection(*[set(p.split()) for p in phrases])
    maybe = F.contains(plain, F.lit(min(shared))) if shared else F.lit(True)
    counts, firsts, lasts = _places(plain, phrases)
    words = F.when(plain == "", 0).otherwise(F.length(plain) - F.length(F.translate(plain, " \n", "")) + 1)
    found = [F.when(c > 0, F.lit(label)) for c, label in zip(counts, phrases.values())]
    places = F.struct(
        sum(counts[1:], counts[0]).alias("n"),
        F.array_min(F.array(*firsts)).cast("bigint").alias("first"),
        F.array_max(F.array(*lasts)).cast("bigint").alias("last"),
        F.array_compact(F.array(*found)).alias("labels"),
    )
    rows = rows.select("doc_id", "plain", words.cast("bigint").alias("n_words"), F.when(maybe, places).alias("p"))
    return rows.select(
        "doc_id", F.xxhash64("plain").alias("text_key"), "n_words",
        F.coalesce("p.n", F.lit(0)).cast("bigint").alias("n_base"),
        F.col("p.first").alias("first_word"), F.col("p.last").alias("last_word"),
        F.coalesce("p.labels", text_list([])).alias("base"),
    )


def word_order(blocks, templates=TEMPLATES):
    """Place of each template word in the global order: rarest in the blocks first. One row per
    template word comes to the driver."""
    vocabulary = sorted({w for _, words in _words(templates) for w in words})
    shown = F.explode(F.array_intersect("tokens", text_list(vocabulary))).alias("word")
    counts = {r["word"]: r["n"] for r in blocks.select(shown).groupBy("word").agg(F.count("word").alias("n")).collect()}
    ordered = sorted(vocabulary, key=lambda w: (counts.get(w, 0), w))
    return {w: k for k, w in enumerate(ordered)}


def template_matches(docs, id="doc_id", text="text", templates=TEMPLATES, threshold=THRESHOLD):
    """Pairs of a text (doc_id, text_key) and a label with the largest containment of its templates."""
    plain = _plain(docs, id, text)
    order = word_order(plain.select(F.explode(F.split("plain", "\n")).alias("line")).select(F.split("line", " ").alias("tokens")), templates)
    entries, prefix_words, fewest = [], set(), min(_least(len(w), threshold) for _, w in _words(templates))
    for k, ((label, words), (_, statement)) in enumerate(zip(_words(templates), templates)):
        names, reach = ",".join(f"'{w}'" for w in words), _reach(statement, threshold)
        words = sorted(words, key=order.get)
        least = _least(len(words), threshold)
        for at, word in enumerate(words[: len(words) - least + 1]):
            ids = ",".join(str(order[w]) for w in words)
            entries.append(f"({k}, '{label}', array({ids}), array({names}), {reach}, {least}, {len(words)}, {order[word]}, {at})")
            prefix_words.add(word)
    index = docs.sparkSession.sql(
        "SELECT * FROM VALUES " + ", ".join(entries) + " AS t(template, label, words, names, reach, least, size, word, at_t)"
    )
    ranks = F.create_map(*[F.lit(x) for pair in order.items() for x in pair])
    rare = text_list(sorted(prefix_words))
    plain = plain.where(F.arrays_overlap(F.split("plain", "[ \n]"), rare))
    alone = F.transform(F.split("plain", "\n"), lambda x: F.struct(F.lit(None).cast("string").alias("left"), x.alias("right")))
    around = _around(F.col("plain"), max(_reach(text, threshold) for _, text in templates))
    blocks = plain.select("doc_id", F.xxhash64("plain").alias("text_key"), F.explode(F.concat(alone, around)).alias("b"))
    blocks = blocks.select("doc_id", "text_key", "b", F.split(F.concat_ws(" ", "b.left", "b.right"), " ").alias("tokens"))
    blocks = blocks.where(F.arrays_overlap("tokens", rare))
    # words that no template holds change no overlap: a block is reduced to the others, in the global order
    known = F.array_intersect("tokens", text_list(list(order)))
    blocks = blocks.select(
        "doc_id", "text_key", "b", F.sort_array(F.transform(known, lambda w: F.element_at(ranks, w))).alias("block")
    ).where(F.size("block") >= fewest)
    prefix = F.slice("block", F.lit(1), F.size("block") - (fewest - 1))
    heads = blocks.select("doc_id", "text_key", "b", "block", F.posexplode(prefix).alias("at_b", "word"))
    pairs = heads.join(F.broadcast(index), "word")  # as many rows as the templates' prefixes have words
    length = F.size("block") >= F.col("least")
    position = F.least(F.size("block") - F.col("at_b"), F.col("size") - F.col("at_t")) >= F.col("least")
    # around a line end, only as far as this template may spread
    side = lambda x, n: F.call_function("substring_index", F.col(x), F.lit(" "), n)
    near = F.split(F.concat_ws(" ", side("b.left", -F.col("reach")), side("b.right", F.col("reach"))), " ")
    overlap = F.when(F.col("b.left").isNull(), F.size(F.array_intersect("block", "words"))).otherwise(
        F.size(F.array_intersect(near, F.col("names")))
    )
    pairs = pairs.where(length & position).select("doc_id", "text_key", "label", overlap.alias("n"), "size", "least")
    return pairs.where(F.col("n") >= F.col("least")).groupBy("doc_id", "text_key", "label").agg(
        F.max(F.col("n") / F.col("size")).alias("containment")
    )


def licenses(docs, id="doc_id", text="text", phrases=PHRASES, templates=TEMPLATES, threshold=THRESHOLD):
    """Per row the phrase places and the labels of phrases and templates; score is the best containment,
    1 for a phrase."""
    matched = template_matches(docs, id, text, templates, threshold).groupBy("doc_id", "text_key").agg(
        F.collect_set("label").alias("more"), F.max("containment").alias("best")
    )
    matched = matched.select(F.col("doc_id").alias("m_id"), F.col("text_key").alias("m_key"), "more", "best")
    rows = scanned(docs, id, text, phrases)
    same = rows["doc_id"].eqNullSafe(matched["m_id"]) & (rows["text_key"] == matched["m_key"])
    joined = rows.join(matched, same, "left")
    name = lambda labels: F.array_join(F.array_sort(F.array_distinct(labels)), ",")
    return joined.select(
        "doc_id", "n_words", "n_base", "first_word", "last_word", name(F.col("base")).alias("base_labels"),
        name(F.array_union("base", F.coalesce("more", text_list([])))).alias("labels"),
        F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.coalesce("best", F.lit(0.0))).alias("score"),
    )
