"""Near duplicates by word n-gram Jaccard: a MinHash LSH forest finds groups, exact counts decide.

Words are runs of letters, digits and characters beyond ASCII, A-Z in lower case; a text's set holds its
runs of five words (a text of fewer words has one run with all of them). Two texts are linked when the
Jaccard similarity of their sets is 0.8 or more; texts with equal words are copies and linked.

Each of the trees sorts the texts by a sequence of MinHash values. Texts with a common prefix are candidates,
and links are verified exactly. Prefixes are so short that a pair just at the threshold meets with the target
chance, more similar ones with a greater: that holds for each pair, whatever else is in the table.

Copies are folded into one representative (the least id) before anything is compared. Candidates form
groups (components of the prefix buckets); a group is cut into blocks, and a task compares two blocks, so
neither pairs nor whole groups are ever rows or one task's input. No link inside a group is left out.

Defined results: a null or wordless text has no links and a class of its own; a row without id has no class
and no links; rows of one id are one document; an empty table gives no rows; other columns are not read.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from orderflow.llm.bytewords import hashes, mixed, pieces, spans, utf8
from orderflow.llm.common import filled, freed, written
from orderflow.llm.components import components

RUN = 5
SIMILARITY = 0.8
TREES = 20
DEPTHS = (8, 7, 6, 5, 4, 3, 2, 1)
TARGET = 0.995
BLOCK = 128
SHIFT = np.uint64(11400714819323198485)

_rng = np.random.default_rng(5)
_PLACES = _rng.integers(1, 1 << 62, RUN).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_FLIPS = _rng.integers(0, 1 << 62, TREES * max(DEPTHS)).astype(np.uint64)
_FACTORS = _rng.integers(1, 1 << 62, TREES * max(DEPTHS)).astype(np.uint64) * np.uint64(2) + np.uint64(1)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_WORD = np.zeros(256, dtype=bool)
_WORD[48:58] = _WORD[97:123] = _WORD[128:] = True


def chance(similarity, depth, trees=TREES):
    """Of a pair to share a prefix of this depth in some tree."""
    return 1 - (1 - similarity**depth) ** trees


def fitting(similarity=SIMILARITY, depths=DEPTHS, target=TARGET):
    """The greatest depth at which a pair of just this similarity meets with the target chance, else the least."""
    return next((d for d in sorted(depths, reverse=True) if chance(similarity, d) >= target), min(depths))


def shingles(column):
    """Word hashes and first word of each row; run hashes and first run of each row."""
    data, offsets = utf8(column)
    data = _LOWER[data]
    starts, ends, first = spans(data, offsets, _WORD)
    words = hashes(data, starts, ends)
    counts = np.diff(first)
    at, stop = np.arange(len(words)), np.repeat(first[1:], counts)
    begin = np.repeat(first[:-1], counts)
    runs = np.zeros(len(words), dtype=np.uint64)
    for k in range(RUN):
        inside = at + k < stop
        runs[inside] += words[at[inside] + k] * _PLACES[k]
    keep = (at + RUN <= stop) | ((at == begin) & (stop - begin < RUN))
    before = np.concatenate(([0], np.cumsum(keep)))
    return words, first, mixed(runs[keep]), before[first]


def _prints(column):
    """A 128-bit digest of each row's words, a space apart; null without words."""
    data, offsets = utf8(column)
    data = _LOWER[data]
    inside = _WORD[data]
    ends = np.concatenate((inside[:-1] & ~inside[1:], [False])) if len(data) else inside
    last = offsets[1:][offsets[1:] > offsets[:-1]] - 1
    ends[last] = False
    keep = inside.copy()
    keep[1:] |= ends[:-1]  # the first sign after a word stands for all up to the next
    at = np.concatenate(([0], np.cumsum(keep)))[offsets]
    flat = np.where(inside, data, 32).astype(np.uint8)[keep].tobytes()
    words = [flat[a:b].rstrip() for a, b in zip(at[:-1].tolist(), at[1:].tolist())]
    return [hashlib.blake2b(w, digest_size=16).digest() if w else None for w in words]


def _forest(runs, first, depth):
    """The keys of all trees of the rows, which have a run each."""
    least = [np.minimum.reduceat((runs ^ f) * a, first[:-1]) for f, a in zip(_FLIPS[: TREES * depth], _FACTORS)]
    least = np.stack(least, axis=1).reshape(len(first) - 1, TREES, depth)
    keys = np.broadcast_to(mixed(np.arange(TREES, dtype=np.uint64) * SHIFT), least.shape[:2])
    for k in range(depth):
        keys = mixed(keys + least[:, :, k] * SHIFT)
    return keys.view(np.int64)


def signed(docs, depth, id="doc_id", text="text"):
    """Per row its id, the fingerprint of its words, and the keys of the trees."""

    def sign(batches):
        for batch in batches:
            for piece in pieces(batch, 1):
                _, first, runs, run_first = shingles(piece.column(1))
                full = np.flatnonzero(np.diff(first) > 0)
                prints, keys = _prints(piece.column(1)), [None] * piece.num_rows
                if len(full):
                    found = _forest(runs, np.append(run_first[full], run_first[-1]), depth)
                    for n, k in enumerate(full.tolist()):
                        keys[k] = found[n]
                columns = {"doc_id": piece.column(0), "print": pa.array(prints, pa.binary())}
                yield pa.RecordBatch.from_pydict(columns | {"keys": pa.array(keys, pa.list_(pa.int64()))})

    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), filled(text).alias("text"))
    return rows.mapInArrow(freed(sign), "doc_id long, print binary, keys array<long>")


def grouped(representatives):
    """Representatives that share a prefix, directly or over others: `node` and `component`."""
    keyed = representatives.select("rep", F.explode("keys").alias("key"))
    buckets = keyed.groupBy("key").agg(F.min("rep").alias("root"), F.count("rep").alias("n")).where("n > 1")
    edges = keyed.join(buckets.select("key", "root"), "key").select(F.col("rep").alias("a"), F.col("root").alias("b"))
    return components(edges)


def _sets(batches):
    """Run sets of texts: sorted, each run once."""
    for batch in batches:
        at = batch.schema.get_field_index("text")
        for piece in pieces(batch, at):
            _, _, runs, first = shingles(piece.column(at))
            sets = [np.unique(runs[a:b]).tobytes() for a, b in zip(first[:-1].tolist(), first[1:].tolist())]
            yield pa.RecordBatch.from_arrays(
                [*[piece.column(k) for k in range(4)], pa.array(sets, pa.binary())],
                names=["component", "node", "blocks", "copies", "runs"],
            )


def _common(sets):
    """Sizes of all intersections of the sets."""
    n = len(sets)
    values, owners = np.concatenate(sets), np.repeat(np.arange(n), [len(s) for s in sets])
    _, column, counts = np.unique(values, return_inverse=True, return_counts=True)
    shared = counts > 1
    number = np.cumsum(shared) - 1
    use = shared[column]
    column, owners = number[column[use]], owners[use]
    total = np.zeros((n, n), dtype=np.float32)
    order = np.argsort(column, kind="stable")
    column, owners = column[order], owners[order]
    for at in range(0, int(shared.sum()), 4096):
        a, b = np.searchsorted(column, [at, at + 4096])
        part = np.zeros((n, 4096), dtype=np.float32)
        part[owners[a:b], column[a:b] - at] = 1
        total += part @ part.T
    return total


def _compared(nodes, blocks, copies, sets, cross, similarity):
    """Links inside one block, or across two: (node, links with copies, least node reached)."""
    common = _common(sets)
    sizes = np.array([len(s) for s in sets], dtype=np.float64)
    union = sizes[:, None] + sizes[None, :] - common
    alike = common / np.maximum(union, 1)
    linked = alike >= similarity - 1e-9
    np.fill_diagonal(linked, False)
    if cross:
        linked &= blocks[:, None] != blocks[None, :]
    roots = nodes.copy()
    while True:
        best = np.where(linked, roots[None, :], np.iinfo(np.int64).max).min(axis=1)
        lower = np.minimum(roots, best)
        if (lower == roots).all():
            break
        roots = lower
    return nodes, linked @ copies, roots


def _verifier(similarity):
    def verify(batches):
        names = ["node", "links", "root"]
        held, held_key = [], None

        def flush():
            unique = {row["node"]: row for row in held}.values()
            nodes = np.array([r["node"] for r in unique], dtype=np.int64)
            blocks = np.array([r["block"] for r in unique], dtype=np.int64)
            copies = np.array([r["copies"] for r in unique], dtype=np.int64)
            sets = [np.frombuffer(r["runs"], dtype=np.uint64) for r in unique]
            cross = held_key[1] != held_key[2]
            return _compared(nodes, blocks, copies, sets, cross, similarity)

        ready = []
        for batch in batches:
            for row in batch.to_pylist():
                key = (row["component"], row["low"], row["high"])
                if key != held_key and held:
                    ready.append(flush())
                    held = []
                held_key = key
                held.append(row)
                if len(ready) >= 500:
                    yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*ready)], names=names)
                    ready = []
        if held:
            ready.append(flush())
        if ready:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*ready)], names=names)

    return verify


def verified(docs, members, similarity=SIMILARITY, block=BLOCK):
    """Links of the members (component, node, copies): one row per node and pair of blocks it is in."""
    sizes = members.groupBy("component").agg(F.ceil(F.count("node") / block).cast("long").alias("blocks"))
    members = members.join(sizes, "component")
    rows = docs.join(members.hint("shuffle_hash"), docs["doc_id"] == members["node"])
    sets = rows.select("component", "node", "blocks", "copies", "text").mapInArrow(
        freed(_sets), "component long, node long, blocks long, copies long, runs binary"
    )
    own = F.pmod(F.xxhash64("node"), F.col("blocks"))
    sets = written(sets.withColumn("block", own), "sets")
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("other")
    pairs = sets.select("component", "node", "copies", "runs", "block", other).select(
        "component", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "block", "node", "copies", "runs",
    )
    # ranges deal the pairs of blocks out evenly; a pair of blocks is never split
    pairs = pairs.repartitionByRange("component", "low", "high").sortWithinPartitions("component", "low", "high", "node")
    return written(pairs.mapInArrow(freed(_verifier(similarity)), "node long, links long, root long"), "links")


def near_duplicates(docs, id="doc_id", text="text", similarity=SIMILARITY, depths=DEPTHS, target=TARGET, block=BLOCK):
    """Per row: doc_id, class_id (the least id linked to it, directly or over others) and n_links (rows
    linked to it, copies included)."""
    rows = written(signed(docs, fitting(similarity, depths, target), id, text), "signed")
    whole = rows.where(F.col("print").isNotNull() & F.col("doc_id").isNotNull())
    representatives = written(whole.groupBy("print").agg(
        F.min("doc_id").alias("rep"), F.count("doc_id").alias("copies"), F.first("keys").alias("keys")
    ), "representatives")
    copies = representatives.select(F.col("rep").alias("node"), "copies")
    texts = docs.select(F.col(id).cast("bigint").alias("doc_id"), filled(text).alias("text"))
    members = grouped(representatives).join(copies, "node")
    links = verified(texts, members, similarity, block)
    classes = components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    counts = links.groupBy("node").agg(F.sum("links").alias("links"))
    folded = representatives.select("print", "rep", "copies")
    folded = folded.join(counts, F.col("rep") == F.col("node"), "left").drop("node")
    folded = folded.join(classes, F.col("rep") == F.col("node"), "left").select(
        F.col("print").alias("p"), F.coalesce("component", "rep").alias("class"),
        (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("links"),
    )
    known = F.col("doc_id").isNotNull()
    return rows.select("doc_id", "print").join(folded, F.col("print") == F.col("p"), "left").select(
        "doc_id", F.when(known, F.coalesce("class", "doc_id")).alias("class_id"),
        F.when(known, F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )
