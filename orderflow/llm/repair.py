"""Token ids in binary shards, compressed by a Re-Pair grammar.

`encoded` writes shards in ascending order of id, `decoded` reads them back, `ids_between` reads part of a
shard. A shard holds whole documents, about `SHARD_IDS` ids. Its file image, all little-endian:

    magic "RPG1", then as unsigned 64-bit: documents, rules, symbols, terminals
    document ids (int64), 1 where the id is null (uint8), ids of each document (uint32)
    rules: left and right symbol (uint32 pairs), expansion length of each rule (uint32)
    start of every 256th symbol in ids (uint64), symbols (uint32)

Symbols below `terminals` are token ids, the others are rules, numbered in the order they were made; a rule
uses earlier symbols only. A pair never crosses a document's end, so documents expand by themselves.

A round replaces many frequent pairs at once: pairs are taken by falling count, leaving out one whose symbol
already stands on the other side of a taken pair, so that no two places overlap and counts stay exact.

Defined results: a null text is the empty text and holds the end id only; rows with equal ids follow each
other by text, rows without an id come first; an empty table gives no shards; other columns are not read.
"""

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from orderflow.llm.bytewords import all_same, gather, pieces, spans, utf8, word_keys
from orderflow.llm.common import BLANKS, filled, freed, written

MAGIC = b"RPG1"
END_ID = 2
SHARD_IDS = 1_000_000
LEAST_COUNT = 16
ROUNDS = 12
STEP = 256
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32
MEMO_WORDS = 1_000_000
MEMO_BYTES = 16_000_000
# Bytes of text encoded at once: the arrays of numbers for them take some hundred times as much.
PIECE = 250_000
SHARD_SCHEMA = "part int, part_start long, n_docs long, n_ids long, data binary"


def _taken(left, right):
    """Which of the pairs, given by falling count, can be replaced in one pass."""
    lefts, rights, keep = set(), set(), []
    for k, (a, b) in enumerate(zip(left.tolist(), right.tolist())):
        if a == b:
            if a in lefts or a in rights:
                continue
        elif a in rights or b in lefts:
            continue
        lefts.add(a)
        rights.add(b)
        keep.append(k)
    return np.array(keep, dtype=np.int64)


def compress(ids, last, terminals, least=LEAST_COUNT, rounds=ROUNDS):
    """Symbols and rules of the ids; `last` marks the last id of each document."""
    symbols, last = ids.astype(np.uint32), last.copy()
    rules, lengths, made = [], [], terminals
    for _ in range(rounds):
        if len(symbols) < 2:
            break
        # codes of pairs: 32 bits while that is enough, since sorting them takes most of the time
        kind = np.uint32 if made < 1 << 16 else np.uint64
        base = kind(made)
        pairs = symbols[:-1].astype(kind) * base + symbols[1:]
        open_ = np.flatnonzero(~last[:-1])
        ordered = np.sort(pairs[open_])
        starts = np.flatnonzero(np.concatenate(([True], ordered[1:] != ordered[:-1]))) if len(ordered) else open_
        counts = np.diff(np.append(starts, len(ordered)))
        # a floor that falls with the rounds keeps the order by frequency
        best = counts.max(initial=0)
        floor = max(least, best // 16)
        often = np.flatnonzero(counts >= floor)
        if not len(often):
            break
        often = often[np.argsort(-counts[often], kind="stable")]
        chosen = ordered[starts[often]]
        chosen = chosen[_taken(chosen // base, chosen % base)]
        left, right = chosen // base, chosen % base
        numbers = made + np.arange(len(chosen))
        by_code = np.argsort(chosen)
        codes = chosen[by_code]
        # a symbol table narrows the search to places whose left symbol begins a taken pair
        begins = np.zeros(made, dtype=bool)
        begins[left] = True
        ends = np.zeros(made, dtype=bool)
        ends[right] = True
        place = np.flatnonzero(begins[symbols[:-1]] & ends[symbols[1:]] & ~last[:-1])
        at = np.minimum(np.searchsorted(codes, pairs[place]), len(codes) - 1)
        fits = codes[at] == pairs[place]
        place, at = place[fits], at[fits]
        twin = symbols[place] == symbols[place + 1]
        if twin.any():  # of a run of equal symbols every other pair
            run = np.flatnonzero(np.concatenate(([True], (place[1:] != place[:-1] + 1) | ~twin[1:] | ~twin[:-1])))
            rank = np.arange(len(place)) - np.repeat(run, np.diff(np.append(run, len(place))))
            fine = ~twin | (rank % 2 == 0)
            place, at = place[fine], at[fine]
        symbols[place] = numbers[by_code][at]
        last[place] = last[place + 1]
        keep = np.ones(len(symbols), dtype=bool)
        keep[place + 1] = False
        symbols, last = symbols[keep], last[keep]
        rules.append(np.stack([left, right], axis=1).astype(np.int64))
        made += len(chosen)
    table = np.concatenate(rules) if rules else np.zeros((0, 2), dtype=np.int64)
    sizes = np.ones(made, dtype=np.int64)
    for made_in in rules:
        begin = terminals + len(lengths)
        sizes[begin : begin + len(made_in)] = sizes[made_in[:, 0]] + sizes[made_in[:, 1]]
        lengths.extend(sizes[begin : begin + len(made_in)].tolist())
    return symbols, table, sizes


def shard_image(doc_ids, texts_ids, terminals):
    """The file image of documents with these id arrays."""
    counts = np.array([len(x) for x in texts_ids], dtype=np.uint32)
    ids = np.concatenate(texts_ids) if len(texts_ids) else np.zeros(0, dtype=np.uint32)
    last = np.zeros(len(ids), dtype=bool)
    last[np.cumsum(counts.astype(np.int64)) - 1] = True  # each document has its end id
    terminals = max(terminals, int(ids.max(initial=0)) + 1)
    symbols, rules, sizes = compress(ids, last, terminals)
    starts = np.concatenate(([0], np.cumsum(sizes[symbols])[:-1]))[::STEP] if len(symbols) else np.zeros(0)
    parts = [
        MAGIC,
        np.array([len(doc_ids), len(rules), len(symbols), terminals], dtype="<u8"),
        np.array([0 if x is None else x for x in doc_ids], dtype="<i8"),
        np.array([x is None for x in doc_ids], dtype="u1"),
        counts.astype("<u4"),
        rules.astype("<u4"),
        sizes[terminals:].astype("<u4"),
        starts.astype("<u8"),
        symbols.astype("<u4"),
    ]
    return b"".join(x if isinstance(x, bytes) else x.tobytes() for x in parts)


def parsed(image):
    """The parts of a file image, without expanding it."""
    if bytes(image[:4]) != MAGIC:
        raise ValueError("not a shard")
    docs, rules, symbols, terminals = (int(x) for x in np.frombuffer(image, "<u8", 4, 4))
    at, found = 36, []
    for kind, n in (("<i8", docs), ("u1", docs), ("<u4", docs), ("<u4", 2 * rules), ("<u4", rules),
                    ("<u8", -(-symbols // STEP)), ("<u4", symbols)):
        found.append(np.frombuffer(image, kind, n, at))
        at += found[-1].nbytes
    ids, null, counts, table, lengths, starts, body = found
    return {"ids": ids, "null": null, "counts": counts, "rules": table.reshape(-1, 2), "lengths": lengths,
            "starts": starts, "symbols": body, "terminals": terminals}


def expanded(shard, symbols=None):
    """The ids of symbols, all by default."""
    symbols = shard["symbols"] if symbols is None else symbols
    first, rules, lengths = shard["terminals"], shard["rules"].tolist(), shard["lengths"].astype(np.int64)
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    flat = np.empty(offsets[-1], dtype=np.uint32)
    span = offsets.tolist()
    for k, (a, b) in enumerate(rules):
        at, end = span[k], span[k + 1]
        if a < first:
            flat[at] = a
            at += 1
        else:
            n = span[a - first + 1] - span[a - first]
            flat[at : at + n] = flat[span[a - first] : span[a - first + 1]]
            at += n
        if b < first:
            flat[at] = b
        else:
            flat[at:end] = flat[span[b - first] : span[b - first + 1]]
    symbols = symbols.astype(np.int64)
    rule = symbols >= first
    sizes = np.ones(len(symbols), dtype=np.int64)
    sizes[rule] = lengths[symbols[rule] - first]
    begins = np.concatenate(([0], np.cumsum(sizes)))
    out = np.empty(begins[-1], dtype=np.uint32)
    out[begins[:-1][~rule]] = symbols[~rule]
    if rule.any():
        n = sizes[rule]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out[np.repeat(begins[:-1][rule], n) + inside] = flat[np.repeat(offsets[symbols[rule] - first], n) + inside]
    return out


def ids_between(image, begin, end):
    """Ids `begin` to `end` of a shard: only the rules met there are expanded."""
    shard = parsed(image)
    begin, end = max(begin, 0), min(end, int(shard["counts"].astype(np.int64).sum()))
    if begin >= end:
        return np.zeros(0, dtype=np.uint32)
    first, rules, lengths = shard["terminals"], shard["rules"], shard["lengths"]
    block = int(np.searchsorted(shard["starts"], begin, side="right")) - 1
    at, k, out = int(shard["starts"][block]), block * STEP, []
    while at < end:
        waiting, k = [int(shard["symbols"][k])], k + 1
        while waiting and at < end:
            x = waiting.pop()
            n = 1 if x < first else int(lengths[x - first])
            if at + n <= begin:
                at += n
            elif x < first:
                out.append(x)
                at += 1
            else:
                waiting += [int(rules[x - first][1]), int(rules[x - first][0])]
    return np.array(out, dtype=np.uint32)


class WordEncoder:
    """Encodes texts by a tokenizer whose tokens never reach over white space: each different word is encoded
    once and kept for later batches, up to a number of words and of their bytes. Words are found by a key of 64 bits
    and long ones compared byte by byte: where two different words have one key, the texts at hand are encoded word by
    word without it."""

    def __init__(self, path, memo=MEMO_WORDS, memo_bytes=MEMO_BYTES):
        from tokenizers import Tokenizer

        self.tokenizer, self.memo, self.memo_bytes = Tokenizer.from_file(path), memo, memo_bytes
        self._forget()
        self.word = np.ones(256, dtype=bool)
        self.word[[ord(x) for x in BLANKS]] = False
        code = np.arange(256)
        letter = ((code >= 48) & (code < 58)) | ((code >= 97) & (code < 123))
        self.solid, self.sign = letter, self.word & (code < 128) & ~letter & (code != 39)
        self.special = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]

    def _forget(self):
        """Known words: sorted keys and the number of each; by number where in `bytes` its bytes and in `ids` its
        ids begin, and how many."""
        self.keys, self.ids, self.bytes = np.zeros(0, np.uint64), np.zeros(0, np.uint32), np.zeros(0, np.uint8)
        self.number = self.begins = self.sizes = self.places = self.lengths = np.zeros(0, np.int32)

    def _tokens(self, words):
        """Ids of the words one after the other, and how many each has: encoded together, a space apart, where a
        token belongs to the word it starts in."""
        ids, sizes = [np.zeros(0, np.uint32)], [np.zeros(0, np.int64)]
        for at in range(0, len(words), 2_000):
            part = words[at : at + 2_000]
            found = self.tokenizer.encode(" ".join(part), add_special_tokens=False)
            ids.append(np.array(found.ids, dtype=np.uint32))
            places = np.array([x[0] for x in found.offsets], dtype=np.int64)
            begins = np.cumsum([0] + [len(w) + 1 for w in part])
            sizes.append(np.diff(np.searchsorted(places, begins)))
        return np.concatenate(ids), np.concatenate(sizes)

    def _learn(self, data, starts, lengths, keys):
        flat, at = gather(data, starts, lengths)
        text = flat.tobytes()
        ids, sizes = self._tokens([text[a:b].decode() for a, b in zip(at[:-1].tolist(), at[1:].tolist())])
        # the new keys are sorted too: they are put in between, which copies but does not sort
        where = np.searchsorted(self.keys, keys)
        number = np.arange(len(self.number), len(self.number) + len(keys), dtype=np.int32)
        self.keys, self.number = np.insert(self.keys, where, keys), np.insert(self.number, where, number)
        for name, more in (("begins", len(self.ids) + np.cumsum(sizes) - sizes), ("places", len(self.bytes) + at[:-1]),
                           ("sizes", sizes), ("lengths", lengths)):
            setattr(self, name, np.concatenate((getattr(self, name), more.astype(np.int32))))
        self.ids, self.bytes = np.concatenate((self.ids, ids)), np.concatenate((self.bytes, flat))

    def encode(self, column):
        """The ids of all texts of an Arrow string column in one array, and where each text begins."""
        data, offsets = utf8(column)
        cuts = None
        lower = LOWERED[data]
        text = lower.tobytes()
        if any(x in text for x in self.special):
            text = data.tobytes()
        else:  # the tokenizer lowers letters, and sets letters and digits apart from other ASCII signs
            data, cuts = lower, (self.solid, self.sign)
        starts, ends, first = spans(data, offsets, self.word, cuts)
        lengths = ends - starts
        keys, sample, which = np.unique(word_keys(data, starts, ends), return_index=True, return_inverse=True)
        if len(self.keys) > self.memo or len(self.bytes) > self.memo_bytes:
            self._forget()
        at = np.minimum(np.searchsorted(self.keys, keys), max(len(self.keys) - 1, 0))
        new = np.flatnonzero(self.keys[at] != keys) if len(self.keys) else np.arange(len(keys))
        if len(new):
            self._learn(data, starts[sample[new]], lengths[sample[new]], keys[new])
            at = np.searchsorted(self.keys, keys)
        at = self.number[at][which]
        if all_same(data, starts, lengths, self.bytes, self.places[at], self.lengths[at]):
            ids, begins = gather(self.ids, self.begins[at], self.sizes[at])
        else:
            words = [text[a:b].decode() for a, b in zip(starts.tolist(), ends.tolist())]
            ids, sizes = self._tokens(words)
            begins = np.concatenate(([0], np.cumsum(sizes)))
        return ids, begins[first]


_ENCODERS = {}


def word_encoder(path):
    """One encoder for each worker process, so that its words serve later tasks too."""
    if path not in _ENCODERS:
        _ENCODERS[path] = WordEncoder(path)
    return _ENCODERS[path]


def encoded(docs, tokenizer, id="doc_id", text="text", end_id=END_ID, shard_ids=SHARD_IDS, encoder=word_encoder):
    """One row for each shard, in the order of part and part_start. `tokenizer` is the path of a vocabulary
    file that every executor has."""

    def write(batches):
        coder, docs_now, ids_now, n, start = encoder(tokenizer), [], [], 0, 0
        terminals = coder.tokenizer.get_vocab_size()
        part = TaskContext.get().partitionId()
        end = np.array([end_id], dtype=np.uint32)

        def shard():
            image = shard_image(docs_now, ids_now, terminals)
            return pa.RecordBatch.from_pydict(
                {"part": pa.array([part], pa.int32()), "part_start": [start], "n_docs": [len(docs_now)],
                 "n_ids": [n], "data": pa.array([image], pa.binary())}
            )

        for batch in batches:
            for piece in pieces(batch, 1, PIECE):
                ids, bounds = coder.encode(piece.column(1))
                for k, doc in enumerate(piece.column(0).to_pylist()):
                    docs_now.append(doc)
                    ids_now.append(np.concatenate((ids[bounds[k] : bounds[k + 1]], end)))
                    n += len(ids_now[-1])
                    if n >= shard_ids:
                        yield shard()
                        docs_now, ids_now, start, n = [], [], start + n, 0
        if docs_now:
            yield shard()

    rows = docs.select(F.col(id).cast("bigint").alias("doc_id"), filled(text).alias("text"))
    rows = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return rows.mapInArrow(freed(write), SHARD_SCHEMA)


def decoded(shards):
    """Per document what its ids in the shards are: place, number and checksum."""
    # one row for each part (a task of the writing stage), not for each document or shard
    parts = shards.groupBy("part").agg(F.sum("n_ids").alias("n"))
    before = F.sum("n").over(W.orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    parts = parts.select(F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("before"))

    def read(batches):
        for batch in batches:
            for k in range(batch.num_rows):
                shard = parsed(batch.column(1)[k].as_buffer())
                ids = expanded(shard).astype("<u4")
                counts = shard["counts"].astype(np.int64)
                ends = np.cumsum(counts)
                view = memoryview(ids.tobytes())
                sums = [zlib.crc32(view[4 * (e - c) : 4 * e]) for e, c in zip(ends.tolist(), counts.tolist())]
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.array(shard["ids"], pa.int64(), mask=shard["null"].astype(bool)),
                    "start": int(batch.column(0)[k].as_py()) + ends - counts,
                    "n_tokens": counts,
                    "ids_crc32": pa.array(sums, pa.int64()),
                })

    placed = shards.join(F.broadcast(parts), F.col("part") == F.col("p")).select(
        (F.col("before") + F.col("part_start")).alias("start"), "data"
    )
    return placed.mapInArrow(freed(read), "doc_id long, start long, n_tokens long, ids_crc32 long")


def stored(docs, tokenizer, **options):
    """The shards, written to the shared folder. A shard is some megabytes, so the writer looks at the size of a page
    after each: after a hundred, as usual, it would hold all shards of a task twice to compress them at once."""
    return written(encoded(docs, tokenizer, **options), "shards", **{"parquet.page.size.row.check.min": 1})
