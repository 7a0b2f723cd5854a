"""Words of whole Arrow batches by array operations: where they are, and a 64-bit hash of each."""

import numpy as np

SEED = 0x9E3779B97F4A7C15
FACTOR = 0x5851F42D4C957F2D
# Bytes of text worked on at once: its arrays of numbers take some hundred times as much.
SMALL = 500_000
_MASK = (1 << 64) - 1
_POWERS = {}


def utf8(column):
    """Bytes and offsets of a string column of a record batch; nulls are empty."""
    n, at = len(column), column.offset
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    if column.null_count:
        column, at = column.fill_null(""), 0
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32, n + 1, 4 * column.offset).astype(np.int64)
    first = offsets[0]
    data = np.frombuffer(data, np.uint8, offsets[-1] - first, first) if data is not None else np.zeros(0, np.uint8)
    return data, offsets - first


def pieces(batch, column, most=SMALL):
    """Slices of a batch with about `most` bytes of a string column, one row at least."""
    _, offsets = utf8(batch.column(column))
    at = 0
    while at < batch.num_rows:
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, side="right")) - 1)
        yield batch.slice(at, end - at)
        at = end


def spans(data, offsets, word, cuts=None):
    """Starts and ends of the words (bytes marked in `word`), and the first word of each row. `cuts` are two
    classes of bytes: a word also ends where one stands next to the other."""
    inside = word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True
    if cuts is not None:
        one, other = cuts[0][data], cuts[1][data]
        edge[1:-1] |= (one[1:] & other[:-1]) | (one[:-1] & other[1:])
    opens = inside & (edge[:-1] | ~np.concatenate(([False], inside[:-1])))
    closes = inside & (edge[1:] | ~np.concatenate((inside[1:], [False])))
    starts, ends = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def _powers(n):
    size = max(1 << 16, 1 << (n - 1).bit_length()) if n else 1 << 16
    if _POWERS.get("size", 0) < size:
        inverse = pow(FACTOR, -1, 1 << 64)
        for name, base in (("up", FACTOR), ("down", inverse)):
            steps = np.full(size, base, dtype=np.uint64)
            steps[0] = 1
            _POWERS[name] = np.multiply.accumulate(steps)
        _POWERS["size"] = size
    return _POWERS["up"], _POWERS["down"]


def mixed(x):
    """A bijection of 64-bit numbers that spreads their bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def hashes(data, starts, ends):
    """A hash of each span, from differences of one running sum."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    up, down = _powers(len(data) + 1)
    sums = np.zeros(len(data) + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[: len(data)], out=sums[1:])
    return mixed((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64) * np.uint64(SEED))


def gather(flat, begins, sizes):
    """The stretches of `flat` one after the other, and where each begins in the result."""
    at = np.concatenate(([0], np.cumsum(sizes)))
    where = np.repeat(begins - at[:-1], sizes) + np.arange(at[-1])
    return flat[where], at


def eights(data):
    """The eight bytes from each place of the data on as one number; zeros follow the end."""
    padded = np.concatenate((data, np.zeros(8, np.uint8)))
    return np.ndarray(len(data) + 1, dtype="<u8", buffer=padded, strides=(1,))


def word_keys(data, starts, ends):
    """A key of each span: its bytes and length where these are at most seven, so that different spans have
    different keys; a hash with the highest bit set for longer ones."""
    sizes = ends - starts
    short = np.minimum(sizes, 7).astype(np.uint64)
    masks = (np.uint64(1) << (short * np.uint64(8))) - np.uint64(1)
    exact = (eights(data)[starts] & masks) | (short << np.uint64(56))
    return np.where(sizes < 8, exact, hashes(data, starts, ends) | np.uint64(1 << 63))


def all_same(data, starts, sizes, other, places, lengths):
    """Whether every span of eight bytes or more holds the bytes of the span of `other` beside it."""
    long = np.flatnonzero(sizes >= 8)
    starts, sizes, places = starts[long], sizes[long], places[long]
    if not np.array_equal(sizes, lengths[long]):
        return False
    here, there = eights(data), eights(other)
    if not np.array_equal(here[starts], there[places]) or not np.array_equal(here[starts + sizes - 8], there[places + sizes - 8]):
        return False
    more = sizes > 16
    found, _ = gather(data, starts[more] + 8, sizes[more] - 16)
    return np.array_equal(found, gather(other, places[more] + 8, sizes[more] - 16)[0])
