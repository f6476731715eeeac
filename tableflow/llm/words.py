"""Words of whole texts, batch by batch, as arrays: byte positions and 64-bit hashes.

Operators that cannot say their work in Spark's functions run in ``mapInArrow`` over these. A batch
is cut into pieces of half a MB, so that a task's memory does not follow Spark's batch size; a piece
always holds whole texts. Words that hash alike are taken to be alike (64 bits).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

PIECE_BYTES = 1 << 19

_BYTES = np.arange(256)
#: words of [^\x20\x09-\x0D]+
BETWEEN_SPACES = (_BYTES != 0x20) & ~((_BYTES >= 0x09) & (_BYTES <= 0x0D))
#: words of [^\x00-\x2F\x3A-\x60\x7B-\x7F]+ once A-Z are lower-cased
LETTERS_AND_DIGITS = (
    ((_BYTES >= 0x30) & (_BYTES <= 0x39))
    | ((_BYTES >= 0x41) & (_BYTES <= 0x5A))
    | ((_BYTES >= 0x61) & (_BYTES <= 0x7A))
    | (_BYTES >= 0x80)
)
LOWER = np.where((_BYTES >= 0x41) & (_BYTES <= 0x5A), _BYTES + 32, _BYTES).astype(np.uint8)
UNCHANGED = _BYTES.astype(np.uint8)
ASCII_LOWER = bytes(LOWER)

_STEP = np.uint64(0x9E3779B97F4A7C15)
_powers = np.ones(1, np.uint64)


def powers(count: int) -> np.ndarray:
    """Powers of an odd constant modulo 2^64."""
    global _powers
    if len(_powers) < count:
        steps = np.full(max(count, 1024), _STEP, np.uint64)
        steps[0] = 1
        _powers = np.multiply.accumulate(steps)
    return _powers[:count]


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads close ones (the splitmix64 finaliser)."""
    x = values ^ (values >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


@dataclass
class Words:
    """The words of a piece. Text t has the words first[t] to first[t + 1]."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray
    hashes: np.ndarray
    #: sums over the words' bytes, one more than there are, if asked for; and where each word begins in them
    sums: np.ndarray | None = None
    places: np.ndarray | None = None

    def prefixes(self, points: int) -> tuple[np.ndarray, np.ndarray]:
        """(words of more than ``points`` code points, hashes of their first ``points``)."""
        leads = np.flatnonzero((self.data & 0xC0) != 0x80)
        at = np.searchsorted(leads, self.starts) + points
        cut = np.append(leads, len(self.data))[np.minimum(at, len(leads))]
        long_ = np.flatnonzero(cut < self.ends)
        begin = self.places[long_]
        size = cut[long_] - self.starts[long_]
        return long_, mixed(self.sums[begin + size] - self.sums[begin] + np.uint64(points << 48))

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def text_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts())

    def starts_with_room(self, length: int) -> np.ndarray:
        """Indices of the words that begin a run of ``length`` words of one text."""
        left = np.repeat(self.first[1:], self.counts()) - np.arange(len(self.starts))
        return np.flatnonzero(left >= length)


def pieces(column: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, byte offset of each text and of the end); a null has no bytes."""
    if column.null_count:
        column = column.fill_null("")
    rows = len(column)
    if not rows:
        return
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offset_bytes, data_bytes = column.buffers()
    offsets = np.frombuffer(offset_bytes, kind)[column.offset : column.offset + rows + 1].astype(np.int64)
    data = np.frombuffer(data_bytes, np.uint8) if data_bytes is not None else np.zeros(0, np.uint8)
    begin = 0
    while begin < rows:
        end = int(np.searchsorted(offsets, offsets[begin] + limit, "right")) - 1
        end = min(max(end, begin + 1), rows)
        at = offsets[begin : end + 1]
        yield begin, end, data[at[0] : at[-1]], at - at[0]
        begin = end
    # workers live on between stages: what they no longer need goes back
    pa.default_memory_pool().release_unused()


def words_of(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray, case: np.ndarray, with_sums: bool = False
) -> Words:
    """Words are runs of bytes of a kind within a text; hashes are of the bytes mapped by ``case``.

    ``with_sums`` keeps what ``Words.prefixes`` needs.
    """
    if not len(data):
        none = np.zeros(0, np.int64)
        zero = np.zeros(1, np.uint64)
        return Words(data, none, none, np.zeros(len(offsets), np.int64), np.zeros(0, np.uint64), zero, none)
    inside = kind[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[:-1] < len(data)]
    begins[edges] = inside[edges]
    stops = inside.copy()
    stops[:-1] &= ~inside[1:]
    last = offsets[1:][offsets[1:] > 0] - 1
    stops[last] = inside[last]
    starts = np.flatnonzero(begins)
    ends = np.flatnonzero(stops) + 1
    first = np.searchsorted(starts, offsets)
    if not len(starts):
        return Words(data, starts, ends, first, np.zeros(0, np.uint64), np.zeros(1, np.uint64), starts)
    lengths = ends - starts
    values = case[data[inside]].astype(np.uint64)
    values += np.uint64(1)
    in_order = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    place = np.arange(len(values)) - np.repeat(in_order, lengths)
    values *= powers(int(lengths.max()))[place]
    hashes = np.add.reduceat(values, in_order)
    hashes += lengths.astype(np.uint64)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values)]) if with_sums else None
    return Words(data, starts, ends, first, mixed(hashes), sums, in_order)


def gram_hashes(values: np.ndarray, length: int) -> np.ndarray:
    """Hash of values[i : i + length] for every i that has them."""
    count = len(values) - length + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    total = values[:count].copy()
    for k in range(1, length):
        total *= _STEP
        total += values[k : k + count]
    return mixed(total)


def sliding_min(values: np.ndarray, length: int) -> np.ndarray:
    """min(values[i : i + length]) for every i that has them."""
    count = len(values) - length + 1
    if count <= 0:
        return values[:0]
    low, span = values, 1
    while 2 * span <= length:
        low = np.minimum(low[: len(low) - span], low[span:])
        span *= 2
    return np.minimum(low[:count], low[length - span : length - span + count])


def as_long(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64) if values.dtype == np.uint64 else values, pa.int64())


def repeated(keys: np.ndarray) -> np.ndarray:
    """Mask of the values that occur twice or more."""
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return np.zeros(len(keys), bool)
    at = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    return twice[at] == keys


def sums_by_text(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sum of values[first[t] : first[t + 1]] for each text."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return total[first[1:]] - total[first[:-1]]
