"""Words of many texts at once as numpy arrays: bounds, 64-bit hashes, hashes of runs of words."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Odd multipliers; a word's hash is a polynomial of its bytes, a run's one of its words' hashes.
BYTE_BASE, RUN_BASE, OTHER_BASE = 0x9E3779B97F4A7C55, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F
BLOCK_BYTES = 1 << 20


def byte_table(inside) -> np.ndarray:
    table = np.zeros(256, bool)
    table[[b for b in range(256) if inside(b)]] = True
    return table


#: Words are runs of anything but ASCII white space ...
NOT_SPACE = byte_table(lambda b: b != 0x20 and not 0x09 <= b <= 0x0D)
#: ... or runs of digits, lower-case letters and whatever is not ASCII.
ALPHANUMERIC = byte_table(lambda b: 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80)
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20


class Powers:
    """Powers of an odd base modulo 2**64 and of its inverse, grown on demand."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            for name, factor in (("up", self.base), ("down", self.inverse)):
                steps = np.full(size, factor, np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up[:n], self.down[:n]


BYTES, RUNS, OTHERS = Powers(BYTE_BASE), Powers(RUN_BASE), Powers(OTHER_BASE)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread every bit of unsigned 64-bit numbers over all bits (a bijection)."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def bounds(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Start and end offsets of the words in ``data``."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    within = inside[data]
    edges = np.flatnonzero(within[1:] != within[:-1]) + 1
    if within[0]:
        edges = np.concatenate(([0], edges))
    if within[-1]:
        edges = np.concatenate((edges, [len(data)]))
    return edges[::2], edges[1::2]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span; spans are in order and do not overlap."""
    out, at = np.empty(len(starts), np.uint64), 0
    while at < len(starts):
        low = starts[at]
        to = max(at + 1, int(np.searchsorted(ends, low + 4 * BLOCK_BYTES, "right")))
        piece = data[low : ends[to - 1]]
        up, down = BYTES.get(len(piece) + 1)
        sums = np.zeros(len(piece) + 1, np.uint64)
        np.cumsum((piece.astype(np.uint64) + np.uint64(1)) * up[:-1], out=sums[1:])
        a, b = starts[at:to] - low, ends[at:to] - low
        out[at:to] = (sums[b] - sums[a]) * down[a]
        at = to
    return mixed(out)


def run_hashes(words: np.ndarray, k: int, powers: Powers = RUNS) -> np.ndarray:
    """A hash of each ``k`` neighbouring word hashes."""
    if len(words) < k:
        return np.zeros(0, np.uint64)
    up, down = powers.get(len(words))
    sums = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * up, out=sums[1:])
    return mixed((sums[k:] - sums[:-k]) * down[: len(words) - k + 1])


def sliding(x: np.ndarray, width: int, least) -> np.ndarray:
    """``least`` (np.minimum or np.maximum) over each ``width`` neighbours."""
    if len(x) < width:
        return x[:0]
    size = 1
    while size * 2 <= width:
        x, size = least(x[:-size], x[size:]), size * 2
    rest = width - size
    return least(x[:-rest], x[rest:]) if rest else x


@dataclass
class Words:
    """``first[i]`` to ``first[i + 1]`` are text i's words in the other arrays."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    first: np.ndarray

    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    def last_start(self, k: int) -> np.ndarray:
        """For each word, whether ``k`` words of the same text begin there (for the first ``len - k + 1``)."""
        n = len(self.hashes) - k + 1
        if n <= 0:
            return np.zeros(0, bool)
        end = np.repeat(self.first[1:], self.counts())
        return np.arange(n) + k <= end[:n]


def tokenised(texts: list[bytes | None], inside: np.ndarray = NOT_SPACE, lower: bool = False) -> Words:
    """The words of some texts; null has none."""
    joined = b"\n".join(t or b"" for t in texts)
    data = np.frombuffer(joined, np.uint8)
    if lower:
        data = LOWER[data]
    lengths = np.fromiter((len(t or b"") + 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate(([0], np.cumsum(lengths)))
    starts, ends = bounds(data, inside)
    return Words(data, starts, ends, span_hashes(data, starts, ends), np.searchsorted(starts, offsets))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[bytes | None]:
    return batch.column(batch.schema.get_field_index(name)).cast(pa.binary()).to_pylist()


def in_blocks(texts: list[bytes | None], limit: int = BLOCK_BYTES) -> Iterator[slice]:
    """Slices of neighbouring texts with about ``limit`` bytes each; a longer text is a slice of its own."""
    begin = size = 0
    for i, text in enumerate(texts):
        size += len(text or b"")
        if size >= limit:
            yield slice(begin, i + 1)
            begin, size = i + 1, 0
    if begin < len(texts):
        yield slice(begin, len(texts))


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned numbers as Spark's signed ones, bit for bit."""
    return x.view(np.int64)
