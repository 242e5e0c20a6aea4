"""Words of whole texts as hashes, many texts at a time.

A word is a longest run of bytes other than blank, tab, line feed, vertical tab, form feed and carriage return
in the UTF-8 text.  Its hash is a polynomial of its bytes modulo 2^64, mixed with its length; it is read off
prefix sums, so no Python loop runs over words.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
_powers = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def powers(n: int, way: str = "up") -> np.ndarray:
    """BASE (or its inverse) to the powers 0 to n - 1 modulo 2^64."""
    if len(_powers[way]) < n:
        steps = np.full(n, BASE if way == "up" else INVERSE, np.uint64)
        steps[0] = 1
        _powers[way] = np.multiply.accumulate(steps)
    return _powers[way][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread all bits of 64-bit values over each other."""
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts after each other, and where each begins; a null is an empty text."""
    texts = pc.fill_null(texts.cast(pa.large_binary()), b"")
    _, at, data = texts.buffers()
    at = np.frombuffer(at, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[at[0] : at[-1]], at - at[0]


def lowered(data: np.ndarray) -> np.ndarray:
    return data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32)


def word_spans(data: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of each word, and by text the number of words before it."""
    solid = ~((data == 32) | ((data >= 9) & (data <= 13)))
    begins, ends = solid.copy(), solid.copy()
    begins[1:] &= ~solid[:-1]
    ends[:-1] &= ~solid[1:]
    edges = at[1:-1]
    inner = edges[(edges > 0) & (edges < len(data))]
    begins[inner] = solid[inner]
    ends[inner - 1] = solid[inner - 1]
    starts, stops = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return starts, stops, np.searchsorted(starts, at)


def span_hashes(data: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span of bytes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(len(data)), out=sums[1:])
    value = (sums[stops] - sums[starts]) * powers(len(data) + 1, "down")[starts]
    return mix(value + mix((stops - starts).astype(np.uint64)))


def shingles(hashes: np.ndarray, first: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``width`` words, and by text where its runs begin.

    A text with fewer words, but some, has all of them as one run.
    """
    counts = np.diff(first)
    runs = np.where(counts >= width, counts - width + 1, (counts > 0).astype(np.int64))
    where = np.concatenate([[0], np.cumsum(runs)])
    head = np.repeat(first[:-1] - where[:-1], runs) + np.arange(where[-1])
    length = np.repeat(np.minimum(counts, width), runs)
    value = mix(length.astype(np.uint64))
    for k in range(width):
        has = length > k
        step = mix(value * np.uint64(3) + hashes[np.where(has, head + k, 0)]) if len(hashes) else value
        value = np.where(has, step, value)
    return value, where


def distinct_by_text(values: np.ndarray, where: np.ndarray) -> list[np.ndarray]:
    """The sorted distinct values of each text."""
    return [np.unique(values[a:b]) for a, b in zip(where[:-1].tolist(), where[1:].tolist(), strict=True)]
