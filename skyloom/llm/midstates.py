"""SHA-256 of many messages at once, in numpy, with states that can be stored, copied and resumed.

A digest as hex text has 64 bytes, which is one block of SHA-256.  A hash of digests is therefore a chain of
block steps, and the state between two of them is eight words: it says all about what came before.
"""

from math import isqrt

import numpy as np

WORDS = 8
DIGEST_BYTES = 32


def _primes(n: int) -> list[int]:
    found: list[int] = []
    x = 2
    while len(found) < n:
        if all(x % p for p in found):
            found.append(x)
        x += 1
    return found


def _cube_root(x: int) -> int:
    low, high = 0, 1 << -(-x.bit_length() // 3)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if middle**3 <= x else (low, middle - 1)
    return low


# The rule of the standard: 32 bits of the fractions of square and cube roots of the first primes.
START = np.array([isqrt(p << 64) & 0xFFFFFFFF for p in _primes(8)], np.uint32)
ROUNDS = [np.uint32(_cube_root(p << 96) & 0xFFFFFFFF) for p in _primes(64)]


def _turned(x: np.ndarray, n: int) -> np.ndarray:
    return (x >> np.uint32(n)) | (x << np.uint32(32 - n))


def start(n: int) -> np.ndarray:
    """The state before anything was read, n times."""
    return np.tile(START, (n, 1))


def step(states: np.ndarray, blocks: np.ndarray) -> np.ndarray:
    """States (n x 8) after one more block (n x 16 words) each."""
    if not len(states):
        return states.copy()
    w = [np.ascontiguousarray(blocks[:, i]) for i in range(16)]
    for i in range(16, 64):
        a, b = w[i - 15], w[i - 2]
        w.append(
            w[i - 16] + w[i - 7]
            + (_turned(a, 7) ^ _turned(a, 18) ^ (a >> np.uint32(3)))
            + (_turned(b, 17) ^ _turned(b, 19) ^ (b >> np.uint32(10)))
        )
    a, b, c, d, e, f, g, h = (np.ascontiguousarray(states[:, i]) for i in range(WORDS))
    for constant, word in zip(ROUNDS, w, strict=True):
        one = h + (_turned(e, 6) ^ _turned(e, 11) ^ _turned(e, 25)) + (g ^ (e & (f ^ g))) + word + constant
        two = (_turned(a, 2) ^ _turned(a, 13) ^ _turned(a, 22)) + ((a & b) | (c & (a | b)))
        a, b, c, d, e, f, g, h = one + two, a, b, c, d + one, e, f, g
    return states + np.stack([a, b, c, d, e, f, g, h], axis=1)


def hex_blocks(digests: np.ndarray) -> np.ndarray:
    """Digests (n x 8 words) as blocks of their hex text (n x 16 words)."""
    raw = np.ascontiguousarray(digests.astype(">u4")).view(np.uint8).reshape(len(digests), DIGEST_BYTES)
    nibbles = np.stack([raw >> 4, raw & 15], axis=2).reshape(len(digests), 2 * DIGEST_BYTES)
    text = np.where(nibbles < 10, nibbles + 48, nibbles + 87).astype(np.uint8)
    return text.view(">u4").astype(np.uint32)


def finish(states: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Digests of messages that ended after ``count`` whole blocks."""
    closing = np.zeros((len(states), 16), np.uint32)
    closing[:, 0] = 0x80000000
    bits = count.astype(np.uint64) * np.uint64(512)
    closing[:, 14] = (bits >> np.uint64(32)).astype(np.uint32)
    closing[:, 15] = bits.astype(np.uint32)
    return step(states, closing)


def from_bytes(raw: bytes | memoryview, n: int) -> np.ndarray:
    return np.frombuffer(raw, ">u4", n * WORDS).astype(np.uint32).reshape(n, WORDS)


def to_bytes(words: np.ndarray) -> np.ndarray:
    """Words (n x 8) as n x 32 bytes."""
    return np.ascontiguousarray(words.astype(">u4")).view(np.uint8).reshape(len(words), DIGEST_BYTES)
