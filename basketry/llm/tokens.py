"""Words, shingles and set keys of many texts at once, as numpy arrays.

Texts are UTF-8 bytes. A byte table maps A-Z to a-z and separators to a space;
what is left between spaces are the words. A word's 64-bit hash comes from
prefix sums of a polynomial over its bytes, so a batch costs a handful of
array passes and no Python object per word.
"""

from __future__ import annotations

import numpy as np

U64 = np.uint64
_BASE = U64(0x9E3779B97F4A7C15)
_INVERSE = U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = np.random.default_rng(20240607).integers(1, 1 << 63, 256, dtype=np.uint64)
_BYTES[32] = 0
#: Bytes hashed in one pass: the arrays of a pass stay in a core's cache.
BLOCK = 1 << 18

#: Separators of the two word rules: ASCII white space, and all ASCII but letters and digits.
SPACES = b"\x20\x09\x0a\x0b\x0c\x0d"
PUNCTUATION = bytes(b for b in range(128) if not chr(b).isalnum())


def byte_table(separators: bytes) -> bytes:
    """Translation table: A-Z to lower case, separators to a space."""
    table = bytearray(bytes(range(256)).lower())
    for b in separators:
        table[b] = 32
    return bytes(table)


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit permutation that spreads every input bit."""
    x = x ^ (x >> U64(32))
    x = x * U64(0xD6E8FEB86659FD93)
    x ^= x >> U64(29)
    x *= U64(0xA24BAED4963EE407)
    return x ^ (x >> U64(32))


class Powers:
    """base**i and base**-i modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, U64)
        self.down = np.ones(1, U64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up = np.concatenate([np.ones(1, U64), np.full(n, _BASE)]).cumprod(dtype=U64)
            self.down = np.concatenate([np.ones(1, U64), np.full(n, _INVERSE)]).cumprod(dtype=U64)
        return self.up[:n], self.down[:n]


POWERS = Powers()


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """p with len + 1 values; (p[e] - p[s]) * base**-s is the hash of data[s:e]."""
    up, _ = POWERS.upto(len(data) + 1)
    out = np.zeros(len(data) + 1, U64)
    np.cumsum(_BYTES[data] * up[: len(data)], out=out[1:])
    return out


def word_hashes(texts: list[bytes], table: bytes, block: int = BLOCK) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of all texts, and where each text's words begin (one more than texts)."""
    joined = b" ".join(texts).translate(table) + b" "
    data = np.frombuffer(joined, np.uint8)
    begins = np.zeros(len(texts) + 1, np.int64)
    np.cumsum([len(t) + 1 for t in texts], out=begins[1:])
    hashes, places, at = [], [], 0
    while at < len(data):
        end = len(data) if at + block >= len(data) else joined.index(b" ", at + block) + 1
        part = data[at:end]
        inside = np.zeros(len(part) + 1, bool)
        np.not_equal(part, 32, out=inside[1:])
        edges = np.flatnonzero(inside[1:] != inside[:-1])
        first, last = edges[0::2], edges[1::2]
        prefix = prefix_hashes(part)
        hashes.append(mix((prefix[last] - prefix[first]) * POWERS.upto(len(part) + 1)[1][first]))
        places.append(first + at)
        at = end
    if not hashes:
        return np.zeros(0, U64), np.zeros(len(texts) + 1, np.int64)
    place = np.concatenate(places)
    return np.concatenate(hashes), np.searchsorted(place, begins)


def shingles(words: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of k consecutive words; a text of fewer words has one shingle, its whole sequence."""
    counts = np.diff(offsets)
    n = len(words)
    out = np.zeros(n, U64)
    for j in range(min(k, n)):
        out[: n - j] = out[: n - j] * U64(0xC2B2AE3D27D4EB4F) + words[j:]
    out = mix(out)
    valid = np.arange(n) + k <= np.repeat(offsets[1:], counts)
    for d in np.flatnonzero((counts > 0) & (counts < k)):
        s, e = offsets[d], offsets[d + 1]
        h = U64(e - s)
        with np.errstate(over="ignore"):
            for w in words[s:e]:
                h = h * U64(0x165667B19E3779F9) + w
        out[s], valid[s] = mix(np.array([h], U64))[0], True
    kept = np.zeros(n + 1, np.int64)
    np.cumsum(valid, out=kept[1:])
    return out[valid], kept[offsets]


def distinct(values: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's values sorted, repeats dropped."""
    parts = [np.unique(values[s:e]) for s, e in zip(offsets[:-1], offsets[1:])]
    out = np.zeros(len(offsets), np.int64)
    np.cumsum([len(p) for p in parts], out=out[1:])
    return (np.concatenate(parts) if parts else values[:0]), out


def sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each text's values modulo 2**64."""
    prefix = np.zeros(len(values) + 1, U64)
    np.cumsum(values, out=prefix[1:])
    return prefix[offsets[1:]] - prefix[offsets[:-1]]


def groups(offsets: np.ndarray, most: int = 1 << 16) -> list[tuple[int, int]]:
    """Runs of texts with about ``most`` values each, for array passes that fit the cache."""
    out, a = [], 0
    while a < len(offsets) - 1:
        b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + most, side="right")) - 1)
        out.append((a, b))
        a = b
    return out
