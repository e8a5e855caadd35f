"""MinHash near-duplicates with circulant signatures.

Two permutations of 0..2**32-1 make all coordinates: the first shuffles the
shingle hashes once, the second is shifted circularly by the number of the
coordinate: h_k(x) = second((first(x) + k) mod 2**32). Bands of coordinates
find candidates and whole shingle sets confirm them; see ``neardup``.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame

from basketry.llm.neardup import Likeness, near_duplicates
from basketry.llm.tokens import U64, groups

U32 = np.uint32


def first(values: np.ndarray) -> np.ndarray:
    """Shingle hashes shuffled into 32 bits."""
    return ((values * U64(0xD1342543DE82EF95)) >> U64(32)).astype(U32)


def second(x: np.ndarray, scratch: np.ndarray) -> np.ndarray:
    """A permutation of 32-bit numbers, in place."""
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(x, U32(shift), out=scratch)
        np.bitwise_xor(x, scratch, out=x)
        np.multiply(x, U32(factor), out=x)
    np.right_shift(x, U32(16), out=scratch)
    return np.bitwise_xor(x, scratch, out=x)


def signatures(values: np.ndarray, offsets: np.ndarray, coordinates: int) -> np.ndarray:
    """One row of coordinates a text; texts without shingles have the largest number throughout."""
    out = np.full((len(offsets) - 1, coordinates), np.iinfo(U32).max, U32)
    base = first(values)
    for a, b in groups(offsets):
        full = np.flatnonzero(offsets[a + 1:b + 1] > offsets[a:b]) + a
        if not len(full):
            continue
        part = base[offsets[a]:offsets[b]]
        starts = offsets[full] - offsets[a]
        x, scratch = np.empty_like(part), np.empty_like(part)
        for k in range(coordinates):
            np.add(part, U32(k), out=x)
            out[full, k] = np.minimum.reduceat(second(x, scratch), starts)
    return out


def near_copies(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every document; see ``neardup.near_duplicates``."""
    return near_duplicates(docs, signatures, like)
