"""Document fingerprints: MinHash with universal hash permutations.

Coordinate i of a text is the least value of (a_i * x + b_i) mod 2**64 over its
shingle hashes x (32 bits each, the upper half of the result is kept), computed for
whole batches in numpy. A fingerprint is the lower 16 bits of every coordinate
in hex; the likeness of two is the share of equal coordinates.

``near_copies`` joins bands of the same coordinates in Spark and verifies the
Jaccard similarity; see ``neardup``.

``edited_fingerprints`` compares every document with an edited text: its last
half replaced by the beginning of the next document by descending id. Documents are
dealt once into ranges of ids, each with a copy of the document that follows it,
and read in order.

Defined results: null text counts as empty; a text without words has an empty
fingerprint; two empty fingerprints have likeness 1, an empty one and another 0.
Ids that repeat are ordered by a hash of their text; rows without an id come
last. A single document is followed by itself. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.common import ranges, strings, whole_text
from basketry.llm.neardup import Likeness, near_duplicates
from basketry.llm.tokens import U64, groups

COORDINATES = 128
#: Documents in a range of ids, and the most ranges (one number each on the driver).
RANGE, MOST_RANGES = 500, 100_000

_draw = np.random.default_rng(4242)
_A = _draw.integers(1, 1 << 63, 256, dtype=np.uint64) | U64(1)
_B = _draw.integers(0, 1 << 63, 256, dtype=np.uint64)


def signatures(values: np.ndarray, offsets: np.ndarray, coordinates: int) -> np.ndarray:
    """One row of 32-bit coordinates a text; texts without shingles have the largest number throughout."""
    out = np.full((len(offsets) - 1, coordinates), np.iinfo(np.uint32).max, np.uint32)
    base = values >> U64(32)
    for a, b in groups(offsets, 1 << 15):
        full = np.flatnonzero(offsets[a + 1:b + 1] > offsets[a:b]) + a
        if not len(full):
            continue
        part, starts = base[offsets[a]:offsets[b]], offsets[full] - offsets[a]
        x = np.empty_like(part)
        for i in range(coordinates):
            np.multiply(part, _A[i], out=x)
            np.add(x, _B[i], out=x)
            out[full, i] = np.minimum.reduceat(x, starts) >> U64(32)
    return out


def near_copies(docs: DataFrame, like: Likeness = Likeness()) -> DataFrame:
    """doc_id, n_shingles, component_id and kept: groups of documents whose fingerprints share a band and whose sets are alike."""
    return near_duplicates(docs, signatures, like)


def fingerprints(texts: list[str], like: Likeness = Likeness(), coordinates: int = COORDINATES) -> list[str]:
    """Four hex digits a coordinate; empty for a text without words."""
    values, offsets = like.sets(texts)
    low = (signatures(values, offsets, coordinates) & np.uint32(0xFFFF)).astype(">u2")
    return [row.tobytes().hex() if full else "" for row, full in zip(low, np.diff(offsets) > 0)]


def likeness(a: str, b: str) -> float:
    """Share of equal coordinates."""
    if not a or not b:
        return float(a == b)
    x, y = (np.frombuffer(bytes.fromhex(v), ">u2") for v in (a, b))
    return float((x == y).mean())


def fingerprint(text: Column) -> Column:
    """The fingerprint of a text column."""

    @F.arrow_udf("string")
    def run(column: pa.Array) -> pa.Array:
        return pa.array([f for a, b in ranges(column) for f in fingerprints(strings(column[a:b]))], pa.string())

    return run(text)


def edited(text: str, following: str) -> str:
    """The last floor(n/2) code points replaced by the first as many, or all, of the following text."""
    half = len(text) // 2
    return text[:len(text) - half] + following[:half]


def _ranges(docs: DataFrame) -> tuple[list[int], list[int | None]]:
    """Splitters of the ids into ranges of about RANGE rows, and the largest id of each range (None: no rows).

    Range r holds ids in [splitters[r - 1], splitters[r]); rows without an id are in range 0.
    """
    n = docs.count()
    parts = max(1, min(MOST_RANGES, n // RANGE))
    splitters: list[int] = []
    if parts > 1:
        quantiles = [i / parts for i in range(1, parts)]
        splitters = sorted(set(docs.agg(F.percentile_approx("doc_id", quantiles, parts * 20)).first()[0] or []))
    top: list[int | None] = [None] * (len(splitters) + 1)
    for row in docs.groupBy(_range_of(splitters)(F.col("doc_id")).alias("r")).agg(F.max("doc_id").alias("top"), F.count("*").alias("n")).collect():
        top[row["r"]] = row["top"] if row["top"] is not None else _NO_ID
    return splitters, top


#: Stands for the id of rows without one: below all others.
_NO_ID = -(1 << 63)


def _range_of(splitters: list[int]):
    """UDF: the range of an id."""
    edges = np.array(splitters, np.int64)

    @F.arrow_udf("int")
    def run(ids: pa.Array) -> pa.Array:
        return pa.array(np.searchsorted(edges, ids.fill_null(_NO_ID).to_numpy(), side="right").astype(np.int32))

    return run


def _dealt(docs: DataFrame) -> DataFrame:
    """Every document in its range, and the first of each range also at the end of the range before it, as ``guest``.

    Before: larger ids. The range of the largest ids comes before the one of the smallest in a circle.
    """
    splitters, top = _ranges(docs)
    filled = [r for r, t in enumerate(top) if t is not None]
    host = {r: filled[(i + 1) % len(filled)] for i, r in enumerate(filled)}  # where the first document of r is the guest
    edges = np.array(splitters, np.int64)
    tops = np.array([_NO_ID if t is None else t for t in top], np.int64)
    hosts = np.array([host.get(r, -1) for r in range(len(top))], np.int32)
    places = pa.struct([("part", pa.int32()), ("guest", pa.bool_())])

    @F.arrow_udf("array<struct<part: int, guest: boolean>>")
    def place(ids: pa.Array) -> pa.Array:
        own = ids.fill_null(_NO_ID).to_numpy()
        part = np.searchsorted(edges, own, side="right").astype(np.int32)
        first = own == tops[part]
        twice = 1 + first.astype(np.int32)
        offsets = np.concatenate([[0], np.cumsum(twice)]).astype(np.int32)
        rows = np.repeat(part, twice)
        guest = np.zeros(len(rows), bool)
        guest[offsets[1:][first] - 1] = True
        rows[guest] = hosts[part[first]]
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(rows), pa.array(guest)], fields=list(places)))

    rows = docs.select("doc_id", "text", place(F.col("doc_id")).alias("places"))
    return rows.select("doc_id", "text", F.explode("places").alias("p")).select("p.part", "p.guest", "doc_id", "text")


RESULT = pa.schema([
    ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
    ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())])
RESULT_DDL = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
              "near_edited double, near_next double")


def _compared(rows: list[tuple]) -> pa.RecordBatch:
    """Rows of (doc_id, text, following text) with their fingerprints."""
    texts = [t for _, t, _ in rows]
    edits = [edited(t, f) for _, t, f in rows]
    prints = fingerprints(texts + edits + [f for _, _, f in rows])
    own, other, following = prints[:len(rows)], prints[len(rows):2 * len(rows)], prints[2 * len(rows):]
    columns = [
        [i for i, _, _ in rows], [len(t) for t in texts], [hashlib.sha256(e.encode()).hexdigest() for e in edits], own, other,
        [likeness(a, b) for a, b in zip(own, other)], [likeness(a, b) for a, b in zip(own, following)]]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT)], schema=RESULT)


def _read_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by part, guests last, ids descending: each document meets the one after it."""
    held: tuple | None = None  # the last document that waits for its successor: part, id, text
    ready: list[tuple] = []
    for batch in batches:
        for part, guest, doc_id, text in zip(*(batch.column(c).to_pylist() for c in ("part", "guest", "doc_id", "text"))):
            if held is not None and held[0] == part:
                ready.append((held[1], held[2], text))
            held = None if guest else (part, doc_id, text)
            if len(ready) >= 256:
                yield _compared(ready)
                ready = []
    if ready:
        yield _compared(ready)


def edited_fingerprints(docs: DataFrame) -> DataFrame:
    """Fingerprints of every text and of its edited text, and their likeness; see the module's text."""
    docs = docs.select("doc_id", whole_text().alias("text"))
    tie = F.xxhash64("text")
    rows = (_dealt(docs).repartition("part")
            .sortWithinPartitions("part", "guest", F.col("doc_id").desc_nulls_last(), tie, "text"))
    return rows.mapInArrow(_read_in_order, RESULT_DDL)
