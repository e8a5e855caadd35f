"""Removal of repeated passages by a sparse suffix array.

Every byte is removed that a string of WIDTH bytes covers which also starts
anywhere else, in the same text or another. A suffix array of all positions would
move many times the input, so the suffixes that are sorted are picked by content:
equal windows of WIDTH bytes have their anchor at the same place (see ``anchors``).

``neighbours`` is the sort: Spark samples splitters and deals suffixes into
ranges of their leading bytes, every range is sorted by multikey quicksort (the
characters are the leading eight bytes, then hashes of growing stretches, so that equal stretches stand
together), neighbours are compared, and the last suffix of a range with the first of the next.
It runs three times, each time on what the one before left open:

  segments  all windows with one anchor; equal segments are repeats, segments whose anchors
            agree but whose bytes do not are open
  blocks    BLOCK windows of an open segment, by their distance from the anchor; open if the
            bytes common to all their windows agree
  windows   single windows of open blocks

Bytes are told apart by 128 bits of hashes. Texts move twice: those with open
segments and those of which a part is kept.

Defined results: null text counts as empty; texts shorter than a window lose
nothing. Rows that share id and text are two documents, so both are removed whole
(if a window long). Rows without an id are treated like any other. An empty table gives no rows; only
id and text are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.anchors import WIDTH, leading, segments, substring_hashes
from basketry.llm.common import ranges, strings, whole_text, with_ids
from basketry.llm.tokens import U64, mix, prefix_hashes
from basketry.session import stage

#: Windows in a block.
BLOCK = 16
#: Runs shorter than this are sorted at once.
SMALL = 2048


# the sort -----------------------------------------------------------------------------------------------------------

def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by multikey quicksort: three-way split by one column, the middle goes on with the next column."""
    order = np.arange(len(columns[0]))
    open_ = [(0, len(order), 0)]
    while open_:
        lo, hi, depth = open_.pop()
        if hi - lo < 2 or depth == len(columns):
            continue
        part = order[lo:hi]
        if hi - lo <= SMALL:
            order[lo:hi] = part[np.lexsort([c[part] for c in reversed(columns[depth:])])]
            continue
        values = columns[depth][part]
        pivot = np.sort(values[[0, len(values) // 2, -1]])[1]
        low, high = part[values < pivot], part[values > pivot]
        order[lo:hi] = np.concatenate([low, part[values == pivot], high])
        open_ += [(lo, lo + len(low), depth), (lo + len(low), hi - len(high), depth + 1), (hi - len(high), hi, depth)]
    return order


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One range: rows in order with what they share with their neighbours."""
    held = [b for b in batches if len(b)]
    if not held:
        return
    table = pa.Table.from_batches(held)
    lead, one, two = (table.column(c).to_numpy() for c in ("lead", "k1", "k2"))
    order = multikey_order([lead, one, two])
    lead, one, two = lead[order], one[order], two[order]
    alike = (lead[1:] == lead[:-1]) & (one[1:] == one[:-1])
    equal = alike & (two[1:] == two[:-1])
    no = np.zeros(1, bool)
    same = np.concatenate([no, equal]) | np.concatenate([equal, no])
    border = np.concatenate([no, alike & ~equal]) | np.concatenate([alike & ~equal, no])
    edge = np.zeros(len(order), np.int32)
    edge[0] += 1
    edge[-1] += 2
    out = table.take(pa.array(order)).append_column("same", pa.array(same)).append_column("border", pa.array(border))
    out = out.append_column("part", pa.array(np.full(len(order), TaskContext.get().partitionId(), np.int32)))
    yield from out.append_column("edge", pa.array(edge)).combine_chunks().to_batches(max_chunksize=50_000)


def neighbours(rows: DataFrame, purpose: str) -> DataFrame:
    """Rows with lead, k1, k2 (long) and others, each with two flags, as a written table:

    same    a neighbour in the order has equal lead, k1 and k2
    border  a neighbour has equal lead and k1, but another k2

    ``rows`` is read twice (once for the splitters). Rows equal in all keys may fall into several ranges: the other
    columns break ties. The driver gets the first and last row of each range.
    """
    others = [c for c in rows.columns if c not in ("lead", "k1", "k2")]
    schema = rows.schema.simpleString().removeprefix("struct<").removesuffix(">")
    dealt = rows.repartitionByRange("lead", "k1", "k2", *others).mapInArrow(
        _compare, f"{schema}, same: boolean, border: boolean, part: int, edge: int")
    written = stage(dealt, purpose)
    ends = written.where("edge > 0").select("part", "edge", "lead", "k1", "k2").collect()
    ends = sorted({(r["part"], e, r["lead"], r["k1"], r["k2"]) for r in ends for e in (1, 2) if r["edge"] & e})
    fixes: dict[tuple[int, int], tuple[bool, bool]] = {}
    for a, b in zip(ends, ends[1:]):  # the last of a range beside the first of the next
        if a[1] == 2 and b[1] == 1 and a[2:4] == b[2:4]:
            for part, edge, *_ in (a, b):
                fixes[part, edge] = (a[4] == b[4], a[4] != b[4])
    if not fixes:
        return written.drop("part", "edge")
    spark = rows.sparkSession
    # a row may be both ends of its range
    flags = spark.createDataFrame(
        [(p, e, any(s for s, _ in got), any(b for _, b in got)) for p, e, got in (
            (p, e, [fixes[p, x] for x in (1, 2) if e & x and (p, x) in fixes]) for p, _ in fixes for e in (1, 2, 3)) if got],
        "part int, edge int, same2 boolean, border2 boolean").distinct()
    fixed = written.join(F.broadcast(flags), ["part", "edge"], "left")
    return (fixed.withColumn("same", F.col("same") | F.coalesce("same2", F.lit(False)))
            .withColumn("border", F.col("border") | F.coalesce("border2", F.lit(False))).drop("part", "edge", "same2", "border2"))


# segments -----------------------------------------------------------------------------------------------------------

SEGMENT = [("start", pa.int32()), ("count", pa.int32()), ("offset", pa.int32()), ("lead", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())]
OWN = [("start", pa.int32()), ("end", pa.int32())]
PARTS_DDL = ("n_bytes long, sha string, "
             "segments array<struct<start: int, count: int, offset: int, lead: long, k1: long, k2: long>>, own array<struct<start: int, end: int>>")


def _list(parts: list[list[np.ndarray]], fields: list[tuple[str, pa.DataType]]) -> pa.ListArray:
    """One list of structs a row from that row's columns."""
    ends = np.concatenate([[0], np.cumsum([len(p[0]) for p in parts])]).astype(np.int32)
    columns = [np.concatenate([p[i] for p in parts]) if parts else np.zeros(0) for i in range(len(fields))]
    arrays = [pa.array(c.view(np.int64) if c.dtype == U64 else c).cast(t) for c, (_, t) in zip(columns, fields)]
    return pa.ListArray.from_arrays(ends, pa.StructArray.from_arrays(arrays, fields=[pa.field(*f) for f in fields]))


def _distinct(data: bytes) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """A text's distinct segments, and the windows [start, end) of those that repeat in it."""
    s = segments(data)
    _, first, which, times = np.unique(s.content, return_index=True, return_inverse=True, return_counts=True)
    again = times[which] > 1
    start, end = s.start[again], s.start[again] + s.count[again]
    joins = np.concatenate([[True], start[1:] != end[:-1]]) if len(start) else np.zeros(0, bool)
    opens = np.flatnonzero(joins)
    closes = np.concatenate([opens[1:], [len(start)]])[:len(opens)] - 1
    first.sort()
    return [c[first] for c in s], [start[opens], end[closes]]


def _parts(text: Column) -> Column:
    @F.arrow_udf(PARTS_DDL)
    def run(column: pa.Array) -> pa.Array:
        sizes, shas, found = [], [], []
        for a, b in ranges(column):
            for text in strings(column[a:b]):
                data = text.encode()
                sizes.append(len(data))
                shas.append(hashlib.sha256(data).hexdigest())
                found.append(_distinct(data))
        return pa.StructArray.from_arrays(
            [pa.array(sizes, pa.int64()), pa.array(shas, pa.string()), _list([f[0] for f in found], SEGMENT), _list([f[1] for f in found], OWN)],
            names=["n_bytes", "sha", "segments", "own"])

    return run(text)


def _keyed(docs: DataFrame) -> DataFrame:
    """Text with the key of its row: id and a hash of the text; two hashes where the id is null. ``id`` is the id as it is."""
    text, own = whole_text(), F.col("doc_id").cast("long")
    return docs.select(F.coalesce(own, F.xxhash64(F.lit("no id"), text)).alias("doc_id"), F.xxhash64(text).alias("h"), own.alias("id"), text.alias("text"))


def _texts(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Texts beside the rows of ``wanted`` (doc_id, h and others; one row a key)."""
    ids = wanted.select("doc_id").distinct()
    return with_ids(_keyed(docs), ids, "left_semi").dropDuplicates(["doc_id", "h"]).join(wanted, ["doc_id", "h"])


# blocks and windows -------------------------------------------------------------------------------------------------

def _cut(text: Column, open_: Column) -> Column:
    """Bytes of each open segment (structs with start and count)."""

    @F.arrow_udf("array<binary>")
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        out = []
        for a, b in ranges(texts):
            for text, found in zip(strings(texts[a:b]), lists[a:b].to_pylist()):
                data = text.encode()
                out.append([data[s["start"]:s["start"] + s["count"] + WIDTH - 1] for s in found])
        return pa.array(out, pa.list_(pa.binary()))

    return run(text, open_)


STRETCH = [("start", pa.int32()), ("count", pa.int32()), ("lead", pa.int64()), ("k1", pa.int64()), ("k2", pa.int64())]
STRETCH_DDL = "array<struct<start: int, count: int, lead: long, k1: long, k2: long>>"


def _blocks(data: bytes, start: int, count: int, offset: int) -> list[np.ndarray]:
    """Blocks of a segment: windows whose distance to the anchor, in units of BLOCK, is the same."""
    raw = np.frombuffer(data, np.uint8)
    prefix = prefix_hashes(raw)
    number = (offset - np.arange(count)) // BLOCK
    first = np.flatnonzero(np.concatenate([[True], number[1:] != number[:-1]]))
    size = np.diff(np.concatenate([first, [count]]))
    number = number[first]
    # bytes that every window of the block covers, were it whole: its nearest window begins, its furthest ends them
    near = np.clip(offset - number * BLOCK, 0, None)
    far = offset - (number * BLOCK + BLOCK - 1) + WIDTH
    core = mix(substring_hashes(prefix, near, far) + number.astype(U64))
    full = mix(substring_hashes(prefix, first, first + size + WIDTH - 1) ^ mix((offset - first).astype(U64)) ^ size.astype(U64))
    return [first + start, size, leading(raw, near), core, full]


def _windows(data: bytes, base: int, start: int, count: int) -> list[np.ndarray]:
    """Single windows [start, start + count) of a segment that begins at ``base``."""
    raw = np.frombuffer(data, np.uint8)[start - base:start - base + count + WIDTH - 1]
    at = np.arange(count)
    hashes = substring_hashes(prefix_hashes(raw), at, at + WIDTH)
    return [at + start, np.ones(count, np.int64), leading(raw, at), hashes, np.zeros(count, U64)]


def _stretches(cut, *columns: Column) -> Column:
    """List of stretches that ``cut`` makes of a row."""

    @F.arrow_udf(STRETCH_DDL)
    def run(*arrays: pa.Array) -> pa.Array:
        return _list([cut(*row) for row in zip(*(a.to_pylist() for a in arrays))], STRETCH)

    return run(*columns)


def _exploded(rows: DataFrame, list_: Column, *keys: str) -> DataFrame:
    return rows.select(*keys, F.explode(list_).alias("s")).select(*keys, "s.*")


# the operator -------------------------------------------------------------------------------------------------------

def repeated_windows(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Windows that start anywhere else too: doc_id, h, start, end (of window starts, end exclusive)."""
    key = ("doc_id", "h")
    interval = [*key, F.col("start"), (F.col("start") + F.col("count")).alias("end")]
    own = _exploded(parts, F.col("own"), *key)

    whole = neighbours(_exploded(parts, F.col("segments"), *key), "suffix-segments")
    wanted = whole.where("border").groupBy(*key).agg(F.collect_list(F.struct("start", "count", "offset")).alias("open"))
    cut = _texts(docs, stage(wanted, "suffix-open")).select(*key, F.arrays_zip("open", _cut(F.col("text"), F.col("open")).alias("data")).alias("z"))
    pieces = stage(cut.select(*key, F.explode("z").alias("z")).select(
        *key, F.col("z.open.start").alias("base"), F.col("z.open.count").alias("size"), F.col("z.open.offset").alias("offset"),
        F.col("z.data").alias("data")), "suffix-pieces")

    blocks = _exploded(pieces, _stretches(_blocks, *map(F.col, ("data", "base", "size", "offset"))), *key, "base")
    middle = neighbours(stage(blocks, "suffix-block-keys"), "suffix-blocks")

    open_ = middle.where("border").select(*key, "base", "start", "count")
    windows = _exploded(open_.join(pieces, [*key, "base"]), _stretches(_windows, *map(F.col, ("data", "base", "start", "count"))), *key)
    last = neighbours(stage(windows, "suffix-window-keys"), "suffix-windows")

    found = [rows.where("same").select(interval) for rows in (whole, middle, last)]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(own)


MERGED_DDL = "n_removed long, n_spans long, runs array<struct<start: int, end: int>>"


def _merged(spans: Column) -> Column:
    """Windows [start, end) as runs of covered bytes."""

    @F.arrow_udf(MERGED_DDL)
    def run(column: pa.Array) -> pa.Array:
        at = column.offsets.to_numpy()
        start, end = (column.values.field(i).to_numpy().astype(np.int64) for i in (0, 1))
        runs = [_runs(start[a:b], end[a:b] - 1 + WIDTH) for a, b in zip(at[:-1], at[1:])]
        removed = [int((e - s).sum()) for s, e in runs]
        return pa.StructArray.from_arrays(
            [pa.array(removed, pa.int64()), pa.array([len(s) for s, _ in runs], pa.int64()), _list(runs, OWN)], names=["n_removed", "n_spans", "runs"])

    return run(spans)


def _runs(start: np.ndarray, end: np.ndarray) -> list[np.ndarray]:
    """Intervals merged where they overlap or touch."""
    order = np.argsort(start, kind="stable")
    start, reach = start[order], np.maximum.accumulate(end[order])
    first = np.flatnonzero(np.concatenate([[True], start[1:] > reach[:-1]])) if len(start) else np.zeros(0, np.int64)
    last = np.concatenate([first[1:], [len(start)]])[:len(first)] - 1
    return [start[first], reach[last]]


def kept_bytes(data: bytes, runs: list[dict]) -> bytes:
    """The bytes outside of the runs."""
    out, at = [], 0
    for r in runs:
        out.append(data[at:r["start"]])
        at = r["end"]
    return b"".join([*out, data[at:]])


def _kept_sha(text: Column, runs: Column) -> Column:
    @F.arrow_udf("string")
    def run(texts: pa.Array, lists: pa.Array) -> pa.Array:
        return pa.array([
            hashlib.sha256(kept_bytes(t.encode(), r)).hexdigest()
            for a, b in ranges(texts) for t, r in zip(strings(texts[a:b]), lists[a:b].to_pylist())], pa.string())

    return run(text, runs)


def removed_runs(docs: DataFrame, parts: DataFrame) -> DataFrame:
    """Covered bytes of the documents that have any: doc_id, h, n_removed, n_spans, runs; as a written table."""
    spans = repeated_windows(docs, parts).groupBy("doc_id", "h").agg(F.collect_list(F.struct("start", "end")).alias("spans"))
    return stage(spans.select("doc_id", "h", _merged(F.col("spans")).alias("m")).select("doc_id", "h", "m.*"), "suffix-runs")


def report(docs: DataFrame) -> DataFrame:
    """One row a document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    parts = stage(_keyed(docs).select("doc_id", "h", "id", _parts(F.col("text")).alias("p")).select("doc_id", "h", "id", "p.*"), "suffix-parts")
    runs = removed_runs(docs, parts)
    sizes = parts.select("doc_id", "h", "n_bytes").distinct()
    partly = stage(runs.join(sizes, ["doc_id", "h"]).where("n_removed < n_bytes").select("doc_id", "h", "runs"), "suffix-partly")
    kept = _texts(docs, partly).select("doc_id", "h", _kept_sha(F.col("text"), F.col("runs")).alias("kept"))
    found = parts.select("doc_id", "h", "id", "n_bytes", "sha").join(runs.drop("runs"), ["doc_id", "h"], "left").join(kept, ["doc_id", "h"], "left")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    return found.select(
        F.col("id").alias("doc_id"), "n_bytes", F.coalesce("n_removed", F.lit(0)).alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).alias("n_spans"),
        F.coalesce("kept", F.when(F.col("n_removed").isNull(), F.col("sha")).otherwise(nothing)).alias("kept_sha256"))
