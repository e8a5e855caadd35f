"""Packing documents into sequences of CAPACITY tokens by cutting-stock column generation.

Every document becomes ids and an end mark. Full stretches of CAPACITY ids are sequences of their own; what is left over,
the tail, is an item. Items are counted by their length in units of GRAIN tokens. A linear program over patterns
(numbers of items of each length that fill a sequence) makes as many full sequences as the histogram allows: a knapsack
dynamic program finds the pattern that gains most at the present prices, until none gains. The solution is rounded down,
then patterns are used once more as long as their items are there.

Items are ranked within their length; pattern runs own ranges of ranks, so an item finds its sequence by one look into the plan, which
is bounded by the number of lengths, not of documents. Units are floored, so a sequence is full or a little more than full: what
goes beyond CAPACITY is cut off the last, longest item. Cut-off ends and items without a pattern form one stream, cut at every CAPACITY. Only the stream's
last stretch is not full; it is cut into powers of two.

Ids move through one shuffle at most (two bytes an id), and only the digests of cut tails need them.

Defined results: null text counts as empty and gives one piece, the end mark. Repeated rows and rows without or with equal ids are documents each. An
empty table gives no rows. Columns other than id and text are not read.
"""

from __future__ import annotations

import os
import re
import zlib
from array import array
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketry.llm.common import ranges, strings, whole_text
from basketry.session import stage

CAPACITY, GRAIN, END = 4096, 16, 2
#: Most steps of the linear program; any step leaves a feasible plan.
STEPS = 3_000
#: The program ends when no pattern can gain this share of a sequence.
GAIN = 1e-4
#: Pieces, and their characters, that a worker remembers (no effect on results).
CHUNKS, CHARACTERS = 1_200_000, 1 << 25
#: Characters taken up at once.
GROUP = 1 << 18

Batches = Iterator[pa.RecordBatch]
Pattern = tuple[tuple[int, int], ...]


# tokens ---------------------------------------------------------------------------------------------------------------

#: The vocabulary's words in lower-case text of Latin-1 characters: endings, letters, single digits, runs of anything else but white space.
_LETTERS, _DIGITS, _SPACES = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff", "0-9\xb2\xb3\xb9\xbc-\xbe", "\t-\r \x85\xa0"
WORD = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{_LETTERS}]+|[{_DIGITS}]|[^{_SPACES}{_LETTERS}{_DIGITS}]+")
SPECIAL = "<|"
#: Byte-level vocabularies write each byte as a visible character: itself, or the next one from 256 on.
_SELF = [*range(33, 127), *range(161, 173), *range(174, 256)]
VISIBLE = {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_SELF)))}


def latin(text: str) -> bool:
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Chunks:
    """Ids of whole texts from a table of the pieces that are tokenised one by one.

    Texts of Latin-1 characters are cut into lower-case words the way the vocabulary does it. All other texts, and those that may hold a
    special token, are cut at spaces and line ends, which no token and no normalisation crosses. The library gives the ids of a piece, once: of a word
    by its model alone, of a chunk by all its steps.
    """

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.size = self.library.get_vocab_size()
        self.table, self.characters = {"": b""}, 0

    def _learn(self, words: set[str], chunks: set[str]) -> None:
        if len(self.table) > CHUNKS or self.characters > CHARACTERS:
            self.table, self.characters = {"": b""}, 0
        chunks = list(chunks - words)
        tokenize = self.library.model.tokenize
        for w in words:
            self.table[w] = array("I", [t.id for t in tokenize(w if w.isascii() and w.isprintable() else w.encode().decode("latin-1").translate(VISIBLE))]).tobytes()
        self.table.update(zip(chunks, (array("I", e.ids).tobytes() for e in self.library.encode_batch_fast(chunks, add_special_tokens=False))))
        self.characters += sum(map(len, words)) + sum(map(len, chunks))

    def encode(self, texts: list[str]) -> Iterator[bytes]:
        """Little-endian 32-bit ids of each text; texts are taken up in groups of about GROUP characters."""
        group, size = [], 0
        for text in texts:
            group.append(text)
            size += len(text)
            if size >= GROUP:
                yield from self._group(group)
                group, size = [], 0
        yield from self._group(group)

    def _group(self, texts: list[str]) -> Iterator[bytes]:
        plain = [SPECIAL not in t and latin(t) for t in texts]
        cut = [WORD.findall(t.lower()) if p else t.replace("\n", " ").split(" ") for t, p in zip(texts, plain)]
        rows = [list(map(self.table.get, pieces)) for pieces in cut]
        new: tuple[set[str], set[str]] = set(), set()
        for pieces, row, p in zip(cut, rows, plain):
            if None in row:
                new[not p].update(c for c, known in zip(pieces, row) if known is None)
        self._learn(*new)
        for pieces, row in zip(cut, rows):
            yield b"".join(row) if None not in row else b"".join([self.table[c] if known is None else known for c, known in zip(pieces, row)])


@lru_cache(maxsize=2)
def chunks_of(path: str) -> Chunks:
    return Chunks(path)


TOKENS_DDL = "row long, doc_id long, doc_tokens long, crcs array<long>, block_at long, tail binary, tail_length int, tail_crc long, units int, rank long, part int"


def _tokenised(path: str, capacity: int, grain: int, end: int) -> Callable[[Batches], Batches]:
    """Documents with digests of their full stretches, their tail, and running numbers of both within the task."""

    def run(batches: Batches) -> Batches:
        own, part, row, blocks, ranks = chunks_of(path), TaskContext.get().partitionId(), 0, 0, Counter()
        mark = np.array([end], "<u4").tobytes()
        kind = "<u2" if max(own.size, end + 1) <= 1 << 16 else "<u4"
        for batch in batches:
            for a, b in ranges(batch.column("text")):
                out: list[tuple] = []
                for doc_id, ids in zip(batch.column("doc_id")[a:b].to_pylist(), own.encode(strings(batch.column("text")[a:b]))):
                    ids += mark
                    n = len(ids) // 4
                    full = n // capacity
                    crcs = [zlib.crc32(ids[4 * capacity * i:4 * capacity * (i + 1)]) for i in range(full)]
                    tail = ids[4 * capacity * full:]
                    units = len(tail) // 4 // grain
                    out.append((
                        (part << 33) + row, doc_id, n, crcs, blocks, np.frombuffer(tail, "<u4").astype(kind).tobytes(), len(tail) // 4, zlib.crc32(tail), units, ranks[units], part))
                    row, blocks = row + 1, blocks + full
                    ranks[units] += bool(tail)
                kinds = [pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.int64(), pa.binary(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int32()]
                names = [c.split()[0] for c in TOKENS_DDL.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names=names)

    return run


def tokens(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN, end: int = END) -> DataFrame:
    """A written table of the tokenised documents."""
    columns = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))
    return stage(columns.mapInArrow(_tokenised(tokenizer, capacity, grain, end), TOKENS_DDL), "packing-tokens")


# plan -----------------------------------------------------------------------------------------------------------------

def cheapest_fill(sizes: np.ndarray, prices: np.ndarray, capacity: int) -> np.ndarray | None:
    """Numbers of items of each size (ascending) that fill the capacity at the least price, or None if nothing fills it."""
    best, last = np.full(capacity + 1, np.inf), np.zeros(capacity + 1, np.int64)
    best[0] = 0
    for c in range(1, capacity + 1):
        k = int(np.searchsorted(sizes, c, side="right"))
        if k:
            price = best[c - sizes[:k]] + prices[:k]
            last[c] = k - 1 - int(price[::-1].argmin())  # of equal prices the larger item
            best[c] = price[last[c]]
    if not np.isfinite(best[capacity]):
        return None
    taken, c = np.zeros(len(sizes)), capacity
    while c:
        taken[last[c]] += 1
        c -= int(sizes[last[c]])
    return taken


def fractional(sizes: np.ndarray, demand: np.ndarray, capacity: int) -> list[tuple[np.ndarray, float]]:
    """Patterns and how often each is used in the linear program that fills the most sequences within the demand."""
    m = len(sizes)
    inverse, value, gain = np.eye(m), demand.astype(float), np.zeros(m)
    basis: list[np.ndarray | None] = [None] * m  # None: items left over
    for _ in range(STEPS):
        prices = gain @ inverse
        low = int(prices.argmin()) if m else 0
        if m and prices[low] < -1e-9:  # leaving items of this length over gains
            column, pattern, worth = np.eye(m)[low], None, 0.0
        else:
            column = pattern = cheapest_fill(sizes, np.maximum(prices, 0), capacity)
            worth = 1.0
            if pattern is None or 1 - prices @ pattern <= GAIN:
                break
        direction = inverse @ column
        can = direction > 1e-9
        if not can.any():
            break
        ratio = np.where(can, value / np.where(can, direction, 1), np.inf)
        out = int(ratio.argmin())
        step = max(0.0, ratio[out])
        value = np.maximum(value - step * direction, 0)
        value[out], gain[out], basis[out] = step, worth, pattern
        pivot = inverse[out] / direction[out]
        inverse -= np.outer(direction, pivot)
        inverse[out] = pivot
    return [(p, float(v)) for p, v in zip(basis, value) if p is not None and v > 1e-9]


def plan(demand: dict[int, int], capacity: int) -> list[tuple[Pattern, int]]:
    """Whole patterns ((size, number), ...) and how often each is used; never more items than there are."""
    sizes = np.array(sorted(demand), np.int64)
    left = np.array([demand[int(s)] for s in sizes], np.int64)
    uses: list[list] = []
    for pattern, times in sorted(fractional(sizes, left, capacity), key=lambda x: x[1] % 1, reverse=True):
        whole = min(int(times + 1e-6), *(int(n // a) for n, a in zip(left, pattern) if a))
        left = left - whole * pattern.astype(np.int64)
        uses.append([pattern.astype(np.int64), whole])
    for use in uses:  # once more where the items are there
        if (use[0] <= left).all():
            left, use[1] = left - use[0], use[1] + 1
    return [(tuple((int(s), int(a)) for s, a in zip(sizes, p) if a), n) for p, n in uses if n]


def _seats(uses: list[tuple[Pattern, int]]) -> tuple[np.ndarray, ...]:
    """By length and rank: where a run of ranks begins and ends, items a sequence, its first sequence and slot. The longest item comes last."""
    rows, taken, first = [], Counter(), 0
    for pattern, times in uses:
        slot = 0
        for size, number in pattern:
            rows.append((size, taken[size], taken[size] + number * times, number, first, slot))
            taken[size] += number * times
            slot += number
        first += times
    rows.sort()
    return tuple(np.array([r[i] for r in rows], np.int64) for i in range(6))


def _seat(units: Column, rank: Column, uses: list[tuple[Pattern, int]]) -> Column:
    """Struct of the sequence and slot of an item; nulls for items without a pattern."""
    size, start, stop, number, first, slot = _seats(uses)
    width = 1 << 40  # ranks of one length
    edges = size * width + start

    @F.arrow_udf("sequence_id long, slot int")
    def run(us: pa.Array, rs: pa.Array) -> pa.Array:
        u, r = us.to_numpy(zero_copy_only=False).astype(np.int64), rs.to_numpy(zero_copy_only=False)
        if not len(edges):
            seq, at, no = np.zeros(len(u), np.int64), np.zeros(len(u), np.int32), np.ones(len(u), bool)
        else:
            i = np.maximum(np.searchsorted(edges, u * width + r, side="right") - 1, 0)
            no = (size[i] != u) | (r < start[i]) | (r >= stop[i])
            seq = first[i] + (r - start[i]) // number[i]
            at = (slot[i] + (r - start[i]) % number[i]).astype(np.int32)
        return pa.StructArray.from_arrays([pa.array(seq, pa.int64(), mask=no), pa.array(at, pa.int32(), mask=no)], names=["sequence_id", "slot"])

    return run(units, rank)


# pieces ---------------------------------------------------------------------------------------------------------------

def _running(batches: Batches) -> Batches:
    """Rows with the task's number and the lengths before them in the task."""
    part, total = TaskContext.get().partitionId(), 0
    for batch in batches:
        length = batch.column("length").to_numpy(zero_copy_only=False)
        ends = np.cumsum(length) + total
        total = int(ends[-1]) if len(ends) else total
        yield batch.append_column("part", pa.array(np.full(len(ends), part, np.int32))).append_column("before", pa.array(ends - length, pa.int64()))


def _offsets(totals: list[tuple[int, int]]) -> dict[int, int]:
    """What stands before each task, from the total of each."""
    out, at = {}, 0
    for part, n in sorted(totals):
        out[part] = at
        at += n
    return out


def _by_part(df: DataFrame, name: str, offsets: dict[int, int]) -> DataFrame:
    """Rows with the offset of their task; one entry a task is sent."""
    table = df.sparkSession.createDataFrame(sorted(offsets.items()) or [(-1, 0)], f"part int, {name} long")
    return df.join(F.broadcast(table), "part")


def _stretches(total: int, capacity: int, first: int) -> tuple[int, list[tuple[int, int, int]]]:
    """Full stretches of a stream, and the pieces (from, to, sequence) of its last one: powers of two."""
    full = total // capacity
    at, out = full * capacity, []
    for bit in range(capacity.bit_length(), -1, -1):
        if (total - full * capacity) >> bit & 1:
            out.append((at, at + (1 << bit), first + full + len(out)))
            at += 1 << bit
    return full, out


def pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, grain: int = GRAIN, end: int = END) -> DataFrame:
    """One row a piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset."""
    return _placed(tokens(docs, tokenizer, capacity, grain, end), capacity, grain).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def _placed(table: DataFrame, capacity: int, grain: int) -> DataFrame:
    """The pieces of a table of tokens, with the row they come from."""
    items = table.where("tail_length > 0").select(
        "row", "doc_id", "doc_tokens", F.col("tail_length").cast("long").alias("tail_length"), "tail_crc", "units", "rank", "part")

    # ranks within a length over all tasks: counts a task and length, added up
    counts = stage(items.groupBy("units", "part").agg(F.count("*").alias("n")), "packing-histogram")
    demand = {r["units"]: r["n"] for r in counts.where("units > 0").groupBy("units").agg(F.sum("n").alias("n")).collect()}  # at most capacity / grain rows
    uses = plan(demand, capacity // grain)
    before = F.sum("n").over(Window.partitionBy("units").orderBy("part")) - F.col("n")
    ranked = items.join(counts.select("units", "part", before.alias("before")), ["units", "part"]).withColumn("rank", F.col("rank") + F.col("before"))
    seated = ranked.select("row", "doc_id", "doc_tokens", "tail_length", "tail_crc", _seat(F.col("units"), F.col("rank"), uses).alias("seat"))
    seated = stage(seated.select("*", "seat.*").drop("seat"), "packing-seats")

    # sequences of whole items; what goes beyond the capacity is cut off
    in_order = Window.partitionBy("sequence_id").orderBy("slot")
    upto = F.sum("tail_length").over(in_order)
    filled = seated.where("sequence_id is not null").withColumn("offset", upto - F.col("tail_length"))
    fits = F.greatest(F.least(F.col("tail_length"), F.lit(capacity) - F.col("offset")), F.lit(0))
    filled = stage(filled.withColumn("fits", fits.cast("long")), "packing-filled")
    base = ["row", "doc_id", "doc_tokens", "tail_length", "tail_crc"]
    whole = filled.where("fits > 0").select(*base, F.lit(0).cast("long").alias("from"), F.col("fits").alias("length"), "sequence_id", "offset")

    # the stream: cut-off ends and items without a pattern, one behind the other
    over = filled.where("fits < tail_length").select(*base, F.col("fits").alias("from"), (F.col("tail_length") - F.col("fits")).alias("length"))
    alone = seated.where("sequence_id is null").select(*base, F.lit(0).cast("long").alias("from"), F.col("tail_length").alias("length"))
    stream = over.unionByName(alone)
    stream = stage(stream.mapInArrow(_running, f"{_ddl(stream)}, part int, before long"), "packing-stream")
    totals = [(r["part"], r["n"]) for r in stream.groupBy("part").agg(F.sum("length").alias("n")).collect()]  # a number a task
    first = sum(n for _, n in uses)
    full, last = _stretches(sum(n for _, n in totals), capacity, first)
    lo = F.col("before") + F.col("task_before")
    at = _by_part(stream, "task_before", _offsets(totals)).withColumn("lo", lo).withColumn("hi", lo + F.col("length")).drop("length")
    k = F.explode(F.sequence(F.floor(F.col("lo") / capacity), F.floor((F.col("hi") - 1) / capacity))).alias("k")
    seat = "struct<a: long, b: long, s: long>"
    ends = F.array(*[F.struct(*[F.lit(v).cast("long").alias(c) for c, v in zip("abs", e)]) for e in last]).cast(f"array<{seat}>")
    one = F.array(F.struct((F.col("k") * capacity).alias("a"), ((F.col("k") + 1) * capacity).alias("b"), (F.col("k") + first).alias("s"))).cast(f"array<{seat}>")
    cut = at.select("*", k).withColumn("e", F.explode(F.when(F.col("k") < full, one).otherwise(ends))).where("e.a < hi and e.b > lo")
    a, b = F.greatest("lo", "e.a"), F.least("hi", "e.b")
    streamed = cut.select(*base, (F.col("from") + a - F.col("lo")).alias("from"), (b - a).alias("length"), F.col("e.s").alias("sequence_id"), (a - F.col("e.a")).alias("offset"))

    parts = stage(whole.unionByName(streamed), "packing-parts")
    uncut = parts.where("length = tail_length").withColumn("ids_crc32", F.col("tail_crc"))
    ids = table.select(F.col("row"), "tail")
    torn = parts.where("length < tail_length").join(ids, "row").withColumn("ids_crc32", _crc(F.col("tail"), F.col("tail_length"), F.col("from"), F.col("length")))
    tails = uncut.unionByName(torn.drop("tail")).withColumn("start", F.col("doc_tokens") - F.col("tail_length") + F.col("from"))

    # full stretches
    blocks = [(r["part"], r["n"]) for r in table.groupBy("part").agg(F.sum(F.size("crcs")).cast("long").alias("n")).collect()]  # a number a task
    many = _by_part(table.where(F.size("crcs") > 0).select("row", "doc_id", "doc_tokens", "part", "block_at", "crcs"), "task_before", _offsets(blocks))
    many = many.select("row", "doc_id", "doc_tokens", (F.col("task_before") + F.col("block_at")).alias("n"), F.posexplode("crcs").alias("i", "ids_crc32"))
    many = many.select(
        "row", "doc_id", (F.col("i").cast("long") * capacity).alias("start"), F.lit(capacity).cast("long").alias("length"), "ids_crc32", "doc_tokens",
        (F.lit(first + full + len(last)) + F.col("n") + F.col("i")).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    return tails.select(many.columns).unionByName(many)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"`{n}` {t}" for n, t in df.dtypes)


def _crc(tail: Column, whole: Column, start: Column, length: Column) -> Column:
    """Digest of some of a tail's ids as 32-bit numbers."""

    @F.arrow_udf("long")
    def run(tails: pa.Array, wholes: pa.Array, starts: pa.Array, lengths: pa.Array) -> pa.Array:
        out = []
        for t, w, s, n in zip(tails, wholes.to_pylist(), starts.to_pylist(), lengths.to_pylist()):
            data = t.as_py()
            ids = np.frombuffer(data, f"<u{len(data) // w}")[s:s + n]
            out.append(zlib.crc32(ids.astype("<u4").tobytes()))
        return pa.array(out, pa.int64())

    return run(tail, whole, start, length)
