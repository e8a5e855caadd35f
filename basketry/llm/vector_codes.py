"""Vector code compression: a codebook for every position of a vector, fitted by member-resident Lloyd rounds.

A vector of floats becomes integers floor(SCALE * x) and is cut into POSITIONS equal consecutive parts. A part
lives with the owner of its position and entry: rows are partitioned by (position, entry, salt). In every round
owners add up their resident members to move their entries, resident parts are compared with the moved
codebook where they are, and only those that change entry travel to their new owner; the others are never
shuffled again. The salts of an owner follow the number of its members, so an entry that holds most parts is
dealt over as many tasks as its share asks for. Only codebooks (at most 256 entries of one vector's length in all)
and one count an entry come to the driver.

Defined results: vectors that are null or hold null or non-finite components are dropped. Components are cut off at
2**25 (values of 32,768), where squares stay exact. Vectors of other lengths, and lengths that cannot be cut evenly, are filled up with zeros to the
longest length; empty vectors are all zeros. The codebook starts from the least ids, repeated ids in the order
of their vectors, rows without id last; with fewer rows than entries the codebook is as short. Repeated rows are coded each.
Labels may be null; nulls are one label. An empty table gives no rows. Columns other than id, vector and label are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import stage

POSITIONS, ENTRIES, ROUNDS, SCALE = 4, 256, 4, 1024
#: Components beyond this are cut off.
LARGEST = 1 << 25
#: Rows compared with a codebook at once.
ROWS = 4096

Batches = Iterator[pa.RecordBatch]


@dataclass(frozen=True)
class Codebooks:
    """Integer entries by position, entry and component."""

    entries: np.ndarray

    @property
    def digest(self) -> str:
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def nearest(self, position: int, parts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each part, ties to the lower one, and its squared distance."""
        book = self.entries[position]
        # every sum below is exact in floats as long as it stays under 2**53
        most = max(np.abs(book).max(initial=0), np.abs(parts).max(initial=0))
        kind = np.float64 if 4 * float(most) ** 2 * max(1, book.shape[1]) < 2**53 else np.int64
        book, parts = book.astype(kind), parts.astype(kind)
        own = (book * book).sum(1)
        entry, error = np.zeros(len(parts), np.int32), np.zeros(len(parts), np.int64)
        for a in range(0, len(parts), ROWS):
            x = parts[a:a + ROWS]
            distance = (x * x).sum(1)[:, None] - 2 * (x @ book.T) + own
            best = distance.argmin(1)
            entry[a:a + ROWS] = best
            error[a:a + ROWS] = distance[np.arange(len(x)), best]
        return entry, error


def usable(vector: Column) -> Column:
    """True for vectors whose components are all finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & F.coalesce(finite, F.lit(False))


def integers(vector: Column, scale: int = SCALE) -> Column:
    def whole(x: Column) -> Column:
        return F.floor(F.greatest(F.least(x.cast("double") * scale, F.lit(float(LARGEST))), F.lit(float(-LARGEST)))).cast("int")

    return F.transform(vector, whole)


def _matrix(column: pa.ListArray, width: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), width)


def _assigned(books: Codebooks) -> Callable[[Batches], Batches]:
    """Parts with the entry they had (was), the nearest one now and its squared distance."""

    def run(batches: Batches) -> Batches:
        width = books.entries.shape[2]
        for batch in batches:
            position = batch.column("position").to_numpy()
            parts = _matrix(batch.column("part"), width)
            entry, error = np.zeros(len(parts), np.int32), np.zeros(len(parts), np.int64)
            for p in np.unique(position):
                at = np.flatnonzero(position == p)
                entry[at], error[at] = books.nearest(int(p), parts[at])
            columns = {n: batch.column(n) for n in ("row", "vec_id", "label", "position", "part")}
            yield pa.RecordBatch.from_pydict(
                columns | {"was": batch.column("entry"), "entry": pa.array(entry), "error": pa.array(error)})

    return run


def _sums(batches: Batches) -> Batches:
    """What a task's resident members add up to: one row a position and entry."""
    total: dict[tuple[int, int], tuple[int, np.ndarray]] = {}
    for batch in batches:
        if not len(batch):
            continue
        key = batch.column("position").to_numpy() * np.int64(1 << 32) + batch.column("entry").to_numpy()
        parts = _matrix(batch.column("part"), len(batch.column("part").flatten()) // len(batch))
        order = np.argsort(key, kind="stable")
        starts = np.flatnonzero(np.diff(key[order], prepend=-1))
        added = np.add.reduceat(parts[order], starts, axis=0) if parts.shape[1] else np.zeros((len(starts), 0), np.int64)
        for k, n, s in zip(key[order][starts].tolist(), np.diff([*starts, len(key)]).tolist(), added):
            members, so_far = total.get(owner := (k >> 32, k & 0xFFFFFFFF), (0, 0))
            total[owner] = members + n, so_far + s
    if total:
        yield pa.RecordBatch.from_pydict({
            "position": pa.array([p for p, _ in total], pa.int32()), "entry": pa.array([e for _, e in total], pa.int32()),
            "n": pa.array([n for n, _ in total.values()], pa.int64()), "sums": pa.array([s.tolist() for _, s in total.values()], pa.list_(pa.int64()))})


def _moved(resident: DataFrame, books: Codebooks) -> Codebooks:
    """Each entry at the floored mean of its members; entries without members stay."""
    width = books.entries.shape[2]
    each = resident.select("position", "entry", "part").mapInArrow(_sums, "position int, entry int, n long, sums array<long>")
    entries = books.entries.copy()
    totals = each.groupBy("position", "entry").agg(F.sum("n").alias("n"), *[F.sum(F.col("sums")[i]).alias(f"s{i}") for i in range(width)])
    for r in totals.collect():  # at most one row an entry
        entries[r["position"], r["entry"]] = [r[f"s{i}"] // r["n"] for i in range(width)]
    return Codebooks(entries)


class _Members:
    """The parts, each with its owner: those that stayed in the last round, and those that travelled."""

    def __init__(self, parts: DataFrame, n_parts: int) -> None:
        spark = parts.sparkSession
        self.resident, self.label = parts.withColumn("entry", F.lit(-1)), parts.schema["label"].dataType.simpleString()
        #: Members that share a salt: a fraction of what a task gets on average.
        self.share = max(1, n_parts // (4 * int(spark.conf.get("spark.sql.shuffle.partitions"))))

    def assigned(self, books: Codebooks) -> DataFrame:
        return self.resident.mapInArrow(
            _assigned(books), f"row long, vec_id long, label {self.label}, position int, part array<int>, was int, entry int, error long")

    def migrate(self, books: Codebooks) -> None:
        """Compare where the parts are; send those that change entry to their new owners."""
        now = stage(self.assigned(books).drop("error"), "lloyd-members")
        sizes = now.groupBy("position", "entry").agg(F.ceil(F.count("*") / self.share).alias("salts"))  # a row an entry
        going = now.where("entry <> was").join(F.broadcast(sizes), ["position", "entry"])
        going = going.withColumn("salt", F.pmod(F.xxhash64("row"), F.col("salts"))).repartition("position", "entry", "salt")
        columns = ["row", "vec_id", "label", "position", "part", "entry"]
        arrived = stage(going.select(columns), "lloyd-movers")
        self.resident = now.where("entry = was").select(columns).unionByName(arrived)


def codes(vectors: DataFrame, vector: str = "embedding", rounds: int = ROUNDS, entries: int = ENTRIES, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """One row a kept vector (vec_id, label, code, error), as a written table, and the fitted codebooks."""
    if not 0 < entries <= 256:
        raise ValueError("an index has two hex digits")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", F.col(vector).alias("v")).where(usable(F.col("v")))
    rows = stage(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "label", integers(F.col("v"), scale).alias("v")), "lloyd-vectors")
    size = rows.agg(F.count("*").alias("n"), F.max(F.size("v")).alias("length")).first()
    width = -(-(size["length"] or 0) // POSITIONS)
    whole = F.concat("v", F.array_repeat(F.lit(0), F.lit(POSITIONS * width) - F.size("v")))
    filled = rows.select("row", "vec_id", "label", whole.alias("v"))
    first = filled.orderBy(F.asc_nulls_last("vec_id"), "v").limit(entries).collect()  # at most one vector an entry
    start = np.array([r["v"] for r in first], np.int64).reshape(len(first), POSITIONS, width)
    books = Codebooks(start.transpose(1, 0, 2).copy())
    cut = F.array(*[F.slice("v", p * width + 1, width) for p in range(POSITIONS)])
    members = _Members(filled.select("row", "vec_id", "label", F.posexplode(cut).alias("position", "part")), POSITIONS * size["n"])
    if size["n"]:
        for _ in range(rounds):
            members.migrate(books)
            books = _moved(members.resident, books)
    number = F.sum(F.col("entry") * F.element_at(F.array(*[F.lit(256 ** (POSITIONS - 1 - p)) for p in range(POSITIONS)]), F.col("position") + 1).cast("long"))
    coded = members.assigned(books).groupBy("row", "vec_id", "label").agg(number.alias("number"), F.sum("error").alias("error"))
    code = F.lower(F.lpad(F.hex("number"), 2 * POSITIONS, "0"))
    return stage(coded.select("vec_id", "label", code.alias("code"), "error"), "lloyd-codes"), books


#: Labels that may be sent to every executor.
LABELS_AT_ONCE = 200_000


def report(vectors: DataFrame) -> DataFrame:
    """vec_id, code, error, label_error (error added up over equal labels) and the digest of the codebooks."""
    coded, books = codes(vectors)
    labels = stage(coded.groupBy(F.col("label").alias("_label")).agg(F.sum("error").alias("label_error")), "lloyd-labels")
    few = labels.limit(LABELS_AT_ONCE + 1).count() <= LABELS_AT_ONCE
    joined = coded.join(F.broadcast(labels) if few else labels, F.col("label").eqNullSafe(F.col("_label")))
    return joined.select("vec_id", "code", "error", "label_error", F.lit(books.digest).alias("codebooks_sha256"))
