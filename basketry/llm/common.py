"""Helpers the operators share: reading documents and building Arrow struct columns."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Rows of a batch that goes to a Python worker: texts are long, and a batch is held twice on its way.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Send fewer rows at once to Python workers, for the rest of the session."""
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(setting)) <= BATCH_ROWS:
        spark.conf.set(setting, str(BATCH_ROWS))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    small_batches(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def whole_text(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def ranges(*columns: pa.Array, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of rows whose texts have about ``most`` bytes together, so that the arrays made of them stay small.

    After the last one Arrow gives back the memory it no longer uses: workers outlive their tasks.
    """
    sizes = sum(pc.fill_null(pc.binary_length(c), 0).to_numpy(zero_copy_only=False).astype(np.int64) for c in columns)
    ends = np.cumsum(sizes)
    at = 0
    while at < len(ends):
        end = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + most, side="right")))
        yield at, end
        at = end
    pa.default_memory_pool().release_unused()


def strings(values: pa.Array) -> list[str]:
    """An Arrow text column as Python strings, empty for nulls."""
    return [v or "" for v in values.to_pylist()]


def structs(kind: pa.StructType, rows: Iterable[tuple]) -> pa.StructArray:
    """Tuples as one Arrow struct column of the given type."""
    columns = list(zip(*rows)) or [()] * kind.num_fields
    return pa.StructArray.from_arrays(
        [pa.array(c, kind.field(i).type) for i, c in enumerate(columns)], fields=[kind.field(i) for i in range(kind.num_fields)])


def joined_spans(spans: Iterable[tuple[int, int, str]], kinds: dict[str, int]) -> str:
    """kind:start:end by start, then by the order of the kinds, then by end."""
    return ",".join(f"{k}:{s}:{e}" for s, e, k in sorted(spans, key=lambda x: (x[0], kinds[x[2]], x[1])))


#: Ids that may be sent to every executor: 16 MB of longs. More are joined by a shuffle.
BROADCAST_IDS = 1_000_000


def with_ids(docs: DataFrame, ids: DataFrame, how: str, column: str = "doc_id") -> DataFrame:
    """``docs`` with (how="left_semi") or without ("left_anti") the given distinct ids.

    ``ids`` must be cheap to read twice: it is counted first, and sent to the executors only if it is small,
    so that the texts need not move.
    """
    few = ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if few else ids, column, how)
