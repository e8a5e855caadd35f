"""Left joins that survive a key holding a large share of all rows.

How two tables are joined is left to Spark: a side it knows to be small is broadcast,
skewed partitions are split at run time. What it cannot split is a key whose rows
arrive from an aggregate or a window, so for facts of rows (``spread=True``) hot keys are
looked for first:

* ``hot_keys`` counts a sample of one column of ``keys_from``, a stored table that owns the key.
  A key is hot from ``HOT_KEY_ROWS`` rows, or one in ``MOST_HOT_KEYS`` of all rows if that is more, so there are
  never more than that many and they can be sent to every executor. They decide where rows are joined,
  never whether: the result is the same with any of them missing.
* without hot keys the join is a plain one. Otherwise rows of a hot key, the null key too, get a
  salt, one for each ``hot_rows`` rows counted, and its lookup rows are
  repeated once per salt. All other keys keep salt 0 and are not repeated.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.session import stage

HOT_KEY_ROWS = 1_000_000
MOST_HOT_KEYS = 100_000
SAMPLED_ROWS = 1_000  # expected in the sample for a key at the threshold

_SALT, _SALTS, _ROWS = "__salt", "__salts", "__rows"


class Owner:
    """A stored table with key columns; each is searched for hot keys once, and not at all if the table is too short."""

    def __init__(self, table: DataFrame) -> None:
        self.table = table
        self._rows: int | None = None
        self._found: dict[tuple[str, int], DataFrame | None] = {}

    def __contains__(self, key: str) -> bool:
        return key in self.table.columns

    def least(self, min_rows: int) -> int:
        """Rows that make a key hot: no more than MOST_HOT_KEYS keys can have them."""
        if self._rows is None:
            self._rows = self.table.select().count()  # from the footers
        return max(min_rows, -(-self._rows // MOST_HOT_KEYS))

    def hot_keys(self, key: str, min_rows: int) -> DataFrame | None:
        """Table of ``hot_keys``, None if there are none."""
        if self.least(min_rows) > self._rows:
            return None
        if (key, min_rows) not in self._found:
            found = hot_keys(self.table, key, min_rows)
            self._found[key, min_rows] = None if found.isEmpty() else found
        return self._found[key, min_rows]


def hot_keys(df: DataFrame, key: str, min_rows: int = HOT_KEY_ROWS) -> DataFrame:
    """(key, __rows) of the keys with about ``min_rows`` rows or more, as a written table.

    The null key is listed too. Reads a sample of the key column, or all of it
    when ``min_rows`` is small.
    """
    share = min(1.0, SAMPLED_ROWS / min_rows)
    keys = df.select(key)
    if share < 1:
        keys = keys.sample(fraction=share, seed=1)
    counted = keys.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_rows * share)
    return stage(counted.select(key, F.ceil(F.col("n") / share).alias(_ROWS)), "hot-keys")


def left_lookup(
    fact: DataFrame,
    lookup: DataFrame,
    key: str,
    *,
    keys_from: Owner | None = None,
    spread: bool = False,
    hot_rows: int | None = None,
    spot: Sequence[str] | None = None,
) -> DataFrame:
    """``fact`` with the columns of ``lookup`` for its ``key`` (left join).

    ``spread`` looks for hot keys, in ``keys_from`` if it is given: a stored table that owns the key, which is
    cheaper to read than the fact. ``spot`` names the columns that tell rows of one key apart (default: all plain
    ones); naming few spares the scan the others.
    """
    if not spread:
        return fact.join(lookup, key, "left")
    owner = keys_from or Owner(fact)
    hot_rows = owner.least(hot_rows or HOT_KEY_ROWS)
    hot = owner.hot_keys(key, hot_rows)
    if hot is None:
        return fact.join(lookup, key, "left")

    salts = F.broadcast(hot.where(F.col(key).isNotNull()).select(key, F.ceil(F.col(_ROWS) / hot_rows).cast("int").alias(_SALTS)))
    nulls = hot.where(F.col(key).isNull()).agg(F.ceil(F.max(_ROWS) / hot_rows)).first()[0]  # rows without a key match nothing
    plain = [f.name for f in fact.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    # The partition id spreads copies of one row. Both inputs are the same
    # when a lost task runs again.
    place = F.xxhash64(*(spot or plain)) + F.spark_partition_id()
    salt = F.when(F.col(_SALTS).isNotNull(), F.pmod(place, F.col(_SALTS)))
    if nulls:
        salt = salt.when(F.col(key).isNull(), F.pmod(place, F.lit(nulls)))
    salted_fact = (
        fact.join(salts, key, "left").withColumn(_SALT, salt.otherwise(F.lit(0)).cast("int")).drop(_SALTS)
    )
    salted_lookup = (
        lookup.join(salts, key, "left")
        .withColumn(_SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(_SALTS), F.lit(1)) - 1)))
        .drop(_SALTS)
    )
    return salted_fact.join(salted_lookup, [key, _SALT], "left").drop(_SALT)


def add_new_columns(
    fact: DataFrame, extra: DataFrame, key: str, taken: Sequence[str] = (), **options
) -> DataFrame:
    """Left join that keeps only the columns of ``extra`` that ``fact`` lacks.

    ``taken`` names further columns the left side would own. Without the key
    on both sides the fact is returned as it is.
    """
    if key not in extra.columns or key not in fact.columns:
        return fact
    known = set(fact.columns) | set(taken)
    fresh = [c for c in extra.columns if c not in known]
    return left_lookup(fact, extra.select(key, *fresh), key, **options)


def unmatched(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None, **options) -> DataFrame:
    """Rows of ``child`` whose ``key`` is absent from ``parent``; a null key is absent.

    A lookup that keeps the misses, so hot keys are spread as in any other.
    """
    known = _known_keys(parent, parent_key or key, key)
    return left_lookup(child, known, key, **options).where(F.col("__known").isNull()).drop("__known").select(child.columns)


def _known_keys(parent: DataFrame, parent_key: str, key: str) -> DataFrame:
    keys = parent.select(F.col(parent_key).alias(key)).where(F.col(key).isNotNull())
    return keys.distinct().withColumn("__known", F.lit(True))


def unmatched_counts(child: DataFrame, parent: DataFrame, key: str, parent_key: str | None = None) -> DataFrame:
    """One row (rows, orphans): child rows in total and without a parent.

    Counts per key first, so both sides of the join hold one row per key.
    """
    per_key = child.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.join(_known_keys(parent, parent_key or key, key), key, "left").agg(
        F.coalesce(F.sum("rows"), F.lit(0)).alias("rows"),
        F.coalesce(F.sum(F.when(F.col("__known").isNull(), F.col("rows"))), F.lit(0)).alias("orphans"),
    )
