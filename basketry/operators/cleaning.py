"""Row and key de-duplication, blank trimming, canonical spelling, quarantine."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from basketry.functions.columns import row_digest
from basketry.operators.joins import left_lookup
from basketry.session import stage


def trim_strings(df: DataFrame) -> DataFrame:
    """Strip leading and trailing blanks of every string column."""
    texts = [f.name for f in df.schema if isinstance(f.dataType, T.StringType)]
    return df.withColumns({name: F.trim(F.col(name)) for name in texts}) if texts else df


def drop_empty_rows(df: DataFrame) -> DataFrame:
    """Drop rows in which every column is null."""
    return df.na.drop(how="all")


def dedupe_rows(df: DataFrame) -> DataFrame:
    """Keep one of each set of identical rows."""
    return df.dropDuplicates()


def clean(df: DataFrame, *, trim_first: bool = False) -> DataFrame:
    """Generic table clean: identical rows, empty rows, blanks.

    By default rows that differ only in blanks both survive, because blanks are
    stripped last. ``trim_first`` strips before comparing.
    """
    if trim_first:
        return df.transform(trim_strings).transform(dedupe_rows).transform(drop_empty_rows)
    return df.transform(dedupe_rows).transform(drop_empty_rows).transform(trim_strings)


#: Groups of 64 stored rows whose marks may be sent to every executor: one number a group, so 256 million rows.
COPIES_AT_ONCE = 4_000_000
_ROWS_A_FILE = 40  # bits


def _placed(stored: DataFrame, files: DataFrame) -> DataFrame:
    """Rows with ``__place``: number of the file and place in it."""
    place = F.shiftleft("__file", _ROWS_A_FILE) + F.col("__row")
    rows = stored.select("*", F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__row"))
    return rows.join(F.broadcast(files), "__path").withColumn("__place", place).drop("__path", "__row", "__file")


def drop_copies(stored: DataFrame) -> DataFrame:
    """``dedupe_rows`` of a stored table of files, without a shuffle of its rows.

    A row's identity is a digest of 128 bits of all its columns. Only digests and places (file and row) are shuffled; of equal rows
    the one with the least place stays. Rows that stay are marked by one bit each, 64 rows a number, however many copies there are. The marks are
    sent to the executors, and the rows are read once more and passed over where they are; only beyond ``COPIES_AT_ONCE`` do both sides meet by a shuffle.
    """
    columns = stored.columns
    paths = stored.select(F.col("_metadata.file_path").alias("__path")).distinct()
    # one row a file; the number is stored, so both passes use the same one
    files = stage(paths.withColumn("__file", F.row_number().over(Window.orderBy("__path")).cast("bigint")), "files")
    digest = [h.alias(f"__{name}") for h, name in zip(row_digest(columns), ("h1", "h2"))]
    kept = _placed(stored, files).select(*digest, "__place").groupBy("__h1", "__h2").agg(F.min("__place").alias("__place"))
    word, bit = F.shiftright("__place", 6).alias("__word"), F.col("__place").bitwiseAND(F.lit(63)).cast("int")
    mark = F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)
    marks = stage(kept.groupBy(word).agg(F.bit_or(mark).alias("__marks")), "copies")
    few = marks.limit(COPIES_AT_ONCE + 1).count() <= COPIES_AT_ONCE
    rows = _placed(stored, files).select(*columns, word, bit.alias("__bit")).join(F.broadcast(marks) if few else marks, "__word")
    return rows.where(F.getbit("__marks", F.col("__bit")) == 1).select(columns)


def clean_stored(stored: DataFrame) -> DataFrame:
    """``clean`` of a stored table of files: copies are found by digests, texts stay where they are."""
    return drop_copies(stored).transform(drop_empty_rows).transform(trim_strings)


def dedupe_by_key(
    df: DataFrame,
    keys: Sequence[str],
    latest_by: Sequence[str],
    *,
    fill: bool = False,
    keep_unkeyed: bool = False,
) -> DataFrame:
    """One row per key: the greatest by ``latest_by``, ties by the whole row.

    An aggregate rather than a window: copies combine before the shuffle, so a
    key with very many copies costs one row per map task.
    ``fill`` completes null fields of the survivor from other copies, taking
    the greatest non-null value of each field.
    Null keys compare equal and make one group; with ``keep_unkeyed`` rows
    that lack a key are told apart by all their columns instead.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [c for c in latest_by if c in rest] + [c for c in rest if c not in latest_by]
    groups = list(keys)
    if keep_unkeyed:
        unkeyed = functools.reduce(Column.__or__, [F.col(k).isNull() for k in keys])
        df = df.withColumn("__itself", F.when(unkeyed, F.struct(*rest)))
        groups.append("__itself")
    newest = F.max(F.struct(*order)).alias("__newest")
    spare = [F.max(c).alias(f"__spare_{i}") for i, c in enumerate(rest)] if fill else []
    kept = {
        c: F.coalesce(F.col(f"__newest.{c}"), F.col(f"__spare_{i}")) if fill else F.col(f"__newest.{c}")
        for i, c in enumerate(rest)
    }
    columns = [kept[c].alias(c) if c in kept else F.col(c) for c in df.columns if c != "__itself"]
    return df.groupBy(*groups).agg(newest, *spare).select(*columns)


def spelling_table(spellings: Mapping[str, Sequence[str]]) -> dict[str, str]:
    """Variant to canonical spelling; the canonical one maps to itself."""
    table = {}
    for canonical, variants in spellings.items():
        for text in (canonical, *variants):
            table[text.strip()] = canonical
    return table


def canonicalize(df: DataFrame, column: str, spellings: Mapping[str, Sequence[str]]) -> DataFrame:
    """Replace known spelling variants; unknown texts stay, stripped of blanks.

    The dictionary is a fixed list of a few dozen entries and travels inside
    the plan as a literal map, so no join is needed.
    """
    table = spelling_table(spellings)
    entries = [F.lit(x) for pair in table.items() for x in pair]
    text = F.trim(F.col(column))
    return df.withColumn(column, F.coalesce(F.try_element_at(F.create_map(*entries), text), text))


def lookup_literal(key: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Value of a small fixed dictionary, ``default`` when the key is unknown."""
    entries = [F.lit(x) for pair in table.items() for x in pair]
    found = F.try_element_at(F.create_map(*entries), key)
    return F.coalesce(found, F.lit(default)) if default is not None else found


def quarantine(df: DataFrame, rules: Mapping[str, Column]) -> DataFrame:
    """Add ``reasons``: names of the broken rules in rule order, empty when sound.

    A rule that evaluates to null does not fire. One pass; callers split on
    ``size(reasons) = 0`` and lose no row.
    """
    hits = [F.when(broken, F.lit(name)) for name, broken in rules.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*hits)))


def accepted(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("reasons") == 0).drop("reasons")


def rejected(flagged: DataFrame) -> DataFrame:
    return flagged.where(F.size("reasons") > 0)


def with_orphans(df: DataFrame, references: Sequence[tuple[str, DataFrame, str]], **options) -> tuple[DataFrame, dict[str, Column]]:
    """Rows with a mark for each (column, parent, key), and rules that call a key without a parent ``<column>_orphan``.

    A parent's key must be unique; a null key is an orphan. Options go to ``joins.left_lookup``.
    """
    rules = {}
    for column, parent, key in references:
        mark = f"__known_{column}"
        known = parent.where(F.col(key).isNotNull()).select(F.col(key).alias(column), F.lit(True).alias(mark))
        df = left_lookup(df, known, column, **options)
        rules[f"{column}_orphan"] = F.col(mark).isNull()
    return df, rules


@dataclass(frozen=True)
class Routed:
    """A stored table of flagged rows, split by verdict: reading one side reads only its files."""

    table: DataFrame

    @property
    def accepted(self) -> DataFrame:
        return self.table.where(F.col("verdict") == "accepted").drop("verdict", "reasons")

    @property
    def rejected(self) -> DataFrame:
        return self.table.where(F.col("verdict") == "rejected").drop("verdict")


def judged(df: DataFrame, rules: Mapping[str, Column], references: Sequence[tuple[str, DataFrame, str]] = (), **options) -> DataFrame:
    """Rows with ``reasons`` (rules in order, then orphans) and ``verdict``: accepted without a reason, else rejected.

    Every input is read once: the rows, and each parent's key column.
    """
    columns = df.columns
    marked, orphans = with_orphans(df, references, **options)
    found = quarantine(marked, {**rules, **orphans})
    verdict = F.when(F.size("reasons") == 0, "accepted").otherwise("rejected")
    return found.select(*columns, "reasons", verdict.alias("verdict"))


def route(df: DataFrame, rules: Mapping[str, Column], references: Sequence[tuple[str, DataFrame, str]], lake, name: str, **options) -> Routed:
    """Write accepted and rejected rows in one pass, each to its own folder of the table; no row is lost or in both."""
    return Routed(lake.overwrite(judged(df, rules, references, **options), name, partition_by=["verdict"]))
