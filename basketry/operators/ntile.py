"""Exact ntile over a whole table without a single-task window.

``ntile(n) over (order by v, id)`` needs only n-1 cut points: the rows at the
ends of the first n-1 tiles. All orders asked for are ranked together, in one
shuffle: every row is sent once an order, as (order, value, tie-break), to sorted
ranges of about equal size. A row's rank is the number of rows in the ranges before
its own, a prefix sum over one number a range, plus its place inside. The rows
at the ends of the tiles are then read by place, and the tiles are plain
comparisons with literals, so nothing is joined back. A value that a third of all rows share is
spread over ranges by the tie-break.

Ties are broken by md5 of the id, which spreads evenly; ids must be distinct.
"""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.session import stage

HEX_DIGITS = 4  # of a digest, looked at per round: 16 ** HEX_DIGITS bands

_NO_VALUE = -(1 << 63)  # rank of null: before every other value


def tie_break(id_column: str) -> Column:
    return F.md5(F.coalesce(F.col(id_column).cast("string"), F.lit("null")))


def tile_ends(rows: int, tiles: int) -> list[int]:
    """1-based rank of the last row of each tile but the last."""
    size, longer = divmod(rows, tiles)
    ends, reached = [], 0
    for tile in range(tiles - 1):
        reached += size + (1 if tile < longer else 0)
        ends.append(reached)
    return ends


def _ordered(column: str) -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.lit(_NO_VALUE))


def ranked(df: DataFrame, columns: Sequence[str], id_column: str) -> DataFrame:
    """(order, value, digest, part, at), as a written table: each row once for every column, in sorted ranges.

    ``part`` numbers the ranges in order, ``at`` the rows inside from 0; ``order`` is the column's number.
    """
    orders = F.array(*[F.struct(F.lit(i).alias("order"), _ordered(c).alias("value")) for i, c in enumerate(columns)])
    keyed = df.select(tie_break(id_column).alias("digest"), orders.alias("orders"))
    keys = ["order", "value", "digest"]
    rows = keyed.select("digest", F.inline("orders")).select(*keys)
    ranges = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    inside = F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)
    return stage(ranges.withColumns({"part": F.spark_partition_id(), "at": inside}), "ranks")


def cut_points(df: DataFrame, columns: list[str], id_column: str, tiles: int) -> dict[str, list[tuple | None]]:
    """Per column the (value, md5) of the last row of each tile but the last.

    None stands for an empty tile. ``df`` is read twice, once for the borders of the ranges,
    so it should be a table rather than a long plan.
    """
    places = ranked(df, columns, id_column)
    sizes = places.groupBy("order", "part").agg(F.count(F.lit(1)).alias("rows"), F.min("at").alias("first"))
    runs: dict[int, list[tuple[int, int, int]]] = {}
    for r in sizes.collect():  # one row a range and order
        runs.setdefault(r["order"], []).append((r["part"], r["rows"], r["first"]))

    wanted: dict[tuple[int, int], list[tuple[str, int]]] = {}
    result: dict[str, list[tuple | None]] = {}
    for number, column in enumerate(columns):
        mine = sorted(runs.get(number, []))
        ends = tile_ends(sum(rows for _, rows, _ in mine), tiles)
        result[column] = [None] * len(ends)
        for tile, end in enumerate(ends):
            for part, rows, first in mine:
                if 0 < end <= rows:
                    wanted.setdefault((part, first + end - 1), []).append((column, tile))
                    break
                end -= rows
    if wanted:
        here = functools.reduce(Column.__or__, [(F.col("part") == part) & (F.col("at") == at) for part, at in wanted])
        for r in places.where(here).collect():  # at most tiles - 1 rows an order
            for column, tile in wanted[r["part"], r["at"]]:
                result[column][tile] = (r["value"], r["digest"])
    return result


def digest_at(df: DataFrame, digest: Column, rank: int) -> str:
    """Bound such that exactly ``rank`` rows have a hex ``digest`` up to it.

    Digests must be distinct.
    """
    prefix = ""
    while len(prefix) < 32:
        band = F.substring(digest, len(prefix) + 1, HEX_DIGITS)
        counted = df.where(digest.startswith(prefix)).groupBy(band.alias("band")).agg(F.count(F.lit(1)).alias("rows"))
        for band_text, rows in sorted((r[0], r[1]) for r in counted.collect()):  # at most 16 ** HEX_DIGITS rows
            if rank <= rows:
                break
            rank -= rows
        prefix += band_text
        if rank == rows:
            return prefix + "g"  # the whole band is in, and "g" sorts after every hex digit
    return prefix


def tile_of(column: str, cuts: list[tuple | None], id_column: str) -> Column:
    """Tile number, 1-based, from literal cut points."""
    value, digest = _ordered(column), tie_break(id_column)
    tile = F.lit(1)
    for cut in cuts:
        if cut is None:
            continue  # empty tile: nothing lies before its end
        last_value, last_digest = cut
        after = (value > last_value) | ((value == last_value) & (digest > last_digest))
        tile = tile + F.when(after, 1).otherwise(0)
    return tile


def add_ntiles(
    df: DataFrame,
    columns: Mapping[str, str],
    id_column: str,
    tiles: int = 3,
) -> DataFrame:
    """Add ``name: ntile(tiles) over (order by column, md5(id))`` columns.

    ``columns`` maps the new name to the ordering column (whole numbers, nulls
    first) and ``df`` must be a stored table with one row per id.
    """
    cuts = cut_points(df, sorted(set(columns.values())), id_column, tiles)
    return df.withColumns({name: tile_of(c, cuts[c], id_column) for name, c in columns.items()})
