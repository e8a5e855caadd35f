"""Data quality measured as tables: one pass per input table, one row per check."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.contracts import QUALITY_RULES
from basketry.functions.columns import number_or_null, percent, row_digest


def _union(parts: list[DataFrame]) -> DataFrame:
    total = parts[0]
    for part in parts[1:]:
        total = total.unionByName(part)
    return total


def null_report(tables: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(table, column, nulls, rows, null_pct); columns a table lacks are skipped."""
    parts = []
    for name, (df, columns) in tables.items():
        present = [c for c in columns if c in df.columns]
        if not present:
            continue
        counts = [F.count_if(F.col(c).isNull()).alias(f"n{i}") for i, c in enumerate(present)]
        entries = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"n{i}").alias("nulls")) for i, c in enumerate(present)])
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows"), *counts)
            .select(F.lit(name).alias("table"), "rows", F.inline(entries))
            .select("table", "column", "nulls", "rows", percent(F.col("nulls"), F.col("rows")).alias("null_pct"))
        )
    return _union(parts)


def _by_table(frames: Sequence[DataFrame]) -> list[tuple[DataFrame, list[int]]]:
    """Each different frame once, with the places where it stands."""
    found: dict[int, tuple[DataFrame, list[int]]] = {}
    for i, df in enumerate(frames):
        found.setdefault(id(df), (df, []))[1].append(i)
    return list(found.values())


def duplicate_report(checks: Mapping[str, tuple[DataFrame, Sequence[str]]]) -> DataFrame:
    """(check, rows, duplicates): rows beyond the first of each value of the columns.

    Nulls compare equal. Checks that name the same frame share its scan: a row is sent once a check, as a digest of 128 bits, and all
    checks of all tables meet in one exchange. Copies combine before it, so a value that very many rows share is one row a task.
    """
    names, frames, columns = list(checks), [df for df, _ in checks.values()], [c for _, c in checks.values()]
    parts = []
    for df, places in _by_table(frames):
        entries = [F.struct(F.lit(i).alias("check"), *row_digest(columns[i])) for i in places]
        parts.append(df.select(F.inline(F.array(*entries))))
    groups = _union(parts).groupBy("check", "h1", "h2").agg(F.count(F.lit(1)).alias("n"))
    found = groups.groupBy("check").agg(F.sum("n").alias("rows"), F.sum(F.col("n") - 1).alias("duplicates"))
    return _named(frames[0], names, "check").join(found.withColumnRenamed("check", "_number"), "_number", "left").select(
        "check", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "duplicates")])


def _named(df: DataFrame, names: Sequence[str], column: str) -> DataFrame:
    """(_number, name), one row each."""
    return df.sparkSession.createDataFrame(list(enumerate(names)), f"_number int, {column} string")


def coerced(df: DataFrame, numbers: Sequence[str] = (), times: Sequence[str] = ()) -> DataFrame:
    """Columns as DOUBLE or TIMESTAMP; what does not convert is null."""
    changed = {c: number_or_null(F.col(c)) for c in numbers if c in df.columns}
    changed |= {c: F.col(c).try_cast("timestamp") for c in times if c in df.columns}
    return df.withColumns(changed) if changed else df


def rule_report(tables: Mapping[str, DataFrame], now: Column | str, rules=QUALITY_RULES) -> DataFrame:
    """(table, rule, kind, violations, rows): all rules of a table in one pass."""
    moment = now if isinstance(now, str) else "current_timestamp()"
    parts = []
    for name, df in tables.items():
        mine = [r for r in rules if r[0] == name]
        if not mine:
            continue
        counts = [F.count_if(F.expr(test.format(now=moment))).alias(f"v{i}") for i, (_, _, _, test) in enumerate(mine)]
        entries = F.array(*[
            F.struct(F.lit(rule).alias("rule"), F.lit(kind).alias("kind"), F.col(f"v{i}").alias("violations"))
            for i, (_, rule, kind, _) in enumerate(mine)
        ])
        parts.append(
            df.agg(F.count(F.lit(1)).alias("rows"), *counts)
            .select(F.lit(name).alias("table"), "rows", F.inline(entries))
            .select("table", "rule", "kind", "violations", "rows")
        )
    return _union(parts)


def reference_report(links: Sequence[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """(child, column, parent, rows, orphans) for (child, df, column, parent, df, key) links.

    Every frame is read once, whether it is a child, a parent or both: it sends a row for each of its links, (link, key, child rows, known).
    One exchange brings a link's keys together; rows of a key are added up before it, so a hot key is one row a task. No
    summary stands in for the keys: a Bloom filter can show that a key is missing, but not that it is there, and nearly all are. A null key is an orphan.
    """
    frames = [df for _, df, *_ in links] + [parent for *_, parent, _ in links]
    n = len(links)
    parts = []
    for df, places in _by_table(frames):
        entries = []
        for place in places:
            link, as_child = place % n, place < n
            key = F.col(links[link][2] if as_child else links[link][5]).cast("string")
            child = F.lit(1) if as_child else F.lit(0)
            entries.append(F.struct(F.lit(link).alias("link"), key.alias("key"), child.cast("bigint").alias("rows"), F.lit(not as_child).alias("known")))
        parts.append(df.select(F.inline(F.array(*entries))))
    keys = _union(parts).groupBy("link", "key").agg(F.sum("rows").alias("rows"), F.bool_or("known").alias("known"))
    missing = ~F.col("known") | F.col("key").isNull()
    found = keys.groupBy("link").agg(F.sum("rows").alias("rows"), F.sum(F.when(missing, F.col("rows")).otherwise(0)).alias("orphans"))
    about = frames[0].sparkSession.createDataFrame(
        [(i, child, column, parent) for i, (child, _, column, parent, _, _) in enumerate(links)], "link int, child string, column string, parent string")
    return about.join(found, "link", "left").select("child", "column", "parent", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("rows", "orphans")])


def late_report(df: DataFrame, flag: Column) -> DataFrame:
    """(rows, late, late_pct)."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.count_if(flag).alias("late")).select(
        "rows", "late", percent(F.col("late"), F.col("rows")).alias("late_pct")
    )


def field_version_report(df: DataFrame, field: str, newer: Column, value: str = "value") -> DataFrame:
    """(version, messages, with_field, with_value): does a field start where it should?"""
    present = F.array_contains(F.json_object_keys(value), field)
    return (
        df.groupBy(F.when(newer, "after").otherwise("before").alias("version"))
        .agg(
            F.count(F.lit(1)).alias("messages"),
            F.count_if(present).alias("with_field"),
            F.count(F.get_json_object(value, f"$.{field}")).alias("with_value"),
        )
    )


def rules_for(entity: str, now: str = "current_timestamp()") -> dict[str, Column]:
    """Invalid-value rules of an entity for ``cleaning.quarantine``."""
    return {rule: F.expr(test.format(now=now)) for table, rule, kind, test in QUALITY_RULES if table == entity and kind == "invalid"}
