from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Runner = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    run: Runner
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def register(name: str, run: Runner, sql: str | None = None) -> None:
    if name in REGISTRY:
        raise ValueError(f"query {name} is registered twice")
    REGISTRY[name] = Entry(run, sql)


def query(name: str, sql: str | None = None) -> Callable[[Runner], Runner]:
    def wrap(run: Runner) -> Runner:
        register(name, run, sql)
        return run

    return wrap
