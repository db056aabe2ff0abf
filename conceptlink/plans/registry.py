"""Registry of the runnable queries and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    name: str
    item: str  # inventory item it shows
    run: Query
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def query(item: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register the function under its own name."""

    def register(run: Query) -> Query:
        if run.__name__ in ENTRIES:
            raise ValueError(f"{run.__name__} is registered twice")
        ENTRIES[run.__name__] = Entry(run.__name__, item, run, sql)
        return run

    return register
