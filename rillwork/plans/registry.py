"""Where every query is registered with the SQL that checks it."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Build
    sql: str | None


REGISTRY: dict[str, Entry] = {}


def query(key: str, sql: str | None = None) -> Callable[[Build], Build]:
    """Register a query; ``sql`` is the same result in the checking engine's dialect."""
    def register(build: Build) -> Build:
        if key in REGISTRY:
            raise ValueError(f"{key} is registered twice")
        REGISTRY[key] = Entry(build, sql)
        return build
    return register
