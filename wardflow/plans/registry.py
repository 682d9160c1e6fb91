"""Named queries over the test tables, each with the SQL that states its result."""

from __future__ import annotations

import textwrap
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ..schema import Tables
from ..session import tune


@dataclass(frozen=True)
class Query:
    name: str
    ops: tuple[str, ...]
    build: Callable[[Tables], DataFrame]
    sql: str | None


REGISTRY: dict[str, Query] = {}


def query(name: str, ops: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` for the inventory rows named in ``ops``."""

    def add(fn):
        if name in REGISTRY:
            raise ValueError(f"query {name} is registered twice")
        REGISTRY[name] = Query(name, tuple(ops.split()), fn, textwrap.dedent(sql).strip() if sql else None)
        return fn

    return add


def run(name: str, spark: SparkSession, folder: str) -> DataFrame:
    return REGISTRY[name].build(Tables(tune(spark), folder))


def hours(a: str, b: str) -> str:
    """SQL for elapsed hours, the same arithmetic as ``elapsed``."""
    return f"((epoch_us({b}) - epoch_us({a})) / 3.6e9)"


def days(a: str, b: str) -> str:
    return f"((epoch_us({b}) - epoch_us({a})) / 8.64e10)"
