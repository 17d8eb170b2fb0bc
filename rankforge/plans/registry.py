"""Registry of demonstration queries: key -> (spark builder, SQL twin)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Registered:
    key: str
    build: Builder
    sql: str | None  # None: no SQL twin (ML fits); checked by rows and properties


REGISTRY: dict[str, Registered] = {}


def register(key: str, sql: str | None = None):
    def deco(fn: Builder) -> Builder:
        if key in REGISTRY:
            raise ValueError(f"duplicate query key {key}")
        REGISTRY[key] = Registered(key, fn, sql)
        return fn
    return deco
