"""Registry of named queries: a DataFrame builder and (optionally) its SQL oracle."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Builder = Callable[[SparkSession, str], DataFrame]


@dataclass
class Entry:
    name: str
    build: Builder
    oracle: str | None
    survey_id: str


QUERIES: dict[str, Entry] = {}


def register(name: str, survey_id: str, oracle: str | None = None):
    """Decorator: ``@register("frame_verdicts", "E3", oracle=SQL)``."""
    def wrap(fn: Builder) -> Builder:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = Entry(name, fn, oracle, survey_id)
        return fn
    return wrap
