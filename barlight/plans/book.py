"""A list of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from barlight.plans.fixtures import rounded, sql


class Book:
    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.sql: dict[str, str] = {}

    def add(self, text: str | None = None, *fixtures: str, doubles: str = "", dates: str = "", places: int = 4, name: str | None = None):
        """Registers a function under its name; text: SQL over the fixtures, whose named columns are rounded like all doubles here."""

        def wrap(fn: Callable[[SparkSession, str], DataFrame]):
            key = name or fn.__name__
            self.queries[key] = lambda spark, sf_dir: rounded(fn(spark, sf_dir), places)
            if text is not None:
                self.sql[key] = sql(text, *fixtures, doubles=doubles, places=places, dates=dates)
            return fn

        return wrap
