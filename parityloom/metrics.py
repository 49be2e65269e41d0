"""Counters, gauges and timings of a run, and those Spark observes in a query."""

from __future__ import annotations

import time
from collections import defaultdict
from collections.abc import Callable
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


class Metrics:
    """Values by name and tags; each is also given to the backend, if there is one."""

    def __init__(self, backend: Callable[[str, float, dict], None] | None = None):
        self.values: dict[tuple[str, tuple], list[float]] = defaultdict(list)
        self.backend = backend

    def add(self, name: str, value: float = 1.0, **tags: str) -> None:
        self.values[name, tuple(sorted(tags.items()))].append(float(value))
        if self.backend:
            self.backend(name, value, tags)

    @contextmanager
    def timed(self, name: str, **tags: str):
        start = time.perf_counter()
        try:
            yield
        finally:
            self.add(name, time.perf_counter() - start, **tags)

    def table(self, spark: SparkSession) -> DataFrame:
        """(name, value, tags) of everything."""
        rows = [(n, v, dict(t)) for (n, t), vs in self.values.items() for v in vs]
        return spark.createDataFrame(rows, "name string, value double, tags map<string,string>")


def observed(df: DataFrame, **named: Column) -> tuple[DataFrame, Observation]:
    """df with aggregates that its next action computes on the way."""
    o = Observation()
    return df.observe(o, *[c.alias(k) for k, c in named.items()]), o
