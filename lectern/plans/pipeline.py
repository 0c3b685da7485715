"""Pipelines: sources, stages and sinks, by name."""

from __future__ import annotations

import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation, SparkSession

from lectern.operators.gates import concatenate, counted, totals
from lectern.runtime import materialise
from lectern.schema import check_schema
from lectern.sinks.base import Sink
from lectern.sources.base import Source

Stage = Callable[[DataFrame], DataFrame]
log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Pipeline:
    """What is read, what is done to it in this order, and where it goes."""

    name: str
    sources: tuple[Source, ...]
    stages: tuple[Stage, ...] = ()
    sinks: tuple[Sink, ...] = ()
    info: dict = field(default_factory=dict)

    def extract(self, spark: SparkSession) -> DataFrame:
        return check_schema(concatenate(*[s.extract(spark) for s in self.sources]))

    def transform(self, df: DataFrame) -> DataFrame:
        """All stages in order. Stages that read files or call a model write their rows down once; the rest is lazy."""
        return reduce(lambda d, stage: check_schema(stage(d)), self.stages, df)

    def load(self, df: DataFrame) -> DataFrame:
        """Compute once, then hand the same rows to every sink; returns them as written."""
        rows = materialise(df, "resources")
        for sink in self.sinks:
            sink.load(rows)
        return rows

    def run(self, spark: SparkSession) -> DataFrame:
        return self.report(spark)[0]

    def report(self, spark: SparkSession) -> tuple[DataFrame, DataFrame]:
        """Run, and say what passed: the rows as written, and ``stage, name, rows, errors``, of the sources together and of each stage.

        Rows are counted on their way, by observations: no stage runs again for it.
        """
        seen: list[tuple[str, DataFrame, Observation]] = []

        def watched(df: DataFrame, name: str) -> DataFrame:
            seen.append((name, df, Observation(f"{self.name}-{len(seen)}")))
            return counted(df, seen[-1][2])

        df = watched(self.extract(spark), "sources")
        for stage in self.stages:
            df = watched(check_schema(stage(df)), _name_of(stage))
        rows = self.load(df)
        counts = [(i, name, *_counts(df, o)) for i, (name, df, o) in enumerate(seen)]
        for i, name, n, errors in counts:
            log.info("%s, %d %s: %d rows, %d errors", self.name, i, name, n, errors)
        return rows, spark.createDataFrame(counts, "stage int, name string, rows long, errors long")


def _counts(df: DataFrame, observation: Observation) -> tuple[int, int]:
    """What was observed; rows that the optimizer knew not to be needed passed nowhere, and are counted."""
    try:
        found = observation.get
    except Py4JJavaError:
        found = df.agg(*totals()).first().asDict()
    return found["rows"], found["errors"]


def _name_of(stage: Stage) -> str:
    return getattr(getattr(stage, "func", stage), "__name__", type(stage).__name__)


_REGISTRY: dict[str, Callable[..., Pipeline]] = {}


def register(name: str) -> Callable[[Callable[..., Pipeline]], Callable[..., Pipeline]]:
    """Make a function that builds a pipeline known under a name."""

    def keep(build: Callable[..., Pipeline]) -> Callable[..., Pipeline]:
        _REGISTRY[name] = build
        return build

    return keep


def available() -> list[str]:
    return sorted(_REGISTRY)


def from_name(name: str, **options) -> Pipeline:
    """The pipeline of that name; an unknown one is an error that names those known."""
    if name not in _REGISTRY:
        raise ValueError(f"no pipeline {name}; available: {', '.join(available())}")
    return _REGISTRY[name](**options)
