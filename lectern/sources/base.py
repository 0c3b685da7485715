"""What a source is: anything that gives a resource table."""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession

from lectern.sources.course_dump import PREFIXES, read_dump


class Source(Protocol):
    def extract(self, spark: SparkSession) -> DataFrame: ...


@dataclass(frozen=True)
class CourseDump:
    """A dump of a learning platform's course pages."""

    path: str
    lms_prefix: str
    prefixes: tuple[str, ...] = PREFIXES
    header: str = "h3"
    strict: bool = True

    def extract(self, spark: SparkSession) -> DataFrame:
        return read_dump(spark, self.path, self.lms_prefix, self.prefixes, self.header, self.strict)


@dataclass(frozen=True)
class Table:
    """A resource table that exists already, under Spark's catalog name or as a Parquet path."""

    name: str = ""
    parquet: str = ""
    options: dict = field(default_factory=dict)

    def extract(self, spark: SparkSession) -> DataFrame:
        return spark.read.options(**self.options).parquet(self.parquet) if self.parquet else spark.table(self.name)
