"""New page files as a stream of links."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.sources.course_dump import PREFIXES, section_links


def stream_links(spark: SparkSession, folder: str, prefixes: tuple[str, ...] = PREFIXES, header: str = "h3") -> DataFrame:
    """A stream of the section links of every page file that arrives in ``folder``, with the file's ``path``."""
    pages = spark.readStream.option("wholetext", "true").option("pathGlobFilter", "*.html").text(folder)
    return section_links(pages.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("html")), prefixes, header)
