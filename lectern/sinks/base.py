"""What a sink is, and one that only counts."""

from __future__ import annotations

import logging
from typing import Protocol

from pyspark.sql import DataFrame

log = logging.getLogger(__name__)


class Sink(Protocol):
    def load(self, df: DataFrame) -> None: ...


class DummySink:
    """Reads everything and logs the number of rows, and the first ones at debug level."""

    def __init__(self, show: int = 20):
        self.show = show

    def load(self, df: DataFrame) -> None:
        log.info("%d resources", df.count())
        if log.isEnabledFor(logging.DEBUG):
            for row in df.drop("content").limit(self.show).collect():
                log.debug("%s", row)
