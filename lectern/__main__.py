"""``python -m lectern NAME OPTIONS.json``: run a registered pipeline with options from a JSON file."""

from __future__ import annotations

import json
import logging
import sys
from pathlib import Path

from pyspark.sql import SparkSession

from lectern.plans import available, from_name


def main(args: list[str]) -> int:
    if len(args) != 2:
        print(f"{__doc__}\nKnown: {', '.join(available())}")
        return 2
    logging.basicConfig(level=logging.INFO, format="[%(levelname)s] %(message)s")
    pipeline = from_name(args[0], **json.loads(Path(args[1]).read_text(encoding="utf-8")))
    spark = SparkSession.builder.appName(f"lectern-{args[0]}").getOrCreate()
    pipeline.run(spark)
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
