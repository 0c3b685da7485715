"""Attach file contents to resource rows."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from lectern.functions.paths import IPYNB, MARKDOWN, PDF
from lectern.runtime import open_store, ship

#: Types whose bytes a later stage reads as a whole; archives are read by range.
READ = (IPYNB, PDF, MARKDOWN)


def with_content(df: DataFrame, mime_types: tuple[str, ...] = READ, gathered: int = 16 << 20) -> DataFrame:
    """Rows of the given types with their file's bytes; only those files are opened, by the tasks that hold the rows.

    Rows are handed on in batches of about ``gathered`` bytes.
    """
    names = df.columns
    at, kind, to = (names.index(n) for n in ("path", "mime_type", "content"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lo, size = 0, 0
            contents: list[bytes | None] = []

            def done(hi: int) -> pa.RecordBatch:
                part = b.slice(lo, hi - lo)
                columns = part.columns
                columns[to] = pa.array(contents, pa.binary())
                return pa.RecordBatch.from_arrays(columns, schema=b.schema)

            for i, (uri, mime_type) in enumerate(zip(b.column(at).to_pylist(), b.column(kind).to_pylist())):
                data = b.column(to)[i].as_py()
                if data is None and mime_type in mime_types:
                    store, path = open_store(uri)
                    with store.open_input_file(path) as f:
                        data = f.read()
                contents.append(data)
                size += len(data or b"")
                if size >= gathered:
                    yield done(i + 1)
                    lo, size, contents = i + 1, 0, []
            if contents:
                yield done(b.num_rows)

    ship(df.sparkSession)
    return df.mapInArrow(run, df.schema)
