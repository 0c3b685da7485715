"""Model-backed steps behind one small interface, with deterministic stand-ins.

The stand-ins are this project's own and make no claim to match a model's output.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import Protocol

from pyspark.sql import Column
from pyspark.sql import functions as F

PNG = "image/png"


class ModelClient(Protocol):
    """Anything picklable with these calls: ``models.remote.RemoteClient``, or one's own. The stand-in is the default."""

    name: str

    def transcribe(self, page: bytes) -> str: ...

    def stitch(self, pages: list[str]) -> str: ...

    def split(self, text: str) -> list[dict]: ...

    def describe(self, image: bytes, mime_type: str) -> str: ...


#: A heading that begins an exercise, a problem or a solution, and its number.
HEADING = re.compile(r"^#{1,6}[ \t]+(Exercise|Problem|Solution)[ \t]+([\w.]+?)[.:]?(?=[ \t]|$).*$", re.IGNORECASE | re.MULTILINE)


@dataclass(frozen=True)
class StandIn:
    """Deterministic: pages are UTF-8 text, stitching joins by a blank line, splitting follows headings."""

    name: str = "stand-in"

    def transcribe(self, page: bytes) -> str:
        return page.decode("utf-8", "replace").strip()

    def stitch(self, pages: list[str]) -> str:
        return "\n\n".join(p.strip() for p in pages)

    def split(self, text: str) -> list[dict]:
        marks = list(HEADING.finditer(text))
        ends = [m.start() for m in marks[1:]] + [len(text)]
        return [
            {"snippet": text[m.start() : e].strip(), "number": m[2], "is_solution": m[1].lower() == "solution"}
            for m, e in zip(marks, ends)
        ]

    def describe(self, image: bytes, mime_type: str) -> str:
        return f"{mime_type.rsplit('/', 1)[-1]} image of {len(image)} bytes"

    def described(self, image: Column, mime_type: Column) -> Column:
        """``describe`` as a column."""
        return F.concat(F.substring_index(mime_type, "/", -1), F.lit(" image of "), F.octet_length(image), F.lit(" bytes"))
