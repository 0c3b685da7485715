"""Settings from the environment or a ``.env`` file; importing the package needs none of them."""

from __future__ import annotations

import os
from pathlib import Path


def read_env(path: str | os.PathLike | None = None) -> dict[str, str]:
    """``KEY=value`` lines of a file, without quotes, comments and ``export``; the environment wins."""
    out: dict[str, str] = {}
    if path is not None and Path(path).exists():
        for line in Path(path).read_text(encoding="utf-8").splitlines():
            key, eq, value = line.strip().removeprefix("export ").partition("=")
            if eq and not key.startswith("#"):
                value = value.strip()
                quoted = len(value) > 1 and value[0] == value[-1] and value[0] in "'\""
                out[key.strip()] = value[1:-1] if quoted else value.split(" #")[0].rstrip()
    return out | {k: v for k, v in os.environ.items() if k in out}
