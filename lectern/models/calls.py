"""Calls of a model from tasks: several in flight, in order, with failures as values."""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterable, Iterator
from concurrent.futures import Future, ThreadPoolExecutor

import pyarrow as pa
from pyspark.sql import functions as F

from lectern.models.remote import ModelError

#: A reply, or why there is none.
REPLY = "struct<value:string,error:string>"
_REPLY = pa.struct([("value", pa.string()), ("error", pa.string())])


def in_order(values: Iterable[object], call: Callable[[object], object], most: int) -> Iterator[object]:
    """``call`` of each value, in the values' order, with up to ``most`` calls at once and no more results waiting."""
    if most <= 1:
        yield from map(call, values)
        return
    with ThreadPoolExecutor(most) as pool:
        flying: deque[Future] = deque()
        try:
            for v in values:
                flying.append(pool.submit(call, v))
                if len(flying) >= most:
                    yield flying.popleft().result()
            while flying:
                yield flying.popleft().result()
        finally:
            for f in flying:  # after an error nothing else is begun
                f.cancel()


def tried(call: Callable[[object], str]) -> Callable[[object], dict]:
    """The call's reply, or the reason of a model's refusal; any other error is one."""

    def run(value: object) -> dict:
        try:
            return {"value": call(value), "error": None}
        except ModelError as e:
            return {"value": None, "error": str(e)[:1000]}

    return run


def calling(call: Callable[[object], str], parallel: int = 1):
    """A column function that calls a model for each value, ``parallel`` at once in a task; null stays null. It is not run again by the optimizer's choice."""

    def one(value: pa.Scalar) -> dict | None:
        return tried(call)(value.as_py()) if value.is_valid else None

    @F.arrow_udf(REPLY)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for b in batches:
            yield pa.array(list(in_order(b, one, parallel)), _REPLY)

    return run.asNondeterministic()


def parallel_of(client: object) -> int:
    """How many calls at once a client stands in a task."""
    return int(getattr(client, "parallel", 1))
