"""Calls of a model: several at once and in order, kept batch by batch, failures as records; the cache's log and compaction."""

import json
import threading
import time
import uuid
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from lectern.functions import paths as P
from lectern.models import ModelError, RemoteClient, StandIn
from lectern.models.calls import calling, in_order
from lectern.operators.cache import KEY, Cache, drain, hits, once
from lectern.operators.exercises import split_exercises
from lectern.operators.pdfs import pdfs_to_markdown
from lectern.schema import as_resources


def test_in_order_and_bounded():
    now, most, lock = [0], [0], threading.Lock()

    def call(v):
        with lock:
            now[0] += 1
            most[0] = max(most[0], now[0])
        time.sleep(0.02 if v % 3 else 0.06)
        with lock:
            now[0] -= 1
        return v * 10

    assert list(in_order(range(20), call, 5)) == [v * 10 for v in range(20)] and 2 <= most[0] <= 5
    assert list(in_order(range(3), call, 1)) == [0, 10, 20]
    begun = []

    def fails(v):
        begun.append(v)
        raise KeyError(v)

    with pytest.raises(KeyError):
        list(in_order(range(1000), fails, 4))
    assert len(begun) < 20


class Slow(BaseHTTPRequestHandler):
    """Answers a page's image with its text, after a while; counts the calls that are under way at once."""

    now, most, lock = 0, 0, threading.Lock()
    refused: set = set()
    asked: list = []

    def do_POST(self):
        import base64

        body = json.loads(self.rfile.read(int(self.headers["Content-Length"])))
        content = body["messages"][0]["content"]
        with Slow.lock:
            Slow.now += 1
            Slow.most = max(Slow.most, Slow.now)
        time.sleep(0.15)
        with Slow.lock:
            Slow.now -= 1
        if isinstance(content, str):
            text = "|".join(p.strip() for p in content.split("```")[1::2])
        else:
            text = base64.b64decode(content[1]["image_url"]["url"].split(",")[1]).decode()
        Slow.asked.append(text)
        code, reply = (400, {"error": "refused"}) if text in Slow.refused else (200, {"choices": [{"message": {"content": text}}]})
        data = json.dumps(reply).encode()
        self.send_response(code)
        self.send_header("Content-Length", str(len(data)))
        self.end_headers()
        self.wfile.write(data)

    def log_message(self, *args):
        pass


@pytest.fixture
def server():
    s = ThreadingHTTPServer(("127.0.0.1", 0), Slow)
    threading.Thread(target=s.serve_forever, daemon=True).start()
    Slow.most, Slow.refused, Slow.asked = 0, set(), []
    yield f"http://127.0.0.1:{s.server_port}"
    s.shutdown()


def books(spark, *contents):
    df = spark.createDataFrame([(f"b{i}", f"/d/b{i}.pdf", c, [i]) for i, c in enumerate(contents)], "title string, path string, content binary, ord array<int>")
    return as_resources(df, source=F.lit("s"), url=F.lit("u"), mime_type=F.lit(P.PDF))


def test_several_calls_at_once_pages_in_order(spark, server):
    client = RemoteClient("m", server, pause=0.01, parallel=6)
    book = "\f".join(f"page {i}" for i in range(18)).encode()
    (row,) = pdfs_to_markdown(books(spark, book), client=client, requests=1).collect()
    assert 4 <= Slow.most <= 6
    assert row.text.replace("\n", "") == "|".join(f"page {i}" for i in range(18)) and row.path == "/d/b0.md"


def test_a_refused_page_does_not_lose_a_book(spark, server, tmp_path):
    client, cache = RemoteClient("m", server, pause=0.01), Cache(str(tmp_path / "c"))
    Slow.refused = {"b"}
    run = lambda: pdfs_to_markdown(books(spark, b"a\fb\fc", b"d"), client=client, cache=cache).orderBy("path").collect()
    first = run()
    assert [r.text.replace("\n", "") for r in first] == ["a|<!-- page 2 could not be transcribed -->|c", "d"]
    (failed,) = cache.failures(spark).collect()
    assert failed.scope == "page-1-m" and failed.error.startswith("400") and failed.tries == 1
    asked = len(Slow.asked)
    run()
    assert Slow.asked[asked:] == ["b"] and cache.failures(spark).first().tries == 2
    Slow.refused = set()
    assert [r.text.replace("\n", "") for r in run()] == ["a|b|c", "d"] and cache.failures(spark).isEmpty()
    asked = len(Slow.asked)
    assert [r.text.replace("\n", "") for r in run()] == ["a|b|c", "d"] and len(Slow.asked) == asked


class Refusing(StandIn):
    def __init__(self):
        object.__setattr__(self, "name", "refusing")

    def split(self, text):
        if "bad" in text:
            raise ModelError("no")
        return super().split(text)


def test_a_refused_sheet_stays_whole(spark):
    df = spark.createDataFrame([("a", "# Exercise 1\nbad"), ("b", "# Exercise 1\nx"), ("c", "no heading"), ("d", None)], "title string, text string")
    rows = as_resources(df, source=F.lit("s"), url=F.lit("u"), path=F.concat(F.lit("/d/"), "title"), mime_type=F.lit(P.MARKDOWN))
    got = split_exercises(rows, client=Refusing()).orderBy("title").collect()
    assert [(r.title, r.text) for r in got] == [("a", "# Exercise 1\nbad"), ("b > Exercise 1", "# Exercise 1\nx")]


def test_a_stopped_run_repeats_no_finished_call(spark, tmp_path):
    """The run is killed in its third batch: what the first two did is kept and is not asked again."""
    calls, cache = tmp_path / "calls", Cache(str(tmp_path / "c"))
    calls.mkdir()
    batches = []

    def compute(d, stop):
        folder = str(calls)

        def call(b):
            (Path(folder) / f"{b.decode()}-{uuid.uuid4().hex}").touch()
            return b.decode().upper()

        batches.append(1)
        if stop and len(batches) == 3:
            raise RuntimeError("killed")
        ask = calling(call, 2)
        return d.select("sha256", ask("content").alias("r")).select("sha256", "r.value", "r.error")

    tasks = spark.createDataFrame([(f"w{i}",) for i in range(24)], "w string").repartition(1).select(F.sha2("w", 256).alias("sha256"), F.encode("w", "UTF-8").alias("content"))
    with pytest.raises(Exception):
        drain(tasks, "s", lambda d: compute(d, True), cache, calls=4, files=1)
    kept = {r.value.lower() for r in cache.read(spark, "s").collect()}
    assert len(kept) == 8
    df = spark.createDataFrame([(f"w{i}",) for i in range(24)] * 2, "w string")
    out = once(df, F.lit(True), F.encode("w", "UTF-8"), "s", lambda d: compute(d, False), cache)
    assert sorted((r.w, r["__value"]) for r in out.collect()) == sorted([(f"w{i}", f"W{i}") for i in range(24)] * 2)
    names = [p.name.split("-")[0] for p in calls.iterdir()]
    assert sorted(names) == sorted(f"w{i}" for i in range(24))


def values(spark, pairs):
    return spark.createDataFrame(pairs, "k string, value string").select(F.sha2("k", 256).alias("sha256"), F.lit("f").alias("filename"), "value")


def test_log_and_compaction(spark, tmp_path):
    cache = Cache(str(tmp_path / "c"))
    assert cache.compact(spark) == 0 and cache.read(spark, "s").isEmpty()
    for i in range(12):
        cache.write(values(spark, [(f"k{i % 5}", f"v{i}"), ("same", f"s{i}")]), "s")
    cache.write(values(spark, [("k0", "other")]), "t")
    keys = values(spark, [(f"k{i}", "") for i in range(6)] + [("same", "")]).select(*KEY)
    want = {"v10", "v11", "v7", "v8", "v9", "s11"}
    before = cache.read(spark, "s")  # a reader under way
    assert {r.value for r in hits(keys, before).collect()} == want and len(cache.folders()) == 13
    assert cache.compact(spark) == 13
    assert {r.value for r in hits(keys, cache.read(spark, "s")).collect()} == want == {r.value for r in hits(keys, before).collect()}
    assert cache.read(spark, "s").count() == 6 and cache.read(spark, "t").count() == 1
    (base,) = cache.folders()
    files = [p for p in (tmp_path / "c" / "records" / base).rglob("*.parquet")]
    assert len(files) == len({p.parent for p in files})  # a file a bucket
    cache.write(values(spark, [("k1", "newer")]), "s")
    assert {r.value for r in hits(keys, cache.read(spark, "s")).collect()} == want - {"v11"} | {"newer"}
    # what the last pointer covered is gone, what this one covers is still there for readers under way
    assert cache.compact(spark) == 2 and len(list((tmp_path / "c" / "records").iterdir())) == 3 and len(cache.folders()) == 1
    assert {r.value for r in hits(keys, cache.read(spark, "s")).collect()} == want - {"v11"} | {"newer"}


def test_lookups_open_only_the_buckets_asked_for(spark, tmp_path):
    cache = Cache(str(tmp_path / "c"))
    cache.write(values(spark, [(f"k{i}", "v") for i in range(300)]), "s")
    one = values(spark, [("k7", "")]).select(*KEY)
    found = cache.lookup(one, "s")
    assert hits(one, found).count() == 1
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and found.select(F.col("_metadata.file_path")).distinct().count() < 5 < cache.read(spark, "s").select(F.col("_metadata.file_path")).distinct().count()


def test_a_half_written_append_is_not_read(spark, tmp_path):
    cache = Cache(str(tmp_path / "c"))
    cache.write(values(spark, [("a", "1")]), "s")
    (done,) = [p for p in (tmp_path / "c" / "records").iterdir()]
    done.rename(done.parent / f"_{done.name.removeprefix('run=')}")
    assert cache.read(spark, "s").isEmpty()
