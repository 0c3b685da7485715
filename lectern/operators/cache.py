"""Results kept by content: a log of (scope, sha256, filename, value) in buckets, compacted now and then, read by joins."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.runtime import materialise, new_path, open_store

KEY = ["sha256", "filename"]
SCHEMA = "sha256 string, filename string, value string, at long, error string, tries int, scope string, bucket int"
#: Keys are dealt to buckets by the first six bits of their hash.
BUCKETS = 64


def bucket_of(sha256: Column) -> Column:
    return F.coalesce((F.conv(F.substring(sha256, 1, 2), 16, 10).cast("int") * BUCKETS / 256).cast("int"), F.lit(0))


def cache_key(df: DataFrame, content: str = "content", filename: str = "filename") -> DataFrame:
    """``df`` with ``sha256`` of its content; with the scope and the output's file name it is the key."""
    return df.withColumn("sha256", F.sha2(F.col(content).cast("binary"), 256)).withColumn("filename", F.col(filename))


def hits(df: DataFrame, cached: DataFrame) -> DataFrame:
    """Rows with a cached value, as ``value``; of several values of a key the last written counts."""
    last = cached.groupBy(*KEY).agg(F.max_by("value", "at").alias("value"))
    return df.join(last, KEY)


def misses(df: DataFrame, cached: DataFrame) -> DataFrame:
    """Rows without a cached value."""
    return df.join(cached.select(*KEY), KEY, "left_anti")


def _last(rows: DataFrame) -> DataFrame:
    """The last record of each key; how often a key has failed in a row is counted on."""
    record = F.max_by(F.struct("value", "at", "error", "tries"), F.struct("at", "tries", F.coalesce("value", F.lit("")))).alias("r")
    return rows.groupBy("scope", "bucket", *KEY).agg(record).select(*KEY, "r.value", "r.at", "r.error", "r.tries", "scope", "bucket")


@dataclass(frozen=True)
class Cache:
    """A cache table at ``path``; a scope is operator, version and model together.

    Every append is a folder of its own under ``records``, which appears whole. A compaction writes the last record of each key, a file a
    bucket, as one more folder, the base, and then swaps the pointer, which names the base and the folders that it covers: a
    reader that asks before sees the old state, one that asks after the new. What a pointer covers stays until the compaction
    after next, for readers that are under way. Appends may happen at any time, compactions one at a time.
    """

    path: str

    def _state(self) -> tuple[fs.FileSystem, str, dict]:
        store, root = open_store(self.path)
        pointer = f"{root}/_current.json"
        if store.get_file_info(pointer).type == fs.FileType.NotFound:
            return store, root, {"covered": []}
        with store.open_input_stream(pointer) as f:
            return store, root, json.loads(f.read())

    def folders(self) -> list[str]:
        """The folders that hold the present state, in the order of time."""
        store, root, state = self._state()
        found = store.get_file_info(fs.FileSelector(f"{root}/records", allow_not_found=True))
        covered = set(state["covered"])
        return sorted(f.base_name for f in found if f.base_name.startswith("run=") and f.base_name not in covered)

    def records(self, spark: SparkSession, scope: str | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """All records of the present state, failures too; of ``buckets`` only, other folders are not opened."""
        root = f"{self.path.rstrip('/')}/records"
        paths = [f"{root}/{f}" for f in self.folders()]
        rows = spark.read.schema(SCHEMA).option("basePath", root).parquet(*paths).drop("run") if paths else spark.createDataFrame([], SCHEMA)
        rows = rows if scope is None else rows.where(F.col("scope") == scope)
        return rows if buckets is None else rows.where(F.col("bucket").isin([int(b) for b in buckets]))

    def read(self, spark: SparkSession, scope: str, buckets: Iterable[int] | None = None) -> DataFrame:
        """The records of a scope that have a value and no failure."""
        return self.records(spark, scope, buckets).where("value IS NOT NULL AND error IS NULL")

    def lookup(self, keys: DataFrame, scope: str) -> DataFrame:
        """``read`` of the buckets that ``keys(sha256)`` fall into: at most ``BUCKETS`` numbers go to the driver."""
        asked = [r.b for r in keys.select(bucket_of(F.col("sha256")).alias("b")).distinct().collect()]
        return self.read(keys.sparkSession, scope, asked)

    def failures(self, spark: SparkSession) -> DataFrame:
        """``scope, sha256, filename, error, tries`` of the keys whose last try failed."""
        return _last(self.records(spark)).where("error IS NOT NULL").select("scope", *KEY, "error", "tries")

    def write(self, values: DataFrame, scope: str) -> None:
        """Append ``values(sha256, filename, value)``, and ``error`` and ``tries`` where they have them; readers take the last of a key."""
        error = F.col("error") if "error" in values.columns else F.lit(None).cast("string")
        tries = F.col("tries").cast("int") if "tries" in values.columns else F.lit(1)
        rows = values.select(*KEY, "value", F.unix_micros(F.current_timestamp()).alias("at"), error.alias("error"), tries.alias("tries"), F.lit(scope).alias("scope"))
        self._put(rows.withColumn("bucket", bucket_of(F.col("sha256"))).repartition("bucket"))

    def _put(self, rows: DataFrame) -> str:
        """Write rows as a folder that takes its name, by the time, when it is whole."""
        store, root, _ = self._state()
        name = f"{time.time_ns():020d}-{uuid.uuid4().hex}"
        rows.write.partitionBy("scope", "bucket").parquet(f"{self.path.rstrip('/')}/records/_{name}")
        store.move(f"{root}/records/_{name}", f"{root}/records/run={name}")
        return f"run={name}"

    def compact(self, spark: SparkSession) -> int:
        """Make one base of the present state; returns how many folders it covers. Lookups stay right at every moment."""
        store, root, before = self._state()
        covered = self.folders()
        if not covered:
            return 0
        base = self._put(_last(self.records(spark)).repartition(BUCKETS, "bucket"))
        with store.open_output_stream(f"{root}/_current.json.part") as f:
            f.write(json.dumps({"base": base, "covered": covered}).encode())
        store.move(f"{root}/_current.json.part", f"{root}/_current.json")
        for gone in before["covered"]:  # nobody reads the state before the last
            if store.get_file_info(f"{root}/records/{gone}").type != fs.FileType.NotFound:
                store.delete_dir(f"{root}/records/{gone}")
        return len(covered)

    def through(self, df: DataFrame, scope: str, compute: Callable[[DataFrame], DataFrame], content: str = "content", filename: str = "filename") -> DataFrame:
        """``df`` with ``value``: cached where there is one, else computed, once a key, and kept.

        ``compute`` gets ``sha256, filename`` and the content and adds ``value``.
        """
        spark = df.sparkSession
        keyed = cache_key(df, content, filename)
        missing = misses(keyed.select(*KEY, content), self.read(spark, scope)).dropDuplicates(KEY)
        self.write(compute(missing), scope)
        return hits(keyed, self.read(spark, scope))


def drain(tasks: DataFrame, scope: str, compute: Callable[[DataFrame], DataFrame], cache: Cache, calls: int = 16, files: int | None = None) -> None:
    """Do the ``tasks(sha256, content)`` batch by batch, and keep each batch's results before the next is begun.

    Tasks are written as a queue of files of ``calls`` each, which a stream drains, ``files`` of them in a batch (twice the cores). A run that is
    stopped leaves the finished batches in the cache, and the next run asks for the rest only. ``compute`` gives
    ``sha256, value``, and ``error`` where a call failed: that is kept as a failure, with the number of tries so far, and tried again by the next run.
    """
    spark = tasks.sparkSession
    queue, done = new_path(spark, "queue"), new_path(spark, "drained")
    tasks.select("sha256", "content").write.option("maxRecordsPerFile", calls).parquet(queue)
    if spark.read.schema("sha256 string, content binary").parquet(queue).isEmpty():
        return
    failed = cache.records(spark, scope).where("error IS NOT NULL").groupBy("sha256").agg(F.max("tries").alias("before"))
    failed = materialise(failed, "failed")

    def keep(batch: DataFrame, number: int) -> None:
        made = compute(batch)
        error = F.col("error") if "error" in made.columns else F.lit(None).cast("string")
        made = made.select("sha256", F.lit("value").alias("filename"), "value", error.alias("error"))
        made = made.join(failed, "sha256", "left").withColumn("tries", F.coalesce("before", F.lit(0)) + 1)
        cache.write(made, scope)

    width = files or 2 * spark.sparkContext.defaultParallelism
    stream = spark.readStream.schema("sha256 string, content binary").option("maxFilesPerTrigger", width).parquet(queue)
    stream.writeStream.foreachBatch(keep).option("checkpointLocation", done).trigger(availableNow=True).start().awaitTermination()


def once(df: DataFrame, gate: Column, content: Column, scope: str, compute: Callable[[DataFrame], DataFrame], cache: Cache | None = None, calls: int = 16) -> DataFrame:
    """``df`` with ``__value``: what ``compute`` makes of each distinct content of the rows that pass the gate; null elsewhere.

    ``compute`` gets ``sha256, content`` (bytes) and returns ``sha256, value``, a string, and may return ``error``: such a value, if there is one, serves this run but is
    no hit of the next. It runs once for a content, and its results are written to shared storage, or batch by batch to the cache, before anything reads
    them: no later step and no task that runs again repeats a model's call for a result that is kept. ``calls``: see ``drain``.
    """
    data = F.when(gate, content).cast("binary")
    keyed = df.withColumn("__sha", F.sha2(data, 256))
    some = keyed.where("__sha IS NOT NULL").groupBy(F.col("__sha").alias("sha256")).agg(F.first(data).alias("content"))
    if cache is None:
        made = materialise(compute(some).select("sha256", "value"), "made")
    else:
        # of the contents at hand, as another run may write on
        keys = materialise(keyed.where("__sha IS NOT NULL").select(F.col("__sha").alias("sha256")).distinct(), "keys")
        drain(some.join(cache.lookup(keys, scope).select("sha256"), "sha256", "left_anti"), scope, compute, cache, calls)
        asked = [r.b for r in keys.select(bucket_of(F.col("sha256")).alias("b")).distinct().collect()]
        kept = cache.records(df.sparkSession, scope, asked).where("filename = 'value'")
        last = kept.groupBy("sha256").agg(F.max_by("value", F.struct("at", "tries")).alias("value"))
        made = materialise(keys.join(last, "sha256").select("sha256", "value"), "made")
    return keyed.join(made.toDF("__sha", "__value"), "__sha", "left").drop("__sha")
