"""Session helpers: shipping this package to executors and writing intermediate tables to shared storage."""

from __future__ import annotations

import atexit
import os
import shutil
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

_PACKAGE = Path(__file__).resolve().parent
_SHIPPED: set[str] = set()
_OWN_SHARED: dict[str, str] = {}
_WRITTEN: dict[str, list[str]] = {}


def ship(spark: SparkSession) -> None:
    """Send this package's sources to the executors, once per application.

    Python workers do not inherit the driver's ``sys.path``. The zip goes through Spark's own file server, so it
    needs no folder that driver and executors share.
    """
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    target = Path(_own_folder("lectern-ship-")) / "lectern_pkg.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(_PACKAGE.rglob("*.py")):
            z.write(p, Path(_PACKAGE.name) / p.relative_to(_PACKAGE))
    spark.sparkContext.addPyFile(str(target))
    _SHIPPED.add(app)


def _own_folder(prefix: str) -> str:
    """A temporary folder of the driver's, gone when it ends."""
    folder = tempfile.mkdtemp(prefix=prefix)
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where that is unset, a session on this machine alone gets a temporary folder; on a cluster it is an error, as
    executors would not see the driver's folder.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    app = spark.sparkContext.applicationId
    if app not in _OWN_SHARED:
        _OWN_SHARED[app] = Path(_own_folder("lectern-shared-")).as_uri()
    return _OWN_SHARED[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A path of its own in the shared folder, which ``clean`` deletes."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    _WRITTEN.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def local_path(uri: str) -> str | None:
    """The path of a ``file:`` URI or bare path, else None."""
    if uri.startswith("file:"):
        return "/" + uri[len("file:") :].lstrip("/")
    return uri if uri.startswith(os.sep) else None


def open_store(uri: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or bare path, and the path there; for use in tasks as well."""
    return fs.FileSystem.from_uri(uri if ":" in uri.split("/", 1)[0] else f"file://{uri}")


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    This cuts the lineage as a reliable checkpoint does, yet runs the plan once where ``checkpoint()`` runs the
    last stage twice, and leaves columnar files that later readers can prune.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def clean(spark: SparkSession) -> int:
    """Delete what this application wrote under ``new_path``, once no DataFrame over it is needed; returns how many."""
    paths = _WRITTEN.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)
    return len(paths)
