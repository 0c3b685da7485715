"""File sources: binary and text files with their paths, content hashes and data URLs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.functions.paths import MIME_TYPES, file_name, guess_mime_type, is_junk


def below(uri: Column, spark: SparkSession, root: str) -> Column:
    """The part of a file's URI below ``root``, decoded; null where it lies elsewhere."""
    at = spark._jvm.org.apache.hadoop.fs.Path(root)
    base = at.getFileSystem(spark._jsc.hadoopConfiguration()).makeQualified(at).toString().rstrip("/") + "/"
    plain = lambda c: F.regexp_replace(c, "^file:/+", "file:/")
    # a plus sign stands for itself in a path
    name, base = plain(F.url_decode(F.replace(uri, F.lit("+"), F.lit("%2B")))), plain(F.lit(base))
    return F.when(F.startswith(name, base), F.substring(name, F.length(base) + 1, F.length(name)))


#: File names of images, whatever their ending's case, for a scan that opens no other file.
IMAGES = "*.{" + ",".join("".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in e[1:]) for e, kind in sorted(MIME_TYPES.items()) if kind.startswith("image/")) + "}"


def read_images(spark: SparkSession, root: str) -> DataFrame:
    """``path, content`` of the images below ``root``, with paths as ``root`` is written."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", IMAGES).load(root)
    at = F.concat(F.lit(root.rstrip("/") + "/"), below(F.col("_metadata.file_path"), spark, root))
    return files.select(at.alias("path"), "content")


def read_binary(spark: SparkSession, root: str, longest: int | None = None) -> DataFrame:
    """``path, name, mime_type, length, content`` of all files below ``root`` but archivers' junk; of ``longest`` bytes at most."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root)
    if longest is not None:
        files = files.where(F.col("length") <= longest)
    path = F.col("path")
    return files.where(~is_junk(path)).select("path", file_name(path).alias("name"), guess_mime_type(path).alias("mime_type"), "length", "content")


def read_text(spark: SparkSession, root: str, glob: str = "*.md") -> DataFrame:
    """``path, text`` of whole UTF-8 files."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", glob).text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def content_hash(content: Column) -> Column:
    """SHA-256 of the bytes, lower-case hex."""
    return F.sha2(content, 256)


def data_url(content: Column, mime_type: Column) -> Column:
    """The bytes as a data URL; an unknown type is an error."""
    unknown = F.raise_error(F.lit("unknown MIME type")).cast("string")
    return F.concat(F.lit("data:"), F.coalesce(mime_type, unknown), F.lit(";base64,"), F.base64(content))
