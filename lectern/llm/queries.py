"""The subpackage's queries: each applies one operator, with its production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lectern.llm.words import vocabulary

#: The public vocabulary files, by name: each worker looks up where they lie. A path works as well.
WORD_BPE = "word_bpe_49k.json"
BYTE_BPE = "byte_bpe_50k.tiktoken"
PIECE_BPE = "piece_bpe_32k.model"


def tokenizer_path(name: str) -> str:
    """Where a public vocabulary file lies on this machine."""
    return vocabulary(name)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.tokencounts import count_edited, sample_edits

    docs = _table(spark, sf_dir, "documents")
    return count_edited(docs, sample_edits(F.col("text")), BYTE_BPE)


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.toxicity import judge

    return judge(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.mixing import copies

    mixed = copies(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "source", "copies")


#: The contract's rules: host, path, action.
URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.urls import judge

    rules = spark.sql("SELECT * FROM VALUES " + ", ".join(map(str, URL_RULES)) + " AS r(host, path, action)")
    return judge(_table(spark, sf_dir, "pages"), rules)


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.warc import round_trip

    return round_trip(spark, _table(spark, sf_dir, "pages"))


def op6_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.simhash import near_duplicates

    return near_duplicates(_table(spark, sf_dir, "documents")).select("doc_id", "fingerprint", "component_id")


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.sharding import assign

    placed = assign(_table(spark, sf_dir, "documents"), shards=24)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )


def op8_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.neighbours import nearest

    return nearest(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op9_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.fingerprints import fingerprint_edits

    return fingerprint_edits(_table(spark, sf_dir, "documents"))


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.packing import pack

    return pack(_table(spark, sf_dir, "documents"), WORD_BPE)


def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.pieces import digests

    return digests(_table(spark, sf_dir, "documents"), PIECE_BPE)


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.alignment import align

    return align(_table(spark, sf_dir, "documents"), BYTE_BPE, PIECE_BPE)


def op13_schema_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    from lectern.llm.migration import migrate_clients

    return migrate_clients(spark, _table(spark, sf_dir, "clients"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_token_counts, op2_toxicity, op3_mixing, op4_url_filters, op5_warc,
        op6_simhash_near_dedup, op7_sharding, op8_neighbours, op9_fingerprints, op10_packing,
        op11_sentencepiece, op12_alignment, op13_schema_rewrite,
    )
}

#: DuckDB SQL for those queries that SQL can express. The others rest on XXH64, random rounding, models or tokenizers.
ORACLE_SQL: dict[str, str] = {
    "op4_url_filters": r"""
        WITH u AS (
            SELECT page_id,
                   lower(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), '')) AS host,
                   coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
            FROM pages
        ), r AS (
            SELECT page_id, host, path, CASE
                WHEN ('.' || host) LIKE '%.example.net' AND starts_with(path, '/en/') THEN 'example.net/en/'
                WHEN ('.' || host) LIKE '%.example.com' AND starts_with(path, '/de/') THEN 'example.com/de/'
                WHEN ('.' || host) LIKE '%.org' AND starts_with(path, '/fr/') THEN 'org/fr/'
                WHEN ('.' || host) LIKE '%.net' AND starts_with(path, '/') THEN 'net/'
            END AS rule
            FROM u
        )
        SELECT page_id, host, path, rule,
               CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
        FROM r
    """,
    "op5_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p
        ), t AS (
            SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d
        )
        SELECT page_id, payload_bytes, payload_digest,
               CASE WHEN payload_bytes >= 1000 AND page_id < top THEN 'revisit' ELSE 'response' END AS record_type,
               CASE WHEN payload_bytes >= 1000 AND page_id < top THEN top END AS refers_to
        FROM t
    """,
}
