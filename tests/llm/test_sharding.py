import zlib

import pytest

from lectern.llm.sharding import assign, write_shards


@pytest.mark.parametrize("per_bucket", [2000, 20])
def test_shards_match_the_mixture(spark, per_bucket):
    rows = [(i, f"text {i} é", "hot" if i % 3 else f"s{i % 4}") for i in range(3000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    got = assign(docs, 24, rows_per_bucket=per_bucket).toPandas()
    counts = got.shard.value_counts()
    assert len(counts) == 24 and counts.max() - counts.min() <= 1 and counts.sum() == 3000
    for _, g in got.groupby("shard"):
        assert sorted(g.slot) == list(range(len(g)))
    by = got.groupby(["source", "shard"]).size().unstack(fill_value=0)
    assert (by.max(axis=1) - by.min(axis=1)).max() <= 2
    texts = {i: t.encode() for i, t, _ in rows}
    assert all(zlib.crc32(texts[i]) == c and len(texts[i]) + 8 == n for i, c, n in zip(got.doc_id, got.text_crc32, got["size"]))
    again = assign(docs.repartition(5), 24, rows_per_bucket=per_bucket).toPandas()
    assert got.set_index("doc_id")["slot"].sort_index().equals(again.set_index("doc_id")["slot"].sort_index())


def test_many_small_sources_do_not_meet(spark):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'t' AS text", "concat('s', id) AS source")
    got = assign(docs, 8).toPandas()
    counts = got.shard.value_counts()
    assert counts.max() - counts.min() <= 1


def test_odd_rows(odd_docs, no_docs, tmp_path):
    got = assign(odd_docs, 24).collect()
    assert len(got) == odd_docs.count() and {r.slot for r in got} == {0}
    assert sorted((r["size"], r.text_crc32) for r in got)[:4] == [(8, 0)] * 3 + [(11, zlib.crc32(b"one"))]
    assert assign(no_docs).count() == 0
    write_shards(odd_docs.drop("shard"), str(tmp_path / "s"), 3)
    back = odd_docs.sparkSession.read.parquet(str(tmp_path / "s"))
    assert back.count() == odd_docs.count() and back.select("shard").distinct().count() == 3
