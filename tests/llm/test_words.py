import pytest
from pyspark.sql import functions as F

from lectern.llm import mixing, nearcopies, sharding, simhash
from lectern.llm.words import KEYS, numbered, row_keys

CLASH = ["__rk1", "__RK2", "__n", "__t", "__again", "__c", "__i", "__part", "__root", "node", "a`b", "x.y"]


@pytest.fixture(scope="module")
def clashing(spark):
    """Rows that differ in where their nulls stand, with a map, nested values and columns of the operators' own names."""
    long = " ".join(f"w{i}" for i in range(60))
    rows = [(1, None, "x y z one two three"), (1, "x y z one two three", None), (2, long, "en"), (3, long + " more", "en"), (3, long + " more", "en"), (4, None, None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    df = df.withColumn("source", F.lit("s")).withColumn("props", F.create_map(F.lit("k"), F.col("lang")))
    df = df.withColumn("list", F.array(F.lit(None).cast("int"), F.lit(1)))
    for i, c in enumerate(CLASH):
        df = df.withColumn(c, F.lit(i))
    return df


def test_nulls_and_their_places_count(spark):
    df = spark.createDataFrame([(None, "a"), ("a", None), ("a", "a"), (None, None), ("a", "a")], "p string, q string")
    assert df.select(*row_keys(df)).distinct().count() == 4
    nested = df.select(F.array("p", "q").alias("l"), F.struct("p", "q").alias("s"), F.create_map(F.lit(1), "p", F.lit(2), "q").alias("m"))
    for c in ("l", "s", "m"):
        one = nested.select(c)
        assert one.select(*row_keys(one)).distinct().count() == 4


def test_equal_rows_are_numbered(spark):
    df = spark.createDataFrame([(1, None)] * 25 + [(2, "b")] + [(None, None)] * 3, "a long, b string").repartition(3)
    got = numbered(df, "i", most=10).collect()
    for key, n in (((1, None), 25), ((2, "b"), 1), ((None, None), 3)):
        assert sorted(r.i for r in got if (r.a, r.b) == key) == list(range(n))


def test_keep_one_loses_no_document(clashing):
    """Equal texts and those without words fall together; the two long texts are similar, but not within three bits."""
    long = " ".join(f"w{i}" for i in range(60))
    common = [(1, None), (1, "x y z one two three"), (2, long)]
    for keep, more in ((nearcopies.keep_one, []), (simhash.keep_one, [(3, long + " more")])):
        kept = keep(clashing)
        assert kept.columns == clashing.columns
        assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=str) == sorted(common + more, key=str)


def test_mix_and_shards_take_any_columns(clashing, tmp_path):
    got = mixing.mix(clashing)
    taken = mixing.copies(clashing)
    assert got.columns == clashing.columns and got.count() == taken.agg(F.sum("copies")).first()[0]
    assert sharding.assign(clashing, 3).count() == clashing.count()
    sharding.write_shards(clashing.drop("props", "a`b", "x.y"), str(tmp_path / "s"), 3)
    assert clashing.sparkSession.read.parquet(str(tmp_path / "s")).count() == clashing.count()


def test_equal_rows_spread_over_cells_and_shards(spark):
    """A third of all rows equal: their copies spread over many cells, their shards and slots differ."""
    same = spark.range(3000).selectExpr("7L AS doc_id", "'one two three' AS text", "'hot' AS source")
    docs = same.union(spark.range(6000).selectExpr("id + 10", "concat('w ', id)", "concat('s', id % 2)"))
    taken = mixing.copies(docs, cell=50)
    assert taken.count() == 9000
    for r in taken.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("want")).collect():
        assert abs(r.t - r.want) <= 3
    placed = sharding.assign(docs, 24, rows_per_bucket=50)
    counts = [r["count"] for r in placed.where("doc_id = 7").groupBy("shard").count().collect()]
    assert len(counts) == 24 and max(counts) - min(counts) <= 2
    mixed = mixing.mix(docs, cell=50)
    assert mixed.where("doc_id = 7").count() == taken.where("doc_id = 7").agg(F.sum("copies")).first()[0]
    assert set(KEYS) <= set(taken.columns)


def test_many_sources(spark):
    """Targets of many sources equal a sequential filling of levels."""
    n = 500
    df = spark.range(n).selectExpr("concat('s', lpad(id, 4, '0')) AS source", "1 + (id * 7919) % 1000 AS size").repartition(7)
    sizes = {r.source: r["size"] for r in df.collect()}
    weights = {s: (5, 2, 1)[i % 3] for i, s in enumerate(sorted(sizes))}
    low, high = 0.0, 1e9
    for _ in range(200):
        level = (low + high) / 2
        low, high = (level, high) if sum(min(3 * sizes[s], weights[s] * level) for s in sizes) < sum(sizes.values()) else (low, level)
    for r in mixing.source_targets(df).collect():
        assert r.target == pytest.approx(min(3 * sizes[r.source], weights[r.source] * low), rel=1e-9)
