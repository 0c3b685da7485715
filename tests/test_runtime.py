from pathlib import Path

from lectern.runtime import clean, local_path, materialise, shared_dir


def test_materialise_and_clean(spark):
    folder = Path(local_path(shared_dir(spark)))
    before = set(folder.glob("numbers-*"))
    df = materialise(spark.range(10), "numbers")
    assert df.count() == 10 and df.dtypes == spark.range(1).dtypes
    assert len(set(folder.glob("numbers-*")) - before) == 1
    assert clean(spark) >= 1 and set(folder.glob("numbers-*")) == before and clean(spark) == 0
    assert materialise(spark.range(0), "none").count() == 0
    assert local_path("hdfs://x/y") is None
