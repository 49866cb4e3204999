import numpy as np
import pytest
from pyspark.sql import functions as F
from tidemark.llm import _ranges as R


@pytest.mark.parametrize("n", [1, 7, 16, 60])
def test_blocks_rise_with_the_key_and_are_even(spark, monkeypatch, n):
    monkeypatch.setattr(R, "COARSE", 16)
    random = np.random.default_rng(n)
    keys = [int(x) for x in random.integers(-5000, 5000, 3000)] + [10**15, 10**15 + 1]
    df = spark.createDataFrame([(k,) for k in keys], "id long")
    cut = R.ranges(df, "id", n)
    rows = df.withColumn("b", cut.block).orderBy("id").collect()
    places = [r.b for r in rows]
    assert places == sorted(places) and 0 <= min(places) and max(places) < cut.count
    sizes = np.bincount(places[:-250], minlength=cut.count)
    assert n == 1 or sizes.max() < 4 * len(keys) / n


def test_odd_keys(spark):
    schema = "id long"
    for keys in ([], [None], [None, 5, 5, 5], [1]):
        df = spark.createDataFrame([(k,) for k in keys], schema)
        for n in (1, 4, 5000):
            cut = R.ranges(df, "id", n)
            got = df.withColumn("b", cut.block).filter((F.col("b") < 0) | (F.col("b") >= cut.count) | F.col("b").isNull())
            assert got.count() == 0


def test_number_of_blocks_follows_the_size(spark, monkeypatch, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    assert R.blocks(docs) == 4
    monkeypatch.setattr(R, "BLOCK_BYTES", 10_000)
    assert R.blocks(docs) > 10
