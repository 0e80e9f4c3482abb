import tracemalloc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from caseweave import deploy
from caseweave.functions.nearest import hashed_counts


def test_long_rows_come_in_small_batches(spark):
    @F.arrow_udf("long")
    def together(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            yield pa.array([len(batch)] * len(batch), pa.int64())

    deploy.ensure_on_workers(spark)
    long = spark.range(0, 3000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))
    most = long.select(together("text").alias("n")).agg(F.max("n")).first()[0]
    assert most * 10_000 <= 2 * deploy.BATCH_BYTES


def test_a_bound_that_the_session_set_stays(spark):
    before = spark.conf.get(deploy._SETTING)
    try:
        spark.conf.set(deploy._SETTING, str(9 << 20))
        deploy.ensure_on_workers(spark)
        assert spark.conf.get(deploy._SETTING) == str(9 << 20)
    finally:
        spark.conf.set(deploy._SETTING, before)


def test_many_tokens_are_counted_some_rows_at_a_time():
    rng = np.random.default_rng(4)
    words = [f"w{i}" for i in range(50)]
    texts = [None, [], *[[words[j] for j in rng.integers(0, 50, n)] for n in (3, 400_000, 0, 7, 300_000, 1_200_000, 5)], None]
    batch = pa.array(texts, pa.list_(pa.string()))
    found = hashed_counts(batch, 64)
    assert found.to_pylist() == [hashed_counts(pa.array([t], batch.type), 64).to_pylist()[0] for t in texts]
    assert found.null_count == 2 and [sum(x) for x in found.drop_null().to_pylist()] == [len(t) for t in texts if t is not None]
    assert hashed_counts(batch.slice(2, 3), 64).to_pylist() == found.to_pylist()[2:5]

    short = pa.array([[words[j % 50] for j in range(200)]] * 10_000, batch.type)
    tracemalloc.start()
    hashed_counts(short, 64)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 40 << 20  # the codes and cells of all 2,000,000 tokens at once are 64 MB
