import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm.common import BATCH_BYTES, BATCH_SETTING, bounded_sample, lowest, saved


@pytest.mark.parametrize("rows", [1, 50, 700, 5000])
def test_sample_is_of_the_lowest_hashes(spark, rows):
    df = spark.range(2000).select(F.when(F.col("id") % 3 > 0, F.col("id") % 400).alias("id"))  # many nulls and copies
    got = [r.id for r in bounded_sample(df, "id", rows).collect()]
    assert got == [r.id for r in df.orderBy(F.xxhash64("id"), "id").limit(rows).collect()]


def test_only_a_bounded_rest_is_put_in_order(spark):
    df = spark.range(0, 100_000, 1, 16)
    plan = bounded_sample(df, "id", 500)._jdf.queryExecution().optimizedPlan().toString()
    assert "Filter" in plan and "xxhash64" in plan.split("Filter", 1)[1]
    assert 500 <= lowest(df, "id", 0.01).count() <= 1500
    assert lowest(df, "id", 1.0).count() == 100_000


def test_texts_go_to_python_in_batches_of_bounded_bytes(spark):
    rows = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("a long text, "), 8_000).alias("text"))  # 30 MB

    def sizes(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes], pa.int64())], ["n"])

    before = spark.conf.get(BATCH_SETTING)
    found = [r.n for r in saved(rows.mapInArrow(sizes, "n long"), "test-batches").collect()]
    assert sum(found) > 30_000_000 and max(found) < 2 * BATCH_BYTES
    assert spark.conf.get(BATCH_SETTING) == before
