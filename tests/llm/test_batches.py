"""Batches of Python tasks are bounded by bytes, not by rows alone."""

import pyarrow as pa
from pyspark.sql import functions as F

from cartulary.llm import common


def test_tasks_get_texts_in_small_batches(spark):
    spark.conf.unset(common._BATCH_SETTING)

    def bytes_of(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([batch.nbytes])], ["n"])

    texts = spark.range(0, 300, 1, 1).select(F.repeat(F.lit("long text "), 10_000).alias("text"))
    common.package_on_workers(spark)
    found = [row.n for row in texts.mapInArrow(bytes_of, "n long").collect()]
    assert sum(found) >= 300 * 100_000 and max(found) <= common.BATCH_BYTES + 200_000
    spark.conf.set(common._BATCH_SETTING, "1000000")
    common.package_on_workers(spark)
    assert spark.conf.get(common._BATCH_SETTING).rstrip("b") == "1000000"
    spark.conf.unset(common._BATCH_SETTING)
