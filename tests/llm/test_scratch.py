"""Pinned tables live below the shared checkpoint folder until they are released."""
import os

from pyspark.sql import functions as F

from sensorlake.llm.scratch import pin, release
from sensorlake.session import ensure_checkpoint_dir


def _folder(spark):
    return f"{ensure_checkpoint_dir(spark)}/llm-{spark.sparkContext.applicationId}".removeprefix("file:")


def test_pin_and_release(spark):
    df = spark.range(100).select("id", F.lit(None).cast("string").alias("nothing"))
    pinned = pin(df, "numbers")
    assert pinned.schema.names == df.schema.names and pinned.count() == 100
    assert any(n.startswith("numbers-") for n in os.listdir(_folder(spark)))
    release(spark)
    assert not os.path.exists(_folder(spark))
    assert pin(df).count() == 100  # the folder comes back with the next table
