"""Connected components of a link table by minimum labels and pointer jumping."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.scratch import pin


def connected_components(links: DataFrame) -> DataFrame:
    """``key, label``: the smallest key of each linked key's component; ``links``: rows of ``a, b``.

    Each round a key takes the smallest label among its neighbours, then the label
    of that label, so a chain of n keys needs about log n rounds.  Labels and links
    are narrow tables, written to the shared scratch folder each round.
    """
    both = pin(links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "links")
    labels = pin(both.groupBy(F.col("a").alias("key")).agg(F.min("b").alias("label"))
                 .select("key", F.least("key", "label").alias("label")), "labels")
    while True:
        seen = both.join(labels.withColumnRenamed("key", "b"), "b").groupBy(F.col("a").alias("key")).agg(F.min("label").alias("_near"))
        nearer = labels.join(seen, "key").select("key", F.col("label").alias("_old"), F.least("label", "_near").alias("label"))
        jump = labels.select(F.col("key").alias("label"), F.col("label").alias("_far"))
        moved = pin(nearer.join(jump, "label").select("key", "_old", F.least("label", "_far").alias("label")), "labels")
        labels = moved.select("key", "label")
        if moved.where("label != _old").isEmpty():
            return labels
