import os
import random
import sys

import pytest
from hypothesis import settings

sys.path.append(os.path.dirname(os.path.abspath(__file__)))

from edges import CLASHES, DOCUMENTS, edge_documents  # noqa: E402

settings.register_profile("llm", deadline=None)
settings.load_profile("llm")

@pytest.fixture(scope="session")
def edge_dir(spark, tmp_path_factory):
    """A table folder with the edge documents, extra columns of clashing names, labels and embeddings."""
    from pyspark.sql import functions as F
    out = str(tmp_path_factory.mktemp("edge"))
    docs = spark.createDataFrame(edge_documents(), DOCUMENTS).withColumns({c: F.lit("x") for c in CLASHES})
    docs.repartition(3).write.parquet(f"{out}/documents.parquet")
    labels = [(i, int(t is not None and len(t) > 100), 0) for i, t, *_ in edge_documents()] + [(None, 1, 0), (5, None, 0)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{out}/labels.parquet")
    rng = random.Random(6)
    vectors = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(300)]
    rows = [(i, v, 0) for i, v in enumerate(vectors)] + [(300 + i, vectors[0], 0) for i in range(40)]
    rows += [(400, None, 0), (401, [0.0] * 8, 0), (402, [float("nan")] * 8, 0), (403, [None] * 8, 0), (404, [1.0, 2.0], 0), (405, [float("inf")] + [1.0] * 7, 0)]
    spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int").write.parquet(f"{out}/embeddings.parquet")
    return out


@pytest.fixture(scope="session")
def empty_dir(spark, edge_dir, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("empty"))
    for t in ("documents", "labels", "embeddings"):
        spark.read.parquet(f"{edge_dir}/{t}.parquet").limit(0).write.parquet(f"{out}/{t}.parquet")
    return out


@pytest.fixture(scope="session")
def odd_dir(spark, edge_dir, tmp_path_factory):
    """The edge tables with repeated rows and null ids."""
    from pyspark.sql import functions as F
    out = str(tmp_path_factory.mktemp("odd"))
    docs = spark.read.parquet(f"{edge_dir}/documents.parquet")
    no_id = docs.where("doc_id % 7 = 0").withColumn("doc_id", F.lit(None).cast("long"))
    all_null = docs.limit(2).select(*[F.lit(None).cast(docs.schema[c].dataType).alias(c) for c in docs.columns])
    docs.union(docs.where("doc_id % 3 = 0")).union(no_id).union(all_null).write.parquet(f"{out}/documents.parquet")
    spark.read.parquet(f"{edge_dir}/labels.parquet").write.parquet(f"{out}/labels.parquet")
    rows = spark.read.parquet(f"{edge_dir}/embeddings.parquet")
    rows.union(rows.where("vec_id < 100")).union(rows.limit(3).withColumn("vec_id", F.lit(None).cast("long"))).write.parquet(f"{out}/embeddings.parquet")
    return out
