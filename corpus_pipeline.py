"""The corpus pipeline: quality, near-duplicates, secrets, mix, token ids.

Every stage takes the documents that its predecessor kept and returns documents, the last
one their token ids.  Stages are written as Parquet and read again, so that each is judged
on its own input and a failure repeats one stage only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import bpe, gam, mixing, secrets, setsketch
from sensorlake.llm.scratch import pin

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
KEEP = 0.7  # the least score of a good document


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier rejects go (operator 2).

    A null text is scored as an empty one; rows with a null id are scored like others and never learned from; repeated
    rows score alike, so they stay or go together; without labels of both kinds every score is the share of label 1
    (0.5 without any), and all documents stay or go by it.  An empty table gives an empty one; columns beyond those of
    documents are left out.
    """
    model = gam.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return gam.score(docs.select(COLUMNS), model).where(F.col("score") >= KEEP).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, one with the smallest id (operator 3).

    Only rows with equal or linked texts go.  Rows that share an id and the words are repeats, of which the one
    with the least text stays; other rows that share an id stay.  A row without words goes only if another has
    its id and its text.  Rows with a null id are compared like others and stay where nothing similar has an id;
    null ids count as equal.  An empty table gives an empty one; columns beyond those of documents are left out.
    """
    own = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("key") == F.col("component_key"))
    chosen = setsketch.groups(docs, percent=80).where(own).select(F.col("doc_id").alias("_id"), F.col("key").alias("_key")).distinct()
    named = setsketch.with_keys(docs.select(COLUMNS))
    # a text without words is told by its digest, which is longer than a class key, and a null one by no bytes
    key = F.coalesce("key", F.sha2("text", 256).cast("binary"), F.lit(b""))
    least = named.groupBy("doc_id", key.alias("key")).agg(F.min(F.struct("text", "lang", "source", "n_chars")).alias("row"))
    found = least.join(pin(chosen, "kept"), F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("key") == F.col("_key")), "left")
    return found.where("_key is not null or length(key) <> 16").select("doc_id", "row.*")


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the texts (operator 7).

    Every row stays: null and empty texts as they are, repeated rows and rows without an id like others.  ``n_chars`` is
    the length of a masked text; a text without a secret keeps the number it came with, null included.  An empty table
    gives an empty one; columns beyond those of documents are left out.
    """
    found = secrets.scan(docs.select(COLUMNS))
    text = secrets.masked(F.col("row.text"), F.col("spans"))
    out = found.select("row.doc_id", text.alias("text"), "row.lang", "row.source", "row.n_chars", F.size("spans").alias("found"))
    length = F.when(F.col("found") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return out.select("doc_id", "text", "lang", "source", length.cast("long").alias("n_chars"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of the sources takes them (operator 4).

    Null and empty texts have size 0 and are taken like the smallest documents; a null source is a source of its own;
    repeated rows count one by one, and rows that share an id and a size are ordered by all their columns, so reruns
    agree.  An empty table gives an empty one; columns beyond those of documents are left out.
    """
    return mixing.mix(docs.select(COLUMNS))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """``doc_id, ids`` of every document of the mix (operator 8).

    Null and empty texts have no ids; a document that the mix takes twice gives two rows; rows with a null id are encoded
    like others.  An empty table gives an empty one; other columns are left out.
    """
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("word_bpe_49k.json")
    return bpe.Codec.compile(docs, vocabulary).encode(docs)


STAGES = [("quality", quality), ("near_duplicates", near_duplicates), ("secret_scan", secret_scan), ("mix", mix), ("tokens", tokens)]

#: The classifier, the sketches and the codec have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = pin(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
