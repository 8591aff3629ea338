"""The queries of this subpackage, ``opN_<name>``, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorlake.llm import alignment, ann, bpe, codes, gam, mixing, search, secrets, setsketch, sharding, suffix, tokencounts, tokenfile
from sensorlake.llm.oracle import oracle_sql  # noqa: F401
from sensorlake.llm.scratch import pin


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vocabulary() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest rows of every row whose id is divisible by 100."""
    vectors = ann.vectors_of(_table(spark, sf_dir, "embeddings"))
    shards = ann.shard_count(vectors)
    index = pin(ann.build_index(vectors, shards), "ann-index", rows_per_file=8)
    return ann.search(index, vectors.where("vec_id % 100 = 0"), shards, k=10)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A quality score of every document, learned from the labels that are not held out."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = gam.train(docs, _table(spark, sf_dir, "labels"))
    scored = gam.score(docs, model, ["doc_id"])
    return scored.select("row.doc_id", gam.held_out(F.col("row.doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"))


def op3_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups of all documents at 85 % of shared five-word shingles."""
    return setsketch.near_duplicates(_table(spark, sf_dir, "documents"), percent=85)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of all documents takes from each document."""
    docs = _table(spark, sf_dir, "documents")
    sized = pin(docs.select("doc_id", "source", mixing.n_words("text").alias("words")), "mixing")
    mixed = mixing.mix_counts(sized, size=F.col("words"))
    return mixed.select("row.doc_id", "size", "source_size", "target",
                        (F.col("size") * F.col("copies")).cast("long").alias("taken"), F.col("row.source").alias("source"))


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in 24 shards of near equal bytes, equal texts together."""
    placed = sharding.shard_documents(_table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                         F.lit(None).cast("int").alias("grown_shard"))


def op6_tokens(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """All documents' ids, written to a token file and read back through its index."""
    segments = tokenfile.write_tokens(_table(spark, sf_dir, "documents"), vocabulary or _vocabulary())
    return tokenfile.read_documents(segments)


def op7_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in all documents: counts and spans of the base kinds, and all spans."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs)
    base = tuple(r.kind for r in secrets.BASE)
    count = [secrets.n_spans(F.col("spans"), k).cast("long").alias(f"n_{k}") for k in base]
    return found.select("row.doc_id", *count, F.sha2(secrets.span_text(F.col("spans"), base), 256).alias("base_sha256"),
                        secrets.span_text(F.col("spans")).alias("spans"))


def op8_bpe(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """All documents encoded with a lexicon of their own frequent words, and decoded."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    codec = bpe.Codec.compile(docs, vocabulary or _vocabulary())
    done = codec.encode(docs, decoded=True)
    return done.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


def op9_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best documents, by BM25, for the words of every document whose id is divisible by 100."""
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return search.Index.build(docs).search(docs.where("doc_id % 100 = 0"), k=10)


def op10_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the bytes of 200-byte strings that start anywhere else too."""
    return suffix.remove_repeats(_table(spark, sf_dir, "documents"))


def op11_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    """Bytes and tokens of all documents."""
    return tokencounts.count_tokens(_table(spark, sf_dir, "documents"), vocabulary or _vocabulary(), limit=2048)


def op12_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all vectors, their errors, and the errors of their labels."""
    found, books = codes.compress(_table(spark, sf_dir, "embeddings"))
    return codes.with_label_errors(found).select("vec_id", F.lower(F.hex("codes")).alias("code"), "error", "label_error",
                                                 F.lit(books.digest()).alias("codebooks_sha256"))


def op13_alignment(spark: SparkSession, sf_dir: str, vocabularies: tuple[str, str] | None = None) -> DataFrame:
    """Groups and links of two tokenizers' tokens in all documents."""
    if vocabularies is None:
        import public_tokenizers

        vocabularies = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.alignment_digests(_table(spark, sf_dir, "documents"), alignment.Tokenizers(*vocabularies))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_neighbours, op2_quality, op3_near_duplicates, op4_mixing, op5_sharding, op6_tokens, op7_secrets, op8_bpe, op9_search, op10_repeats, op11_counts, op12_codes,
                                  op13_alignment)}
