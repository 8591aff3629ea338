"""Mixing sources to target weights by systematic sampling (operator 4, DataFrame functions only).

Every document of a source is expected ``target / source size`` times in the mix.
Within a source the expected copies are added up in a fixed order, one random
offset is added, and a document is emitted once for every integer boundary that
its stretch of the running sum crosses.  Documents are ordered by size, so that
the words taken differ from the target by less than one document.

The running sum is distributed (``running_total``): a source is cut into size
classes, those into sizes, and a size into 256 parts by the id's digest, so
neither a hot source nor a hot group of copies meets in one task.

Defined results: a null or empty text has size 0; a null source is a source of
its own (last in order); repeated rows count one by one; rows with a null id are
mixed like others; which of the rows that share an id and a size are taken more
often follows from their columns, not from where they are read; an empty table
gives an empty mix.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.llm.running import running_total

#: What a word is, and the weights in code point order of the sources.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
TRIALS = 32


def n_words(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0) -> DataFrame:
    """One row per source: ``_has_source, _source, source_size, target``.

    ``share`` times all words are shared by weight; a source stops at ``limit``
    times its own size and the excess goes to the others by weight.  The level at
    which this comes to rest has a closed form over the sources in order of
    ``limit * size / weight``: a source is full if the level that the sources from
    it on could reach is at least its own ratio.
    """
    per = sized.groupBy("_has_source", "_source").agg(F.sum("size").alias("source_size"))
    named = Window.orderBy(F.desc("_has_source"), "_source")
    turn = F.pmod(F.row_number().over(named) - 1, F.lit(len(weights)))
    per = per.withColumn("_weight", F.element_at(F.array(*map(F.lit, weights)), (turn + 1).cast("int")).cast("double"))
    per = per.withColumn("_cap", F.lit(float(limit)) * F.col("source_size")).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    everything = Window.partitionBy()
    by_ratio = Window.orderBy("_ratio", F.desc("_has_source"), "_source").rowsBetween(Window.unboundedPreceding, -1)
    total = F.lit(float(share)) * F.sum("source_size").over(everything)
    reach = ((total - F.coalesce(F.sum("_cap").over(by_ratio), F.lit(0.0)))
             / (F.sum("_weight").over(everything) - F.coalesce(F.sum("_weight").over(by_ratio), F.lit(0.0))))
    per = per.withColumn("_total", total).withColumn("_full", reach >= F.col("_ratio"))
    spare = F.col("_total") - F.sum(F.when(F.col("_full"), F.col("_cap")).otherwise(0.0)).over(everything)
    sharing = F.sum(F.when(~F.col("_full"), F.col("_weight")).otherwise(0.0)).over(everything)
    per = per.withColumn("target", F.when(F.col("_full"), F.col("_cap")).otherwise(spare * F.col("_weight") / sharing))
    return per.select("_has_source", "_source", "source_size", "target")


def _copies(before: Column, each: Column, offset: Column) -> Column:
    crossed = F.floor((before + 1) * each + offset) - F.floor(before * each + offset)
    # rounding of very large sums must not add a third copy where two are the most
    return F.least(crossed, F.ceil(each)).cast("int")


def _offset(seed: str, trial: int) -> Column:
    """A number in [0, 1) from the seed, the source and the trial."""
    name = F.concat(F.lit(f"{seed}{trial}|"), F.col("_has_source").cast("int").cast("string"), F.col("_source"))
    return F.conv(F.substring(F.md5(name), 1, 8), 16, 10).cast("double") / F.lit(2.0 ** 32)


def mix_counts(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, limit: float = 2.0, seed: str = "mix",
               doc_id: str = "doc_id", source: str = "source", size: Column | None = None) -> DataFrame:
    """Each row of ``docs`` as the struct ``row``, with ``size, source_size, target, copies``.

    ``size``: words of a row; by default those of the column ``text``.  Of ``TRIALS`` random
    offsets, a source takes the one whose words come nearest to its target: in a small source a
    single long document can outweigh what the order by size evens out.
    """
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        (n_words(F.col("text")) if size is None else size).alias("size"),
        F.col(source).isNotNull().alias("_has_source"),
        F.coalesce(F.col(source).cast("string"), F.lit("")).alias("_source"),
        F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("null"))).alias("_order"),
        # rows that share an id and a size are told apart by all their columns, so that reruns agree
        F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema if "map<" not in f.dataType.simpleString()]).alias("_tie"))
    sized = (sized.withColumn("_class", F.floor(16 * F.log2(F.col("size") + 1)))
             .withColumn("_part", F.substring("_order", 1, 2)).withColumn("_one", F.lit(1)))
    of = ["_has_source", "_source"]
    levels = [["_class"], ["size", "_part"]]
    each = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    targets = source_targets(sized.drop("row"), weights, share, limit).withColumn("_each", each)
    trials = [_offset(seed, i) for i in range(TRIALS)]
    tried = running_total(sized.drop("row"), "_one", of, levels, ["_order", "_tie"], attach=targets).groupBy(*of).agg(
        F.first("target").alias("target"),
        *[F.sum(F.col("size") * _copies(F.col("before"), F.col("_each"), u)).alias(f"_words{i}") for i, u in enumerate(trials)])
    nearest = F.array_min(F.array(*[F.struct(F.abs(F.col(f"_words{i}") - F.col("target")), F.lit(i), u.alias("offset"))
                                    for i, u in enumerate(trials)]))
    offsets = tried.select(*of, nearest["offset"].alias("_offset"))
    mixed = running_total(sized, "_one", of, levels, ["_order", "_tie"], attach=targets.join(offsets, of))
    return mixed.select("row", "size", "source_size", "target", _copies(F.col("before"), F.col("_each"), F.col("_offset")).alias("copies"))


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixed corpus: every row of ``docs`` as often as the mix takes it, columns unchanged."""
    taken = mix_counts(docs, **options).where("copies > 0")
    return taken.select("row", F.explode(F.array_repeat(F.lit(0), F.col("copies")))).select("row.*")
