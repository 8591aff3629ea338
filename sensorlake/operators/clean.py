"""Batch cleaning: global row order, quantile clipping, interpolation
(ST1, WN4, AG9, FL6, SF10, WN5).

The reference sorts the whole batch by time, clips every feature to the
batch's [q01, q99] and fills the clipped / missing values by linear
interpolation over *row position* in that pooled order. A naive Spark window
over the whole batch would run in one task, so the order is built in two
levels instead:

1. range-partition the batch on the order key (tie columns included, so one
   hot timestamp is split over several tasks), sort inside each partition and
   pin (partition id, position) with a reliable checkpoint;
2. aggregate one small row per segment (partition id x group): row count and
   the first / last non-missing (position, value) per feature;
3. on that small table (one row per segment, bounded by the partition count
   in pooled mode), prefix sums give each segment its row offset and
   ``last/first(ignoreNulls)`` carries the nearest known value across
   segment borders;
4. a window partitioned by segment finishes the fill row by row.

With ``group_cols`` (e.g. ``["device_id"]``) positions, quantiles and fills are
per group; the group columns lead the range key so a hot device is still split
over many segments.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sensorlake.schemas import FEATURES
from sensorlake.session import ensure_checkpoint_dir

_PID, _MID = "_pid", "_mid"


def join_small(big: DataFrame, small: DataFrame, on: list[str], bounded: bool = False,
               how: str = "inner") -> DataFrame:
    """Join a side table. It is broadcast by hand only where its size is bounded by construction: one row
    (no ``on``), or ``bounded``, one row per shuffle partition. Any other table grows with the data, and
    Spark picks the join from its measured bytes."""
    if not on:
        return big.crossJoin(F.broadcast(small))
    return big.join(F.broadcast(small) if bounded else small, on, how)


# A table of one row per group is broadcast by hand up to so many rows (a few MB), which are counted first.
FEW_GROUPS = 10_000


def join_groups(big: DataFrame, small: DataFrame, group_cols: list[str]) -> DataFrame:
    """Join a pinned table of one row per group, so that no task gets all rows of a group.

    A join by the group alone would deal a few devices' rows to as many tasks, and the windows and
    aggregates after it would stay there, as rows dealt by the group are also dealt by group and segment.
    Few groups are broadcast. Of many, sequenced rows get theirs by segment, a part of a group's rows."""
    if small.count() <= FEW_GROUPS:
        return big.join(F.broadcast(small), group_cols)
    keys = list(group_cols)
    if _PID in big.columns:
        keys = [_PID, *keys]
        small = big.select(*keys).distinct().join(small, group_cols)
    return big.join(small, keys)


def sequence(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
             num_partitions: int | None = None, keep: list[str] | None = None) -> DataFrame:
    """ST1: range-partition and sort by ``group_cols + order_cols`` and pin
    ``_pid`` (partition id) and ``_mid`` (increasing id inside the partition)
    with a reliable checkpoint, so later passes see the same positions.
    ``keep`` (default: all) lists the columns written with them; columns used
    only for ordering (e.g. the raw line as last tie-break) can be left out."""
    group_cols = list(group_cols or [])
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    key = group_cols + list(order_cols)
    keep = list(keep) if keep is not None else list(df.columns)
    keep = keep + [c for c in group_cols if c not in keep]
    ensure_checkpoint_dir(spark)
    ordered = (df.repartitionByRange(n, *key)
               .sortWithinPartitions(*key)
               .select(*keep, F.spark_partition_id().alias(_PID), F.monotonically_increasing_id().alias(_MID)))
    return ordered.checkpoint(eager=True)


def _segments(seq: DataFrame, features: list[str], group_cols: list[str]) -> DataFrame:
    """Steps 2-3: one row per segment with its row offset inside the group and,
    per feature, the nearest known (position, value) before and after it."""
    seg_keys = [_PID] + group_cols
    aggs = [F.count(F.lit(1)).alias("_cnt"), F.min(_MID).alias("_mid0")]
    for f in features:
        known = F.when(F.col(f).isNotNull(), F.struct(F.col(_MID).alias("m"), F.col(f).alias("v")))
        aggs += [F.min(known).alias(f"_first_{f}"), F.max(known).alias(f"_last_{f}")]
    seg = seq.groupBy(*seg_keys).agg(*aggs)

    # running frames only (a frame ending at "unbounded following" is
    # re-evaluated per row); "next" is a running frame in reverse order. All
    # expressions of one frame go into one select, so each order is one sort.
    fwd = Window.partitionBy(*group_cols).orderBy(_PID) if group_cols else Window.orderBy(_PID)
    rev = (Window.partitionBy(*group_cols) if group_cols else Window).orderBy(F.col(_PID).desc())
    before = fwd.rowsBetween(Window.unboundedPreceding, -1)
    after = rev.rowsBetween(Window.unboundedPreceding, -1)
    seg = seg.select("*", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))

    def to_pos(s: Column) -> Column:
        return F.when(s.isNotNull(), F.struct(
            (s["m"] - F.col("_mid0") + F.col("_off") + 1).alias("i"), s["v"].alias("v")))

    seg = seg.select(*seg_keys, "_mid0", "_off",
                     *[to_pos(F.col(f"_first_{f}")).alias(f"_firstp_{f}") for f in features],
                     *[to_pos(F.col(f"_last_{f}")).alias(f"_lastp_{f}") for f in features])
    seg = seg.select("*", *[F.last(f"_lastp_{f}", ignorenulls=True).over(before).alias(f"_carry_prev_{f}")
                            for f in features])
    seg = seg.select("*", *[F.last(f"_firstp_{f}", ignorenulls=True).over(after).alias(f"_carry_next_{f}")
                            for f in features])
    cols = seg_keys + ["_mid0", "_off"]
    for f in features:
        cols += [f"_carry_prev_{f}", f"_carry_next_{f}"]
    return seg.select(*cols)


def _with_segments(seq: DataFrame, features: list[str], group_cols: list[str]) -> DataFrame:
    seg = _segments(seq, features, group_cols)
    # pooled mode: one row per partition, a proven bound
    return join_small(seq, seg, [_PID] + group_cols, bounded=not group_cols)


def row_index(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
              num_partitions: int | None = None, out_col: str = "row_idx") -> DataFrame:
    """WN4: dense 1-based row number in ``order_cols`` order (per group when
    ``group_cols``), without a single-partition window."""
    group_cols = list(group_cols or [])
    seq = sequence(df, order_cols, group_cols, num_partitions)
    joined = _with_segments(seq, [], group_cols)
    pos = F.col(_MID) - F.col("_mid0") + F.col("_off") + 1
    return joined.withColumn(out_col, pos).select(*df.columns, out_col)


def batch_quantiles(df: DataFrame, features: list[str] = FEATURES, probs=(0.01, 0.99),
                    group_cols: list[str] | None = None, exact: bool = True,
                    accuracy: int = 100_000) -> DataFrame:
    """AG9: per-feature quantiles of the batch (pooled, or per group), missing
    values (NULL or NaN) skipped, linear interpolation between order
    statistics (``pos = p * (n - 1)``). Output columns ``{feature}_lo`` /
    ``{feature}_hi``.

    Exact: a sketch brackets each order statistic (``_bracket_quantiles``), and
    only the values inside a bracket are ranked; one path for every size.
    ``exact=False``: the bounded ``percentile_approx`` sketch alone.
    """
    group_cols = list(group_cols or [])
    ps = [float(p) for p in probs]
    if exact:
        return _bracket_quantiles(df, features, ps, group_cols)
    aggs = []
    for f in features:
        q = F.percentile_approx(_present(f), ps, accuracy)
        aggs += [q[i].alias(f"{f}_{name}") for i, name in enumerate(_quantile_names(ps))]
    return df.groupBy(*group_cols).agg(*aggs)


def _present(f: str) -> Column:
    """A feature as DOUBLE with NaN as NULL."""
    return F.nanvl(F.col(f).cast("double"), F.lit(None).cast("double"))


def _quantile_names(ps: list[float]) -> list[str]:
    """Output suffixes: ``lo``/``hi`` for a (low, high) pair, else 0, 1, ..."""
    return ["lo", "hi"] if len(ps) == 2 else [str(i) for i in range(len(ps))]


# The sketch's accuracy (its rank error is a 1/SKETCH of the rows), and how many errors a bracket's
# end lies beside the wanted rank.
SKETCH, BRACKET = 20_000, 4
# Partial sketches that one task merges: so many, or two for each core, however many partitions the rows have.
SKETCHES = 32


def _bracket_quantiles(df: DataFrame, features: list[str], ps: list[float], group_cols: list[str]) -> DataFrame:
    """Exact quantiles by bracket and refine: two passes over the rows, no sort of them.

    1. One aggregate: the number of values of each feature, and the sketch's values a little below and
       above every probability, which bracket the order statistics.
    2. One pass: values beyond a bracket, on the side of the nearer end, are counted; values inside it
       are counted per distinct value. Both reduce to few rows before the shuffle. A running count over
       a bracket's values, some ``2 * BRACKET / SKETCH`` of the rows, picks the statistics.

    A pick outside its bracket shows in the counts. The second pass then runs again with brackets that
    hold all values, so the result is exact even where the sketch is not."""
    step = BRACKET / SKETCH
    probes = [min(max(p + d, 0.0), 1.0) for p in ps for d in (-step, step)]
    aggs = []
    for f in features:
        aggs += [F.count(_present(f)).alias(f"_n_{f}"), F.percentile_approx(_present(f), probes, SKETCH).alias(f"_b_{f}")]
    partial = max(SKETCHES, 2 * df.sparkSession.sparkContext.defaultParallelism)
    bounds = df.coalesce(partial).groupBy(*group_cols).agg(*aggs)
    if group_cols:
        ensure_checkpoint_dir(df.sparkSession)
        return _group_quantiles(df, bounds.checkpoint(eager=True), features, ps, group_cols)
    row = bounds.first()
    for widest in (False, True):
        ends = {f: [float("-inf"), float("inf")] * len(ps) if widest else row[f"_b_{f}"] for f in features if row[f"_n_{f}"]}
        cells = [(f, j, F.lit(row[f"_n_{f}"]), F.lit(ends[f][2 * j]), F.lit(ends[f][2 * j + 1])) for f in ends for j in range(len(ps))]
        picked = {(r["feature"], r["j"]): r for r in _picked(df, cells, ps, []).collect()} if cells else {}
        if all(r["held"] for r in picked.values()):
            break
    named = [(f, j, name) for f in features for j, name in enumerate(_quantile_names(ps))]
    values = [F.lit(picked[f, j]["q"] if (f, j) in picked else None).cast("double").alias(f"{f}_{name}") for f, j, name in named]
    return df.sparkSession.range(1).select(*values)


def _group_quantiles(df: DataFrame, bounds: DataFrame, features: list[str], ps: list[float], group_cols: list[str]) -> DataFrame:
    """The second pass per group; the picks, one row per group, feature and probability, and the limits are pinned."""
    names = _quantile_names(ps)

    def picks(rows: DataFrame, widest: bool) -> DataFrame:
        low, high = (F.lit(float(x)) for x in ("-inf", "inf"))
        cells = [(f, j, F.col(f"_n_{f}"), low if widest else F.col(f"_b_{f}")[2 * j], high if widest else F.col(f"_b_{f}")[2 * j + 1])
                 for f in features for j in range(len(ps))]
        split = [_PID] if _PID in rows.columns else []
        return _picked(join_groups(rows.select(*split, *group_cols, *features), bounds, group_cols), cells, ps, group_cols)

    found = picks(df, False).checkpoint(eager=True)
    missed = found.where("not held").select(*group_cols).distinct()
    if not missed.isEmpty():  # all cells of such a group again
        found = found.join(missed, group_cols, "left_anti").unionByName(picks(df.join(missed, group_cols, "left_semi"), True))
    pivot = found.groupBy(*group_cols).agg(*[F.max(F.when((F.col("feature") == f) & (F.col("j") == j), F.col("q"))).alias(f"{f}_{name}")
                                             for f in features for j, name in enumerate(names)])
    return bounds.select(*group_cols).join(pivot, group_cols, "left").checkpoint(eager=True)  # a group without any value has null limits


def _picked(df: DataFrame, cells: list[tuple[str, int, Column, Column, Column]], ps: list[float], group_cols: list[str]) -> DataFrame:
    """One row per group, ``feature`` and ``j`` (place of the probability): the quantile ``q`` and whether the
    bracket ``held`` its ranks. ``cells``: feature, j, number of values, and the bracket's ends."""
    rows = []
    for f, j, n, lo, hi in cells:
        x = _present(f)
        low = ps[j] <= 0.5  # count from the nearer end
        inside, beyond = (x >= lo) & (x <= hi), (x < lo) if low else (x > hi)
        rows.append(F.when(inside | beyond, F.struct(F.lit(f).alias("feature"), F.lit(j).alias("j"), n.alias("n"), F.when(inside, x).alias("v"))))
    keys = [*group_cols, "feature", "j", "n"]
    counted = (df.select(*group_cols, F.inline(F.filter(F.array(*rows), lambda c: c.isNotNull())))
               .groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("c")))
    low = F.element_at(F.array(*[F.lit(p <= 0.5) for p in ps]), F.col("j") + 1)
    p = F.element_at(F.array(*[F.lit(p) for p in ps]), F.col("j") + 1)
    pos = p * (F.col("n") - 1).cast("double")
    from_end = F.when(low, F.col("v")).otherwise(-F.col("v"))  # null, beyond the bracket, comes first
    w = Window.partitionBy(*keys).orderBy(from_end.asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    ranked = counted.withColumn("_upto", F.sum("c").over(w))
    # a value stands at the ranks (upto - c, upto] from its end
    at = {side: F.when(low, r).otherwise(F.col("n") - r + 1) for side, r in
          (("lo", F.floor(pos).cast("long") + 1), ("hi", F.ceil(pos).cast("long") + 1))}
    per = ranked.groupBy(*keys).agg(*[
        F.max(F.when((F.col("_upto") - F.col("c") < r) & (r <= F.col("_upto")), F.col("v"))).alias(f"_v{side}") for side, r in at.items()])
    lo_r, hi_r, vlo, vhi = F.floor(pos), F.ceil(pos), F.col("_vlo"), F.col("_vhi")
    q = F.when((lo_r == hi_r) | (vlo == vhi), vlo).otherwise((hi_r.cast("double") - pos) * vlo + (pos - lo_r.cast("double")) * vhi)
    return per.select(*group_cols, "feature", "j", q.alias("q"), (vlo.isNotNull() & vhi.isNotNull()).alias("held"))


def clip_outliers(df: DataFrame, limits: DataFrame, features: list[str] = FEATURES,
                  group_cols: list[str] | None = None) -> DataFrame:
    """FL6/SF10: values strictly outside [lo, hi] become missing."""
    group_cols = list(group_cols or [])
    out = join_groups(df, limits, group_cols) if group_cols else join_small(df, limits, [])
    for f in features:
        x = F.col(f)
        out = out.withColumn(f, F.when((x < F.col(f"{f}_lo")) | (x > F.col(f"{f}_hi")),
                                       F.lit(None).cast("double")).otherwise(x))
    return out.select(*df.columns)


def interpolate_sequenced(seq: DataFrame, features: list[str] = FEATURES,
                          group_cols: list[str] | None = None, keep_index: str | None = None) -> DataFrame:
    """WN5 on a frame from ``sequence``: linear interpolation by row position;
    leading gaps stay missing, trailing gaps take the last known value.

    The two window passes run on the rows as they are (neighbours found by
    ``_mid``); the small per-segment table (offsets, carried neighbours) is
    joined afterwards, so the sorts do not carry it."""
    group_cols = list(group_cols or [])
    base_cols = [c for c in seq.columns if c not in (_PID, _MID)]
    part = Window.partitionBy(_PID, *group_cols)
    upto = part.orderBy(_MID).rowsBetween(Window.unboundedPreceding, 0)
    # "from here on" as a running frame over the reversed order (linear, not quadratic)
    onward = part.orderBy(F.col(_MID).desc()).rowsBetween(Window.unboundedPreceding, 0)

    def known(f: str) -> Column:
        return F.when(F.col(f).isNotNull(), F.struct(F.col(_MID).alias("m"), F.col(f).alias("v")))

    # one select per frame: two window operators (one sort each) for all features
    out = seq.select("*", *[F.last(known(f), ignorenulls=True).over(upto).alias(f"_pw_{f}")
                            for f in features])
    out = out.select("*", *[F.last(known(f), ignorenulls=True).over(onward).alias(f"_qw_{f}")
                            for f in features])
    out = join_small(out, _segments(seq, features, group_cols), [_PID] + group_cols, bounded=not group_cols)
    pos = F.col(_MID) - F.col("_mid0") + F.col("_off") + 1

    def in_group(w: Column) -> Column:
        return F.when(w.isNotNull(), F.struct((w["m"] - F.col("_mid0") + F.col("_off") + 1).alias("i"),
                                               w["v"].alias("v")))

    out = out.select("*", pos.alias("_pos"),
                     *[F.coalesce(in_group(F.col(f"_pw_{f}")), F.col(f"_carry_prev_{f}")).alias(f"_p_{f}")
                       for f in features],
                     *[F.coalesce(in_group(F.col(f"_qw_{f}")), F.col(f"_carry_next_{f}")).alias(f"_q_{f}")
                       for f in features])
    for f in features:
        p, q = F.col(f"_p_{f}"), F.col(f"_q_{f}")
        slope = (q["v"] - p["v"]) / (q["i"] - p["i"]).cast("double")
        filled = (F.when(p.isNull(), F.lit(None).cast("double"))
                  .when(q.isNull(), p["v"])
                  .when(q["i"] == p["i"], p["v"])
                  .otherwise(slope * (F.col("_pos") - p["i"]).cast("double") + p["v"]))
        out = out.withColumn(f, F.coalesce(F.col(f), filled))
    cols = base_cols + ([F.col("_pos").alias(keep_index)] if keep_index else [])
    return out.select(*cols)


def interpolate(df: DataFrame, order_cols: list[str], features: list[str] = FEATURES,
                group_cols: list[str] | None = None, num_partitions: int | None = None,
                keep_index: str | None = None) -> DataFrame:
    """WN5: sequence ``df`` by ``order_cols`` (per group) and interpolate."""
    seq = sequence(df, order_cols, group_cols, num_partitions)
    return interpolate_sequenced(seq, features, group_cols, keep_index)


# order columns that are also data (kept after sequencing); the rest of the
# order key (file name, raw line) only breaks ties and is dropped before the pin
KEEP_ORDER_COLS = ("timestamp", "device_id")


def sequence_batch(df: DataFrame, order_cols: list[str], group_cols: list[str] | None = None,
                   num_partitions: int | None = None) -> DataFrame:
    """``sequence`` without the columns that only break ties."""
    keep = [c for c in df.columns if c not in order_cols or c in KEEP_ORDER_COLS]
    return sequence(df, order_cols, group_cols, num_partitions, keep=keep)


def clean_sequenced(seq: DataFrame, features: list[str] = FEATURES, group_cols: list[str] | None = None,
                    exact_quantiles: bool = True, keep_index: str | None = None) -> DataFrame:
    """AG9 -> FL6 -> WN5 on sequenced rows. A time slice of them will do: it is a run of neighbours in the
    order (of each group), and only distances between rows enter the interpolation."""
    group_cols = list(group_cols or [])
    limits = batch_quantiles(seq, features, group_cols=group_cols, exact=exact_quantiles)
    return interpolate_sequenced(clip_outliers(seq, limits, features, group_cols), features, group_cols, keep_index)


def clean_batch(df: DataFrame, order_cols: list[str], features: list[str] = FEATURES,
                group_cols: list[str] | None = None, exact_quantiles: bool = True,
                num_partitions: int | None = None, keep_index: str | None = None) -> DataFrame:
    """AG9 -> FL6 -> WN5 in one plan: the batch is sequenced (and pinned) once, quantiles are taken from
    the pinned rows, clipping keeps the segment columns, and interpolation runs on the clipped rows."""
    seq = sequence_batch(df, order_cols, group_cols, num_partitions)
    return clean_sequenced(seq, features, group_cols, exact_quantiles, keep_index)
