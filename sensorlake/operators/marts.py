"""Hourly marts from the minute table (AG3-AG8, AG12 = UD2, FL7, WN2, WN3,
SF11-SF13, JN1, PL3).

The reference groups the same rows nine times (four marts plus five
per-feature loops). Here one window + one aggregate over (hour, device)
produces every statistic; the four marts are projections of it and the
hour-over-hour change is one ``lag`` over the small hourly result.

Sizes: the minute table holds one row per (minute, device), so an hourly
group has at most 60 rows whatever the data volume; the per-device ``lag``
runs on hourly rows (one per hour and device), bounded by the time span.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sensorlake.functions.columns import floor_hour, percent_of, safe_ratio
from sensorlake.schemas import FEATURES, MART_COLUMNS, RATIOS


def _exact_mean_var(x: str, scale: int):
    """Mean and sample variance of a DECIMAL column from exact integer sums.

    With ``u = x * 10^scale`` (an integer), ``S1 = sum(u)`` and ``S2 = sum(u^2)``
    are exact whatever the row order, and so is ``n*S2 - S1^2``; only the final
    two divisions round. The result is the same on every partitioning (an
    online float variance is not) and at least as accurate."""
    u = (F.col(x) * F.lit(10 ** scale)).cast("decimal(38,0)")
    n = F.count(x)
    s1, s2 = F.sum(u), F.sum(u * u)
    unit = float(10 ** scale)
    mean = F.try_divide(s1.cast("double"), n.cast("double")) / F.lit(unit)
    num = (n.cast("decimal(38,0)") * s2 - s1 * s1).cast("double")
    var = F.try_divide(num, (n * (n - 1)).cast("double")) / F.lit(unit * unit)
    return mean, var


def hourly_stats(minutes: DataFrame, features: list[str] = FEATURES, ts_col: str = "timestamp") -> DataFrame:
    """One row per (hour label, device) with every hourly statistic.

    Above-mean (FL7) is the exact test ``x * n > sum(x)`` on the stored values
    (decimals), so a constant hour counts 0 %, not a float-rounding 100 %.
    On stored (DECIMAL) minutes, mean and variance come from exact integer
    sums (``_exact_mean_var``); on DOUBLE input they are ``avg``/``var_samp``.
    """
    types = {f.name: f.dataType for f in minutes.schema.fields}
    hour = floor_hour(F.col(ts_col)).alias("timestamp")
    rows = minutes.select(hour, "device_id", *features, "light")
    grp = Window.partitionBy("timestamp", "device_id")  # WN3: group totals beside rows
    for f in features:
        above = F.col(f) * F.count(f).over(grp) > F.sum(f).over(grp)
        rows = rows.withColumn(f"_above_{f}", above.cast("int"))
    aggs = [F.count(F.lit(1)).alias("record_count")]
    for f in features:
        x = F.col(f).cast("double")
        if isinstance(types[f], T.DecimalType):
            mean, var = _exact_mean_var(f, types[f].scale)
        else:
            mean, var = F.avg(x), F.var_samp(x)
        aggs += [
            mean.alias(f"mean_{f}"),
            F.median(x).alias(f"median_{f}"),
            var.alias(f"variance_{f}"),
            F.max(x).alias(f"max_{f}"),
            F.min(x).alias(f"min_{f}"),
            F.sum(F.col(f"_above_{f}")).alias(f"_above_{f}"),
        ]
    aggs.append(F.avg(F.col("light").cast("double")).alias("mean_light"))
    return rows.groupBy("timestamp", "device_id").agg(*aggs)


def with_changes(stats: DataFrame, features: list[str] = FEATURES) -> DataFrame:
    """WN2: hourly mean minus the device's previous *observed* hour (a missing
    hour is spanned); NULL for the device's first hour."""
    w = Window.partitionBy("device_id").orderBy("timestamp")
    for f in features:
        stats = stats.withColumn(f"{f}_change_last_hour",
                                 F.col(f"mean_{f}") - F.lag(f"mean_{f}").over(w))
    return stats


def average_mart(stats: DataFrame) -> DataFrame:
    """AG3: dm_iot_average."""
    return stats.select("timestamp", "device_id",
                        *[F.col(f"mean_{f}").alias(f) for f in FEATURES],
                        F.col("mean_light").alias("light"))


def extreme_mart(stats: DataFrame) -> DataFrame:
    """AG4: dm_iot_extreme."""
    return stats.select(*MART_COLUMNS["dm_iot_extreme"])


def count_mart(stats: DataFrame) -> DataFrame:
    """AG5: dm_iot_count."""
    return stats.select("timestamp", "device_id", F.col("record_count").cast("int").alias("record_count"))


def ml_mart(stats: DataFrame, changes: bool = True) -> DataFrame:
    """PL3: dm_iot_ml - mean/median/variance, change, ratios,
    variance-to-mean and above-mean percentage per feature."""
    df = with_changes(stats) if changes else stats
    extra = []
    for name, (num, den) in RATIOS.items():
        extra.append(safe_ratio(F.col(f"mean_{num}"), F.col(f"mean_{den}")).alias(name))
    for f in FEATURES:
        extra.append(safe_ratio(F.col(f"variance_{f}"), F.col(f"mean_{f}")).alias(f"variance_to_mean_{f}"))
    for f in FEATURES:
        extra.append(percent_of(F.col(f"_above_{f}"), F.col("record_count")).alias(f"high_low_percentage_{f}"))
    base = [c for c in MART_COLUMNS["dm_iot_ml"][:2 + 3 * len(FEATURES) + len(FEATURES)]]
    if not changes:
        base = [c for c in base if not c.endswith("_change_last_hour")]
    return df.select(*base, *extra)


def all_marts(stats: DataFrame) -> dict[str, DataFrame]:
    return {
        "dm_iot_average": average_mart(stats),
        "dm_iot_extreme": extreme_mart(stats),
        "dm_iot_count": count_mart(stats),
        "dm_iot_ml": ml_mart(stats),
    }
