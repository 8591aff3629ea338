"""DuckDB SQL oracles for the registered queries.

Each statement recomputes, from the raw driver tables, what the matching
Spark query in ``sensorlake.plans.registry`` returns: same column names,
doubles rounded to 12 decimals in both engines.
"""

from __future__ import annotations

from sensorlake.schemas import (FEATURE_DECIMAL, FEATURES, LIGHT_MEAN_DECIMAL, PERCENT_DECIMAL, RATIO_DECIMAL,
                                RATIOS, VARIANCE_DECIMAL)

R = 12  # decimals kept on DOUBLE outputs in both engines

TELEMETRY = """
telemetry AS (
  SELECT ts AS timestamp,
    concat('b8:27:eb:bf:9d:5', CAST(user_id % 3 AS VARCHAR)) AS device_id,
    CAST(CAST(value AS DECIMAL(12,2)) / 10000 AS DECIMAL(12,10)) AS co,
    CAST(30 + CAST((event_id * 7) % 400 AS DECIMAL(5,1)) / 10 AS DECIMAL(5,1)) AS humidity,
    CAST(0.005 + CAST(value AS DECIMAL(12,2)) / 20000 AS DECIMAL(12,10)) AS lpg,
    CAST(CAST(user_id + 1 AS DECIMAL(12,2)) / 10000 AS DECIMAL(12,10)) AS smoke,
    CAST(15 + CAST(event_id % 150 AS DECIMAL(5,1)) / 10 AS DECIMAL(5,1)) AS temperature,
    CASE WHEN event_type = 'view' THEN 1 ELSE 0 END AS light,
    event_id
  FROM events)"""

RAW_LINES = """
raw_lines AS (
  SELECT event_id, timestamp,
    CASE WHEN event_id % 97 = 0
      THEN strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f') || ' ' || device_id || '       '
      ELSE concat_ws(' ', strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f'), device_id,
        CASE WHEN event_id % 89 = 0 THEN 'x' ELSE CAST(co AS VARCHAR) END,
        CAST(humidity AS VARCHAR), CAST(lpg AS VARCHAR), CAST(smoke AS VARCHAR),
        CAST(temperature AS VARCHAR), CAST(light AS VARCHAR)) END AS value
  FROM telemetry)"""

PARSED = r"""
tokens AS (
  SELECT event_id, value AS raw_line,
    CASE WHEN regexp_replace(value, '^\s+|\s+$', '', 'g') = '' THEN CAST([] AS VARCHAR[])
         ELSE string_split_regex(regexp_replace(value, '^\s+|\s+$', '', 'g'), '\s+') END AS tok
  FROM raw_lines),
typed AS (
  SELECT event_id, raw_line, len(tok) AS n_tok,
    try_cast(tok[1] || ' ' || tok[2] AS TIMESTAMP) AS timestamp,
    tok[3] AS device_id,
    try_cast(tok[4] AS DOUBLE) AS co, try_cast(tok[5] AS DOUBLE) AS humidity,
    try_cast(tok[6] AS DOUBLE) AS lpg, try_cast(tok[7] AS DOUBLE) AS smoke,
    try_cast(tok[8] AS DOUBLE) AS temperature, try_cast(tok[9] AS DOUBLE) AS light_num
  FROM tokens),
parsed AS (
  SELECT event_id, raw_line, timestamp, device_id, co, humidity, lpg, smoke, temperature,
    CASE WHEN light_num IN (0, 1) THEN CAST(light_num AS INTEGER) END AS light,
    CASE WHEN n_tok <> 9 THEN 'arity'
         WHEN timestamp IS NULL THEN 'timestamp'
         WHEN co IS NULL OR humidity IS NULL OR lpg IS NULL OR smoke IS NULL
              OR temperature IS NULL OR light_num IS NULL THEN 'number'
         WHEN light_num NOT IN (0, 1) THEN 'domain'
         WHEN length(device_id) > 17 THEN 'length' END AS reject
  FROM typed),
accepted AS (SELECT * EXCLUDE (reject) FROM parsed WHERE reject IS NULL)"""


def _with(*ctes: str) -> str:
    return "WITH " + ",".join(ctes)


def _r(expr: str) -> str:
    return f"round({expr}, {R})"


def _feats(fmt: str, sep: str = ", ") -> str:
    return sep.join(fmt.format(f=f) for f in FEATURES)


TEL = _with(TELEMETRY)
LINES = _with(TELEMETRY, RAW_LINES)
ACC = _with(TELEMETRY, RAW_LINES, PARSED)

# complete minutes of the accepted lines (FL4)
MINUTE_SLICE = """,
cut AS (SELECT date_trunc('minute', max(timestamp)) AS c FROM accepted),
sliced AS (SELECT a.* FROM accepted a, cut WHERE a.timestamp < cut.c)"""

QUANTILES = ",\nlimits AS (SELECT " + _feats(
    "quantile_cont({f}, 0.01) AS {f}_lo, quantile_cont({f}, 0.99) AS {f}_hi") + " FROM {src})"
QUANTILES_BY_DEVICE = ",\nlimits AS (SELECT device_id, " + _feats(
    "quantile_cont({f}, 0.01) AS {f}_lo, quantile_cont({f}, 0.99) AS {f}_hi") + " FROM {src} GROUP BY device_id)"

CLIP_SELECT = _feats("CASE WHEN s.{f} < l.{f}_lo OR s.{f} > l.{f}_hi THEN NULL ELSE s.{f} END AS {f}")


def _interp(src: str, part: str = "") -> str:
    """Row-position linear interpolation (numpy order of operations)."""
    pb = f"PARTITION BY {part} " if part else ""
    w1 = f"({pb}ORDER BY rn ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"
    w2 = f"({pb}ORDER BY rn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"
    known = _feats(
        "last_value(CASE WHEN {f} IS NOT NULL THEN rn END IGNORE NULLS) OVER " + w1 + " AS {f}_pi, "
        "last_value({f} IGNORE NULLS) OVER " + w1 + " AS {f}_pv, "
        "first_value(CASE WHEN {f} IS NOT NULL THEN rn END IGNORE NULLS) OVER " + w2 + " AS {f}_qi, "
        "first_value({f} IGNORE NULLS) OVER " + w2 + " AS {f}_qv")
    fill = _feats(
        "coalesce({f}, CASE WHEN {f}_pi IS NULL THEN NULL WHEN {f}_qi IS NULL THEN {f}_pv "
        "ELSE ({f}_qv - {f}_pv) / CAST({f}_qi - {f}_pi AS DOUBLE) * CAST(rn - {f}_pi AS DOUBLE) + {f}_pv END) AS {f}")
    return (f",\nknown AS (SELECT *, {known} FROM {src}),\n"
            f"filled AS (SELECT * EXCLUDE ({_feats('{f}, {f}_pi, {f}_pv, {f}_qi, {f}_qv')}), {fill} FROM known)")


def _minute_rollup(src: str, with_count: bool, rounded: bool = True) -> str:
    cnt = ", count(*) AS raw_rows" if with_count else ""
    mean = ("round(avg(CAST({f} AS DOUBLE)), %d) AS {f}" % R) if rounded else "avg(CAST({f} AS DOUBLE)) AS {f}"
    return (f"SELECT date_trunc('minute', timestamp) AS timestamp, device_id, "
            + _feats(mean)
            + ", CASE WHEN 2 * sum(light) > count(light) THEN 1 ELSE 0 END AS light"
            + cnt + f" FROM {src} GROUP BY ALL")


def _hourly(src: str = "telemetry") -> str:
    """hourly statistics CTE over a DDS-shaped source (decimals)."""
    above = _feats("CASE WHEN {f} * count({f}) OVER g > sum({f}) OVER g THEN 1 ELSE 0 END AS above_{f}")
    stats = ", ".join(
        f"CAST(sum(CAST({f} * {10 ** FEATURE_DECIMAL[f][1]} AS HUGEINT)) AS DOUBLE) / CAST(count({f}) AS DOUBLE)"
        f" / {float(10 ** FEATURE_DECIMAL[f][1])} AS mean_{f}, "
        f"CAST(count({f}) * sum(CAST({f} * {10 ** FEATURE_DECIMAL[f][1]} AS HUGEINT) * CAST({f} * {10 ** FEATURE_DECIMAL[f][1]} AS HUGEINT))"
        f" - sum(CAST({f} * {10 ** FEATURE_DECIMAL[f][1]} AS HUGEINT)) * sum(CAST({f} * {10 ** FEATURE_DECIMAL[f][1]} AS HUGEINT)) AS DOUBLE)"
        f" / CAST(NULLIF(count({f}) * (count({f}) - 1), 0) AS DOUBLE) / {float(10 ** (2 * FEATURE_DECIMAL[f][1]))} AS variance_{f}"
        for f in FEATURES) + ", " + _feats(
        "median(CAST({f} AS DOUBLE)) AS median_{f}, max(CAST({f} AS DOUBLE)) AS max_{f}, "
        "min(CAST({f} AS DOUBLE)) AS min_{f}, sum(above_{f}) AS above_{f}")
    return (f",\nhrows AS (SELECT date_trunc('hour', timestamp) AS timestamp, device_id, "
            f"{_feats('{f}')}, light FROM {src}),\n"
            f"flags AS (SELECT *, {above} FROM hrows WINDOW g AS (PARTITION BY timestamp, device_id)),\n"
            f"hstats AS (SELECT timestamp, device_id, count(*) AS record_count, {stats}, "
            f"avg(CAST(light AS DOUBLE)) AS mean_light FROM flags GROUP BY timestamp, device_id),\n"
            "hchg AS (SELECT *, " + _feats(
                "mean_{f} - lag(mean_{f}) OVER (PARTITION BY device_id ORDER BY timestamp) AS {f}_change_last_hour")
            + " FROM hstats)")


def _ratio(n: str, d: str) -> str:
    return f"{n} / CASE WHEN {d} = 0 THEN NULL ELSE {d} END"


ML_SELECT = ("SELECT timestamp, device_id, "
             + _feats("round(mean_{f}, %d) AS mean_{f}, round(median_{f}, %d) AS median_{f}, "
                      "round(variance_{f}, %d) AS variance_{f}")
             + ", " + _feats("round({f}_change_last_hour, %d) AS {f}_change_last_hour")
             + f", round({_ratio('mean_co', 'mean_humidity')}, %d) AS co_to_humidity_ratio"
             + f", round({_ratio('mean_smoke', 'mean_temperature')}, %d) AS smoke_to_temperature_ratio"
             + f", round({_ratio('mean_lpg', 'mean_co')}, %d) AS lpg_to_co_ratio, "
             + _feats("round(" + _ratio("variance_{f}", "mean_{f}") + ", %d) AS variance_to_mean_{f}")
             + ", " + _feats("round(100.0 * above_{f} / record_count, %d) AS high_low_percentage_{f}")
             + " FROM hchg")

# Storage casts follow NUMERIC assignment from float8: the double's shortest
# decimal text is rounded half-up (15.149999999999999 -> 15.1). DuckDB's direct
# double->decimal cast scales in binary first, so the oracle goes through text.
SEVEN_DAYS_BEFORE_MAX = "(SELECT max(timestamp) FROM telemetry) - INTERVAL 7 DAY"


def oracle_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["raw_line_encode"] = LINES + "\nSELECT event_id, value FROM raw_lines"
    q["raw_line_parse"] = ACC + "\nSELECT event_id, timestamp, device_id, " + _feats("{f}") + ", light FROM accepted"
    q["reject_counts"] = ACC + "\nSELECT coalesce(reject, 'ok') AS reason, count(*) AS lines FROM parsed GROUP BY 1"
    q["history_epoch_to_lines"] = TEL + """,
hist AS (SELECT event_id, epoch_us(timestamp) / 1000000.0 AS ts, device_id AS device,
  CAST(co AS DOUBLE) AS co, CAST(humidity AS DOUBLE) AS humidity, CAST(lpg AS DOUBLE) AS lpg,
  CAST(smoke AS DOUBLE) AS smoke, CAST(temperature AS DOUBLE) AS temp, light = 1 AS light FROM telemetry),
conv AS (SELECT event_id, make_timestamp(CAST(round(ts * 1000000) AS BIGINT)) AS timestamp, * EXCLUDE (event_id) FROM hist)
SELECT event_id, timestamp, device AS device_id, concat_ws(' ', strftime(timestamp, '%Y-%m-%d %H:%M:%S.%f'), device,
  CAST(co AS VARCHAR), CAST(humidity AS VARCHAR), CAST(lpg AS VARCHAR), CAST(smoke AS VARCHAR),
  CAST(temp AS VARCHAR), CAST(CAST(light AS INTEGER) AS VARCHAR)) AS value FROM conv"""
    q["full_minute_slice"] = ACC + MINUTE_SLICE + "\nSELECT event_id, timestamp, device_id FROM sliced"
    q["full_hour_slice"] = TEL + """,
cut AS (SELECT date_trunc('hour', max(timestamp)) AS c FROM telemetry)
SELECT event_id, timestamp, device_id FROM telemetry, cut WHERE timestamp < cut.c"""
    q["watermark_slice"] = TEL + f"\nSELECT event_id, timestamp, device_id FROM telemetry WHERE timestamp > {SEVEN_DAYS_BEFORE_MAX}"
    q["batch_quantiles"] = ACC + QUANTILES.format(src="accepted") + "\nSELECT " + _feats(
        "round({f}_lo, %d) AS {f}_lo, round({f}_hi, %d) AS {f}_hi") + " FROM limits"
    q["outlier_clip"] = ACC + QUANTILES.format(src="accepted") + "\nSELECT s.event_id, " + CLIP_SELECT + \
        " FROM accepted s, limits l"
    q["interpolate_pooled"] = ACC + QUANTILES.format(src="accepted") + f""",
clipped AS (SELECT s.event_id, s.timestamp, s.device_id, s.raw_line, {CLIP_SELECT} FROM accepted s, limits l),
ordered AS (SELECT *, row_number() OVER (ORDER BY timestamp, device_id, raw_line) AS rn FROM clipped)""" + \
        _interp("ordered") + "\nSELECT event_id, rn AS row_idx, " + _feats("round({f}, %d) AS {f}") + " FROM filled"
    q["interpolate_per_device"] = ACC + QUANTILES_BY_DEVICE.format(src="accepted") + f""",
clipped AS (SELECT s.event_id, s.timestamp, s.device_id, s.raw_line, {CLIP_SELECT} FROM accepted s JOIN limits l USING (device_id)),
ordered AS (SELECT *, row_number() OVER (PARTITION BY device_id ORDER BY timestamp, raw_line) AS rn FROM clipped)""" + \
        _interp("ordered", "device_id") + "\nSELECT event_id, device_id, rn AS row_idx, " + \
        _feats("round({f}, %d) AS {f}") + " FROM filled"
    q["row_index"] = LINES + "\nSELECT event_id, row_number() OVER (ORDER BY timestamp, event_id) AS row_idx FROM raw_lines"
    q["batch_labels"] = LINES + """,
idx AS (SELECT *, row_number() OVER (ORDER BY timestamp, event_id) AS row_idx FROM raw_lines),
b AS (SELECT floor((row_idx - 1) / 1000) AS batch_no, arg_max(value, row_idx) AS last_line, count(*) AS records FROM idx GROUP BY 1)
SELECT CAST(batch_no AS BIGINT) AS batch_no,
  split_part(trim(last_line), ' ', 1) || '_' || split_part(trim(last_line), ' ', 2) AS batch, records FROM b"""
    q["file_name_timestamp"] = q["batch_labels"].replace(
        "SELECT CAST(batch_no AS BIGINT) AS batch_no,", "SELECT CAST(batch_no AS BIGINT) AS batch_no, strptime(replace(") \
        .replace("split_part(trim(last_line), ' ', 2) AS batch, records FROM b",
                 "split_part(trim(last_line), ' ', 2), ':', '_'), '%Y-%m-%d_%H_%M_%S.%f') AS file_time FROM b")
    q["new_files"] = q["file_name_timestamp"].replace(
        "AS file_time FROM b", "AS file_time FROM b") + \
        f" WHERE file_time > {SEVEN_DAYS_BEFORE_MAX}"
    q["minute_rollup"] = ACC + "\n" + _minute_rollup("accepted", True)
    q["dds_end_to_end"] = ACC + MINUTE_SLICE + QUANTILES.format(src="sliced") + f""",
clipped AS (SELECT s.timestamp, s.device_id, s.raw_line, s.light, {CLIP_SELECT} FROM sliced s, limits l),
ordered AS (SELECT *, row_number() OVER (ORDER BY timestamp, device_id, raw_line) AS rn FROM clipped)""" + \
        _interp("ordered") + "\n" + _minute_rollup("filled", False)
    full_hours = TEL + """,
hcut AS (SELECT date_trunc('hour', max(timestamp)) AS c FROM telemetry),
dds AS (SELECT t.* FROM telemetry t, hcut WHERE t.timestamp < hcut.c)"""
    q["dm_end_to_end"] = full_hours + _hourly("dds") + "\n" + ML_SELECT
    hourly = TEL + _hourly("telemetry")
    q["hourly_average"] = hourly + "\nSELECT timestamp, device_id, " + _feats("round(mean_{f}, %d) AS {f}") + \
        ", round(mean_light, %d) AS light FROM hstats"
    q["hourly_extreme"] = hourly + "\nSELECT timestamp, device_id, " + _feats(
        "round(max_{f}, %d) AS max_{f}, round(min_{f}, %d) AS min_{f}") + " FROM hstats"
    q["hourly_count"] = hourly + "\nSELECT timestamp, device_id, CAST(record_count AS INTEGER) AS record_count FROM hstats"
    q["hourly_mean"] = hourly + "\nSELECT timestamp, device_id, " + _feats("round(mean_{f}, %d) AS mean_{f}") + " FROM hstats"
    q["hourly_median"] = hourly + "\nSELECT timestamp, device_id, " + _feats("round(median_{f}, %d) AS median_{f}") + " FROM hstats"
    q["hourly_variance"] = hourly + "\nSELECT timestamp, device_id, " + _feats("round(variance_{f}, %d) AS variance_{f}") + " FROM hstats"
    q["hourly_change"] = hourly + "\nSELECT timestamp, device_id, " + _feats(
        "round({f}_change_last_hour, %d) AS {f}_change_last_hour") + " FROM hchg"
    q["hourly_ratios"] = hourly + "\nSELECT timestamp, device_id" \
        f", round({_ratio('mean_co', 'mean_humidity')}, %d) AS co_to_humidity_ratio" \
        f", round({_ratio('mean_smoke', 'mean_temperature')}, %d) AS smoke_to_temperature_ratio" \
        f", round({_ratio('mean_lpg', 'mean_co')}, %d) AS lpg_to_co_ratio FROM hstats"
    q["variance_to_mean"] = hourly + "\nSELECT timestamp, device_id, " + _feats(
        "round(" + _ratio("variance_{f}", "mean_{f}") + ", %d) AS variance_to_mean_{f}") + " FROM hstats"
    q["high_low_percentage"] = hourly + "\nSELECT timestamp, device_id, " + _feats(
        "round(100.0 * above_{f} / record_count, %d) AS high_low_percentage_{f}") + " FROM hstats"
    q["ml_features"] = hourly + "\n" + ML_SELECT
    q["keep_first_dedupe"] = TEL + """,
keyed AS (SELECT date_trunc('minute', timestamp) AS minute, * EXCLUDE (timestamp) FROM telemetry),
ranked AS (SELECT *, row_number() OVER (PARTITION BY minute, device_id ORDER BY event_id) AS rk FROM keyed)
SELECT minute AS timestamp, device_id, event_id, """ + _feats("{f}") + ", light FROM ranked WHERE rk = 1"
    mid = "(SELECT min(timestamp) + (max(timestamp) - min(timestamp)) / 2 FROM telemetry)"
    q["anti_join_append"] = TEL + f""",
minutes AS ({_minute_rollup('telemetry', True)}),
stored AS (SELECT timestamp, device_id FROM ({_minute_rollup(f'(SELECT * FROM telemetry WHERE timestamp < {mid})', True)}))
SELECT m.* FROM minutes m ANTI JOIN stored s USING (timestamp, device_id)"""
    q["constraint_violations"] = ACC + """,
v AS (SELECT
  count(*) FILTER (WHERE timestamp IS NULL) AS ts_null,
  count(*) FILTER (WHERE device_id IS NULL) AS dev_null,
  count(*) FILTER (WHERE length(device_id) > 17) AS dev_len,
  count(*) FILTER (WHERE light IS NULL) AS light_null,
  count(*) FILTER (WHERE light NOT IN (0, 1)) AS light_dom,
  """ + _feats("count(*) FILTER (WHERE {f} IS NULL) AS {f}_null") + ", " + _feats("count(*) FILTER (WHERE {f} IS NOT NULL AND try_cast({f} AS DECIMAL(%s)) IS NULL) AS {f}_rng") + """
  FROM parsed),
l AS (SELECT 'timestamp' AS column_name, 'not_null' AS check_name, ts_null AS violations FROM v
  UNION ALL SELECT 'device_id', 'not_null', dev_null FROM v
  UNION ALL SELECT 'device_id', 'length', dev_len FROM v
  """ + "\n  ".join(f"UNION ALL SELECT '{f}', 'range', {f}_rng FROM v UNION ALL SELECT '{f}', 'not_null', {f}_null FROM v" for f in FEATURES) + """
  UNION ALL SELECT 'light', 'not_null', light_null FROM v
  UNION ALL SELECT 'light', 'domain', light_dom FROM v)
SELECT * FROM l WHERE violations > 0"""
    for f in FEATURES:
        p, s = FEATURE_DECIMAL[f]
        q["constraint_violations"] = q["constraint_violations"].replace(
            f"try_cast({f} AS DECIMAL(%s))", f"try_cast({f} AS DECIMAL({p},{s}))", 1)
    q["duplicate_keys"] = TEL + """
SELECT date_trunc('minute', timestamp) AS timestamp, device_id, count(*) AS copies
FROM telemetry GROUP BY 1, 2 HAVING count(*) > 1"""
    q["time_series_report"] = hourly + f""",
recent AS (SELECT * FROM hstats WHERE timestamp >= {SEVEN_DAYS_BEFORE_MAX})
SELECT timestamp, device_id, """ + _feats(
        "round(mean_{f}, %d) AS avg_{f}, round(min_{f}, %d) AS min_{f}, round(max_{f}, %d) AS max_{f}") + " FROM recent"
    q["completeness_monitor"] = ACC + f""",
minutes AS ({_minute_rollup('accepted', False)}),
cnt AS (SELECT date_trunc('hour', timestamp) AS timestamp, device_id, count(*) AS record_count FROM minutes GROUP BY 1, 2)
SELECT timestamp, device_id, CAST(record_count AS INTEGER) AS record_count,
  round(100.0 * record_count / 60.0, %d) AS completeness_pct FROM cnt WHERE record_count <> 60"""
    q["device_summary"] = TEL + "\nSELECT device_id, count(*) AS rows, " + _feats(
        "round(avg(CAST({f} AS DOUBLE)), %d) AS avg_{f}, round(stddev_samp(CAST({f} AS DOUBLE)), %d) AS std_{f}") + \
        " FROM telemetry GROUP BY device_id"
    q["late_rows"] = TEL + f"""
SELECT device_id, count(*) AS late_rows FROM telemetry WHERE timestamp <= {SEVEN_DAYS_BEFORE_MAX} GROUP BY device_id"""
    q["union_files"] = q["history_epoch_to_lines"].replace(
        "SELECT event_id, timestamp, device AS device_id, concat_ws(",
        "SELECT 'history' AS source, event_id, concat_ws(") + """
UNION ALL
SELECT 'landing' AS source, event_id, value FROM (""" + LINES.replace("WITH ", "WITH ", 1) + \
        "\nSELECT event_id, value FROM raw_lines)"
    q["storage_cast"] = ACC + f""",
minutes AS ({_minute_rollup('accepted', False, rounded=False)})
SELECT timestamp, device_id, """ + _feats("try_cast(CAST({f} AS VARCHAR) AS DECIMAL(%s)) AS {f}") + \
        ", CAST(light AS SMALLINT) AS light FROM minutes"
    for f in FEATURES:
        p, s = FEATURE_DECIMAL[f]
        q["storage_cast"] = q["storage_cast"].replace(
            f"try_cast(CAST({f} AS VARCHAR) AS DECIMAL(%s))", f"try_cast(CAST({f} AS VARCHAR) AS DECIMAL({p},{s}))", 1)
    q["minute_stream"] = ACC + MINUTE_SLICE + "\n" + _minute_rollup("sliced", True)
    q["hour_stream"] = q["minute_stream"].replace("\n" + _minute_rollup("sliced", True), "") + f""",
minutes AS ({_minute_rollup('sliced', False, rounded=False)}),
mcut AS (SELECT max(timestamp) AS c FROM accepted),
hours AS (SELECT m.* FROM minutes m, mcut WHERE date_trunc('hour', m.timestamp) + INTERVAL 1 HOUR <= mcut.c)
SELECT date_trunc('hour', timestamp) AS timestamp, device_id, count(*) AS record_count, """ + _feats(
        "round(avg({f}), %d) AS {f}, round(max({f}), %d) AS max_{f}, round(min({f}), %d) AS min_{f}") + \
        " FROM hours GROUP BY 1, 2"
    q |= _job_oracles(q)
    return {k: _half_up_rounding(v) for k, v in q.items()}


def _decimal(expr: str, p: int, s: int) -> str:
    return f"try_cast(CAST({expr} AS VARCHAR) AS DECIMAL({p},{s}))"


def _stored(src: str) -> str:
    """Minutes of ``src`` as the minute table stores them."""
    return (f"SELECT timestamp, device_id, " + ", ".join(f"{_decimal(f, *FEATURE_DECIMAL[f])} AS {f}" for f in FEATURES)
            + f", CAST(light AS SMALLINT) AS light FROM ({_minute_rollup(src, False, rounded=False)})")


# the raw lines in three parts by time
PARTS = """,
parts AS (SELECT event_id, CAST(floor((row_number() OVER (ORDER BY timestamp, event_id) - 1) * 3 / count(*) OVER ()) AS INTEGER) AS part FROM raw_lines),
acc AS (SELECT a.*, part FROM accepted a JOIN parts USING (event_id))"""


def _load_marks() -> str:
    """The newest stored minute after the first and after the second of three loads without cleaning."""
    marks = "".join(f""",
cut{p} AS (SELECT date_trunc('minute', max(timestamp)) AS c FROM acc WHERE part <= {p}),
wm{p} AS (SELECT date_trunc('minute', max(timestamp)) AS w FROM acc, cut{p} WHERE part <= {p} AND timestamp < c)""" for p in range(2))
    return ACC + PARTS + marks


def _clean_loads() -> str:
    """Three loads, each with the quantiles and the interpolation of the rows that it reads: those after the
    newest stored minute and before the newest minute that has begun."""
    sql = ACC + PARTS + ",\nstored0 AS (SELECT * FROM (" + _stored("(FROM accepted LIMIT 0)") + "))"
    complete = " AND ".join(f"{f} IS NOT NULL" for f in FEATURES)
    for p in range(3):
        load = f"""WITH s AS (SELECT * FROM acc, (SELECT date_trunc('minute', max(timestamp)) AS c FROM acc WHERE part <= {p}), (SELECT max(timestamp) AS w FROM stored{p}) m
  WHERE part <= {p} AND acc.timestamp < c AND (w IS NULL OR acc.timestamp > w))""" + QUANTILES.format(src="s") + f""",
clipped AS (SELECT s.timestamp, s.device_id, s.raw_line, s.light, {CLIP_SELECT} FROM s, limits l),
ordered AS (SELECT *, row_number() OVER (ORDER BY timestamp, device_id, raw_line) AS rn FROM clipped)""" + _interp("ordered") + "\n" + _stored("filled")
        sql += f""",
stored{p + 1} AS (SELECT * FROM stored{p} UNION ALL SELECT n.* FROM ({load}) n ANTI JOIN stored{p} USING (timestamp, device_id) WHERE {complete} AND light IS NOT NULL)"""
    return sql + "\nSELECT * FROM stored3"


def _job_oracles(q: dict[str, str]) -> dict[str, str]:
    """What the deployed jobs leave in their tables, computed in one go."""
    out = {}
    out["job_minutes"] = out["minute_table_stream"] = ACC + MINUTE_SLICE + "\n" + _stored("sliced")
    ml = {}
    for f in FEATURES:
        ml |= {f"{c}_{f}": FEATURE_DECIMAL[f] for c in ("max", "min", "mean", "median")}
        ml |= {f"variance_{f}": VARIANCE_DECIMAL[f], f"{f}_change_last_hour": FEATURE_DECIMAL[f]}
    cols = [_decimal(f"mean_{f}", *FEATURE_DECIMAL[f]) + f" AS {f}" for f in FEATURES]
    cols += [_decimal("mean_light", *LIGHT_MEAN_DECIMAL) + " AS light", "CAST(record_count AS INTEGER) AS record_count"]
    cols += [_decimal(c, *d) + f" AS {c}" for c, d in ml.items()]
    cols += [_decimal(_ratio(f"mean_{n}", f"mean_{d}"), *RATIO_DECIMAL) + f" AS {name}" for name, (n, d) in RATIOS.items()]
    cols += [_decimal(_ratio(f"variance_{f}", f"mean_{f}"), *RATIO_DECIMAL) + f" AS variance_to_mean_{f}" for f in FEATURES]
    cols += [_decimal(f"100.0 * above_{f} / record_count", *PERCENT_DECIMAL) + f" AS high_low_percentage_{f}" for f in FEATURES]
    out["job_marts"] = ACC + MINUTE_SLICE + f""",
stored AS ({_stored('sliced')}),
hcut AS (SELECT date_trunc('hour', max(timestamp)) AS c FROM stored),
dds AS (SELECT s.* FROM stored s, hcut WHERE s.timestamp < hcut.c)""" + _hourly("dds") + "\nSELECT timestamp, device_id, " + ", ".join(cols) + " FROM hchg"
    out["history_load"] = TEL + """
SELECT timestamp, device_id, CASE WHEN event_id % 61 <> 0 THEN CAST(co AS DOUBLE) END AS co, CAST(humidity AS DOUBLE) AS humidity,
  CAST(lpg AS DOUBLE) AS lpg, CAST(smoke AS DOUBLE) AS smoke, CAST(temperature AS DOUBLE) AS temperature, light, CAST(NULL AS VARCHAR) AS reject
FROM telemetry"""
    out["device_export"] = TEL + ",\none AS (SELECT * FROM telemetry WHERE device_id = 'b8:27:eb:bf:9d:51')" + _hourly("one") + \
        "\nSELECT timestamp, device_id, " + _feats(
            "round(mean_{f}, %d) AS avg_{f}, round(min_{f}, %d) AS min_{f}, round(max_{f}, %d) AS max_{f}") + " FROM hstats"
    out["reject_reasons"] = TEL + f""",
f AS (SELECT *, CASE WHEN event_id % 73 = 0 OR event_id % 71 = 0 THEN 'timestamp' WHEN event_id % 67 = 0 THEN 'number'
  WHEN event_id % 83 = 0 THEN 'domain' WHEN event_id % 79 = 0 THEN 'length' ELSE 'ok' END AS reason FROM telemetry),
good AS (SELECT timestamp, device_id, CASE WHEN event_id % 5 = 0 THEN 123.0 ELSE CAST(co AS DOUBLE) END AS co,
  CASE WHEN event_id % 7 <> 0 THEN CAST(humidity AS DOUBLE) END AS humidity, lpg, smoke, temperature, light FROM f WHERE reason = 'ok'),
m AS ({_stored("good")}),
r AS ({_minute_rollup("good", False, rounded=False)}),
s AS (SELECT CASE WHEN m.co IS NULL THEN 'range' WHEN r.humidity IS NULL THEN 'null' ELSE 'ok' END AS reason FROM m JOIN r USING (timestamp, device_id))
SELECT 'line' AS stage, reason, count(*) AS lines FROM f GROUP BY ALL UNION ALL SELECT 'minute', reason, count(*) FROM s GROUP BY ALL"""
    out["job_minutes_clean"] = out["minute_table_stream_clean"] = _clean_loads()
    out["file_ledger"] = _load_marks() + """,
idx AS (SELECT l.*, a.event_id IS NOT NULL AS ok, floor((row_number() OVER o - 1) / 1000) AS batch_no, row_number() OVER o AS rn
  FROM raw_lines l LEFT JOIN accepted a USING (event_id) WINDOW o AS (ORDER BY l.timestamp, event_id)),
staged AS (SELECT part, batch_no, idx.* EXCLUDE (batch_no) FROM idx JOIN parts USING (event_id) UNION ALL SELECT 2, 1000000 + batch_no, idx.* EXCLUDE (batch_no) FROM idx WHERE event_id % 700 = 0),
marked AS (SELECT staged.*, w FROM staged LEFT JOIN (SELECT 1 AS part, w FROM wm0 UNION ALL SELECT 2, w FROM wm1) USING (part)),
files AS (SELECT part, max_by(timestamp, rn) AS file_time, any_value(w) AS watermark, count(*) AS lines, count(*) FILTER (NOT ok) AS rejected_lines,
  count(*) FILTER (ok AND timestamp <= w) AS late_lines FROM marked GROUP BY part, batch_no)
SELECT CAST(part AS BIGINT) AS load, CASE WHEN file_time <= watermark THEN 'late' ELSE 'loaded' END AS status, file_time, watermark,
  CAST(CASE WHEN file_time <= watermark THEN NULL ELSE lines END AS DOUBLE) AS lines, CAST(CASE WHEN file_time <= watermark THEN NULL ELSE rejected_lines END AS DOUBLE) AS rejected_lines,
  CAST(CASE WHEN file_time <= watermark THEN NULL ELSE late_lines END AS DOUBLE) AS late_lines FROM files
UNION ALL SELECT 1, 'refused', NULL, w, NULL, NULL, NULL FROM wm0 WHERE EXISTS (FROM idx)"""
    out["stream_late_rows"] = _load_marks() + """
SELECT CAST(2 AS BIGINT) AS batch, device_id, count(*) AS late_rows FROM accepted, wm1 WHERE event_id % 50 = 0 AND timestamp <= w GROUP BY device_id"""
    out["landing_stream_batches"] = LINES + """,
idx AS (SELECT timestamp, row_number() OVER (ORDER BY timestamp, event_id) AS rn FROM raw_lines)
SELECT max_by(timestamp, rn) AS file_time, count(*) AS lines FROM idx GROUP BY floor((rn - 1) / 1000)"""
    out["completeness_calendar"] = ACC + f""",
minutes AS ({_minute_rollup('accepted', False)}),
cnt AS (SELECT date_trunc('hour', timestamp) AS timestamp, device_id, count(*) AS n FROM minutes GROUP BY 1, 2),
spans AS (SELECT device_id, min(timestamp) AS a, (SELECT max(timestamp) FROM cnt) AS b FROM cnt GROUP BY 1),
spine AS (SELECT device_id, unnest(generate_series(a, b, INTERVAL 1 HOUR)) AS timestamp FROM spans)
SELECT timestamp, device_id, CAST(coalesce(n, 0) AS INTEGER) AS record_count, round(100.0 * coalesce(n, 0) / 60.0, %d) AS completeness_pct
FROM spine LEFT JOIN cnt USING (timestamp, device_id) WHERE coalesce(n, 0) <> 60"""
    out["table_lifecycle"] = ACC + f""",
filled AS (SELECT count(*) AS n FROM ({_stored("accepted")}) WHERE {_feats("{f} IS NOT NULL", " AND ")} AND light IS NOT NULL),
t AS (SELECT unnest(['dds_iot_data', 'dm_iot_average', 'dm_iot_extreme', 'dm_iot_count', 'dm_iot_ml', 'landing_files']) AS table_name),
s AS (SELECT unnest(['created', 'filled', 'one dropped', 'all dropped']) AS step),
p AS (SELECT step, table_name, step <> 'all dropped' AND NOT (step = 'one dropped' AND table_name = 'dm_iot_ml') AS present FROM s, t)
SELECT step, table_name, present, CAST(CASE WHEN present THEN CASE WHEN step <> 'created' AND table_name = 'dds_iot_data' THEN n ELSE 0 END END AS DOUBLE) AS rows FROM p, filled"""
    fed = ACC + MINUTE_SLICE + f",\nstored AS ({_stored('sliced')})"
    ml = ML_SELECT[len("SELECT timestamp, device_id, "):-len(" FROM hchg")]
    out["minute_fed_marts"] = fed + """,
hcut AS (SELECT date_trunc('hour', max(timestamp)) AS c FROM stored),
dds AS (SELECT s.* FROM stored s, hcut WHERE s.timestamp < hcut.c)""" + _hourly("dds") + "\nSELECT timestamp, device_id, " + _feats(
        "round(mean_{f}, %d) AS {f}") + ", round(mean_light, %d) AS light, CAST(record_count AS INTEGER) AS record_count, " + _feats(
        "round(max_{f}, %d) AS max_{f}, round(min_{f}, %d) AS min_{f}") + ", " + ml + " FROM hchg"
    out["minute_fed_report"] = fed + _hourly("stored") + "\nSELECT timestamp, device_id, " + _feats(
        "round(mean_{f}, %d) AS avg_{f}, round(min_{f}, %d) AS min_{f}, round(max_{f}, %d) AS max_{f}") + \
        " FROM hstats WHERE timestamp >= (SELECT max(timestamp) - INTERVAL 7 DAY FROM stored)"
    out["mart_publication"] = ACC + MINUTE_SLICE + f""",
stored AS ({_stored('sliced')}),
early AS (SELECT * FROM stored WHERE timestamp < (SELECT date_trunc('day', min(timestamp)) + INTERVAL 10 DAY FROM stored)),
n AS (SELECT (SELECT count(DISTINCT (date_trunc('hour', timestamp), device_id)) FROM early WHERE timestamp < (SELECT date_trunc('hour', max(timestamp)) FROM early)) AS a,
  (SELECT count(DISTINCT (date_trunc('hour', timestamp), device_id)) FROM stored WHERE timestamp < (SELECT date_trunc('hour', max(timestamp)) FROM stored)) AS b)
SELECT step, mart, CASE WHEN step = 'next load' THEN b ELSE a END AS rows FROM n, (SELECT unnest(['first days', 'failed load', 'next load']) AS step),
  (SELECT unnest(['dm_iot_average', 'dm_iot_extreme', 'dm_iot_count', 'dm_iot_ml']) AS mart)"""
    means = _feats("avg({f}) AS {f}")
    out["hour_change_stream"] = q["hour_stream"][:q["hour_stream"].index("\nSELECT date_trunc('hour', timestamp) AS timestamp, device_id, count(*)")] + f""",
means AS (SELECT date_trunc('hour', timestamp) AS timestamp, device_id, {means} FROM hours GROUP BY 1, 2)
SELECT timestamp, device_id, """ + _feats("round({f} - lag({f}) OVER (PARTITION BY device_id ORDER BY timestamp), %d) AS {f}_change_last_hour") + " FROM means"
    hours = "hours AS (SELECT m.*"
    share = q["hour_stream"].replace(hours, "hours AS (SELECT m.*, date_trunc('hour', m.timestamp) AS h")
    share = share.replace("\nSELECT date_trunc('hour', timestamp) AS timestamp, device_id, count(*) AS record_count, ",
                          ",\nflagged AS (SELECT *, " + ", ".join("CASE WHEN {d} * count({f}) OVER g > sum({d}) OVER g THEN 1 ELSE 0 END AS above_{f}".format(
                              f=f, d=_decimal(f, *FEATURE_DECIMAL[f])) for f in FEATURES)
                          + " FROM hours WINDOW g AS (PARTITION BY h, device_id))\nSELECT h AS timestamp, device_id, count(*) AS record_count, "
                          + "round(avg(CAST(light AS DOUBLE)), %d) AS light, " + _feats("round(100.0 * sum(above_{f}) / count(*), %d) AS high_low_percentage_{f}") + ", ")
    out["hour_stream"] = share.replace(" FROM hours GROUP BY 1, 2", " FROM flagged GROUP BY 1, 2")
    return out


def _half_up_rounding(sql: str) -> str:
    """Rewrite ``round(expr, %d)`` as Spark's DOUBLE rounding: half-up on the
    shortest decimal text of the double (DuckDB's ``round`` scales in binary,
    which rounds some decimal ties the other way)."""
    out, i = [], 0
    while True:
        j = sql.find("round(", i)
        if j < 0:
            out.append(sql[i:])
            return "".join(out)
        depth, k = 0, j + len("round")
        while True:
            if sql[k] == "(":
                depth += 1
            elif sql[k] == ")":
                depth -= 1
                if depth == 0:
                    break
            k += 1
        inner = sql[j + len("round("):k]
        out.append(sql[i:j])
        if inner.endswith(", %d"):
            expr = _half_up_rounding(inner[:-len(", %d")])
            out.append(f"CAST(CAST(CAST({expr} AS VARCHAR) AS DECIMAL(38,{R})) AS DOUBLE)")
        else:
            out.append("round(" + _half_up_rounding(inner) + ")")
        i = k + 1
