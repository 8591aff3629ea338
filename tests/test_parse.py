"""Line parsing and reject accounting (FIXTURES.md section 4)."""
from pyspark.sql import functions as F

from sensorlake.operators.parse import accepted, parse_lines, reject_counts

from helpers import line, lines_df

DEV = "b8:27:eb:bf:9d:51"
T = "2020-07-19 23:58:27.364972"


def test_reject_reasons(spark):
    cases = {
        "ok": line(T, DEV),
        "tabs": line(T, DEV).replace(" ", " \t  "),
        "short": f"{T} {DEV}       ",
        "long": line(T, DEV) + " 7",
        "blank": "   ",
        "bad_ts": line("2020-99-01 00:00:00.000000", DEV),
        "bad_number": line(T, DEV, co="x"),
        "light2": line(T, DEV, light="2"),
        "long_device": line(T, DEV + "0"),
    }
    parsed = parse_lines(lines_df(spark, list(cases.values())))
    got = {r["raw_line"]: r["reject"] for r in parsed.collect()}
    want = {"ok": None, "tabs": None, "short": "arity", "long": "arity", "blank": "arity",
            "bad_ts": "timestamp", "bad_number": "number", "light2": "domain", "long_device": "length"}
    assert {k: got[v] for k, v in cases.items()} == want
    counts = {r["reason"]: r["lines"] for r in reject_counts(parsed).collect()}
    assert counts == {"ok": 2, "arity": 3, "timestamp": 1, "number": 1, "domain": 1, "length": 1}


def test_accepted_values(spark):
    df = accepted(parse_lines(lines_df(spark, [line(T, DEV, co="0.0058973606725447", hum="49.5", light="1")])))
    r = df.collect()[0]
    assert str(r["timestamp"]) == "2020-07-19 23:58:27.364972"
    assert r["device_id"] == DEV and r["co"] == 0.0058973606725447 and r["humidity"] == 49.5 and r["light"] == 1


def test_nan_token_is_missing_not_reject(spark):
    df = parse_lines(lines_df(spark, [line(T, DEV, hum="NaN")]))
    r = df.collect()[0]
    assert r["reject"] is None and r["humidity"] is None


def test_tokens_are_taken_as_written_or_not_at_all(spark):
    """What a cast would accept beyond a plain number or time is a reject."""
    cases = {line(T, DEV, co="1.0d"): "number", line(T, DEV, co="0x1p3"): "number", line(T, DEV, light="1f"): "number",
             line("2020-07-19 00:00:00.000000+05:00", DEV): "timestamp", line("2020-07-19 00:00:00Z", DEV): "timestamp",
             line(T, DEV, co="1e-3"): None, line(T, DEV, co="-0.5"): None, line(T, DEV, co=".5"): None}
    got = {r["raw_line"]: r["reject"] for r in parse_lines(lines_df(spark, list(cases))).collect()}
    assert got == cases


def test_missing_values_survive_a_replay(spark):
    from sensorlake.sources.landing import history_to_lines
    hist = spark.createDataFrame([(1594512000.5, DEV, None, 50.0, True, 0.1, 0.2, 20.0)],
                                 "ts double, device string, co double, humidity double, light boolean, lpg double, smoke double, temp double")
    lines = history_to_lines(hist).select("value")
    assert " nan 50.0 " in lines.first()["value"]
    r = parse_lines(lines.selectExpr("value", "'' as file_name")).first()
    assert r["reject"] is None and r["co"] is None and r["humidity"] == 50.0


def test_generated_code_of_the_parser_is_compiled(spark):
    """The JVM leaves methods of more than 8,000 bytes to its interpreter: each line then takes several times as long."""
    lines = spark.range(10).select(F.concat(F.lit("2020-07-20 00:00:00.000000 d 1 2 3 4 5 "), F.col("id") % 2).alias("value"))
    code = accepted(parse_lines(lines))._jdf.queryExecution().debug().codegenToSeq()
    assert code.size() and max(code.apply(i)._3().maxMethodCodeSize() for i in range(code.size())) <= 8000
