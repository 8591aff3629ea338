"""Scalar column functions (SF1-SF15) as built-in Spark expressions.

Every function returns a ``Column``; nothing here runs Python per row.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sensorlake.schemas import LANDING_NAME_FORMAT, RAW_TIME_FORMAT

__all__ = [
    "whitespace_tokens", "line_timestamp", "file_name_timestamp", "label_timestamp",
    "file_stem", "floor_minute", "floor_hour", "epoch_to_timestamp",
    "timestamp_text", "safe_ratio",
    "percent_of", "batch_label_from_line", "float_text",
]


def whitespace_tokens(line: Column) -> Column:
    """SF7: split a line on any run of whitespace, ignoring leading/trailing
    whitespace, like Python's ``str.split()``. A blank line gives []."""
    # one regex split; the only empty pieces are at the ends (leading or
    # trailing whitespace, blank line), and array_remove drops them
    return F.array_remove(F.split(line, r"\s+"), "")


def line_timestamp(date_tok: Column, time_tok: Column) -> Column:
    """SF2: 'yyyy-MM-dd' + 'HH:mm:ss[.ffffff]' -> TIMESTAMP_NTZ, NULL when invalid.

    Nothing but digits and separators is taken: a cast alone would accept a
    zone offset behind the time and drop it."""
    plain = (F.translate(date_tok, "0123456789-", "") == "") & (F.translate(time_tok, "0123456789:.", "") == "")
    return F.when(plain, F.concat_ws(" ", date_tok, time_tok).try_cast("timestamp_ntz"))


def file_stem(path: Column) -> Column:
    """Last path component without a trailing '.txt'."""
    return F.regexp_replace(F.substring_index(path, "/", -1), r"\.txt$", "")


def file_name_timestamp(path: Column) -> Column:
    """SF1: landing file name -> TIMESTAMP_NTZ of its last record.

    Names are ``yyyy-MM-dd_HH_mm_ss.SSSSSS.txt``; the colon spelling
    ``yyyy-MM-dd_HH:mm:ss.SSSSSS`` is accepted too. NULL when malformed.
    """
    return label_timestamp(F.translate(file_stem(path), ":", "_"))


def label_timestamp(label: Column) -> Column:
    """Batch label -> TIMESTAMP_NTZ, NULL when malformed.

    Other texts (``part-00000-...``) are not tried: a failed parse throws and catches an exception, and
    this runs for every line of a file."""
    return F.when(label.rlike("^[0-9+_.-]+$"), F.try_to_timestamp(label, F.lit(LANDING_NAME_FORMAT))).cast("timestamp_ntz")


def floor_minute(ts: Column) -> Column:
    """SF3: left edge of the minute, kept as TIMESTAMP_NTZ."""
    return F.date_trunc("minute", ts).cast("timestamp_ntz")


def floor_hour(ts: Column) -> Column:
    """SF4: left edge of the hour, kept as TIMESTAMP_NTZ."""
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def epoch_to_timestamp(epoch_seconds: Column) -> Column:
    """SF5: epoch seconds (double) -> TIMESTAMP_NTZ in UTC; rounds to the
    microsecond first because a bigint cast would truncate."""
    micros = F.round(epoch_seconds * F.lit(1_000_000)).cast("bigint")
    return F.timestamp_micros(micros).cast("timestamp_ntz")


def timestamp_text(ts: Column) -> Column:
    """SF6: timestamp -> 'yyyy-MM-dd HH:mm:ss.ffffff'."""
    return F.date_format(ts, RAW_TIME_FORMAT)




def safe_ratio(num: Column, den: Column) -> Column:
    """SF11/SF12: num/den, NULL when den is 0 or either side is NULL."""
    return F.try_divide(num, den)


def percent_of(part: Column, whole: Column) -> Column:
    """SF13: 100 * part / whole as DOUBLE."""
    return F.lit(100.0) * part.cast("double") / whole.cast("double")



def batch_label_from_line(line: Column) -> Column:
    """SF8: first two blank-separated tokens of a trimmed line joined by '_'."""
    toks = F.split(F.trim(line), " ")
    return F.concat_ws("_", F.element_at(toks, 1), F.element_at(toks, 2))


def float_text(x: Column) -> Column:
    """Shortest text of a DOUBLE as a Python program prints it into a raw line
    ('0.000655', '22.6', '1e-06', '1.63e-05', '1e+16').

    Rule of that format: plain notation for 1e-4 <= |x| < 1e16, otherwise
    mantissa + 'e' + signed two-digit exponent. Spark's cast gives the same
    digits but switches to 'E' notation below 1e-3 and from 1e7 on, so those
    texts are re-rendered (plain ones through an exact decimal)."""
    s = x.cast("string")
    mant = F.regexp_extract(s, r"^(-?[0-9.]+)E", 1)
    exp = F.regexp_extract(s, r"E(-?[0-9]+)$", 1).try_cast("int")
    sci_mant = F.regexp_replace(mant, r"\.0$", "")
    sci = F.concat(sci_mant, F.lit("e"), F.when(exp < 0, F.lit("-")).otherwise(F.lit("+")),
                   F.when(F.abs(exp) < 10, F.concat(F.lit("0"), F.abs(exp).cast("string")))
                   .otherwise(F.abs(exp).cast("string")))
    plain = F.regexp_replace(s.try_cast("decimal(38,30)").cast("string"), r"0+$", "")
    plain = F.regexp_replace(plain, r"\.$", ".0")
    return (F.when(exp.isNull(), s)
            .when((exp >= -4) & (exp < 16), plain)
            .otherwise(sci))
