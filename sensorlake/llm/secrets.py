"""Secret scan with a trigram inverted index (operator 7, DataFrame functions only).

From every rule's regular expression a Boolean query over trigrams is derived: an
alternative of conjunctions that every text with a match must satisfy.  Postings
(trigram, text key) are kept for the trigrams that some rule asks for; per key the
posting lists are intersected, and only texts that satisfy a rule's query are
verified with its expression.  A rule without mandatory trigrams scans all texts.
The index compares lower-cased text, so a query never misses a match in other case.

Spans are found without leaving the JVM: the pieces between the matches and the
matches themselves give every match's offsets by their lengths.

Defined results: a null text is an empty one, without spans; repeated rows and
null ids are scanned like others; offsets are code points, the end exclusive.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parse
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sensorlake.llm.scratch import pin


@dataclass(frozen=True)
class Rule:
    """``pattern`` in the syntax that Java and Python share; ``group`` must have ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds, in order. A run of 14 (16) or more is what is left of
#: `AKIA[A-Z0-9]+` (`[0-9a-f]+`) when matches under 18 (16) characters are dropped.
BASE = (
    Rule("assign", r"""((?:[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12),
    Rule("access", r"AKIA[A-Z0-9]{14,}"),
    Rule("hex", r"[0-9a-f]{16,}"),
)
#: Further kinds, each with a fixed mark of its issuer.
MORE = (
    Rule("github", r"gh[opsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)

MOST_STRINGS, MOST_CHARACTERS = 64, 8


# ---- regular expression -> Boolean trigram query ---------------------------------------

def trigram_query(pattern: str) -> list[frozenset[str]] | None:
    """Alternatives, each a set of lower-case trigrams that all occur; None if nothing is mandatory."""
    strings, query = _derive(sre_parse.parse(pattern))
    query = _both(query, _of_strings(strings))
    if query is None or frozenset() in query:
        return None
    return sorted((a for a in query if not any(b < a for b in query)), key=sorted)


def _of_strings(strings):
    """What a text holds that holds one of ``strings`` (None: unknown)."""
    if strings is None:
        return None
    return {frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings}


def _both(a, b):
    if a is None or b is None:
        return a if b is None else b
    out = {x | y for x, y in product(a, b)}
    return out if len(out) <= MOST_STRINGS else a


def _either(queries):
    return None if any(q is None for q in queries) else set().union(*queries)


def _derive(nodes):
    """(the strings it matches, or None if too many or unknown; what any match demands besides)."""
    run, query, exact = {""}, None, True
    for op, arg in nodes:
        strings, own = _node(op, arg)
        query = _both(query, own)
        joined = None if strings is None else {a + b for a, b in product(run, strings)}
        if joined is not None and len(joined) <= MOST_STRINGS:
            run = joined
            continue
        # the run of known strings ends here; what it demands stays, and a new one begins
        query, exact = _both(query, _of_strings(run)), False
        run = strings if strings is not None else {""}
    if exact:
        return run, query
    return None, _both(query, _of_strings(run))


def _node(op, arg):
    if op is sre.LITERAL:
        return {chr(arg).lower()}, None
    if op is sre.IN:
        chars = set()
        for kind, value in arg:
            if kind is sre.LITERAL:
                chars.add(chr(value).lower())
            elif kind is sre.RANGE and value[1] - value[0] < MOST_CHARACTERS:
                chars |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
            else:
                return None, None
        return (chars if len(chars) <= MOST_CHARACTERS else None), None
    if op is sre.SUBPATTERN:
        return _derive(arg[-1])
    if op is sre.BRANCH:
        branches = [_derive(b) for b in arg[1]]
        if all(s is not None and q is None for s, q in branches):
            return set().union(*(s for s, _ in branches)), None
        return None, _either([_both(q, _of_strings(s)) for s, q in branches])
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        low, high, body = arg
        strings, query = _derive(body)
        if (low, high) == (1, 1):
            return strings, query
        if low == 0:
            return ({""} | strings if high == 1 and strings is not None else None), None
        return None, _both(query, _of_strings(strings))
    return None, None


# ---- index -------------------------------------------------------------------------------

def text_key(text: str | Column) -> Column:
    return F.xxhash64(text)


def postings(docs: DataFrame, trigrams: list[str], text: str = "text") -> DataFrame:
    """``trigram, key``: one row for every wanted trigram of every text; ``key`` stands for equal texts."""
    wanted = F.array(*map(F.lit, trigrams))
    found = F.transform(F.array(F.lower(F.col(text))), lambda low: F.filter(wanted, lambda t: F.contains(low, t)))
    return docs.select(text_key(F.col(text)).alias("key"), F.explode(found[0]).alias("trigram"))


def candidates(index: DataFrame, queries: dict[str, list[frozenset[str]]]) -> DataFrame:
    """``key, rules``: the kinds whose query the text's postings satisfy (keys without any are left out).

    Intersects the posting lists by key; a key has at most as many postings as there are wanted trigrams.
    """
    by_key = index.groupBy("key").agg(F.collect_set("trigram").alias("_has"))
    kinds = []
    for kind, query in queries.items():
        holds = F.lit(False)
        for conjunction in query:
            all_of = F.array(*map(F.lit, sorted(conjunction)))
            holds = holds | (F.size(F.array_intersect(all_of, F.col("_has"))) == len(conjunction))
        kinds.append(F.when(holds, F.lit(kind)))
    return by_key.select("key", F.array_compact(F.array(*kinds)).alias("rules")).where(F.size("rules") > 0)


# ---- verification --------------------------------------------------------------------------

SPAN = "array<struct<start:int,place:int,end:int,kind:string>>"


def _spans(text: Column, rule: Rule, place: int) -> Column:
    """All leftmost non-overlapping matches of one rule; a match whose group is too short counts as none."""
    pattern = F.lit(rule.pattern)
    whole, part = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group))
    steps = F.arrays_zip(F.split(text, rule.pattern, -1).alias("gap"), whole.alias("whole"), part.alias("part"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def step(acc, x):
        begin = acc["at"] + F.length(x["gap"])
        end = begin + F.coalesce(F.length(x["whole"]), F.lit(0))
        span = F.struct(begin.alias("start"), F.lit(place).alias("place"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        keep = x["whole"].isNotNull() & (F.length(x["part"]) >= rule.least)
        spans = F.when(keep, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(end.alias("at"), spans.alias("spans"))

    found = F.aggregate(steps, start, step, lambda acc: acc["spans"])
    return F.when(F.regexp_like(text, pattern), found).otherwise(F.array().cast(SPAN))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, text: str = "text") -> DataFrame:
    """Every row of ``docs`` with ``spans``: structs of start, place of the rule, end and kind, in this order."""
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern)) is not None}
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    texts = docs.select(row, body.alias("_text"))
    trigrams = sorted({t for q in queries.values() for c in q for t in c})
    if trigrams:
        index = postings(texts, trigrams, "_text")
        found = pin(candidates(index, queries), "secret-candidates")
        texts = texts.withColumn("key", text_key("_text")).join(found, "key", "left")
    else:
        texts = texts.withColumn("rules", F.array().cast("array<string>"))
    spans = []
    for place, rule in enumerate(rules):
        own = _spans(F.col("_text"), rule, place)
        if rule.kind in queries:
            own = F.when(F.array_contains("rules", rule.kind), own).otherwise(F.array().cast(SPAN))
        spans.append(own)
    return texts.select("row", F.array_sort(F.concat(*spans)).alias("spans"))


def n_spans(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind))


def span_text(spans: Column, kinds: tuple[str, ...] | None = None) -> Column:
    """``kind:start:end`` of the spans, or of those of ``kinds``, comma-joined in their order."""
    if kinds is not None:
        spans = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def masked(text: Column, spans: Column) -> Column:
    """The text with ``[kind]`` in place of every span (overlapping spans: one mark, of the first)."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))

    def step(acc, s):
        gap = F.substring(text, acc["at"] + 1, s["start"] - acc["at"])
        added = F.when(s["start"] >= acc["at"], F.concat(acc["text"], gap, F.lit("["), s["kind"], F.lit("]"))).otherwise(acc["text"])
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), added.alias("text"))

    done = F.aggregate(spans, start, step, lambda acc: F.concat(acc["text"], F.substring(text, acc["at"] + 1, F.length(text))))
    return F.when(F.size(spans) > 0, done).otherwise(text)
