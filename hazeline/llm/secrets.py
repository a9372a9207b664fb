"""Secret scans with a trigram inverted index.

Each rule is a regex. From its parse tree comes a Boolean query: a disjunction of clauses, each a set of trigrams that a text
must have for that way of matching. The index holds (trigram, document) for all trigrams of all clauses, over lower-cased texts. A clause's
postings are intersected by counting, and only the documents of some clause are verified with the rule. A rule without
mandatory trigrams scans all texts. Everything on the data is DataFrame functions.
"""

from __future__ import annotations

import re
from re import _constants as C
from re import _parser as parser

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.base import query, table
from hazeline.llm.spans import SPAN, spans
from hazeline.session import materialise

_ASSIGN = r"(?i:password|passwd|secret|token|api_?key)[\"']?+\x20*+[:=]\x20*+[\"']?+([A-Za-z0-9+/_.=-]++)"

#: Rules in the order of their kinds: name, regex, and what a match must pass. The regexes find the same matches as the plain
#: ones, but take time in proportion to the text.
RULES = [
    ("assign", _ASSIGN, lambda v: F.length(F.regexp_extract(v, _ASSIGN, 1)) >= 6),
    ("access", r"AKIA[A-Z0-9]{16,}+", None),
    ("hex", r"(?<![0-9a-f])[0-9a-f]{24,}+", None),
    ("forge", r"gh[pousr]_[A-Za-z0-9]{36,}+", None),
    ("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}+", None),
    ("cloud", r"AIza[A-Za-z0-9_-]{35,}+", None),
    ("payment", r"[rs]k_live_[A-Za-z0-9]{16,}+", None),
    ("jwt", r"eyJ[A-Za-z0-9_-]{10,}+\.eyJ[A-Za-z0-9_-]{10,}+\.[A-Za-z0-9_-]{10,}+", None),
    ("key_block", r"-----BEGIN (?:[A-Z]++ )*+PRIVATE KEY-----", None),
]
BASE = ["assign", "access", "hex"]
#: Strings that a part of a regex may stand for before it counts as anything.
MOST = 48
_REPEATS = {getattr(C, x) for x in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") if hasattr(C, x)}


def _strings(node) -> list[str] | None:
    """All lower-cased strings that a node can match, or None if they are many or unbounded."""
    op, arg = node
    if op is C.LITERAL:
        return [chr(arg).lower()]
    if op is C.IN:
        if any(o not in (C.LITERAL, C.RANGE) for o, _ in arg):
            return None
        every = {chr(x).lower() for o, a in arg for x in ([a] if o is C.LITERAL else range(a[0], a[1] + 1 if a[1] - a[0] < MOST else a[0] + MOST + 1))}
        return sorted(every) if len(every) <= 8 else None
    if op in (C.AT, C.ASSERT, C.ASSERT_NOT):
        return [""]
    if op is C.SUBPATTERN:
        return _product(arg[3])
    if op is C.ATOMIC_GROUP:
        return _product(arg)
    if op is C.BRANCH:
        parts = [_product(p) for p in arg[1]]
        return None if any(p is None for p in parts) else sorted({s for p in parts for s in p})
    if op in _REPEATS and arg[1] <= 2:
        one = _product(arg[2])
        if one is None:
            return None
        out, power = set(), {""}
        for n in range(arg[1] + 1):
            if n >= arg[0]:
                out |= power
            if len(out) > MOST or (n < arg[1] and len(power) * len(one) > MOST):
                return None
            power = {a + b for a in power for b in one}
        return sorted(out)
    return None


def _product(nodes) -> list[str] | None:
    out = [""]
    for node in nodes:
        more = _strings(node)
        if more is None or len(out) * len(more) > MOST:
            return None
        out = sorted({a + b for a in out for b in more})
    return out


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def _both(a: set[frozenset[str]], b: set[frozenset[str]]) -> set[frozenset[str]]:
    both = {x | y for x in a for y in b} if len(a) * len(b) <= MOST * MOST else min(a, b, key=lambda q: -min(map(len, q)))
    return {x for x in both if not any(y < x for y in both)}


def _clauses(nodes) -> set[frozenset[str]]:
    """Disjunction of trigram sets for a sequence; an empty set among them means: no condition."""
    out, run = {frozenset()}, [""]

    def flush():
        nonlocal out, run
        out, run = _both(out, {_trigrams(s) for s in run}), [""]

    for node in nodes:
        more = _strings(node)
        if more is not None and len(run) * len(more) <= MOST:
            run = sorted({a + b for a in run for b in more})
            continue
        flush()
        if more is not None:
            run = more
            continue
        op, arg = node
        if op is C.SUBPATTERN:
            out = _both(out, _clauses(arg[3]))
        elif op is C.BRANCH:
            out = _both(out, set().union(*[_clauses(p) for p in arg[1]]))
        elif op in _REPEATS and arg[0] > 0:
            out = _both(out, _clauses(arg[2]))
    flush()
    return {frozenset()} if frozenset() in out else out


def trigram_query(regex: str) -> list[list[str]]:
    """Clauses of mandatory trigrams of a regex, over lower-cased text; [] if it has none."""
    out = _clauses(parser.parse(regex))
    return [] if frozenset() in out else sorted(sorted(c) for c in out)


def index(docs: DataFrame, wanted: list[str]) -> DataFrame:
    """Postings (trigram, doc_id, text_hash) of the wanted trigrams; ``docs`` has doc_id, text, text_hash."""
    low = docs.select("doc_id", "text_hash", F.lower("text").alias("__low"))
    held = F.array_compact(F.array(*[F.when(F.contains("__low", F.lit(t)), F.lit(t)) for t in wanted]))
    return low.select(F.explode(held).alias("trigram"), "doc_id", "text_hash")


def candidates(postings: DataFrame, queries: dict[str, list[list[str]]]) -> DataFrame:
    """Documents (doc_id, text_hash, rules) for which some clause of a rule has all its trigrams."""
    spark = postings.sparkSession
    rows = [(rule, i, t, len(c)) for rule, clauses in queries.items() for i, c in enumerate(clauses) for t in c]
    clauses = spark.range(1).select(F.inline(F.array(*[
        F.struct(*[F.lit(v).alias(n) for n, v in zip(("rule", "clause", "trigram", "need"), r)]) for r in rows])))
    return (postings.join(clauses, "trigram").groupBy("doc_id", "text_hash", "rule", "clause")
            .agg(F.count_distinct("trigram").alias("held"), F.max("need").alias("need")).where("held = need")
            .groupBy("doc_id", "text_hash").agg(F.collect_set("rule").alias("rules")))


def scanned(docs: DataFrame, rules: list = RULES) -> DataFrame:
    """doc_id and one array of spans for each rule, for every row of ``docs``.

    A null text counts as empty. Rows with a null or repeated doc_id are scanned like any other. Other columns are ignored. An
    empty table gives an empty result.
    """
    queries = {name: trigram_query(regex) for name, regex, _ in rules}
    wanted = sorted({t for clauses in queries.values() for c in clauses for t in c})
    own = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("text_hash", F.xxhash64("text"))
    found = candidates(index(own, wanted).distinct(), queries).select(
        F.col("doc_id").alias("__d"), F.col("text_hash").alias("__h"), "rules")
    found = materialise(found, "candidates")
    rows = own.join(found, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("text_hash") == F.col("__h")), "left")
    none = F.array().cast(f"array<{SPAN}>")
    out = []
    for name, regex, passes in rules:
        all_ = spans(F.col("text"), regex, passes)
        out.append((F.when(F.array_contains("rules", name), all_).otherwise(none) if queries[name] else all_).alias(name))
    return rows.select("doc_id", *out)


def listed(kinds: list[str], by_kind: bool) -> Column:
    """All spans of the columns ``kinds`` as kind:start:end, ordered by kind and start, or by start and kind."""
    def entries(rank: int, kind: str) -> Column:
        text = lambda s: F.concat_ws(":", F.lit(kind), s["start"].cast("string"), s["stop"].cast("string")).alias("t")
        place = lambda s: [F.lit(rank), s["start"]] if by_kind else [s["start"], F.lit(rank)]
        return F.transform(kind, lambda s: F.struct(*[x.alias(n) for n, x in zip("ab", place(s))], text(s)))

    every = F.concat(*[entries(i, k) for i, k in enumerate(kinds)])
    return F.array_join(F.transform(F.array_sort(every), lambda x: x["t"]), ",")


@query("op4_secret_trigrams")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    rows = scanned(table(spark, folder, "documents"))
    return rows.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in BASE],
                       F.sha2(listed(BASE, False).cast("binary"), 256).alias("base_sha256"),
                       listed([name for name, _, _ in RULES], False).alias("spans"))
