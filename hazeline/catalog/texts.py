"""Text operators on the documents."""

from pyspark.sql import functions as F

from hazeline.catalog.base import query
from hazeline.operators import text as X

_WORDS = r"""words AS (SELECT doc_id, pos, regexp_replace(w, '^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$', '', 'g') AS term
  FROM (SELECT doc_id, unnest(regexp_extract_all(text, '[^\s]+')) AS w, generate_subscripts(regexp_extract_all(text, '[^\s]+'), 1) AS pos FROM documents)),
tokens AS (SELECT doc_id, pos, term FROM words WHERE regexp_full_match(term, '[\p{L}\p{N}]+'))"""
_STOP = "lower(term) NOT IN (" + ", ".join(f"'{w}'" for w in X.STOP_WORDS) + ")"


# pattern, kept part: the first that fits is applied
_RULES = [("sses$", "ss"), ("ies$", "i"), ("([^s])s$", r"\1"), ("(..)ing$", r"\1"), ("(..)ed$", r"\1"), ("(..)ly$", r"\1")]


def _stem_sql():
    arms = " ".join(f"WHEN regexp_matches(lower(term), '{p}') THEN regexp_replace(lower(term), '{p}', '{to}')" for p, to in _RULES)
    return f"CASE {arms} ELSE lower(term) END"


def _terms(t, words):
    return t("documents").select("doc_id", F.explode(words).alias("term")).groupBy("doc_id", "term").agg(F.count(F.lit(1)).alias("n"))


@query("x1_tokens", f"WITH {_WORDS} SELECT doc_id, term, count(*) AS n FROM tokens GROUP BY ALL")
def tokens(t):
    return _terms(t, X.tokens("text"))


@query("x2_drop_stopwords", f"WITH {_WORDS} SELECT doc_id, term, count(*) AS n FROM tokens WHERE {_STOP} GROUP BY ALL")
def stopwords(t):
    return _terms(t, X.drop_stopwords(X.tokens("text")))


@query("x3_stem", f"WITH {_WORDS} SELECT doc_id, {_stem_sql()} AS term, count(*) AS n FROM tokens WHERE {_STOP} GROUP BY ALL")
def stems(t):
    return _terms(t, X.stem(X.drop_stopwords(X.tokens("text"))))


def _kinds(w):
    out = f"regexp_replace(translate({w}, 'aeiou', 'VVVVV'), '[^Vy]', 'C', 'g')"
    for pattern, kind in (("^y", "C"), ("Vy", "VC"), ("Cy", "CV"), ("y", "C")):
        out = f"regexp_replace({out}, '{pattern}', '{kind}', 'g')"
    return out


def _measure(w):
    return f"len(regexp_extract_all({_kinds(w)}, 'VC'))"


def _measured_sql():
    """CTEs s0 .. s9 (term, w): each step of the stemmer over the distinct terms."""
    twice = lambda w: f"(length({w}) > 1 AND right({w}, 1) = left(right({w}, 2), 1) AND ends_with({_kinds(w)}, 'C'))"
    short = lambda w: f"(ends_with({_kinds(w)}, 'CVC') AND NOT regexp_matches({w}, '[wxy]$'))"
    less, bare = "left(w, length(w) - 1)", "rtrim(w, '|')"
    part = lambda names, i: f"regexp_extract(w, '^(.*?)({'|'.join(names)})$', {i})"

    def table(rules):
        to = " ".join(f"WHEN '{a}' THEN '{b}'" for a, b in rules.items())
        return (f"CASE WHEN {part(rules, 2)} <> '' AND {_measure(part(rules, 1))} > 0 THEN {part(rules, 1)} || CASE {part(rules, 2)} {to} END ELSE w END")

    first = ["eed", "ed", "ing"]
    steps = [
        f"CASE WHEN ends_with(w, 'sses') OR ends_with(w, 'ies') THEN left(w, length(w) - 2) WHEN ends_with(w, 'ss') THEN w WHEN ends_with(w, 's') THEN {less} ELSE w END",
        f"""CASE WHEN {part(first, 2)} = 'eed' AND {_measure(part(first, 1))} > 0 THEN {part(first, 1)} || 'ee'
  WHEN {part(first, 2)} IN ('ed', 'ing') AND contains({_kinds(part(first, 1))}, 'V') THEN {part(first, 1)} || '|' ELSE w END""",
        f"""CASE WHEN NOT ends_with(w, '|') THEN w WHEN regexp_matches({bare}, '(at|bl|iz)$') THEN {bare} || 'e'
  WHEN {twice(bare)} AND NOT regexp_matches({bare}, '[lsz]$') THEN left({bare}, length({bare}) - 1)
  WHEN {_measure(bare)} = 1 AND {short(bare)} THEN {bare} || 'e' ELSE {bare} END""",
        f"CASE WHEN ends_with(w, 'y') AND contains({_kinds(less)}, 'V') THEN {less} || 'i' ELSE w END",
        table(X.DOUBLE_SUFFIXES), table(X.ENDINGS),
        f"""CASE WHEN {part(X.LAST_SUFFIXES, 2)} <> '' AND {_measure(part(X.LAST_SUFFIXES, 1))} > 1
  AND ({part(X.LAST_SUFFIXES, 2)} <> 'ion' OR regexp_matches({part(X.LAST_SUFFIXES, 1)}, '[st]$')) THEN {part(X.LAST_SUFFIXES, 1)} ELSE w END""",
        f"CASE WHEN ends_with(w, 'e') AND ({_measure(less)} > 1 OR ({_measure(less)} = 1 AND NOT {short(less)})) THEN {less} ELSE w END",
        f"CASE WHEN ends_with(w, 'l') AND {twice('w')} AND {_measure('w')} > 1 THEN {less} ELSE w END"]
    ctes = [f"s0 AS (SELECT DISTINCT term, lower(term) AS w FROM tokens WHERE {_STOP})"]
    for i, step in enumerate(steps):
        ctes.append(f"s{i + 1} AS MATERIALIZED (SELECT term, CASE WHEN length(w) > 2 THEN {step} ELSE w END AS w FROM s{i})")
    return ", ".join(ctes)


@query("x3_measured_stems", f"""WITH {_WORDS}, {_measured_sql()}
SELECT doc_id, rtrim(w, '|') AS term, count(*) AS n FROM tokens JOIN s9 USING (term) WHERE {_STOP} GROUP BY ALL""")
def measured_stems(t):
    words = t("documents").select("doc_id", F.explode(X.drop_stopwords(X.tokens("text"))).alias("term"), F.lit(1).alias("n"))
    return X.measured_stems(words, ["doc_id"])


@query("x4_polarity", f"""WITH {_WORDS},
lexicon AS (SELECT DISTINCT lower(term) AS term, (length(lower(term)) % 5 - 2) / 2.0::DOUBLE AS weight FROM (
  SELECT regexp_replace(w, '^[^\\p{{L}}\\p{{N}}]+|[^\\p{{L}}\\p{{N}}]+$', '', 'g') AS term FROM (SELECT unnest(regexp_extract_all(text, '[^\\s]+')) AS w FROM benchmark))
  WHERE regexp_full_match(term, '[\\p{{L}}\\p{{N}}]+')),
p AS (SELECT doc_id, avg(weight) AS polarity FROM tokens JOIN lexicon ON lexicon.term = lower(tokens.term) GROUP BY doc_id)
SELECT d.doc_id, round(coalesce(polarity, 0.0), 9) AS polarity,
  CASE WHEN polarity > 0 THEN 'Positive' WHEN polarity < 0 THEN 'Negative' ELSE 'Neutral' END AS sentiment
FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id""")
def polarity(t):
    term = F.lower("term")
    lexicon = t("benchmark").select(F.explode(X.tokens("text")).alias("term")).select(
        term.alias("term"), ((F.length(term) % 5 - 2) / 2.0).alias("weight")).distinct()
    return X.polarity(t("documents"), lexicon)
