"""Headline text: tokens, stop words, stems by suffix or by measure, polarity."""

from __future__ import annotations

from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.values import sentiment_label
from hazeline.operators.ranks import constant_if_small

# Terms of a lexicon that may become a constant of the plan.
LEXICON_ROWS = 100_000

# Common English stop words.
STOP_WORDS = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom this "
    "that these those am is are was were be been being have has had having do does did doing a an "
    "the and but if or because as until while of at by for with about against between into through "
    "during before after above below to from up down in out on off over under again further then "
    "once here there when where why how all any both each few more most other some such no nor not "
    "only own same so than too very s t can will just don should now"
).split()

# Suffix rules, all of which only strip: sses -> ss, ies -> i, plural s, ing, ed, ly.
SUFFIX = "(?<=ss|i)es$|(?<=[^s])s$|(?<=..)ing$|(?<=..)ed$|(?<=..)ly$"


# A blank-separated word whose core is letters and digits, with punctuation only at its edges.
WORD = r"(?<!\S)[^\p{L}\p{N}\s]*+([\p{L}\p{N}]++)[^\p{L}\p{N}\s]*+(?!\S)"


def tokens(text: Column | str) -> Column:
    """Blank-separated words without edge punctuation; words with inner punctuation are dropped."""
    return F.regexp_extract_all(F.col(text) if isinstance(text, str) else text, F.lit(WORD), F.lit(1))


def drop_stopwords(words: Column | str, stop=STOP_WORDS) -> Column:
    w = F.col(words) if isinstance(words, str) else words
    return F.filter(w, lambda x: ~F.lower(x).isin(*stop))


def stem(words: Column | str) -> Column:
    """Suffix-stripped lower-case words; applied in place, so nothing is shuffled."""
    w = F.col(words) if isinstance(words, str) else words
    return F.transform(w, lambda x: F.regexp_replace(F.lower(x), SUFFIX, ""))


def polarity(docs: DataFrame, lexicon: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(key, polarity, sentiment): mean lexicon weight of the words found, 0 when none is.

    Words meet the lexicon first, without a shuffle while that is small, so only
    one partial mean per document and task is moved.
    """
    terms = docs.select(key, F.explode(tokens(text)).alias("term")).select(key, F.lower("term").alias("term"))
    known = constant_if_small(lexicon.select("term", "weight"), LEXICON_ROWS)
    hits = terms.join(known, "term").groupBy(key).agg(F.avg("weight").alias("polarity"))
    out = docs.select(key).join(hits, key, "left").select(key, F.coalesce("polarity", F.lit(0.0)).alias("polarity"))
    return out.withColumn("sentiment", sentiment_label("polarity"))


# The suffixes of a published stemmer and what they become, by step. A step takes the longest suffix that fits.
DOUBLE_SUFFIXES = {
    "ational": "ate", "tional": "tion", "enci": "ence", "anci": "ance", "izer": "ize", "abli": "able", "alli": "al", "entli": "ent",
    "eli": "e", "ousli": "ous", "ization": "ize", "ation": "ate", "ator": "ate", "alism": "al", "iveness": "ive", "fulness": "ful",
    "ousness": "ous", "aliti": "al", "iviti": "ive", "biliti": "ble"}
ENDINGS = {"icate": "ic", "ative": "", "alize": "al", "iciti": "ic", "ical": "ic", "ful": "", "ness": ""}
LAST_SUFFIXES = ["al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize"]


def letter_kinds(w: Column) -> Column:
    """V for each vowel and C for each consonant; y is a vowel after a consonant."""
    marked = F.regexp_replace(F.translate(w, "aeiou", "VVVVV"), "[^Vy]", "C")
    for pattern, kind in (("^y", "C"), ("Vy", "VC"), ("Cy", "CV"), ("y", "C")):
        marked = F.regexp_replace(marked, pattern, kind)
    return marked


def measure(w: Column) -> Column:
    """How often a vowel is followed by a consonant."""
    return F.regexp_count(letter_kinds(w), F.lit("VC"))


def _cut(suffixes) -> str:
    return f"^(.*?)({'|'.join(suffixes)})$"


def _part(pattern: str, i: int) -> Column:
    return F.regexp_extract("w", pattern, i)


def _ends(suffixes) -> Column:
    """Whether ``w`` has one of the suffixes: most words have none, and need no pattern to tell."""
    return reduce(or_, [F.col("w").endswith(x) for x in suffixes])


def _doubled(w: Column) -> Column:
    return (F.length(w) > 1) & (F.right(w, F.lit(1)) == F.substring(w, -2, 1)) & letter_kinds(w).endswith("C")


def _short(w: Column) -> Column:
    """Ends in consonant, vowel, consonant, the last not w, x or y."""
    return letter_kinds(w).endswith("CVC") & ~w.rlike("[wxy]$")


def _stem_steps() -> list[Column]:
    """New values of ``w``, one step after the other."""
    w = F.col("w")
    vowel = lambda x: F.contains(letter_kinds(x), F.lit("V"))
    root, tail = _part("^(.*?)(eed|ed|ing)$", 1), _part("^(.*?)(eed|ed|ing)$", 2)
    # a suffix that went leaves a mark, as the next step only looks at such words
    fallen = F.when(~_ends(["ed", "ing"]), w).when((tail == "eed") & (measure(root) > 0), F.concat(root, F.lit("ee"))).when(
        tail.isin("ed", "ing") & vowel(root), F.concat(root, F.lit("|"))).otherwise(w)
    bare = F.rtrim(w, F.lit("|"))
    mended = F.when(~w.endswith("|"), w).when(bare.rlike("(at|bl|iz)$"), F.concat(bare, F.lit("e"))).when(
        _doubled(bare) & ~bare.rlike("[lsz]$"), F.left(bare, F.length(bare) - 1)).when(
        (measure(bare) == 1) & _short(bare), F.concat(bare, F.lit("e"))).otherwise(bare)
    less = F.left(w, F.length(w) - 1)

    def replaced(table: dict[str, str]) -> Column:
        root, tail = _part(_cut(table), 1), _part(_cut(table), 2)
        new = F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), tail)
        return F.when(~_ends(table), w).when((tail != "") & (measure(root) > 0), F.concat(root, new)).otherwise(w)

    last, gone = _part(_cut(LAST_SUFFIXES), 1), _part(_cut(LAST_SUFFIXES), 2)
    return [
        F.when(w.endswith("sses"), F.left(w, F.length(w) - 2)).when(w.endswith("ies"), F.left(w, F.length(w) - 2))
        .when(w.endswith("ss"), w).when(w.endswith("s"), less).otherwise(w),
        fallen, mended,
        F.when(w.endswith("y") & vowel(less), F.concat(less, F.lit("i"))).otherwise(w),
        replaced(DOUBLE_SUFFIXES), replaced(ENDINGS),
        F.when(~_ends(LAST_SUFFIXES), w).when((gone != "") & (measure(last) > 1) & ((gone != "ion") | last.rlike("[st]$")), last).otherwise(w),
        F.when(w.endswith("e") & ((measure(less) > 1) | ((measure(less) == 1) & ~_short(less))), less).otherwise(w),
        F.when(w.endswith("l") & _doubled(w) & (measure(w) > 1), less).otherwise(w),
    ]


def stem_table(words: DataFrame, term: str = "term") -> DataFrame:
    """(term, stem) of each distinct term: lower case, then the measure-based steps, for words of more than two letters."""
    out = words.select(F.col(term).alias("term")).filter("term IS NOT NULL").distinct().withColumn("w", F.lower("term"))
    for step in _stem_steps():
        out = out.withColumn("w", F.when(F.length("w") > 2, step).otherwise(F.col("w")))
    return out.select("term", F.rtrim("w", F.lit("|")).alias("stem"))


def measured_stems(counts: DataFrame, keys: list[str], term: str = "term", n: str = "n") -> DataFrame:
    """Counts by (keys, term) as counts by (keys, stem); each distinct term is stemmed once.

    Rows of ``counts`` needn't be summed before. They are moved to their term's stem and summed there, by hash: a term has one stem,
    so neither side is sorted, and frequent terms are only met on the side that Spark splits.
    """
    stems = stem_table(counts, term).withColumnRenamed("term", "_term").hint("shuffle_hash")
    joined = counts.join(stems, F.col(term) == F.col("_term"))
    return joined.groupBy(*keys, F.col("stem").alias(term)).agg(F.sum(n).alias(n))
