"""Personal data by boosted trees over candidate spans.

High-recall generators propose overlapping spans: the base patterns without their checks, and looser forms (addresses with
"[at]" and "dot", digit groups with any separators, colon-separated addresses). Each candidate gets features of its format and its
context. Gradient-boosted trees are fitted on candidates of the base patterns, whose checks label them, and score the
others; a threshold calibrated on held-out candidates selects what is added. Base spans always stay. Everything on the data is
DataFrame functions and MLlib.
"""

from __future__ import annotations

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.llm.base import query, table
from hazeline.llm.secrets import listed
from hazeline.llm.spans import SPAN, spans
from hazeline.session import materialise

KINDS = ["email", "ip", "card", "phone"]
PRECISION = 0.98
TREES, DEPTH = 12, 3

# The same matches as the plain patterns have, in time proportional to the text: a match of these can only start where the run
# of its first class starts, or where the match before ended.
BASE = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?+[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
LOOSE = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++(?:@|\x20?[\[(]at[\])]\x20?|\x20at\x20)[A-Za-z0-9-]++(?:(?:\.|\x20?[\[(]dot[\])]\x20?|\x20dot\x20)[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9A-Fa-f:])[0-9A-Fa-f]{1,4}+(?::[0-9A-Fa-f]{1,4}+){7}+(?![0-9A-Fa-f:])",
    "card": r"(?<![0-9])[0-9](?:[\x20./_-]{0,2}+[0-9]){11,}+",
    "phone": r"(?<![0-9A-Za-z+])\(?[0-9](?:[\x20()./-]{0,2}+[0-9]){7,14}+(?![0-9A-Za-z])",
}
KEYWORDS = {"email": "mail|contact|write|address", "ip": "ip|host|server|addr|login", "card": "card|visa|credit|pay|account",
            "phone": "phone|tel|call|mobile|fax|reach"}
_OCTET = "0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2})"


def _digits(v: Column) -> Column:
    return F.regexp_replace(v, "[^0-9]", "")


def passes(kind: str, v: Column) -> Column:
    """The check of a base pattern."""
    if kind == "ip":
        return v.rlike(rf"^(?:{'[.]'.join([r'(?:0*(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{1,2}))'] * 4)})$")
    if kind == "card":
        return F.length(_digits(v)).between(16, 19) & F.call_function("luhn_check", _digits(v))
    if kind == "phone":
        return F.length(_digits(v)).between(8, 15)
    return F.lit(True)


def candidates(docs: DataFrame) -> DataFrame:
    """(row, doc_id, the base spans of each kind, options): every row with all its candidates, written once."""
    text = F.coalesce(F.col("text"), F.lit(""))
    found = docs.select("doc_id", *[spans(text, BASE[k]).alias(f"raw_{k}") for k in KINDS],
                        *[spans(text, LOOSE[k]).alias(f"loose_{k}") for k in KINDS])

    def base(k: str) -> Column:
        return F.filter(f"raw_{k}", lambda s: passes(k, s["value"])).alias(k)

    def option(how: str, k: str) -> Column:
        return F.transform(f"{how}_{k}", lambda s: F.struct(
            F.lit(k).alias("kind"), F.lit(how == "raw").alias("raw"), (passes(k, s["value"]) if how == "raw" else F.lit(False)).alias("good"),
            *[s[c].alias(c) for c in ("start", "stop", "before", "after")], F.left(s["value"], F.lit(80)).alias("value")))

    def bare(k: str) -> Column:
        return F.transform(k, lambda s: F.struct(s["start"].alias("start"), s["stop"].alias("stop"))).alias(k)

    options = F.concat(*[option(how, k) for how in ("raw", "loose") for k in KINDS])
    return materialise(found.select("doc_id", options.alias("options"), *map(base, KINDS))
                       .select(F.monotonically_increasing_id().alias("row"), "doc_id", "options", *map(bare, KINDS)), "candidates")


def features(options: DataFrame) -> tuple[DataFrame, list[str]]:
    """Format and context of each candidate as doubles."""
    v, before = F.col("value"), F.lower("before")
    digits = _digits(v)
    number = F.length(digits)
    named = {
        "length": F.least(F.col("stop") - F.col("start"), F.lit(80)), "digits": number,
        "letters": F.length(F.regexp_replace(v, "[^A-Za-z]", "")), "dots": F.length(F.regexp_replace(v, "[^.]", "")),
        "blanks": F.length(F.regexp_replace(v, "[^ -]", "")), "brackets": F.length(F.regexp_replace(v, r"[^()\[\]]", "")),
        "at": F.contains(v, F.lit("@")), "plus": F.startswith(v, F.lit("+")), "zero": F.startswith(v, F.lit("0")),
        "luhn": F.when(number.between(12, 19), F.call_function("luhn_check", digits)).otherwise(F.lit(False)),
        "octets": v.rlike(rf"^{_OCTET}(?:\.{_OCTET}){{3}}$"),
        "glued": before.rlike(r"[\p{L}0-9]$"), "glued_after": F.col("after").rlike(r"^[\p{L}0-9]"),
        "colon": before.rlike(r"[:=#]\s*$"),
        **{f"kind_{k}": F.col("kind") == k for k in KINDS}, **{f"word_{k}": before.rlike(w) for k, w in KEYWORDS.items()},
    }
    return options.withColumns({f"f_{n}": c.cast("double") for n, c in named.items()}), [f"f_{n}" for n in named]


def _threshold(scored: DataFrame, precision: float) -> float | None:
    """Smallest score, in hundredths, from which on held-out candidates are right often enough; None if there is none."""
    bins = (scored.groupBy(F.floor(F.col("score") * 100).alias("bin")).agg(F.sum(F.col("label") * F.col("n")).alias("right"), F.sum("n").alias("n"))
            .orderBy(F.desc("bin")).collect())
    best, right, n = None, 0, 0
    for b in bins:
        right, n = right + b["right"], n + b["n"]
        if n and right >= precision * n:
            best = b["bin"] / 100
    return best


def added(rows: DataFrame) -> DataFrame:
    """(row, and for each kind the spans that the trees add): loose candidates over the threshold that touch no base span."""
    options, names = features(rows.select("row", F.explode("options").alias("o")).select("row", "o.*"))
    # candidates of equal features and labels are one weighted row, so that the trees see all of them
    side = (F.pmod(F.xxhash64("value", "before", "after", "kind"), F.lit(4)) == 0).alias("held")
    labelled = options.where("raw").groupBy(side, F.col("good").cast("double").alias("label"), *names).agg(F.count(F.lit(1)).cast("double").alias("n"))
    labelled = materialise(labelled, "labelled")
    kinds = {r["label"] for r in labelled.groupBy("label").count().collect()}
    empty = rows.sparkSession.range(0).select(F.col("id").alias("row"), *[F.array().cast("array<struct<start:int,stop:int>>").alias(f"more_{k}") for k in KINDS])
    if len(kinds) < 2:
        return empty
    gather = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    fitted = labelled.where("NOT held")
    if len(fitted.groupBy("label").count().take(2)) < 2:
        return empty
    model = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=0.3, seed=7, maxMemoryInMB=64, weightCol="n").fit(gather.transform(fitted).select("features", "label", "n"))

    def scored(part: DataFrame) -> DataFrame:
        return model.transform(gather.transform(part)).withColumn("score", vector_to_array("probability")[1])

    least = _threshold(scored(labelled.where("held")), PRECISION)
    if least is None:
        return empty
    chosen = scored(options.where("NOT raw")).where(F.col("score") >= least).select("row", "kind", F.struct("start", "stop").alias("s"))
    lists = [F.array_sort(F.collect_set(F.when(F.col("kind") == k, F.col("s")))).alias(f"more_{k}") for k in KINDS]
    return chosen.groupBy("row").agg(*lists)


def detected(docs: DataFrame) -> DataFrame:
    """doc_id, base spans of each kind (``email`` .. ``phone``) and added ones (``more_email`` .. ``more_phone``) of every row.

    A null text counts as empty; rows with a null or repeated doc_id are handled like any other; other columns are ignored;
    an empty table gives an empty result. Added spans never touch a base span of any kind. Without candidates of
    both labels nothing is added.
    """
    rows = candidates(docs)
    out = rows.join(added(rows).withColumnRenamed("row", "__row"), F.col("row") == F.col("__row"), "left")
    all_ = F.concat(*KINDS)
    none = F.array().cast("array<struct<start:int,stop:int>>")
    more = [F.coalesce(F.filter(f"more_{k}", lambda s: ~F.exists(all_, lambda b: (b["start"] < s["stop"]) & (s["start"] < b["stop"]))), none).alias(f"more_{k}") for k in KINDS]
    return out.select("doc_id", *KINDS, *more)


@query("op2_pii_boosted")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    rows = detected(table(spark, folder, "documents"))
    counts = [F.size(k).cast("long").alias(f"n_{k}") for k in KINDS]
    base = F.sha2(listed(KINDS, True).cast("binary"), 256).alias("base_sha256")
    joint = rows.select("doc_id", *counts, base, *[F.concat(k, f"more_{k}").alias(k) for k in KINDS])
    return joint.select("doc_id", *[f"n_{k}" for k in KINDS], "base_sha256", listed(KINDS, True).alias("spans"))
