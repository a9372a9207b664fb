"""Classification metrics, all derived from one confusion table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.values import band_ordinal, decode
from hazeline.schema import LABELS, SEVERE_LABELS


def consensus(preds: DataFrame, row: list[str], label: str = "label_id") -> DataFrame:
    """Vote of several models: most frequent label and "a/n"; ties go to the more severe label."""
    votes = preds.groupBy(*row, label).agg(F.count(F.lit(1)).alias("c"))
    # count and label in one number: the aggregation stays in hash form
    out = votes.groupBy(*row).agg(F.max(F.col("c") * 1000 + F.col(label)).alias("_best"), F.sum("c").alias("n"))
    return out.select(*row, F.expr("CAST(_best % 1000 AS INT)").alias("consensus_id"),
                      decode("_best % 1000").alias("consensus"),
                      F.format_string("%d/%d", F.floor(F.col("_best") / 1000), "n").alias("agreement_score"))


def mismatch(votes: DataFrame, aligned: bool = False) -> DataFrame:
    """Flag rows whose consensus differs from the index band.

    The two use different vocabularies: by default their names are compared as
    they are; ``aligned`` compares their ordinals.
    """
    differs = F.col("consensus_id") != band_ordinal("band") if aligned else F.col("consensus") != F.col("band")
    return votes.withColumn("mismatch_flag", differs)


def confusion(df: DataFrame, truth: str, pred: str, n_labels: int = len(LABELS),
              by: list[str] | None = None) -> DataFrame:
    """(by, actual, predicted, n) on the full label grid, zeros kept."""
    by = by or []
    cells = df.groupBy(*by, F.col(truth).cast("int").alias("actual"), F.col(pred).cast("int").alias("predicted")).agg(
        F.count(F.lit(1)).alias("n"))
    ids = F.sequence(F.lit(0), F.lit(n_labels - 1))
    groups = cells.select(*by).distinct() if by else df.sparkSession.range(1).select()
    grid = groups.select(*by, F.explode(ids).alias("actual")).select(*by, "actual", F.explode(ids).alias("predicted"))
    return grid.join(cells, [*by, "actual", "predicted"], "left").select(
        *by, "actual", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def _ratio(a, b):
    return F.when(b > 0, a / b).otherwise(0.0)


def class_report(cm: DataFrame, by: list[str] | None = None) -> DataFrame:
    """(by, label_id, precision, recall, f1, support, predicted); a zero denominator gives 0."""
    by = by or []
    sides = cm.select(*by, F.inline(F.array(
        F.struct(F.col("actual").alias("label_id"), F.col("n").alias("support"), F.lit(0).cast("bigint").alias("predicted"),
                 F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")),
        F.struct(F.col("predicted").alias("label_id"), F.lit(0).cast("bigint").alias("support"), F.col("n").alias("predicted"),
                 F.lit(0).cast("bigint").alias("tp")))))
    g = sides.groupBy(*by, "label_id").agg(*[F.sum(c).alias(c) for c in ("support", "predicted", "tp")])
    g = g.withColumns({"precision": _ratio(F.col("tp"), F.col("predicted")), "recall": _ratio(F.col("tp"), F.col("support"))})
    return g.withColumn("f1", _ratio(2 * F.col("tp"), F.col("support") + F.col("predicted")))


def weighted_metrics(report: DataFrame, by: list[str] | None = None) -> DataFrame:
    """accuracy and support-weighted precision, recall, F1."""
    total = F.sum("support")
    return report.groupBy(*(by or [])).agg(
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        *[F.try_divide(F.sum(F.col(c) * F.col("support")), total).alias(f"{c}_weighted") for c in ("precision", "recall", "f1")])


def macro_metrics(report: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Unweighted recall and F1 over labels seen in the truth or in the predictions."""
    seen = (F.col("support") > 0) | (F.col("predicted") > 0)
    return report.filter(seen).groupBy(*(by or [])).agg(F.avg("recall").alias("macro_recall"), F.avg("f1").alias("macro_f1"))


def balanced_accuracy(report: DataFrame, by: list[str] | None = None, variant: str = "true_labels") -> DataFrame:
    """Mean recall over labels with true rows; ``macro`` counts predicted-only labels too."""
    keep = F.col("support") > 0
    if variant == "macro":
        keep = keep | (F.col("predicted") > 0)
    return report.filter(keep).groupBy(*(by or [])).agg(F.avg("recall").alias("balanced_accuracy"))


def severe_recall(report: DataFrame, by: list[str] | None = None, labels=LABELS, severe=SEVERE_LABELS) -> DataFrame:
    """Recall and F1 of the severe labels, their mean recall, and their support.

    With support 0 a recall of 0 means "undefined".
    """
    aggs = []
    for s in severe:
        hit = F.col("label_id") == labels.index(s)
        n = s.lower()
        aggs += [F.max(F.when(hit, F.col("recall"))).alias(f"{n}_recall"), F.max(F.when(hit, F.col("f1"))).alias(f"{n}_f1"),
                 F.max(F.when(hit, F.col("support"))).alias(f"{n}_support")]
    out = report.groupBy(*(by or [])).agg(*aggs)
    mean = sum((F.col(f"{s.lower()}_recall") for s in severe), F.lit(0.0)) / len(severe)
    return out.withColumn("severe_class_recall", mean)


def evaluate(df: DataFrame, truth: str, pred: str, by: list[str] | None = None, n_labels: int = len(LABELS)) -> DataFrame:
    """All metrics of a scored frame, one row per group of ``by``; no rows give null ratios and ``rows`` 0."""
    by = by or []
    report = class_report(confusion(df, truth, pred, n_labels, by), by)
    total, seen = F.sum("support"), (F.col("support") > 0) | (F.col("predicted") > 0)

    def of(i, c):
        return F.max(F.when(F.col("label_id") == i, F.col(c)))

    v, h = (LABELS.index(s) for s in SEVERE_LABELS)
    return report.groupBy(*by).agg(
        F.try_divide(F.sum("tp"), total).alias("accuracy"),
        *[F.try_divide(F.sum(F.col(c) * F.col("support")), total).alias(f"{c}_weighted") for c in ("precision", "recall", "f1")],
        F.avg(F.when(F.col("support") > 0, F.col("recall"))).alias("balanced_accuracy"),
        F.avg(F.when(seen, F.col("recall"))).alias("macro_recall"), F.avg(F.when(seen, F.col("f1"))).alias("macro_f1"),
        of(v, "recall").alias("very_unhealthy_recall"), of(h, "recall").alias("hazardous_recall"),
        ((of(v, "recall") + of(h, "recall")) / 2).alias("severe_class_recall"),
        of(v, "support").alias("very_unhealthy_support"), of(h, "support").alias("hazardous_support"),
        total.alias("rows"))
