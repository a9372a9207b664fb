"""Metric tables, votes and evaluation, on three baseline forecasts of the readings."""

from pyspark.sql import functions as F

from hazeline.catalog.base import name_of, ordinal, query, with_readings
from hazeline.functions.index import add_index
from hazeline.functions.values import encode, horizon_slug, slug
from hazeline.operators import evaluate as E
from hazeline.operators import joins as J
from hazeline.operators import topk as K
from hazeline.operators.windows import forecast_frame, lag_columns
from hazeline.schema import HORIZONS, LABELS

MODELS = ["Persistence Base", "Lag Three", "Constant Level"]


def baseline_predictions(t, horizons=HORIZONS):
    """(city, dt, horizon_hours, model, target, pred): label now, label three rows ago, constant."""
    df = t.readings.withColumn("y", encode("aqi_category"))
    df = forecast_frame(df.select("city", "dt", "aqi_category", "y"), list(horizons), past=lag_columns(["y"], [3]), back=3)
    models = F.array(F.struct(F.lit(MODELS[0]).alias("model"), F.col("y").alias("pred")),
                     F.struct(F.lit(MODELS[1]).alias("model"), F.coalesce("y_lag_3h", "y").alias("pred")),
                     F.struct(F.lit(MODELS[2]).alias("model"), F.lit(2).alias("pred")))
    return df.select("city", "dt", "horizon_hours", "target", F.inline(models))


def _leads(horizons):
    return " UNION ALL ".join(
        f"SELECT city, dt, y, l3, {h} AS horizon_hours, lead(y, {h}) OVER w AS target, lead(dt, {h}) OVER w AS tdt "
        "FROM scored WINDOW w AS (PARTITION BY city ORDER BY dt)" for h in horizons)


def prediction_ctes(horizons=HORIZONS):
    return [f"""scored AS (SELECT city, dt, y, lag(y, 3) OVER (PARTITION BY city ORDER BY dt) AS l3
  FROM (SELECT city, dt, {ordinal('aqi_category')} AS y FROM readings))""",
            f"leads AS ({_leads(horizons)})",
            f"""preds AS (SELECT l.city, l.dt, l.horizon_hours, l.target, m.model,
    CASE m.model WHEN '{MODELS[0]}' THEN y WHEN '{MODELS[1]}' THEN coalesce(l3, y) ELSE 2 END AS pred
  FROM leads l, (VALUES {', '.join(f"('{m}')" for m in MODELS)}) m(model)
  WHERE tdt = dt + to_hours(CAST(horizon_hours AS INTEGER)) AND target IS NOT NULL)"""]


REPORT_CTE = """classes AS (
  SELECT horizon_hours, model, label_id, count(*) FILTER (WHERE target = label_id) AS support,
    count(*) FILTER (WHERE pred = label_id) AS predicted, count(*) FILTER (WHERE target = label_id AND pred = label_id) AS tp
  FROM preds, range(6) r(label_id) GROUP BY horizon_hours, model, label_id),
report AS (SELECT *, coalesce(tp / NULLIF(predicted, 0), 0.0) AS precision, coalesce(tp / NULLIF(support, 0), 0.0) AS recall,
  coalesce(2 * tp / NULLIF(support + predicted, 0), 0.0) AS f1 FROM classes)"""

METRIC_CTES = [*prediction_ctes(), REPORT_CTE, """metrics AS (
  SELECT horizon_hours, model, sum(tp) / sum(support) AS accuracy, sum(precision * support) / sum(support) AS precision_weighted,
    sum(recall * support) / sum(support) AS recall_weighted, sum(f1 * support) / sum(support) AS f1_weighted,
    avg(recall) FILTER (WHERE support > 0) AS balanced_accuracy,
    avg(recall) FILTER (WHERE support > 0 OR predicted > 0) AS macro_recall,
    avg(f1) FILTER (WHERE support > 0 OR predicted > 0) AS macro_f1,
    max(recall) FILTER (WHERE label_id = 4) AS very_unhealthy_recall, max(recall) FILTER (WHERE label_id = 5) AS hazardous_recall,
    (max(recall) FILTER (WHERE label_id = 4) + max(recall) FILTER (WHERE label_id = 5)) / 2 AS severe_class_recall,
    max(support) FILTER (WHERE label_id = 4) AS very_unhealthy_support,
    max(support) FILTER (WHERE label_id = 5) AS hazardous_support, CAST(sum(support) AS BIGINT) AS rows
  FROM report GROUP BY horizon_hours, model)"""]

_DOUBLES = ["accuracy", "precision_weighted", "recall_weighted", "f1_weighted", "balanced_accuracy", "macro_recall",
            "macro_f1", "very_unhealthy_recall", "hazardous_recall", "severe_class_recall"]
METRIC_COLUMNS = ", ".join(f"round({c}, 9) AS {c}" for c in _DOUBLES) + ", very_unhealthy_support, hazardous_support, rows"
METRIC_SELECT = f"SELECT horizon_hours, model, {METRIC_COLUMNS} FROM metrics"


def baseline_metrics(t):
    return E.evaluate(baseline_predictions(t), "target", "pred", ["horizon_hours", "model"])


def _small(t):
    return baseline_metrics(t).select("horizon_hours", "model", "accuracy", "macro_f1", "severe_class_recall")


def metric_sql(body: str) -> str:
    return with_readings(body, *METRIC_CTES)


@query("m26_m29_evaluate", metric_sql(METRIC_SELECT))
def evaluate_all(t):
    return baseline_metrics(t)


@query("m24_confusion", with_readings(
    """SELECT horizon_hours, model, CAST(a.i AS INT) AS actual, CAST(p.i AS INT) AS predicted,
  count(*) FILTER (WHERE target = a.i AND pred = p.i) AS n
FROM preds, range(6) a(i), range(6) p(i) GROUP BY ALL""", *prediction_ctes()))
def confusion(t):
    return E.confusion(baseline_predictions(t), "target", "pred", by=["horizon_hours", "model"])


@query("m25_class_report", with_readings(
    """SELECT horizon_hours, model, CAST(label_id AS INT) AS label_id, support, predicted, tp, round(precision, 9) AS precision,
  round(recall, 9) AS recall, round(f1, 9) AS f1 FROM report""", *prediction_ctes(), REPORT_CTE))
def class_report(t):
    by = ["horizon_hours", "model"]
    return E.class_report(E.confusion(baseline_predictions(t), "target", "pred", by=by), by)


def _report(t):
    by = ["horizon_hours", "model"]
    return E.class_report(E.confusion(baseline_predictions(t), "target", "pred", by=by), by), by


_REPORT = [*prediction_ctes(), REPORT_CTE]


@query("m26_weighted_metrics", with_readings(
    """SELECT horizon_hours, model, round(sum(tp) / sum(support), 9) AS accuracy,
  round(sum(precision * support) / sum(support), 9) AS precision_weighted,
  round(sum(recall * support) / sum(support), 9) AS recall_weighted,
  round(sum(f1 * support) / sum(support), 9) AS f1_weighted FROM report GROUP BY ALL""", *_REPORT))
def weighted(t):
    return E.weighted_metrics(*_report(t))


@query("m27_macro_metrics", with_readings(
    """SELECT horizon_hours, model, round(avg(recall), 9) AS macro_recall, round(avg(f1), 9) AS macro_f1
FROM report WHERE support > 0 OR predicted > 0 GROUP BY ALL""", *_REPORT))
def macro(t):
    return E.macro_metrics(*_report(t))


@query("m28_balanced_accuracy", with_readings(
    """SELECT horizon_hours, model, round(avg(recall) FILTER (WHERE support > 0), 9) AS balanced_accuracy,
  round(avg(recall) FILTER (WHERE support > 0 OR predicted > 0), 9) AS macro_variant FROM report GROUP BY ALL""", *_REPORT))
def balanced(t):
    rep, by = _report(t)
    macro_form = E.balanced_accuracy(rep, by, "macro").withColumnRenamed("balanced_accuracy", "macro_variant")
    return E.balanced_accuracy(rep, by).join(macro_form, by)


@query("m29_severe_recall", with_readings(
    """SELECT horizon_hours, model, round(v.recall, 9) AS very_unhealthy_recall, round(v.f1, 9) AS very_unhealthy_f1,
  v.support AS very_unhealthy_support, round(h.recall, 9) AS hazardous_recall, round(h.f1, 9) AS hazardous_f1,
  h.support AS hazardous_support, round((v.recall + h.recall) / 2, 9) AS severe_class_recall
FROM report v JOIN report h USING (horizon_hours, model) WHERE v.label_id = 4 AND h.label_id = 5""", *_REPORT))
def severe(t):
    return E.severe_recall(*_report(t))


_VOTES = [*prediction_ctes([1]), """votes AS (SELECT city, dt, pred, count(*) AS c FROM preds GROUP BY ALL),
best AS (SELECT city, dt, arg_max(pred, c * 10 + pred) AS consensus_id, max(c) AS c, sum(c) AS n FROM votes GROUP BY city, dt)"""]


def _consensus(t):
    return E.consensus(baseline_predictions(t, [1]).withColumnRenamed("pred", "label_id"), ["city", "dt"])


@query("m22_consensus", with_readings(
    f"""SELECT city, dt, CAST(consensus_id AS INT) AS consensus_id, {name_of('consensus_id')} AS consensus,
  CAST(c AS VARCHAR) || '/' || CAST(CAST(n AS BIGINT) AS VARCHAR) AS agreement_score FROM best""", *_VOTES))
def votes(t):
    return _consensus(t)


_BAND_ID = ("CASE WHEN top <= 50 THEN 0 WHEN top <= 100 THEN 1 WHEN top <= 200 THEN 2 WHEN top <= 300 THEN 3 "
            "WHEN top <= 400 THEN 4 ELSE 5 END")
_BAND_NAME = ("CASE WHEN top <= 50 THEN 'Good' WHEN top <= 100 THEN 'Satisfactory' WHEN top <= 200 THEN 'Moderate' "
              "WHEN top <= 300 THEN 'Poor' WHEN top <= 400 THEN 'Very Poor' ELSE 'Severe' END")


@query("m23_mismatch", with_readings(
    f"""SELECT b.city, b.dt, {name_of('consensus_id')} AS consensus, {_BAND_NAME} AS band,
  ({name_of('consensus_id')}) <> ({_BAND_NAME}) AS mismatch_flag, consensus_id <> ({_BAND_ID}) AS aligned_flag
FROM best b JOIN (SELECT city, dt, max(idx) AS top FROM fx GROUP BY city, dt) i ON i.city = b.city AND i.dt = b.dt""", *_VOTES))
def mismatches(t):
    both = _consensus(t).join(add_index(t.readings).select("city", "dt", "band"), ["city", "dt"])
    out = E.mismatch(both)
    return E.mismatch(out.withColumnRenamed("mismatch_flag", "_plain"), aligned=True).select(
        "city", "dt", "consensus", "band", F.col("_plain").alias("mismatch_flag"), F.col("mismatch_flag").alias("aligned_flag"))


@query("j2_attach_label", with_readings(
    f"SELECT city, dt, CAST(label_id AS INT) AS label_id, {name_of('label_id')} AS label_name "
    f"FROM (SELECT city, dt, {ordinal('aqi_category')} AS label_id FROM readings)"))
def named(t):
    df = t.readings.select("city", "dt", encode("aqi_category").alias("label_id"))
    return J.attach_label(df, J.label_table(t.spark, LABELS), "label_id").select("city", "dt", "label_id", "label_name")


@query("j3_attach_metrics", metric_sql(
    """SELECT p.city, p.dt, p.horizon_hours, p.model, p.pred, round(m.accuracy, 9) AS accuracy FROM preds p
LEFT JOIN (SELECT * FROM metrics WHERE model <> 'Lag Three') m USING (horizon_hours, model) WHERE p.horizon_hours = 24"""))
def with_metrics(t):
    m = _small(t).filter("model <> 'Lag Three'").select("horizon_hours", "model", "accuracy")
    p = baseline_predictions(t, [24]).select("city", "dt", "horizon_hours", "model", "pred")
    return J.attach_metrics(p, m).select("city", "dt", "horizon_hours", "model", "pred", "accuracy")


@query("j4_replace_models", metric_sql(
    """SELECT horizon_hours, model, round(accuracy, 9) AS accuracy FROM metrics WHERE model <> 'Lag Three'
UNION ALL SELECT horizon_hours, 'Lag Three', round(macro_f1, 9) FROM metrics WHERE model = 'Lag Three' AND horizon_hours = 1"""))
def replaced(t):
    m = _small(t)
    new = m.filter("model = 'Lag Three' and horizon_hours = 1").select("horizon_hours", "model", F.col("macro_f1").alias("accuracy"))
    return J.replace_models(m.select("horizon_hours", "model", "accuracy"), new, ["Lag Three"])


@query("j5_update_metrics", metric_sql(
    """SELECT o.horizon_hours, o.model, round(CASE WHEN n.model IS NOT NULL THEN n.accuracy ELSE o.accuracy END, 9) AS accuracy
FROM metrics o LEFT JOIN (SELECT model, accuracy FROM metrics WHERE horizon_hours = 1 AND model <> 'Constant Level') n
  ON n.model = o.model"""))
def updated(t):
    m = _small(t).select("horizon_hours", "model", "accuracy")
    new = m.filter("horizon_hours = 1 and model <> 'Constant Level'").select("model", "accuracy")
    return J.update_metrics(m, new)


@query("k4_leaderboard", metric_sql(
    """SELECT model, round(score, 9) AS score, rank, CASE WHEN rank = 1 THEN 'best' WHEN rank = n THEN 'worst' END AS place
FROM (SELECT model, score, row_number() OVER (ORDER BY score DESC, model) AS rank, count(*) OVER () AS n
  FROM (SELECT model, coalesce(NULLIF(severe_class_recall, 0), accuracy, 0.0) AS score FROM metrics WHERE horizon_hours = 1))"""))
def board(t):
    m = _small(t).filter("horizon_hours = 1")
    return K.leaderboard(m, "severe_class_recall", "accuracy").select("model", "score", "rank", "place")


@query("k5_best_per_horizon", metric_sql(
    """SELECT horizon_hours, arg_max(model, (accuracy, model)) AS model, round(max(accuracy), 9) AS accuracy
FROM metrics GROUP BY horizon_hours"""))
def best(t):
    return K.best_per_horizon(_small(t))


@query("k6_sort_metrics", metric_sql(
    "SELECT horizon_hours, model, round(accuracy, 9) AS accuracy FROM metrics ORDER BY horizon_hours, accuracy DESC, model"))
def ordered(t):
    return K.sort_metrics(_small(t).select("horizon_hours", "model", "accuracy"))


@query("k7_best_config", metric_sql(
    """SELECT model || ' ' || horizon_hours AS config_label, round(1 - accuracy, 9) AS final_loss FROM metrics
ORDER BY 1 - accuracy, 1 LIMIT 1"""))
def best_config(t):
    grid = _small(t).select(F.concat_ws(" ", "model", "horizon_hours").alias("config_label"), (1 - F.col("accuracy")).alias("final_loss"))
    return K.best_config(grid)


@query("e14_display_metrics", metric_sql(
    """SELECT split_part(model, ' ', 1) AS name, model AS full_name, round(accuracy * 100, 1) AS accuracy,
  round(macro_f1 * 100, 1) AS macro_f1 FROM metrics"""))
def display(t):
    return K.display_metrics(_small(t), ["accuracy", "macro_f1"])


@query("e16_slug", metric_sql(
    """SELECT model, horizon_hours, lower(replace(model, ' ', '_')) AS slug,
  'forecast_' || horizon_hours || 'h_' || lower(replace(model, ' ', '_')) AS name FROM metrics"""))
def slugs(t):
    return _small(t).select("model", "horizon_hours", slug("model").alias("slug"), horizon_slug("model", "horizon_hours").alias("name"))
