"""Forecast training, scoring and nowcast plans."""

from __future__ import annotations

import time as clock
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from functools import reduce
from operator import and_

from pyspark import inheritable_thread_target
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.storagelevel import StorageLevel

from hazeline.functions.index import add_index
from hazeline.functions.values import calendar, cyclical, encode, target_time
from hazeline.operators import models as M
from hazeline.operators.evaluate import consensus, evaluate, mismatch
from hazeline.operators.joins import attach_metrics
from hazeline.operators.splits import balanced_weights, split_chrono
from hazeline.operators.windows import forecast_frame, lag_columns, roll_columns, serve_features
from hazeline.schema import GASES, HORIZONS, LAG_STEPS, ROLL_WIDTHS, WEATHER, feature_set
from hazeline.session import scratch_path
from hazeline.sources.models import MODEL_LABELS

CALENDAR = ["year", "month", "day", "hour", "day_of_week"]
CYCLES = ["hour_sin", "hour_cos", "month_sin", "month_cos"]


def feature_names(base: list[str] | None = None, cols=GASES, steps=LAG_STEPS, widths=ROLL_WIDTHS) -> list[str]:
    """Base numeric columns, lags, rolls and cycles, in training order."""
    base = base if base is not None else [*GASES, *WEATHER, *CALENDAR]
    lags = [f"{c}_lag_{k}h" for c in cols for k in steps]
    rolls = [f"{c}_roll_{kind}_{w}h" for c in cols for w in widths for kind in ("mean", "max")]
    return [*base, *lags, *rolls, *CYCLES]


def training_frame(df: DataFrame, horizons=HORIZONS, months: int | None = 18, steps=LAG_STEPS,
                   widths=ROLL_WIDTHS, features: list[str] | None = None) -> DataFrame:
    """Feature rows per horizon.

    Windows come before the time filter, so that the oldest kept rows still see
    their history.
    """
    past = {**lag_columns(GASES, steps), **roll_columns(GASES, widths)}
    out = forecast_frame(cyclical(calendar(df)), list(horizons), past=past, back=max([*steps, *widths]))
    if months:
        newest = df.agg(F.max("dt").alias("m")).scalar()
        out = out.filter(F.col("dt") >= newest - F.make_ym_interval(months=F.lit(months)))
    features = features or feature_names(steps=steps, widths=widths)
    # a condition for each column: of one over all of them the optimizer derives a copy for each subset of the computed ones
    known = [F.col(f.name).isNotNull() & ~F.isnan(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name).isNotNull()
             for f in out.schema.fields if f.name in features]
    return out.filter(reduce(and_, known, F.lit(True)))


def metric_grid(frame: DataFrame, features: list[str], horizons: list[int],
                estimators: dict[str, Callable], city: str | None = "city",
                on_model: Callable[[int, str, PipelineModel], None] | None = None, side_by_side: int = 4) -> DataFrame:
    """One metric row per horizon and model, with split sizes and fit seconds.

    The frame is stored once, by horizon, in the shared folder: finding the
    split cuts then reads one column of one horizon, and a lost executor costs a
    re-read, not the window pass. Up to ``side_by_side`` fits of a horizon run at
    the same time, each in a scheduler pool of its own, so that jobs of one
    fill the cores that the others leave.
    """
    spark = frame.sparkSession
    path = scratch_path(spark, "forecast-frame")
    frame.write.partitionBy("horizon_hours").parquet(path)
    stored = spark.read.schema(frame.schema).parquet(path)
    rows = []
    for h in horizons:
        split = split_chrono(stored.filter(F.col("horizon_hours") == h))
        train = balanced_weights(split.filter("split = 'train'"), "target").persist(StorageLevel.MEMORY_AND_DISK)
        test = split.filter("split = 'test'")
        sizes = {r["split"]: r["count"] for r in split.groupBy("split").count().collect()}

        def one(name: str, make: Callable) -> tuple[PipelineModel, dict | None]:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"fit {name}")
            started = clock.time()
            model = M.fit(make(), train, features, city)
            took = clock.time() - started
            # one row per fit
            row = evaluate(model.transform(test), "target", "prediction").first()
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)
            return model, None if row is None else row.asDict() | {
                "horizon_hours": h, "model": name, "train_rows": sizes.get("train", 0),
                "validation_rows": sizes.get("validation", 0), "test_rows": sizes.get("test", 0),
                "train_time_seconds": float(took)}

        with ThreadPoolExecutor(max(1, side_by_side)) as pool:
            fits = {name: pool.submit(inheritable_thread_target(one), name, make) for name, make in estimators.items()}
            for name, fit in fits.items():
                model, row = fit.result()
                if on_model:
                    on_model(h, name, model)
                if row is not None:
                    rows.append(row)
        train.unpersist()
    return spark.createDataFrame(rows, _GRID_SCHEMA)


_GRID_SCHEMA = (
    "horizon_hours int, model string, accuracy double, precision_weighted double, recall_weighted double, "
    "f1_weighted double, balanced_accuracy double, macro_recall double, macro_f1 double, "
    "very_unhealthy_recall double, hazardous_recall double, severe_class_recall double, "
    "very_unhealthy_support bigint, hazardous_support bigint, rows bigint, train_rows bigint, "
    "validation_rows bigint, test_rows bigint, train_time_seconds double")


def batch_forecast(requests: DataFrame, df: DataFrame, models: dict[tuple[int, str], PipelineModel],
                   metrics: DataFrame | None = None, steps=LAG_STEPS, widths=ROLL_WIDTHS) -> DataFrame:
    """Forecast many requests (request_id, city, dt, horizon_hours, model, features map).

    Each stored model scores the requests that name it. Every request is
    answered: ``status`` is ok, or says why there is no prediction (unknown city,
    no such model, incomplete features).
    """
    feats = serve_features(requests, df, GASES, steps, widths, carry=tuple(WEATHER))
    known = df.select(F.col("city").alias("_city")).distinct()
    feats = feats.join(known, F.col("city") == F.col("_city"), "left").withColumn("known", F.col("_city").isNotNull()).drop("_city")
    out = score_requests(cyclical(calendar(feats)), models)
    if metrics is None:
        return out
    m = metrics.select("horizon_hours", "model", F.struct(*metrics.columns).alias("metrics"))
    return attach_metrics(out, m)


def score_requests(feats: DataFrame, models: dict[tuple[int, str], PipelineModel]) -> DataFrame:
    """Answers to requests whose features are there, with ``known`` (whether the city is); works on a stream as well."""
    named = F.lit(False)
    whole = F.lit(True)
    for (h, name), model in models.items():
        own = (F.col("horizon_hours") == h) & (F.col("model") == name)
        named = named | own
        whole = F.when(own, F.array_size(F.array_compact(F.array(*[F.col(c).cast("double") for c in _inputs(model, feats)])))
                       == len(_inputs(model, feats))).otherwise(whole)
    feats = feats.withColumn("status", F.when(~F.col("known"), "unknown city").when(~F.coalesce(named, F.lit(False)), "no such model")
                             .when(~whole, "incomplete features").otherwise("ok")).drop("known")
    answer = ["request_id", "city", "horizon_hours", "model", F.col("dt").alias("input_time"),
              target_time("dt", F.col("horizon_hours")).alias("forecast_for")]
    out = None
    for (h, name), model in models.items():
        part = feats.filter((F.col("horizon_hours") == h) & (F.col("model") == name) & (F.col("status") == "ok"))
        scored = M.probabilities(model.transform(part)).select(
            *answer, F.lit(MODEL_LABELS.get(name, name)).alias("model_label"),
            F.col("prediction_label").alias("prediction"), "confidence", "probabilities", "status")
        out = scored if out is None else out.unionByName(scored)
    rest = feats.filter("status != 'ok'").select(*answer, "status")
    return rest if out is None else out.unionByName(rest, allowMissingColumns=True)


def _inputs(model: PipelineModel, df: DataFrame) -> list[str]:
    """Numeric columns of ``df`` that a fitted pipeline reads."""
    numeric = {f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)}
    read = [c for s in model.stages if s.hasParam("inputCols") and s.isSet("inputCols") for c in s.getInputCols()]
    return [c for c in dict.fromkeys(read) if c in numeric]


def nowcast_rows(df: DataFrame, features: str = "features") -> DataFrame:
    """The rows with an array of exactly twelve values, as named columns."""
    names = feature_set("nowcast")
    ok = df.filter(F.size(features) == len(names))
    return ok.select(*[c for c in df.columns if c != features],
                     *[F.col(features)[i].alias(n) for i, n in enumerate(names)])


def batch_nowcast(rows: DataFrame, models: dict[str, PipelineModel], key: str, aligned: bool = False) -> DataFrame:
    """Vote of several models, index of the same values, and whether the two disagree.

    Every row is answered: one without exactly twelve values, all known, has the
    status "incomplete features" and nulls.
    """
    names = feature_set("nowcast")
    base = nowcast_rows(rows).na.drop(subset=names)
    votes = None
    for model in models.values():
        one = model.transform(base).select(key, F.col("prediction").cast("int").alias("label_id"))
        votes = one if votes is None else votes.unionByName(one)
    out = consensus(votes, [key]).join(add_index(base).select(key, "aqi", "band", "dominant"), key)
    out = mismatch(out, aligned).withColumn("status", F.lit("ok")).withColumnRenamed(key, "_key")
    answered = rows.select(key).join(out, F.col(key) == F.col("_key"), "left").drop("_key")
    return answered.withColumn("status", F.coalesce("status", F.lit("incomplete features")))


def nowcast_table(df: DataFrame) -> DataFrame:
    """Nowcast features and target of complete rows."""
    names = feature_set("nowcast")
    out = calendar(df).withColumn("target", encode("aqi_category"))
    return out.na.drop(subset=[*names, "target"])


