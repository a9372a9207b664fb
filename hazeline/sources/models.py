"""Model persistence by horizon and name."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from hazeline.schema import HORIZONS

DEFAULT_MODEL = "logistic_regression"
# Display names of the stored forecast models.
MODEL_LABELS = {
    "logistic_regression": "Logistic Regression",
    "random_forest": "Random Forest",
    "hist_gradient_boosting": "Hist Gradient Boosting",
    "xgboost": "XGBoost",
}


def model_path(root: str, horizon: int, name: str) -> str:
    return f"{root.rstrip('/')}/h={horizon}/m={name}"


def save_model(model: PipelineModel, root: str, horizon: int, name: str) -> str:
    path = model_path(root, horizon, name)
    model.write().overwrite().save(path)
    return path


def exists(spark: SparkSession, path: str) -> bool:
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop)


def load_model(spark: SparkSession, root: str, horizon: int, name: str,
               fallback: str | None = DEFAULT_MODEL) -> tuple[PipelineModel, str]:
    """(model, name used). A model that is not stored is replaced by the fallback, and the name says so."""
    if horizon not in HORIZONS:
        raise ValueError(f"unsupported horizon {horizon}; use one of {HORIZONS}")
    if name not in MODEL_LABELS:
        raise ValueError(f"unsupported model {name!r}; use one of {sorted(MODEL_LABELS)}")
    for candidate in (name, fallback):
        if candidate and exists(spark, model_path(root, horizon, candidate)):
            return PipelineModel.load(model_path(root, horizon, candidate)), candidate
    raise FileNotFoundError(f"no model {name!r} and no fallback for horizon {horizon} under {root}")
