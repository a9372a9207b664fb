import gzip
import json

import pytest
from pyspark.sql import functions as F

from hazeline.session import materialise, scratch_root
from hazeline.sources.live import flatten_live
from hazeline.sources.models import exists, load_model, save_model
from hazeline.sources.readings import published_names, read_readings, write_readings
from hazeline.sources.reports import read_metrics, write_report


def test_gzip_csv_in_any_column_order(spark, tmp_path):
    path = tmp_path / "raw.csv.gz"
    with gzip.open(path, "wt") as f:
        f.write("Datetime,AQI_Category,PM2_5_ugm3,City,Extra,Hour\n")
        f.write("2024-01-01 05:00:00,Good,1.5,Delhi,x,5\nnot a time,Good,NaN,Delhi,y,\n")
    df = read_readings(spark, str(path))
    assert df.columns == ["dt", "aqi_category", "pm25", "city", "extra", "hour"]
    a, b = df.collect()
    assert (a.pm25, a.hour, str(a.dt)) == (1.5, 5, "2024-01-01 05:00:00")
    assert b.dt is None and b.pm25 is None and b.hour is None
    assert read_readings(spark, str(path), columns=["City", "PM2_5_ugm3", "absent"]).columns == ["city", "pm25"]


def test_partitioned_store_round_trip(spark, panel, tmp_path):
    path = str(tmp_path / "store")
    write_readings(panel, path, rows_per_file=100)
    back = read_readings(spark, path).select(*panel.columns)
    assert back.exceptAll(panel).count() == 0 and panel.exceptAll(back).count() == 0
    plan = spark.read.parquet(path).filter("city = 'A'")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(city" in plan
    assert "PM2_5_ugm3" in published_names(panel).columns


def test_reports(spark, tmp_path):
    m = spark.createDataFrame([(1, "Tree", 0.5), (24, "Tree", 0.25)], "horizon_hours int, model string, accuracy double")
    write_report(m, str(tmp_path / "report"))
    assert sorted((r.horizon_hours, r.accuracy) for r in read_metrics(spark, str(tmp_path / "report")).collect()) == [(1, 0.5), (24, 0.25)]
    raw = json.loads(next((tmp_path / "report").glob("*.json")).read_text())
    assert raw["horizons_hours"] == [1, 24] and raw["task"] == "future_aqi_category_forecasting"
    (tmp_path / "list.json").write_text(json.dumps([{"Model": "A", "Accuracy": 0.5}, {"Model": "B", "Accuracy": 0.6}]))
    assert read_metrics(spark, str(tmp_path / "list.json")).count() == 2
    (tmp_path / "m.csv").write_text("Model,Accuracy\nA,0.5\n")
    assert read_metrics(spark, str(tmp_path / "m.csv")).first().Accuracy == 0.5


def test_live_defaults(spark):
    air = json.dumps({"list": [{"components": {"pm2_5": 12.0, "co": 1500.0}}]})
    df = spark.createDataFrame([("x", air, '{"main": {"temp": 20.5}, "wind": {"speed": 2.0}}'), ("y", '{"list": []}', "{}"),
                                ("z", '{"list": [{"components": {}}]}', "{}")], "id string, air string, weather string")
    got = {r.id: r for r in flatten_live(df).collect()}
    assert set(got) == {"x", "z"}
    assert (got["x"].pm25, got["x"].co, got["x"].pm10, got["x"].temp, got["x"].wind) == (12.0, 1.5, 0.0, 20.5, 7.2)
    assert got["z"].co == 0.0 and got["z"].temp is None
    assert flatten_live(df, missing=None).filter("id = 'z'").first().pm25 is None


def test_models_are_found_or_replaced(spark, tmp_path):
    from hazeline.operators import models as M

    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(40)], "x double, target double")
    model = M.fit(M.logistic(weight=None, max_iter=5), df, ["x"])
    path = save_model(model, str(tmp_path), 4, "logistic_regression")
    assert exists(spark, path)
    again, used = load_model(spark, str(tmp_path), 4, "xgboost")
    assert used == "logistic_regression"
    assert again.transform(df).select("prediction").collect() == model.transform(df).select("prediction").collect()
    with pytest.raises(FileNotFoundError):
        load_model(spark, str(tmp_path), 1, "xgboost")
    with pytest.raises(ValueError):
        load_model(spark, str(tmp_path), 5, "xgboost")


def test_scratch_follows_the_session(spark, panel):
    root = scratch_root(spark)
    assert spark.conf.get("spark.checkpoint.dir") == root == scratch_root(spark)
    out = materialise(panel, "probe")
    assert out.count() == panel.count()
    assert root in out.select(F.input_file_name()).first()[0]
