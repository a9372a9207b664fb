import pytest
from pyspark.sql import functions as F

from hazeline.functions.index import add_index, band, eligible, sub_index
from hazeline.functions.values import cyclical, decode, encode, parse_ts, coerce
from hazeline.schema import BREAKPOINTS, GASES, INDEX_LEVELS, LABELS, FEATURE_SETS


@pytest.mark.parametrize("gas", GASES)
def test_breakpoints_and_just_above(spark, gas):
    conc = BREAKPOINTS[gas]
    df = spark.createDataFrame([(float(c), float(i)) for c, i in zip(conc, INDEX_LEVELS)], "v double, want double")
    for r in df.select("want", sub_index(gas, "v").alias("got")).collect():
        assert r.got == pytest.approx(r.want)
    above = spark.createDataFrame([(c + 1e-9, float(i)) for c, i in zip(conc, INDEX_LEVELS)], "v double, want double")
    for r in above.select("want", sub_index(gas, "v").alias("got")).collect():
        assert r.want < r.got < r.want + 1e-6


def test_edges(spark):
    df = spark.createDataFrame([(None,), (float("nan"),), (-6.0,), (251.0,)], "v double")
    assert [r.x for r in df.select(sub_index("pm25", "v").alias("x")).collect()] == [0.0, 0.0, -10.0, 401.0]
    assert df.select(sub_index("nh3", "v").alias("x")).first().x == 0.0


def test_overall_ties_and_empty(spark):
    df = spark.createDataFrame([(60.0, 100.0, None), (None, None, None), (None, 430.0, 10.0)], "pm25 double, pm10 double, co double")
    got = [tuple(r) for r in add_index(df, {"pm25": "pm25", "pm10": "pm10", "co": "co"}).select("aqi", "band", "dominant").collect()]
    assert got == [(100.0, "Satisfactory", "PM2.5"), (0.0, "N/A", "None"), (400.0, "Very Poor", "PM10")]


def test_co_unit(spark):
    df = spark.createDataFrame([(2000.0,)], "co double")
    assert add_index(df, {"co": "co"}, co_divisor=1000).first().aqi == 100.0


def test_band_uses_unrounded(spark):
    df = spark.createDataFrame([(50.0,), (50.0001,), (400.0,), (400.1,)], "i double")
    assert [r.b for r in df.select(band("i").alias("b")).collect()] == ["Good", "Satisfactory", "Very Poor", "Severe"]


def test_eligible(spark):
    df = spark.createDataFrame([(1.0, None, 1.0, 1.0), (None, None, 1.0, 1.0), (1.0, 1.0, None, None)], "pm25 double, pm10 double, no2 double, co double")
    cols = {c: c for c in df.columns}
    assert [r.e for r in df.select(eligible(cols).alias("e")).collect()] == [True, False, False]


def test_labels_and_parsing(spark):
    df = spark.createDataFrame([(lab,) for lab in LABELS] + [("Severe",), (None,)], "l string")
    got = [r for r in df.select(encode("l").alias("c")).select("c", decode("c").alias("back")).collect()]
    assert [r.c for r in got] == [0, 1, 2, 3, 4, 5, None, None]
    assert [r.back for r in got] == LABELS + ["Unknown", "Unknown"]
    texts = spark.createDataFrame([("2024-03-01 05:00:00",), ("2024-03-01T05:00",), ("01/03/2024 05:00",), ("x",), (None,)], "t string")
    got = [r.d for r in texts.select(F.date_format(parse_ts("t"), "yyyyMMddHH").alias("d")).collect()]
    assert got == ["2024030105"] * 3 + [None, None]
    nums = spark.createDataFrame([("1.5",), ("",), ("bad",), (None,)], "t string")
    assert [r.v for r in nums.select(coerce("t", 9.0).alias("v")).collect()] == [1.5, 9.0, 9.0, 9.0]


def test_month_cycle_starts_at_january(spark):
    df = spark.sql("SELECT timestamp'2024-01-05 06:00:00' AS dt")
    r = cyclical(df).first()
    assert (r.month_sin, r.month_cos) == (0.0, 1.0)
    assert r.hour_sin == pytest.approx(1.0)


def test_feature_set_sizes():
    assert {k: len(v) for k, v in FEATURE_SETS.items()} == {
        "nowcast": 12, "research": 37, "research_reduced": 34, "clustering": 30, "clustering_used": 9, "synthetic": 8}


@pytest.mark.parametrize("gas, value, index", [
    ("pm25", 15.0, 25.0), ("pm25", 45.0, 75.0), ("pm25", 75.0, 150.0), ("pm25", 105.0, 250.0), ("pm25", 185.0, 350.0), ("pm25", 300.0, 450.0),
    ("pm10", 25.0, 25.0), ("pm10", 175.0, 150.0), ("pm10", 300.0, 250.0), ("pm10", 390.0, 350.0), ("no2", 60.0, 75.0), ("no2", 130.0, 150.0),
    ("no2", 340.0, 350.0), ("co", 0.5, 25.0), ("co", 6.0, 150.0), ("co", 13.5, 250.0), ("co", 25.5, 350.0), ("so2", 230.0, 150.0),
    ("so2", 1200.0, 350.0), ("o3", 75.0, 75.0), ("o3", 134.0, 150.0), ("o3", 188.0, 250.0), ("o3", 478.0, 350.0)])
def test_values_of_the_regulation(spark, gas, value, index):
    """Middles of the published bands, written out."""
    assert spark.createDataFrame([(value,)], "v double").select(sub_index(gas, "v").alias("x")).first().x == pytest.approx(index)
