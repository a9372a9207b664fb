import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from hazeline.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = build_session("tests", "local[4]", **{
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def panel(spark):
    """Two cities, hourly, with nulls and one missing hour each."""
    rows = []
    for city, shift in (("A", 0), ("B", 7)):
        for i in range(200):
            if i == 90 + shift:
                continue
            v = None if i % 11 == shift % 11 else float((i * 37 + shift * 13) % 101)
            rows.append((city, i, v, float(i % 17), ["Good", "Moderate", "Unhealthy"][(i + shift) % 3]))
    df = spark.createDataFrame(rows, "city string, i int, pm25 double, co double, aqi_category string")
    return df.selectExpr("city", "timestamp'2024-01-25 00:00:00' + make_interval(0, 0, 0, 0, i) AS dt", "pm25", "co", "aqi_category").cache()


def rows_of(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]
