"""Hourly readings derived from the ``events`` table of the test data."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hazeline.functions.index import sub_index
from hazeline.schema import GASES, LABELS

# gas -> event type that carries it
EVENT_GASES = {"pm25": "view", "pm10": "click", "no2": "purchase", "so2": "error", "o3": "signup"}


def observations(events: DataFrame) -> DataFrame:
    """One row per event: city, exact time, event type, value in hundredths, k."""
    return events.selectExpr(
        "concat('S', CAST(user_id % 5 AS STRING)) AS city", "CAST(ts AS TIMESTAMP) AS ts", "event_type",
        "CAST(round(value * 100) AS BIGINT) AS cents",
        "CAST(get_json_object(props, '$.k') AS BIGINT) AS k", "event_id")


def readings(events: DataFrame) -> DataFrame:
    """(city, hour) panel with six gases, three weather columns and a label.

    Values are summed as whole hundredths, so that a mean is one division of
    exact integers and does not depend on the order of addition.
    """
    obs = observations(events).withColumn("dt", F.expr("date_trunc('HOUR', ts)"))
    sums = [f"sum(cents) FILTER (WHERE event_type = '{kind}') AS s_{gas}, "
            f"count(cents) FILTER (WHERE event_type = '{kind}') AS n_{gas}" for gas, kind in EVENT_GASES.items()]
    aggs = [F.expr(a.strip()) for pair in sums for a in pair.split(", ")] + [F.expr("sum(k) AS s_co"), F.expr("count(k) AS n_co")]
    g = obs.groupBy("city", "dt").agg(*aggs)

    def mean(gas: str, per: int) -> str:
        return f"CASE WHEN n_{gas} > 0 THEN CAST(s_{gas} AS DOUBLE) / CAST(n_{gas} * {per} AS DOUBLE) END"

    df = g.selectExpr(
        "city", "dt", *[f"{mean(c, 10 if c == 'co' else 100)} AS {c}" for c in GASES],
        "round(15 + 10 * sin(2 * pi() * hour(dt) / 24), 6) AS temp",
        f"{mean('co', 1)} AS humidity", "CAST(n_co AS DOUBLE) AS wind")
    parts = {f"_{c}": F.when(F.col(c).isNotNull(), sub_index(c, c)) for c in GASES}
    df = df.withColumns(parts).withColumn("_top", F.greatest(*parts)).drop(*parts)
    # levels 50, 100, 200, 300, 400, written with few uses of the index: filters on the label expand it
    level = "1 + least(5, CAST(ceil(_top / 100) AS INT)) * CAST(_top > 50 AS INT)"
    names = ", ".join(f"'{lab}'" for lab in LABELS)
    label = f"coalesce(element_at(array({names}), {level}), '{LABELS[-1]}')"
    return df.withColumn("aqi_category", F.expr(label)).drop("_top")
