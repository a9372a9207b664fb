"""Streams with state over several micro-batches: expiry, late rows, forecasts from kept rows."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from hazeline.operators.windows import serve_features
from hazeline.streaming import state as S

START = dt.datetime(2024, 1, 1)


def at(seconds):
    return START + dt.timedelta(seconds=seconds)


def streamed(spark, batches, schema, folder, build):
    """Rows that ``build`` of a stream gives, whose micro-batches are the given lists of rows; one list for each trigger."""
    import time

    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(folder / "in"))
        time.sleep(0.05)
    source = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / "in"))
    with S.with_store(spark):
        q = (build(source).writeStream.format("parquet").outputMode("append").option("path", str(folder / "out"))
             .option("checkpointLocation", str(folder / "checkpoint")).trigger(availableNow=True).start())
        q.awaitTermination()
    assert sum(1 for p in q.recentProgress if p["numInputRows"]) == len(batches)
    return [r for r in spark.read.parquet(str(folder / "out")).collect()], q.recentProgress


READING = "city string, ts timestamp, event_id long, v double"


def expired_by_hand(rows, life, until):
    """Readings without a newer one within their life that ended before the watermark."""
    best = {}
    for c, t, i, _ in rows:
        best[c, t] = max(best.get((c, t), -1), i)
    out = set()
    for (c, t), i in best.items():
        if t + dt.timedelta(seconds=life) <= until and not any(d == c and t < u <= t + dt.timedelta(seconds=life) for d, u in best):
            out.add((c, t, i))
    return out


def test_readings_expire_over_micro_batches(spark, tmp_path):
    rng = random.Random(4)
    rows = sorted([(rng.choice("AB"), at(rng.randrange(40_000)), i, float(i)) for i in range(120)] + [("A", at(500), 900, 1.0), ("A", at(500), 901, 2.0)],
                  key=lambda r: r[1])
    batches = [rows[i:i + 25] for i in range(0, len(rows), 25)]
    for b in batches:  # rows of a batch in any order, and some in the next batch within the delay
        rng.shuffle(b)
    late = ("A", at(10), 999, 0.0)  # long past when the last batch comes
    got, progress = streamed(spark, [*batches[:-1], batches[-1] + [late]], READING, tmp_path, lambda s: S.stream_expiring(s, 900, delay="10 minutes"))
    until = max(r[1] for r in rows) - dt.timedelta(minutes=10)
    expired = [(r["city"], r["ts"], r["event_id"]) for r in got if r["status"] == "expired"]
    assert set(expired) == expired_by_hand(rows, 900, until) and len(expired) == len(set(expired)) > 10
    current = {}
    for r in got:
        if r["status"] == "current":
            current[r["city"]] = max(current.get(r["city"], (START, -1)), (r["ts"], r["event_id"]))
    assert current == {c: max((t, i) for d, t, i, _ in rows if d == c) for c in "AB"}
    assert all(r["event_id"] != 999 for r in got)
    # what has expired is in no state any more
    kept = sum(o["numRowsTotal"] for o in progress[-1]["stateOperators"])
    assert kept < len(rows)


def test_close_readings_are_one_run_in_the_state(spark, tmp_path):
    rng = random.Random(5)
    rows = [("A", at(rng.randrange(3_000)), i, None if i % 5 == 0 else float(i)) for i in range(300)] + [("A", at(9_000 + 60 * i), 300 + i, 1.0) for i in range(100)]
    between = [("A", at(1_500), 900, 1.0), ("A", at(30_000), 901, 1.0)]  # in a run that is known, and long after all
    got, progress = streamed(spark, [rows, between], READING, tmp_path, lambda s: S.stream_expiring(s, 900, delay="20000 seconds"))
    want = expired_by_hand(rows + between, 900, at(10_000))
    assert {(r["city"], r["ts"], r["event_id"]) for r in got if r["status"] == "expired"} == want and len(want) == 1
    assert max(sum(o["numRowsTotal"] for o in p["stateOperators"]) for p in progress) < 20


@pytest.fixture(scope="module")
def history(spark):
    rng = random.Random(3)
    rows = [(c, at(3600 * h), *[None if rng.random() < 0.1 else round(rng.random() * 100, 1) for _ in range(6)], 20.0 + h, 50.0, 3.0)
            for c in ("A", "B") for h in range(60) if not (c == "B" and h % 7 == 3)]
    return spark.createDataFrame(rows, "city string, dt timestamp, pm25 double, pm10 double, no2 double, co double, so2 double, o3 double, "
                                       "temp double, humidity double, wind double")


REQUEST = ("request_id string, city string, dt timestamp, horizon_hours int, model string, features map<string,string>, pm25 double, pm10 double, "
           "no2 double, co double, so2 double, o3 double, temp double, humidity double, wind double")


def test_features_from_state_equal_those_from_the_table(spark, history, tmp_path):
    late = (1.5, 2.5, None, 4.0, 5.0, 6.0, 21.0, 55.0, 2.0)
    asked = [("r1", "A", at(3600 * 61), 1, "m", {"co": "3.5"}), ("r2", "A", None, 6, "m", None), ("r3", "B", at(3600 * 59 + 60), 1, None, {"pm25": "x"}),
             ("r4", "nowhere", at(0), 1, "m", {"co": "1"}), ("r5", "B", at(3600 * 55), 1, "m", {})]
    more = [("s1", "A", at(3600 * 70), 1, "m", {}), ("s2", "B", None, 1, "m", {})]
    reading = (None, "A", at(3600 * 62), None, None, None, *late)
    batches = [[(*r, *[None] * 9) for r in asked], [reading, (None, "A", None, None, None, None, *late)], [(*r, *[None] * 9) for r in more]]
    steps, widths = [1, 3, 24], [3, 6]
    got, _ = streamed(spark, batches, REQUEST, tmp_path, lambda s: S.stream_features(s, history, steps=steps, widths=widths))
    newer = history.unionByName(spark.createDataFrame([("A", at(3600 * 62), *late)], history.schema))
    names = [c for c in got[0].__fields__ if c not in ("known",)]
    for table, rows in ((history, asked), (newer, more)):
        req = spark.createDataFrame(rows, "request_id string, city string, dt timestamp, horizon_hours int, model string, features map<string,string>")
        want = {r["request_id"]: r for r in serve_features(req, table, steps=steps, widths=widths, carry=("temp", "humidity", "wind")).collect()}
        mine = {r["request_id"]: r for r in got if r["request_id"] in want}
        assert set(mine) == set(want)
        for i, r in want.items():
            for c in names:
                a, b = mine[i][c], r[c]
                assert a == b or (a is not None and b is not None and abs(a - b) < 1e-9), (i, c, a, b)
            assert mine[i]["known"] == (r["city"] != "nowhere")


def test_last_rows(spark, history):
    got = sorted(tuple(r)[:2] for r in S.last_rows(history, 5, ["co"]).collect())
    rows = [tuple(r)[:2] for r in history.collect()]
    assert got == sorted(x for c in "AB" for x in sorted(r for r in rows if r[0] == c)[-5:])


def test_answering_costs_no_step_per_request():
    """Twenty thousand requests of one city take little longer than their parsing."""
    import time

    import pandas as pd
    from pyspark.sql import types as T

    cols, carry, steps, widths = ["co", "no2"], ["temp"], [1, 2, 24], [3, 24]
    kinds = [("request_id", T.LongType()), ("city", T.StringType()), ("dt", T.TimestampType()), ("horizon_hours", T.IntegerType()), ("model", T.StringType()),
             ("known", T.BooleanType()), *[(c, T.DoubleType()) for c in cols + carry], *[(f"{c}_lag_{k}h", T.DoubleType()) for c in cols for k in steps],
             *[(f"{c}_roll_{m}_{w}h", T.DoubleType()) for c in cols for w in widths for m in ("mean", "max")]]
    state = S.LastRows(cols, carry, steps, widths, T.StructType([T.StructField(*k) for k in kinds]))
    held = pd.DataFrame({"dt": pd.date_range("2024-01-01", periods=30, freq="h"), "co": [float(i) for i in range(30)], "no2": [None, 1.0] * 15, "temp": 5.0})
    n = 20_000
    part = pd.DataFrame({"request_id": range(n), "dt": pd.to_datetime(pd.Series([None, "2024-01-01 03:00", "2023-01-01 00:00"] * n)[:n]), "horizon_hours": 1, "model": "m",
                         "features": [{"co": str(i), "temp": "x"} if i % 2 else None for i in range(n)]})
    started = time.process_time()
    out = state._answer("A", part, held)
    assert time.process_time() - started < 1.0
    first, second = out.iloc[0], out.iloc[1]
    # the newest hour, from which 29 rows are before it
    assert (first["dt"], first["co"], first["co_lag_1h"], first["co_lag_24h"], first["co_roll_mean_3h"]) == (held["dt"].iloc[-1], 29.0, 28.0, 5.0, 27.0)
    assert (first["no2"], first["no2_roll_max_3h"], first["temp"], first["known"]) == (1.0, 1.0, 5.0, True)
    assert (second["co"], second["temp"], second["co_lag_2h"], second["co_lag_24h"], second["co_roll_max_24h"]) == (1.0, 5.0, 1.0, 1.0, 2.0)
    # before all rows: the last ones
    assert (out.iloc[2]["co_lag_1h"], out.iloc[2]["co_roll_mean_3h"]) == (29.0, 28.0)
    assert out["request_id"].tolist() == list(range(n)) and out["horizon_hours"].tolist() == [1] * n
