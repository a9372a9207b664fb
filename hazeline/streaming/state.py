"""Streaming operators that keep state for each city: readings that expire, and forecasts from the last rows.

They need a state store that holds several variables for a key: ``with_store`` sets it while a stream is started.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pandas as pd
from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from hazeline.functions.values import calendar, cyclical
from hazeline.plans.forecast import score_requests
from hazeline.schema import GASES, LAG_STEPS, ROLL_WIDTHS, WEATHER

_STORE = "spark.sql.streaming.stateStore.providerClass"


@contextmanager
def with_store(spark: SparkSession):
    """Streams started inside use the embedded store; the session's setting comes back afterwards."""
    old = spark.conf.get(_STORE, None)
    spark.conf.set(_STORE, "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
    try:
        yield
    finally:
        if old is None:
            spark.conf.unset(_STORE)
        else:
            spark.conf.set(_STORE, old)


class LatestReadings(StatefulProcessor):
    """Readings of a city that are younger than their life; a timer of event time ends each that no newer one replaced.

    A reading is only judged when the watermark has passed the end of its life, so the result doesn't depend on how rows
    fall into micro-batches. Of readings that follow each other within a life only the last can end without a newer one, and a late
    one between them always has one, so state holds such a run as the time of its first and its last reading. ``time`` is in microseconds.
    """

    def __init__(self, columns: list[str], time: str, tie: str, life: int, schema: T.StructType):
        self.columns, self.time, self.tie, self.life, self.schema = columns, time, tie, life, schema
        self.place = (columns.index(time), columns.index(tie))
        self.whole = [i for i, f in enumerate(schema.fields) if isinstance(f.dataType, T.IntegralType)]

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        # a run: its last reading and, behind it, the time of its first
        self.runs = handle.getListState("runs", T.StructType([*self.schema.fields, T.StructField("run_from_us", T.LongType())]))
        self.newest = handle.getValueState("newest", self.schema)

    def _order(self, row) -> tuple:
        return row[self.place[0]], row[self.place[1]]

    def _end(self, row) -> int:
        """Millisecond at which the reading's life is over."""
        return -(-(row[self.place[0]] + self.life) // 1000)

    def _out(self, city, rows: list, status: str) -> pd.DataFrame:
        out = pd.DataFrame([tuple(r) for r in rows], columns=self.columns)
        out.insert(0, "city", city)
        return out.assign(status=status)

    def _found(self, batch: pd.DataFrame) -> list[tuple]:
        """Runs of a batch's readings."""
        batch = batch[batch[self.time].notna()].sort_values([self.time, self.tie], kind="stable")
        time = batch[self.time].to_numpy("int64")
        cut = np.flatnonzero(np.diff(time) > self.life)
        last = batch[self.columns].iloc[[*cut, len(time) - 1] if len(time) else []]
        rows = [[_plain(v) for v in r] for r in last.itertuples(index=False)]
        for r in rows:
            # whole numbers are floats where a batch holds nulls, too
            for i in self.whole:
                r[i] = None if r[i] is None else int(r[i])
        return [(*r, int(first)) for r, first in zip(rows, time[[0, *(cut + 1)]] if rows else [])]

    def _joined(self, runs: list[tuple]) -> list[tuple]:
        """Runs in the order of time, of which those within a life of each other are one."""
        out = []
        for r in sorted(runs, key=lambda r: r[-1]):
            if out and r[-1] <= out[-1][self.place[0]] + self.life:
                out[-1] = (*max(out[-1], r, key=self._order)[:-1], out[-1][-1])
            else:
                out.append(r)
        return out

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        new = []
        for batch in rows:
            new = self._joined(new + self._found(batch))
        if not new:
            return
        held = [tuple(r) for r in self.runs.get()] if self.runs.exists() else []
        runs = self._joined(held + new)
        self.runs.put(runs)
        self.handle.registerTimer(min(self._end(r) for r in runs))
        best, top = self.newest.get() if self.newest.exists() else None, max(new, key=self._order)[:-1]
        if best is None or self._order(top) > self._order(best):
            self.newest.update(top)
            yield self._out(key[0], [top], "current")

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        # all that the watermark has passed is judged at once; one timer waits for the first of the others
        now = max(expiredTimerInfo.getExpiryTimeInMs(), timerValues.getCurrentWatermarkInMs())
        held = [tuple(r) for r in self.runs.get()] if self.runs.exists() else []
        over, kept = [r for r in held if self._end(r) <= now], [r for r in held if self._end(r) > now]
        if kept:
            # a timer of this run's shorter past may come before the first end
            self.handle.registerTimer(min(self._end(r) for r in kept))
        if over and kept:
            self.runs.put(kept)
        elif over:
            self.runs.clear()
        if over:
            yield self._out(key[0], [r[:-1] for r in over], "expired")

    def close(self) -> None:
        pass


def _plain(v):
    """A value that the state store takes: Python's own types."""
    if isinstance(v, pd.Timestamp):
        return None if v is pd.NaT else v.to_pydatetime()
    if isinstance(v, np.generic):
        v = v.item()
    return None if v is pd.NaT or (isinstance(v, float) and np.isnan(v)) else v


def stream_expiring(stream: DataFrame, ttl_seconds: int = 900, time: str = "ts", tie: str = "event_id", delay: str = "15 minutes") -> DataFrame:
    """The latest reading of each city while it lives: (city, the other columns, status).

    A row with status ``current`` says that a reading is now the city's newest; one with ``expired`` that ``ttl_seconds`` passed
    after a reading without a newer one, which the watermark (``delay`` behind the newest time) decides. Rows later than the
    watermark are dropped, rows without a time ignored. Of equal times the larger ``tie`` counts. Append mode.
    """
    stream = stream.withColumn("time_in_us", F.unix_micros(time))
    columns = [c for c in stream.columns if c != "city"]
    schema = T.StructType([T.StructField(c, stream.schema[c].dataType) for c in columns])
    out = T.StructType([stream.schema["city"], *schema.fields, T.StructField("status", T.StringType())])
    state = LatestReadings(columns, "time_in_us", tie, ttl_seconds * 1_000_000, schema)
    return stream.withWatermark(time, delay).groupBy("city").transformWithStateInPandas(
        statefulProcessor=state, outputStructType=out, outputMode="append", timeMode="EventTime").drop("time_in_us")


def _number(given, last: float) -> float:
    """What a request brings, or else the last value."""
    try:
        return last if given is None else float(given)
    except ValueError:
        return last


class LastRows(StatefulProcessor):
    """The last rows of a city, which requests are answered from; the history is read once, as initial state."""

    def __init__(self, cols: list[str], carry: list[str], steps: list[int], widths: list[int], out: T.StructType):
        self.cols, self.carry, self.steps, self.widths, self.out = cols, carry, steps, widths, out
        # twice the longest reach, so that requests may be older than the newest rows
        self.keep = 2 * max([*steps, *widths])
        self.state_schema = T.StructType([T.StructField("dt", T.TimestampType()), *[T.StructField(c, T.DoubleType()) for c in [*cols, *carry]]])

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.rows = handle.getListState("rows", self.state_schema)

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        # a long initial state may come in parts
        held = self._held()
        rows = self._frame(initialState)
        self._store(pd.concat([held, rows]).sort_values("dt", kind="stable") if len(held) else rows)

    def _frame(self, rows: pd.DataFrame) -> pd.DataFrame:
        return rows[["dt", *self.cols, *self.carry]].sort_values("dt", kind="stable")

    def _store(self, rows: pd.DataFrame) -> None:
        last = rows.tail(self.keep)
        self.rows.put([tuple(_plain(v) for v in r) for r in last.itertuples(index=False)])

    def _held(self) -> pd.DataFrame:
        found = [tuple(r) for r in self.rows.get()] if self.rows.exists() else []
        return pd.DataFrame(found, columns=self.state_schema.names).astype({c: float for c in [*self.cols, *self.carry]})

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        asked, read = [], []
        for batch in rows:
            asked.append(batch[batch["request_id"].notna()])
            read.append(self._frame(batch[batch["request_id"].isna() & batch["dt"].notna()]))
        held = self._held()
        new = pd.concat([x for x in read if len(x)] or [held.iloc[:0]])
        if len(new):
            # a reading that is sent again replaces the one before
            held = pd.concat([held, new]).drop_duplicates("dt", keep="last").sort_values("dt", kind="stable")
        for part in asked:
            if len(part):
                yield self._answer(key[0], part, held)
        if len(new):
            self._store(held)

    def _answer(self, city, part: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        n, many = len(held), len(part)
        times = held["dt"].to_numpy("datetime64[ns]")
        values = {c: held[c].to_numpy(float) for c in [*self.cols, *self.carry]}
        at = pd.to_datetime(part["dt"]).to_numpy("datetime64[ns]")
        if n:
            at = np.where(np.isnat(at), times[-1], at)
        # rows before the request; where there are none, the last rows
        have = np.where(np.isnat(at), n, np.searchsorted(times, at, "left"))
        have = np.where(have == 0, n, have)
        given = [dict(f) if f is not None else {} for f in part["features"]]
        now = {}
        for c in values:
            last = values[c][-1] if n else np.nan
            now[c] = np.array([_number(g.get(c), last) for g in given], float)
        out = {"request_id": part["request_id"], "city": [city] * many, "dt": at, "horizon_hours": part["horizon_hours"],
               "model": part["model"], "known": [n > 0] * many, **now}
        # a roll depends on the request's place alone
        places, place = np.unique(have, return_inverse=True)
        for c in self.cols:
            for k in self.steps:
                out[f"{c}_lag_{k}h"] = np.where(have >= k, values[c][np.maximum(have - k, 0)], now[c]) if n else now[c]
            for w in self.widths:
                rows = [values[c][max(0, i - w):i] for i in places]
                rows = [x[~np.isnan(x)] for x in rows]
                out[f"{c}_roll_mean_{w}h"] = np.array([x.mean() if len(x) else np.nan for x in rows], float)[place]
                out[f"{c}_roll_max_{w}h"] = np.array([x.max() if len(x) else np.nan for x in rows], float)[place]
        frame = {}
        for f in self.out.fields:
            v = out[f.name]
            if f.name != "dt" and not isinstance(f.dataType, T.DoubleType):
                # whole numbers are floats where a batch holds readings, too
                whole = isinstance(f.dataType, T.IntegralType)
                v = pd.Series([None if x is None or x != x else int(x) if whole else x for x in v], dtype=object)
            frame[f.name] = v
        return pd.DataFrame(frame)

    def close(self) -> None:
        pass


def last_rows(df: DataFrame, n: int, cols: list[str], city: str = "city", time: str = "dt") -> DataFrame:
    """The last ``n`` rows of each city.

    Days are counted first, so that only rows of the days that matter are ordered.
    """
    day = F.to_date(time)
    counts = df.where(F.col(time).isNotNull()).groupBy(F.col(city).alias("_city"), day.alias("_day")).agg(F.count(F.lit(1)).alias("_n"))
    later = Window.partitionBy("_city").orderBy(F.desc("_day")).rowsBetween(Window.unboundedPreceding, -1)
    days = counts.withColumn("_later", F.coalesce(F.sum("_n").over(later), F.lit(0))).where(F.col("_later") < n).drop("_n")
    rows = df.select(city, time, *cols).withColumn("_day", day)
    rows = rows.join(days.withColumnRenamed("_day", "_d"), (F.col(city) == F.col("_city")) & (F.col("_day") == F.col("_d")))
    inside = F.row_number().over(Window.partitionBy(city, "_day").orderBy(F.desc(time)))
    return rows.withColumn("_at", inside + F.col("_later")).where(F.col("_at") <= n).select(city, time, *cols)


def stream_features(stream: DataFrame, history: DataFrame, cols=GASES, carry=WEATHER, steps=LAG_STEPS, widths=ROLL_WIDTHS) -> DataFrame:
    """Features of the requests in a stream of requests and readings, with ``known`` (whether the city has rows).

    ``stream`` has city, dt, request_id, horizon_hours, model, features (map) for requests, and ``cols`` and ``carry`` for readings,
    which have no request_id. ``history`` is read once, when the stream starts; from then on each city's last rows are kept in
    its state, with the readings that come in: twice as many as the longest lag or roll reaches back. Values are those of
    ``serve_features`` on the same rows for requests that are not older than the later half of these. A request for an unknown city has what it brings itself.
    """
    cols, carry = list(cols), list(carry)
    names = [f"{c}_lag_{k}h" for c in cols for k in steps]
    names += [f"{c}_roll_{kind}_{w}h" for c in cols for w in widths for kind in ("mean", "max")]
    kinds = {f.name: f.dataType for f in stream.schema.fields}
    out = T.StructType([*[T.StructField(c, kinds[c]) for c in ("request_id", "city", "dt", "horizon_hours", "model")],
                        T.StructField("known", T.BooleanType()), *[T.StructField(c, T.DoubleType()) for c in [*cols, *carry, *names]]])
    state = LastRows(cols, carry, list(steps), list(widths), out)
    past = history.select("city", "dt", *[F.col(c).cast("double").alias(c) for c in [*cols, *carry]])
    start = last_rows(past, state.keep, [*cols, *carry])
    return stream.groupBy("city").transformWithStateInPandas(
        statefulProcessor=state, outputStructType=out, outputMode="append", timeMode="None", initialState=start.groupBy("city"))


def stream_forecasts(stream: DataFrame, history: DataFrame, models: dict[tuple[int, str], PipelineModel], steps=LAG_STEPS,
                     widths=ROLL_WIDTHS) -> DataFrame:
    """Answers to the requests in a stream, as ``batch_forecast`` gives them: one row each, with a status."""
    feats = cyclical(calendar(stream_features(stream, history, steps=steps, widths=widths)))
    return score_requests(feats, models)
