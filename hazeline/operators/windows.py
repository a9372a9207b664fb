"""Time-series features: lags, rolls, horizon targets, sequences, serving features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from hazeline.functions.values import encode
from hazeline.operators.clean import dedupe_ts
from hazeline.operators.filters import city_or_all
from hazeline.operators.joins import asof_attach
from hazeline.operators.panel import chunked, own_rows, window
from hazeline.schema import GASES, LAG_STEPS, ROLL_WIDTHS


def _over(by: list[str], frame: str = "") -> str:
    return f"OVER (PARTITION BY {', '.join([*by, '_chunk'])} ORDER BY _pos {frame})"


def lag_columns(cols=GASES, steps=LAG_STEPS, city: str = "city") -> dict[str, Column]:
    w = _over([city])
    return {f"{c}_lag_{k}h": F.expr(f"lag({c}, {k}) {w}") for c in cols for k in steps}


def roll_columns(cols=GASES, widths=ROLL_WIDTHS, kinds=("mean", "max"), city: str = "city") -> dict[str, Column]:
    """Rolls over the ``n`` rows before the current one; null below max(2, n // 2) values."""
    agg = {"mean": "avg", "max": "max"}
    out = {}
    for c in cols:
        for n in widths:
            w = _over([city], f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING")
            for kind in kinds:
                out[f"{c}_roll_{kind}_{n}h"] = F.expr(
                    f"CASE WHEN count({c}) {w} >= {max(2, n // 2)} THEN {agg[kind]}({c}) {w} END")
    return out


def lags(df: DataFrame, cols=GASES, steps=LAG_STEPS, city: str = "city", time: str = "dt") -> DataFrame:
    base = chunked(df, max(steps), 0, [city], time)
    return own_rows(base.select("*", *[e.alias(n) for n, e in lag_columns(cols, steps, city).items()]))


def rolls(df: DataFrame, cols=GASES, widths=ROLL_WIDTHS, kinds=("mean", "max"),
          city: str = "city", time: str = "dt") -> DataFrame:
    base = chunked(df, max(widths), 0, [city], time)
    return own_rows(base.select("*", *[e.alias(n) for n, e in roll_columns(cols, widths, kinds, city).items()]))


def past_features(df: DataFrame, cols=GASES, steps=LAG_STEPS, widths=ROLL_WIDTHS,
                  city: str = "city", time: str = "dt") -> DataFrame:
    """All lags and rolls in one pass over one sort."""
    base = chunked(df, max([*steps, *widths]), 0, [city], time)
    new = {**lag_columns(cols, steps, city), **roll_columns(cols, widths, city=city)}
    return own_rows(base.select("*", *[e.alias(n) for n, e in new.items()]))


def time_lags(df: DataFrame, cols: list[str], hours: int, city: str = "city", time: str = "dt") -> DataFrame:
    """Value exactly ``hours`` earlier by the clock; null where that hour is absent."""
    past = df.select(city, (F.col(time) + F.make_interval(hours=F.lit(hours))).alias(time),
                     *[F.col(c).alias(f"{c}_at_{hours}h") for c in cols])
    return df.join(past, [city, time], "left")


def lead_label(df: DataFrame, h: int, label: str = "aqi_category", city: str = "city",
               time: str = "dt") -> DataFrame:
    """Label h rows later (``target_category``) and whether that row is h hours later."""
    base = chunked(df, 0, h, [city], time)
    w = window([city])
    base = base.select("*", F.lead(label, h).over(w).alias("target_category"),
                       F.lead(time, h).over(w).alias("_t"))
    out = own_rows(base)
    exact = F.coalesce(F.col("_t") == F.col(time) + F.make_interval(hours=F.lit(h)), F.lit(False))
    return out.withColumn("exact", exact).drop("_t")


def forecast_frame(df: DataFrame, hs: list[int], features: list[str] | None = None,
                   past: dict[str, Column] | None = None, back: int = 0, label: str = "aqi_category",
                   city: str = "city", time: str = "dt") -> DataFrame:
    """One row per reading and horizon whose target lies exactly that many hours ahead.

    All horizons, and the ``past`` columns that look back up to ``back`` rows,
    share one window pass. Rows with a null target or a null in ``features`` are
    dropped.
    """
    past = past or {}
    base = chunked(df, back, max(hs), [city], time)
    w = window([city])
    leads = F.array(*[F.struct(F.lit(h).alias("horizon_hours"), F.lead(label, h).over(w).alias("target_category"),
                               F.lead(time, h).over(w).alias("_t")) for h in hs])
    base = base.select("*", leads.alias("_leads"), *[e.alias(n) for n, e in past.items()])
    out = own_rows(base).select(*df.columns, *past, F.inline("_leads"))
    out = out.filter(F.col("_t") == F.col(time) + F.make_interval(hours=F.col("horizon_hours")))
    out = out.withColumn("target", encode("target_category")).filter("target is not null").drop("_t")
    return out.na.drop(subset=features) if features else out


def sequences(df: DataFrame, features: list[str], length: int, h: int, label: str = "aqi_category",
              by: list[str] | None = None, time: str = "dt") -> DataFrame:
    """(by, time, sequence, target): ``length`` steps ending at the row, label h rows on."""
    by = by or ["city"]
    base = chunked(df, length - 1, h, by, time)
    w = window(by)
    step = F.array(*[F.col(c).cast("float") for c in features])
    base = base.select("*", F.collect_list(step).over(w.rowsBetween(1 - length, 0)).alias("sequence"),
                       F.lead(encode(label), h).over(w).alias("target"))
    return (own_rows(base).select(*by, time, "sequence", "target")
            .filter((F.size("sequence") == length) & F.col("target").isNotNull()))


def history_columns(cols: list[str], steps, widths, city: str = "city") -> dict[str, Column]:
    """Lags and rolls as they stand for a moment just after the row (no minimum count)."""
    out = {f"{c}_lag_{k}h": F.expr(f"lag({c}, {k - 1}) {_over([city])}") for c in cols for k in steps}
    for c in cols:
        for n in widths:
            w = _over([city], f"ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW")
            out[f"{c}_roll_mean_{n}h"] = F.expr(f"avg({c}) {w}")
            out[f"{c}_roll_max_{n}h"] = F.expr(f"max({c}) {w}")
    return out


def default_time(requests: DataFrame, df: DataFrame, city: str = "city", time: str = "dt") -> DataFrame:
    """Requests whose null times become the newest time of their city."""
    newest = df.groupBy(F.col(city).alias("_city")).agg(F.max(time).alias("_time"))
    out = requests.join(newest, F.col(city) == F.col("_city"), "left").withColumn(time, F.coalesce(time, "_time"))
    return out.select(*requests.columns)


def serve_features(requests: DataFrame, df: DataFrame, cols=GASES, steps=LAG_STEPS, widths=ROLL_WIDTHS,
                   carry: tuple = (), city: str = "city", time: str = "dt") -> DataFrame:
    """Features of many requests (request_id, city, dt, features map) at once.

    The current values of ``cols`` and ``carry`` are the city's newest row,
    overridden by the request's ``features`` map. Lags and rolls use rows strictly
    before the request time; a city without any uses its last rows. A lag that
    reaches beyond the history falls back to the current value. A request without
    a time is for the city's newest time. Every request gets a row: that of an
    unknown city has only what the request brings, and nulls.
    """
    requests = default_time(requests, df, city, time)
    cols = list(cols)
    base = chunked(df, max([*steps, *widths]), 0, [city], time, last="_newest")
    hist = history_columns(cols, steps, widths, city)
    names = list(hist)
    full = own_rows(base.select("*", (F.col("_pos") + 1).alias("_have"), *[e.alias(n) for n, e in hist.items()]))
    full = full.withColumn("_h", F.struct("_have", *names))
    newest = full.filter("_newest").select(city, F.struct("_h", *cols, *carry).alias("_new"))
    joined = asof_attach(requests, full, [city], time, "_h").join(newest, city, "left")
    joined = joined.withColumn("_use", F.coalesce("_h", F.col("_new._h")))
    current = {c: F.coalesce(F.try_element_at(F.col("features"), F.lit(c)).try_cast("double"), F.col(f"_new.{c}"))
               for c in [*cols, *carry]}
    lagged = {f"{c}_lag_{k}h": F.when(F.col("_use._have") >= k, F.col(f"_use.{c}_lag_{k}h")).otherwise(current[c])
              for c in cols for k in steps}
    keep = [c for c in requests.columns if c != "features"]
    return joined.select(*keep, *[e.alias(c) for c, e in current.items()],
                         *[lagged.get(n, F.col(f"_use.{n}")).alias(n) for n in names])


def serve_sequence(requests: DataFrame, df: DataFrame, cols=GASES, length: int = 12,
                   city: str = "city", time: str = "dt") -> DataFrame:
    """(request, step, values): the last ``length - 1`` rows before the request and the current row.

    Nulls are filled forward, then backward, inside the sequence. With fewer
    rows before the request time than needed the city's last rows are used. A
    request without a time is for the city's newest time; one for an unknown city
    has the one step that it brings itself.
    """
    requests = default_time(requests, df, city, time)
    cols = list(cols)
    base = chunked(df, length - 1, 0, [city], time, last="_newest")
    w = window([city])
    item = F.struct(time, *cols)
    past = own_rows(base.withColumn("_seq", F.collect_list(item).over(w.rowsBetween(2 - length, 0))))
    newest = past.filter("_newest").select(city, F.struct("_seq", *cols).alias("_new"))
    known = asof_attach(requests, past, [city], time, "_seq")
    joined = known.join(newest, city, "left")
    now = F.struct(F.col(time), *[F.coalesce(F.try_element_at(F.col("features"), F.lit(c)).try_cast("double"),
                                             F.col(f"_new.{c}")).alias(c) for c in cols])
    hist = F.when(F.size(F.coalesce("_seq", F.array())) >= length - 1, F.col("_seq")).otherwise(F.col("_new._seq"))
    seq = F.array_append(F.coalesce(hist, F.array()), now)
    out = joined.select(*[c for c in requests.columns if c != "features"], F.posexplode(seq).alias("step", "_s"))
    keys = [c for c in requests.columns if c not in ("features", time)]
    out = out.select(*keys, F.col(time), "step", F.col(f"_s.{time}").alias("step_time"),
                     *[F.col(f"_s.{c}").alias(c) for c in cols])
    v = Window.partitionBy(*keys, time).orderBy("step")
    upto, onward = v.rowsBetween(Window.unboundedPreceding, 0), v.rowsBetween(0, Window.unboundedFollowing)
    return out.select(*keys, time, "step", "step_time", *[
        F.coalesce(F.last(c, ignorenulls=True).over(upto), F.first(c, ignorenulls=True).over(onward)).alias(c)
        for c in cols])


def smooth(df: DataFrame, key: str, value: str) -> DataFrame:
    """Centred three-point mean over an already grouped series; partial at the ends."""
    w = Window.orderBy(key).rowsBetween(-1, 1)
    return df.withColumn(f"{value}_smooth", F.avg(value).over(w))


def timeline(df: DataFrame, name: str, n: int = 24, cols=GASES, city: str = "city", time: str = "dt") -> DataFrame:
    """Last n complete rows of a city, one per timestamp, oldest first; all cities if it is unknown."""
    rows = city_or_all(df, name)
    rows = dedupe_ts(rows, [time], [city]).na.drop(subset=list(cols))
    return rows.orderBy(F.col(time).desc()).limit(n).orderBy(time)
