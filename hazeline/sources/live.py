"""Live observation payloads (nested JSON) to feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.schema import GASES

AIR_SCHEMA = ("list array<struct<components: struct<pm2_5 double, pm10 double, no2 double, co double, "
              "so2 double, o3 double>>>")
WEATHER_SCHEMA = "main struct<temp double, humidity double>, wind struct<speed double>"
_SOURCE_KEYS = {"pm25": "pm2_5", "pm10": "pm10", "no2": "no2", "co": "co", "so2": "so2", "o3": "o3"}


def flatten_live(df: DataFrame, air: str = "air", weather: str = "weather", missing: float | None = 0.0) -> DataFrame:
    """Replace the two JSON text columns by gases and weather.

    CO comes in ug/m3 and is divided by 1000; wind comes in m/s and is turned
    into km/h. A missing gas counts as ``missing``; CO and wind default to 0.
    A payload without measurements is dropped.
    """
    df = df.withColumns({"_air": F.from_json(air, AIR_SCHEMA), "_wx": F.from_json(weather, WEATHER_SCHEMA)})
    df = df.filter(F.size(F.coalesce(F.col("_air.list"), F.array())) > 0)
    comp = F.element_at("_air.list", 1)["components"]

    def gas(name: str) -> Column:
        v = comp[_SOURCE_KEYS[name]]
        if name == "co":
            return F.coalesce(v, F.lit(0.0)) / 1000
        return v if missing is None else F.coalesce(v, F.lit(missing))

    return df.select(*[c for c in df.columns if c not in (air, weather, "_air", "_wx")],
                     *[gas(g).alias(g) for g in GASES], F.col("_wx.main.temp").alias("temp"),
                     F.col("_wx.main.humidity").alias("humidity"),
                     (F.coalesce("_wx.wind.speed", F.lit(0.0)) * 3.6).alias("wind"))
