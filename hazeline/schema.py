"""Column names, label vocabularies, breakpoints and feature sets of the readings table.

Everything inside the engine works on the short canonical names; ``RENAME``
maps the published column names of the hourly table to them.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# These must equal the published table layout and standards.
# ---------------------------------------------------------------------------
POLLUTANT_COLUMNS = [
    "PM2_5_ugm3", "PM10_ugm3", "PM_Ratio", "CO_ugm3", "NO2_ugm3",
    "SO2_ugm3", "O3_ugm3", "Dust_ugm3", "NH3_ugm3", "AOD",
]
WEATHER_COLUMNS = [
    "Temp_2m_C", "Temp_80m_C", "Temp_120m_C", "Temp_180m_C", "Humidity_Percent",
    "Dew_Point_C", "Humidity_Category", "Wind_Speed_10m_kmh", "Wind_Speed_80m_kmh",
    "Wind_Speed_120m_kmh", "Wind_Dir_10m", "Wind_Gusts_kmh", "Wind_Category",
    "Wind_Stagnation", "Precipitation_mm", "Rain_mm", "Is_Raining", "Heavy_Rain",
    "Pressure_MSL_hPa", "Surface_Pressure_hPa", "Solar_Radiation_Wm2",
    "Direct_Radiation_Wm2", "Diffuse_Radiation_Wm2", "UV_Index", "Cloud_Cover_Percent",
    "Cloud_Low_Percent", "Cloud_Mid_Percent", "Cloud_High_Percent", "Is_Daytime",
    "Sunshine_Seconds", "Temp_Inversion", "Inversion_Strength_C",
]
TIME_COLUMNS = [
    "Datetime", "Year", "Month", "Day", "Hour", "Day_of_Week", "Day_Name",
    "Week_of_Year", "Is_Weekend", "Quarter", "Season", "Time_of_Day",
    "Festival_Period", "Crop_Burning_Season",
]
TARGET_COLUMNS = ["AQI_Category"]
DERIVED_COLUMNS = [
    "US_AQI", "US_AQI_PM25", "US_AQI_PM10", "US_AQI_NO2", "US_AQI_O3",
    "US_AQI_CO", "EU_AQI", "EU_AQI_PM25", "EU_AQI_PM10", "PM25_Category_India",
]
EMPTY_COLUMNS = [
    "NH3_ugm3", "Temp_80m_C", "Temp_120m_C", "Temp_180m_C",
    "Wind_Speed_80m_kmh", "Wind_Speed_120m_kmh", "UV_Index", "Inversion_Strength_C",
]
CONSTANT_COLUMNS = ["Temp_Inversion"]

LABELS = ["Good", "Moderate", "Unhealthy_Sensitive", "Unhealthy", "Very_Unhealthy", "Hazardous"]
BANDS = ["Good", "Satisfactory", "Moderate", "Poor", "Very Poor", "Severe"]
BAND_LIMITS = [50, 100, 200, 300, 400]

INDEX_LEVELS = [0, 50, 100, 200, 300, 400]
BREAKPOINTS = {
    "pm25": [0, 30, 60, 90, 120, 250],
    "pm10": [0, 50, 100, 250, 350, 430],
    "no2": [0, 40, 80, 180, 280, 400],
    "co": [0, 1, 2, 10, 17, 34],
    "so2": [0, 40, 80, 380, 800, 1600],
    "o3": [0, 50, 100, 168, 208, 748],
}
GAS_NAMES = {"pm25": "PM2.5", "pm10": "PM10", "no2": "NO2", "co": "CO", "so2": "SO2", "o3": "O3"}

HORIZONS = [1, 4, 6, 12, 24]
LAG_STEPS = [1, 3, 6, 12, 24]
ROLL_WIDTHS = [3, 6, 12, 24]
SEVERE_LABELS = ["Very_Unhealthy", "Hazardous"]
MINORITY_LABELS = ["Hazardous", "Severe", "Very_Unhealthy", "Unhealthy"]
# ---------------------------------------------------------------------------

GASES = ["pm25", "pm10", "no2", "co", "so2", "o3"]
WEATHER = ["temp", "humidity", "wind"]

RENAME = {
    "City": "city", "Datetime": "dt", "AQI_Category": "aqi_category",
    "PM2_5_ugm3": "pm25", "PM10_ugm3": "pm10", "NO2_ugm3": "no2",
    "CO_ugm3": "co", "SO2_ugm3": "so2", "O3_ugm3": "o3",
    "Temp_2m_C": "temp", "Humidity_Percent": "humidity", "Wind_Speed_10m_kmh": "wind",
    "Year": "year", "Month": "month", "Day": "day", "Hour": "hour", "Day_of_Week": "day_of_week",
}

_STRING_COLUMNS = {
    "City", "Day_Name", "Season", "Time_of_Day", "Humidity_Category", "Wind_Category",
    "PM25_Category_India", "AQI_Category",
}
_INT_COLUMNS = {
    "Year", "Month", "Day", "Hour", "Day_of_Week", "Week_of_Year", "Quarter", "Is_Weekend",
    "Festival_Period", "Crop_Burning_Season", "Wind_Stagnation", "Is_Raining", "Heavy_Rain",
    "Is_Daytime", "Temp_Inversion",
}


def canonical(name: str) -> str:
    """Short engine name of a published column (lower case where none is listed)."""
    return RENAME.get(name, name.lower())


def _field(name: str) -> T.StructField:
    if name in _STRING_COLUMNS or name == "Datetime":
        return T.StructField(name, T.StringType())
    if name in _INT_COLUMNS:
        return T.StructField(name, T.IntegerType())
    return T.StructField(name, T.DoubleType())


def raw_schema() -> T.StructType:
    """Declared schema of the published CSV; ``Datetime`` stays text for the lenient parse."""
    names = ["City", *TIME_COLUMNS, *POLLUTANT_COLUMNS, *WEATHER_COLUMNS,
             *DERIVED_COLUMNS, *TARGET_COLUMNS]
    return T.StructType([_field(n) for n in names])


_CORE = ["PM2_5_ugm3", "PM10_ugm3", "NO2_ugm3", "CO_ugm3", "SO2_ugm3", "O3_ugm3"]
_OTHER = ["PM_Ratio", "Dust_ugm3", "AOD"]
_WEATHER_MODEL = [c for c in WEATHER_COLUMNS if c not in {
    "Temp_80m_C", "Temp_120m_C", "Temp_180m_C", "Dew_Point_C", "Humidity_Category",
    "Wind_Speed_80m_kmh", "Wind_Speed_120m_kmh", "Wind_Category", "UV_Index",
    "Temp_Inversion", "Inversion_Strength_C"}]
_TIME_MODEL = ["Year", "Month", "Day", "Hour", "Day_of_Week"]
_EVENTS = ["Festival_Period", "Crop_Burning_Season"]

FEATURE_SETS = {
    "nowcast": _CORE + ["Temp_2m_C", "Humidity_Percent", "Wind_Speed_10m_kmh",
                        "Hour", "Month", "Day_of_Week"],
    "research": _CORE + _OTHER + _WEATHER_MODEL + _TIME_MODEL + _EVENTS,
    "research_reduced": _CORE + _WEATHER_MODEL + _TIME_MODEL + _EVENTS,
    "clustering": _CORE + _OTHER + _WEATHER_MODEL,
    "clustering_used": _CORE + ["Temp_2m_C", "Humidity_Percent", "Wind_Speed_10m_kmh"],
    "synthetic": ["PM2_5_ugm3", "PM10_ugm3", "NO2_ugm3", "CO_ugm3", "O3_ugm3",
                  "Temp_2m_C", "Humidity_Percent", "Wind_Speed_10m_kmh"],
}


def feature_set(name: str, published: bool = False) -> list[str]:
    """Columns of a registered feature set, in canonical or published names."""
    cols = FEATURE_SETS[name]
    return list(cols) if published else [canonical(c) for c in cols]
