"""Labels, limits, patterns and formats that results depend on."""

from __future__ import annotations

from typing import NamedTuple


class ValidRange(NamedTuple):
    """Values a measure may take; outside it the measure (not the row) becomes NULL."""

    low: float
    high: float | None = None
    low_open: bool = False
    high_open: bool = False


# --- Fixed values: station identity -------------------------------------------------------------
UNIDENTIFIED = "Unidentified"
UNIDENTIFIED_STATION_ID = "96535"
STATION_SUFFIX = ":9:MY"
STATION_COUNTRY = "MY"
LOCAL_TIME_ZONE = "Asia/Kuala_Lumpur"

# --- Fixed values: what an accepted API response says -------------------------------------------
ACCEPTED_STATUS = 200
ACCEPTED_LANGUAGE = "en-US"
ACCEPTED_UNITS = "m"
MAX_REQUEST_DAYS = 31

# --- Fixed values: validity ranges of station weather -------------------------------------------
WEATHER_RANGES = {
    "dew_point": ValidRange(0, 45, low_open=True, high_open=True),
    "min_temperature": ValidRange(0, 42, low_open=True, high_open=True),
    "max_temperature": ValidRange(0, 42, low_open=True, high_open=True),
    "feels_like_temperature": ValidRange(0, 45, low_open=True, high_open=True),
    "temperature": ValidRange(0, 42, low_open=True, high_open=True),
    "pressure_tend": ValidRange(0),
    "pressure": ValidRange(850, 1090),
    "wind_speed": ValidRange(0),
    "gust": ValidRange(0),
    "relative_humidity": ValidRange(0, 100),
    "heat_index": ValidRange(0, 45, low_open=True, high_open=True),
    "wind_direction_degree": ValidRange(0, 360, high_open=True),
    "wind_chill": ValidRange(0, 45, low_open=True, high_open=True),
    "uv_index": ValidRange(0),
}
# Text columns in which the word "none", in any case, means missing.
WEATHER_NONE_TEXT = ["pressure_desc", "wind_direction_dir", "clouds", "weather_phrase", "uv_description"]

# --- Fixed values: validity ranges of personal stations -----------------------------------------
PWS_RANGES = {
    "solar_radiation": ValidRange(0),
    "humidity": ValidRange(0, 100),
    "dew_point": ValidRange(0, 45, low_open=True, high_open=True),
    "temperature": ValidRange(0, 42, low_open=True, high_open=True),
    "pressure_tend": ValidRange(0),
    "pressure": ValidRange(850, 1090),
    "wind_speed": ValidRange(0),
    "gust": ValidRange(0),
    "heat_index": ValidRange(0, 45, low_open=True, high_open=True),
    "wind_direction_degree": ValidRange(0, 360, high_open=True),
    "wind_chill": ValidRange(0, 45, low_open=True, high_open=True),
    "uv_index": ValidRange(0),
    "precipitation_rate": ValidRange(0),
    "precipitation_total": ValidRange(0),
}
# Personal stations whose sensor for one measure is known to be broken.
PWS_DENIED = {
    "humidity": ["ISELAN1"],
    "wind_speed": ["ISELANGO11", "ISELANGO6", "IPETAL1"],
    "gust": ["ISELANGO11", "ISELANGO6"],
    "uv_index": ["ISELANGO11", "IPEKAN1", "IPETAL1"],
}

# --- Fixed values: air-quality bands (upper bound, not included) --------------------------------
AQI_BANDS = [
    (50, "Good"),
    (100, "Moderate"),
    (150, "Unhealthy for sensitive groups"),
    (200, "Unhealthy"),
    (300, "Very unhealthy"),
]
AQI_TOP_BAND = "Hazardous"

# --- Fixed values: UV bands (upper bound, included; the first one starts at 0) ------------------
UV_BANDS = [(2, "low"), (5, "moderate"), (7, "high"), (10, "very high"), (20, "extreme")]

# --- Fixed values: pollutant symbols (symbol, pollutant, unit) ----------------------------------
POLLUTANT_SYMBOLS = [
    ("**", "PM2.5", "ug/m3"),
    ("*", "PM10", "ug/m3"),
    ("a", "SO2", "ppm"),
    ("b", "NO2", "ppm"),
    ("c", "O3", "ppm"),
    ("d", "CO", "ppm"),
    ("&", "multi-pollutant", None),
]
NO_SYMBOL = "-"
UNKNOWN_POLLUTANT = "unknown"
NOT_AVAILABLE = "N/A"
ACCEPTED_SYMBOLS = ["*", "**", "a", "b", "c", "d", "&", "-"]
ACCEPTED_POLLUTANTS = ["PM10", "PM2.5", "NO2", "SO2", "CO2", "O3", "multi-pollutant", "CO", "Unidentified"]
ACCEPTED_LABELS = ["Good", "Moderate", "Unhealthy", "Unhealthy for sensitive groups", "Very unhealthy", "Hazardous"]

# --- Fixed values: legacy 24-hour matrix --------------------------------------------------------
MATRIX_KEYS = ["24hour_api_apims", "24hour_api"]
MATRIX_HEADER = [
    "State", "Location",
    "1:00AM", "2:00AM", "3:00AM", "4:00AM", "5:00AM", "6:00AM", "7:00AM", "8:00AM", "9:00AM", "10:00AM", "11:00AM",
    "12:00PM", "1:00PM", "2:00PM", "3:00PM", "4:00PM", "5:00PM", "6:00PM", "7:00PM", "8:00PM", "9:00PM", "10:00PM", "11:00PM", "12:00AM",
]
MATRIX_RETRY_TIMES = ["2300", "0000", "0100"]

# --- Fixed values: address parts, best first ----------------------------------------------------
TOWN_KEYS = ["town", "hamlet", "county", "suburb", "neighbourhood", "quarter", "district"]
CITY_KEYS = ["city", "district", "state_district", "county", "region", "suburb"]

# --- Fixed values: formats ----------------------------------------------------------------------
READING_TIME_FORMAT = "yyyy-MM-dd'T'HH:mm:ss"
COMPACT_DATE_FORMAT = "yyyyMMdd"
# Last epoch second of year 9999: a larger number must be milliseconds.
LAST_EPOCH_SECOND = 253402300799

# --- Fixed values: how a missing value was written as text ---------------------------------------
MISSING_TEXTS = ["None", "none", "nan", "NaN", ""]

# --- Fixed values: incremental models and dev runs ----------------------------------------------
TEST_RUN_ROWS = 1000
