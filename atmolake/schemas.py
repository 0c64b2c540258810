"""Declared schemas; nothing is ever inferred."""

from __future__ import annotations

_WEATHER_TEXT = (
    "class obs_name temp min_temp max_temp feels_like dewPt wc heat_index pressure pressure_tend pressure_desc "
    "wspd wdir wdir_cardinal gust rh clds precip_total precip_hrly uv_desc uv_index vis water_temp day_ind "
    "wx_phrase wx_icon icon_extd qualifier qualifier_svrty blunt_phrase terse_phrase"
).split()

# Measures are declared STRING: the JSON reader then keeps the number as it was written, which is
# what the all-text bronze tables store. `obs_id`, `key` and `stationID` are VARIANT because a
# missing key and a JSON null mean different things there.
WEATHER_OBSERVATION = (
    "struct<obs_id: variant, key: variant, valid_time_gmt: bigint, expire_time_gmt: bigint, "
    + ", ".join(f"`{name}`: string" for name in _WEATHER_TEXT)
    + ">"
)
PWS_OBSERVATION = (
    "struct<stationID: variant, epoch: bigint, obsTimeUtc: string, obsTimeLocal: string, lat: string, lon: string, "
    "uvHigh: string, solarRadiationHigh: string, humidityAvg: string, winddirAvg: string, qcStatus: string, "
    "metric: struct<tempAvg: string, windspeedAvg: string, windgustAvg: string, dewptAvg: string, "
    "windchillAvg: string, heatindexAvg: string, pressureMax: string, pressureMin: string, pressureTrend: string, "
    "precipRate: string, precipTotal: string>>"
)
RESPONSE_HEAD = {"metadata": "struct<status_code: int, language: string, units: string>", "weather_station": "string"}
AQ_TABLE = "api_table_hourly"
AQ_READING = (
    "struct<STATION_ID: string, STATE_ID: int, STATION_NAME: string, STATION_LOCATION: string, DATETIME: string, API: string>"
)
MATRIX_DOCUMENT = "map<string, array<array<string>>>"
TILE_HEAD = {"type": "string"}
TILE_FEATURE = (
    "struct<id: string, geometry: struct<type: string, coordinates: array<double>>, "
    "properties: struct<country: string, neighborhood: string, type: string, station_name: string>>"
)

# Bronze column -> field of the observation, in bronze column order. `None`: computed.
BRONZE_WEATHER = {
    "datetime": None,
    "class": "class",
    "expire_time_gmt": None,
    "weather_station": None,
    "observation_place": "obs_name",
    "temperature": "temp",
    "min_temperature": "min_temp",
    "max_temperature": "max_temp",
    "feels_like_temperature": "feels_like",
    "pressure": "pressure",
    "pressure_tend": "pressure_tend",
    "pressure_desc": "pressure_desc",
    "wind_speed": "wspd",
    "wind_direction_deg": "wdir",
    "wind_direction_dir": "wdir_cardinal",
    "wind_chill": "wc",
    "gust": "gust",
    "weather_phrase": "wx_phrase",
    "dew_point": "dewPt",
    "relative_humidity": "rh",
    "clouds": "clds",
    "precipitation_total": "precip_total",
    "precipitation_hourly": "precip_hrly",
    "heat_index": "heat_index",
    "uv_description": "uv_desc",
    "uv_index": "uv_index",
    "visibility": "vis",
    "water_temperature": "water_temp",
    "day_indicator": "day_ind",
    "qualifier": "qualifier",
    "qualifier_severity": "qualifier_svrty",
    "blunt_phrase": "blunt_phrase",
    "terse_phrase": "terse_phrase",
    "wx_icon": "wx_icon",
    "icon_extended": "icon_extd",
}
BRONZE_PWS = {
    "datetime": None,
    "weather_station": None,
    "obsTimeUtc": "obsTimeUtc",
    "obsTimeLocal": "obsTimeLocal",
    "lat": "lat",
    "lon": "lon",
    "uv": "uvHigh",
    "solar_radiation_high": "solarRadiationHigh",
    "humidity": "humidityAvg",
    "temperature": "metric.tempAvg",
    "wind_speed": "metric.windspeedAvg",
    "gust": "metric.windgustAvg",
    "dew_point": "metric.dewptAvg",
    "wind_direction": "winddirAvg",
    "wind_chill": "metric.windchillAvg",
    "pressure": None,
    "pressure_trend": "metric.pressureTrend",
    "heat_index": "metric.heatindexAvg",
    "precipitation_rate": "metric.precipRate",
    "precipitation_total": "metric.precipTotal",
    "qc_status": "qcStatus",
}
BRONZE_AIR_QUALITY = ["location", "datetime", "value"]


SEEDS = {
    "state_locations": (
        "Identifying_Location string, Place string, Latitude double, Longitude double, Postcode string, "
        "ICAO string, PWStation string, Missing_Data string, address string"
    ),
    "city_places": "Place string, City string",
    "city_states": "City string, State string",
    "air_quality_indicators": "pollutant string, symbol string, meaning string, unit string",
    "air_quality_warning": "label string, pollutant string, warning_message string, should_report boolean",
    "uv_info": (
        "uv_level int, exposure_category string, short_description string, long_description string"
    ),
}
