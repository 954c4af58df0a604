"""Weather preset: column names, code table, bin edges, rule thresholds.

The operators are generic; this module only supplies their arguments for
the daily-observation layout.
"""

from __future__ import annotations

import math

# ---------------------------------------------------------------------------
# These must equal the source job's values for the
# results to match (labels, codes, thresholds and report texts).
# ---------------------------------------------------------------------------

WEATHER_CODES: dict[int, str] = {
    0: "Despejado",
    1: "Mayormente despejado",
    2: "Parcialmente nublado",
    3: "Nublado",
    45: "Neblina",
    48: "Neblina con escarcha",
    51: "Llovizna leve",
    53: "Llovizna moderada",
    55: "Llovizna intensa",
    61: "Lluvia leve",
    63: "Lluvia moderada",
    65: "Lluvia intensa",
    71: "Nevada leve",
    73: "Nevada moderada",
    75: "Nevada intensa",
    77: "Granizo",
    80: "Chubascos leves",
    81: "Chubascos moderados",
    82: "Chubascos intensos",
    85: "Chubascos de nieve leves",
    86: "Chubascos de nieve intensos",
    95: "Tormenta eléctrica",
    96: "Tormenta con granizo leve",
    99: "Tormenta con granizo intenso",
}
UNKNOWN_CODE_LABEL = "Desconocido"

PRECIPITATION_EDGES = [-0.1, 0.0, 5.0, 20.0, 50.0, math.inf]
PRECIPITATION_LABELS = ["Sin lluvia", "Leve", "Moderada", "Fuerte", "Muy fuerte"]

TEMPERATURE_EDGES = [-math.inf, 0.0, 10.0, 20.0, 30.0, math.inf]
TEMPERATURE_LABELS = ["Muy frío", "Frío", "Templado", "Cálido", "Muy cálido"]

# Quality rules (the rules file of the source job).
RULES = {
    "temperature": {"min": -80.0, "max": 60.0},
    "precipitation": {"min": 0.0, "max": 500.0},
    "wind_speed": {"min": 0.0, "max": 408.0},
    "humidity": {"min": 0.0, "max": 100.0},
    "uv_index": {"min": 0.0, "max": 20.0},
    "required_fields": [
        "date", "city_name", "country_code", "latitude", "longitude",
        "temperature_max", "temperature_min", "precipitation_sum",
    ],
    "thresholds": {"max_null_percentage": 10.0, "max_duplicate_percentage": 1.0},
}

# Check names and report texts, in run order.
CHECK_NAMES = [
    "required_fields", "temperature_range", "precipitation_range",
    "no_future_dates", "no_duplicates", "null_percentage",
    "temperature_consistency",
]
TEXT_REQUIRED_OK = "Todos los campos requeridos presentes"
TEXT_REQUIRED_MISSING = "Columnas faltantes: {missing}"
TEXT_TEMPERATURE_BAD = "Temperaturas fuera de rango [{lo}, {hi}]°C"
TEXT_TEMPERATURE_OK = "Temperaturas en rango válido"
TEXT_PRECIPITATION_BAD = "Precipitación fuera de rango [0, {hi}]mm"
TEXT_PRECIPITATION_OK = "Precipitación en rango válido"
TEXT_FUTURE_BAD = "Fechas futuras detectadas"
TEXT_FUTURE_OK = "Sin fechas futuras"
TEXT_DUPLICATES_BAD = "{n} filas duplicadas encontradas"
TEXT_DUPLICATES_OK = "Sin duplicados"
TEXT_NULLS = "Nulos: {pct}% (máximo permitido: {max_pct}%)"
TEXT_CONSISTENCY_BAD = "temp_min > temp_max en algunas filas"
TEXT_CONSISTENCY_OK = "Temperaturas consistentes (min <= max)"

# Alert thresholds of the daily mart.
HEAVY_RAIN_MM = 20
HEAT_ALERT_C = 35
WIND_ALERT_KMH = 60

# Gauge scales of the conditions panel: humidity, wind, UV, rain.
GAUGE_SCALES = {"humidity_mean": 100, "wind_speed_max": 120,
                "uv_index_max": 12, "precipitation_sum": 50}

# Country code ISO-2 -> ISO-3 for the map view.
ISO2_TO_ISO3 = {
    "MX": "MEX", "GT": "GTM", "SV": "SLV", "HN": "HND", "NI": "NIC", "CR": "CRI",
    "PA": "PAN", "CO": "COL", "VE": "VEN", "EC": "ECU", "PE": "PER", "BO": "BOL",
    "CL": "CHL", "AR": "ARG", "PY": "PRY", "UY": "URY", "BR": "BRA", "CU": "CUB",
    "DO": "DOM", "PR": "PRI", "HT": "HTI", "JM": "JAM",
}

# Extraction window: as_of minus this many days, both ends included.
DAYS_BACK = 7

# ---------------------------------------------------------------------------
# Our own additions (not fixed by the source job): optional range checks over
# the ranges the rules declare but no check reads, and their texts.
# ---------------------------------------------------------------------------

TEXT_RANGE_BAD = "{col} fuera de rango [{lo}, {hi}]"
TEXT_RANGE_OK = "{col} en rango válido"
EXTRA_RANGES = (
    ("wind_speed_range", "wind_speed_max", RULES["wind_speed"]["min"], RULES["wind_speed"]["max"]),
    ("humidity_max_range", "humidity_max", RULES["humidity"]["min"], RULES["humidity"]["max"]),
    ("humidity_min_range", "humidity_min", RULES["humidity"]["min"], RULES["humidity"]["max"]),
    ("uv_index_range", "uv_index_max", RULES["uv_index"]["min"], RULES["uv_index"]["max"]),
)

# ---------------------------------------------------------------------------
# Column layout of the observation rows.
# ---------------------------------------------------------------------------

KEY = ["city_name", "date"]
DIMENSION_COLUMNS = ["city_name", "country", "country_code", "region",
                     "latitude", "longitude", "timezone"]
NUMERIC_COLUMNS = [
    "temperature_max", "temperature_min", "temperature_mean",
    "precipitation_sum", "precipitation_hours",
    "wind_speed_max", "wind_direction",
    "humidity_max", "humidity_min",
    "uv_index_max",
]
ROUNDED_COLUMNS = [
    "temperature_max", "temperature_min", "temperature_mean",
    "precipitation_sum", "wind_speed_max", "uv_index_max",
    "humidity_max", "humidity_min",
]
ZERO_FILL_COLUMNS = ["precipitation_sum", "precipitation_hours"]
OBSERVATION_COLUMNS = (
    ["date"] + DIMENSION_COLUMNS + NUMERIC_COLUMNS
    + ["weather_code", "sunrise", "sunset"]
)
DERIVED_COLUMNS = ["weather_description", "temperature_range", "humidity_mean",
                   "precipitation_category", "temperature_category"]

# Raw variable name -> observation column (parallel arrays of the payload).
RAW_VARIABLES = {
    "temperature_2m_max": "temperature_max",
    "temperature_2m_min": "temperature_min",
    "temperature_2m_mean": "temperature_mean",
    "precipitation_sum": "precipitation_sum",
    "precipitation_hours": "precipitation_hours",
    "wind_speed_10m_max": "wind_speed_max",
    "wind_direction_10m_dominant": "wind_direction",
    "relative_humidity_2m_max": "humidity_max",
    "relative_humidity_2m_min": "humidity_min",
    "uv_index_max": "uv_index_max",
    "weather_code": "weather_code",
    "sunrise": "sunrise",
    "sunset": "sunset",
}
