"""Names, texts, limits and lookups that messages and tables must carry exactly."""

# --- fixed values: message fields -------------------------------------------------------------
# wire name -> internal column, in the order in which fields are checked
REQUIRED_FIELDS = {
    "Location": "location",
    "Date_Time": "date_time",
    "Temperature_C": "temperature_c",
    "Humidity_pct": "humidity_pct",
    "Precipitation_mm": "precipitation_mm",
    "Wind_Speed_kmh": "wind_speed_kmh",
}
FLOAT_FIELDS = ("Temperature_C", "Humidity_pct", "Precipitation_mm", "Wind_Speed_kmh")

# --- fixed values: topics and envelopes -------------------------------------------------------
TOPIC_READINGS = "weather-data"
TOPIC_RETRY = "retry-data"
TOPIC_ERRORS = "error-data"
UNKNOWN_LOCATION = "unknown"
MISSING_FIELD = "MISSING_FIELD"
TYPE_ERROR = "TYPE_ERROR"
RETRY_FAILED = "CONSUMER3_RETRY_FAIL"
RETRY_FAILED_FILE = "processed_by_consumer3"
CHAOS_REASON = "Intentional Chaos Error (Simulated Failure)"
STATUS_NEW = "NEW"

# --- fixed values: limits ---------------------------------------------------------------------
WINDOW = "60 seconds"
WATERMARK = "2 minutes"
COOLDOWN_MINUTES = 30
DIVERT_RATE = 0.2
RETRY_FAIL_RATE = 0.01
ARCHIVE_ROWS_PER_FILE = 2000
ARCHIVE_TRIGGER = "60 seconds"
OUTBOX_BATCH = 10
SLICE_SECONDS = 60
TOPIC_PARTITIONS = 10

# --- fixed values: alert thresholds -----------------------------------------------------------
ALERT_THRESHOLDS = {"TEMP_HIGH": 35.0, "TEMP_LOW": 0.0, "RAIN_HEAVY": 30.0, "WIND_STRONG": 40.0}
RETRY_THRESHOLDS = {"TEMP_HIGH": 31.0, "TEMP_LOW": -10.0, "RAIN_HEAVY": 11.0, "WIND_STRONG": 35.0}
RETRY_DEFAULTS = {"Temperature_C": -999.0, "Precipitation_mm": 0.0, "Wind_Speed_kmh": 0.0}

# --- fixed values: alert texts ----------------------------------------------------------------
ALERT_EMOJI = {"TEMP_HIGH": "🔥", "TEMP_LOW": "❄️", "RAIN_HEAVY": "🌧️", "WIND_STRONG": "💨"}
DEFAULT_EMOJI = "⚠️"

# --- fixed values: location -> topic partition ------------------------------------------------
REGION_PARTITIONS = {
    "Phoenix": 0,
    "Houston": 1,
    "Los Angeles": 2,
    "San Antonio": 3,
    "San Diego": 4,
    "Dallas": 5,
    "Philadelphia": 6,
    "San Jose": 7,
    "Chicago": 8,
    "New York": 9,
}
