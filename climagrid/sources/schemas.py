"""The schemas of the raw and trusted zones."""

from pyspark.sql import types as T

_DAYS = T.ArrayType(T.StringType())
_MEASURES = T.ArrayType(T.DoubleType())

WEATHER_DOCUMENT = (
    T.StructType()
    .add("latitude", "double")
    .add("longitude", "double")
    .add("generationtime_ms", "double")
    .add("utc_offset_seconds", "integer")
    .add("timezone", "string")
    .add("timezone_abbreviation", "string")
    .add("elevation", "double")
    .add(
        "daily_units",
        T.StructType()
        .add("time", "string")
        .add("temperature_2m_max", "string")
        .add("precipitation_sum", "string"),
    )
    .add(
        "daily",
        T.StructType()
        .add("time", _DAYS)
        .add("temperature_2m_max", _MEASURES)
        .add("precipitation_sum", _MEASURES),
    )
)

LOCATION_COLUMNS = (
    "location_id",
    "city_name",
    "country",
    "latitude",
    "longitude",
    "population",
    "elevation",
    "average_tourism_visits_per_year",
)
# All text as in the file; prepare_locations casts.
LOCATION_CSV = T.StructType([T.StructField(c, T.StringType()) for c in LOCATION_COLUMNS])

OBSERVATION = (
    T.StructType()
    .add("weather_date", "date")
    .add("location_id", "integer")
    .add("city_name", "string")
    .add("country", "string")
    .add("max_temp_c", "double")
    .add("precipitation_mm", "double")
    .add("population", "integer")
    .add("elevation", "double")
)
OBSERVATION_COLUMNS = OBSERVATION.fieldNames()
