"""Explicit read schemas for the raw inputs of the travel / climate jobs.

Columns are read by name with these types; CSV columns arrive as strings and
are typed once by the jobs. Names follow the public I-94 data dictionary.
"""

from pyspark.sql.types import (
    DateType, DoubleType, IntegerType, LongType, StringType, StructField, StructType,
)


def _strings(*names: str) -> StructType:
    return StructType([StructField(n, StringType()) for n in names])


AIRPORT_CODES = _strings(
    "ident", "type", "name", "elevation_ft", "continent", "iso_country",
    "iso_region", "municipality", "gps_code", "iata_code", "local_code", "coordinates",
)

CODE_BOOK = _strings("code", "value")

GLOBAL_CITY_TEMPERATURES = _strings(
    "dt", "AverageTemperature", "AverageTemperatureUncertainty", "City", "Country",
    "Latitude", "Longitude",
)

US_CITIES_SIMPLEMAP = _strings("city", "state_id", "state_name", "lat", "lng")

# The public field names in the data's order.
# Raw monthly entry records; numerics are doubles in the monthly parquet files.
RAW_ENTRIES = StructType([
    StructField("cicid", DoubleType()), StructField("i94yr", DoubleType()),
    StructField("i94mon", DoubleType()), StructField("i94cit", DoubleType()),
    StructField("i94res", DoubleType()), StructField("i94port", StringType()),
    StructField("arrdate", DoubleType()), StructField("i94mode", DoubleType()),
    StructField("i94addr", StringType()), StructField("depdate", DoubleType()),
    StructField("i94bir", DoubleType()), StructField("i94visa", DoubleType()),
    StructField("count", DoubleType()), StructField("dtadfile", StringType()),
    StructField("visapost", StringType()), StructField("occup", StringType()),
    StructField("entdepa", StringType()), StructField("entdepd", StringType()),
    StructField("entdepu", StringType()), StructField("matflag", StringType()),
    StructField("biryear", DoubleType()), StructField("dtaddto", StringType()),
    StructField("gender", StringType()), StructField("insnum", StringType()),
    StructField("airline", StringType()), StructField("admnum", DoubleType()),
    StructField("fltno", StringType()), StructField("visatype", StringType()),
])

# The names and order of the cleaned fact table (one row per cicid).
ENTRY_FACT = StructType([
    StructField("cicid", LongType()), StructField("admission_number", LongType()),
    StructField("i94port_city_code", StringType()), StructField("destination_state_code", StringType()),
    StructField("allow_to_stay_date", StringType()), StructField("airline_code", StringType()),
    StructField("flight_number", StringType()), StructField("visa_type", StringType()),
    StructField("arrival_date", DateType()), StructField("departure_date", DateType()),
    StructField("add_to_file_date", DateType()), StructField("entry_year", IntegerType()),
    StructField("entry_month", IntegerType()), StructField("citizenship_of_country_id", IntegerType()),
    StructField("resident_of_country_id", IntegerType()), StructField("visa_category_id", IntegerType()),
    StructField("entry_mode_id", IntegerType()), StructField("age", IntegerType()),
])

PORT_DIM = _strings("i94port_code", "city", "state_code", "state_name")

MONTHLY_TEMPERATURE = StructType([
    StructField("city", StringType()), StructField("state_id", StringType()),
    StructField("month", IntegerType()), StructField("average_temperature", DoubleType()),
])
