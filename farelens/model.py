"""Schemas and fixed values of the fare model.

Everything here is data, not behaviour: the CSV header map, the column groups
the rules iterate over, the output table layouts and the business constants.
"""

from __future__ import annotations

from pyspark.sql import types as T

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's for identical results.
# ---------------------------------------------------------------------------

# Raw CSV header -> staging column, in source order.
CSV_COLUMN_MAP: dict[str, str] = {
    "Airline": "airline",
    "Source": "source",
    "Source Name": "source_name",
    "Destination": "destination",
    "Destination Name": "destination_name",
    "Departure Date & Time": "departure_datetime",
    "Arrival Date & Time": "arrival_datetime",
    "Duration (hrs)": "duration_hrs",
    "Stopovers": "stopovers",
    "Aircraft Type": "aircraft_type",
    "Class": "flight_class",
    "Booking Source": "booking_source",
    "Base Fare (BDT)": "base_fare_bdt",
    "Tax & Surcharge (BDT)": "tax_surcharge_bdt",
    "Total Fare (BDT)": "total_fare_bdt",
    "Seasonality": "seasonality",
    "Days Before Departure": "days_before_departure",
}

REQUIRED_COLUMNS = (
    "airline",
    "source",
    "destination",
    "base_fare_bdt",
    "tax_surcharge_bdt",
    "total_fare_bdt",
)
NOT_NULL_COLUMNS = REQUIRED_COLUMNS
NUMERIC_COLUMNS = ("base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt", "duration_hrs")
FARE_COLUMNS = ("base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt")
NON_EMPTY_STRING_COLUMNS = ("airline", "source", "destination")
CODE_COLUMNS = ("source", "destination")
DATETIME_COLUMNS = ("departure_datetime", "arrival_datetime")

AIRPORT_CODE_PATTERN = r"\A[A-Z]{3}\z"  # three letters, whole string
FARE_RECONCILIATION_TOLERANCE = "0.01"  # absolute BDT, compared as an exact decimal
KNOWN_FARE_UPLIFT_FACTOR = 1.20
FARE_UPLIFT_RELATIVE_TOLERANCE = 1e-6
FARE_UPLIFT_ABSOLUTE_TOLERANCE = 1e-8  # default absolute term of an isclose test
SQL_UPLIFT_TOLERANCE = 0.000001  # the inspection query's plain absolute bound
MIN_VALID_ROW_RATIO = 0.95
BASELINE_SEASON = "Regular"
PEAK_SEASONS = ("Eid", "Hajj", "Winter Holidays")
TOP_N_ROUTES = 20
TAX_FLOOR_BDT = 200

# Spellings read as missing by the pandas CSV reader (its documented default
# ``na_values`` list), so a CSV read here labels the same cells as missing.
NA_STRINGS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None",
    "n/a", "nan", "null",
)

# Lead-time buckets: (upper bound in days, label); rows above the last bound
# fall into OPEN_LEAD_TIME_BUCKET.
LEAD_TIME_BUCKETS = (
    (7, "1. 0-7 days"),
    (14, "2. 8-14 days"),
    (30, "3. 15-30 days"),
    (60, "4. 31-60 days"),
)
OPEN_LEAD_TIME_BUCKET = "5. 61+ days"

FARE_CASE_EXACT = "reconciles exactly"
FARE_CASE_UPLIFT = "known 1.20x uplift"
FARE_CASE_MISMATCH = "unexplained mismatch"

# Output table names.
STAGING_TABLE = "stg_flight_prices"
FACT_TABLE = "flight_prices"
KPI_AVERAGE_FARE_TABLE = "kpi_average_fare_by_airline"
KPI_SEASONAL_VARIATION_TABLE = "kpi_seasonal_fare_variation"
KPI_BOOKING_COUNT_TABLE = "kpi_booking_count_by_airline"
KPI_POPULAR_ROUTES_TABLE = "kpi_popular_routes"
KPI_TABLES = (
    KPI_AVERAGE_FARE_TABLE,
    KPI_SEASONAL_VARIATION_TABLE,
    KPI_BOOKING_COUNT_TABLE,
    KPI_POPULAR_ROUTES_TABLE,
)
REPORT_FILENAME = "data_quality_report.json"

# Fact table columns, in order.
FACT_COLUMNS = (
    "airline",
    "source",
    "source_name",
    "destination",
    "destination_name",
    "departure_datetime",
    "arrival_datetime",
    "duration_hrs",
    "stopovers",
    "aircraft_type",
    "flight_class",
    "booking_source",
    "base_fare_bdt",
    "tax_surcharge_bdt",
    "total_fare_bdt",
    "seasonality",
    "days_before_departure",
    "route",
    "is_peak_season",
    "has_fare_uplift",
    "_source_file",
)

# Free-text columns trimmed by the cleaning step (codes are handled apart).
TEXT_COLUMNS = (
    "airline",
    "source_name",
    "destination_name",
    "stopovers",
    "aircraft_type",
    "flight_class",
    "booking_source",
    "seasonality",
)

# ---------------------------------------------------------------------------
# Spark types
# ---------------------------------------------------------------------------

FARE_TYPE = T.DecimalType(14, 4)

# Typed staging columns (the CSV is read as strings and converted to these).
STAGED_TYPES: dict[str, T.DataType] = {
    "airline": T.StringType(),
    "source": T.StringType(),
    "source_name": T.StringType(),
    "destination": T.StringType(),
    "destination_name": T.StringType(),
    "departure_datetime": T.TimestampNTZType(),
    "arrival_datetime": T.TimestampNTZType(),
    "duration_hrs": T.DoubleType(),
    "stopovers": T.StringType(),
    "aircraft_type": T.StringType(),
    "flight_class": T.StringType(),
    "booking_source": T.StringType(),
    "base_fare_bdt": FARE_TYPE,
    "tax_surcharge_bdt": FARE_TYPE,
    "total_fare_bdt": FARE_TYPE,
    "seasonality": T.StringType(),
    "days_before_departure": T.IntegerType(),
}

# Declared lengths of the staging layout's text columns, in characters.
STAGED_LENGTHS: dict[str, int] = {
    "airline": 100,
    "source": 10,
    "source_name": 255,
    "destination": 10,
    "destination_name": 255,
    "stopovers": 50,
    "aircraft_type": 100,
    "flight_class": 50,
    "booking_source": 50,
    "seasonality": 50,
    "_source_file": 255,
}

FACT_SCHEMA = T.StructType(
    [T.StructField(c, STAGED_TYPES[c]) for c in FACT_COLUMNS[:17]]
    + [
        T.StructField("route", T.StringType()),
        T.StructField("is_peak_season", T.BooleanType(), False),
        T.StructField("has_fare_uplift", T.BooleanType(), False),
        T.StructField("_source_file", T.StringType()),
    ]
)

# KPI table layouts (column name -> type), in table order.
KPI_SCHEMAS: dict[str, T.StructType] = {
    KPI_AVERAGE_FARE_TABLE: T.StructType([
        T.StructField("airline", T.StringType(), False),
        T.StructField("average_base_fare", T.DoubleType()),
        T.StructField("average_tax_charge", T.DoubleType()),
        T.StructField("average_total_fare", T.DoubleType()),
        T.StructField("min_total_fare", T.DoubleType()),
        T.StructField("max_total_fare", T.DoubleType()),
        T.StructField("flight_count", T.LongType(), False),
    ]),
    KPI_SEASONAL_VARIATION_TABLE: T.StructType([
        T.StructField("seasonality", T.StringType(), False),
        T.StructField("is_peak_season", T.BooleanType()),
        T.StructField("average_total_fare", T.DoubleType()),
        T.StructField("flight_count", T.LongType(), False),
        T.StructField("variation_vs_baseline_pct", T.DoubleType()),
    ]),
    KPI_BOOKING_COUNT_TABLE: T.StructType([
        T.StructField("airline", T.StringType(), False),
        T.StructField("booking_count", T.LongType(), False),
        T.StructField("booking_share_pct", T.DoubleType()),
    ]),
    KPI_POPULAR_ROUTES_TABLE: T.StructType([
        T.StructField("route", T.StringType(), False),
        T.StructField("source", T.StringType(), False),
        T.StructField("destination", T.StringType(), False),
        T.StructField("booking_count", T.LongType(), False),
        T.StructField("average_total_fare", T.DoubleType()),
        T.StructField("rank_position", T.IntegerType()),
    ]),
}


class SchemaValidationError(Exception):
    """The input is structurally unusable (missing columns, no rows)."""


class QualityGateError(ValueError):
    """Too few rows passed validation for the run to continue."""
