"""Hand-made frames for the unit tests: invented carriers, places and amounts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import types as T

from farelens.model import FARE_TYPE, STAGED_TYPES

REQUIRED = ["airline", "source", "destination", "base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt"]
STAGED_COLUMNS = list(STAGED_TYPES)

#: A row that no rule objects to, as text; parts and total agree to the paisa.
SOUND = {
    "airline": "Kite Air", "source": "QAA", "source_name": "Quay North", "destination": "QBB", "destination_name": "Quay South",
    "departure_datetime": "2031-07-09 22:40:00", "arrival_datetime": "2031-07-10 01:10:00", "duration_hrs": "2.5",
    "stopovers": "2 Stops", "aircraft_type": "T-70", "flight_class": "Premium", "booking_source": "Desk",
    "base_fare_bdt": "640.50", "tax_surcharge_bdt": "59.50", "total_fare_bdt": "700.00",
    "seasonality": "Regular", "days_before_departure": "33", "_source_file": "kites.csv",
}


def text_rows(spark, rows, columns=None):
    """Rows given as changes to ``SOUND``, every cell text, None NULL."""
    columns = columns or [*STAGED_COLUMNS, "_source_file"]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.createDataFrame([tuple((SOUND | change).get(c) for c in columns) for change in rows], schema)


FACT_ROW = {"airline": "Kite Air", "source": "QAA", "destination": "QBB", "base": 640.5, "tax": 59.5, "total": 700, "season": "Regular", "peak": False}


def fact_rows(spark, rows):
    """Fact rows as changes to ``FACT_ROW``; the route follows from the codes."""
    fare = lambda x: None if x is None else Decimal(str(x))
    data = []
    for change in rows:
        r = FACT_ROW | change
        route = None if r["source"] is None or r["destination"] is None else f"{r['source']}-{r['destination']}"
        data.append((r["airline"], r["source"], r["destination"], r.get("route", route), fare(r["base"]), fare(r["tax"]), fare(r["total"]), r["season"], r["peak"]))
    names = ["airline", "source", "destination", "route", "base_fare_bdt", "tax_surcharge_bdt", "total_fare_bdt", "seasonality", "is_peak_season"]
    kinds = [T.StringType()] * 4 + [FARE_TYPE] * 3 + [T.StringType(), T.BooleanType()]
    return spark.createDataFrame(data, T.StructType([T.StructField(n, k) for n, k in zip(names, kinds, strict=True)]))


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
