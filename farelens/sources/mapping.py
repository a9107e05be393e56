"""Maps the TPC-H-like test tables onto the raw fare model.

The reference's own CSV is not shipped, so correctness runs on a view of the
driver tables shaped like it: one row per lineitem, with deliberate defects
keyed on ``l_orderkey % 1009`` and a 1.20x uplift on ``l_orderkey % 23 = 0``.
``l_orderkey`` and ``l_linenumber`` ride along as lineage columns; the pair is
not unique, so it is not a row id.

Join order is chosen for size: orders (1/4 of lineitem) meets customer first,
then the result meets lineitem once on the order key. How they are joined is
left to adaptive execution: it broadcasts a side only when its measured size is
under ``spark.sql.adaptive.autoBroadcastJoinThreshold``, and splits skewed
partitions of a shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from farelens.functions.exprs import with_columns_once
from farelens.model import CSV_COLUMN_MAP
from farelens.sources.csv import plain_file_name

TPCH_TABLES = ("lineitem", "orders", "customer", "supplier", "part")

# Defect codes carried by d = l_orderkey % 1009 (fixed values of the mapping).
DEFECT_MODULUS = 1009
D_NULL_AIRLINE = 1
D_BLANK_AIRLINE = 2
D_MALFORMED_SOURCE = 3
D_NULL_DESTINATION = 4
D_NEGATIVE_BASE = 5
D_NULL_TOTAL = 6
D_MISMATCH = 7
D_ARRIVAL_FIRST = 8
D_ZERO_DURATION = 9
D_NEGATIVE_DAYS = 10
D_UNTIDY_SOURCE = 11
D_NULL_SOURCE = 12
D_NULL_BASE = 13
D_NULL_TAX = 14
D_NEGATIVE_TAX = 15
D_NEGATIVE_TOTAL = 16
D_BLANK_SOURCE = 17
D_MALFORMED_DESTINATION = 18
D_UNTIDY_TEXT = 19
D_UNKNOWN_SEASON = 20
D_NULL_SEASON = 21
D_NULL_DAYS = 22
D_UNTIDY_SEASON = 24
# Defects that only text can carry (``text_from_tpch``): column -> text by code.
TEXT_DEFECTS = {
    "base_fare_bdt": {41: "abc", 42: "1.0d"},
    "tax_surcharge_bdt": {43: "n/a", 44: "12,5"},
    "total_fare_bdt": {45: "x1"},
    "duration_hrs": {46: "1.5f", 47: "NaN"},
    "seasonality": {48: "NA", 49: " null "},
    "days_before_departure": {50: "-3.0", 51: "14.0", 52: "14.7", 57: "1e1"},
    "departure_datetime": {53: "some day"},
    "airline": {55: "None"},
}
D_OTHER_TIME_FORMAT = 54
TEXT_TIME_FORMAT = "MM/dd/yyyy HH:mm"
UPLIFT_MODULUS = 23
SAME_NATION_BYPASS_MODULUS = 7
N_NATIONS = 25
TAX_FLOOR = 200
MISMATCH_OFFSET = 50


def read_tables(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TPCH_TABLES}


def _nation_code(nation: Column, first_letter: int) -> Column:
    """Three-letter code for a nation key: a fixed lead letter and two letters
    from the key in base 5 (``chr(first + key // 5)``, ``chr(first + key % 5)``)."""
    return F.concat(
        F.chr(F.lit(first_letter) + F.floor(nation / F.lit(5.0)).cast("int")),
        F.chr(F.lit(first_letter) + nation % 5),
    )


def _dec(c: Column, p: int, s: int) -> Column:
    return c.cast(T.DecimalType(p, s))


def _fares(lines: DataFrame, once: bool) -> DataFrame:
    """The three fares of each lineitem row, all from its own columns.

    ``once``: for frames whose rows are filtered on the fares. Every rule on
    them would otherwise convert price, discount and tax to decimals anew.
    """
    add = with_columns_once if once else DataFrame.withColumns
    price = _dec(F.col("l_extendedprice"), 10, 2)
    lines = add(lines, {
        "_base": _dec(price * _dec(F.lit(1) - F.col("l_discount"), 4, 2), 14, 4),
        "_tax": F.greatest(_dec(F.lit(TAX_FLOOR), 14, 4), _dec(price * _dec(F.col("l_tax"), 4, 2), 14, 4)),
    })
    d, base0, tax0 = F.col("l_orderkey") % DEFECT_MODULUS, F.col("_base"), F.col("_tax")
    return add(lines, {
        "l_discounted_fare": _dec(F.when(d == D_NULL_BASE, F.lit(None)).when(d == D_NEGATIVE_BASE, -base0).otherwise(base0), 14, 4),
        "l_tax_fare": _dec(F.when(d == D_NULL_TAX, F.lit(None)).when(d == D_NEGATIVE_TAX, -tax0).otherwise(tax0), 14, 4),
        "l_total_fare": _dec(
            F.when(d == D_NULL_TOTAL, F.lit(None))
            .when(d == D_MISMATCH, base0 + tax0 + MISMATCH_OFFSET)
            .when(d == D_NEGATIVE_TOTAL, -(base0 + tax0))
            .when(F.col("l_orderkey") % UPLIFT_MODULUS == 0, (base0 + tax0) * F.lit(1.2).cast("decimal(2,1)"))
            .otherwise(base0 + tax0),
            14, 4,
        ),
    }).drop("_base", "_tax", "l_extendedprice", "l_discount", "l_tax")


def raw_from_tpch(spark: SparkSession, sf_dir: str, once: bool = False) -> DataFrame:
    """Raw fare rows (typed, staging names) derived from the driver tables.

    ``once`` works out the fares, airline and codes once a row, also where nothing
    reads them: for frames whose rows are filtered on them.
    """
    t = read_tables(spark, sf_dir)
    li = t["lineitem"].select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
        "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
        plain_file_name().alias("_source_file"),
    )
    li = _fares(li, once)
    orders = t["orders"].select("o_orderkey", "o_custkey", "o_orderdate", "o_orderpriority")
    cust = t["customer"].select("c_custkey", "c_nationkey")
    supp = t["supplier"].select("s_suppkey", "s_nationkey")
    part = t["part"].select("p_partkey", "p_brand", "p_type", "p_size")

    order_side = orders.join(cust, orders.o_custkey == cust.c_custkey)
    j = (
        li.join(order_side, li.l_orderkey == order_side.o_orderkey)
        .join(supp, li.l_suppkey == supp.s_suppkey)
        .join(part, li.l_partkey == part.p_partkey)
    )

    d = F.col("l_orderkey") % DEFECT_MODULUS
    a = F.col("s_nationkey")
    b = F.when(
        (F.col("s_nationkey") == F.col("c_nationkey"))
        & (F.col("l_orderkey") % SAME_NATION_BYPASS_MODULUS != 0),
        (F.col("c_nationkey") + 1) % N_NATIONS,
    ).otherwise(F.col("c_nationkey"))
    days0 = F.abs(F.datediff(F.col("l_shipdate"), F.col("o_orderdate"))) % 90
    shift = F.col("p_size") * 15
    month = F.month("l_shipdate")

    upper_code = F.concat(F.lit("N"), _nation_code(a, 65))
    untidy_code = F.concat(F.lit(" n"), _nation_code(a, 97), F.lit(" "))

    add = with_columns_once if once else DataFrame.withColumns
    j = add(j, {
        "airline": F.when(d == D_NULL_AIRLINE, F.lit(None).cast("string"))
        .when(d == D_BLANK_AIRLINE, F.lit("   "))
        .when(d == D_UNTIDY_TEXT, F.concat(F.lit("\t"), F.col("p_brand"), F.lit("\u00a0 ")))
        .otherwise(F.col("p_brand")),
        "source": F.when(d == D_MALFORMED_SOURCE, F.lit("DHAKA"))
        .when(d == D_UNTIDY_SOURCE, untidy_code)
        .when(d == D_NULL_SOURCE, F.lit(None).cast("string"))
        .when(d == D_BLANK_SOURCE, F.lit("\t "))
        .otherwise(upper_code),
        "destination": F.when(d == D_NULL_DESTINATION, F.lit(None).cast("string"))
        .when(d == D_MALFORMED_DESTINATION, F.lit("C9P"))
        .otherwise(F.concat(F.lit("N"), _nation_code(b, 65))),
    })
    return j.select(
        "l_orderkey",
        "l_linenumber",
        "airline",
        "source",
        F.concat(F.lit("NATION_"), a.cast("string"), F.when(d == D_UNTIDY_TEXT, F.lit("  ")).otherwise(F.lit(""))).alias("source_name"),
        "destination",
        F.concat(F.lit("NATION_"), b.cast("string")).alias("destination_name"),
        F.col("l_shipdate").alias("departure_datetime"),
        F.when(d == D_ARRIVAL_FIRST, F.timestamp_add("MINUTE", -shift, F.col("l_shipdate")))
        .otherwise(F.timestamp_add("MINUTE", shift, F.col("l_shipdate"))).alias("arrival_datetime"),
        F.when(d == D_ZERO_DURATION, F.lit(0.0))
        .otherwise(F.col("p_size") * F.lit(0.25)).cast("double").alias("duration_hrs"),
        F.when(F.col("l_linestatus") == "O", F.lit("Direct")).otherwise(F.lit("1 Stop")).alias("stopovers"),
        F.col("p_type").alias("aircraft_type"),
        F.when(F.col("l_returnflag") == "A", F.lit("Economy"))
        .when(F.col("l_returnflag") == "N", F.lit("Business"))
        .otherwise(F.lit("First Class")).alias("flight_class"),
        F.col("o_orderpriority").alias("booking_source"),
        F.col("l_discounted_fare").alias("base_fare_bdt"),
        F.col("l_tax_fare").alias("tax_surcharge_bdt"),
        F.col("l_total_fare").alias("total_fare_bdt"),
        F.when(d == D_UNKNOWN_SEASON, F.lit("Puja"))
        .when(d == D_NULL_SEASON, F.lit(None).cast("string"))
        .when(d == D_UNTIDY_SEASON, F.lit(" Eid\t"))
        .when(month.isin(12, 1), F.lit("Winter Holidays"))
        .when(month == 4, F.lit("Eid"))
        .when(month == 6, F.lit("Hajj"))
        .otherwise(F.lit("Regular")).alias("seasonality"),
        F.when(d == D_NEGATIVE_DAYS, F.lit(-1)).when(d == D_NULL_DAYS, F.lit(None)).otherwise(days0).cast("int").alias("days_before_departure"),
        "_source_file",
    )


def text_from_tpch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as a CSV would bring them: every cell text under the source
    headers, with defects that only text can have."""
    raw = raw_from_tpch(spark, sf_dir)
    d = F.col("l_orderkey") % DEFECT_MODULUS
    cells = []
    for header, name in CSV_COLUMN_MAP.items():
        cell = F.col(name).cast("string")
        for code, text in TEXT_DEFECTS.get(name, {}).items():
            cell = F.when(d == code, F.lit(text)).otherwise(cell)
        if name == "departure_datetime":
            cell = F.when(d == D_OTHER_TIME_FORMAT, F.date_format(name, TEXT_TIME_FORMAT)).otherwise(cell)
        cells.append(cell.alias(header))
    return raw.select("l_orderkey", "l_linenumber", *cells, "_source_file")
