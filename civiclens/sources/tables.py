"""Raw service requests derived from the order tables.

No given table holds service requests, so the engine's input is a projection of
``lineitem`` ⋈ ``orders`` ⋈ ``customer``: one request per order line, with text, blank,
padded, NULL and malformed values in the places where real feeds have them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Request types with their short codes, and departments, by position.
REQUEST_TYPES = (
    ("311 INFORMATION ONLY CALL", "311IOC"),
    ("Aircraft Noise Complaint", "AVN"),
    ("Graffiti Removal Request", "GRAF"),
    ("Pothole in Street Complaint", "PHF"),
    ("Street Light Out Complaint", "SFD"),
    ("Rodent Baiting/Rat Complaint", "SGA"),
    ("Garbage Cart Maintenance", "SIE"),
    ("Abandoned Vehicle Complaint", "SKA"),
    ("Tree Emergency", "SEL"),
    ("Water Lead Test Kit Request", "AAE"),
    ("Building Violation", "BBA"),
    ("Sanitation Code Violation", "SCB"),
    ("Gas Leak Hazard", None),
    (" Pothole in Street Complaint ", "PHF"),
    ("   ", "UNKX"),
    (None, None),
)
DEPARTMENTS = (
    "CDOT - Department of Transportation",
    "Streets and Sanitation",
    "Aviation",
    "DOB - Buildings",
    "311 City Services",
    "DWM - Department of Water Management",
    "Health",
    "OEMC",
    None,
    " ",
)


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _pick(values: tuple[str | None, ...], position: Column) -> Column:
    return F.get(F.array(*[F.lit(v).cast("string") for v in values]), position.cast("int"))


def _iso(timestamp: Column) -> Column:
    text = timestamp.cast("string")
    return F.concat(F.substring(text, 1, 10), F.lit("T"), F.substring(text, 12, 8), F.lit(".000"))


def _number(value: Column) -> Column:
    return value.cast("string")


def _unless(condition: Column, value: Column) -> Column:
    return F.when(~condition, value)


def raw_requests(spark: SparkSession, folder: str) -> DataFrame:
    """The 39 raw columns; ``location`` is the last."""
    lines = read_table(spark, folder, "lineitem")
    orders = read_table(spark, folder, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"
    )
    customers = read_table(spark, folder, "customer").select("c_custkey", "c_nationkey")

    col = F.col
    start = (col("l_partkey") * 7 + col("l_suppkey")) % 1440
    shift = start + col("l_quantity").cast("int") * 997 - 2400
    # Lines are shuffled once, by order and as what the columns need of them: orders meet their customers first, so a hot
    # customer moves no lines, and adaptive execution splits a hot order. A merge join also spreads a table of few row
    # groups, which a broadcast would leave to few tasks.
    narrow = lines.select(
        "l_orderkey", "l_linenumber",
        (col("l_partkey") % len(REQUEST_TYPES)).cast("int").alias("kind"),
        (col("l_suppkey") % len(DEPARTMENTS)).cast("int").alias("owner"),
        _unless(
            col("l_suppkey") % 5 < 2, (col("l_partkey") + col("l_suppkey")) % len(DEPARTMENTS)
        ).cast("int").alias("creator"),
        (col("l_discount") == 0.0).alias("duplicate"),
        (col("l_tax") == 0.0).alias("legacy"),
        ((col("l_returnflag") == "A") & (col("l_linestatus") == "O")).alias("unclosed"),
        (col("l_shipdate") + F.make_dt_interval(mins=start.cast("int"))).alias("created_ts"),
        (col("l_shipdate") + F.make_dt_interval(mins=shift.cast("int"))).alias("changed_ts"),
    )
    placed = orders.join(customers, col("o_custkey") == col("c_custkey")).select(
        "o_orderkey", "o_orderstatus", "o_orderpriority", "c_custkey", "c_nationkey",
        (col("c_custkey") % 400).cast("int").alias("a"),
    )
    base = narrow.hint("merge").join(placed, col("l_orderkey") == col("o_orderkey")).withColumns({"created": _iso(col("created_ts")), "changed": _iso(col("changed_ts"))})

    a, order_text = col("a"), _number(col("l_orderkey"))
    kind = col("kind")
    unplaced = a % 13 == 0
    latitude = _unless(unplaced, F.concat(F.lit("41."), _number(a % 50 * 4217 + 600000)))
    longitude = _unless(unplaced, F.concat(F.lit("-87."), _number(a % 50 * 7211 + 500000)))
    return base.select(
        F.concat(F.lit("SR"), order_text, F.lit("-"), _number(col("l_linenumber"))).alias("sr_number"),
        _pick(tuple(t for t, _ in REQUEST_TYPES), kind).alias("sr_type"),
        _pick(tuple(c for _, c in REQUEST_TYPES), kind).alias("sr_short_code"),
        _pick(DEPARTMENTS, col("owner")).alias("owner_department"),
        _pick(DEPARTMENTS, col("creator")).alias("created_department"),
        F.when(col("o_orderstatus") == "F", "Completed")
        .when(col("o_orderstatus") == "O", "Open")
        .otherwise("Canceled")
        .alias("status"),
        F.when(col("o_orderpriority") == "1-URGENT", "Phone Call")
        .when(col("o_orderpriority") == "2-HIGH", "Internet")
        .when(col("o_orderpriority") == "3-MEDIUM", "Mobile Device")
        .when(col("o_orderpriority") == "5-LOW", "")
        .alias("origin"),
        col("created").alias("created_date"),
        col("changed").alias("last_modified_date"),
        _unless(col("unclosed"), col("changed")).alias("closed_date"),
        _unless(a % 11 == 0, F.concat(_number(a % 50 + 100), F.lit(" W ADDISON ST"))).alias("street_address"),
        _unless(a % 3 == 0, F.lit("CHICAGO")).alias("city"),
        _unless(a % 3 == 0, F.lit("IL")).alias("state"),
        _unless(a % 15 == 0, _number(col("c_nationkey") + 60600)).alias("zip_code"),
        _unless(a % 11 == 0, _number(a % 50 + 100)).alias("street_number"),
        F.when(a % 11 == 0, " ").otherwise("W").alias("street_direction"),
        _unless(a % 22 == 0, F.lit("ADDISON")).alias("street_name"),
        F.when(a % 9 == 0, "").otherwise("ST").alias("street_type"),
        col("duplicate"),
        col("legacy").alias("legacy_record"),
        F.when(col("legacy"), F.concat(F.lit("CSR-"), order_text)).alias("legacy_sr_number"),
        F.when(
            col("l_linenumber") >= 6, F.concat(F.lit("SR"), order_text, F.lit("-1"))
        ).alias("parent_sr_number"),
        _unless(a % 17 == 0, _number(a % 77 + 1)).alias("community_area"),
        F.when(a % 54 == 51, "")
        .when(a % 54 == 52, "x")
        .when(a % 54 == 53, " 7 ")
        .when(a % 54 != 0, _number(a % 54))
        .alias("ward"),
        _unless(a % 4 == 0, _number(a % 29)).alias("electrical_district"),
        _unless(a % 6 == 0, F.concat(F.lit("F0"), _number(a % 20))).alias("electricity_grid"),
        _number(a % 3).alias("police_sector"),
        _unless(a % 17 == 0, _number(a % 25 + 1)).alias("police_district"),
        F.concat(
            _number(a % 40 + 1700), F.when(col("l_linenumber") == 7, " ").otherwise("")
        ).alias("police_beat"),
        F.when(col("c_custkey") % 8 == 0, "").otherwise(_number(col("c_custkey") % 61)).alias("precinct"),
        F.when(a % 5 == 0, "Thursday")
        .when(a % 5 == 1, "MON")
        .when(a % 5 == 2, "Monday")
        .alias("sanitation_division_days"),
        F.substring("created", 12, 2).alias("created_hour"),
        _number(a % 7 + 1).alias("created_day_of_week"),
        F.lit(None).cast("string").alias("created_month"),
        _unless(unplaced, F.concat(_number(a * 137 + 1110000), F.lit(".621"))).alias("x_coordinate"),
        _unless(unplaced, F.concat(_number(a * 211 + 1810000), F.lit(".942"))).alias("y_coordinate"),
        latitude.alias("latitude"),
        longitude.alias("longitude"),
        _unless(unplaced, F.struct(latitude.alias("latitude"), longitude.alias("longitude"))).alias("location"),
    )
