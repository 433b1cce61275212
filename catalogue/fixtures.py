"""Incident tables derived from the test parquet, whole tables every time."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.functions.cleaning import violent_flag

# Category sets that stand in for the violent categories of the raw data.
ORDER_VIOLENT = ("1-URGENT", "2-HIGH")
EVENT_VIOLENT = ("error", "purchase")


# Known columns, so that no job has to read file footers to find them.
SCHEMAS = {
    "orders": """o_orderkey bigint, o_custkey bigint, o_orderstatus string,
        o_totalprice double, o_orderdate timestamp_ntz, o_orderpriority string""",
    "customer": """c_custkey bigint, c_name string, c_nationkey int, c_acctbal double,
        c_mktsegment string""",
    "events": """event_id bigint, ts timestamp_ntz, user_id bigint, event_type string,
        value double, props string""",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def dated_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``order_incidents`` without what needs the customer's row: no join."""
    return table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("ts"),
        F.concat(F.lit("BLOCK "), F.col("o_custkey").cast("string")).alias("block"),
        F.col("o_orderpriority").alias("category"),
        violent_flag("o_orderpriority", ORDER_VIOLENT, null_as=0).alias("violent"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("arrest"),
    )


def order_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per order; the customer gives its place."""
    orders, customers = table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer")
    district = (F.col("c_nationkey") + 1).cast("int")
    digit = (F.col("c_custkey") % 10).cast("string")
    return orders.join(customers, F.col("o_custkey") == F.col("c_custkey")).select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").alias("ts"),
        F.concat(F.lit("BLOCK "), F.col("c_custkey").cast("string")).alias("block"),
        F.concat(F.lpad(district.cast("string"), 2, "0"), F.lit("1"), digit).alias("unit"),
        district.alias("district"),
        F.col("o_orderpriority").alias("category"),
        violent_flag("o_orderpriority", ORDER_VIOLENT, null_as=0).alias("violent"),
        F.when(F.col("o_orderstatus") == "F", 1).otherwise(0).alias("arrest"),
        F.when(F.col("c_mktsegment") == "HOUSEHOLD", 1).otherwise(0).alias("domestic"),
    )


def event_incidents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One incident per event; the only fixture with hours of the day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("id"),
        "ts",
        F.col("user_id").cast("string").alias("block"),
        F.col("event_type").alias("category"),
        violent_flag("event_type", EVENT_VIOLENT, null_as=0).alias("violent"),
        F.when(F.col("event_type") == "purchase", 1).otherwise(0).alias("arrest"),
    )


def raw_text(incidents: DataFrame) -> DataFrame:
    """Incidents written out the way the raw table spells them."""

    def spelled(flag: str):
        return F.when(F.col(flag) == 1, "true").otherwise("false")

    return incidents.select(
        F.col("id").cast("string").alias("ID"),
        F.date_format("ts", "MM/dd/yyyy hh:mm:ss a").alias("Date"),
        F.col("block").alias("Block"),
        F.col("category").alias("Primary Type"),
        spelled("arrest").alias("Arrest"),
        spelled("domestic").alias("Domestic"),
        F.col("unit").alias("Beat"),
        F.concat(F.col("district").cast("string"), F.lit(".0")).alias("District"),
    )


def dirty_text(incidents: DataFrame) -> DataFrame:
    """Raw rows with dirt by key: dates, flags, districts, categories and blocks.

    What a rule cannot read is null after cleaning: dates that are no dates or
    absent, flags that are no flags, districts that are no numbers from 1 to 25.
    """
    key = F.col("ID").cast("bigint")
    ts = F.try_to_timestamp("Date", F.lit("MM/dd/yyyy hh:mm:ss a"))
    number = F.split("District", "[.]")[0]
    return raw_text(incidents).select(
        "ID",
        F.when(key % 11 == 0, "31st of June")
        .when(key % 13 == 0, F.lit(None))
        .when(key % 7 == 0, F.date_format(ts, "M/d/yyyy h:mm:ss a"))
        .otherwise(F.col("Date"))
        .alias("Date"),
        F.when(key % 47 == 0, F.lit(None)).when(key % 53 == 0, "").otherwise(F.col("Block")).alias("Block"),
        F.when(key % 43 != 0, F.col("Primary Type")).alias("Primary Type"),
        F.when(key % 17 == 0, "maybe")
        .when(key % 19 == 0, F.lit(None))
        .when(key % 5 == 0, F.upper("Arrest"))
        .otherwise(F.col("Arrest"))
        .alias("Arrest"),
        F.when(key % 59 == 0, "").otherwise(F.col("Domestic")).alias("Domestic"),
        F.when(key % 61 != 0, F.col("Beat")).alias("Beat"),
        F.when(key % 23 == 0, "26")
        .when(key % 29 == 0, "unknown")
        .when(key % 31 == 0, F.lit(None))
        .when(key % 37 == 0, "0.5")
        .when(key % 41 == 0, F.concat(F.lit("-"), number))
        .when(key % 3 == 0, F.concat(F.lit(" "), F.lpad(number, 3, "0"), F.lit(" ")))
        .when(key % 3 == 1, F.concat(number, F.lit(".9")))
        .otherwise(F.col("District"))
        .alias("District"),
    )


def cut_lines(incidents: DataFrame) -> DataFrame:
    """Raw rows as CSV lines under their header; by key, some are cut or too long."""
    text = raw_text(incidents)
    cells = [F.col(f"`{c}`") for c in text.columns]
    key = F.col("ID").cast("bigint")
    line = (
        F.when(key % 97 == 0, F.concat_ws(",", *cells[:5]))
        .when(key % 89 == 0, F.concat_ws(",", *cells, F.lit("more")))
        .otherwise(F.concat_ws(",", *cells))
    )
    return text.select(line.alias(",".join(text.columns)))


def write_lines(lines: DataFrame, path: str) -> None:
    """Lines of one text column, whose name is the header of every file."""
    # A separator and a quote that no line holds, so that lines stay as they are.
    lines.write.option("header", True).option("sep", "\x01").option("quote", "\x02").csv(path)
