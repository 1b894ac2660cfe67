"""Incident-shaped inputs derived from the given tables, always from all their rows.

``shipments`` and ``clicks`` are silver-shaped; the two feeds are raw, one with
native types and one all text, with blanks, bad dates, bad times, bad and
negative delays and natural copies among them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marlstone.sources.readers import ROW_ID

TYPED_FEED = "typed_feed"
TEXT_FEED = "text_feed"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shipments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem x part x supplier as incidents: 83 months, no hour, some blank stations.

    The dimensions grow with the data, so the joins carry no broadcast hint.
    """
    lines = table(spark, sf_dir, "lineitem")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_type")
    suppliers = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    joined = lines.join(parts, lines.l_partkey == parts.p_partkey).join(
        suppliers, lines.l_suppkey == suppliers.s_suppkey)
    day = F.col("l_shipdate").cast("date")
    return joined.select(
        day.alias("event_date"),
        F.date_format(day, "yyyy-MM").alias("event_year_month"),
        F.when(F.col("l_suppkey") % 23 == 0, "").otherwise(F.col("s_name")).alias("station"),
        F.col("p_type").alias("code_clean"),
        F.when(F.col("p_type") != "PROMO", F.concat(F.lit("DESC "), "p_type"))
        .alias("code_description"),
        F.concat("l_returnflag", "l_linestatus").alias("line_canonical"),
        F.when(F.col("l_quantity") <= 30, 0)
        .otherwise((F.col("l_quantity") - 30).cast("int")).alias("min_delay"),
    )


def _pick(key: Column, *values: str, default: str = "") -> Column:
    chain = F
    for i, value in enumerate(values):
        chain = chain.when(key == i, value)
    return chain.otherwise(default)


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as incidents: one month, all hours, messy station and line text."""
    events = table(spark, sf_dir, "events")
    eid = F.col("event_id")
    return events.select(
        eid, F.col("ts").alias("event_ts"),
        F.col("ts").cast("date").alias("event_date"),
        F.hour("ts").alias("event_hour"),
        F.date_format("ts", "yyyy-MM").alias("event_year_month"),
        F.when(eid % 17 == 0, "").otherwise(F.concat(
            F.lit("  user "), (F.col("user_id") % 40).cast("string"), F.lit("   stn ")))
        .alias("station_raw"),
        F.col("event_type").alias("code"),
        _pick(eid % 11, "YU", "yus", "BD", "SHP", "SRT", "YU/ BD", "LINE 2 - X", "LINE 1",
              "line 2", "95 YORK").alias("line_raw"),
        F.when(eid % 5 < 2, 0).otherwise(F.floor("value").cast("int")).alias("min_delay"),
    )


def typed_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as a natively typed raw feed."""
    events = table(spark, sf_dir, "events")
    eid, user = F.col("event_id"), F.col("user_id")
    return events.select(
        F.col("ts").cast("date").alias("date"),
        F.when(eid % 113 == 0, "24:61").otherwise(F.date_format("ts", "HH:mm")).alias("time"),
        F.date_format("ts", "EEEE").alias("day"),
        F.when(eid % 17 == 0, "").otherwise(F.concat(
            F.lit("  user "), (user % 40).cast("string"), F.lit("   stn "))).alias("station"),
        F.concat(F.lit(" "), "event_type").alias("code"),
        F.when(eid % 101 == 0, -4.0).when(eid % 103 == 0, F.lit(None))
        .when(eid % 5 < 2, 0.0).otherwise(F.floor("value").cast("double")).alias("min_delay"),
        F.when(eid % 7 != 0, F.col("value")).alias("min_gap"),
        _pick(user % 3, "n ", " S").alias("bound"),
        _pick(eid % 11, "YU", "yus", "BD", "SHP", "SRT", "YU/ BD", "LINE 2 - X", "LINE 1",
              "line 2", "95 YORK").alias("line"),
        user.alias("vehicle"),
        eid.alias(ROW_ID),
    )


def text_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders as an all-text raw feed with quotes, commas, NA, blanks and bad values."""
    orders = table(spark, sf_dir, "orders")
    cust = F.col("o_custkey")
    return orders.select(
        F.when(cust % 211 == 0, "n/a")
        .otherwise(F.col("o_orderdate").cast("date").cast("string")).alias("date"),
        F.when(cust % 97 == 0, "").otherwise(
            _pick(cust % 4, "8:15", "08:15", "17:45", default="18:05")).alias("time"),
        F.date_format("o_orderdate", "EEEE").alias("day"),
        F.concat(F.lit(" "), F.replace("o_orderpriority", F.lit("-"), F.lit("  ")),
                 F.lit(', "main" ')).alias("station"),
        F.lower("o_orderstatus").alias("code"),
        F.when(cust % 101 == 0, "-4").when(cust % 103 == 0, "").when(cust % 107 == 0, "abc")
        .otherwise(F.floor(F.col("o_totalprice") / 50000).cast("string")).alias("min_delay"),
        F.col("o_totalprice").cast("string").alias("min_gap"),
        F.when(cust % 5 == 0, "NA").otherwise(F.col("o_orderstatus")).alias("bound"),
        F.when(F.col("o_orderstatus") == "F", "YU").when(F.col("o_orderstatus") == "O", "Line 2")
        .otherwise("YU / BD").alias("line"),
        F.lit("").alias("vehicle"),
        F.col("o_orderkey").alias(ROW_ID),
    )


def feeds(spark: SparkSession, sf_dir: str) -> list[tuple[str, DataFrame]]:
    return [(TYPED_FEED, typed_feed(spark, sf_dir)), (TEXT_FEED, text_feed(spark, sf_dir))]


def code_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A raw code reference: lower case, garbled dashes, every code listed twice.

    It leaves out one code of each feed, so coverage is partial.
    """
    types = table(spark, sf_dir, "events").select(F.col("event_type").alias("code"))
    states = table(spark, sf_dir, "orders").select(F.lower("o_orderstatus").alias("code"))
    known = types.where("code <> 'signup'").distinct().unionByName(
        states.where("code <> 'p'").distinct())
    twice = known.select("code", F.explode(F.array(F.lit(0), F.lit(1))).alias(ROW_ID))
    # the three characters an en dash becomes when its bytes are read as windows-1252
    description = F.when(F.col(ROW_ID) == 0, F.concat(F.lit("CODE â€“ "), F.upper("code")))
    return twice.withColumn("description", description.otherwise("listed again"))
