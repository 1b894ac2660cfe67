"""Scalar columns, filters and projections."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.config import LINE_CODES, LINE_RULES, UNKNOWN
from marlstone.functions import casting, encoding, text
from marlstone.operators import exports, gold, silver
from marlstone.registry.base import query
from marlstone.registry.gold_queries import MEAN, SUMS
from marlstone.registry.inputs import (
    clicks, code_list, feeds, shipments, table, text_feed,
)
from marlstone.registry.sql import bucket, cleaned, over
from marlstone.sources import bronze as bronze_layer
from marlstone.sources import sinks


def bronze(spark, sf_dir):
    return bronze_layer.unify(feeds(spark, sf_dir))


def annotated(spark, sf_dir):
    """Typed bronze with descriptions; the dimension is stored, as a published list would be."""
    dimension = sinks.reliable_checkpoint(silver.code_dimension(code_list(spark, sf_dir)))
    return silver.annotate(bronze(spark, sf_dir), dimension)


def silver_table(spark, sf_dir):
    return silver.silver(annotated(spark, sf_dir))


@query("p1_clean_free_text", over("clicks", f"""
    SELECT event_id, {cleaned('station_raw')} AS station FROM clicks"""))
def clean_free_text(spark, sf_dir):
    return clicks(spark, sf_dir).select(
        "event_id", text.clean_text(F.col("station_raw")).alias("station"))


@query("p1_clean_whole_documents", """
    SELECT doc_id, length(cleaned) AS n, md5(cleaned) AS digest
    FROM (SELECT doc_id, trim(regexp_replace(replace(upper(text), 'ẞ', 'SS'),
                 '[\\s\\x{85}\\x{A0}\\x{1680}\\x{2000}-\\x{200A}\\x{2028}\\x{2029}\\x{202F}\\x{205F}\\x{3000}]+',
                 ' ', 'g')) AS cleaned FROM documents)""")
def clean_documents(spark, sf_dir):
    cleaned_text = table(spark, sf_dir, "documents").select(
        "doc_id", text.clean_text(F.col("text")).alias("cleaned"))
    return cleaned_text.select(
        "doc_id", F.length("cleaned").cast("bigint").alias("n"), F.md5("cleaned").alias("digest"))


@query("p2_trim_upper", over("text_feed", """
    SELECT source_row_id, upper(trim(code)) AS code, upper(trim(bound)) AS bound,
           trim(vehicle) AS vehicle, trim(station) AS station FROM text_feed"""))
def trim_upper(spark, sf_dir):
    return text_feed(spark, sf_dir).select(
        "source_row_id", text.strip_upper(F.col("code")).alias("code"),
        text.strip_upper(F.col("bound")).alias("bound"), text.strip(F.col("vehicle")).alias("vehicle"),
        text.strip(F.col("station")).alias("station"))


@query("p3_canonical_line", over("bronze", f"""
    SELECT line AS line_raw, {bucket('line')} AS line_canonical, count(*) AS incidents
    FROM bronze GROUP BY ALL"""))
def canonical_line(spark, sf_dir):
    mapped = text.map_by_rules(F.col("line"), LINE_RULES, UNKNOWN)
    return bronze(spark, sf_dir).groupBy(
        F.col("line").alias("line_raw"), mapped.alias("line_canonical")
    ).agg(F.count(F.lit(1)).alias("incidents"))


@query("p4_mojibake_repair", """
    SELECT doc_id, md5(text) AS repaired, md5(text) AS untouched FROM documents""")
def mojibake_repair(spark, sf_dir):
    """Garble every document the way the defect does and repair it; also repair the original."""
    garbled = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(text.repair_mojibake(garbled)).alias("repaired"),
        F.md5(text.repair_mojibake(F.col("text"))).alias("untouched"))


@query("p4_mojibake_windows_1252", """
    SELECT doc_id, md5(text) AS repaired,
           md5(concat(text, chr(233), chr(CAST(8232 + doc_id % 2 AS INTEGER)))) AS separated
    FROM documents""")
def mojibake_windows_1252(spark, sf_dir):
    """Documents read as windows-1252, its printable characters on bytes 80-9F; a line separator at the end stops repair."""
    shown, raw = text._CP1252_SHOWN, text._CP1252_RAW
    garbled = F.translate(F.decode(F.encode("text", "UTF-8"), "ISO-8859-1"), raw, shown)
    separator = F.when(F.col("doc_id") % 2 == 0, "\u2028").otherwise("\u2029")
    kept = F.concat(F.col("text"), F.lit("\u00e9"), separator)
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.md5(text.repair_mojibake(garbled)).alias("repaired"),
        F.md5(text.repair_mojibake(kept)).alias("separated"))


@query("p4_code_descriptions", over("code_list", "SELECT code_clean, code_description FROM code_list"))
def code_descriptions(spark, sf_dir):
    return silver.code_dimension(code_list(spark, sf_dir))


@query("p5_raw_value_kept", over("silver", """
    SELECT line_canonical, line_raw, count(*) AS incidents FROM silver GROUP BY ALL"""))
def raw_value_kept(spark, sf_dir):
    return silver_table(spark, sf_dir).groupBy("line_canonical", "line_raw").agg(
        F.count(F.lit(1)).alias("incidents"))


@query("p6_date_parse", over("typed", """
    SELECT source_file, source_row_id, event_date FROM typed"""))
def date_parse(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "source_file", "source_row_id", casting.parse_date(F.col("date")).alias("event_date"))


@query("p6_date_parse_iso_instant", """
    SELECT o_orderkey, CAST(o_orderdate AS DATE) AS event_date FROM orders""")
def date_parse_iso_instant(spark, sf_dir):
    """ISO dates as feeds publish them: alone, or with a time after a T or a space."""
    day = F.col("o_orderdate")
    pick = F.col("o_custkey") % 4
    published = F.when(pick == 0, F.date_format(day, "yyyy-MM-dd")).when(
        pick == 1, F.date_format(day, "yyyy-MM-dd'T'HH:mm:ss")).when(
        pick == 2, F.date_format(day, "yyyy-MM-dd HH:mm:ss")).otherwise(F.date_format(day, "yyyy-MM-dd'T'HH:mm'Z'"))
    return table(spark, sf_dir, "orders").select("o_orderkey", casting.parse_date(published).alias("event_date"))


@query("p6_date_parse_other_formats", """
    SELECT o_orderkey, CASE WHEN o_custkey % 211 <> 0 THEN CAST(o_orderdate AS DATE) END AS event_date
    FROM orders""")
def date_parse_formats(spark, sf_dir):
    """Three published formats and an unparseable one, picked per row."""
    day = F.col("o_orderdate")
    pick = F.col("o_custkey") % 3
    published = F.when(F.col("o_custkey") % 211 == 0, "31/31/99").when(
        pick == 0, F.date_format(day, "yyyy-MM-dd")).when(
        pick == 1, F.date_format(day, "dd/MM/yyyy")).otherwise(F.date_format(day, "MMM d, yyyy"))
    formats = ("yyyy-MM-dd", "dd/MM/yyyy", "MMM d, yyyy")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", casting.parse_date(published, formats).alias("event_date"))


@query("p7_event_timestamp", over("typed", "SELECT source_file, source_row_id, event_ts FROM typed"))
def event_timestamp(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "source_file", "source_row_id",
        casting.event_timestamp(F.col("date"), F.col("time")).alias("event_ts"))


@query("p8_number_parse", over("typed", """
    SELECT source_file, source_row_id, min_delay, min_gap FROM typed"""))
def number_parse(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        "source_file", "source_row_id",
        casting.parse_number(F.col("min_delay")).alias("min_delay"),
        casting.parse_number(F.col("min_gap")).alias("min_gap"))


@query("p9_hour_and_month", over("typed", """
    SELECT CAST(hour(event_ts) AS INT) AS event_hour, strftime(event_ts, '%Y-%m') AS event_year_month,
           count(*) AS incidents
    FROM typed GROUP BY ALL"""))
def hour_and_month(spark, sf_dir):
    ts = casting.event_timestamp(F.col("date"), F.col("time"))
    return bronze(spark, sf_dir).groupBy(
        casting.event_hour(ts).alias("event_hour"),
        casting.event_year_month(ts).alias("event_year_month"),
    ).agg(F.count(F.lit(1)).alias("incidents"))


_REJECTS = """
    SELECT source_file, source_row_id, event_date, event_ts, station_raw AS station, code_clean,
           code_description, min_delay, line_canonical
    FROM annotated WHERE is_reject"""


@query("p10_quarantine", over("annotated", _REJECTS))
def quarantine(spark, sf_dir):
    return silver.rejects(annotated(spark, sf_dir)).select(
        "source_file", "source_row_id", "event_date", "event_ts", "station", "code_clean",
        "code_description", "min_delay", "line_canonical")


@query("p10_accepted", over("annotated", """
    SELECT source_file, source_row_id, min_delay FROM annotated WHERE NOT is_reject"""))
def accepted(spark, sf_dir):
    return silver.accepted(annotated(spark, sf_dir)).select(
        "source_file", "source_row_id", "min_delay")


@query("p11_silver_projection", over("silver", "SELECT * FROM silver"))
def silver_projection(spark, sf_dir):
    return silver_table(spark, sf_dir)


@query("p12_year_and_quarter", """
    SELECT CAST(year(l_shipdate) AS INT) AS event_year,
           CAST(quarter(l_shipdate) AS INT) AS event_quarter, count(*) AS line_items
    FROM lineitem GROUP BY ALL""")
def year_and_quarter(spark, sf_dir):
    dated = table(spark, sf_dir, "lineitem").select(F.col("l_shipdate").cast("date").alias("event_date"))
    return gold.with_periods(dated).groupBy("event_year", "event_quarter").agg(
        F.count(F.lit(1)).alias("line_items"))


@query("p13_conditional_sums", over("shipments", f"""
    SELECT station, CAST(sum(CASE WHEN min_delay > 0 THEN 1 ELSE 0 END) AS BIGINT) AS incidents_with_delay,
           CAST(sum(CASE WHEN min_delay > 0 THEN min_delay END) AS BIGINT) AS delayed_minutes, {SUMS}
    FROM shipments GROUP BY station"""))
def conditional_sums(spark, sf_dir):
    cube = gold.station_cube(shipments(spark, sf_dir))
    return cube.groupBy("station").agg(*[
        F.sum(c).alias(c)
        for c in ("incidents", "incidents_with_delay", "total_delay_minutes", "delayed_minutes")])


@query("p14_default_description", over("silver", """
    SELECT code_clean AS code, coalesce(max(code_description), 'Not in reference table') AS description,
           count(*) AS incidents, sum(min_delay) AS total_delay_minutes
    FROM silver GROUP BY code_clean"""))
def default_description(spark, sf_dir):
    return gold.delays_by_code(silver_table(spark, sf_dir))


@query("p15_rounding", """
    SELECT l_partkey, floor(avg(l_extendedprice) * 100 + 0.5) / 100 AS mean_2,
           floor(avg(l_quantity) * 10 + 0.5) / 10 AS mean_1
    FROM (SELECT l_partkey, floor(l_extendedprice) AS l_extendedprice, l_quantity FROM lineitem)
    GROUP BY l_partkey""")
def rounding(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(
        encoding.round_half_up(F.avg(F.floor("l_extendedprice")), 2).alias("mean_2"),
        encoding.round_half_up(F.avg("l_quantity"), 1).alias("mean_1"))


@query("p16_named_stations", over("silver", """
    SELECT station, count(*) AS incidents FROM silver WHERE station <> '' GROUP BY station"""))
def named_stations(spark, sf_dir):
    return gold.named_stations(silver_table(spark, sf_dir)).groupBy("station").agg(
        F.count(F.lit(1)).alias("incidents"))


@query("p17_percent_in_group", over("shipments", f"""
    SELECT code_clean, 100.0::DOUBLE * count({MEAN[4:-1]}) / count(*) AS pct
    FROM shipments GROUP BY code_clean"""))
def percent_in_group(spark, sf_dir):
    return shipments(spark, sf_dir).groupBy("code_clean").agg(
        encoding.percent(F.count_if(F.col("min_delay") > 0), F.count(F.lit(1))).alias("pct"))


_SHORT = "CASE line_canonical " + " ".join(
    f"WHEN '{full}' THEN '{short}'" for full, short in LINE_CODES.items()) + " END"


@query("p18_short_line_codes", over("silver", f"""
    SELECT {_SHORT} AS line, count(*) AS incidents FROM silver GROUP BY 1"""))
def short_line_codes(spark, sf_dir):
    return exports.with_short_line(silver_table(spark, sf_dir)).groupBy("line").agg(
        F.count(F.lit(1)).alias("incidents"))


@query("p18_full_line_names", over("silver", """
    SELECT line_canonical, count(*) AS incidents FROM silver GROUP BY 1"""))
def full_line_names(spark, sf_dir):
    encoded = exports.with_short_line(silver_table(spark, sf_dir))
    return exports.with_full_line(encoded).groupBy("line_canonical").agg(
        F.count(F.lit(1)).alias("incidents"))


@query("p19_epoch_days", """
    SELECT CAST(date_diff('day', DATE '1970-01-01', CAST(o_orderdate AS DATE)) AS INT) AS epoch_day,
           CAST(o_orderdate AS DATE) AS day, count(*) AS orders
    FROM orders GROUP BY ALL""")
def epoch_days(spark, sf_dir):
    """Encoded, then decoded again from the number."""
    encoded = table(spark, sf_dir, "orders").groupBy(
        encoding.epoch_day(F.col("o_orderdate").cast("date")).alias("epoch_day")
    ).agg(F.count(F.lit(1)).alias("orders"))
    return encoded.withColumn("day", encoding.from_epoch_day(F.col("epoch_day")))
