"""Readers, bronze steps and sinks, as round trips through the shared folder."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.config import PARTITION_COLUMNS, SourceSpec
from marlstone.operators import exports, gold, silver
from marlstone.registry.base import query
from marlstone.registry.column_queries import annotated, bronze, silver_table
from marlstone.registry.gold_queries import AVERAGE, DELAYED, SUMS
from marlstone.registry.inputs import code_list, feeds, shipments, table, text_feed, typed_feed
from marlstone.registry.join_queries import SHIPMENT_LINES
from marlstone.registry.sql import over
from marlstone.sources import bronze as bronze_layer
from marlstone.sources import manifest as manifests
from marlstone.sources import readers, sinks

_FEED_COLUMNS = "date, time, day, station, code, min_delay, min_gap, bound, line, vehicle"


def write_csv(df, path: str) -> None:
    df.write.mode("overwrite").options(
        header=True, quote='"', escape='"',
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)


@query("s1_text_source", over("text_feed", f"""
    SELECT CAST(source_row_id AS VARCHAR) AS order_key, {_FEED_COLUMNS} FROM text_feed"""))
def text_source(spark, sf_dir):
    """Blanks come back as '', NA stays text, quotes and commas survive."""
    path = sinks.work_path(spark, "text-feed")
    write_csv(text_feed(spark, sf_dir).withColumnRenamed("source_row_id", "Order  Key"), path)
    return readers.read_source(spark, SourceSpec("text_feed", path)).drop(readers.ROW_ID)


@query("s1_text_source_with_line_breaks", """
    SELECT CAST(doc_id AS VARCHAR) AS doc_id, md5(text) AS digest FROM documents""")
def text_source_with_line_breaks(spark, sf_dir):
    """Whole documents through CSV: the reader finds the quoted line breaks itself."""
    path = sinks.work_path(spark, "documents")
    write_csv(table(spark, sf_dir, "documents").select("doc_id", "text"), path)
    read = readers.read_source(spark, SourceSpec("documents", path))
    return read.select("doc_id", F.md5("text").alias("digest"))


@query("s2_typed_source", """
    SELECT CAST(event_id AS VARCHAR) AS event_id, strftime(ts, '%Y-%m-%d') AS ts,
           CAST(user_id AS VARCHAR) AS user_id, event_type, CAST(value AS VARCHAR) AS value, props
    FROM events""")
def typed_source(spark, sf_dir):
    """The events file as it is: dates, numbers and text all become published text."""
    events = readers.read_source(spark, SourceSpec("events", f"{sf_dir}/events.parquet", "parquet"))
    events = events.drop(readers.ROW_ID)
    return bronze_layer.unify_text(events, events.columns)


@query("s3_header_normalisation", """
    SELECT o_orderkey AS order_key, o_custkey AS cust_key, o_orderstatus AS order_status FROM orders""")
def header_normalisation(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    published = orders.select(
        F.col("o_orderkey").alias("_id"), F.col("o_orderkey").alias(" Order Key "),
        F.col("o_custkey").alias("CUST\tKEY"), F.col("o_orderstatus").alias("Order   Status"))
    return readers.normalise_columns(published)


@query("s4_union_with_lineage", over("bronze", """
    SELECT source_file, source_ord, source_row_id, station, vehicle FROM bronze"""))
def union_with_lineage(spark, sf_dir):
    texts = [(n, bronze_layer.unify_text(df)) for n, df in feeds(spark, sf_dir)]
    return bronze_layer.union_sources(texts).select(
        "source_file", "source_ord", "source_row_id", "station", "vehicle")


@query("s5_required_columns", over("bronze", """
    SELECT source_file, count(*) AS incidents FROM bronze GROUP BY source_file"""))
def required_columns(spark, sf_dir):
    guarded = bronze_layer.require_columns(bronze(spark, sf_dir))
    return guarded.groupBy("source_file").agg(F.count(F.lit(1)).alias("incidents"))


@query("s6_unify_to_text", over("bronze", f"""
    SELECT {_FEED_COLUMNS}, source_file, source_row_id FROM bronze"""))
def unify_to_text(spark, sf_dir):
    return bronze(spark, sf_dir).select(
        *[c.strip() for c in _FEED_COLUMNS.split(",")], "source_file", "source_row_id")


@query("s7_partition_keys", over("bronze", """
    SELECT partition_year, partition_month, count(*) AS incidents FROM bronze GROUP BY ALL"""))
def partition_keys(spark, sf_dir):
    return bronze(spark, sf_dir).groupBy(*PARTITION_COLUMNS).agg(
        F.count(F.lit(1)).alias("incidents"))


@query("s8_partitioned_bronze", over("bronze", """
    SELECT date, station, vehicle, source_file, source_row_id, partition_year, partition_month
    FROM bronze
    WHERE (partition_year, partition_month) NOT IN (
              SELECT (partition_year, partition_month) FROM bronze WHERE source_file = 'typed_feed')
       OR source_file = 'typed_feed'"""))
def partitioned_bronze(spark, sf_dir):
    """Both feeds written, then one alone: only the months it has are replaced."""
    path = sinks.work_path(spark, "bronze")
    sinks.write_partitioned(bronze(spark, sf_dir), path)
    second = bronze_layer.unify([("typed_feed", typed_feed(spark, sf_dir))])
    sinks.write_partitioned(second, path)
    return spark.read.parquet(path).select(
        "date", "station", "vehicle", "source_file", "source_row_id", *PARTITION_COLUMNS)


@query("s9_silver_sink", over("silver", """
    SELECT *, CAST(year(event_date) AS INT) AS partition_year,
           CAST(month(event_date) AS INT) AS partition_month FROM silver"""))
def silver_sink(spark, sf_dir):
    path = sinks.work_path(spark, "silver")
    sinks.write_silver(silver_table(spark, sf_dir), path)
    return sinks.read_silver(spark, path)


@query("s10_rejects_sink", over("annotated", """
    SELECT source_file, source_row_id, date, time, min_delay FROM annotated WHERE is_reject"""))
def rejects_sink(spark, sf_dir):
    """Rejects written over an earlier full table, then read back."""
    path = sinks.work_path(spark, "rejects")
    rows = annotated(spark, sf_dir)
    sinks.write_table(rows, path)
    sinks.write_table(silver.rejects(rows), path)
    return spark.read.parquet(path).select(
        "source_file", "source_row_id", "date", "time", "min_delay")


@query("s11_gold_tables", over("shipments", f"""
    SELECT event_date, {SUMS}, {DELAYED}, {AVERAGE}, count(DISTINCT station) AS stations_affected
    FROM shipments GROUP BY event_date"""))
def gold_tables(spark, sf_dir):
    path = sinks.work_path(spark, "gold")
    sinks.write_table(gold.daily_summary(shipments(spark, sf_dir)), path)
    return spark.read.parquet(path)


@query("s12_sql_view", over("silver", """
    SELECT line_canonical, count(*) AS incidents, sum(min_delay) AS total_delay_minutes
    FROM silver GROUP BY line_canonical"""))
def sql_view(spark, sf_dir):
    sinks.publish_view(silver_table(spark, sf_dir), "silver_delays_view")
    return spark.sql("""
        SELECT line_canonical, count(*) AS incidents, sum(min_delay) AS total_delay_minutes
        FROM silver_delays_view GROUP BY line_canonical""")


@query("s13_record_json", over("shipments", f"""
    SELECT station, {SUMS}, {AVERAGE} FROM shipments WHERE station <> '' GROUP BY station"""))
def record_json(spark, sf_dir):
    path = sinks.work_path(spark, "records")
    rows = gold.delays_by_station(shipments(spark, sf_dir))
    sinks.write_json(rows, path)
    return spark.read.schema(rows.schema).json(path)


@query("s13_record_text", over("shipments", """
    SELECT concat('{"event_date":"', event_date, '","line_canonical":"', line_canonical,
                  '","total_delay_minutes":', total, '}') AS record
    FROM (SELECT event_date, line_canonical, CAST(sum(min_delay) AS BIGINT) AS total
          FROM shipments GROUP BY ALL)"""))
def record_text(spark, sf_dir):
    return exports.records(gold.days_by_line(shipments(spark, sf_dir)))


_EPOCH = "CAST(date_diff('day', DATE '1970-01-01', event_date) AS INT)"


@query("s14_daily_compact", over("shipments", f"""
    SELECT {_EPOCH} AS epoch_day, {SUMS} FROM shipments GROUP BY event_date"""))
def daily_compact(spark, sf_dir):
    return exports.daily_compact(shipments(spark, sf_dir))


_SHORT = "CASE line_canonical " + " ".join(
    f"WHEN '{full}' THEN '{short}'" for full, short in SHIPMENT_LINES.items()) + " END"


@query("s14_daily_by_line_arrays", over("shipments", f"""
    SELECT concat('[', {_EPOCH}, ',"', {_SHORT}, '",', CAST(sum(min_delay) AS BIGINT), ']') AS row
    FROM shipments GROUP BY event_date, line_canonical"""))
def daily_by_line_arrays(spark, sf_dir):
    return exports.as_arrays(
        exports.daily_by_line_compact(shipments(spark, sf_dir), SHIPMENT_LINES))


@query("s16_parquet_dataset", """
    SELECT event_type, count(*) AS events, CAST(sum(user_id) AS BIGINT) AS users FROM events
    GROUP BY event_type""")
def parquet_dataset(spark, sf_dir):
    events = readers.load_dataset(spark, f"{sf_dir}/events.parquet")
    return events.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("events"), F.sum("user_id").alias("users"))


@query("s16_csv_dataset", """
    SELECT CAST(c_custkey AS INT) AS c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment
    FROM customer""")
def csv_dataset(spark, sf_dir):
    """Types are inferred when a CSV file is handed to the checker."""
    path = sinks.work_path(spark, "customer") + ".csv"
    write_csv(table(spark, sf_dir, "customer"), path)
    return readers.load_dataset(spark, path)


@query("s16_table_dataset", """
    SELECT n_name, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
    GROUP BY n_name""")
def table_dataset(spark, sf_dir):
    customers = table(spark, sf_dir, "customer")
    nations = table(spark, sf_dir, "nation")
    joined = customers.join(nations, customers.c_nationkey == nations.n_nationkey)
    joined.createOrReplaceTempView("customer_nation")
    loaded = readers.load_dataset(spark, "warehouse.db", table="customer_nation")
    return loaded.groupBy("n_name").agg(F.count(F.lit(1)).alias("customers"))


@query("s17_file_manifest")
def file_manifest(spark, sf_dir):
    """The given files themselves, compared with a first scan kept in the shared folder."""
    files = {name: f"{sf_dir}/{name}.parquet" for name in ("events", "orders", "lineitem")}
    path = sinks.work_path(spark, "manifest")
    first = manifests.compare(
        manifests.scan_files(spark, {"events": files["events"], "orders": files["orders"]}),
        manifests.empty_manifest(spark))
    sinks.write_table(first, path)
    return manifests.compare(manifests.scan_files(spark, files), spark.read.parquet(path)).select(
        "logical_name", "filename", "bytes", "sha256", "status")


@query("s17_file_digests", """
    SELECT CAST(n_nationkey AS VARCHAR) AS file_key, CAST(strlen(n_name) + 1 AS BIGINT) AS bytes,
           sha256(concat(n_name, chr(10))) AS sha256
    FROM nation""")
def file_digests(spark, sf_dir):
    """A nested feed of one text file per nation, scanned by path, size and content."""
    path = sinks.work_path(spark, "nations")
    nations = table(spark, sf_dir, "nation").select(F.col("n_name").alias("value"), F.col("n_nationkey").alias("k"))
    nations.repartition("k").write.partitionBy("k").text(path)
    return manifests.scan_files(spark, {"nations": path}).select(
        F.regexp_extract("filename", r"\Ak=(\d+)/", 1).alias("file_key"), "bytes", "sha256")


@query("s17_large_file_digests", """
    SELECT CAST(doc_id // 2000 AS VARCHAR) AS file_key,
           CAST(sum(4 * (strlen(coalesce(text, '')) + 1)) AS BIGINT) AS bytes,
           sha256(string_agg(repeat(concat(coalesce(text, ''), chr(10)), 4), '' ORDER BY doc_id)) AS sha256
    FROM documents GROUP BY doc_id // 2000""")
def large_file_digests(spark, sf_dir):
    """Text files of 2,000 documents each, every text four times: most take several reads to hash."""
    path = sinks.work_path(spark, "texts")
    line = F.coalesce("text", F.lit(""))
    docs = table(spark, sf_dir, "documents").select(
        F.concat_ws("\n", line, line, line, line).alias("value"), F.floor(F.col("doc_id") / 2000).alias("k"), "doc_id")
    docs.repartition("k").sortWithinPartitions("k", "doc_id").drop("doc_id").write.partitionBy("k").text(path)
    return manifests.scan_files(spark, {"texts": path}).select(
        F.regexp_extract("filename", r"\Ak=(\d+)/", 1).alias("file_key"), "bytes", "sha256")


@query("s19_reference_list", """
    SELECT DISTINCT code FROM (
        SELECT upper(event_type) AS code FROM events WHERE event_type <> 'signup'
        UNION ALL SELECT o_orderstatus FROM orders WHERE o_orderstatus <> 'P')""")
def reference_list(spark, sf_dir):
    return readers.reference_codes(code_list(spark, sf_dir))
