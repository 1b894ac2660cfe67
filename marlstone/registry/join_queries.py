"""Lookups, membership, dictionaries, dedupe, union."""

from __future__ import annotations

from pyspark.sql import functions as F

from marlstone.operators import exports, gold, quality, silver
from marlstone.registry.base import query
from marlstone.registry.column_queries import annotated, bronze
from marlstone.registry.gold_queries import (
    QUARTER, many_codes, station_rows, top_codes_sql, top_rows,
)
from marlstone.registry.inputs import code_list, feeds, shipments, table
from marlstone.registry.sql import over
from marlstone.sources import bronze as bronze_layer
from marlstone.sources import manifest as manifests
from marlstone.sources import sinks


@query("j1_code_lookup", over("annotated", """
    SELECT source_file, source_row_id, code_clean, code_description FROM annotated"""))
def code_lookup(spark, sf_dir):
    return annotated(spark, sf_dir).select(
        "source_file", "source_row_id", "code_clean", "code_description")


@query("j1_code_lookup_shuffled", over("annotated", """
    SELECT source_file, source_row_id, code_clean, code_description FROM annotated"""))
def code_lookup_shuffled(spark, sf_dir):
    """The same lookup with a dimension past the broadcast bound."""
    typed = silver.type_columns(bronze(spark, sf_dir))
    dimension = silver.code_dimension(code_list(spark, sf_dir))
    return silver.lookup(typed, dimension, "code_clean", limit=0).select(
        "source_file", "source_row_id", "code_clean", "code_description")


@query("j2_membership", """
    SELECT CAST(count_if(l.doc_id IS NOT NULL) AS BIGINT) AS hits, count(*) AS rows
    FROM documents d LEFT JOIN (SELECT DISTINCT doc_id FROM labels) l ON d.doc_id = l.doc_id""")
def membership(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels").select("doc_id")
    hits = quality.coverage(quality.value_counts(documents, "doc_id"), labels)
    return hits.withColumn("rows", F.lit(documents.count()).cast("bigint"))


@query("j4_frequency_members", """
    SELECT CAST(sum(n) AS BIGINT) AS rows, CAST(sum(CASE WHEN n <= 8 THEN n ELSE 0 END) AS BIGINT) AS tail_rows
    FROM (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)""")
def frequency_members(spark, sf_dir):
    return quality.long_tail(quality.value_counts(table(spark, sf_dir, "orders"), "o_custkey"), 8)


@query("j4_frequency_members_nan", """
    SELECT CAST(sum(n) AS BIGINT) AS rows,
           CAST(sum(CASE WHEN v IS NOT NULL AND n <= 40 THEN n ELSE 0 END) AS BIGINT) AS tail_rows
    FROM (SELECT v, count(*) AS n
          FROM (SELECT CASE WHEN p_size % 5 <> 0 THEN p_size + 0.5 END AS v FROM part) GROUP BY v)""")
def frequency_members_nan(spark, sf_dir):
    """NaN is a missing number: it stays in the denominator and is never a rare value."""
    size = F.col("p_size") + 0.5
    sizes = table(spark, sf_dir, "part").select(
        F.when(F.col("p_size") % 5 == 0, F.lit(float("nan"))).otherwise(size.cast("double")).alias("v"))
    return quality.long_tail(quality.value_counts(sizes, "v"), 40)


def _ranked_stations(spark, sf_dir):
    """The ranking, kept in the shared folder because several steps read it."""
    return sinks.reliable_checkpoint(gold.top_stations(shipments(spark, sf_dir), "quarter"))


def _ranked_codes(spark, sf_dir):
    return sinks.reliable_checkpoint(gold.top_codes(many_codes(spark, sf_dir), "quarter"))


# the six line values of the shipments, so that they can carry short codes
SHIPMENT_LINES = {"AF": "L1", "AO": "L2", "NF": "L3", "NO": "L4", "RF": "ML", "RO": "UNK"}


_RANKED = top_rows(station_rows(QUARTER), QUARTER, "station", 15)
_NAMES = f"""
    SELECT station, row_number() OVER (ORDER BY first_seen) - 1 AS station_index
    FROM (SELECT station, min(place) AS first_seen
          FROM (SELECT *, row_number() OVER (ORDER BY event_year, event_quarter, line_canonical,
                       total_delay_minutes DESC, station) AS place FROM ({_RANKED}))
          GROUP BY station)"""
_SHORT = "CASE line_canonical " + " ".join(
    f"WHEN '{full}' THEN '{short}'" for full, short in SHIPMENT_LINES.items()) + " END AS line"


@query("d4_station_names", over("shipments", _NAMES))
def station_names(spark, sf_dir):
    return exports.station_dictionary(_ranked_stations(spark, sf_dir))


@query("s15_encoded_station_rows", over("shipments", f"""
    SELECT event_year, event_quarter, {_SHORT}, station_index, incidents, total_delay_minutes,
           avg_delay_minutes_when_delayed
    FROM ({_RANKED}) JOIN ({_NAMES}) USING (station)"""))
def encoded_station_rows(spark, sf_dir):
    ranked = _ranked_stations(spark, sf_dir)
    return exports.encode_stations(ranked, exports.station_dictionary(ranked), SHIPMENT_LINES)


@query("s15_encoded_code_rows", top_codes_sql(QUARTER).replace(
    "SELECT * FROM (", f"SELECT * EXCLUDE (line_canonical, description), {_SHORT} FROM (", 1))
def encoded_code_rows(spark, sf_dir):
    return exports.encode_codes(_ranked_codes(spark, sf_dir), SHIPMENT_LINES)


@query("s15_code_descriptions", top_codes_sql(QUARTER).replace(
    "SELECT * FROM (", "SELECT DISTINCT code, description FROM (SELECT * FROM (", 1) + ")")
def code_descriptions(spark, sf_dir):
    return exports.code_dictionary(_ranked_codes(spark, sf_dir))


@query("j5_decoded_station_rows", over("shipments", _RANKED))
def decoded_station_rows(spark, sf_dir):
    """Encoded and decoded again."""
    ranked = _ranked_stations(spark, sf_dir)
    names = exports.station_dictionary(ranked)
    encoded = exports.encode_stations(ranked, names, SHIPMENT_LINES)
    return exports.decode_stations(encoded, names, SHIPMENT_LINES)


@query("j5_decoded_code_rows", top_codes_sql(QUARTER))
def decoded_code_rows(spark, sf_dir):
    ranked = _ranked_codes(spark, sf_dir)
    encoded = exports.encode_codes(ranked, SHIPMENT_LINES)
    return exports.decode_codes(encoded, exports.code_dictionary(ranked), SHIPMENT_LINES)


@query("j3_snapshot_compare", """
    SELECT source AS logical_name, CAST(doc_id AS VARCHAR) AS filename, sha256(text) AS sha256,
           CASE WHEN doc_id % 3 = 0 THEN 'downloaded' ELSE 'unchanged_skipped' END AS status
    FROM documents""")
def snapshot_compare(spark, sf_dir):
    """Each document as a file; the snapshot before had other content for every third one."""
    documents = table(spark, sf_dir, "documents")
    stamp = F.lit("2024-01-01 00:00:00").cast("timestamp")

    def snapshot(content):
        return documents.select(
            F.col("source").alias("logical_name"), F.col("doc_id").cast("string").alias("filename"),
            F.octet_length(content).cast("bigint").alias("bytes"), stamp.alias("modified"),
            F.sha2(content, 256).alias("sha256"))

    body = F.col("text")
    before = snapshot(F.when(F.col("doc_id") % 3 == 0, F.concat(body, F.lit("."))).otherwise(body))
    return manifests.compare(snapshot(body), before).select(
        "logical_name", "filename", "sha256", "status")


@query("d1_keep_first", over("annotated", """
    SELECT * EXCLUDE rn FROM (
        SELECT source_file, source_row_id, event_ts, event_date, station, code_clean, min_delay,
               min_gap, bound, vehicle_id, line_raw, row_number() OVER (
            PARTITION BY event_ts, station, code_clean, min_delay, vehicle_id, line_raw
            ORDER BY source_ord, source_row_id) AS rn
        FROM annotated WHERE NOT is_reject) WHERE rn = 1"""))
def keep_first(spark, sf_dir):
    keys = ["event_ts", "station_clean", "code_clean", "min_delay", "vehicle_id", "line_raw"]
    typed = silver.keyed(annotated(spark, sf_dir), keys)
    kept = silver.first_of_keyed(silver.accepted(typed), keys, silver.SOURCE_ORDER)
    return kept.select(
        "source_file", "source_row_id", "event_ts", "event_date",
        F.col("station_clean").alias("station"), "code_clean", "min_delay", "min_gap",
        F.col("bound_clean").alias("bound"), "vehicle_id", "line_raw")


@query("d1_keep_first_without_row_id", """
    SELECT * EXCLUDE rn FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY
            l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag,
            l_linestatus, l_shipdate) AS rn
        FROM lineitem) WHERE rn = 1""")
def keep_first_without_row_id(spark, sf_dir):
    """lineitem repeats (order, line) pairs and has no row id."""
    keys = ["l_orderkey", "l_linenumber"]
    rows = silver.with_key_hash(table(spark, sf_dir, "lineitem"), keys)  # a table as it is needs no copy
    return silver.first_of_keyed(rows, keys).drop(silver.KEY_HASH)


@query("d2_duplicate_rows", """
    SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (SELECT DISTINCT text, lang, source FROM documents))
             AS repeated FROM documents""")
def duplicate_rows(spark, sf_dir):
    documents = table(spark, sf_dir, "documents").select("text", "lang", "source")
    repeated = quality.repeated_rows(documents)
    return documents.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(repeated).cast("bigint").alias("repeated"))


@query("d2_duplicate_rows_many", """
    SELECT count(*) AS rows, count(*) - (SELECT count(*) FROM (
             SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem)) AS repeated FROM lineitem""")
def duplicate_rows_many(spark, sf_dir):
    """Too many suspects to broadcast: all rows are grouped."""
    pairs = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber")
    repeated = quality.repeated_rows(pairs, broadcast_hashes=1)
    return pairs.agg(
        F.count(F.lit(1)).alias("rows"), F.lit(repeated).cast("bigint").alias("repeated"))


@query("d3_bag_union", over("bronze", """
    SELECT date, station, code, line, min_delay, source_file, source_ord FROM bronze"""))
def bag_union(spark, sf_dir):
    texts = [(n, bronze_layer.unify_text(df)) for n, df in feeds(spark, sf_dir)]
    return bronze_layer.union_sources(texts).select(
        "date", "station", "code", "line", "min_delay", "source_file", "source_ord")
