"""The physical plans we rely on at scale."""

import re

import pytest
from frames import bronze_frame, code_frame, random_silver, silver_frame
from pyspark.sql import functions as F

from marlstone.operators import explore, gold, joins, silver
from marlstone.registry import catalog
from marlstone.registry.inputs import clicks, shipments
from marlstone.sources import sinks


def plan(df, mode="formatted"):
    return df._sc._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def initial(df):
    """The plan before adaptive execution changes it."""
    return plan(df, "simple")


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("plans") / "silver")
    clean, _ = silver.build_silver(bronze_frame(spark), code_frame(spark))
    sinks.write_silver(clean, path)
    return sinks.read_silver(spark, path)


def test_no_query_leaves_the_jvm(spark, sf_dir):
    for name in ("p1_clean_whole_documents", "p4_mojibake_repair", "p11_silver_projection",
                 "t5_top_stations_by_quarter_line", "s2_typed_source", "t7_rolling_daily"):
        text = plan(catalog.QUERIES[name](spark, sf_dir))
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|MapInPandas|PythonUDF", text), name


@pytest.mark.parametrize("model, columns", [
    (gold.monthly_trend, {"event_year_month", "min_delay"}),
    (gold.delays_by_station, {"station", "min_delay"}),
    (gold.delays_by_hour, {"event_hour", "min_delay"}),
])
def test_gold_reads_only_its_columns(stored, model, columns):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(model(stored))).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == columns


def test_blank_filter_reaches_the_scan(stored):
    pushed = re.search(r"PushedFilters: \[(.*)\]", plan(gold.delays_by_station(stored))).group(1)
    assert "Not(EqualTo(station,))" in pushed


def test_period_prunes_folders_and_pushes_the_range(stored):
    text = plan(explore.daily_series(stored, "2021-Q1", "UNKNOWN"))
    folders = re.search(r"PartitionFilters: \[(.*)\]", text).group(1)
    assert "partition_year" in folders and "partition_month" in folders
    pushed = re.search(r"PushedFilters: \[(.*)\]", text).group(1)
    assert "GreaterThanOrEqual(event_date,2021-01-01)" in pushed
    assert "LessThan(event_date,2021-04-01)" in pushed and "EqualTo(line_canonical,UNKNOWN)" in pushed


def test_limits_are_top_k_not_full_sorts(stored):
    assert "TakeOrderedAndProject" in plan(gold.delays_by_code(stored))
    assert "TakeOrderedAndProject" in plan(explore.rank_stations(stored))


def test_rankings_and_dedupe_cut_groups_before_the_shuffle(stored, spark):
    for df in (gold.top_stations(stored), silver.keep_first(stored, ["station"]),
               silver.keep_first(stored, ["station"], broadcast_keys=0)):
        kinds = re.findall(r"WindowGroupLimit .*?(Partial|Final)", initial(df))
        assert sorted(kinds) == ["Final", "Partial"]


def test_dedupe_sorts_only_rows_with_a_repeated_key(stored):
    once = silver.keep_first(stored.select("source_file", "event_ts").distinct(), ["source_file", "event_ts"])
    assert "Window" not in initial(once)
    text = initial(silver.keep_first(stored, ["station"]))
    # the union's first branch, drawn with a line beside it, lets single rows pass
    alone = "\n".join(line for line in text.split("Union")[1].splitlines() if line.lstrip().startswith(":"))
    assert "LeftAnti" in alone and "Sort" not in alone and "hashpartitioning" not in alone
    assert "LeftSemi" in text and text.count("Window ") == 1


def test_no_aggregate_sits_on_a_sort(stored):
    """Silver's measure is a double, so a sort below a sum would stay in the plan."""
    assert dict(stored.dtypes)["min_delay"] == "double"
    for df in (explore.rolling_daily(stored), explore.headline_totals(gold.line_totals(stored, "quarter"), "2021"),
               explore.roll_up(gold.line_hours(stored), "event_hour"), explore.top_line_share(stored)):
        assert "rangepartitioning" not in initial(df)


def test_single_distinct_counts_do_not_expand_silver(stored):
    assert "Expand" not in plan(gold.totals_by_line(stored))
    assert "Expand" not in plan(gold.daily_summary(stored))
    # the headline expands after silver was reduced to (line, station) pairs
    below = initial(gold.headline(stored)).split("Expand")[1]
    assert re.search(r"keys=\[line_canonical#\d+, station#\d+\]", below)


def test_no_aggregate_sorts_silver(stored):
    for df in (gold.delays_by_code(stored), gold.top_codes(stored, "quarter"), gold.code_cube(stored),
               gold.station_cube(stored), gold.time_cube(stored), gold.headline(stored)):
        nearest = [n for n in initial(df).splitlines() if "Aggregate(" in n][-1]
        assert "HashAggregate" in nearest, nearest


def test_lookup_broadcasts_only_below_the_measured_bound(spark):
    dimension = silver.code_dimension(code_frame(spark))
    size = joins.measured_bytes(dimension)
    assert 0 < size < 1000
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        typed = silver.type_columns(bronze_frame(spark))
        assert "BroadcastHashJoin" in initial(joins.lookup(typed, dimension, "code_clean"))
        assert "BroadcastHashJoin" not in initial(joins.lookup(typed, dimension, "code_clean", size - 1))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_no_window_runs_over_raw_rows_in_one_partition(spark, sf_dir):
    for df in (explore.rolling_daily(shipments(spark, sf_dir)), gold.top_codes(shipments(spark, sf_dir))):
        text = initial(df)
        assert "Window" in text
        assert "SinglePartition" not in text


def test_typing_is_whole_stage_code(spark, sf_dir):
    text = plan(silver.type_columns(bronze_frame(spark)), "formatted")
    assert "codegen id" in text


def test_the_bronze_write_is_rebalanced_not_hash_fixed(spark):
    df = bronze_frame(spark).withColumns({"partition_year": F.lit(2025), "partition_month": F.lit(1)})
    assert "REBALANCE_PARTITIONS_BY_COL" in initial(
        df.hint("rebalance", F.col("partition_year"), F.col("partition_month")))


def test_clicks_scan_only_what_is_needed(spark, sf_dir):
    read = re.search(r"ReadSchema: struct<([^>]*)>", plan(gold.delays_by_hour(clicks(spark, sf_dir)))).group(1)
    assert {c.split(":")[0] for c in read.split(",")} == {"event_id", "ts", "value"}


def test_silver_frame_is_usable_without_layout_columns(spark):
    rows = random_silver()
    assert explore.in_period(silver_frame(spark, rows), "2024").count() == sum(r[0].year == 2024 for r in rows)
