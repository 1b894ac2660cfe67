"""One key, code, row or month holding a third of everything."""

import datetime as dt
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marlstone.operators import gold, quality, silver
from marlstone.registry.inputs import text_feed
from marlstone.sources import bronze, sinks

N = 60_000


@pytest.fixture(scope="module")
def hot(spark):
    """A third of the rows are one incident; the rest are spread thin."""
    i = F.col("id")
    third = i % 3 == 0
    return spark.range(0, N, 1, 24).select(
        i.alias("source_row_id"),
        F.when(third, 0).otherwise(i % 5000).alias("k"),
        F.when(third, "HOT").otherwise(F.concat(F.lit("S"), i % 400)).alias("station"),
        F.when(third, "HOT").otherwise(F.concat(F.lit("C"), i % 900)).alias("code_clean"),
        F.lit("L").alias("line_canonical"),
        F.expr("date_add(date'2024-01-01', cast(if(id % 3 = 0, 0, id % 700) as int))").alias("event_date"),
        (i % 7).cast("int").alias("min_delay"))


def python_rows():
    for i in range(N):
        third = i % 3 == 0
        yield (i, 0 if third else i % 5000, "HOT" if third else f"S{i % 400}",
               "HOT" if third else f"C{i % 900}",
               dt.date(2024, 1, 1) + dt.timedelta(days=0 if third else i % 700), i % 7)


def test_keep_first_of_a_hot_key(spark, hot):
    first = {}
    for i, k, *_ in python_rows():
        first.setdefault(k, i)
    got = {r["k"]: r["source_row_id"] for r in silver.keep_first(hot, ["k"], ["source_row_id"]).collect()}
    assert got == first


def test_a_hot_key_reaches_the_shuffle_once_per_task(spark, hot):
    """The group limit leaves at most one row per key and task to send."""
    kept = silver.keep_first(hot, ["station"], ["source_row_id"], broadcast_keys=0)
    kept.collect()
    text = kept._sc._jvm.PythonSQLUtils.explainString(kept._jdf.queryExecution(), "simple")
    assert "WindowGroupLimit" in text.split("Exchange")[-1]


@pytest.mark.parametrize("limit", [0, 10 ** 9])
def test_lookup_with_a_hot_code_keeps_every_row(spark, hot, limit):
    dimension = spark.createDataFrame([("HOT", "hot"), ("C1", "one")], "code_clean string, code_description string")
    small_cluster = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100k",
        "spark.sql.autoBroadcastJoinThreshold": "-1",
    }
    for name, value in small_cluster.items():
        spark.conf.set(name, value)
    try:
        wide = hot.withColumn("pad", F.sha2(F.col("source_row_id").cast("string"), 512))
        counted = silver.lookup(wide, dimension, "code_clean", limit).groupBy("code_description").agg(
            F.count(F.lit(1)).alias("n"), F.max(F.length("pad")))
        counts = {r["code_description"]: r["n"] for r in counted.collect()}
        final = counted._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in small_cluster:
            spark.conf.unset(name)
    # past the broadcast bound the hot code's rows are spread over several tasks
    assert ("SortMergeJoin(skew=true)" in final) == (limit == 0)
    expected = Counter({"HOT": "hot", "C1": "one"}.get(r[3]) for r in python_rows())
    assert counts == dict(expected)


@pytest.mark.parametrize("limit", [0, quality.BROADCAST_HASHES])
def test_hot_copies_are_counted_in_full(spark, hot, limit):
    df = hot.select("k", "station", "min_delay")
    rows = pd.DataFrame([(r[1], r[2], r[5]) for r in python_rows()])
    assert quality.repeated_rows(df, limit) == int(rows.duplicated().sum())


def test_long_tail_and_coverage_with_a_hot_value(spark, hot):
    counts = Counter(r[3] for r in python_rows())
    row = quality.long_tail(quality.value_counts(hot, "code_clean"), 44).first()
    assert tuple(row) == (N, sum(n for n in counts.values() if n <= 44))
    reference = spark.createDataFrame([("hot",), ("c5",)], "v string")
    assert quality.coverage(quality.value_counts(hot, "code_clean"), reference).first()["hits"] == counts["HOT"] + counts["C5"]


def test_rankings_with_a_hot_station(spark, hot):
    total, count = Counter(), Counter()
    for _, _, station, _, day, delay in python_rows():
        total[day.year, station] += delay
        count[day.year, station] += 1
    expected = []
    for year in (2024, 2025):
        best = sorted((k for k in total if k[0] == year), key=lambda k: (-total[k], k[1]))[:15]
        expected += [(year, "L", s, count[y, s], total[y, s]) for y, s in best]
    assert [tuple(r)[:5] for r in gold.top_stations(hot).collect()] == expected


def test_a_hot_month_is_split_over_files(spark, hot, tmp_path):
    """A partition too big for one task is written by several."""
    path = tmp_path / "bronze"
    keyed = hot.withColumns({
        "partition_year": F.lit(2024),
        "partition_month": F.when(F.col("code_clean") == "HOT", 1).otherwise(2 + F.col("k") % 11).cast("int"),
        "pad": F.sha2(F.col("source_row_id").cast("string"), 512)})
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "300k")
    try:
        sinks.write_partitioned(keyed, str(path))
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    january = list((path / "partition_year=2024" / "partition_month=1").glob("*.parquet"))
    assert len(january) > 1
    assert spark.read.parquet(str(path)).count() == N


def test_whole_feed_survives_unification(spark, sf_dir):
    feed = text_feed(spark, sf_dir)
    assert bronze.unify([("text", feed)]).count() == feed.count()


def test_random_keep_first_is_stable_over_partitionings(spark):
    rng = random.Random(4)
    rows = [(rng.randint(0, 40), rng.choice("ab"), rng.randint(0, 9)) for _ in range(2000)]
    df = spark.createDataFrame(rows, "k int, a string, b int")
    results = {tuple(sorted(map(tuple, silver.keep_first(df.repartition(n), ["k"]).collect()))) for n in (1, 3, 11)}
    assert len(results) == 1
