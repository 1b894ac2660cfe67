import datetime as dt
import json
from collections import Counter
from dataclasses import replace

import pytest
from frames import CODES, plain_silver, raw_feed, raw_row
from pyspark.sql import functions as F

from marlstone.config import SILVER_COLUMNS, FeedConfig, SourceSpec
from marlstone.operators import quality
from marlstone.plans import medallion

HEADER = "_id,Date,Time,Day,Station,Code,Min Delay,Min Gap,Bound,Line,Vehicle\n"
RUN_DATE = dt.date(2022, 12, 20)
TYPED = [
    (dt.date(2022, 12, 1 + i), f"0{i}:30", "Day", "Harbour", "q5", i, float(i), "n", "YU", i) for i in range(4)]
TYPED_DDL = ("`Date` date, `Time` string, `Day` string, `Station` string, `Code` string, `Min Delay` int, "
             "`Min Gap` double, `Bound` string, `Line` string, `Vehicle` int")


def write_feed(path, rows):
    path.write_text(HEADER + "".join(",".join([str(i), *r]) + "\n" for i, r in enumerate(rows)))


@pytest.fixture()
def cfg(spark, tmp_path):
    write_feed(tmp_path / "feed.csv", raw_feed())
    (tmp_path / "codes.csv").write_text("_id,CODE,DESCRIPTION\n" + "".join(
        f"{i},{code},{text or ''}\n" for i, code, text in CODES))
    spark.createDataFrame(TYPED, TYPED_DDL).coalesce(1).write.parquet(str(tmp_path / "typed"))
    return FeedConfig(
        sources=(SourceSpec("typed", str(tmp_path / "typed"), "parquet"),
                 SourceSpec("feed.csv", str(tmp_path / "feed.csv"))),
        codes=SourceSpec("codes", str(tmp_path / "codes.csv")))


def expected():
    """Silver and rejects of both feeds in plain Python; the typed feed comes first."""
    typed = [(d.isoformat(), t, day, s, c, str(m), str(int(g)), b, line, str(v)) for d, t, day, s, c, m, g, b, line, v in TYPED]
    return plain_silver(typed + raw_feed(), [(i, c, t or "") for i, c, t in CODES])


def stored(spark, root):
    out = {}
    for name in ("silver/delays", "silver/rejects", "gold/daily_summary", "gold/delays_by_code",
                 "gold/delays_by_station", "gold/delays_by_line", "gold/monthly_trend", "gold/delays_by_hour"):
        out[name] = sorted(map(str, spark.read.parquet(f"{root}/{name}").collect()))
    return out


def test_run_from_raw_files(spark, cfg, tmp_path):
    root = str(tmp_path / "out")
    silver, bad = expected()
    n_raw = len(TYPED) + len(raw_feed())
    result = medallion.run(spark, cfg, root, RUN_DATE)
    assert result.report["row_counts"] == {
        "bronze": n_raw, "silver": len(silver), "silver_rejects_or_duplicates_removed": n_raw - len(silver)}
    columns = [c for c in SILVER_COLUMNS if c != "source_file"]
    assert sorted(map(str, map(tuple, result.silver.select(*columns).collect()))) == sorted(map(str, silver))
    assert result.rejects.count() == len(bad)
    assert [c.name for c in result.checks] == [c.name for c in quality.run_preset(
        spark.read.parquet(root + "/bronze"), result.silver, spark.createDataFrame([("Q5",)], "code string"), RUN_DATE)]
    assert spark.table("silver_delays").count() == len(silver)
    agreed = medallion.reconcile(result.cubes).first()
    assert agreed["incidents"] == len(silver) and agreed["incidents_agree"] and agreed["totals_agree"]
    assert agreed["total_delay_minutes"] == sum(r[8] for r in silver)
    report = spark.read.schema(medallion.REPORT_SCHEMA).json(root + "/reports/latest_run").first()
    assert report["checks_total"] == 10 and len(report["manifest_files"]) == 3
    days = [json.loads(r["row"]) for r in spark.read.json(root + "/export/daily_summary").collect()]
    per_day = Counter((r[1] - dt.date(1970, 1, 1)).days for r in silver)
    assert {d[0]: d[1] for d in days} == per_day
    assert not (tmp_path / "out" / "work" / "typed").exists()


def test_checks_from_cubes_equal_checks_from_silver(spark, cfg, tmp_path):
    result = medallion.run(spark, cfg, str(tmp_path / "out"), RUN_DATE)
    bronze = spark.read.parquet(str(tmp_path / "out" / "bronze"))
    codes = spark.createDataFrame([(c.strip().upper(),) for _, c, _ in CODES], "code string")
    plain = quality.run_preset(bronze, result.silver, codes, RUN_DATE)
    assert [c.to_dict() for c in result.checks] == [c.to_dict() for c in plain]


def test_iso_date_times_are_not_rejected(spark, tmp_path):
    rows = [raw_row(date=d, vehicle=str(i)) for i, d in enumerate(
        ["2022-05-01T00:00:00", "2022-05-01 00:00:00", "2022-05-02T10:11", "2022-05-03"])]
    write_feed(tmp_path / "feed.csv", rows)
    (tmp_path / "codes.csv").write_text("CODE,DESCRIPTION\nQ7,SIGNAL\n")
    cfg = FeedConfig(sources=(SourceSpec("f", str(tmp_path / "feed.csv")),),
                     codes=SourceSpec("codes", str(tmp_path / "codes.csv")), view_name="other_view")
    result = medallion.run(spark, cfg, str(tmp_path / "out"), RUN_DATE)
    assert result.rejects.count() == 0 and spark.table("other_view").count() == 4
    assert {r["partition_month"] for r in spark.read.parquet(str(tmp_path / "out" / "bronze")).collect()} == {5}


def written(root, *names):
    return {str(p): p.stat().st_mtime_ns for name in names for p in (root / name).rglob("*.parquet")}


def test_a_run_over_unchanged_files_writes_no_layer(spark, cfg, tmp_path):
    root = tmp_path / "out"
    first = medallion.run(spark, cfg, str(root), RUN_DATE)
    layers = ("bronze", "silver", "cubes", "gold", "rankings")
    before = written(root, *layers)
    second = medallion.run(spark, cfg, str(root), RUN_DATE + dt.timedelta(days=400))
    assert written(root, *layers) == before
    assert second.report["row_counts"] == first.report["row_counts"]
    # checks are made anew: the feed is old by now
    assert not next(c for c in second.checks if c.name == "freshness").passed
    # another configuration, or a file that is gone, runs again
    medallion.run(spark, replace(cfg, line_default="MULTI_LINE_OR_NETWORK"), str(root), RUN_DATE)
    assert written(root, *layers) != before


def test_running_again_changes_nothing(spark, cfg, tmp_path):
    root = str(tmp_path / "out")
    first = medallion.run(spark, cfg, root, RUN_DATE)
    before = stored(spark, root)
    second = medallion.run(spark, cfg, root, RUN_DATE)
    assert stored(spark, root) == before
    assert [c.to_dict() for c in second.checks] == [c.to_dict() for c in first.checks]
    assert all(f["changed"] > 0 for f in first.report["manifest_files"])
    assert all(f["changed"] == 0 for f in second.report["manifest_files"])


def test_months_gone_from_the_feeds_stay_in_bronze_but_not_in_silver(spark, cfg, tmp_path):
    root = str(tmp_path / "out")
    medallion.run(spark, cfg, root, RUN_DATE)
    months = {(r["partition_year"], r["partition_month"]) for r in spark.read.parquet(root + "/bronze").collect()}
    write_feed(tmp_path / "feed.csv", [raw_row(date="2024-04-02")])
    result = medallion.run(spark, cfg, root, RUN_DATE)
    assert {(r["partition_year"], r["partition_month"]) for r in spark.read.parquet(root + "/bronze").collect()} == (
        months | {(2024, 4)})
    assert {(r["event_date"].year, r["event_date"].month) for r in result.silver.collect()} == {(2022, 12), (2024, 4)}
    assert result.report["row_counts"]["bronze"] == len(TYPED) + 1


def test_time_ordered_feeds_give_the_same_silver(spark, cfg, tmp_path):
    gathered = medallion.run(spark, cfg, str(tmp_path / "a"), RUN_DATE)
    direct = medallion.run(spark, replace(cfg, time_ordered=True), str(tmp_path / "b"), RUN_DATE)
    assert sorted(map(str, direct.silver.collect())) == sorted(map(str, gathered.silver.collect()))


def test_gate_stops_the_export_but_not_the_report(spark, cfg, tmp_path):
    root = tmp_path / "out"
    with pytest.raises(quality.QualityGateError):
        medallion.run(spark, cfg, str(root), RUN_DATE, gate=True)
    assert (root / "reports" / "latest_run").exists() and not (root / "export").exists()


def test_shuffles_grow_with_the_input_and_are_put_back(spark):
    setting = "spark.sql.shuffle.partitions"
    before = spark.conf.get(setting)
    for raw, wanted in ((0, int(before)), (100 * 2**30, 400), (100 * 2**40, 409_600)):
        with medallion.sized_shuffles(spark, raw):
            assert int(spark.conf.get(setting)) == wanted
        assert spark.conf.get(setting) == before


def test_scans_of_layers_grow_with_their_rows_and_are_put_back(spark, tmp_path, monkeypatch):
    months = [f"{year}-{month:02d}-05" for year in (2021, 2022) for month in range(1, 13)]
    write_feed(tmp_path / "feed.csv", [raw_row(date=day) for day in months])
    (tmp_path / "codes.csv").write_text("_id,CODE,DESCRIPTION\n1,Q5,Text\n")
    cfg = FeedConfig(sources=(SourceSpec("feed.csv", str(tmp_path / "feed.csv")),),
                     codes=SourceSpec("codes", str(tmp_path / "codes.csv")))
    monkeypatch.setattr(medallion, "publish", lambda *a: None)
    tasks, before = [], spark.conf.get("spark.sql.files.minPartitionNum", None)
    monkeypatch.setattr(medallion, "typed_table", lambda rows, *a, f=medallion.typed_table: tasks.append(
        rows.rdd.getNumPartitions()) or f(rows, *a))
    monkeypatch.setattr(medallion, "SCAN_TARGET_ROWS", 1, raising=False)
    result = medallion.run(spark, cfg, str(tmp_path / "out"), RUN_DATE)
    assert tasks == [len(months)] and result.silver.count() == len(months)
    assert spark.conf.get("spark.sql.files.minPartitionNum", None) == before


def test_a_catalog_table_counts_with_its_size(spark):
    spark.range(200_000).createOrReplaceTempView("sized_feed")
    cfg = FeedConfig(sources=(SourceSpec("t", "sized_feed", "table"),))
    assert medallion.table_bytes(spark, cfg) >= 200_000 * 8


def test_views_of_unknown_size_are_measured(spark):
    local = spark.createDataFrame([(i, "x" * 100) for i in range(1000)], "a int, b string")
    local.createOrReplaceTempView("local_feed")
    spark.createDataFrame(spark.sparkContext.parallelize([(1, "a")] * 500), "a int, b string").createOrReplaceTempView(
        "rdd_feed")
    spark.range(50_000).createOrReplaceTempView("left_feed")
    spark.range(50_000).withColumn("v", F.lit(1)).createOrReplaceTempView("right_feed")
    spark.sql("SELECT * FROM left_feed JOIN right_feed USING (id)").createOrReplaceTempView("joined_feed")
    sizes = {name: medallion.table_bytes(spark, FeedConfig(sources=(SourceSpec("t", name, "table"),)))
             for name in ("local_feed", "rdd_feed", "joined_feed")}
    assert 100_000 <= sizes["local_feed"] < 1_000_000 and 0 < sizes["rdd_feed"] < 100_000
    assert 700_000 <= sizes["joined_feed"] < 10_000_000


def test_a_run_over_a_view_without_statistics(spark, cfg, tmp_path, monkeypatch):
    monkeypatch.setattr(medallion, "publish", lambda *a: None)
    spark.createDataFrame(TYPED, TYPED_DDL).createOrReplaceTempView("typed_feed_view")
    setting = "spark.sql.shuffle.partitions"
    before, used = spark.conf.get(setting), []
    monkeypatch.setattr(medallion, "build_bronze", lambda *a, f=medallion.build_bronze: used.append(
        spark.conf.get(setting)) or f(*a))
    views = replace(cfg, sources=(SourceSpec("typed", "typed_feed_view", "table"), cfg.sources[1]))
    result = medallion.run(spark, views, str(tmp_path / "out"), RUN_DATE)
    assert result.silver.count() == len(expected()[0])
    assert used == [before] == [spark.conf.get(setting)]
