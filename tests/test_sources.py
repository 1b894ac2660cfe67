import hashlib

import pytest
from pyspark.sql import functions as F

from marlstone.config import REQUIRED_COLUMNS, FeedConfig, SourceSpec
from marlstone.functions import casting
from marlstone.operators import joins
from marlstone.sources import bronze, manifest, readers, sinks

HEADER = "_id,Date,Time,Day,Station,Code,Min Delay,Min Gap,Bound,Line,Vehicle\n"


def feed(path, *rows, header=HEADER):
    path.write_text(header + "".join(r + "\n" for r in rows), encoding="utf-8")
    return str(path)


def test_csv_keeps_text_as_published(spark, tmp_path):
    path = feed(tmp_path / "a.csv",
                '1,2024-01-02,08:15,Tue,"GATE, ""NINE""",NA,007,,N,YU,',
                "2,2024-01-03,09:00,Wed, padded ,A1,3,5,,BD,12")
    rows = readers.read_source(spark, SourceSpec("a", path)).orderBy("date").collect()
    assert rows[0]["station"] == 'GATE, "NINE"' and rows[0]["code"] == "NA"
    assert rows[0]["min_delay"] == "007" and rows[0]["min_gap"] == "" and rows[0]["vehicle"] == ""
    assert rows[1]["station"] == " padded " and rows[1]["bound"] == ""
    assert "_id" not in rows[0].asDict() and "min_delay" in rows[0].asDict()


def test_quoted_line_breaks_are_found_and_read(spark, tmp_path):
    plain = feed(tmp_path / "plain.csv", '1,d,t,x,"a ""b"" c",c,1,1,n,l,v')
    broken = feed(tmp_path / "broken.csv", '1,d,t,x,"two\nlines",c,1,1,n,l,v', "2,d,t,x,one,c,1,1,n,l,v")
    assert not readers.has_quoted_line_breaks(spark, plain)
    assert readers.has_quoted_line_breaks(spark, broken)
    stations = {r["station"] for r in readers.read_source(spark, SourceSpec("b", broken)).collect()}
    assert stations == {"two\nlines", "one"}


def test_files_with_other_headers_are_not_lined_up_by_position(spark, tmp_path):
    (tmp_path / "f").mkdir()
    (tmp_path / "f" / "a.csv").write_text("x,y\n1,2\n")
    (tmp_path / "f" / "b.csv").write_text("y,x\n2,1\n")
    with pytest.raises(Exception, match="header"):
        readers.read_source(spark, SourceSpec("f", str(tmp_path / "f"))).collect()


def test_row_ids_follow_file_order_across_splits(spark, tmp_path):
    path = feed(tmp_path / "big.csv", *[f"{i},d,t,x,s{i},c,1,1,n,l,v" for i in range(3000)])
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "7000")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        df = readers.read_source(spark, SourceSpec("big", path))
        assert df.rdd.getNumPartitions() > 3
        order = [r["station"] for r in df.orderBy(readers.ROW_ID).select("station").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
    assert order == [f"s{i}" for i in range(3000)]


def test_header_normalisation(spark):
    assert readers.normalise_name("﻿ Min \t Delay ") == "min_delay"
    df = spark.createDataFrame([(1, 2)], "`_ID` int, `Vehicle No` int")
    assert readers.normalise_columns(df).columns == ["vehicle_no"]


def test_missing_columns_are_named(spark):
    df = spark.createDataFrame([("a",)], "date string")
    with pytest.raises(ValueError, match=r"lack required columns: \['time'"):
        bronze.require_columns(df)


def test_feeds_of_different_types_become_one_text_table(spark):
    typed = spark.sql("""
        SELECT DATE'2024-01-02' AS date, '08:15' AS time, 'Tue' AS day, 'S' AS station, 'A' AS code,
               5 AS min_delay, CAST(NULL AS DOUBLE) AS min_gap, 'N' AS bound, 'YU' AS line,
               CAST(7 AS BIGINT) AS vehicle, 1.5 AS extra""")
    text = spark.sql("""
        SELECT 'n/a' AS date, '' AS time, '' AS day, 'T' AS station, 'B' AS code, 'x' AS min_delay,
               '2' AS min_gap, CAST(NULL AS STRING) AS bound, 'BD' AS line, '' AS vehicle, 'e' AS extra""")
    out = bronze.unify([("one", typed), ("two", text)])
    assert all(out.schema[c].dataType.simpleString() == "string" for c in REQUIRED_COLUMNS)
    first, second = out.orderBy("source_ord").collect()
    assert (first["date"], first["min_delay"], first["min_gap"], first["vehicle"]) == ("2024-01-02", "5", "", "7")
    assert (first["partition_year"], first["partition_month"], first["source_file"]) == (2024, 1, "one")
    assert (second["partition_year"], second["partition_month"], second["bound"]) == (0, 0, "")
    assert (first["extra"], second["extra"]) == ("1.5", "e")


def test_a_column_only_one_feed_has_survives(spark):
    base = spark.createDataFrame([tuple("x" for _ in REQUIRED_COLUMNS)], list(REQUIRED_COLUMNS))
    out = bronze.unify([("one", base), ("two", base.withColumn("note", F.lit("n")))])
    assert sorted(r["note"] or "" for r in out.collect()) == ["", "n"]


def test_partitioned_sink_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "bronze")
    rows = [(2024, 1, "a"), (2024, 2, "b"), (2024, 2, "c"), (0, 0, "bad")]
    schema = "partition_year int, partition_month int, v string"
    sinks.write_partitioned(spark.createDataFrame(rows, schema), path)
    sinks.write_partitioned(spark.createDataFrame([(2024, 2, "new")], schema), path)
    got = {(r["partition_month"], r["v"]) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "a"), (2, "new"), (0, "bad")}


def test_partitioned_sink_writes_few_files(spark, tmp_path):
    path = tmp_path / "files"
    df = spark.range(0, 20000, 1, 16).select(
        F.lit(2024).alias("partition_year"), (F.col("id") % 12 + 1).cast("int").alias("partition_month"), "id")
    sinks.write_partitioned(df, str(path))
    files = list(path.rglob("*.parquet"))
    assert 12 <= len(files) <= 24, len(files)


def test_silver_lies_by_line_and_station_within_a_month(spark, tmp_path):
    import pyarrow.parquet as pq
    from frames import bronze_frame, code_frame, raw_feed

    from marlstone.operators import explore, silver

    rows, _ = silver.build_silver(bronze_frame(spark, raw_feed(2000)), code_frame(spark))
    day = F.make_date(F.lit(2021), F.lit(5), F.dayofmonth("event_date"))
    path = tmp_path / "silver"
    spark._jsc.hadoopConfiguration().setInt("parquet.block.size", 1024)
    try:
        sinks.write_silver(rows.withColumn("event_date", day), str(path))
    finally:
        spark._jsc.hadoopConfiguration().unset("parquet.block.size")
    stored = sinks.read_silver(spark, str(path))
    keys = [(r["line_canonical"], r["station"]) for r in stored.coalesce(1).collect()]
    assert keys == sorted(keys) and len(set(keys)) > 10
    (file,) = path.rglob("*.parquet")
    groups = pq.ParquetFile(file).metadata
    at = groups.schema.names.index("line_canonical")
    spans = [groups.row_group(i).column(at).statistics for i in range(groups.num_row_groups)]
    for line in {k for k, _ in keys}:
        read = sum(groups.row_group(i).num_rows for i, s in enumerate(spans) if s.min <= line <= s.max)
        own = sum(k == line for k, _ in keys)
        assert own <= read <= own + 2 * max(groups.row_group(i).num_rows for i in range(groups.num_row_groups))
    assert explore.select_rows(stored, line=keys[0][0]).count() == sum(k == keys[0][0] for k, _ in keys)


def test_empty_table_replaces_the_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_table(spark.range(3), path)
    sinks.write_table(spark.range(0), path)
    assert spark.read.parquet(path).count() == 0


def test_dataset_loader(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "d.parquet"))
    assert readers.load_dataset(spark, str(tmp_path / "d.parquet")).count() == 3
    (tmp_path / "d.csv").write_text("ts,n\n2024-01-01 08:00,5\n2024-01-02 08:00,6\n")
    loaded = readers.load_dataset(spark, str(tmp_path / "d.csv"))
    assert dict(loaded.dtypes)["n"] == "int"
    spark.range(2).createOrReplaceTempView("loader_view")
    assert readers.load_dataset(spark, "x.db", table="loader_view").count() == 2
    with pytest.raises(ValueError, match="say which table"):
        readers.load_dataset(spark, "x.duckdb")
    with pytest.raises(ValueError, match="cannot load '.xml'"):
        readers.load_dataset(spark, "x.xml")


def test_manifest_hashes_and_statuses(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    (raw / "a.csv").write_text("one")
    (raw / "b.csv").write_text("two")
    files = {"a": str(raw / "a.csv"), "b": str(raw / "b.csv")}
    first = manifest.compare(manifest.scan_files(spark, files), manifest.empty_manifest(spark))
    kept = {r["logical_name"]: r for r in first.collect()}
    assert kept["a"]["sha256"] == hashlib.sha256(b"one").hexdigest()
    assert kept["a"]["bytes"] == 3 and {r["status"] for r in kept.values()} == {"downloaded"}
    stored = spark.createDataFrame(list(kept.values()), manifest.MANIFEST_SCHEMA)

    (raw / "b.csv").write_text("TWO")
    second = manifest.compare(manifest.scan_files(spark, files), stored)
    assert {r["logical_name"]: r["status"] for r in second.collect()} == {
        "a": "unchanged_skipped", "b": "downloaded"}
    assert [r["logical_name"] for r in manifest.changed_files(second).collect()] == ["b"]


def test_a_file_larger_than_one_read_is_hashed_whole(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(manifest, "CHUNK_BYTES", 1000)
    content = bytes(range(256)) * 40
    (tmp_path / "big file.csv.gz").write_bytes(content)
    row = manifest.scan_files(spark, {"big": str(tmp_path / "big file.csv.gz")}).first()
    assert (row["sha256"], row["bytes"]) == (hashlib.sha256(content).hexdigest(), len(content))


def test_one_row_per_file_however_often_a_nested_feed_is_scanned(spark, tmp_path):
    names = [f"k={k}/{part}.csv" for k in range(3) for part in ("a", "b")]
    for name in names:
        (tmp_path / "raw" / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / "raw" / name).write_text(name)
    stored = manifest.empty_manifest(spark)
    for turn in range(4):
        rows = manifest.compare(manifest.scan_files(spark, {"feed": str(tmp_path / "raw")}), stored).collect()
        assert sorted(r["filename"] for r in rows) == names
        assert all(r["sha256"] == hashlib.sha256(r["filename"].encode()).hexdigest() for r in rows)
        assert {r["status"] for r in rows} == {"unchanged_skipped" if turn else "downloaded"}
        stored = spark.createDataFrame(rows, manifest.MANIFEST_SCHEMA)
    (tmp_path / "raw" / names[0]).unlink()
    current = manifest.scan_files(spark, {"feed": str(tmp_path / "raw")})
    assert [r["filename"] for r in manifest.gone_files(current, stored).collect()] == [names[0]]
    # a glob and a relative path name files by what follows their fixed part
    globbed = manifest.scan_files(spark, {"feed": str(tmp_path / "raw" / "k=1*")})
    assert sorted(r["filename"] for r in globbed.collect()) == names[2:4]


@pytest.mark.parametrize("root, names", [
    ("raw", ["a/part.csv", "b/part.csv", "c1/x/part.csv"]), ("raw/", ["a/part.csv", "b/part.csv", "c1/x/part.csv"]),
    ("raw/*/part.csv", ["a/part.csv", "b/part.csv"]), ("raw/?", ["a/part.csv", "b/part.csv"]),
    ("raw/[ab]/part.csv", ["a/part.csv", "b/part.csv"]), ("raw/{a,b,a}", ["a/part.csv", "b/part.csv"]),
    ("raw/c[1-9]", ["c1/x/part.csv"]), ("raw/a/part.csv", ["part.csv"]), ("raw/a/par?.csv", ["part.csv"]),
])
def test_every_file_has_one_key_under_every_kind_of_root(spark, tmp_path, root, names):
    for name in ("a/part.csv", "b/part.csv", "c1/x/part.csv"):
        file = tmp_path / "raw" / "raw" / name  # the folder's own name occurs twice in the address
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(name)
    stored = manifest.empty_manifest(spark)
    for turn in range(4):
        found = manifest.scan_files(spark, {"feed": str(tmp_path / "raw") + "/" + root})
        rows = manifest.compare(found, stored).collect()
        assert sorted(r["filename"] for r in rows) == names
        assert {r["status"] for r in rows} == {"unchanged_skipped" if turn else "downloaded"}
        stored = spark.createDataFrame(rows, manifest.MANIFEST_SCHEMA)


def test_files_share_tasks_by_size(spark, tmp_path):
    for i in range(40):
        (tmp_path / f"{i}.csv").write_text(str(i))
    rows = manifest.scan_files(spark, {"feed": str(tmp_path)})
    assert rows.rdd.getNumPartitions() <= spark.sparkContext.defaultParallelism
    assert {r["filename"]: r["sha256"] for r in rows.collect()} == {
        f"{i}.csv": hashlib.sha256(str(i).encode()).hexdigest() for i in range(40)}


def test_reference_codes(spark):
    df = spark.createDataFrame([(" b",), ("A ",), ("B",)], "code string")
    assert [r["code"] for r in readers.reference_codes(df).collect()] == ["A", "B"]


def test_shared_dir_comes_from_the_session(spark):
    assert sinks.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


class Session:
    """As much of a session as shared_dir looks at."""

    def __init__(self, master, folder=None):
        session = self

        class Context:
            def getCheckpointDir(self):
                return session.folder

            def setCheckpointDir(self, path):
                session.folder = path + "/run"

        self.sparkContext, self.conf, self.folder = Context(), {}, folder
        self.sparkContext.master = master


def test_only_a_local_session_gets_a_temporary_shared_dir():
    local = Session("local[4]")
    first = sinks.shared_dir(local)
    assert first and sinks.shared_dir(local) == first
    for master in ("spark://host:7077", "yarn", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            sinks.shared_dir(Session(master))
        named = Session(master)
        named.conf = {"spark.checkpoint.dir": "hdfs://shared/work/"}
        assert sinks.shared_dir(named) == "hdfs://shared/work"


def test_options_of_a_source_go_before_the_readers_own(spark, tmp_path):
    path = feed(tmp_path / "f.csv", r"1;2;'a \'b\' c'", header="x;y;z\n")
    spec = SourceSpec("f", path, options={"sep": ";", "quote": "'", "escape": "\\"})
    assert readers.read_source(spark, spec).first()["z"] == "a 'b' c"
    assert readers.read_source(spark, SourceSpec("f", path, options={"header": "false", "multiLine": "true"})).count() == 2


def test_only_files_with_line_breaks_lose_their_splits(spark, tmp_path):
    (tmp_path / "f").mkdir()
    for i in range(10):
        rows = [f"{i},{k},t,x,s{k},c,1,1,n,l,v" for k in range(400)]
        feed(tmp_path / "f" / f"{i}.csv", *rows, *(['9,d,t,x,"two\nlines",c,1,1,n,l,v'] if i == 3 else []))
    settings = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "0"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        df = readers.read_source(spark, SourceSpec("f", str(tmp_path / "f")))
        assert df.rdd.getNumPartitions() > 20
        stations = [r["station"] for r in df.collect()]
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert len(stations) == 4001 and stations.count("two\nlines") == 1


def test_instants_do_not_move_with_the_session_zone(spark):
    zone = spark.conf.get("spark.sql.session.timeZone")
    seen = set()
    try:
        for name in ("UTC", "America/Toronto", "Asia/Tokyo"):
            spark.conf.set("spark.sql.session.timeZone", name)
            df = spark.sql("SELECT timestamp_micros(1704160800000000) AS v")  # 2024-01-02 02:00 at offset zero
            text = bronze.unify_text(df, ["v"]).first()["v"]
            stamp = df.select(casting.parse_timestamp(F.col("v"), df.schema["v"].dataType).cast("string").alias("s"))
            seen.add((text, stamp.first()["s"]))
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
    assert seen == {("2024-01-02", "2024-01-02 02:00:00")}


def test_wide_values_are_measured(spark):
    wide = spark.createDataFrame([(1, ["x" * 1000] * 50, {"k": "y" * 5000}, bytearray(3000))],
                                 "k int, a array<string>, m map<string,string>, b binary")
    assert joins.measured_bytes(wide) > 50_000 + 5000 + 3000
