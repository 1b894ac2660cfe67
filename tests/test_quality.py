import datetime as dt
import random
from collections import Counter

import pandas as pd
import pytest
from pyspark.sql import functions as F

from marlstone import run_checks
from marlstone.operators import quality
from marlstone.plans.check import check_dataset
from marlstone.registry import quality_queries

RUN_DATE = dt.date(2026, 5, 20)


def generated(n=120, seed=6):
    """(when, place, size): text times of which some do not parse, blanks, and rows that repeat."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        moment = dt.datetime(2026, 1, 1) + dt.timedelta(minutes=rng.randint(0, 190_000))
        rows.append((rng.choice([moment.isoformat(" ", "minutes")] * 9 + ["later"]), rng.choice(["P1", "P2", "P3", " "]),
                     rng.randint(-2, 40)))
        if rng.random() < 0.1:
            rows.append(rng.choice(rows))
    return rows


ROWS = generated()


@pytest.fixture(scope="module")
def sample(spark):
    return spark.createDataFrame(ROWS, "event_ts string, station string, amount bigint")


def one(df, config):
    results = run_checks(df, config, RUN_DATE)
    assert len(results) == 1
    return results[0]


def values(spark, vs, kind="string"):
    return spark.createDataFrame([(v,) for v in vs], f"v {kind}")


def test_a_suite_measures_what_plain_python_counts(sample):
    n = len(ROWS)
    times = [dt.datetime.fromisoformat(t) for t, *_ in ROWS if t != "later"]
    newest = max(times).date()
    config = {
        "long_tail": {"column": "station", "max_count": 20, "max_rate": 1.0},
        "not_blank_max_rates": {"station": 0.9}, "non_negative_columns": ["amount"], "layer": "made",
        "mapped_value_coverage": {"column": "station", "unknown_values": ["P1"], "min_rate": 0.1},
        "duplicate_max_rate": 0.5, "timestamp_column": "event_ts", "timestamp_parse_min_rate": 0.5,
        "reference_coverage": {"column": "station", "reference_values": ["p2", "P9"], "min_rate": 0.0},
        "freshness": {"date_column": "event_ts", "max_age_days": 400},
        "required_columns": ["event_ts", "amount", "absent"],
    }
    places = Counter(p for _, p, _ in ROWS)
    expected = {
        "schema_conformance": "2/3 required columns present",
        "timestamp_parse_rate": round(len(times) / n, 4),
        "station_null_rate": round(places[" "] / n, 4),
        "non_negative_amount": sum(a < 0 for *_, a in ROWS),
        "reference_coverage": round(places["P2"] / n, 4),
        "duplicate_rate": round((n - len(set(ROWS))) / n, 4),
        "mapped_value_coverage": round(1 - places["P1"] / n, 4),
        "freshness": f"max event_ts {newest.isoformat()}, {(RUN_DATE - newest).days} days before run date",
        "long_tail_rate": round(sum(c for c in places.values() if c <= 20) / n, 4),
    }
    results = run_checks(sample, config, RUN_DATE)
    # reported in a fixed order, whatever the order of the configuration
    assert [(r.name, r.measured) for r in results] == list(expected.items())
    assert {r.layer for r in results} == {"made"}
    assert [r.name for r in results if not r.passed] == ["schema_conformance", "non_negative_amount"]


def test_names_with_dots_and_backticks(spark):
    df = spark.createDataFrame([("2026-05-01", "", -1.0)] * 2, "`when.at` string, `a``b` string, `min.delay` double")
    results = run_checks(df, {
        "timestamp_column": "when.at", "not_blank_max_rates": {"a`b": 0.1}, "non_negative_columns": ["min.delay"],
        "reference_coverage": {"column": "a`b", "reference_values": ["x"], "min_rate": 0.1}, "duplicate_max_rate": 0.1,
        "mapped_value_coverage": {"column": "a`b", "min_rate": 0.1},
        "freshness": {"date_column": "when.at", "max_age_days": 100},
        "volume_anomaly": {"period_column": "when.at", "max_deviation": 1},
        "long_tail": {"column": "min.delay", "max_count": 1, "max_rate": 0.1}}, RUN_DATE)
    assert len(results) == 9 and results[2].measured == 2


def test_nan_is_a_missing_number(spark):
    nan = float("nan")
    r = one(values(spark, [1.0, nan], "double"), {"long_tail": {"column": "v", "max_count": 5, "max_rate": 0.5}})
    assert r.measured == 0.5 and r.passed
    periods = [float(i) for i in range(9) for _ in range(10)] + [nan] * 500
    r = one(values(spark, periods, "double"), {"volume_anomaly": {"period_column": "v", "max_deviation": 0.1}})
    assert r.passed and r.measured == 0.0


def test_unknown_keys_are_rejected(sample):
    with pytest.raises(ValueError, match=r"Unknown config keys: \['requierd_columns'\]"):
        run_checks(sample, {"requierd_columns": ["event_ts"]})


def test_only_named_checks_run(sample):
    assert run_checks(sample, {"layer": "x", "dataset_name": "y"}) == []


def test_schema_conformance_needs_no_data(sample):
    r = one(sample, {"required_columns": ["event_ts", "other"]})
    assert not r.passed and r.measured == "1/2 required columns present" and r.layer == "dataset"


def test_negative_rows_are_counted_and_text_is_ignored(spark, sample):
    r = one(sample.withColumn("amount", F.col("amount") - 4), {"non_negative_columns": ["amount"]})
    assert not r.passed and r.measured == sum(a < 4 for *_, a in ROWS) and r.threshold == "== 0"
    assert one(values(spark, ["-1", "x", "", None, "-2d", "nan"]), {"non_negative_columns": ["v"]}).measured == 1


def test_null_is_not_blank(spark):
    r = one(values(spark, ["", " \t", None, "x"]), {"not_blank_max_rates": {"v": 0.5}})
    assert r.name == "v_null_rate" and r.measured == 0.5 and r.passed


def test_passing_is_decided_on_the_unrounded_rate(spark):
    df = spark.range(30001).select(F.when(F.col("id") == 0, "").otherwise("x").alias("v"))
    r = one(df, {"not_blank_max_rates": {"v": 0.0}})
    assert r.measured == 0.0 and not r.passed


def test_reference_coverage_with_list_and_frame(spark):
    df = values(spark, [" a", "B ", "c", None, "a"])
    spec = {"column": "v", "min_rate": 0.6, "name": "codes"}
    by_list = one(df, {"reference_coverage": {**spec, "reference_values": ["A", " b", "b"]}})
    by_frame = one(df, {"reference_coverage": {**spec, "reference_values": values(spark, ["A", " b", "b", None])}})
    assert (by_list.name, by_list.measured, by_list.passed) == ("codes", 0.6, True)
    assert (by_frame.name, by_frame.measured, by_frame.passed) == ("codes", 0.6, True)


def test_mapped_coverage_counts_null_as_mapped(spark):
    df = values(spark, ["UNKNOWN", "", None, "x"])
    assert one(df, {"mapped_value_coverage": {"column": "v", "min_rate": 0.5}}).measured == 0.5
    r = one(df, {"mapped_value_coverage": {"column": "v", "min_rate": 0.9, "unknown_values": ["x"], "name": "m"}})
    assert (r.name, r.measured, r.passed) == ("m", 0.75, False)


def random_rows(n, seed, distinct):
    rng = random.Random(seed)
    return [(rng.choice([None, *range(distinct)]), rng.choice(["x", "y", None]), rng.choice([0.0, -0.0, 1.5, None]))
            for _ in range(n)]


@pytest.mark.parametrize("limit", [0, 3, quality.BROADCAST_HASHES])
@pytest.mark.parametrize("distinct", [5, 400, 100000])
def test_duplicates_equal_pandas(spark, limit, distinct):
    rows = random_rows(500, distinct, distinct)
    df = spark.createDataFrame(rows, "a int, b string, c double").repartition(5)
    expected = int(pd.DataFrame(rows).duplicated().sum())
    assert quality.repeated_rows(df, limit) == expected


def test_colliding_hashes_are_not_duplicates(spark, monkeypatch):
    """Even if every row had the same hash, only equal rows would count."""
    monkeypatch.setattr(quality.F, "xxhash64", lambda *c: F.lit(1).cast("bigint"))
    df = spark.createDataFrame([(1, "a"), (2, "a"), (1, "a"), (3, "b")], "a int, b string")
    assert quality.repeated_rows(df) == 1


def test_freshness(spark, sample):
    age = (RUN_DATE - max(dt.datetime.fromisoformat(t) for t, *_ in ROWS if t != "later").date()).days
    r = one(sample, {"freshness": {"date_column": "event_ts", "max_age_days": age - 1}})
    assert not r.passed and r.threshold == f"<= {age - 1} days"
    dates = spark.createDataFrame([(dt.date(2026, 5, 19),), (None,)], "v date")
    assert one(dates, {"freshness": {"date_column": "v", "max_age_days": 1}}).passed
    never = one(values(spark, ["soon", None]), {"freshness": {"date_column": "v", "max_age_days": 1}})
    assert not never.passed and never.measured == "no parseable date"


def months(spark, counts):
    rows = [(f"{2020 + i // 12}-{i % 12 + 1:02d}",) for i, n in enumerate(counts) for _ in range(n)]
    return spark.createDataFrame(rows + [(None,)] * 50, "m string")


def volume(counts):
    """The rule on a list, by hand: the last period is left out."""
    before = counts[-8:-2] if len(counts) >= 8 else counts[:-2]
    mean = sum(before) / len(before)
    return round(abs(counts[-2] - mean) / mean, 4)


@pytest.mark.parametrize("counts", [
    [10, 12, 9, 11, 10, 30, 2], [10, 12, 9, 11, 10, 30, 40, 2], [500, 3, 4, 5, 6, 7, 8, 9, 10, 1],
    [7, 3, 9, 4, 5, 5, 6, 2, 9, 30, 1, 8]])
def test_volume_deviation(spark, counts):
    r = one(months(spark, counts), {"volume_anomaly": {"period_column": "m", "max_deviation": 0.6}})
    assert r.measured == volume(counts) and r.passed == (volume(counts) <= 0.6)


def test_volume_needs_history(spark):
    spec = {"period_column": "m", "max_deviation": 0.6}
    r = one(months(spark, [5] * 6), {"volume_anomaly": spec})
    assert not r.passed and r.measured == "insufficient history"
    assert one(months(spark, [5] * 11), {"volume_anomaly": {**spec, "min_periods": 12}}).measured == "insufficient history"
    assert one(months(spark, [5] * 12), {"volume_anomaly": {**spec, "min_periods": 12}}).measured == 0.0
    assert not one(months(spark, [5, 5]), {"volume_anomaly": {**spec, "min_periods": 2}}).passed
    assert not one(months(spark, [5]), {"volume_anomaly": {**spec, "min_periods": 1}}).passed


def test_long_tail_leaves_nulls_in_the_denominator_only(spark):
    df = values(spark, ["a"] * 3 + ["b"] * 2 + ["c"] + [None] * 4)
    r = one(df, {"long_tail": {"column": "v", "max_count": 2, "max_rate": 0.25}})
    assert r.measured == 0.3 and not r.passed and r.name == "long_tail_rate"


def test_empty_table(spark):
    df = spark.createDataFrame([], "ts string, v string, n int, m string")
    got = {r.name: (r.measured, r.passed) for r in run_checks(df, {
        "timestamp_column": "ts", "not_blank_max_rates": {"v": 0.5}, "non_negative_columns": ["n"],
        "reference_coverage": {"column": "v", "min_rate": 0.1, "reference_values": ["A"]},
        "duplicate_max_rate": 0.1, "mapped_value_coverage": {"column": "v", "min_rate": 0.1},
        "freshness": {"date_column": "ts", "max_age_days": 1},
        "volume_anomaly": {"period_column": "m", "max_deviation": 1},
        "long_tail": {"column": "v", "max_count": 1, "max_rate": 0.5}}, RUN_DATE)}
    assert got == {
        "timestamp_parse_rate": (0.0, False), "v_null_rate": (1.0, False), "non_negative_n": (0, True),
        "reference_coverage": (0.0, False), "duplicate_rate": (0.0, True),
        "mapped_value_coverage": (0.0, False),
        "freshness": ("max ts 2026-05-20, 0 days before run date", True),
        "volume_anomaly": ("insufficient history", False), "long_tail_rate": (1.0, False)}


def test_report_and_gate(spark, sample):
    results = run_checks(sample, {
        "timestamp_column": "event_ts", "timestamp_parse_min_rate": 0.1, "required_columns": ["nope"]}, RUN_DATE)
    frame = quality.results_frame(spark, results)
    report = quality.summarise(frame, "made", len(ROWS)).first()
    assert (report["dataset"], report["rows"], report["checks_passed"], report["checks_total"]) == (
        "made", len(ROWS), 1, 2)
    assert {c["name"]: c["measured"] for c in report["checks"]}["timestamp_parse_rate"] == str(results[1].measured)
    with pytest.raises(quality.QualityGateError, match="schema_conformance"):
        quality.assert_passed(results)
    quality.assert_passed([r for r in results if r.passed])


def test_a_dataset_is_loaded_checked_and_reported(spark, sample, tmp_path):
    path = str(tmp_path / "sample.parquet")
    sample.write.parquet(path)
    config = {"dataset_name": "sample", "required_columns": ["event_ts", "station"],
              "non_negative_columns": ["amount"]}
    report = check_dataset(spark, path, config, run_date=RUN_DATE).first()
    assert (report["dataset"], report["rows"], report["checks_passed"], report["checks_total"]) == (
        "sample", len(ROWS), 1, 2)
    (tmp_path / "cells.csv").write_text('v,n\n"two\nlines",1\nNA,2\n,3\n  ,x\n')
    report = check_dataset(spark, str(tmp_path / "cells.csv"), {"not_blank_max_rates": {"v": 0.2}}).first()
    # NA and the empty cell are missing, which is not blank
    assert report["rows"] == 4 and report["checks"][0]["measured"] == "0.25"


def test_results_keep_the_measure_as_text_and_number(spark, sample):
    frame = quality.results_frame(spark, run_checks(sample, {
        "timestamp_column": "event_ts", "required_columns": ["event_ts"]}, RUN_DATE))
    rows = {r["name"]: r for r in frame.collect()}
    rate = round(sum(t != "later" for t, *_ in ROWS) / len(ROWS), 4)
    assert rows["timestamp_parse_rate"]["measured"] == str(rate)
    assert rows["timestamp_parse_rate"]["measured_value"] == rate
    assert rows["schema_conformance"]["measured_value"] is None


def by_hand(rows, reference, max_count):
    """The rates in plain Python; None is missing, which is not blank, negative, known or rare."""
    n = len(rows)
    stamps, texts, numbers = zip(*rows)
    count = {v: texts.count(v) for v in set(texts)}

    def number(v):
        try:
            return float(v) if v is not None and v.strip() == v.strip("dDfFxX_ ") else None
        except ValueError:
            return None

    def parses(v):
        try:
            dt.datetime.strptime(v or "", "%Y-%m-%d %H:%M")
            return True
        except ValueError:
            return False

    return {
        "timestamp_parse_rate": sum(map(parses, stamps)) / n,
        "text_null_rate": sum(v is not None and not v.strip() for v in texts) / n,
        "non_negative_number": sum((number(v) or 0) < 0 for v in numbers),
        "reference_coverage": sum(v is not None and v.strip().upper() in reference for v in texts) / n,
        "duplicate_rate": (n - len(set(rows))) / n,
        "mapped_value_coverage": sum(v not in ("UNKNOWN", "") for v in texts) / n,
        "long_tail_rate": sum(v is not None and count[v] <= max_count for v in texts) / n,
    }


@pytest.mark.parametrize("seed", range(6))
def test_suite_equals_a_calculation_by_hand(spark, seed):
    rng = random.Random(seed)
    stamps = [None, "", "2026-05-01 07:30", "2026-05-31 23:59", "2026-02-30 10:00", "later"]
    texts = [None, "", "  ", "a", " A", "b ", "UNKNOWN", "c", *[f"rare{i}" for i in range(40)]]
    numbers = [None, "", "-1", "-0", "5", "-2.5", "-3d", "nan", "x", "1e3", "-1e-3"]
    rows = [(rng.choice(stamps), rng.choice(texts), rng.choice(numbers)) for _ in range(rng.randint(30, 400))]
    df = spark.createDataFrame(rows, "stamp string, text string, number string").repartition(4)
    results = run_checks(df, {
        "timestamp_column": "stamp", "not_blank_max_rates": {"text": 0.1}, "non_negative_columns": ["number"],
        "reference_coverage": {"column": "text", "min_rate": 0.5, "reference_values": ["a", "B"]},
        "duplicate_max_rate": 0.2, "mapped_value_coverage": {"column": "text", "min_rate": 0.9},
        "long_tail": {"column": "text", "max_count": 3, "max_rate": 0.5}}, RUN_DATE)
    expected = by_hand(rows, {"A", "B"}, 3)
    assert {r.name: r.measured for r in results} == {k: round(v, 4) for k, v in expected.items()}


def test_report_makes_silver_once(spark, sf_dir, monkeypatch):
    made, real = [], quality_queries.silver_table
    monkeypatch.setattr(quality_queries, "silver_table", lambda *args: made.append(1) or real(*args))
    row = quality_queries.report_summary(spark, sf_dir).first()
    assert made == [1] and row["checks_total"] == 10
    assert row["rows"] == real(spark, sf_dir).count()
