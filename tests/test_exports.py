import datetime as dt
import json
from collections import Counter, defaultdict

import pytest
from frames import random_silver, silver_frame
from pyspark.sql import functions as F

from marlstone.config import LINE_CODES
from marlstone.operators import exports, gold
from marlstone.plans import medallion

ROWS = random_silver(700, seed=41)
EPOCH = dt.date(1970, 1, 1)


@pytest.fixture(scope="module")
def silver(spark):
    return silver_frame(spark, ROWS)


def sections_of(silver):
    cubes = medallion.silver_cubes(silver)
    parts = exports.sections(cubes.by_time, cubes.by_station, cubes.by_code)
    return {name: df.collect() for name, df in parts.items()}


@pytest.fixture(scope="module")
def exported(silver):
    return sections_of(silver)


def arrays(rows):
    return [json.loads(r["row"]) for r in rows]


def plain(key):
    """{key(row): (incidents, minutes)} of the generated rows."""
    sums = defaultdict(lambda: [0, 0])
    for row in ROWS:
        k = key(*row)
        if k is not None:
            sums[k][0] += 1
            sums[k][1] += row[6]
    return {k: tuple(v) for k, v in sums.items()}


def quarter(day):
    return (day.month + 2) // 3


def test_every_array_section_says_what_its_fields_are(exported):
    fields = {r["section"]: r["fields"] for r in exported["array_fields"]}
    assert set(fields) <= set(exported) and len(fields) == 6
    for section, names in fields.items():
        assert {len(a) for a in arrays(exported[section])} == {len(names)}, section


def test_year_totals_are_those_of_the_rows(exported):
    expected = plain(lambda day, h, m, s, c, d, n, line: (day.year, LINE_CODES[line]))
    got = {(r["event_year"], r["line"]): (r["incidents"], r["total_delay_minutes"])
           for r in exported["totals_by_year_line"]}
    assert got == expected
    head = exported["headline"][0]
    assert (head["incidents"], head["total_delay_minutes"]) == (len(ROWS), sum(r[6] for r in ROWS))


def test_daily_arrays_are_those_of_the_rows(exported):
    assert {a[0]: (a[1], a[2]) for a in arrays(exported["daily_summary"])} == plain(
        lambda day, *_: (day - EPOCH).days)
    per_line = plain(lambda day, h, m, s, c, d, n, line: ((day - EPOCH).days, LINE_CODES[line]))
    assert {(a[0], a[1]): a[2] for a in arrays(exported["daily_by_line"])} == {k: v[1] for k, v in per_line.items()}


def test_quarter_arrays_are_those_of_the_rows(exported):
    totals = plain(lambda day, h, m, s, c, d, n, line: (day.year, quarter(day), LINE_CODES[line]))
    assert {tuple(a[:3]): (a[3], a[4]) for a in arrays(exported["totals_by_quarter_line"])} == totals
    hours = plain(lambda day, hour, m, s, c, d, n, line: (day.year, quarter(day), LINE_CODES[line], hour))
    assert {tuple(a[:4]): (a[4], a[5]) for a in arrays(exported["hour_by_quarter_line"])} == hours


def test_quarter_rankings_decode_to_the_best_of_the_rows(exported):
    names = {r["station_index"]: r["station"] for r in exported["station_names"]}
    assert sorted(names) == list(range(len(names))) and "" not in names.values()
    sums = plain(lambda day, h, m, s, c, d, n, line: (day.year, quarter(day), LINE_CODES[line], s) if s else None)
    groups = defaultdict(list)
    for (*group, station), (_, minutes) in sums.items():
        groups[tuple(group)].append((-minutes, station))
    expected = {(*g, s) for g, found in groups.items() for _, s in sorted(found)[:gold.TOP_STATIONS_PER_GROUP]}
    assert {(*a[:3], names[a[3]]) for a in arrays(exported["stations_by_quarter_line"])} == expected
    ranked_codes = Counter(a[3] for a in arrays(exported["codes_by_quarter_line"]))
    described = {r["code"]: r["description"] for r in exported["code_descriptions"]}
    assert set(described) == set(ranked_codes)
    assert all(text == (gold.NO_DESCRIPTION if code < "C05" else f"about {code}") for code, text in described.items())


def test_sections_from_silver_equal_sections_from_cubes(spark):
    silver = silver_frame(spark, random_silver(500, seed=21))
    direct = exports.sections(silver, silver, silver)
    for name, rows in sections_of(silver).items():
        unordered = name in ("station_names", "code_descriptions")
        expected = direct[name].collect()
        assert (sorted(expected) == sorted(rows)) if unordered else (expected == rows), name


def test_station_index_is_the_order_of_first_appearance(spark):
    ranked = gold.top_stations(silver_frame(spark, random_silver(900, seed=8)), "quarter")
    names = list(dict.fromkeys(r["station"] for r in ranked.collect()))
    got = {r["station"]: r["station_index"] for r in exports.station_dictionary(ranked).collect()}
    assert got == {name: i for i, name in enumerate(names)}


def test_encode_then_decode_gives_the_rankings_back(spark):
    silver = silver_frame(spark, random_silver(600, seed=9))
    ranked = gold.top_stations(silver, "quarter")
    names = exports.station_dictionary(ranked)
    back = exports.decode_stations(exports.encode_stations(ranked, names), names)
    assert sorted(back.collect(), key=str) == sorted(ranked.collect(), key=str)
    codes = gold.top_codes(silver, "quarter")
    back = exports.decode_codes(exports.encode_codes(codes), exports.code_dictionary(codes))
    assert sorted(back.collect()) == sorted(codes.collect())


def test_a_line_outside_the_domain_stops_the_export(silver):
    odd = silver.withColumn("line_canonical", F.lit("LINE_99"))
    with pytest.raises(Exception, match="line outside its domain: LINE_99"):
        exports.with_short_line(gold.delays_by_line(odd)).collect()


def test_records_are_json_objects_with_iso_dates(silver):
    records = [json.loads(r["record"]) for r in exports.records(gold.daily_summary(silver)).collect()]
    assert [r["event_date"] for r in records] == sorted({row[0].isoformat() for row in ROWS})
