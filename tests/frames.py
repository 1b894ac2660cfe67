"""Generated feeds and silver rows, and a plain-Python account of what becomes of a feed."""

import datetime as dt
import random
import re

from marlstone.config import LINE_1, LINE_2, LINE_4, REQUIRED_COLUMNS

PLAIN = {
    "date": "2021-07-19", "time": "05:45", "day": "Mon", "station": "DEPOT", "code": "Q7", "min_delay": "3",
    "min_gap": "6", "bound": "S", "line": "SHP", "vehicle": "555",
}
CODES = [(0, "Q5", "WATER"), (1, " q6 ", "SNOW"), (2, "Q7", "SIGNAL"), (3, "Q7", "LISTED TWICE"), (4, "Q8", None)]
LINES = {"YU": LINE_1, "yus": LINE_1, "B D": LINE_2, "line 2": LINE_2, "SHP": LINE_4, "": "UNKNOWN", "bus 9": "UNKNOWN"}


def raw_row(**fields):
    """One row of a feed: plain values but for ``fields``."""
    return tuple({**PLAIN, **fields}.values())


def raw_feed(n=250, seed=17):
    """Rows with untidy text, missing parts, unusable delays, and copies of earlier rows."""
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        if rows and rng.random() < 0.15:
            again = list(rng.choice(rows))
            again[6], again[7] = str(rng.randint(0, 99)), rng.choice("NSEW")
            rows.append(tuple(again))
            continue
        day = dt.date(2021, 1, 1) + dt.timedelta(days=rng.randint(0, 700))
        rows.append((
            rng.choice([day.isoformat()] * 8 + ["", "soon", f"{day.isoformat()}T{rng.randint(0, 23):02d}:15:00"]),
            rng.choice([f"{rng.randint(0, 23):02d}:{rng.randint(0, 59):02d}"] * 6 + ["", "31:00"]),
            day.strftime("%a"), rng.choice(["Depot", " depot  west", "HARBOUR", "", "\tharbour "]),
            rng.choice(["q5", "Q6", " Q7", "Q8", "Q9", ""]), rng.choice(["0", "0", "1", "2.5", "14", "-3", "", "4m"]),
            rng.choice(["", "3", "x"]), rng.choice(["n", " S ", ""]), rng.choice(list(LINES)),
            str(rng.randint(1, 12)) + rng.choice(["", " "])))
    return rows


def _number(text):
    return float(text) if re.fullmatch(r"-?\d+(\.\d+)?", text) else None


def plain_silver(rows, codes=CODES):
    """(silver, rejects) of a feed, row by row: what the pipeline has to agree with."""
    described = {}
    for _, code, description in codes:
        described.setdefault(code.strip().upper(), description)
    kept, rejected, seen = [], [], set()
    for row in rows:
        r = dict(zip(REQUIRED_COLUMNS, row, strict=True))
        found = re.fullmatch(r"(\d{4}-\d\d-\d\d)(T\d\d:\d\d:\d\d)?", r["date"])
        day = dt.date.fromisoformat(found[1]) if found else None
        delay = _number(r["min_delay"])
        if day is None or delay is None or delay < 0:
            rejected.append(row)
            continue
        clock = re.fullmatch(r"([01]\d|2[0-3]):([0-5]\d)", r["time"])
        ts = dt.datetime.combine(day, dt.time(int(clock[1]), int(clock[2]))) if clock else None
        station, code = " ".join(r["station"].split()).upper(), r["code"].strip().upper()
        key = (ts, station, code, delay, r["vehicle"].strip(), r["line"])
        if key in seen:
            continue
        seen.add(key)
        kept.append((
            ts, day, ts.hour if ts else None, ts.strftime("%Y-%m") if ts else None, r["day"], station, code,
            described.get(code), delay, _number(r["min_gap"]), r["bound"].strip().upper(), r["line"], LINES[r["line"]],
            r["vehicle"].strip()))
    return kept, rejected


def bronze_frame(spark, rows=None, name="feed", position=0):
    tagged = [(*r, name, position, i) for i, r in enumerate(raw_feed() if rows is None else rows)]
    schema = ", ".join(f"{c} string" for c in REQUIRED_COLUMNS)
    return spark.createDataFrame(tagged, schema + ", source_file string, source_ord int, source_row_id bigint")


def code_frame(spark, codes=CODES):
    return spark.createDataFrame(codes, "source_row_id int, code string, description string")


SILVER_DDL = (
    "event_date date, event_hour int, event_year_month string, station string, "
    "code_clean string, code_description string, min_delay int, line_canonical string")


def silver_frame(spark, rows=None):
    return spark.createDataFrame(random_silver() if rows is None else rows, SILVER_DDL)


def random_silver(n=800, seed=3):
    """Rows with ties, blanks, missing hours and missing descriptions."""
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        day = dt.date(2023, 1, 1) + dt.timedelta(days=rng.randint(0, 900))
        hour = rng.choice([None, *range(24)])
        code = f"C{rng.randint(0, 39):02d}"
        rows.append((
            day, hour, None if hour is None else day.strftime("%Y-%m"),
            rng.choice(["", *[f"S{i:02d}" for i in range(30)]]), code,
            None if code < "C05" else f"about {code}",
            rng.choice([0, 0, 0, 1, 2, 3, 5]), rng.choice([LINE_1, LINE_2, "UNKNOWN"])))
    return rows
