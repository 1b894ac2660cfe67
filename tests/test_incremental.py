"""Runs that rebuild only the months which changed files touch equal full runs."""

import datetime as dt
import random
import shutil

import pytest
from frames import CODES, raw_row

from marlstone.config import FeedConfig, SourceSpec
from marlstone.plans import incremental, medallion
from marlstone.sources import readers

HEADER = "_id,Date,Time,Day,Station,Code,Min Delay,Min Gap,Bound,Line,Vehicle\n"
RUN_DATE = dt.date(2022, 6, 1)


def write(path, rows):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(HEADER + "".join(",".join([str(i), *r]) + "\n" for i, r in enumerate(rows)))


def month_rows(month, n, seed):
    """Rows of one month; some without a time, whose copies lie in other months too, some unusable."""
    rng = random.Random(seed)
    return [raw_row(
        date=rng.choice([f"2022-{month:02d}-{rng.randint(1, 28):02d}"] * 9 + ["soon"]),
        time=rng.choice([f"{rng.randint(0, 23):02d}:10"] * 3 + [""]), station=rng.choice(["A", "B"]),
        min_delay=rng.choice(["1", "2", "-1"]), min_gap=str(rng.randint(0, 99)), vehicle=str(rng.randint(1, 3)))
        for _ in range(n)]


@pytest.fixture()
def feeds(tmp_path, monkeypatch):
    monkeypatch.setattr(medallion, "publish", lambda *a: None)  # exports come from the cubes, which are compared
    raw = tmp_path / "raw"
    for month in (1, 2, 3, 4):
        write(raw / "one" / f"2022 {month}.csv", month_rows(month, 40, month))
    write(raw / "two" / "k=1" / "a%20b.csv", month_rows(2, 30, 9) + month_rows(3, 30, 10))
    write(raw / "two" / "k=2" / "c.csv", month_rows(4, 30, 11))
    (raw / "codes.csv").write_text("CODE,DESCRIPTION\n" + "".join(f"{c},{d or ''}\n" for _, c, d in CODES))
    cfg = FeedConfig(
        sources=(SourceSpec("one", str(raw / "one")), SourceSpec("two", str(raw / "two"))),
        codes=SourceSpec("codes", str(raw / "codes.csv")))
    return raw, cfg


def bag(df, drop=()):
    return sorted(str([(c, r[c]) for c in sorted(df.columns) if c not in drop]) for r in df.collect())


def cells(cube):
    """Rounding apart, a cube's cells whatever months they are stored in."""
    return bag(cube)


def everything(spark, root, result):
    state = {
        "silver": bag(result.silver), "rejects": bag(result.rejects, ("source_row_id",)),
        "counts": result.report["row_counts"], "checks": [c.to_dict() for c in result.checks]}
    state |= {f"cube {name}": cells(cube) for name, cube in vars(result.cubes).items()}
    state |= {f"gold {name}": bag(spark.read.parquet(f"{root}/gold/{name}")) for name in medallion.GOLD_MODELS}
    state["files"] = bag(spark.read.parquet(f"{root}/state/file_months"))
    return state


def same_as_full(spark, cfg, root, tmp_path, name):
    result = medallion.run(spark, cfg, str(root), RUN_DATE)
    full_root = tmp_path / f"full-{name}"
    full = medallion.run(spark, cfg, str(full_root), RUN_DATE)
    got, expected = everything(spark, root, result), everything(spark, full_root, full)
    for part in expected:
        assert got[part] == expected[part], (name, part)
    return result


def written(root, layer):
    return {str(p.relative_to(root)): p.stat().st_mtime_ns for p in (root / layer).rglob("*.parquet")}


def test_changed_new_and_gone_files(spark, feeds, tmp_path, monkeypatch):
    raw, cfg = feeds
    root = tmp_path / "out"
    medallion.run(spark, cfg, str(root), RUN_DATE)
    full_runs = []
    monkeypatch.setattr(medallion, "build_bronze", lambda *a, f=medallion.build_bronze: full_runs.append(a[2].root) or f(*a))

    before = {layer: written(root, layer) for layer in ("silver/delays", "cubes/by_station", "bronze")}
    rows = [r for r in month_rows(3, 40, 3) if r[1]]
    write(raw / "one" / "2022 3.csv", [*rows[5:], raw_row(date="2022-03-05", time="", vehicle="new")])
    result = same_as_full(spark, cfg, root, tmp_path, "changed")
    assert all(f["changed"] == (f["logical_name"] == "one") for f in result.report["manifest_files"])
    # the other months' files of bronze were not touched; silver's may be, for rows without a time
    after = written(root, "bronze")
    assert {p for p in after if p in before["bronze"]} >= {
        p for p in before["bronze"] if "partition_month=1/" in p or "partition_month=4/" in p}

    write(raw / "one" / "2022 9.csv", month_rows(9, 20, 20) + month_rows(1, 5, 21))
    shutil.rmtree(raw / "two" / "k=2")
    same_as_full(spark, cfg, root, tmp_path, "new and gone")

    (raw / "one" / "2022 1.csv").unlink()
    (raw / "one" / "2022 9.csv").unlink()
    result = same_as_full(spark, cfg, root, tmp_path, "a month is empty")
    assert {r["event_date"].month for r in result.silver.collect()} == {2, 3, 4}
    assert str(root) not in full_runs and len(full_runs) == 3


def test_only_files_of_the_months_are_read(spark, feeds, tmp_path, monkeypatch):
    raw, cfg = feeds
    root = tmp_path / "out"
    medallion.run(spark, cfg, str(root), RUN_DATE)
    read = []
    monkeypatch.setattr(
        incremental, "read_files", lambda s, c, a, f=incremental.read_files: read.append(sorted(a)) or f(s, c, a))
    # rows with a time alone, so that no other month's share of the timeless ones changes
    write(raw / "one" / "2022 4.csv", [r for r in month_rows(4, 40, 4) if not r[1] or r[0].endswith("1")])
    layers = ("silver/delays", "cubes/by_time", "cubes/by_code", "bronze")
    before = {layer: written(root, layer) for layer in layers}
    same_as_full(spark, cfg, root, tmp_path, "one month")
    own = [str(raw / "one" / "2022 4.csv")]
    both = sorted([*own, str(raw / "two" / "k=2" / "c.csv")])
    assert read[:2] == [[], own] and {f.rsplit("/", 1)[1] for f in both} <= {f.rsplit("/", 1)[1] for f in read[2]}
    for layer in layers:
        kept = {p: t for p, t in before[layer].items() if "month=4/" not in p and "month=0/" not in p}
        assert kept.items() <= written(root, layer).items(), layer


def test_what_needs_a_full_run(spark, feeds, tmp_path, monkeypatch):
    raw, cfg = feeds
    root = tmp_path / "out"
    medallion.run(spark, cfg, str(root), RUN_DATE)
    runs = []
    monkeypatch.setattr(medallion, "build_bronze", lambda *a, f=medallion.build_bronze: runs.append(1) or f(*a))
    (raw / "codes.csv").write_text("CODE,DESCRIPTION\nQ7,OTHER WORDS\n")
    result = medallion.run(spark, cfg, str(root), RUN_DATE)
    assert len(runs) == 1 and {r["code_description"] for r in result.silver.collect()} == {"OTHER WORDS"}
    make_gold = medallion.materialise_gold
    # a run that dies between its layers leaves no finished state, so the next one makes all of them
    monkeypatch.setattr(medallion, "materialise_gold", lambda *a: (_ for _ in ()).throw(RuntimeError("killed")))
    write(raw / "one" / "2022 1.csv", month_rows(1, 10, 1))
    with pytest.raises(RuntimeError, match="killed"):
        medallion.run(spark, cfg, str(root), RUN_DATE)
    monkeypatch.setattr(medallion, "materialise_gold", make_gold)
    same_as_full(spark, cfg, root, tmp_path, "after a killed run")
    assert len(runs) == 3
    assert not incremental.supported(FeedConfig(sources=(SourceSpec("t", "t", "table"),)))
    assert not incremental.supported(FeedConfig(dedupe_keys=("station",)))


def test_selected_files_are_the_only_ones_opened(spark, tmp_path):
    for name, text in (("a b.csv", "x,y\n1,2\n"), ("c+d%.csv", "x,y\n3,4\n"), ("e.csv", "x,y\n5,6\n")):
        (tmp_path / name).write_text(text)
    spec = SourceSpec("s", str(tmp_path))

    def values(only):
        return sorted(r["x"] for r in readers.read_source(spark, spec, only).collect())

    assert values(None) == ["1", "3", "5"] and values([]) == []
    assert values([str(tmp_path / "a b.csv"), str(tmp_path / "c+d%.csv")]) == ["1", "3"]
    (tmp_path / "e.csv").chmod(0)
    assert readers.read_source(spark, spec, [str(tmp_path / "a b.csv")]).rdd.getNumPartitions() == 1
