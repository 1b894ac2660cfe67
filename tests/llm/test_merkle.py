import hashlib
import random
import zlib

import pytest
from awkward import LONG, given
from pyspark.sql import functions as F

from marlstone.llm import merkle, ranks
from marlstone.llm.queries import QUERIES

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, grp string, position long, path string"


def digest(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(row):
    return digest("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row))


def levels(nodes):
    found = [nodes]
    while len(nodes) > 1:
        nodes = [digest("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        found.append(nodes)
    return found


def brute(rows, tampered):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified), in any order."""
    groups = {}
    for row in rows:
        other = (*row[:3], None if row[3] is None else row[3] + 1, row[4])
        groups.setdefault(row[2], []).append((row[0], leaf_of(row), leaf_of(other) if tampered(row) else None))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        groups[g].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees[g] = levels([leaf for _, leaf, _ in groups[g]])
    top = levels([trees[g][-1][0] for g in order])
    out = []
    for number, g in enumerate(order):
        for place, (doc_id, leaf, other) in enumerate(groups[g]):
            proof, folded = [], other or leaf
            for tree, at in ((trees[g], place), (top, number)):
                for nodes in tree[:-1]:
                    sibling = nodes[at ^ 1] if at ^ 1 < len(nodes) else ""
                    proof.append(sibling)
                    folded = digest(sibling + folded if at % 2 else folded + sibling)
                    at //= 2
            root = top[-1][0]
            out.append((doc_id, leaf, trees[g][-1][0], root, digest("".join(proof)), folded, folded == root))
    return out


def by_crc(row):
    return row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is not None, v) for v in r))


def built(df):
    changed = [F.col("n_chars") + 1 if c == "n_chars" else F.col(c) for c in merkle.FIELDS]
    found = merkle.manifest(df, claim=F.when(F.crc32(F.col("doc_id").cast("string")) % 7 == 0, merkle.leaf(*changed)))
    folded = merkle.fold(F.coalesce("claim", "leaf"), F.col("path"))
    return found.select(
        "id", "leaf", "subroot", "root", F.sha2(F.array_join(merkle.siblings(F.col("path")), ""), 256), folded,
        folded == F.col("root"))


@pytest.mark.parametrize("levels_at_once", [1, 3, 12])
def test_against_brute_force(spark, monkeypatch, levels_at_once):
    monkeypatch.setattr(merkle, "LEVELS", levels_at_once)
    monkeypatch.setattr(merkle, "SLOTS", 1 << levels_at_once)
    rng = random.Random(levels_at_once)
    sizes = {"de": 1, "en": 23, "": 2, None: 5, "é": 8, "zz": 9}
    ids = iter(rng.sample([*range(-5000, 5000), 2 ** 63 - 1, -2 ** 63, 2 ** 40], 60))
    rows = [(next(ids), "s", g, rng.choice([None, 3]), f"t{i}") for g, n in sizes.items() for i in range(n)]
    rng.shuffle(rows)
    df = spark.createDataFrame([(*r, "x", 1, "x") for r in rows], SCHEMA)
    assert ordered(built(df).collect()) == ordered(brute(rows, by_crc))


def test_nulls_repeats_ties_and_clashing_names(spark):
    rows = [
        (None, None, None, None, None), (None, None, None, None, None), (None, "a", None, 1, "x"), (1, "a", None, 1, ""),
        (1, "a", "en", 1, "x"), (1, "a", "en", 1, "x"), (1, "a", "en", 1, "x"), (1, "b", "en", 1, "y"), (0, "", "en", 0, ""),
        (2, "a", "en", 1, LONG), (None, "a", "en", 1, "x"), (None, "a", "en", 1, "x"), (3, "a", "", 5, "中é"), (-7, "-", "-", 0, "-"),
    ] + [(9, "hot", "fr", 1, f"t{i % 40}") for i in range(300)] + [(i, "s", "fr", 1, "t") for i in range(5)]
    df = spark.createDataFrame([(*r, "x", 1, "x") for r in rows], SCHEMA).repartition(7)
    assert ordered(built(df).collect()) == ordered(brute(rows, by_crc))


def test_empty_table_and_single_row(spark):
    assert built(spark.createDataFrame([], SCHEMA)).count() == 0
    row = (5, "s", "en", 1, "t")
    got = built(spark.createDataFrame([(*row, "x", 1, "x")], SCHEMA)).collect()
    assert [tuple(r) for r in got] == brute([row], by_crc) and got[0][1] == got[0][2] == got[0][3]


def test_whole_query_against_brute_force(spark):
    sf_dir = "/root/testdata/sf0.1"
    rows = given(sf_dir, "documents", "doc_id, source, lang, n_chars, text")
    got = QUERIES["op11_merkle_manifest"](spark, sf_dir).collect()
    assert ordered(got) == ordered(brute(rows, by_crc))
    assert {r["doc_id"] for r in got if not r["verified"]} == {r[0] for r in rows if by_crc(r)}


def test_ranks_from_bitmaps_sparse_dense_and_repeated(spark, monkeypatch):
    monkeypatch.setattr(ranks, "HELD_ROWS", 700)
    rng = random.Random(4)
    ids = [*range(3000), *rng.sample(range(2 ** 62), 300), *rng.choices(range(100, 200), k=500), None, None]
    rng.shuffle(ids)
    df = spark.createDataFrame([("=g", i) for i in ids], "grp string, id long").repartition(5)
    rows = df.withColumns({"row": F.monotonically_increasing_id(), "leaf": F.sha2(F.col("id").cast("string"), 256)})
    rows = rows.withColumn("leaf", F.coalesce("leaf", F.lit("")))
    placed, totals = ranks.ranked(rows.checkpoint(), ["leaf"], "id bigint")
    got = [r["id"] for r in sorted(placed.collect(), key=lambda r: r["position"])]
    assert got == sorted(ids, key=lambda i: (i is not None, i or 0))
    assert [tuple(r) for r in totals.collect()] == [("=g", len(ids))]


def test_numbers_of_values_follow_their_order(spark):
    values = [None, "", "b", "a", "é", "z", "a", None, "aa"]
    got = ranks.numbered(spark.createDataFrame([(v,) for v in values], "v string"), "v").collect()
    expected = sorted(set(values), key=lambda v: (v is not None, (v or "").encode()))
    assert {r["v"]: r["number"] for r in got} == {v: i for i, v in enumerate(expected)}


def test_sql_says_the_same(spark):
    import duckdb

    from marlstone.llm.queries import ORACLES

    sf_dir = "/root/testdata/sf0.01"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = con.sql(ORACLES["op11_merkle_manifest"])
    found = QUERIES["op11_merkle_manifest"](spark, sf_dir).select(*expected.columns).collect()
    assert ordered(found) == ordered(expected.fetchall())
