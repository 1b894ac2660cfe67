import math
from collections import Counter

import duckdb
import pytest
from awkward import awkward, empty

from marlstone.llm import mixing
from marlstone.llm.queries import ORACLES, QUERIES


def test_query_matches_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    expected = sorted(con.sql(ORACLES["op6_source_mixing"]).fetchall())
    rows = QUERIES["op6_source_mixing"](spark, sf_dir).select("doc_id", "source", "mix_copy", "mix_key").collect()
    assert sorted(map(tuple, rows)) == expected


def frame(spark, n, share):
    return spark.createDataFrame(
        [(i, "hot" if i < n * share else f"s{i % 4}", "t") for i in range(n)], "doc_id long, source string, text string")


def test_counts_follow_the_weights(spark):
    docs = frame(spark, 6000, 0.5)
    weights = {"hot": 0.1, "s0": 0.5, "s1": 0.2, "s2": 0.2}
    out = mixing.mix(docs, mixing.target_rates(docs, weights), seed=5).collect()
    sizes = Counter(r["source"] for r in out)
    for source, weight in weights.items():
        mean = 6000 * weight
        assert abs(sizes[source] - mean) < 5 * math.sqrt(mean)
    assert "s3" not in sizes
    # copies of a document are numbered, and their counts are Poisson: variance near the mean
    per_doc = Counter(r["doc_id"] for r in out if r["source"] == "s0")
    counts = [per_doc.get(i, 0) for i in range(3000, 6000) if i % 4 == 0]
    mean = sum(counts) / len(counts)
    spread = sum((c - mean) ** 2 for c in counts) / len(counts)
    assert 0.8 < spread / mean < 1.2
    keys = [r["mix_key"] for r in out]
    assert keys == sorted(keys) and len(set(keys)) == len(keys)


@pytest.mark.parametrize("mean", [0.01, 1.0, 15.9, 16.0, 16.1, 500.0])
def test_draws_have_the_mean_and_spread_of_the_rate(spark, mean):
    docs = spark.createDataFrame([(i, "a") for i in range(400)], "doc_id long, source string")
    rates = spark.createDataFrame([("a", mean)], "mix_source string, rate double")
    per_doc = Counter(r["doc_id"] for r in mixing.mix(docs, rates).select("doc_id").collect())
    counts = [per_doc.get(i, 0) for i in range(400)]
    own = sum(counts) / 400
    assert abs(own - mean) < 5 * math.sqrt(mean / 400)
    if mean > 1:
        assert 0.7 < sum((c - own) ** 2 for c in counts) / 400 / mean < 1.3


def test_rerun_and_other_partitioning_agree(spark):
    docs = frame(spark, 500, 0.3)
    rates = mixing.source_rates(docs)
    once = sorted(map(tuple, mixing.mix(docs, rates, seed=1).collect()))
    assert once == sorted(map(tuple, mixing.mix(docs.repartition(7), rates, seed=1).collect()))
    assert once != sorted(map(tuple, mixing.mix(docs, rates, seed=2).collect()))


def test_awkward_rows_and_empty_table(spark):
    docs = awkward(spark)
    out = mixing.mix(docs, mixing.source_rates(docs))
    assert out.columns == [*docs.columns, "mix_copy", "mix_key"]
    assert {r["source"] for r in out.collect()} <= {"a", "b", "c", None}
    assert mixing.mix(empty(spark), mixing.source_rates(empty(spark))).count() == 0
    nulls = mixing.target_rates(docs, {None: 1.0})
    assert {r["source"] for r in mixing.mix(docs, nulls).collect()} == {None}
    with pytest.raises(ValueError):
        mixing.mix(docs.withColumnRenamed("n", "mix_key"), nulls)
