"""Mixing sources to target weights by Poisson replication.

Each document is repeated a Poisson-distributed number of times whose mean is
its source's target rate. The draw inverts the distribution at a number hashed
from seed and id, so a rerun, a retried task and any partitioning agree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marlstone.llm.storage import stored
from marlstone.operators.joins import broadcast_if_small

# A larger mean is the sum of independent draws of at most this mean each.
MEAN_PER_DRAW = 16.0
# P(X > 100) is below 1e-40 at mean 16; numbers drawn are multiples of 2 ** -52.
LARGEST_DRAW = 100


def source_rates(docs: DataFrame, source_col: str = "source", alpha: float = 0.5) -> DataFrame:
    """(source, rate): repetitions that keep the row count and level sources to n ** alpha."""
    counts = docs.groupBy(F.col(source_col).alias("mix_source")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"), F.sum(F.pow("n", F.lit(alpha))).alias("mass"))
    # one row on the right
    return counts.crossJoin(F.broadcast(total)).select(
        "mix_source", (F.col("total") * F.pow("n", F.lit(alpha)) / F.col("mass") / F.col("n")).alias("rate"))


def target_rates(docs: DataFrame, weights: dict[str | None, float], source_col: str = "source") -> DataFrame:
    """(source, rate) for given weights; a source that is not named gets none."""
    spark = docs.sparkSession
    wanted = spark.createDataFrame(list(weights.items()), "s string, weight double")
    counts = docs.groupBy(F.col(source_col).cast("string").alias("mix_source")).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    mass = float(sum(weights.values())) or 1.0
    return counts.crossJoin(F.broadcast(total)).join(
        wanted, F.col("mix_source").eqNullSafe(F.col("s")), "left").select(
        "mix_source", F.coalesce(F.col("weight") / mass * F.col("total") / F.col("n"), F.lit(0.0)).alias("rate"))


def with_distribution(rates: DataFrame) -> DataFrame:
    """Number of draws per source, and the cumulative probabilities of one draw."""
    draws = F.greatest(F.ceil(F.col("rate") / MEAN_PER_DRAW), F.lit(1)).cast("int")
    mean = F.col("rate") / F.col("draws")
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(LARGEST_DRAW)),
        F.struct(F.exp(-mean).alias("p"), F.array(F.exp(-mean)).alias("cdf")),
        lambda acc, k: F.struct(
            (acc["p"] * mean / k).alias("p"),
            F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * mean / k)).alias("cdf")))
    return rates.withColumn("draws", draws).withColumn("cdf", steps["cdf"])


def uniform(*parts: Column) -> Column:
    """A number in [0, 1) from the first 52 bits of an MD5 over the parts."""
    digest = F.md5(F.concat_ws("|", *[F.coalesce(p.cast("string"), F.lit("")) for p in parts]))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / float(1 << 52)


def mix(
    docs: DataFrame, rates: DataFrame, seed: int = 0, id_col: str = "doc_id", source_col: str = "source",
) -> DataFrame:
    """``docs`` repeated by their source's rate, in a global random order.

    ``rates`` has one row per source (mix_source, rate); a source without a rate,
    or with rate 0, goes. Null is a source like any other. Rows of equal id are
    drawn alike; rows without id are drawn as one id. Added columns: mix_copy
    (from 1) and mix_key, which orders the result. An empty table stays empty.
    These names, and those of the columns used inside, must be free in ``docs``.
    """
    taken = {"mix_copy", "mix_key", "__source", "__draws", "__cdf", "__copies"} & set(docs.columns)
    if taken:
        raise ValueError(f"the documents already have columns {sorted(taken)}")
    table = with_distribution(rates.withColumn("rate", F.coalesce("rate", F.lit(0.0))).where("rate > 0")).select(
        F.col("mix_source").alias("__source"), F.col("draws").alias("__draws"), F.col("cdf").alias("__cdf"))
    # measured: a small table of sources keeps the documents, and a hot source, from being shuffled for it
    table = broadcast_if_small(stored(table, "mix-rates"))
    own_id, seed_col = docs[id_col], F.lit(seed)
    drawn = docs.join(table, docs[source_col].eqNullSafe(F.col("__source")))
    numbers = F.transform(F.sequence(F.lit(1), F.col("__draws")), lambda j: uniform(seed_col, own_id, j))
    count = F.aggregate(numbers, F.lit(0), lambda acc, u: acc + F.size(F.filter("__cdf", lambda c: c <= u)))
    copies = drawn.withColumn("__copies", count).where("__copies > 0").withColumn(
        "mix_copy", F.explode(F.sequence(F.lit(1), F.col("__copies"))))
    keyed = copies.withColumn("mix_key", F.md5(F.concat_ws(
        "|", seed_col.cast("string"), F.coalesce(own_id.cast("string"), F.lit("")),
        F.col("mix_copy").cast("string"), F.lit("order"))))
    return keyed.select(*[docs[c] for c in docs.columns], "mix_copy", "mix_key").repartitionByRange(
        "mix_key").sortWithinPartitions("mix_key")
