import random
from collections import defaultdict

import numpy as np
import pyarrow as pa
from awkward import LOWER, awkward, awkward_rows, empty, given

from marlstone.llm import bloom, near_dedup
from marlstone.llm.components import components
from marlstone.llm.queries import QUERIES


def shingle_set(text, size):
    words = (text or "").translate(LOWER).encode().split()
    if len(words) < size:
        return frozenset([tuple(words)]) if words else frozenset()
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def brute(rows, size):
    """Components over all pairs, copies first."""
    sets = {i: shingle_set(t, size) for i, t in rows}
    parent = {i: i for i in sets}

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def link(a, b):
        a, b = sorted((root(a), root(b)))
        parent[b] = a

    classes = defaultdict(list)
    for i, s in sets.items():
        if s:
            classes[s].append(i)
    for ids in classes.values():
        for i in ids:
            link(ids[0], i)
    reps = [(s, ids[0]) for s, ids in classes.items()]
    holders = defaultdict(list)
    for k, (s, _) in enumerate(reps):
        for x in s:
            holders[x].append(k)
    for k, (s, i) in enumerate(reps):
        for other in {m for x in s for m in holders[x] if m > k}:
            t, j = reps[other]
            shared = len(s & t)
            if 100 * shared >= 80 * (len(s) + len(t) - shared):
                link(i, j)
    return {i: (len(s), root(i)) for i, s in sets.items()}


def found(df):
    return {r["id"]: (r["n_shingles"], r["component_id"]) for r in df.collect()}


def test_query_matches_brute_force(spark, sf_dir):
    expected = brute(given(sf_dir, "documents", "doc_id, text"), 2)
    rows = QUERIES["op1_near_dedup"](spark, sf_dir).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in rows} == expected
    assert len(rows) == len(expected) and all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in rows)


def near_group(rng, base, n, most):
    """Copies of a text with up to ``most`` words replaced."""
    out = []
    for _ in range(n):
        words = base.split()
        for _ in range(rng.randint(0, most)):
            words[rng.randrange(len(words))] = f"edit{rng.random():.6f}"
        out.append(" ".join(words))
    return out


def test_large_group_of_near_copies(spark):
    """Many members lie under the threshold from the first one and must be reached through others."""
    rng = random.Random(11)
    base = " ".join(f"w{rng.randrange(10 ** 6)}" for _ in range(90))
    texts = near_group(rng, base, 500, 16)
    # a chain: neighbours are alike, its ends are not
    chain = [f"c{i}" for i in range(100)]
    for _ in range(12):
        texts.append(" ".join(chain))
        chain = chain[6:] + [f"c{rng.random():.6f}" for _ in range(6)]
    # short texts that share a phrase without being copies
    texts += [f"the very common phrase of all {rng.randrange(40)} and {rng.randrange(40)}" for _ in range(200)]
    rows = list(enumerate(texts))
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    expected = brute(rows, 2)
    assert len({c for _, c in expected.values()}) > 20
    assert found(near_dedup.near_duplicates(df, words=2)) == expected


def test_awkward_rows_and_empty_table(spark):
    got = near_dedup.near_duplicates(awkward(spark), words=2).collect()
    assert len(got) == len(awkward_rows())
    expected = brute([(r[0], r[1]) for r in awkward_rows() if r[0] is not None], 2)
    assert {r["id"]: (r["n_shingles"], r["component_id"]) for r in got if r["id"] is not None} == expected
    assert all(r["kept"] and r["component_id"] is None for r in got if r["id"] is None)
    assert near_dedup.near_duplicates(empty(spark)).count() == 0
    left = near_dedup.keep_one(awkward(spark))
    assert left.columns == awkward(spark).columns
    ids = [r["doc_id"] for r in left.collect()]
    assert ids.count(1) == 2 and 2 not in ids and ids.count(None) == 2 and 7 not in ids and {3, 4, 5} <= set(ids)


def test_estimate_follows_similarity():
    rng = np.random.default_rng(3)
    for shared, own in ((900, 100), (300, 300), (40, 5), (20, 80)):
        near, truth = [], shared / (shared + 2 * own)
        for _ in range(40):
            pool = rng.integers(0, 2 ** 63, shared + 2 * own, dtype=np.uint64) * np.uint64(2)
            sets = [np.sort(pool[:shared + own]), np.sort(np.concatenate([pool[:shared], pool[shared + own:]]))]
            starts = np.array([0, len(sets[0]), len(sets[0]) + len(sets[1])])
            rows = near_dedup.registers(np.concatenate(sets), starts)
            n = np.array([float(shared + own)])
            near.append(near_dedup.estimate(rows[:1], rows[1:], n, n)[0])
        assert abs(np.mean(near) - truth) < 0.03
        assert np.std(near) < 2 * np.sqrt(truth * (1 - truth) / min(shared + own, 512)) + 0.01


def test_chance_collisions_are_expected():
    rng = np.random.default_rng(4)
    agree = []
    for _ in range(60):
        sets = [np.sort(rng.integers(0, 2 ** 63, 20_000, dtype=np.uint64) * np.uint64(2)) for _ in range(2)]
        rows = near_dedup.registers(np.concatenate(sets), np.array([0, 20_000, 40_000]))
        agree.append((rows[0] == rows[1]).mean())
    expected = near_dedup.expected_collisions(np.array([20_000.0]), np.array([20_000.0]))[0]
    assert 0.5 * expected < np.mean(agree) < 2 * expected


def test_shingles_of_texts_without_enough_words():
    hashes, starts = near_dedup.shingles(pa.array(["a b c", "A  B", "", None, "b a", "a b a b"]), 3)
    assert np.diff(starts).tolist() == [1, 1, 0, 0, 1, 2]
    again, _ = near_dedup.shingles(pa.array(["a b"]), 3)
    assert hashes[1] == again[0] != hashes[2]


def test_components_of_a_long_path_and_a_star(spark):
    rng = random.Random(2)
    names = list(range(1000, 1300))
    rng.shuffle(names)
    path = [tuple(sorted(p)) for p in zip(names, names[1:], strict=False)]
    star = [(1, i) for i in range(2, 800)]
    got = {r["node"]: r["component"] for r in components(
        spark.createDataFrame(path + star, "a long, b long")).collect()}
    assert got == {**dict.fromkeys(names, 1000), **dict.fromkeys(range(1, 800), 1)}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_bloom_filter_has_no_false_negative(spark, monkeypatch):
    rng = np.random.default_rng(8)
    own, other = (rng.integers(-2 ** 63, 2 ** 63 - 1, 5000) for _ in range(2))
    df = spark.createDataFrame([(int(v),) for v in own] + [(None,)], "v long").repartition(3)
    for bits in (bloom.MAX_BITS, 1 << 15):
        monkeypatch.setattr(bloom, "MAX_BITS", bits)
        built = bloom.bloom_filter(df, "v").value
        assert bloom.may_contain(built, own).all() and built.size * 8 <= max(bits, 1 << 16)
        if bits > 1 << 15:
            assert bloom.may_contain(built, other).mean() < 0.05
    assert not bloom.may_contain(bloom.bloom_filter(df.limit(0), "v").value, other).any()
