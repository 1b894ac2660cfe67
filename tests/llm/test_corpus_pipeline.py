import random
import subprocess
import sys
import zlib
from pathlib import Path

import numpy as np
import pytest
from awkward import awkward, empty, given
from test_decontaminate import brute as hits_of
from test_near_dedup import brute as groups_of

ROOT = Path(__file__).resolve().parents[2]
sys.path.insert(0, str(ROOT))

import corpus_pipeline  # noqa: E402

from marlstone.llm import quality  # noqa: E402
from marlstone.llm.queries import tokenizer_path  # noqa: E402

COLUMNS = "doc_id, text, lang, source, n_chars"


def rows_of(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_and_run_agree_with_brute_force(spark, sf_dir):
    from tokenizers import Tokenizer

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    good = steps["quality classifier"](spark, docs, sf_dir)
    assert good.columns == docs.columns
    kept = rows_of(good)
    model = quality.train(docs, quality.graded(spark.read.parquet(f"{sf_dir}/labels.parquet")))
    chance = {r["id"]: r["top_probability"] for r in quality.scores(docs, model).collect()}
    assert set(kept) == {i for i, p in chance.items() if p >= 0.5}

    single = steps["near-dedup"](spark, good, sf_dir)
    groups = groups_of(list(kept.items()), 5)
    assert set(rows_of(single)) == {i for i, (_, c) in groups.items() if i == c}

    clean = steps["benchmark decontamination"](spark, single, sf_dir)
    hits = hits_of(list(rows_of(single).items()), given(sf_dir, "benchmark", "item_id, text"))
    assert set(rows_of(clean)) == {i for i, (_, n, _) in hits.items() if not n}
    assert clean.columns == docs.columns

    mixed = steps["source mixing"](spark, clean, sf_dir)
    assert mixed.columns == docs.columns
    copies = sorted((r["doc_id"], r["text"]) for r in mixed.collect())
    assert {i for i, _ in copies} <= set(rows_of(clean))

    library = Tokenizer.from_file(tokenizer_path())
    expected, start = [], 0
    for i, text in copies:
        data = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        expected.append((i, start, len(data), zlib.crc32(data.tobytes())))
        start += len(data)
    out = corpus_pipeline.run(spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, out)) == expected


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory, sf_dir):
    path = tmp_path_factory.mktemp("odd")
    for name, df in (("documents", awkward(spark)), ("benchmark", spark.read.parquet(f"{sf_dir}/benchmark.parquet")),
                     ("labels", spark.read.parquet(f"{sf_dir}/labels.parquet"))):
        df.write.parquet(str(path / f"{name}.parquet"))
    return str(path)


@pytest.mark.parametrize("make", [awkward, empty])
def test_every_stage_takes_awkward_rows(spark, odd_dir, make):
    docs = make(spark)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, odd_dir)
        assert out.columns == docs.columns
        out.collect()
    corpus_pipeline.STAGES[-1][1](spark, docs, odd_dir).collect()


def test_pipeline_drops_planted_cases_and_keeps_clean_ones(spark, sf_dir, tmp_path):
    rng = random.Random(4)
    given_docs = [r for r in given(sf_dir, "documents", COLUMNS)]
    plain = sorted(given_docs, key=lambda r: -len(r[1]))[:60]
    plain = [r for r in plain if r[2] == "en"]
    item = given(sf_dir, "benchmark", "text")[0][0]
    words = [f"clean{rng.randrange(10 ** 6)}" for _ in range(400)]
    fresh = [(10_000 + i, " ".join(rng.sample(words, 80)) + ".", "en", "src1", 1) for i in range(20)]
    edited = [(20_000 + i, t.replace("clean", "clean", 1) + " end", "en", "src1", 1) for i, t, *_ in fresh[:5]]
    leaked = [(30_000, " ".join(rng.sample(words, 30)) + " " + item, "en", "src1", 1)]
    spark.createDataFrame(given_docs + fresh + edited + leaked, "doc_id long, text string, lang string, source string, n_chars long") \
        .write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    steps = dict(corpus_pipeline.STAGES)
    kept = steps["quality classifier"](spark, docs, sf_dir)
    assert {i for i, *_ in fresh} <= set(rows_of(kept))
    single = steps["near-dedup"](spark, kept, sf_dir)
    clean = set(rows_of(steps["benchmark decontamination"](spark, single, sf_dir)))
    assert {i for i, *_ in fresh} <= clean and 30_000 not in clean
    assert not {i + 10_000 for i, *_ in fresh[:5]} & clean
    assert plain


def test_the_rest_works_without_these_folders():
    """The entry module imports, and offers the other queries, where they are not there."""
    code = (
        "import sys\n"
        "class Absent:\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name == 'corpus_pipeline' or name.startswith('marlstone.llm'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Absent())\n"
        "import __spark_entry__ as e\n"
        "assert 'pipeline' not in e.queries() and not any(q.startswith('op') for q in e.queries())\n"
        "assert len(e.queries()) > 100 and set(e.oracle_sql()) <= set(e.queries())\n")
    subprocess.run([sys.executable, "-c", code], cwd=ROOT, check=True)
