import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from awkward import awkward, awkward_rows, empty, given
from hypothesis import given as every
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marlstone.llm import simple8b, token_counts, token_output
from marlstone.llm.queries import QUERIES, tokenizer_path
from marlstone.llm.tokens import Encoder

ALPHABET = ["a", "B", "é", "×", "÷", " ", " ", "　", "\u0085", " ", "  ", "\n", "\r\n", "\t", ".", ",", "!",
            "'s", "'ll", "’", "“", "1", "23", "<|endoftext|>", "<|", "|>", "\x00", "\x1c", "\x7f", "中", "ß", "𝄞", "ª",
            "²", "…", "-", "_", "word", " word", " ", "​"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def ids_of(library, texts):
    return [x.ids for x in library.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def test_pieces_encode_as_whole_texts(library):
    rng = random.Random(5)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(4000)] + ["", None, "x" * 100_000]
    encoder, expected = Encoder(tokenizer_path()), ids_of(library, texts)
    ids, counts = encoder.encode(pa.array(texts))
    assert counts.tolist() == [len(x) for x in expected]
    assert ids.tolist() == [i for x in expected for i in x]
    assert encoder.counts(pa.array(texts)).tolist() == counts.tolist()


def test_memory_of_pieces_is_bounded(library, monkeypatch):
    monkeypatch.setattr("marlstone.llm.tokens.CACHED_PIECES", 50)
    monkeypatch.setattr("marlstone.llm.tokens.CHUNK_BYTES", 200)
    texts = [f"word{i} other{i % 7} {i * i}" for i in range(500)]
    encoder = Encoder(tokenizer_path())
    ids, _ = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for x in ids_of(library, texts) for i in x]


def test_frequent_pieces_stay_known_past_the_bound(library, monkeypatch):
    monkeypatch.setattr("marlstone.llm.tokens.CACHED_PIECES", 50)
    monkeypatch.setattr("marlstone.llm.tokens.CHUNK_BYTES", 200)
    learned, learn = Counter(), Encoder._learn

    def counted(self, *kinds):
        learned.update(piece for kind in kinds for piece in kind)
        learn(self, *kinds)

    monkeypatch.setattr(Encoder, "_learn", counted)
    texts = [f"x often é, word{i} {i * i}" for i in range(500)]
    encoder = Encoder(tokenizer_path())
    ids, _ = encoder.encode(pa.array(texts))
    assert ids.tolist() == [i for x in ids_of(library, texts) for i in x]
    assert learned[b" often"] == 1 and len(encoder._known) <= 50


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "piece_bpe_32k.model"])
def test_other_tokenizers_get_whole_texts(name):
    path = public_tokenizers.path(name)
    texts = ["Some  Text\nhere.", "", None, "é 中"]
    if name.endswith(".model"):
        import sentencepiece

        expected = sentencepiece.SentencePieceProcessor(model_file=path).encode([t or "" for t in texts])
    else:
        expected = ids_of(Tokenizer.from_file(path), texts)
    ids, counts = Encoder(path).encode(pa.array(texts))
    assert counts.tolist() == [len(x) for x in expected] and ids.tolist() == [i for x in expected for i in x]


@settings(max_examples=150, deadline=None)
@every(st.lists(st.one_of(st.integers(0, 3), st.integers(0, 60000), st.integers(0, 2 ** 64 - 1)), max_size=400),
       st.sampled_from([1, 7, 64, 1024]))
def test_simple8b_round_trip(values, block):
    data = np.array(values, np.uint64)
    packed = simple8b.pack(data, block)
    assert simple8b.unpack(packed, len(values), block).tolist() == values
    assert len(packed.offsets) == -(-len(values) // block)
    assert len(packed.escapes) == sum(v >= 2 ** 60 for v in values)


def test_simple8b_packs_small_ids_tightly():
    assert simple8b.pack(np.ones(60_000, np.uint64)).words.size <= 1100
    assert simple8b.pack(np.full(60_000, 50_000, np.uint64)).words.size <= 20_100
    # any block can be decoded without the others
    values = np.arange(5000, dtype=np.uint64) * np.uint64(37)
    packed = simple8b.pack(values)
    a, b = packed.offsets[2], packed.offsets[3]
    alone = simple8b.Packed(packed.words[a:b], np.zeros(1, np.uint32), packed.escapes)
    assert simple8b.unpack(alone, 1024).tolist() == values[2048:3072].tolist()


def expected_output(library, rows):
    out, start = [], 0
    for i, ids in rows:
        data = np.array([*ids, 0], "<u4")
        out.append((i, start, len(data), zlib.crc32(data.tobytes())))
        start += len(data)
    return out


def test_output_query(spark, sf_dir, library):
    docs = sorted(given(sf_dir, "documents", "doc_id, text"))
    expected = expected_output(library, zip([d for d, _ in docs], ids_of(library, [t for _, t in docs]), strict=True))
    rows = QUERIES["op3_token_output"](spark, sf_dir).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, rows)) == expected


def test_output_of_awkward_rows(spark, tmp_path, library):
    token_output.write_tokens(awkward(spark), str(tmp_path / "t"), tokenizer_path())
    rows = sorted((r[0], r[1]) for r in awkward_rows() if r[0] is not None and r[1] is not None)
    got = token_output.read_tokens(spark, str(tmp_path / "t")).collect()
    assert len(got) == len(awkward_rows())
    starts = sorted((r["start"], r["n_tokens"]) for r in got)
    assert all(a + n == b for (a, n), (b, _) in zip(starts, starts[1:], strict=False))
    assert sorted(r["n_tokens"] - 1 for r in got) == sorted(
        len(x) for x in ids_of(library, [r[1] for r in awkward_rows()]))
    by_id = [r["id"] for r in sorted(got, key=lambda r: r["start"])]
    assert by_id[:2] == [None, None] and by_id[2:] == sorted(by_id[2:]) and rows


def test_empty_output(spark, tmp_path):
    token_output.write_tokens(empty(spark), str(tmp_path / "t"), tokenizer_path())
    assert token_output.read_tokens(spark, str(tmp_path / "t")).count() == 0


def test_counts_query_and_awkward_rows(spark, sf_dir, library):
    docs = dict(given(sf_dir, "documents", "doc_id, text"))
    lengths = dict(zip(docs, map(len, ids_of(library, docs.values())), strict=True))
    for r in QUERIES["op4_token_counts"](spark, sf_dir).collect():
        assert (r["n_bytes"], r["n_tokens"], r["over_limit"]) == (
            len((docs[r["doc_id"]] or "").encode()), lengths[r["doc_id"]], lengths[r["doc_id"]] > 1024)
    got = token_counts.token_counts(awkward(spark), tokenizer_path()).collect()
    texts = [r[1] for r in awkward_rows()]
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in got) == sorted(
        (len((t or "").encode()), len(x)) for t, x in zip(texts, ids_of(library, texts), strict=True))
    assert token_counts.token_counts(empty(spark), tokenizer_path()).count() == 0


def test_an_order_of_ones_own_is_kept_in_the_files(spark, tmp_path):
    rows = [(i, f"text {i}", (i * 7) % 20) for i in range(20)] + [(3, "text 3", 19)]
    df = spark.createDataFrame(rows, "doc_id long, text string, order0 long")
    path = str(tmp_path / "tokens")
    token_output.write_tokens(df, path, tokenizer_path(), order=["order0"])
    found = sorted(token_output.read_tokens(spark, path).collect(), key=lambda r: r["start"])
    assert [r["id"] for r in found] == [i for i, _, _ in sorted(rows, key=lambda r: (r[2], r[0]))]
