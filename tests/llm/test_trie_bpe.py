import hashlib
import json
import random

import pyarrow as pa
import pytest
from awkward import awkward, awkward_rows, empty, given
from hypothesis import given as every
from hypothesis import settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from marlstone.llm import trie_bpe
from marlstone.llm.queries import QUERIES, WORD_TOKENIZER, tokenizer_path
from marlstone.llm.trie_bpe import TrieBpe

PATH = tokenizer_path(WORD_TOKENIZER)
ALPHABET = ["a", "B", "é", "×", "÷", " ", " ", " ", "\u0085", "　", "  ", "\n", "\r\n", "\t", "\x0b", ".", ",", "!",
            "'s", "'S", "'ll", "'", "’", "“", "1", "23", "٣", "Ⅷ", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "\x00",
            "\x1c", "\x7f", "中", "ß", "𝄞", "ª", "²", "…", "-", "_", "word", " word", "é", "́", "Σ", "ΑΣ", "İ",
            "ﬁ", "한", "ing", "the", "aaaa", "​", "ÄÖ", "ÿ"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


@pytest.fixture(scope="module")
def encoder():
    return TrieBpe(PATH)


def same(encoder, library, texts):
    ids, bounds = encoder.encode(pa.array(texts, pa.string()))
    decoded = encoder.decode(ids, bounds)
    for i, own in enumerate(library.encode_batch([t or "" for t in texts], add_special_tokens=False)):
        assert ids[bounds[i]:bounds[i + 1]].tolist() == own.ids, texts[i]
        assert decoded[i].decode() == library.decode(own.ids, skip_special_tokens=False)


def test_as_the_library_on_odd_texts(encoder, library):
    rng = random.Random(3)
    texts = ["".join(rng.choices(ALPHABET, k=rng.randint(0, 40))) for _ in range(6000)]
    same(encoder, library, [*texts, "", None, "x" * 5000, "ab" * 3000, "a" * 64, "a" * 65, "ü" * 40, "中" * 500])


def test_as_the_library_on_unlikely_words(encoder, library):
    rng = random.Random(5)
    letters = ["abcdefghijklmnopqrstuvwxyz", "aab", "ins", "eéè", "etaoin"]
    same(encoder, library, ["".join(rng.choices(rng.choice(letters), k=rng.randint(1, 90))) for _ in range(8000)])


@settings(max_examples=200, deadline=None)
@every(st.lists(st.text(max_size=60), max_size=8))
def test_as_the_library_on_any_text(texts):
    same(shared_encoder(), shared_library(), texts)


def shared_encoder(kept=[]):  # noqa: B006
    kept or kept.append(TrieBpe(PATH))
    return kept[0]


def shared_library(kept=[]):  # noqa: B006
    kept or kept.append(Tokenizer.from_file(PATH))
    return kept[0]


def test_prefixes_are_encoded_once_and_memory_is_bounded(library, monkeypatch):
    encoder = TrieBpe(PATH)
    encoder.encode(pa.array(["walk walked walker walking walks"]))
    inner = {w[:i] for w in ("walk", "walked", "walker", "walking", "walks") for i in range(1, len(w))}
    assert len(encoder._token) == 1 + len(inner)
    monkeypatch.setattr(trie_bpe, "TRIE_NODES", 100)
    monkeypatch.setattr(trie_bpe, "CACHED_CHUNKS", 50)
    for at in range(0, 2000, 100):
        same(encoder, library, [f"word{i} other{i % 7} {'xyz'[i % 3] * 30}{i}" for i in range(at, at + 100)])
    assert len(encoder._token) < 5000 and len(encoder._chunks) <= 400


def test_another_layout_gets_whole_texts(library, tmp_path):
    layout = json.loads(open(PATH, encoding="utf-8").read())
    layout["normalizer"]["normalizers"].pop()  # upper case stays
    path = tmp_path / "other.json"
    path.write_text(json.dumps(layout), encoding="utf-8")
    encoder, library = TrieBpe(str(path)), Tokenizer.from_file(str(path))
    assert not encoder.cuts
    same(encoder, library, ["Some  Text\nhere.", "", None, "é 中 ab"])


def test_merges_out_of_order_are_refused(tmp_path):
    layout = json.loads(open(PATH, encoding="utf-8").read())
    layout["model"]["merges"].reverse()
    path = tmp_path / "other.json"
    path.write_text(json.dumps(layout), encoding="utf-8")
    with pytest.raises(ValueError, match="order of training"):
        TrieBpe(str(path))


def test_whole_query_against_the_library(spark, library):
    sf_dir = "/root/testdata/sf0.01"
    docs = dict(given(sf_dir, "documents", "doc_id, text"))
    rows = QUERIES["op12_trie_bpe"](spark, sf_dir).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    for r in rows:
        ids = library.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        packed = b"".join(i.to_bytes(4, "little") for i in ids)
        text = library.decode(ids, skip_special_tokens=False)
        assert (r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) == (
            len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256(text.encode()).hexdigest())


def test_encode_and_decode_on_awkward_rows(spark, library):
    encoded = trie_bpe.encode(awkward(spark), PATH)
    texts = sorted((r[0] is not None, r[0] or 0, r[1] or "") for r in awkward_rows())
    ids = {t: library.encode(t, add_special_tokens=False).ids for _, _, t in texts}
    assert sorted((r["id"] is not None, r["id"] or 0, r["ids"]) for r in encoded.collect()) == sorted(
        (known, i, ids[t]) for known, i, t in texts)
    decoded = trie_bpe.decode(encoded, PATH).collect()
    assert sorted(r["text"] for r in decoded) == sorted(
        library.decode(ids[t], skip_special_tokens=False) for _, _, t in texts)
    assert trie_bpe.digests(awkward(spark), PATH).count() == len(texts)
    assert trie_bpe.encode(empty(spark), PATH).count() == 0 == trie_bpe.digests(empty(spark), PATH).count()


def test_decode_takes_null_ids(spark):
    df = spark.createDataFrame([(1, None), (2, []), (3, [3306, 267])], "id long, ids array<int>")
    assert {r["id"]: r["text"] for r in trie_bpe.decode(df, PATH).collect()} == {1: "", 2: "", 3: "hello</w> ,</w>"}
