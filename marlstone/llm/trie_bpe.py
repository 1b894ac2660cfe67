"""BPE encoding over a trie of words, and decoding.

The last token of a word's every prefix decides its encoding: of the tokens that
end a prefix, the right one is that which the library's merges would leave beside
the last token of the prefix before it, and there is just one. Words of a
corpus share prefixes, so distinct words go into a trie in sorted order, which
is a depth-first walk, and every node's last token is found once. Walking back
from a word's leaf by the lengths of these tokens gives its ids.
"""

from __future__ import annotations

import json
import re
from array import array
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marlstone.llm.arrays import NOT_SPACE, bound_batches, byte_slices, split_words, text_buffer
from marlstone.llm.storage import once_per_worker
from marlstone.llm.tokens import byte_letters

SLICE_BYTES = 4 << 20
TRIE_NODES = 1_000_000
CACHED_CHUNKS = 800_000
LONG_WORD = 64  # letters; longer words take the same steps without a place in the trie
LONG_CHUNK = 1024  # bytes; longer runs are not remembered
NEVER = 1 << 60

# The layout under which a text may be cut at ASCII white space.
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
NORMALIZERS = [
    {"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
# the same pattern over lower-case printable ASCII
ASCII_WORDS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
# with the letters of Latin-1, which have one form and lower-case one by one
LATIN = re.compile("[!-~\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]*")
LATIN_WORDS = re.compile("'s|'t|'re|'ve|'m|'ll|'d|[a-z\u00df-\u00f6\u00f8-\u00ff]+|[0-9]|[^a-z0-9\u00df-\u00f6\u00f8-\u00ff]+")


class TrieBpe:
    """Encodes and decodes as the tokenizers library does with one .json file.

    Takes byte-level BPE vocabularies, with or without a word-end suffix, whose
    merges are in order of training. Ids are those without added special
    tokens, truncation or padding; strings of special tokens inside a text get
    their own id.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            layout = json.load(file)
        model, added = layout["model"], layout.get("added_tokens", [])
        unusual = [k for k in ("dropout", "continuing_subword_prefix", "byte_fallback", "ignore_merges") if model.get(k)]
        if model["type"] != "BPE" or unusual or any(
                t["normalized"] or t["lstrip"] or t["rstrip"] or t["single_word"] for t in added):
            raise ValueError(f"{path}: not a plain BPE model")
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._suffix = model.get("end_of_word_suffix") or ""
        self._added = {t["content"]: t["id"] for t in added}
        ordered = sorted(self._added, key=len, reverse=True)
        self._added_pattern = re.compile("(" + "|".join(map(re.escape, ordered)) + ")") if ordered else None
        self._load(model)
        self.cuts = self._at_spaces(layout)
        strings = {i: t for t, i in (model["vocab"] | self._added).items()}
        self._strings = pa.array(
            [strings.get(i, "").encode() + b" " for i in range(max(strings) + 1)], pa.large_binary())
        self._joined = layout.get("decoder") is None
        self._letters = byte_letters()
        self._reset()
        self._chunks: dict[bytes, bytes] = {}

    @staticmethod
    def _at_spaces(layout: dict) -> bool:
        normal, split = layout.get("normalizer") or {}, layout.get("pre_tokenizer") or {}
        first, *rest = split.get("pretokenizers") or [{}]
        return (
            normal.get("normalizers") == NORMALIZERS and first.get("pattern") == {"Regex": WORD_PATTERN}
            and first.get("behavior") == "Removed" and first.get("invert") is True
            and [(p["type"], p.get("use_regex"), p.get("add_prefix_space")) for p in rest] == [("ByteLevel", False, False)]
            and not any(re.search(r"\s", t["content"]) for t in layout.get("added_tokens", [])))

    def _load(self, model: dict) -> None:
        vocab, suffix = model["vocab"], self._suffix
        ends = {t for t in vocab if suffix and t.endswith(suffix) and len(t) > len(suffix)}
        self._inner = {t: i for t, i in vocab.items() if t not in ends}
        self._final = {t[:-len(suffix)]: vocab[t] for t in ends} if suffix else self._inner
        texts = [*self._inner, *self._final]
        self._begins = {t[:i] for t in texts for i in range(len(t))} | self._inner.keys()
        self._merges: dict[tuple[int, int], int] = {}
        self._parts: dict[int, tuple[int, int, int]] = {}
        for rank, merge in enumerate(model["merges"]):
            left, right = merge.split(" ") if isinstance(merge, str) else merge
            a, b, made = vocab[left], vocab[right], vocab[left + right]
            self._merges[a, b] = rank
            self._parts[made] = a, b, rank
        if len(self._parts) < len(self._merges) or any(
                max(self._rank(a), self._rank(b)) >= rank for a, b, rank in self._parts.values()):
            raise ValueError("merges are not in order of training")
        self._stays: dict[int, bool] = {}
        self._reached: dict[int, bool] = {}
        self._ends, self._ending, self._state_of = [""], [[]], {"": 0}
        self._moves: dict[int, int] = {}
        self._closes: dict[int, list[tuple[int, int]]] = {}

    def _rank(self, token: int) -> int:
        parts = self._parts.get(token)
        return parts[2] if parts else -1

    def _apart(self, left: int, right: int, limit: int) -> bool:
        """Does no merge before ``limit`` join the two tokens' inner edges?

        Goes back in time from the whole tokens to their outermost letters, and
        asks at each moment whether the two parts that met then would have
        merged before either was merged with its own other half.
        """
        left_until = right_until = limit
        while True:
            rank = self._merges.get((left, right))
            # of equal merges the leftmost goes first
            if rank is not None and rank < left_until and rank <= right_until:
                return False
            made_left, made_right = self._rank(left), self._rank(right)
            if made_left < 0 and made_right < 0:
                return True
            if made_left > made_right:
                left, left_until = self._parts[left][1], made_left
            else:
                right, right_until = self._parts[right][0], made_right

    def _whole(self, token: int) -> bool:
        """Do the merges make this token from its own letters?"""
        known = self._reached.get(token)
        if known is None:
            parts = self._parts.get(token)
            known = parts is None or (
                self._whole(parts[0]) and self._whole(parts[1]) and self._apart(*parts))
            self._reached[token] = known
        return known

    def _enter(self, state: int, letter: str) -> int:
        """The state after one more letter.

        A state is the longest end of the letters so far with which a token
        begins; ``_ending`` has the tokens that end in it, the longest first.
        """
        text = self._ends[state] + letter
        while text not in self._begins:
            text = text[1:]
        found = self._state_of.get(text)
        if found is None:
            found = self._state_of[text] = len(self._ends)
            self._ends.append(text)
            self._ending.append(self._tokens_of(self._inner, text))
        self._moves[state << 21 | ord(letter)] = found
        return found

    def _tokens_of(self, vocab: dict[str, int], text: str) -> list[tuple[int, int]]:
        found = [(vocab.get(text[at:]), len(text) - at) for at in range(len(text))]
        return [(token, size) for token, size in found if token is not None and self._whole(token)]

    def _closing(self, state: int, letter: str) -> list[tuple[int, int]]:
        """The tokens that end a word with this last letter, the longest first."""
        key = state << 21 | ord(letter)
        found = self._closes.get(key)
        if found is None:
            found = self._closes[key] = self._tokens_of(self._final, self._ends[state] + letter)
        return found

    def _last(self, tokens: list[tuple[int, int]], path: list[int], letter: str) -> tuple[int, int]:
        """The last token of a prefix and the node before it; ``path`` has the nodes of all shorter prefixes."""
        depth, before, stays = len(path), self._token, self._stays
        for found, size in tokens:
            if size == depth:
                return found, 0
            node = path[-size]
            left = before[node]
            beside = stays.get(left << 21 | found)
            if beside is None:
                beside = stays[left << 21 | found] = self._apart(left, found, NEVER)
            if beside:
                return found, node
        raise ValueError(f"no token ends in {letter!r}")

    def _reset(self) -> None:
        self._children: dict[int, int] = {}
        # by node: last token, the node before that token, state; the first is the root
        self._token, self._back, self._state = array("i", [-1]), array("i", [0]), array("i", [0])
        self._words: dict[str, bytes] = {}

    def _grow(self, path: list[int], letter: str) -> int:
        """A node for the path's letters and one more."""
        state = self._state[path[-1]]
        state = self._moves.get(state << 21 | ord(letter)) or self._enter(state, letter)
        found, node = self._last(self._ending[state], path, letter)
        self._token.append(found)
        self._back.append(node)
        self._state.append(state)
        return len(self._token) - 1

    def _ids(self, path: list[int], letter: str) -> bytes:
        """Ids of a word, of whose letters but the last the path has the nodes."""
        found, node = self._last(self._closing(self._state[path[-1]], letter), path, letter)
        ids = array("I", [found])
        while node:
            ids.append(self._token[node])
            node = self._back[node]
        ids.reverse()
        return ids.tobytes()

    def _insert(self, words: list[str]) -> None:
        """Words into the trie depth-first; each node's last token comes from its ancestors'.

        A word's last letter is a leaf of its own, which the word's ids stand for.
        """
        path, before, children = [0], "", self._children
        for word in sorted(words):
            inner = word[:-1]
            shared, most = 0, min(len(before), len(inner))
            while shared < most and before[shared] == inner[shared]:
                shared += 1
            del path[shared + 1:]
            for letter in inner[shared:]:
                step = path[-1] << 21 | ord(letter)
                node = children.get(step)
                if node is None:
                    node = children[step] = self._grow(path, letter)
                path.append(node)
            self._words[word] = self._ids(path, word[-1])
            before = inner

    def _long(self, word: str) -> bytes:
        """A long word's ids, by the same steps along its own prefixes, which leave the trie again."""
        nodes, path = len(self._token), [0]
        for letter in word[:-1]:
            path.append(self._grow(path, letter))
        ids = self._ids(path, word[-1])
        for kept in (self._token, self._back, self._state):
            del kept[nodes:]
        return ids

    def _split(self, chunk: bytes) -> list[str | int]:
        """Words of a run of text, in letters of the vocabulary; a special token is its id."""
        text = chunk.decode()
        if self.cuts and LATIN.fullmatch(text) and (
                self._added_pattern is None or not self._added_pattern.search(text)):
            if text.isascii():
                return ASCII_WORDS.findall(text.lower())
            return [w if w.isascii() else w.encode().decode("latin-1").translate(self._letters)
                    for w in LATIN_WORDS.findall(text.lower())]
        found: list[str | int] = []
        normalizer, split = self._tokenizer.normalizer, self._tokenizer.pre_tokenizer
        for part in self._added_pattern.split(text) if self._added_pattern else [text]:
            if part in self._added:
                found.append(self._added[part])
            elif part:
                part = normalizer.normalize_str(part) if normalizer else part
                found.extend(word for word, _ in split.pre_tokenize_str(part)) if split else found.append(part)
        return found

    def _learn(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of every chunk; distinct new words are inserted together."""
        split = [self._split(chunk) for chunk in chunks]
        new = {w for words in split for w in words if isinstance(w, str) and len(w) <= LONG_WORD} - self._words.keys()
        if len(self._token) > TRIE_NODES:
            self._reset()
            new = {w for words in split for w in words if isinstance(w, str) and len(w) <= LONG_WORD}
        self._insert(list(new))

        def ids(word: str | int) -> bytes:
            if isinstance(word, int):
                return word.to_bytes(4, "little")
            return self._words[word] if len(word) <= LONG_WORD else self._long(word)

        return [b"".join(map(ids, words)) for words in split]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and each text's first place among them and the end; null is empty."""
        data, offsets = text_buffer(texts)
        if not self.cuts:
            parts = self._learn([data[a:b].tobytes() for a, b in zip(offsets, offsets[1:], strict=False)])
            bounds = np.concatenate([[0], np.cumsum([len(p) // 4 for p in parts])]).astype(np.int64)
            return np.frombuffer(b"".join(parts), "<u4"), bounds
        words = split_words(data, offsets, NOT_SPACE)
        if not words.codes.size:
            return np.zeros(0, "<u4"), np.zeros(len(offsets), np.int64)
        distinct = words.distinct.to_pylist()
        if len(self._chunks) + len(distinct) > CACHED_CHUNKS:
            self._chunks = {}
        known = list(map(self._chunks.get, distinct))
        new = [chunk for chunk, ids in zip(distinct, known, strict=True) if ids is None]
        learned = dict(zip(new, self._learn(new), strict=True))
        self._chunks.update((c, ids) for c, ids in learned.items() if len(c) <= LONG_CHUNK)
        encoded = pa.array([learned[c] if ids is None else ids for c, ids in zip(distinct, known, strict=True)],
                           pa.large_binary()).take(pa.array(words.codes))
        at = np.frombuffer(encoded.buffers()[1], np.int64)[encoded.offset:encoded.offset + len(encoded) + 1]
        ids = np.frombuffer(encoded.buffers()[2], "<u4", int(at[-1] - at[0]) // 4, int(at[0]))
        return ids, (at[words.before] - at[0]) // 4

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The text of each run of ids, in UTF-8."""
        if not self._joined:
            return [t.encode() for t in self._tokenizer.decode_batch(
                [ids[a:b].tolist() for a, b in zip(bounds, bounds[1:], strict=False)], skip_special_tokens=False)]
        if not ids.size:
            return [b""] * (len(bounds) - 1)
        shown = self._strings.take(pa.array(ids.astype(np.int64)))
        at = np.frombuffer(shown.buffers()[1], np.int64)[shown.offset:shown.offset + len(shown) + 1]
        data, edges = memoryview(shown.buffers()[2]), at[bounds]
        # every token brings a space, of which a text's last is left out
        return [bytes(data[a:max(a, b - 1)]) for a, b in zip(edges, edges[1:], strict=False)]


def _encoder(path: str) -> TrieBpe:
    return once_per_worker(("trie-bpe", path), lambda: TrieBpe(path))


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select(
        F.col(id_col).cast("bigint").alias("id"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, and the token ids of the whole text.

    Null and empty texts have none; ids of rows may repeat or be null; an empty
    table gives no rows; other columns are not read.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                ids, bounds = encoder.encode(part.column("text"))
                yield pa.record_batch({
                    "id": part.column("id"),
                    "ids": pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids.astype(np.int32)))})

    return _texts(docs, id_col, text_col).mapInArrow(run, "id bigint, ids array<int>")


def decode(encoded: DataFrame, tokenizer: str, id_col: str = "id", ids_col: str = "ids") -> DataFrame:
    """One row per row of ``encoded``: id, and the text of its ids, special tokens included; null ids are none."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            lists = batch.column("ids")
            bounds = np.concatenate([[0], np.cumsum(pc.fill_null(pc.list_value_length(lists), 0).to_numpy())])
            texts = encoder.decode(lists.flatten().to_numpy(zero_copy_only=False), bounds.astype(np.int64))
            yield pa.record_batch({
                "id": batch.column("id"), "text": pa.array([t.decode(errors="replace") for t in texts], pa.string())})

    bound_batches(encoded.sparkSession)
    rows = encoded.select(F.col(id_col).cast("bigint").alias("id"), F.col(ids_col).cast("array<int>").alias("ids"))
    return rows.mapInArrow(run, "id bigint, text string")


def digests(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: id, n_tokens, ids_sha256 and decoded_sha256.

    What encode() and then decode() give, with only their digests leaving the task.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoder(tokenizer)
        for batch in batches:
            for part in byte_slices(batch, "text", SLICE_BYTES):
                ids, bounds = encoder.encode(part.column("text"))
                own = [sha256(ids[a:b].tobytes()).hexdigest() for a, b in zip(bounds, bounds[1:], strict=False)]
                yield pa.record_batch({
                    "id": part.column("id"), "n_tokens": pa.array(np.diff(bounds), pa.int64()),
                    "ids_sha256": pa.array(own, pa.string()),
                    "decoded_sha256": pa.array(
                        [sha256(text).hexdigest() for text in encoder.decode(ids, bounds)], pa.string())})

    return _texts(docs, id_col, text_col).mapInArrow(
        run, "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
