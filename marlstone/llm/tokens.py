"""Token ids by the public tokenizer libraries, each distinct piece of text encoded once.

A byte-level BPE splits text by a fixed pattern before it merges, so a text cut
where that pattern always ends a match has the ids of its pieces, end to end.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from itertools import chain, compress, repeat

import numpy as np
import pyarrow as pa

from marlstone.llm.arrays import ragged_positions, text_buffer
from marlstone.llm.storage import once_per_worker

CHUNK_BYTES = 4 << 20
CACHED_PIECES = 250_000
JOINED = 1000

# Bytes that are neither white space nor control characters. Lead bytes under
# which Unicode keeps its other white space are left out as well.
_PLAIN = np.zeros(256, bool)
_PLAIN[0x21:0x7F] = True
_PLAIN[0x80:] = True
_SPACE_LEADS = np.zeros(256, bool)
_SPACE_LEADS[[0xC2, 0xE1, 0xE2, 0xE3]] = True
_ASCII_LETTER = np.zeros(256, bool)
_ASCII_LETTER[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = True
_LETTER_LEAD = np.zeros(256, bool)  # of U+00C0 to U+00FF, all letters but U+00D7 and U+00F7
_LETTER_LEAD[0xC3] = True
_LETTER_TAIL = np.zeros(256, bool)
_LETTER_TAIL[0x80:0xC0] = True
_LETTER_TAIL[[0x97, 0xB7]] = False
_CLOSING = np.zeros(256, bool)
_CLOSING[list(b".,;:!?")] = True


def byte_letters() -> dict[int, str]:
    """The printable character that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(shown)]
    return {b: chr(b) for b in shown} | {b: chr(0x100 + i) for i, b in enumerate(others)}


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """True at every byte before which the pre-tokenizer always splits.

    These are: a single space between two plain characters, a single line break
    between two plain characters (before and after it), and a closing mark
    right after an ASCII letter or one of U+00C0 to U+00FF.
    """
    n = data.size
    cuts = np.zeros(n, bool)
    if n < 3:
        return cuts
    begins = _PLAIN[data] & ~_SPACE_LEADS[data]  # a plain character may begin here
    ends = _PLAIN[data]  # a plain character ends here
    ends[1:] &= ~((data[1:] >= 0x80) & _SPACE_LEADS[data[:-1]])
    ends[2:] &= ~((data[2:] >= 0x80) & _SPACE_LEADS[data[:-2]])
    between = ends[:-2] & begins[2:]
    cuts[1:-1] = between & ((data[1:-1] == 0x20) | (data[1:-1] == 0x0A))
    cuts[2:] |= between & (data[1:-1] == 0x0A)
    closing = np.flatnonzero(_CLOSING[data[2:]]) + 2
    before = data[closing - 1]
    cuts[closing] |= _ASCII_LETTER[before] | (_LETTER_TAIL[before] & _LETTER_LEAD[data[closing - 2]])
    cuts[1] |= _CLOSING[data[1]] & _ASCII_LETTER[data[0]]
    return cuts


class Encoder:
    """Encodes texts as the library does, with a bounded memory of pieces.

    ``path`` names a tokenizers .json or a sentencepiece .model file. Texts are
    cut into pieces only for a byte-level BPE without normalizer; other kinds
    get every text whole.
    """

    def __init__(self, path: str) -> None:
        self.pieces = False
        if path.endswith(".model"):
            import sentencepiece

            model = sentencepiece.SentencePieceProcessor(model_file=path)
            self._encode = lambda texts: [np.array(x, np.int64) for x in model.encode(texts, num_threads=1)]
        else:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
            from tokenizers import Tokenizer

            tokenizer = Tokenizer.from_file(path)
            tokenizer.no_truncation()
            tokenizer.no_padding()
            self._encode = lambda texts: [
                np.array(x.ids, np.int64) for x in tokenizer.encode_batch_fast(texts, add_special_tokens=False)]
            with open(path, encoding="utf-8") as file:
                layout = json.load(file)
            split = layout.get("pre_tokenizer") or {}
            self.pieces = (
                split.get("type") == "ByteLevel" and split.get("use_regex", True)
                and not split.get("add_prefix_space") and not layout.get("normalizer")
                and all(not (t["lstrip"] or t["rstrip"] or t["single_word"] or set(t["content"]) & set(" \n.,;:!?"))
                        for t in layout.get("added_tokens", [])))
            self._marks = np.zeros(256, bool)
            self._marks[[t["content"].encode()[0] for t in layout.get("added_tokens", [])]] = True
            self._model = tokenizer.model
            self._letters = np.zeros(256, "<u2")
            for byte, letter in byte_letters().items():
                self._letters[byte] = ord(letter)
            self._letters[0x0A] = 0x0A  # stands between words, and in none
            line_break = self._encode(["\n"])[0]
            self._line_break = int(line_break[0]) if line_break.size == 1 else None
        self._reset()

    def _reset(self) -> None:
        self._known: dict[bytes, int] = {}
        self._ids = np.zeros(1 << 16, np.int64)
        self._starts = np.zeros(1 << 12, np.int64)
        self._sizes = np.zeros(1 << 12, np.int64)
        self._n_ids = 0

    def _remember(self, pieces: list[bytes], ids: np.ndarray, sizes: np.ndarray) -> None:
        n, m = len(self._known), len(pieces)
        while n + m > self._starts.size:
            self._starts, self._sizes = np.append(self._starts, self._starts), np.append(self._sizes, self._sizes)
        while self._n_ids + ids.size > self._ids.size:
            self._ids = np.append(self._ids, self._ids)
        self._ids[self._n_ids:self._n_ids + ids.size] = ids
        self._starts[n:n + m] = self._n_ids + np.cumsum(sizes) - sizes
        self._sizes[n:n + m] = sizes
        self._n_ids += ids.size
        self._known.update(zip(pieces, range(n, n + m), strict=True))

    def _numbers(self, pieces: list[bytes]) -> np.ndarray:
        """The numbers of the pieces, -1 for those not known."""
        return np.fromiter(map(self._known.get, pieces, repeat(-1)), np.int64, len(pieces))

    def _keep(self, pieces: list[bytes]) -> None:
        """Forget all but ``pieces``, which are known."""
        numbers = self._numbers(pieces)
        sizes = self._sizes[numbers]
        ids = self._ids[ragged_positions(self._starts[numbers], sizes)]
        self._reset()
        self._remember(pieces, ids, sizes)

    def _joinable(self, distinct: pa.Array) -> np.ndarray:
        """True for pieces that may stand between line breaks in a longer string.

        They are plain characters after at most one space; one with a first
        character of an added token in it is left out too.
        """
        data = np.frombuffer(distinct.buffers()[2], np.uint8)
        offsets = np.frombuffer(distinct.buffers()[1], np.int64)
        odd = (~_PLAIN | _SPACE_LEADS | self._marks)[data]
        first = offsets[:-1]
        odd[first[(data[first] == 0x20) & (np.diff(offsets) > 1)]] = False
        return np.diff(np.concatenate([[0], np.cumsum(odd)])[offsets]) == 0

    @staticmethod
    def _single(distinct: pa.Array) -> np.ndarray:
        """True for pieces of letters after at most one space: the pattern does not split them."""
        data = np.frombuffer(distinct.buffers()[2], np.uint8)
        offsets = np.frombuffer(distinct.buffers()[1], np.int64)
        odd = ~(_ASCII_LETTER | _LETTER_LEAD)[data]
        odd[1:] &= ~(_LETTER_LEAD[data[:-1]] & _LETTER_TAIL[data[1:]])
        first = offsets[:-1]
        odd[first[(data[first] == 0x20) & (np.diff(offsets) > 1)]] = False
        return np.diff(np.concatenate([[0], np.cumsum(odd)])[offsets]) == 0

    def _learn(self, single: list[bytes], plain: list[bytes], apart: list[bytes]) -> None:
        """Single words go straight to the library's merges, other plain pieces in long
        strings with a line break between them, the rest one by one."""
        if single:
            shown = self._letters[np.frombuffer(b"\n".join(single), np.uint8)].tobytes().decode("utf-16-le")
            tokenize = self._model.tokenize
            found = [[t.id for t in tokenize(word)] for word in shown.split("\n")]
            sizes = np.fromiter(map(len, found), np.int64, len(found))
            self._remember(single, np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum())), sizes)
        groups = [plain[i:i + JOINED] for i in range(0, len(plain), JOINED)]
        for group, ids in zip(
                groups, self._encode([b"\n".join(g).decode() for g in groups]) if groups else [], strict=True):
            breaks = np.flatnonzero(ids == self._line_break)
            if breaks.size != len(group) - 1:
                apart.extend(group)
                continue
            bounds = np.concatenate([[-1], breaks, [ids.size]])
            self._remember(group, np.delete(ids, breaks), np.diff(bounds) - 1)
        if apart:
            found = self._encode([p.decode() for p in apart])
            self._remember(apart, np.concatenate(found), np.array([x.size for x in found], np.int64))

    def _chunks(self, data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pieces in chunks of bounded bytes: first byte, and the number of the known piece."""
        cuts = safe_cuts(data)
        cuts[offsets[:-1][offsets[:-1] < data.size]] = True
        starts = np.append(np.flatnonzero(cuts), data.size)
        at = 0
        while at < starts.size - 1:
            stop = max(at + 1, int(np.searchsorted(starts, starts[at] + CHUNK_BYTES, "right")) - 1)
            own = starts[at:stop + 1]
            coded = pa.Array.from_buffers(pa.large_binary(), stop - at, [
                None, pa.py_buffer(own - own[0]), pa.py_buffer(np.ascontiguousarray(data[own[0]:own[-1]])),
            ]).dictionary_encode()
            distinct = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
            numbers = self._numbers(distinct)
            new = numbers < 0
            if len(self._known) + int(new.sum()) > CACHED_PIECES:
                self._keep(list(compress(distinct, ~new)))  # those met again, so that frequent pieces stay
                numbers = self._numbers(distinct)
            single = self._single(coded.dictionary)
            plain = self._joinable(coded.dictionary) & (self._line_break is not None) & ~single
            self._learn(*(list(compress(distinct, new & kind)) for kind in (single, plain, ~single & ~plain)))
            numbers[new] = self._numbers(list(compress(distinct, new)))
            yield own[:-1], numbers[coded.indices.to_numpy(zero_copy_only=False)]
            at = stop

    def counts(self, texts: pa.Array) -> np.ndarray:
        """Tokens per text; null is empty. No list of ids is kept."""
        if not self.pieces:
            return np.array([x.size for x in self._whole(texts)], np.int64)
        data, offsets = text_buffer(texts)
        total = np.zeros(len(texts), np.int64)
        for starts, numbers in self._chunks(data, offsets):
            text = np.searchsorted(offsets, starts, "right") - 1
            total += np.bincount(text, self._sizes[numbers], len(texts)).astype(np.int64)
        return total

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts end to end, and how many each text has; null is empty."""
        if not self.pieces:
            found = self._whole(texts)
            return (np.concatenate(found) if found else np.zeros(0, np.int64),
                    np.array([x.size for x in found], np.int64))
        data, offsets = text_buffer(texts)
        total, parts = np.zeros(len(texts), np.int64), [np.zeros(0, np.int64)]
        for starts, numbers in self._chunks(data, offsets):
            sizes = self._sizes[numbers]
            parts.append(self._ids[ragged_positions(self._starts[numbers], sizes)])
            text = np.searchsorted(offsets, starts, "right") - 1
            total += np.bincount(text, sizes, len(texts)).astype(np.int64)
        return np.concatenate(parts), total

    def _whole(self, texts: pa.Array) -> list[np.ndarray]:
        return self._encode([t or "" for t in texts.to_pylist()]) if len(texts) else []


def worker_encoder(path: str) -> Encoder:
    """The worker's own encoder: loaded once, and what it has learned serves its later tasks."""
    return once_per_worker(("encoder", path), lambda: Encoder(path))
