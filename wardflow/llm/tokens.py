"""Token ids of whole texts, computed from their distinct chunks.

Both byte-pair vocabularies used here split a text before every white space that follows something else and between
a letter or digit and a mark other than the apostrophe, and nothing after such a point changes how the part before it
is encoded. So a text's ids are those of its chunks (white space and the word behind it, marks), and a chunk seen
before is not encoded again. Chunks are found, looked up and put together as columns, without an object for each.
Texts with white space other than space, tab, line feed and carriage return, where the rule could differ, and texts
that hold the string of a special token, which the tokenizer as loaded takes for that token, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

MEMO, LONGEST = 400_000, 64
SLICE_BYTES = 4 << 20
# Chunks of one word end, or of one beginning with white space: for both vocabularies' splitting rules the letters behind
# a space or line feed are one piece, and a space belongs to whatever follows it.
LETTERS = "A-Za-zÀ-ÖØ-öø-ÿ"
ONE_END = rf"\A[ \n][{LETTERS}]+\z"
ONE_BEGINNING = rf"\A(?: [^ \t\n\r]+|\n[{LETTERS}]+)\z"
# White space that the libraries at hand do not class alike.
ODD = (
    r"[\x0b\x0c\x1c-\x1f\x{85}\x{a0}\x{1680}\x{180e}\x{2000}-\x{200d}\x{2028}\x{2029}\x{202f}\x{205f}"
    r"\x{2060}\x{3000}\x{feff}]"
)
BYTES = np.arange(256)
SPACE = np.isin(BYTES, [9, 10, 13, 32])
ALNUM = np.isin(BYTES, list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"))
MARK = (BYTES > 32) & (BYTES < 127) & ~ALNUM & (BYTES != 39)
# The letters from U+00C0 to U+00FF are the byte C3 and one of these.
LATIN = (BYTES >= 0x80) & (BYTES < 0xC0) & ~np.isin(BYTES, [0x97, 0xB7])


class ChunkEncoder:
    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [token.content for token in self.tokenizer.get_added_tokens_decoder().values()]
        self.odd = "|".join([ODD, *(re.escape(content) for content in special if content)])
        # Chunks met lately and their ids.
        self.memo, self.memo_ids = pa.array([], pa.large_string()), pa.array([], pa.large_binary())
        # Which ids end a word, or else (without a mark of word ends) which begin with its space or line feed.
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.marks_ends = bool(suffix)
        self.mark = np.zeros(self.tokenizer.get_vocab_size() + 1, bool)
        for token, number in self.tokenizer.get_vocab().items():
            self.mark[number] = token.endswith(suffix) if suffix else token.startswith(("Ġ", "Ċ"))

    def encode(self, texts: pa.Array) -> Iterator[bytes]:
        """The ids of each text (null: none) as little-endian unsigned 32-bit integers."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        start = 0
        while start < len(texts):
            done = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, done + SLICE_BYTES, side="right")))
            yield from self._encode(texts.slice(start, end - start))
            start = end

    def _encode(self, texts: pa.Array) -> Iterator[bytes]:
        odd = pc.match_substring_regex(texts, self.odd)
        chunks, firsts = _chunks(pc.if_else(odd, "", texts))
        chunks = chunks.dictionary_encode()
        ids, ends = _content(self._ids(chunks.dictionary).take(chunks.indices), "<i8")
        for i, strange in enumerate(odd.to_pylist()):
            if strange:
                encoded = self.tokenizer.encode_batch_fast([texts[i].as_py()], add_special_tokens=False)[0]
                yield np.array(encoded.ids, "<u4").tobytes()
            else:
                yield ids[ends[firsts[i]] : ends[firsts[i + 1]]].tobytes()

    def _ids(self, distinct: pa.Array) -> pa.Array:
        """The ids of each chunk; ``distinct`` holds none twice."""
        at = pc.fill_null(pc.index_in(distinct, value_set=self.memo), -1).to_numpy().copy()
        new = at < 0
        fresh = distinct.filter(pa.array(new))
        fresh_ids = self._whole(fresh)
        at[new] = len(self.memo) + np.arange(len(fresh))
        found = pa.concat_arrays([self.memo_ids, fresh_ids]).take(pa.array(at))
        if len(self.memo) + len(fresh) > MEMO:
            self.memo, self.memo_ids = self.memo[:0], self.memo_ids[:0]
            fresh, fresh_ids = distinct, found
        short = pc.less_equal(pc.binary_length(fresh), LONGEST)
        self.memo = pa.concat_arrays([self.memo, fresh.filter(short)])
        self.memo_ids = pa.concat_arrays([self.memo_ids, fresh_ids.filter(short)])
        return found

    def _whole(self, chunks: pa.Array) -> pa.Array:
        """The ids of each chunk. Chunks with one mark each are encoded as one text, which is faster."""
        alike = pc.match_substring_regex(chunks, ONE_END if self.marks_ends else ONE_BEGINNING)
        joined = _content(chunks.filter(alike), "<i8")[0].tobytes().decode()
        encoded = self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids if joined else []
        ids = np.array(encoded, "<u4")
        marked = np.flatnonzero(self.mark[ids])
        alike = alike.to_numpy(zero_copy_only=False)
        if len(marked) != alike.sum():
            return self._each(chunks)
        cuts = 4 * np.concatenate([[0], marked + 1] if self.marks_ends else [marked, [len(ids)]])
        rest = self._each(chunks.filter(pa.array(~alike)))
        place = np.where(alike, np.cumsum(alike) - 1, len(marked) + np.cumsum(~alike) - 1)
        return pa.concat_arrays([_cut(ids, cuts), rest]).take(pa.array(place))

    def _each(self, chunks: pa.Array) -> pa.Array:
        encoded = self.tokenizer.encode(chunks.to_pylist(), is_pretokenized=True, add_special_tokens=False)
        owner = np.array([w for w in encoded.word_ids if w is not None], np.int64)
        ends = 4 * np.cumsum(np.bincount(owner, minlength=len(chunks)))
        return _cut(np.array(encoded.ids, "<u4"), np.concatenate([[0], ends]))


def _cut(ids: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """``ids`` cut at the bytes ``bounds``."""
    buffers = [None, pa.py_buffer(bounds.astype("<i8")), pa.py_buffer(ids)]
    return pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, buffers)


def _content(values: pa.Array, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """(the bytes of all values, where in them each begins and the last ends); ``kind`` is that of the array's offsets."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    bounds = np.frombuffer(values.buffers()[1], kind, len(values) + 1, int(kind[-1]) * values.offset).astype(np.int64)
    size = int(bounds[-1] - bounds[0])
    raw = np.frombuffer(values.buffers()[2], np.uint8, size, int(bounds[0])) if size else np.zeros(0, np.uint8)
    return raw, bounds - bounds[0]


def _chunks(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """(the chunks of all texts, which of them is the first of each text); the chunks lie in the texts' own bytes."""
    raw, offsets = _content(texts, "<i4")
    space, mark = SPACE[raw], MARK[raw]
    begins = space.copy()
    begins[1:] &= ~space[:-1]
    begins[1:] |= mark[1:] & ALNUM[raw[:-1]]
    begins[2:] |= mark[2:] & LATIN[raw[1:-1]] & (raw[:-2] == 0xC3)
    begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(begins)
    bounds = np.append(starts, len(raw))
    chunks = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(bounds), pa.py_buffer(raw)])
    return chunks, np.searchsorted(starts, offsets)


@lru_cache(maxsize=2)
def encoder(path: str) -> ChunkEncoder:
    """One encoder per Python worker and vocabulary file; what it has learned serves later tasks too."""
    return ChunkEncoder(path)
