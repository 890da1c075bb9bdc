"""Token ids of many words at once, over Arrow arrays: each distinct word goes to the tokenizer once."""

from __future__ import annotations

import os
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Bytes of text taken together; longer texts are cut between words.
CHUNK_BYTES = 1 << 22
# Words whose ids a task keeps for the runs that follow, of at most so many bytes each.
CACHE_WORDS, CACHED_BYTES = 400_000, 64
ENCODE_AT_ONCE = 20_000


def load_tokenizer(text: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_str(text)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    return tokenizer


class WordIds:
    """Ids of words as an Arrow list array; the first ``kept`` short words seen (by default CACHE_WORDS) are kept."""

    def __init__(self, tokenizer, kept: int | None = None):
        self.tokenizer = tokenizer
        self.kept = CACHE_WORDS if kept is None else kept
        self.special = [t.content for t in tokenizer.get_added_tokens_decoder().values()]
        self.words = pa.array([], pa.string())
        self.ids = pa.array([], pa.list_(pa.int32()))

    def encode(self, words: pa.Array) -> pa.Array:
        offsets, values = [np.zeros(1, np.int64)], []
        for at in range(0, len(words), ENCODE_AT_ONCE):
            ids = [e.ids for e in self.tokenizer.encode_batch_fast(words.slice(at, ENCODE_AT_ONCE).to_pylist(), add_special_tokens=False)]
            offsets.append(offsets[-1][-1] + np.cumsum([len(x) for x in ids], dtype=np.int64))
            values.append(np.fromiter((i for x in ids for i in x), np.int32))
        return pa.ListArray.from_arrays(pa.array(np.concatenate(offsets), pa.int32()), pa.array(np.concatenate(values) if values else [], pa.int32()))

    def __call__(self, words: pa.Array) -> pa.Array:
        """``words`` are distinct."""
        known = pc.index_in(words, value_set=self.words)
        new = words.filter(pc.is_null(known))
        ids = self.encode(new)
        at = known.to_numpy(zero_copy_only=False).copy() if known.null_count == 0 else pc.fill_null(known, -1).to_numpy(zero_copy_only=False).copy()
        at[at < 0] = len(self.words) + np.arange(len(new))
        out = pa.concat_arrays([self.ids, ids]).take(pa.array(at))
        if (room := self.kept - len(self.words)) > 0:
            short = pa.array(np.flatnonzero(pc.binary_length(new).to_numpy() <= CACHED_BYTES)[:room])
            self.words = pa.concat_arrays([self.words, new.take(short)])
            self.ids = pa.concat_arrays([self.ids, ids.take(short)])
        return out


def in_chunks(texts: pa.Array, cut: re.Pattern, size: int | None = None) -> Iterator[tuple[np.ndarray, pa.Array]]:
    """Runs of texts of about ``size`` bytes (by default CHUNK_BYTES), in order, with the row of each; null texts are empty.

    A longer text comes by itself, in parts that begin where ``cut`` matches. Runs are slices of Arrow's buffers.
    """
    size = size or CHUNK_BYTES
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    ends = np.append(0, np.cumsum(sizes, dtype=np.int64))
    at = 0
    while at < len(texts):
        if sizes[at] > size:
            text, begin = texts[at].as_py(), 0
            while begin is not None:
                m = cut.search(text, begin + size)
                to = m.start() if m else None
                yield np.array([at]), pa.array([text[begin:to]], pa.large_string())
                begin = to
            at += 1
        else:
            to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
            yield np.arange(at, to), pc.fill_null(texts.slice(at, to - at).cast(pa.large_string()), "")
            at = to


def packed(x: np.ndarray, kind: str = "<i4") -> bytes:
    """Integers as byte planes, compressed."""
    raw = np.ascontiguousarray(x, kind)
    return pa.compress(raw.view(np.uint8).reshape(-1, raw.itemsize).T.tobytes(), "zstd", asbytes=True)


def unpacked(x: bytes, n: int, kind: str = "<i4") -> np.ndarray:
    width = np.dtype(kind).itemsize
    raw = pa.decompress(x, width * n, "zstd", asbytes=True) if n else b""
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(width, n).T).view(kind).ravel()


def flat(lists: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Values and offsets of a list array."""
    offsets = lists.offsets.to_numpy()
    return lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]], offsets - offsets[0]
