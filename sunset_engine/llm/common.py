"""Shared pieces of the training-data operators: table access, tokenizer files, hashing of words."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.operators.joins import materialize

MASK = (1 << 64) - 1
# Bytes hashed at once: eight bytes a power, a few arrays of that size at a time.
WINDOW_BYTES = 1 << 18


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_json(path: str) -> str:
    """The tokenizer file's text: the driver reads it once and tasks get it by broadcast."""
    with open(path, encoding="utf-8") as f:
        return f.read()


# ---- words and shingles of whole texts, over Arrow's byte buffers -------------------------------

def _odd_inverse(b: int) -> int:
    x = b
    for _ in range(6):
        x = (x * (2 - b * x)) & MASK
    return x


_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = _odd_inverse(_BASE)
_BYTE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.random.default_rng(7).integers(1, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

WHITE_SPACE = np.zeros(256, bool)
WHITE_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
# ASCII letters and digits and all bytes of longer characters make words here.
NOT_ALNUM = np.array([not (chr(b).isalnum() or b >= 128) if b < 128 else False for b in range(256)])


def _lowered() -> np.ndarray:
    t = _BYTE.copy()
    t[65:91] = t[97:123]
    return t


_LOWER = _lowered()


def mix(h: np.ndarray) -> np.ndarray:
    """Final mixing of 64-bit hashes (the public murmur3 finaliser)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def distinct(x: np.ndarray) -> np.ndarray:
    """Sorted distinct values (a plain sort: many times faster on hashes than hashing them again)."""
    x = np.sort(x)
    return x[np.append(True, x[1:] != x[:-1])] if len(x) else x


def string_bytes(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its values (nulls are empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8) if column.buffers()[2] is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def text_slices(column: pa.Array, size: int = 1 << 21) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Bytes and offsets of runs of texts of about ``size`` bytes, a single longer text by itself; only a run is copied."""
    ends = np.append(0, np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64))
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + size, "right")) - 1)
        yield string_bytes(column.slice(at, to - at))
        at = to


def lean_memory() -> None:
    """What this worker freed in earlier tasks, and Arrow's buffers from now on, go back to the system."""
    pa.set_memory_pool(pa.system_memory_pool())
    with contextlib.suppress(OSError, AttributeError):          # glibc only
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable) -> Callable:
    """``run`` over a task's batches, with the worker's memory given back before and after."""
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lean_memory()
        try:
            yield from run(batches)
        finally:
            lean_memory()
    return wrapped


def word_hashes(data: np.ndarray, offsets: np.ndarray, separator: np.ndarray = WHITE_SPACE, prefixes: tuple[int, ...] = ()) -> tuple[np.ndarray, ...]:
    """64-bit hash of every word of every text, A-Z lower-cased, and each text's first word.

    Words are runs of bytes that ``separator`` does not mark. ``prefixes`` adds, for each
    length in bytes, the hashes of the words' beginnings. The bytes are taken in
    windows that end between words, so memory is bounded by the longest word or the window.
    """
    n = len(data)
    hashes, places = [], []
    begun: list[list[np.ndarray]] = [[] for _ in prefixes]
    at = 0
    begins = np.zeros(n + 1, bool)
    begins[offsets[:-1]] = True
    powers = np.empty(0, np.uint64)
    while at < n:
        to = min(n, at + WINDOW_BYTES)
        while to < n:                        # back to a place between words, else further on
            back = np.flatnonzero(separator[data[at + 1:to + 1]] | begins[at + 1:to + 1])
            if len(back):
                to = at + 1 + int(back[-1])
                break
            to = min(n, to + WINDOW_BYTES)
        part = data[at:to]
        word = ~separator[part]
        starts = word.copy()
        starts[1:] &= ~word[:-1] | begins[at + 1:to]
        starts = np.flatnonzero(starts)
        if len(starts):
            if len(powers) < len(part):
                powers = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(part) - 1, _BASE, np.uint64)]))
                inverse = np.multiply.accumulate(np.concatenate([[np.uint64(1)], np.full(len(part) - 1, _INVERSE, np.uint64)]))
            value = np.where(word, _LOWER[part], np.uint64(0)) * powers[:len(part)]
            sums = np.append(np.uint64(0), np.cumsum(value, dtype=np.uint64))
            following = np.append(starts[1:], len(part))
            hashes.append(mix((sums[following] - sums[starts]) * inverse[starts]))
            places.append(starts + at)
            if prefixes:
                letters = np.append(0, np.cumsum(word, dtype=np.int32))
                size = letters[following] - letters[starts]
                for most, out in zip(prefixes, begun, strict=True):
                    out.append(mix((sums[starts + np.minimum(size, most)] - sums[starts]) * inverse[starts] + _PLACE[most]))
        at = to
    found = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
    place = np.concatenate(places) if places else np.zeros(0, np.int64)
    return found, np.searchsorted(place, offsets), *(np.concatenate(x) if x else np.zeros(0, np.uint64) for x in begun)


def shingle_sets(words: np.ndarray, first: np.ndarray, k: int) -> Iterator[np.ndarray]:
    """Sorted distinct ``k``-word shingle hashes of each text; with fewer words, the whole sequence as one."""
    n = len(words)
    rolled = np.zeros(max(0, n - k + 1), np.uint64)
    for j in range(k):
        rolled += words[j:j + len(rolled)] * _PLACE[j]
    rolled = mix(rolled)
    for a, b in zip(first[:-1], first[1:], strict=True):
        m = b - a
        if m >= k:
            yield distinct(rolled[a:b - k + 1])
        elif m:
            yield mix(np.add.reduce(words[a:b] * _PLACE[:m], keepdims=True) + _PLACE[40 + m:41 + m])
        else:
            yield np.zeros(0, np.uint64)


# ---- connected components -----------------------------------------------------------------------

def connected_components(edges: DataFrame, name: str = "components") -> DataFrame:
    """Smallest reachable id of every id in ``edges(a, b)``: columns (id, component_id).

    Alternating large-star and small-star rounds (Kiveris et al., "Connected components
    in MapReduce and beyond"). Every round is one written table; the loop ends when a
    round changes nothing. Each star takes a minimum by key, combined before the shuffle,
    and a join of that minimum to the edges, whose hot keys Spark can split. No group is
    gathered anywhere.
    """
    now = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name)
    state = None
    while True:
        here = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if here == state or not here[0]:
            break
        state = here
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        # Written, so that both sides of the join are shuffled for it and Spark can split a hub's edges.
        least = materialize(both.groupBy(F.col("a").alias("c")).agg(F.least(F.col("c"), F.min("b")).alias("m")), f"{name}-least")
        large = both.where("b > a").join(least, F.col("a") == F.col("c")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        down = large.groupBy(F.col("a").alias("c")).agg(F.min("b").alias("m"))
        joined = large.join(down, F.col("a") == F.col("c"))
        small = joined.select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
        now = materialize(small.where("a <> b").distinct(), name)
    return now.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("component_id")).unionAll(
        now.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
