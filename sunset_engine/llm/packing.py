"""Best-fit packing of documents into sequences by bin completion.

Items are document pieces of 1 to ``capacity`` tokens, so all that a packing needs is how
many pieces there are of each length: at most ``capacity`` numbers, whatever the size of
the corpus. The search runs on those numbers. Best-fit decreasing gives the first incumbent.
Bin completion (Korf) then takes the largest length left, enumerates all undominated fillings
of the room beside it, least waste first, applies each as often as the counts allow, completes it by best fit, and
gives up a branch once its waste exceeds what an incumbent one sequence better would
allow; it stops when an incumbent meets the lower bound or after a set number of fillings.

The result is a short list of patterns with repetitions. Spark numbers the pieces of each
length (by hashed groups, so that no length is numbered in one task) and joins the numbers
with the patterns' ranges.
"""

from __future__ import annotations

import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunset_engine.llm.common import lean, table, tokenizer_json
from sunset_engine.llm.word_ids import WordIds, flat, in_chunks, load_tokenizer
from sunset_engine.operators.joins import materialize

CAPACITY = 1024
END_ID = 2
# Pieces of one length that are numbered together.
GROUP_ROWS = 20_000
NODES = 3_000

Pattern = tuple[tuple[int, ...], int]         # lengths in order, times used

# A space before a letter, digit, mark or other visible ASCII always begins a token of this tokenizer, and
# so does a single line feed between visible characters.
SAFE_CUT = re.compile(r" (?=[^\W_]|[!-~])")
NOT_SAFE = "[ \\n]([\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}\\x{2028}-\\x{202f}\\x{205f}\\x{3000}\\x{feff}]|$)|^\\n"
# ASCII marks at the end of a word are tokens of their own.
MARKS_AT_END = r"^(?P<stem>(?s:.*)[\p{L}\p{N}])(?P<marks>[!-/:-@\[-`{-~]+)$"


# ---- the search, on counts by length ------------------------------------------------------------

def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """Sequences needed at least: by total length, and by lengths that cannot share (Martello and Toth)."""
    count = np.zeros(capacity + 2, np.int64)
    count[1 + np.fromiter(counts, np.int64)] = np.fromiter(counts.values(), np.int64)
    items, tokens = np.cumsum(count), np.cumsum(count * (np.arange(capacity + 2) - 1))      # of lengths below the index
    k = np.arange(capacity // 2 + 1)
    middle = capacity // 2 + 1
    half = items[capacity - k + 1] - items[middle]
    room = capacity * half - (tokens[capacity - k + 1] - tokens[middle])
    spill = tokens[middle] - tokens[k] - room
    return int(max(-(-tokens[-1] // capacity), (items[-1] - items[middle] + np.maximum(0, -(-spill // capacity))).max()))


def best_fit(counts: dict[int, int], capacity: int) -> list[Pattern]:
    """Best-fit decreasing; sequences that look alike are kept as one entry with a number."""
    open_bins: list[list[Pattern]] = [[] for _ in range(capacity + 1)]
    some = 0                                   # bit r: there are sequences with room for r
    for n in sorted(counts, reverse=True):
        left = counts[n]
        while left:
            fits = some >> n
            if fits:
                rest = n + (fits & -fits).bit_length() - 1
                held, times = open_bins[rest].pop()
                if not open_bins[rest]:
                    some &= ~(1 << rest)
            else:
                held, times, rest = (), math.ceil(left / (capacity // n)), capacity
            each = rest // n
            full = min(times, left // each)
            if full:
                open_bins[rest - each * n].append((held + (n,) * each, full))
                some |= 1 << rest - each * n
                left -= full * each
                times -= full
            if left and times and left < each:
                open_bins[rest - left * n].append((held + (n,) * left, 1))
                some |= 1 << rest - left * n
                times -= 1
                left = 0
            if times and held:
                open_bins[rest].append((held, times))
                some |= 1 << rest
    return [p for bins in open_bins for p in bins]


def reachable(lengths: list[int], counts: dict[int, int], room: int) -> list[int]:
    """Sums up to ``room`` that the lengths from each place on can make, as bits: one more entry than lengths."""
    all_ = (1 << room + 1) - 1
    out = [1]
    for n in reversed(lengths):
        now, left, step = out[-1], min(counts[n], room // n), 1
        while left:                            # copies in steps that double, the rest at last
            step = min(step, left)
            now |= now << n * step & all_
            left -= step
            step *= 2
        out.append(now)
    return out[::-1]


def fillings(counts: dict[int, int], room: int, waste: int) -> Iterator[tuple[int, ...]]:
    """All undominated fillings of ``room`` with waste of at most ``waste``, least waste first, one after another.

    A single length that fits exactly dominates everything. Otherwise a filling is kept when
    no length left fits into its waste and none of its lengths can be exchanged for a
    larger one that is left and still fits. The sums that can be reached are found first, so no walk ends in vain.
    """
    if room == 0 or counts.get(room):
        yield (room,) if room else ()
        return
    lengths = sorted((n for n, c in counts.items() if c and n <= room), reverse=True)
    sums = reachable(lengths, counts, room)

    def exact(at: int, rest: int, lost: int, spare: int) -> Iterator[tuple[int, ...]]:
        """``spare`` is the last length passed of which one is left: what it could replace is passed too."""
        if rest == 0:
            yield ()
            return
        for i in range(at, len(lengths)):
            if not sums[i] >> rest & 1:        # nor from any later place
                return
            n = lengths[i]
            if not lost or spare - n > lost:
                for k in range(min(counts[n], rest // n), 0, -1):
                    if sums[i + 1] >> rest - k * n & 1:
                        for more in exact(i + 1, rest - k * n, lost, n if k < counts[n] else spare):
                            yield (n,) * k + more
            spare = n

    for lost in range(min(waste, room) + 1):
        if sums[0] >> room - lost & 1:
            for held in exact(0, room - lost, lost, room + lost + 1):
                if not any(held.count(n) < counts[n] for n in lengths if n <= lost):
                    yield held


def bin_completion(counts: dict[int, int], capacity: int = CAPACITY, nodes: int = NODES) -> list[Pattern]:
    """Patterns that hold every item once: the best packing found, proven or left after ``nodes`` fillings tried.

    ``nodes`` is the search's only bound; ``lower_bound`` tells how far the result can be from the best.
    """
    counts = {n: c for n, c in counts.items() if c}
    least = lower_bound(counts, capacity)
    best = best_fit(counts, capacity)
    size = sum(t for _, t in best)
    total = sum(n * c for n, c in counts.items())

    def options(now: dict[int, int], wasted: int) -> tuple[int, Iterator[tuple[int, ...]]]:
        largest = max(now)
        others = dict(now)
        others[largest] -= 1
        return largest, fillings(others, capacity - largest, (size - 1) * capacity - total - wasted)

    left = nodes
    stack = [(counts, [], 0, 0, *options(counts, 0))] if counts else []
    while stack and size > least and left:
        now, made, used, wasted, largest, untried = stack[-1]
        filling = next(untried, None)
        if filling is None:
            stack.pop()
            continue
        left -= 1
        allowed = (size - 1) * capacity - total - wasted         # waste that one sequence fewer leaves
        pattern = (largest, *filling)
        lost = capacity - sum(pattern)
        if lost > allowed:                                       # the incumbent got better meanwhile
            stack.pop()
            continue
        times = min(now[n] // pattern.count(n) for n in set(pattern))
        if lost:
            times = max(1, min(times, allowed // lost))
        after = dict(now)
        for n in pattern:
            after[n] -= times
        after = {n: c for n, c in after.items() if c}
        child, used, wasted = [*made, (pattern, times)], used + times, wasted + lost * times
        rest = best_fit(after, capacity)                         # completes the branch: a new incumbent, perhaps
        if used + (n := sum(t for _, t in rest)) < size:
            best, size = child + rest, used + n
        if after and used + lower_bound(after, capacity) < size:
            stack.append((after, child, used, wasted, *options(after, wasted)))
    return best


# ---- pieces of documents ------------------------------------------------------------------------

def _word_parts(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """Parts that the tokenizer treats apart: (distinct parts, code of each part, offsets by text)."""
    unsafe = pc.match_substring_regex(texts, NOT_SAFE).to_numpy(zero_copy_only=False)
    split = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
    words, offsets = split.flatten(), split.offsets.to_numpy()
    offsets = offsets - offsets[0]
    if unsafe.any():
        lists = split.to_pylist()
        for i in np.flatnonzero(unsafe):
            text = texts[i].as_py()
            cuts = [0, *(m.start() for m in SAFE_CUT.finditer(text) if m.start())]
            parts = [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]
            lists[i] = [parts[0], *(p[1:] for p in parts[1:])]
        words = pa.array([w for x in lists for w in x], pa.large_string())
        offsets = np.append(0, np.cumsum([len(x) for x in lists]))
    first = np.zeros(len(words), bool)
    first[offsets[:-1]] = True
    heads = words.filter(pa.array(first)).cast(pa.string()).dictionary_encode()
    rest = words.filter(pa.array(~first)).cast(pa.string()).dictionary_encode()
    codes = np.empty(len(words), np.int64)
    codes[first] = heads.indices.to_numpy()
    codes[~first] = rest.indices.to_numpy() + len(heads.dictionary)
    spaced = pc.if_else(pc.starts_with(rest.dictionary, "\n"), rest.dictionary, pc.binary_join_element_wise("", rest.dictionary, " "))
    both = pa.concat_arrays([heads.dictionary, spaced]).dictionary_encode()
    return both.dictionary, both.indices.to_numpy()[codes], offsets


def _ids_of(encode: WordIds, words: pa.Array) -> pa.Array:
    """Ids of distinct words; marks at the end are encoded apart, so that there are fewer words."""
    plain = words
    for token in encode.special:                              # such a string is one token, marks and all
        plain = pc.if_else(pc.match_substring(words, token), "", plain)
    found = pc.extract_regex(plain, MARKS_AT_END)
    stems = pc.coalesce(pc.struct_field(found, "stem"), words).dictionary_encode()
    marks = pc.coalesce(pc.struct_field(found, "marks"), pa.scalar("")).dictionary_encode()
    parts = [flat(encode(x.dictionary).take(x.indices)) for x in (stems, marks)]
    size = [np.diff(offsets) for _, offsets in parts]
    ends = np.append(0, np.cumsum(size[0] + size[1]))
    out = np.empty(ends[-1], np.int32)
    begins = ends[:-1]
    for (values, offsets), n in zip(parts, size, strict=True):
        out[np.repeat(begins - offsets[:-1], n) + np.arange(len(values))] = values
        begins = begins + n
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out))


def _cut(ids: np.ndarray, capacity: int) -> Iterator[tuple[int, int, int, int]]:
    """(piece, start, length, crc32) of a document's ids."""
    n = len(ids)
    raw = memoryview(np.ascontiguousarray(ids, "<u4")).cast("B")
    first = n if n <= capacity else (n - 1) % capacity + 1
    ends = [0, *range(first, n + 1, capacity)]
    for piece, (a, b) in enumerate(zip(ends[:-1], ends[1:], strict=True)):
        yield piece, a, b - a, zlib.crc32(raw[4 * a:4 * b])


def _pieces(shared, capacity: int, end_id: int, run_bytes: int | None = None, kept_words: int | None = None) -> Callable:
    end = np.array([end_id], np.uint32)

    def run(batches):
        encode = WordIds(load_tokenizer(shared.value), kept_words)
        for batch in batches:
            out: list[tuple] = []
            row, held = -1, []
            ids = batch.column("doc_id").to_pylist()

            def close() -> None:
                if row >= 0:
                    whole = np.concatenate([*held, end])
                    out.extend((ids[row], *x) for x in _cut(whole, capacity))

            for rows, texts in in_chunks(batch.column("text"), SAFE_CUT, run_bytes):
                words, codes, offsets = _word_parts(texts)
                values, ends = flat(_ids_of(encode, words).take(pa.array(codes)))
                values = values.view(np.uint32)
                ends = ends[offsets]
                for i, r in enumerate(rows.tolist()):
                    if r != row:
                        close()
                        row, held = r, []
                    held.append(values[ends[i]:ends[i + 1]])
            close()
            columns = list(zip(*out, strict=True)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.int32()), *(pa.array(c, pa.int64()) for c in columns[2:])],
                                             names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return lean(run)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int = END_ID,
                 id_col: str = "doc_id", text_col: str = "text", run_bytes: int | None = None, kept_words: int | None = None) -> DataFrame:
    """Documents to pieces (doc_id, piece, start, length, ids_crc32) of at most ``capacity`` tokens.

    A document is its ids by the tokenizer and then ``end_id`` (a null or empty text: that id
    alone). Only longer ones are cut; the first piece takes what whole pieces leave. A task encodes runs of texts of
    ``run_bytes`` and keeps the ids of ``kept_words`` words: less memory for more time, the same pieces.
    """
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        _pieces(shared, capacity, end_id, run_bytes, kept_words), "doc_id long, piece int, start long, length long, ids_crc32 long")


# ---- assignment ---------------------------------------------------------------------------------

def slots(patterns: list[Pattern]) -> list[tuple[int, int, int, int, int, int]]:
    """Ranges of item numbers by length: (length, from, to, each, sequence, offset).

    Item number ``r`` of a length in [from, to) goes to sequence + (r - from) // each, at
    offset + ((r - from) % each) * length.
    """
    used: dict[int, int] = {}
    out, sequence = [], 0
    for pattern, times in sorted(patterns):
        offset = 0
        for n in sorted(set(pattern), reverse=True):
            each = pattern.count(n)
            start = used.get(n, 0)
            out.append((n, start, start + each * times, each, sequence, offset))
            used[n] = start + each * times
            offset += each * n
        sequence += times
    return out


def pack(pieces: DataFrame, capacity: int = CAPACITY, length_col: str = "length", order: tuple[str, ...] = ("doc_id", "piece"), nodes: int = NODES) -> DataFrame:
    """``pieces`` with (sequence_id, offset): sequences of at most ``capacity``, gapless from 0.

    Every row is one item, repeated rows included; lengths must lie in 1 to ``capacity``.
    Rows with equal values in ``order`` are numbered in any order, which gives the same
    packing. An empty table gives no rows.
    """
    spark = pieces.sparkSession
    pieces = materialize(pieces, "packing-pieces")       # numbered twice: both must see the same rows
    groups = max(8, pieces.count() // GROUP_ROWS)
    grouped = pieces.withColumn("_group", F.pmod(F.xxhash64(*order), F.lit(groups)))
    sizes = materialize(grouped.groupBy(length_col, "_group").count(), "packing-counts")
    counts = {r[0]: r[1] for r in sizes.groupBy(length_col).agg(F.sum("count")).collect()}      # at most ``capacity`` rows
    if counts and not 1 <= min(counts) <= max(counts) <= capacity:
        raise ValueError(f"lengths must lie in 1 to {capacity}")
    found = slots(bin_completion(counts, capacity, nodes)) if counts else []
    # An Arrow table: rows of Python would start a second set of Python workers on every executor.
    plan = spark.createDataFrame(pa.table({c: pa.array([x[i] for x in found], pa.int64()) for i, c in enumerate((length_col, "_from", "_to", "_each", "_sequence", "_at"))}))
    before = sizes.withColumn("_before", F.sum("count").over(Window.partitionBy(length_col).orderBy("_group")) - F.col("count")).drop("count")
    number = F.row_number().over(Window.partitionBy(length_col, "_group").orderBy(*order)) - 1
    ranked = (grouped.withColumn("_n", number).join(before, [length_col, "_group"])
              .withColumn("_n", F.col("_n") + F.col("_before")).drop("_before", "_group"))
    # The plan has a few rows for each length, so its size is bounded by the capacity.
    return (ranked.join(F.broadcast(plan), length_col).where("_n >= _from and _n < _to")
            .withColumn("sequence_id", F.expr("_sequence + (_n - _from) div _each"))
            .withColumn("offset", F.expr(f"_at + ((_n - _from) % _each) * `{length_col}`"))
            .drop("_n", "_from", "_to", "_each", "_sequence", "_at"))


def pack_documents(docs: DataFrame, path: str | None = None, run_bytes: int | None = None, kept_words: int | None = None) -> DataFrame:
    """Documents to packed pieces: (length, doc_id, piece, start, ids_crc32, sequence_id, offset).

    Null and empty texts are one end token; rows that repeat, and rows without an id, are
    packed like any other; other columns are not read; an empty table gives no rows.
    """
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("byte_bpe_50k.json")
    return pack(token_pieces(docs, tokenizer_json(path), run_bytes=run_bytes, kept_words=kept_words))


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents in sequences of at most 1024 tokens."""
    return pack_documents(table(spark, sf_dir, "documents")).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")
