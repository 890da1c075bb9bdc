"""Alignment of two tokenizers over a corpus: where their tokens end together, and which tokens share text.

A text's tokens by the first tokenizer (A) and by the second (B) cover the same bytes. Wherever
a token of each ends at the same byte, the text falls into groups; every A token of a group is
linked with every B token of it. How many documents link a pair of ids is counted over the corpus.

The work on a run of texts is done on Arrow arrays. Lists of token ids are flattened, with the
parent index of each token for its document; running sums of the tokens' byte lengths, less
what stood before the document, are their ends; an Acero hash join on (document, end) finds the
common ends. A task keeps a dictionary of its pairs with the number of documents of each, by
``Table.group_by``, and each document's links as codes into it. Spark adds up the
dictionaries' counts and joins the totals back to the dictionaries, so pairs are shuffled once per dictionary, never
once per document, and every document's sums are taken where its codes meet its dictionary.

Both tokenizers work word by word, so each distinct word of a run is encoded once.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunset_engine.llm.common import lean, lean_memory, table, tokenizer_json
from sunset_engine.llm.word_ids import flat, in_chunks, load_tokenizer, packed, unpacked
from sunset_engine.operators.joins import materialize

# Bytes of text aligned at once; a longer text is cut between words.
SLICE_BYTES = 1 << 20
# A dictionary is closed when it has so many pairs, or has served so many links.
CHUNK_PAIRS, CHUNK_LINKS = 1 << 18, 1 << 23
# Pairs made at once; groups of more links than LARGE_GROUP are reduced to distinct ids first.
PAIRS_AT_ONCE, LARGE_GROUP = 1 << 20, 256
# Words kept with their ids by a task, of at most so many bytes each.
CACHE_WORDS, CACHED_BYTES = 400_000, 48
ENCODE_AT_ONCE = 1_000
BLOCK = "▁"
SPACES = "\\s\\x{1c}-\\x{1f}\\x{85}\\x{a0}\\x{1680}\\x{180e}\\x{2000}-\\x{200f}\\x{2028}-\\x{202f}\\x{205f}\\x{3000}\\x{feff}"

# A space between words: both tokenizers begin a token with it, whatever stands around.
CUT = re.compile(rf"(?<=[^ {BLOCK}]) (?=[^\W_]|[!-~])")
# White space beside white space, at the beginning or at the end: such texts are cut by CUT alone.
NOT_PLAIN = f"(^|[ \\n])([{SPACES}]|$)"
ONE_WORD = f"^[ \\n][^{SPACES}{BLOCK}]+$"
MARKS_AT_END = r"^(?P<stem>(?s:.*)[\p{L}\p{N}])(?P<marks>[!-/:-@\[-`{-~]+)$"
LETTER_AND_MARK = re.compile(r"[^\W_][!-/:-@\[-`{-~]")


# ---- the two tokenizers -------------------------------------------------------------------------

def byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable Latin-1 characters stand for themselves, the other bytes for 256 and on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(c): b for c, b in [*zip(own, own, strict=True), *((256 + i, b) for i, b in enumerate(rest))]}


class Tokenizers:
    """Ids of words by both tokenizers, and the bytes that each id stands for."""

    def __init__(self, a: str, b: bytes):
        import sentencepiece

        self.a = load_tokenizer(a)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b)
        chars = byte_of_char()
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        a_bytes = [bytes(chars[c] for c in n) if all(c in chars for c in n) else n.encode() for n in names]
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(BLOCK, " ").encode() for i, p in enumerate(pieces)]
        self.bytes = [pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())]
        self.size = [pc.binary_length(x) for x in self.bytes]
        self.shown = pa.concat_arrays([_shown(len(a_bytes), (",", "|")), _shown(len(b_bytes), (",", ";", ""))])
        # No piece joins a letter or digit with an ASCII mark behind it; the first tokenizer never does.
        self.marks_apart = not any(LETTER_AND_MARK.search(p) for i, p in enumerate(pieces) if not (self.b.is_byte(i) or self.b.is_control(i) or self.b.is_unknown(i)))
        self.words = pa.array([], pa.string())
        self.lists = [pa.array([], pa.list_(pa.int32()))] * 2
        self.good = pa.array([], pa.bool_())

    def _joined(self, words: pa.Array) -> list[pa.Array] | None:
        """Ids of words that begin with a space or line feed and hold no other: a block is one text, cut where its words end."""
        ends = np.cumsum(pc.binary_length(words).to_numpy(), dtype=np.int64)
        text = "".join(words.to_pylist())
        both = [self.a.encode_batch_fast([text], add_special_tokens=False)[0].ids, self.b.encode(f"a{text}")[1:]]
        lists = []
        for ids, size in zip(both, self.size, strict=True):
            ids = np.array(ids, np.int32)
            through = np.cumsum(size.take(pa.array(ids)).to_numpy(), dtype=np.int64)
            cut = np.searchsorted(through, ends)
            if not len(through) or through[-1] != ends[-1] or (through[cut] != ends).any():
                return None                    # a word's bytes are not given back
            lists.append(pa.ListArray.from_arrays(pa.array(np.append(0, cut + 1), pa.int32()), pa.array(ids)))
        return lists

    def _single(self, words: pa.Array) -> list[pa.Array]:
        """Ids of any words. The second tokenizer puts a space before a text by itself."""
        texts = words.to_pylist()
        a = [e.ids for e in self.a.encode_batch_fast(texts, add_special_tokens=False)]
        b = self.b.encode([w[1:] if w[:1] == " " else w for w in texts], num_threads=1)
        return [pa.array(a, pa.list_(pa.int32())), pa.array([ids if w[:1] == " " else ids[1:] for w, ids in zip(texts, b, strict=True)], pa.list_(pa.int32()))]

    def encode(self, words: pa.Array) -> tuple[list[pa.Array], pa.Array]:
        """Id lists by both tokenizers, and whether both give back the words' bytes."""
        plain = pc.match_substring_regex(words, ONE_WORD).to_numpy(zero_copy_only=False)
        parts = [[pa.array([], pa.list_(pa.int32()))] for _ in range(2)]
        for mask in (plain, ~plain):
            some = words.filter(pa.array(mask))
            for at in range(0, len(some), ENCODE_AT_ONCE):
                block = some.slice(at, ENCODE_AT_ONCE)
                for out, lists in zip(parts, (mask is plain and self._joined(block)) or self._single(block), strict=True):
                    out.append(lists)
        order = pa.array(np.argsort(np.argsort(~plain, kind="stable"), kind="stable"))
        lists, good = [pa.concat_arrays(x).take(order) for x in parts], np.ones(len(words), bool)
        for ids, known in zip(lists, self.bytes, strict=True):
            values, ends = flat(ids)
            joined = known.take(pa.array(values))
            good &= _same(joined, np.append(0, np.cumsum(pc.binary_length(joined).to_numpy(), dtype=np.int64))[ends], words)
        return lists, pa.array(good)

    def _kept(self, words: pa.Array) -> tuple[list[pa.Array], pa.Array]:
        """``encode`` of distinct words, of which some are kept for the runs that follow."""
        at = pc.fill_null(pc.index_in(words, value_set=self.words), -1).to_numpy(zero_copy_only=False).copy()
        new = words.filter(pa.array(at < 0))
        lists, good = self.encode(new)
        at[at < 0] = len(self.words) + np.arange(len(new))
        out = [pa.concat_arrays([old, more]).take(pa.array(at)) for old, more in zip(self.lists, lists, strict=True)]
        fine = pa.concat_arrays([self.good, good]).take(pa.array(at))
        if (room := CACHE_WORDS - len(self.words)) > 0:
            short = pa.array(np.flatnonzero(pc.binary_length(new).to_numpy() <= CACHED_BYTES)[:room])
            self.words = pa.concat_arrays([self.words, new.take(short)])
            self.lists = [pa.concat_arrays([old, more.take(short)]) for old, more in zip(self.lists, lists, strict=True)]
            self.good = pa.concat_arrays([self.good, good.take(short)])
        return out, fine

    def __call__(self, words: pa.Array) -> tuple[list[pa.Array], np.ndarray]:
        """Id lists of distinct words; marks behind a word are encoded apart, behind a line feed, so that there are fewer words."""
        if not self.marks_apart:
            lists, fine = self._kept(words)
            return lists, fine.to_numpy(zero_copy_only=False)
        found = pc.extract_regex(words, MARKS_AT_END)
        stems = pc.coalesce(pc.struct_field(found, "stem"), words)
        marks = pc.binary_join_element_wise("\n", pc.coalesce(pc.struct_field(found, "marks"), pa.scalar("")), "")
        parts = pa.concat_arrays([stems, marks]).dictionary_encode()
        lists, fine = self._kept(parts.dictionary)
        fine = fine.to_numpy(zero_copy_only=False)[parts.indices.to_numpy()]
        n = len(words)
        first, behind = parts.indices.slice(0, n), parts.indices.slice(n)
        return [_concatenated(flat(x.take(first)), flat(pc.list_slice(x, 1).take(behind))) for x in lists], fine[:n] & fine[n:]


def _concatenated(*parts: tuple[np.ndarray, np.ndarray]) -> pa.Array:
    """Lists one behind the other, given as (values, offsets)."""
    sizes = [np.diff(offsets) for _, offsets in parts]
    ends = np.append(0, np.cumsum(sum(sizes), dtype=np.int64))
    out = np.empty(ends[-1], np.int32)
    begins = ends[:-1]
    for (values, offsets), n in zip(parts, sizes, strict=True):
        out[np.repeat(begins - offsets[:-1], n) + np.arange(len(values))] = values
        begins = begins + n
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(out))


def _shown(n: int, ends: tuple[str, ...]) -> pa.Array:
    """Ids in decimal with each of ``ends`` behind them, one block of ``n`` after another."""
    return pa.array([f"{i}{e}" for e in ends for i in range(n)], pa.large_string())


def _same(joined: pa.Array, places: np.ndarray, words: pa.Array) -> np.ndarray:
    """Whether the bytes of ``joined`` between ``places`` are those of each word."""
    wide = words.cast(pa.large_binary())
    offsets = np.frombuffer(wide.buffers()[1], np.int64)[wide.offset:wide.offset + len(wide) + 1]
    same = np.diff(offsets) == np.diff(places)
    have = np.frombuffer(joined.buffers()[2] or b"", np.uint8)
    want = np.frombuffer(wide.buffers()[2] or b"", np.uint8)[offsets[0]:offsets[-1]] if len(wide) else have[:0]
    if same.all() and np.array_equal(have[:places[-1]], want):
        return same
    for i in np.flatnonzero(same):
        same[i] = np.array_equal(have[places[i]:places[i + 1]], want[offsets[i] - offsets[0]:offsets[i + 1] - offsets[0]])
    return same


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(distinct words, code of each word, words of each text); the words of a text together are a space and the text."""
    odd = pc.match_substring_regex(texts, NOT_PLAIN).to_numpy(zero_copy_only=False)
    plain = texts.filter(pa.array(~odd))
    split = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
    coded = pc.list_flatten(split).cast(pa.string()).dictionary_encode()
    names = pc.if_else(pc.starts_with(coded.dictionary, "\n"), coded.dictionary, pc.binary_join_element_wise("", coded.dictionary, " "))
    sizes = np.zeros(len(texts), np.int64)
    sizes[~odd] = pc.list_value_length(split).to_numpy()
    codes = coded.indices.to_numpy()
    if odd.any():
        more = []
        for i in np.flatnonzero(odd):
            text = " " + texts[i].as_py()
            cuts = [0, *(m.start() for m in CUT.finditer(text))]
            more += [text[a:b] for a, b in zip(cuts, [*cuts[1:], len(text)], strict=True)]
            sizes[i] = len(cuts)
        both = pa.concat_arrays([names, pa.array(more, pa.string())]).dictionary_encode()
        renamed = both.indices.to_numpy()
        rows = np.repeat(np.arange(len(texts)), sizes)
        order = np.argsort(np.concatenate([np.flatnonzero(~odd[rows]), np.flatnonzero(odd[rows])]), kind="stable")
        codes, names = np.concatenate([renamed[:len(names)][codes], renamed[len(names):]])[order], both.dictionary
    return names, codes, sizes


# ---- a run of texts -----------------------------------------------------------------------------

@dataclass
class Run:
    """Figures of each text, its groups written out, and its distinct pairs: ``pairs`` holds (document, pair, times)."""

    good: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    groups: list[bytes]
    pairs: pa.Table


def _distinct(tables: list[pa.Table]) -> pa.Table:
    """(document, pair, times) of links, each pair of a document once."""
    made = pa.concat_tables(tables).group_by(["doc", "pair"], use_threads=False).aggregate([("times", "sum")])
    return made.select(["doc", "pair", "times_sum"]).rename_columns(["doc", "pair", "times"])


def _fewer(group: np.ndarray, ids: np.ndarray, large: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, id, times) of tokens; in large groups each id once."""
    some = large[group]
    if not some.any():
        return group, ids, np.ones(len(ids), np.int64)
    t = pa.table({"g": group[some], "i": ids[some]}).group_by(["g", "i"], use_threads=False).aggregate([([], "count_all")])
    g = np.concatenate([group[~some], t["g"].to_numpy()])
    order = np.argsort(g, kind="stable")
    times = np.concatenate([np.ones(int((~some).sum()), np.int64), t["count_all"].to_numpy()])
    return g[order], np.concatenate([ids[~some], t["i"].to_numpy()])[order], times[order]


def _linked(group: list[np.ndarray], ids: list[np.ndarray], counts: list[np.ndarray], doc: np.ndarray, width: int) -> pa.Table:
    """The distinct pairs of each document's groups; ``doc`` is each group's document."""
    large = counts[0] * counts[1] > LARGE_GROUP
    (ga, a, ta), (gb, b, tb) = (_fewer(g, i, large) for g, i in zip(group, ids, strict=True))
    per = np.bincount(gb, minlength=len(doc))
    first = np.append(0, np.cumsum(per))
    ends = np.append(0, np.cumsum(per[ga]))
    out = []
    at = 0
    while at < len(ga):
        to = max(at + 1, int(np.searchsorted(ends, ends[at] + PAIRS_AT_ONCE, "right")) - 1)
        left = np.repeat(np.arange(at, to), per[ga[at:to]])
        right = np.arange(ends[at], ends[to]) - ends[left] + first[ga[left]]
        pair = a[left].astype(np.int64) * width + b[right]
        out.append(_distinct([pa.table({"doc": doc[ga[left]].astype(np.int64), "pair": pair, "times": ta[left] * tb[right]})]))
        at = to
    if len(out) == 1:
        return out[0]
    return _distinct(out or [pa.table({"doc": pa.array([], pa.int64()), "pair": pa.array([], pa.int64()), "times": pa.array([], pa.int64())})])


def align(texts: pa.Array, tokenizers: Tokenizers) -> Run:
    """Texts of bounded size in all; empty ones, and those whose tokens don't give their bytes back, have no tokens."""
    n = len(texts)
    names, codes, sizes = words_of(texts)
    lists, fine = tokenizers(names)
    parent = np.repeat(np.arange(n), sizes)
    good = (pc.binary_length(texts).to_numpy() > 0) & (np.bincount(parent, ~fine[codes], n) == 0)
    kept = good[parent]
    words, parent = pa.array(codes[kept]), pa.array(parent[kept])
    before = np.zeros(n + 1, np.int64)                       # bytes before each document
    np.cumsum(np.bincount(parent.to_numpy(), pc.binary_length(names).to_numpy()[words.to_numpy()], n).astype(np.int64), out=before[1:])
    ids, docs, ends = [], [], []
    for lists_, size in zip(lists, tokenizers.size, strict=True):
        taken = lists_.take(words)
        ids.append(pc.list_flatten(taken))
        docs.append(parent.take(pc.list_parent_indices(taken)))
        ends.append(pc.subtract(pc.cumulative_sum(size.take(ids[-1]).cast(pa.int64())), pa.array(before).take(docs[-1])))
    sides = [pa.table({"doc": d, "end": e, name: pa.array(np.arange(len(d)))}) for d, e, name in zip(docs, ends, ("i", "j"), strict=True)]
    common = sides[0].join(sides[1], ["doc", "end"], join_type="inner", use_threads=False)
    ids, docs = [x.to_numpy() for x in ids], [x.to_numpy() for x in docs]
    group, last = [], []
    for side, at in zip(docs, (common["i"], common["j"]), strict=True):
        closes = np.zeros(len(side), bool)
        closes[at.to_numpy()] = True
        last.append(closes)
        group.append(np.cumsum(closes) - closes)
    doc = docs[0][last[0]]
    counts = [np.bincount(g, minlength=len(doc)) for g in group]
    links = np.append(0, np.cumsum(counts[0] * counts[1]))
    n_groups = np.bincount(doc, minlength=n)
    through = np.append(0, np.cumsum(n_groups))
    return Run(good, *(np.bincount(d, minlength=n) for d in docs), n_groups, links[through[1:]] - links[through[:-1]],
               _written(ids, group, last, counts, doc, n, tokenizers), _linked(group, ids, counts, doc, len(tokenizers.size[1])))


def _written(ids: list[np.ndarray], group: list[np.ndarray], last: list[np.ndarray], counts: list[np.ndarray], doc: np.ndarray, n: int, tokenizers: Tokenizers) -> list[bytes]:
    """Each document's groups as ``a1,a2|b1;a3|b2,b3``."""
    a_size = len(tokenizers.size[0])
    final = np.zeros(len(doc), bool)
    final[:-1] = doc[1:] != doc[:-1]
    final[-1:] = True
    a_end, b_end = last[0].astype(np.int64), np.where(last[1], np.where(final[group[1]], 2, 1), 0)
    a_before, b_before = (np.append(0, np.cumsum(c)) for c in counts)
    out = np.empty(len(ids[0]) + len(ids[1]), np.int64)
    out[np.arange(len(ids[0])) + b_before[group[0]]] = ids[0] + a_end * a_size
    out[np.arange(len(ids[1])) + a_before[group[1] + 1]] = 2 * a_size + ids[1] + b_end * len(tokenizers.size[1])
    text = tokenizers.shown.take(pa.array(out))
    per = np.bincount(doc, counts[0] + counts[1], n).astype(np.int64)
    if not len(out):
        return [b""] * n
    places = np.frombuffer(text.buffers()[1], np.int64)[np.append(0, np.cumsum(per))]
    raw = memoryview(text.buffers()[2])
    return [bytes(raw[x:y]) for x, y in zip(places[:-1].tolist(), places[1:].tolist(), strict=True)]


# ---- documents to dictionaries of pairs and links as codes --------------------------------------

SLICES = ("chunk long, doc_ids array<long>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, groups array<string>, "
          "n_pairs array<int>, codes binary, times binary, size long, pairs array<long>, docs array<long>")
SLICE_SCHEMA = pa.schema([("chunk", pa.int64()), *((c, pa.list_(pa.int64())) for c in ("doc_ids", "n_a", "n_b", "n_groups", "n_links")), ("groups", pa.list_(pa.string())),
                          ("n_pairs", pa.list_(pa.int32())), ("codes", pa.binary()), ("times", pa.binary()), ("size", pa.int64()), ("pairs", pa.list_(pa.int64())), ("docs", pa.list_(pa.int64()))])


class Dictionary:
    """The distinct pairs of a chunk of documents and how many documents have each."""

    def __init__(self, chunk: int):
        self.chunk, self.pairs, self.docs, self.links = chunk, pa.array([], pa.int64()), np.zeros(0, np.int64), 0

    def codes(self, pairs: pa.Table) -> np.ndarray:
        """``pairs`` has a row for each document and pair: their codes."""
        counted = pairs.group_by("pair", use_threads=False).aggregate([([], "count_all")])
        at = pc.fill_null(pc.index_in(counted["pair"].combine_chunks(), value_set=self.pairs), -1).to_numpy().copy()
        new = at < 0
        at[new] = len(self.pairs) + np.arange(int(new.sum()))
        self.pairs = pa.concat_arrays([self.pairs, counted["pair"].combine_chunks().filter(pa.array(new))])
        self.docs = np.append(self.docs, np.zeros(len(self.pairs) - len(self.docs), np.int64))
        self.docs[at] += counted["count_all"].to_numpy()
        self.links += pairs.num_rows
        return at[pc.index_in(pairs["pair"].combine_chunks(), value_set=counted["pair"].combine_chunks()).to_numpy()]

    def full(self) -> bool:
        return len(self.pairs) >= CHUNK_PAIRS or self.links >= CHUNK_LINKS

    def row(self) -> dict:
        return {"chunk": self.chunk, "pairs": self.pairs.to_numpy(), "docs": self.docs}


class Whole:
    """A text that came in parts: its figures so far."""

    def __init__(self, row: int):
        self.row, self.good, self.figures, self.groups, self.pairs = row, True, np.zeros(4, np.int64), [], []

    def add(self, run: Run) -> None:
        self.good &= bool(run.good[0])
        self.figures += np.array([run.n_a[0], run.n_b[0], run.n_groups[0], run.n_links[0]])
        self.groups.append(run.groups[0])
        self.pairs = [_distinct([*self.pairs, run.pairs])]

    def run(self) -> Run:
        some = self.good
        f = [np.array([x if some else 0]) for x in self.figures]
        return Run(np.array([some]), *f, [b";".join(self.groups) if some else b""], self.pairs[0] if some else self.pairs[0].slice(0, 0))


def _aligned(shared, digest: bool) -> Callable:
    def row_of(known: Dictionary, ids: list, run: Run) -> dict:
        code = known.codes(run.pairs)
        doc, times = run.pairs["doc"].to_numpy(), run.pairs["times"].to_numpy()
        order = np.lexsort((code, doc))
        per = np.bincount(doc, minlength=len(ids))
        code, times = code[order], times[order]
        steps = np.diff(code, prepend=0)
        first = np.append(0, np.cumsum(per))[:-1][per > 0]
        steps[first] = code[first]
        shown = [hashlib.sha256(g).hexdigest() if g and digest else g.decode() for g in run.groups]
        return {"chunk": known.chunk, "doc_ids": ids, "n_a": run.n_a, "n_b": run.n_b, "n_groups": run.n_groups, "n_links": run.n_links, "groups": shown,
                "n_pairs": per, "codes": packed(steps), "times": packed(times, "<i8"), "size": len(code)}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
        tokenizers = Tokenizers(*shared.value)
        number = TaskContext.get().partitionId() << 32
        known = Dictionary(number)
        for batch in batches:
            ids = batch.column("id")
            whole: Whole | None = None
            runs = in_chunks(batch.column("text"), CUT, SLICE_BYTES)
            while True:
                at, texts = next(runs, (None, None))
                if whole and (at is None or at[0] != whole.row):
                    yield row_of(known, ids.slice(whole.row, 1).to_pylist(), whole.run())
                    whole = None
                if at is None:
                    break
                if len(at) > 1:
                    yield row_of(known, ids.take(pa.array(at)).to_pylist(), align(texts, tokenizers))
                elif whole is None:
                    whole = Whole(int(at[0]))
                    whole.add(align(texts, tokenizers))
                else:                          # the space before this part is not in it
                    whole.add(align(pc.utf8_slice_codeunits(texts, 1), tokenizers))
                if known.full() and not whole:
                    yield known.row()
                    known = Dictionary(known.chunk + 1)
        if known.links:
            yield known.row()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in rows(batches):
            yield pa.RecordBatch.from_arrays([pa.array([row.get(f.name)], f.type) for f in SLICE_SCHEMA], schema=SLICE_SCHEMA)
    return lean(run)


def _summed(slices: pa.Table, totals: pa.Table) -> pa.Table:
    """A chunk's documents with their links counted: n_best and count_sum."""
    lean_memory()
    code = totals["code"].to_numpy()
    n, best = np.zeros(len(code), np.int64), np.zeros(len(code), np.int64)
    n[code], best[code] = totals["n"].to_numpy(), totals["best"].to_numpy()
    out = []
    for r in slices.to_pylist():
        size, per = r["size"], np.array(r["n_pairs"], np.int64)
        steps, times = unpacked(r["codes"], size).astype(np.int64), unpacked(r["times"], size, "<i8")
        first = np.append(0, np.cumsum(per))
        run = np.append(0, np.cumsum(steps))
        at = run[1:] - np.repeat(run[first[:-1]], per)       # steps began anew with each document
        sums = [np.append(0, np.cumsum(times * x[at])) for x in (best, n)]
        out.append(pa.table([pa.array(r["doc_ids"], pa.int64()), *(pa.array(r[c], pa.int64()) for c in ("n_a", "n_b", "n_groups", "n_links")),
                             *(pa.array(s[first[1:]] - s[first[:-1]]) for s in sums), pa.array(r["groups"], pa.string())], names=list(RESULT)))
    return pa.concat_tables(out) if out else pa.table([pa.array([], pa.string() if c == "groups" else pa.int64()) for c in RESULT], names=list(RESULT))


RESULT = ("id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")


@dataclass
class Alignment:
    """A corpus aligned: rows of documents and rows of dictionaries, written in the shared folder."""

    stored: DataFrame
    width: int

    def _pairs(self) -> DataFrame:
        """(of, code, pair, docs) of all dictionaries; ``of`` is the chunk."""
        both = self.stored.where("pairs is not null").select(F.col("chunk").alias("of"), F.posexplode_outer(F.arrays_zip("pairs", "docs")).alias("code", "x"))
        return both.select("of", "code", F.col("x.pairs").alias("pair"), F.col("x.docs").alias("docs"))

    def pair_counts(self) -> DataFrame:
        """(pair, a, b, n, best): documents that link the ids, and whether no other b has more with this a."""
        summed = self._pairs().groupBy("pair").agg(F.sum("docs").alias("n"))
        ids = summed.select("pair", F.expr(f"cast(pair div {self.width} as int)").alias("a"), F.expr(f"cast(pair % {self.width} as int)").alias("b"), "n")
        # An a has as many rows as the second vocabulary has ids, at most.
        return ids.withColumn("best", (F.col("n") == F.max("n").over(Window.partitionBy("a"))).cast("int"))

    def documents(self, id_col: str = "doc_id") -> DataFrame:
        """One row per document: (id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
        totals = self._pairs().drop("docs").join(self.pair_counts().select("pair", "n", "best"), "pair").select("of", "code", "n", "best")
        slices = self.stored.where("pairs is null").drop("pairs", "docs")
        types = ", ".join(f"{c} {'string' if c == 'groups' else 'long'}" for c in RESULT)
        return slices.groupBy("chunk").cogroup(totals.groupBy("of")).applyInArrow(_summed, types).withColumnRenamed("id", id_col)


def aligned(docs: DataFrame, a: str, b: bytes, id_col: str = "doc_id", text_col: str = "text", digest: bool = False) -> Alignment:
    """Alignment of tokenizer ``a`` (the text of a byte-level BPE file) with ``b`` (the bytes of a sentencepiece model with byte fallback).

    A text is encoded by ``a`` behind a space, as ``b`` puts one there itself; special tokens' strings are
    ordinary text. ``groups`` of a document is ``a1,a2|b1;a3|b2,b3``: ids of both in decimal,
    group by group; with ``digest`` the SHA-256 of that in hex.

    Null and empty texts, and texts whose tokens don't give back a space and the text, have no tokens:
    zeros and empty groups. Rows that repeat are documents of their own, those without an id
    too. Other columns are not read, whatever their names. An empty table gives no rows. A text longer than
    ``SLICE_BYTES`` is aligned in parts cut between words, where tokens of both end, and counted as one document.
    """
    import sentencepiece

    width = sentencepiece.SentencePieceProcessor(model_proto=b).get_piece_size()
    shared = docs.sparkSession.sparkContext.broadcast((a, b))
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return Alignment(materialize(given.mapInArrow(_aligned(shared, digest), SLICES), "alignment"), width)


def op12_alignment(spark: SparkSession, sf_dir: str, a: str | None = None, b: str | None = None) -> DataFrame:
    """All documents by byte_bpe_50k and piece_bpe_32k."""
    if a is None or b is None:
        import public_tokenizers

        a, b = a or public_tokenizers.path("byte_bpe_50k.json"), b or public_tokenizers.path("piece_bpe_32k.model")
    with open(b, "rb") as f:
        model = f.read()
    made = aligned(table(spark, sf_dir, "documents"), tokenizer_json(a), model, digest=True).documents()
    return made.select("doc_id", *RESULT[1:-1], F.col("groups").alias("groups_sha256"))
