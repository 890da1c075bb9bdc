"""BPE encoding and decoding by a table of distinct words.

White space always separates tokens of this tokenizer, so a text's ids are those of its
words one after another. Texts are split into words; a chunk of documents keeps its words
as codes into its own list of distinct words, most frequent first. Those lists are dealt
by word hash, each distinct word is encoded once, and the ids go back to the chunk, where
the codes put them in the words' places. Only distinct words and their ids are
shuffled, never one row per word; codes stay where they were written. Decoding joins ids with the vocabulary's pieces.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Iterable
from itertools import groupby, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.llm.common import lean, lean_memory, string_bytes, table, tokenizer_json, word_hashes
from sunset_engine.llm.word_ids import WordIds, flat, in_chunks, load_tokenizer, packed, unpacked
from sunset_engine.session import scratch_path

BLANK = re.compile(r"[ \t\n\r\x0b\x0c]")
# Words with this many documents' distinct words on average share a task.
ROWS_PER_BUCKET = 20_000
# Spark refuses tables of more than 100,000 buckets; beyond a billion documents buckets get larger instead.
MAX_BUCKETS = 50_000
# Documents in one output batch.
OUT_ROWS = 500
# Bytes of text that share a list of distinct words; a longer text has its own, and comes to it in parts of that size.
CHUNK_BYTES = 1 << 23
# Words whose codes share a row of a chunk: rows of some 300 KB, which the JVM frees as soon as it is done with them.
ROW_WORDS = 1 << 18
# Bytes of text that are split into words at once.
SLICE_BYTES = 1 << 20

CHUNKS = "chunk long, doc_ids array<long>, words array<int>, rows array<int>, codes binary, size long, bucket int, list binary, places binary, list_size long, n int"


def _coded(parts: Iterable[tuple[np.ndarray, pa.Array]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, pa.Array]:
    """A chunk's rows, the words of each, the words' codes, and the distinct words in the order of their codes.

    A text that comes in parts is one row.
    """
    per_row, words = np.zeros(1, np.int64), []
    for rows, texts in parts:
        here = np.zeros(len(rows), np.int64)
        for at, some in in_chunks(texts, BLANK, SLICE_BYTES):
            split = pc.ascii_split_whitespace(some)
            here[at] += np.diff(split.offsets.to_numpy())
            words.append(split.flatten().cast(pa.string()).dictionary_encode())
        per_row = per_row + here
    words = pa.chunked_array(words).unify_dictionaries()
    return rows, per_row, np.concatenate([part.indices.to_numpy() for part in words.chunks]), words.chunk(0).dictionary


def _split(buckets: int) -> Callable:
    """Documents to rows per chunk with its codes, whole documents in each, and one row per chunk and bucket with the words."""
    def rows_of(chunk: int, ids: list, per_row: np.ndarray, text_rows: np.ndarray, codes: np.ndarray, names: pa.Array):
        often = np.bincount(codes, minlength=len(names))
        data, offsets = string_bytes(names)
        hashed, first = word_hashes(data, offsets, np.zeros(256, bool))
        bucket = np.zeros(len(names), np.int64)
        some = np.diff(first) > 0
        bucket[some] = (hashed % np.uint64(buckets)).astype(np.int64)
        by = np.lexsort((bucket, -np.floor(np.log2(np.maximum(often, 1))).astype(np.int64)))
        place = np.empty(len(names), np.int32)
        place[by] = np.arange(len(names), dtype=np.int32)
        nothing = dict.fromkeys(("doc_ids", "words", "rows", "codes", "size", "bucket", "list", "places", "list_size", "n"))
        begin = np.append(0, np.cumsum(per_row))
        cuts = np.flatnonzero(np.diff(begin[:-1] // ROW_WORDS)) + 1
        for a, z in pairwise([0, *cuts.tolist(), len(per_row)]):
            some = place[codes[begin[a]:begin[z]]]
            yield nothing | {"chunk": chunk, "doc_ids": ids[a:z], "words": per_row[a:z].tolist(), "rows": text_rows[a:z].tolist(), "codes": packed(some), "size": len(some)}
        within = by[np.argsort(bucket[by], kind="stable")]
        ends = np.searchsorted(bucket[within], np.arange(buckets + 1))
        names = names.take(pa.array(within))
        for b in np.flatnonzero(np.diff(ends)):
            here = slice(ends[b], ends[b + 1])
            blob = " ".join(names.slice(ends[b], ends[b + 1] - ends[b]).to_pylist()).encode()
            yield nothing | {"chunk": chunk, "bucket": int(b), "list": pa.compress(blob, "zstd", asbytes=True), "list_size": len(blob),
                             "places": packed(np.diff(place[within[here]], prepend=0)), "n": int(ends[b + 1] - ends[b])}

    schema = pa.schema([("chunk", pa.int64()), ("doc_ids", pa.list_(pa.int64())), ("words", pa.list_(pa.int32())), ("rows", pa.list_(pa.int32())), ("codes", pa.binary()), ("size", pa.int64()),
                        ("bucket", pa.int32()), ("list", pa.binary()), ("places", pa.binary()), ("list_size", pa.int64()), ("n", pa.int32())])

    def made(chunk: int, ids: pa.Array, rows: np.ndarray, per_row: np.ndarray, codes: np.ndarray, names: pa.Array) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(list(rows_of(chunk, ids.take(pa.array(rows)).to_pylist(), per_row, rows, codes, names)), schema)

    def run(batches):
        chunk = TaskContext.get().partitionId() << 32       # a task that runs again gives the same numbers
        for batch in batches:
            ids = batch.column("doc_id")
            for _, parts in groupby(in_chunks(batch.column("text"), BLANK, CHUNK_BYTES), key=lambda run: int(run[0][0])):
                chunk += 1
                yield made(chunk, ids, *_coded(parts))
    return lean(run)


def _encoded(shared) -> Callable:
    """A bucket's word lists of all chunks: each distinct word is encoded once."""
    held: dict[str, WordIds] = {}             # one tokenizer for all groups of a task

    def run(group: pa.Table) -> pa.Table:
        lean_memory()
        done = encoded(group)
        lean_memory()                         # workers wait for their next task without what this one used
        return done

    def encoded(group: pa.Table) -> pa.Table:
        if not held:
            held["encoder"] = WordIds(load_tokenizer(shared.value))
        lists = [pa.array(pa.decompress(b, s, "zstd", asbytes=True).decode().split(" "), pa.string()) for b, s in zip(group.column("list").to_pylist(), group.column("list_size").to_pylist(), strict=True)]
        coded = pa.concat_arrays(lists).dictionary_encode()
        ids = held["encoder"].encode(coded.dictionary)
        ends = np.cumsum([0, *map(len, lists)])
        out = []
        for a, b in zip(ends[:-1], ends[1:], strict=True):
            values, offsets = flat(ids.take(coded.indices.slice(a, b - a)))
            out.append((packed(np.diff(offsets)), packed(values), len(values)))
        return pa.table({"chunk": group.column("chunk"), "places": group.column("places"), "n": group.column("n"),
                         "lengths": pa.array([x[0] for x in out], pa.binary()), "ids": pa.array([x[1] for x in out], pa.binary()), "n_ids": pa.array([x[2] for x in out], pa.int64())})
    return run


def _joined(chunks: pa.Table, words: pa.Table):
    """A chunk's ids in the places of its words, one row of codes at a time: one row of ids for each document."""
    lengths, ids, places = [], [], []
    for r in words.to_pylist():
        places.append(np.cumsum(unpacked(r["places"], r["n"])))
        lengths.append(unpacked(r["lengths"], r["n"]))
        ids.append(unpacked(r["ids"], r["n_ids"]))
    empty = np.zeros(0, np.int32)
    length = np.concatenate(lengths or [empty])
    lists = pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum(length)), pa.int32()), pa.array(np.concatenate(ids or [empty])))
    lists = lists.take(pa.array(np.argsort(np.concatenate(places or [empty]), kind="stable")))
    for r in chunks.to_pylist():
        codes = unpacked(r["codes"], r["size"])
        ends = np.append(0, np.cumsum(r["words"]))
        rows = r["rows"]
        at = 0
        while at < len(rows):
            to = min(len(rows), at + OUT_ROWS)
            values, offsets = flat(lists.take(pa.array(codes[ends[at]:ends[to]])))
            cut = offsets[ends[at:to + 1] - ends[at]]
            yield pa.RecordBatch.from_arrays([pa.array([r["chunk"]] * (to - at), pa.int64()), pa.array(rows[at:to], pa.int32()), pa.array(r["doc_ids"][at:to], pa.int64()),
                                              pa.ListArray.from_arrays(pa.array(cut, pa.int32()), pa.array(values))], names=["chunk", "row", "doc_id", "ids"])
            at = to


def _cogrouped(chunks: pa.Table, words: pa.Table) -> pa.Table:
    lean_memory()
    schema = pa.schema([("chunk", pa.int64()), ("row", pa.int32()), ("doc_id", pa.int64()), ("ids", pa.list_(pa.int32()))])
    done = pa.Table.from_batches(list(_joined(chunks, words)), schema)
    lean_memory()
    return done


def _stored(split: DataFrame, buckets: int) -> DataFrame:
    """``split`` written bucketed by chunk, so that the codes are joined where they lie and never shuffled."""
    spark = split.sparkSession
    name = f"bpe_chunks_{uuid.uuid4().hex}"
    split.write.format("parquet").bucketBy(buckets, "chunk").option("path", scratch_path(spark, name)).saveAsTable(name)
    return spark.table(name)


def encode(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, ids array<int>) per row of ``docs``: what the tokenizers library encodes, no special tokens added.

    ``tokenizer`` holds the text of a tokenizer file whose tokens never span white space.
    Null, empty and blank texts have no ids; rows that repeat, and rows without an id, each
    get their row; other columns are not read; an empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    buckets = min(MAX_BUCKETS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), docs.count() // ROWS_PER_BUCKET))
    shared = spark.sparkContext.broadcast(tokenizer)
    split = _stored(docs.mapInArrow(_split(buckets), CHUNKS), buckets)
    words = (split.where("bucket is not null").select("chunk", "bucket", "list", "list_size", "places", "n").groupBy("bucket")
             .applyInArrow(_encoded(shared), "chunk long, places binary, n int, lengths binary, ids binary, n_ids long"))
    chunks = split.where("bucket is null").select("chunk", "doc_ids", "words", "rows", "codes", "size")
    return (chunks.groupBy("chunk").cogroup(words.groupBy("chunk")).applyInArrow(_cogrouped, "chunk long, row int, doc_id long, ids array<int>")
            .select("doc_id", "ids"))


def pieces(tokenizer: str) -> list[str | None]:
    t = load_tokenizer(tokenizer)
    return [t.id_to_token(i) for i in range(t.get_vocab_size(with_added_tokens=True))]


def _decoded(shared, col: str, numbers: str | None = None) -> Callable:
    def run(batches):
        tables = {"decoded": pa.array(shared.value, pa.string())}
        if numbers is not None:
            tables[numbers] = pa.array(range(len(shared.value)), pa.int32()).cast(pa.string())
        for batch in batches:
            for at in range(0, batch.num_rows, OUT_ROWS):
                part = batch.slice(at, OUT_ROWS)
                values, offsets = flat(part.column(col))
                values, offsets = pa.array(values), pa.array(offsets, pa.int32())
                names = [n for n in part.schema.names if n != col]
                spelled = [pc.binary_join(pa.ListArray.from_arrays(offsets, table.take(values)), " ") for table in tables.values()]
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), *spelled], names=[*names, *tables])
    return lean(run)


def decode(ids: DataFrame, tokenizer: str, col: str = "ids", numbers: str | None = None) -> DataFrame:
    """Ids to text: each id is looked up in the id-to-piece table (as large as the vocabulary) and the pieces
    are joined by a space, as a tokenizer without a decoder does. ``col`` is replaced by ``decoded``, and by
    the decimal ids joined by a space if ``numbers`` names a column for them: one Arrow string a row, where a
    cast of the ids to strings makes several Java objects for each."""
    shared = ids.sparkSession.sparkContext.broadcast(pieces(tokenizer))
    rest = [f"`{f.name}` {f.dataType.simpleString()}" for f in ids.schema if f.name != col]
    made = ["decoded string"] + ([f"`{numbers}` string"] if numbers is not None else [])
    return ids.mapInArrow(_decoded(shared, col, numbers), ", ".join(rest + made))


def op10_bpe_table(spark: SparkSession, sf_dir: str, path: str | None = None) -> DataFrame:
    """Every document: number of ids, digest of the ids and of the text they decode to."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    tokenizer = tokenizer_json(path)
    ids = encode(table(spark, sf_dir, "documents"), tokenizer)
    spelled = decode(ids.select("doc_id", F.size("ids").cast("long").alias("n_tokens"), "ids"), tokenizer, numbers="numbers")
    return spelled.select("doc_id", "n_tokens", F.sha2("numbers", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
