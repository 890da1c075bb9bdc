import random

import pytest

from sunset_engine.llm import bpe_table as B
from sunset_engine.llm import word_ids
from sunset_engine.llm.common import tokenizer_json

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(5)
    parts = ["a", "B", "É", "e\u0301", " ", "  ", "\n", "\t", "'s", "'LL", "'", "1", "23", ".", "!!", "<|endoftext|>", "<|startoftext|>x", "日本", "\x85", "\u2003", "\x1c", "\r\n", "word ", "WORDS ", "ß", "İ"]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 25))) for _ in range(400)] + [None, "", " \n ", "\u2003\x85", "many words " * 9000, "y" * 3000]


@pytest.mark.parametrize("chunk", [1 << 23, 50])
def test_encodes_and_decodes_like_the_library(spark, monkeypatch, chunk):
    from tokenizers import Tokenizer

    monkeypatch.setattr(B, "CHUNK_BYTES", chunk)
    t = Tokenizer.from_file(PATH)
    rows = [(i, x, "c", 1) for i, x in enumerate(texts())] + [(None, "again again", "c", 1), (0, "again again", "c", 1), (0, "again again", "c", 1)]
    rows = [r for r in rows if chunk > 50 or r[1] is None or len(r[1]) < 50 or "  " not in r[1]]
    df = spark.createDataFrame(rows, "doc_id long, text string, chunk string, ids int")
    tokenizer = tokenizer_json(PATH)
    ids = B.encode(df, tokenizer)
    got = sorted((str(r.doc_id), list(r.ids)) for r in ids.collect())
    expected = sorted((str(i), t.encode(x or "", add_special_tokens=False).ids) for i, x, *_ in rows)
    if chunk > 50:
        assert got == expected
        decoded = sorted((str(r.doc_id), r.decoded) for r in B.decode(ids, tokenizer).collect())
        assert decoded == sorted((str(i), t.decode(t.encode(x or "", add_special_tokens=False).ids, skip_special_tokens=False)) for i, x, *_ in rows)
    else:                                     # long texts come in parts
        joined = {}
        for d, x in got:
            joined[d] = joined.get(d, 0) + len(x)
        total = {}
        for d, x in expected:
            total[d] = total.get(d, 0) + len(x)
        assert joined == total


@pytest.mark.parametrize("chunk", [50, 400])
def test_texts_longer_than_a_chunk_are_one_row(spark, monkeypatch, chunk):
    from tokenizers import Tokenizer

    monkeypatch.setattr(B, "CHUNK_BYTES", chunk)
    t = Tokenizer.from_file(PATH)
    rng = random.Random(8)
    long = ["".join(rng.choice(["word", "Words'", "é", "日本", " ", "  ", "\n", "\t", "1", "!!"]) for _ in range(n)) for n in (40, 200, 900, 900)]
    rows = [(i, x) for i, x in enumerate(["short", long[0], None, long[1], "y" * 700, long[2], "", "z z", long[3], " " * 900])] + [(None, long[2]), (3, long[1]), (3, long[1])]
    tokenizer = tokenizer_json(PATH)
    ids = B.encode(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1), tokenizer)
    encoded = [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in rows]
    assert sorted((str(r.doc_id), list(r.ids)) for r in ids.collect()) == sorted((str(i), x) for i, x in encoded)
    assert sorted((str(r.doc_id), r.decoded) for r in B.decode(ids, tokenizer).collect()) == sorted((str(i), t.decode(x, skip_special_tokens=False)) for i, x in encoded)


def test_empty_table(spark):
    assert B.encode(spark.createDataFrame([], "doc_id long, text string"), tokenizer_json(PATH)).collect() == []


def test_packing_of_integers():
    import numpy as np

    x = np.array([0, 1, 255, 256, 70000, -3], np.int32)
    assert B.unpacked(B.packed(x), 6).tolist() == x.tolist() and B.unpacked(B.packed(x[:0]), 0).tolist() == []


def test_chunks_are_split_in_slices(monkeypatch):
    """No more than a slice is split at once; the rows are those of a chunk split whole."""
    from types import SimpleNamespace

    import pyarrow as pa

    rng = random.Random(6)
    texts = ["".join(rng.choice(["a ", "bb", "\u00e9 ", "word\n", " ", "z"]) for _ in range(rng.randint(0, 60))) for _ in range(400)] + [None, "", "one two", "q " * 90]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(texts)), pa.int64()), "text": pa.array(texts)})
    monkeypatch.setattr(B, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 1)))
    monkeypatch.setattr(B, "CHUNK_BYTES", 4000)
    split, most = B.pc.ascii_split_whitespace, []

    def counted(x):
        most.append(B.pc.sum(B.pc.binary_length(x)).as_py())
        return split(x)

    def rows(size):
        most.clear()
        monkeypatch.setattr(B, "SLICE_BYTES", size)
        return pa.Table.from_batches(list(B._split(3)(iter([batch])))).to_pylist()

    monkeypatch.setattr(B, "pc", SimpleNamespace(ascii_split_whitespace=counted, sum=B.pc.sum, binary_length=B.pc.binary_length))
    whole = rows(1 << 20)
    assert len(whole) > 8
    assert rows(500) == whole and max(most) <= 500


def test_groups_give_memory_back(monkeypatch):
    """Before and after each group, so that workers wait without what the last group used."""
    import pyarrow as pa

    calls = []
    monkeypatch.setattr(B, "lean_memory", lambda: calls.append(1))
    chunks = pa.table({c: pa.array([], pa.int64()) for c in ("chunk", "doc_ids", "words", "rows", "codes", "size")})
    words = pa.table({c: pa.array([], pa.int64()) for c in ("chunk", "places", "n", "lengths", "ids", "n_ids")})
    assert B._cogrouped(chunks, words).num_rows == 0 and len(calls) == 2


def test_decimal_ids_come_from_the_tasks(spark, tmp_path):
    """The ids' digest casts no ids to strings in the JVM, which made it hold most of its heap; its value is that of the ids themselves."""
    import hashlib

    from tokenizers import Tokenizer

    t = Tokenizer.from_file(PATH)
    rows = [(i, x) for i, x in enumerate(texts())] + [(None, "again again"), (0, "again again"), (0, "again again")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = B.op10_bpe_table(spark, str(tmp_path), PATH)
    assert "cast(ids" not in got._jdf.queryExecution().toString().lower()

    def digest(x):
        return hashlib.sha256(x.encode()).hexdigest()

    encoded = [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in rows]
    expected = [(str(i), len(x), digest(" ".join(map(str, x))), digest(t.decode(x, skip_special_tokens=False))) for i, x in encoded]
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()) == sorted(expected)
    spelled = B.decode(spark.createDataFrame([(1, [5, 0, 12]), (2, [])], "n int, ids array<int>"), tokenizer_json(PATH), numbers="as text")
    assert sorted((r.n, r["as text"]) for r in spelled.collect()) == [(1, "5 0 12"), (2, "")]


def test_codes_of_a_chunk_come_in_short_rows(spark, monkeypatch):
    """A chunk's codes were one row of megabytes; a text stays in one row, and each text is there once."""
    from types import SimpleNamespace

    import pyarrow as pa
    from tokenizers import Tokenizer

    monkeypatch.setattr(B, "ROW_WORDS", 20)
    monkeypatch.setattr(B, "TaskContext", SimpleNamespace(get=lambda: SimpleNamespace(partitionId=lambda: 1)))
    given = [x if x is None or len(x) < 3000 else x[:200] for x in texts()] + ["long " * 70, "", None, "a b"]
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(given)), pa.int64()), "text": pa.array(given)})
    rows = [r for r in pa.Table.from_batches(list(B._split(3)(iter([batch])))).to_pylist() if r["bucket"] is None]
    assert len(rows) > 20 and {r["chunk"] for r in rows} == {(1 << 32) + 1}
    assert [i for r in rows for i in r["doc_ids"]] == list(range(len(given))) == [i for r in rows for i in r["rows"]]
    assert all(r["size"] == sum(r["words"]) and sum(r["words"][:-1]) <= 20 for r in rows)

    t = Tokenizer.from_file(PATH)
    got = B.encode(spark.createDataFrame(enumerate(given), "doc_id long, text string").coalesce(1), tokenizer_json(PATH))
    assert sorted((r.doc_id, list(r.ids)) for r in got.collect()) == [(i, t.encode(x or "", add_special_tokens=False).ids) for i, x in enumerate(given)]
    assert B.encode(spark.createDataFrame([(1, " "), (2, None)], "doc_id long, text string").coalesce(1), tokenizer_json(PATH)).count() == 2
