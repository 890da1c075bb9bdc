import itertools
import random
import zlib

import numpy as np
import pytest

from sunset_engine.llm import packing as K
from sunset_engine.llm import word_ids
from sunset_engine.llm.common import tokenizer_json

public_tokenizers = pytest.importorskip("public_tokenizers")
PATH = public_tokenizers.path("byte_bpe_50k.json")


def check(patterns, counts, capacity):
    held = {}
    for pattern, times in patterns:
        assert sum(pattern) <= capacity and times > 0
        for n in pattern:
            held[n] = held.get(n, 0) + times
    assert held == counts
    return sum(t for _, t in patterns)


def counted(items):
    return {n: items.count(n) for n in set(items)}


def optimum(items, capacity):
    """Fewest bins by trying all placements."""
    best = len(items)
    items = sorted(items, reverse=True)

    def walk(i, bins):
        nonlocal best
        if len(bins) >= best:
            return
        if i == len(items):
            best = len(bins)
            return
        for b in {r: j for j, r in enumerate(bins)}.values():
            if bins[b] >= items[i]:
                walk(i + 1, [r - items[i] if j == b else r for j, r in enumerate(bins)])
        walk(i + 1, [*bins, capacity - items[i]])

    walk(0, [])
    return best


def test_small_instances_are_optimal():
    rng = random.Random(0)
    for _ in range(120):
        items = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        size = check(K.bin_completion(counted(items), 20), counted(items), 20)
        assert size == optimum(items, 20) >= K.lower_bound(counted(items), 20)


def test_bin_completion_beats_best_fit_where_it_can():
    rng = random.Random(1)
    counts = counted([rng.randint(200, 600) for _ in range(4000)])
    first = check(K.best_fit(counts, 1024), counts, 1024)
    assert K.lower_bound(counts, 1024) <= check(K.bin_completion(counts, 1024), counts, 1024) < first


def test_fillings_are_undominated():
    counts = {7: 1, 6: 2, 5: 1, 3: 3, 2: 1}
    for filling in K.fillings(counts, 12, 12):
        left = dict(counts)
        for n in filling:
            left[n] -= 1
        waste = 12 - sum(filling)
        assert waste >= 0 and all(c >= 0 for c in left.values())
        assert not any(c and n <= waste for n, c in left.items())
    assert list(K.fillings(counts, 7, 7)) == [(7,)]


def undominated(held, lost, counts):
    spare = [n for n in counts if held.count(n) < counts[n]]
    return not any(n <= lost for n in spare) and not any(x < n <= x + lost for x in held for n in spare)


def test_every_undominated_filling_comes_least_waste_first():
    rng = random.Random(4)
    for _ in range(60):
        counts = {n: rng.randint(1, 3) for n in rng.sample(range(2, 15), rng.randint(1, 6))}
        room, waste = rng.randint(1, 24), rng.randint(0, 5)
        lengths = sorted(counts, reverse=True)
        found = [f for f in K.fillings(counts, room, waste)]
        assert len(found) == len(set(found)) and [room - sum(f) for f in found] == sorted(room - sum(f) for f in found)
        if counts.get(room):
            assert found == [(room,)]
            continue
        every = {tuple(n for n, k in zip(lengths, ks) for _ in range(k)) for ks in itertools.product(*(range(counts[n] + 1) for n in lengths))}
        want = {f for f in every if 0 <= room - sum(f) <= waste and undominated(f, room - sum(f), counts)}
        assert set(found) == want


def test_the_search_ends_with_its_nodes_alone():
    """Many mid-size lengths: fillings are listed one by one, none is left out."""
    rng = random.Random(8)
    counts = {n: rng.randint(1, 4) for n in range(90, 700, 2)}
    size = check(K.bin_completion(counts, 1024), counts, 1024)
    assert K.lower_bound(counts, 1024) <= size <= check(K.best_fit(counts, 1024), counts, 1024)
    many = sum(1 for _ in itertools.islice(K.fillings(counts, 900, 0), 5000))
    assert many == 5000


def texts(seed):
    rng = random.Random(seed)
    parts = ["a", "B", "é", " ", "  ", "\n", "\n\n", " \n", "\t", "'s", "'", "1", "23", ".", ",", "!!", "<|endoftext|>", " ", "日本", "-", "_", "\x85", "\x1c", "\r\n", "ll", "'ll", "word "]
    return ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(1500)] + [None, "", " ", "\n", "tokens and more words. " * 3000, "x" * 6000]


@pytest.mark.parametrize("chunk", [1 << 23, 9])
def test_ids_are_the_library_s(monkeypatch, chunk):
    from tokenizers import Tokenizer
    import pyarrow as pa

    monkeypatch.setattr(word_ids, "CHUNK_BYTES", chunk)
    tokenizer = Tokenizer.from_file(PATH)
    rows = texts(3)

    class Shared:
        value = tokenizer_json(PATH)

    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(len(rows)), pa.int64()), "text": pa.array(rows)})
    got = {}
    for out in K._pieces(Shared, 64, 2)(iter([batch])):
        for r in out.to_pylist():
            got.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    for i, t in enumerate(rows):
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], "<u4")
        ends = list(itertools.accumulate(p[2] for p in sorted(got[i])))
        assert ends[-1] == len(ids) and all(p[2] == 64 for p in sorted(got[i])[1:]) and sorted(got[i])[0][2] <= 64
        for (_, start, length, crc), end in zip(sorted(got[i]), ends):
            assert start == end - length and crc == zlib.crc32(ids[start:end].tobytes())


def test_packing_is_gapless_and_whole(spark, monkeypatch):
    monkeypatch.setattr(K, "GROUP_ROWS", 50)
    rows = [(i, t, "z", 1) for i, t in enumerate(texts(4)[::5])] + [(0, "again", "z", 1), (0, "again", "z", 1), (None, "none", "z", 1)]
    rows += [(10_000 + i, "the same text", "z", 1) for i in range(700)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length string, sequence_id int")
    got = K.pack_documents(df, PATH).toPandas()
    pieces = K.token_pieces(df, tokenizer_json(PATH)).toPandas()
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(str, got[key].values.tolist())) == sorted(map(str, pieces[key].values.tolist()))
    for _, s in got.sort_values("offset").groupby("sequence_id"):
        assert s.offset.tolist() == [0, *np.cumsum(s.length)[:-1]] and s.length.sum() <= 1024
    assert got.sequence_id.nunique() == -(-got.length.sum() // 1024)             # many short pieces: no waste
    assert K.pack_documents(df.limit(0), PATH).collect() == []


def test_lengths_out_of_range_are_refused(spark):
    with pytest.raises(ValueError):
        K.pack(spark.createDataFrame([(1, 0, 1025)], "doc_id long, piece int, length long"))


def test_plan_needs_no_python_workers(spark):
    """Rows of Python would start a second set of Python workers on every executor."""
    packed = K.pack(spark.createDataFrame([(1, 0, 5), (2, 0, 7)], "doc_id long, piece int, length long"), 10)
    assert "ExistingRDD" not in packed._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.doc_id, r.length, r.offset) for r in packed.collect()) == [(1, 5, 0), (2, 7, 0)]
