import random

import pytest

from sunset_engine.llm import ngram_join as J

SCHEMA = "doc_id long, text string, cls string, n string, token int, hub int"


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = (t or "").lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            same = rows[i][0] is not None and rows[i][0] == rows[j][0] and sets[i] and sets[j]
            if same or sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(d, least.get(find(i), d))
    return sorted((str(d), len(sets[i]), str(least.get(find(i)))) for i, (d, _) in enumerate(rows))


def corpus(seed):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(60)]
    rows = []
    for base in range(12):
        text = [rng.choice(words) for _ in range(rng.choice([3, 6, 30, 80, 200]))]
        for _ in range(rng.choice([1, 3, 12])):
            t = list(text)
            for _ in range(rng.randrange(0, 1 + len(t) // 12)):
                t[rng.randrange(len(t))] = rng.choice(words)
            rows.append(" ".join(t))
    passage = " ".join(rng.choice(words) for _ in range(12))
    rows += [passage + " " + " ".join(rng.choice(words) for _ in range(n)) for n in (0, 0, 1, 2, 40)]
    rows += [None, "", " \n\t ", "W1 w2", "w1   W2", "w1", "x" * 5000, ("w1 w2 w3 " * 4000).strip()]
    ids = list(range(len(rows)))
    rng.shuffle(ids)
    return list(zip(ids, rows)) + [(None, rows[0]), (None, "only here once more"), (ids[3], rows[3])]


@pytest.mark.parametrize("k,percent,block", [(4, 85, 2048), (2, 60, 4)])
def test_matches_brute_force(spark, monkeypatch, k, percent, block):
    monkeypatch.setattr(J, "BLOCK_ROWS", block)
    rows = corpus(k)
    df = spark.createDataFrame([(*r, "c", "n", 1, 2) for r in rows], SCHEMA)
    got = J.near_duplicates(df, k, percent)
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in got.collect()) == brute(rows, k, percent)


def test_keep_one_of_each_group(spark):
    """Rows count by id and text: a text of its own under a repeated id stays."""
    a, b, near, c = "one two three four five six", "this is another text of some words", " ".join(f"w{i}" for i in range(80)), "and once more something else here now"
    rows = [(1, a, 1), (2, a, 2), (2, b, 3), (2, b, 3), (3, None, 4), (4, b + " ", 5), (None, a, 6), (5, "", 7), (6, near, 8), (6, near + " x", 9), (7, near + " y", 10), (8, c, 11), (8, c, 11)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    kept = J.keep_one(docs, J.near_duplicates(docs, 5, 80))
    got = sorted((str(r.doc_id), r.extra) for r in kept.collect())
    assert kept.columns == docs.columns
    assert got in [sorted([("1", 1), ("2", 3), ("3", 4), ("None", 6), ("5", 7), ("6", x), ("8", 11)]) for x in (8, 9)]


def test_empty_table(spark):
    assert J.near_duplicates(spark.createDataFrame([], SCHEMA)).collect() == []


def test_facts_and_sets_are_passed_on_in_slices():
    """A batch of many texts comes back as many batches, and each class is still sent once a batch."""
    import numpy as np
    import pyarrow as pa

    rng = random.Random(2)
    texts = [" ".join(f"w{rng.randint(0, 10**6)}" for _ in range(200)) for _ in range(1500)]
    texts += [None, "", "a b", texts[0], texts[-1], "x " * 400_000, texts[7]]
    n = len(texts)
    batch = pa.RecordBatch.from_pydict({"doc_id": pa.array(range(n), pa.int64()), "text": pa.array(texts), "text_hash": pa.array(range(n), pa.int64())})
    out = list(J._facts(5, 80)(iter([batch])))
    assert len(out) > 4 and max(b.num_rows for b in out) < 60_000
    whole = pa.Table.from_batches(out).to_pylist()
    documents, sent = [r for r in whole if r["token"] is None], [r for r in whole if r["token"] is not None]
    assert [r["doc_id"] for r in documents] == [r["text_hash"] for r in documents] == list(range(n))
    assert documents[0]["cls"] == documents[-4]["cls"] and documents[-7]["cls"] is documents[-6]["cls"] is None
    for r, t in zip(documents, texts):
        words = (t or "").split()
        assert r["n"] == (len({tuple(words[i:i + 5]) for i in range(len(words) - 4)}) if len(words) > 4 else bool(words))
    assert len(sent) == len({(r["cls"], r["token"]) for r in sent}) and {r["cls"] for r in sent} == {r["cls"] for r in documents if r["cls"] is not None}

    fetched = list(J._fetched(5, 80)(iter([pa.RecordBatch.from_pydict({"cls": pa.array([r["cls"] for r in documents], pa.int64()), "text": pa.array(texts)})])))
    assert len(fetched) > 2 and max(b.num_rows for b in fetched) < 1000
    rows = pa.Table.from_batches(fetched).to_pylist()
    assert [(r["cls"], r["n"]) for r in rows] == [(r["cls"], r["n"]) for r in documents if r["cls"] is not None]
    assert all(J.class_of(np.array(r["tokens"], np.int64).view(np.uint64)) == r["cls"] for r in rows[:50])
