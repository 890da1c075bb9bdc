import random
import re

import numpy as np
import pyarrow as pa

from sunset_engine.llm import common as C


def test_word_hashes_tell_words_apart(monkeypatch):
    rng = random.Random(1)
    texts = ["".join(rng.choice(["a", "B", "é", " ", "\n", "\t", "  ", "xyz"]) for _ in range(rng.randint(0, 60))) for _ in range(300)] + [None, "", "   ", "a" * 500]
    lower = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
    expected = [[w for w in re.split("[\x20\x09-\x0D]+", (t or "").translate(lower)) if w] for t in texts]
    seen = []
    for window in (7, 1 << 20):
        monkeypatch.setattr(C, "WINDOW_BYTES", window)
        hashes, first, begun = C.word_hashes(*C.string_bytes(pa.array(texts)), prefixes=(2,))
        words = [w for ws in expected for w in ws]
        assert np.diff(first).tolist() == [len(ws) for ws in expected]
        assert len(hashes) == len(words) and len(set(zip(hashes.tolist(), words))) == len(set(words)) == len(set(hashes.tolist()))
        starts = [w.encode()[:2] for w in words]
        assert len(set(zip(begun.tolist(), starts))) == len(set(starts)) == len(set(begun.tolist()))
        seen.append(hashes.tolist())
    assert seen[0] == seen[1]


def test_shingles_match_tuples():
    texts = ["a b c d e a b c", "a b", "", "B a", "a b c"]
    hashes, first = C.word_hashes(*C.string_bytes(pa.array(texts)))
    sets = list(C.shingle_sets(hashes, first, 3))
    words = [t.lower().split() for t in texts]
    plain = [{tuple(w[i:i + 3]) for i in range(len(w) - 2)} if len(w) >= 3 else ({tuple(w)} if w else set()) for w in words]
    assert [len(s) for s in sets] == [len(p) for p in plain]
    for i in range(len(texts)):
        for j in range(len(texts)):
            assert len(np.intersect1d(sets[i], sets[j])) == len(plain[i] & plain[j])


def test_connected_components_of_random_graphs(spark):
    rng = random.Random(4)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(1000, 1040)] + [(2000, i) for i in range(1900, 2100)] + [(5, 5)]
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    got = {r.id: r.component_id for r in C.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    linked = {x for a, b in edges if a != b for x in (a, b)}
    assert got == {x: find(x) for x in linked}
    assert C.connected_components(spark.createDataFrame([], "a long, b long")).count() == 0
