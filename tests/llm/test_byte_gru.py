import corpus_pipeline
import numpy as np
import pytest
from pyspark.sql import functions as F

from sunset_engine.llm import byte_gru as G
from sunset_engine.llm.common import table

SF = "/root/testdata/sf0.01"


def test_backpropagation_matches_differences(monkeypatch):
    monkeypatch.setattr(G, "HIDDEN", 3)
    rng = np.random.default_rng(0)
    params = [rng.normal(0, 0.5, s) for s in ((9, 256), (9, 3), (9, 256), (9, 3), (2, 6), (2,))]
    x, y = rng.integers(97, 101, (7, 4)).astype(np.uint8), np.array([0, 1, 1, 0])
    mask = np.ones((7, 4), np.float32)
    mask[5:, 2] = 0

    def loss(p):
        model = G.Model(["a", "b"], G.Gru(p[0], p[1]), G.Gru(p[2], p[3]), p[4], p[5])
        prob = model.probabilities(x, None).astype(float)
        masked = [model.forward.states(x, mask, False), model.backward.states(x, mask, True)]
        logits = np.matmul(p[4], np.concatenate(masked, axis=1)) + p[5][:, None]
        prob = np.exp(logits) / np.exp(logits).sum(axis=1, keepdims=True)
        return -(np.log(prob[:, y, np.arange(4)]) * mask).sum() / mask.sum()

    grads = G.gradients([p.astype(np.float64) for p in params], x, mask, y)
    for k, p in enumerate(params):
        for _ in range(12):
            at = tuple(int(rng.integers(n)) for n in p.shape) if k not in (0, 2) else (int(rng.integers(9)), int(rng.integers(97, 101)))
            up, down = ([q.copy() for q in params] for _ in range(2))
            up[k][at] += 1e-2
            down[k][at] -= 1e-2
            assert grads[k][at] == pytest.approx((loss(up) - loss(down)) / 2e-2, abs=2e-3)


@pytest.fixture(scope="module")
def model(spark):
    docs = table(spark, SF, "documents")
    return G.train(docs.where(~G.held_out(F.col("doc_id"))))


def test_held_out_accuracy(spark):
    docs = table(spark, SF, "documents")
    got = G.op3_byte_gru(spark, SF)
    assert got.columns == ["doc_id", "held_out", "lang_pred", "score"]
    rows = got.join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(rows) == docs.count()
    held = [r for r in rows if r.held_out]
    assert 100 < len(held) < 300
    assert np.mean([r.lang == r.lang_pred for r in held]) >= 0.97
    assert all(0 <= r.score <= 1 for r in rows)


def test_edge_texts(spark, model):
    rows = [(1, None, "k", 1.0), (2, "", "k", 1.0), (3, "123 !? \n", "k", 1.0), (4, "the and of " * 40000, "k", 1.0), (4, "the and of " * 40000, "k", 1.0), (None, "é", "k", 1.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, known string, score double")
    got = G.identify(df, model).collect()
    assert [r.lang_pred for r in got[:3]] == ["und"] * 3 and [r.score for r in got[:3]] == [0.0] * 3
    assert got[3].lang_pred == got[4].lang_pred == "en" and got[3].known == "k"
    assert got[5].lang_pred in model.languages
    assert G.identify(df.limit(0), model).collect() == []
    assert {r.lang_pred for r in G.identify(df, None).collect()} == {"und"}


def test_no_labels_no_model(spark):
    assert G.train(spark.createDataFrame([(1, "a", None), (2, None, "en")], "doc_id long, text string, lang string")) is None


def test_a_long_text_is_read_whole(model):
    """Windows cover every byte once, and the score is the mean over all of them."""
    data = np.frombuffer(("le la les " * 20 + "the and of " * 200).encode(), np.uint8)
    start, length, text = G.windows(data, np.array([0, 0, len(data), len(data)]))
    assert (text == 1).all() and length.sum() == len(data) and (np.diff(start) == G.WINDOW).all()


def test_every_language_is_learned(spark, monkeypatch):
    """70 languages, each with its own alphabet; one of them has a single document."""
    monkeypatch.setattr(G, "SAMPLE_DOCUMENTS", 70 * 3)
    monkeypatch.setattr(G, "LEAST_PER_LANGUAGE", 3)
    rows = [(100 * k + i, chr(0x4E00 + 97 * k) * 30, f"l{k:02}") for k in range(70) for i in range(1 if k == 69 else 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = G.train(docs)
    assert model.languages == [f"l{k:02}" for k in range(70)] and model.out.shape[0] == 70
    bar = corpus_pipeline.language_bar
    assert bar(4) == bar(1) == 0.4 and 1 / 70 < bar(70) < 0.03


def test_prediction_against_a_loop_over_positions(spark, monkeypatch):
    """Every position of every window read one after another, in plain floats, and averaged over the document."""
    monkeypatch.setattr(G, "WINDOW", 5)
    rng = np.random.default_rng(4)
    n_h, names = 3, ["aa", "bb", "cc"]
    f32 = lambda *shape: rng.normal(0, 0.7, shape).astype(np.float32)
    model = G.Model(names, G.Gru(f32(3 * n_h, 256), f32(3 * n_h, n_h)), G.Gru(f32(3 * n_h, 256), f32(3 * n_h, n_h)), f32(3, 2 * n_h), f32(3))
    texts = ["a", "abcde", "abcdefg", "é日本 xyz" * 3, None, "", "123 !", "q" * 23]

    def states(gru, window):
        h, out = np.zeros(n_h), []
        for byte in window:
            a, g = gru.bytes[:, byte].astype(float), gru.state.astype(float) @ h
            z, r = (1 / (1 + np.exp(-(a[i:i + n_h] + g[i:i + n_h]))) for i in (0, n_h))
            n = np.tanh(a[2 * n_h:] + r * g[2 * n_h:])
            h = (1 - z) * n + z * h
            out.append(h)
        return out

    def brute(text):
        if not any(c.isalpha() for c in text or ""):
            return G.UNDETERMINED, 0.0
        data, total = text.encode(), np.zeros(3)
        for at in range(0, len(data), 5):
            w = data[at:at + 5]
            for h, b in zip(states(model.forward, w), reversed(states(model.backward, w[::-1]))):
                logits = model.out.astype(float) @ np.concatenate([h, b]) + model.bias
                total += np.exp(logits) / np.exp(logits).sum()
        return names[total.argmax()], total.max() / len(data)

    got = G.identify(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model).collect()
    for r in got:
        name, score = brute(texts[r.doc_id])
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-5)


def test_texts_are_passed_on_in_slices():
    """A batch of many texts does not come back as one batch."""
    import random
    from types import SimpleNamespace

    import pyarrow as pa

    rng = random.Random(3)
    texts = ["".join(rng.choice("abcd \u00e9") for _ in range(1500)) for _ in range(4000)] + ["", "end"]
    state = lambda *shape: np.random.default_rng(5).normal(0, 0.3, shape).astype(np.float32)
    parts = (["aa", "bb", "cc"], state(24, 256), state(24, 8), state(24, 256), state(24, 8), state(3, 16), np.zeros(3, np.float32))
    batch = pa.RecordBatch.from_pydict({"c0": list(range(len(texts))), "text": texts})
    out = list(G._predicted(SimpleNamespace(value=parts), True)(iter([batch])))
    assert len(out) > 2 and all(sum(len(t.encode()) for t in b.column("text").to_pylist()) <= 1 << 21 for b in out)
    whole = pa.Table.from_batches(out)
    assert whole.column("c0").to_pylist() == list(range(len(texts))) and whole.column("text").to_pylist() == texts
    model = G.Model(parts[0], G.Gru(*parts[1:3]), G.Gru(*parts[3:5]), *parts[5:])
    for i in (0, 1800, 3999, 4001):
        data = np.frombuffer(texts[i].encode(), np.uint8)
        start, length, _ = G.windows(data, np.array([0, len(data)]))
        p = model.probabilities(*G.taken(data, start, length)).sum(axis=(0, 2)) / len(data)
        assert whole.column("lang_pred")[i].as_py() == parts[0][p.argmax()] and whole.column("score")[i].as_py() == pytest.approx(p.max(), rel=1e-4)
