import random

import numpy as np
import pyarrow as pa
import pytest

from sunset_engine.llm import ordinal_quality as O
from sunset_engine.llm.common import string_bytes, table

SF = "/root/testdata/sf0.1"


def test_thresholds_order_and_recover():
    """One feature drives the grade: its weight is found, thresholds ascend, tails fall."""
    rng = np.random.default_rng(0)
    n = 3000
    kind = rng.integers(0, 3, n)
    grade = np.clip(kind + (rng.random(n) < 0.1) - (rng.random(n) < 0.1), 0, 2)
    values = np.stack([kind, np.full(n, 7)], axis=1).ravel()
    model = O.fit(values, np.arange(n + 1) * 2, grade, np.ones(n), 3)
    assert (np.diff(model.thresholds) > 0).all()
    tails = model.tails(np.array([0, 7, 1, 7, 2, 7]), np.array([0, 2, 4, 6]))
    assert (np.diff(tails, axis=1) <= 0).all() and (np.diff(tails.sum(axis=1)) > 0.5).all()


def test_features_are_whole_texts():
    texts = ["loser", "a b c", None, "", "a b c a b c", "loser!!! " * 3]
    values, ends = O.features(*string_bytes(pa.array(texts)))
    rows = [set(values[a:b].tolist()) for a, b in zip(ends[:-1], ends[1:])]
    words = [{v for v in r if v < 1 << O.BITS} for r in rows]
    assert words[1] == words[4] and words[0] < words[5] and not words[2] and not words[3]
    assert all(len([v for v in r if v >= 1 << O.BITS]) == O.SHAPES for r in rows)


@pytest.fixture(scope="module")
def model(spark):
    return O.learned(spark, SF, table(spark, SF, "documents"))


def test_held_out_quality(spark, model):
    docs = table(spark, SF, "documents").select("doc_id", "text")
    labels = O.ratings(table(spark, SF, "labels")).where("crc32(cast(cast(doc_id as string) as binary)) % 5 = 0")
    rows = O.rate(docs, model).join(labels, "doc_id").withColumn("kept", O.kept()).collect()
    good, bad = [[r for r in rows if (r.grade == 2) == g] for g in (True, False)]
    assert len(bad) > 150
    assert np.mean([r.kept for r in good]) >= 0.97
    assert np.mean([r.kept for r in bad]) <= 0.35
    assert np.mean([r.expected_grade for r in good]) - np.mean([r.expected_grade for r in bad]) > 0.7
    assert all(0 <= r.expected_grade <= 2 and 0 <= r.tail_prob <= 1 for r in rows)


def test_edge_texts(spark, model):
    rows = [(1, None, 9.0), (2, "", 9.0), (3, " \n", 9.0), (4, "loser " * 50000, 9.0), (4, "loser " * 50000, 9.0), (None, "a", 9.0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, tail_prob double")
    got = O.rate(df, model).collect()
    assert [(r.expected_grade, r.tail_prob) for r in got[:3]] == [(0.0, 0.0)] * 3
    assert got[3].tail_prob == got[4].tail_prob < 0.5 and len(got) == 6
    assert O.rate(df.limit(0), model).collect() == []
    assert all(r.tail_prob is None for r in O.rate(df, None).collect())


def test_one_grade_gives_no_model(spark):
    docs = spark.createDataFrame([(1, "a"), (2, "b")], "doc_id long, text string")
    assert O.train(docs, spark.createDataFrame([(1, 2), (2, 2)], "doc_id long, grade int"), 3) is None
    assert O.train(docs, spark.createDataFrame([], "doc_id long, grade int"), 3) is None


def test_ratings(spark):
    labels = spark.createDataFrame([(1, 1, 0), (2, 0, 0), (3, 1, 1), (4, None, 0), (5, 0, 1)], "doc_id long, quality int, toxic int")
    assert {r.doc_id: r.grade for r in O.ratings(labels).collect()} == {1: 2, 2: 1, 3: 0, 5: 0}


def test_toxic_words_are_caught_without_being_capped(spark, model):
    """A single marked word at the end of a long clean text still counts."""
    clean = next(r.text for r in table(spark, SF, "documents").join(table(spark, SF, "labels").where("quality = 1 and toxic = 0"), "doc_id")
                 .where("lang = 'en' and length(text) > 8000").orderBy("doc_id").limit(1).collect())
    random.seed(1)
    df = spark.createDataFrame([(1, clean), (2, clean + " loser idiot scum moron")], "doc_id long, text string")
    a, b = (r.expected_grade for r in O.rate(df, model).orderBy("doc_id").collect())
    assert b < a


def test_rating_against_a_sum_over_features(spark):
    """Tails and expected grade of each text from its features' weights, added up one by one."""
    rng = np.random.default_rng(6)
    weights = rng.normal(0, 0.5, (1 << O.BITS) + O.SHAPES * O.BINS).astype(np.float32)
    model = O.Model(weights, np.array([-0.7, 0.4, 1.9]))
    texts = ["one two three", "A b, c!", "", None, " \n", "word " * 3000, "é 日本\n" * 40, "x"]
    got = {r.doc_id: r for r in O.rate(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1), model).collect()}
    assert len(got) == len(texts)
    for i, text in enumerate(texts):
        if not (text or "").strip():
            assert (got[i].expected_grade, got[i].tail_prob) == (0.0, 0.0)
            continue
        values, _ = O.features(*string_bytes(pa.array([text])))
        score = sum(float(weights[v]) for v in values)
        tails = [1 / (1 + np.exp(t - score)) for t in model.thresholds]
        assert got[i].expected_grade == pytest.approx(sum(tails), rel=1e-6) and got[i].tail_prob == pytest.approx(tails[-1], rel=1e-6)


def test_rated_texts_are_passed_on_in_slices():
    """A batch of many texts neither makes its features at once nor comes back as one batch."""
    from types import SimpleNamespace

    rng = random.Random(4)
    texts = [" ".join(rng.choice(["good", "loser", "a", "Word", "!!"]) for _ in range(rng.randint(0, 400))) for _ in range(3000)] + ["", "long " * 200_000, "end"]
    places = np.arange(0, 1 << O.BITS, 3)
    weights = np.zeros((1 << O.BITS) + O.SHAPES * O.BINS, np.float32)
    weights[places] = (places % 11 - 5) / 8
    model = O.Model(weights, np.array([-0.5, 0.5]))
    batch = pa.RecordBatch.from_pydict({"c0": list(range(len(texts))), "text": texts})
    out = list(O._rated(SimpleNamespace(value=(places, weights[places], model.thresholds)), True)(iter([batch])))
    assert all(b.num_rows == 1 or sum(len(t) for t in b.column("text").to_pylist()) <= 1 << 20 for b in out) and len(out) > 3
    whole = pa.Table.from_batches(out)
    assert whole.column("c0").to_pylist() == list(range(len(texts))) and whole.column("text").to_pylist() == texts
    tails = model.tails(*O.features(*string_bytes(pa.array(texts)), weights != 0))
    assert np.allclose(whole.column("tail_prob").to_numpy(), tails[:, -1]) and np.allclose(whole.column("expected_grade").to_numpy(), tails.sum(axis=1))
