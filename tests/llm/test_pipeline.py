import duckdb
import pytest

import corpus_pipeline
from sunset_engine.llm import catalog
from sunset_engine.operators.joins import materialize

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = {"documents": docs}
    for name, stage in corpus_pipeline.STAGES:
        docs = out[name] = materialize(stage(spark, docs, SF), f"test-{name}").cache()
    return out


def test_stages_in_order(stages):
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "language", "near_duplicates", "private_data", "packing"]
    for name in list(stages)[:-1]:
        assert stages[name].columns == COLUMNS
    counts = [stages[n].count() for n in ("documents", "quality", "language", "near_duplicates", "private_data")]
    assert counts == sorted(counts, reverse=True) and counts[3] == counts[4] and counts[-1] > 50


def test_no_near_copies_are_left(stages):
    """Compared with brute force on the stage's own input: one document of every group stays, and no other goes."""
    rows = {r.doc_id: r.text for r in stages["language"].collect()}
    sets = {}
    for i, t in rows.items():
        w = t.translate(str.maketrans({chr(65 + k): chr(97 + k) for k in range(26)})).split()
        sets[i] = {tuple(w[j:j + 5]) for j in range(len(w) - 4)} or {tuple(w)}
    parent = {i: i for i in rows}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(rows)
    for n, i in enumerate(ids):
        for j in ids[:n]:
            if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    assert {r.doc_id for r in stages["near_duplicates"].collect()} == {i for i in ids if find(i) == i}


def test_every_document_is_packed(stages):
    packed = stages["packing"]
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in stages["private_data"].collect()}
    assert packed.groupBy("sequence_id").sum("length").where("`sum(length)` > 1024").count() == 0


def test_stages_take_odd_rows(spark):
    rows = [(1, None, None, None, None, "x"), (2, "", "en", "s", 0, "x"), (None, "the and of the", "en", "s", 14, "x"), (3, "the and of the mail a.b@c.de", "en", "s", 28, "x"),
            (3, "the and of the mail a.b@c.de", "en", "s", 28, "x"), (4, "word " * 30000, None, "s", 150000, "x"), (5, "???", "fr", "s", 3, "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, extra string")
    for frame in (docs, docs.limit(0)):
        for name, stage in corpus_pipeline.STAGES:
            out = stage(spark, frame, SF)
            assert out.columns == COLUMNS or name == "packing"
            assert (out.count() == 0) or frame is docs


def test_run_and_registration(spark):
    assert "pipeline" in catalog.queries() and corpus_pipeline.ORACLE_SQL is None
    names = [q for q in catalog.queries() if q.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(catalog.oracle_sql()))
def test_queries_match_their_sql(spark, name):
    got = catalog.queries()[name](spark, SF)
    with duckdb.connect() as c:
        for t in ("documents", "embeddings", "pages", "conversations"):
            c.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
        cols = sorted(got.columns)
        expected = c.execute(f"select {', '.join(cols)} from ({catalog.oracle_sql()[name]})").fetchall()
    rows = [tuple(r[c] for c in cols) for r in got.collect()]
    assert len(rows) == len(expected) and sorted(map(str, rows)) == sorted(map(str, expected))


def test_language_without_labels_keeps_texts(spark):
    rows = [(1, "the and of the", None, "s", 14), (2, "été", None, "s", 3), (2, "été", None, "s", 3), (3, "123 ?", None, "s", 5), (4, "", None, "s", 0), (5, None, None, "s", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    out = corpus_pipeline.language(spark, docs, SF)
    assert out.columns == COLUMNS and sorted(r.doc_id for r in out.collect()) == [1, 2, 2]
    assert corpus_pipeline.language(spark, docs.limit(0), SF).collect() == []
