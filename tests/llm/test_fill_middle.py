import hashlib
import re

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sunset_engine.llm import fill_middle as M

TEXTS = [None, "", "\n", "a", "a\nb\nc", "é\n日本\n😀x\n", "x<P>y\nz", "<P", ">\n<S>", "a<", "P>b\nc", "<M\n>", "tail\n\n\n", "no feed at all 😀😀", "é" * 5000 + "\n" + "z" * 70_000, "\r\n\r", "a\nb\nc"]


def units(text, unit):
    return re.findall(r"[^\n]*\n|[^\n]+", text) if unit == "line" else list(text)


def expected(id_, text, unit="line", fim=100, spm=50):
    text = text or ""
    h = hashlib.sha256(f"7:{'' if id_ is None else id_}".encode()).hexdigest()
    h = [int(h[8 * i:8 * i + 8], 16) for i in range(4)]
    parts = units(text, unit)
    n = len(parts)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = "".join(parts[:a]), "".join(parts[a:b]), "".join(parts[b:])
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= fim:
        return n, "plain", None, None, text
    if h[3] % 100 < spm:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


@pytest.mark.parametrize(("unit", "fim"), [("line", 100), ("char", 100), ("line", 60)])
def test_against_brute_force(spark, unit, fim):
    rows = [(i + 1000 * k, t, "x", i) for k in range(6) for i, t in enumerate(TEXTS)] + [(None, "a\nb", "x", 0), (3, "a", "y", 1), (3, "a", "y", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, draw0 string, n int").repartition(3)
    got = M.transform(docs, unit=unit, fim_percent=fim).withColumn("back", M.restored(F.col("output"), F.col("form"))).collect()
    assert sorted(((r.doc_id, r.draw0, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got), key=repr) == sorted(
        ((i, x, *expected(i, t, unit, fim)) for i, t, x, _ in rows), key=repr)
    assert sorted((str(r.doc_id), r.back) for r in got) == sorted((str(i), t or "") for i, t, *_ in rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


@settings(max_examples=200, deadline=None)
@given(st.text(alphabet="aé日😀\n", max_size=60), st.lists(st.integers(0, 60), min_size=1))
def test_the_index_converts_both_ways(text, cuts):
    data = np.frombuffer(text.encode(), np.uint8)
    index = M.Exceptions.of(data)
    points = np.array([min(c, len(text)) for c in cuts])
    places = np.array([len(text[:c].encode()) for c in points])
    assert (index.bytes(points) == places).all()
    assert (index.points(places) == points).all()


def test_empty_table_and_unknown_unit(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert M.transform(empty).collect() == []
    assert M.transform(empty).columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"]
    with pytest.raises(ValueError):
        M.transform(empty, unit="word")


def test_a_run_of_texts_is_cut_at_its_own_lines(spark):
    """More than one slice, and texts longer than a slice."""
    rows = [(i, ("é" * (i % 7) + "\n") * 90_000) for i in range(12)]
    got = M.transform(spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)).collect()
    assert [(r.doc_id, r.n, r.form, r.prefix_chars, r.middle_chars, r.output) for r in got] == [(i, *expected(i, t)) for i, t in rows]
