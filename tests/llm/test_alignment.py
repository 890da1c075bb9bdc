import base64
import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from sunset_engine.llm import alignment as M
from sunset_engine.llm.common import tokenizer_json

A = tokenizer_json(public_tokenizers.path("byte_bpe_50k.json"))
with open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as f:
    B = f.read()
SP = sentencepiece.SentencePieceProcessor(model_proto=B)
with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
TT = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def tokens(text):
    """[(id, bytes)] by both, or nothing."""
    if not text:
        return [], []
    a = [(i, TT.decode_single_token_bytes(i)) for i in TT.encode_ordinary(" " + text)]
    b = [(i, bytes([int(p[3:5], 16)]) if SP.is_byte(i) else p.replace("▁", " ").encode()) for i, p in ((i, SP.id_to_piece(i)) for i in SP.encode(text))]
    whole = (" " + text).encode()
    return (a, b) if b"".join(x for _, x in a) == whole == b"".join(x for _, x in b) else ([], [])


def groups(text):
    a, b = tokens(text)
    out, i, j, x, y = [], 0, 0, 0, 0
    while i < len(a):
        own = ([a[i][0]], [b[j][0]])
        x, y, i, j = x + len(a[i][1]), y + len(b[j][1]), i + 1, j + 1
        while x != y:
            if x < y:
                own[0].append(a[i][0])
                x, i = x + len(a[i][1]), i + 1
            else:
                own[1].append(b[j][0])
                y, j = y + len(b[j][1]), j + 1
        out.append(own)
    return out


def expected(rows, digest):
    made = [(i, groups(t)) for i, t in rows]
    links = [[(a, b) for x, y in g for a in x for b in y] for _, g in made]
    count = Counter(p for one in links for p in set(one))
    top = {}
    for (a, _), n in count.items():
        top[a] = max(n, top.get(a, 0))
    out = []
    for (i, g), one in zip(made, links, strict=True):
        shown = ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in g)
        if digest and shown:
            shown = hashlib.sha256(shown.encode()).hexdigest()
        out.append((i, sum(len(x) for x, _ in g), sum(len(y) for _, y in g), len(g), len(one), sum(count[p] == top[p[0]] for p in one), sum(count[p] for p in one), shown))
    return out, count


TEXTS = [None, "", " ", "  ", "\n", "a", "a b", "a  b", " a", "a ", "a\nb", "a\n\nb", "\nab", "ab\n", "a \n b\t c", "▁", "a▁b c", "é", "日本語 テキスト", "😀 😀😀", "\x00 x", "<|endoftext|> a<s></s>",
         "don't we'll x", "x y z", "12345 67 8", " " * 300 + "a" + " " * 77, "\n" * 50, "ab" * 2000, "!?" * 300 + " a", "The quick brown fox jumps over the lazy dog. " * 20, "é ﻿b ​c"]


@pytest.mark.parametrize("digest", [False, True])
def test_against_brute_force(spark, digest):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(None, "The quick fox"), (5, "a"), (5, "a")]
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], "doc_id long, text string, id string, chunk int").repartition(3)
    made = M.aligned(docs, A, B, digest=digest)
    want, count = expected(rows, digest)
    assert sorted((tuple(r) for r in made.documents().collect()), key=repr) == sorted(want, key=repr)
    got = made.pair_counts().collect()
    assert {(r.a, r.b): r.n for r in got} == dict(count) and len(got) == len(count)


def test_long_texts_in_parts_and_many_dictionaries(spark, monkeypatch):
    """Bounds so small that texts are cut, dictionaries closed and groups reduced on the way."""
    monkeypatch.setattr(M, "SLICE_BYTES", 200)
    monkeypatch.setattr(M, "CHUNK_PAIRS", 50)
    monkeypatch.setattr(M, "PAIRS_AT_ONCE", 40)
    monkeypatch.setattr(M, "LARGE_GROUP", 3)
    monkeypatch.setattr(M, "CACHE_WORDS", 20)
    rows = [(i, " ".join(filter(None, (t or "" for t in TEXTS[i % 7:])))) for i in range(12)] + [(50, "▁ " + "word and word " * 200), (51, "one two " * 300), (52, "one two " * 300)]
    got = M.aligned(spark.createDataFrame(rows, "doc_id long, text string").repartition(2), A, B).documents().collect()
    assert sorted((tuple(r) for r in got), key=repr) == sorted(expected(rows, False)[0], key=repr)


def test_the_query(spark, tmp_path):
    rows = list(enumerate(TEXTS))
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = M.op12_alignment(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected(rows, True)[0])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(alphabet="ab 1.'s\n\t é日😀▁<|>", max_size=40), max_size=6))
def test_runs_of_odd_texts(texts):
    known = test_runs_of_odd_texts.__dict__.setdefault("known", M.Tokenizers(A, B))
    run = M.align(pa.array(texts, pa.large_string()), known)
    for i, t in enumerate(texts):
        want = expected([(0, t)], False)[0][0]
        assert (run.n_a[i], run.n_b[i], run.n_groups[i], run.n_links[i], run.groups[i].decode()) == (*want[1:5], want[7])
    links = Counter((i, a * 32000 + b) for i, t in enumerate(texts) for x, y in groups(t) for a in x for b in y)
    got = zip(*(run.pairs[c].to_pylist() for c in ("doc", "pair", "times")), strict=True)
    assert {(d, p): n for d, p, n in got} == dict(links)


def test_an_empty_table(spark):
    made = M.aligned(spark.createDataFrame([], "doc_id long, text string"), A, B)
    assert made.documents().collect() == [] and made.pair_counts().collect() == []


def test_byte_tables_of_all_characters():
    """Both tokenizers give back every character but the block that stands for a space."""
    known = M.Tokenizers(A, B)
    words = [f" {chr(c)}" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    _, good = known.encode(pa.array(words))
    assert [w[1:] for w, g in zip(words, good.to_pylist(), strict=True) if not g] == ["▁"]
    assert np.all(np.array(known.size[0].to_pylist()[:-1]) > 0)
