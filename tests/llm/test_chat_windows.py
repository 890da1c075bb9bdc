import hashlib
import random
from collections import defaultdict
from itertools import groupby
from urllib.parse import quote_plus

import pytest
from pyspark.sql import functions as F

from sunset_engine.llm import chat_windows as M

SCHEMA = "conv_id long, turn long, role string, text string, position string, tok int"
WORDS = ["a", "bb ", "\\", "###", "####", "#", "</turn>", "</turn>\n", "### Assistant: ", "é", "日本", "\n", "</turn", "\\/", "$1 ", "long words and more of them "]


def fmt(role, text):
    label = "?" if role is None else M.LABELS.get(role, "=" + quote_plus(role, safe="*"))
    e = (text or "").replace("\\", "\\\\")
    out = "".join("#\\" if e[i:i + 3] == "###" else c for i, c in enumerate(e)).replace("</turn>", "<\\/turn>")
    return f"### {label}: ", out, "</turn>\n"


def brute(rows, budget, history, segment):
    """Windows as (conv, position, n_system, n_history, n_new, tokens, text, loss)."""
    convs = defaultdict(list)
    for c, turn, role, text, *_ in rows:
        convs[c].append((turn is not None, turn or 0, role != "system", "".join(fmt(role, text)), role, text))
    out = []
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[:3], t[3].encode()))
        size = [-(-len(t[3].encode()) // 4) for t in turns]
        segs, n = {}, 0
        for _, block in groupby(range(len(turns)), key=lambda i: turns[i][1] // segment if turns[i][0] else None):
            block = list(block)
            for k, i in enumerate(block):
                segs[i] = n + k // segment
            n = segs[block[-1]] + 1
        sys = turns[0][4] == "system" and size[0] * 2 <= budget
        first = int(sys)
        windows, start = [], None                  # (start, history)

        def past(k):
            j = k
            room = min(history, budget - sys * size[0] - size[k])
            while j > first and segs[j - 1] >= segs[k] - 1 and sum(size[j - 1:k]) <= room:
                if segs[j - 1] < segs[k] and sum(size[i] for i in range(j - 1, len(turns)) if segs[i] == segs[j - 1]) > history:
                    break
                j -= 1
            return j

        for k in range(first, len(turns)):
            if start is None or segs[k] != segs[start[0]] or sys * size[0] + sum(size[start[1]:k + 1]) > budget:
                start = (k, past(k))
                windows.append([*start, k])
            windows[-1][2] = k + 1
        if not windows:
            windows = [[1, 1, 1]]
        for i, (s, h, e) in enumerate(windows):
            at = 0 if i == 0 else s
            text, loss = "", []
            for j in [*([0] if sys else []), *range(h, e)]:
                head, body, tail = fmt(*turns[j][4:])
                if j >= s and turns[j][4] == "assistant":
                    loss.append((len(text) + len(head), len(body)))
                text += head + body + tail
            out.append((c, at, int(sys and i > 0), s - h, e - s + (i == 0 and sys), sys * size[0] + sum(size[h:e]), text, loss))
    return sorted(out, key=repr)


def conversations():
    draw = random.Random(5)
    rows = []
    for c in [*range(40), None]:
        for turn in range(draw.choice([1, 2, 3, 8, 30])):
            role = "system" if turn == 0 and draw.random() < 0.5 else draw.choice(["user", "assistant", "assistant", "tool: #1", "system", None, "", "User", "é"])
            text = "".join(draw.choice(WORDS) for _ in range(draw.choice([0, 1, 3, 10, 60])))
            turn = draw.choice([turn, turn, turn, turn, 3, None]) if c in (5, 6, 7, None) else turn
            rows.append((c, turn, role, None if draw.random() < 0.05 else text, "x", 1))
            if draw.random() < 0.05:
                rows.append(rows[-1])
    return rows


@pytest.mark.parametrize(("budget", "history", "segment"), [(1024, 256, 256), (120, 40, 256), (60, 30, 4), (30, 0, 3), (80, 1000, 2)])
def test_against_brute_force(spark, monkeypatch, budget, history, segment):
    monkeypatch.setattr(M, "SEGMENT", segment)
    rows = conversations()
    made = M.windows(spark.createDataFrame(rows, SCHEMA).repartition(5), budget, history)
    got = [(r.conv_id, r.position, r.n_system, r.n_history, r.n_new, r.n_tokens, r.text, [tuple(x) for x in r.loss]) for r in made.collect()]
    want = brute(rows, budget, history, segment)
    assert sorted(got, key=repr) == want
    assert all(w[5] <= budget or w[3] == 0 and w[2] + w[4] <= 2 for w in want)


def test_every_turn_comes_back_once(spark, monkeypatch):
    monkeypatch.setattr(M, "SEGMENT", 4)
    rows = conversations()
    back = M.read_back(M.windows(spark.createDataFrame(rows, SCHEMA), 70, 30)).collect()
    got = sorted(((r.conv_id, t.role, t.text) for r in back for t in r.turns), key=repr)
    assert got == sorted(((c, role, text or "") for c, _, role, text, *_ in rows), key=repr)
    assert sum(len(r.loss_text) for r in back) == sum(len(text or "") for _, _, role, text, *_ in rows if role == "assistant")


def test_own_counts_a_hot_conversation_and_no_rows(spark):
    rows = [(1, i, ("user", "assistant")[i % 2], f"text {i}", "x", 30) for i in range(3000)]
    turns = spark.createDataFrame(rows, SCHEMA)
    made = M.windows(turns, 400, 80, tokens_col="tok").collect()
    assert sum(r.n_new for r in made) == 3000 and max(r.n_tokens for r in made) <= 400
    assert all(r.n_history == 2 for r in made if r.position)
    assert M.windows(turns.limit(0)).collect() == []
    plan = M.windows(turns)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_a_long_text_is_one_turn(spark):
    text = ("\\###</turn>\n" * 40_000)
    r = M.read_back(M.windows(spark.createDataFrame([(1, 0, "assistant", text, "", 0)], SCHEMA))).collect()
    assert [(t.role, t.text) for t in r[0].turns] == [("assistant", text)] and r[0].loss_text == text


def test_the_query_gives_the_digests(spark, tmp_path):
    rows = conversations()
    rows = [(c, i, role or "none", text, "x", 0) for i, (c, _, role, text, *_) in enumerate(rows) if c is not None]
    spark.createDataFrame(rows, SCHEMA).write.parquet(str(tmp_path / "conversations.parquet"))
    rows += [(M.ODD_ID, 0, "user", M.ODD_TEXT, "", 0), (M.ODD_ID, 1, "assistant", M.ODD_TEXT, "", 0)]
    want = {}
    for c in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == c]
        said = "".join(f"{r[2]}\n{r[3] or ''}\n" for r in own)
        loss = "".join(r[3] or "" for r in own if r[2] == "assistant")
        want[c] = (len(own), hashlib.sha256(said.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest())
    got = M.op13_chat_windows(spark, str(tmp_path)).collect()
    assert {r.conv_id: tuple(r)[1:5] for r in got} == want and len(got) == len(want)
    assert all(r.formatted_chars > 0 for r in got)
