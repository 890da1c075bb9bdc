"""Language identification by a bidirectional gated recurrent network over bytes.

Two GRUs read windows of a text's UTF-8 bytes, one forwards and one backwards; at every position
a softmax over their states labels the position, and a document's probabilities are the
mean over all its positions. The network is trained in numpy by backpropagation through
time on windows of a bounded sample of labelled documents; prediction reads whole texts.
All arrays have features first and windows last, so that gates are contiguous.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.llm.common import lean, string_bytes, table, text_slices
from sunset_engine.operators.joins import broadcast_if_bounded, materialize

HIDDEN = 8
WINDOW = 64
# The fit: labelled documents per language (about), fewer when all languages together would have more than
# SAMPLE_DOCUMENTS, but not fewer than LEAST_PER_LANGUAGE; windows of each document.
SAMPLE_PER_LANGUAGE = 800
SAMPLE_DOCUMENTS = 51_200
LEAST_PER_LANGUAGE = 25
SAMPLE_WINDOWS = 6
EPOCHS = 5
BATCH = 192
RATE = 0.02
SEED = 11
# Windows that are read side by side; fewer, and smaller batches of the fit, above so many languages.
SIDE_BY_SIDE = 2048
MANY_LANGUAGES = 128
UNDETERMINED = "und"


@dataclass
class Gru:
    """One direction: gates z, r, n as rows of ``bytes`` (a column for each byte) and ``state``."""

    bytes: np.ndarray
    state: np.ndarray

    def step(self, x: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        n_h = len(h)
        a = np.take(self.bytes, x, axis=1)
        g = self.state @ h
        gates = np.tanh(0.5 * (a[:2 * n_h] + g[:2 * n_h])) * np.float32(0.5) + np.float32(0.5)
        z, r = gates[:n_h], gates[n_h:]
        n = np.tanh(a[2 * n_h:] + r * g[2 * n_h:])
        return z, r, n, g[2 * n_h:]

    def states(self, x: np.ndarray, mask: np.ndarray | None, back: bool) -> np.ndarray:
        """States after each position: (positions, hidden, windows). Only what prediction needs."""
        n_h = self.state.shape[1]
        out = np.empty((len(x), n_h, x.shape[1]), np.float32)
        h = np.zeros((n_h, x.shape[1]), np.float32)
        a = np.empty((3 * n_h, x.shape[1]), np.float32)
        g = np.empty_like(a)
        half = np.float32(0.5)
        gate_bytes, gate_state = self.bytes.copy(), self.state.copy()
        gate_bytes[:2 * n_h] *= half            # sigmoid(v) = tanh(v / 2) / 2 + 1 / 2
        gate_state[:2 * n_h] *= half
        for t in range(len(x) - 1, -1, -1) if back else range(len(x)):
            np.take(gate_bytes, x[t], axis=1, out=a, mode="clip")
            np.matmul(gate_state, h, out=g)
            a[:2 * n_h] += g[:2 * n_h]
            gates = a[:2 * n_h]
            np.tanh(gates, out=gates)
            gates *= half
            gates += half
            n = a[2 * n_h:]
            g[2 * n_h:] *= gates[n_h:]
            n += g[2 * n_h:]
            np.tanh(n, out=n)
            h = out[t]
            previous = out[t + 1] if back and t + 1 < len(x) else out[t - 1] if not back and t else None
            if previous is None:
                np.multiply(gates[:n_h], n, out=h)
                np.subtract(n, h, out=h)
            else:
                np.subtract(previous, n, out=h)
                h *= gates[:n_h]
                h += n
            if mask is not None:
                h *= mask[t]
        return out


@dataclass
class Model:
    languages: list[str]
    forward: Gru
    backward: Gru
    out: np.ndarray               # languages x (2 hidden)
    bias: np.ndarray

    def probabilities(self, x: np.ndarray, mask: np.ndarray | None) -> np.ndarray:
        """Position labels: (positions, languages, windows)."""
        n_h = self.forward.state.shape[1]
        logits = np.matmul(self.out[:, :n_h], self.forward.states(x, mask, False))
        logits += np.matmul(self.out[:, n_h:], self.backward.states(x, mask, True))
        logits += self.bias[:, None]
        logits -= logits.max(axis=1, keepdims=True)
        np.exp(logits, out=logits)
        logits /= logits.sum(axis=1, keepdims=True)
        if mask is not None:
            logits *= mask[:, None, :]
        return logits


def windows(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All windows of all texts: (start, length, text), in order."""
    size = np.diff(offsets)
    each = -(-size // WINDOW)
    text = np.repeat(np.arange(len(size)), each)
    nth = np.arange(len(text)) - np.repeat(np.cumsum(each) - each, each)
    start = offsets[:-1][text] + nth * WINDOW
    return start, np.minimum(WINDOW, offsets[1:][text] - start), text


def taken(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray | None]:
    """Bytes (positions, windows) and, if some window is shorter, a mask."""
    at = np.arange(WINDOW)[:, None]
    x = data[np.minimum(start + at, len(data) - 1)]
    return x, None if (length == WINDOW).all() else (at < length).astype(np.float32)


def at_once(windows_: int, languages: int) -> int:
    """So many windows that their labels' probabilities take no more memory with many languages."""
    return max(8, windows_ * MANY_LANGUAGES // max(MANY_LANGUAGES, languages))


def fit(x: np.ndarray, mask: np.ndarray, y: np.ndarray, languages: list[str]) -> Model:
    """Backpropagation through time with Adam: every position of a window has its document's label."""
    rng = np.random.default_rng(SEED)
    n_y = len(languages)
    n_h = max(HIDDEN, min(8 * HIDDEN, n_y // 4))          # more states tell more languages apart
    batch = at_once(BATCH, n_y)
    f32 = lambda v: v.astype(np.float32)
    params = [f32(rng.normal(0, 0.3, (3 * n_h, 256))), f32(rng.normal(0, 1 / np.sqrt(n_h), (3 * n_h, n_h))), f32(rng.normal(0, 0.3, (3 * n_h, 256))),
              f32(rng.normal(0, 1 / np.sqrt(n_h), (3 * n_h, n_h))), f32(rng.normal(0, 0.3, (n_y, 2 * n_h))), np.zeros(n_y, np.float32)]
    moments = [(np.zeros_like(p), np.zeros_like(p)) for p in params]
    steps = max(1, EPOCHS * -(-x.shape[1] // batch))
    done = 0
    for _ in range(EPOCHS):
        order = rng.permutation(x.shape[1])
        for at in range(0, len(order), batch):
            pick = order[at:at + batch]
            grads = gradients(params, x[:, pick], mask[:, pick], y[pick])
            done += 1
            rate = RATE * min(1.0, done / 20) * (1 - 0.95 * done / steps)
            norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
            for p, g, (m, v) in zip(params, grads, moments, strict=True):
                g = g * np.float32(min(1.0, 1.0 / max(norm, 1e-12)))
                m += 0.1 * (g - m)
                v += 0.01 * (g * g - v)
                p -= np.float32(rate) * (m / (1 - 0.9 ** done)) / (np.sqrt(v / (1 - 0.99 ** done)) + 1e-6)
    return Model(languages, Gru(params[0], params[1]), Gru(params[2], params[3]), params[4], params[5])


def gradients(params: list[np.ndarray], x: np.ndarray, mask: np.ndarray, y: np.ndarray) -> list[np.ndarray]:
    """Of the mean cross-entropy over all positions."""
    n_h, (n_t, n_b) = params[1].shape[1], x.shape
    grus = [(Gru(params[0], params[1]), range(n_t)), (Gru(params[2], params[3]), range(n_t - 1, -1, -1))]
    states, kept = [], []
    for gru, order in grus:
        h = np.zeros((n_h, n_b), np.float32)
        out, tape = np.empty((n_t, n_h, n_b), np.float32), [None] * n_t
        for t in order:
            z, r, n, gn = gru.step(x[t], h)
            tape[t] = (h, z, r, n, gn)
            h = out[t] = (n + z * (h - n)) * mask[t]
        states.append(out)
        kept.append(tape)
    both = np.concatenate(states, axis=1)
    logits = np.matmul(params[4], both) + params[5][:, None]
    logits -= logits.max(axis=1, keepdims=True)
    p = np.exp(logits)
    p /= p.sum(axis=1, keepdims=True)
    p[:, y, np.arange(n_b)] -= 1
    p *= (mask / mask.sum())[:, None, :]
    d_out = np.einsum("tyb,thb->yh", p, both, optimize=True)
    d_both = np.matmul(params[4].T, p)
    grads: list[np.ndarray] = []
    for k, (gru, order) in enumerate(grus):
        d_h = np.zeros((n_h, n_b), np.float32)
        d_state = np.zeros_like(gru.state)
        d_a = np.empty((n_t, 3 * n_h, n_b), np.float32)
        for t in reversed(order):
            h, z, r, n, gn = kept[k][t]
            d = (d_both[t, k * n_h:(k + 1) * n_h] + d_h) * mask[t]
            d_n = d * (1 - z) * (1 - n * n)
            d_z = d * (h - n) * z * (1 - z)
            d_r = d_n * gn * r * (1 - r)
            d_a[t] = np.concatenate([d_z, d_r, d_n])
            d_g = np.concatenate([d_z, d_r, d_n * r])
            d_state += d_g @ h.T
            d_h = d * z + gru.state.T @ d_g
        flat = x.ravel()
        d_bytes = np.stack([np.bincount(flat, d_a[:, f].ravel(), 256) for f in range(3 * n_h)]).astype(np.float32)
        grads += [d_bytes, d_state]
    return [*grads, d_out, p.sum(axis=(0, 2))]


def _sampled(batches):
    """Texts to a few windows each, spread evenly over the whole text."""
    for batch in batches:
        data, offsets = string_bytes(batch.column("text"))
        start, length, text = windows(data, offsets)
        first = np.searchsorted(text, np.arange(batch.num_rows + 1))
        out, lang = [], []
        for i, name in enumerate(batch.column("lang").to_pylist()):
            n = first[i + 1] - first[i]
            for j in np.unique(np.linspace(0, n - 1, min(n, SAMPLE_WINDOWS)).astype(int)) if n else []:
                k = first[i] + j
                out.append(data[start[k]:start[k] + length[k]].tobytes())
                lang.append(name)
        yield pa.RecordBatch.from_pydict({"lang": pa.array(lang, pa.string()), "bytes": pa.array(out, pa.binary())})


def train(docs: DataFrame) -> Model | None:
    """A model from ``docs`` (doc_id, text, lang); None without a labelled text.

    Every language that labels a text is learned. The fit takes a bounded sample: of each
    language about ``SAMPLE_PER_LANGUAGE`` documents (picked by a hash of id and text, one at
    least), fewer when there are more than ``SAMPLE_DOCUMENTS`` in all, and of each
    ``SAMPLE_WINDOWS`` windows of ``WINDOW`` bytes.
    """
    named = docs.where("lang is not null and text is not null and text <> ''")
    lot = F.pmod(F.xxhash64("doc_id", F.octet_length("text")), F.lit(1 << 30))
    counts = materialize(named.groupBy("lang").agg(F.count("*").alias("count"), F.min(lot).alias("least")), "gru-languages")
    each = max(LEAST_PER_LANGUAGE, min(SAMPLE_PER_LANGUAGE, SAMPLE_DOCUMENTS // max(1, counts.count())))
    share = broadcast_if_bounded(counts)
    draw = (lot * F.col("count") < (1 << 30) * each) | (lot == F.col("least"))
    rows = named.join(share, "lang").where(draw).select("lang", "text").mapInArrow(_sampled, "lang string, bytes binary").toPandas()
    if not len(rows):
        return None
    rows = rows.sort_values(["lang", "bytes"])
    languages = sorted(rows["lang"].unique())
    length = rows["bytes"].map(len).to_numpy()
    data = np.frombuffer(b"".join(rows["bytes"]), np.uint8)
    x, mask = taken(data, np.cumsum(length) - length, length)
    y = rows["lang"].map({v: i for i, v in enumerate(languages)}).to_numpy()
    return fit(x, np.ones(x.shape, np.float32) if mask is None else mask, y, languages)


def _predicted(shared, keep_text: bool) -> Callable:
    def run(batches):
        names, f_bytes, f_state, b_bytes, b_state, out, bias = shared.value
        model = Model(names, Gru(f_bytes, f_state), Gru(b_bytes, b_state), out, bias)
        side = at_once(SIDE_BY_SIDE, len(model.languages))
        for batch in batches:
            passed = [n for n in batch.schema.names if n != "text" or keep_text]
            row = 0
            for data, offsets in text_slices(batch.column("text")):
                texts = len(offsets) - 1
                start, length, text = windows(data, offsets)
                total = np.zeros((len(model.languages), texts))
                full = length == WINDOW
                for some in (np.flatnonzero(full), np.flatnonzero(~full)):
                    for at in range(0, len(some), side):
                        pick = some[at:at + side]
                        x, mask = taken(data, start[pick], length[pick])
                        p = model.probabilities(x, mask).sum(axis=0)
                        for k in range(len(p)):
                            total[k] += np.bincount(text[pick], p[k], texts)
                total /= np.maximum(1, np.diff(offsets))
                best = total.argmax(axis=0)
                score = np.clip(total[best, np.arange(texts)], 0, 1)
                part = batch.slice(row, texts)
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in passed), pa.array([model.languages[k] for k in best], pa.string()), pa.array(score)],
                                                 names=[*passed, "lang_pred", "score"])
                row += texts
    return lean(run)


def identify(docs: DataFrame, model: Model | None, text_col: str = "text", keep_text: bool = False) -> DataFrame:
    """``docs`` with (lang_pred, score): the language of the whole text and its probability.

    A null text, and one without a letter, is ``und`` with score 0, as are all texts when
    there is no model. Rows that repeat, and all other columns, stay as they are, unless
    named lang_pred or score; the text stays if ``keep_text``. An empty table gives no rows.
    """
    text = F.col(f"`{text_col}`")
    names = [c for c in docs.columns if c not in ("lang_pred", "score") and (keep_text or c != text_col)]
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in names], F.lit(UNDETERMINED).alias("lang_pred"), F.lit(0.0).alias("score"))
    known = F.coalesce(text.rlike(r"\p{L}"), F.lit(False))
    # Under plain names on the way through Python; the text goes there once.
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names) if c != text_col], known.alias("known"), text.cast("string").alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.languages, model.forward.bytes, model.forward.state, model.backward.bytes, model.backward.state, model.out, model.bias))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in plain.schema if f.name != "text" or keep_text)
    out = plain.mapInArrow(_predicted(shared, keep_text), f"{schema}, lang_pred string, score double")
    back = [F.col("text").alias(c) if c == text_col else F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    return out.select(*back, F.when(F.col("known"), F.col("lang_pred")).otherwise(UNDETERMINED).alias("lang_pred"),
                      F.when(F.col("known"), F.col("score")).otherwise(0.0).alias("score"))


def held_out(doc_id: Column) -> Column:
    """Documents that are never learned from: crc32 of the id as text divisible by 5. An id of null is not one."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op3_byte_gru(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learned from those not held out."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = train(docs.where(F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))))
    return identify(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text"), model)
