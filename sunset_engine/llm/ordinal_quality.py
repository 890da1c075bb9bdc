"""Quality by ordinal cumulative-link regression on graded ratings.

A text has one score, the sum of weights of its hashed words, beginnings of words and runs of
marks (present or not) and of a few bins of its shape: shares of capitals, digits, marks and spaces, word length, number
of words, and how many of them are different. Ordered thresholds cut the score into grades:
P(grade >= j) = 1 / (1 + exp(threshold_j - score)), with the same weights for all grades.
The expected grade ranks texts; the probability of the upper grades selects them.

Weights and thresholds are fitted in numpy on a bounded sample of rated texts, weighted
back to the grades' shares; rating reads whole texts.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.llm.common import NOT_ALNUM, distinct, lean, lean_memory, table, text_slices, word_hashes

BITS = 22
# Beginnings of words, in bytes, that count as features besides whole words.
PREFIXES = (4, 5)
BINS = 16
SHAPES = 8
# The fit: rated texts per grade (about). A feature has a weight if its share of some grade is so many standard
# errors off the grade's share; the many words that say nothing would add up over long texts.
SAMPLE_PER_GRADE = 3000
LEAST_DEVIATION = 4.0
EPOCHS = 12
BATCH = 64
# Small samples are passed over more often, up to so many steps.
LEAST_STEPS = 2000
RATE = 0.15
DECAY = 2e-5
SEED = 5
# Bytes of text whose features are taken together, and passed on.
SLICE_BYTES = 1 << 19
# Selection: probability of the upper grade.
KEEP = 0.5


def _classes() -> np.ndarray:
    kind = np.full(256, 4, np.uint8)               # other marks
    kind[[9, 10, 11, 12, 13, 32]] = 0
    kind[65:91], kind[97:123], kind[48:58], kind[128:] = 1, 2, 3, 2
    return kind


_KIND = _classes()
_NOT_MARK = _KIND != 4
# Counted together, each in its half of a 64-bit sum: white space and capitals, digits and marks, line feeds.
_PAIRS = [(_KIND == a).astype(np.uint64) | (_KIND == b).astype(np.uint64) << np.uint64(32) for a, b in ((0, 1), (3, 4))]
_PAIRS.append((np.arange(256) == 10).astype(np.uint64))


def features(data: np.ndarray, offsets: np.ndarray, used: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers of all texts, ascending and distinct within each, and the offsets of the texts.

    ``used`` marks the features that matter: hashed ones that it does not mark are left out early.
    """
    n = len(offsets) - 1
    hashed, first, *begun = word_hashes(data, offsets, NOT_ALNUM, PREFIXES)
    words = np.diff(first)
    row = np.repeat(np.arange(n), words) << BITS
    marks, first_mark = word_hashes(data, offsets, _NOT_MARK)
    mark_row = np.repeat(np.arange(n), np.diff(first_mark)) << BITS
    bucket = lambda h: (h >> np.uint64(64 - BITS)).astype(np.int64)
    whole = distinct(row | bucket(hashed))
    different = np.bincount(whole >> BITS, minlength=n)
    keys = [whole if used is None else whole[used[whole & ((1 << BITS) - 1)]]]
    for r, h in (*((row, b) for b in begun), (mark_row, marks)):
        number = bucket(h)
        matters = slice(None) if used is None else used[number]
        keys.append(r[matters] | number[matters])
    key = distinct(np.concatenate(keys))
    text = key >> BITS
    size = np.maximum(1, np.diff(offsets))
    counts = [np.diff(np.append(np.uint64(0), np.cumsum(pair[data], dtype=np.uint64))[offsets]) for pair in _PAIRS]
    low, high = np.uint64((1 << 32) - 1), np.uint64(32)
    share = [c / size for c in (counts[0] & low, counts[0] >> high, counts[1] & low, counts[1] >> high)]
    lines = counts[2] & low
    shape = [*(np.sqrt(s) for s in share), np.log2(1 + words) / 16, different / np.maximum(1, words), size / np.maximum(1, words) / 24, lines / np.maximum(1, words)]
    bins = np.stack([np.clip((s * BINS).astype(np.int64), 0, BINS - 1) + (1 << BITS) + i * BINS for i, s in enumerate(shape)], axis=1)
    ends = np.searchsorted(text, np.arange(n + 1))
    values = np.empty(len(key) + bins.size, np.int64)
    offsets = ends + SHAPES * np.arange(n + 1)
    is_shape = np.zeros(len(values), bool)
    is_shape[(offsets[1:, None] - SHAPES + np.arange(SHAPES)).ravel()] = True
    values[is_shape] = bins.ravel()
    values[~is_shape] = key & ((1 << BITS) - 1)
    return values, offsets


@dataclass
class Model:
    weights: np.ndarray           # by feature number
    thresholds: np.ndarray        # ascending, one fewer than grades

    def tails(self, values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """P(grade >= j) for j = 1, 2, ...: one row per text."""
        sums = np.append(0, np.cumsum(self.weights[values], dtype=np.float64))
        score = sums[offsets[1:]] - sums[offsets[:-1]]
        return 1 / (1 + np.exp(np.clip(self.thresholds - score[:, None], -500, 500)))


def fit(values: np.ndarray, offsets: np.ndarray, grade: np.ndarray, weight: np.ndarray, grades: int) -> Model:
    """Weighted maximum likelihood by Adagrad; gaps between thresholds are kept positive."""
    rng = np.random.default_rng(SEED)
    names = distinct(values)
    index = np.searchsorted(names, values).astype(np.int32)
    texts = np.bincount(index, minlength=len(names))
    share = np.bincount(grade, minlength=grades) / len(grade)
    of = np.repeat(grade.astype(np.int8), np.diff(offsets))
    found = np.stack([np.bincount(index[of == g], minlength=len(names)) for g in range(grades)])
    error = np.sqrt(np.maximum(1e-12, texts * (share * (1 - share))[:, None]))
    used = (np.abs(found - texts * share[:, None]) / error).max(axis=0) >= LEAST_DEVIATION
    w, sq = np.zeros(len(names)), np.full(len(names), 1e-3)
    theta = np.linspace(-1.0, 1.0, grades - 1) if grades > 2 else np.zeros(1)
    theta_sq = np.full(grades - 1, 1e-3)
    size = np.diff(offsets)
    weight = weight / weight.mean()
    for _ in range(max(EPOCHS, -(-LEAST_STEPS * BATCH // max(1, len(grade))))):
        order = rng.permutation(len(grade))
        for at in range(0, len(order), BATCH):
            pick = order[at:at + BATCH]
            row = np.repeat(np.arange(len(pick)), size[pick])
            x = index[np.repeat(offsets[pick] - np.append(0, np.cumsum(size[pick]))[:-1], size[pick]) + np.arange(len(row))]
            score = np.bincount(row, w[x], len(pick))
            cut = np.concatenate([[-np.inf], theta, [np.inf]])
            with np.errstate(over="ignore"):
                high, low = (1 / (1 + np.exp(score - cut[grade[pick] + d])) for d in (1, 0))
            each = weight[pick] / len(pick)
            g = np.bincount(x, (each * (1 - high - low))[row], len(w)) + DECAY * w
            g[~used] = 0
            sq += g * g
            w -= RATE * g / np.sqrt(sq)
            p = np.maximum(high - low, 1e-9)
            g_theta = np.zeros(grades + 1)
            np.add.at(g_theta, grade[pick] + 1, -each * high * (1 - high) / p)
            np.add.at(g_theta, grade[pick], each * low * (1 - low) / p)
            theta_sq += g_theta[1:-1] ** 2
            theta = theta - RATE * g_theta[1:-1] / np.sqrt(theta_sq)
            theta = np.maximum.accumulate(theta + 1e-3 * np.arange(len(theta))) if (np.diff(theta) <= 0).any() else theta
    weights = np.zeros((1 << BITS) + SHAPES * BINS, np.float32)
    weights[names[used]] = w[used]
    return Model(weights, theta)


def _sampled(batches):
    lean_memory()
    for batch in batches:
        at = 0
        for data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
            values, ends = features(data, offsets)
            n = len(offsets) - 1
            yield pa.RecordBatch.from_pydict({"grade": batch.column("grade").slice(at, n),
                                              "features": pa.array([values[a:b].astype("<i4").tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.binary())})
            at += n


def train(docs: DataFrame, ratings: DataFrame, grades: int) -> Model | None:
    """A model from texts (doc_id, text) and ratings (doc_id, grade from 0 to ``grades`` - 1).

    Of each grade about ``SAMPLE_PER_GRADE`` texts are taken, picked by a hash. A document with
    several ratings has the lowest. None without texts of at least two grades.
    """
    rated = ratings.where(F.col("grade").between(0, grades - 1) & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.min("grade").cast("int").alias("grade"))
    counts = {r[0]: r[1] for r in rated.groupBy("grade").count().collect()}            # one row per grade
    if len(counts) < 2:
        return None
    draw = F.lit(False)
    for g, c in counts.items():
        draw = draw | ((F.col("grade") == g) & (F.pmod(F.xxhash64("doc_id", F.lit(SEED)), F.lit(1 << 30)) * F.lit(c) < F.lit((1 << 30) * SAMPLE_PER_GRADE)))
    picked = rated.where(draw)                                                        # about SAMPLE_PER_GRADE * grades rows
    rows = docs.where("text <> ''").join(F.broadcast(picked), "doc_id").select("grade", "text").mapInArrow(_sampled, "grade int, features binary").toPandas()
    if rows["grade"].nunique() < 2:
        return None
    rows = rows.sort_values(["grade", "features"])
    grade = rows["grade"].to_numpy()
    size = rows["features"].map(len).to_numpy() // 4
    values = np.frombuffer(b"".join(rows.pop("features")), "<i4")
    share = np.array([counts.get(g, 0) / max(1, (grade == g).sum()) for g in range(grades)])
    return fit(values, np.append(0, np.cumsum(size)), grade, share[grade], grades)


def _rated(shared, keep_text: bool) -> Callable:
    def run(batches):
        places, values, thresholds = shared.value
        model = Model(np.zeros((1 << BITS) + SHAPES * BINS, np.float32), thresholds)
        model.weights[places] = values
        used = model.weights != 0
        for batch in batches:
            passed = [n for n in batch.schema.names if n != "text" or keep_text]
            at = 0
            for data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
                tails = model.tails(*features(data, offsets, used))
                part = batch.slice(at, len(tails))
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in passed), pa.array(tails.sum(axis=1)), pa.array(tails[:, -1])],
                                                 names=[*passed, "expected_grade", "tail_prob"])
                at += len(tails)
    return lean(run)


def rate(docs: DataFrame, model: Model | None, text_col: str = "text", keep_text: bool = True) -> DataFrame:
    """``docs`` with (expected_grade, tail_prob): the mean grade and the chance of the highest.

    Null, empty and blank texts have 0 and 0. Without a model both are null. All rows and columns
    stay (the text unless ``keep_text`` is false), but for columns already named like the
    two; an empty table gives no rows.
    """
    text = F.col(f"`{text_col}`")
    names = [c for c in docs.columns if c not in ("expected_grade", "tail_prob") and (keep_text or c != text_col)]
    if model is None:
        return docs.select(*[F.col(f"`{c}`") for c in names], F.lit(None).cast("double").alias("expected_grade"), F.lit(None).cast("double").alias("tail_prob"))
    blank = F.coalesce(~text.rlike(r"[^\x20\x09-\x0D]"), F.lit(True))
    # Under plain names on the way through Python; the text goes there once.
    plain = docs.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)], blank.alias("blank"), text.cast("string").alias("text"))
    if keep_text:
        plain = plain.drop(f"c{names.index(text_col)}")
    places = np.flatnonzero(model.weights)
    shared = docs.sparkSession.sparkContext.broadcast((places, model.weights[places], model.thresholds))
    passed = [c for c in plain.columns if c != "text" or keep_text]
    schema = ", ".join(f"`{c}` {plain.schema[c].dataType.simpleString()}" for c in passed)
    out = plain.mapInArrow(_rated(shared, keep_text), f"{schema}, expected_grade double, tail_prob double")
    back = [F.col("text").alias(c) if keep_text and c == text_col else F.col(f"c{i}").alias(c) for i, c in enumerate(names)]
    value = lambda c: F.when(F.col("blank"), 0.0).otherwise(F.col(c)).alias(c)
    return out.select(*back, value("expected_grade"), value("tail_prob"))


def kept(keep: float = KEEP) -> Column:
    """Selection by the upper tail; everything is kept when there was no model."""
    return F.coalesce(F.col("tail_prob") >= keep, F.lit(True))


def ratings(labels: DataFrame) -> DataFrame:
    """Grades of labels: 0 toxic, 1 of low quality, 2 good; rows without both labels are left out."""
    return labels.where("quality is not null and toxic is not null").select(
        "doc_id", F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 0, 1).otherwise(2).alias("grade"))


def learned(spark: SparkSession, sf_dir: str, docs: DataFrame) -> Model | None:
    """A model from the labels of documents whose id's crc32 is not divisible by 5; the others are left for tests."""
    seen = ratings(table(spark, sf_dir, "labels")).where(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 != 0)
    return train(docs.select("doc_id", "text"), seen, 3)


def op6_ordinal_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's expected grade, chance of being good, and whether it is kept."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return rate(docs, learned(spark, sf_dir, docs), keep_text=False).select("doc_id", "expected_grade", "tail_prob", kept().alias("kept"))
