"""Fill-in-the-middle transformation with a sparse index of multibyte characters.

A text's cuts are wanted in code points and made in bytes. Only characters of more than one
byte make the two differ, so a run of texts keeps one sorted list of those characters: their
byte positions and how many bytes over one they have taken up to there. A binary search in that list
turns a byte offset into a code-point offset or back; everything between two listed
characters is ASCII, where both advance together. Texts are cut where they lie in Arrow's
buffers, a run of a few megabytes at a time, and no text is decoded.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.llm.common import lean, table, text_slices

PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
SEED = 7
# Of 100 texts so many are transformed, and so many of those with the suffix first.
FIM_PERCENT, SPM_PERCENT = 100, 50
DRAWS = 4
LINE_FEED = 10


@dataclass
class Exceptions:
    """The characters of more than one byte in some UTF-8 bytes: where they begin and the excess bytes up to and with each."""

    at: np.ndarray
    excess: np.ndarray

    @classmethod
    def of(cls, data: np.ndarray) -> Exceptions:
        at = np.flatnonzero(data >= 0xC0)
        lead = data[at]
        return cls(at, np.append(0, np.cumsum(1 + (lead >= 0xE0) + (lead >= 0xF0), dtype=np.int64)))

    def points(self, cuts: np.ndarray) -> np.ndarray:
        """Code points before byte offsets that lie between characters."""
        return cuts - self.excess[np.searchsorted(self.at, cuts)]

    def bytes(self, cuts: np.ndarray) -> np.ndarray:
        """Byte offsets behind so many code points."""
        return cuts + self.excess[np.searchsorted(self.at - self.excess[:-1], cuts)]


def _line_cuts(data: np.ndarray, begin: np.ndarray, end: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(lines, first cut, second cut) of each text; lines end behind a line feed or with the text."""
    feeds = np.flatnonzero(data == LINE_FEED)
    first = np.searchsorted(feeds, begin)
    whole = np.searchsorted(feeds, end) - first
    open_ = (end > begin) & (data[np.maximum(end - 1, 0)] != LINE_FEED) if len(data) else np.zeros(len(begin), bool)
    lines = whole + open_
    chosen = np.sort(draws[:, :2] % (lines + 1)[:, None], axis=1)

    def place(k: np.ndarray) -> np.ndarray:
        """Behind the k-th line."""
        known = np.append(feeds + 1, 0)[np.minimum(first + np.maximum(k, 1) - 1, len(feeds))]
        return np.where(k == 0, begin, np.where(k <= whole, known, end))

    return lines, place(chosen[:, 0]), place(chosen[:, 1])


def _char_cuts(index: Exceptions, begin: np.ndarray, end: np.ndarray, draws: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(characters, first cut, second cut) of each text."""
    start = index.points(begin)
    chars = index.points(end) - start
    chosen = np.sort(draws[:, :2] % (chars + 1)[:, None], axis=1)
    return chars, index.bytes(start + chosen[:, 0]), index.bytes(start + chosen[:, 1])


SCHEMA = "n long, form string, prefix_chars long, middle_chars long, output string"
NAMES = ("n", "form", "prefix_chars", "middle_chars", "output")


def _transformed(data: np.ndarray, offsets: np.ndarray, draws: np.ndarray, unit: str, percent: int, spm: int) -> list[pa.Array]:
    """Columns ``NAMES`` of a run of texts."""
    begin, end = offsets[:-1], offsets[1:]
    index = Exceptions.of(data)
    n, one, two = (_line_cuts(data, begin, end, draws) if unit == "line" else _char_cuts(index, begin, end, draws))
    points = [index.points(x) for x in (begin, one, two)]
    raw = data.tobytes()
    marks = [m.encode() for m in (PREFIX, SUFFIX, MIDDLE)]
    has = np.zeros(len(begin), bool)
    for mark in marks:
        at = raw.find(mark)
        while at >= 0:
            row = np.searchsorted(offsets, at, "right") - 1
            has[row] |= at + len(mark) <= offsets[row + 1]      # else it is made of two texts' ends
            at = raw.find(mark, at + 1)
    plain = (begin == end) | has | (draws[:, 2] % 100 >= percent)
    form = np.where(plain, 0, np.where(draws[:, 3] % 100 < spm, 2, 1))
    view = memoryview(raw)
    pieces: list[bytes | memoryview] = []
    p, s, m = marks
    for kind, a, b, c, d in zip(form.tolist(), begin.tolist(), one.tolist(), two.tolist(), end.tolist(), strict=True):
        if kind == 0:
            pieces.append(view[a:d])
        elif kind == 1:
            pieces += (p, view[a:b], s, view[c:d], m, view[b:c])
        else:
            pieces += (s, view[c:d], p, view[a:b], m, view[b:c])
    size = (end - begin) + np.where(plain, 0, sum(map(len, marks)))
    places = np.append(0, np.cumsum(size))
    output = pa.LargeStringArray.from_buffers(len(begin), pa.py_buffer(places.astype(np.int64)), pa.py_buffer(b"".join(pieces)))
    return [pa.array(n.astype(np.int64)), pa.array(np.array(["plain", "psm", "spm"])[form]), pa.array(points[1] - points[0], pa.int64(), mask=plain),
            pa.array(points[2] - points[1], pa.int64(), mask=plain), output.cast(pa.string())]


def _runs(unit: str, percent: int, spm: int, text: str, draw: str) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            draws = np.stack([batch.column(f"{draw}{i}").to_numpy(zero_copy_only=False) for i in range(DRAWS)], axis=1)
            rest = [c for c in batch.schema.names if c != text and not c.startswith(draw)]
            at = 0
            for data, offsets in text_slices(batch.column(text)):
                to = at + len(offsets) - 1
                part = batch.slice(at, to - at)
                made = _transformed(data, offsets, draws[at:to], unit, percent, spm)
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in rest), *made], names=[*rest, *NAMES])
                at = to
    return lean(run)


def draws(id_: Column, seed: int = SEED) -> list[Column]:
    """The first four 32-bit numbers of the SHA-256 of ``seed:id`` (a null id: empty)."""
    text = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(id_.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(text, 1 + 8 * i, 8), 16, 10).cast("long") for i in range(DRAWS)]


def transform(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", unit: str = "line", seed: int = SEED,
              fim_percent: int = FIM_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``docs`` without ``text_col`` and with (n, form, prefix_chars, middle_chars, output).

    A text is cut twice between its ``unit``s, of which it has ``n``: lines with their line feed, or
    code points (``unit="char"``). The places and the form follow from the seed and the id alone, so a
    retried task gives the same. Forms: ``psm`` <P>prefix<S>suffix<M>middle, ``spm`` <S>suffix<P>prefix<M>middle, ``plain`` the text as it is.

    Plain are null and empty texts (both give an empty output), texts that hold one of the three marks, and a share of
    100 - ``fim_percent``; their prefix_chars and middle_chars are null. Rows that repeat, and rows
    without an id, are transformed like any other. All other columns pass through, but columns of the five
    new names, which are replaced. An empty table gives no rows. A text is read whole, whatever its length.
    """
    if unit not in ("line", "char"):
        raise ValueError("unit must be line or char")
    kept = [c for c in docs.columns if c not in (text_col, *NAMES)]
    text, draw = "text", "draw"
    while any(c == text or c.startswith(draw) for c in kept):
        text, draw = f"_{text}", f"_{draw}"
    given = docs.select(*[F.col(f"`{c}`") for c in kept], F.col(f"`{text_col}`").cast("string").alias(text),
                        *[c.alias(f"{draw}{i}") for i, c in enumerate(draws(F.col(f"`{id_col}`"), seed))])
    rest = "".join(f"`{c}` {t}, " for c, t in given.dtypes if c in kept)
    return given.mapInArrow(_runs(unit, fim_percent, spm_percent, text, draw), rest + SCHEMA)


def restored(output: Column, form: Column) -> Column:
    """The text that ``transform`` was given, from its output and form alone (null texts come back empty)."""
    parts = F.split(output, f"{PREFIX}|{SUFFIX}|{MIDDLE}", -1)          # a text with a mark of its own is plain
    return (F.when(form == "psm", F.concat(F.get(parts, F.lit(1)), F.get(parts, F.lit(3)), F.get(parts, F.lit(2))))
            .when(form == "spm", F.concat(F.get(parts, F.lit(2)), F.get(parts, F.lit(3)), F.get(parts, F.lit(1)))).otherwise(output))


def op11_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents cut at lines, with digests of the output and of the text rebuilt from it."""
    made = transform(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"),
                       F.sha2(restored(F.col("output"), F.col("form")), 256).alias("restored_sha256"))


_PLACES = ", ".join(f"CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT) AS h{i + 1}" for i in range(DRAWS))
ORACLE = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, sha256('{SEED}:' || doc_id) AS h FROM documents),
u AS (SELECT doc_id, t, {_PLACES}, regexp_extract_all(t, '[^\\n]*\\n|[^\\n]+') AS l FROM d),
c AS (SELECT *, len(l) AS n, least(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS a, greatest(h1 % (len(l) + 1), h2 % (len(l) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= {FIM_PERCENT} THEN 'plain'
       WHEN h4 % 100 < {SPM_PERCENT} THEN 'spm' ELSE 'psm' END AS form FROM u),
p AS (SELECT doc_id, n, t, form, array_to_string(l[1:a], '') AS pre, array_to_string(l[a + 1:b], '') AS mid, array_to_string(l[b + 1:n], '') AS suf FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM p
"""
