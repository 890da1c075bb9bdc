"""N-gram Jaccard join by multiple-global-order prefix filtering.

Two sets with Jaccard similarity of at least t share a token among the first
p = n - ceil(t n) + 1 tokens of each, whatever order all tokens are put in, so long as it is
one order for all sets. Candidates here must share such prefix tokens under three orders.

The first order finds them. It is set by what the corpus holds: tokens whose hash falls in a
fixed lowest range come first, of these the ones in a single text, then the others by the
number of texts; tokens beyond the range follow by hash. A text therefore sends only its
lowest-hashed tokens (a third more than p) to be counted, and most texts end there: with p
tokens of their own they have no partner. The two other orders, by other hashes, are checked
on the candidates before full sets are compared.

Texts with equal sets form one class and are compared once. Each shared prefix token names the
class that shares most as its hub. Classes are compared with their hubs first. What stays in
another component than its hub is compared with all classes of that hub, in blocks that answer
with a spanning forest: no list of all pairs is ever made.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sunset_engine.llm.common import connected_components, lean, mix, shingle_sets, table, text_slices, word_hashes
from sunset_engine.operators.joins import broadcast_if_bounded, materialize

# Documents whose ids may be broadcast (8 bytes each) to pick candidates' texts without moving texts.
BROADCAST_IDS = 1_000_000
# A block of a hub's classes: tokens of their sets, and classes.
BLOCK_TOKENS = 500_000
BLOCK_ROWS = 2048
# Bytes of text whose sets are made together, and passed on.
SLICE_BYTES = 1 << 19
ORDER_SALTS = np.array([0x5BE0CD19137E2179, 0x243F6A8885A308D3], np.uint64)
SIGN = np.uint64(1 << 63)


def prefix_length(n: int, percent: int) -> int:
    return n - (percent * n + 99) // 100 + 1


def range_end(percent: int) -> int:
    """End of the hash range that comes first: it holds a third more tokens of a set than its prefix has."""
    return min((1 << 64) - 1, (100 - percent) * (1 << 64) // 75)


def class_of(tokens: np.ndarray) -> int:
    """63-bit id of a shingle set."""
    return int.from_bytes(hashlib.blake2b(tokens.tobytes(), digest_size=8).digest(), "little") >> 1


def signed(tokens: np.ndarray) -> np.ndarray:
    """As signed numbers in the same order."""
    return (tokens ^ SIGN).view(np.int64)


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[pa.RecordBatch, Iterator[np.ndarray]]]:
    """Slices of a batch, and the sets of each."""
    at = 0
    for data, offsets in text_slices(batch.column("text"), SLICE_BYTES):
        n = len(offsets) - 1
        yield batch.slice(at, n), shingle_sets(*word_hashes(data, offsets), k)
        at += n


def _facts(k: int, percent: int) -> Callable:
    """Documents to their classes, and to the tokens that each class (once a batch) sends to be counted."""
    end = np.uint64(range_end(percent))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, cls, first = [], [], []
            seen: set[int] = set()
            for _, sets in _sets(batch, k):
                sent: dict[int, np.ndarray] = {}
                for tokens in sets:
                    c = class_of(tokens) if len(tokens) else None
                    low = int(np.searchsorted(tokens, end))
                    n.append(len(tokens))
                    cls.append(c)
                    first.append(low)
                    if c is not None and c not in seen:
                        seen.add(c)
                        sent[c] = signed(tokens[:max(low, prefix_length(len(tokens), percent))])
                tokens = np.concatenate([np.zeros(0, np.int64), *sent.values()])
                t = len(tokens)
                yield pa.RecordBatch.from_pydict({
                    "doc_id": pa.nulls(t, pa.int64()), "text_hash": pa.nulls(t, pa.int64()), "n": pa.nulls(t, pa.int64()),
                    "cls": pa.array(np.repeat(np.fromiter(sent, np.int64, len(sent)), [len(x) for x in sent.values()])),
                    "low": pa.nulls(t, pa.int64()), "token": pa.array(tokens)})
            # Side by side, so that the file's reader passes over the tokens when only documents are asked for.
            yield pa.RecordBatch.from_pydict({
                "doc_id": batch.column("doc_id"), "text_hash": batch.column("text_hash"), "n": pa.array(n, pa.int64()), "cls": pa.array(cls, pa.int64()),
                "low": pa.array(first, pa.int64()), "token": pa.nulls(len(n), pa.int64())})
    return lean(run)


def prefix(tokens: np.ndarray, order: int, percent: int) -> np.ndarray:
    """The prefix under one of the orders by other hashes, as 32-bit tokens: enough for a filter."""
    p = prefix_length(len(tokens), percent)
    ranks = mix(tokens ^ ORDER_SALTS[order])
    return (tokens[np.argpartition(ranks, p - 1)[:p]] if p < len(tokens) else tokens).astype(np.uint32).view(np.int32)


def _fetched(k: int, percent: int) -> Callable:
    """Rows (cls, text) to (cls, n, the prefixes of the other orders, all tokens)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in (x for batch in batches for x in _sets(batch, k)):
            cls: list[int] = []
            out: list[list[np.ndarray]] = [[], [], []]
            for wanted, tokens in zip(part.column("cls").to_pylist(), sets, strict=True):
                if len(tokens) and class_of(tokens) == wanted:
                    cls.append(wanted)
                    for held, x in zip(out, (prefix(tokens, 0, percent), prefix(tokens, 1, percent), tokens.view(np.int64)), strict=True):
                        held.append(x)
            if cls:
                lists = [pa.ListArray.from_arrays(pa.array(np.append(0, np.cumsum([len(x) for x in held])), pa.int32()), pa.array(np.concatenate(held))) for held in out]
                yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array([len(x) for x in out[2]], pa.int64()), *lists], names=["cls", "n", "p1", "p2", "tokens"])
    return lean(run)


def _star(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b), those whose sets reach the similarity: sizes, then the other orders, then the sets."""
    def both(left: DataFrame, names: tuple[str, ...]) -> DataFrame:
        for c in ("a", "b"):
            left = left.join(sets.select(F.col("cls").alias(c), *[F.col(x).alias(f"{x}_{c}") for x in names]), c)
        return left

    sized = materialize(both(pairs, ("n",)).where(f"100 * least(n_a, n_b) >= {percent} * greatest(n_a, n_b)"), "ngram-sized")
    return (both(broadcast_if_bounded(sized, BROADCAST_IDS), ("p1", "p2", "tokens"))
            .where(F.arrays_overlap("p1_a", "p1_b") & F.arrays_overlap("p2_a", "p2_b"))
            .withColumn("common", F.size(F.array_intersect("tokens_a", "tokens_b")).cast("long"))
            .where(f"100 * common >= {percent} * (n_a + n_b - common)").select("a", "b"))


class _Index:
    """Counts of the tokens that a set has in common with each of many sets."""

    def __init__(self, sets: list[np.ndarray]):
        tokens = np.concatenate(sets) if sets else np.zeros(0, np.int64)
        by = np.argsort(tokens, kind="stable")
        self.tokens, self.owner, self.size = tokens[by], np.repeat(np.arange(len(sets)), [len(x) for x in sets])[by], len(sets)

    def common(self, tokens: np.ndarray) -> np.ndarray:
        low, high = np.searchsorted(self.tokens, tokens, "left"), np.searchsorted(self.tokens, tokens, "right")
        times = high - low
        at = np.repeat(low - np.append(0, np.cumsum(times))[:-1], times) + np.arange(times.sum())
        return np.bincount(self.owner[at], minlength=self.size)


def _compared(percent: int) -> Callable:
    def run(key: tuple, group: pa.Table) -> pa.Table:
        kind, i, j = (key[x].as_py() for x in (1, 2, 3))
        group = group.sort_by("cls").combine_chunks()
        cls, role, block, n = (group.column(c).to_numpy() for c in ("cls", "role", "block", "n"))
        lists = {c: [x.values.to_numpy() for x in group.column(c)] for c in ("p1", "p2", "tokens")}
        left = np.flatnonzero((role == 1) & (block == i))
        right = np.flatnonzero((role == kind) & (block == j))
        index = {c: _Index([lists[c][r] for r in right]) for c in lists}
        root = np.arange(len(cls))
        for a in left:
            fits = (100 * np.minimum(n[a], n[right]) >= percent * np.maximum(n[a], n[right])) & (right != a)
            for c in ("p1", "p2"):
                if fits.any():
                    fits &= index[c].common(lists[c][a]) > 0
            if fits.any():
                common = index["tokens"].common(lists["tokens"][a])
                for b in right[fits & (100 * common >= percent * (n[a] + n[right] - common))]:
                    x, y = a, b
                    while root[x] != x:
                        x = root[x]
                    while root[y] != y:
                        y = root[y]
                    root[max(x, y)] = min(x, y)
        while (root[root] != root).any():
            root = root[root]
        some = root != np.arange(len(cls))
        return pa.table({"a": pa.array(cls[some]), "b": pa.array(cls[root[some]])})
    return run


def _rest(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links of hubs' classes (cls, hub, role: 1 outside its hub's component, 0 inside) that have a class outside.

    Blocks of outsiders meet each other and the blocks of insiders.
    """
    of = sets.select("cls", "n")
    sizes = (members.join(of, "cls").groupBy("hub").agg(*[
        F.ceil(F.greatest(F.sum(F.when(F.col("role") == r, F.col("n")).otherwise(0)) / BLOCK_TOKENS, F.sum(F.when(F.col("role") == r, 1).otherwise(0)) / BLOCK_ROWS)).cast("int").alias(f"blocks{r}")
        for r in (0, 1)]).where("blocks1 > 0"))
    dealt = members.join(sizes, "hub").withColumn("block", F.expr("pmod(xxhash64(cls), if(role = 1, blocks1, blocks0))").cast("int"))
    steps = lambda n: F.filter(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda x: x < n)
    outside = F.concat(
        F.transform(steps(F.col("blocks1")), lambda o: F.struct(F.lit(1).alias("kind"), F.least("block", o).alias("i"), F.greatest("block", o).alias("j"))),
        F.transform(steps(F.col("blocks0")), lambda o: F.struct(F.lit(0).alias("kind"), F.col("block").alias("i"), o.alias("j"))))
    inside = F.transform(steps(F.col("blocks1")), lambda o: F.struct(F.lit(0).alias("kind"), o.alias("i"), F.col("block").alias("j")))
    dealt = dealt.withColumn("to", F.explode(F.when(F.col("role") == 1, outside).otherwise(inside)))
    dealt = materialize(dealt.select("hub", "to.kind", "to.i", "to.j", "cls", "role", "block"), "ngram-dealt")
    return (sets.join(broadcast_if_bounded(dealt, BROADCAST_IDS), "cls")
            .groupBy("hub", "kind", "i", "j").applyInArrow(_compared(percent), "a long, b long"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row (doc_id, n_shingles, component_id, text_hash) per document.

    Words are runs of anything but ASCII white space, A-Z lower-cased; a document's set has
    its distinct ``k``-word shingles, or its whole word sequence when it has fewer. Documents
    link when 100 * common >= ``percent`` * union. ``component_id`` is the smallest id
    reachable over links, the document's own included.

    Null, empty and blank texts have no shingles and link with nothing. Equal texts are one
    class and are never paired with each other. Rows that repeat an id count as one document
    and each get a row. A null id never names a component: such a row takes the component of
    its class, or null. An empty table gives no rows; other columns are not read. Sets are of
    64-bit hashes.
    """
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    facts = materialize(docs.withColumn("text_hash", F.xxhash64("text")).mapInArrow(_facts(k, percent), "doc_id long, text_hash long, n long, cls long, low long, token long"), "ngram-facts")
    documents, sent = facts.where("token is null"), facts.where("token is not null").select("token", "cls")
    classes = materialize(documents.where("cls is not null").groupBy("cls").agg(F.min("doc_id").alias("rep"), F.max("n").alias("n"), F.max("low").alias("low"))
                          .where("rep is not null"), "ngram-classes")

    # The first order. Only tokens of several classes matter from here on.
    shared = sent.groupBy("token").agg(F.min("cls").alias("lo"), F.max("cls").alias("hi")).where("lo <> hi").select("token")
    hits = materialize(sent.join(shared, "token").distinct(), "ngram-hits")
    ranged = F.col("token") < F.lit(range_end(percent) - (1 << 63))
    # Counts by token are written before they are joined: Spark can then split the rows of a hot token.
    seen = materialize(hits.groupBy("token").agg(F.count("*").alias("texts")), "ngram-seen")
    counted = hits.join(seen, "token").withColumn("ranged", ranged)
    room = (classes.join(hits.where(ranged).groupBy("cls").agg(F.count("*").alias("common")), "cls", "left")
            .select("cls", "n", F.expr(f"n - (({percent} * n + 99) div 100) + 1 - (low - coalesce(common, 0))").alias("room")).where("room > 0"))
    place = F.row_number().over(Window.partitionBy("cls", "ranged").orderBy("texts", "token"))
    first = materialize(counted.join(room, "cls").withColumn("place", place).where("not ranged or place <= room").select("token", "cls", "n"), "ngram-first")
    texts = materialize(first.groupBy("token").agg(F.count("*").alias("texts")).where("texts > 1"), "ngram-texts")
    lists = materialize(first.join(texts, "token"), "ngram-lists")
    weight = lists.groupBy("cls").agg((F.sum("texts") / F.max("n")).alias("weight"))
    hubs = materialize(lists.join(weight, "cls").groupBy("token").agg(F.max_by("cls", "weight").alias("hub")), "ngram-hubs")
    members = materialize(lists.select("token", "cls").join(hubs, "token").select("cls", "hub").distinct(), "ngram-members")

    wanted = materialize(members.select(F.explode(F.array("cls", "hub")).alias("cls")).distinct()
                         .join(classes, "cls").select(F.col("rep").alias("doc_id"), "cls"), "ngram-wanted")
    sets = materialize(docs.join(broadcast_if_bounded(wanted, BROADCAST_IDS), "doc_id").select("cls", "text")
                       .mapInArrow(_fetched(k, percent), "cls long, n long, p1 array<int>, p2 array<int>, tokens array<long>"), "ngram-sets")
    star = connected_components(_star(members.where("cls <> hub").select(F.col("cls").alias("a"), F.col("hub").alias("b")), sets, percent), "ngram-star")
    of = lambda c: star.select(F.col("id").alias(c), F.col("component_id").alias(f"of_{c}"))
    placed = members.unionAll(members.select(F.col("hub").alias("cls"), "hub")).distinct().join(of("cls"), "cls", "left").join(of("hub"), "hub", "left")
    roles = materialize(placed.select("cls", "hub", F.expr("if(coalesce(of_cls, cls) = coalesce(of_hub, hub), 0, 1)").alias("role")), "ngram-roles")
    links = star.select(F.col("id").alias("a"), F.col("component_id").alias("b")).unionAll(_rest(roles, sets, percent))
    rep = lambda c: classes.select(F.col("cls").alias(c), F.col("rep").alias(f"rep_{c}"))
    found = connected_components(links.join(rep("a"), "a").join(rep("b"), "b").select(F.col("rep_a").alias("a"), F.col("rep_b").alias("b")), "ngram-all")
    of_class = classes.join(found.withColumnRenamed("id", "rep"), "rep", "left").select("cls", "rep", "component_id")
    return (documents.join(of_class, "cls", "left")
            .select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "rep", "doc_id").alias("component_id"), "text_hash"))


def keep_one(docs: DataFrame, found: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One document of each component of ``found``: the one with the smallest id.

    Rows are told apart by id and text: one that repeats another stays once; of different texts
    under the kept id, which are alike, the one with the smallest hash stays. Rows without shingles, and rows without an id, all stay.
    """
    key = [id_col, "_hash"]
    told = found.select(F.col("doc_id").alias(id_col), F.col("text_hash").alias("_hash"), "n_shingles", "component_id").where(f"`{id_col}` is not null and n_shingles > 0")
    same = told.where(f"component_id = `{id_col}`")
    several = same.groupBy("component_id").agg(F.min("_hash").alias("least"), F.max("_hash").alias("most")).where("least <> most")
    gone = told.where(f"component_id <> `{id_col}`").select(*key).unionByName(same.join(several, "component_id").where("_hash <> least").select(*key)).distinct()
    again = told.groupBy(*key).count().where("count > 1").select(*key)
    # Within the bound on ids, texts are not moved; beyond it they are joined by id and hash.
    gone, again = (broadcast_if_bounded(materialize(ids, "ngram-ids"), BROADCAST_IDS) for ids in (gone, again))
    kept = docs.withColumn("_hash", F.xxhash64(F.col(f"`{text_col}`").cast("string"))).join(gone, key, "left_anti")
    once = kept.join(again, key, "left_semi").dropDuplicates(key)
    return kept.join(again, key, "left_anti").unionByName(once).select(*[F.col(f"`{c}`") for c in docs.columns])


def op2_ngram_jaccard(spark, sf_dir: str) -> DataFrame:
    """Documents of the corpus: 4-word shingles, similarity of 0.85 or more."""
    return near_duplicates(table(spark, sf_dir, "documents"), k=4, percent=85).drop("text_hash")


ORACLE = r"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (SELECT doc_id, CASE WHEN len(w) >= 4 THEN list_distinct([array_to_string(w[i:i + 3], ' ') FOR i IN generate_series(1, len(w) - 3)])
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words),
sizes AS (SELECT doc_id, len(s) AS n FROM sets),
tokens AS (SELECT doc_id, unnest(s) AS t FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM tokens a JOIN tokens b ON a.t = b.t AND a.doc_id < b.doc_id GROUP BY 1, 2),
pairs AS (SELECT a, b FROM common JOIN sizes x ON a = x.doc_id JOIN sizes y ON b = y.doc_id WHERE 100 * c >= 85 * (x.n + y.n - c)),
links AS (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reach AS (SELECT a, a AS b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a),
least AS (SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT doc_id, n AS n_shingles, coalesce(c, doc_id) AS component_id FROM sizes LEFT JOIN least ON doc_id = a
"""
