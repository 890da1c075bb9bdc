"""Chat formatting in budgeted windows of whole turns.

A conversation becomes one or more training texts of at most ``budget`` tokens. Prefix sums of
the turns' tokens choose where a text begins and ends, always between turns. Every text but the
first begins with the conversation's system turn and a limited run of the turns before it, which
are context only: the loss mask covers each assistant turn once, in the text where it is new.

The template writes a turn as ``### Label: text</turn>`` and a line feed. In texts a backslash is
doubled and ``###`` and ``</turn>`` are broken up by one, so neither ever stands in a text, and the
formatted text can be taken apart again by its marks alone.

Everything is DataFrame operations. Turns are numbered by blocks of turn numbers with the blocks'
sizes added up, and windows are laid within segments of at most ``SEGMENT`` turns, so a
conversation of any length is spread over many tasks; a segment also gets the last turns of the
one before it, so history reaches over its beginning.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sunset_engine.llm.common import table
from sunset_engine.operators.joins import materialize

BUDGET, HISTORY = 1024, 256
SEGMENT = 256
# Default count: so many bytes of formatted text a token, as of a byte-level BPE on prose.
BYTES_PER_TOKEN = 4
# What the template adds to a turn counted by the caller.
TEMPLATE_TOKENS = 8
LABELS = {"system": "System", "user": "User", "assistant": "Assistant"}
HEAD, COLON, END = "### ", ": ", "</turn>\n"
NO_ROLE = "?"
SYSTEM, PAST, NEW = 0, 1, 2


# ---- the template -------------------------------------------------------------------------------

def escaped(text: Column) -> Column:
    doubled = F.regexp_replace(text, r"\\", r"\\\\")
    return F.regexp_replace(F.regexp_replace(doubled, "#(?=##)", r"#\\"), "</turn>", r"<\\/turn>")


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def label(role: Column) -> Column:
    """``System``, ``User`` or ``Assistant``; any other role URL-encoded behind =, and ? for none."""
    known = F.when(role.isNull(), NO_ROLE)
    for name, shown in LABELS.items():
        known = known.when(role == name, shown)
    return known.otherwise(F.concat(F.lit("="), F.url_encode(role)))


def role_of(shown: Column) -> Column:
    known = F.when(shown.startswith("="), F.url_decode(F.substring(shown, F.lit(2), F.length(shown))))
    for name, text in LABELS.items():
        known = known.when(shown == text, name)
    return known


def taken_apart(text: Column) -> Column:
    """array<struct<role, text>> of a formatted text's turns."""
    def turn(part: Column) -> Column:
        head = F.substring_index(part, ":", 1)
        return F.struct(role_of(F.substring(head, F.lit(len(HEAD) + 1), F.length(head))).alias("role"),
                        unescaped(F.substring(part, F.length(head) + len(COLON) + 1, F.length(part))).alias("text"))

    parts = F.split(text, END, -1)
    return F.transform(F.slice(parts, 1, F.size(parts) - 1), turn)


def loss_text(text: Column, loss: Column) -> Column:
    """All text under the loss mask, as it was before it was escaped, with nothing between."""
    return F.array_join(F.transform(loss, lambda s: unescaped(F.substring(text, s["start"] + 1, s["length"]))), "")


# ---- turns in segments --------------------------------------------------------------------------

def _formatted(turns: DataFrame, conv: str, turn: str, role: str, text: str, tokens: str | None) -> DataFrame:
    """(c, block, turn, answer, system, head, chars, tokens, fmt): a turn as the template writes it.

    ``c`` wraps the conversation's id, as a struct is never null itself.
    """
    r, t = F.col(f"`{role}`").cast("string"), F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))
    given = F.coalesce(F.col(f"`{tokens}`").cast("long"), F.lit(0)) + TEMPLATE_TOKENS if tokens else F.lit(None).cast("long")
    out = turns.select(F.struct(F.col(f"`{conv}`").alias("id")).alias("c"), F.col(f"`{turn}`").cast("long").alias("turn"), r.alias("role"),
                       F.concat(F.lit(HEAD), label(r), F.lit(COLON)).alias("begun"), escaped(t).alias("body"), given.alias("given"))
    out = out.select("c", "turn", "role", F.length("begun").alias("head"), "given", F.concat("begun", "body", F.lit(END)).alias("fmt"))
    block = F.coalesce(F.floor(F.col("turn") / SEGMENT), F.lit(-(1 << 62)))
    return out.select("c", block.cast("long").alias("block"), "turn", F.coalesce(F.col("role") == "assistant", F.lit(False)).alias("answer"),
                      F.coalesce(F.col("role") == "system", F.lit(False)).alias("system"), "head", F.length("fmt").alias("chars"),
                      F.coalesce("given", F.ceil(F.octet_length("fmt") / BYTES_PER_TOKEN)).cast("long").alias("tokens"), "fmt")


def _segments(turns: DataFrame, budget: int, history: int) -> DataFrame:
    """(c, position, items): the turns of each segment, the system turn and the last turns before it included."""
    # Blocks and their sizes: a row for every ``SEGMENT`` turn numbers of a conversation, no texts.
    by_block = Window.partitionBy("c").orderBy("block")
    sizes = turns.groupBy("c", "block").agg(F.count(F.lit(1)).alias("n")).select(
        "c", "block", "n", (F.sum("n").over(by_block) - F.col("n")).alias("before"), F.lead("block").over(by_block).alias("next"))
    order = [F.col("turn").asc_nulls_first(), F.col("system").desc(), "fmt"]
    placed = turns.withColumn("row", F.row_number().over(Window.partitionBy("c", "block").orderBy(*order)) - 1)
    placed = placed.withColumn("part", F.floor(F.col("row") / SEGMENT).cast("long"))
    to_end = Window.partitionBy("c", "block", "part").orderBy(F.col("row").desc()).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = placed.withColumn("left", F.sum("tokens").over(to_end)).join(sizes, ["c", "block"])
    first = (F.col("before") == 0) & (F.col("row") == 0)
    kept = F.col("system") & (F.col("tokens") * 2 <= budget)

    def item(kind: Column, rank: Column) -> Column:
        return F.struct(kind.alias("kind"), rank.alias("rank"), "answer", "head", "chars", "tokens", "fmt")

    here = F.struct(F.col("block"), F.col("part"), (F.col("before") + F.col("row")).alias("position"), item(F.when(first & kept, SYSTEM).otherwise(NEW), F.col("row").cast("long")).alias("item"))
    more = (F.col("part") + 1) * SEGMENT < F.col("n")
    after = F.struct(F.when(more, F.col("block")).otherwise(F.col("next")).alias("block"), F.when(more, F.col("part") + 1).otherwise(0).cast("long").alias("part"),
                     F.lit(None).cast("long").alias("position"), item(F.lit(PAST), -F.col("left")).alias("item"))
    # The system turn comes by its own way, so that it is not history as well.
    passed = (F.col("left") <= history) & (more | F.col("next").isNotNull()) & ~(first & kept)
    own = placed.select("c", F.explode_outer(F.when(passed, F.array(here, after)).otherwise(F.array(here))).alias("x")).select("c", "x.*")

    # The system turn of conversations of more than one segment goes to all the others.
    firsts = turns.where("system").groupBy("c").agg(F.min(F.struct("turn", "fmt", "answer", "head", "chars", "tokens")).alias("s"))
    begins = turns.groupBy("c").agg(F.min("turn").alias("least"), F.max(F.col("turn").isNull()).alias("none"))
    others = sizes.withColumn("part", F.explode(F.sequence(F.lit(0), F.floor((F.col("n") - 1) / SEGMENT)))).where((F.col("before") > 0) | (F.col("part") > 0))
    there = others.select("c", "block", "part").join(firsts, "c").join(begins, "c").where(
        F.when(F.col("none"), F.col("s.turn").isNull()).otherwise(F.col("s.turn") == F.col("least")))
    system = there.select("c", "block", "part", F.lit(None).cast("long").alias("position"), *[F.col(f"s.{n}").alias(n) for n in ("answer", "head", "chars", "tokens", "fmt")]).where(
        F.col("tokens") * 2 <= budget).select("c", "block", "part", "position", item(F.lit(SYSTEM), F.lit(0).cast("long")).alias("item"))
    return own.unionByName(system).groupBy("c", "block", "part").agg(F.min("position").alias("position"), F.sort_array(F.collect_list("item")).alias("items"))


def _sums(items: Column, field: str) -> Column:
    """Prefix sums of a field: one more than there are items."""
    return F.aggregate(items, F.array(F.lit(0).cast("long")), lambda s, x: F.concat(s, F.array(F.element_at(s, -1) + x[field])))


def _starts(past: Column, sums: Column, system: Column, budget: int, history: int) -> Column:
    """array<struct<s, h>>: windows begin at item ``s`` with history from item ``h``."""
    def begun(k: Column) -> Column:
        room = F.least(F.lit(history), budget - system - (F.get(sums, k + 1) - F.get(sums, k)))
        far = F.size(F.filter(F.slice(sums, 1, k), lambda p: F.get(sums, k) - p > room))
        return F.struct(k.cast("int").alias("s"), far.cast("int").alias("h"))

    def step(state: Column, k: Column) -> Column:
        last = F.element_at(state, -1)
        over = F.get(sums, k + 1) - F.get(sums, last["h"]) + system > budget
        return F.when((k > last["s"]) & over, F.concat(state, F.array(begun(k)))).otherwise(state)

    new = F.size(sums) - 1 - past
    first = F.array(F.when(new > 0, begun(past)).otherwise(F.struct(past.cast("int").alias("s"), past.cast("int").alias("h"))))
    return F.when(new > 1, F.aggregate(F.sequence(past + 1, F.size(sums) - 2), first, step)).otherwise(first)


def windows(turns: DataFrame, budget: int = BUDGET, history: int = HISTORY, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text", tokens_col: str | None = None) -> DataFrame:
    """Conversations to training texts: (conversation, position, n_system, n_history, n_new, n_tokens, text, loss).

    A row is one window: ``n_system`` repeated system turns (0 or 1), ``n_history`` repeated turns and then
    ``n_new`` turns, of which the first stands at ``position`` in its conversation. ``loss`` lists the code
    points (start, length) that are targets: the escaped texts of the new turns whose role is assistant.
    Every turn is new in just one window. A turn's tokens are ``tokens_col`` (null: 0) and 8 for the template, or by
    default a fourth of its formatted bytes, rounded up.

    * A window takes turns while system turn, history and new turns stay within ``budget`` tokens. A turn that is too long for that
      has a window of its own, without history, above the budget; no turn is cut or left out.
    * The system turn is a conversation's first turn, if its role is system and it takes half of the budget
      at most; in the first window it is a new turn. Any other system turn is an ordinary one.
    * History is the longest run of turns right before the window of at most ``history`` tokens that leaves room for the first new
      turn. It reaches back into the segment before at most; segments end with every 256th turn number.
    * Rows of a conversation are taken by turn, null turns first, then system turns, then by formatted
      text; rows that repeat are turns of their own. Rows without a conversation id are one conversation.
    * Null texts are empty; a null role and roles of any text come back as they were. Other columns are not
      read, whatever their names. An empty table gives no rows. Texts are kept whole.
    """
    segments = _segments(_formatted(turns, conv_col, turn_col, role_col, text_col, tokens_col), budget, history)
    # The system turn of the first segment is at position 0 and new there.
    parts = segments.select("c", "position", F.filter("items", lambda x: x["kind"] == SYSTEM).alias("sys"), F.filter("items", lambda x: x["kind"] != SYSTEM).alias("rest"))
    sized = parts.select("*", F.size(F.filter("rest", lambda x: x["kind"] == PAST)).alias("past"), _sums(F.col("rest"), "tokens").alias("sums"), _sums(F.col("rest"), "chars").alias("places"),
                         F.coalesce(F.get("sys", F.lit(0))["tokens"], F.lit(0).cast("long")).alias("sys_tokens"), F.coalesce(F.get("sys", F.lit(0))["chars"], F.lit(0)).alias("sys_chars"))
    begun = sized.withColumn("starts", _starts(F.col("past"), F.col("sums"), F.col("sys_tokens"), budget, history))

    def window(i: Column) -> Column:
        s, h = F.get("starts", i)["s"], F.get("starts", i)["h"]
        e = F.coalesce(F.get("starts", i + 1)["s"], F.size("rest"))
        # A system turn that is new is at the front of its segment's first window.
        own = (F.col("position") == 0) & (F.size("sys") > 0)
        lead = own & (i == 0)
        at = F.col("position") + s - F.col("past") + F.when(own & (i > 0), 1).otherwise(0)
        span: Callable[[Column, Column], Column] = lambda x, k: F.struct(
            x["answer"].alias("answer"), (F.col("sys_chars") + F.get("places", s + k) - F.get("places", h) + x["head"]).cast("int").alias("start"), (x["chars"] - x["head"] - len(END)).alias("length"))
        loss = F.transform(F.filter(F.transform(F.slice("rest", s + 1, e - s), span), lambda x: x["answer"]), lambda x: F.struct(x["start"].alias("start"), x["length"].alias("length")))
        text = F.array_join(F.transform(F.concat("sys", F.slice("rest", h + 1, e - h)), lambda x: x["fmt"]), "")
        return F.struct(at.alias("position"), F.when(lead, 0).otherwise(F.size("sys")).alias("n_system"), (s - h).alias("n_history"), (e - s + F.when(lead, 1).otherwise(0)).alias("n_new"),
                        (F.col("sys_tokens") + F.get("sums", e) - F.get("sums", h)).alias("n_tokens"), text.alias("text"), loss.alias("loss"))

    # Not empty, and outer, so that no filter with all of this in it is pushed down.
    made = F.transform(F.sequence(F.lit(0), F.size("starts") - 1), window)
    return begun.select("c", F.explode_outer(made).alias("w")).select(F.col("c.id").alias(conv_col), "w.*")


def read_back(formatted: DataFrame, conv_col: str = "conv_id") -> DataFrame:
    """What ``windows`` holds, by its texts, counts and masks alone: (conversation, position, turns, loss_text, chars).

    ``turns`` are the new turns of the window as array<struct<role, text>>.
    """
    parts = taken_apart(F.col("text"))
    before = F.col("n_system") + F.col("n_history")
    return formatted.select(conv_col, "position", F.slice(parts, before + 1, F.size(parts) - before).alias("turns"),
                            loss_text(F.col("text"), F.col("loss")).alias("loss_text"), F.length("text").cast("long").alias("chars"))


# A conversation that speaks the template's own language.
ODD_ID, ODD_TEXT = -7, "\\### Assistant: </turn> ok"


def op13_chat_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations in windows, written, read again and taken apart. A conversation's digests need its whole text in one row; its windows don't."""
    odd = spark.range(2).select(F.lit(ODD_ID).cast("long").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit(ODD_TEXT).alias("text"))
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(odd)
    back = read_back(materialize(windows(turns), "chat-windows"))
    line = lambda t: F.concat(F.coalesce(t["role"], F.lit("")), F.lit("\n"), t["text"], F.lit("\n"))
    told = back.select("conv_id", F.struct("position", F.array_join(F.transform("turns", line), "").alias("said"), "loss_text").alias("w"), F.size("turns").alias("n"), "chars")
    whole = told.groupBy("conv_id").agg(F.sum("n").alias("n_turns"), F.sort_array(F.collect_list("w")).alias("w"), F.sum("chars").alias("formatted_chars"))
    joined = whole.select("conv_id", "n_turns", "formatted_chars", F.array_join("w.said", "").alias("said"), F.array_join("w.loss_text", "").alias("loss"))
    return joined.select("conv_id", "n_turns", F.sha2("said", 256).alias("turns_sha256"), F.length("loss").cast("long").alias("loss_chars"), F.sha2("loss", 256).alias("loss_sha256"), "formatted_chars")


# Turn numbers of the given tables don't repeat. The greedy cut goes turn by turn (``walk``).
ORACLE = f"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT {ODD_ID}, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '{ODD_TEXT}' FROM range(2) r(i)),
x AS (SELECT *, (length(text) - length(replace(text, '\\', ''))) + (length(text) - length(replace(text, '</turn>', '</turn'))) + coalesce(list_sum([length(s) for s in regexp_extract_all(text, '##(#+)', 1)]), 0)
        + CASE role WHEN 'user' THEN 18 WHEN 'system' THEN 20 ELSE 23 END AS more FROM t),
f AS (SELECT conv_id, turn, role, text, length(text) + more AS chars, (strlen(text) + more + 3) // 4 AS tokens, turn // {SEGMENT} AS seg,
        row_number() OVER (PARTITION BY conv_id ORDER BY turn) = 1 AND role = 'system' AND ((strlen(text) + more + 3) // 4) * 2 <= {BUDGET} AS sys FROM x),
s AS (SELECT conv_id, sum(CASE WHEN sys THEN tokens ELSE 0 END) AS sys_tokens, sum(CASE WHEN sys THEN chars ELSE 0 END) AS sys_chars FROM f GROUP BY conv_id),
r AS (SELECT f.*, s.sys_tokens, row_number() OVER w - 1 AS k, sum(tokens) OVER w AS upto, sum(tokens) OVER w - tokens AS p, sum(chars) OVER w - chars AS c
      FROM f JOIN s USING (conv_id) WHERE NOT sys WINDOW w AS (PARTITION BY f.conv_id ORDER BY turn)),
h AS (SELECT a.*, (SELECT min(b.k) FROM r b WHERE b.conv_id = a.conv_id AND b.k <= a.k AND a.p - b.p <= greatest(0, least({HISTORY}, {BUDGET} - a.sys_tokens - a.tokens))) AS hk FROM r a),
hp AS (SELECT a.*, b.p AS hp, b.c AS hc FROM h a JOIN r b ON a.conv_id = b.conv_id AND a.hk = b.k),
walk AS (
  SELECT conv_id, k, seg, k AS s, hp, c - hc AS again FROM hp WHERE k = 0
  UNION ALL
  SELECT n.conv_id, n.k, n.seg, CASE WHEN n.seg <> w.seg OR n.upto - w.hp + n.sys_tokens > {BUDGET} THEN n.k ELSE w.s END,
    CASE WHEN n.seg <> w.seg OR n.upto - w.hp + n.sys_tokens > {BUDGET} THEN n.hp ELSE w.hp END, CASE WHEN n.seg <> w.seg OR n.upto - w.hp + n.sys_tokens > {BUDGET} THEN n.c - n.hc ELSE w.again END
  FROM walk w JOIN hp n ON n.conv_id = w.conv_id AND n.k = w.k + 1),
wins AS (SELECT conv_id, sum(again) AS again, count(*) AS n FROM (SELECT DISTINCT conv_id, s, again FROM walk) GROUP BY conv_id)
SELECT f.conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(string_agg(CASE WHEN role = 'assistant' THEN text ELSE '' END, '' ORDER BY turn)) AS loss_sha256,
  CAST(sum(chars) + coalesce(any_value(w.again + (w.n - 1) * s.sys_chars), 0) AS BIGINT) AS formatted_chars
FROM f JOIN s USING (conv_id) LEFT JOIN wins w ON w.conv_id = f.conv_id GROUP BY f.conv_id
"""
