"""URL filtering by rules and by the ratio of two character language models.

Rules allow or block a host with its subdomains under a path; the longest that fits wins.
URLs that a rule decides train two variable-order Markov models over characters, one of
allowed and one of blocked URLs. A model mixes all orders from 0 up: the counts of the longest context
are added to the shorter context's distribution with a fixed weight, so contexts seen often speak for
themselves and rare ones fall back. A URL that no rule fits is judged by the difference of
its log-likelihoods per character, against a threshold calibrated on rule-decided URLs
that the models did not see.

Everything is DataFrame operations. The score of a character depends on its gram (it and
the characters before it), so each distinct gram is scored once and joined to the URLs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.llm.common import table
from sunset_engine.operators.joins import broadcast_if_bounded, materialize

RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
ORDER = 4
# Weight, in characters, of the shorter context's distribution.
PRIOR = 2.0
# Chance of a character at order 0 before any is seen.
BASE = 1.0 / 256
# Grams whose scores may be broadcast: some 40 bytes each.
BROADCAST_GRAMS = 1_000_000
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# First hex digits of a URL's MD5 that keep it for calibration.
CALIBRATION = ("0", "1", "2")


def host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without one."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring(_url, instr(_url, '://') + 3)")).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)


def split_url(df: DataFrame, url_col: str) -> DataFrame:
    """Adds host and path."""
    rest = "CASE WHEN instr(_url, '://') > 0 THEN substring(_url, instr(_url, '://') + 3) ELSE '' END"
    return (df.withColumn("_url", F.col(url_col)).withColumn("_rest", F.expr(rest))
            .withColumn("host", host(F.col("_url")))
            .withColumn("path", F.regexp_extract("_rest", r"^[^/?#]*([^?#]*)", 1)).drop("_url", "_rest"))


def judged_by_rules(df: DataFrame, rules=RULES) -> DataFrame:
    """Adds rule (the longest that fits host and path, else null) and ruled (its verdict)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for text, decision in sorted(rules, key=lambda r: len(r[0])):
        name, path = text[:text.index("/")], text[text.index("/"):]
        fits = ((F.col("host") == name) | F.col("host").endswith("." + name)) & F.col("path").startswith(path)
        rule = F.when(fits, text).otherwise(rule)
        verdict = F.when(fits, decision).otherwise(verdict)
    return df.withColumn("rule", rule).withColumn("ruled", verdict)


def _grams(urls: DataFrame, keep: list[str]) -> DataFrame:
    """One row per character: the gram of it and the ``ORDER`` characters before it; begin and end are marked."""
    padded = F.concat(F.lit("\x02" * ORDER), F.col("url"), F.lit("\x03"))
    return urls.select(*keep, F.explode(F.transform(F.sequence(F.lit(1), F.length("url") + 1), lambda i: F.substring(padded, i, F.lit(ORDER + 1)))).alias("gram"))


def _scores(train: DataFrame, grams: DataFrame) -> DataFrame:
    """Rows (gram, llr): log-likelihood of the gram's last character as allowed less as blocked."""
    sums = [F.sum(F.when(F.col("ruled") == v, F.col("n")).otherwise(0)).alias(c) for v, c in (("allow", "a"), ("block", "b"))]
    counted = materialize(_grams(train, ["ruled"]).groupBy("gram", "ruled").agg(F.count("*").alias("n")), "url-grams")
    lengths = F.explode(F.sequence(F.lit(1), F.lit(ORDER + 1))).alias("k")
    ends = counted.select("ruled", "n", "gram", lengths).withColumn("s", F.expr("right(gram, k)"))
    seen = ends.groupBy("s").agg(*sums)
    context = ends.where("k > 1").withColumn("s", F.expr("left(s, k - 1)")).groupBy("s", "k").agg(*sums)
    asked = grams.select("gram", lengths).withColumn("s", F.expr("right(gram, k)")).withColumn("c", F.expr("left(s, k - 1)"))
    known = asked.join(seen, "s", "left")
    # The empty context is one row for all grams: a scalar, not a join key.
    total = counted.agg(*sums).select(F.struct("a", "b").alias("t")).scalar()
    longer = known.where("k > 1").join(context.select(F.col("s").alias("c"), F.col("k"), F.col("a").alias("ca"), F.col("b").alias("cb")), ["c", "k"], "left")
    joined = longer.unionByName(known.where("k = 1").withColumns({"ca": total.getField("a"), "cb": total.getField("b")}))
    orders = range(1, ORDER + 2)
    wide = joined.groupBy("gram").agg(*[F.coalesce(F.max(F.when(F.col("k") == k, F.col(c))), F.lit(0)).alias(f"{c}{k}") for k in orders for c in ("a", "b", "ca", "cb")])
    chance = {}
    for c in ("a", "b"):
        p = F.lit(BASE)
        for k in orders:
            p = (F.col(f"{c}{k}") + F.lit(PRIOR) * p) / (F.col(f"c{c}{k}") + F.lit(PRIOR))
        chance[c] = p
    return wide.select("gram", (F.log(chance["a"]) - F.log(chance["b"])).alias("llr"))


def filter_urls(pages: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row (page_id, host, path, rule, verdict, score) per row of ``pages``.

    ``verdict`` is the rule's, or without one the models': allow when the URL's mean
    log-likelihood difference (``score``, null where a rule decides) is at least the
    threshold. A null URL, or one without ``://``, has empty host and path; a null or empty
    URL has no evidence against it and is allowed. Where rules allow or block nothing, there
    is no contrast, scores count for nothing and the rest is allowed. Rows that repeat are
    judged alike; a null id is carried through; other columns are not read; an empty table
    gives no rows. URLs are told apart by a 64-bit hash while they are scored.
    """
    rows = judged_by_rules(split_url(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url")), "url"), rules)
    rows = rows.withColumn("uid", F.xxhash64("url"))
    urls = materialize(rows.where("url <> ''").groupBy("uid").agg(F.first("url").alias("url"), F.first("ruled").alias("ruled"))
                       .withColumn("held", F.substring(F.md5("url"), 1, 1).isin(*CALIBRATION)), "url-distinct")
    judged = materialize(_grams(urls.where("ruled is null or held"), ["uid", "ruled"]), "url-judged")
    llr = materialize(_scores(urls.where("ruled is not null and not held"), judged.select("gram").distinct()), "url-scores")
    # Beginnings like http:// are in every URL. Within the bound, grams are not shuffled; beyond it Spark splits such keys' rows.
    scored = materialize(judged.join(broadcast_if_bounded(llr, BROADCAST_GRAMS), "gram").groupBy("uid").agg(F.avg("llr").alias("score"), F.first("ruled").alias("held_as")), "url-scored")
    t = threshold(scored)
    found = rows.join(scored.where("held_as is null").select("uid", "score"), "uid", "left")
    verdict = F.coalesce("ruled", F.when(F.col("score") < F.lit(t), "block").otherwise("allow")) if t is not None else F.coalesce("ruled", F.lit("allow"))
    return found.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.when(F.col("ruled").isNull(), F.col("score")).alias("score"))


def threshold(scored: DataFrame) -> float | None:
    """Between the means of held-out allowed and blocked URLs, as many deviations from either; None without both."""
    m = scored.agg(*[f(F.when(F.col("held_as") == v, F.col("score"))).alias(f"{n}_{v}") for v in ("allow", "block") for n, f in (("mean", F.avg), ("dev", F.stddev_pop))]).first()
    if m.mean_allow is None or m.mean_block is None:
        return None
    wide = m.dev_allow + m.dev_block
    return (m.mean_allow * m.dev_block + m.mean_block * m.dev_allow) / wide if wide else (m.mean_allow + m.mean_block) / 2


def op9_url_model_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's URL."""
    return filter_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def oracle() -> str:
    """The same in DuckDB SQL."""
    rules = sorted(RULES, key=lambda r: -len(r[0]))
    fits = lambda t: f"((host = '{t[:t.index('/')]}' OR ends_with(host, '.{t[:t.index('/')]}')) AND starts_with(path, '{t[t.index('/'):]}'))"
    chance = {}
    for c in "ab":
        p = repr(BASE)
        for k in range(1, ORDER + 2):
            p = f"((coalesce(max(CASE WHEN k = {k} THEN {c} END), 0) + {PRIOR} * {p}) / (coalesce(max(CASE WHEN k = {k} THEN c{c} END), 0) + {PRIOR}))"
        chance[c] = p
    return f"""
WITH raw AS (SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
parts AS (SELECT page_id, url, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM raw),
ruled AS (SELECT *, CASE {' '.join(f"WHEN {fits(t)} THEN '{t}'" for t, _ in rules)} END AS rule, CASE {' '.join(f"WHEN {fits(t)} THEN '{v}'" for t, v in rules)} END AS ruled FROM parts),
urls AS (SELECT DISTINCT url, ruled, substr(md5(url), 1, 1) IN {CALIBRATION} AS held FROM ruled WHERE url <> ''),
grams AS (SELECT url, ruled, held, substr(repeat(chr(2), {ORDER}) || url || chr(3), unnest(generate_series(1, length(url) + 1)), {ORDER + 1}) AS gram FROM urls),
ends AS (SELECT ruled, right(gram, k) AS s, k FROM grams, (SELECT unnest(generate_series(1, {ORDER + 1})) AS k) WHERE ruled IS NOT NULL AND NOT held),
seen AS (SELECT s, count(*) FILTER (WHERE ruled = 'allow') AS a, count(*) FILTER (WHERE ruled = 'block') AS b FROM ends GROUP BY s),
context AS (SELECT left(s, k - 1) AS c, k, count(*) FILTER (WHERE ruled = 'allow') AS ca, count(*) FILTER (WHERE ruled = 'block') AS cb FROM ends GROUP BY ALL),
asked AS (SELECT gram, right(gram, k) AS s, left(right(gram, k), k - 1) AS c, k FROM (SELECT DISTINCT gram FROM grams), (SELECT unnest(generate_series(1, {ORDER + 1})) AS k)),
llr AS (SELECT gram, ln({chance['a']}) - ln({chance['b']}) AS llr FROM asked LEFT JOIN seen USING (s) LEFT JOIN context USING (c, k) GROUP BY gram),
scored AS (SELECT url, any_value(ruled) AS held_as, avg(llr) AS score FROM grams JOIN llr USING (gram) WHERE ruled IS NULL OR held GROUP BY url),
m AS (SELECT avg(score) FILTER (WHERE held_as = 'allow') AS ma, avg(score) FILTER (WHERE held_as = 'block') AS mb,
  stddev_pop(score) FILTER (WHERE held_as = 'allow') AS da, stddev_pop(score) FILTER (WHERE held_as = 'block') AS db FROM scored),
t AS (SELECT CASE WHEN da + db > 0 THEN (ma * db + mb * da) / (da + db) ELSE (ma + mb) / 2 END AS t FROM m)
SELECT page_id, host, path, rule, coalesce(ruled, CASE WHEN s.score < t.t THEN 'block' ELSE 'allow' END) AS verdict
FROM (SELECT page_id, url, coalesce(host, '') AS host, coalesce(path, '') AS path, rule, ruled FROM ruled) r LEFT JOIN (SELECT * FROM scored WHERE held_as IS NULL) s USING (url), t
"""
