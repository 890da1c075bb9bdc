"""Personal data to format-preserving pseudonyms by keyed Feistel networks.

Numbers and dates that pass their checks are permuted within their own format: a card number
stays a card number with a right check digit, an address stays an address, a date a date. A
permutation under one key maps equal values to equal pseudonyms in every document, whatever
their separators, and different values to different ones.

Two networks are used. Numbers below a * b are split into two digits of those bases, and in
turn each is shifted by a keyed hash of the other. Strings are split in halves whose
letters and digits are shifted, each within its own class, by keyed hashes of the other
half; all other characters stay. Everything is column expressions; hashes are SHA-256.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sunset_engine.llm.common import table

ROUNDS = 8
KEY = "example key: pass your own"

# Formats in the order in which they are tried at a place.
# Repeated groups are possessive: the matcher then goes on in a loop, where a greedy group would call itself once a
# repetition and overflow the stack on long values.
LABEL = r"[A-Za-z0-9]++(?:-++[A-Za-z0-9]++)*+"
EMAIL = rf"(?<![\w.+%-])[A-Za-z0-9_][A-Za-z0-9._%+-]*+@{LABEL}(?:\.{LABEL})++"
CREDENTIAL = r"(?<![A-Za-z])(?i:pass(?:word|wd)|pwd|token|secret|api[_-]?key)[\"']?\s{0,3}[:=]\s{0,3}[\"']?[A-Za-z0-9_+/=.-]{6,}"
ACCESS_KEY = r"(?<![A-Za-z0-9])A(?:KIA|SIA)[A-Z0-9]{16}(?![A-Za-z0-9])"
DATE = r"(?<![\w.-])(?:\d{4}-\d{2}-\d{2}|\d{2}/\d{2}/\d{4}|\d{2}\.\d{2}\.\d{4})(?:(?=[Tt]\d{2})|(?![\w-]|\.\d))"
ADDRESS = r"(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d)"
SOCIAL = r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])"
CARD = r"(?<![\w-])\d(?:[ -]?\d){12,18}(?![\w-]*\w)"
PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?!\w)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d){7,12}(?!\w)"
NUMBERS = "|".join((DATE, ADDRESS, SOCIAL, PHONE))
VALUES = rf"{EMAIL}|{CREDENTIAL}|{ACCESS_KEY}|(?=[\d(+])(?:{NUMBERS})"
# Numbers in a row with 13 digits or more, what is attached before and behind them included: whatever
# begins in it ends in it, and no lookaround sees past its ends.
ROW = (r"(?:(?<![.+(-])[.+(-]++|(?<!\w))(?=\d(?:[ ./()+-]{0,3}\d){12})\d++(?:[ ./()+-]{1,3}+\d++)*+"
       rf"(?:(?!{CREDENTIAL}|{ACCESS_KEY})[\w.%+@-])*+")
FOUND = rf"{EMAIL}|{CREDENTIAL}|{ACCESS_KEY}|(?=[\d(+.-])(?:{ROW})|(?=[\d(+])(?:{NUMBERS})"
# Groups of digits in a card number: at most four of four digits or more, and a shorter one.
CARD_GROUPS = 5
FIRST_DAY = "1900-01-01"
# Days from FIRST_DAY: 270 * 271, up to 2100-05-01.
DAY_BASES = (270, 271)
SOCIAL_BASES = (898 * 99, 9999)


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with ``value`` computed once, however often ``then`` uses it."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def _hash(*parts: Column | str) -> Column:
    """A keyed 48-bit number of the parts."""
    text = F.concat_ws("|", *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])
    return F.conv(F.substring(F.sha2(text, 256), 1, 12), 16, 10).cast("long")


def permuted(x: Column, bases: tuple[int, int], key: str, kind: str) -> Column:
    """Keyed permutation of the numbers below the product of ``bases``."""
    a, b = bases
    start = F.struct(F.floor(x / b).cast("long").alias("l"), F.pmod(x, F.lit(b)).cast("long").alias("r"))

    def step(s: Column, i: Column) -> Column:
        left = F.pmod(s["l"] + _hash(key, kind, i, s["r"]), F.lit(a))
        right = F.pmod(s["r"] + _hash(key, kind, i, s["l"]), F.lit(b))
        return F.when(i % 2 == 1, F.struct(left.alias("l"), s["r"].alias("r"))).otherwise(F.struct(s["l"].alias("l"), right.alias("r")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: s["l"] * b + s["r"])


def _shifted(half: Column, key: str, kind: str, i: Column, other: Column) -> Column:
    """Each letter and digit of ``half`` moved within its class by its place and a keyed hash of ``other``, taken once."""
    seed = F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other), 256)

    def one(seed: Column) -> Callable[[Column, Column], Column]:
        def moved(c: Column, at: Column) -> Column:
            code, h = F.ascii(c), F.xxhash64(seed, at)
            move = lambda first, n: F.char(first + F.pmod(code - first + F.pmod(h, F.lit(n)), F.lit(n)))
            digit = code.between(48, 57)
            if kind == "hex":
                value = F.when(digit, code - 48).otherwise(code - 87)
                return F.when(digit | code.between(97, 102), F.lower(F.hex(F.pmod(value + F.pmod(h, F.lit(16)), F.lit(16))))).otherwise(c)
            return F.when(digit, move(48, 10)).when(code.between(65, 90), move(65, 26)).when(code.between(97, 122), move(97, 26)).otherwise(c)
        return moved

    return F.when(F.length(half) > 0, let(seed, lambda s: F.array_join(F.transform(F.split(half, ""), one(s)), ""))).otherwise("")


def scrambled(x: Column, key: str, kind: str) -> Column:
    """Keyed permutation of the strings that have their letters and digits in the same places."""
    middle = F.floor(F.length(x) / 2).cast("int")
    start = F.struct(F.substring(x, F.lit(1), middle).alias("l"), F.substring(x, middle + 1, F.length(x)).alias("r"))

    def step(s: Column, i: Column) -> Column:
        return F.when(i % 2 == 1, F.struct(_shifted(s["l"], key, kind, i, s["r"]).alias("l"), s["r"].alias("r"))).otherwise(
            F.struct(s["l"].alias("l"), _shifted(s["r"], key, kind, i, s["l"]).alias("r")))

    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))


def digits_of(x: Column) -> Column:
    return F.regexp_replace(x, r"\D", "")


def luhn_sum(digits: Column) -> Column:
    """Luhn sum of a digit string whose last digit is the check digit."""
    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), lambda s, i: s + F.when(
        (F.length(digits) - i) % 2 == 0, F.substring(digits, i, F.lit(1)).cast("int")).otherwise(
        F.substring(digits, i, F.lit(1)).cast("int") * 2 - F.when(F.substring(digits, i, F.lit(1)) > "4", 9).otherwise(0)))


def refilled(format_: Column, digits: Column) -> Column:
    """``format_`` with its digits replaced, one after another, by ``digits``."""
    def one(at: Column) -> Column:
        c = F.substring(format_, at, F.lit(1))
        nth = F.length(F.regexp_replace(F.substring(format_, F.lit(1), at), r"\D", ""))
        return F.when(c.between("0", "9"), F.substring(digits, nth, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(format_)), one), "")


def _email(m: Column, key: str) -> Column:
    return let(F.instr(m, "@"), lambda at: F.concat(scrambled(F.substring(m, F.lit(1), at - 1), key, "email"), F.substring(m, at, F.length(m))))


def _credential(m: Column, key: str) -> Column:
    lead = F.regexp_extract(m, r"^[^:=]*[:=]\s*[\"']?", 0)
    return let(F.substring(m, F.length(lead) + 1, F.length(m)), lambda secret: F.concat(
        lead, F.when(secret.rlike("^[0-9a-f]+$"), scrambled(secret, key, "hex")).otherwise(scrambled(secret, key, "secret"))))


def _card(m: Column, key: str) -> Column:
    def moved(digits: Column) -> Column:
        new = scrambled(F.substring(digits, F.lit(1), F.length(digits) - 1), key, "card")
        return let(new, lambda d: F.concat(d, F.pmod(10 - luhn_sum(F.concat(d, F.lit("0"))) % 10, F.lit(10)).cast("string")))

    return let(digits_of(m), lambda digits: F.when(luhn_sum(digits) % 10 == 0, let(moved(digits), lambda new: refilled(m, new))))


def _phone(m: Column, key: str) -> Column:
    """All digits but those of a country code, so that a number is one value with and without it."""
    country = F.regexp_extract(m, r"^\+(?:\d{1,3}(?=\D)|\d)", 0)
    return let(country, lambda c: let(F.substring(m, F.length(c) + 1, F.length(m)), lambda rest: let(
        scrambled(digits_of(rest), key, "phone"), lambda new: F.concat(c, refilled(rest, new)))))


def _address(m: Column, key: str) -> Column:
    def put(o: Column) -> Column:
        number = permuted(((o[0] * 256 + o[1]) * 256 + o[2]) * 256 + o[3], (65536, 65536), key, "address")
        return let(number, lambda n: F.concat_ws(".", *[F.pmod(F.floor(n / (1 << shift)), F.lit(256)).cast("string") for shift in (24, 16, 8, 0)]))

    return let(F.split(m, r"\.").cast("array<long>"), lambda o: F.when((o[0] < 256) & (o[1] < 256) & (o[2] < 256) & (o[3] < 256), put(o)))


def _social(m: Column, key: str) -> Column:
    def put(o: Column) -> Column:
        packed = ((o[0] - F.when(o[0] > 666, 2).otherwise(1)) * 99 + o[1] - 1) * 9999 + o[2] - 1
        return let(permuted(packed, SOCIAL_BASES, key, "social"), lambda n: let(F.floor(n / (99 * 9999)) + 1, lambda area: F.concat_ws(
            "-", F.lpad((area + F.when(area > 665, 1).otherwise(0)).cast("string"), 3, "0"),
            F.lpad((F.pmod(F.floor(n / 9999), F.lit(99)) + 1).cast("string"), 2, "0"), F.lpad((F.pmod(n, F.lit(9999)) + 1).cast("string"), 4, "0"))))

    return let(F.split(m, "-").cast("array<long>"), lambda o: F.when((o[0] > 0) & (o[0] != 666) & (o[0] < 900) & (o[1] > 0) & (o[2] > 0), put(o)))


def _date(m: Column, key: str) -> Column:
    def dated(form: str) -> Column:
        days = F.datediff(F.try_to_timestamp(m, F.lit(form)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        return let(days, lambda d: F.when(d.between(0, DAY_BASES[0] * DAY_BASES[1] - 1), F.date_format(
            F.date_add(F.lit(FIRST_DAY).cast("date"), permuted(d.cast("long"), DAY_BASES, key, "date").cast("int")), form)))

    return (F.when(m.contains("/"), F.coalesce(dated("dd/MM/yyyy"), dated("MM/dd/yyyy")))
            .when(m.contains("."), dated("dd.MM.yyyy")).otherwise(dated("yyyy-MM-dd")))


def _cards(groups: Column, between: Column) -> Column:
    """Card numbers among the ``groups`` of digits of a row, from left to right: (first, size) in groups.

    A card number is one group, or groups of four digits or more with single spaces or hyphens
    between and perhaps a shorter last one; the fewest groups that pass the check count.
    ``between`` has the text before each group and, last, the text behind them all.
    """
    before, behind = lambda i: F.get(between, i - 1), lambda i: F.get(between, i)
    size = lambda i: F.length(F.get(groups, i - 1))
    joined = lambda i: behind(i).rlike("^-+$")

    def fits(i: Column, k: Column) -> Column:
        last = i + k - 1
        long_ = F.forall(F.slice(groups, i, k - 1), lambda g: F.length(g) >= 4) & F.forall(F.slice(between, i + 1, k - 1), lambda s: s.isin(" ", "-"))
        year = (k > 1) & (size(i) == 4) & (size(i - 1) <= 2) & before(i).isin("/", ".") & (before(i - 1) == before(i))
        month = (k > 1) & (size(last) < 4) & behind(last).isin("/", ".")
        # A hyphen behind joins other numbers to it, but for a short last one such as a code.
        open_ = F.when(last < F.size(groups), ~joined(last) | ((size(last + 1) <= 3) & ~behind(last + 1).rlike(r"^[\w-]*[\w-]"))).otherwise(True)
        digits = F.array_join(F.slice(groups, i, k), "")
        return F.when((last <= F.size(groups)) & long_, F.when(F.length(digits).between(13, 19) & open_ & ~F.coalesce(year, F.lit(False)) & ~F.coalesce(month & (last < F.size(groups)), F.lit(False))
                      & ~before(i).rlike(r"[\w+-]$") & ~behind(last).rlike(r"^(?:[\w-]*\w|[\w.%+-]*@)"), luhn_sum(digits) % 10 == 0)).otherwise(False)

    def at(i: Column) -> Column:
        some = F.when(size(i) >= 4, F.get(F.filter(F.sequence(F.lit(1), F.lit(CARD_GROUPS)), lambda k: fits(i, k)), F.lit(0)))
        return F.struct(i.alias("first"), some.alias("size"))

    all_ = F.filter(F.transform(F.sequence(F.lit(1), F.size(groups)), at), lambda w: w["size"].isNotNull())
    start = F.struct(F.lit(0).alias("end"), F.array().cast("array<struct<first:int,size:int>>").alias("taken"))
    return F.aggregate(all_, start, lambda s, w: F.when(w["first"] > s["end"], F.struct(
        (w["first"] + w["size"] - 1).alias("end"), F.concat(s["taken"], F.array(w)).alias("taken"))).otherwise(s), lambda s: s["taken"])


def _total(parts: Column) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda n, p: n + p["n"])


def _changed(old: Column, new: Column) -> Column:
    """(text, n): ``new`` where it is not null, and 1 where it is another text than ``old``."""
    return let(F.coalesce(new, old), lambda t: F.struct(t.alias("text"), (t != old).cast("long").alias("n")))


def _scanned(text: Column, pattern: str, match: Callable[[Column], Column], gap: Callable[[Column], Column] | None = None) -> Column:
    """(text, n): matches of ``pattern`` in turn by ``match``, what is between them by ``gap``."""
    def put(found: Column, gaps: Column) -> Column:
        t = lambda g: g["text"] if gap else g
        n = _total(found) + _total(gaps) if gap else _total(found)
        return F.struct(F.array_join(F.zip_with(gaps, found, lambda g, m: F.concat(t(g), F.coalesce(m["text"], F.lit("")))), "").alias("text"), n.alias("n"))

    gaps = F.split(text, pattern, -1)
    return let(F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), 0), match), lambda found: let(
        F.transform(gaps, gap) if gap else gaps, lambda g: put(found, g)))


def _parts(m: Column) -> Column:
    """A row of numbers cut before and behind each of its card numbers. No other format is found in such a number."""
    def put(groups: Column, between: Column, cards: Column) -> Column:
        def cut(texts: Column) -> Column:
            joined = lambda first, n: F.array_join(F.slice(texts, first, n), "")

            def one(i: Column) -> Column:
                end = F.coalesce(F.get(cards, i - 1)["first"] + F.get(cards, i - 1)["size"] - 1, F.lit(0))
                first = F.coalesce(F.get(cards, i)["first"], F.size(groups) + 1)
                card = F.when(i < F.size(cards), joined(2 * first, 2 * F.get(cards, i)["size"] - 1)).otherwise("")
                return F.array(joined(2 * end + 1, 2 * (first - end) - 1), card)

            return F.flatten(F.transform(F.sequence(F.lit(0), F.size(cards)), one))

        return let(F.flatten(F.zip_with(between, groups, lambda s, g: F.array(s, F.coalesce(g, F.lit(""))))), cut)

    return let(F.regexp_extract_all(m, F.lit(r"(\d+)"), 1), lambda groups: let(F.split(m, r"\d+", -1), lambda between: let(
        _cards(groups, between), lambda cards: put(groups, between, cards))))


def _replaced(m: Column, key: str) -> Column:
    """(text, n) of a match of ``FOUND``: card numbers first, then the other formats, then what is a card number in any grouping."""
    def loose(text: Column) -> Column:
        return _scanned(text, CARD, lambda c: _changed(c, _card(c, key)))

    def rest(text: Column) -> Column:
        return _scanned(text, VALUES, lambda v: _changed(v, pseudonym(v, key)), loose)

    row = m.rlike(f"^(?!(?:{EMAIL}|{CREDENTIAL}|{ACCESS_KEY})$)(?:{ROW})$")
    return let(F.transform(F.when(row, _parts(m)).otherwise(F.array(m)), rest), lambda done: F.struct(
        F.array_join(F.transform(done, lambda d: d["text"]), "").alias("text"), _total(done).alias("n")))


def pseudonym(m: Column, key: str) -> Column:
    """The pseudonym of a match of ``VALUES``, or null where it fails its format's check."""
    whole = lambda p: m.rlike(f"^(?:{p})$")
    return (F.when(m.contains("@") & whole(EMAIL), _email(m, key)).when(whole(CREDENTIAL), _credential(m, key))
            .when(whole(ACCESS_KEY), F.concat(F.substring(m, 1, 4), scrambled(F.substring(m, 5, 16), key, "access")))
            .when(whole(DATE), _date(m, key)).when(whole(ADDRESS), _address(m, key)).when(whole(SOCIAL), _social(m, key)).when(whole(PHONE), _phone(m, key)))


def pseudonymize(docs: DataFrame, key: str = KEY, text_col: str = "text", count_col: str | None = None) -> DataFrame:
    """``docs`` with personal data in ``text_col`` replaced by pseudonyms; ``count_col`` adds the number of values replaced.

    Covered are e-mail addresses (the part before the @), credentials after words such as
    password or token, access keys, dates from 1900 to 2100-05-01 (yyyy-mm-dd, dd/mm/yyyy
    or else mm/dd/yyyy, dd.mm.yyyy; the date of an ISO timestamp too), IPv4 addresses, social
    security numbers, card numbers of 13 to 19 digits with a right check digit, and phone
    numbers. What fails its format's check stays as it is. A permutation may map a value to
    itself, a short one more likely.

    Other numbers may stand before and behind a value. Among several numbers in a row, a card
    number is one group of digits or groups of four digits or more and a shorter last one; in
    any other grouping it is found only as the longest row of digits left by the other formats.
    A hyphen makes one number of two, but for one of up to three digits behind a card number.
    Where two readings overlap and both pass the check, the one on the left counts.

    Null texts stay null, empty texts empty; every row stays, repeated ones included, and
    all other columns pass through, whatever their names. An empty table gives no rows.
    """
    text = F.col(f"`{text_col}`")

    done = F.when(text.rlike(FOUND), _scanned(text, FOUND, lambda m: _replaced(m, key)))
    temporary = "_done"
    while temporary in docs.columns:
        temporary += "_"
    out = docs.withColumn(temporary, done)
    new = {text_col: F.coalesce(F.col(temporary)["text"], text)}
    if count_col:
        new[count_col] = F.coalesce(F.col(temporary)["n"], F.lit(0).cast("long"))
    return out.withColumns(new).drop(temporary)


def op8_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its pseudonymised text and the number of values replaced."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pseudonymize(docs, count_col="n_replaced").select("doc_id", "n_replaced", "text")
