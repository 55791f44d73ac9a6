"""Format-preserving pseudonyms; DataFrame functions only.

Numbers and dates that pass the checks of their format are permuted inside it by
a keyed Feistel network: a card number becomes another valid card number, a
date another date. It is a permutation, so equal values get equal pseudonyms in every
document and different values stay different, without any table of values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cytospark.llm.tables import col
from cytospark.llm.texts import fresh

#: Formats, in the order in which they are tried at a place.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])",
    "date": r"(?<![0-9-])[0-9]{4}[-/][0-9]{2}[-/][0-9]{2}(?![0-9-])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "phone": (r"\+[0-9]{1,3} \([0-9]{3}\) [0-9]{3}-[0-9]{4}(?![0-9])"
              r"|(?<![0-9A-Za-z+])\+(?=(?:[ .-]?[0-9]){8})[0-9]{1,3}[ .-][0-9]{1,4}(?:[ .-][0-9]{2,4}){1,4}(?![0-9])"
              r"|(?<![0-9A-Za-z+])\+[0-9]{10,15}(?![0-9])"
              r"|(?<![0-9A-Za-z])\([0-9]{3}\) ?[0-9]{3}[ .-][0-9]{4}(?![0-9])"
              r"|(?<![0-9A-Za-z.+-])(?:1[ .-])?(?:[0-9]{3}-[0-9]{3}-[0-9]{4}|[0-9]{3}\.[0-9]{3}\.[0-9]{4})(?![0-9A-Za-z]|[.-][0-9])"),
}
#: A run of numbers, a space or a dash apart, of 13 digits or more, up to a value of another format. Cards are found inside it.
PATTERNS["card"] = (r"(?<![0-9A-Za-z])(?=[0-9](?:[ -]?[0-9]){12})[0-9]++(?![A-Za-z])(?:[ -](?!"
                    + "|".join(PATTERNS[k] for k in ("ip", "date", "ssn", "phone")) + r")[0-9]++(?![A-Za-z])){0,63}+")
#: Groups of digits in which cards are written, longest first, and their digits.
GROUPINGS = {"4,4,4,4,3,": 19, "4,4,4,4,": 16, "4,6,5,": 15, "4,6,4,": 14}
ROUNDS = 8
#: Dates from here on, so many days: 250 x 292.
FIRST_DAY, DAY_LEFT, DAY_RIGHT = "1900-01-01", 250, 292


def feistel(left: Column, right: Column, left_size: Column, right_size: Column, key: str, context: str,
            rounds: int = ROUNDS, inverse: bool = False) -> Column:
    """Struct (l, r): a keyed permutation of the pairs 0 <= l < left_size, 0 <= r < right_size."""
    def shift(i: Column, x: Column, other: Column, size: Column) -> Column:
        word = F.sha2(F.concat_ws("|", F.lit(key), F.lit(context), i, left_size, right_size, other), 256)
        step = F.conv(F.substring(word, 1, 15), 16, 10).cast("bigint") % size
        return (x + (size - step if inverse else step)) % size

    def turn(acc: Column, i: Column) -> Column:
        even = F.struct(shift(i, acc["l"], acc["r"], left_size).alias("l"), acc["r"].alias("r"))
        odd = F.struct(acc["l"].alias("l"), shift(i, acc["r"], acc["l"], right_size).alias("r"))
        return F.when(i % 2 == 0, even).otherwise(odd)

    order = F.sequence(F.lit(rounds - 1), F.lit(0), F.lit(-1)) if inverse else F.sequence(F.lit(0), F.lit(rounds - 1))
    start = F.struct(left.cast("bigint").alias("l"), right.cast("bigint").alias("r"))
    return F.aggregate(order, start, turn)


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def _tens(n: Column) -> Column:
    return F.pow(F.lit(10), n).cast("bigint")


def _permuted_digits(digits: Column, key: str, context: str, inverse: bool) -> Column:
    """A digit string of up to 18 digits, permuted among those of its length."""
    n = F.length(digits)
    half = (n / 2).cast("int")
    parts = feistel(F.substring(digits, F.lit(1), half), F.substring(digits, half + 1, n - half), _tens(half), _tens(n - half), key,
                    context, inverse=inverse)
    return F.transform(F.array(parts), lambda p: F.concat(F.lpad(p["l"].cast("string"), half, "0"),
                                                          F.lpad(p["r"].cast("string"), n - half, "0")))[0]


def luhn_sum(digits: Column, doubled: int) -> Column:
    """Luhn sum from the last digit on; every second digit, from place ``doubled`` (0: the last), counts twice."""
    each = F.transform(F.split(F.reverse(digits), ""), lambda d, i: F.when(
        i % 2 == doubled, (d.cast("int") * 2) - F.when(d.cast("int") > 4, 9).otherwise(0)).otherwise(d.cast("int")))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x)


def _refilled(shape: Column, digits: Column) -> Column:
    """``digits`` at the places of the digits of ``shape``."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))
    step = lambda acc, c: F.when(c.rlike("[0-9]"), F.struct(
        F.concat(acc["out"], F.substring(digits, acc["k"], F.lit(1))).alias("out"), (acc["k"] + 1).alias("k"))).otherwise(
        F.struct(F.concat(acc["out"], c).alias("out"), acc["k"].alias("k")))
    return F.aggregate(F.split(shape, ""), start, step, lambda acc: acc["out"])


def _once(value: Column, then) -> Column:
    """``then(value)`` with the value worked out once."""
    return F.transform(F.array(value), then)[0]


def _places(m: Column) -> Column:
    """Where cards can stand in a run of numbers: structs (s, n) of the first digit and the number of digits, best first.

    Unbroken numbers and the usual groupings come first, then the whole run, then what else of groups of
    three digits or more makes up to 19. Only the shape of the run is used.
    """
    def places(g: Column) -> Column:
        total = lambda x: F.aggregate(x, F.lit(0), lambda u, v: u + v)
        index = F.sequence(F.lit(1), F.size(g))
        spans = lambda i, sizes: F.transform(F.filter(sizes, lambda n: n.isNotNull()), lambda n: F.struct(
            (total(F.slice(g, F.lit(1), i - 1)) + 1).alias("s"), n.alias("n")))
        usual = lambda i: _once(F.concat(F.array_join(F.slice(g, i, F.lit(5)).cast("array<string>"), ","), F.lit(",")), lambda head: F.array(
            F.when(F.get(g, i - 1).between(13, 19), F.get(g, i - 1)), *[F.when(head.startswith(k), n) for k, n in GROUPINGS.items()]))
        sums = lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(6), F.size(g) - i + 1)), lambda k: F.when(
            F.forall(F.slice(g, i, k), lambda x: x >= 3), total(F.slice(g, i, k))))
        other = lambda i: F.slice(F.reverse(F.filter(sums(i), lambda n: n.between(13, 19))), 1, 1)
        whole = F.filter(F.array(F.struct(F.lit(1).alias("s"), total(g).alias("n"))), lambda c: c["n"].between(13, 19))
        return F.concat(F.flatten(F.transform(index, lambda i: spans(i, usual(i)))), whole,
                        F.flatten(F.transform(index, lambda i: spans(i, other(i)))))
    return _once(F.transform(F.split(m, "[ -]"), lambda x: F.length(x)), places)


def _chosen(digits: Column, places: Column) -> Column:
    """The places with a valid number that do not overlap a better one."""
    step = lambda acc, c: F.when(
        (luhn_sum(F.substring(digits, c["s"], c["n"]), 1) % 10 == 0)
        & ~F.exists(acc, lambda o: (o["s"] < c["s"] + c["n"]) & (c["s"] < o["s"] + o["n"])), F.concat(acc, F.array(c))).otherwise(acc)
    return F.aggregate(places, F.slice(places, 1, 0), step)


def _card(m: Column, key: str, inverse: bool) -> Column:
    """Each card in a run of numbers. It is permuted again while other places would be chosen after it, so the way back is exact."""
    def card(digits: Column) -> Column:
        body = F.substring(digits, F.lit(1), F.length(digits) - 1)
        made = lambda b: F.concat(b, ((F.lit(10) - luhn_sum(b, 0) % 10) % 10).cast("string"))
        return _once(_permuted_digits(body, key, "card", inverse), made)

    def changed(d: Column, c: Column) -> Column:
        return F.concat(F.substring(d, F.lit(1), c["s"] - 1), _once(F.substring(d, c["s"], c["n"]), card),
                        F.substring(d, c["s"] + c["n"], F.length(d)))

    def moved(digits: Column, places: Column, spans: Column) -> Column:
        def walk(d: Column, c: Column) -> Column:
            step = lambda w, _: F.when(w["done"], w).otherwise(_once(changed(w["d"], c), lambda x: F.struct(
                x.alias("d"), (_chosen(x, places) == spans).alias("done"))))
            return F.aggregate(F.sequence(F.lit(1), F.lit(64)), F.struct(d.alias("d"), F.lit(False).alias("done")), step)["d"]
        return F.aggregate(F.reverse(spans) if inverse else spans, digits, walk)

    def new(places: Column) -> Column:
        return _once(_digits(m), lambda d: _once(_chosen(d, places), lambda spans: F.when(
            F.size(spans) > 0, _refilled(m, moved(d, places, spans))).otherwise(m)))
    return _once(_places(m), new)


def _values(m: Column) -> Column:
    """How many values a match holds: a run of numbers can hold several cards."""
    cards = _once(_places(m), lambda places: F.size(_chosen(_digits(m), places)))
    return F.when(m.rlike("^[0-9][0-9 -]+$"), F.greatest(F.lit(1), cards)).otherwise(1)


def _phone(m: Column, key: str, inverse: bool) -> Column:
    """The country code stays: what a plus sign has before a separator, or what is left of the last ten digits."""
    code = F.regexp_extract(m, r"^\+([0-9]{1,3})[ .-]", 1)

    def new(digits: Column) -> Column:
        kept = F.when(F.length(code) > 0, F.length(code)).otherwise(F.greatest(F.length(digits) - 10, F.lit(0)))
        return _refilled(m, F.concat(F.substring(digits, F.lit(1), kept), _once(F.substring(digits, kept + 1, F.length(digits)), lambda d: (
            _permuted_digits(d, key, "phone", inverse)))))
    return _once(_digits(m), new)


def _ssn(m: Column, key: str, inverse: bool) -> Column:
    area, group, serial = (F.split(m, "-")[i].cast("int") for i in range(3))
    valid = (area > 0) & (area != 666) & (area < 900) & (group > 0) & (serial > 0)
    left = area - 1 - F.when(area > 666, 1).otherwise(0)  # 898 areas
    moved = feistel(left, (group - 1) * 9999 + serial - 1, F.lit(898), F.lit(99 * 9999), key, "ssn", inverse=inverse)
    text = _once(moved, lambda p: F.format_string(
        "%03d-%02d-%04d", p["l"] + 1 + F.when(p["l"] >= 665, 1).otherwise(0), F.floor(p["r"] / 9999) + 1, p["r"] % 9999 + 1))
    return F.when(valid, text).otherwise(m)


def _date(m: Column, key: str, inverse: bool) -> Column:
    day = F.datediff(F.try_to_date(F.translate(m, "/", "-"), "yyyy-MM-dd"), F.lit(FIRST_DAY).cast("date"))
    valid = day.isNotNull() & (day >= 0) & (day < DAY_LEFT * DAY_RIGHT)
    moved = feistel(F.floor(day / DAY_RIGHT), day % DAY_RIGHT, F.lit(DAY_LEFT), F.lit(DAY_RIGHT), key, "date", inverse=inverse)
    text = _once(moved, lambda p: F.date_add(F.lit(FIRST_DAY).cast("date"), (p["l"] * DAY_RIGHT + p["r"]).cast("int")).cast("string"))
    return F.when(valid, _refilled(m, F.translate(text, "-", ""))).otherwise(m)


def _ip(m: Column, key: str, inverse: bool) -> Column:
    a, b, c, d = (F.split(m, r"\.")[i].cast("int") for i in range(4))
    valid = (a < 256) & (b < 256) & (c < 256) & (d < 256)
    moved = feistel(a * 256 + b, c * 256 + d, F.lit(65536), F.lit(65536), key, "ip", inverse=inverse)
    text = _once(moved, lambda p: F.concat_ws(".", F.floor(p["l"] / 256), p["l"] % 256, F.floor(p["r"] / 256), p["r"] % 256))
    return F.when(valid, text).otherwise(m)


def _email(m: Column, key: str) -> Column:
    """Letters and digits of mail addresses have no fixed format: a keyed digest names the mailbox."""
    return F.concat(F.substring(F.sha2(F.concat_ws("|", F.lit(key), F.lit("email"), F.lower(m)), 256), 1, 16), F.lit("@mail.invalid"))


def pseudonym(m: Column, key: str, inverse: bool = False) -> Column:
    """The pseudonym of one match; a value that fails its format's checks stays as it is."""
    whole = lambda k: m.rlike(f"^(?:{PATTERNS[k]})$")
    mail = m if inverse else _email(m, key)
    return (F.when(m.contains("@"), mail).when(whole("ip"), _ip(m, key, inverse)).when(whole("date"), _date(m, key, inverse))
            .when(whole("ssn"), _ssn(m, key, inverse)).when(whole("phone"), _phone(m, key, inverse)).otherwise(_card(m, key, inverse)))


def pseudonymise(docs: DataFrame, key: str, text: str = "text", into: str = "n_replaced", inverse: bool = False
                 ) -> tuple[DataFrame, str]:
    """All rows and columns, personal values in the text replaced, and a column with their number; map-only.

    Returns the frame and that column's name (``into``, with underscores in front if taken).
    ``inverse`` gives numbers and dates back (mail addresses are not reversible). Null stays null.
    """
    into = fresh(docs.columns, into)
    pattern = "|".join(PATTERNS.values())
    t = col(text)
    found = F.regexp_extract_all(t, F.lit(pattern), F.lit(0))
    work = fresh([*docs.columns, into], "replaced")
    new = F.when(t.rlike(pattern), F.transform(found, lambda m: F.struct(m.alias("old"), pseudonym(m, key, inverse).alias("new"))))
    marked = docs.withColumn(work, new)
    pairs = F.concat(F.transform(work, lambda p: p["new"]), F.array(F.lit("")))
    whole = F.array_join(F.zip_with(F.split(t, pattern, -1), pairs, lambda a, b: F.concat(a, b)), "")
    changed = F.aggregate(F.filter(work, lambda p: p["old"] != p["new"]), F.lit(0), lambda n, p: n + _values(p["old"]))
    out = [F.when(F.col(work).isNull(), col(c)).otherwise(whole).alias(c) if c == text else col(c) for c in docs.columns]
    return marked.select(*out, F.when(F.col(work).isNull(), 0).otherwise(changed).alias(into)), into


def report(docs: DataFrame, key: str = "key of this run") -> DataFrame:
    """The rows of ``op7_pii``: doc_id, values replaced, and the SHA-256 of the text made."""
    out, into = pseudonymise(docs.select("doc_id", "text"), key)
    return out.select("doc_id", F.col(into).cast("long").alias("n_replaced"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("text_sha256"))
