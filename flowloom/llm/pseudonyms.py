"""Format-preserving Feistel pseudonyms for personal data, in DataFrame operations only.

Found and validated: payment cards (13 to 19 digits, Luhn), also beside other numbers as long as they begin and end where a
group of digits does, telephone numbers with country code (7 to 12 further digits in any grouping), US social security
numbers (ranges that can be issued), IPv4 addresses (octets), dates from 1900 to 4 August 2099 in three spellings, and the local
part of mail addresses. Each value is mapped to a number of its own domain, a x b in size, that a keyed Feistel network
permutes: halves l < a and r < b are shifted in turn by a keyed hash of the other. So pseudonyms are valid values in the
same format, different values keep different pseudonyms, and equal values stay linked across documents. A date keeps
its pseudonym in every spelling. In a mail address each letter and digit of the local part is shifted within its class.

One regular expression cuts a text into matches and the gaps between them; all else is done to the matches, and the text
is put together again. Rows are independent: no shuffle.

A short number after a telephone number, parted by a single blank, is taken for its last group if it fits. A card is one group
or has a card's usual groups, and begins with digits that are given to issuers. In a run of more digits than two cards have,
groups are cards only if the whole run is cards; so lists of plain numbers stay.

Defined cases: a null text stays null, an empty one empty, with counts 0. Numbers that do not validate stay as they are.
Repeated rows change alike. Columns named like a result column are replaced by it, others are carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowloom.llm.common import replaced

ROUNDS = 10
DAYS = 270 * 270
FIRST_DAY = "1900-01-01"
KINDS = ("email", "date", "ip", "ssn", "phone", "card")
DATE_FORMATS = {r"^\d{4}-\d{2}-\d{2}$": "yyyy-MM-dd", r"^\d{2}\.\d{2}\.\d{4}$": "dd.MM.yyyy", r"^\d{2}/\d{2}/\d{4}$": "MM/dd/yyyy"}
EMAIL = r"[A-Za-z0-9][A-Za-z0-9._%+-]{0,63}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}"
DATE = r"(?:\d{4}-\d{2}-\d{2}|\d{2}\.\d{2}\.\d{4}|\d{2}/\d{2}/\d{4})(?!\d)"
IP = r"(?:\d{1,3}\.){3}\d{1,3}(?!\d|\.\d)"
SSN = r"\d{3}-\d{2}-\d{4}(?![\d-])"
#: The country codes of E.164 of one and two digits; all others have three.
CODE = r"(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3})"
#: A group of digits that begins one of these is not part of the telephone or card number before it.
_OTHER = rf"(?!{DATE}|{IP}|{SSN}|[A-Za-z0-9._%+-]{{1,64}}@)"
_CARD_SHAPE = r"(?!\d{4}[ -]\d{4}[ -]\d{4}[ -]\d|\d{4}[ -]\d{6}[ -]\d|\d{13})"
#: Numbers of country code 1 have ten further digits, in one group or as 3-3-4.
_NORTH = r"(?!1(?!\d{10}(?!\d)|[ ./-]?\(?\d{3}\)?[ ./-]?\d{3}[ ./-]?\d{4}(?!\d)))"
PHONE = rf"\+(?!\d+\.\d+(?!\d|\.\d)){_NORTH}{CODE}(?:\.?\(?\d\)?|[ /-]{_OTHER}{_CARD_SHAPE}\(?\d\)?){{7,12}}"
#: A run of digits of any length, in which cards are looked for; possessive, as Java's regular expressions recurse otherwise.
RUN = rf"\d(?:\d|[ -]{_OTHER}\d){{12,}}+"
CARD_MIN, CARD_MAX = 13, 19
#: First digits that the large card networks issue.
ISSUER = r"^(?:4|5[0-9]|6[0-9]|3[0-9]|2(?:22[1-9]|2[3-9]\d|[3-6]\d\d|7[01]\d|720)|1800|2131|2014|2149|9792|220[0-4]|8[16])"
PATTERN = rf"{EMAIL}|(?<![\d.]){DATE}|(?<![\d.]){IP}|(?<![\d-]){SSN}|(?<!\d){PHONE}(?!\d)|(?<!\d){RUN}"


def _hash(key: str, label: str, i: Column, other: Column) -> Column:
    return F.sha2(F.concat_ws(":", F.lit(key), F.lit(label), i.cast("string"), other.cast("string"), F.lit(key)), 256)


def _number(hashed: Column, begin: int | Column = 1, digits: int = 15) -> Column:
    return F.conv(F.substr(hashed, F.lit(begin) if isinstance(begin, int) else begin, F.lit(digits)), 16, 10).cast("long")


def permuted(value: Column, a: Column, b: Column, key: str, label: str) -> Column:
    """A keyed permutation of 0 <= value < a * b."""
    start = F.struct(F.floor(value / b).cast("long").alias("l"), (value % b).cast("long").alias("r"))

    def turn(s, i):
        left = F.when(i % 2 == 0, (s["l"] + _number(_hash(key, label, i, s["r"])) % a) % a).otherwise(s["l"])
        right = F.when(i % 2 == 1, (s["r"] + _number(_hash(key, label, i, s["l"])) % b) % b).otherwise(s["r"])
        return F.struct(left.cast("long").alias("l"), right.cast("long").alias("r"))

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: s["l"] * b + s["r"])


def luhn_sum(digits: Column) -> Column:
    """The Luhn sum of a string of digits; a valid number's is a multiple of ten."""
    def add(total, i):
        d = F.substr(digits, F.length(digits) - i, F.lit(1)).cast("int") * (1 + i % 2)
        return total + F.when(d > 9, d - 9).otherwise(d)

    return F.aggregate(F.sequence(F.lit(0), F.length(digits) - 1), F.lit(0), add)


def refilled(shape: Column, digits: Column) -> Column:
    """``shape`` with its digits replaced, one by one."""
    start = F.struct(F.lit("").alias("out"), F.lit(1).alias("k"))

    def put(s, c):
        is_digit = c.rlike("[0-9]")
        return F.struct(F.concat(s["out"], F.when(is_digit, F.substr(digits, s["k"], F.lit(1))).otherwise(c)).alias("out"), (s["k"] + is_digit.cast("int")).alias("k"))

    return F.aggregate(F.split(shape, ""), start, put, lambda s: s["out"])


def _power(n: Column) -> Column:
    return F.rpad(F.lit("1"), n + 1, F.lit("0")).cast("long")


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _card(digits: Column, key: str) -> Column:
    """The pseudonym of a valid card number without blanks."""
    payload = F.substr(digits, F.lit(1), F.length(digits) - 1)
    n = F.length(payload)
    half = F.floor(n / 2).cast("int")
    changed = F.lpad(permuted(payload.cast("long"), _power(half), _power(n - half), key, "card").cast("string"), n, F.lit("0"))
    return F.transform(F.array(changed), lambda p: F.concat(p, ((10 - luhn_sum(F.concat(p, F.lit("0"))) % 10) % 10).cast("string")))[0]


def _cards(m: Column, key: str) -> Column:
    """(n, new): the cards in a run of groups of digits, and the run with them replaced; new is null without any.

    All windows of whole groups are tried. Of valid ones that overlap the longer goes first.
    """
    def valid(groups):
        def window(i, k):
            part = F.slice(groups, i, k)
            shape = F.array_join(F.transform(part, lambda g: F.length(g).cast("string")), "-")
            usual = (k == 1) | shape.rlike("^(?:4-4-4-4(?:-[1-3])?|4-6-[45])$")
            digits = F.array_join(part, "")
            card = usual & digits.rlike(ISSUER) & F.length(digits).between(CARD_MIN, CARD_MAX)
            return F.struct(card.alias("card"), (-F.length(digits)).alias("less"), i.alias("i"), k.alias("k"), digits.alias("digits"))

        starts = F.sequence(F.lit(1), F.size(groups))
        windows = F.flatten(F.transform(starts, lambda i: F.transform(F.sequence(F.lit(1), F.least(F.lit(CARD_MAX), F.size(groups) - i + 1)), lambda k: window(i, k))))
        found = F.filter(windows, lambda w: w["card"] & (luhn_sum(w["digits"]) % 10 == 0))
        return F.transform(F.array(found), lambda every: whole(groups, every))[0]

    def whole(groups, every):
        # Of a long run of fours, those windows that would make cards of all of it count, or none.
        fours = F.filter(every, lambda w: (w["k"] == 4) & (w["i"] % 4 == 1))
        single = F.filter(every, lambda w: w["k"] == 1)
        even = F.when(F.size(fours) * 4 == F.size(groups), fours).otherwise(F.slice(fours, 1, 0))
        long = F.length(F.array_join(groups, "")) > 2 * CARD_MAX
        return F.array_sort(F.when(long, F.concat(single, even)).otherwise(every))

    def apart(found):
        clash = lambda w, o: (o["i"] < w["i"] + w["k"]) & (w["i"] < o["i"] + o["k"])
        return F.aggregate(found, F.slice(found, 1, 0), lambda s, w: F.when(F.exists(s, lambda o: clash(w, o)), s).otherwise(F.array_append(s, w)))

    def put(groups, cards):
        def shown(g, at):
            i = at + 1
            own = F.filter(cards, lambda w: (w["i"] <= i) & (i < w["i"] + w["k"]))
            begin = lambda w: F.length(F.array_join(F.slice(groups, w["i"], i - w["i"]), "")) + 1
            return F.coalesce(F.try_element_at(F.transform(own, lambda w: F.substr(w["new"], begin(w), F.length(g))), F.lit(1)), g)

        seps = F.array_append(F.regexp_extract_all(m, F.lit("[ -]"), F.lit(0)), F.lit(""))
        return F.array_join(F.zip_with(F.transform(groups, shown), seps, lambda g, sep: F.concat(g, sep)), "")

    def all_of(groups):
        picked = F.transform(F.array(valid(groups)), apart)[0]
        picked = F.transform(picked, lambda w: F.struct(w["i"].alias("i"), w["k"].alias("k"), _card(w["digits"], key).alias("new")))
        return F.transform(F.array(picked), lambda cards: F.struct(F.size(cards).alias("n"), F.when(F.size(cards) > 0, put(groups, cards)).alias("new")))[0]

    return F.transform(F.array(F.split(m, "[ -]")), all_of)[0]


def _phone(m: Column, key: str) -> Column:
    """All digits after the country code changed; the code is told from the digits, so spellings of a number stay linked."""
    code = F.regexp_extract(_digits(m), f"^{CODE}", 0)
    number = F.substr(_digits(m), F.length(code) + 1, F.length(_digits(m)))
    n = F.length(number)
    half = F.floor(n / 2).cast("int")
    return refilled(m, F.concat(code, F.lpad(permuted(number.cast("long"), _power(half), _power(n - half), key, "phone").cast("string"), n, F.lit("0"))))


def _ip(m: Column, key: str) -> Column:
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("long"))
    value = F.aggregate(octets, F.lit(0).cast("long"), lambda s, o: s * 256 + o)
    half = F.lit(65_536).cast("long")
    changed = permuted(value, half, half, key, "ip")
    shown = F.transform(F.array(changed), lambda v: F.array_join(F.array(*[(F.shiftright(v, s).bitwiseAND(255)).cast("string") for s in (24, 16, 8, 0)]), "."))[0]
    return F.when(F.array_max(octets) <= 255, shown)


def _ssn(m: Column, key: str) -> Column:
    """Areas 001 to 899 without 666, groups 01 to 99, serials 0001 to 9999."""
    area, group, serial = (F.substr(m, F.lit(a), F.lit(n)).cast("long") for a, n in ((1, 3), (5, 2), (8, 4)))
    valid = area.between(1, 899) & (area != 666) & (group > 0) & (serial > 0)
    below = F.lit(99 * 9999).cast("long")
    value = (area - 1 - (area > 666).cast("long")) * below + (group - 1) * 9999 + serial - 1
    changed = permuted(value, F.lit(898).cast("long"), below, key, "ssn")

    def shown(v):
        a = F.floor(v / below).cast("long") + 1
        a = a + (a >= 666).cast("long")
        parts = ((a, 3), (F.floor(v % below / 9999).cast("long") + 1, 2), (v % 9999 + 1, 4))
        return F.array_join(F.array(*[F.lpad(p.cast("string"), n, "0") for p, n in parts]), "-")

    return F.when(valid, F.transform(F.array(changed), shown)[0])


def _date(m: Column, key: str) -> Column:
    out = F.lit(None).cast("string")
    for pattern, spelling in DATE_FORMATS.items():
        day = F.date_diff(F.try_to_timestamp(F.when(m.rlike(pattern), m), F.lit(spelling)).cast("date"), F.lit(FIRST_DAY).cast("date"))
        half = F.lit(270).cast("long")
        changed = F.date_add(F.lit(FIRST_DAY).cast("date"), permuted(day.cast("long"), half, half, key, "date").cast("int"))
        out = F.when(m.rlike(pattern), F.when((day >= 0) & (day < DAYS), F.date_format(changed, spelling))).otherwise(out)
    return out


def _shifted(text: Column, hashed: Column) -> Column:
    """Each letter or digit moved on within its class by a byte of the hash."""
    def one(c, k):
        by = _number(hashed, k % 32 * 2 + 1, 2)
        code = F.ascii(c)
        moved = lambda first, n: F.char((code - first + by) % n + first)
        return F.when(c.rlike("[0-9]"), moved(48, 10)).when(c.rlike("[a-z]"), moved(97, 26)).when(c.rlike("[A-Z]"), moved(65, 26)).otherwise(c)

    return F.array_join(F.transform(F.split(text, ""), one), "")


def _email(m: Column, key: str) -> Column:
    local, domain = F.substring_index(m, "@", 1), F.substring_index(m, "@", -1)
    cut = F.floor(F.length(local) / 2).cast("int")
    start = F.struct(F.substr(local, F.lit(1), cut).alias("l"), F.substr(local, cut + 1, F.length(local)).alias("r"))

    def turn(s, i):
        return F.struct(
            F.when(i % 2 == 0, _shifted(s["l"], _hash(key, "email", i, s["r"]))).otherwise(s["l"]).alias("l"),
            F.when(i % 2 == 1, _shifted(s["r"], _hash(key, "email", i, s["l"]))).otherwise(s["r"]).alias("r"),
        )

    return F.concat(F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn, lambda s: F.concat(s["l"], s["r"])), F.lit("@"), domain)


def _pseudonym(m: Column, key: str) -> Column:
    """(kind, (n, new)) of a match: how many values of the kind it holds, and the text with them replaced; new is null where none validates."""
    date = F.lit(False)
    for pattern in DATE_FORMATS:
        date = date | m.rlike(pattern)
    tests = {"email": m.contains("@"), "date": date, "ip": m.rlike(r"^(?:\d{1,3}\.){3}\d{1,3}$"), "ssn": m.rlike(r"^\d{3}-\d{2}-\d{4}$"), "phone": m.startswith("+"), "card": F.lit(True)}
    change = {"email": _email, "date": _date, "ip": _ip, "ssn": _ssn, "phone": _phone}
    kind = done = None
    for k in KINDS:
        one = _cards(m, key) if k == "card" else F.struct(F.lit(1).alias("n"), change[k](m, key).alias("new"))
        kind = F.when(tests[k], F.lit(k)) if kind is None else kind.when(tests[k], F.lit(k))
        done = F.when(tests[k], one) if done is None else done.when(tests[k], one)
    return F.struct(kind.alias("kind"), done.alias("done"))


def pseudonymised(docs: DataFrame, key: str, text_col: str = "text") -> DataFrame:
    """``docs`` with personal data in the text replaced, and the number of replacements by kind, ``n_<kind>``."""
    text = F.col(text_col)
    taken = {c.lower() for c in docs.columns}
    found_col, gaps_col = (next(c for c in (f"{base}{'_' * k}" for k in range(99)) if c not in taken) for base in ("_found", "_gaps"))
    matches = F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))

    def checked(m):
        return F.transform(
            F.array(_pseudonym(m, key)), lambda p: F.struct(F.when(p["done"]["new"].isNotNull(), p["kind"]).alias("kind"), p["done"]["n"].alias("n"), F.coalesce(p["done"]["new"], m).alias("new")),
        )[0]

    df = docs.withColumn(found_col, F.transform(matches, checked)).withColumn(gaps_col, F.split(text, PATTERN))
    whole = F.array_join(F.zip_with(gaps_col, F.col(found_col), lambda g, f: F.concat(g, F.coalesce(f["new"], F.lit("")))), "")

    def count(kind):
        return F.coalesce(F.aggregate(F.filter(found_col, lambda f: f["kind"] == kind), F.lit(0), lambda s, f: s + f["n"]), F.lit(0)).cast("long")

    counts = {f"n_{kind}": F.when(text.isNotNull(), count(kind)).otherwise(F.lit(0).cast("long")) for kind in KINDS}
    return replaced(df, {text_col: F.when(text.isNotNull(), whole), **counts}).drop(found_col, gaps_col)
