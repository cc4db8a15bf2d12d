"""Format-preserving pseudonyms for personal data, with built-in functions only.

E-mail addresses, dates, phone, social-security, card and bank account numbers and IPv4 addresses are found by one
pattern and validated. Each valid value goes through a keyed Feistel network over its own alphabet and length (dates:
over the 146,097 days of their 400-year cycle; social-security numbers: over the numbers that can be issued; numbers of ten
digits: those that can be dialled in North America among each other, and the others), so it
becomes another valid value of the same format, and equal values become equal pseudonyms in every document, whatever
their punctuation. Without the key they cannot be turned back.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS, HEX, ALNUM = "0123456789", "0123456789abcdef", "0123456789abcdefghijklmnopqrstuvwxyz"
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
ROUNDS = 8
KINDS = ("email", "date", "phone", "ssn", "card", "ip", "iban")

EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)+"
DATE = r"[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}/[0-9]{2}/[0-9]{4}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}"
PHONE = r"(?:\+1[ .-]?)?(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}"
SSN = r"[0-9]{3}-[0-9]{2}-[0-9]{4}"
CARD = r"[0-9]{13,19}|[0-9]{4}[ -][0-9]{4}[ -][0-9]{4}[ -][0-9]{4}|[0-9]{4}[ -][0-9]{6}[ -][0-9]{5}"
IP = r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.[0-9])"
#: Country codes of the numbering plan; with one, any grouping of 8 digits or more, as far as the pattern reaches, that does not run into another value.
COUNTRY = r"[17]|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|[2-9][0-9]{2}"
ABROAD = rf"\+(?:{COUNTRY})(?:(?![ .-](?:{DATE}|{SSN}|{CARD}|{IP}|[2-9][0-9]{{2}}[2-9][0-9]{{6}})(?![0-9A-Za-z]))[ .-]?(?:\([0-9]{{1,4}}\)|[0-9])){{5,12}}"
#: Ten digits in a row whose area and exchange can be dialled.
PLAIN = r"[2-9][0-9]{2}[2-9][0-9]{6}(?!\.[0-9])"
#: International bank account numbers, in one piece or in fours; in fours, only the first may be without a digit.
IBAN = r"[A-Z]{2}[0-9]{2} ?[A-Z0-9]{4}(?: ?(?=[A-Z]{0,3}[0-9])[A-Z0-9]{4}){1,6}(?: ?(?=[A-Z]{0,2}[0-9])[A-Z0-9]{1,3})?"
TIMED = rf"(?:{DATE})(?=[Tt][0-9]{{2}})"
PATTERN = rf"{EMAIL}|(?<![0-9A-Za-z])(?<![0-9]\.)(?:{TIMED}|(?:{DATE}|{PHONE}|{ABROAD}|{SSN}|{PLAIN}|{CARD}|{IP}|{IBAN})(?![0-9A-Za-z]))"
#: The last form that fits holds: a slash date is day-first where its first number is no month.
DATE_FORMS = ((r"^[0-9]{4}-", "yyyy-MM-dd"), (r"^[0-9]{4}/", "yyyy/MM/dd"), (r"^[0-9]{2}/", "MM/dd/yyyy"), (r"^(?:1[3-9]|2[0-9]|3[01])/", "dd/MM/yyyy"), (r"^[0-9]{2}\.", "dd.MM.yyyy"))
#: 400 Gregorian years always have 189 * 773 days.
FIRST_DAY, LOW_DAYS, HIGH_DAYS = "1800-01-01", 189, 773
CYCLE = LOW_DAYS * HIGH_DAYS
#: Cycles before and after FIRST_DAY: the years 200 to 9799.
CYCLES_BEFORE, CYCLES_AFTER = 4, 20
#: Social-security numbers: areas 001-665 and 667-899, groups 01-99, serials 0001-9999.
AREAS, GROUPS, SERIALS = 898, 99, 9999


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once, however often it stands in there."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _code(key: str, kind: str, size: Column | int, i: Column, other: Column) -> Column:
    """64 hex digits from the key, the kind and length of the value, the round and the other half."""
    size = size if isinstance(size, Column) else F.lit(size)
    return F.sha2(F.concat_ws("|", F.lit(key), F.lit(kind), size.cast("string"), i.cast("string"), other.cast("string")), 256)


def _shift(part: Column, code: Column, alphabet: str) -> Column:
    """Each character moved on in the alphabet by a byte of the code."""
    letters = F.lit(alphabet)

    def moved(code: Column) -> Column:
        def move(j: Column) -> Column:
            step = F.conv(F.substr(code, F.pmod(j - 1, F.lit(32)) * 2 + 1, F.lit(2)), 16, 10).cast("int")
            return F.substr(letters, F.pmod(F.instr(letters, F.substr(part, j, F.lit(1))) - 1 + step, F.lit(len(alphabet))) + 1, F.lit(1))

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(part)), move), "")

    return F.when(F.length(part) == 0, F.lit("")).otherwise(let(code, moved))


def feistel(value: Column, alphabet: str, key: str, kind: str) -> Column:
    """A keyed permutation of the strings over the alphabet that have the value's length."""

    def turn(value: Column) -> Column:
        size = F.length(value)
        half = F.floor(size / 2).cast("int")
        start = F.struct(F.substr(value, F.lit(1), half).alias("l"), F.substr(value, half + 1, size - half).alias("r"))

        def step(s: Column, i: Column) -> Column:
            return F.struct(s["r"].alias("l"), _shift(s["l"], _code(key, kind, size, i, s["r"]), alphabet).alias("r"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, lambda s: F.concat(s["l"], s["r"]))

    return let(value, turn)


def feistel_pair(high: Column, low: Column, high_size: int, low_size: int, key: str, kind: str, finish: Callable[[Column], Column]) -> Column:
    """``finish`` of a keyed permutation of the pairs (high, low) of numbers below their sizes."""

    def draw(i: Column, other: Column, size: int) -> Column:
        return F.pmod(F.conv(F.substring(_code(key, kind, 0, i, other), 1, 8), 16, 10).cast("long"), F.lit(size))

    def step(s: Column, i: Column) -> Column:
        moved = F.pmod(s["high"] + draw(i, s["low"], high_size), F.lit(high_size)).cast("long")
        return let(moved, lambda h: F.struct(h.alias("high"), F.pmod(s["low"] + draw(i, h, low_size), F.lit(low_size)).cast("long").alias("low")))

    start = F.struct(high.cast("long").alias("high"), low.cast("long").alias("low"))
    return F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, step, finish)


def feistel_day(day: Column, key: str) -> Column:
    """A keyed permutation of the numbers below CYCLE."""
    return feistel_pair(F.floor(day / LOW_DAYS), F.pmod(day, F.lit(LOW_DAYS)), HIGH_DAYS, LOW_DAYS, key, "date", lambda s: (s["high"] * LOW_DAYS + s["low"]).cast("int"))


def feistel_ssn(digits: Column, key: str) -> Column:
    """A keyed permutation of the nine digits of the social-security numbers that can be issued."""
    area, group, serial = (F.substring(digits, at, n).cast("int") for at, n in ((1, 3), (4, 2), (6, 4)))
    high = (area - F.when(area > 666, 2).otherwise(1)) * GROUPS + group - 1

    def written(s: Column) -> Column:
        place = F.floor(s["high"] / GROUPS)
        area = place + F.when(place >= 665, 2).otherwise(1)
        parts = ((area, 3), (F.pmod(s["high"], F.lit(GROUPS)) + 1, 2), (s["low"] + 1, 4))
        return F.concat(*[F.lpad(x.cast("string"), n, "0") for x, n in parts])

    return feistel_pair(high, serial - 1, AREAS * GROUPS, SERIALS, key, "ssn", written)


def feistel_ten(digits: Column, key: str) -> Column:
    """A keyed permutation of the numbers of ten digits: those whose area and exchange can be dialled stay such numbers."""
    area, exchange, line = (F.substring(digits, at, n).cast("int") for at, n in ((1, 3), (4, 3), (7, 4)))
    dialled = (area >= 200) & (exchange >= 200)
    other = F.when(area < 200, area * 1000 + exchange).otherwise(200_000 + (area - 200) * 200 + exchange)

    def written(area: Column, exchange: Column) -> Callable[[Column], Column]:
        return lambda s: F.concat(*[F.lpad(x(s).cast("string"), n, "0") for x, n in ((area, 3), (exchange, 3), (lambda s: s["low"], 4))])

    high = lambda s: s["high"]
    yes = written(lambda s: F.floor(high(s) / 800) + 200, lambda s: F.pmod(high(s), F.lit(800)) + 200)
    no = written(
        lambda s: F.when(high(s) < 200_000, F.floor(high(s) / 1000)).otherwise(F.floor((high(s) - 200_000) / 200) + 200),
        lambda s: F.when(high(s) < 200_000, F.pmod(high(s), F.lit(1000))).otherwise(F.pmod(high(s), F.lit(200))),
    )
    return F.when(dialled, feistel_pair((area - 200) * 800 + exchange - 200, line, 640_000, 10_000, key, "dialled", yes)).otherwise(
        feistel_pair(other, line, 360_000, 10_000, key, "ten", no)
    )


def luhn_sum(digits: Column) -> Column:
    def of(digits: Column) -> Column:
        size = F.length(digits)

        def add(total: Column, j: Column) -> Column:
            d = F.substr(digits, j, F.lit(1)).cast("int")
            twice = F.when(d > 4, d * 2 - 9).otherwise(d * 2)
            return total + F.when(F.pmod(size - j, F.lit(2)) == 1, twice).otherwise(d)

        return F.aggregate(F.sequence(F.lit(1), size), F.lit(0), add)

    return let(digits, of)


def mod_97(text: Column) -> Column:
    """The number that digits and letters (A is 10, Z is 35) spell, modulo 97."""

    def of(text: Column) -> Column:
        def add(total: Column, j: Column) -> Column:
            c = F.ascii(F.substr(text, j, F.lit(1)))
            return F.pmod(F.when(c >= 65, total * 100 + c - 55).otherwise(total * 10 + c - 48), F.lit(97))

        return F.aggregate(F.sequence(F.lit(1), F.length(text)), F.lit(0), add)

    return let(text, of)


def _only(text: Column, keep: str) -> Column:
    return F.regexp_replace(text, f"[^{keep}]", "")


def _refill(shape: Column, letters: Column, keep: str) -> Column:
    """``shape`` with its characters of the class replaced by ``letters``, one after the other."""

    def fill(letters: Column) -> Column:
        def put(j: Column) -> Column:
            ch = F.substr(shape, j, F.lit(1))
            return F.when(ch.rlike(f"^[{keep}]$"), F.substr(letters, F.length(_only(F.substr(shape, F.lit(1), j), keep)), F.lit(1))).otherwise(ch)

        return F.array_join(F.transform(F.sequence(F.lit(1), F.length(shape)), put), "")

    return let(letters, fill)


def _date(m: Column) -> Column:
    out = F.lit(None).cast("date")
    for form, pattern in DATE_FORMS:
        out = F.when(m.rlike(form), F.to_date(F.try_to_timestamp(m, F.lit(pattern)))).otherwise(out)
    return out


def _day(m: Column) -> Column:
    return F.datediff(_date(m), F.lit(FIRST_DAY).cast("date"))


def kind_of(m: Column) -> Column:
    """The kind of a match that is valid, else null: dates that exist, Luhn and modulo-97 sums, octets, number ranges."""
    digits, compact = _only(m, "0-9"), _only(m, "A-Z0-9")
    octets = F.transform(F.split(m, r"\."), lambda o: o.cast("int"))
    ssn_ok = ~m.rlike("^(?:000|666|9)|-00-|-0000$")
    return (
        F.when(m.contains("@"), F.when(m.rlike("^[^@]*[A-Za-z0-9]"), "email"))
        .when(m.rlike(f"^(?:{DATE})$"), F.when(_day(m).between(-CYCLES_BEFORE * CYCLE, CYCLES_AFTER * CYCLE - 1), "date"))
        .when(m.rlike(f"^(?:{PHONE}|{PLAIN})$"), "phone").when(m.startswith("+"), F.when(F.length(digits) >= 8, "phone")).when(m.rlike(f"^(?:{SSN})$"), F.when(ssn_ok, "ssn"))
        .when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), F.when(F.forall(octets, lambda o: o <= 255), "ip"))
        .when(m.rlike("^[A-Z]"), F.when((F.length(compact) >= 15) & (mod_97(F.concat(F.substr(compact, F.lit(5)), F.substring(compact, 1, 4))) == 1), "iban"))
        .when(luhn_sum(digits) % 10 == 0, "card")
    )


def pseudonym(m: Column, kind: Column, key: str) -> Column:
    """The pseudonym of a match of a kind; the match itself where the kind is null."""
    digits = _only(m, "0-9")
    local = F.lower(F.substring_index(m, "@", 1))
    email = F.concat(_refill(local, feistel(_only(local, "a-z0-9"), ALNUM, key, "email"), "a-z0-9"), F.lit("@"), F.substring_index(m, "@", -1))

    def dated(day: Column) -> Column:
        out = F.lit(None).cast("string")
        for form, pattern in DATE_FORMS:
            out = F.when(m.rlike(form), F.date_format(F.date_add(F.lit(FIRST_DAY).cast("date"), day), pattern)).otherwise(out)
        return out

    date = let(_day(m), lambda day: let(feistel_day(F.pmod(day, F.lit(CYCLE)), key) + F.floor(day / CYCLE).cast("int") * CYCLE, dated))
    country = F.when(m.startswith("+"), F.regexp_extract(m, rf"^\+({COUNTRY})", 1)).otherwise(F.lit(""))
    national = F.substr(digits, F.length(country) + 1)
    phone = let(national, lambda n: F.concat(country, F.when(F.length(n) == 10, feistel_ten(n, key)).otherwise(feistel(n, DIGITS, key, "phone"))))
    phone = _refill(m, phone, "0-9")
    payload = feistel(F.substr(digits, F.lit(1), F.length(digits) - 1), DIGITS, key, "card")
    card = let(payload, lambda p: F.concat(p, F.pmod(10 - luhn_sum(F.concat(p, F.lit("0"))) % 10, F.lit(10)).cast("string")))
    packed = F.array_join(F.transform(F.split(m, r"\."), lambda o: F.lpad(F.lower(F.hex(o.cast("int"))), 2, "0")), "")
    pairs = F.regexp_extract_all(feistel(packed, HEX, key, "ip"), F.lit("[0-9a-f]{2}"), F.lit(0))
    ip = F.array_join(F.transform(pairs, lambda h: F.conv(h, 16, 10)), ".")
    compact = _only(m, "A-Z0-9")
    bban = F.substr(compact, F.lit(5))
    bban = _refill(_refill(bban, feistel(_only(bban, "0-9"), DIGITS, key, "iban"), "0-9"), feistel(_only(bban, "A-Z"), LETTERS, key, "iban"), "A-Z")
    country_code = F.substring(compact, 1, 2)
    iban = let(bban, lambda b: F.concat(country_code, F.lpad((98 - mod_97(F.concat(b, country_code, F.lit("00")))).cast("string"), 2, "0"), b))
    return (
        F.when(kind == "email", email).when(kind == "date", date).when(kind == "phone", phone)
        .when(kind == "ssn", _refill(m, feistel_ssn(digits, key), "0-9")).when(kind == "card", _refill(m, card, "0-9")).when(kind == "ip", ip)
        .when(kind == "iban", _refill(m, iban, "A-Z0-9")).otherwise(m)
    )


def pseudonymise(docs: DataFrame, *, key: str, text_col: str = "text") -> DataFrame:
    """docs with the text pseudonymised, plus n_email, n_date, n_phone, n_ssn, n_card, n_ip and n_iban (replaced if present).

    key: the secret that the pseudonyms hang on; whoever has it can turn them back, so it has no default and must not
    be empty. Equal values (same digits, same date, same address in any case) get equal pseudonyms under one key. What looks
    like a value but is not valid stays as it is. Null text stays null and counts 0; empty texts stay empty; each
    row is treated by itself over its whole text, so repeated rows agree; an empty table gives no rows. One map
    over the rows without a shuffle; texts without a digit pair or an at sign pass unread by the pattern.
    """
    if not key:
        raise ValueError("a key is needed")
    text = F.col(f"`{text_col}`")
    names = [f"n_{k}" for k in KINDS]
    kept = [c for c in docs.columns if c not in names]
    maybe = text.contains("@") | text.rlike("[0-9][0-9./-]*[0-9]")
    rows = docs.select(*[F.col(f"`{c}`") for c in kept], F.when(maybe & text.rlike(PATTERN), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).alias("_hits"))
    rows = rows.withColumn("_gaps", F.when(F.col("_hits").isNotNull(), F.split(text, PATTERN, -1)))
    rows = rows.withColumn("_kinds", F.transform("_hits", kind_of))
    new = F.zip_with("_hits", "_kinds", lambda m, k: pseudonym(m, k, key))
    rows = rows.withColumn("_new", new)
    joined = F.concat(F.array_join(F.zip_with(F.slice("_gaps", F.lit(1), F.size("_new")), "_new", lambda gap, new: F.concat(gap, new)), ""), F.element_at("_gaps", -1))
    of_kind = lambda kind: lambda x: x.eqNullSafe(F.lit(kind))
    counts = [F.when(F.col("_kinds").isNull(), F.lit(0)).otherwise(F.size(F.filter("_kinds", of_kind(k)))).cast("long").alias(n) for k, n in zip(KINDS, names, strict=True)]
    return rows.select(*[F.when(F.col("_new").isNull(), text).otherwise(joined).alias(c) if c == text_col else F.col(f"`{c}`") for c in kept], *counts)
