"""Personal data to format-preserving pseudonyms (DataFrame functions only).

Found values are permuted by a keyed Feistel network within their own format,
so equal values stay equal (and linked) across documents and the map can be
undone with the key:

* card numbers (13 to 19 digits, or grouped 4-4-4-4 or 4-6-5 by blanks or
  hyphens; valid by the Luhn rule): all digits but the first and the check digit are permuted,
  the check digit is computed anew;
* IBANs (valid modulo 97): the digits of the account part, check digits anew;
* dates (``YYYY-MM-DD``, ``DD.MM.YYYY``, and ``MM/DD/YYYY`` or ``DD/MM/YYYY``,
  valid in the calendar): days are permuted within their 400-year cycle. Slash
  dates that are valid both ways are read by the text's language: the month
  first in English and where it isn't known, else the day. (One that is valid
  only in the other order keeps that order, so to undo it the order must be known);
* IPv4 addresses (each part below 256): permuted as 32-bit numbers;
* telephone numbers (``+`` or a bracketed area code, or ``ddd-ddd-dddd`` and
  ``ddd.ddd.dddd``): digits permuted in place, the country code stays;
* US social security numbers ``ddd-dd-dddd``: digits permuted in place.

Values without a number format get keyed names of the same shape class:
e-mail addresses (local part and domain), and secrets (access keys, values
after ``token``, ``password``, ``secret``, ``api key``).

The Feistel network: a value of a domain ``a * b`` is a pair ``(l, r)``; each
round adds a keyed hash of one half to the other half modulo its size. That is
a bijection of the domain for any round function. Rounds hash with SHA-256.

A text is split around the matches of one pattern and put together again, so
everything else stays byte for byte. Defined results: null stays null; a text
without finds is unchanged; a match that fails validation stays; repeated rows
are treated alike; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .columns import once

ROUNDS = 8
#: Replace in production; the permutation is as secret as this is.
KEY = "replace-this-key"

_EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+"
_SECRET = r"\b(?i:token|password|passwd|secret|api[_-]?key)\b[\"']?[ \t]*[=:][ \t]*[\"']?[A-Za-z0-9+/_-]{8,}"
_ACCESS_KEY = r"\b(?:AKIA|ASIA)[A-Z0-9]{16}\b"
_IBAN = r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,4})?\b"
_IP = r"(?<![\d.])(?:\d{1,3}\.){3}\d{1,3}(?![\d]|\.\d)"
_DATE = r"(?<![\d/.-])(?:\d{4}-\d{2}-\d{2}|\d{2}[./]\d{2}[./]\d{4})(?![\d/-]|\.\d)"
_PHONE = r"(?<![\w+])(?:\+\d{1,3}[ .-]?)?\(\d{2,4}\)[ .-]?\d{3,4}[ .-]?\d{3,4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,4}(?!\d)"
_BARE_PHONE = r"(?<![\w+])(?<!\d[.-])(?:1[.-])?(?:\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4})(?!\w|[.-]\d)"
_SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
_CARD = r"(?<![\d.])(?:\d{13,19}|\d{4}(?:[ -]\d{4}){3}|\d{4}[ -]\d{6}[ -]\d{5})(?!\d|\.\d)"
PATTERN = "|".join((_EMAIL, _SECRET, _ACCESS_KEY, _IBAN, _IP, _DATE, _PHONE, _BARE_PHONE, _SSN, _CARD))
#: Every match contains one of these; texts without them aren't searched.
HINT = r"@|\d[ .()/+-]{0,2}\d[ .()/+-]{0,2}\d|(?i:token|passw|secret|api.?key)|AKIA|ASIA"


def _round(key: Column, tag: Column, r: int, half: Column) -> Column:
    """A keyed 60-bit number for this half."""
    h = F.sha2(F.concat_ws("|", key, tag, F.lit(str(r)), half.cast("string")), 256)
    return F.conv(F.substring(h, 1, 15), 16, 10).cast("bigint")


def feistel(value: Column, a: Column, b: Column, tag: Column, key: str = KEY, undo: bool = False) -> Column:
    """``value`` of ``0 .. a*b-1`` permuted (or put back); ``tag`` keeps formats apart."""
    k = F.lit(key)
    state = F.struct(F.floor(value / b).cast("bigint").alias("l"), F.pmod(value, b).alias("r"))
    sign = -1 if undo else 1

    def step(r):
        if r % 2 == 0:
            return lambda s: F.struct(F.pmod(s["l"] + sign * F.pmod(_round(k, tag, r, s["r"]), a), a).alias("l"), s["r"].alias("r"))
        return lambda s: F.struct(s["l"].alias("l"), F.pmod(s["r"] + sign * F.pmod(_round(k, tag, r, s["l"]), b), b).alias("r"))

    for r in (reversed(range(ROUNDS)) if undo else range(ROUNDS)):
        state = once(state, step(r))
    return once(state, lambda s: s["l"] * b + s["r"])


def _digits(s: Column) -> Column:
    return F.regexp_replace(s, r"\D", "")


def permute_digits(digits: Column, tag: str | Column, key: str = KEY, undo: bool = False) -> Column:
    """A digit string of 1 to 18 digits permuted among those of its length."""
    tag = F.lit(tag) if isinstance(tag, str) else tag
    def within(d):
        n = F.length(d)
        left = F.floor(n / 2)
        sizes = F.struct(F.pow(F.lit(10.0), left).cast("bigint").alias("a"), F.pow(F.lit(10.0), n - left).cast("bigint").alias("b"),
                         F.concat_ws(":", tag, n.cast("string")).alias("tag"))
        return F.lpad(once(sizes, lambda z: feistel(d.cast("bigint"), z["a"], z["b"], z["tag"], key, undo)).cast("string"), n, "0")
    return once(digits, within)


#: Digits that one network takes.
_BLOCK = 17


def permute_long(digits: Column, tag: str, key: str = KEY, undo: bool = False) -> Column:
    """A digit string of 1 to 34 digits permuted among those of its length.

    Longer ones than a network takes go through two; the second block's depends
    on the first block as it was.
    """
    first, long = F.substr(digits, F.lit(1), F.lit(_BLOCK)), F.length(digits) > _BLOCK
    head = permute_digits(first, tag, key, undo)
    # a single digit stands in where there is no second block
    rest = F.when(long, F.substr(digits, F.lit(_BLOCK + 1), F.length(digits))).otherwise("0")
    tail = permute_digits(rest, F.concat_ws("/", F.lit(tag), head if undo else first), key, undo)
    return F.when(long, F.concat(head, tail)).otherwise(head)


def _refill(original: Column, new: Column) -> Column:
    """``original`` with its digits, in order, replaced by those of ``new``."""
    def fill(digits):
        filled = F.aggregate(F.split(original, ""), F.struct(F.lit("").alias("t"), F.lit(1).alias("i")), lambda s, c: F.when(
            c.rlike(r"^\d$"), F.struct(F.concat(s["t"], F.substr(digits, s["i"], F.lit(1))).alias("t"), (s["i"] + 1).alias("i")))
            .otherwise(F.struct(F.concat(s["t"], c).alias("t"), s["i"].alias("i"))))
        return filled["t"]
    return once(new, fill)


def _luhn(d: Column) -> Column:
    """The sum that is a multiple of 10 for valid numbers."""
    return F.aggregate(F.transform(F.split(F.reverse(d), ""), lambda c, i: F.when(i % 2 == 0, c.cast("int")).otherwise(
        (c.cast("int") * 2) - F.when(c.cast("int") > 4, 9).otherwise(0))), F.lit(0), lambda s, x: s + x)


def _card(m: Column, key: str) -> Column:
    def number(d):
        n = F.length(d)
        body = F.concat(F.substr(d, F.lit(1), F.lit(1)), permute_digits(F.substr(d, F.lit(2), n - 2), "card", key))
        new = once(body, lambda x: F.concat(x, F.pmod(10 - F.pmod(_luhn(F.concat(x, F.lit("0"))), F.lit(10)), F.lit(10)).cast("string")))
        return F.when((F.pmod(_luhn(d), F.lit(10)) == 0) & ~d.rlike(r"^(\d)\1*$"), _refill(m, new)).otherwise(m)
    return once(_digits(m), number)


def _mod97(iban: Column) -> Column:
    turned = F.concat(F.substr(iban, F.lit(5), F.length(iban)), F.substr(iban, F.lit(1), F.lit(4)))
    return F.aggregate(F.split(turned, ""), F.lit(0).cast("bigint"), lambda s, c: F.when(
        c.rlike(r"^\d$"), F.pmod(s * 10 + F.ascii(c) - 48, F.lit(97))).otherwise(F.pmod(s * 100 + F.ascii(c) - 55, F.lit(97))))


def _iban(m: Column, key: str) -> Column:
    def valid(v):
        account, land = F.substr(v, F.lit(5), F.length(v)), F.substr(v, F.lit(1), F.lit(2))
        digits = _digits(account)
        new = permute_long(digits, "iban", key)
        body = F.when(F.length(digits) > 0, _refill(account, new)).otherwise(account)
        whole = once(body, lambda x: _digits(F.concat(F.lpad((98 - _mod97(F.concat(land, F.lit("00"), x))).cast("string"), 2, "0"), x)))
        return F.when(_mod97(v) == 1, _refill(m, whole)).otherwise(m)
    return once(F.replace(m, F.lit(" "), F.lit("")), valid)


#: Days of the Gregorian cycle of 400 years: 189 * 773.
_CYCLE = (189, 773)


def permute_day(day: Column, key: str = KEY, undo: bool = False) -> Column:
    """A date permuted within its 400-year cycle (counted from 1700-03-01)."""
    total = _CYCLE[0] * _CYCLE[1]
    first = F.lit("1700-03-01").cast("date")
    new = once(F.date_diff(day, first).cast("bigint"), lambda n: F.floor(n / total) * total + feistel(
        F.pmod(n, F.lit(total)), F.lit(_CYCLE[0]), F.lit(_CYCLE[1]), F.lit("date"), key, undo))
    return F.date_add(first, new.cast("int"))


def _date(m: Column, key: str, day_first: Column) -> Column:
    def by(fmt, other):
        day = F.try_to_timestamp(m, F.lit(fmt)).cast("date")
        return F.when(day.isNotNull(), F.date_format(permute_day(day, key), fmt)).otherwise(other)
    month, day = "MM/dd/yyyy", "dd/MM/yyyy"
    return (F.when(m.rlike(r"^\d{4}-"), by("yyyy-MM-dd", m)).when(m.rlike(r"^\d\d\.\d\d\.\d{4}$"), by("dd.MM.yyyy", m))
            .when(m.rlike(r"^\d\d/\d\d/\d{4}$"), F.when(day_first, by(day, by(month, m))).otherwise(by(month, by(day, m)))).otherwise(m))


def _day_first(lang: Column) -> Column:
    """Whether texts of this language write the day before the month; false for null."""
    return F.coalesce(~lang.cast("string").rlike(r"^(?i:\s*|(en|eng|english)([_-]us)?)$"), F.lit(False))


def _ip(m: Column, key: str) -> Column:
    parts = F.transform(F.split(m, r"\."), lambda p: p.cast("bigint"))
    value = F.aggregate(parts, F.lit(0).cast("bigint"), lambda s, p: s * 256 + p)
    new = feistel(value, F.lit(65536), F.lit(65536), F.lit("ip"), key)
    text = once(new, lambda v: F.concat_ws(".", *[F.pmod(F.shiftright(v, s), F.lit(256)).cast("string") for s in (24, 16, 8, 0)]))
    return F.when(F.forall(parts, lambda p: p < 256), text).otherwise(m)


def _in_place(m: Column, tag: str, key: str) -> Column:
    return _refill(m, permute_digits(_digits(m), tag, key))


# The telephone country codes of one and two digits; all others have three.
_COUNTRY = r"1|7|2[07]|3[0-4]|36|39|4[01]|4[3-9]|5[1-8]|6[0-6]|8[1246]|9[0-58]|\d{3}"


def _phone(m: Column, key: str) -> Column:
    land = F.regexp_extract(m, rf"^(\+\d{{1,3}}(?=[ .(-])|\+(?:{_COUNTRY})|1(?=[.-]\d{{3}}[.-]))", 1)
    rest = F.substr(m, F.length(land) + 1, F.length(m))
    return F.concat(land, _in_place(rest, "phone", key))


def _name(value: Column, tag: str, key: str, n) -> Column:
    return F.substr(F.sha2(F.concat_ws("|", F.lit(key), F.lit(tag), value), 256), F.lit(1), n)


def _email(m: Column, key: str) -> Column:
    low = F.lower(m)
    host = F.regexp_extract(low, r"@(.*)$", 1)
    return F.concat(F.lit("u"), _name(low, "email", key, F.lit(12)), F.lit("@h"), _name(host, "host", key, F.lit(8)), F.lit(".invalid"))


def _secret(m: Column, key: str) -> Column:
    value = F.regexp_extract(m, r"([A-Za-z0-9+/_-]{8,})$", 1)
    n = F.length(value)
    return F.concat(F.substr(m, F.lit(1), F.length(m) - n), F.substr(F.repeat(_name(value, "secret", key, F.lit(64)), 1 + F.floor(n / 64).cast("int")), F.lit(1), n))


def _access_key(m: Column, key: str) -> Column:
    return F.concat(F.substr(m, F.lit(1), F.lit(4)), F.upper(_name(m, "access", key, F.lit(16))))


def pseudonym(m: Column, key: str = KEY, day_first: Column | None = None) -> Column:
    """The pseudonym of one match of ``PATTERN`` (the match itself if it isn't valid)."""
    day_first = F.lit(False) if day_first is None else day_first
    whole = lambda p: f"^(?:{p})$"
    return (F.when(m.contains("@"), _email(m, key))
            .when(m.rlike(whole(_SECRET)), _secret(m, key))
            .when(m.rlike(whole(_ACCESS_KEY)), _access_key(m, key))
            .when(m.rlike(whole(_IP)), _ip(m, key))
            .when(m.rlike(whole(_DATE)), _date(m, key, day_first))
            .when(m.rlike(rf"^[+(]|^(?:{_BARE_PHONE})$"), _phone(m, key))
            .when(m.rlike(whole(_SSN)), _in_place(m, "ssn", key))
            .when(m.rlike(r"^[A-Z]{2}"), _iban(m, key))
            .otherwise(_card(m, key)))


def pseudonymize(docs: DataFrame, text_col: str = "text", key: str = KEY, found_col: str | None = None) -> DataFrame:
    """``docs`` with ``text_col`` pseudonymized; ``found_col`` gets the number of replaced values.

    Matches are found once per text; only they go through the network. A column
    ``lang``, if there is one, tells how slash dates are read.
    """
    text = F.col(f"`{text_col}`")
    rest = [F.col(f"`{c}`") for c in docs.columns]
    hit = F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0)))
    d = docs.select(F.struct(*rest).alias("row"), hit.alias("found"))
    day_first = _day_first(F.col("row.`lang`")) if "lang" in docs.columns else None
    d = d.select("row", "found", F.transform("found", lambda m: pseudonym(m, key, day_first)).alias("new"))
    text = F.col(f"row.`{text_col}`")
    put = F.array_join(F.flatten(F.zip_with(F.split(text, PATTERN, -1), F.col("new"), lambda p, m: F.array(p, F.coalesce(m, F.lit(""))))), "")
    text = F.when(F.size("new") > 0, put).otherwise(text)
    out = [text.alias(c) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns]
    if found_col:
        changed = F.size(F.filter(F.zip_with("found", "new", lambda a, b: a != b), lambda x: x))
        out.append(F.greatest(F.coalesce(changed, F.lit(0)), F.lit(0)).cast("long").alias(found_col))
    return d.select(*out)
