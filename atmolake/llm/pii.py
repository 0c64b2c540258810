"""Format-preserving pseudonyms for personal data.

Each validated number, date, address or secret is replaced by one of its own format, through a keyed permutation of
the values of that format: equal values get equal pseudonyms in all documents, and no two values get the same one.
The permutation is a Feistel network that adds keyed round values modulo the sizes of two halves; where only part of
a grid is valid, it is walked until a valid value comes (cycle walking, which keeps it a permutation).

Kinds: e-mail address (its last label stays), IPv4 address, telephone number (the country code stays), payment card
(Luhn's check digit is made anew), IBAN (country stays, check digits made anew), US social security number, date
between 1900 and 2099 (year-month-day, day.month.year, month/day/year, and day/month/year if the day is over 12; a day has
one pseudonym in all of these, which is written month first where a day/month/year would be read otherwise), and what follows the name of a secret and `=` or `:`. What fails validation stays as it is.
"""

from __future__ import annotations

import datetime
import hashlib
import re
import warnings
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atmolake.llm.common import give_back, unused


#: Known to all, for tests and for the registered queries; whoever has the key can undo the pseudonyms.
DEFAULT_KEY = b"change this key"
#: Setting of the session that holds the key of a deployment.
KEY_SETTING = "spark.atmolake.pii.key"


def session_key(spark: SparkSession) -> bytes:
    """The key that the session was given, or else, with a warning, the one known to all."""
    key = spark.conf.get(KEY_SETTING, None)
    if not key:
        warnings.warn(f"{KEY_SETTING} is not set: pseudonyms are made with a key known to all", stacklevel=2)
    return key.encode() if key else DEFAULT_KEY
ROUNDS = 8


def feistel(value: int, left: int, right: int, key: bytes, tweak: str) -> int:
    """A keyed permutation of range(left * right)."""
    a, b = divmod(value, right)
    for i in range(0, ROUNDS, 2):
        a = (a + _round(key, tweak, i, b)) % left
        b = (b + _round(key, tweak, i + 1, a)) % right
    return a * right + b


def _round(key: bytes, tweak: str, i: int, half: int) -> int:
    data = f"{tweak}|{i}|{half}".encode()
    return int.from_bytes(hashlib.blake2b(data, key=key, digest_size=32).digest(), "big")


def permute(text: str, key: bytes, tweak: str) -> str:
    """Digits and letters a-z, A-Z become others of their class; all other characters stay, as does the form."""
    form = re.sub("[0-9]", "0", re.sub("[a-z]", "a", re.sub("[A-Z]", "A", text)))
    places = [i for i, c in enumerate(form) if c in "0aA" and text[i].isascii()]
    sizes = [10 if form[i] == "0" else 26 for i in places]
    half = len(places) // 2
    left, right, value = 1, 1, 0
    for k, (i, size) in enumerate(zip(places, sizes)):
        value = value * size + ord(text[i]) - ord(form[i])
        left, right = (left * size, right) if k < half else (left, right * size)
    value = feistel(value, left, right, key, f"{tweak}|{form}")
    out = list(text)
    for i, size in zip(reversed(places), reversed(sizes)):
        value, digit = divmod(value, size)
        out[i] = chr(ord(form[i]) + digit)
    return "".join(out)


def _walk(text: str, valid: Callable[[str], bool], key: bytes, tweak: str) -> str:
    text = permute(text, key, tweak)
    while not valid(text):
        text = permute(text, key, tweak)
    return text


def _put(digits: str, into: str) -> str:
    """The digits, at the places of the digits of a text."""
    rest = iter(digits)
    return "".join(next(rest) if "0" <= c <= "9" else c for c in into)


def _digits(text: str) -> str:
    return re.sub("[^0-9]", "", text)


def luhn(digits: str) -> int:
    """The sum that is 0 for a valid number."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _card(found: str, key: bytes) -> str | None:
    digits = _digits(found)
    if not 13 <= len(digits) <= 19 or luhn(digits) or len(set(digits)) == 1:
        return None
    body = permute(digits[:-1], key, "card")
    return _put(body + str(-luhn(body + "0") % 10), found)


def _mod97(iban: str) -> int:
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97


def _iban(found: str, key: bytes) -> str | None:
    plain = found.replace(" ", "")
    if not 15 <= len(plain) <= 34 or _mod97(plain) != 1:
        return None
    body = permute(plain[4:], key, "iban" + plain[:2])
    plain = iter(f"{plain[:2]}{98 - _mod97(plain[:2] + '00' + body):02}{body}")
    return "".join(c if c == " " else next(plain) for c in found)


def _ibans(text: str, key: bytes) -> Iterator[tuple[int, int, str]]:
    """Of the ends before a blank, that at the length of the country is tried first, so that no word behind is taken along."""
    at = 0
    while m := _IBAN.search(text, at):
        at = m.start() + 1
        found = m[0]
        length = IBAN_LENGTHS.get(found[:2])
        ends = [len(found), *(i for i in range(len(found) - 1, 0, -1) if found[i] == " ")]
        right = [end for end in ends if end - found.count(" ", 0, end) == length]
        for end in [*right, *(ends[:1] if length else ends)]:
            if (new := _iban(found[:end], key)) is not None:
                at = m.start() + end
                yield m.start(), at, new
                break


def _ipv4(found: str, key: bytes) -> str | None:
    parts = found.split(".")
    if any(int(p) > 255 or (p[0] == "0" and p != "0") for p in parts):
        return None
    a, b, c, d = map(int, parts)
    value = feistel(((a * 256 + b) * 256 + c) * 256 + d, 65536, 65536, key, "ipv4")
    return ".".join(str(value >> shift & 255) for shift in (24, 16, 8, 0))


def _nanp(digits: str) -> bool:
    return digits[0] > "1" and digits[3] > "1"


def _phone(found: str, key: bytes) -> str | None:
    digits = _digits(found)
    if found[0] == "+" and digits[0] != "1":  # another country: its first two digits stay
        return _put(digits[:2] + permute(digits[2:], key, "phone" + digits[:2]), found) if 8 <= len(digits) <= 15 else None
    code, local = digits[:-10], digits[-10:]
    if len(digits) < 10 or code not in ("", "1"):
        return None
    if not _nanp(local):  # no number of the plan, but written as one: it stays outside the plan, if nothing else tells
        if found[0] not in "+(":
            return None
        return _put(code + _walk(local, lambda d: not _nanp(d), key, "phone1"), found)
    return _put(code + _walk(local, _nanp, key, "phone1"), found)


def _ssn(found: str, key: bytes) -> str | None:
    def valid(d: str) -> bool:
        return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

    digits = _digits(found)
    return _put(_walk(digits, valid, key, "ssn"), found) if valid(digits) else None


_FIRST, _DAYS = datetime.date(1900, 1, 1).toordinal(), (datetime.date(2100, 1, 1) - datetime.date(1900, 1, 1)).days


def _date(found: str, key: bytes) -> str | None:
    parts = re.split(r"[-/.]", found)
    a, b, c = map(int, parts)
    if len(parts[0]) == 4:
        order = (0, 1, 2)
    elif "." in found or ("/" in found and a > 12):
        order = (2, 1, 0)
    else:
        order = (2, 0, 1)
    year, month, day = ((a, b, c)[k] for k in order)
    try:
        date = datetime.date(year, month, day)
    except ValueError:
        return None
    if not 1900 <= year <= 2099:
        return None
    date = _pseudonym(date, key)
    if order == (2, 1, 0) and "/" in found and date.day <= 12:
        order = (2, 0, 1)  # with slashes such a day is read as a month, so the pseudonym is written month first
    out = [""] * 3
    for k, number in zip(order, (date.year, date.month, date.day)):
        out[k] = str(number).zfill(4 if number > 99 else 2)
    marks = re.findall(r"[-/.]", found)
    return out[0] + marks[0] + out[1] + marks[1] + out[2]


def _pseudonym(date: datetime.date, key: bytes) -> datetime.date:
    """One permutation of the days, whatever form a date is written in."""
    value = date.toordinal() - _FIRST
    while True:
        value = feistel(value, 271, 270, key, "date")
        if value < _DAYS:
            return datetime.date.fromordinal(_FIRST + value)


def _email(found: str, key: bytes) -> str | None:
    local, domain = found.rsplit("@", 1)
    names, dot, top = domain.rpartition(".")
    # Letters of either case are one value; each keeps its case.
    plain = permute(f"{local}@{names}".lower(), key, "email")
    return "".join(p.upper() if c.isupper() else p for p, c in zip(plain, f"{local}@{names}")) + dot + top


def _secret(found: str, key: bytes) -> str | None:
    if not re.fullmatch("[0-9a-f]+", found):
        return permute(found, key, "secret")
    left, right = 16 ** (len(found) // 2), 16 ** (len(found) - len(found) // 2)
    return f"{feistel(int(found, 16), left, right, key, f'hex{len(found)}'):0{len(found)}x}"


_EMAIL = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9](?:[A-Za-z0-9._%+-]{0,62}[A-Za-z0-9])?@(?:[A-Za-z0-9](?:[A-Za-z0-9-]{0,61}[A-Za-z0-9])?\.)+[A-Za-z]{2,24}(?![A-Za-z0-9])")
_SECRET = re.compile(r"(?i)(?:token|secret|passw(?:or)?d|api[_-]?key|access[_-]?key)[\"']?\s*[=:]\s*[\"']?([A-Za-z0-9+/_-]{16,})")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])")
IBAN_LENGTHS = {
    country: length
    for length, countries in {
        15: "NO", 16: "BE", 18: "DK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA",
        23: "AE GI IL IQ TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "FR GR IT MC MR SM",
        28: "AL AZ BY CY DO GT HU LB PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC", 32: "LC",
    }.items()
    for country in countries.split()
}
#: By the first characters; each alternative that matches is validated by its own rule, and a failure tries the next.
_NUMBERS: list[tuple[str, re.Pattern, Callable[[str, bytes], str | None]]] = [
    ("ipv4", re.compile(r"[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?![0-9]|\.[0-9])"), _ipv4),
    ("date", re.compile(r"(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{4}/[0-9]{2}/[0-9]{2}|[0-9]{2}([./])[0-9]{2}\1[0-9]{4})(?![0-9])"), _date),
    ("ssn", re.compile(r"[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"), _ssn),
    ("card", re.compile(r"(?:[0-9]{13,19}|[0-9]{4}([ -])[0-9]{4}\1[0-9]{4}\1[0-9]{1,7}|[0-9]{4}([ -])[0-9]{6}\2[0-9]{4,5})(?![0-9])"), _card),
    ("phone", re.compile(r"(?:\+[0-9]{1,3}[ .-]?)?\([0-9]{2,4}\)[ .-]?[0-9]{2,4}[ .-][0-9]{3,4}(?![0-9])|\+[0-9]{1,3}(?:[ .-]?[0-9]{2,4}){2,5}(?![0-9])|(?:1[ .-])?[0-9]{3}([ .-])[0-9]{3}\1[0-9]{4}(?![0-9])"), _phone),
]
#: A bracket or plus sign before a digit, and the first digit of a number, also that behind the sign.
_START = re.compile(r"\((?=[0-9])|(?<![A-Za-z0-9])(?:\+(?=[0-9])|[0-9])")
_WORDS = [("email", _EMAIL, 0, _email, re.compile("@")), ("secret", _SECRET, 1, _secret, re.compile("(?i)token|secret|passw|key"))]
_IBAN_HINT = re.compile("[A-Z]{2}[0-9]{2}")


def spans(text: str, key: bytes = DEFAULT_KEY) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, pseudonym) of all that is replaced, in order and without overlaps."""
    found: list[tuple[int, int, str, str]] = []
    for kind, pattern, group, make, hint in _WORDS:
        if hint.search(text):
            for m in pattern.finditer(text):
                if (new := make(m[group], key)) is not None:
                    found.append((*m.span(group), kind, new))
    if _IBAN_HINT.search(text):
        found += [(start, end, "iban", new) for start, end, new in _ibans(text, key)]
    taken = sorted(found)
    free = 0
    k = 0
    for m in _START.finditer(text):
        at = m.start()
        if at < free:
            continue
        if at > 1 and text[at - 1] in ".+/-" and "0" <= text[at - 2] <= "9" and at - 1 != free:
            continue  # it goes on with a number that is none of these
        while k < len(taken) and taken[k][1] <= at:
            k += 1
        if k < len(taken) and taken[k][0] <= at:
            continue
        for kind, pattern, make in _NUMBERS:
            if (n := pattern.match(text, at)) and not (k < len(taken) and taken[k][0] < n.end()) and (new := make(n[0], key)) is not None:
                found.append((at, n.end(), kind, new))
                free = n.end()
                break
    out, end = [], 0
    for span in sorted(found):
        if span[0] >= end:
            out.append(span)
            end = span[1]
    return out


def pseudonymized(text: str | None, key: bytes = DEFAULT_KEY) -> tuple[str | None, list[tuple[int, int, str, str]]]:
    if not text:
        return text, []
    found = spans(text, key)
    parts, end = [], 0
    for start, stop, _, new in found:
        parts += [text[end:start], new]
        end = stop
    return "".join([*parts, text[end:]]), found


def pseudonymize(docs: DataFrame, key: bytes | None = None, text: str = "text", into: str = "pii") -> DataFrame:
    """docs with the text replaced, and a struct column `into`, in place of one of that name: of each kind the number of
    replacements. Without a key the one of the session is taken.

    Null and empty texts stay. Rows are replaced one by one, so repeated rows stay alike; no row is moved.
    """
    key = session_key(docs.sparkSession) if key is None else key
    kinds = sorted(["iban"] + [w[0] for w in _WORDS] + [n[0] for n in _NUMBERS])
    schema = "text string, " + ", ".join(f"{kind} int" for kind in kinds)

    @F.pandas_udf(schema)
    def replace(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for value in batch:
                new, found = pseudonymized(value, key)
                rows.append((new, *[sum(kind == f[2] for f in found) for kind in kinds]))
            yield pd.DataFrame(rows, columns=["text", *kinds])
        give_back()

    held = unused(docs, "_pii")
    out = docs.withColumn(held, replace(F.col(f"`{text}`")))
    return out.withColumns({text: F.col(held)["text"], into: F.col(held).dropFields("text")}).drop(held)
