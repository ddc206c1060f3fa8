"""Personal data under format-preserving pseudonyms from a keyed Feistel network.

What is found is validated first (Luhn and IBAN check digits, calendar dates,
address octets), then its letters and digits are permuted inside their own
format: a Feistel network over two halves of the format's number of values,
walked until it lands in range, so the map is a bijection for each key and
format. Equal values get equal pseudonyms in all documents; separators, letter
case, lengths and check digits stay right. Nothing is looked up, so nothing is
shared between tasks.
"""

from __future__ import annotations

import datetime
import hashlib
import math
import re
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cubeguard.llm.common import ship_code

#: For tests and the registered query; a real run gives its own secret.
KEY = b"public test key"
ROUNDS = 8
KINDS = ("email", "iban", "card", "ssn", "ip", "date", "phone")
# The written forms.
PATTERN = re.compile(
    r"(?P<email>(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@(?:[A-Za-z0-9-]{1,63}\.)+[A-Za-z]{2,24})"
    r"|(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9]))"
    r"|(?P<ip>(?<![\w.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\w|\.[0-9]))"
    r"|(?P<date>(?<![\w./-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![\w/-]|\.[0-9]))"
    r"|(?P<ssn>(?<![\w-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![\w-]))"
    r"|(?P<phone>(?<![\w+])\+[0-9]{1,3}(?:[\x20.-]?\([0-9]{1,4}\))?(?:[\x20.-]?[0-9]{2,5}){2,5}(?!\w)"
    r"|(?<![\w(])\([0-9]{3}\)\x20?[0-9]{3}-[0-9]{4}(?!\w)|(?<![\w.-])[0-9]{3}[.-][0-9]{3}[.-][0-9]{4}(?![\w-]))"
    r"|(?P<card>(?<!\w)(?:[0-9]{13,19}|[0-9]{4}(?P<gap>[\x20-])[0-9]{4}(?P=gap)[0-9]{4}(?P=gap)[0-9]{4}|3[0-9]{3}[\x20-][0-9]{6}[\x20-][0-9]{5})(?!\w))", re.ASCII)
_EPOCH, _DAYS = datetime.date(1900, 1, 1).toordinal(), datetime.date(2100, 1, 1).toordinal() - datetime.date(1900, 1, 1).toordinal()
_DATES = {"-": "%Y-%m-%d", ".": "%d.%m.%Y"}
_SPACED = re.compile(r"[^A-Za-z0-9]")
# An IBAN's length by country.
_IBAN_SIZES = {code: size for size, codes in {
    15: "NO", 16: "BE", 18: "DK FK FI FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV", 22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL",
    24: "AD CZ DZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU"}.items() for code in codes.split()}


def permuted(value: int, size: int, key: bytes, tweak: str) -> int:
    """A keyed bijection of range(size)."""
    if size < 2:
        return value
    half = math.isqrt(size - 1) + 1
    while True:
        left, right = divmod(value, half)
        for k in range(ROUNDS):
            seal = hashlib.blake2b(f"{tweak}|{size}|{k}|{right}".encode(), key=key[:64], digest_size=16).digest()
            left, right = right, (left + int.from_bytes(seal, "big")) % half
        value = left * half + right
        if value < size:
            return value


def _radix(chars: str) -> list[tuple[int, int]]:
    """(digit, base) of each character in its own class."""
    return [(ord(c) - 48, 10) if c.isdigit() else (ord(c) - (65 if c.isupper() else 97), 26) for c in chars]


def reshaped(text: str, key: bytes, tweak: str) -> str:
    """Letters and digits permuted inside their classes; all else stays."""
    chars = [c for c in text if c.isascii() and c.isalnum()]
    size = value = 0
    size = 1
    for digit, base in _radix("".join(chars)):
        value, size = value * base + digit, size * base
    value = permuted(value, size, key, tweak + "".join("9" if c.isdigit() else "A" if c.isupper() else "a" for c in chars))
    out = []
    for c in reversed(chars):
        value, digit = divmod(value, 10 if c.isdigit() else 26)
        out.append(chr(digit + (48 if c.isdigit() else 65 if c.isupper() else 97)))
    return "".join(out.pop() if c.isascii() and c.isalnum() else c for c in text)


def _put(form: str, chars: str) -> str:
    own = iter(chars)
    return "".join(next(own) if c.isalnum() else c for c in form)


def luhn(digits: str) -> int:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10


def _email(text: str, key: bytes) -> str:
    name, _, domain = text.rpartition("@")
    host, _, top = domain.rpartition(".")
    whole = reshaped(f"{name}@{host}", key, "email")
    return f"{whole}.{top}"


def _card(text: str, key: bytes) -> str | None:
    digits = _SPACED.sub("", text)
    if luhn(digits) or not digits.strip("0"):
        return None
    body = f"{permuted(int(digits[:-1]), 10 ** (len(digits) - 1), key, 'card'):0{len(digits) - 1}d}"
    return _put(text, body + str(-luhn(body + "0") % 10))


def _mod97(chars: str) -> int:
    return int("".join(str(int(c, 36)) for c in chars)) % 97


def _iban(text: str, key: bytes) -> str | None:
    chars = _SPACED.sub("", text)
    if _mod97(chars[4:] + chars[:4]) != 1:
        return None
    body = reshaped(chars[4:], key, "iban" + chars[:2])
    return _put(text, f"{chars[:2]}{98 - _mod97(body + chars[:2] + '00'):02d}{body}")


def _ends(kind: str, found: str) -> list[int]:
    """Where a found form may end, the likeliest first.

    Behind an IBAN and a space, capitals and digits look like more of it: it ends at its
    country's length, and where that is not known, at any space.
    """
    if kind != "iban":
        return [len(found)]
    spaces = [k for k, c in enumerate(found) if c == " "]
    stops = [len(found), *reversed(spaces)]
    size = _IBAN_SIZES.get(found[:2])
    if size is None:
        return [k for k in stops if k - found.count(" ", 0, k) >= 15]
    return list(dict.fromkeys([*(k for k in stops if k - found.count(" ", 0, k) == size), len(found)]))


def _ip(text: str, key: bytes) -> str | None:
    parts = [int(p) for p in text.split(".")]
    if max(parts) > 255:
        return None
    new = permuted(int.from_bytes(bytes(parts), "big"), 1 << 32, key, "ip")
    return ".".join(map(str, new.to_bytes(4, "big")))


def _date(text: str, key: bytes) -> str | None:
    for form in [_DATES["-"]] if "-" in text else [_DATES["."]] if "." in text else ["%m/%d/%Y", "%d/%m/%Y"]:
        try:
            day = datetime.datetime.strptime(text, form).date().toordinal() - _EPOCH
        except ValueError:
            continue
        if 0 <= day < _DAYS:
            return datetime.date.fromordinal(_EPOCH + permuted(day, _DAYS, key, "date" + form)).strftime(form)
    return None


def _ssn(text: str, key: bytes) -> str | None:
    area, group, serial = text.split("-")
    if area in ("000", "666") or area[0] == "9" or group == "00" or serial == "0000":
        return None
    return reshaped(text, key, "ssn")


def _phone(text: str, key: bytes) -> str | None:
    if not 7 <= len(_SPACED.sub("", text)) <= 15:
        return None
    code = re.match(r"\+[0-9]{1,3}", text)
    kept = code.group() if code and not text[code.end():code.end() + 1].isdigit() else text[:1] if text[0] == "+" else ""
    return kept + reshaped(text[len(kept):], key, "phone")


_MASKS: dict[str, Callable[[str, bytes], str | None]] = {"email": _email, "iban": _iban, "card": _card, "ssn": _ssn, "ip": _ip, "date": _date, "phone": _phone}


def pseudonymised(text: str, key: bytes = KEY) -> tuple[str, list[tuple[str, int, int]]]:
    """The text with pseudonyms, and (kind, start, end) of what was replaced, in the original.

    Where a form does not validate, the search goes on behind its first character.
    """
    out, spans, done, at = [], [], 0, 0
    while m := PATTERN.search(text, at):
        kind = m.lastgroup
        for end in _ends(kind, m.group()):
            if (new := _MASKS[kind](m.group()[:end], key)) is not None:
                break
        else:
            at = m.start() + 1
            while at < m.end() and text[at - 1].isalnum() and text[at].isalnum():
                at += 1  # not into the middle of a run
            continue
        out += [text[done:m.start()], new]
        spans.append((kind, m.start(), m.start() + end))
        done = at = m.start() + end
    return "".join([*out, text[done:]]), spans


_HINT = re.compile(r"@|[0-9]{2}")


def pseudonyms(docs: DataFrame, key: bytes = KEY) -> DataFrame:
    """One row per row of ``docs``: doc_id, text (with pseudonyms), n_<kind> for each kind, spans.

    ``spans`` lists kind:start:end of what was replaced, in code points of the original.
    A null text stays null without spans, an empty one empty; a null doc_id is carried;
    repeated rows get equal results; an empty table gives an empty one. Other columns are
    not read.
    """
    ship_code(docs.sparkSession)
    names = ["doc_id", "text", *(f"n_{k}" for k in KINDS), "spans"]

    def run(batches):
        for batch in batches:
            texts, counts, spans = [], {k: [] for k in KINDS}, []
            for text in batch.column("text").to_pylist():
                new, found = pseudonymised(text, key) if text and _HINT.search(text) else (text, [])
                texts.append(new)
                spans.append(",".join(f"{k}:{a}:{b}" for k, a, b in found))
                for kind in KINDS:
                    counts[kind].append(sum(f[0] == kind for f in found) if found else 0)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string()), *(pa.array(counts[k], pa.int64()) for k in KINDS), pa.array(spans, pa.string())], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(run, "doc_id long, text string, " + ", ".join(f"n_{k} long" for k in KINDS) + ", spans string")
