"""Personal data replaced by format-preserving pseudonyms.

Values found in a text are validated, ranked within their format (a number from 0 to the number of values of that
format), permuted there by a keyed Feistel network, and written back in the same format: card
numbers stay valid by their check digit, dates stay dates, addresses keep their shape. The permutation
depends on the key and the format alone, so equal values have equal pseudonyms in all documents, different
values different ones, and who holds the key can undo it. No value is its own pseudonym.
"""

from __future__ import annotations

import datetime
import hashlib
import re
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from catalograph.llm.tables import text_slices

ROUNDS = 8

# ---------------------------------------------------------------- the permutation


def _feistel(key: bytes, tweak: str, half: int, value: int, rounds: range) -> int:
    """Balanced network over 2 * half bits; reversed rounds undo it."""
    mask = (1 << half) - 1
    left, right = value >> half, value & mask
    size = (half + 7) // 8
    forward = rounds.step > 0
    for number in rounds:
        given = right if forward else left
        digest = b""
        while len(digest) < size:
            digest += hashlib.blake2b(f"{tweak}|{number}|{len(digest)}|{given}".encode(), key=key).digest()
        mixed = int.from_bytes(digest[:size], "big") & mask
        left, right = (right, left ^ mixed) if forward else (right ^ mixed, left)
    return left << half | right


def _walk(key: bytes, tweak: str, size: int, value: int, rounds: range) -> int:
    """Repeat until the value is back inside the format; a walk of about 4 steps at most on average."""
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    value = _feistel(key, tweak, half, value, rounds)
    while value >= size:
        value = _feistel(key, tweak, half, value, rounds)
    return value


@lru_cache(maxsize=50_000)
def permute(key: bytes, tweak: str, size: int, value: int, step: int = 1) -> int:
    """A keyed permutation of 0..size-1 without fixed point (for size > 1); ``step=-1`` undoes it.

    It is one step along a single keyed cycle through all values: back to the place on the cycle, one on, forth.
    """
    place = _walk(key, tweak, size, value, range(ROUNDS - 1, -1, -1))
    return _walk(key, tweak, size, (place + step) % size, range(ROUNDS))


def _digits(key: bytes, tweak: str, digits: str, step: int) -> str:
    return str(permute(key, f"{tweak}{len(digits)}", 10 ** len(digits), int(digits), step)).zfill(len(digits))


def _refill(shape: str, digits: str) -> str:
    """The digits of ``shape`` replaced in order, everything else kept."""
    left = iter(digits)
    return "".join(next(left) if "0" <= c <= "9" else c for c in shape)


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


# ---------------------------------------------------------------- formats

def luhn_digit(digits: str) -> str:
    """Check digit that makes ``digits`` + it valid."""
    total = 0
    for place, char in enumerate(reversed(digits)):
        number = int(char) * (2 if place % 2 == 0 else 1)
        total += number - 9 if number > 9 else number
    return str(-total % 10)


def card(key: bytes, text: str, step: int) -> str | None:
    """13 to 19 digits, spaces or hyphens between, with a right check digit: all but first and check digit move."""
    digits = _only_digits(text)
    if not 13 <= len(digits) <= 19 or luhn_digit(digits[:-1]) != digits[-1]:
        return None
    body = digits[0] + _digits(key, "card" + digits[0], digits[1:-1], step)
    return _refill(text, body + luhn_digit(body))


def spaced_card(key: bytes, text: str, step: int) -> str | None:
    """A card, or the card before a last group that is not part of it.

    Pseudonyms that make a card with that group are passed over, so the same digits are found again.
    """
    if (new := card(key, text, step)) or len(re.findall(_BLANK, text)) < 4:
        return new
    cut = len(text) - re.search(_BLANK, text[::-1]).end()
    new, rest = text[:cut], text[cut:]
    while (new := card(key, new, step)) and card(key, new + rest, step):
        pass
    return new


def phone(key: bytes, text: str, step: int) -> str | None:
    """A country code after +, then 7 to 12 digits in groups (10 after +1); the code stays. Groups that follow
    a whole number are not part of it."""
    code = re.match(r"\+(\d{1,3})(?=\D)", text) or re.match(r"\+(1|7|\d\d)", text)
    low, high = (10, 10) if code[1] == "1" else (7, 12)
    while text:
        digits = _only_digits(text)[len(code[1]):]
        if low <= len(digits) <= high:
            return _refill(text, code[1] + _digits(key, "phone" + code[1], digits, step))
        shorter = re.sub(r"[ \u00a0.-]\(?\d+\)?\Z", "", text)
        text = shorter if shorter != text else ""
    return None


def local_phone(key: bytes, text: str, step: int) -> str:
    """Three, three and four digits with brackets or one kind of separator.

    Parted by blanks, the first two groups begin with 2 to 9, as area and exchange codes do, and stay so.
    """
    digits = _only_digits(text)
    if not re.search(_BLANK, text) or "(" in text:
        return _refill(text, _digits(key, "phone1", digits, step))
    rank = ((int(digits[:3]) - 200) * 800 + int(digits[3:6]) - 200) * 10_000 + int(digits[6:])
    rank, line = divmod(permute(key, "phone1 blanks", 800 * 800 * 10_000, rank, step), 10_000)
    area, exchange = divmod(rank, 800)
    return _refill(text, f"{area + 200}{exchange + 200}{line:04d}")


def social(key: bytes, text: str, step: int) -> str | None:
    """Area, group and serial number as issued: no 000, 666 or 9xx area, no 00 group, no 0000 serial."""
    area, group, serial = int(text[:3]), int(text[4:6]), int(text[7:])
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    rank = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    rank, serial = divmod(permute(key, "social", 898 * 99 * 9999, rank, step), 9999)
    area, group = divmod(rank, 99)
    return f"{area + 1 + (area >= 665):03d}{text[3]}{group + 1:02d}{text[3]}{serial + 1:04d}"


def address(key: bytes, text: str, step: int) -> str | None:
    """Four octets up to 255 without leading zeros; each keeps its number of digits."""
    octets = text.split(".")
    if any(int(o) > 255 or (o[0] == "0" and len(o) > 1) for o in octets):
        return None
    ranges = [{1: (0, 10), 2: (10, 90), 3: (100, 156)}[len(o)] for o in octets]
    rank, size = 0, 1
    for octet, (low, number) in zip(octets, ranges):
        rank, size = rank * number + int(octet) - low, size * number
    rank = permute(key, "address" + "".join(str(len(o)) for o in octets), size, rank, step)
    out = []
    for low, number in reversed(ranges):
        rank, rest = divmod(rank, number)
        out.append(str(rest + low))
    return ".".join(reversed(out))


_FIRST_DAY, _DAYS = datetime.date(1900, 1, 1).toordinal(), 73_049  # to 2099-12-31


def date(key: bytes, text: str, step: int) -> str | None:
    """Year first, or year last after month and day in an order that makes a real day (day first if both do)."""
    parts = re.split(r"\D", text)
    mark = text[len(parts[0])]
    orders = ((0, 1, 2),) if len(parts[0]) == 4 else ((2, 1, 0), (2, 0, 1))
    for order in orders:
        try:
            rank = datetime.date(*(int(parts[i]) for i in order)).toordinal() - _FIRST_DAY
        except ValueError:
            continue
        if not 0 <= rank < _DAYS:
            return None
        # One order of days for all notations. A pseudonym that would read day first is passed over where the
        # value reads month first only, so either notation stays a permutation of its own days.
        while True:
            rank = permute(key, "date", _DAYS, rank, step)
            day = datetime.date.fromordinal(rank + _FIRST_DAY)
            if order != (2, 0, 1) or day.day > 12:
                break
        values = {order[0]: f"{day.year:04d}", order[1]: f"{day.month:02d}", order[2]: f"{day.day:02d}"}
        return mark.join(values[i] for i in range(3))
    return None


@lru_cache(maxsize=None)
def _short_days(first: int, second: int) -> tuple[list[tuple[int, int, int]], dict[tuple[int, int, int], int]]:
    """All (first, second, year) with numbers of so many digits that are a day and month in either order."""
    def real(year, month, day):
        try:
            return bool(datetime.date(year, month, day))
        except ValueError:
            return False

    spans = [range(1, 10) if digits == 1 else range(10, 32) for digits in (first, second)]
    days = [(a, b, y) for y in range(1900, 2100) for a in spans[0] for b in spans[1] if real(y, b, a) or real(y, a, b)]
    return days, {day: n for n, day in enumerate(days)}


def short_date(key: bytes, text: str, step: int) -> str | None:
    """Day and month in either order, at least one without a leading zero, and the year: moves among those of its widths."""
    first, mark, second, year = re.fullmatch(r"(\d{1,2})(\D)(\d{1,2})\D(\d{4})", text).groups()
    if "0" in (first[0], second[0]):
        return None
    days, places = _short_days(len(first), len(second))
    place = places.get((int(first), int(second), int(year)))
    if place is None:
        return None
    a, b, y = days[permute(key, f"date{len(first)}{len(second)}", len(days), place, step)]
    return f"{a}{mark}{b}{mark}{y}"


_IBAN_SIZES = dict(pair.split(":") for pair in (
    "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BI:27 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DJ:27 DK:18 "
    "DO:28 EE:20 EG:29 ES:24 FI:18 FK:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HN:28 HR:21 HU:28 IE:22 IL:23 "
    "IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MN:20 MR:27 "
    "MT:31 MU:30 NI:28 NL:18 NO:15 OM:23 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 RU:33 SA:24 SC:31 SD:18 SE:24 SI:19 "
    "SK:24 SM:27 SO:23 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20 YE:30").split())
_IBAN_SIZES = {country: int(size) for country, size in _IBAN_SIZES.items()}


def iban(key: bytes, text: str, step: int) -> str | None:
    """Two letters, two check digits, 11 to 30 letters or digits, valid modulo 97; the check digits are computed.

    Of a longer text the value of the country's length is taken if a space follows it. In lower case the country must
    be a known one.
    """
    def check(country: str, body: str) -> str:
        return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"
    plain = re.sub(_BLANK, "", text)
    if text != text.upper() and (text[:2].upper() not in _IBAN_SIZES or text[:2] != text[:2].lower()):
        return None
    if (size := _IBAN_SIZES.get(text[:2].upper(), len(plain))) < len(plain):
        # the pattern took in what follows a value of this country
        ends = [m.end() for m in re.finditer("[A-Za-z0-9]", text)]
        end = ends[size - 1]
        return iban(key, text[:end], step) if re.match(_BLANK, text[end]) else None
    country, body = plain[:2], plain[4:]
    if not 11 <= len(body) <= 30 or check(country, body) != plain[2:4]:
        return None
    moved = _letters(key, "iban" + country.upper(), body, step)
    left = iter(country + check(country, moved) + moved)
    return "".join(c if re.match(_BLANK, c) else next(left) for c in text)


def _letters(key: bytes, tweak: str, text: str, step: int) -> str:
    """Digits stay digits, lower- and upper-case ASCII letters stay such, anything else stays as it is."""
    kinds = [("0", 10) if "0" <= c <= "9" else ("a", 26) if "a" <= c <= "z" else ("A", 26) if "A" <= c <= "Z" else None
             for c in text]
    rank, size = 0, 1
    for char, kind in zip(text, kinds):
        if kind:
            rank, size = rank * kind[1] + ord(char) - ord(kind[0]), size * kind[1]
    if size == 1:
        return text
    shape = "".join(k[0] if k else c for c, k in zip(text, kinds))
    rank = permute(key, tweak + shape, size, rank, step)
    out = []
    for char, kind in zip(reversed(text), reversed(kinds)):
        if kind:
            rank, rest = divmod(rank, kind[1])
            char = chr(ord(kind[0]) + rest)
        out.append(char)
    return "".join(reversed(out))


def mail(key: bytes, text: str, step: int) -> str | None:
    """The local part moves; the domain is kept."""
    local, domain = text.rsplit("@", 1)
    moved = "".join(_letters(key, "mail@" + domain.lower() + (f"@{at}" if at else ""), local[at:at + 64], step)
                    for at in range(0, len(local), 64))
    return None if moved == local else f"{moved}@{domain}"


def secret(key: bytes, text: str, step: int) -> str | None:
    """A hexadecimal or alphanumeric key of at least 16 characters; a known prefix stays."""
    if re.fullmatch(r"[0-9a-f]+|[0-9A-F]+", text) and re.search(r"[a-fA-F]", text):
        moved = f"{permute(key, f'hex{len(text)}', 16 ** len(text), int(text, 16), step):0{len(text)}x}"
        return moved.upper() if re.search("[A-F]", text) else moved
    prefix = re.match(r"(?:AKIA|ASIA|gh[pousr]_|sk-|pk-|xox[abp]-|AIza)?", text)[0]
    return prefix + _letters(key, "secret" + prefix, text[len(prefix):], step)


# One pass over the text; the alternatives begin with a character that is rare in prose.
_FOUND = re.compile(
    r"(?P<address>(?<![\w.])\d{1,3}(?:\.\d{1,3}){3}(?![\w]|\.\d))"
    r"|(?P<social>(?<![\w-])\d{3}(?P<a>[- \u00a0])\d{2}(?P=a)\d{4}(?![\w-]))"
    r"|(?P<date>(?<![\w./-])(?:\d{4}(?P<b>[-/.])\d{2}(?P=b)\d{2}|\d{2}(?P<c>[-/.])\d{2}(?P=c)\d{4})(?!(?!T\d\d:\d)[\w/-]|\.\d))"
    r"|(?P<short_date>(?<![\w./-])\d{1,2}(?P<d>[-/.])\d{1,2}(?P=d)\d{4}(?!(?!T\d\d:\d)[\w/-]|\.\d))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}(?:[ \u00a0.-]?\(\d{1,4}\)|[ \u00a0.-]?\d{1,4})(?:[ \u00a0.-]?\d{2,4}){1,4}(?!\w))"
    r"|(?P<local_phone>(?<![\w(-])(?:\(\d{3}\)[ \u00a0]?\d{3}-\d{4}|\d{3}-\d{3}-\d{4}|\d{3}\.\d{3}\.\d{4}"
    r"|(?<!\d[ \u00a0])[2-9]\d\d(?P<e>[ \u00a0])[2-9]\d\d(?P=e)\d{4}(?![ \u00a0]\d))(?![\w-]))"
    r"|(?P<card>(?<![\w-])(?:\d{4}(?P<f>[ \u00a0-])\d{4}(?P=f)\d{4}(?P=f)(?:\d{4}(?P=f)\d{1,3}|\d{1,7})"
    r"|\d{4}(?P<g>[ \u00a0-])\d{6}(?P=g)\d{5}|\d{13,19})(?![\w-]))", re.ASCII)
_BLANK = "[ \u00a0]"
_IBAN = re.compile(r"\b[A-Za-z]{2}\d{2}(?:[ \u00a0]?[A-Za-z0-9]{4}){2,7}(?:[ \u00a0]?[A-Za-z0-9]{1,3})?\b", re.ASCII)
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"[^\W_]+(?:-+[^\W_]+)*(?:\.[^\W_]+(?:-+[^\W_]+)*)+")
_SECRET = re.compile(
    r"(?P<named>(?<![A-Za-z])(?i:token|secret|passwd|password|api[_-]?key|access[_-]?key|auth)[\"']?\s{0,3}[:=]\s{0,3}[\"']?)"
    r"(?P<value>[A-Za-z0-9_\-]{16,128})(?![A-Za-z0-9_])"
    r"|(?<![A-Za-z0-9_])(?P<known>(?:AKIA|ASIA)[A-Z0-9]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk-[A-Za-z0-9]{20,64}|AIza[A-Za-z0-9_-]{35})"
    r"(?![A-Za-z0-9_])", re.ASCII)
_NUMBERS: dict[str, Callable] = {"address": address, "social": social, "date": date, "short_date": short_date, "phone": phone,
                                 "local_phone": local_phone, "card": spaced_card}
_HINTS = ("oken", "OKEN", "ecret", "ECRET", "assw", "ASSW", "ey", "EY", "uth", "UTH", "AKIA", "ASIA", "gh", "sk-", "AIza")
_DIGIT = re.compile("[0-9]")


def _replace(text: str, spans: list[tuple[int, int, str]]) -> str:
    out, at = [], 0
    for start, end, value in sorted(spans):
        if start >= at:
            out += (text[at:start], value)
            at = end
    return "".join((*out, text[at:]))


def pseudonymise(text: str, key: bytes, step: int = 1) -> tuple[str, int]:
    """The text with its values replaced, and their number; ``step=-1`` restores them."""
    spans: list[tuple[int, int, str]] = []
    at = text.find("@")
    while at >= 0:
        domain = _DOMAIN.match(text, at + 1)
        start = at
        while domain and start and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (new := mail(key, text[start:domain.end()], step)):
            spans.append((start, domain.end(), new))
        at = text.find("@", at + 1)
    if _DIGIT.search(text):
        if any(hint in text for hint in _HINTS):
            for m in _SECRET.finditer(text):
                group = "value" if m["value"] else "known"
                if _DIGIT.search(m[group]):
                    spans.append((m.start(group), m.end(group), secret(key, m[group], step)))
        m = _FOUND.search(text)
        while m:
            kind = next(name for name in _NUMBERS if m[name])
            new = _NUMBERS[kind](key, m[0], step)
            if new:  # as long as what it replaces
                spans.append((m.start(), m.start() + len(new), new))
            m = _FOUND.search(text, m.start() + (len(new) if new else 1))
        m = _IBAN.search(text)
        while m:
            new = iban(key, m[0], step)
            if new:
                spans.append((m.start(), m.start() + len(new), new))
            m = _IBAN.search(text, m.start() + (len(new) if new else 1))
    # where two values overlap the one that starts first counts, the longer of two that start together
    spans.sort(key=lambda s: (s[0], -s[1]))
    kept: list[tuple[int, int, str]] = []
    for span in spans:
        if not kept or span[0] >= kept[-1][1]:
            kept.append(span)
    return (_replace(text, kept) if kept else text), len(kept)


# ---------------------------------------------------------------- over DataFrames

def pseudonym_column(text: Column, key: bytes) -> Column:
    """Struct (text, replaced) of a text column; a null text stays null with 0 replaced."""

    @F.arrow_udf("text string, replaced int")
    def of(columns: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for column in columns:
            texts, numbers = [], []
            for slice_ in text_slices(column):
                for new, number in (pseudonymise(t, key) for t in slice_):
                    texts.append(new)
                    numbers.append(number)
            out = pa.array(texts, pa.string())
            if column.null_count:
                out = pc.if_else(column.is_null(), pa.scalar(None, pa.string()), out)
            yield pa.StructArray.from_arrays([out, pa.array(numbers, pa.int32())], ["text", "replaced"])

    return of(text)


def pseudonymised(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id, text, replaced)`` per row of ``docs``; repeated rows stay, an empty table gives none.

    A null text stays null, an empty one empty, with 0 replaced. A text of any length is read whole. Of overlapping
    values the one that starts first counts, of two that start together the longer.
    """
    return (docs.select(F.col(id_col).alias("id"), pseudonym_column(F.col(text_col), key).alias("p"))
            .select("id", "p.text", "p.replaced"))


def with_pseudonyms(docs: DataFrame, key: bytes, text_col: str = "text") -> DataFrame:
    """``docs`` with values in ``text_col`` replaced; all other columns and the length of the texts are unchanged.

    Null, empty, long and overlapping values as in ``pseudonymised``; repeated rows stay, an empty table gives none.
    """
    return docs.select(*[pseudonym_column(F.col(f"`{c}`"), key)["text"].alias(c) if c == text_col else F.col(f"`{c}`")
                         for c in docs.columns])
