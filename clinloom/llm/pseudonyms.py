"""Format-preserving pseudonyms by keyed Feistel permutations.

Values are found by format and then validated: card numbers (13 to 19 digits, Luhn), IBANs (modulo 97),
social security numbers, phone numbers of ten digits with area code, dates (ISO, a time may follow, day.month.year,
month/day/year; those from 1900 to 2099 among themselves and so the others), IPv4 addresses and e-mail addresses. A valid value is numbered within the set of valid values of
its own format, the number goes through a keyed permutation of that set (a balanced Feistel network over
the next even number of bits, walked until it lands in the set again), and the image is written in the
same format, with its check digits made anew. So a pseudonym is valid where the value was, equal values
have equal pseudonyms in all documents, different ones have different ones, and the key's owner can
turn it back. Digits that fail validation stay.

Other digits or capitals may stand beside a card number or an IBAN, a blank between. Within a run of them
every start and end where a value of the kind may stand alone is validated, and the leftmost valid value is
taken, of its ends one of the country's IBAN length or else the last. So about one in ten stretches of 13 to 19
digits in rows of numbers passes for a card. Turning text back reads the pseudonyms in the same way; beside other
digits it may take another end than was written, and there ``found`` tells the places.

Nulls and edge cases: a null text stays null with no findings; empty texts stay; an empty table gives no rows;
other columns pass through, but ``found`` replaces one of its name; repeated and very long
texts are handled whole; overlapping finds go to the leftmost, then the kind first in ``KINDS``. A
permutation may map a value to itself, with a probability of one by the size of its set (one in 10 ** 10
for a phone number).
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clinloom.llm.common import add_columns

ROUNDS = 10
KINDS = ("email", "iban", "ip", "date", "phone", "ssn", "card")
_EDGE, _STOP = r"(?<![\w.+-])", r"(?![\w-])(?!\.\d)"
PATTERNS = {
    "email": re.compile(r"(?<![\w.+-])[A-Za-z0-9][A-Za-z0-9._+-]*@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,}(?![\w-])", re.A),
    "iban": re.compile(_EDGE + r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?" + _STOP, re.A),
    "ip": re.compile(_EDGE + r"\d{1,3}\.\d{1,3}\.\d{1,3}\.\d{1,3}" + _STOP, re.A),
    "date": re.compile(_EDGE + r"(?:\d{4}-\d\d-\d\d(?=T\d\d:)|(?:\d{4}-\d\d-\d\d|\d\d\.\d\d\.\d{4}|\d\d/\d\d/\d{4})" + _STOP + ")", re.A),
    "phone": re.compile(r"(?<![\w.+(-])(?:\+\d{1,3}[ .-])?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}" + _STOP, re.A),
    "ssn": re.compile(_EDGE + r"\d{3}-\d\d-\d{4}" + _STOP, re.A),
    "card": re.compile(_EDGE + r"\d(?:[ -]?\d){12,18}" + _STOP, re.A),
}
#: Runs that hold a card number or an IBAN, and the value alone at a place in them.
_RUNS = {
    "iban": (re.compile(r"(?<![A-Z0-9])[A-Z0-9]{2,}+(?: [A-Z0-9]+)*+", re.A), re.compile(r"[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?", re.A)),
    "card": (re.compile(r"(?<!\d)\d(?:[ -]?\d){12,}+", re.A), re.compile(r"\d(?:[ -]?\d){12,18}", re.A)),
}
_STARTS, _ENDS = re.compile(_EDGE + r"(?=[A-Z0-9])", re.A), re.compile(r"(?<=[A-Z0-9])" + _STOP, re.A)
#: Longest value of a kind, blanks included.
_LONGEST = {"iban": 43, "card": 37}
IBAN_LENGTHS = {
    c: int(n)
    for n, *countries in map(
        str.split,
        ("15 NO", "16 BE", "18 DK FI FO GL NL SD", "19 MK SI", "20 AT BA EE KZ LT LU XK", "21 CH HR LI LV", "22 BG BH CR DE GB GE IE ME RS VA",
         "23 AE GI IL IQ OM TL", "24 AD CZ ES MD PK RO SA SE SK TN VG", "25 LY PT ST", "26 IS TR", "27 FR GR IT MC MR SM",
         "28 AL AZ BY CY DO GT HU LB PL SV", "29 BR EG PS QA UA", "30 JO KW MU", "31 MT SC", "32 LC", "33 RU"),
    )
    for c in countries
}
FIRST_DAY, LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
#: Characters that are permuted as one number.
MOST_CHARS = 128
_LETTERS = "abcdefghijklmnopqrstuvwxyz"


class Permutation:
    """Keyed permutations of {0 .. size-1}, one for each (name, size)."""

    def __init__(self, key: bytes):
        if len(key) < 16:
            raise ValueError("the key needs 16 bytes or more")
        self.key = hashlib.sha256(key).digest()

    def _round(self, name: bytes, k: int, half: int, bits: int) -> int:
        data = half.to_bytes(bits // 8 + 1, "big")
        out = hashlib.blake2b(name + bytes([k]) + data, key=self.key, digest_size=min(64, bits // 8 + 8)).digest()
        return int.from_bytes(out, "big") & (1 << bits) - 1

    def _pass(self, name: bytes, x: int, bits: int, back: bool) -> int:
        left, right = x >> bits, x & (1 << bits) - 1
        for k in reversed(range(ROUNDS)) if back else range(ROUNDS):
            if back:
                left, right = right ^ self._round(name, k, left, bits), left
            else:
                left, right = right, left ^ self._round(name, k, right, bits)
        return left << bits | right

    def __call__(self, name: str, x: int, size: int, back: bool = False, inside: Callable[[int], bool] = lambda _: True) -> int:
        """The image of ``x``; ``inside`` tells members of a smaller set that holds x and its image."""
        bits = max(1, (max(size - 1, 1).bit_length() + 1) // 2)
        tag = f"{name}:{size}".encode()
        y = self._pass(tag, x, bits, back)
        while y >= size or not inside(y):
            y = self._pass(tag, y, bits, back)
        return y


def luhn(digits: str) -> int:
    """Check digit for ``digits``."""
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (2 - i % 2)
        total += d - 9 * (d > 9)
    return -total % 10


def _radix(chars: str) -> list[str]:
    """The alphabet of each letter or digit, empty for what stays."""
    kinds = []
    for c in chars:
        kinds.append("0123456789" if c.isdigit() else _LETTERS if c in _LETTERS else _LETTERS.upper() if c in _LETTERS.upper() else "")
    return kinds


def _permute_chars(permute: Permutation, name: str, chars: str, back: bool) -> str:
    if len(chars) > MOST_CHARS:  # piece by piece, each place with a permutation of its own
        pieces = [chars[k : k + MOST_CHARS] for k in range(0, len(chars), MOST_CHARS)]
        return "".join(_permute_chars(permute, f"{name}#{k}", x, back) for k, x in enumerate(pieces))
    kinds, x, size = _radix(chars), 0, 1
    for c, kind in zip(chars, kinds, strict=True):
        if kind:
            x, size = x * len(kind) + kind.index(c), size * len(kind)
    # the shape is part of the permutation's name: each format has its own
    y = permute(name + ":" + "".join(k[:1] or c for c, k in zip(chars, kinds, strict=True)), x, size, back)
    out = []
    for c, kind in zip(reversed(chars), reversed(kinds), strict=True):
        if kind:
            y, r = divmod(y, len(kind))
            c = kind[r]
        out.append(c)
    return "".join(reversed(out))


def _fill(shape: str, digits: str) -> str:
    """``shape`` with its letters and digits replaced in order."""
    left = iter(digits)
    return "".join(next(left) if c.isalnum() else c for c in shape)


def _is_card(text: str) -> bool:
    digits = text.replace(" ", "").replace("-", "")
    return 13 <= len(digits) <= 19 and luhn(digits[:-1]) == int(digits[-1]) and len(set(digits)) > 1


def _card(permute, text, back):
    if not _is_card(text):
        return None
    digits = re.sub(r"\D", "", text)
    n = len(digits) - 2  # the leading digit, which names the industry, stays; the last one checks
    head = digits[0]
    same = lambda y: len(set(head + f"{y:0{n}d}")) > 1  # noqa: E731  as repeated digits are no card
    body = head + f"{permute(f'card:{head}', int(digits[1:-1]), 10**n, back, same):0{n}d}"
    return _fill(text, body + str(luhn(body)))


def _rest(plain: str) -> int:
    return int("".join(str(int(c, 36)) for c in plain)) % 97


def _is_iban(text: str) -> bool:
    plain = text.replace(" ", "")
    return 15 <= len(plain) <= 34 and _rest(plain[4:] + plain[:4]) == 1


def _iban(permute, text, back):
    if not _is_iban(text):
        return None
    plain = text.replace(" ", "")
    body = _permute_chars(permute, "iban:" + plain[:2], plain[4:], back)
    return _fill(text, plain[:2] + f"{98 - _rest(body + plain[:2] + '00'):02d}" + body)


def _ip(permute, text, back):
    parts = text.split(".")
    if any(int(p) > 255 or str(int(p)) != p for p in parts):
        return None
    x = int.from_bytes(bytes(map(int, parts)), "big")
    return ".".join(map(str, permute("ip", x, 1 << 32, back).to_bytes(4, "big")))


def _date(permute, text, back):
    order = "ymd" if text[4] == "-" else "dmy" if text[2] == "." else "mdy"
    sep = re.search(r"\D", text)[0]
    part = dict(zip(order, map(int, text.split(sep)), strict=True))
    try:
        day = date(part["y"], part["m"], part["d"]).toordinal()
    except ValueError:
        return None
    span = LAST_DAY - FIRST_DAY + 1
    if FIRST_DAY <= day <= LAST_DAY:
        day = FIRST_DAY + permute("date", day - FIRST_DAY, span, back)
    else:  # days of other centuries are permuted among themselves
        y = permute("other date", day - 1 if day < FIRST_DAY else day - 1 - span, date.max.toordinal() - span, back)
        day = 1 + y + (span if 1 + y >= FIRST_DAY else 0)
    to = date.fromordinal(day)
    return sep.join(f"{to.year:04d}" if p == "y" else f"{to.month if p == 'm' else to.day:02d}" for p in order)


def _phone(permute, text, back):
    country = re.match(r"\+\d+[ .-]", text)
    head = country[0] if country else ""
    digits = re.sub(r"\D", "", text[len(head) :])
    return head + _fill(text[len(head) :], f"{permute('phone:' + re.sub(r'[^0-9]', '', head), int(digits), 10**10, back):010d}")


def _ssn(permute, text, back):
    valid = lambda x: 0 < x // 10**6 < 900 and x // 10**6 != 666 and x // 10**4 % 100 and x % 10**4
    x = int(text.replace("-", ""))
    if not valid(x):
        return None
    return _fill(text, f"{permute('ssn', x, 10**9, back, lambda y: bool(valid(y))):09d}")


def _email(permute, text, back):
    stem, dot, top = text.rpartition(".")
    return _permute_chars(permute, "email", stem, back) + dot + top


_REWRITE = {"email": _email, "iban": _iban, "ip": _ip, "date": _date, "phone": _phone, "ssn": _ssn, "card": _card}


def pseudonym(permute: Permutation, kind: str, text: str, back: bool = False) -> str | None:
    """The pseudonym of a value, or with ``back`` the value of a pseudonym; None if it isn't
    valid."""
    return _REWRITE[kind](permute, text, back)


_VALID = {"card": _is_card, "iban": _is_iban}


def _inside(kind: str, text: str) -> list[tuple[int, int]]:
    """Spans of the valid values of ``kind``, leftmost first, each the longest at its start or for an IBAN one
    of its country's length."""
    spans, (run, alone) = [], _RUNS[kind]
    for m in run.finditer(text):
        at = m.start()
        ends = [e.start() for e in _ENDS.finditer(text, at, m.end() + 2) if e.start() <= m.end()]
        for s in _STARTS.finditer(text, at, m.end()):
            start = s.start()
            if start < at or not alone.match(text, start, m.end()):
                continue
            low = bisect.bisect_left(ends, start + 13)
            good = [e for e in ends[low : bisect.bisect_right(ends, start + _LONGEST[kind])] if alone.fullmatch(text, start, e) and _VALID[kind](text[start:e])]
            if good:
                length = IBAN_LENGTHS.get(text[start : start + 2]) if kind == "iban" else None
                at = next((e for e in good if e - start - text.count(" ", start, e) == length), good[-1])
                spans.append((start, at))
    return spans


def find(text: str) -> list[tuple[int, int, str]]:
    """Candidate (start, end, kind) in order; card numbers and IBANs are valid, other kinds are validated later."""
    spans = []
    for rank, kind in enumerate(KINDS):
        if kind == "email" and "@" not in text:
            continue
        if kind in _RUNS:
            spans += [(start, rank, end, kind) for start, end in _inside(kind, text)]
        else:
            spans += [(m.start(), rank, m.end(), kind) for m in PATTERNS[kind].finditer(text)]
    return [(a, b, k) for a, _, b, k in sorted(spans)]


def rewrite(text: str, permute: Permutation, back: bool = False) -> tuple[str, list[tuple[int, int, str]]]:
    """The text with pseudonyms, and the spans of the values in the text given."""
    out, at, done = [], 0, []
    for start, end, kind in find(text) if _HAS(text) else ():
        if start < at:
            continue
        new = pseudonym(permute, kind, text[start:end], back)
        if new is not None:
            out += [text[at:start], new]
            at = end
            done.append((start, end, kind))
    return ("".join(out) + text[at:], done) if done else (text, done)


_HAS = re.compile(r"[0-9@]").search


def pseudonymise(df: DataFrame, key: bytes, text: str = "text", back: bool = False) -> DataFrame:
    """``df`` with ``text`` rewritten, and ``found``: spans of the values as array<struct<start, end,
    kind>> in the text as it was."""
    at = df.columns.index(text)
    spans = "array<struct<start:int,end:int,kind:string>>"

    def make():
        permute = Permutation(key)

        def work(part):
            texts, found = [], []
            for t in part.column(at).to_pylist():
                new, done = rewrite(t, permute, back) if t else (t, [])
                texts.append(new)
                found.append([{"start": a, "end": b, "kind": k} for a, b, k in done])
            return [texts, found]

        return work

    return add_columns(df, f"`{text}` string, found {spans}", make)


def op1(documents: DataFrame, key: bytes) -> DataFrame:
    """Per document: doc_id, text with pseudonyms, n_found, spans (kind:start:end, comma-joined, of the
    text as it was)."""
    done = pseudonymise(documents.select("doc_id", "text"), key)
    joined = F.array_join(F.transform("found", lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return done.select("doc_id", "text", F.size("found").cast("long").alias("n_found"), joined.alias("spans"))
