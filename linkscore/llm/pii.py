"""Personal data replaced by format-preserving pseudonyms.

Numbers that pass their check and dates of the calendar are permuted with a
keyed Feistel network inside their own format: a card number becomes another
valid card number with the same separators, a date another date of the same
notation. The permutation depends on the key and the value alone, so equal
values stay linked across documents, and whoever holds the key can undo it.
Where a new value makes a neighbour read differently, the values of that stretch
are permuted again: undoing comes before linking there.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from datetime import date
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame

from linkscore.llm.batches import slices

ROUNDS = 10
KINDS = ("email", "ip", "card", "iban", "ssn", "phone", "date")

_FIRST_DAY, _LAST_DAY = date(1900, 1, 1).toordinal(), date(2099, 12, 31).toordinal()
_LETTERS = "abcdefghijklmnopqrstuvwxyz"
_MARK = re.compile(r"[0-9]|@")
_EMAIL = re.compile(r"(?<![\w.+-])([A-Za-z0-9]+(?:[._+-][A-Za-z0-9]+)*)(@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,})", re.A)
_IP = re.compile(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?![\d]|\.\d)", re.A)
_DIGIT_RUN = re.compile(r"(?<![\w-])\d(?:[ -]?\d){12,}(?![\w])", re.A)  # groups among which a card number may stand
_GROUP = re.compile(r"[0-9]+")
_IBAN = re.compile(r"(?=\b([A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30})\b)", re.A)  # the longest from each start; shorter ones end at its blanks
_SSN = re.compile(r"(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-])", re.A)
_PHONE = re.compile(r"(?<![\w(])(?:\+1[ .-]?)?(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\w-])|(?<![\w(])\+[2-9]\d{0,2}(?:[ .-]?\d){7,11}(?!\w)", re.A)
_DATE = re.compile(r"(?<![\w./-])(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?=T\d|(?![\w/-]|\.\d))|(?<![\w./-])(\d{1,2})([-/.])(\d{1,2})\6(\d{4})(?=T\d|(?![\w/-]|\.\d))", re.A)
# no rule reaches beyond such a stretch or looks at what lies around it
_STRETCH = re.compile(r"[\w.+@()/-]+(?:(?<=[A-Z0-9)]) (?=[A-Z0-9(])[\w.+@()/-]+)*", re.A)

_LAYOUTS = {(4, 4, 4, 4), (4, 6, 5), (4, 6, 4), (4, 4, 4, 4, 3), *((n,) for n in range(13, 20))}
_CARD_LENGTHS = (16, 15, 14, 13, 19, 18, 17)  # the usual ones first
_LENGTH_COUNTRIES = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBAN_LENGTHS = {country: n for n, countries in _LENGTH_COUNTRIES.items() for country in countries.split()}


class Feistel:
    """Keyed permutation of ``range(size)``: a network on two digits of base ceil(sqrt(size)), walked until it lands inside."""

    def __init__(self, key: bytes, size: int, kind: str):
        self.key, self.size, self.label = key[:64], size, f"{kind}:{size}:".encode()
        self.side = max(2, next(s for s in range(int(size**0.5) - 1, int(size**0.5) + 3) if s >= 0 and s * s >= size)) if size < 1 << 50 else _root(size)

    def _round(self, nth: int, value: int) -> int:
        digest = hashlib.blake2b(self.label + b"%d:%d" % (nth, value), key=self.key, digest_size=16).digest()
        return int.from_bytes(digest, "big") % self.side

    def _once(self, x: int, back: bool) -> int:
        left, right = divmod(x, self.side)
        if back:
            for i in reversed(range(ROUNDS)):
                left, right = (right - self._round(i, left)) % self.side, left
        else:
            for i in range(ROUNDS):
                left, right = right, (left + self._round(i, right)) % self.side
        return left * self.side + right

    def permute(self, x: int, back: bool = False) -> int:
        while True:
            x = self._once(x, back)
            if x < self.size:
                return x


def _root(n: int) -> int:
    """Smallest s with s * s >= n."""
    s = int(n**0.5)
    while s * s >= n:
        s -= 1
    while s * s < n:
        s += 1
    return s


_NETWORKS: dict[tuple[bytes, int, str], Feistel] = {}  # a few sizes by kind


def _network(key: bytes, size: int, kind: str) -> Feistel:
    if (key, size, kind) not in _NETWORKS:
        _NETWORKS[key, size, kind] = Feistel(key, size, kind)
    return _NETWORKS[key, size, kind]


def _digits(text: str) -> str:
    return "".join(c for c in text if c in "0123456789")


def _refill(shape: str, digits: str) -> str:
    """``shape`` with its digits replaced in order."""
    rest = iter(digits)
    return "".join(next(rest) if c in "0123456789" else c for c in shape)


def luhn_digit(body: str) -> str:
    total = 0
    for i, c in enumerate(reversed(body)):
        d = int(c) * (2 if i % 2 == 0 else 1)
        total += d - 9 if d > 9 else d
    return str(-total % 10)


def _number(key: bytes, kind: str, digits: str, back: bool) -> str:
    n = len(digits)
    return str(_network(key, 10**n, f"{kind}{n}").permute(int(digits), back)).zfill(n) if n else ""


def _cards(text: str, odd: bool) -> Iterator[tuple[int, int]]:
    """Stretches of whole groups with the digits of a card, the likeliest first.

    What comes first depends on the grouping alone. ``odd`` are those in unusual
    groups or with mixed separators, which may as well be parts of other numbers.
    """
    for run in _DIGIT_RUN.finditer(text):
        groups = [(m.start(), m.end()) for m in _GROUP.finditer(text, run.start(), run.end())]
        found = []
        for i in range(len(groups)):
            sizes: list[int] = []
            for start, end in groups[i : i + 19]:
                sizes.append(end - start)
                n = sum(sizes)
                if n > 19:
                    break
                if n < 13:
                    continue
                value = text[groups[i][0] : end]
                usual = not (" " in value and "-" in value)
                rank = 0 if usual and tuple(sizes) in _LAYOUTS else 1 if usual and len(sizes) == len(groups) else 2
                if odd == (rank == 2):
                    found.append((rank, _CARD_LENGTHS.index(n) if odd else 0, groups[i][0], end))
        for *_, start, end in sorted(found):
            yield start, end


def _card(value: str, key: bytes, back: bool) -> str | None:
    d = _digits(value)
    if not 13 <= len(d) <= 19 or len(set(d)) == 1:
        return None
    if luhn_digit(d[:-1]) != d[-1]:
        return None
    while True:
        body = _number(key, "card", d[:-1], back)
        d = body + luhn_digit(body)
        if len(set(d)) > 1:
            return _refill(value, d)


def _mod97(text: str) -> int:
    return int("".join(str(int(c, 36)) for c in text)) % 97


def _ibans(text: str) -> Iterator[tuple[int, int]]:
    """From each start what has the length of its country; of unknown countries every length, the longest first."""
    for m in _IBAN.finditer(text):
        start, run = m.start(1), m[1]
        length = _IBAN_LENGTHS.get(run[:2])
        for end in reversed([i for i, c in enumerate(run) if c == " "] + [len(run)]):
            n = end - run.count(" ", 0, end)
            if n == length or (length is None and n >= 15):
                yield start, start + end


def _iban(value: str, key: bytes, back: bool) -> str | None:
    plain = value.replace(" ", "")
    # other check digits may agree too, but are never issued
    if not 2 <= int(plain[2:4]) <= 98 or _mod97(plain[4:] + plain[:4]) != 1:
        return None
    account = _characters(key, "iban", plain[4:], back)
    check = 98 - _mod97(account + plain[:2] + "00")
    rest = iter(plain[:2] + f"{check:02d}" + account)
    return "".join(c if c == " " else next(rest) for c in value)


def _characters(key: bytes, kind: str, text: str, back: bool) -> str:
    """Digits to digits and letters to letters of the same case, the rest unchanged, as one number."""
    bases = [10 if c in "0123456789" else 26 if c.lower() in _LETTERS else 1 for c in text]
    size = value = 1
    for b in bases:
        size *= b
    value = 0
    for c, b in zip(text, bases):
        value = value * b + (int(c) if b == 10 else _LETTERS.index(c.lower()) if b == 26 else 0)
    if size == 1:
        return text
    shape = "".join("d" if b == 10 else "a" if b == 26 else c for c, b in zip(text, bases))
    value = _network(key, size, f"{kind}:{shape}").permute(value, back)
    out = []
    for c, b in zip(reversed(text), reversed(bases)):
        value, digit = divmod(value, b)
        out.append(str(digit) if b == 10 else (_LETTERS[digit].upper() if c.isupper() else _LETTERS[digit]) if b == 26 else c)
    return "".join(reversed(out))


def _email(value: str, key: bytes, back: bool) -> str:
    name, at, domain = value.partition("@")
    return _characters(key, "email", name, back) + at + domain


def _ip(value: str, key: bytes, back: bool) -> str | None:
    parts = value.split(".")
    if any(int(p) > 255 or (len(p) > 1 and p[0] == "0") for p in parts):
        return None
    new = _network(key, 1 << 32, "ip").permute(int.from_bytes(bytes(map(int, parts)), "big"), back)
    return ".".join(map(str, new.to_bytes(4, "big")))


_AREAS = [i for i in range(1, 900) if i != 666]


def _ssn(text: str, key: bytes, back: bool) -> str | None:
    area, group, serial = map(int, text.split("-"))
    if area in (0, 666) or area >= 900 or not group or not serial:
        return None
    value = ((area - 1 - (area > 666)) * 99 + group - 1) * 9999 + serial - 1
    value = _network(key, len(_AREAS) * 99 * 9999, "ssn").permute(value, back)
    value, serial = divmod(value, 9999)
    area, group = divmod(value, 99)
    return f"{_AREAS[area]:03d}-{group + 1:02d}-{serial + 1:04d}"


def _phone(text: str, key: bytes, back: bool) -> str | None:
    d = _digits(text)
    if text.startswith("+") and not text.startswith("+1"):
        keep = 2 if len(d) > 9 else 1  # the country code stays
        return _refill(text, d[:keep] + _number(key, "phone", d[keep:], back))
    lead, local = d[:-10], d[-10:]
    if local[0] in "01" or local[3] in "01":
        if not text.startswith("+1"):
            return None
        # written as a number of the country but in no assigned area: stays so
        while True:
            local = _number(key, "phone", local, back)
            if local[0] in "01" or local[3] in "01":
                return _refill(text, lead + local)
    value = (int(local[0]) - 2) * 10**8 * 8 + int(local[1:3]) * 8 * 10**6 + (int(local[3]) - 2) * 10**6 + int(local[4:])
    value = _network(key, 64 * 10**8, "nanp").permute(value, back)
    value, tail = divmod(value, 10**6)
    value, fourth = divmod(value, 8)
    first, middle = divmod(value, 100)
    return _refill(text, f"{lead}{first + 2}{middle:02d}{fourth + 2}{tail:06d}")


def _date(value: str, key: bytes, back: bool) -> str | None:
    """Year first, or year last with the day before the month; the month first where only that is a date."""
    m = _DATE.fullmatch(value)
    if m[1]:
        order, gap, parts = "ymd", m[2], (m[1], m[3], m[4])
    else:
        order, gap, parts = "dmy", m[6], (m[5], m[7], m[8])
    for notation in (order, "mdy") if order == "dmy" else (order,):
        at = {c: int(p) for c, p in zip(notation, parts)}
        try:
            day = date(at["y"], at["m"], at["d"]).toordinal()
        except ValueError:
            continue
        if not _FIRST_DAY <= day <= _LAST_DAY:
            continue
        found = _dated(key, notation, day, tuple(len(p) for p in parts), back)
        if found is not None:
            return gap.join(found)
    return None


def _dated(key: bytes, notation: str, day: int, widths: tuple[int, ...], back: bool) -> list[str] | None:
    """The permuted day in the notation; walked on until it can be written in the same widths and read the same way."""
    net = _network(key, _LAST_DAY - _FIRST_DAY + 1, "date")
    value = day - _FIRST_DAY
    while True:
        value = net.permute(value, back)
        new = date.fromordinal(value + _FIRST_DAY)
        numbers = {"y": new.year, "m": new.month, "d": new.day}
        out = [str(numbers[c]).zfill(w) for c, w in zip(notation, widths)]
        fits = all(len(o) == w for o, w in zip(out, widths))
        if fits and (notation != "mdy" or new.day > 12):
            return out


def _matches(pattern: re.Pattern) -> Callable[[str], Iterator[tuple[int, int]]]:
    return lambda text: (m.span() for m in pattern.finditer(text))


Span = tuple[int, int, str]  # start, end, kind
Rule = Callable[[str, bytes, bool], str | None]

_RULES: dict[str, Rule] = {"email": _email, "ip": _ip, "card": _card, "iban": _iban, "ssn": _ssn, "phone": _phone, "date": _date}
_ORDER: tuple[tuple[str, Callable[[str], Iterator[tuple[int, int]]]], ...] = (
    ("email", _matches(_EMAIL)),
    ("ip", _matches(_IP)),
    ("iban", _ibans),
    ("card", partial(_cards, odd=False)),
    ("ssn", _matches(_SSN)),
    ("phone", _matches(_PHONE)),
    ("date", _matches(_DATE)),
    ("card", partial(_cards, odd=True)),
)


def _found(text: str) -> list[Span]:
    """Where the values are.

    Kinds are tried in a fixed order and do not overlap: what an earlier kind has
    taken is left alone by later ones.
    """
    taken: list[Span] = []
    used = bytearray(len(text))
    for kind, candidates in _ORDER:
        for start, end in candidates(text):
            if used.find(1, start, end) < 0 and _RULES[kind](text[start:end], b"", False) is not None:
                taken.append((start, end, kind))
                used[start:end] = b"\1" * (end - start)
    return sorted(taken)


def _permuted(text: str, spans: list[Span], key: bytes, back: bool) -> tuple[str, list[Span]]:
    """The text with the values at the spans permuted once, and the spans there: an address may change its length."""
    out, places, at, shift = [], [], 0, 0
    for start, end, kind in spans:
        new = _RULES[kind](text[start:end], key, back)
        out += [text[at:start], new]
        places.append((start + shift, start + shift + len(new), kind))
        at, shift = end, shift + len(new) - (end - start)
    return "".join(out) + text[at:], places


def _stretch(text: str, key: bytes, back: bool) -> str:
    """The stretch with its values permuted until the same ones are found again."""
    spans = _found(text)
    while spans:
        text, spans = _permuted(text, spans, key, back)
        if _found(text) == spans:
            break
    return text


def pseudonymise(text: str, key: bytes, back: bool = False) -> tuple[str, list[Span]]:
    """The text with its personal data permuted, and ``(start, end, kind)`` in the input's code points.

    ``back`` undoes the permutation; whoever knows the key can do so, hence there is
    no key by default.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    if not _MARK.search(text):
        return text, []
    spans = _found(text)
    new, places = _permuted(text, spans, key, back)
    if spans and _found(new) != places:
        new = _STRETCH.sub(lambda m: _stretch(m[0], key, back) if _MARK.search(m[0]) else m[0], text)
    return new, spans


def pseudonymise_documents(docs: DataFrame, key: bytes, back: bool = False) -> DataFrame:
    """``doc_id, text`` (null stays null), a count per kind, ``n_replaced`` and ``spans`` of every row.

    Rows are independent: repeated ids stay, other columns are left out, empty
    texts have nothing to replace, texts of any length are read whole, no rows give
    no rows.
    """
    if not key:
        raise ValueError("pseudonyms need a key")

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for table in slices(batch):
                texts, spans, counts = [], [], []
                for text in table["text"].to_pylist():
                    new, found = pseudonymise(text, key, back) if text else (text, [])
                    kinds = [k for _, _, k in found]
                    texts.append(new)
                    counts.append([*map(kinds.count, KINDS), len(kinds)])
                    spans.append(",".join(f"{k}:{a}:{b}" for a, b, k in found))
                yield pa.RecordBatch.from_arrays(
                    [table["doc_id"].cast(pa.int64()).combine_chunks(), pa.array(texts, pa.string()), *[pa.array(x, pa.int64()) for x in zip(*counts)], pa.array(spans, pa.string())],
                    names=["doc_id", "text", *[f"n_{k}" for k in KINDS], "n_replaced", "spans"],
                )

    numbers = ", ".join(f"n_{k} long" for k in (*KINDS, "replaced"))
    return docs.select("doc_id", "text").mapInArrow(work, f"doc_id long, text string, {numbers}, spans string")
