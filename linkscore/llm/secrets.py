"""Secret scan with linking of the parts of a credential.

Strong patterns count alone. Weak ones (a long mixed string, an account name, a
service address) are common in clean text; an interval join within a document
reports them only where parts that complement each other stand close together:
a secret with an access identifier, or a secret with an endpoint.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from linkscore.llm.batches import slices

REACH = 200  # code points that a scope extends around a part
KINDS = ("assign", "access", "hex", "weak_access", "weak_secret", "weak_endpoint")

# fixed values: the base patterns
_ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A | re.I)
_KEYWORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")  # a shorter run of these letters holds no match
_HEX = re.compile(r"[0-9a-f]{24,}")

_WEAK_ACCESS = re.compile(r"""\b(?:client_?id|access_?id|account|user(?:name)?|login)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@_.-]{3,})""", re.A | re.I)
# an equals sign before a candidate assigns it; it belongs to a candidate only as padding
_WEAK_SECRET = re.compile(r"(?<![A-Za-z0-9+/_-])(?=[A-Za-z0-9+/_-]*[0-9])(?=[A-Za-z0-9+/_-]*[A-Z])(?=[A-Za-z0-9+/_-]*[a-z])[A-Za-z0-9+/_-]{16,}={0,2}", re.A)
_WEAK_ENDPOINT = re.compile(r"""\b(?:https?|ftp|jdbc:\w+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+""", re.A | re.I)
_DIGIT = re.compile(r"[0-9]")

Span = tuple[int, int, int]  # start, kind, end


def base_spans(text: str) -> list[Span]:
    """Leftmost non-overlapping matches of each base kind, the too short ones dropped."""
    found: list[Span] = []
    low = text.lower()
    if any(k in low for k in _KEYWORDS):
        found += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if m.end(2) - m.start(2) >= 6]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text)]
    found += [(m.start(), 2, m.end()) for m in _HEX.finditer(text)]
    return sorted(found)


def weak_spans(text: str) -> list[Span]:
    """Candidates that need a partner. An address ends where a secret assigned inside it begins."""
    found: list[Span] = []
    secret = [(m.start(), 4, m.end()) for m in _WEAK_SECRET.finditer(text)] if _DIGIT.search(text) else []
    if "://" in text:
        assigned = [a for a, _, _ in secret if text[a - 1 : a] == "="]
        for m in _WEAK_ENDPOINT.finditer(text):
            nth = bisect_left(assigned, m.start())
            found.append((m.start(), 5, min([m.end(), *assigned[nth : nth + 1]])))
    if "=" in text or ":" in text:
        found += [(m.start(), 3, m.end()) for m in _WEAK_ACCESS.finditer(text)]
    return sorted(found + secret)


def _meets(span: Span, others: list[Span], ends: list[int], reach: int) -> bool:
    """Whether one of the spans, sorted by start, lies within ``reach`` of ``span`` without overlapping it.

    ``ends`` are running maxima of the ends, so the first span that ends late
    enough is found by bisection, and the join costs the matches it looks at.
    """
    start, _, end = span
    for i in range(bisect_left(ends, start - reach), len(others)):
        a, _, b = others[i]
        if a > end + reach:
            return False
        if b >= start - reach and (b <= start or a >= end):
            return True
    return False


def linked(base: list[Span], weak: list[Span], reach: int = REACH) -> list[Span]:
    """Weak spans with a complementary part in their scope and no overlap with a base span.

    Roles: identifiers are ``access`` and ``weak_access``; secrets ``assign``,
    ``hex`` and ``weak_secret``; endpoints ``weak_endpoint``. A weak secret needs
    an identifier or an endpoint; a weak identifier or endpoint needs a secret.
    """
    if not weak:
        return []

    def side(kinds: tuple[int, ...]) -> tuple[list[Span], list[int]]:
        own = sorted(s for s in (*base, *weak) if s[1] in kinds)
        ends, most = [], 0
        for s in own:
            most = max(most, s[2])
            ends.append(most)
        return own, ends

    secrets, others = side((0, 2, 4)), side((1, 3, 5))
    out = []
    for s in weak:
        if any(a < s[2] and s[0] < b for a, _, b in base):
            continue
        if _meets(s, *(others if s[1] == 4 else secrets), reach):
            out.append(s)
    return out


def written(spans: list[Span]) -> str:
    """kind:start:end by start, then kind, comma-joined; code points, end exclusive."""
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def scan(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """``doc_id, n_assign, n_access, n_hex, base_spans, spans`` of every row.

    A null text is an empty one and has no spans; texts of any length are read
    whole. Rows are independent: repeated ids stay, other columns are left out, no
    rows give no rows.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for table in slices(batch):
                counts, strong, every = [], [], []
                for text in table["text"].to_pylist():
                    base = base_spans(text or "")
                    kinds = [s[1] for s in base]
                    counts.append((kinds.count(0), kinds.count(1), kinds.count(2)))
                    strong.append(written(base))
                    every.append(written(base + linked(base, weak_spans(text or ""), reach)))
                yield pa.RecordBatch.from_arrays(
                    [table["doc_id"].cast(pa.int64()).combine_chunks(), *[pa.array(x, pa.int64()) for x in zip(*counts)], pa.array(strong, pa.string()), pa.array(every, pa.string())],
                    names=["doc_id", "n_assign", "n_access", "n_hex", "base_spans", "spans"],
                )

    return docs.select("doc_id", "text").mapInArrow(
        work, "doc_id long, n_assign long, n_access long, n_hex long, base_spans string, spans string"
    )
