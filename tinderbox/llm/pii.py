"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Four base kinds are always reported when their own rule holds. Further kinds need a checksum or a
telling word close by: each proposal has a prior, a confirmed checksum and context words raise it,
words of another subject lower it, and spans at or above `MIN_SCORE` are reported.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tinderbox.llm.common import by_position, slices

Span = tuple[int, int]
KINDS = ("email", "ip", "card", "phone", "iban", "ssn")
MIN_SCORE = 0.6
WINDOW = 48

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]+)+")
# A digit run is tried once, at its first digit: later starts in it could only fail the same way.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}(?![A-Za-z0-9])")
SSN = re.compile(r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])")
DIGITS = re.compile(r"[0-9]")

# Words that speak for or against a kind when they stand within WINDOW characters of a proposal.
FOR = {
    "card": re.compile(r"\b(?:card|credit|debit|visa|mastercard|amex|kreditkarte|tarjeta|carte)\b", re.I),
    "iban": re.compile(r"\b(?:iban|account|bank|bic|konto|cuenta|compte)\b", re.I),
    "ssn": re.compile(r"\b(?:ssn|social\x20security|taxpayer)\b", re.I),
}
AGAINST = re.compile(r"\b(?:isbn|order|invoice|serial|version|part|sku|tracking)\b", re.I)
# Prior of a proposal, and what a confirmed checksum adds.
PRIOR = {"card": (0.2, 0.3), "iban": (0.2, 0.6), "ssn": (0.3, 0.0)}
CONTEXT_BONUS = 0.4
CONTEXT_MALUS = 0.4


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        if i % 2:
            d = d * 2 - 9 if d > 4 else d * 2
        total += d
    return total % 10 == 0


def mod97(iban: str) -> bool:
    """ISO 13616: country and check digits move to the end, letters count from 10, remainder is 1."""
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def emails(text: str) -> list[Span]:
    """Leftmost, non-overlapping: from each @ back over the local part, then over the domain."""
    out, floor, at = [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > floor and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at + 1) if start < at else None
        if found:
            floor = found.end()
            out.append((start, floor))
        at = text.find("@", max(at + 1, floor))
    return out


def ips(text: str) -> list[Span]:
    def small(part: str) -> bool:
        part = part.lstrip("0")
        return len(part) < 3 or (len(part) == 3 and part <= "255")

    return [m.span() for m in IP.finditer(text) if all(map(small, m.group().split(".")))]


def cards(text: str, least: int = 16, most: int = 19) -> list[Span]:
    out = []
    for m in CARD.finditer(text):
        if m.end() - m.start() < least:
            continue
        digits = m.group().replace(" ", "").replace("-", "")
        if least <= len(digits) <= most and luhn(digits):
            out.append(m.span())
    return out


def phones(text: str) -> list[Span]:
    return [m.span() for m in PHONE.finditer(text) if 8 <= len(DIGITS.findall(m.group())) <= 15] if "+" in text else []


def scored(text: str) -> list[tuple[str, int, int, float]]:
    """Proposals of the further kinds with their scores."""
    proposals = [("card", s, e, True) for s, e in cards(text, 13, 15)]
    for m in IBAN.finditer(text):
        if mod97(m.group().replace(" ", "")):
            proposals.append(("iban", *m.span(), True))
    for m in SSN.finditer(text):
        area, group, serial = m.group().split("-")
        if area not in ("000", "666") and area < "900" and group != "00" and serial != "0000":
            proposals.append(("ssn", *m.span(), False))
    out = []
    for kind, start, end, confirmed in proposals:
        near = f"{text[max(0, start - WINDOW) : start]} {text[end : end + WINDOW]}"
        prior, bonus = PRIOR[kind]
        score = prior + bonus * confirmed
        score += CONTEXT_BONUS * bool(FOR[kind].search(near)) - CONTEXT_MALUS * bool(AGAINST.search(near))
        out.append((kind, start, end, round(score, 6)))
    return out


def base_spans(text: str) -> dict[str, list[Span]]:
    return {"email": emails(text), "ip": ips(text), "card": cards(text), "phone": phones(text)}


def all_spans(text: str) -> list[tuple[str, int, int]]:
    """Base spans and accepted further ones, by kind as in KINDS, then by start."""
    found = [(k, s, e) for k, spans in base_spans(text).items() for s, e in spans]
    taken = {k: spans for k, spans in base_spans(text).items()}
    for kind, start, end, score in scored(text):
        if score >= MIN_SCORE and not any(s < end and start < e for s, e in taken.get(kind, ())):
            found.append((kind, start, end))
    return sorted(found, key=lambda x: (KINDS.index(x[0]), x[1]))


def joined(spans: list[tuple[str, int, int]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def masked(text: str) -> str:
    """The text with every reported span replaced by its kind, as in `[email]`; of overlapping
    spans, the one that starts first (then the longest, then the first kind) gives the name."""
    out, at = [], 0
    for kind, start, end in sorted(all_spans(text), key=lambda x: (x[1], -x[2], KINDS.index(x[0]))):
        if start >= at:
            out += [text[at:start], f"[{kind}]"]
        at = max(at, end)
    return "".join(out) + text[at:]


def _detector() -> Callable:
    def detect(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            rows = []
            for text in batch.column("text").to_pylist():
                base = base_spans(text or "")
                plain = joined([(k, s, e) for k in ("email", "ip", "card", "phone") for s, e in base[k]])
                counts = [len(base[k]) for k in ("email", "ip", "card", "phone")]
                rows.append((*counts, sha256(plain.encode()).hexdigest(), joined(all_spans(text or ""))))
            cols = list(zip(*rows, strict=True))
            kinds = [pa.int64()] * 4 + [pa.string()] * 2
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *(pa.array(c, k) for c, k in zip(cols, kinds, strict=True))],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"],
            )

    return detect


def find_pii(docs: DataFrame) -> DataFrame:
    """One row per document: counts of the base kinds, a digest of the base spans, and all spans.

    Positions are code points, ends exclusive. Null and empty texts have no spans. Documents are judged one by one,
    so null ids and repeated rows get rows of their own; other columns are not read. Work on a text
    is linear in its length, but for the short windows around proposals.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string").alias("text")).mapInArrow(
        _detector(),
        f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string",
    )


def mask_pii(docs: DataFrame) -> DataFrame:
    """The same rows and columns, whatever these are named, with the spans of `text` replaced; null texts stay null,
    repeated rows are masked each, and no rows give no rows. An `n_chars` column, if there is one, follows the new text."""
    names, at = docs.columns, docs.columns.index("text")

    def mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts = [None if t is None else masked(t) for t in batch.column(at).to_pylist()]
            cols = [pa.array(texts, batch.schema.field(i).type) if i == at else batch.column(i) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

    out = by_position(docs, mask)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return out
