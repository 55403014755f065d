"""Secret scans with multipart credential linking.

Strong spans stand alone. Weak parts (identifiers, loosely named secrets, endpoints) are only reported where
complementary parts lie within one scope: sorted parts are joined on the interval between them.
"""

from __future__ import annotations

import bisect
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .store import table

KINDS = ("assign", "access", "hex", "ident", "weak", "endpoint")
#: Code points between two parts of one credential, and between parts and the further ones they bring in.
SCOPE = 240
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
#: Weak parts by kind.
IDENT = re.compile(r"""\b(?:user(?:name|_?id)?|login|account(?:_?id)?|client_?id|access_?key_?id|key_?id|tenant(?:_?id)?)["']?\x20*[:=]\x20*["']?([A-Za-z0-9@._-]{3,})""", re.ASCII | re.IGNORECASE)
WEAK = re.compile(r"""\b(?:pass|pwd|passphrase|password|passwd|secret|token|api_?key|auth|credential|client_?secret|private_?key)["']?\x20*[:=]\x20*["']?([^\s"',;]{6,})""", re.ASCII | re.IGNORECASE)
ENDPOINT = re.compile(r"""\b(?:(?:https?|ftp|ssh|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb|redis|amqp)://[^\s"'<>]+|(?:host|hostname|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._-]{3,}(?::\d+)?)""", re.ASCII | re.IGNORECASE)
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
_WEAK_WORDS = ("pass", "pwd", "auth", "credential", "private", *_ASSIGN_WORDS)
#: Which sides complement each kind. A strong span is a secret or, for access, an identifier.
_SIDE = {"assign": "secret", "access": "ident", "hex": "secret", "ident": "ident", "weak": "secret", "endpoint": "endpoint"}
SPANS = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string"

_HEXDIGIT = np.zeros(256, bool)
_HEXDIGIT[[*range(48, 58), *range(97, 103)]] = True


def has_hex(data: np.ndarray) -> bool:
    """True if 16 bytes in a row are lower-case hex digits: any such run holds every 16th byte's place."""
    if len(data) < 16:
        return False
    for k in np.flatnonzero(_HEXDIGIT[data[15::16]]) * 16 + 15:
        a = b = int(k)
        while a and _HEXDIGIT[data[a - 1]]:
            a -= 1
        while b + 1 < len(data) and b - a < 15 and _HEXDIGIT[data[b + 1]]:
            b += 1
        if b - a >= 15:
            return True
    return False


def base_spans(text: str, low: str | None = None, hexes: bool = True) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) of strong spans, in code points."""
    low = text.lower() if low is None else low
    found: list[tuple[int, int, int]] = []
    if any(w in low for w in _ASSIGN_WORDS):
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    if hexes:
        found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(found)


def _near(starts: list[int], reach: list[int], at: int, end: int, scope: int) -> bool:
    """Whether an interval overlaps at - scope .. end + scope. starts are sorted; reach[k] is the greatest end up to k."""
    k = bisect.bisect_right(starts, end + scope)
    return k > 0 and reach[k - 1] >= at - scope


def link_weak(strong: list[tuple[int, int, int]], weak: list[tuple[int, int, int]], scope: int = SCOPE) -> list[tuple[int, int, int]]:
    """The weak parts with complements in scope: a secret needs an identifier or endpoint, an identifier needs a
    secret, an endpoint needs both."""
    sides: dict[str, tuple[list[int], list[int]]] = {}
    for side in ("secret", "ident", "endpoint"):
        own = [(a, b) for a, k, b in sorted([*strong, *weak]) if _SIDE[KINDS[k]] == side]
        sides[side] = [a for a, _ in own], list(np.maximum.accumulate([b for _, b in own])) if own else []
    near = lambda side, a, b: _near(*sides[side], a, b, scope)
    kept = []
    for a, k, b in weak:
        side = _SIDE[KINDS[k]]
        if side == "secret":
            ok = near("ident", a, b) or near("endpoint", a, b)
        elif side == "ident":
            ok = near("secret", a, b)
        else:
            ok = near("secret", a, b) and near("ident", a, b)
        if ok:
            kept.append((a, k, b))
    return kept


def weak_spans(text: str, low: str, strong: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Weak parts that overlap no strong span."""
    if not strong and not any(w in low for w in _WEAK_WORDS):
        return []
    found = []
    for number, pattern in ((3, IDENT), (4, WEAK), (5, ENDPOINT)):
        found += [(m.start(), number, m.end()) for m in pattern.finditer(text)]
    starts, ends = [s[0] for s in strong], list(np.maximum.accumulate([s[2] for s in strong])) if strong else []
    return [x for x in sorted(found) if not (starts and (k := bisect.bisect_left(starts, x[2])) and ends[k - 1] > x[0])]


def scan(text: str, data: np.ndarray | None = None) -> tuple[list[tuple[int, int, int]], list[tuple[int, int, int]]]:
    """Strong spans, and all spans, by start and then kind."""
    low = text.lower()
    strong = base_spans(text, low, data is None or has_hex(data))
    weak = weak_spans(text, low, strong)
    return strong, sorted([*strong, *link_weak(strong, weak)]) if weak else strong


def joined(spans: list[tuple[int, int, int]]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def _rows(batch: pa.RecordBatch, column: int) -> Iterator[tuple[str, np.ndarray]]:
    for value in batch.column(column):
        raw = value.as_buffer() if value.is_valid else None
        yield (str(raw.to_pybytes(), "utf-8", "replace"), np.frombuffer(raw, np.uint8)) if raw is not None and raw.size else ("", np.zeros(0, np.uint8))


def find_secrets(docs: DataFrame) -> DataFrame:
    """Spans of every document. Null text is empty and has none; null or repeated doc_id are kept; other columns are
    not read. Each document is scanned whole, in linear time in its parts, with no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for text, data in _rows(batch, 1):
                strong, spans = scan(text, data)
                kinds = [k for _, k, _ in strong]
                out.append((*(kinds.count(k) for k in range(3)), hashlib.sha256(joined(strong).encode()).hexdigest(), joined(spans)))
            columns = list(zip(*out, strict=True)) if out else [()] * 5
            kinds_ = (pa.int64(),) * 3 + (pa.string(),) * 2
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, t) for c, t in zip(columns, kinds_, strict=True))], names=[x.split()[0] for x in SPANS.split(", ")])

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SPANS)


def redact(docs: DataFrame, mark: str = "[SECRET]") -> DataFrame:
    """documents with every span replaced by `mark` (overlapping spans by one) and n_chars counted anew; other columns stay
    whatever they are called. Null text stays null, texts of any length are scanned whole, and an empty table gives an
    empty one."""

    def hide(text: str, data: np.ndarray) -> str:
        spans = scan(text, data)[1]
        if not spans:
            return text
        parts, at, end = [], 0, -1
        for a, _, b in spans:
            if a >= end:
                parts += [text[at:a], mark]
            end = at = max(end, b)
        return "".join([*parts, text[at:]])

    names = docs.columns
    k = names.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(k)
            clean = pa.array([hide(*x) if valid else None for x, valid in zip(_rows(batch, k), column.is_valid().to_pylist(), strict=True)], pa.string())
            yield pa.RecordBatch.from_arrays([clean if j == k else batch.column(j) for j in range(batch.num_columns)], names=names)

    hidden = docs.withColumn("text", F.col("text").cast("string")).mapInArrow(run, docs.withColumn("text", F.col("text").cast("string")).schema)
    return hidden.withColumn("n_chars", F.coalesce(F.length("text"), F.lit(0)).cast("long")).select(*names) if "n_chars" in names else hidden


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(table(spark, sf_dir, "documents"))
