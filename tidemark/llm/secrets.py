"""Secret scans: fixed patterns, and strings whose characters are too even for words.

Candidates are strings of 20 characters or more that keys can be written in. A window slides over each; the counts of its
characters are updated by the one that enters and the one that leaves, and so is its Shannon entropy. Each class of
characters has its own bound. Strings on the allow-list, and those that mix no letters with digits, are left alone.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import arrow_type, prepare

KINDS = ("assign", "access", "hex", "entropy")
ASSIGN = re.compile(r"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{16,}")
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=-]{20,}")
WINDOW = 20
#: Bits a character that a window must exceed, by class: a window of n different characters has log2(n).
CLASSES = ((re.compile(r"[0-9a-fA-F]+"), 2.9), (re.compile(r"[A-Za-z0-9]+"), 3.6), (re.compile(r"[A-Za-z0-9+/_=-]+"), 3.7))
ALLOWED = re.compile(r"example|sample|placeholder|changeme|lorem|abcdefgh|0123456|1234567|x{6}|[0-9a-f]{8}-[0-9a-f]{4}-[0-9a-f]{4}-|^https?|^www", re.IGNORECASE)
PLOGP = [0.0, *(c * math.log2(c) for c in range(1, WINDOW + 1))]


def even(text: str, bound: float) -> tuple[int, int] | None:
    """(start, end) of the part covered by windows above the bound, from the first to the last; None if there is none."""
    counts: dict[str, int] = {}
    total, first, last, size = 0.0, None, 0, min(WINDOW, len(text))
    for i, c in enumerate(text):
        if i >= size:
            old = text[i - size]
            n = counts[old]
            total += PLOGP[n - 1] - PLOGP[n]
            counts[old] = n - 1
        n = counts.get(c, 0)
        total += PLOGP[n + 1] - PLOGP[n]
        counts[c] = n + 1
        if i >= size - 1 and math.log2(size) - total / size > bound:
            first, last = (i - size + 1 if first is None else first), i + 1
    return None if first is None else (first, last)


def united(spans: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """The (start, end) that spans cover together, in order and apart from each other."""
    out: list[tuple[int, int]] = []
    for a, _, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(out[-1][1], b)
        else:
            out.append((a, b))
    return out


def scan(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of all spans, in order; in code points. Kinds are numbers of KINDS."""
    found, low = [], text.lower()
    if "passw" in low or "secret" in low or "token" in low or "key" in low:
        found += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 12]
    if "AKIA" in text:
        found += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text) if m.end() - m.start() >= 18]
    found += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    base, k = united(found), 0  # candidates come in order, so one walk along base is enough
    for m in CANDIDATE.finditer(text):
        s = m[0]
        if not any(c.isdigit() for c in s) or not any(c.isalpha() for c in s) or ALLOWED.search(s):
            continue
        bound = next(b for pattern, b in CLASSES if pattern.fullmatch(s))
        if part := even(s, bound):
            a, b = m.start() + part[0], m.start() + part[1]
            while k < len(base) and base[k][1] <= a:
                k += 1
            if k == len(base) or base[k][0] >= b:
                found.append((a, 3, b))
    return sorted(found)


def find_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, spans array<struct<kind, start, end>>) for each row of docs, spans by start, then kind.

    Patterns assign, access and hex are found leftmost first, each for itself; entropy spans that overlap one of these are
    left out. A null text counts as empty. Rows are scanned one by one, whatever their ids, and every row is returned. Texts
    are scanned whole, in time that grows with their length. An empty table gives an empty one; other columns are not read.
    """
    prepare(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind, id_type = arrow_type(rows, "id")
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = [[{"kind": KINDS[k], "start": a, "end": b} for a, k, b in scan(t)] for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(kind), pa.array(out, pa.list_(span))], ["id", "spans"])

    return rows.mapInArrow(run, f"id {id_type}, spans array<struct<kind: string, start: bigint, end: bigint>>").withColumnRenamed("id", id_col)
