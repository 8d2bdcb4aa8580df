"""Benchmark decontamination by spaced seeds.

A mask is a row of token positions of which some are ignored; the hash of the others is a seed. Seeds of the benchmark
and of the documents are joined, so a changed token spoils only the seeds that look at it. Around a hit the two texts
are laid side by side, and the overlap counts if enough of a window of aligned tokens is equal. Where a text begins or ends inside of
a window, what lies outside counts as changed.

Why no overlap is missed: enumeration of all ways to change a quarter of a window (5 of 20 tokens; of the whole of a shorter
item from 8 tokens on) shows that a mask hits each of them; the tests repeat it. For other windows and shares, the
longest row of equal tokens that each window is sure to hold serves as the only mask. Shorter items must stand whole.

Of hits that follow each other on one alignment only the first is looked at: a window around a later one that does not
reach back to the first can be moved to the left, over tokens that are all equal, until it does. Texts that repeat
themselves therefore cost no more than others, although each of their seeds meets itself wherever it stands.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import arrow_type, cut, prepare
from tidemark.llm.words import U, WordHasher, mix, per_chunk, texts

#: Tokens in a window, and the share of them that must be equal, for which the masks are enumerated.
WINDOW, SHARE = 20, 0.75
#: 1: the token counts; 0: any token may stand there. For items that have a whole window, and for shorter ones.
MASKS, SHORT_MASKS = ("110111", "1001000111", "11111"), ("10111", "111001", "1001011")
#: Items with fewer tokens must stand whole and unchanged.
LEAST_ITEM = 8
#: Hits that are laid side by side at once.
HITS = 50_000
#: Tokens of a benchmark that is sent to all tasks, about 60 bytes each; a larger one is joined by a shuffle of seeds.
BLOCK_TOKENS = 250_000
#: Bits of the filter for the seeds of a larger benchmark (16 MB).
FILTER_BITS = 27


RESULT = ("doc_start", "item_start", "n_tokens", "n_equal")


def token_table() -> np.ndarray:
    """True for bytes of a token: digits, letters and all that is not ASCII."""
    t = np.zeros(256, bool)
    t[48:58] = t[65:91] = t[97:123] = t[128:] = True
    return t


def seeds(h: np.ndarray, mask: str, k: int) -> np.ndarray:
    """Seed at each start in h; shorter by the mask's span less one."""
    n = len(h) - len(mask) + 1
    if n < 1:
        return np.empty(0, U)
    out = np.full(n, U(k + 1))
    for i, c in enumerate(mask):
        if c == "1":
            out = (out + h[i : i + n]) * U(0x9FB21C651E98DF25)
    return mix(out)


def seed_rows(first: np.ndarray, span: int, n: int) -> np.ndarray:
    """Which of n starts have the whole span inside one text."""
    ok = np.ones(n, bool)
    for x in range(1, span):
        at = first[1:-1] - x
        ok[at[(at >= 0) & (at < n)]] = False
    return ok


def masks_for(window: int, share: float) -> list[tuple[str, int, int]]:
    """(mask, least and most tokens of the items that it is for); every mask begins with a 1."""
    whole = min(LEAST_ITEM, window)
    out = [("1" * n, n, n) for n in range(1, whole)]
    if window == WINDOW and share >= SHARE:
        return [(m, WINDOW, 1 << 62) for m in MASKS] + [(m, LEAST_ITEM, WINDOW - 1) for m in SHORT_MASKS] + out
    need = {w: max(1, math.ceil(share * w)) for w in range(whole, window + 1)}
    return [("1" * min(-(-n // (w - n + 1)) for w, n in need.items()), whole, 1 << 62), *out]


def before(s: np.ndarray, first: np.ndarray) -> np.ndarray:
    """For each start the seed one token before it in the same text; 0 where there is none."""
    out = np.zeros(len(s), U)
    out[1:] = s[:-1]
    out[first[:-1][first[:-1] < len(s)]] = 0
    return out


def seeds_of(h: np.ndarray, first: np.ndarray, masks: list[tuple[str, int, int]], items: bool) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(number of the mask, starts, seeds, seeds before them), of seeds whole inside a text; of items, those the mask is for."""
    for k, (mask, least, most) in enumerate(masks):
        s = seeds(h, mask, k)
        ok = np.flatnonzero(seed_rows(first, len(mask), len(s)))
        if items:
            n = np.diff(first)[np.searchsorted(first, ok, "right") - 1]
            ok = ok[(n >= least) & (n <= most)]
        yield k, ok, s[ok], before(s, first)[ok]


class Block:
    """Benchmark items, ready to be looked up in documents."""

    def __init__(self, ids: list, values: list[str], masks: list[tuple[str, int, int]]):
        buf, offsets = texts(pa.array(values, pa.string()))
        self.ids, self.masks = ids, masks
        self.h, self.first = WordHasher(token_table(), lower=True)(buf, offsets)
        _, start, name, prior = (list(x) for x in zip(*seeds_of(self.h, self.first, masks, True), strict=True))
        self.start, name, prior = np.concatenate(start), np.concatenate(name), np.concatenate(prior)
        self.names, self.priors = np.unique(name), np.unique(prior)
        key = np.searchsorted(self.names, name) * (len(self.priors) + 1) + np.searchsorted(self.priors, prior)
        order = np.argsort(key, kind="stable")
        self.key, self.start = key[order], self.start[order]
        self.bits = np.zeros(1 << 20, bool)
        self.bits[(self.names >> U(44)).astype(np.int64)] = True

    def hits(self, at: np.ndarray, s: np.ndarray, prior: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(starts in the document, starts in the items) of equal seeds whose seeds before are not equal as well."""
        on = self.bits[(s >> U(44)).astype(np.int64)]
        at, s, prior = at[on], s[on], prior[on]
        if not len(at) or not len(self.names):
            return
        r = np.minimum(np.searchsorted(self.names, s), len(self.names) - 1)
        on = self.names[r] == s
        at, r, prior = at[on], r[on], prior[on]
        q = np.minimum(np.searchsorted(self.priors, prior), len(self.priors) - 1)
        same = (self.priors[q] == prior) & (prior != 0)
        width = len(self.priors) + 1
        low, high = np.searchsorted(self.key, r * width), np.searchsorted(self.key, (r + 1) * width)
        a = np.where(same, np.searchsorted(self.key, r * width + q), high)
        b = np.where(same, np.searchsorted(self.key, r * width + q, "right"), high)
        n = (a - low) + (high - b)
        ends = np.cumsum(n)
        for x in range(0, int(ends[-1]) if len(n) else 0, HITS):
            hit = np.arange(x, min(x + HITS, int(ends[-1])))
            of = np.searchsorted(ends, hit, "right")
            nth = hit - (ends - n)[of]
            left = (a - low)[of]
            yield at[of], self.start[np.where(nth < left, low[of] + nth, b[of] + nth - left)]


def worth(block: Block, h: np.ndarray, first: np.ndarray, span: int, doc: np.ndarray, ref: np.ndarray, window: int, share: float) -> np.ndarray:
    """(row, item, shift) of the hits (seeds of the span at doc and ref) with a window around them that has enough equal tokens."""
    row, item = np.searchsorted(first, doc, "right") - 1, np.searchsorted(block.first, ref, "right") - 1
    inside = doc + span <= first[row + 1]
    doc, ref, row, item = doc[inside], ref[inside], row[inside], item[inside]
    reach = max(window - span, 0)
    x = np.arange(-reach, span + reach)
    at, to = doc[:, None] + x, ref[:, None] + x
    both = (at >= first[row][:, None]) & (at < first[row + 1][:, None]) & (to >= block.first[item][:, None]) & (to < block.first[item + 1][:, None])
    equal = both & (h[np.clip(at, 0, len(h) - 1)] == block.h[np.clip(to, 0, len(block.h) - 1)])
    same = np.zeros((len(doc), len(x) + 1), np.int64)
    np.cumsum(equal, axis=1, out=same[:, 1:])
    size = min(window, len(x))
    most = (same[:, size:] - same[:, :-size]).max(axis=1, initial=0)
    on = most >= share * np.minimum(window, np.diff(block.first)[item])
    return np.unique(np.stack((row, item, doc - ref), 1)[on], axis=0)


def leaks_in(block: Block, h: np.ndarray, first: np.ndarray, window: int, share: float) -> list[tuple[int, int, int, int, int, int]]:
    """(row, item, first token in the document, in the item, tokens in the window, equal ones): the best of each pair."""
    found = []
    for k, at, s, prior in seeds_of(h, first, block.masks, False):
        found += [worth(block, h, first, len(block.masks[k][0]), doc, ref, window, share) for doc, ref in block.hits(at, s, prior)]
    best: dict = {}
    if found:
        for row, item, shift in np.unique(np.concatenate(found), axis=0).tolist():
            a, b = int(block.first[item]), int(block.first[item + 1])
            lo, hi = max(a, int(first[row]) - shift), min(b, int(first[row + 1]) - shift)
            w = min(window, hi - lo)
            if best.get((row, item), (0,))[0] >= w:
                continue  # it can't be better
            same = np.concatenate(([0], np.cumsum(block.h[lo:hi] == h[lo + shift : hi + shift])))
            runs = same[w:] - same[:-w]
            x = int(runs.argmax())
            if best.get((row, item), (0,))[0] < runs[x]:
                best[row, item] = (int(runs[x]), lo + x + shift - int(first[row]), lo + x - a, w)
    return [(r, i, d, p, w, n) for (r, i), (n, d, p, w) in sorted(best.items())]


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text", window: int = 20, share: float = 0.75, block_tokens: int = BLOCK_TOKENS) -> DataFrame:
    """Overlaps of documents with benchmark items: one row for each pair that has one.

    Returns id, item id, doc_start and item_start (tokens from 0), n_tokens and n_equal of the best aligned window. Tokens
    are rows of ASCII letters, digits and other characters beyond ASCII, in lower case. A pair counts if `share` of a
    window of `window` aligned tokens (the whole item, if that is shorter) is equal; if a text begins or ends inside of the
    window, as many equal tokens are asked for, and n_tokens is less. Items with fewer than 8 tokens count where they stand
    whole. Null and empty texts have no tokens and match nothing. Rows with equal ids, null ids among them, count as one:
    a pair comes once, with its best window. Texts are looked at whole. The benchmark's size is checked first: up to
    block_tokens tokens go to all tasks; a larger one is joined with the documents by their seeds, in one shuffle.
    """
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    items = benchmark.select(F.col(item_col).alias("item"), F.col(item_text_col).alias("text")).where("text is not null")
    (kind, id_type), (item_kind, item_type) = arrow_type(base, "id"), arrow_type(items, "item")
    schema = pa.schema([("id", kind), ("item", item_kind), *((n, pa.int64()) for n in RESULT)])
    ddl = f"id {id_type}, item {item_type}, " + ", ".join(f"{n} long" for n in RESULT)
    tokens = items.agg(F.sum(F.octet_length("text") / 4)).first()[0] or 0
    hasher, masks = WordHasher(token_table(), lower=True), masks_for(window, share)
    if tokens > block_tokens:
        out = by_seeds(base, items, masks, window, share, schema, ddl)
    else:
        rows = items.collect()
        block = Block([r[0] for r in rows], [r[1] for r in rows], masks)

        def step(part, buf, offsets):
            h, first = hasher(buf, offsets)
            found = leaks_in(block, h, first, window, share)
            row, item, *rest = zip(*found, strict=True) if found else ((),) * 6
            return {"id": part.column(0).take(pa.array(row, pa.int64())), "item": pa.array([block.ids[i] for i in item], item_kind)} | dict(zip(RESULT, rest, strict=True))

        out = base.mapInArrow(per_chunk(step, schema), ddl)
    best = out.groupBy("id", "item").agg(F.max(F.struct("n_equal", "n_tokens", (-F.col("doc_start")).alias("d"), (-F.col("item_start")).alias("i"))).alias("b"))
    return best.select(F.col("id").alias(id_col), F.col("item").alias(item_col), (-F.col("b.d")).alias("doc_start"), (-F.col("b.i")).alias("item_start"), "b.n_tokens", "b.n_equal")


def by_seeds(docs: DataFrame, items: DataFrame, masks: list[tuple[str, int, int]], window: int, share: float, schema: pa.Schema, ddl: str) -> DataFrame:
    """Overlaps of a benchmark of any size. Seeds of either side are rows that carry the tokens around them, so that what meets can
    be compared at once; documents send only seeds that a bit filter of the benchmark's seeds lets through."""
    hasher = WordHasher(token_table(), lower=True)

    def rows(name: str, kind: pa.DataType, is_item: bool, bits: np.ndarray | None) -> Callable:
        out = pa.schema([("seed", pa.int64()), (name, kind), ("start", pa.int64()), ("prior", pa.int64()), ("span", pa.int32()), ("size", pa.int64()), ("near", pa.binary()), ("left", pa.int32())])

        def step(part, buf, offsets):
            h, first = hasher(buf, offsets)
            columns = [[] for _ in out]
            for k, at, s, prior in seeds_of(h, first, masks, is_item):
                if bits is not None:
                    on = np.flatnonzero(bits[(s >> U(64 - FILTER_BITS + 3)).astype(np.int64)] >> (s >> U(64 - FILTER_BITS) & U(7)).astype(np.uint8) & 1)
                    at, s, prior = at[on], s[on], prior[on]
                span = len(masks[k][0])
                row = np.searchsorted(first, at, "right") - 1
                lo, hi = np.maximum(at - window + span, first[row]), np.minimum(at + window, first[row + 1])
                values = (s.view(np.int64), row, at - first[row], prior.view(np.int64), np.full(len(at), span), np.diff(first)[row])
                for c, v in zip(columns, (*values, [h[a:b].tobytes() for a, b in zip(lo.tolist(), hi.tolist(), strict=True)], at - lo), strict=True):
                    c.append(v)
            flat = {f.name: [x for v in c for x in v] if f.name == "near" else np.concatenate(c) for f, c in zip(out, columns, strict=True)}
            return flat | {name: part.column(0).take(pa.array(flat[name].astype(np.int64)))}

        return per_chunk(step, out)

    columns = "start long, prior long, span int, size long, near binary, left int"
    of_items = cut(items.mapInArrow(rows("item", schema.field("item").type, True, None), f"seed long, {ddl.split(', ')[1]}, {columns}"))
    place = F.shiftrightunsigned("seed", 64 - FILTER_BITS)
    bits = np.zeros(1 << FILTER_BITS - 3, np.uint8)
    for at, b in of_items.groupBy(F.shiftright(place, 3).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1, CAST(shiftrightunsigned(seed, {64 - FILTER_BITS}) & 7 AS INT))"))).collect():
        bits[at] = b
    of_docs = docs.mapInArrow(rows("id", schema.field("id").type, False, bits), f"seed long, {ddl.split(', ')[0]}, {columns}")
    names = ("start", "prior", "size", "near", "left")
    met = of_docs.withColumnsRenamed({n: f"d_{n}" for n in names}).join(of_items.drop("span").withColumnsRenamed({n: f"i_{n}" for n in names}), "seed")
    met = met.where("d_prior = 0 OR d_prior <> i_prior").select("id", "item", "d_start", "i_start", "span", "i_size", "d_near", "d_left", "i_near", "i_left")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep, found = [], []
            for r, (d, i, span, size, x, xl, y, yl) in enumerate(zip(*(c.to_pylist() for c in batch.columns[2:]), strict=True)):
                x, y, left = np.frombuffer(x, U), np.frombuffer(y, U), min(xl, yl)
                n = left + min(len(x) - xl, len(y) - yl)
                same = np.concatenate(([0], np.cumsum(x[xl - left : xl - left + n] == y[yl - left : yl - left + n])))
                w = min(window, n)
                equal = same[w:] - same[:-w]
                best = int(equal.argmax())
                if equal[best] >= share * min(window, size):
                    keep.append(r)
                    found.append((d - left + best, i - left + best, w, int(equal[best])))
            rest = zip(*found, strict=True) if found else ((),) * 4
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in (0, 1)] + [pa.array(v, pa.int64()) for v in rest], schema=schema)

    return met.mapInArrow(compare, ddl)
