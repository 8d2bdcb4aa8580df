"""Best-fit packing of token sequences, planned over a histogram of lengths.

Lengths up to the capacity are a bounded set, so the plan is made from their counts alone: longest first, each length
goes to the fullest open sequences that have room, many equal sequences at a time. A piece then finds its place in the
plan by its rank among the pieces of its length.
"""

from __future__ import annotations

import gc
import re
import sys
import types
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tables import arrow_type, cut, prepare

#: Words that a worker remembers, about 200 bytes each.
CACHE_WORDS = 600_000
#: Bytes of text that are split at once; the more, the fewer times a word is looked up.
BATCH_BYTES = 1 << 22
# Characters for which the pattern below is known to split as the tokenizer does (tests compare them one by one).
SAFE = re.compile("[\t-\r -~\x85\xa0-įı-ſ]*")
ASCII_SPLIT = re.compile("[a-z]+|[0-9]|'(?:[stmd]|re|ve|ll)|[^\t-\r a-z0-9]+")
SPLIT = re.compile("'(?:[stmd]|re|ve|ll)|[a-zªµºß-öø-ſ]+|[0-9²³¹¼½¾]|[^\t-\r \x85\xa0a-zªµºß-öø-ſ0-9²³¹¼½¾]+")


class TokenCoder:
    """Texts to little-endian 32-bit ids. Words already seen come from a bounded cache; what the fast pattern is not known
    to split rightly goes to the tokenizer whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for w, i in vocabulary.items() if w.endswith("</w>")]] = True
        self.cache: dict[str, bytes] = {}

    def whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def learn(self, words: list[str]) -> dict[str, bytes]:
        out: dict[str, bytes] = {}
        for a in range(0, len(words), 20_000):
            some = words[a : a + 20_000]
            ids = np.array(self.tokenizer.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, "<u4")
            stop = np.flatnonzero(self.ends[ids]) + 1
            if len(stop) == len(some) and stop[-1] == len(ids):
                raw, cuts = ids.tobytes(), [0, *(stop * 4).tolist()]
                out.update((w, raw[i:j]) for w, i, j in zip(some, cuts, cuts[1:], strict=False))
            else:
                out.update((w, self.whole(w)) for w in some)
        return out

    def __call__(self, values: list[str]) -> list[bytes]:
        split = [(ASCII_SPLIT if x.isascii() else SPLIT).findall(x.lower()) if SAFE.fullmatch(x) and "<|" not in x else None for x in values]
        seen: set[str] = set()
        for words in split:
            seen.update(words or ())
        known = self.cache.get
        here = {w: known(w) for w in seen}  # small enough to stay in the processor's cache while the ids are joined
        if new := sorted(w for w, ids in here.items() if ids is None):
            learnt = self.learn(new)
            here |= learnt
            if len(self.cache) > CACHE_WORDS:
                self.cache = here
            else:
                self.cache |= learnt
        get = here.__getitem__
        return [self.whole(x) if w is None else b"".join(map(get, w)) for x, w in zip(values, split, strict=True)]


def coder_for(path: str) -> TokenCoder:
    """This worker's coder: what it has learnt serves its later tasks too."""
    state = sys.modules.setdefault("_tidemark_worker", types.ModuleType("_tidemark_worker"))
    if getattr(state, "path", None) != path:
        state.path, state.coder = path, TokenCoder(path)
    return state.coder


def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list, list[str]]]:
    """(ids, texts) of about BATCH_BYTES, or one longer text."""
    ids, values, size = [], [], 0
    for batch in batches:
        for i, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            if size and size + len(x) > BATCH_BYTES:
                yield ids, values
                ids, values, size = [], [], 0
            ids.append(i)
            values.append(x)
            size += len(x) + 1
    if values:
        yield ids, values


def best_fit(counts: np.ndarray, capacity: int) -> np.ndarray:
    """Plan rows (length, first rank, first sequence, pieces in each sequence, offset) for counts[length] pieces.

    Rank t of a row goes to sequence first + t // pieces, at offset + t % pieces * length. Runs over sequences are handled
    together; their number depends on the lengths, not on the number of pieces.
    """
    lanes: dict[int, list[tuple[int, int]]] = {}
    room = np.zeros(capacity + 1, bool)
    plan, opened = [], 0
    for length in np.flatnonzero(counts)[::-1].tolist():
        left, rank = int(counts[length]), 0
        while left:
            fits = np.flatnonzero(room[length:])[:1]
            if len(fits):
                r = length + int(fits[0])
                start, many = lanes[r].pop()
                room[r] = bool(lanes[r])
            else:
                r, start, many = capacity, opened, -(-left // (capacity // length))
                opened += many
            each = r // length
            for n, pieces in ((min(many, left // each), each), (1, left % each)):
                n = min(n, many)
                if n and pieces:
                    plan.append((length, rank, start, pieces, capacity - r))
                    rest = r - pieces * length
                    if rest:
                        lanes.setdefault(rest, []).append((start, n))
                        room[rest] = True
                    start, many, rank, left = start + n, many - n, rank + n * pieces, left - n * pieces
            if many:
                lanes.setdefault(r, []).append((start, many))
                room[r] = True
    return np.array(plan, np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", capacity: int = 4096, end_id: int = 1) -> DataFrame:
    """Packs all texts into sequences of at most capacity tokens.

    Returns a row for each piece: id, piece, start, length, ids_crc32, sequence_id, offset. A text's ids end with end_id, so
    a null or empty text is one token. Only longer texts are cut. Rows with equal or null ids are packed each for itself.
    The driver gets one count for each length (at most capacity); ranks inside a length are given by task and then shifted.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind, id_type = arrow_type(base, "id")
    schema = pa.schema([("id", kind), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64()), ("crc", pa.int64()), ("task", pa.int32()), ("rank", pa.int64())])
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder, task, seen = coder_for(tokenizer_path), TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        gc.disable()  # many strings, no cycles
        try:
            for column, values in joined(batches):
                ids = [x + end for x in coder(values)]
                rows = [(r, p, p * capacity, min(capacity, len(x) // 4 - p * capacity), x) for r, x in enumerate(ids) for p in range(-(-len(x) // 4 // capacity))]
                row, piece, start, length, _ = zip(*rows, strict=True)
                crc = [zlib.crc32(x[4 * s : 4 * (s + n)]) for _, _, s, n, x in rows]
                rank = []
                for n in length:
                    rank.append(int(seen[n]))
                    seen[n] += 1
                yield pa.RecordBatch.from_arrays([pa.array([column[r] for r in row], kind), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64()), pa.array([task] * len(rows), pa.int32()), pa.array(rank, pa.int64())], schema=schema)
        finally:
            gc.enable()

    pieces = cut(base.mapInArrow(encode, f"id {id_type}, piece int, start long, length long, crc long, task int, rank long"))
    by_task = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    shift = by_task.select("length", "task", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("shift"))
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in by_task.groupBy("length").agg(F.sum("n")).collect():
        counts[length] = n
    plan = best_fit(counts, capacity)
    order = np.lexsort((plan[:, 1], plan[:, 0]))
    plan = plan[order]
    key = plan[:, 0] << 48 | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            p = plan[np.searchsorted(key, length << 48 | rank, "right") - 1]
            t = rank - p[:, 1]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(p[:, 2] + t // p[:, 3]), pa.array(p[:, 4] + t % p[:, 3] * length)], names=["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"])

    ranked = pieces.join(shift, ["length", "task"]).select("id", "piece", "start", "length", F.col("crc").alias("ids_crc32"), (F.col("rank") + F.col("shift")).alias("rank"))
    return ranked.mapInArrow(place, f"id {id_type}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long").withColumnRenamed("id", id_col)
