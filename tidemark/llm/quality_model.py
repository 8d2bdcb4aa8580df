"""Quality classifier: random-indexing word vectors, pooled, then a small network with calibrated probabilities.

Words are rows of letters and digits, and rows of signs, so that marks have vectors too. Every word has a sparse random
index vector, made from its hash. Its word vector is the sum of the index vectors of its neighbours wherever it stands in
the corpus; words share a fixed number of slots by hash, so the table has a fixed size whatever the corpus is. A document
is the mean of its words' vectors, weighted by rarity, their spread, and the length of the mean of its index vectors (long
where few words repeat). Nothing else is looked at. Two layers in numpy turn that into a logit, and a temperature fitted
on held-back rows turns the logit into a probability.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import arrow_type, prepare
from tidemark.llm.toxicity import sample
from tidemark.llm.words import U, WordHasher, chunks

SLOTS, DIM, ONES, REACH, PARTS = 1 << 16, 32, 4, 2, 16
#: Words whose vectors are held at once.
PIECE = 1 << 17
#: Sums of so many tasks are added up by one task, on each of so many levels; the last one adds up all that is left.
FAN_IN, LEVELS = 64, 3


def kinds() -> np.ndarray:
    """For each byte: 0 white space, 1 part of a word of letters and digits, 2 part of a word of signs."""
    t = np.full(256, 2, np.uint8)
    t[[0x20, *range(0x09, 0x0E)]] = 0
    t[48:58] = t[65:91] = t[97:123] = t[128:] = 1
    return t


def word_spans(buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of all words; offsets: where each text starts, and the end of the last one."""
    if not len(buf):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kind = kinds()[buf]
    edge = np.empty(len(kind), bool)
    edge[0], edge[1:] = True, kind[1:] != kind[:-1]
    edge[offsets[1:-1][offsets[1:-1] < len(buf)]] = True
    starts = np.flatnonzero(edge)
    ends, word = np.append(starts[1:], len(kind)), kind[starts] > 0
    return starts[word], ends[word]


def words(buf: np.ndarray, offsets: np.ndarray, hasher: WordHasher) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each word, index of each text's first word, one more at the end)."""
    starts, ends = word_spans(buf, offsets)
    return hasher.hashes(buf, starts, ends), np.searchsorted(starts, offsets)


def index_vectors(slots: int = SLOTS, dim: int = DIM, seed: int = 11) -> np.ndarray:
    """Sparse vectors of ONES signed ones for each slot."""
    rng = np.random.default_rng(seed)
    out = np.zeros((slots, dim), np.float32)
    for _ in range(ONES):
        out[np.arange(slots), rng.integers(0, dim, slots)] += rng.choice([-1.0, 1.0], slots)
    return out


def slots_of(h: np.ndarray) -> np.ndarray:
    return (h >> U(64 - SLOTS.bit_length() + 1)).astype(np.int64)


def context_sums(h: np.ndarray, first: np.ndarray, index: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(sum of neighbours' index vectors of each slot, words in each slot)."""
    s = slots_of(h)
    x = index[s]
    around = np.zeros_like(x)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    for o in range(1, REACH + 1):
        same = (row[o:] == row[:-o])[:, None]
        around[o:] += x[:-o] * same
        around[:-o] += x[o:] * same
    order = np.argsort(s, kind="stable")
    begin = np.flatnonzero(np.concatenate(([True], np.diff(s[order]) > 0))) if len(s) else np.empty(0, np.int64)
    out = np.zeros_like(index)
    if len(begin):
        out[s[order][begin]] = np.add.reduceat(around[order], begin, axis=0)
    return out, np.bincount(s, minlength=len(index))


def word_vectors(docs: DataFrame, text_col: str = "text") -> tuple[np.ndarray, np.ndarray]:
    """(unit vectors of the slots, log rarity of the slots) over all of docs.

    Each task sends one sum of fixed size, in PARTS parts; sums are added up by a tree of tasks, FAN_IN at a time, each in a
    stream. The driver gets one table of SLOTS * (DIM + 1) numbers.
    """
    hasher, width = WordHasher(), SLOTS // PARTS

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = index_vectors()
        total, n = np.zeros((SLOTS, DIM), np.float64), np.zeros(SLOTS, np.float64)
        for _, buf, offsets in chunks(batches):
            h, first = words(buf, offsets, hasher)
            if len(h):
                s, c = context_sums(h, first, index)
                total += s
                n += c
        both = np.column_stack((total, n))
        task = TaskContext.get().partitionId()
        yield pa.RecordBatch.from_arrays([pa.array(range(PARTS), pa.int32()), pa.array([task] * PARTS, pa.int32()), pa.array([both[p * width : (p + 1) * width].astype(np.float32).tobytes() for p in range(PARTS)], pa.binary())], ["part", "task", "sums"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for p, t, x in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                new = np.frombuffer(x.as_buffer(), np.float32)
                key = p, t // FAN_IN
                held[key] = held[key] + new if key in held else new.astype(np.float64)
        if held:
            part, task = zip(*held, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array(task, pa.int32()), pa.array([x.astype(np.float32).tobytes() for x in held.values()], pa.binary())], ["part", "task", "sums"])

    ddl = "part int, task int, sums binary"
    sums = docs.select(F.lit(0).alias("zero"), F.col(text_col).alias("text")).mapInArrow(local, ddl)
    for _ in range(LEVELS):
        sums = sums.repartition("part", F.floor(F.col("task") / FAN_IN)).mapInArrow(add, ddl)
    rows = sums.select("part", "sums").collect()
    table = np.zeros((SLOTS, DIM + 1))
    for p, x in rows:
        table[p * width : (p + 1) * width] += np.frombuffer(bytes(x), np.float32).reshape(width, DIM + 1)
    vectors, n = table[:, :DIM], table[:, DIM]
    vectors = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-9)
    return vectors.astype(np.float32), np.log((n.sum() + 1) / (n + 1)).astype(np.float32)


def pooled(buf: np.ndarray, offsets: np.ndarray, hasher: WordHasher, vectors: np.ndarray, rarity: np.ndarray, index: np.ndarray) -> np.ndarray:
    """A row of features for each text; a text longer than a chunk is pooled piece by piece."""
    h, first = words(buf, offsets, hasher)
    n = np.diff(first)
    out = np.zeros((len(n), 2 * DIM + 1), np.float32)
    some = np.flatnonzero(n)
    if not len(some):
        return out
    begin, count = first[:-1][some], n[some][:, None].astype(np.float64)
    sums = np.zeros((len(some), 3 * DIM + 1))  # weighted vectors, vectors squared, index vectors, weights
    plain = np.zeros((len(some), DIM))
    row = np.repeat(np.arange(len(some)), n[some])
    for a in range(0, len(h), PIECE):
        s, r = slots_of(h[a : a + PIECE]), row[a : a + PIECE]
        v, w = vectors[s], rarity[s][:, None]
        cut = np.flatnonzero(np.concatenate(([True], r[1:] != r[:-1])))
        add = lambda x: np.add.reduceat(x, cut, axis=0)  # noqa: E731, B023
        sums[r[cut]] += np.column_stack((add(v * w), add(v * v), add(index[s]), add(w)))
        plain[r[cut]] += add(v)
    out[some, :DIM] = sums[:, :DIM] / np.maximum(sums[:, -1:], 1e-6)
    out[some, DIM : 2 * DIM] = np.sqrt(np.maximum(sums[:, DIM : 2 * DIM] / count - (plain / count) ** 2, 0))
    out[some, 2 * DIM] = np.linalg.norm(sums[:, 2 * DIM : 3 * DIM] / count, axis=1) * np.sqrt(np.minimum(count[:, 0], 50)) / 4
    return out


@dataclass(frozen=True)
class Network:
    """Two layers over standardised features; logits are divided by the temperature."""

    shift: np.ndarray
    scale: np.ndarray
    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: float
    temperature: float

    def logits(self, x: np.ndarray) -> np.ndarray:
        return np.tanh(np.clip((x - self.shift) / self.scale, -6, 6) @ self.w1 + self.b1) @ self.w2 + self.b2

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 24, epochs: int = 60, seed: int = 3, prior: float | None = None) -> Network:
    """Adam on the logistic loss; a fifth of the rows is held back for the temperature. prior: share of label 1 among all rows."""
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(x))
    back, fit = order[: len(x) // 5], order[len(x) // 5 :]
    shift, scale = x[fit].mean(0), x[fit].std(0) + 1e-3
    z = np.clip((x - shift) / scale, -6, 6)
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], hidden)), np.zeros(hidden), rng.normal(0, 1 / np.sqrt(hidden), hidden), np.zeros(1)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for _ in range(epochs):
        for b in np.array_split(rng.permutation(fit), max(1, len(fit) // 128)):
            a = np.tanh(z[b] @ p[0] + p[1])
            d = (1 / (1 + np.exp(-np.clip(a @ p[2] + p[3], -30, 30))) - y[b]) / len(b)
            back_a = d[:, None] * p[2] * (1 - a * a)
            g = [z[b].T @ back_a + 1e-4 * p[0], back_a.sum(0), a.T @ d + 1e-4 * p[2], np.array([d.sum()])]
            t += 1
            for k in range(4):
                m[k], v[k] = 0.9 * m[k] + 0.1 * g[k], 0.999 * v[k] + 0.001 * g[k] ** 2
                p[k] -= 0.01 * (m[k] / (1 - 0.9**t)) / (np.sqrt(v[k] / (1 - 0.999**t)) + 1e-8)
    share = y.mean()
    bias = np.log(prior / (1 - prior)) - np.log(share / (1 - share)) if prior and 0 < share < 1 else 0.0
    net = Network(shift, scale, p[0], p[1], p[2], float(p[3][0]), 1.0)
    held = net.logits(x[back]) if len(back) else np.zeros(0)
    loss = lambda c: float(np.mean(np.logaddexp(0, -(2 * y[back] - 1) * held / c))) if len(back) else c
    best = min(np.geomspace(0.5, 8, 40), key=loss) if len(back) else 1.0
    return Network(shift, scale, p[0], p[1], p[2], float(p[3][0] + bias * best), float(best))


def classify(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", most_rows: int = 10_000) -> DataFrame:
    """(id, score) for each row of docs: how likely label 1 is.

    Word vectors are gathered from all texts. The network is fitted on at most most_rows labelled rows of either class that
    `allowed` admits (columns of labels), chosen by a hash of the id; the share of the classes among all of them sets the
    intercept. Labels that are null don't count. With labels of one class only, or none, every score is 0.5. A null or empty
    text has the features of no words and is scored by them. Rows are scored one by one, whatever their ids.
    """
    prepare(docs.sparkSession)
    base = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, id_type = arrow_type(base, "id")
    vectors, rarity = word_vectors(base)
    hasher = WordHasher()

    def features(net: Network | None):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            index = index_vectors()
            for part, buf, offsets in chunks(batches):
                x = pooled(buf, offsets, hasher, vectors, rarity, index)
                last = pa.array(net(x)) if net else pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays([part.column(0).cast(kind) if net else part.column(0), last], ["id", "x"])

        return run

    picked = sample(docs, labels, id_col, text_col, label_col, allowed, most_rows)
    shares = labels.where(allowed & F.col(label_col).isNotNull()).agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    rows = picked.select("y", "text").mapInArrow(features(None), "id int, x binary").collect()
    y = np.array([r[0] for r in rows], np.float64)
    if not len(y) or y.min() == y.max():
        return base.select(F.col("id").alias(id_col), F.lit(0.5).alias("score"))
    x = np.stack([np.frombuffer(bytes(r[1]), np.float32) for r in rows]).astype(np.float64)
    order = np.lexsort((*x.T, y))  # rows arrive in any order; the fit shall not depend on it
    net = train(x[order], y[order], prior=shares)
    return base.mapInArrow(features(net), f"id {id_type}, x double").select(F.col("id").alias(id_col), F.col("x").alias("score"))
