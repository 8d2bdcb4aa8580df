"""Vectorised words and hashes over Arrow text columns, without one Python object per word."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 2 << 20
BLOCK_BYTES = 1 << 18
U = np.uint64
_R = 0x9E3779B97F4A7C15 | 1
_RINV = pow(_R, -1, 1 << 64)
_Q = 0xD6E8FEB86659FD93


def space_table() -> np.ndarray:
    """True for the bytes of a word, [^\\x20\\x09-\\x0D]."""
    t = np.ones(256, bool)
    t[[0x20, *range(0x09, 0x0E)]] = False
    return t


def mix(x: np.ndarray) -> np.ndarray:
    """A full avalanche of 64-bit values."""
    x = x ^ (x >> U(30))
    x = x * U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U(27))
    x = x * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def byte_values() -> np.ndarray:
    return mix(np.arange(1, 257, dtype=U) * U(_Q))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, U(base))
    out[0] = 1
    return np.multiply.accumulate(out)


class WordHasher:
    """Splits a byte buffer into words and names each word by a 64-bit hash of its bytes.

    A word's hash does not depend on where it stands, so every task agrees on it. Memory: about twelve times the
    chunk, whatever its words are like.
    """

    def __init__(self, table: np.ndarray | None = None, lower: bool = False):
        self.args = (table, lower)
        self.table = space_table() if table is None else table
        self.values = byte_values()
        if lower:
            self.values[65:91] = self.values[97:123]
        self.pow, self.inv = powers(_R, BLOCK_BYTES), powers(_RINV, BLOCK_BYTES)

    def __reduce__(self):
        return WordHasher, self.args

    def spans(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Starts and ends of all words; offsets: where each text starts, and the end of the last one."""
        if not len(buf):
            return np.empty(0, np.int64), np.empty(0, np.int64)
        w = self.table[buf]
        inner = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < len(buf))]
        edge = np.empty(len(w), bool)
        edge[0], edge[1:] = True, ~w[:-1]
        edge[inner] = True
        starts = np.flatnonzero(w & edge)
        edge[-1], edge[:-1] = True, ~w[1:]
        edge[inner - 1] = True
        return starts, np.flatnonzero(w & edge) + 1

    def hashes(self, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        out, a, n = np.empty(len(starts), U), 0, len(starts)
        while a < n:
            base = int(starts[a])
            b = int(np.searchsorted(ends, base + BLOCK_BYTES, "right"))
            if b <= a:  # one word longer than a block
                h, scale, step = 0, 1, int(self.pow[-1]) * _R % (1 << 64)
                for x in range(base, int(ends[a]), BLOCK_BYTES):
                    v = self.values[buf[x : min(x + BLOCK_BYTES, int(ends[a]))]]
                    h = (h + int((v * self.pow[: len(v)]).sum(dtype=U)) * scale) % (1 << 64)
                    scale = scale * step % (1 << 64)
                out[a] = h
                a += 1
                continue
            v = self.values[buf[base : int(ends[b - 1])]]
            c = np.empty(len(v) + 1, U)
            c[0] = 0
            np.cumsum(v * self.pow[: len(v)], out=c[1:])
            s = starts[a:b] - base
            out[a:b] = (c[ends[a:b] - base] - c[s]) * self.inv[s]
            a = b
        return mix(out + (ends - starts).astype(U) * U(_Q))

    def __call__(self, buf: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(hash of each word, index of each text's first word, one more at the end)."""
        starts, ends = self.spans(buf, offsets)
        return self.hashes(buf, starts, ends), np.searchsorted(starts, offsets)


def rolling(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive values, made by doubling; shorter than h by n - 1."""
    if len(h) < n:
        return np.empty(0, U)
    out, done, part, size, rest = None, 0, h, 1, n
    while True:
        if rest & 1:
            if out is None:
                out, done = part, size
            else:
                m = len(h) - done - size + 1
                out = out[:m] + part[done : done + m] * U(pow(_R, done, 1 << 64))
                done += size
        rest >>= 1
        if not rest:
            return mix(out)
        part = part[:-size] + part[size:] * U(pow(_R, size, 1 << 64))
        size *= 2


def window_rows(first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """For texts whose words start at first: the starts of all windows of n words, and the text each is in."""
    count = np.maximum(np.diff(first) - n + 1, 0)
    rows = np.repeat(np.arange(len(count)), count)
    begin = np.cumsum(count) - count
    return np.arange(count.sum()) - begin[rows] + first[:-1][rows], rows


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; a null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    big = pa.types.is_large_string(column.type)
    _, off, data = column.buffers()
    if not len(column):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(off, np.int64 if big else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None and offsets[-1] > offsets[0] else np.empty(0, np.uint8)
    return buf, offsets - offsets[0]


def chunks(batches: Iterator[pa.RecordBatch], column: int | str = 1) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches whose texts have CHUNK_BYTES at most, or one longer text: (slice, bytes, offsets)."""
    for batch in batches:
        buf, offsets = texts(batch.column(column))
        a = 0
        while a < batch.num_rows:
            b = max(a + 1, int(np.searchsorted(offsets, offsets[a] + CHUNK_BYTES, "right")) - 1)
            yield batch.slice(a, b - a), buf[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a]
            a = b


def per_chunk(step: Callable, schema: pa.Schema) -> Callable:
    """A mapInArrow function: step(slice, bytes, offsets) returns a dict of columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, buf, offsets in chunks(batches):
            out = step(part, buf, offsets)
            yield pa.RecordBatch.from_arrays([x if isinstance(x, (pa.Array, pa.ChunkedArray)) else pa.array(x, t.type) for x, t in zip((out[f.name] for f in schema), schema, strict=True)], schema=schema)

    return run


def long_lists(values: np.ndarray, counts: np.ndarray) -> pa.Array:
    """A list column of int64 from flat values."""
    offsets = np.zeros(len(counts) + 1, np.int32)
    np.cumsum(counts, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values.view(np.int64) if values.dtype == U else values.astype(np.int64)))
