"""Substring dedup by recompression.

Words are named by a 64-bit hash; rounds of recompression then split the names into left and right ones by a hash bit
and replace each left-right pair by the name of the pair. A name is a hash of what it stands for, so all tasks agree on
it without a shuffle for each round. Equal neighbours are on the same side: a run stays as it is, because the name of a
whole run would depend on words outside of a window.

Why no repeat is missed: in round r a common passage loses one symbol of 2^(r-1) words at most at either end, so after
three rounds its inner 36 of 50 words are the same symbols of 8 words at most in both documents. A gram is the shortest
row of symbols with five words or more (12 at most); of the grams that begin in each 24 words, the one with the least
hash is an anchor. One such stretch begins LOST words after the window and its grams end inside the inner words, so its anchor
follows from the window's words alone: all documents with the window have it. Windows whose own stretch has an anchor
that several documents share are then compared whole; where its least document is this one, no smaller one has the window.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import arrow_type, cut, prepare
from tidemark.llm.words import U, WordHasher, long_lists, mix, per_chunk, rolling, window_rows

ROUNDS, GRAM_WORDS, REACH, LOST = 3, 5, 24, 7
#: The least window for which the bound above holds: REACH grams of 12 words at most, and 7 words lost at either end.
LEAST_WINDOW = 50


def symbols(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(names, first word of each symbol) after ROUNDS of pair recompression inside each text."""
    name, start = h, np.arange(len(h))
    last = np.zeros(len(h) + 1, bool)
    last[first] = True  # a text begins here
    for r in range(1, ROUNDS + 1):
        if len(name) < 2:
            break
        left = (mix(name ^ U(r * 0x632BE59BD9B4E019 % (1 << 64))) & U(1)).astype(bool)
        pair = np.zeros(len(name), bool)
        pair[:-1] = left[:-1] & ~left[1:] & ~last[start[1:]]
        name = name.copy()
        i = np.flatnonzero(pair)
        name[i] = mix(name[i] * U(0xA0761D6478BD642F) + name[i + 1] * U(0xE7037ED1A0B428DB) + U(r))
        keep = np.ones(len(name), bool)
        keep[i + 1] = False
        name, start = name[keep], start[keep]
    return name, start


def slide(x: np.ndarray, n: int, f) -> np.ndarray:
    """f over each n consecutive values."""
    size, part = 1, x
    while size * 2 <= n:
        part = f(part[:-size], part[size:])
        size *= 2
    rest = n - size
    return f(part[: len(part) - rest], part[rest:]) if rest else part


def anchors(h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(name, first word) of each anchor gram, and the name of the anchor of the stretch that begins at each word."""
    if len(h) < REACH:
        return np.empty(0, U), np.empty(0, np.int64), np.empty(0, U)
    name, start = symbols(h, first)
    end = np.append(start[1:], len(h))
    text_end = first[1:][np.searchsorted(first, start, "right") - 1]
    j = np.searchsorted(end, start + GRAM_WORDS)
    inside = j < len(end)
    j[~inside] = 0
    inside &= end[j] <= text_end
    i = np.flatnonzero(inside)
    size, key = j[i] - i, np.zeros(len(i), U)
    for k in range(GRAM_WORDS):
        on = size >= k
        key[on] = (key[on] + name[i[on] + k]) * U(0x9FB21C651E98DF25)
    key = mix(key) | U(1)
    at = np.full(len(h), ~U(0))
    at[start[i]] = key
    least = slide(at, REACH, np.minimum)
    ok = np.zeros(len(least), bool)
    w, _ = window_rows(first, REACH)
    ok[w] = True
    least[~ok] = 0
    most = slide(np.concatenate((np.zeros(REACH - 1, U), least, np.zeros(REACH - 1, U))), REACH, np.maximum)
    chosen = most[start[i]] == key
    return key[chosen], start[i][chosen], least


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = 50) -> DataFrame:
    """Removes each word of a window of `window` words that also stands in a text with a smaller id.

    Returns id, n_words, n_removed, kept_text for each row of docs. A null text counts as empty. A row with a null id
    keeps all its words and takes none from others. Rows with the same id never take words from each other, and each is
    judged by its own text. Texts shorter than a window lose nothing. Exact copies are found by a 128-bit hash of the
    text, windows by 64 bits. Ids may be of any type that can be ordered.
    """
    if window < LEAST_WINDOW:
        raise ValueError(f"windows of under {LEAST_WINDOW} words are not sure to hold an anchor")
    spark = docs.sparkSession
    prepare(spark)
    base = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    kind, id_type = arrow_type(base, "id")
    some = base.where("id is not null")  # all that is joined has this filter, so that the texts are dealt out only once
    dealt = some.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), "id")
    text_name = F.unhex(F.md5("text"))
    named = some.where(F.length("text") >= 2 * window - 1).select("id", text_name.alias("name"))  # shorter texts hold no window
    # Written, so that the join has a plain exchange on either side: a name with very many rows is then split by the engine.
    firsts = cut(named.groupBy("name").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("name", "least"))
    copies = named.join(firsts, "name").where("id > least").groupBy("id").agg(F.collect_set("name").alias("copies"))
    # By id and name: of several rows with one id, only those whose own text is a copy.
    flagged = dealt.join(copies, "id", "left").select("id", "text", F.when(F.col("copies").isNotNull(), F.array_contains("copies", text_name)).alias("copy"))
    hasher = WordHasher()

    def found(part, buf, offsets):
        h, first = hasher(buf, offsets)
        key, start, _ = anchors(h, first)
        row = np.searchsorted(first, start, "right") - 1
        both = np.unique(np.stack((row.astype(U), key), 1), axis=0) if len(key) else np.empty((0, 2), U)
        return {"id": part.column(0).take(pa.array(both[:, 0].astype(np.int64))), "key": both[:, 1].view(np.int64) if len(key) else np.empty(0, np.int64)}

    def around(part, buf, offsets):
        h, first = hasher(buf, offsets)
        _, _, least = anchors(h, first)
        shared = part.column("keys").combine_chunks() if isinstance(part.column("keys"), pa.ChunkedArray) else part.column("keys")
        at, row = window_rows(first, window)
        key = least[at + LOST]
        hit = np.isin(key, shared.flatten().to_numpy(zero_copy_only=False).view(U))
        at, row, key = at[hit], row[hit], key[hit]
        name = rolling(h, window)[at] if len(at) else np.empty(0, U)
        own = part.column("own")
        counts = own.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        mine = own.flatten().to_numpy(zero_copy_only=False).view(U) ^ mix(np.repeat(np.arange(len(counts)), counts).astype(U))
        late = ~np.isin(key ^ mix(row.astype(U)), mine)
        _, one = np.unique(row.astype(U) * U(0x9FB21C651E98DF25) ^ name, return_index=True)
        return {"id": part.column(0).take(pa.array(row[one])), "name": name[one].view(np.int64), "late": late[one]}

    def keep(part, buf, offsets):
        h, first = hasher(buf, offsets)
        names = part.column("names")
        gone, n = np.zeros(len(h) + 1, np.int64), np.diff(first)
        if names.null_count < len(names):
            at, rows = window_rows(first, window)
            counts = names.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
            flat = names.flatten().to_numpy(zero_copy_only=False).view(U)
            cuts = np.concatenate(([0], np.cumsum(counts)))
            roll = rolling(h, window)
            for r in np.flatnonzero(counts):
                w = np.arange(first[r], first[r + 1] - window + 1)
                w = w[np.isin(roll[w], flat[cuts[r] : cuts[r + 1]])]
                np.add.at(gone, w, 1)
                np.add.at(gone, w + window, -1)
        away = np.cumsum(gone)[:-1] > 0
        copy = part.column("copy").fill_null(False).to_numpy(zero_copy_only=False) & (n >= window)
        for r in np.flatnonzero(copy):
            away[first[r] : first[r + 1]] = True
        removed = np.add.reduceat(np.append(away, False).astype(np.int64), first[:-1]) if len(n) else n
        removed[n == 0] = 0
        raw, out = buf.tobytes(), []
        for r in range(len(n)):
            words = raw[offsets[r] : offsets[r + 1]].split()
            if removed[r]:
                words = [w for w, x in zip(words, away[first[r] : first[r + 1]].tolist(), strict=True) if not x]
            out.append(b" ".join(words))
        return {"id": part.column(0), "n_words": n, "n_removed": removed, "kept_text": pa.array(out, pa.binary()).cast(pa.string())}

    pairs = flagged.where("NOT coalesce(copy, false)").select("id", "text").mapInArrow(per_chunk(found, pa.schema([("id", kind), ("key", pa.int64())])), f"id {id_type}, key long")
    shared = pairs.groupBy("key").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("key", "least")
    # A window whose own stretch has an anchor first seen in its own document can stand in no smaller one: it is not late.
    hits = pairs.join(shared, "key").groupBy("id").agg(F.collect_list("key").alias("keys"), F.collect_list(F.when(F.col("least") == F.col("id"), F.col("key"))).alias("own"))
    windows = flagged.where("NOT coalesce(copy, false)").select("id", "text").join(hits, "id").mapInArrow(per_chunk(around, pa.schema([("id", kind), ("name", pa.int64()), ("late", pa.bool_())])), f"id {id_type}, name long, late boolean")
    repeated = windows.groupBy("name").agg(F.min("id").alias("least"), F.max("id").alias("most")).where("least < most").select("name", "least")
    lost = windows.where("late").drop("late").join(repeated, "name").where("id > least").groupBy("id").agg(F.collect_list("name").alias("names"))
    schema = pa.schema([("id", kind), ("n_words", pa.int64()), ("n_removed", pa.int64()), ("kept_text", pa.string())])
    rest = base.where("id is null").select("id", "text", F.lit(None).cast("boolean").alias("copy"), F.lit(None).cast("array<bigint>").alias("names"))
    out = flagged.select("id", "text", "copy").join(lost, "id", "left").unionByName(rest).mapInArrow(per_chunk(keep, schema), f"id {id_type}, n_words long, n_removed long, kept_text string")
    return out.withColumnRenamed("id", id_col)
