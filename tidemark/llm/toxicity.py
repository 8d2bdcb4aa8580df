"""Toxicity by a weighted lexicon, matched by Aho-Corasick over folded text.

The lexicon is learnt from labelled rows: words and beginnings of words that toxic texts have far more often than others.
Before matching, text is put in lower case, look-alike letters and digits become the letters they stand for, and all
other characters become spaces. Exception phrases take back the hits inside them. Hits are normalised by length; a
logistic curve over the normalised sums gives the score.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_right
from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.tables import cut, prepare

# What a character is read as.
LOOK_ALIKES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "а": "a", "е": "e", "і": "i", "ј": "j", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "ѕ": "s", "ԁ": "d", "α": "a", "ε": "e", "ι": "i", "ο": "o", "ρ": "p", "τ": "t", "υ": "u", "ν": "v", "​": "", "‌": "", "‍": "", "­": "", "﻿": ""}
#: Hits inside these are no hits: everyday senses of words that are also insults.
EXCEPTIONS = (
    "trash can", "trash bin", "trash bag", "trash collection", "trash compactor", "trash talk", "class clown", "clown fish", "clownfish", "circus clown",
    "rodeo clown", "sore loser wins", "pond scum", "soap scum", "scum line", "pig iron", "pig latin", "guinea pig", "piggy bank", "dumb bell", "dumbbell",
    "dumb waiter", "dumbwaiter", "deaf and dumb", "dumb terminal", "crazy golf", "crazy paving", "crazy quilt", "worthless currency", "worthless stock", "pathetic fallacy",
    "idiot proof", "idiot light", "idiot board", "the idiot by dostoevsky", "filthy lucre", "donkey kong", "donkey engine", "rat race", "lab rat", "rat trap", "rat snake",
    "snake oil", "weasel word", "weasel words", "kill switch", "kill the process", "drop dead gorgeous", "stupid simple", "ugly duckling", "freak wave", "freak accident", "control freak",
    "cockroach trap", "parasite drag", "garbage collection", "garbage collector", "garbage truck", "rubbish bin", "vermin control", "crap shoot", "craps table", "nut case study",
)
#: Words that count even where no label speaks of them, with a modest weight: insults in English, German, French and Spanish.
SEED_WORDS = (
    "idiot", "idiots", "moron", "morons", "scum", "scumbag", "imbecile", "imbeciles", "worthless", "pathetic", "cretin", "halfwit", "dimwit", "dumbass", "jackass", "bastard", "asshole",
    "trottel", "arschloch", "vollidiot", "schwachkopf", "dummkopf", "drecksack", "abschaum", "mistkerl", "blödmann", "wichser",
    "connard", "connards", "imbécile", "abruti", "crétin", "salaud", "enfoiré", "débile", "ordure", "connasse",
    "idiota", "estúpido", "estúpida", "imbécil", "gilipollas", "cabrón", "pendejo", "escoria", "tarado", "capullo",
)
SEED_WEIGHT = 2.0
#: Lengths of the beginnings of words, of words that count as ordinary ones, and of pieces of longer or unspaced ones.
SHORTEST, LONGEST, WORD, PIECES = 4, 7, 40, (2, 3, 4)
# Scripts that put no spaces between words: Thai to Myanmar, Khmer, kana, Han.
UNSPACED = re.compile("[\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u9fff\uf900-\ufaff\U00020000-\U0003ffff]")


class Folder(dict):
    """For str.translate: letters stay, look-alikes are replaced, the rest becomes a space."""

    def __missing__(self, code: int):
        c = chr(code)
        self[code] = out = LOOK_ALIKES.get(c, c if c.isalpha() else " ")
        return out


def fold(text: str, table: Folder) -> str:
    return text.lower().translate(table)


def features(folded: str) -> set[str]:
    """Whole words (with a space on both sides) and beginnings of words (with one before) of a text; of words in scripts
    without spaces, and of those with over WORD letters, all pieces of a few letters instead."""
    out = set()
    for w in set(folded.split()):
        if len(w) > WORD or UNSPACED.search(w):
            out.update(w[i : i + n] for n in PIECES for i in range(len(w) - n + 1))
        else:
            out.add(f" {w} ")
            out.update(f" {w[:n]}" for n in range(SHORTEST, min(LONGEST, len(w)) + 1))
    return out


@dataclass(frozen=True)
class Model:
    """weights: of each lexicon entry; curve: intercept, then the weights of measures()."""

    weights: dict[str, float]
    curve: tuple[float, ...] = (-3.0, 1.0, 0.5, 0.0)


def automaton(weights: dict[str, float]):
    """The entries and the exceptions; each with how many of its characters lie before the end of what it matches."""
    import ahocorasick

    out, table = ahocorasick.Automaton(), Folder()
    for phrase in EXCEPTIONS:
        whole = f" {fold(phrase, table)} "
        out.add_word(whole, (len(whole) - 1, 1, 0.0))
    for word, weight in weights.items():
        out.add_word(word, (len(word.rstrip()), len(word) - len(word.rstrip()), weight))
    if len(out):
        out.make_automaton()
    return out


def measures(folded: str, found) -> tuple[float, float, float]:
    """(weight by length, weight, hits), damped; of entries that begin together the heaviest counts."""
    hits: dict[int, float] = {}
    begins: list[int] = []  # of exceptions, with the end of each: both rise, since matches come by where they end
    ends: list[int] = []
    padded = f" {folded} "
    if len(found):
        for end, (size, tail, weight) in found.iter(padded):
            start = end - tail - size + 1
            if weight == 0.0:
                while begins and begins[-1] >= start:
                    begins.pop(), ends.pop()
                begins.append(start)
                ends.append(end)
            elif hits.get(start, 0.0) < weight:
                hits[start] = weight
    if begins:
        spared = lambda s: (k := bisect_right(begins, s)) and s < ends[k - 1]
        hits = {s: w for s, w in hits.items() if not spared(s)}
    if not hits:
        return 0.0, 0.0, 0.0
    total = sum(hits.values())
    return math.log1p(100 * total / (folded.count(" ") + 20)), math.log1p(total), math.log1p(len(hits))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, rounds: int = 60) -> np.ndarray:
    """Newton's method."""
    x = np.column_stack((np.ones(len(x)), x))
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge * len(x) * np.eye(len(w)), x.T @ (p - y) + ridge * len(x) * w)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str, allowed: Column, most: int) -> DataFrame:
    """(id, text, y) of at most `most` labelled rows of either class, chosen by a hash of the id. So many ids are broadcast."""
    named = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull() & allowed).groupBy(F.col(id_col).alias("id")).agg(F.max(F.col(label_col).cast("int")).alias("y"))
    picked = named.where("y = 1").orderBy(F.xxhash64("id")).limit(most).union(named.where("y = 0").orderBy(F.xxhash64("id")).limit(most))
    return docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")).join(F.broadcast(picked), "id")


def learn(docs: DataFrame, labels: DataFrame, allowed: Column, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic", most_rows: int = 10_000, least_odds: float = 3.0) -> Model:
    """A lexicon and its curve from at most 2 * most_rows labelled rows.

    Every entry counts that is in at least three toxic texts and in one of 250, and exp(least_odds) times as often in toxic
    texts as in others; the sample alone bounds their number. Equal texts count once, as toxic if any of them is labelled so.
    Entries are counted and compared by Spark; the driver gets those that tell and 2 * most_rows rows of three measures.
    Null labels and ids don't count. Without labels of both classes the seed words and a fixed curve remain.
    """
    prepare(docs.sparkSession)
    rows = sample(docs, labels, id_col, text_col, label_col, allowed, most_rows)
    rows = cut(rows.groupBy("text").agg(F.max("y").alias("y")))
    sizes = dict(rows.groupBy("y").count().collect())
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    seeds = {f" {fold(w, Folder())} ": SEED_WEIGHT for w in SEED_WORDS}
    if not toxic or not clean:
        return Model(seeds)

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Folder()
        for batch in batches:
            n: Counter = Counter()
            for text in batch.column("text").to_pylist():
                n.update(features(fold(text, table)))
            yield pa.RecordBatch.from_arrays([pa.array(list(n), pa.string()), pa.array(list(n.values()), pa.int64())], ["entry", "n"])

    least = max(3, toxic // 250)
    count = lambda y: rows.where(F.col("y") == y).select("text").mapInArrow(counted, "entry string, n long").groupBy("entry").agg(F.sum("n").alias(f"n{y}"))
    odds = F.log((F.col("n1") + 0.5) / (toxic + 1) * (clean + 1) / (F.coalesce("n0", F.lit(0)) + 0.5))
    told = count(1).where(F.col("n1") >= least).join(count(0), "entry", "left").withColumn("odds", odds).where(F.col("odds") >= least_odds)
    weights: dict[str, float] = {}
    for e, w in sorted(told.select("entry", "odds").collect(), key=lambda r: (len(r[0].rstrip()), r[0])):
        # A longer entry adds nothing to a beginning that tells as much.
        if not any(weights.get(e[:n], -9.0) >= w - 0.7 for n in range(SHORTEST + 1, len(e))):
            weights[e] = w
    weights = seeds | {e: round(w, 4) for e, w in weights.items()}
    measured = scored(rows, "text", "_m", lambda m: m, weights, 3).select("_m", "y").collect()
    x = np.array([(*m, y) for m, y in measured], np.float64)
    x = x[np.lexsort(x.T)]  # rows arrive in any order; the fit shall not depend on it
    curve = logistic(x[:, :3], x[:, 3])
    return Model(weights, tuple(round(float(c), 6) for c in curve))


def scored(docs: DataFrame, text_col: str, name: str, value: Callable, weights: dict[str, float], width: int = 0) -> DataFrame:
    """docs with a column `name`: value of the measures of a batch (rows of three), `width` numbers a row where that is given."""
    at, names = docs.columns.index(text_col), [f"c{k}" for k in range(len(docs.columns))]
    plain = docs.toDF(*names)
    schema = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in plain.schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, table = automaton(weights), Folder()
        for batch in batches:
            m = value(np.array([measures(fold(t or "", table), found) for t in batch.column(at).to_pylist()], np.float64).reshape(-1, 3))
            last = pa.array(m.tolist(), pa.list_(pa.float64())) if width else pa.array(m, pa.float64())
            yield pa.RecordBatch.from_arrays([*batch.columns, last], [*names, "value"])

    out = plain.mapInArrow(run, f"{schema}value {'array<double>' if width else 'double'}")
    kept = [F.col(n).alias(c) for n, c in zip(names, docs.columns, strict=True) if c != name]
    return out.select(*kept, F.col("value").alias(name))


def score(docs: DataFrame, model: Model, text_col: str = "text", score_col: str = "score") -> DataFrame:
    """docs with a score column, which takes the place of one of that name; a null or empty text has no hits, and an empty
    table stays empty. Rows are scored one by one, whatever their ids, and texts whole, in time that grows with their length."""
    prepare(docs.sparkSession)
    curve = np.array(model.curve)
    return scored(docs, text_col, score_col, lambda m: 1 / (1 + np.exp(-np.clip(curve[0] + m @ curve[1:], -700, 700))), model.weights)
