"""License scans by a positional index of rare words.

Templates are indexed by word: for each of their words, where it stands. The inverse document frequency of these words
over all documents tells which are rare. A file looks up the rarest words of each template; the difference between the place in the
file and in the template is a shift, and words whose shifts differ by DRIFT at most stand in about the same order: a few words
may have been put in or left out between them. Where two rare words agree so, the template's words are compared at all shifts around,
and the label counts only if its key phrase is there as well. Of each template so many words are rare that whatever has the
least share of its words has two of them, whatever else the file holds.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.leaks import token_table
from tidemark.llm.tables import arrow_type, prepare
from tidemark.llm.words import WordHasher, per_chunk, texts

# Phrases that give a label wherever they stand.
BASE = (("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"), ("mit license", "mit"))
# Label, words of the notice or licence, phrase that must be there.
TEMPLATES = (
    ("agpl", "you can redistribute it and or modify it under the terms of the gnu affero general public license", "gnu affero general public license"),
    ("apache", "licensed under the apache license version 2 0", "apache license"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind", "you may not use this file except in compliance with the license"),
    ("artistic", "this program is free software you can redistribute it and or modify it under the terms of the artistic license", "artistic license"),
    ("boost", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license", "boost software license"),
    ("boost", "distributed under the boost software license version 1 0", "boost software license"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use in source and binary forms"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "redistributions of source code must retain the above copyright notice"),
    ("bsd-3-clause", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission", "may be used to endorse or promote products derived from this software"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license", "creative commons attribution"),
    ("cc-by-nc", "licensed under cc by nc 4 0", "cc by nc"),
    ("cc-by-nc", "this work is licensed under a creative commons attribution noncommercial 4 0 international license", "creative commons attribution noncommercial"),
    ("cc-by-nd", "this work is licensed under a creative commons attribution noderivatives 4 0 international license", "creative commons attribution noderivatives"),
    ("cc-by-sa", "this work is licensed under a creative commons attribution sharealike 4 0 international license", "creative commons attribution sharealike"),
    ("cc-by-sa", "licensed under cc by sa 4 0", "cc by sa"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work", "waived all copyright and related or neighboring rights"),
    ("cc0", "released under cc0 1 0 universal public domain dedication", "cc0 1 0 universal"),
    ("cddl", "the contents of this file are subject to the terms of the common development and distribution license", "common development and distribution license"),
    ("epl", "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0", "eclipse public license"),
    ("eupl", "licensed under the eupl version 1 2 or as soon they will be approved by the european commission", "licensed under the eupl"),
    ("gpl", "this work is licensed under the gnu general public license version 3", "gnu general public license"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "gnu general public license"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy modify"),
    ("lgpl", "you can redistribute it and or modify it under the terms of the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("mit", "released under the mit license", "mit license"),
    ("mit", "the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software", "shall be included in all copies or substantial portions of the software"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license"),
    ("ms-pl", "this license governs use of the accompanying software if you use the software you accept this license microsoft public license ms pl", "microsoft public license"),
    ("ofl", "this font software is licensed under the sil open font license version 1 1", "sil open font license"),
    ("public-domain", "this is free and unencumbered software released into the public domain", "released into the public domain"),
    ("wtfpl", "do what the fuck you want to public license", "what the fuck you want to public license"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software", "in no event will the authors be held liable for any damages"),
    ("all-rights-reserved", "all rights reserved", "all rights reserved"),
)
#: A row of shifts needs this share of a template's words, and this many of its rare ones.
LEAST_SHARE, LEAST_VOTES = 0.45, 2
#: By how much the shifts of a notice's words may differ.
DRIFT = 4


def hashed(phrase: str) -> np.ndarray:
    buf, offsets = texts(pa.array([phrase]))
    return WordHasher(token_table(), lower=True)(buf, offsets)[0]


def places(h: np.ndarray, phrase: np.ndarray) -> np.ndarray:
    """Starts of a phrase in h, texts not regarded."""
    n = len(h) - len(phrase) + 1
    if n < 1:
        return np.empty(0, np.int64)
    at = np.flatnonzero(h[:n] == phrase[0])
    for k in range(1, len(phrase)):
        at = at[h[at + k] == phrase[k]]
    return at


def shares(h: np.ndarray, low: int, high: int, template: np.ndarray, begins: list[int]) -> list[tuple[int, float]]:
    """Those shifts at which a row of DRIFT + 1 shifts begins where the text h[low:high] has the least share of the template's
    words, each word at any of these shifts; with the share."""
    out = []
    index = np.arange(len(template))
    for a in range(0, len(begins), 256):
        some = np.array(begins[a : a + 256])
        at = some[:, None, None] + np.arange(DRIFT + 1)[None, :, None] + index[None, None, :]
        inside = (at >= low) & (at < high)
        equal = (inside & (h[np.clip(at, low, high - 1)] == template)).any(axis=1).sum(axis=1)
        out += [(int(s), int(n) / len(template)) for s, n in zip(some, equal, strict=True) if n >= LEAST_SHARE * len(template)]
    return out


def word_counts(docs: DataFrame, text_col: str = "text") -> tuple[int, dict[int, int]]:
    """Number of documents, and of those that have each template word (by hash), over all of docs."""
    vocabulary = np.unique(np.concatenate([hashed(t) for _, t, _ in TEMPLATES]))
    hasher = WordHasher(token_table(), lower=True)

    def count(part, buf, offsets):
        h, first = hasher(buf, offsets)
        col = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        on = np.flatnonzero(vocabulary[col] == h)
        row = np.searchsorted(first, on, "right") - 1
        cell = np.unique(row * len(vocabulary) + col[on]) % len(vocabulary)
        n = np.bincount(cell, minlength=len(vocabulary))
        return {"word": np.append(vocabulary.view(np.int64), 0), "n": np.append(n, part.num_rows)}

    schema = pa.schema([("word", pa.int64()), ("n", pa.int64())])
    rows = docs.select(F.lit(0).alias("zero"), F.col(text_col).alias("text")).mapInArrow(per_chunk(count, schema), "word long, n long").groupBy("word").agg(F.sum("n")).collect()
    n = dict(rows)
    return n.pop(0, 0), n


def find_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Base phrases and licence notices of each row of docs.

    Returns id, n_words, n_base, first_word, last_word, base_labels, labels and score: the largest share of a notice's words
    that stand at about one shift, at least 0.5 where a base phrase stands, else 0. Words are rows of digits, ASCII letters and
    characters beyond ASCII, in lower case; a null text has none. Rows are scanned one by one, whatever their ids. Labels
    are sorted and joined by commas. The driver gets one count for each template word.
    """
    prepare(docs.sparkSession)
    total, counts = word_counts(docs, text_col)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    kind, id_type = arrow_type(rows, "id")
    fields = [("id", kind), ("n_words", pa.int64()), ("n_base", pa.int64()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64())]
    hasher = WordHasher(token_table(), lower=True)

    def index():
        """(rare words in order of hash, postings (template, place) of each, templates, key phrases)."""
        templates, keys = [hashed(t) for _, t, _ in TEMPLATES], [hashed(k) for _, _, k in TEMPLATES]
        postings: dict = {}
        idf = lambda w: math.log((total + 1) / (counts.get(int(np.uint64(w).astype(np.int64)), 0) + 1))
        for t, words in enumerate(x.tolist() for x in templates):
            spare = math.ceil(LEAST_SHARE * len(words) - 1e-9) - LEAST_VOTES  # places that need no rare word
            for w in sorted(set(words), key=lambda w: (idf(w), w)):
                if words.count(w) <= spare:
                    spare -= words.count(w)
                else:
                    spare = 0
                    postings.setdefault(w, []).extend((t, place) for place, x in enumerate(words) if x == w)
        order = np.array(sorted(postings), np.uint64)
        return order, [postings[w] for w in order.tolist()], templates, keys

    order, postings, templates, keys = index()
    base = [(hashed(p), label) for p, label in BASE]

    def step(part, buf, offsets):
        h, first = hasher(buf, offsets)
        n = part.num_rows
        total_, low, high, base_labels, labels, score = np.zeros(n, np.int64), [None] * n, [None] * n, [set() for _ in range(n)], [set() for _ in range(n)], np.zeros(n)
        for phrase, label in base:
            at = places(h, phrase)
            row = np.searchsorted(first, at, "right") - 1
            inside = at + len(phrase) <= first[row + 1]
            for a, r in zip((at[inside] - first[row[inside]]).tolist(), row[inside].tolist(), strict=True):
                total_[r] += 1
                low[r] = a if low[r] is None else min(low[r], a)
                high[r] = a if high[r] is None else max(high[r], a)
                base_labels[r].add(label)
                score[r] = 0.5
        col = np.minimum(np.searchsorted(order, h), len(order) - 1)
        on = np.flatnonzero(order[col] == h)
        on_row = np.searchsorted(first, on, "right") - 1
        cuts = np.searchsorted(on_row, np.arange(n + 1))
        for r in np.flatnonzero(np.diff(cuts) >= LEAST_VOTES):
            at, rare = on[cuts[r] : cuts[r + 1]], col[on[cuts[r] : cuts[r + 1]]]
            votes: dict = {}
            for a, w in zip(at.tolist(), rare.tolist(), strict=True):
                for t, place in postings[w]:
                    votes.setdefault(t, []).append((a - place, place))
            for t, found in votes.items():
                found.sort()
                label, end = TEMPLATES[t][0], 0
                tried: set = set()
                for x, (shift, place) in enumerate(found):
                    end = max(end, x)
                    while end + 1 < len(found) and found[end + 1][0] <= shift + DRIFT:
                        end += 1
                    if end > x and any(p != place for _, p in found[x + 1 : end + 1]):
                        tried.update(range(found[end][0] - DRIFT, shift + 1))
                for begin, share in shares(h, int(first[r]), int(first[r + 1]), templates[t], sorted(tried)):
                    if share <= score[r] and label in labels[r]:
                        continue
                    lo, hi = begin - len(keys[t]), begin + DRIFT + len(templates[t]) + len(keys[t])
                    if len(places(h[max(int(first[r]), lo) : max(min(int(first[r + 1]), hi), 0)], keys[t])):
                        labels[r].add(label)
                        score[r] = max(score[r], share)
        join = lambda x: ",".join(sorted(x))
        return {"id": part.column(0), "n_words": np.diff(first), "n_base": total_, "first_word": pa.array(low, pa.int64()), "last_word": pa.array(high, pa.int64()), "base_labels": [join(x) for x in base_labels], "labels": [join(x | y) for x, y in zip(base_labels, labels, strict=True)], "score": score}

    return rows.mapInArrow(per_chunk(step, pa.schema(fields)), f"id {id_type}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double").withColumnRenamed("id", id_col)
