"""The pipeline's stages against brute force on a small corpus with all that can go wrong, and the whole on the smallest tables."""

import random

import pytest
from pyspark.sql import functions as F

corpus_pipeline = pytest.importorskip("corpus_pipeline")
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, extra array<int>"


def corpus():
    rng = random.Random(21)
    words = ["".join(rng.choices("abcdefgh", k=rng.randint(3, 8))) for _ in range(600)]
    some = lambda k: " ".join(rng.choices(words, k=k))
    texts = [(i, some(rng.randint(20, 60)) + "\n" + some(30)) for i in range(60)]
    item, other = some(40), some(25)
    texts += [(100, texts[3][1]), (101, texts[4][1] + " tail"), (102, "so " + item + " then " + some(20)), (103, None), (104, ""), (105, " \n "), (None, some(40)), (None, texts[5][1])]
    texts += [(110, "a footer line that stands below every text\n" + some(30)), (111, "a footer line that stands below every text\n" + some(30)), (112, "a footer line that stands below every text")]
    texts += [(120, other), (120, some(30)), (120, other), (121, some(9000)), (122, "you are vermin and grobble " * 3 + some(10))]
    for i in range(200, 260):  # labelled
        texts.append((i, some(25) + (" vermin grobble vermin" if i % 2 else "")))
    return texts, item


def write(spark, tmp_path, texts, item, labels):
    docs = spark.createDataFrame([(i, t, "en", f"s{n % 3}", len(t or ""), 0.5, [n]) for n, (i, t) in enumerate(texts)], SCHEMA)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item), (2, None)] if item else [], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    return docs


def distance_at_most_2(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1] <= 2


def brute_lines(rows):
    first, out = {}, []
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is not None, rows[n][0] or 0, n))
    for n in order:
        for k, line in enumerate((rows[n][1] or "").split("\n")):
            if line.split():
                first.setdefault(line, (order.index(n), k))
    for n in order:
        kept = []
        for k, line in enumerate((rows[n][1] or "").split("\n")):
            at = (order.index(n), k)
            near = len(line) >= 20 and any(len(o) >= 20 and w < at and abs(len(o) - len(line)) <= 2 and distance_at_most_2(o, line) for o, w in first.items() if o != line)
            if not line.split() or first[line] == at and not near:
                kept.append(line)
        text = "\n".join(kept)
        if text == (rows[n][1] or "") or text.split():
            out.append((rows[n][0], text))
    return out


def grams(t, n=5):
    w = (t or "").split()
    return {tuple(w[k : k + n]) for k in range(len(w) - n + 1)}


def brute_copies(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))
    sets, root = [grams(t) for _, t in rows], list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
                a, b = root[i], root[j]
                root = [min(a, b) if r in (a, b) else r for r in root]
    return [r for n, r in enumerate(rows) if root[n] == n]


def key(rows):
    return sorted(((i is not None, i or 0), t or "") for i, t in rows)


def test_stages_against_brute_force(spark, tmp_path):
    texts, item = corpus()
    labels = [(i, 1, i % 2) for i in range(200, 260)]
    docs = write(spark, tmp_path, texts, item, labels)
    (_, toxic), (_, lines), (_, copies), (_, leaks), (_, packing) = corpus_pipeline.STAGES
    pairs = lambda df: [(r.doc_id, r.text) for r in df.collect()]
    step = 0

    def again(df):
        nonlocal step
        assert tuple(df.columns) == corpus_pipeline.COLUMNS
        step += 1
        df.write.parquet(f"{tmp_path}/stage{step}")
        return spark.read.parquet(f"{tmp_path}/stage{step}")

    out = again(toxic(spark, docs, str(tmp_path)))
    assert key(pairs(out)) == key([(i, t) for i, t in texts if "vermin" not in (t or "")])
    before, out = pairs(out), again(lines(spark, out, str(tmp_path)))
    assert len(pairs(out)) == len(brute_lines(before))
    same = lambda rows: [r for r in rows if r[0] not in (None, 120)]  # noqa: E731  # which of equal ids is first is not fixed
    assert key(same(pairs(out))) == key(same(brute_lines(before))) and out.where("n_chars <> length(text)").isEmpty()
    before, out = pairs(out), again(copies(spark, out, str(tmp_path)))
    assert key(pairs(out)) == key(brute_copies(before))
    before, out = pairs(out), again(leaks(spark, out, str(tmp_path)))
    assert key(pairs(out)) == key([(i, t) for i, t in before if item not in (t or "")])
    pieces = packing(spark, out, str(tmp_path)).collect()
    assert {r.doc_id for r in pieces} == {r.doc_id for r in out.collect()} and sum(r.piece == 0 for r in pieces) == out.count()
    whole = corpus_pipeline.run(spark, str(tmp_path)).collect()
    at = lambda rows: sorted(((r.doc_id is not None, r.doc_id or 0), r.piece, r.length, r.ids_crc32) for r in rows)
    assert at(whole) == at(pieces)


def test_near_copies_with_equal_ids_leave_one(spark, tmp_path):
    rng = random.Random(2)
    t, u = (" ".join("".join(rng.choices("abcdefgh", k=5)) for _ in range(60)) for _ in range(2))
    rows = [(1, t), (1, t), (None, t), (2, u), (2, u + " end"), (3, u), (4, None), (4, None)]
    docs = spark.createDataFrame([(i, x, "en", "s", 0, 0.0, []) for i, x in rows], SCHEMA)
    got = [(r.doc_id, r.text) for r in corpus_pipeline.drop_near_copies(spark, docs, str(tmp_path)).collect()]
    assert key(got) in [key([(None, t), (2, x), (4, None), (4, None)]) for x in (u, u + " end")]


def test_empty_tables(spark, tmp_path):
    write(spark, tmp_path, [], None, [])
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0


def test_pipeline_on_the_smallest_tables(spark):
    d = "/root/testdata/sf0.001"
    docs = before = spark.read.parquet(f"{d}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, d)
        assert tuple(docs.columns) == corpus_pipeline.COLUMNS and docs.dtypes == before.dtypes, name
    rows = corpus_pipeline.run(spark, d).collect()
    assert {r.doc_id for r in rows} == {r.doc_id for r in docs.collect()} and len(rows) > 0.5 * before.count()
    assert spark.read.parquet(f"{d}/documents.parquet").where(F.col("doc_id").isNull()).isEmpty()
