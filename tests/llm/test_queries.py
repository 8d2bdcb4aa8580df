"""All ten queries on tables that hold everything that can go wrong, and on empty ones."""

import random

import pytest

from tidemark.llm import queries

#: Names that the operators use inside stand beside the texts.
EXTRA = "score double, id string, n long, x long, y long, key string, name string, n_words string, task int, rank int, value string, piece int, m0 double, kept boolean, line string, rep long, tree int"
SCHEMA = f"doc_id long, text string, lang string, source string, n_chars long, {EXTRA}"


def nasty():
    rng = random.Random(31)
    w = ["".join(rng.choices("abcdefgh", k=rng.randint(1, 8))) for _ in range(400)]
    text = lambda k: " ".join(rng.choices(w, k=k))
    long = text(150_000)
    rows = [(i, text(rng.randint(1, 120))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, " \n\t\r\n "), (None, None), (None, text(30)), (None, rows[3][1]), (53, rows[3][1]), (54, rows[3][1])]
    rows += [(55, long), (56, long + " end"), (57, "x" * 300_000), (58, "the " * 60_000), (59, "\n" * 50_000), (60, "a\n" * 30_000), (61, "漢字" * 20_000), (62, "\x00\x01 null byte"), (63, "𝒳 𐍈 é́ ‮")]
    rows += [(64, text(80)), (64, text(80)), (64, rows[5][1]), (64, rows[5][1]), (65, "password: " + "A1b2" * 30_000), (66, "0123456789abcdef" * 10_000), (-1, rows[7][1]), (2**62, rows[7][1] + " z")]
    return rows


def write(spark, tmp_path, rows):
    more = (0.5, "i", 1, 2, 3, "k", "n", "w", 1, 2, "v", 3, 0.1, True, "l", 4, 5)
    spark.createDataFrame([(i, t, "en", None, None, *more) for i, t in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    labels = [(i, i % 2, i % 3 == 0) for i, _ in rows if i is not None] + [(None, 1, True), (10**6, 0, False), (1, None, None)]
    spark.createDataFrame([(i, q, None if t is None else int(t)) for i, q, t in labels if rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    items = [(1, rows[3][1]), (2, None), (3, ""), (4, rows[9][1]), (4, rows[9][1])] if rows else []
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("nasty"), nasty())


@pytest.fixture(scope="module")
def empty(spark, tmp_path_factory):
    return write(spark, tmp_path_factory.mktemp("empty"), [])


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_on_nasty_tables(spark, tables, name):
    rows, docs = queries.QUERIES[name](spark, tables).collect(), nasty()
    ids = sorted((r.doc_id is not None, r.doc_id or 0) for r in rows)
    want = sorted((i is not None, i or 0) for i, _ in docs)
    if name == "op3_best_fit_packing":
        assert sorted((r.doc_id is not None, r.doc_id or 0) for r in rows if r.piece == 0) == want
    elif name == "op9_decontamination":
        assert {(3, 1), (53, 1), (54, 1), (None, 1), (9, 4)} <= {(r.doc_id, r.item_id) for r in rows} and len(rows) == len({(r.doc_id, r.item_id) for r in rows})
    else:
        assert ids == want


@pytest.mark.parametrize("name", sorted(queries.QUERIES))
def test_on_empty_tables(spark, empty, name):
    assert queries.QUERIES[name](spark, empty).count() == 0


def test_batches_of_long_texts_are_small(spark):
    import pyarrow as pa
    from pyspark.sql import functions as F

    from tidemark.llm import tables

    tables.prepare(spark)

    def size(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows])], ["n"])

    rows = spark.range(0, 200, 1, 1).select(F.repeat(F.lit("x"), 1 << 20).alias("text")).mapInArrow(size, "n long").collect()
    assert sum(r.n for r in rows) == 200 and max(r.n for r in rows) <= tables.ARROW_BYTES / (1 << 20) + 1
