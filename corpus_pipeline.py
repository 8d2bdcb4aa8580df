"""A corpus pipeline over documents: toxic texts go, repeated lines go, one of each group of near copies stays, texts that
hold benchmark passages go, and what is left is packed into sequences.

Each stage takes (spark, docs, sf_dir) and works on all that the one before has kept; only the columns of documents count,
others are left out. An empty table stays empty at each stage. Rows with equal or null ids are documents of their own: where
there are any, a stage gives each row a key first. A null or empty text is not toxic, has no lines to lose, is no copy of
another and holds no passage, so it stays.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.leaks import decontaminate
from tidemark.llm.line_dedup import dedup_lines, has_word
from tidemark.llm.near_copies import jaccard_join
from tidemark.llm.packing import pack
from tidemark.llm.queries import crc_part
from tidemark.llm.tables import documents, keyed, shared_folder
from tidemark.llm.toxicity import learn, score

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
KEY = "_key"
#: A document is toxic from here on; above 0.3, what op5 calls toxic, since a clean document lost is lost for good.
TOXIC = 0.5


def own_keys(docs: DataFrame) -> DataFrame:
    return keyed(docs.select(*COLUMNS), "doc_id", KEY)


def without(docs: DataFrame, gone: DataFrame) -> DataFrame:
    """docs without the rows of those keys."""
    return docs.join(gone.select(KEY).distinct(), KEY, "left_anti").select(*COLUMNS)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Learns from the labelled documents that are not held out, and drops documents that score TOXIC or more."""
    model = learn(docs, documents(spark, sf_dir, "labels"), ~crc_part(4, 2))
    return score(docs.select(*COLUMNS), model, score_col="_score").where(F.col("_score") < TOXIC).drop("_score")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes out repeated lines; a document goes if that leaves it without a word. n_chars follows the text."""
    out = dedup_lines(own_keys(docs), id_col=KEY, carry=("doc_id", "lang", "source"), exact_chars=1)
    out = out.where((F.col("n_exact") + F.col("n_near") == 0) | has_word("kept_text"))
    return out.select("doc_id", F.col("kept_text").alias("text"), "lang", "source", F.length("kept_text").cast("long").alias("n_chars"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each class of near copies the document with the least id stays."""
    docs = own_keys(docs)
    return without(docs, jaccard_join(docs, id_col=KEY).where(F.col(KEY) != F.col("class_id")))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of the benchmark."""
    docs = own_keys(docs)
    return without(docs, decontaminate(docs, documents(spark, sf_dir, "benchmark"), id_col=KEY))


def pack_rest(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Packs the rest into sequences of 4096 tokens."""
    import public_tokenizers

    return pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES = [("toxicity", drop_toxic), ("line_dedup", drop_lines), ("ngram_jaccard", drop_near_copies), ("decontamination", drop_leaks), ("best_fit_packing", pack_rest)]

#: Learnt scores and tokenizers are beyond SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is written as Parquet in the shared folder and read again. A stage's folder is
    deleted when the next one's is complete; the last one's stays, since the rows returned are read from it."""
    docs, folder = documents(spark, sf_dir), f"{shared_folder(spark)}/pipeline-{uuid.uuid4()}"
    for k, (name, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if k:
            old = spark._jvm.org.apache.hadoop.fs.Path(f"{folder}/{STAGES[k - 1][0]}")
            old.getFileSystem(spark._jsc.hadoopConfiguration()).delete(old, True)
    return docs
