"""Session helpers that the operators share."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that go to Python at once: long texts then stay within a worker's memory.
ARROW_ROWS, ARROW_BYTES = 500, 8 << 20


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches, for the whole session; a checkpoint folder where the cluster names none (tests)."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ARROW_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(ARROW_BYTES))
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


@functools.cache
def local_folder() -> str:
    """A folder of this process, which goes when it ends."""
    folder = tempfile.mkdtemp(prefix="tidemark-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    return folder


def shared_folder(spark: SparkSession) -> str:
    """The folder that driver and executors share; a local one only in local mode, where both are one process."""
    if folder := spark.conf.get("spark.checkpoint.dir", None):
        return folder
    master = spark.sparkContext.master
    if not re.fullmatch(r"local(\[[^\]]*\])?", master):
        raise ValueError(f"set spark.checkpoint.dir to a folder that the driver and all executors of {master} share")
    return local_folder()


def cut(df: DataFrame) -> DataFrame:
    """Writes df to the shared checkpoint folder and reads it from there: lost executors lose nothing of it."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def arrow_type(df: DataFrame, column: str) -> tuple[pa.DataType, str]:
    """The Arrow type and the SQL type of a column, as functions over Arrow batches declare them."""
    from pyspark.sql.pandas.types import to_arrow_type

    kind = df.schema[column].dataType
    return to_arrow_type(kind), kind.simpleString()


def unique_ids(docs: DataFrame, id_col: str) -> bool:
    """Whether every row has an id of its own, none of them null. Reads the ids alone."""
    return docs.groupBy(id_col).agg(F.count(F.lit(1)).alias("n")).where(F.col(id_col).isNull() | (F.col("n") > 1)).isEmpty()


def keyed(docs: DataFrame, id_col: str, key_col: str) -> DataFrame:
    """docs with a key of its own for each row: the id where ids are unique, else the id and a number, written so that it stays.

    Keys are ordered as ids are; a null id comes first.
    """
    if unique_ids(docs, id_col):
        return docs.withColumn(key_col, F.col(id_col))
    return cut(docs.withColumn(key_col, F.struct(F.col(id_col).alias("id"), F.monotonically_increasing_id().alias("row"))))


def id_of(docs: DataFrame, key: str, id_col: str, id_type: str) -> Column:
    """The id in a key that keyed() made."""
    return (F.col(key) if docs.schema[key].dataType.simpleString() == id_type else F.col(key)["id"]).alias(id_col)
