"""What the operators share: reading tables, cutting lineage, and exchanges of packed blocks."""

from __future__ import annotations

import contextlib
import ctypes
import gc
import os
import tempfile
import time
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType, StructField, StructType

NO_ID = (1 << 63) - 1  # a null id orders after every other
ROWS_PER_BATCH = 1000


def prepare(spark: SparkSession) -> None:
    """Small Arrow batches (whole texts can be long) and a checkpoint folder.

    The folder the cluster names in spark.checkpoint.dir is used; a folder of our own is
    set only where neither that setting nor a folder set earlier exists, as in tests.
    """
    if spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000":
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    sc = spark.sparkContext
    if not sc._jsc.sc().getCheckpointDir().isDefined():
        shared = sc.getConf().get("spark.checkpoint.dir")
        if not shared and not sc.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        sc.setCheckpointDir(shared or os.path.join(tempfile.gettempdir(), "pixelframe-checkpoints"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """The rows from the shared checkpoint folder: a lost executor costs no recomputation."""
    prepare(df.sparkSession)
    return df.checkpoint(eager=True)


def release(spark: SparkSession, rounds: int = 2) -> None:
    """Lets Spark drop the shuffle files of finished steps, which it does once the driver's
    garbage collector has seen that nothing refers to them. Those of the last step often go in
    the third or fourth round only: worth it where they are large and the next step's are too."""
    for _ in range(rounds):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(0.2)


def column(name: str) -> Column:
    """A column by its whole name, dots, spaces and backticks included."""
    return F.col("`" + name.replace("`", "``") + "`")


def carried(docs: DataFrame, carry: list[str] | None) -> Column:
    """The carried columns (all unless given) in one struct, so their names can't clash."""
    return F.struct(*[column(c).alias(c) for c in (docs.columns if carry is None else carry)]).alias("row")


def fields(df: DataFrame, names: list[str], more: str = "") -> StructType:
    """Columns of df, then those of a DDL string."""
    return StructType([StructField(n, df.schema[n].dataType) for n in names] + (list(StructType.fromDDL(more)) if more else []))


def text_bytes(docs: DataFrame, text_col: str) -> int:
    """Bytes of all texts: what block counts are derived from."""
    return docs.select(F.sum(F.octet_length(column(text_col).cast("string"))).alias("n")).first()["n"] or 0


def id_order(docs: DataFrame, id_col: str, to: str) -> DataFrame:
    """docs with a long column that orders as the ids do, nulls last: the id itself if it is a
    whole number, else its rank among the distinct ids (counted by ordered partition)."""
    if isinstance(docs.schema[id_col].dataType, IntegralType):
        return docs.withColumn(to, F.coalesce(column(id_col).cast("long"), F.lit(NO_ID)))
    ids = docs.select(column(id_col).alias("k")).where("k IS NOT NULL").distinct().orderBy("k")
    kind = StructType([StructField("k", docs.schema[id_col].dataType), StructField(to, StructType.fromDDL("r bigint")[0].dataType)])
    ranks = cut(docs.sparkSession.createDataFrame(ids.rdd.zipWithIndex().map(lambda x: (x[0][0], x[1])), kind))
    return docs.join(ranks, column(id_col) == ranks["k"], "left").withColumn(to, F.coalesce(column(to), F.lit(NO_ID))).drop(ranks["k"])


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: list[str] | None = None) -> DataFrame:
    """id (a long that orders as the ids do, null last), xxhash64 of the text, the text, and row.

    (id, th) is the key of a row: rows that agree in both have the same result, so repeated
    rows and repeated ids need no row numbers.
    """
    carry, key = docs.columns if carry is None else carry, "id"
    while key in docs.columns:
        key += "_"
    t = column(text_col).cast("string")
    return id_order(docs, id_col, key).select(column(key).alias("id"), F.xxhash64(t).alias("th"), t.alias("text"), carried(docs, carry))


def trim() -> None:
    """Gives freed memory back: an idle worker would keep it while other steps need it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def map_batches(df: DataFrame, f: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str | StructType) -> DataFrame:
    prepare(df.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from f(batches)
        trim()

    return df.mapInArrow(run, schema)


def batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c) for c in columns.values()], list(columns))
