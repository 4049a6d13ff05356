"""Small helpers that the operators share: batch sizes, the shared work folder, reading tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes of text that one Arrow batch brings to a Python worker.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to a few MB, so that a run of very long texts can't fill a worker's memory."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def shared_folder(spark: SparkSession) -> str:
    """The folder that the cluster names in spark.checkpoint.dir. Where none is set, a new local one, on one machine only (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = "file://" + tempfile.mkdtemp(prefix="tidemark-")
        spark.sparkContext.setCheckpointDir(base)
    return base.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write df to a table of its own in the shared folder and read it back: lost executors can't take it with them."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_to = path
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of written() that no later step reads."""
    for df in tables:
        if path := getattr(df, "written_to", None):
            jvm = df.sparkSession._jvm
            at = jvm.org.apache.hadoop.fs.Path(path)
            at.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(at, True)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def words_source(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text as UTF-8 bytes, under fixed names: other columns never reach Python."""
    # a plain column where it is one: Spark shares a shuffle only between plans that are the same in every alias
    plain = id_col == "doc_id" and dict(docs.dtypes)[id_col] == "bigint"
    return docs.select(F.col(id_col) if plain else F.col(id_col).cast("long").alias("doc_id"), text_or_empty(text_col).cast("binary").alias("text"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def apart(docs: DataFrame, text_col: str = "text") -> tuple[DataFrame, Callable[[DataFrame], DataFrame]]:
    """docs (with doc_id) so that rows of one id with different texts have ids of their own, and what gives results their ids back.

    Where no id has two texts, docs come back as they are. Else the new ids keep the order of the old ones, texts of one id follow each other by their hash, and equal rows have
    one id. Null ids stay null. Looking for such ids takes one pass that shuffles 24 bytes a document."""
    h = F.xxhash64(F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")))
    named = docs.filter("doc_id is not null").select("doc_id", h.alias("text hash"))
    twice = named.groupBy("doc_id").agg(F.min("text hash").alias("least"), F.max("text hash").alias("most")).filter("least <> most").select("doc_id")
    places = named.join(twice, "doc_id", "left_semi").distinct()
    places = written(places.withColumn("text place", F.row_number().over(Window.partitionBy("doc_id").orderBy("text hash")) - 1), "texts-of-one-id")
    most = places.agg(F.max("text place")).first()[0]
    if most is None:
        discard(places)
        return docs, lambda out: out
    bits, ids = int(most).bit_length(), docs.agg(F.min("doc_id"), F.max("doc_id")).first()
    met = docs.withColumn("text hash", h).join(places, ["doc_id", "text hash"], "left").withColumn("text place", F.coalesce("text place", F.lit(0)).cast("long"))
    if -(1 << 63 - bits) <= ids[0] and ids[1] < 1 << 63 - bits:
        keyed = written(met.withColumn("doc_id", F.shiftleft("doc_id", bits) + F.col("text place")).select(*docs.columns), "apart")
        return keyed, lambda out: out.withColumn("doc_id", F.shiftright("doc_id", bits))
    # no room in 64 bits: numbers in order, those of a stretch of ids after those of the stretches before it
    own = met.filter("doc_id is not null").select("doc_id", "text place").distinct().withColumn("stretch", F.shiftright("doc_id", 44))
    before = own.groupBy("stretch").count().withColumn("before", F.coalesce(F.sum("count").over(Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("stretch", "before")
    numbers = own.join(before, "stretch").withColumn("new id", F.row_number().over(Window.partitionBy("stretch").orderBy("doc_id", "text place")) + F.col("before"))
    numbers = written(numbers.select("doc_id", "text place", F.col("new id").cast("long").alias("new id")), "new-ids")
    keyed = written(met.join(numbers, ["doc_id", "text place"], "left").withColumn("doc_id", F.col("new id")).select(*docs.columns), "apart")
    old = numbers.select(F.col("new id").alias("doc_id"), F.col("doc_id").alias("old id"))
    return keyed, lambda out: out.join(old, "doc_id", "left").withColumn("doc_id", F.col("old id")).select(*out.columns)
