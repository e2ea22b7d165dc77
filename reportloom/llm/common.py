"""Helpers shared by the operators: table paths, written tables, Arrow batches."""

from __future__ import annotations

import atexit
import re
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Words of a text in the contracts: runs of anything but six ASCII blanks.
WORD = re.compile(r"[^\x20\x09-\x0D]+")
#: Rows of an Arrow batch. Texts can be long, so batches have few rows.
BATCH_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Hold Arrow batches to BATCH_ROWS rows: with texts of 100 KB a batch stays near 25 MB."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= BATCH_ROWS:
        spark.conf.set(key, str(BATCH_ROWS))


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from spark.checkpoint.dir. Where that is unset a local session gets a temporary one; a cluster gets an error, as its executors share no local folder."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        folder = tempfile.mkdtemp(prefix="reportloom-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, deleted when the driver's JVM ends."""
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(hadoop)
    return path


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage is cut and a lost executor costs nothing."""
    path = new_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Deletes written tables that no later step reads, so that a long operator holds little of the shared folder."""
    for t in tables:
        hadoop = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t.written_path)
        hadoop.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(hadoop, True)


#: Rows of a few longs that may be broadcast: about 30 MB. Larger tables are joined by shuffling.
BROADCAST_ROWS = 1_000_000


def checked_broadcast(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df``, a written table, marked for broadcast if a count shows that it has at most ``rows`` rows."""
    return F.broadcast(df) if df.count() <= rows else df


#: Rows of one key that a task of a salted join gets, about.
SALT_ROWS = 1000


def salted_join(many: DataFrame, one: DataFrame, key: str, by: str, how: str = "inner", rows: int = SALT_ROWS, counted: DataFrame | None = None) -> DataFrame:
    """``many`` joined with ``one`` (at most a row for each key): a key of more than ``rows`` rows is dealt over salts, which ``by``, a column of ``many``, decides.

    ``counted`` (else ``many``) is a written table with the keys of ``many``, as it is read for the counts first. Keys in need of salts are few: at most the rows of ``many`` by ``rows``.
    """
    hot = (counted or many).groupBy(key).agg(F.count("*").alias("_n")).filter(F.col("_n") > rows).select(key, F.ceil(F.col("_n") / rows).cast("int").alias("_salts"))
    hot = checked_broadcast(written(hot, "hot-keys"))
    salted = many.join(hot, key, "left").withColumn("_salt", F.coalesce(F.pmod(F.xxhash64(by), F.col("_salts")), F.lit(0)).cast("int")).drop("_salts")
    copies = one.join(hot, key, "left").withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1))).drop("_salts")
    return salted.join(copies, [key, "_salt"], how).drop("_salt")
