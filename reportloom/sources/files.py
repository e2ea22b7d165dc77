"""Text files as documents, in several encodings, and sections, tables and reports as files."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import newlines, safe_name

#: Encodings after UTF-8, in order of trial.
ENCODINGS = ("GB18030", "Big5")


def _named(df: DataFrame, text) -> DataFrame:
    stem = F.regexp_replace(F.element_at(F.split(F.url_decode(F.col("_metadata.file_path")), "/"), -1), r"\.[^.]*$", "")
    return df.select(stem.alias("doc_id"), newlines(text).alias("text"))


def read_texts(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(doc_id, text) of UTF-8 files; doc_id is the name without its ending."""
    return _named(spark.read.option("wholetext", True).option("pathGlobFilter", glob).text(path), F.col("value"))


@contextmanager
def settings(spark: SparkSession, **values: str) -> Iterator[None]:
    """Session settings while a plan is made; those of before come back."""
    names = {k.replace("__", "."): v for k, v in values.items()}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def read_mixed(spark: SparkSession, path: str, glob: str = "*.txt") -> DataFrame:
    """(doc_id, text) of files in UTF-8 or a Chinese encoding: the first that decodes without a replacement. Decodes them with the JVM's character sets."""
    with settings(spark, spark__sql__legacy__javaCharsets="true", spark__sql__legacy__codingErrorAction="true"):
        raw = spark.read.format("binaryFile").option("pathGlobFilter", glob).load(path)
        tries = [F.when(F.is_valid_utf8(F.col("content").cast("string")), F.col("content").cast("string"))]
        for name in ENCODINGS:
            t = F.decode("content", name)
            tries.append(F.when(~t.contains("�"), t))
        return _named(raw, F.coalesce(*tries, F.regexp_replace(F.decode("content", "GB18030"), "�", "")))


def file_name(flat: bool = False):
    """A column: where a section's file goes, order_name.txt in its document's folder or, ``flat``, behind the document's name."""
    order = F.lpad(F.coalesce(F.col("ord"), F.lit(999)).cast("string"), 3, "0")
    return F.concat(F.col("doc_id").cast("string"), F.lit("_" if flat else "/"), order, F.lit("_"), safe_name(F.col("canonical")), F.lit(".txt"))


def write_sections(sections: DataFrame, path: str, flat: bool = False, folders: int = 64) -> None:
    """Sections as Parquet with the name of the file each would be.

    Documents are dealt to a fixed number of folders, not to one each, so that a document's sections are found in one
    folder (``folder_of``) and the number of files doesn't grow with that of documents.
    """
    out = sections.withColumns({"file": file_name(flat), "folder": folder_of(folders)})
    out.repartition("folder", F.pmod(F.hash("doc_id"), F.lit(16))).sortWithinPartitions("folder", "doc_id", "ord").write.mode("overwrite").partitionBy("folder").parquet(path)


def folder_of(folders: int = 64):
    """A column: the folder of ``write_sections`` that holds a document."""
    return F.pmod(F.xxhash64("doc_id"), F.lit(folders)).cast("int")


def read_section_files(spark: SparkSession, path: str, numbered: bool = False) -> DataFrame:
    """(doc_id, number, name, size) of section files: the number before the first underscore, the size in bytes; ``numbered`` leaves out names that don't begin with digits."""
    raw = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*_*.txt").load(path)
    parts = F.split(F.url_decode(F.col("path")), "/")
    name = lambda k: F.regexp_extract(F.element_at(parts, -1), r"^([^_]*)_(.*)\.txt$", k)
    out = raw.select(F.element_at(parts, -2).alias("doc_id"), name(1).alias("number"), name(2).alias("name"), F.col("length").alias("size"))
    return out.filter("number RLIKE '^[0-9]+$'") if numbered else out


def listed(files: DataFrame) -> DataFrame:
    """(doc_id): the documents that section files belong to; folders whose names begin with an underscore are none."""
    return files.select("doc_id").distinct().filter(~F.col("doc_id").startswith("_"))


def section_sizes(files: DataFrame) -> DataFrame:
    """(doc_id, numbers, sizes): a document's section numbers in order, and the size of each."""
    pairs = F.array_sort(F.collect_list(F.struct("number", "size")))
    each = files.groupBy("doc_id", "number").agg(F.max("size").alias("size")).groupBy("doc_id").agg(pairs.alias("x"))
    return each.select("doc_id", F.col("x.number").alias("numbers"), F.map_from_entries("x").alias("sizes"))


def write_report(summary: DataFrame, path: str, details: DataFrame | None = None) -> None:
    """A one-row summary as JSON text; ``details`` as lines of JSON beside it, in the order of status_rank and doc_id, in as many files as they need."""
    summary.select(F.to_json(F.struct("*")).alias("value")).coalesce(1).write.mode("overwrite").text(path)
    if details is not None:
        details.sort("status_rank", "doc_id").write.mode("overwrite").json(f"{path}_details")


def read_report(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A report's rows by ``schema``, JSON over one or several lines; no rows if there is no such file."""
    try:
        return spark.read.schema(schema).option("multiLine", True).json(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def write_tables(tables: dict[str, DataFrame], path: str, readable: tuple[str, ...] = ()) -> None:
    """Named tables (audits, cleaned texts, blocks, labels, sub-sections, differences, answers), each as Parquet in its folder; those in ``readable`` as lines of JSON too."""
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path}/{name}")
        if name in readable:
            df.sparkSession.read.parquet(f"{path}/{name}").write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/{name}_json")


def append_new(rows: DataFrame, path: str, key: str = "doc_id") -> None:
    """Appends to a log (Parquet) the rows whose key it doesn't hold yet; of rows with one key the first by all columns. A null key is never logged."""
    spark = rows.sparkSession
    once = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.min(F.struct(*[c for c in rows.columns if c != key])).alias("x")).select(key, "x.*")
    try:
        once = once.join(spark.read.schema(once.schema).parquet(path).select(key), key, "left_anti")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
    once.write.mode("append").parquet(path)
