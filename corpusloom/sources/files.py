"""Files as tables."""

from __future__ import annotations

import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ..functions.text import basename, blank_to_null, looks_like_pdf
from .json_array import read_json_array


def binary_files(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """path, modificationTime, length, content; content is not read unless it is used."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(path)


def file_listing(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """name, path, length, modificationTime without reading any content."""
    return binary_files(spark, path, glob).select(basename(F.col("path")).alias("name"), "path", "length", "modificationTime")


def file_hashes(spark: SparkSession, path: str, glob: str = "*") -> DataFrame:
    """name, length, sha256, is_pdf."""
    f = binary_files(spark, path, glob)
    return f.select(basename(F.col("path")).alias("name"), "length", F.sha2("content", 256).alias("sha256"), looks_like_pdf(F.col("content")).alias("is_pdf"))


def whole_texts(spark: SparkSession, path: str) -> DataFrame:
    """path, text of whole UTF-8 files."""
    return spark.read.option("recursiveFileLookup", True).text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def is_fresh(derived: Column, source: Column) -> Column:
    """A derived file at least as new as its source."""
    return F.coalesce(derived >= source, F.lit(False))


def page_texts(pages: DataFrame, key: str | list[str], number: str, text: Column, ocr_text: Column) -> DataFrame:
    """Pages as rows → key, text (non-empty pages in order, blank lines between), any_ocr. Pages without text take their OCR text."""
    own = blank_to_null(F.trim(text))
    best = F.coalesce(own, blank_to_null(F.trim(ocr_text)))
    keys = [key] if isinstance(key, str) else key
    rows = pages.select(*keys, number, best.alias("_t"), (own.isNull() & best.isNotNull()).alias("_ocr"))
    ordered = F.sort_array(F.collect_list(F.when(F.col("_t").isNotNull(), F.struct(number, "_t"))))
    return rows.groupBy(*keys).agg(F.array_join(F.transform(ordered, lambda x: x["_t"]), "\n\n").alias("text"), F.bool_or("_ocr").alias("any_ocr"))


def read_records(spark: SparkSession, path: str, schema) -> DataFrame:
    """A JSON array of records, of any length: see `json_array`; of rows with one id the last wins. Raises on malformed input."""
    rows = read_json_array(spark, path, schema)
    whole = F.struct(*(f.name for f in schema))
    return rows.groupBy("id").agg(F.max_by(whole, F.struct("start", "k")).alias("r")).select("r.*")


def _first_sign(spark: SparkSession, path: str) -> str:
    """The first character of a file that is no white space."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    stream = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).open(at)
    try:
        while (c := stream.read()) >= 0:
            if c not in b" \t\r\n\xef\xbb\xbf":  # the last three: a byte order mark
                return chr(c)
        return ""
    finally:
        stream.close()


def read_records_or_quarantine(spark: SparkSession, path: str, schema) -> DataFrame:
    """The records of a JSON file; one that cannot be parsed is set aside under another name, and the store starts empty. So does one that is not there."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    empty = spark.createDataFrame([], schema)
    if not fs.exists(at):
        return empty
    try:
        if _first_sign(spark, path) != "[":
            raise ValueError("not a JSON array")
        rows = read_records(spark, path, schema)
        rows.write.format("noop").mode("overwrite").save()
        return rows
    except Exception as e:  # a parse error reaches Python as one of several Spark exceptions
        if not isinstance(e, ValueError) and not any(x in str(e) for x in ("MALFORMED", "FAILFAST", "JsonParse", "FAILED_READ_FILE")):
            raise
        fs.rename(at, jvm.org.apache.hadoop.fs.Path(f"{path}.corrupt-{int(time.time())}"))
        return empty


#: Fields that legacy records may have besides those of a record (fixed values).
LEGACY = ("remote_pdf_url", "local_pdf_path", "pdf_sha256")


def read_legacy(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A JSON array of legacy records: schema's fields that occur in the file, and those of LEGACY. Raises unless the file's top level is an array."""
    if _first_sign(spark, path) != "[":
        raise ValueError(f"{path}: the top level must be a list")
    every = StructType([*schema.fields, *(StructField(c, StringType()) for c in LEGACY)])
    rows = spark.read.schema(every).option("multiLine", True).option("mode", "FAILFAST").json(path)
    there = set(spark.read.option("multiLine", True).option("primitivesAsString", True).json(path).columns)
    return rows.select(*(f.name for f in every if f.name in there))


def to_convert(wanted: DataFrame, files: DataFrame, texts: DataFrame) -> DataFrame:
    """Documents whose text has to be made: wanted (record_id, kind, path) with a filled file and no text at least as new.

    files (path, length, modificationTime); texts (record_id, kind, modificationTime)."""
    source = files.where("length > 0").select("path", F.col("modificationTime").alias("_source"))
    derived = texts.groupBy("record_id", "kind").agg(F.max("modificationTime").alias("_derived"))
    both = wanted.join(source, "path").join(derived, ["record_id", "kind"], "left")
    return both.where(~is_fresh(F.col("_derived"), F.col("_source"))).drop("_source", "_derived")


def text_listing(spark: SparkSession, folder: str) -> DataFrame:
    """record_id, kind, modificationTime, path of the texts folder/kind/record_id.md."""
    f = binary_files(spark, folder, "*.md")
    return f.select(F.regexp_extract("path", r"([^/]+)\.md$", 1).alias("record_id"), F.regexp_extract("path", r"([^/]+)/[^/]+$", 1).alias("kind"), "modificationTime", "path")
