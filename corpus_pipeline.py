"""The training-data pipeline: quality, near duplicates, PII, mixing, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last return the columns of documents.
`run` writes each stage's result as Parquet in the shared folder and reads it for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm.common import WORD_SQL, discard, stored, table
from corpusloom.llm.jaccard_join import jaccard_components
from corpusloom.llm.mixing import mix
from corpusloom.llm.packing import pack
from corpusloom.llm.pii import find
from corpusloom.llm.quality_rules import quality_rules
from corpusloom.llm.queries import tokenizer_file

#: The columns that a stage hands on.
COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _documents(docs: DataFrame) -> DataFrame:
    return docs.select(*COLUMNS)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go (null and empty texts among them); of the others, lines that fail a rule. Each row is judged by itself:
    ids may be null or repeat, an empty table gives an empty one."""
    judged = quality_rules(docs, carry=("lang", "source"))
    return judged.where("kept").select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.length("clean_text").cast("long").alias("n_chars"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group stays: the one with the least id (null last; of several texts with that id the one with the least hash),
    once if its row is repeated. Rows without a word are in no group, so all of them stay."""
    key = F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", F.xxhash64("text").alias("hash"))
    keyed = _documents(docs).withColumn("_key", key)
    groups = jaccard_components(keyed.select("_key", "text"), "_key")
    first = groups.where((F.col("n_shingles") > 0) & (F.col("_key") == F.col("component_id"))).select("_key").distinct()
    kept = keyed.join(first, "_key", "left_semi").dropDuplicates(["_key"])
    wordless = keyed.where(~F.coalesce(F.col("text").rlike(WORD_SQL), F.lit(False)))
    return kept.union(wordless.select(kept.columns)).select(*COLUMNS)


def pii(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data is generalised, and terms that give it away are removed. No row goes; a null text becomes an empty one."""
    found = find(docs, clean=True, carry=("lang", "source"))
    return found.select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.length("clean_text").cast("long").alias("n_chars"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A document that is taken k times comes k times; of the one at a source's threshold that is taken in part, so many first words.
    Null sources are a source; rows with one id are decided together; texts without a word are not taken."""
    mixed = mix(docs, carry=("text", "lang", "source"))
    share = lambda x: F.when(F.col("size") > 0, x).otherwise(0).cast("int")
    mixed = mixed.withColumns({"full": share(F.floor(F.col("taken") / F.col("size"))), "rest": share(F.col("taken") % F.col("size"))})
    words = F.regexp_extract_all("text", F.lit(r"([\x20\x09-\x0D]*[^\x20\x09-\x0D]+)"), F.lit(1))
    part = F.when(F.col("rest") > 0, F.array(F.array_join(F.slice(words, 1, F.col("rest")), ""))).otherwise(F.array().cast("array<string>"))
    rows = mixed.select("doc_id", F.explode(F.concat(F.array_repeat("text", F.col("full")), part)).alias("text"), "lang", "source")
    return rows.withColumn("n_chars", F.length("text").cast("long")).select(*COLUMNS)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document in a sequence. Each row is a document of its own, whatever its id; a null text is an empty one, which
    is its end id alone."""
    return pack(docs, tokenizer_file())


STAGES = [
    ("quality rules", quality),
    ("n-gram Jaccard join", near_duplicates),
    ("PII", pii),
    ("mixing", mixing),
    ("packing", packing),
]

#: None: neither the tokenizer nor the disclosure estimate can be said in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table of documents; a stage's result goes when the next one's is written."""
    docs = table(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        before, docs = docs, stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage-{k}")
        if 0 < k < len(STAGES) - 1:
            discard(before)
    return docs
