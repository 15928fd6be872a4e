"""Documents that try every operator: nulls, empty and long texts, ties, repeated rows, clashing extra columns."""

import os
import re

from pyspark.sql import functions as F

SF = "/root/testdata/sf0.001"
HAS_DATA = os.path.isdir(SF)
LONG = "many words in a row " * 20_000
ROWS = [
    (1, "Plain words stand here and there are more than ten of them in all.", "en", "a"),
    (1, "Plain words stand here and there are more than ten of them in all.", "en", "a"),
    (2, "", "en", "a"),
    (3, None, None, None),
    (None, "A text without an id that still has quite a few words in it, as many as ten.", "fr", "b"),
    (4, LONG, "en", None),
    (5, " \n\t ", "de", "b"),
    (6, "mail bob@x.org or +1 (555) 010-2030 now, card 4111 1111 1111 1111, host 10.0.0.1!", "en", "a"),
    (7, "x" * 100_000, None, "\U0001f600"),
    (8, "   İstanbul 한글 é <|endoftext|> don't I'LL \x1c\x85", "en", "￿"),
]
#: Names that operators use themselves.
CLASHES = ["size", "target", "taken", "h", "n", "set", "kept", "score", "id", "key", "spans", "terms", "host", "part", "node", "n_words", "source_size", "text2"]


def documents(spark, rows=ROWS, clash=True):
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")
    return df.withColumns({c: F.lit("clash") for c in CLASHES}) if clash else df


def words(text):
    return re.findall("[^\x20\x09-\x0d]+", text or "")
