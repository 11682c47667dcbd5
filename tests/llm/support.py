"""Odd documents for every operator: nulls in each column, empty and very long texts, ties, repeated rows, clashing names."""
from pyspark.sql import types as T

CLASHING = ["digest", "winner", "size", "shard", "lot", "member", "fp", "rep", "key", "g", "u", "v", "low", "high", "id", "component", "score", "kept", "path", "start", "length", "lang_pred", "slot", "n", "held_out", "ids", "path_", "_millrace_lang", "_millrace_score", "place", "marked", "placef", "row", "file", "bucket", "bits", "h1", "h2", "line", "loses", "drop", "part", "mask", "words"]

WORDS = "the river runs past a quiet mill where grain is ground for bread and every morning the miller opens the gate".split()
LONG = " ".join(WORDS[(i * i + 3 * i) % len(WORDS)] + str(i % 977) for i in range(60_000))

ROWS = [
    (1, None, "en", "src0", None),
    (2, "", "en", "src0", 0),
    (3, " \n\t ", None, None, 4),
    (4, "word", "en", "src1", 4),
    (5, "The river runs past a quiet mill", "en", "src1", 32),
    (5, "The river runs past a quiet mill", "en", "src1", 32),
    (6, "the RIVER runs past a quiet mill", "fr", "src2", 32),
    (7, "!!! ### 123", "de", "src2", 11),
    (8, LONG, "en", "src0", len(LONG)),
    (9, LONG, "en", "src0", len(LONG)),
    (None, "no id here but some words all the same", "en", None, 38),
    (None, None, None, None, None),
    (10, "Ünïcödé 日本語 😀   tabs\tand\x0bmore\x00end ▁ x", "es", "src3", 44),
    (11, "x" * 5000, None, "src3", 5000),
]


def documents(spark, rows=ROWS, clashing=True):
    """A documents table of (doc_id, text, lang, source, n_chars), with extra columns of names that operators use."""
    extra = CLASHING if clashing else []
    schema = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()), *(T.StructField(c, T.StringType()) for c in extra)])
    return spark.createDataFrame([(*r, *["other"] * len(extra)) for r in rows], schema)


def empty(spark):
    return documents(spark, [])
