"""A training corpus from raw documents: language, exact copies, near copies, secrets, sequences.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and reread as the docs of the
next one. All but the last return the columns of documents.
"""
from pyspark.sql import DataFrame, SparkSession

from millrace.llm import exact_dedup, language_id, packing, secret_scan, simhash
from millrace.llm.tables import discard, stash, stashed, table, tokenizer


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without a letter (null and empty texts too) and those whose language the model can't tell.

    Very long texts are read as a whole. Ties between languages go to the smaller label; repeated rows share a verdict, a
    null doc_id or lang changes none. With nothing to learn from, no language is told and all rows go. An empty table
    gives an empty result; extra columns, whatever their names, are kept.
    """
    return language_id.identified(docs)


def without_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts keeps the one with the largest doc_id.

    Null texts equal empty ones. Very long texts are compared by their digests like others. Ties: rows that repeat the
    largest doc_id and text all stay. Rows without a doc_id stay. An empty table gives an empty result; extra columns,
    whatever their names, are kept.
    """
    return exact_dedup.first_copies(docs)


def without_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies keeps the smallest doc_id.

    Near copies are texts whose SimHash fingerprints of four-word shingles differ in 4 bits at most, and texts whose
    five-word shingles have a Jaccard similarity of 0.8 or more (found by min-hash, verified on the shingles). Null, empty
    and wordless texts are near copies of one another. Very long texts are read as a whole. Ties: rows that
    repeat the smallest doc_id all stay. Rows without a doc_id stay. An empty table gives an empty result; extra columns,
    whatever their names, are kept.
    """
    return simhash.one_of_each(docs, similarity=0.8)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Puts a mark in the place of each secret; keeps every document.

    Null and empty texts stay as they are. Very long texts are read as a whole. Of candidates that overlap the leftmost
    one counts; repeated rows change alike. An empty table gives an empty result; extra columns, whatever their names, are
    kept. n_chars follows the text.
    """
    return secret_scan.redact(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """A row per piece of a document, with its sequence and offset.

    A null or empty text is its end id alone, a very long one is cut into full windows and a rest. Pieces of equal length
    go in the order of their rows; repeated rows are packed once each, rows without a doc_id too. An empty table gives no
    piece. Extra columns, whatever their names, are not looked at.
    """
    return packing.pack_documents(docs, tokenizer("word_bpe_49k.json"))


STAGES = [
    ("language_id", known_language),
    ("exact_dedup", without_copies),
    ("simhash_near_dedup", without_near_copies),
    ("secret_scan", without_secrets),
    ("packing", packed),
]

ORACLE_SQL = None  # SQL has neither the language model, XXH64, the forest nor the tokeniser; tested by brute force


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another on the documents of sf_dir. A stage's working tables go once its result is written."""
    docs, before = table(spark, sf_dir, "documents"), set(stashed())
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), f"stage-{name}")
        discard(spark, [path for path in stashed()[:-1] if path not in before])
    return STAGES[-1][1](spark, docs, sf_dir)
