"""One query for each operator, with production parameters over whole tables, and DuckDB SQL where SQL can say it."""
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm import centroids, exact_dedup, fertility, filter_audit, language_id, licenses, line_dedup, packing, quality, secret_scan, sentencepiece_codec, simhash, toxicity
from millrace.llm.tables import table, tokenizer


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, p_text, p_meta, score and kept of every document."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, licenses, sentence_ids and n_unknown of every document."""
    return licenses.license_scan(table(spark, sf_dir, "documents"))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, fingerprint, component_id (and kept) of every document."""
    return simhash.near_dedup(table(spark, sf_dir, "documents"), width=4, distance=4).drop("place")


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_words, base counts, base_failed and kept of every document, and the measures."""
    found = fertility.quality_rules(table(spark, sf_dir, "documents"), {"piece": tokenizer("piece_bpe_32k.model"), "word": tokenizer("word_bpe_49k.json")})
    return found.withColumn("outside", F.array_join("outside", ","))


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, end, sha256, score and is_secret of every candidate in every document."""
    return secret_scan.secret_scan(table(spark, sf_dir, "documents"))


def op6_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256 of every document."""
    return sentencepiece_codec.round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, start, length, ids_crc32, doc_tokens, sequence_id and offset of every piece."""
    return packing.pack_documents(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, lang_pred and score of every document."""
    return language_id.language_id(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, keep_id, group_size, kept and text_sha256 of every document."""
    found = exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def op11_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """doc_id, n_lines, n_dropped and kept_sha256 of every document."""
    found = line_dedup.line_dedup(table(spark, sf_dir, "documents"), least_length=40, least_documents=5)
    return found.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


def op12_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia and centroid_sha256 of every vector that is kept."""
    return centroids.cluster(table(spark, sf_dir, "embeddings"), k=8, rounds=10, seed=3, scale=1024, size=64).drop("centroid")


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters keep, remove and lose, by part, order and step."""
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_quality": op1_quality,
    "op2_license_scan": op2_license_scan,
    "op3_simhash": op3_simhash,
    "op4_quality_rules": op4_quality_rules,
    "op5_secret_scan": op5_secret_scan,
    "op6_sentencepiece": op6_sentencepiece,
    "op7_packing": op7_packing,
    "op8_language_id": op8_language_id,
    "op9_toxicity": op9_toxicity,
    "op10_exact_dedup": op10_exact_dedup,
    "op11_line_dedup": op11_line_dedup,
    "op12_centroids": op12_centroids,
    "op13_filter_audit": op13_filter_audit,
}

SQL = {
    "op2_license_scan": licenses.sql(),
    "op11_line_dedup": line_dedup.sql(),
    "op12_centroids": centroids.sql(),
    "op13_filter_audit": filter_audit.sql(),
    "op10_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))""",
}
