"""Queries of the training-data problems and, where SQL can express them, their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, credentials, handwritten, language, packing, splitting, syntax
from tessera.llm.near_duplicates import NearDuplicates
from tessera.session import ship_package, table

#: Production parameters.
TOKEN_LIMIT = 1024
TOKEN_OVERLAP = 64
SHINGLE_WORDS, SIMILARITY, LEAST_SHINGLES = 3, 0.6, 30
CONTAINER_TOKENS = 2048
#: Confidence from which a language outweighs a label that names another one.
LABEL_CONFIDENCE = 0.08


def _classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return handwritten.classify_files(table(spark, sf_dir, "files"), table(spark, sf_dir, "file_texts"), table(spark, sf_dir, "upstream_files"))


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir).filter("NOT handwritten").select("file_id").distinct()


def p1_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _classified(spark, sf_dir)


def p2_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    out = splitting.split_oversized(table(spark, sf_dir, "chunks"), limit=TOKEN_LIMIT, overlap=TOKEN_OVERLAP, only_oversized=True, with_text=False)
    return out.filter("piece_no = 1 AND n_pieces > 1").select("chunk_id").distinct()


def p2_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return splitting.split_oversized(table(spark, sf_dir, "chunks"), limit=TOKEN_LIMIT, overlap=TOKEN_OVERLAP)


def _near(spark: SparkSession, sf_dir: str) -> NearDuplicates:
    ship_package(spark)
    return NearDuplicates(table(spark, sf_dir, "chunks"), "chunk_id", "text", width=SHINGLE_WORDS, threshold=SIMILARITY, least=LEAST_SHINGLES)


def p3_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir).key_pairs().select(F.col("key_a").alias("chunk_id_a"), F.col("key_b").alias("chunk_id_b"))


def p3_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _near(spark, sf_dir).groups().withColumnRenamed("key", "chunk_id")


def p5_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return credentials.credential_lines(table(spark, sf_dir, "chunks")).select("chunk_id", "line_no")


def p5_redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return credentials.redact(table(spark, sf_dir, "chunks"))


def _checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return syntax.check_files(table(spark, sf_dir, "files"), table(spark, sf_dir, "file_texts"))


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _checked(spark, sf_dir).filter("error_line IS NOT NULL").select("file_id").distinct()


def p6_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return syntax.error_rates(_checked(spark, sf_dir), table(spark, sf_dir, "files"))


def p7_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    return bpe.encode_corpus(table(spark, sf_dir, "documents"))


def p8_containers(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    return packing.pack(bpe.token_counts(docs), "doc_id", "n_tokens", capacity=CONTAINER_TOKENS, n_items=docs.count())


def p9_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    carried = docs.select(F.struct("doc_id", language.label_code_column(F.col("lang")).alias("label")).alias("row"), "text")
    out = language.text_languages(carried, language.fit(docs), key="row")
    label = F.col("row.label")
    wrong = label.isNull() | (F.col("n_languages") > 1) | ((label != F.col("lang_code")) & (F.col("confidence") >= LABEL_CONFIDENCE))
    return out.filter(wrong).select(F.col("row.doc_id").alias("doc_id"), "lang_code").distinct()


def p9_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    return language.text_languages(docs, language.fit(docs), every_row=True)


def p9_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    ship_package(spark)
    docs = table(spark, sf_dir, "documents")
    return language.text_segments(docs, language.fit(docs))


QUERIES = {
    f.__name__: f
    for f in (p1_found, p1_files, p2_found, p2_pieces, p3_found, p3_groups, p5_found, p5_redacted, p6_found, p6_rates, p7_ids, p8_containers, p9_found, p9_languages, p9_segments)
}

ORACLE = {
    "p2_found": "SELECT DISTINCT chunk_id FROM chunks WHERE (length(text) + 3) // 4 > 1024",
}
