"""The registered queries of the corpus operators, with their production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import exact_dedup as _dedup
from tessera.llm import language_id, lexical_search, line_dedup, toxicity, url_filters
from tessera.llm.common import table
from tessera.llm.decontaminate import contaminated
from tessera.llm.packing import pack_documents
from tessera.llm.quotes import link_quotes
from tessera.llm.simhash import simhash_groups
from tessera.llm.token_counts import token_counts
from tessera.llm.warc import warc_round_trip
from tessera.llm.whitening import whiten


def tokenizer_file(name: str) -> str:
    import public_tokenizers
    return str(public_tokenizers.path(name))


def fold(n: int) -> Column:
    """crc32 of doc_id as text, modulo ``n``."""
    return F.crc32(F.col("doc_id").cast("string")) % n


def language_rows() -> Column:
    """The rows that language identification may learn from."""
    return fold(4) != 2


def op1_quotation_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies, roots and depths of all messages of ``conversations``."""
    return link_quotes(table(spark, sf_dir, "conversations"))


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = language_id.fit(docs, language_rows())
    return language_id.identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold(4) == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", "rejected")


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per document: doc_id, removed_lines (their numbers), n_removed, and the cleaned text."""
    return line_dedup.line_dedup(table(spark, sf_dir, "documents")).select(
        "doc_id", "removed_lines", F.size("removed_lines").alias("n_removed"), "text")


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"), fold(5) != 0)
    return toxicity.score(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold(5) == 0, F.lit(False)).alias("held_out"), "score", "predicted")


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_groups(table(spark, sf_dir, "documents"), shingle=3, bits=3)


def op7_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"), limit=2048)


def op8_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document and benchmark item with an occurrence: doc_id, item_id, edits, start_char, end_char."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_round_trip(table(spark, sf_dir, "pages"), shard_bytes=32 << 20, file_bytes=4 << 20).drop("payload", "url")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_documents(table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json"),
                          tokenizer_file("byte_bpe_50k.tiktoken"), limit=2048)


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"), k=4)


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.sql(f"SELECT * FROM VALUES {', '.join(map(str, url_filters.RULES))} AS r(host, path, verdict)")
    return url_filters.url_filter(table(spark, sf_dir, "pages"), rules)


QUERIES = {f.__name__: f for f in (
    op1_quotation_linking, op2_exact_dedup, op3_language_id, op4_line_dedup, op5_toxicity, op6_simhash,
    op7_token_counts, op8_decontamination, op9_warc, op10_best_fit_packing, op11_embedding_whitening,
    op12_lexical_search, op13_url_filters)}
ORACLE = {"op2_exact_dedup": _dedup.SQL, "op12_lexical_search": lexical_search.SQL, "op13_url_filters": url_filters.SQL}
