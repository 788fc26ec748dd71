"""The corpus pipeline: five stages, each over all that the stage before it kept.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next stage's docs. All but the last return the
columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import language_id, line_dedup as lines
from tessera.llm.common import table, written
from tessera.llm.decontaminate import contaminated
from tessera.llm.packing import pack_documents
from tessera.llm.queries import language_rows, tokenizer_file
from tessera.llm.simhash import simhash_groups

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def _columns(df: DataFrame) -> DataFrame:
    return df.select(*COLUMNS)


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 3: documents whose language cannot be told go."""
    model = language_id.fit(docs, language_rows())
    return _columns(language_id.identify(docs, model).where("NOT rejected"))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 4: lines of earlier documents are deleted; n_chars follows the text."""
    out = lines.line_dedup(docs)
    changed = F.size("removed_lines") > 0
    return _columns(out.withColumn("n_chars", F.when(changed, F.length("text").cast("long")).otherwise(F.col("n_chars"))))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: of each group of near-duplicates the document with the smallest doc_id stays.

    Rows with a null doc_id cannot be told apart from one another by an id; they stay.
    """
    groups = simhash_groups(docs, shingle=3, bits=3)
    # written, so that the planner knows its size: few ids are broadcast, and no text is shuffled
    gone = written(groups.where("doc_id <> component_id").select("doc_id").distinct(), "gone")
    return _columns(docs.join(gone, "doc_id", "left_anti"))


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 8: documents in which a benchmark item occurs go.

    Rows with a null doc_id have no id to go by: they are searched again under a
    hash of their text, and those that are hit go as well.
    """
    benchmark = table(spark, sf_dir, "benchmark")
    own = F.xxhash64("text")
    hit = contaminated(docs, benchmark).select("doc_id").where("doc_id IS NOT NULL").distinct()
    nameless = contaminated(docs.where("doc_id IS NULL").select(own.alias("doc_id"), "text"), benchmark).select("doc_id").distinct()
    gone = written(hit.withColumn("nameless", F.lit(False)).unionByName(nameless.withColumn("nameless", F.lit(True))), "gone")
    key = F.struct(F.coalesce("doc_id", own).alias("k"), F.col("doc_id").isNull().alias("nameless"))
    return _columns(docs.withColumn("_key", key).join(gone.select(F.struct(F.col("doc_id").alias("k"), "nameless").alias("_key")), "_key", "left_anti"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: what is left as sequences of at most 2048 tokens."""
    return pack_documents(docs, tokenizer_file("byte_bpe_50k.json"), tokenizer_file("byte_bpe_50k.tiktoken"), limit=2048)


STAGES = [("language", language), ("line_dedup", line_dedup), ("near_dedup", near_dedup),
          ("decontaminate", decontaminate), ("pack", pack)]
#: Fitting, alignment and packing are beyond SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
