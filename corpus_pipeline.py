"""The training-data pipeline over ``documents``, stage by stage.

Each stage reads what its predecessor kept, decides over all of it, and all but
the last return the columns of ``documents``: quality rules (rejected documents
go), MinHash near-dedup (one document of each group stays), benchmark
decontamination (contaminated documents go), mixing to target weights (documents
that the mix takes stay; ones taken whole more than once come as often), and
token-ID files (read back).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from etalage.llm.decontaminate import find_contamination
from etalage.llm.mixing import mix_sources
from etalage.llm.near_dedup import group_near_duplicates
from etalage.llm.quality_forest import judge_quality
from etalage.llm.queries import word_bpe
from etalage.llm.storage import fresh_name, store
from etalage.llm.token_files import tokens_to_files
from etalage.sources.io import read_source

#: words of a shingle; near copies share 80 % of them
SHINGLE = 5


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; rows that share an id are judged each by its own text."""
    judged, name = judge_quality(docs, read_source(spark, sf_dir, "labels", ["doc_id", "quality"]))
    return judged.where(f"{name}.kept").select(*docs.columns)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: that with the smallest id (null last).

    Rows are told apart by a number of their own, so a document without id is compared
    as any other, and of rows that share an id each stands for itself.
    """
    row = fresh_name([*docs.columns, "first"], "row")
    rows = store(docs.withColumn(row, F.monotonically_increasing_id()), "numbered")
    groups = group_near_duplicates(rows, doc_id=row, shingle=SHINGLE).select(F.col("doc_id").alias("row"), "component_id")
    first = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", F.xxhash64("text").alias("tie"), F.col(row).alias("row"))
    kept = rows.select(F.col(row).alias("row"), first.alias("first")).join(groups, "row").groupBy("component_id").agg(
        F.min("first").alias("first")).select(F.col("first.row").alias(row))
    return rows.join(kept, row, "left_semi").select(*docs.columns)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage; a text without words has none."""
    judged, name = find_contamination(docs, read_source(spark, sf_dir, "benchmark", ["item_id", "text"]))
    return judged.where(f"not {name}.contaminated").select(*docs.columns)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: a document comes as often as half of it or more is taken. One without words is never taken;
    a null source is a source of its own."""
    mixed = mix_sources(docs, keep=docs.columns)
    mix = F.col(mixed.columns[-1])
    times = F.floor(mix["taken"] / F.greatest(mix["size"], F.lit(1)) + 0.5).cast("int")
    copy = fresh_name(mixed.columns, "copy")
    return mixed.where(times > 0).select(*docs.columns, F.explode(F.sequence(F.lit(1), times)).alias(copy)).drop(copy)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 (null ids first; a text without
    words has the end id only)."""
    return tokens_to_files(docs, word_bpe(), by_word=True)


STAGES = [
    ("quality", quality_stage),
    ("near_dedup", near_dedup_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("token_files", token_stage),
]

#: the forest, the seeded mix and the tokenizer cannot be said in SQL
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each writes its result before the next reads it."""
    docs = read_source(spark, sf_dir, "documents")
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = store(docs, f"stage-{name}")
    return docs
