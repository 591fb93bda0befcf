"""Corpus pipeline: from raw documents to packed training sequences, in five stages.

Each stage takes what the one before kept and returns the columns of ``documents``; the last returns
the packed pieces. ``run`` writes each stage's result as Parquet and reads it back, so a lost executor
costs one stage's work at most.

Cases, in every stage: rows without id stay, as nothing can be said of them by id (the classifier judges their
text); null, empty and wordless texts stay and are packed as their end id. Repeated rows of one id share that
id's fate in the second and fourth stage and are judged one by one elsewhere; of equal texts the least id
stays. Texts of any length are read whole. An empty ``documents`` gives no pieces; without labels, or without
benchmark items, that stage keeps all. Further columns are carried to the last stage but one, whatever their names.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import common as C
from lakemart.llm import decontaminate, jaccard_join, packing, perplexity, substring_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier keeps; rows without text are kept."""
    judged = perplexity.classify(docs, C.read_table(spark, sf_dir, "labels"), keep_rest=True)
    return judged.where("kept").select("rest.*").select(docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the least id of each group of near duplicates; rows without id stay."""
    linked = jaccard_join.near_duplicates(docs)
    later = linked.where("component_id <> doc_id").select("doc_id").distinct()
    return docs.join(later, "doc_id", "left_anti").select(docs.columns)


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that a smaller document has; texts without any stay as they are."""
    cut = substring_dedup.dedup(docs, keep_rest=True)
    text = F.when(F.col("n_removed") > 0, F.col("kept")).otherwise(F.col("text"))
    size = F.when(F.col("n_removed") > 0, F.char_length("kept").cast("long")).otherwise(F.col("rest.n_chars"))
    return cut.select("rest.*", text.alias("text"), size.alias("_size")).withColumn("n_chars", F.col("_size")).select(docs.columns)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by items of ``benchmark``; rows without id stay."""
    found = decontaminate.contamination(docs, C.read_table(spark, sf_dir, "benchmark"))
    return docs.join(found.where("contaminated").select("doc_id").distinct(), "doc_id", "left_anti").select(docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents in sequences of at most 4096 tokens."""
    return packing.pack(packing.pieces(docs, public_tokenizers.path("word_bpe_49k.json")))


STAGES = [("quality classifier", quality), ("n-gram Jaccard join", near_duplicates), ("substring dedup", repeated_passages),
          ("benchmark decontamination", benchmark_passages), ("best-fit packing", packed)]

#: The classifier and the tokenizer cannot be written in SQL; tests/llm compares with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, from ``documents`` on."""
    docs = C.read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = C.stored(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
