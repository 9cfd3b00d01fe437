"""The corpus pipeline: stages over ``documents``, each writing what the next one reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkwatch.llm.contamination import contamination
from sparkwatch.llm.near import near_duplicates
from sparkwatch.llm.packing import packed
from sparkwatch.llm.quality import fold, learn_quality, score_quality
from sparkwatch.llm.substrings import remove_repeats
from sparkwatch.session import written_table

#: The stages are learned or iterative; tests compare them with brute force.
ORACLE_SQL = None


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality ranking rejects go.

    It learns from the labels that the query ``op2_quality`` learns from. Without labels of
    both classes nothing is rejected.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(fold("doc_id", 3) != 1)
    return score_quality(docs, learn_quality(docs, labels)).where("predicted = 1").select("row.*")


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.8 or more) stays.

    It is the one with the smallest doc_id. Each distinct pair of doc_id and text is a document of its
    own (told apart by a 64-bit hash), so where a doc_id has several texts each stays or goes by its own group;
    a row that repeats doc_id and text goes. Rows without doc_id stay, since nothing says what they are.
    """
    rows = docs.where("doc_id IS NOT NULL").select(
        F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.xxhash64("doc_id", "text").alias("key")
    )
    found = near_duplicates(rows.select(F.col("key").alias("doc_id"), F.col("row.text").alias("text")))
    groups = found.select(F.col("doc_id").alias("key"), "component_id").distinct()
    named = rows.select(F.col("row.doc_id").alias("doc_id"), "key").distinct().join(groups, "key")
    first = named.groupBy("component_id").agg(F.min(F.struct("doc_id", "key")).alias("first")).select("first.key")
    kept = rows.join(first, "key", "left_semi").dropDuplicates(["key"]).select("row.*")
    return kept.unionByName(docs.where("doc_id IS NULL"))


def substring_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of 50 or more words that an earlier document holds as well are cut out.

    A document stays even if nothing is left of it; n_chars is counted anew.
    """
    cut = remove_repeats(docs, length=50)
    values = {c: F.col(f"row.`{c}`") for c in docs.columns if c != "text"} | {"text": F.col("text")}
    if "n_chars" in values:
        values["n_chars"] = F.length("text").cast("long")
    return cut.select(*[values[c].alias(c) for c in docs.columns])


def contamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark passages make up a twentieth or more go."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return contamination(docs, items).where("NOT contaminated").select("row.*")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the packed sequences: doc_id, piece,
    first_word, n_words, bin, offset, capacity. A document without words has a null bin."""
    return packed(docs, carry=["doc_id"]).select(
        "row.doc_id", "piece", "first_word", "n_words", "bin", "offset", "capacity"
    )


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("substrings", substring_stage),
    ("contamination", contamination_stage),
    ("packing", packing_stage),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``; each stage is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written_table(stage(spark, docs, sf_dir), name)
    return docs
