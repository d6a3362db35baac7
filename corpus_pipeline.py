"""A corpus from documents, in five stages: language, near-duplicates, benchmark overlap, mixing, shards.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept; run() writes every stage's result as Parquet into the
shared folder and reads it again. All stages but the last return the columns of documents, whatever further columns there are, with their values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmark.llm.common import delete_path, join_small, named, new_path, packed, scratch, unpacked, written
from leafmark.llm.decontaminate import clean_documents
from leafmark.llm.language import accepted
from leafmark.llm.mixing import mixed_rows
from leafmark.llm.near_dup import near_duplicates
from leafmark.llm.sharding import numbered, sharded


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents without a letter, and those whose trigrams no learned language explains better than chance."""
    return accepted(docs, docs)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows linked by five-word shingles at a similarity of 0.8 or more, the one with the least id stays, null last (of one id, that with the least
    checksum of its text); each row is judged by its own text."""
    if docs.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count():
        rows = docs.select(packed(*[named(c) for c in docs.columns]), F.col("doc_id").alias("id"), F.xxhash64("text").alias("mark"))
        rows, _ = numbered(rows, [F.col("id").asc_nulls_last(), "mark"], "doc_id")
    else:
        rows = docs.select(packed(*[named(c) for c in docs.columns]), "doc_id")
    found = near_duplicates(rows.select("doc_id", F.col("row.text").alias("text")), words=5, percent=80)
    dropped = written(found.where("not kept").select("doc_id"), "dropped")
    left = join_small(rows, dropped, ["doc_id"], "left_anti")
    return left.select(*unpacked(left))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Leaves out documents that share ten words in a row with a benchmark item."""
    return clean_documents(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Takes half as many words again as there are, sources weighing 3, 1, 2 in turn; a document twice at most, as two rows."""
    return mixed_rows(docs, weights=[3, 1, 2], share=1.5, most=2)


def deal_into_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows with the shard (of 8) and slot that a reproducible shuffle gives them; columns `shard` and `slot` of the rows stay, as `shard_source` and `slot_source`."""
    return sharded(docs, n_shards=8, seed=5, add=("shard", "slot"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", keep_uncontaminated),
    ("mixing", mix_sources),
    ("sharding", deal_into_shards),
]

#: Language identification is no SQL query; every stage is tested against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages one after another; what a stage writes for itself is deleted when its result is written."""
    docs, before = spark.read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, stage in STAGES:
        path = new_path(spark, f"stage-{name}")
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        if before:
            delete_path(spark, before)
        docs, before = spark.read.parquet(path), path
    return docs
