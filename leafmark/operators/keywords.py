"""Literal keyword counting, dictionaries, matrices and reviewed tiers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import match_key, occurrences

#: A dictionary may have this many keywords; it is frozen on the driver and sent to all executors.
MAX_KEYWORDS = 16_383


def dictionary(spark: SparkSession, lines: list[str]) -> DataFrame:
    """keyword_id, keyword (first spelling), key and ordinal of the distinct keywords; blank lines do not count."""
    if len(lines) > MAX_KEYWORDS:
        raise ValueError(f"more than {MAX_KEYWORDS} keywords")
    raw = spark.createDataFrame(list(enumerate(lines)), "ordinal int, line string").select("ordinal", F.trim(F.replace("line", F.lit("﻿"), F.lit(""))).alias("keyword"))
    keyed = raw.where("keyword <> ''").withColumn("key", match_key("keyword"))
    first = keyed.groupBy("key").agg(F.min(F.struct("ordinal", "keyword")).alias("s"))
    return first.select(F.concat(F.lit("kw-"), F.substring(F.sha2("key", 256), 1, 16)).alias("keyword_id"), "s.keyword", "key", "s.ordinal")


def keyword_counts(docs: DataFrame, words: DataFrame, keep: list[str]) -> DataFrame:
    """One row per document and keyword with its literal count (0 counts as a row; null where the text is unknown).

    Keywords are independent of one another; occurrences of one do not overlap. The texts' keys are made once; the dictionary
    has at most MAX_KEYWORDS rows and goes to every executor as one array, so no row is shuffled.
    """
    known = words.select("keyword_id", "keyword", "key", "ordinal").orderBy("ordinal").collect()
    table = F.array(*[F.struct(F.lit(r.keyword_id).alias("keyword_id"), F.lit(r.keyword).alias("keyword"), F.lit(r.key).alias("key")) for r in known])
    keyed = docs.select(*keep, match_key("text").alias("text_key"))
    return keyed.select("*", F.explode(table).alias("k")).select(*keep, "k.keyword_id", "k.keyword", occurrences(F.col("text_key"), F.col("k.key")).alias("n"))


def keyword_matrix(counts: DataFrame, row: str, keywords: dict[str, str]) -> DataFrame:
    """Rows by keyword (columns named by the keys of `keywords`), and a row of column totals (its `row` is null); a total is null if any of its counts is unknown."""
    def total(keyword: str, name: str) -> Column:
        of = F.col("keyword") == keyword
        return F.when(F.count_if(of) == F.count_if(of & F.col("n").isNotNull()), F.sum(F.when(of, F.col("n")))).alias(name)

    return counts.rollup(row).agg(*[total(k, name) for name, k in keywords.items()])


def latest_decisions(events: DataFrame) -> DataFrame:
    """The last decision on each candidate by (time, id)."""
    last = Window.partitionBy("candidate_id").orderBy(F.col("decided_at").desc(), F.col("decision_id").desc())
    return events.withColumn("_n", F.row_number().over(last)).where("_n = 1").drop("_n")


def conflicting_decisions(events: DataFrame) -> DataFrame:
    """Candidates with different statuses at one instant: an error of the log."""
    return events.groupBy("candidate_id", "decided_at").agg(F.count_distinct("status").alias("n")).where("n > 1").select("candidate_id", "decided_at")


def tiers(candidates: DataFrame, decisions: DataFrame) -> DataFrame:
    """Literal, accepted and pending counts per keyword, never mixed; the reviewed total is unknown while anything is pending."""
    judged = candidates.join(decisions.select("candidate_id", "status"), "candidate_id", "left")
    pending = F.count_if((F.col("tier") == "candidate") & (F.col("status").isNull() | (F.col("status") == "REVOKED")))
    literal, accepted = F.count_if(F.col("tier") == "literal"), F.count_if((F.col("tier") == "candidate") & (F.col("status") == "ACCEPTED"))
    out = judged.groupBy("keyword").agg(literal.alias("literal"), accepted.alias("accepted"), pending.alias("pending"))
    return out.withColumn("reviewed", F.when(F.col("pending") == 0, F.col("literal") + F.col("accepted")))
