"""Mixing sources to target weights by Pareto order sampling.

Every source gets a target number of words: its weight's part of `share` times all words, never more than `most` times its own words, the rest dealt
again by weight (water filling). Inside a source a document of b binary digits of words has the inclusion weight LENGTH_WEIGHT + b, so longer documents are
taken a little more often; scaled so that the expected words meet the target, with `most` copies at most. The whole part of a document's scaled weight is
taken for certain; the fractional part is its inclusion probability p in a Pareto sample: documents are ranked by
(u / (1 - u)) / (p / (1 - p)), u a hash of the id and the text, and the lowest ranks are taken until the words still wanted are reached (to the nearest
document). Ranks are 52-bit integers; equal ones are ordered by id, then by that hash, so the mix depends on the rows alone, not on their partitions.

Scale. One pass measures the texts into a table of a few numbers per row; sources and length classes are sums of it. The place where a
source's ranks are cut is found bit by bit: each of four passes sums the words by 13 bits of the rank, so no source is sorted
or held in one task, whatever part of the rows it has. Rows at the cut are summed by id and text first, then by partition of the input, so
a text that is repeated in many rows is no large group either.

Cases: a null text, or one without words, has size 0 and is never taken; a null source is a source of its own, the last; a null id counts as an empty
one; rows that agree in id and text are taken one by one; an empty table gives an empty mix; mixed_rows() gives all columns as they were, whatever
their names; in sampled(), the columns it adds replace ones of the same names. Sources are ordered, and their targets worked out, in one task of a few
numbers a source.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import drop_written, join_small, named, packed, unpacked, written

LENGTH_WEIGHT, LEVELS, LEVEL_BITS = 8, 4, 13
MADE = ["size", "source_size", "target", "copies"]


def water_fill(df: DataFrame, by: list[str], weight: str, cap: str, total: Column | str, out: str) -> DataFrame:
    """Deals `total` of each group to its rows by weight, no row getting more than its cap (total is at most the sum of caps)."""
    all_ = Window.partitionBy(*by) if by else Window.partitionBy(F.lit(0))
    order = all_.orderBy(F.col(cap) / F.col(weight), *[c for c in df.columns if c not in by])
    before = F.coalesce(F.sum(cap).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    left = F.sum(weight).over(order.rowsBetween(0, Window.unboundedFollowing))
    total = F.col(total) if isinstance(total, str) else total
    full = df.withColumn("_full", F.col(cap) / F.col(weight) <= (total - before) / left)
    spent = F.coalesce(F.sum(F.when(F.col("_full"), F.col(cap))).over(all_), F.lit(0.0))
    open_ = F.sum(F.when(~F.col("_full"), F.col(weight))).over(all_)
    return full.withColumn("_level", (total - spent) / open_).withColumn(out, F.when(F.col("_full"), F.col(cap)).otherwise(F.least(F.col(cap), F.col("_level") * F.col(weight)))).drop("_full", "_level")


def _plan(rows: DataFrame, weights: list[float], share: float, most: int) -> tuple[DataFrame, DataFrame]:
    """Sources (source, source_size, target) and length classes (source, bits, level: expected copies)."""
    classes = written(rows.groupBy("source", "bits").agg(F.sum("size").alias("words"), F.count("*").alias("n")), "classes")
    sources = classes.groupBy("source").agg(F.sum("words").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    place = F.row_number().over(everything.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (place % len(weights) + 1).cast("int"))
    sources = sources.withColumn("w", weight).withColumn("cap", F.col("source_size") * float(most)).withColumn("total", F.sum("source_size").over(everything) * share)
    sources = written(water_fill(sources, [], "w", "cap", "total", "target").select("source", "source_size", "target"), "sources")
    level = classes.where("bits > 0").join(sources, classes["source"].eqNullSafe(sources["source"])).select(sources["*"], "bits", "words", (F.col("words") * (F.col("bits") + F.lit(float(LENGTH_WEIGHT)))).alias("w"), (F.col("words") * float(most)).alias("cap"))
    level = water_fill(level, ["source"], "w", "cap", "target", "x").select("source", "bits", "source_size", "target", (F.col("x") / F.col("words")).alias("level"))
    level = written(level, "levels")
    drop_written(classes)
    return sources, level


def _decided(docs: DataFrame, row: Column, weights: list[float], share: float, most: int, seed: int) -> DataFrame:
    """row of each row of docs, with size, source_size, target and copies (0 to most)."""
    words = F.coalesce(F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")
    doc_id = F.col("doc_id").cast("string")
    tie = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id, F.lit("")), F.lit(":"), F.coalesce(F.md5(F.col("text").cast("string")), F.lit(""))))
    rows = docs.select(row, F.col("source").cast("string").alias("source"), F.col("doc_id").alias("id"), tie.alias("tie"), words.alias("size"))
    rows = rows.withColumn("bits", F.when(F.col("size") > 0, F.length(F.bin("size"))).otherwise(0))
    rows = written(rows.withColumn("rid", F.monotonically_increasing_id()), "rows")
    sources, levels = _plan(rows.select("source", "bits", "size"), weights, share, most)

    sid = F.sha2(F.coalesce(F.col("source"), F.lit("\0null")), 256)  # a key that null sources can be joined by
    narrow = join_small(rows.withColumn("sid", sid), levels.withColumn("sid", sid).drop("source"), ["sid", "bits"], "left")
    p = F.coalesce(F.col("level") - F.floor("level"), F.lit(0.0))
    u = (F.conv(F.substring("tie", 1, 13), 16, 10).cast("long") + F.lit(0.5)) / float(1 << 52)
    odds = (u / (1 - u)) / (F.col("p") / (1 - F.col("p")))
    key = F.when(F.col("p") > 0, F.floor(odds / (1 + odds) * float(1 << LEVELS * LEVEL_BITS)).cast("long"))
    ranked = narrow.withColumn("p", p).withColumn("key", key).withColumn("whole", F.coalesce(F.floor("level"), F.lit(0)).cast("long"))

    # Words still wanted from each source, and the bits found so far of the rank at which it is cut
    slim = written(ranked.select("sid", "rid", "id", "tie", "size", "whole", "key", "target"), "ranks")
    state = slim.groupBy("sid").agg((F.max("target") - F.sum(F.col("whole") * F.col("size"))).alias("left"))
    state = written(state.where("left is not null").withColumn("prefix", F.lit(0).cast("long")), "cut")
    for level in range(LEVELS):
        shift = LEVEL_BITS * (LEVELS - 1 - level)
        part = join_small(slim.where("key is not null"), state, ["sid"], "inner").where(F.shiftright("key", shift + LEVEL_BITS) == F.col("prefix"))
        sums = part.groupBy("sid", "left", F.shiftright("key", shift).alias("prefix")).agg(F.sum("size").alias("words"))
        before = F.sum("words").over(Window.partitionBy("sid").orderBy("prefix")) - F.col("words")
        sums = sums.withColumn("before", before).where((F.col("before") <= F.col("left")) | (F.col("before") == 0))
        found = sums.groupBy("sid").agg(F.max_by(F.struct((F.col("left") - F.col("before")).alias("left"), "prefix"), "prefix").alias("s"))
        old, state = state, written(found.select("sid", "s.left", "s.prefix"), "cut")
        drop_written(old)

    # Rows at the cut: how many of each (id, text), then how many of those in each partition of the input
    at = join_small(slim.where("key is not null"), state.withColumnRenamed("prefix", "key"), ["sid", "key"], "inner").select("sid", "rid", "id", "tie", "size", "left")
    at = at.withColumn("part", F.shiftright("rid", 33))
    parts = written(at.groupBy("sid", "tie", "part").agg(F.count("*").alias("n"), F.min("id").alias("id"), F.max("size").alias("size"), F.max("left").alias("left")), "edge-parts")
    same = parts.groupBy("sid", "tie").agg(F.sum("n").alias("n"), F.min("id").alias("id"), F.max("size").alias("size"), F.max("left").alias("left"))
    ahead = F.sum(F.col("n") * F.col("size")).over(Window.partitionBy("sid").orderBy(F.col("id").asc_nulls_last(), "tie")) - F.col("n") * F.col("size")
    fit = F.floor((F.col("left") - ahead - F.col("size") / 2) / F.col("size")) + 1  # rows r = 0, 1, ... with ahead + r * size + size / 2 <= left
    same = same.withColumn("fit", F.least(F.greatest(fit, F.lit(0)), F.col("n"))).where("fit > 0").select("sid", "tie", "fit")
    ahead = F.sum("n").over(Window.partitionBy("sid", "tie").orderBy("part")) - F.col("n")
    share_of = parts.join(same, ["sid", "tie"]).withColumn("take", F.least(F.col("fit") - ahead, F.col("n"))).where("take > 0").select("sid", "tie", "part", "take")
    turn = F.row_number().over(Window.partitionBy("sid", "tie", "part").orderBy("rid"))
    last = written(at.join(share_of, ["sid", "tie", "part"]).withColumn("turn", turn).where("turn <= take").select("rid", F.lit(1).alias("edge")), "edge")
    drop_written(slim, parts)

    cut = join_small(ranked, state.select("sid", F.col("prefix").alias("cut")), ["sid"], "left")
    taken = join_small(cut, last, ["rid"], "left").withColumn("copies", F.col("whole") + F.when((F.col("key") < F.col("cut")) | F.col("edge").isNotNull(), 1).otherwise(0))
    sizes = sources.withColumn("sid", sid).select("sid", F.col("source_size").alias("_size"), F.col("target").alias("_target"))
    out = join_small(taken.drop("source_size", "target"), sizes, ["sid"], "left")
    return out.select("row", "size", F.col("_size").alias("source_size"), F.col("_target").alias("target"), "copies")


def sampled(docs: DataFrame, weights: list[float], share: float, most: int = 2, seed: int = 0, keep: list[str] | None = None) -> DataFrame:
    """A row per row of docs: the columns `keep` (all, if None) with size, source_size, target and copies (0 to most)."""
    rows = _decided(docs, packed(*[named(c) for c in (docs.columns if keep is None else keep)]), weights, share, most, seed)
    return rows.select(*unpacked(rows, MADE), *MADE)


def mixed_rows(docs: DataFrame, weights: list[float], share: float, most: int = 2, seed: int = 0) -> DataFrame:
    """The mix itself: the columns of docs, each row as many times as it is taken."""
    rows = _decided(docs, packed(*[named(c) for c in docs.columns]), weights, share, most, seed).where("copies > 0")
    return rows.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))).alias("copy")).select(*unpacked(rows))
