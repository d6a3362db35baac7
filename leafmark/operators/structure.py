"""Lines to paragraphs and headings, words to cells, captions to tables, ranked boxes to average precision.

Joins are on the document or page with geometry as a residual; folds run over one document's headings or totals, gathered in an array.
"""

from __future__ import annotations

from bisect import bisect_right

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import geometry, headings
from .layout import iou_matrix

LINE = ("page", "place", "kind", "x0", "y0", "x1", "y1", "size", "text")


def paragraphs(lines: DataFrame, doc: str = "doc", order: str = "n") -> DataFrame:
    """lines (doc, n and LINE) with the number of their paragraph, from 1, in the order of the document."""
    w = Window.partitionBy(doc).orderBy(order)
    this = F.struct(*LINE)
    breaks = F.when(F.row_number().over(w) == 1, 1).otherwise(headings.starts_paragraph(F.lag(this).over(w), this).cast("int"))
    return lines.withColumn("breaks", breaks).withColumn("paragraph", F.sum("breaks").over(w)).drop("breaks")


def heading_levels(found: DataFrame, doc: str = "doc", order: str = "n") -> DataFrame:
    """(doc, n, level) of headings (doc, n, ratio to the body's size, kind and path of their number, rank of their part word). A part word's level is its rank
    among those of the document; of other numbers the first sets the level of its kind, depth adds to it; the rest goes by size. No heading is more than one level
    below the one before."""

    def one(items) -> list[int]:
        parts = sorted({h["rank"] for h in items if h["kind"] == "keyword"})
        first, out, above = {}, [], 0
        for h in items:
            kind, path, ratio = h["kind"], h["path"], h["ratio"]
            if ratio is None or ratio != ratio:
                level = 1 if kind in ("keyword", "roman") else 2
            else:
                level = next((i for i, low in enumerate(headings.LEVEL_RATIOS, 1) if ratio >= low), headings.DEEPEST_LEVEL)
            if kind == "keyword":
                level, first = parts.index(h["rank"]) + 1, {}
            elif kind:
                depth = len(path)
                if kind in first:
                    level = first[kind][1] + depth - first[kind][0]
                else:
                    level = max(level, depth) if kind == "arabic" else level
                    first[kind] = depth, min(level, headings.DEEPEST_LEVEL, above + 1)
            above = max(1, min(level, headings.DEEPEST_LEVEL, above + 1))
            out.append(above)
        return out

    @F.pandas_udf("array<int>")
    def levels(docs: pd.Series) -> pd.Series:
        return docs.map(one)

    listed = found.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct(order, "ratio", "kind", "path", "rank"))).alias("h"))
    paired = listed.select(doc, F.explode(F.arrays_zip(F.col(f"h.{order}").alias(order), levels("h").alias("level"))).alias("x"))
    return paired.select(doc, f"x.{order}", "x.level")


def translations(lines: DataFrame, body: Column, doc: str = "doc", order: str = "n") -> DataFrame:
    """(doc, n, translated_by, text): headings (is_heading) with the English line right below them, in a smaller size or one that is not known."""
    w = Window.partitionBy(doc).orderBy(order)
    this = F.struct(order, "is_heading", "page", "kind", "bold", "x0", "y0", "x1", "y1", "size", "text", body.alias("body"))
    a, b = F.col("a"), F.col("b")
    smaller = F.coalesce(b["size"] <= a["size"] * 0.95, F.lit(True))
    fits = a["is_heading"] & ~headings.is_english(a["text"]) & ~b["is_heading"] & headings.is_translation(b, b["body"]) & smaller & headings.adjacent(a, b) & headings.aligned(a, b)
    return lines.select(doc, this.alias("a"), F.lead(this).over(w).alias("b")).where(fits).select(doc, f"a.{order}", F.col(f"b.{order}").alias("translated_by"), F.col("b.text").alias("text"))


def table_preference(tables: DataFrame, models: DataFrame, page: str = "page") -> DataFrame:
    """tables (page, id, engine and corners) with `superseded`: at least half of it lies in tables found by a model, or it is a guess that holds 0.8 of one of these."""
    box = lambda t: F.struct(*(F.col(f"{t}.{c}") for c in ("x0", "y0", "x1", "y1")))
    t, m = box("t"), box("m")
    shared = geometry.intersection(t, m)
    holds = (F.col("t.engine") == "heuristic") & (geometry.area(m) > 0) & (shared / geometry.area(m) >= 0.8)
    near = tables.alias("t").join(models.alias("m"), (F.col(f"t.{page}") == F.col(f"m.{page}")) & (shared > 0))
    hit = near.where((geometry.area(t) > 0) & (shared / geometry.area(t) >= 0.5) | holds).select(F.col(f"t.{page}").alias(page), F.col("t.id").alias("id")).distinct()
    return tables.join(hit.withColumn("superseded", F.lit(True)), [page, "id"], "left").fillna(False, ["superseded"])


def cell_words(words: DataFrame, cells: DataFrame, frames: DataFrame, page: str = "page", margin: float = 2.0) -> DataFrame:
    """(page, id, place, cell, near_edge) of words: in_one_cell, in_several_cells, in_table_no_cell or outside_tables by their centre; the cell where it is the only one."""
    x, y = (F.col("w.x0") + F.col("w.x1")) / 2, (F.col("w.y0") + F.col("w.y1")) / 2
    inside = lambda t: (F.col(f"w.{page}") == F.col(f"{t}.{page}")) & x.between(F.col(f"{t}.x0"), F.col(f"{t}.x1")) & y.between(F.col(f"{t}.y0"), F.col(f"{t}.y1"))
    edge = F.least(x - F.col("c.x0"), F.col("c.x1") - x, y - F.col("c.y0"), F.col("c.y1") - y) < margin
    in_cells = words.alias("w").join(cells.alias("c"), inside("c")).groupBy(f"w.{page}", "w.id").agg(F.count("*").alias("cells"), F.min("c.cell").alias("cell"), F.bool_or(edge).alias("near"))
    framed = words.alias("w").join(frames.alias("f"), inside("f"), "left_semi").select(page, "id").withColumn("framed", F.lit(True))
    all_ = words.select(page, "id").join(framed, [page, "id"], "left").join(in_cells, [page, "id"], "left")
    place = F.when(F.isnull("framed"), "outside_tables").when(F.col("cells") == 1, "in_one_cell").when(F.col("cells") > 1, "in_several_cells").otherwise("in_table_no_cell")
    return all_.select(page, "id", place.alias("place"), F.when(place == "in_one_cell", F.col("cell")).alias("cell"), F.coalesce(F.col("near") & F.col("framed"), F.lit(False)).alias("near_edge"))


def header_cells(blocks: DataFrame, columns: DataFrame, table: str = "table_id") -> DataFrame:
    """blocks (table_id, id, x0, x1) with the first column they overlap and how many they span; one between columns goes to the column that begins nearest (of equals the first)."""
    b0, b1, c0, c1 = F.col("b.x0"), F.col("b.x1"), F.col("c.x0"), F.col("c.x1")
    over = (F.greatest(b0, c0) <= F.least(b1, c1)) | ((b0 + b1) / 2).between(c0, c1)
    met = blocks.alias("b").join(columns.alias("c"), F.col(f"b.{table}") == F.col(f"c.{table}"))
    found = met.groupBy(f"b.{table}", "b.id").agg(F.min(F.when(over, F.col("c.col"))).alias("lo"), F.max(F.when(over, F.col("c.col"))).alias("hi"), F.min(F.struct(F.abs(c0 - b0), "c.col"))["col"].alias("nearest"))
    return found.select(table, "id", F.coalesce("lo", "nearest").alias("col"), (F.coalesce(F.col("hi") - F.col("lo"), F.lit(0)) + 1).alias("col_span"))


def wrapped_rows(cells: DataFrame, table: str = "table_id") -> DataFrame:
    """cells (table_id, row, col, text) where a long label without numbers joins the row of numbers right below it; rows are numbered anew from 0 where a row has gone."""
    by_row = cells.groupBy(table, "row").agg(
        F.max(F.when(F.col("col") == 0, F.coalesce("text", F.lit("")))).alias("label"), F.count_if((F.col("col") > 0) & F.col("text").rlike(r"\d{3,}")).alias("numbers"),
        F.array_join(F.filter(F.transform(F.array_sort(F.collect_list(F.struct("col", "text"))), lambda c: headings.bare(c["text"])), lambda t: t != ""), " ").alias("said"))
    w = Window.partitionBy(table).orderBy("row")
    after = lambda c: F.lead(c).over(w)
    joins = (after("row") == F.col("row") + 1) & (F.length("label") >= 20) & (F.col("numbers") == 0) & (after("numbers") >= 2) & (F.length(after("label")) <= 45)
    rows = by_row.withColumn("gone", F.coalesce(joins, F.lit(False)))
    rows = rows.select(table, "row", "gone", F.when(F.lag("gone").over(w), F.lag("said").over(w)).alias("over"), F.sum(F.when(F.col("gone"), 0).otherwise(1)).over(w).alias("k"), F.bool_or("gone").over(Window.partitionBy(table)).alias("any"))
    text = F.when((F.col("col") == 0) & F.isnotnull("over"), F.trim(F.concat_ws(" ", "over", headings.bare(F.col("text"))))).otherwise(F.col("text"))
    return cells.join(rows.where("not gone"), [table, "row"]).select(table, F.when(F.col("any"), F.col("k") - 1).otherwise(F.col("row")).cast("int").alias("row"), "col", text.alias("text"))


def gutters(blocks: DataFrame, width: int, page: str = "page", least: float = 8.0) -> DataFrame:
    """(page, start, end) of white columns at least `least` points wide that no block of the page touches, inside margins of 12 %; a sweep over the blocks' left edges."""
    margin, bins = int(width * 0.12), width + 1
    spans = blocks.where("x0 is not null and x1 is not null").select(page, F.greatest(F.lit(0), F.col("x0").cast("int")).alias("lo"), F.least(F.lit(width), F.col("x1").cast("int")).alias("hi"))
    ends = spans.select(page).distinct().select(page, F.lit(bins).alias("lo"), F.lit(bins).alias("hi"))
    w = Window.partitionBy(page).orderBy("lo", "hi")
    reach = F.coalesce(F.max("hi").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(-1))
    gaps = spans.unionByName(ends).select(page, F.greatest(reach + 1, F.lit(margin)).alias("start"), F.least("lo", F.lit(bins - margin)).alias("end"))
    return gaps.where(F.col("end") - F.col("start") >= least)


def balance_pairs(totals: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, assets, equity) of totals (doc, id, page, side; ids in the order of the document, pages never falling): each equity total with the nearest assets total before it
    that is still free, on its page or the page before. The rest stands alone, with null for the other side."""

    def one(items) -> list[tuple]:
        free, out = [], []
        for t in items:
            if t["side"] == "assets":
                free.append(t)
            elif free and t["page"] - free[-1]["page"] <= 1:
                out.append((free.pop()["id"], t["id"]))
            else:
                out.append((None, t["id"]))
        return out + [(t["id"], None) for t in free]

    @F.pandas_udf("array<struct<assets:bigint,equity:bigint>>")
    def paired(docs: pd.Series) -> pd.Series:
        return docs.map(one)

    listed = totals.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("id", "page", "side"))).alias("t"))
    return listed.select(doc, F.inline(paired("t")))


#: Pairs of boxes up to which few_ious() is taken
SMALL = 64


def few_ious(a: list[list[float]], b: list[list[float]]) -> list[list[float]]:
    """iou_matrix() of a few boxes, where arrays cost more than they save."""
    out = []
    for ax0, ay0, ax1, ay1 in a:
        row, area = [], (ax1 - ax0) * (ay1 - ay0)
        for bx0, by0, bx1, by1 in b:
            wide, tall = (ax1 if ax1 < bx1 else bx1) - (ax0 if ax0 > bx0 else bx0), (ay1 if ay1 < by1 else by1) - (ay0 if ay0 > by0 else by0)
            both = wide * tall if wide > 0 and tall > 0 else 0.0
            union = area + (bx1 - bx0) * (by1 - by0) - both
            row.append(both / union if union > 0 else 0.0)
        out.append(row)
    return out


THRESHOLDS = [round(0.5 + 0.05 * i, 2) for i in range(10)]


def average_precision(reference: DataFrame, prediction: DataFrame, page: str = "page") -> DataFrame:
    """(kind, ap_50, ap_50_95, total_gt, total_preds) of boxes (page, id, kind, corners), predictions with a score: precision at 101 recalls, for overlaps of 0.5 to 0.95.

    On a page predictions take, by falling score (then id), the free reference box of greatest overlap. Null without reference boxes, 0 without predictions. Counts run over
    slices of scores first, so no class is gathered in a task: a slice's rows start from the sums of those before it.
    """
    def one(flat, truth) -> list[int]:
        """For each prediction a number whose bit i says that it is right at threshold i."""
        flat, truth = np.asarray(flat, float), np.asarray(truth if truth is not None else (), float)
        marks = [0] * (len(flat) // 4)
        if not len(truth):
            return marks
        if len(flat) * len(truth) <= 16 * SMALL:
            overlap = few_ious(*([v[k : k + 4] for k in range(0, len(v), 4)] for v in (flat.tolist(), truth.tolist())))
        else:
            overlap = iou_matrix(flat.reshape(-1, 4), truth.reshape(-1, 4)).tolist()
        near = [(i, j, v) for i, row in enumerate(overlap) for j, v in enumerate(row) if v >= THRESHOLDS[0]]
        if len({i for i, _, _ in near}) == len(near) == len({j for _, j, _ in near}):  # no box has a choice: the greedy pass takes each pair up to its overlap
            for i, _, v in near:
                marks[i] = (1 << bisect_right(THRESHOLDS, v)) - 1
            return marks
        most = max(max(o) for o in overlap)
        for bit, least in enumerate(THRESHOLDS):
            free = set(range(len(truth) // 4)) if least <= most else set()
            for i, row in enumerate(overlap if free else ()):
                best = max(free, key=lambda j: (row[j], -j), default=None)
                if best is not None and row[best] >= least:
                    free.remove(best)
                    marks[i] |= 1 << bit
        return marks

    @F.pandas_udf("array<int>")
    def right(flat: pd.Series, truth: pd.Series) -> pd.Series:
        return pd.Series([one(f, t) for f, t in zip(flat, truth)])

    box = F.array(*(F.col(c).cast("double") for c in ("x0", "y0", "x1", "y1")))
    listed = prediction.groupBy(page, "kind").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "id", box.alias("box")))).alias("p"))
    truth = reference.groupBy(page, "kind").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("id", box.alias("box")))), lambda x: x["box"])).alias("truth"))
    judged = listed.join(truth, [page, "kind"], "left").select(page, "kind", F.explode(F.arrays_zip(F.col("p.s").alias("s"), F.col("p.id").alias("id"), right(F.flatten("p.box"), "truth").alias("m"))).alias("x"))
    bits = [f"b{i}" for i in range(len(THRESHOLDS))]
    flags = judged.select("kind", page, "x.id", "x.s", "x.m", F.floor(F.col("x.s") * 1024).alias("slice"), *(F.shiftright("x.m", i).bitwiseAND(F.lit(1)).alias(b) for i, b in enumerate(bits)))
    sums = flags.groupBy("kind", "slice").agg(*(F.sum(b).alias(b) for b in bits), F.count("*").alias("n"))
    w = Window.partitionBy("kind").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("kind", "slice", *(F.coalesce(F.sum(c).over(w), F.lit(0)).alias(f"{c}_0") for c in [*bits, "n"]))
    inner = Window.partitionBy("kind", "slice").orderBy("s", page, "id").rowsBetween(Window.unboundedPreceding, 0)
    totals = reference.groupBy("kind").agg(F.count("*").alias("total_gt"))
    counted = prediction.groupBy("kind").agg(F.count("*").alias("total_preds"))
    # precision falls between hits, so only rows that are right somewhere are looked at
    run = flags.select("kind", "slice", "m", F.count("*").over(inner).alias("n"), *(F.sum(b).over(inner).alias(b) for b in bits)).where("m <> 0").join(sums, ["kind", "slice"]).join(totals, "kind")
    hits = F.array(*(F.struct(F.lit(i).alias("t"), F.shiftright("m", i).bitwiseAND(F.lit(1)).alias("hit"), (F.col(b) + F.col(f"{b}_0")).alias("hits")) for i, b in enumerate(bits)))
    run = run.select("kind", "total_gt", (F.col("n") + F.col("n_0")).alias("seen"), F.inline(F.filter(hits, lambda x: x["hit"] == 1)))
    recall = F.col("hits") / F.col("total_gt")
    near = F.floor(F.col("hits") * 100 / F.col("total_gt"))
    step = F.when(recall >= (near + 1) * 0.01, near + 1).when(recall < near * 0.01, near - 1).otherwise(near)
    best = run.groupBy("kind", "t", F.least(step, F.lit(100)).alias("step")).agg(F.max(F.col("hits") / F.col("seen")).alias("precision"))
    curve = best.groupBy("kind", "t").agg(F.collect_list(F.struct("step", "precision")).alias("c"))
    at = F.transform(F.sequence(F.lit(0), F.lit(100)), lambda r: F.coalesce(F.array_max(F.transform(F.filter("c", lambda x: x["step"] >= r), lambda x: x["precision"])), F.lit(0.0)))
    ap = curve.select("kind", "t", (F.aggregate(at, F.lit(0.0), lambda a, v: a + v) / 101).alias("ap")).groupBy("kind").agg(F.max(F.when(F.col("t") == 0, F.col("ap"))).alias("a50"), (F.sum("ap") / len(THRESHOLDS)).alias("a95"))
    known = totals.join(counted, "kind", "full").join(ap, "kind", "left")
    value = lambda c: F.when(F.col("total_gt") > 0, F.round(F.coalesce(c, F.lit(0.0)), 4))
    return known.select("kind", value("a50").alias("ap_50"), value("a95").alias("ap_50_95"), F.coalesce("total_gt", F.lit(0)).alias("total_gt"), F.coalesce("total_preds", F.lit(0)).alias("total_preds"))
