"""Links and verdicts over written results: captions, contents entries, sections, keyword reports, attributed occurrences, completion marks."""

from __future__ import annotations

import difflib
import re

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import headings

# fixed values
CAPTION_START = r"(?iu)^(?:hình|bảng|ảnh|sơ đồ|biểu đồ|figure|table|fig\.)\s+\d+[:.\-]"
TABLE_CAPTION = r"(?iu)^\s*(?:bảng|table)(?:\s+\d+(?:\.\d+)*)?\s*[:：.\-–]\s*\S"
CHART_CAPTION = r"(?iu)^\s*(?:biểu đồ|chart)\s+\d+(?:\.\d+)*\s*[:：.\-–]\s*\S"
CONTENTS_RATIO = 0.88
CONTENTS_LINE = re.compile(r"(.{4,120}?)(?:\s*\.{2,}\s*|\s+)(\d{1,4})\s*")


def block_role(text: Column, top: Column, page: Column, height: Column) -> Column:
    """caption, formula, title, section_header, list or text, by form and place."""
    t = F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), r"\s+", " "))
    lines = F.size(F.split(F.regexp_replace(F.coalesce(text, F.lit("")), r"\n$", ""), "\n"))
    capitals = t.rlike(r"\p{Lu}") & ~t.rlike(r"\p{Ll}")
    role = F.when(t.rlike(CAPTION_START), "caption").when(t.rlike(r"(?:=|\+|-|\*|/|sum|int)\s*\(\d+\)$|^\$\$.*\$\$$"), "formula")
    role = role.when((page == 1) & (top < height * 0.35) & (F.length(t) < 120) & (lines <= 3) & (capitals | (headings.word_count(t) < 15)), "title")
    role = role.when(t.rlike(r"(?iu)^(?:\d+(?:\.\d+)*|[A-Z]\.|[IVXLCDM]+\.|chương|phần|mục)\s+\S") & (lines <= 2) & (F.length(t) < 150), "section_header")
    return role.when(F.coalesce(text, F.lit("")).rlike(r"^\s*(?:[-*•–+]|\(\d+\)|\d+\))\s+"), "list").otherwise("text")


def sections(lines: DataFrame, doc: str = "doc", order: str = "n") -> DataFrame:
    """(doc, n, level, parent, page_start, page_end) of the headings among lines (doc, n, page, level; level null on other lines). The parent is the last heading of a smaller
    level before; a section ends before the next heading of its level or a smaller one, on the page of the last line there."""
    w = Window.partitionBy(doc).orderBy(order)
    before, after = w.rowsBetween(Window.unboundedPreceding, -1), w.rowsBetween(1, Window.unboundedFollowing)
    levels = range(1, headings.DEEPEST_LEVEL + 1)
    place = F.struct(F.col(order).alias("n"), F.lag("page").over(w).alias("last"))
    parent = F.greatest(*(F.when(F.col("level") > k, F.max(F.when(F.col("level") == k, F.col(order))).over(before)) for k in levels), F.lit(None).cast("int"))
    end = F.array_min(F.array(*(F.when(F.col("level") >= k, F.min(F.when(F.col("level") == k, F.col("here"))).over(after)) for k in levels)))
    final = F.max(F.struct(order, "page")).over(Window.partitionBy(doc))["page"]
    found = lines.withColumn("here", place).withColumn("end", end).withColumn("parent", parent).withColumn("final", final)
    return found.where("level is not null").select(doc, order, "level", "parent", F.col("page").alias("page_start"), F.greatest("page", F.coalesce("end.last", "final")).alias("page_end"))


def line_agreement(lines: DataFrame, words: DataFrame, sample: int = 5, page: str = "page") -> DataFrame:
    """(page, id, ocr, layer, disagreement) of up to `sample` lines of each page, evenly spaced by id: edits between a line's text and that of the words (page, id, text) whose
    centre it holds, in their order, by the longer of both."""
    w = Window.partitionBy(page)
    ranked = lines.withColumn("k", F.row_number().over(w.orderBy("id")) - 1).withColumn("n", F.count("*").over(w))
    picks = F.transform(F.sequence(F.lit(0), F.lit(sample - 1)), lambda i: F.call_function("bround", i * (F.col("n") - 1) / (sample - 1)).cast("int"))
    chosen = ranked.where((F.col("n") <= sample) | F.array_contains(picks, F.col("k")))
    x, y = (F.col("w.x0") + F.col("w.x1")) / 2, (F.col("w.y0") + F.col("w.y1")) / 2
    inside = (F.col(f"l.{page}") == F.col(f"w.{page}")) & x.between(F.col("l.x0"), F.col("l.x1")) & y.between(F.col("l.y0"), F.col("l.y1"))
    met = chosen.alias("l").join(words.alias("w"), inside, "left").groupBy(f"l.{page}", "l.id", "l.text").agg(F.array_sort(F.collect_list(F.when(F.isnotnull("w.id"), F.struct(F.col("w.id").alias("i"), F.col("w.text").alias("t"))))).alias("m"))
    squeezed = lambda c: F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), r"\s+", " "))
    pairs = met.select(page, "id", squeezed(F.col("text")).alias("ocr"), squeezed(F.array_join(F.transform("m", lambda v: v["t"]), " ")).alias("layer"))
    return pairs.withColumn("disagreement", F.round(F.levenshtein("ocr", "layer") / F.greatest(F.length("ocr"), F.length("layer"), F.lit(1)), 4))


def table_captions(blocks: DataFrame, frames: DataFrame, gap: float, page: str = "page") -> DataFrame:
    """(page, frame, caption, position, gap) where one caption has one table within reach and no other caption claims it. A caption lies with half of its width over the table, at
    most `gap` points above or below it, in the same section, with nothing between them."""
    c = blocks.where(F.col("text").rlike(TABLE_CAPTION) | F.col("text").rlike(CHART_CAPTION)).alias("c")
    wide = F.least("c.x1", "f.x1") - F.greatest("c.x0", "f.x0")
    below = F.col("c.y0") >= F.col("f.y1")
    away = F.round(F.when(below, F.col("c.y0") - F.col("f.y1")).otherwise(F.col("f.y0") - F.col("c.y1")), 2)
    near = c.join(frames.alias("f"), (F.col(f"c.{page}") == F.col(f"f.{page}")) & (F.col("c.section") == F.col("f.section")) & (wide >= (F.col("c.x1") - F.col("c.x0")) * 0.5) & away.between(0, gap))
    near = near.select(F.col(f"c.{page}").alias(page), F.col("c.id").alias("caption"), F.col("f.id").alias("frame"), F.when(below, "below").otherwise("above").alias("position"), away.alias("gap"),
                       F.greatest("c.x0", "f.x0").alias("l"), F.least("c.x1", "f.x1").alias("r"), F.when(below, F.col("f.y1")).otherwise(F.col("c.y1")).alias("t"), F.when(below, F.col("c.y0")).otherwise(F.col("f.y0")).alias("b"))
    others = blocks.select(page, "id", "x0", "y0", "x1", "y1").unionByName(frames.select(page, "id", "x0", "y0", "x1", "y1")).alias("o")
    n = near.alias("n")
    between = (F.least("n.r", "o.x1") > F.greatest("n.l", "o.x0")) & (F.least("n.b", "o.y1") > F.greatest("n.t", "o.y0")) & ~F.col("o.id").isin(F.col("n.caption"), F.col("n.frame"))
    free = n.join(others, (F.col(f"n.{page}") == F.col(f"o.{page}")) & between, "left_anti")
    one = free.withColumn("tables", F.count("*").over(Window.partitionBy(page, "caption"))).where("tables = 1").withColumn("captions", F.count("*").over(Window.partitionBy(page, "frame"))).where("captions = 1")
    return one.select(page, "frame", "caption", "position", "gap")


def figure_captions(blocks: DataFrame, frames: DataFrame, gap: float, overlap: float, page: str = "page") -> DataFrame:
    """(page, frame, caption, position, gap) of figures: the nearest block that begins like a caption, within `gap` points and overlapping by `overlap` of the narrower width; text
    inside a figure is none. Figures choose by id, a caption taken is gone; of equal gaps the least id."""
    inside = lambda f: ((F.col("c.x0") + F.col("c.x1")) / 2).between(F.col(f"{f}.x0") - 2, F.col(f"{f}.x1") + 2) & ((F.col("c.y0") + F.col("c.y1")) / 2).between(F.col(f"{f}.y0") - 2, F.col(f"{f}.y1") + 2)
    same = lambda f: F.col(f"c.{page}") == F.col(f"{f}.{page}")
    c = blocks.where(F.col("text").rlike(CAPTION_START)).alias("c").join(frames.alias("g"), same("g") & inside("g"), "left_anti")
    shared, narrow = F.least("c.x1", "f.x1") - F.greatest("c.x0", "f.x0"), F.least(F.col("c.x1") - F.col("c.x0"), F.col("f.x1") - F.col("f.x0"))
    below = F.col("c.y0") >= F.col("f.y1")
    away = F.when(below, F.col("c.y0") - F.col("f.y1")).otherwise(F.col("f.y0") - F.col("c.y1"))
    near = c.join(frames.alias("f"), same("f") & (narrow > 0) & (shared / narrow >= overlap) & away.between(0, gap))

    @F.pandas_udf("array<struct<frame:bigint,caption:bigint,position:string,gap:double>>")
    def chosen(pages: pd.Series) -> pd.Series:
        def one(options):
            taken, held = set(), {}
            for o in options:
                if o["frame"] not in held and o["caption"] not in taken:
                    held[o["frame"]] = o
                    taken.add(o["caption"])
            return [(o["frame"], o["caption"], o["position"], round(o["gap"], 2)) for o in held.values()]

        return pages.map(one)

    listed = near.groupBy(F.col(f"c.{page}").alias(page)).agg(F.array_sort(F.collect_list(F.struct(F.col("f.id").alias("frame"), away.alias("gap"), F.col("c.id").alias("caption"), F.when(below, "below").otherwise("above").alias("position")))).alias("o"))
    return listed.select(page, F.inline(chosen("o")))


def contents_entries(lines: DataFrame, page: str = "page") -> DataFrame:
    """(page, id, number_id, title, printed) of contents lines (page, id, text and corners): a title with its number at the end, or with the nearest free number to its right on the row."""

    @F.pandas_udf("array<struct<id:bigint,number_id:bigint,title:string,printed:int>>")
    def found(pages: pd.Series) -> pd.Series:
        def one(rows):
            free = [r for r in rows if r["x0"] is not None and r["y1"] - r["y0"] <= 2 * max(1.0, r["x1"] - r["x0"]) and re.fullmatch(r"\d{1,3}", r["text"])]
            bare, out = {r["id"] for r in free}, []
            for r in rows:
                if r["id"] in bare:
                    continue
                letters = lambda t: sum(ch.isalpha() for ch in t)
                whole = CONTENTS_LINE.fullmatch(r["text"])
                if whole and letters(whole[1]) >= 3:
                    out.append((r["id"], None, whole[1], int(whole[2])))
                elif letters(r["text"]) >= 3 and r["x0"] is not None and len(r["text"]) <= 120 and r["y1"] - r["y0"] <= 2 * max(1.0, r["x1"] - r["x0"]):
                    row = [n for n in free if n["x0"] >= r["x1"] - 1 and abs(n["y0"] + n["y1"] - r["y0"] - r["y1"]) / 2 <= 0.6 * min(r["y1"] - r["y0"], 2 * (n["y1"] - n["y0"]))]
                    if row:
                        near = min(row, key=lambda n: n["x0"])
                        free.remove(near)
                        out.append((r["id"], near["id"], r["text"], int(near["text"])))
            return out

        return pages.map(one)

    row = F.struct("id", headings.bare(F.col("text")).alias("text"), "x0", "y0", "x1", "y1")
    return lines.groupBy(page).agg(F.array_sort(F.collect_list(row)).alias("r")).select(page, F.inline(found("r"))).withColumn("title", headings.title_key(F.col("title")))


def contents_matches(found: DataFrame, entries: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, n, ratio, printed, page_offset): headings (doc, n, page, title key) that a contents entry (title key, printed) of the document matches at 0.88 or more, the best first in the
    order of entries (k). page_offset: the most frequent difference of pages, if at least three headings match and 60 % of them say it (of equally frequent ones the first)."""

    @F.pandas_udf("array<struct<n:bigint,ratio:double,printed:int,page_offset:int>>")
    def matched(heads: pd.Series, lists: pd.Series) -> pd.Series:
        def one(rows, listed):
            out, matcher = [], difflib.SequenceMatcher()
            for h in rows:
                matcher.set_seq2(h["title"])
                best, printed = 0.0, None
                for e in listed if h["title"] else ():
                    matcher.set_seq1(e["title"])
                    if e["title"] and matcher.real_quick_ratio() >= CONTENTS_RATIO > 0 and matcher.quick_ratio() >= CONTENTS_RATIO:
                        ratio = difflib.SequenceMatcher(None, h["title"], e["title"]).ratio()
                        if ratio > best:
                            best, printed = ratio, e["printed"]
                if best >= CONTENTS_RATIO:
                    out.append((h["n"], best, printed, h["page"] - printed))
            steps = [o[3] for o in out]
            common = max(dict.fromkeys(steps), key=steps.count) if len(steps) >= 3 else None
            common = common if common is not None and steps.count(common) >= 0.6 * len(steps) else None
            return [(*o[:3], common) for o in out]

        return pd.Series([one(a, b) for a, b in zip(heads, lists)])

    heads = found.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("n", "page", "title"))).alias("h"))
    lists = entries.groupBy(doc).agg(F.array_sort(F.collect_list(F.struct("k", "title", "printed"))).alias("e"))
    return heads.join(lists, doc).select(doc, F.inline(matched("h", "e")))


def keyword_acceptance(spans: DataFrame, attributions: DataFrame, units: DataFrame, references: DataFrame, doc: str = "doc") -> DataFrame:
    """(doc, keyword, outcome, n): occurrences (doc, keyword, start) by what review says of them. Without attribution: unattributed; without a unit: outside_scope; in a unit nobody
    annotated: unscored; the first linked to a reference of its unit and keyword: correct; the rest: extra. References (doc, ref, unit, keyword) that none has: missing."""
    span = [doc, "keyword", "start"]
    linked = spans.join(attributions.withColumn("named", F.lit(True)), span, "left").join(units, [doc, "unit"], "left")
    refs = references.select(doc, "ref", F.col("unit").alias("ref_unit"), F.col("keyword").alias("ref_keyword"))
    linked = linked.join(refs, [doc, "ref"], "left")
    scored = F.isnotnull("unit") & F.col("annotated")
    right = F.coalesce(scored & (F.col("ref_unit") == F.col("unit")) & (F.col("ref_keyword") == F.col("keyword")), F.lit(False))
    first = F.row_number().over(Window.partitionBy(doc, "ref", "right").orderBy("start", "keyword")) == 1
    outcome = F.when(F.isnull("named"), "unattributed").when(F.isnull("unit"), "outside_scope").when(~F.coalesce("annotated", F.lit(False)), "unscored").when(F.col("right") & F.col("first"), "correct").otherwise("extra")
    judged = linked.withColumn("right", right).withColumn("first", first).withColumn("outcome", outcome)
    missing = references.join(units.where("annotated"), [doc, "unit"], "left_semi").join(judged.where("outcome = 'correct'").select(doc, "ref"), [doc, "ref"], "left_anti").select(doc, "keyword", F.lit("missing").alias("outcome"))
    return judged.select(doc, "keyword", "outcome").unionByName(missing).groupBy(doc, "keyword", "outcome").agg(F.count("*").alias("n"))


def report_faults(reports: DataFrame, counted: DataFrame, dictionary: list[str], doc: str = "doc_id") -> DataFrame:
    """(doc, keyword, fault) of keyword reports (doc, keyword, n, total): missing_keyword, extra_keyword, negative_count, count_differs (from counted: doc, keyword, n) and
    total_differs (keyword null)."""
    sums = reports.groupBy(doc).agg(F.collect_set("keyword").alias("has"), (~F.min("total").eqNullSafe(F.sum("n")) | ~F.min("total").eqNullSafe(F.max("total"))).alias("off"))
    entry = lambda keyword, fault: F.struct(keyword.alias("keyword"), F.lit(fault).alias("fault"))
    gone = F.transform(F.array_except(F.array(*map(F.lit, dictionary)), "has"), lambda k: entry(k, "missing_keyword"))
    whole = sums.select(doc, F.inline(F.concat(gone, F.when(F.col("off"), F.array(entry(F.lit(None).cast("string"), "total_differs"))).otherwise(F.array()))))
    both = reports.select(doc, "keyword", F.col("n").alias("said")).join(counted.select(doc, "keyword", "n"), [doc, "keyword"], "left")
    fault = F.when(~F.coalesce(F.col("keyword").isin(dictionary), F.lit(False)), "extra_keyword").when(F.coalesce(F.col("said") < 0, F.lit(True)), "negative_count").when(F.col("said") != F.coalesce("n", F.lit(0)), "count_differs")
    return both.withColumn("fault", fault).where("fault is not null").select(doc, "keyword", "fault").unionByName(whole)


def completion_faults(marks: DataFrame, files: DataFrame) -> DataFrame:
    """(path, fault) of files (path, sha256) against the marks of a finished run: absent, unlisted, changed or unsafe (a path that leaves its folder)."""
    listed = marks.select("path", F.col("sha256").alias("want"), F.lit(True).alias("marked"))
    there = files.select("path", F.col("sha256").alias("have"), F.lit(True).alias("there"))
    fault = F.when(F.col("path").rlike(r"^/|(?:^|/)\.\.(?:/|$)"), "unsafe").when(F.isnull("there"), "absent").when(F.isnull("marked"), "unlisted").when(~F.col("want").eqNullSafe(F.col("have")), "changed")
    return listed.join(there, "path", "full").select("path", fault.alias("fault")).where("fault is not null")
