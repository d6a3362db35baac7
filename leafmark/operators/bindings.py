"""Texts bound to cells, blocks matched by their texts, Markdown as plain text."""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from ..functions import headings

NUMBER = r"([0-9]+(?:[.,][0-9]+)*)"


def bound_tables(cells: DataFrame, blocks: DataFrame, table: str = "table_id") -> DataFrame:
    """(table_id, bound, loose): tables whose every block lies in exactly one cell with a text, whose cells say what their blocks say from top to bottom, and which keep all numbers.
    loose: blocks in no cell or in several. Tables without cells have no row; blocks of such tables are not looked at."""
    c, b = cells.alias("c"), blocks.alias("b")
    within = (F.col(f"b.{table}") == F.col(f"c.{table}")) & (F.length(F.coalesce("c.text", F.lit(""))) > 0)
    for low, high in (("x0", "x1"), ("y0", "y1")):
        within = within & (F.col(f"c.{low}") <= F.col(f"b.{low}")) & (F.col(f"b.{high}") <= F.col(f"c.{high}"))
    met = b.join(c, within, "left").groupBy(f"b.{table}", "b.id", "b.x0", "b.y0", "b.text").agg(F.count("c.cell").alias("n"), F.min("c.cell").alias("cell"))
    said = met.where("n = 1").groupBy(table, "cell").agg(F.array_sort(F.collect_list(F.struct("y0", "x0", "id", headings.bare(F.col("text")).alias("t")))).alias("parts"))
    said = said.select(table, "cell", F.trim(F.array_join(F.transform("parts", lambda p: p["t"]), " ")).alias("said"))
    numbers = lambda rows, name: rows.select(table, F.explode(F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(NUMBER), 1)).alias("v")).groupBy(table, "v").agg(F.count("*").alias(name))
    lost = numbers(cells, "a").join(numbers(blocks, "b"), [table, "v"], "full").where("not (a <=> b)").select(table).distinct().withColumn("lost", F.lit(True))
    same = cells.join(said, [table, "cell"], "left").groupBy(table).agg(F.every(F.coalesce("text", F.lit("")) == F.coalesce("said", F.lit(""))).alias("same"))
    loose = met.groupBy(table).agg(F.count_if(F.col("n") != 1).alias("loose"))
    joined = same.join(loose, table, "left").join(lost, table, "left").fillna(0, ["loose"])
    return joined.select(table, (F.col("same") & (F.col("loose") == 0) & F.isnull("lost")).alias("bound"), "loose")


def matched_texts(reference: DataFrame, prediction: DataFrame, group: str = "page") -> DataFrame:
    """(page, reference_id, predicted_id): reference blocks (page, id, text) of five characters or more, in order, each with the first free block of the same text, else with the one
    that holds it or that it holds at half the length or more, the closest in length first."""

    @F.pandas_udf("array<struct<reference_id:bigint,predicted_id:bigint>>")
    def matched(lefts: pd.Series, rights: pd.Series) -> pd.Series:
        def one(have, guess):
            free, out = {g["id"]: g["t"] for g in guess} if guess is not None else {}, []
            for r in have:
                t = r["t"]
                close = [(1.0 if t == p else min(len(t), len(p)) / max(len(t), len(p), 1), t == p, -k, i) for k, (i, p) in enumerate(free.items()) if t in p or p in t]
                best = max((c for c in close if c[0] >= 0.5), key=lambda c: (c[1], c[0], c[2]), default=None)
                if best:
                    del free[best[3]]
                    out.append((r["id"], best[3]))
            return out

        return pd.Series([one(a, b) for a, b in zip(lefts, rights)])

    text = F.trim(F.regexp_replace(F.coalesce("text", F.lit("")), r"[ \t\n\r]+", " "))
    listed = lambda rows, name: rows.select(group, "id", text.alias("t")).groupBy(group).agg(F.array_sort(F.collect_list(F.struct("id", "t"))).alias(name))
    have = listed(reference.where(F.length(text) >= 5), "a")
    return have.join(listed(prediction, "b"), group, "left").select(group, F.inline(matched("a", "b")))


_MARKS = [(re.compile(p, re.I), r) for p, r in (
    (r"!?\[([^\]\n]*)\]\((?:[^()\n]|\([^()\n]*\))*\)", r"\1"), (r"(?<!\\)(`+)(.+?)\1", r"\2"), (r"(?<![\w\\])([*_]{2})(?=\S)(.+?)(?<=\S)\1(?!\w)", r"\2"), (r"(?<![\w\\])([*_])(?=\S)(.+?)(?<=\S)\1(?!\w)", r"\2"),
    (r"<br\s*/?>", "\n"), (r"</?(?:table|thead|tbody|tfoot|tr|td|th|caption)\b[^>]*>", ""), (r"\\([\\`*{}\[\]()#+\-.!_>|])", r"\1"))]


def plain(markdown: str | None) -> str | None:
    """Markdown as plain text: fences, rules, comments and marks gone, cells between tabs, code and formulas as they are, at most one empty line in a row."""
    if markdown is None:
        return None

    def inline(text: str) -> str:
        for pattern, by in _MARKS:
            text = pattern.sub(by, text)
        return html.unescape(text)

    out, until = [], None  # until: what ends the block of literal lines we are in
    for line in markdown.splitlines():
        bare = line.strip()
        fence = re.match(r"\s*(`{3,}|~{3,})(.*)$", line)
        if until is not None:
            closes = bare == until if until in ("$$", r"\]") else fence and fence[1].startswith(until) and not fence[2].strip()
            if closes:
                until = None
            else:
                out.append(line)
        elif fence:
            until = fence[1]
        elif bare in ("$$", r"\["):
            until = "$$" if bare == "$$" else r"\]"
        elif re.fullmatch(r"-{3,}|_{3,}|(?:\*\s*){3,}|<!--.*?-->", bare):
            continue
        elif bare.startswith("|") and bare.endswith("|"):
            cells = re.split(r"(?<!\\)\|", bare)[1:-1]
            if not cells or not all(re.fullmatch(r"\s*:?-{3,}:?\s*", c) for c in cells):
                out.append("\t".join(inline(c.strip()) for c in cells))
        else:
            for lead in (r"^\s{0,3}#{1,6}\s+", r"^(?:\s{0,3}>\s?)+", r"^\s{0,3}[-+*]\s+"):
                line = re.sub(lead, "", line)
            out.append(inline(line))
    return re.sub(r"\n{3,}", "\n\n", "\n".join(out)).strip("\n") + "\n"


@F.pandas_udf(StringType())
def plain_text(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield batch.map(plain)


def merged_headings(lines: DataFrame, doc: str = "doc", order: str = "n") -> DataFrame:
    """(doc, n, lines, text) of headings broken over lines: a heading line without a number joins the one right before it (no line between) of the same style, adjacent and aligned,
    unless that one ends a sentence with a full stop."""
    w = Window.partitionBy(doc).orderBy(order)
    from ..functions.routing import numbering

    this = F.struct(order, "is_heading", "page", "bold", "x0", "y0", "x1", "y1", "size", "text")
    a, b = F.lag(this).over(w), this
    sizes = F.when(F.isnull(a["size"]) | F.isnull(b["size"]), F.isnull(a["size"]) & F.isnull(b["size"])).otherwise(F.abs(a["size"] - b["size"]) <= F.greatest(F.lit(0.5), F.greatest(a["size"], b["size"]) * 0.08))
    joins = a["is_heading"] & b["is_heading"] & numbering(headings.bare(b["text"])).isNull() & sizes & (a["bold"] == b["bold"]) & headings.adjacent(a, b) & headings.aligned(a, b) & ~headings.bare(a["text"]).endswith(".")
    marked = lines.withColumn("fresh", F.when(F.coalesce(joins, F.lit(False)), 0).otherwise(1)).withColumn("head", F.sum("fresh").over(w)).where("is_heading")
    found = marked.groupBy(doc, "head").agg(F.array_sort(F.collect_list(F.struct(order, headings.bare(F.col("text")).alias("t")))).alias("p"))
    return found.select(doc, F.col("p")[0][order].alias(order), F.size("p").alias("lines"), F.array_join(F.transform("p", lambda x: x["t"]), " ").alias("text"))
