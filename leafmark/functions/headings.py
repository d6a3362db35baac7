"""What the lines of a page may be: bullets, headings, translations of headings, first lines of paragraphs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .routing import PARTS, numbering

# fixed values
BULLETS = "-+*•–●▪"
SENTENCE_ENDS = ".:;?!"
VIETNAMESE_LETTERS = "ăâđêôơưáàảãạắằẳẵặấầẩẫậéèẻẽẹếềểễệíìỉĩịóòỏõọốồổỗộớờởỡợúùủũụứừửữựýỳỷỹỵ"
JOBS = "chủ tịch|phó chủ tịch|tổng giám đốc|phó tổng giám đốc|giám đốc|kế toán trưởng|thành viên|trưởng ban|người đại diện|thư ký"
AMOUNT_UNITS = "đồng|vnd|vnđ|usd|triệu|tỷ|tỉ|nghìn|ngàn|lần|%"
LEVEL_RATIOS = (2.6, 1.6, 1.25)
DEEPEST_LEVEL = 4


def bare(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"^\s+|\s+$", "")


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"\S+"))


def ends_sentence(text: Column) -> Column:
    return bare(text).rlike(rf"[{SENTENCE_ENDS}]$")


def starts_lower(text: Column) -> Column:
    """Whether the first letter is a small one; false without a letter."""
    return F.coalesce(text, F.lit("")).rlike(r"^\P{L}*\p{Ll}")


def is_bullet(text: Column) -> Column:
    """A list mark alone or before a blank; a sign or dash before a digit is a number's."""
    return bare(text).rlike(rf"^(?:[{BULLETS}]$|[{BULLETS}]\s+(?!\d)|[*•●▪]\s+)")


def title_key(text: Column) -> Column:
    """A title without its number, leaders and punctuation, in small letters. Numbers go in the order part word, roman, decimal, capital, each at most once."""
    t = F.regexp_replace(bare(text), r"\.{2,}\s*\d*\s*$", "")
    for number in (rf"(?iu)^(?:{PARTS})\s+(?:[IVXLC]+|\d+|[A-Z])(?![\p{{L}}\p{{N}}_])", r"^[IVXLC]+\s*[.)\-–:]\s+(?=\S)", r"^\d{1,2}(?:\.\d{1,2}){0,3}\s*[.)\-–:]?\s+(?=[^\d\s])", r"^[A-ZĐ]\s*[.)]\s+(?=\S)"):
        t = F.regexp_replace(t, number, "")
    return F.trim(F.regexp_replace(F.lower(F.regexp_replace(t, r"[^\p{L}\p{N}\p{M}_\s]", " ")), r"\s+", " "))


def heading_rejection(text: Column, before: list[Column], placed: Column, unresolved: Column) -> Column:
    """Why a line cannot be a heading, null where nothing speaks against it. `before`: the texts of up to two lines before it."""
    t = bare(text)
    numbered, words = numbering(t).isNotNull(), word_count(t)
    digits, letters = F.regexp_count(t, F.lit(r"\p{Nd}")), F.regexp_count(t, F.lit(r"\p{L}"))
    sign = r"[\d\s.,%()/:\-–+]*"
    signed = F.lit(False)
    for b in before:
        signed = signed | bare(b).rlike(rf"(?iu)^(?:{JOBS})(?![\p{{L}}\p{{N}}_])")
    reasons = [
        ("unplaced", ~F.coalesce(placed, F.lit(False))),
        ("unresolved_table_source", F.coalesce(unresolved, F.lit(False))),
        ("bullet", is_bullet(t)),
        ("page_number_like", t.rlike(r"(?iu)^(?:trang\s+)?\d{1,4}(?:\s*/\s*\d{1,4})?$")),
        ("amount_or_number", F.when(numbered, title_key(t)).otherwise(t).rlike(rf"(?iu)^{sign}(?:{AMOUNT_UNITS})?{sign}$")),
        ("mostly_digits", digits > F.greatest(letters, F.lit(1)) * 0.5),
        ("date", t.rlike(r"(?iu)(?<![\p{L}\p{N}_])\d{1,2}[/\-.]\d{1,2}[/\-.]\d{2,4}(?![\p{L}\p{N}_])|ngày\s+\d+\s+tháng\s+\d+") & (words <= 6)),
        ("too_short", (letters < 3) & ~numbered),
        ("sentence_like", (words > 25) | t.endswith(",")),
        ("toc_line", t.rlike(r"\.{3,}\s*\d+$")),
        ("label", t.endswith(":") & (words <= 3)),
        ("person_name", signed & ~numbered & t.rlike(r"^\p{Lu}\S*(?:\s+\p{Lu}\S*){1,4}$") & (digits == 0)),
        ("person_name", t.rlike(r"(?iu)^(?:ông|bà)\s") & (words <= 6)),
    ]
    found = None
    for name, holds in reasons:
        found = F.when(holds, name) if found is None else found.when(holds, name)
    return found


def is_english(text: Column) -> Column:
    """At least four letters, all of them ASCII."""
    t = F.coalesce(text, F.lit(""))
    return (F.regexp_count(t, F.lit(r"\p{L}")) >= 4) & ~t.rlike(r"[\p{L}&&[^A-Za-z]]")


def upper_share(text: Column) -> Column:
    letters = F.regexp_count(text, F.lit(r"\p{L}"))
    return F.coalesce(F.regexp_count(text, F.lit(r"\p{Lu}")) / F.nullif(letters, F.lit(0)), F.lit(0.0))


def is_translation(line: Column, body: Column) -> Column:
    """Whether a line (text, kind, bold, size) may be the English form of the heading above it: short, no sentence, set apart by its style."""
    t = bare(line["text"])
    styled = line["kind"].isin("title", "section_header") | line["bold"] | (upper_share(t) >= 0.8) | (line["size"] / F.nullif(body, F.lit(0.0)) >= 1.1)
    return is_english(t) & (word_count(t) <= 12) & ~ends_sentence(t) & F.coalesce(styled, F.lit(False))


def aligned(a: Column, b: Column) -> Column:
    """Lines with one left edge (6 points) or one centre (8 points)."""
    return (F.abs(a["x0"] - b["x0"]) <= 6) | (F.abs((a["x0"] + a["x1"]) / 2 - (b["x0"] + b["x1"]) / 2) <= 8)


def adjacent(a: Column, b: Column) -> Column:
    """b right below a on its page; tight leading may make boxes overlap by half a line."""
    gap, tall = b["y0"] - a["y1"], a["y1"] - a["y0"]
    return (a["page"] == b["page"]) & gap.between(tall * -0.5, tall * 0.8)


def starts_paragraph(a: Column, b: Column) -> Column:
    """Whether line b begins a paragraph after line a (structs of page, place, kind, x0, y0, x1, y1, size, text; place: its column and article). Lines without a box stand alone."""
    tall = lambda s: s["y1"] - s["y0"]
    gap, ended = b["y0"] - a["y1"], ends_sentence(a["text"])
    fresh = ended & ~starts_lower(b["text"])
    slight = (a["page"] == b["page"]) & (b["y0"] > a["y0"]) & a["kind"].eqNullSafe(b["kind"]) & (gap >= F.least(tall(a), tall(b)) * -0.25)
    sizes = F.coalesce((a["size"] != 0) & (b["size"] != 0) & (F.abs(a["size"] - b["size"]) > 1.5), F.lit(False))
    rule = F.when(~a["place"].eqNullSafe(b["place"]) | ~(b["page"] - a["page"]).isin(0, 1), True).when(is_bullet(b["text"]) | numbering(bare(b["text"])).isNotNull() | sizes, True)
    rule = rule.when((a["page"] != b["page"]) | (gap < 0) & ~slight, ended | ~starts_lower(b["text"])).when(gap > tall(a) * 0.6, True)
    rule = rule.when((b["x0"] - a["x0"] > 12) & ended, True).otherwise(fresh)
    unplaced = F.lit(False)
    for s in (a, b):
        for c in ("x0", "y0", "x1", "y1"):
            unplaced = unplaced | F.isnull(s[c])
    return F.when(unplaced, True).otherwise(F.coalesce(rule, F.lit(True)))
