"""Page and line predicates, language evidence, evaluation text forms, numbering and amounts at line ends, as column expressions."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .text import is_connector_line

# Fixed values
TO_READ = ["SCANNED_IMAGE", "SCANNED_WITH_OCR_LAYER", "NATIVE_TEXT_LOW_QUALITY", "IMAGE_ONLY", "MIXED"]
VIETNAMESE = "ăâđêôơưáàảãạắằẳẵặấầẩẫậéèẻẽẹếềểễệíìỉĩịóòỏõọốồổỗộớờởỡợúùủũụứừửữựýỳỷỹỵ"
VOWELS = "aeiouy" + VIETNAMESE.replace("đ", "")
VIETNAMESE_PHRASES = ["bao cao", "doanh thu", "loi nhuan", "tai chinh", "hoi dong", "co dong", "cong ty", "quan tri", "von dieu le", "dai hoi", "nam truoc", "tong tai san"]
ENGLISH_WORDS = "the and of for with from to in is are was were has have revenue grew strongly annual report financial statements board directors shareholders profit assets liabilities cash flow company year results".split()
ENGLISH_PHRASES = ["annual report", "financial statements", "board of directors", "cash flow"]
STROKES = ["I", "1", "l", "|", "!", "[", "]", "/", "-", "i", "L", "T", "H", "E", "F"]
UNITS = "%|\\$|đ|₫|€|¥|VND|vnd"
AMOUNT = r"^\(?[0-9]{1,3}(?:\.[0-9]{3})+(?:,[0-9]+)?\)?$|^-?$|^[0-9]+(?:,[0-9]+)?%$|^\(?[0-9]+\)?$"
PERIODS = ["năm", "tháng", "quý", "kỳ", "ngày", "mục", "điều", "khoản", "phần"]
PARTS = "phần|chương|mục|điều|phụ lục"
ROMAN = {"I": 1, "V": 5, "X": 10, "L": 50, "C": 100}


def nfc(text: Column) -> Column:
    """NFC; pure ASCII texts stay in the JVM."""
    plain = text.rlike(r"\A[\x00-\x7F]*\z")
    form = F.pandas_udf(lambda s: s.map(lambda t: unicodedata.normalize("NFC", t), na_action="ignore"), "string")
    return F.when(plain, text).otherwise(form(F.when(~plain, text)))


def once(value: Column, f: Callable[[Column], Column]) -> Column:
    """f(value) with the value worked out once, however often f names it."""
    return F.get(F.transform(F.array(value), f), 0)


def page_type(chars: Column, images: Column, coverage: Column, full: Column, tables: Column, hidden_layer: Column, hidden_only: Column, score: Column, reliable: float = 0.9, review: float = 0.7) -> Column:
    """The kind of a page by its text layer and pictures. A hidden layer is never trusted; unknown flags count as false, unknown numbers as 0."""
    chars, images, coverage, tables, score = (F.coalesce(c, F.lit(0)) for c in (chars, images, coverage, tables, score))
    full, hidden_layer, hidden_only = (F.coalesce(c, F.lit(False)) for c in (full, hidden_layer, hidden_only))
    sparse = chars < 30
    kind = F.when(hidden_layer, "SCANNED_WITH_OCR_LAYER").when(hidden_only, "NATIVE_TEXT_LOW_QUALITY")
    kind = kind.when(sparse & (images > 0), "SCANNED_IMAGE").when(sparse, "IMAGE_ONLY")
    kind = kind.when((images >= 4) & (chars < 400) & (tables == 0), "PRODUCT_SHOWCASE_COLLAGE")
    kind = kind.when((score >= reliable) & ~full & (coverage > 0.4) & (images > 0), "MIXED").when(score >= reliable, "NATIVE_TEXT")
    return kind.when((score < review) | full | (coverage > 0.5), "NATIVE_TEXT_LOW_QUALITY").otherwise("MIXED")


def is_read_again(kind: Column) -> Column:
    return kind.isin(TO_READ)


def page_category(kind: Column) -> Column:
    return F.when(kind == "NATIVE_TEXT", "native").when(kind == "MIXED", "mixed").otherwise("scan")


def attempt_state(complete: Column, *signatures: tuple[str, Column]) -> Column:
    """State of an attempt: signatures (name, present) in order of weight, names of None for other errors."""
    found = reduce(lambda a, b: a | b, (present for _, present in signatures))
    state = F.when(complete & ~found, "COMPLETED")
    for name, present in signatures:
        state = state.when(present, name)
    return state.otherwise("INTERRUPTED")


def rejection(text: Column, confidence: Column, lexicon: list[str]) -> Column:
    """Why a read line is not taken, null where it is. A doubtful line (confidence below 0.8 or unknown) needs evidence: figures, a known word,
    a Vietnamese letter or a plausible share of vowels."""
    text = F.coalesce(text, F.lit(""))
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    low = F.lower(bare)
    count = lambda of: F.regexp_count(low, F.lit(of))
    digits, letters, vowels = count(r"\p{Nd}"), count(r"\p{L}"), count(f"[{VOWELS}]")
    known = F.exists(F.split(low, r"\s+"), lambda w: F.regexp_replace(w, r"[^\p{L}]", "").isin(lexicon))
    evidence = (digits >= 2) | ((digits > 0) & bare.rlike(UNITS)) | known | low.rlike(f"[{VIETNAMESE}]")
    doubtful = confidence.isNull() | (confidence < 0.8)
    odd = F.when(letters >= 3, (vowels / letters < 0.15) | (vowels / letters > 0.85)).otherwise((letters > 0) & (digits == 0))
    noise = ~bare.rlike(r"[\p{L}\p{N}]") | is_connector_line(bare) | (doubtful & ~evidence & odd) | (~doubtful & (letters >= 5) & (digits == 0) & (vowels == 0))
    return F.when(confidence < 0.6, "REJECTED_LOW_CONFIDENCE").when(noise, "REJECTED_HALLUCINATION")


def glyph_noise(lines: DataFrame, page: str, text: str) -> DataFrame:
    """(page, lines, noise): pages whose lines are mostly loose glyphs, as a turned page gives; so are pages without a line."""
    bare = lines.select(page, F.regexp_replace(text, r"^\s+|\s+$", "").alias("t")).withColumn("n", F.length("t"))
    kept = F.col("n") > 0
    counts = bare.groupBy(page).agg(F.count_if(kept).alias("lines"), F.count_if(kept & (F.col("n") <= 2)).alias("short"), F.count_if(F.col("t").isin(STROKES)).alias("strokes"), F.count_if(F.col("n") >= 4).alias("words"), F.sum("n").alias("chars"))
    share = lambda c: F.col(c) / F.greatest("lines", F.lit(1))
    noise = (F.col("lines") == 0) | ((F.col("lines") <= 20) & (share("short") >= 0.4) & (F.col("words") < 3)) | ((share("short") >= 0.35) & (F.col("words") < 12)) | (share("strokes") >= 0.25)
    return counts.select(page, "lines", (noise | ((share("chars") < 3.2) & (share("words") <= 0.15)) | ((share("chars") < 3.0) & (F.col("words") <= 2))).alias("noise"))


def language_evidence(text: Column) -> Column:
    """struct(language, reason): vi, en or unknown. Plain ASCII is no evidence of English by itself."""
    answer = lambda a, b: F.struct(F.lit(a).alias("language"), F.lit(b).alias("reason"))
    none = answer("unknown", "insufficient_lexical_evidence")
    says = lambda joined, phrases: reduce(lambda a, b: a | b, (F.contains(joined, F.lit(f" {p} ")) for p in phrases))

    def of_measures(m: Column) -> Column:
        en = m["en"] | ((m["hits"] >= 2) & (m["hits"] >= 0.25 * m["tokens"]))
        found = F.when(m["letters"] < 4, none).when(m["marked"] >= 0.03 * m["letters"], answer("vi", "vietnamese_character_ratio")).when(m["foreign"] | ~(m["vi"] | en), none)
        return found.when(m["vi"] & en, answer("unknown", "mixed_lexical_evidence")).when(m["vi"], answer("vi", "unaccented_vietnamese_phrase")).otherwise(answer("en", "english_lexical_evidence"))

    def of_text(low: Column) -> Column:
        tokens = F.regexp_extract_all(low, F.lit("([a-z]+)"), 1)
        lexical = lambda t: F.struct(F.size(t).alias("tokens"), F.size(F.array_intersect(t, F.array(*map(F.lit, ENGLISH_WORDS)))).alias("hits"), F.concat(F.lit(" "), F.array_join(t, " "), F.lit(" ")).alias("joined"))
        counts = [F.regexp_count(low, F.lit(p)).alias(n) for p, n in ((r"\p{L}", "letters"), (f"[{VIETNAMESE}]", "marked"))]
        foreign = low.rlike(r"[\p{L}&&[^a-z]]").alias("foreign")
        measures = lambda x: F.struct(*counts, foreign, x["tokens"].alias("tokens"), x["hits"].alias("hits"), says(x["joined"], VIETNAMESE_PHRASES).alias("vi"), says(x["joined"], ENGLISH_PHRASES).alias("en"))
        return once(once(once(tokens, lexical), measures), of_measures)

    return once(F.lower(nfc(F.coalesce(text, F.lit("")))), of_text)


def visible_text(text: Column) -> Column:
    """NFC with line feeds as the only line ends; null is empty."""
    return F.replace(F.replace(nfc(F.coalesce(text, F.lit(""))), F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))


def reading_text(text: Column) -> Column:
    """The visible text with every run of white space as one blank, none at the ends."""
    return F.trim(F.regexp_replace(visible_text(text), r"[ \t\n]+", " "))


def evaluation_lines(text: Column) -> Column:
    """Lines of a Markdown text to be compared: page headings, heading marks, rules, running-line marks, table rules and outer pipes gone, blanks collapsed."""
    plain = nfc(F.coalesce(text, F.lit("")))
    for pattern in (r"^#+\s*Trang\s+\d+.*$", r"^>\s*\*{1,2}(?:Header|Footer)\*{1,2}:\s*", r"^#+\s*", r"^---\s*$", r"^\|\s*[-:\s|]+\|\s*$"):
        plain = F.regexp_replace(plain, "(?md)" + pattern, "")
    lines = F.transform(F.split(plain, r"\r\n|[\n\r]"), lambda x: F.trim(F.regexp_replace(x, r"\s+", " ")))
    lines = F.filter(lines, lambda x: x != "")
    return F.transform(lines, lambda x: F.when(x.rlike(r"^\|.*\|$"), F.trim(F.regexp_replace(x, r"^\||\|$", ""))).otherwise(x))


def reading_order_share(reference: Column, prediction: Column) -> Column:
    """Share of long reference lines whose start is found in the prediction no earlier than that of the line found before; 1 below two such lines."""
    lines = F.filter(evaluation_lines(reference), lambda x: F.length(x) > 15)
    text = F.array_join(evaluation_lines(prediction), "\n")
    found = lambda both: F.struct(F.size(both["lines"]).alias("n"), F.filter(F.transform(both["lines"], lambda x: F.position(F.substring(x, 1, 25), both["text"])), lambda p: p > 0).alias("at"))
    rising = lambda at: F.size(F.filter(F.transform(at, lambda p, i: p >= F.coalesce(F.get(at, i - 1), F.lit(0))), lambda ok: ok))
    share = lambda x: F.when(x["n"] <= 1, F.lit(1.0)).otherwise(F.round(rising(x["at"]) / x["n"], 4))
    return once(once(F.struct(lines.alias("lines"), text.alias("text")), found), share)


def whole_tokens(text: Column, forms: list[str]) -> Column:
    """The given capital forms that stand as whole tokens, in order, repeats included."""
    return F.regexp_extract_all(text, F.lit(rf"(?<![\p{{L}}])({'|'.join(forms)})(?![\p{{L}}])"), 1)


def with_strokes(text: Column, forms: dict[str, str]) -> Column:
    """The text with whole-token acronyms given their stroked letters; longer words that hold one stay."""
    return reduce(lambda t, f: F.regexp_replace(t, rf"(?<![\p{{L}}]){f[0]}(?![\p{{L}}])", f[1]), forms.items(), text)


def company_id(value: Column) -> Column:
    """struct(id, valid): NFC, trimmed and folded; empty or unknown values are `unknown`, names with blanks inside are no ids."""
    bare = F.regexp_replace(nfc(F.coalesce(value, F.lit(""))), r"^\s+|\s+$", "")
    low = F.lower(bare)
    valid = ~low.rlike(r"\s")
    return F.struct(F.when(low == "", "unknown").when(valid, low).alias("id"), valid.alias("valid"))


def trailing_amounts(line: Column) -> Column:
    """The description of a line and the amounts that end it, as an array; a line of a period word and a number stays whole."""
    words = F.filter(F.split(F.trim(line), r"\s+"), lambda x: x != "")
    said_until = lambda w: F.struct(w.alias("words"), F.coalesce(F.array_max(F.transform(w, lambda x, i: F.when(x.rlike(AMOUNT), 0).otherwise(i + 1))), F.lit(0)).alias("last"))
    cut = lambda x: F.struct(F.array_join(F.slice(x["words"], F.lit(1), x["last"]), " ").alias("said"), F.slice(x["words"], x["last"] + 1, F.size(x["words"])).alias("amounts"))
    parts = lambda x: F.when(F.lower(x["said"]).isin(PERIODS), F.array(F.trim(line))).when(x["said"] == "", x["amounts"]).otherwise(F.concat(F.array(x["said"]), x["amounts"]))
    return once(once(once(words, said_until), cut), parts)


def roman_value(token: Column) -> Column:
    values = F.transform(F.split(token, "(?!^)"), lambda c: sum((F.when(c == k, v).otherwise(0) for k, v in ROMAN.items()), F.lit(0)))
    signed = F.transform(values, lambda v, i: F.when(v < F.coalesce(F.get(values, i + 1), F.lit(0)), -v).otherwise(v))
    return F.aggregate(signed, F.lit(0), lambda a, v: a + v)


def numbering(text: Column) -> Column:
    """struct(kind, path) of the number that opens a heading: a part word with a number, a roman or decimal number, a capital; null without one."""
    t = F.regexp_replace(text, r"^\s+", "")
    part = F.upper(F.regexp_extract(t, rf"(?iu)^(?:{PARTS})\s+([IVXLC]+|\d+|[A-Z])\b", 1))
    roman = F.regexp_extract(t, r"^([IVXLC]+)\s*[.)\-–:]\s+\S", 1)
    arabic = F.regexp_extract(t, r"^(\d{1,2}(?:\.\d{1,2}){0,3})\s*[.)\-–:]?\s+[^\d\s]", 1)
    capital = F.regexp_extract(t, r"^([A-ZĐ])\s*[.)]\s+\S", 1)
    answer = lambda kind, path: F.struct(F.lit(kind).alias("kind"), path.cast("array<int>").alias("path"))
    value = F.when(part.rlike("^[0-9]+$"), part.cast("int")).when(part.rlike("^[IVXLC]+$"), roman_value(part)).otherwise(0)
    found = F.when(part != "", answer("keyword", F.array(value))).when(roman != "", answer("roman", F.array(roman_value(roman))))
    return found.when(arabic != "", answer("arabic", F.split(arabic, r"\."))).when(capital != "", answer("upper_alpha", F.array(F.ascii(capital))))


def weighted_median(rows: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """(keys, median): the median of values repeated by whole weights. Distinct values are summed first, so a group holds its distinct values alone."""
    sums = rows.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.sum(weight).alias("w"))
    upto = sums.withColumn("upto", F.sum("w").over(Window.partitionBy(*keys).orderBy(value))).withColumn("all", F.sum("w").over(Window.partitionBy(*keys)))
    middle = upto.where((F.col("upto") >= F.floor((F.col("all") + 1) / 2)) & (F.col("upto") - F.col("w") < F.ceil((F.col("all") + 1) / 2)))
    return middle.groupBy(*keys).agg(((F.min(value) + F.max(value)) / 2).alias("median"))


def half_of_spread(x0: Column, x1: Column, split: float) -> Column:
    """struct(side, x0, x1): the half of a two-page spread that a box belongs to by its centre, and its place there."""
    left = (x0 + x1) / 2 < split
    return F.struct(F.when(left, "L").otherwise("R").alias("side"), F.when(left, x0).otherwise(x0 - split).alias("x0"), F.when(left, x1).otherwise(x1 - split).alias("x1"))


def islands(rows: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    """Rows with `island`: from 1, one more where the value differs from the row before."""
    w = Window.partitionBy(*keys).orderBy(*order)
    starts = rows.withColumn("island", F.when(F.col(value).eqNullSafe(F.lag(value).over(w)) & (F.row_number().over(w) > 1), 0).otherwise(1))
    return starts.withColumn("island", F.sum("island").over(w.rowsBetween(Window.unboundedPreceding, 0)))
