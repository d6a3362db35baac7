"""Text keys and measures as column expressions; Arrow UDFs only for what Spark has no expression for (NFC, case folding)."""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F


def _match_key(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for s in texts:
        yield s.map(lambda t: unicodedata.normalize("NFC", unicodedata.normalize("NFC", t).casefold()), na_action="ignore")


def match_key(text: Column | str) -> Column:
    """NFC and full case folding, as keyword matching compares texts. Null stays null. Pure ASCII texts, whose key is their lower case, stay in the JVM."""
    text = F.col(text) if isinstance(text, str) else text
    plain = text.rlike(r"\A[\x00-\x7F]*\z")
    return F.when(plain, F.lower(text)).otherwise(F.pandas_udf(_match_key, "string")(F.when(~plain, text)))


def fold_word(word: str) -> str:
    """Case-folded, without diacritics; a barred d becomes d."""
    bare = "".join(c for c in unicodedata.normalize("NFD", word.casefold()) if not unicodedata.combining(c))
    return bare.replace("đ", "d")


def _accent_fold(texts: pd.Series) -> pd.Series:
    return texts.map(fold_word, na_action="ignore")


def accent_fold(text: Column | str) -> Column:
    return F.pandas_udf(_accent_fold, "string")(text)


def occurrences(text: Column, keyword: Column) -> Column:
    """Non-overlapping occurrences, left to right, of a literal keyword in a text; both are keys."""
    gone = F.replace(text, keyword, F.lit(""))
    return F.when(F.length(keyword) > 0, ((F.length(text) - F.length(gone)) / F.length(keyword)).cast("long")).otherwise(F.lit(0).cast("long"))


def clean_line(text: Column) -> Column:
    """No-break and zero-width characters to plain ones, runs of blanks to one, no blanks at the ends."""
    plain = F.translate(text, " ​‌‍﻿", " ")
    return F.trim(F.regexp_replace(plain, r"[ \t]+", " "))


#: Fixed value: a roman number up to 3999 as a pattern, also with four equal letters where only the five form is missing
_ROMAN = "M{0,3}(?:CM|CD|D?C{0,3})(?:XC|XL|L?X{0,3})(?:IX|IV|V?I{0,3})"


def is_page_number(text: Column) -> Column:
    """A decimal number of up to four digits or a well-formed roman one, alone, after "trang", or with a total."""
    return F.trim(text).rlike(rf"(?i)^(?:trang\s+)?(?:[0-9]{{1,4}}|(?=[ivxlcdm]){_ROMAN})(?:\s*/\s*[0-9]{{1,4}})?$")


def is_connector_line(text: Column) -> Column:
    """Empty, or only strokes and dots in tokens of two characters at most."""
    bare = F.regexp_replace(text, r"^\s+|\s+$", "")
    return (bare == "") | (bare.rlike(r"^[1lI|/\\\-_zE.,\s]+$") & F.forall(F.split(bare, r"\s+"), lambda x: F.length(x) <= 2))


def is_inside_number(text: Column, start: Column, end: Column) -> Column:
    """Whether a separator and a digit stand right before or after the places start to end (from 0, end exclusive)."""
    at = lambda i: F.when(i >= 0, F.substring(text, i + 1, F.lit(1)))
    touches = lambda mark, digit: F.coalesce(at(mark).isin(".", ",", "-", "/") & at(digit).rlike("^[0-9]$"), F.lit(False))
    return touches(start - 1, start - 2) | touches(end, end + 1)


def accent_strip(text: Column) -> Column:
    """Without diacritics, case kept; a barred d becomes d. Pure ASCII texts stay in the JVM."""
    bare = F.pandas_udf(lambda s: s.map(lambda t: "".join(c for c in unicodedata.normalize("NFD", t) if not unicodedata.category(c) == "Mn").replace("đ", "d").replace("Đ", "D"), na_action="ignore"), "string")
    return F.when(text.rlike(r"\A[\x00-\x7F]*\z"), text).otherwise(bare(F.when(~text.rlike(r"\A[\x00-\x7F]*\z"), text)))


def joined_lines(lines: Column) -> Column:
    """Lines of a paragraph as one: a letter and a hyphen before a line that begins with a small letter are glued without the hyphen, others get a space between."""
    glue = lambda acc, x: F.when(acc == "", x).when(acc.rlike(r"\p{L}-$") & x.rlike(r"^\p{Ll}"), F.concat(F.regexp_replace(acc, "-$", ""), x)).otherwise(F.concat_ws(" ", acc, x))
    return F.aggregate(F.filter(F.transform(lines, lambda x: F.trim(x)), lambda x: x != ""), F.lit(""), glue)


def repeated_tail(text: Column) -> Column:
    """The text with a phrase of one to four words that ends it three times or more given once; as it is otherwise."""
    return F.regexp_replace(text, r"(?i)(?<!\S)(\S+(?:\s+\S+){0,3}?)(?:\s+\1){2,}\s*$", "$1")


def cer(reference: Column, prediction: Column) -> Column:
    """Character error rate, not clamped; null where the reference is empty or unknown."""
    return F.when(F.length(reference) > 0, F.levenshtein(reference, F.coalesce(prediction, F.lit(""))) / F.length(reference))


def shingles(words: Column, n: int) -> Column:
    """Distinct runs of n words. The words are worked out once, not once for each run."""

    def runs(w: Column) -> Column:
        last = F.size(w) - n + 1
        return F.when(last > 0, F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), lambda i: F.array_join(F.slice(w, i, n), " ")))).otherwise(F.array().cast("array<string>"))

    return F.element_at(F.transform(F.array(words), runs), 1)
