"""Amounts as exact decimals, and their conventions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What an amount looks like in each convention, and what speaks for one
SHAPES = {"vn": r"[0-9]{1,3}(?:\.[0-9]{3})+(?:,[0-9]+)?|[0-9]+(?:,[0-9]+)?", "en": r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+(?:\.[0-9]+)?", "plain": "[0-9]+"}
EVIDENCE = {"vn": r"[0-9]{1,3}(?:\.[0-9]{3})+(?:,[0-9]+)?|[0-9]+,[0-9]{1,2}", "en": r"[0-9]{1,3}(?:,[0-9]{3})+(?:\.[0-9]+)?|[0-9]+\.[0-9]{1,2}"}


def _let(value: Column, then) -> Column:
    """then(value) with value worked out once."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _whole(text: Column, pattern: str) -> Column:
    return text.rlike(f"^(?:{pattern})$")


def _bare(text: Column) -> Column:
    return F.regexp_replace(F.translate(text, "\u00a0", " "), r"^\s+|\s+$", "")


def is_negative(text: Column) -> Column:
    t = _bare(text)
    return (t.startswith("(") & t.endswith(")")) | t.rlike("^[-\u2212\u2013].")


def digits(text: Column) -> Column:
    """The digits of an amount with their marks, without sign or brackets, which must balance; blanks only between groups of three of a whole value. Null for anything else."""

    def unsigned(t: Column) -> Column:
        inside = F.regexp_replace(t, r"^\(\s*|\s*\)$", "")
        return F.when(t.startswith("(") & t.endswith(")"), inside).when(t.startswith("(") | t.endswith(")"), None).otherwise(F.regexp_replace(t, r"^[-+\u2212\u2013](?=.)\s*", ""))

    def ungrouped(body: Column) -> Column:
        return F.when(_whole(body, r"[0-9]{1,3}(?: [0-9]{3})+(?:[.,][0-9]+)?"), F.replace(body, F.lit(" "), F.lit(""))).otherwise(body)

    return _let(_let(_let(_bare(text), unsigned), ungrouped), lambda body: F.when(_whole(body, "[0-9][0-9.,]*"), body))


def parse_amount(text: Column, convention: Column) -> Column:
    """A decimal from a printed amount: brackets or a minus mean negative, a lone dash zero; a percentage, another convention and unknown forms give null, never zero.

    vn: dots group, a comma is the decimal point; en: the other way round; plain: digits only.
    """

    def value(token: Column) -> Column:
        vn = F.when((convention == "vn") & _whole(token, SHAPES["vn"]), F.translate(token, ",.", "."))
        en = vn.when((convention == "en") & _whole(token, SHAPES["en"]), F.replace(token, F.lit(","), F.lit("")))
        return en.when((convention == "plain") & _whole(token, SHAPES["plain"]), token).cast("decimal(38,9)")

    number = _let(digits(text), value)
    dash = _bare(text).rlike("^[-\u2013\u2014\u2212]$")
    return F.when(dash, F.lit(0).cast("decimal(38,9)")).otherwise(F.when(is_negative(text), -number).otherwise(number))


def convention(texts: Column) -> Column:
    """vn, en, plain or ambiguous, as an aggregate over the amounts of a table; cells that are no amount say nothing."""
    token = digits(texts)
    vn, en = (F.coalesce(F.bool_or(_whole(token, EVIDENCE[k])), F.lit(False)) for k in ("vn", "en"))
    return F.when(vn & en, "ambiguous").when(vn, "vn").when(en, "en").otherwise("plain")
