"""Alignment of a text with its reference: edits by kind, and the errors of diacritics among them."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from functools import cache, lru_cache
from unicodedata import normalize

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The combining marks that are tones, and those that are shapes
TONES = {"́": "acute", "̀": "grave", "̉": "hook_above", "̃": "tilde", "̣": "dot_below"}
SHAPES = {"̆": "breve", "̂": "circumflex", "̛": "horn"}


#: Bits of the table of moves that are held at once; of a larger table every k-th row is kept, and the rows between are worked out again on the way back
TABLE_BITS = 1 << 28


def aligned(reference: list, prediction: list) -> list[tuple[int | None, int | None]]:
    """Pairs of places of one cheapest alignment. Read from the end, a pair is preferred to a deletion, and that to an insertion.

    A row of the table of costs is a few operations on whole numbers of a bit for each place of the prediction (Myers, Hyyrö): bits say where costs rise and fall along the row.
    Common ends are paired at once.
    """
    tail = 0
    while tail < min(len(reference), len(prediction)) and reference[-1 - tail] == prediction[-1 - tail]:
        tail += 1
    n, m = len(reference) - tail, len(prediction) - tail
    out: list[tuple[int | None, int | None]] = [(n + k, m + k) for k in reversed(range(tail))]
    where: dict = {}
    for j in range(m):
        where[prediction[j]] = where.get(prediction[j], 0) | 1 << j
    marks = [where.get(x, 0) for x in reference[:n]]
    every = n if n * m <= TABLE_BITS else math.isqrt(n) + 1
    full = (1 << m) - 1
    starts = [(full, 0)]
    for low in range(0, n - every, every) if every else ():
        starts.append(_rows(marks[low : low + every], *starts[-1], full))
    i, j = n, m
    while i and j:
        low = (i - 1) // every * every
        apart, deleted = [], []
        _rows(marks[low:i], *starts[low // every], full, apart, deleted)
        while i > low and j:
            j -= 1
            if not apart[i - 1 - low] >> j & 1:
                i -= 1
                out.append((i, j))
            elif deleted[i - 1 - low] >> j & 1:
                i, j = i - 1, j + 1
                out.append((i, None))
            else:
                out.append((None, j))
    out += [(k, None) for k in reversed(range(i))]
    out += [(None, k) for k in reversed(range(j))]
    return out[::-1]


def _rows(marks: list[int], up: int, down: int, full: int, apart: list | None = None, deleted: list | None = None) -> tuple[int, int]:
    """Where costs rise and fall along the last of some rows, from those along the row before the first. marks: the places of each row's element in the prediction.
    Collected of each row: the places where a pair is not cheapest, and those where a deletion is."""
    for eq in marks:
        same = ((eq & up) + up ^ up) | eq | down
        more = down | full & ~(same | up)
        less = same & up
        if apart is not None:
            apart.append(same & full & ~eq)
            deleted.append(more)
        more = more << 1 | 1
        up = full & (less << 1 | ~(same | more))
        down = full & same & more
    return up, down


@cache
def slots(char: str | None) -> tuple[str, str | None, str | None, str | None]:
    """Base letter in lower case, shape, tone and stroke of a character."""
    if not char:
        return "", None, None, None
    if char in "đĐ":
        return "d", None, None, "bar"
    base, *marks = normalize("NFD", char)
    shape = [SHAPES[m] for m in marks if m in SHAPES]
    tone = [TONES[m] for m in marks if m in TONES]
    return base.lower(), shape[-1] if shape else None, tone[-1] if tone else None, None


@lru_cache(1 << 16)
def _of_pair(r: str | None, p: str | None) -> dict[str, int]:
    """What a pair of characters (one of them None: an insertion or a deletion) adds to the measures."""
    (r_base, *r_slots), (p_base, *p_slots) = slots(r), slots(p)
    marked, there = sum(x is not None for x in r_slots), sum(x is not None for x in p_slots)
    out = {"hits" if r == p else "insertions" if r is None else "deletions" if p is None else "substitutions": 1, "slots": marked}
    out["der_errors"] = sum((a is not None or b is not None) and (a != b or r_base != p_base) for a, b in zip(r_slots, p_slots, strict=True))
    out["uncomposed"] = int(p is not None and (p in TONES or p in SHAPES))
    if r is None:
        return out
    if p is None:
        out["deleted_slots"] = marked
    elif r_base != p_base:
        out["base_mismatch_slots"] = marked
    elif marked or there:
        out["slot_errors"] = sum(a is not None and a != b for a, b in zip(r_slots, p_slots, strict=True))
        out["spurious_marks"] = sum(a is None and b is not None for a, b in zip(r_slots, p_slots, strict=True))
    return out


def _paired(reference: str, prediction: str) -> Counter:
    """How often each pair of characters (in NFC, None for none) stands in the alignment."""
    ref, pred = list(normalize("NFC", reference)), list(normalize("NFC", prediction))
    return Counter((None if i is None else ref[i], None if j is None else pred[j]) for i, j in aligned(ref, pred))


def measures(reference: str, prediction: str) -> dict[str, int]:
    """Edits by kind over characters and words, and diacritic errors with and without those under a wrong base letter."""
    out = dict.fromkeys(MEASURES, 0)
    for pair, n in _paired(reference, prediction).items():
        for name, k in _of_pair(*pair).items():
            out[name] += n * k
    out["chars"] = out["hits"] + out["substitutions"] + out["deletions"]
    out["dser_errors"] = out["slot_errors"] + out["deleted_slots"] + out["spurious_marks"] + out["uncomposed"]
    words, said = reference.split(), prediction.split()
    out["words"] = len(words)
    out["word_edits"] = sum(i is None or j is None or words[i] != said[j] for i, j in aligned(words, said))
    return out


MEASURES = ["chars", "hits", "substitutions", "deletions", "insertions", "slots", "der_errors", "slot_errors", "deleted_slots", "spurious_marks", "uncomposed", "base_mismatch_slots", "dser_errors", "words", "word_edits"]


def _dealt(pairs: DataFrame) -> DataFrame:
    """The rows dealt over many tasks: a file may be one task, and alignment is far dearer than reading."""
    return pairs.repartition(max(64, 8 * pairs.sparkSession.sparkContext.defaultParallelism))


def text_metrics(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """Measures of each row (reference, prediction; a null prediction counts as empty, a null reference as unknown: null measures) and cer, wer, der and dser (null without a denominator)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [dict.fromkeys(MEASURES) if r is None else measures(r, p or "") for r, p in zip(batch["reference"], batch["prediction"], strict=True)]
            yield pd.concat([batch[keys].reset_index(drop=True), pd.DataFrame(rows, columns=MEASURES).astype("Int64")], axis=1)

    fields = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.select(*keys).schema)
    made = _dealt(pairs.select(*keys, "reference", "prediction")).mapInPandas(run, f"{fields}, {', '.join(f'{m} long' for m in MEASURES)}")
    rate = lambda top, bottom: F.when(F.col(bottom) > 0, top / F.col(bottom))
    return made.withColumns({"cer": rate(F.col("substitutions") + F.col("deletions") + F.col("insertions"), "chars"), "wer": rate(F.col("word_edits"), "words"), "der": rate(F.col("der_errors"), "slots"), "dser": rate(F.col("dser_errors"), "slots")})


def confusions(pairs: DataFrame, top: int = 25) -> DataFrame:
    """The most frequent (kind, reference value, predicted value, reference character) of diacritics that differ under one base letter."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found, rows = Counter(), Counter()
            for r, p in zip(batch["reference"], batch["prediction"], strict=True):
                found += _paired(r or "", p or "")
            for (r, p), n in found.items():
                if r is not None and p is not None and r != p:
                    (a, *x), (b, *y) = slots(r), slots(p)
                    rows += {(kind, u or "none", v or "none", r): n for kind, u, v in zip(("shape", "tone", "stroke"), x, y, strict=True) if a == b and u != v}
            yield pd.DataFrame([(*k, n) for k, n in rows.items()], columns=["kind", "reference_value", "predicted_value", "char", "n"])

    made = _dealt(pairs.select("reference", "prediction")).mapInPandas(run, "kind string, reference_value string, predicted_value string, char string, n long")
    counted = made.groupBy("kind", "reference_value", "predicted_value", "char").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return counted.orderBy(F.col("n").desc(), "kind", "char", "reference_value", "predicted_value").limit(top)


def slot_counts(text: Column) -> dict[str, Column]:
    """Marks of each kind in a text, as column expressions over its decomposed form; the letters that hold them are written in escapes of Unicode."""
    bare = F.pandas_udf(lambda s: s.map(lambda t: normalize("NFD", t), na_action="ignore"), "string")(text)
    count = lambda chars: F.regexp_count(bare, F.lit(f"[{''.join(chars)}]"))
    return {"shapes": count(SHAPES), "tones": count(TONES), "strokes": count("đĐ")}
