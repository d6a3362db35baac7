"""Occurrences of keywords in texts with their places: literal and bounded matches, citations, aliases and their rules.

Offsets count code points: match_start and match_end in the folded text (NFC, case-folded), source_start and source_end in the NFC text, from which
quotations are cut. Folding may lengthen a text (a sharp s becomes two letters), so every folded character remembers its source.

Texts are worked off one by one in Arrow batches; rows are shuffled nowhere. A null text has no occurrences; empty and repeated keywords do not count.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import fold_word
from ..sources.tables import bound_batches

MARKER = re.compile(r"^# Trang ([0-9]+)$", re.M)
CONTEXT_WORDS = 10
_WORD = re.compile(r"[^\W_]+", re.U)


def key_of(text: str) -> str:
    return unicodedata.normalize("NFC", unicodedata.normalize("NFC", text).casefold())


def distinct_keywords(lines: list[str]) -> dict[str, str]:
    """Folded keys of the keywords in order, with their first spelling."""
    out: dict[str, str] = {}
    for line in lines:
        word = unicodedata.normalize("NFC", line.strip())
        if word and key_of(word) not in out:
            out[key_of(word)] = word
    return out


def literal_spans(folded: str, keys: list[str]) -> Iterator[tuple[str, int, int]]:
    """Occurrences of every key, left to right and not overlapping one another; keys are independent."""
    for key in keys:
        at = folded.find(key)
        while at >= 0:
            yield key, at, at + len(key)
            at = folded.find(key, at + len(key))


def _in_word(char: str) -> bool:
    return char.isalnum() or "̀" <= char <= "ͯ"


def bounded_spans(folded: str, keys: list[str]) -> tuple[list[tuple[str, int, int]], list[tuple[str, int, int, str]]]:
    """Occurrences at word boundaries: of overlapping ones the leftmost stays, then the longest, then the first key; and the others, each with the key that keeps it out."""
    found = []
    for rank, key in enumerate(keys):
        head, tail = _in_word(key[0]), _in_word(key[-1])
        at = folded.find(key)
        while at >= 0:
            end = at + len(key)
            if not (head and at and _in_word(folded[at - 1])) and not (tail and end < len(folded) and _in_word(folded[end])):
                found.append((at, -len(key), rank))
            at = folded.find(key, at + 1)
    kept, out, reach = [], [], 0
    for at, size, rank in sorted(found):
        if kept and at < reach:
            out.append((keys[rank], at, at - size, kept[-1][0]))
        else:
            kept.append((keys[rank], at, at - size))
            reach = at - size
    return kept, out


def _folded(text: str) -> tuple[str, list[int]]:
    """The folded text and, for each of its characters, the place of its source character."""
    pieces, source = [], []
    for i, char in enumerate(text):
        piece = char.casefold()
        pieces.append(piece)
        source += [i] * len(piece)
    return "".join(pieces), source


#: Rows that leave a worker at once; a batch of texts may have many times as many
OUT_ROWS = 5000


def _rows(batches: Iterator[pd.DataFrame], columns: list[str], of_text) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = []
        for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
            if text is not None:
                for row in of_text(unicodedata.normalize("NFC", text)):
                    rows.append((doc_id, *row))
                    if len(rows) >= OUT_ROWS:
                        yield pd.DataFrame(rows, columns=columns)
                        rows = []
        yield pd.DataFrame(rows, columns=columns)


def _texts(docs: DataFrame) -> DataFrame:
    bound_batches(docs.sparkSession)
    return docs.select("doc_id", "text")


_SPAN = "doc_id long, keyword string, match_start long, match_end long, source_start long, source_end long"


def keyword_spans(docs: DataFrame, keywords: list[str], bounded: bool = False) -> DataFrame:
    """A row per occurrence; `bounded` chooses word-bounded, leftmost-longest counting."""
    words = distinct_keywords(keywords)

    def spans(text: str):
        folded, source = _folded(text)
        for key, a, b in bounded_spans(folded, list(words))[0] if bounded else literal_spans(folded, list(words)):
            yield words[key], a, b, source[a], source[b - 1] + 1

    return _texts(docs).mapInPandas(lambda it: _rows(it, [c.split()[0] for c in _SPAN.split(", ")], spans), _SPAN)


def suppressed_spans(docs: DataFrame, keywords: list[str]) -> DataFrame:
    """Word-bounded occurrences that another one keeps out."""
    words = distinct_keywords(keywords)
    schema = "doc_id long, keyword string, match_start long, match_end long, kept_keyword string"
    spans = lambda text: ((words[k], a, b, words[by]) for k, a, b, by in bounded_spans(_folded(text)[0], list(words))[1])
    return _texts(docs).mapInPandas(lambda it: _rows(it, [c.split()[0] for c in schema.split(", ")], spans), schema)


def citations(docs: DataFrame, keywords: list[str]) -> DataFrame:
    """Literal occurrences with their page (that of the last marker line before them; null without one, or if they reach over the next marker), the words before
    and after inside that page, and the source spelling."""
    words = distinct_keywords(keywords)
    schema = "doc_id long, keyword string, match_start long, match_end long, page_number int, citation_before string, citation_keyword string, citation_after string"

    def cited(text: str):
        folded, source = _folded(text)
        marks = [(m.start(), int(m[1])) for m in MARKER.finditer(text)]
        begins = [m[0] for m in marks]
        tokens = [m.span() for m in re.finditer(r"\S+", text)]
        first, last = [t[0] for t in tokens], [t[1] for t in tokens]
        for key, a, b in literal_spans(folded, list(words)):
            start, end = source[a], source[b - 1] + 1
            low, high, page = 0, len(text), None
            at = bisect_right(begins, start) - 1
            if at >= 0:
                bounds = (begins[at], begins[at + 1] if at + 1 < len(begins) else len(text))
                if end <= bounds[1]:
                    (low, high), page = bounds, marks[at][1]
            stop, go = bisect_left(first, start), bisect_right(last, end)
            before = [text[max(x, low) : min(y, start)] for x, y in tokens[max(0, stop - CONTEXT_WORDS) : stop] if y > low]
            after = [text[max(x, end) : min(y, high)] for x, y in tokens[go : go + CONTEXT_WORDS] if x < high]
            yield words[key], a, b, page, " ".join(before), text[start:end], " ".join(after)

    made = _texts(docs).mapInPandas(lambda it: _rows(it, [c.split()[0] for c in schema.split(", ")], cited), schema.replace("page_number int", "page_number double"))
    return made.withColumn("page_number", F.col("page_number").cast("int"))


def in_citation_order(cited: DataFrame, keywords: list[str]) -> DataFrame:
    """Citations with their place in the order of keywords, pages (unknown ones last) and offsets, within each document."""
    order = F.create_map(*[F.lit(x) for i, k in enumerate(distinct_keywords(keywords).values()) for x in (k, i)])
    by = Window.partitionBy("doc_id").orderBy(order[F.col("keyword")], F.col("page_number").asc_nulls_last(), "match_start")
    return cited.withColumn("position", F.row_number().over(by))


def alias_candidates(docs: DataFrame, keywords: list[str], min_words: int = 2) -> DataFrame:
    """Runs of words that equal a keyword of several words but for accents and case, and do not overlap a literal occurrence of that keyword."""
    words = distinct_keywords(keywords)
    by_first = defaultdict(list)
    for key, word in words.items():
        folded = tuple(map(fold_word, word.split()))
        if len(folded) >= min_words:
            by_first[folded[0]].append((key, word, folded))
    schema = "doc_id long, keyword string, observed_text string, match_start long, match_end long"

    def found(text: str):
        if not by_first:
            return
        tokens = [(m.start(), m.end()) for m in _WORD.finditer(text)]
        bare = [fold_word(text[a:b]) for a, b in tokens]
        literal = None
        for i, first in enumerate(bare):
            for key, word, folded in by_first.get(first, ()):
                part = tokens[i : i + len(folded)]
                if tuple(bare[i : i + len(folded)]) != folded or any(not text[x[1] : y[0]].isspace() for x, y in zip(part, part[1:], strict=False)):
                    continue
                start, end = part[0][0], part[-1][1]
                if literal is None:
                    full, source = _folded(text)
                    literal = defaultdict(list)
                    for k, a, b in literal_spans(full, [w[0] for ws in by_first.values() for w in ws]):
                        literal[k].append((source[a], source[b - 1] + 1))
                if text[start:end].casefold() != word.casefold() and not any(a < end and b > start for a, b in literal[key]):
                    yield word, text[start:end], start, end

    return _texts(docs).mapInPandas(lambda it: _rows(it, [c.split()[0] for c in schema.split(", ")], found), schema)


def ruled(candidates: DataFrame, docs: DataFrame, rules: DataFrame) -> DataFrame:
    """Candidates with the first rule (rule_id) of their keyword and spelling whose literal context stands beside them in the same paragraph; others are pending.

    rules: rule_id, keyword, alias (lower case), required_before and required_after (null: none).
    """
    text = candidates.join(docs.select("doc_id", "text"), "doc_id")
    before = F.element_at(F.split(F.substring("text", F.lit(1), F.col("match_start")), r"\r?\n[ \t]*\r?\n"), -1)
    after = F.element_at(F.split(F.expr("substring(text, match_end + 1)"), r"\r?\n[ \t]*\r?\n"), 1)
    squeeze = lambda c: F.regexp_replace(F.lower(c), r"\s+", " ")
    rows = text.select(*candidates.columns, F.rtrim(squeeze(before)).alias("before"), F.ltrim(squeeze(after)).alias("after"))
    both = rows.join(F.broadcast(rules.withColumnRenamed("keyword", "of")), (F.col("keyword") == F.col("of")) & (squeeze(F.col("observed_text")) == F.col("alias")), "left")
    ends = lambda b: F.endswith("before", b) & ~F.substring(F.expr("substring(before, 1, length(before) - length(required_before))"), -1, 1).rlike(r"[\w]")
    begins = lambda b: F.startswith("after", b) & ~F.expr("substring(after, length(required_after) + 1, 1)").rlike(r"[\w]")
    holds = F.col("rule_id").isNotNull() & (F.col("required_before").isNull() | ends(F.col("required_before"))) & (F.col("required_after").isNull() | begins(F.col("required_after")))
    first = both.groupBy(*candidates.columns).agg(F.min(F.when(holds, F.col("rule_id"))).alias("rule_id"))
    return first.withColumn("status", F.when(F.col("rule_id").isNull(), "pending").otherwise("ruled"))
