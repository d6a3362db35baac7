"""Spans, alignments, bounds, boxes and tables against plain versions."""

import itertools
import random
import re
import unicodedata

import numpy as np
import pytest
from pyspark.sql import functions as F

from leafmark.functions import alignment, bounds, numbers, tables
from leafmark.functions.text import is_connector_line, is_inside_number, is_page_number, joined_lines, repeated_tail
from leafmark.operators import layout, spans
from leafmark.plans.layout_queries import ORACLE_SQL, QUERIES

SF = "/root/testdata/sf0.001"


def folded(text):
    return unicodedata.normalize("NFC", text).casefold()


def plain_bounded(text, keywords):
    text, found = folded(text), []
    letter = lambda c: c.isalnum() or "̀" <= c <= "ͯ"
    for rank, k in enumerate(keywords):
        k = folded(k)
        for i in range(len(text) - len(k) + 1):
            j = i + len(k)
            if text[i:j] == k and not (letter(k[0]) and i and letter(text[i - 1])) and not (letter(k[-1]) and j < len(text) and letter(text[j])):
                found.append((i, -(j - i), rank, keywords[rank]))
    kept, reach = [], 0
    for i, size, _, k in sorted(found):
        if i >= reach:
            kept.append((k, i, i - size))
            reach = i - size
    return kept


def test_bounded_matches_against_a_plain_scan(spark):
    rng = random.Random(3)
    words = ["a", "aa", "a b", "b a", "ß", "_a", "a.", "B a b"]
    texts = ["".join(rng.choice(["a", "aa", "b", " ", ".", "ß", "_", "B"]) for _ in range(40)) for _ in range(150)] + [None, "", "ssa SS ß"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {}
    for r in spans.keyword_spans(frame, words, bounded=True).collect():
        got.setdefault(r.doc_id, []).append((r.keyword, r.match_start, r.match_end))
    assert {i: sorted(plain_bounded(t, words)) for i, t in enumerate(texts) if t and plain_bounded(t, words)} == {i: sorted(v) for i, v in got.items()}
    lost = spans.suppressed_spans(spark.createDataFrame([(1, "a b a")], "doc_id long, text string"), ["a", "a b"]).collect()
    assert [(r.keyword, r.match_start, r.kept_keyword) for r in lost] == [("a", 0, "a b")]


def test_citations(spark):
    text = "# Trang 1\nStraße " + unicodedata.normalize("NFD", "HỌC MÁY") + " one two three four five six seven eight nine ten eleven\n# Trang 2\nhọc máy."
    frame = spark.createDataFrame([(1, text), (2, "no marker học máy"), (3, None)], "doc_id long, text string")
    rows = spans.in_citation_order(spans.citations(frame, ["SS", "học máy", "học máy", " "]), ["SS", "học máy"]).orderBy("doc_id", "position").collect()
    assert [(r.doc_id, r.keyword, r.page_number, r.citation_keyword) for r in rows] == [(1, "SS", 1, "ß"), (1, "học máy", 1, "HỌC MÁY"), (1, "học máy", 2, "học máy"), (2, "học máy", None, "học máy")]
    assert rows[1].citation_before == "# Trang 1 Straße" and rows[1].citation_after == "one two three four five six seven eight nine ten"
    assert (rows[0].citation_before, rows[0].citation_after.split()[0]) == ("# Trang 1 Stra", "e") and (rows[2].citation_before, rows[2].citation_after) == ("# Trang 2", ".")
    found = QUERIES["citations"](spark, SF).limit(2000).collect()
    marked = {r.doc_id: "\n".join(f"# Trang {i}\n{x}" for i, x in enumerate(r.text.split("\n"), 1)) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    for r in found:
        t = marked[r.doc_id]
        heads = [m for m in re.finditer(r"(?m)^# Trang ([0-9]+)$", t) if m.start() <= t.find(r.citation_keyword) or True]
        source = [i for i, c in enumerate(t) for _ in c.casefold()]
        start, end = source[r.match_start], source[r.match_end - 1] + 1
        at = max((m for m in heads if m.start() <= start), key=lambda m: m.start())
        stop = min([m.start() for m in heads if m.start() > start], default=len(t))
        assert t[start:end] == r.citation_keyword and int(at[1]) == r.page_number
        assert r.citation_before == " ".join(t[at.start() : start].split()[-10:]) and r.citation_after == " ".join(t[end:stop].split()[:10])


def test_aliases_and_rules(spark):
    text = "Hoc may và học máy.\n\nUse hoc  may now\n\nHỌC\nMAY; hoc-may"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    found = spans.alias_candidates(frame, ["học máy", "máy"])
    assert [(r.observed_text, r.match_start) for r in found.orderBy("match_start").collect()] == [("Hoc may", 0), ("hoc  may", text.index("hoc  may")), ("HỌC\nMAY", text.index("HỌC\n"))]
    rules = spark.createDataFrame([(1, "học máy", "hoc may", "use", None), (2, "học máy", "hoc may", None, "và"), (3, "học máy", "hoc may", "se", "now")], "rule_id int, keyword string, alias string, required_before string, required_after string")
    got = {r.match_start: (r.rule_id, r.status) for r in spans.ruled(found, frame, rules).collect()}
    assert got == {0: (2, "ruled"), text.index("hoc  may"): (1, "ruled"), text.index("HỌC\n"): (None, "pending")}


def plain_alignment(a, b):
    d = np.zeros((len(a) + 1, len(b) + 1), int)
    d[:, 0], d[0] = range(len(a) + 1), range(len(b) + 1)
    for i, j in itertools.product(range(1, len(a) + 1), range(1, len(b) + 1)):
        d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
    i, j, out = len(a), len(b), []
    while i or j:
        if i and j and d[i, j] == d[i - 1, j - 1] + (a[i - 1] != b[j - 1]):
            i, j = i - 1, j - 1
            out.append((i, j))
        elif i and d[i, j] == d[i - 1, j] + 1:
            i -= 1
            out.append((i, None))
        else:
            j -= 1
            out.append((None, j))
    return out[::-1]


def test_alignment_against_the_whole_table():
    rng = random.Random(5)
    for _ in range(300):
        a, b = ("".join(rng.choice("abc") for _ in range(rng.randint(0, 60))) for _ in range(2))
        assert alignment.aligned(list(a), list(b)) == plain_alignment(a, b), (a, b)
    a = "x" * 3000
    assert len(alignment.aligned(list(a), list(a[:1500] + "y" + a[1500:]))) == 3001


def test_text_metrics(spark):
    rows = [(1, "ộ", "ẹ"), (2, "người", "ngi"), (3, "đá ở", None), (4, None, "x"), (5, "", "é"), (6, "ma má", "ma ma"), (7, "a", "á")]
    got = {r.id: r for r in alignment.text_metrics(spark.createDataFrame(rows, "id int, reference string, prediction string"), ["id"]).collect()}
    assert (got[1].der_errors, got[1].slots, got[1].dser_errors, got[1].base_mismatch_slots) == (2, 2, 0, 2)
    assert got[2].deleted_slots == 3 and got[3].deletions == 4 and got[3].wer == 1 and got[4].chars is None and got[5].cer is None and got[5].insertions == 1
    assert (got[6].dser_errors, got[6].slots, got[6].word_edits, got[6].wer) == (1, 1, 1, 0.5) and (got[7].spurious_marks, got[7].dser) == (1, None)
    top = alignment.confusions(spark.createDataFrame([("đá", "da"), ("má", "mà")], "reference string, prediction string")).collect()
    assert sorted((r.kind, r.reference_value, r.predicted_value, r.n) for r in top) == [("stroke", "bar", "none", 1), ("tone", "acute", "grave", 1), ("tone", "acute", "none", 1)]
    counts = spark.createDataFrame([("đường Đ ộ a",)], "text string").select(*[c.alias(n) for n, c in alignment.slot_counts(F.col("text")).items()]).first()
    assert tuple(counts) == (3, 2, 2)


def test_exact_bounds(spark):
    assert bounds.least_trials(0, 1e-4) == 29956 and bounds.least_trials(0, 1e-4, 0.99) == 46050
    assert bounds.holds(0, 29956, 1e-4) and not bounds.holds(0, 29955, 1e-4)
    for k, n in ((1, 20), (5, 60), (20, 1000)):
        p = bounds.upper_bound(k, n)
        from math import comb

        assert sum(comb(n, x) * p**x * (1 - p) ** (n - x) for x in range(k + 1)) == pytest.approx(0.05, abs=1e-9)
        assert bounds.upper_bound(k, bounds.least_trials(k, 0.01)) <= 0.01 < bounds.upper_bound(k, bounds.least_trials(k, 0.01) - 1)
    rows = [(0, 29956, None), (2, 10_000, None), (0, 0, None), (0, 40_000, 2.0), (0, 90_000, 2.0), (1, 90_000, 0.5)]
    got = bounds.gated(spark.createDataFrame(rows, "errors long, trials long, effect double")).collect()
    assert [r.status for r in got] == ["PASS", "FAIL", "NOT_EVALUATED", "NOT_EVALUATED", "PASS", "NOT_EVALUATED"]
    assert [r.reason for r in got][2:4] == ["NO_REFERENCE_SLOTS", "INSUFFICIENT_SLOTS_FOR_BOUND"] and got[5].reason == "INVALID_DESIGN_EFFECT"
    frame = spark.createDataFrame([(i, "a", float(i % 10)) for i in range(400)], "id int, g string, v double")
    a, b = (bounds.bootstrap_mean(frame.repartition(k), ["g"], F.col("v"), draws=300).first() for k in (1, 5))
    assert tuple(a)[:2] == tuple(b)[:2] and a.low == pytest.approx(b.low) and a.low < a.mean == 4.5 < a.high and 0.4 < a.high - a.low < 0.8


def test_reading_order_of_two_columns(spark):
    boxes = [("t", 0, 0, 200, 10), ("l1", 0, 20, 90, 30), ("l2", 0, 32, 90, 42), ("r1", 110, 20, 200, 30), ("r2", 110, 33, 200, 43), ("none", None, None, None, None)]
    frame = spark.createDataFrame([(1, n, *[None if v is None else float(v) for v in b]) for n, *b in boxes], "page int, id string, x0 double, y0 double, x1 double, y1 double")
    assert [r.id for r in layout.reading_order(frame).orderBy("position").collect()] == ["t", "l1", "l2", "r1", "r2", "none"]
    assert layout.xy_cut(np.array([[0, 0, 1, 1], [5, 0, 6, 1], [0, 5, 1, 6], [5, 5, 6, 6]], float)) == [0, 1, 2, 3]
    rows = QUERIES["reading_order"](spark, SF).groupBy("page").agg(F.sort_array(F.collect_list("position")).alias("p")).collect()
    assert all(r.p == list(range(1, len(r.p) + 1)) for r in rows)


def test_assignment_against_all_permutations():
    rng = np.random.default_rng(1)
    for _ in range(200):
        n, m = map(int, rng.integers(1, 6, 2))
        gain = np.where(rng.random((n, m)) < 0.4, 0, rng.random((n, m)).round(2))
        best = max(sum(gain[r, c] for r, c in zip(rows, cols, strict=True)) for k in [min(n, m)] for rows in itertools.combinations(range(n), k) for cols in itertools.permutations(range(m), k))
        pairs = layout.assignment(gain)
        assert sum(gain[p] for p in pairs) == pytest.approx(best) and len({r for r, _ in pairs}) == len({c for _, c in pairs}) == len(pairs)


def test_box_matches(spark):
    schema = "page int, id long, x0 double, y0 double, x1 double, y1 double"
    ref = spark.createDataFrame([(1, 1, 0.0, 0.0, 10.0, 10.0), (1, 2, 0.0, 20.0, 10.0, 30.0), (2, 3, 0.0, 0.0, 1.0, 1.0)], schema)
    pred = spark.createDataFrame([(1, 8, 0.0, 1.0, 10.0, 11.0), (1, 9, 0.0, 2.0, 10.0, 12.0), (3, 7, 0.0, 0.0, 1.0, 1.0)], schema)
    got = sorted(((r.page, r.reference_id, r.predicted_id) for r in layout.matched_boxes(ref, pred).collect()), key=str)
    assert got == [(1, 1, 8), (1, 2, None), (1, None, 9), (2, 3, None), (3, None, 7)]
    assert tuple(layout.detection_scores(layout.matched_boxes(ref, pred)).first()) == (1, 2, 2, 1 / 3, 1 / 3, 1 / 3)


def test_order_graph(spark):
    assert layout.solve_order(list("abc"), [("c", "a", 1.0, True)]) == (["b", "c", "a"], [])
    order, dropped = layout.solve_order(list("abc"), [("a", "b", 0.5, False), ("b", "a", 0.2, False), ("b", "c", 0.1, False)])
    assert order == ["a", "b", "c"] and dropped == [("b", "a", 0.2, False)]
    assert layout.solve_order(list("ab"), [("a", "b", 1.0, True), ("b", "a", 1.0, True)]) == (["a", "b"], [])
    nodes = spark.createDataFrame([(1, "x", 1), (1, "y", 2), (2, "z", 1)], "page int, id string, rank int")
    edges = spark.createDataFrame([(1, "y", "x", 1.0, True), (1, "y", "elsewhere", 1.0, True)], "page int, before string, after string, score double, hard boolean")
    assert sorted((r.page, r.id, r.position) for r in layout.ordered_by_edges(nodes, edges, "page").collect()) == [(1, "x", 2), (1, "y", 1), (2, "z", 1)]


def test_tables():
    cells = [(0, 0, 1, 2, "a|b"), (1, 0, 1, 1, "x"), (1, 1, 1, 1, "1.000"), (2, 0, 1, 1, ""), (3, 1, 1, 1, "(2)"), (3, 2, 1, 1, None)]
    lines = tables.grid(cells)
    assert lines == [["a|b", ""], ["x", "1.000"], ["", "(2)"]] and tables.grid([]) == []
    assert tables.pipe_table(lines).split("\n") == ["| a\\|b |       |", "| ---- | ----: |", "| x    | 1.000 |", "|      |   (2) |"]
    page = tables.html_table(cells)
    assert 'colspan="2"' in page and [len(r.children) for r in tables.trees(page)[0].children] == [1, 2, 1, 2]
    a = "<table><tr><td>ab</td><td>c</td></tr></table>"
    assert tables.teds(a, a) == 1 and tables.teds(a, "") == 0 and tables.teds(a, a.replace(">ab", ">xb")) == round(1 - 0.5 / 3, 4)
    assert tables.teds(a, a.replace(">ab", ">xb"), True) == 1 and tables.teds(a, a.replace("<td>c</td>", "")) == round(1 - 1 / 3, 4)
    assert tables.teds(a, a.replace("<td>c", '<td colspan="2">c')) == round(1 - 1 / 3, 4)


def test_amounts_lines_and_predicates(spark):
    amounts = {"(1.234)": -1234, "–": 0, "12,5%": None, "(5": None, "5)": None, "+7": 7, "–7": -7, "−7": -7, "12 34": None, "12 345": 12345, "": None, "1.2.3": None, "1.234,5": 1234.5, "abc": None, "- 8": -8}
    frame = spark.createDataFrame([(t,) for t in amounts] + [(None,)], "t string")
    got = {r.t: r.a for r in frame.select("t", numbers.parse_amount(F.col("t"), F.lit("vn")).alias("a")).collect()}
    assert {t: v if v is None else float(v) for t, v in got.items()} == {**amounts, None: None}
    groups = {"vn": ["1.234", "1,5"], "en": ["1,234"], "plain": ["55", "x"], "ambiguous": ["1.234", "1.5"]}
    rows = spark.createDataFrame([(g, t) for g, ts in groups.items() for t in ts], "g string, t string")
    assert all(r.g == r.c for r in rows.groupBy("g").agg(numbers.convention(F.col("t")).alias("c")).collect())
    lines = {"civil": (False, False), "ill": (False, False), "xiv / 20": (True, False), "Trang MCM": (True, False), "": (False, True), "- 3 -": (False, False), "l | -": (False, True), "12345": (False, False)}
    assert {r.t: (r.p, r.c) for r in spark.createDataFrame([(t,) for t in lines], "t string").select("t", is_page_number(F.col("t")).alias("p"), is_connector_line(F.col("t")).alias("c")).collect()} == lines
    odd = spark.createDataFrame([("1.50 x 50,7 y 50", "a so we so we so we")], "t string, r string")
    row = odd.select(*[is_inside_number(F.col("t"), F.lit(a), F.lit(a + 2)).alias(f"n{a}") for a in (2, 7, 14)], repeated_tail(F.col("r")).alias("r"), joined_lines(F.array(*map(F.lit, ["exam-", "ple of", " ", "X-", "Ray"]))).alias("j")).first()
    assert tuple(row) == (True, True, False, "a so we", "example of X- Ray")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_queries_without_sql_run(spark, name):
    assert QUERIES[name](spark, SF).count() > 0
