"""Captions, contents entries, sections and reviews: cases, and plain versions where there is no SQL."""

import difflib
import random

from leafmark.operators import evidence

BOX = "page int, id long, section int, x0 double, y0 double, x1 double, y1 double"


def test_figure_captions_against_a_search(spark):
    rng = random.Random(2)
    box = lambda w, h: (lambda x, y: (x, y, x + w, y + h))(rng.uniform(0, 200), rng.uniform(0, 400))
    frames = [(p, i, 1, *box(90, 60)) for p in range(15) for i in range(4)]
    blocks = [(p, 10 + i, 1, *box(60, 10), rng.choice(["Hình 1: a", "Figure 2- b", "text", "hình x"])) for p in range(15) for i in range(9)]
    held = lambda b, f: f[3] - 2 <= (b[3] + b[5]) / 2 <= f[5] + 2 and f[4] - 2 <= (b[4] + b[6]) / 2 <= f[6] + 2
    want, taken = set(), set()
    for f in frames:
        options = []
        for b in blocks:
            if b[0] == f[0] and b[7][:6] in ("Hình 1", "Figure") and (b[0], b[1]) not in taken and not any(held(b, g) for g in frames if g[0] == b[0]):
                gap = b[4] - f[6] if b[4] >= f[6] else f[4] - b[6]
                if (min(b[5], f[5]) - max(b[3], f[3])) / min(b[5] - b[3], f[5] - f[3]) >= 0.3 and 0 <= gap <= 60:
                    options.append((gap, b[1], "below" if b[4] >= f[6] else "above"))
        if options:
            gap, caption, side = min(options)
            taken.add((f[0], caption))
            want.add((f[0], f[1], caption, side, round(gap, 2)))
    got = evidence.figure_captions(spark.createDataFrame(blocks, BOX + ", text string"), spark.createDataFrame(frames, BOX), 60.0, 0.3)
    assert set(map(tuple, got.collect())) == want and len(want) > 5


def test_table_captions_need_a_free_way(spark):
    frames = [(1, 1, 1, 0.0, 50.0, 100.0, 90.0), (2, 1, 1, 0.0, 50.0, 100.0, 90.0), (3, 1, 1, 0.0, 50.0, 100.0, 90.0)]
    blocks = [(1, 5, 1, 0.0, 30.0, 90.0, 40.0, "Bảng 1: x"), (2, 5, 1, 0.0, 10.0, 90.0, 20.0, "Table 1. x"), (2, 6, 1, 0.0, 30.0, 90.0, 40.0, "between"), (3, 5, 1, 0.0, 30.0, 90.0, 40.0, "Bảng 1: x"), (3, 6, 1, 0.0, 95.0, 90.0, 99.0, "Biểu đồ 1: x")]
    got = evidence.table_captions(spark.createDataFrame(blocks, BOX + ", text string"), spark.createDataFrame(frames, BOX), 60.0)
    assert list(map(tuple, got.collect())) == [(1, 1, 5, "above", 10.0)]


def test_contents_entries(spark):
    rows = [(1, 1, "Tổng quan .... 5", 0, 0, 90, 10), (1, 2, "Quản trị", 0, 20, 50, 30), (1, 3, "17", 80, 20, 90, 30), (1, 4, "Nhân sự", 0, 21, 50, 31), (1, 5, "9", 60, 21, 70, 31), (1, 6, "đứng", 0, 0, 5, 90), (1, 7, None, None, None, None, None), (1, 8, "Năm", 0, 60, 50, 70)]
    frame = spark.createDataFrame([(*r[:3], *(None if v is None else float(v) for v in r[3:])) for r in rows], "page int, id long, text string, x0 double, y0 double, x1 double, y1 double")
    assert sorted(map(tuple, evidence.contents_entries(frame).collect())) == [(1, 1, None, "tổng quan", 5), (1, 2, 5, "quản trị", 9), (1, 4, 3, "nhân sự", 17)]
    assert evidence.contents_entries(frame.limit(0)).count() == 0


def test_contents_matches_against_all_ratios(spark):
    rng = random.Random(4)
    word = lambda: "".join(rng.choice("abc ") for _ in range(rng.randint(0, 14))).strip()
    heads = [(d, i, 10 + i, word()) for d in range(6) for i in range(8)]
    entries = [(d, i, (h[3][1:] + "a") if rng.random() < 0.3 else h[3], h[2] - (3 if i % 4 else 1)) for d in range(6) for i, h in enumerate(x for x in heads if x[0] == d)]
    want = set()
    for d in range(6):
        found = []
        for _, n, page, t in (h for h in heads if h[0] == d):
            best = max(((difflib.SequenceMatcher(None, t, e[2]).ratio() if t and e[2] else 0.0, -e[1], e[3]) for e in entries if e[0] == d), default=(0,))
            if best[0] >= 0.88:
                found.append((d, n, round(best[0], 9), best[2], page - best[2]))
        steps = [f[4] for f in found]
        common = max(dict.fromkeys(steps), key=steps.count) if len(steps) >= 3 else None
        want |= {(*f[:4], common if common is not None and steps.count(common) >= 0.6 * len(steps) else None) for f in found}
    got = evidence.contents_matches(spark.createDataFrame(heads, "doc int, n long, page int, title string"), spark.createDataFrame(entries, "doc int, k int, title string, printed int"))
    assert {(r.doc, r.n, round(r.ratio, 9), r.printed, r.page_offset) for r in got.collect()} == want


def test_reports_and_marks(spark):
    reports = spark.createDataFrame([(1, "a", 2, 2), (1, "x", 0, 2), (2, "a", -1, None), (2, "b", 0, -1)], "doc_id int, keyword string, n long, total long")
    counted = spark.createDataFrame([(1, "a", 2), (2, "a", 1)], "doc_id int, keyword string, n long")
    got = sorted(map(str, (tuple(r) for r in evidence.report_faults(reports, counted, ["a", "b"]).collect())))
    assert got == ["(1, 'b', 'missing_keyword')", "(1, 'x', 'extra_keyword')", "(2, 'a', 'negative_count')"]
    marks = spark.createDataFrame([("a", "1"), ("../b", "1"), ("c", "2"), ("d", None)], "path string, sha256 string")
    files = spark.createDataFrame([("a", "1"), ("../b", "1"), ("c", "3"), ("e", "1")], "path string, sha256 string")
    assert sorted(map(tuple, evidence.completion_faults(marks, files).collect())) == [("../b", "unsafe"), ("c", "changed"), ("d", "absent"), ("e", "unlisted")]
