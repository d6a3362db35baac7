"""Lines, headings, totals, cells and ranked boxes: cases, and plain versions where there is no SQL."""

import random

from pyspark.sql import functions as F

from leafmark.functions import headings
from leafmark.operators import structure


def test_heading_functions(spark):
    texts = ["- a", "-5 a", "– 5", "•", "+ x", "1. Tổng quan ..... 12", "Phụ lục A Ghi CHÚ", None, "", "The Board", "The Bộ", "ab ü"]
    rows = spark.createDataFrame(list(enumerate(texts)), "i int, t string").select("i", headings.is_bullet(F.col("t")).alias("b"), headings.title_key(F.col("t")).alias("k"), headings.is_english(F.col("t")).alias("e")).orderBy("i").collect()
    assert [r.b for r in rows] == [True, False, False, True, True] + [False] * 7
    assert [r.k for r in rows[5:9]] == ["tổng quan", "ghi chú", "", ""] and [r.e for r in rows[9:]] == [True, False, False]
    reason = headings.heading_rejection(F.col("t"), [F.col("b")], F.col("p"), F.lit(None))
    cases = [("Nguyễn Văn An", "Giám đốc", True, "person_name"), ("Nguyễn Văn An", "Giám đốcx", True, None), ("12 triệu", "", True, "amount_or_number"), ("1. 12 triệu", "", True, "amount_or_number"), ("IV. 1.234 x", "", True, "mostly_digits"), ("x", "", False, "unplaced"), (None, None, True, "amount_or_number"), ("Ngày 3 tháng 4", None, True, "date")]
    got = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, t string, b string, p boolean").select("i", reason.alias("r")).orderBy("i").collect()
    assert [r.r for r in got] == [c[3] for c in cases]


def test_paragraphs_without_boxes_and_over_pages(spark):
    rows = [(1, 1, 1, "a", "p", 0.0, 0.0, 9.0, 10.0, None, "an open"), (1, 2, 2, "a", "p", 0.0, 0.0, 9.0, 10.0, None, "sentence"), (1, 3, 2, "a", "p", 0.0, None, 9.0, 10.0, None, "and"), (1, 4, 4, "a", "p", 0.0, 0.0, 9.0, 10.0, None, "so on"), (2, 1, 1, None, None, 0.0, 0.0, 9.0, 10.0, None, None)]
    frame = spark.createDataFrame(rows, "doc int, n int, page int, place string, kind string, x0 double, y0 double, x1 double, y1 double, size double, text string")
    assert {(r.doc, r.n): r.paragraph for r in structure.paragraphs(frame).collect()} == {(1, 1): 1, (1, 2): 1, (1, 3): 2, (1, 4): 3, (2, 1): 1}
    assert structure.paragraphs(frame.limit(0)).count() == 0


def test_heading_levels(spark):
    h = [(1, None, "keyword", [1], 1), (2, None, "arabic", [1], None), (3, None, "arabic", [1, 1], None), (4, None, "arabic", [1, 1, 1, 1], None), (5, None, "arabic", [2], None), (6, 3.0, None, None, None), (7, 1.0, None, None, None), (8, None, "keyword", [2], 3), (9, 1.7, "roman", [1], None), (10, None, "roman", [2], None)]
    frame = spark.createDataFrame([(7, *x) for x in h], "doc int, n int, ratio double, kind string, path array<int>, rank int")
    assert [r.level for r in structure.heading_levels(frame).orderBy("n").collect()] == [1, 2, 3, 4, 2, 1, 2, 2, 2, 2]
    assert structure.heading_levels(frame.limit(0)).count() == 0


def test_balance_pairs_against_a_search(spark):
    rng = random.Random(5)
    rows, want = [], set()
    for doc in range(40):
        page, items = 1, []
        for i in range(rng.randint(1, 12)):
            page += rng.choice([0, 0, 1, 2])
            items.append((doc, i, page, rng.choice(["assets", "equity"])))
        used = set()
        for _, i, p, side in items:
            if side == "equity":
                near = [j for _, j, q, s in items if s == "assets" and j < i and j not in used and 0 <= p - q <= 1]
                used |= {max(near)} if near else set()
                want.add((doc, max(near) if near else None, i))
        want |= {(doc, i, None) for _, i, _, s in items if s == "assets" and i not in used}
        rows += items
    frame = spark.createDataFrame(rows, "doc int, id long, page int, side string")
    assert set(map(tuple, structure.balance_pairs(frame).collect())) == want


def plain_ap(reference, prediction, least):
    iou = lambda a, b: (lambda i: i / ((a[2] - a[0]) * (a[3] - a[1]) + (b[2] - b[0]) * (b[3] - b[1]) - i))(max(min(a[2], b[2]) - max(a[0], b[0]), 0) * max(min(a[3], b[3]) - max(a[1], b[1]), 0))
    taken, curve, hits = set(), [], 0
    for seen, (page, _, _, box) in enumerate(sorted(prediction, key=lambda p: (-p[2], p[0], p[1])), 1):
        best = max(((iou(box, b), -i, (p, i)) for p, i, b in reference if p == page and (p, i) not in taken), default=(0, 0, None))
        if best[0] >= least and best[2]:
            taken.add(best[2])
            hits += 1
        curve.append((hits / len(reference), hits / seen))
    return sum(max((p for r, p in curve if r >= k * 0.01), default=0.0) for k in range(101)) / 101


def test_average_precision_against_a_plain_version(spark):
    rng = random.Random(11)
    box = lambda: (lambda x, y: (x, y, x + rng.uniform(5, 20), y + rng.uniform(5, 20)))(rng.uniform(0, 60), rng.uniform(0, 60))
    reference = [(p, i, k, box()) for k in ("a", "b") for p in range(12) for i in range(5)]
    prediction = [(p, 50 + i, k, tuple(v + rng.uniform(-3, 3) for v in b), round(rng.random(), 2)) for p, i, k, b in reference if rng.random() < 0.8] + [(p, 90, "a", box(), round(rng.random(), 2)) for p in range(15)] + [(1, 1, "c", box(), 0.5)]
    reference += [(1, 1, "d", box())]
    got = {r.kind: r for r in structure.average_precision(
        spark.createDataFrame([(p, i, k, *b) for p, i, k, b in reference], "page int, id int, kind string, x0 double, y0 double, x1 double, y1 double"),
        spark.createDataFrame([(p, i, k, *b, s) for p, i, k, b, s in prediction], "page int, id int, kind string, x0 double, y0 double, x1 double, y1 double, score double")).collect()}
    for k in ("a", "b"):
        have, guess = [(p, i, b) for p, i, kk, b in reference if kk == k], [(p, i, s, b) for p, i, kk, b, s in prediction if kk == k]
        aps = [plain_ap(have, guess, t) for t in structure.THRESHOLDS]
        assert (got[k].ap_50, got[k].ap_50_95) == (round(aps[0], 4), round(sum(aps) / 10, 4))
    assert (got["c"].ap_50, got["c"].total_gt, got["d"].ap_50, got["d"].total_preds) == (None, 0, 0.0, 0)
