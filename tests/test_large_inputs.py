"""Cases for steps that once grew too fast in time or memory, beside their plain versions."""

import random
import tracemalloc

import numpy as np
import pandas as pd
from test_layout_queries import plain_alignment

from leafmark.functions import alignment, tables
from leafmark.operators import layout, spans, structure
from leafmark.plans.routing_queries import QUERIES


def test_alignment_of_long_unlike_texts_holds_bits(monkeypatch):
    """a table of moves of a byte each took 131 MB here."""
    rng = random.Random(3)
    a, b = ([rng.choice("abcdefgh") for _ in range(4000)] for _ in range(2))
    tracemalloc.start()
    whole = alignment.aligned(a, b)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 24 << 20
    monkeypatch.setattr(alignment, "TABLE_BITS", 100)
    assert alignment.aligned(a, b) == whole
    for _ in range(200):
        a, b = ([rng.choice("abc") for _ in range(rng.randint(0, 60))] for _ in range(2))
        assert alignment.aligned(a, b) == plain_alignment(a, b)


def test_confusions_are_counted_where_they_are_found_in_many_tasks(spark):
    """a file of one task was aligned in one task, and each confusion left it as a row."""
    pairs = spark.createDataFrame([("đá đá", "da da")] * 9 + [(None, "a"), ("á", None)], "reference string, prediction string").coalesce(1)
    got = {(r.kind, r.char): r.n for r in alignment.confusions(pairs).collect()}
    assert got == {("stroke", "đ"): 18, ("tone", "á"): 18}
    assert alignment._dealt(pairs).rdd.getNumPartitions() >= 64


def test_text_metrics_are_taken_in_many_tasks(spark):
    """a file of one task was aligned in one task."""
    pairs = spark.createDataFrame([(i, "đá " * i, "da " * (i // 2)) for i in range(1, 40)], "id int, reference string, prediction string").coalesce(1)
    made = alignment.text_metrics(pairs, ["id"])
    assert made.rdd.getNumPartitions() >= 64
    assert {r.id: r.chars for r in made.collect()} == {i: 3 * i for i in range(1, 40)}


def test_rendered_tables_go_in_batches(spark):
    """each table was a call of a grouped function; two texts on one place, one of them missing, could not be sorted."""
    rows = [(t, r, c, 1, 1, f"{t}-{r}-{c}") for t in range(3) for r in range(2) for c in range(2)] + [(3, 0, 0, 1, 1, None), (3, 0, 0, 1, 1, "a|b"), (None, 0, 0, 1, 2, "<x>")]
    made = tables.rendered(spark.createDataFrame(rows, "table_id long, row int, col int, row_span int, col_span int, text string"))
    assert "FlatMapGroupsInPandas" not in made._jdf.queryExecution().toString()
    got = {r.table_id: r for r in made.collect()}
    assert (got[1].n_rows, got[1].n_cols, got[1].html) == (2, 2, "<table><tr><th>1-0-0</th><th>1-0-1</th></tr><tr><td>1-1-0</td><td>1-1-1</td></tr></table>")
    assert got[3].markdown == "| a\\|b |\n| ---- |" and got[None].html == '<table><tr><th colspan="2">&lt;x&gt;</th></tr></table>' and tables.html_table([]) == "<table></table>"


def test_trees_of_one_shape_are_compared_at_once_and_as_singly(monkeypatch):
    """a tree was compared in steps of single cells, its structure anew for each table."""
    rng = random.Random(7)

    def table(lines: int):
        return tables.html_table([(r, c, 1, 1, rng.choice(["a", "abc", "", "ab & d", "x" * 70, "y" * 66])) for r in range(lines) for c in range(2)])

    pairs = [(table(3 + k % 2), table(2)) for k in range(40)] + [(None, table(1)), ("<p>", "<table><tr><td>a<td>b</table>")]
    together = tables.all_teds(pairs)
    assert together == [(tables.teds(*p), tables.teds(*p, True)) for p in pairs]
    monkeypatch.setattr(tables, "FEW", 1 << 30)
    assert tables.all_teds(pairs) == together
    assert tables.teds("<table><tr><td>abcd</td></tr></table>", "<table><tr><td>abce</td></tr></table>") == 0.875
    parsed = tables._Trees()
    parsed.feed(pairs[0][0])
    shown = lambda n: (n.tag, n.spans, n.text, [shown(c) for c in n.children])
    assert shown(parsed.tables[0]) == shown(tables.trees(pairs[0][0])[0])
    for a, b in (("", ""), ("", "ab"), ("kitten", "sitting"), ("x" * 70, "x" * 69 + "y")):
        assert tables._edits(a, b) == sum(i is None or j is None or a[i] != b[j] for i, j in alignment.aligned(list(a), list(b)))


def test_pages_are_matched_together_and_as_singly(spark):
    """a page was a call of its own; now only pages where a box has a choice are."""
    rng = np.random.default_rng(4)
    n, m = rng.integers(0, 5, 300), rng.integers(0, 5, 300)
    box = lambda k: np.hstack([lo := rng.integers(0, 12, (k, 2)).astype(float), lo + rng.integers(4, 12, (k, 2))])
    a, b = box(n.sum()), box(m.sum())
    want = set()
    for p, (x, y) in enumerate(zip(np.cumsum(n) - n, np.cumsum(m) - m, strict=True)):
        iou = layout.iou_matrix(a[x : x + n[p]], b[y : y + m[p]])
        pairs = layout.assignment(np.where(iou >= 0.5, min(iou.shape) + 1 + iou, 0)) if iou.size else []
        want |= {(x + r, y + c, iou[r, c]) for r, c in pairs}
    assert set(zip(*layout.matched(a, b, n, m, 0.5), strict=True)) == want and len(want) > 20


def test_small_pages_are_cut_as_large_ones():
    """arrays for four boxes cost more than they saved."""
    rng = np.random.default_rng(2)
    for _ in range(1500):
        k = int(rng.integers(0, 12))
        low = rng.integers(0, 40, (k, 2))
        boxes = np.hstack([low, low + rng.integers(0, 15, (k, 2))]).astype(float)
        assert layout.small_cut(boxes.tolist()) == layout.xy_cut(boxes)


def test_average_precision_where_no_pair_reaches_a_threshold(spark):
    """Ten rows left the window for each prediction; now those of hits alone, and a threshold without hits still counts as 0."""
    schema = "page int, id int, kind string, x0 double, y0 double, x1 double, y1 double"
    have = spark.createDataFrame([(1, 1, "a", 0.0, 0.0, 10.0, 10.0), (2, 1, "b", 0.0, 0.0, 10.0, 10.0)], schema)
    guess = spark.createDataFrame([(1, 7, "a", 0.0, 0.0, 10.0, 7.2, 0.9), (1, 8, "a", 0.0, 0.0, 10.0, 7.1, 0.8), (2, 7, "b", 50.0, 0.0, 60.0, 10.0, 0.9)], schema + ", score double")
    got = {r.kind: r for r in structure.average_precision(have, guess).collect()}
    assert (got["a"].ap_50, got["a"].ap_50_95, got["b"].ap_50, got["b"].ap_50_95) == (1.0, 0.5, 0.0, 0.0)
    boxes = [[0.0, 0.0, 4.0, 4.0], [1.0, 1.0, 3.0, 9.0], [2.0, 2.0, 2.0, 2.0]]
    assert structure.few_ious(boxes, boxes) == layout.iou_matrix(np.array(boxes), np.array(boxes)).tolist()


def test_found_rows_leave_in_pieces():
    """all rows of a batch of texts were held until its end."""
    batch = pd.DataFrame({"doc_id": [1, 2, 3], "text": ["a" * 12_000, None, "a"]})
    made = list(spans._rows(iter([batch]), ["doc_id", "at"], lambda text: ((i,) for i in range(len(text)))))
    assert max(map(len, made)) == spans.OUT_ROWS and pd.concat(made).values.tolist() == [[1, i] for i in range(12_000)] + [[3, 0]]


def test_batches_are_cut_by_bytes(spark):
    """ten thousand texts were sent to a worker at once, however long."""
    QUERIES["reading_order_accuracy"](spark, "/root/testdata/sf0.001")
    assert 0 < int(spark.conf.get("spark.sql.execution.arrow.maxBytesPerBatch")) <= 4 << 20
