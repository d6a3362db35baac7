"""Boxes of pages: reading order, rows, graphs of order, and one-to-one matching.

A page is the unit of work; pages are independent and small. The boxes of a page are gathered as arrays in one row, and Arrow batches of pages are worked off in numpy; nothing is
compared across pages."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType


def widest_gap(low: np.ndarray, high: np.ndarray) -> tuple[float, float]:
    """(width, where it begins) of the widest gap in the union of intervals; width 0 without one. Of equal gaps the first."""
    order = np.lexsort((high, low))
    covered = np.maximum.accumulate(high[order])[:-1]
    gaps = low[order][1:] - covered
    if not len(gaps) or gaps.max() <= 0:
        return 0.0, 0.0
    return float(gaps.max()), float(covered[gaps.argmax()])


def by_lines(boxes: np.ndarray, nodes: np.ndarray, tolerance: float = 6.0) -> list[int]:
    """Places of boxes line by line: a line takes boxes whose top is within the tolerance of its first box's, and reads from left to right."""
    nodes = nodes[np.lexsort((nodes, boxes[nodes, 0], boxes[nodes, 1]))]
    out, line = [], []
    for i in nodes:
        if line and boxes[i, 1] - boxes[line[0], 1] > tolerance:
            out += sorted(line, key=lambda k: (boxes[k, 0], k))
            line = []
        line.append(i)
    return out + sorted(line, key=lambda k: (boxes[k, 0], k))


def xy_cut(boxes: np.ndarray, min_gap: float = 3.0, leaf=by_lines) -> list[int]:
    """Reading order: a set of boxes is cut at its widest gap, left of it before right, or above before below (also on a tie), until no gap is wide enough; `leaf` orders the rest."""
    out, open_ = [], [np.arange(len(boxes))] if len(boxes) else []
    while open_:
        nodes = open_.pop()
        (wide, x), (tall, y) = (widest_gap(boxes[nodes, a], boxes[nodes, a + 2]) for a in (0, 1))
        if len(nodes) < 2 or max(wide, tall) < min_gap:
            out += leaf(boxes, nodes)
            continue
        first = boxes[nodes, 2] <= x if wide > tall else boxes[nodes, 3] <= y
        open_ += [nodes[~first], nodes[first]]
    return [int(i) for i in out]


def small_cut(boxes: list[list[float]], min_gap: float = 3.0, tolerance: float = 6.0) -> list[int]:
    """As xy_cut() with lines, for a few boxes, where arrays cost more than they save."""

    def gap(nodes: list[int], axis: int) -> tuple[float, float]:
        spans = sorted((boxes[i][axis], boxes[i][axis + 2]) for i in nodes)
        width, begin, reach = 0.0, 0.0, spans[0][1]
        for low, high in spans[1:]:
            if low - reach > width:
                width, begin = low - reach, reach
            if high > reach:
                reach = high
        return width, begin

    out, open_ = [], [list(range(len(boxes)))] if boxes else []
    while open_:
        nodes = open_.pop()
        if len(nodes) > 1:
            (wide, x), (tall, y) = gap(nodes, 0), gap(nodes, 1)
            if max(wide, tall) >= min_gap:
                side, end = (2, x) if wide > tall else (3, y)
                open_ += [[i for i in nodes if boxes[i][side] > end], [i for i in nodes if boxes[i][side] <= end]]
                continue
            nodes.sort(key=lambda i: (boxes[i][1], boxes[i][0], i))
        line = []
        for i in nodes:
            if line and boxes[i][1] - boxes[line[0]][1] > tolerance:
                out += sorted(line, key=lambda k: (boxes[k][0], k))
                line = []
            line.append(i)
        out += sorted(line, key=lambda k: (boxes[k][0], k))
    return out


#: Boxes of a page up to which small_cut() is taken
SMALL = 48


def _gathered(blocks: DataFrame, page: str, ids: str, boxes: str) -> DataFrame:
    """A row per page with the ids of its boxes in order and their corners, four numbers a box (NaN for a missing one)."""
    nan = F.lit(float("nan"))
    listed = blocks.groupBy(page).agg(F.sort_array(F.collect_list(F.struct("id", "x0", "y0", "x1", "y1"))).alias("b"))
    corners = F.flatten(F.transform("b", lambda x: F.array(*[F.coalesce(x[c].cast("double"), nan) for c in ("x0", "y0", "x1", "y1")])))
    return listed.select(page, F.col("b.id").alias(ids), corners.alias(boxes))


def _boxes(flat) -> np.ndarray:
    return np.asarray(flat if flat is not None else (), float).reshape(-1, 4)


def reading_order(blocks: DataFrame, page: str = "page", min_gap: float = 3.0) -> DataFrame:
    """blocks (page, id, x0, y0, x1, y1) with their position on the page, from 1; blocks without a box come last, by id."""

    def order(pages: pd.Series) -> pd.Series:
        out = []
        for flat in pages:
            if len(flat) <= 4 * SMALL and not np.isnan(flat).any():
                flat = flat.tolist()
                out.append(small_cut([flat[k : k + 4] for k in range(0, len(flat), 4)], min_gap))
                continue
            box = _boxes(flat)
            placed = ~np.isnan(box).any(1)
            at = np.flatnonzero(placed)
            out.append([*at[xy_cut(box[at], min_gap)].tolist(), *np.flatnonzero(~placed).tolist()])
        return pd.Series(out)

    rows = _gathered(blocks, page, "ids", "boxes").withColumn("order", F.pandas_udf(order, "array<int>")("boxes"))
    return rows.select(page, "ids", F.posexplode("order")).select(page, F.element_at("ids", F.col("col") + 1).alias("id"), (F.col("pos") + 1).alias("position"))


def solve_order(nodes: list, edges: list[tuple]) -> tuple[list, list[tuple]]:
    """Nodes in an order that keeps the edges (before, after, score, hard), as near to the given one as they allow. While there is a cycle, its weakest soft edge is left out;
    returns those, too. Nodes on or behind a cycle of hard edges alone come at the end, in the given order."""
    rank = {n: i for i, n in enumerate(nodes)}
    edges, dropped = list(edges), []
    while True:
        after, waiting = {n: [] for n in nodes}, dict.fromkeys(nodes, 0)
        for a, b, *_ in edges:
            after[a].append(b)
            waiting[b] += 1
        ready, out = [rank[n] for n in nodes if not waiting[n]], []
        heapq.heapify(ready)
        while ready:
            node = nodes[heapq.heappop(ready)]
            out.append(node)
            for n in after[node]:
                waiting[n] -= 1
                if not waiting[n]:
                    heapq.heappush(ready, rank[n])
        if len(out) == len(nodes):
            return out, dropped

        def leads(start, goal) -> bool:
            seen, todo = set(), [start]
            while todo:
                node = todo.pop()
                if node == goal:
                    return True
                if node not in seen:
                    seen.add(node)
                    todo += after[node]
            return False

        soft = [e for e in edges if not e[3] and waiting[e[0]] and waiting[e[1]] and leads(e[1], e[0])]
        if not soft:
            return out + [n for n in nodes if n not in set(out)], dropped
        weakest = min(soft, key=lambda e: (e[2], rank[e[0]], rank[e[1]]))
        edges.remove(weakest)
        dropped.append(weakest)


def ordered_by_edges(nodes: DataFrame, edges: DataFrame, group: str) -> DataFrame:
    """nodes (group, id, rank) with their position under edges (group, before, after, score, hard) between nodes of the group, and how many soft edges had to go."""

    def solve(counts: pd.Series, before: pd.Series, after: pd.Series, score: pd.Series, hard: pd.Series) -> pd.DataFrame:
        out = []
        for n, *lists in zip(counts, before, after, score, hard, strict=True):
            listed = [e for e in zip(*(x if x is not None else () for x in lists), strict=True) if e[0] >= 0 and e[1] >= 0]
            order, dropped = solve_order(list(range(n)), listed)
            out.append((order, len(dropped)))
        return pd.DataFrame(out, columns=["order", "dropped"])

    left = nodes.groupBy(group).agg(F.sort_array(F.collect_list(F.struct("rank", "id")))["id"].alias("ids"))
    right = edges.groupBy(F.col(group).alias("_of")).agg(F.array_sort(F.collect_list(F.struct("before", "after", "score", "hard"))).alias("e"))
    place = lambda c: F.transform("e", lambda x: (F.array_position("ids", x[c]) - 1).cast("int"))
    both = left.join(right, F.col(group) == F.col("_of"), "left").select(group, "ids", F.size("ids").alias("n"), place("before").alias("before"), place("after").alias("after"), F.col("e.score").alias("score"), F.col("e.hard").alias("hard"))
    solved = both.withColumn("s", F.pandas_udf(solve, "order array<int>, dropped int")("n", "before", "after", "score", "hard"))
    return solved.select(group, "ids", "s.dropped", F.posexplode("s.order")).select(group, F.element_at("ids", F.col("col") + 1).alias("id"), (F.col("pos") + 1).alias("position"), "dropped")


def assignment(gain: np.ndarray) -> list[tuple[int, int]]:
    """Pairs (row, column) of positive gain of a one-to-one assignment with the greatest sum of gains: shortest augmenting paths with potentials."""
    flip = gain.shape[0] > gain.shape[1]
    cost = -(gain.T if flip else gain).astype(float)
    n, m = cost.shape
    u, v, of = np.zeros(n + 1), np.zeros(m + 1), np.zeros(m + 1, int)  # of: the row (from 1) of each column; column 0 is the start
    for i in range(1, n + 1):
        of[0], j = i, 0
        best, came, done = np.full(m + 1, np.inf), np.zeros(m + 1, int), np.zeros(m + 1, bool)
        while of[j]:
            done[j] = True
            step = cost[of[j] - 1] - u[of[j]] - v[1:]
            nearer = ~done[1:] & (step < best[1:])
            best[1:][nearer], came[1:][nearer] = step[nearer], j
            nxt = int(np.where(done[1:], np.inf, best[1:]).argmin()) + 1
            delta = best[nxt]
            u[of[done]] += delta
            v[done] -= delta
            best[~done] -= delta
            j = nxt
        while j:
            of[j], j = of[came[j]], came[j]
    pairs = [(of[j] - 1, j - 1) for j in range(1, m + 1) if of[j]]
    return sorted((c, r) if flip else (r, c) for r, c in pairs if -cost[r, c] > 0)


def iou_matrix(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    wide = np.minimum(a[:, None, 2], b[None, :, 2]) - np.maximum(a[:, None, 0], b[None, :, 0])
    tall = np.minimum(a[:, None, 3], b[None, :, 3]) - np.maximum(a[:, None, 1], b[None, :, 1])
    both = np.clip(wide, 0, None) * np.clip(tall, 0, None)
    area = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    union = area(a)[:, None] + area(b)[None, :] - both
    return np.divide(both, union, out=np.zeros_like(both), where=union > 0)


def matched_boxes(reference: DataFrame, prediction: DataFrame, page: str = "page", threshold: float = 0.5) -> DataFrame:
    """One-to-one pairs of reference and predicted boxes of a page (page, reference_id, predicted_id, iou) at or above a threshold: as many as can be, then of the greatest total overlap.
    Boxes without a partner have a row, too, with the other id null: misses and false alarms."""

    both = _gathered(reference, page, "ids", "boxes").join(_gathered(prediction, page, "others", "guesses"), page, "full").select(page, "ids", "boxes", "others", "guesses")
    kinds = [f.dataType for f in both.schema]
    schema = StructType([StructField(page, kinds[0]), StructField("reference_id", kinds[1].elementType), StructField("predicted_id", kinds[3].elementType), StructField("iou", DoubleType())])

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pages, ids, boxes, others, guesses = batch.columns
            a, b = (x.flatten().to_numpy(zero_copy_only=False).reshape(-1, 4) for x in (boxes, guesses))
            sizes = [pc.fill_null(pc.list_value_length(x), 0).to_numpy(zero_copy_only=False).astype(np.int64) for x in (ids, others)]
            r, c, iou = matched(a, b, *sizes, threshold)
            alone = [np.setdiff1d(np.arange(len(x)), taken) for x, taken in ((a, r), (b, c))]
            none = [np.zeros(len(x), np.int64) for x in alone]
            at = [np.concatenate(x) for x in ((r, alone[0], none[1]), (c, none[0], alone[1]))]
            missing = [np.repeat([False, False, True], [len(r), *map(len, alone)]), np.repeat([False, True, False], [len(r), *map(len, alone)])]
            of = [np.repeat(np.arange(len(n)), n) for n in sizes]
            on = np.concatenate((of[0][r], of[0][alone[0]], of[1][alone[1]]))
            columns = [pages.take(pa.array(on)), *(x.flatten().take(pa.array(i, mask=m)) for x, i, m in zip((ids, others), at, missing, strict=True))]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(np.concatenate((iou, *map(np.zeros_like, none))).astype(float), mask=missing[0] | missing[1])], names=schema.names)

    return both.mapInArrow(match, schema)


def matched(a: np.ndarray, b: np.ndarray, n: np.ndarray, m: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Pairs (place in a, place in b, overlap) of the boxes of many pages, of which each has n in a and m in b. Where boxes have one candidate at most, it is theirs; other pages are assigned singly."""
    pairs, first, second = n * m, np.cumsum(n) - n, np.cumsum(m) - m
    page = np.repeat(np.arange(len(n)), pairs)
    k = np.arange(len(page)) - (np.cumsum(pairs) - pairs)[page]
    r, c = first[page] + k // np.maximum(m[page], 1), second[page] + k % np.maximum(m[page], 1)
    iou = _ious(a[r], b[c])
    hit = np.flatnonzero(iou >= threshold)
    many = (np.bincount(r[hit], minlength=len(a))[r[hit]] > 1) | (np.bincount(c[hit], minlength=len(b))[c[hit]] > 1)
    unclear = np.unique(page[hit][many])
    hit = hit[~np.isin(page[hit], unclear)]
    found = [(r[hit], c[hit], iou[hit])]
    begins = np.cumsum(pairs) - pairs
    for p in unclear:
        gain = iou[begins[p] : begins[p] + pairs[p]].reshape(n[p], m[p])
        chosen = np.array(assignment(np.where(gain >= threshold, min(gain.shape) + 1 + gain, 0)), int).reshape(-1, 2)
        found.append((first[p] + chosen[:, 0], second[p] + chosen[:, 1], gain[chosen[:, 0], chosen[:, 1]]))
    return tuple(map(np.concatenate, zip(*found, strict=True)))


def _ious(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """iou_matrix() of box by box."""
    wide = np.minimum(a[:, 2], b[:, 2]) - np.maximum(a[:, 0], b[:, 0])
    tall = np.minimum(a[:, 3], b[:, 3]) - np.maximum(a[:, 1], b[:, 1])
    both = np.clip(wide, 0, None) * np.clip(tall, 0, None)
    area = lambda x: (x[:, 2] - x[:, 0]) * (x[:, 3] - x[:, 1])
    union = area(a) + area(b) - both
    return np.divide(both, union, out=np.zeros_like(both), where=union > 0)


def detection_scores(matches: DataFrame, by: list[str] | None = None) -> DataFrame:
    """True and false positives, misses, precision, recall and F1 of matched boxes."""
    tp = F.count_if(F.col("reference_id").isNotNull() & F.col("predicted_id").isNotNull())
    fp, fn = F.count_if(F.col("reference_id").isNull()), F.count_if(F.col("predicted_id").isNull())
    made = matches.groupBy(*(by or [])).agg(tp.alias("tp"), fp.alias("fp"), fn.alias("fn"))
    rate = lambda top, bottom: F.when(bottom > 0, top / bottom)
    t, p, n = F.col("tp"), F.col("fp"), F.col("fn")
    return made.withColumns({"precision": rate(t, t + p), "recall": rate(t, t + n), "f1": rate(2 * t, 2 * t + p + n)})


def region_links(blocks: DataFrame, regions: DataFrame, preferred: list[str]) -> DataFrame:
    """The region of each block (page, id): the one it names (region_id), else the smallest of those that hold its centre, preferred kinds first; without one, an inferred region of its own.

    regions: page, region, kind, x0, y0, x1, y1. A join on the page with the centre as residual.
    """
    b, r = blocks.alias("b"), regions.alias("r")
    inside = ((F.col("b.x0") + F.col("b.x1")) / 2).between(F.col("r.x0"), F.col("r.x1")) & ((F.col("b.y0") + F.col("b.y1")) / 2).between(F.col("r.y0"), F.col("r.y1"))
    pairs = b.join(r, (F.col("b.page") == F.col("r.page")) & (inside | (F.col("b.region_id") == F.col("r.region"))), "left")
    named: Column = F.coalesce(F.col("b.region_id") == F.col("r.region"), F.lit(False))
    area = (F.col("r.x1") - F.col("r.x0")) * (F.col("r.y1") - F.col("r.y0"))
    best = F.min(F.when(F.col("r.region").isNotNull(), F.struct((~named).alias("a"), (~F.col("r.kind").isin(*preferred)).alias("b"), area.alias("c"), F.col("r.region").alias("region"))))
    found = pairs.groupBy(F.col("b.page").alias("page"), F.col("b.id").alias("id")).agg(best.alias("s"))
    return found.select("page", "id", F.coalesce("s.region", F.concat(F.lit("inferred-"), F.col("page"), F.lit("-"), F.col("id"))).alias("region"), F.col("s").isNull().alias("inferred"))
