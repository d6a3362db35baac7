"""Tables as cells (row, col, row_span, col_span, text): grids, renderings, trees, edit similarity and stitching over pages.

A table is a group of cells; groups are small and independent. The cells of a table are gathered as arrays in one row, and Arrow batches of tables are worked off.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def grid(cells: list[tuple[int, int, int, int, str]]) -> list[list[str]]:
    """The texts of a table by place. A spanning cell fills its first place; of two cells on one place the earlier stays; rows and columns without any text are left out."""
    if not cells:
        return []
    rows = max(r + max(1, rs) for r, _, rs, _, _ in cells)
    cols = max(c + max(1, cs) for _, c, _, cs, _ in cells)
    out = [[""] * cols for _ in range(rows)]
    for r, c, _, _, text in sorted(cells, key=_placed):
        out[r][c] = out[r][c] or (text or "").strip()
    used = [j for j in range(cols) if any(line[j] for line in out)]
    return [[line[j] for j in used] for line in out if any(line)]


def right_aligned(values: list[str]) -> bool:
    """A column of which most filled cells are numbers."""
    filled = [v for v in values if v]
    return bool(filled) and 2 * sum(v.strip("()%-–−+ ").replace(".", "").replace(",", "").replace(" ", "").isdigit() for v in filled) > len(filled)


def pipe_table(lines: list[list[str]]) -> str:
    """A Markdown table; its first line is the head. Columns have the width of their longest cell, three at least; bars in texts are escaped."""
    if not lines:
        return ""
    safe = [[c.replace("\\", "\\\\").replace("|", "\\|").replace("\n", " ") for c in line] for line in lines]
    right = [right_aligned([line[j] for line in lines[1:]]) for j in range(len(lines[0]))]
    width = [max(3, *(len(line[j]) for line in safe)) for j in range(len(lines[0]))]
    row = lambda line: "| " + " | ".join(c.rjust(w) if r else c.ljust(w) for c, w, r in zip(line, width, right, strict=True)) + " |"
    rule = "| " + " | ".join("-" * (w - 1) + ":" if r else "-" * w for w, r in zip(width, right, strict=True)) + " |"
    return "\n".join([row(safe[0]), rule, *map(row, safe[1:])])


def html_table(cells: list[tuple[int, int, int, int, str]]) -> str:
    """An HTML table with spans; the first row is the head."""
    out, last = [], None
    tag = "th"
    for r, c, rs, cs, text in sorted(cells, key=_placed):
        if out and r != last:
            tag = "td"
            out.append("</tr>")
        if r != last:
            out.append("<tr>")
        out.append(f"<{tag}{f' rowspan="{rs}"' if rs > 1 else ''}{f' colspan="{cs}"' if cs > 1 else ''}>{html.escape(text or '')}</{tag}>")
        last = r
    return f"<table>{''.join(out)}{'</tr>' if out else ''}</table>"


def _placed(cell: tuple) -> tuple:
    """The order of cells; a missing text goes before others."""
    return cell[:4], cell[4] is not None, cell[4] or ""


def rendered(cells: DataFrame, key: str = "table_id") -> DataFrame:
    """Each table with its number of rows and columns, its Markdown and its HTML."""
    names = ["row", "col", "row_span", "col_span", "text"]

    def render(*lists: pd.Series) -> pd.DataFrame:
        out = []
        for table in zip(*lists, strict=True):
            listed = list(zip(*(x.tolist() for x in table), strict=True))
            lines = grid(listed)
            out.append((len(lines), len(lines[0]) if lines else 0, pipe_table(lines), html_table(listed)))
        return pd.DataFrame(out, columns=["n_rows", "n_cols", "markdown", "html"])

    listed = cells.groupBy(key).agg(F.collect_list(F.struct(*names)).alias("c"))
    made = listed.select(key, F.pandas_udf(render, "n_rows int, n_cols int, markdown string, html string")(*(F.col(f"c.{n}") for n in names)).alias("r"))
    return made.select(key, "r.*")


class Node:
    """A node of a table's tree: its tag, spans, text and children."""

    def __init__(self, tag: str, spans: tuple[int, int] = (1, 1)) -> None:
        self.tag, self.spans, self.text, self.children = tag, spans, "", []


class _Trees(HTMLParser):
    """All tables of a page as trees of table, tr and td; heads count as cells. A table inside a cell is a table of its own."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.tables: list[Node] = []
        self.open: list[Node] = []

    def handle_starttag(self, tag, attrs):
        if tag == "table":
            self.open.append(Node("table"))
            self.tables.append(self.open[-1])
        elif tag in ("tr", "td", "th") and self.open:
            inside = "table" if tag == "tr" else "tr"
            while self.open[-1].tag not in (inside, "table"):
                self.open.pop()
            if self.open[-1].tag == "table" and tag != "tr":
                self._child(Node("tr"))
            values = dict(attrs)
            number = lambda name: int(values[name]) if (values.get(name) or "").isdigit() else 1
            self._child(Node("tr" if tag == "tr" else "td", (1, 1) if tag == "tr" else (number("rowspan"), number("colspan"))))

    def _child(self, node: Node) -> None:
        self.open[-1].children.append(node)
        self.open.append(node)

    def handle_endtag(self, tag):
        tag = "td" if tag == "th" else tag
        if tag in ("table", "tr", "td") and any(n.tag == tag for n in self.open):
            while self.open.pop().tag != tag:
                pass

    def handle_data(self, data):
        if self.open and self.open[-1].tag == "td":
            self.open[-1].text += data


_CELL = re.compile(r'<t([hd])(?: rowspan="([0-9]+)")?(?: colspan="([0-9]+)")?>([^<]*)</t\1>')
_PLAIN = re.compile(f"<table>(?:<tr>(?:{_CELL.pattern.replace('"([0-9]+)"', '"[0-9]+"').replace('([^<]*)', '[^<]*')})*</tr>)*</table>")


def _plain_tree(page: str) -> Node:
    """The tree of a page that is one table as html_table() writes it, without a parser."""
    root = Node("table")
    for line in page.removeprefix("<table>").split("</tr>")[:-1]:
        root.children.append(Node("tr"))
        for _, rows, cols, text in _CELL.findall(line):
            root.children[-1].children.append(Node("td", (int(rows or 1), int(cols or 1))))
            root.children[-1].children[-1].text = html.unescape(text)
    return root


def trees(page: str) -> list[Node]:
    if _PLAIN.fullmatch(page or ""):
        return [_plain_tree(page)]
    parser = _Trees()
    parser.feed(page or "")
    parser.close()
    return parser.tables


def _edits(a: str, b: str) -> int:
    """Edit distance by bits of whole numbers, one for each place of b."""
    where: dict[str, int] = {}
    for j, y in enumerate(b):
        where[y] = where.get(y, 0) | 1 << j
    full, last, cost = (1 << len(b)) - 1, 1 << len(b) >> 1, len(b)
    up, down = full, 0
    for x in a:
        eq = where.get(x, 0)
        same = ((eq & up) + up ^ up) | eq | down
        more = down | full & ~(same | up)
        less = same & up
        cost += 1 if more & last or not last else -1 if less & last else 0
        more = more << 1 | 1
        up, down = full & (less << 1 | ~(same | more)), full & same & more
    return cost


def _shares(texts: list[str], s: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Edit distances of pairs of distinct texts (by place) over the longer one's length. As _edits(), a column of 64-bit numbers for all pairs at once; texts beyond 63 characters singly."""
    sizes = np.array([len(x) for x in texts])
    out = np.zeros(len(s))
    long = (sizes[s] > 63) | (sizes[t] > 63)
    chars = {c: k for k, c in enumerate(sorted({c for x in texts for c in x}))}
    if len(texts) * len(chars) > TABLE_CELLS:
        long[:] = True
    alone = np.flatnonzero(long & (s != t))
    out[alone] = [_edits(texts[a], texts[b]) for a, b in zip(s[alone].tolist(), t[alone].tolist(), strict=True)]
    rest = np.flatnonzero(~long & (s != t))
    if len(rest):
        a, b, one = s[rest], t[rest], np.uint64(1)
        where = np.zeros((len(texts), len(chars)), np.uint64)
        codes = np.zeros((len(texts), 63), np.intp)
        for k, x in enumerate(texts):
            if len(x) <= 63:
                for j, c in enumerate(x):
                    where[k, chars[c]] |= one << np.uint64(j)
                    codes[k, j] = chars[c]
        size, ends = sizes[a], sizes[b].astype(np.uint64)
        full = (one << ends) - one
        last, cost = (one << ends) >> one, sizes[b].astype(float)
        up, down = full.copy(), np.zeros_like(full)
        for j in range(int(size.max(initial=0))):
            eq = where[b, codes[a, j]]
            same = ((eq & up) + up ^ up) | eq | down
            more = down | full & ~(same | up)
            less = same & up
            step = np.where((more & last > 0) | (last == 0), 1, np.where(less & last > 0, -1, 0))
            cost += np.where(j < size, step, 0)
            more = more << one | one
            up, down = full & (less << one | ~(same | more)), full & same & more
        out[rest] = cost
    return np.divide(out, np.maximum(sizes[s], sizes[t]), out=np.zeros(len(s)), where=s != t)


#: Numbers in a table that is held at once for many trees of one shape; fewer trees than FEW are worked off singly
TABLE_CELLS = 1 << 21
FEW = 10


class _Flat:
    """A tree by post-order: its nodes' labels (tag, spans), texts, first leaves below them, and key roots."""

    def __init__(self, root: Node) -> None:
        labels, texts, left = [], [], []

        def walk(node: Node) -> int:
            first = [walk(c) for c in node.children]
            labels.append((node.tag, node.spans))
            texts.append(node.text.strip() if node.tag == "td" else "")
            left.append(first[0] if first else len(labels) - 1)
            return left[-1]

        walk(root)
        self.texts, self.left, self.shape = texts, left, (tuple(labels), tuple(left))
        self.roots = sorted({leaf: i for i, leaf in enumerate(left)}.values())


def _distance(x: _Flat, y: _Flat, rename: list[list[float]]) -> float:
    """Key roots and post-order tables (the algorithm of Zhang and Shasha): memory is the product of the sizes."""
    lx, ly = x.left, y.left
    known = [[0.0] * len(ly) for _ in lx]
    for i in x.roots:
        for j in y.roots:
            li, lj = lx[i], ly[j]
            above = [float(q) for q in range(j - lj + 2)]
            rows = [above]
            for s in range(li, i + 1):
                best = float(s - li + 1)
                row, whole, base, of, cost = [best], lx[s] == li, rows[lx[s] - li], known[s], rename[s]
                for q, t in enumerate(range(lj, j + 1)):
                    best = min(best, above[q + 1]) + 1
                    if whole and ly[t] == lj:
                        best = min(best, above[q] + cost[t])
                        of[t] = best
                    else:
                        best = min(best, base[ly[t] - lj] + of[t])
                    row.append(best)
                rows.append(row)
                above = row
    return float(known[-1][-1])


def _alike(x: _Flat, y: _Flat) -> list[list[float]]:
    """The cost of each node of x as each of y by tags and spans."""
    return [[float(a != b) for b in y.shape[0]] for a in x.shape[0]]


def _distances(x: _Flat, y: _Flat, rename: np.ndarray) -> np.ndarray:
    """As _distance() for many pairs of trees of the shapes of x and y; rename has the costs of the pairs as its last axis. Leaves are done at once, as their key roots are single nodes."""
    known = np.zeros(rename.shape)
    flat = lambda f: np.array([i for i in f.roots if f.left[i] == i], int)
    at = np.ix_(flat(x), flat(y))
    known[at] = rename[at]

    def one(i: int, j: int, lx, ly, known: np.ndarray, rename: np.ndarray) -> None:
        li, lj = lx[i], ly[j]
        d = np.empty((i - li + 2, j - lj + 2, rename.shape[2]))
        d[:, 0], d[0] = np.arange(d.shape[0])[:, None], np.arange(d.shape[1])[:, None]
        back = np.array(ly[lj : j + 1]) - lj
        stem = np.flatnonzero(back == 0)
        step = np.empty(rename.shape[2])
        for p, s in enumerate(range(li, i + 1), 1):
            costs = d[lx[s] - li][back] + known[s, lj : j + 1]
            if lx[s] == li:
                costs[stem] = d[p - 1][stem] + rename[s, lj + stem]
            np.minimum(costs, d[p - 1, 1:] + 1, out=costs)
            row = list(d[p])
            for q, cost in enumerate(costs):
                np.add(row[q], 1, out=step)
                np.minimum(cost, step, out=row[q + 1])
            if lx[s] == li:
                known[s, lj + stem] = d[p][stem + 1]

    for i in x.roots:
        for j in y.roots:
            if y.left[j] != j:
                one(i, j, x.left, y.left, known, rename)
            elif x.left[i] != i:
                one(j, i, y.left, x.left, known.swapaxes(0, 1), rename.swapaxes(0, 1))
    return known[-1, -1]


@lru_cache(1 << 12)
def _by_shape(a: tuple, b: tuple) -> float:
    x, y = _Flat.__new__(_Flat), _Flat.__new__(_Flat)
    for f, shape in ((x, a), (y, b)):
        f.shape, f.left = shape, shape[1]
        f.roots = sorted({leaf: i for i, leaf in enumerate(f.left)}.values())
    return _distance(x, y, _alike(x, y))


def _with_texts(pairs: list[tuple[_Flat, _Flat]]) -> list[float]:
    """Distances of pairs of trees that have the same two shapes."""
    x, y = pairs[0]
    most = max(1, TABLE_CELLS // (len(x.left) * len(y.left)))
    if len(pairs) > most:
        return [d for k in range(0, len(pairs), most) for d in _with_texts(pairs[k : k + most])]
    rename = np.array(_alike(x, y))
    both = np.nonzero((rename == 0) & np.array([a[0] == "td" for a in x.shape[0]])[:, None])
    places: dict[str, int] = {}
    s, t = (np.array([[places.setdefault(w, len(places)) for w in f.texts] for f in side], int) for side in zip(*pairs, strict=True))
    shares = _shares(list(places), s[:, both[0]].ravel(), t[:, both[1]].ravel()).reshape(len(pairs), -1)
    costs = np.repeat(rename[:, :, None], len(pairs), 2)
    costs[both] = shares.T
    if len(pairs) >= FEW:
        return _distances(x, y, costs).tolist()
    return [_distance(x, y, costs[:, :, k].tolist()) for k in range(len(pairs))]


def tree_distance(a: Node, b: Node, structure_only: bool = False) -> float:
    """Edit distance of two ordered trees: 1 for a node that is added, removed or of another tag or span, and for cells the share of their text that differs."""
    x, y = _Flat(a), _Flat(b)
    return _by_shape(x.shape, y.shape) if structure_only else _with_texts([(x, y)])[0]


def size(node: Node) -> int:
    return 1 + sum(map(size, node.children))


def teds(reference: str | None, prediction: str | None, structure_only: bool = False) -> float:
    """1 less the distance of two tables' trees over the nodes (but the root) of the larger; 0 if one is missing."""
    return all_teds([(reference, prediction)])[0][int(structure_only)]


def all_teds(pairs: list[tuple[str | None, str | None]]) -> list[tuple[float, float]]:
    """(teds, teds by structure alone) of each pair; pairs of the same shapes are worked off together, and each pair of shapes once for the structure."""
    out: list[tuple[float, float]] = [(0.0, 0.0)] * len(pairs)
    groups: dict[tuple, list] = {}
    for k, (reference, prediction) in enumerate(pairs):
        a, b = trees(reference or "")[:1], trees(prediction or "")[:1]
        if a and b:
            x, y = _Flat(a[0]), _Flat(b[0])
            groups.setdefault((x.shape, y.shape), []).append((k, x, y))
    for (a, b), listed in groups.items():
        most = max(len(a[1]), len(b[1])) - 1
        value = lambda d: round(max(0.0, 1 - d / most), 4) if most else 1.0  # noqa: B023, E731
        shaped = value(_by_shape(a, b))
        for (k, _, _), d in zip(listed, _with_texts([(x, y) for _, x, y in listed]), strict=True):
            out[k] = (value(d), shaped)
    return out


def table_similarity(pairs: DataFrame, keys: list[str]) -> DataFrame:
    """pairs (reference, prediction: HTML) with teds and teds_structure."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = all_teds(list(zip(batch["reference"], batch["prediction"], strict=True)))
            yield batch[keys].assign(teds=[a for a, _ in found], teds_structure=[b for _, b in found])

    fields = ", ".join(f"{n} {t}" for n, t in pairs.select(*keys).dtypes)
    return pairs.select(*keys, "reference", "prediction").mapInPandas(run, f"{fields}, teds double, teds_structure double")


def stitched(cells: DataFrame, chain: str = "chain", part: str = "part") -> DataFrame:
    """Cells of tables that go on over pages as one table: parts follow one another by `part`; a part whose first row repeats that of the chain's first part loses it.

    Rows are shifted by the rows of the parts before; a window over parts, not over cells.
    """
    head = cells.where(F.col("row") == 0).groupBy(chain, part).agg(F.array_sort(F.collect_list(F.struct("col", F.trim("text").alias("text")))).alias("head"))
    rows = cells.groupBy(chain, part).agg((F.max("row") + 1).alias("n"))
    parts = rows.join(head, [chain, part], "left")
    first = F.first("head").over(_by(chain, part).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    number = F.row_number().over(_by(chain, part))
    parts = parts.withColumn("repeats", (number > 1) & F.coalesce(F.col("head") == first, F.lit(False)))
    gone = F.col("repeats").cast("int")
    parts = parts.withColumn("gone", gone).withColumn("before", F.coalesce(F.sum(F.col("n") - F.col("gone")).over(_by(chain, part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    out = cells.join(parts.select(chain, part, "gone", "before"), [chain, part]).where(F.col("row") >= F.col("gone"))
    return out.withColumn("row", (F.col("row") - F.col("gone") + F.col("before")).cast("int")).drop("gone", "before")


def _by(chain: str, part: str):
    return Window.partitionBy(chain).orderBy(part)
