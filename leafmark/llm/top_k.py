"""Exact top-k inner products with multi-resolution segment statistics.

A vector's components are quantised to floor(scale * x). Every vector is cut into segments; of each segment its mean and deviation are kept,
at a coarse and a finer resolution, at last the components themselves. For a query q and a vector x, a segment of w components contributes at most
w * (mean_q * mean_x + dev_q * dev_x) to the inner product (Cauchy-Schwarz), which bounds the distance |q|^2 + |x|^2 - 2 q.x from below. The best
scores so far (at first those of the best bounds among a block's first rows) give a threshold; vectors whose bound at one resolution lies below it are dropped, and exact scores
are computed for the survivors. A resolution that drops less than half is left out for the next blocks. Bounds are 32-bit floats with room for rounding.

Scale. Rows are packed into blocks of bounded size where they are read. Vectors are dealt to parts, queries to groups, and each pair of a part and a
group is one partition: it holds the queries of its group (GROUP_BYTES at most), takes the vectors of its part block by block, and hands on k
rows a query; a window over those picks the best. Vectors are shipped once for each group, queries once for each part (see layout()). Nothing is
broadcast, and copies of one vector are spread like other rows.

Vectors with a component beyond 31 bits have blocks of their own; they, and scores that may leave 64 bits, are worked out with integers of any size.

Cases: vectors that are null or hold a null or non-finite component take no part, as queries or otherwise; shorter vectors count as padded with
zeros, so an empty one scores 0 with all; ties go to the smaller vec_id; rows that share a vec_id are separate rows, a query's own row alone is left out;
null ids take no part; an empty table gives an empty result; other columns are ignored. A score beyond 64 bits counts as the largest (or smallest) long.
"""

from __future__ import annotations

import heapq
from collections import defaultdict
from collections.abc import Iterable, Iterator
from functools import partial
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import bound_batches, written

BLOCK, LARGE_BLOCK, QUERIES_AT_ONCE, PAIRS_AT_ONCE, SEEDED, PROBE = 4096, 256, 512, 1 << 16, 512, 16
RESOLUTIONS = (4, 16)

#: Components of a block; bytes that the queries of a partition take, with their statistics and best rows.
BLOCK_CELLS, GROUP_BYTES = 1 << 18, 192 << 20

FOUND = "q_uid long, query_id long, vec_id long, uid long, score long"


def layout(n: int, asked: int, dim: int, k: int, cores: int) -> tuple[int, int, int]:
    """Rows of a block, parts of the vectors, groups of the queries. Queries and their best rows, once for each part, are about as much as the vectors, unless the cores need more parts."""
    most = min(BLOCK, max(256, n // (4 * cores)))
    groups = -(-asked * (8 * dim + 24 * k + 128) // GROUP_BYTES)
    blocks = -(-n // most)
    parts = min(blocks, max(2 * cores, min(blocks // 16, n * dim // (max(1, asked) * (dim + 20 * k)))))
    return most, max(1, parts), max(1, groups)


def _blocks(scale: float, most: int, count: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of a task's rows, dealt in turn to `count` parts: ids and quantised components as a matrix (integers, or doubles beyond 31 bits), by vec_id."""
    at_part = TaskContext.get().partitionId()

    def packed(table: pa.Table) -> Iterator[pa.RecordBatch]:
        nonlocal at_part
        ids, uids = (table.column(c).to_numpy() for c in ("vec_id", "uid"))
        lists = table.column("embedding").combine_chunks()
        at = np.asarray(lists.offsets).astype(np.int64)
        size = np.diff(at)
        x = np.floor(scale * np.asarray(lists.values)[at[0] : at[-1]].astype(np.float64))
        at -= at[0]
        large = np.zeros(len(size), bool)
        large[np.searchsorted(at, np.nonzero(np.abs(x) >= (1 << 31) - 1)[0], "right") - 1] = True
        for rows, limit in ((np.nonzero(~large)[0], most), (np.nonzero(large)[0], LARGE_BLOCK)):
            rows = rows[np.argsort(size[rows], kind="stable")]
            while len(rows):
                fits = int(np.searchsorted(np.arange(1, min(limit, len(rows)) + 1) * size[rows[:limit]], BLOCK_CELLS, "right"))
                now, rows = rows[: max(1, fits)], rows[max(1, fits) :]
                now = now[np.lexsort((uids[now], ids[now]))]
                dim = int(size[now].max())
                row = np.repeat(np.arange(len(now)), size[now])
                col = np.arange(len(row)) - np.repeat(np.cumsum(size[now]) - size[now], size[now])
                taken = x[np.repeat(at[now], size[now]) + col]
                peak = np.abs(taken).max(initial=0)
                out = np.zeros((len(now), dim), np.float64 if large[now[0]] else np.int16 if peak < 1 << 15 else np.int32)
                out[row, col] = taken
                yield pa.RecordBatch.from_arrays(
                    [pa.array([at_part % count], pa.int32()), pa.array([dim], pa.int32()), pa.array([out.dtype.str]), *(pa.array([a.tobytes()], pa.binary()) for a in (ids[now], uids[now], out))],
                    ["at", "dim", "kind", "ids", "uids", "x"],
                )
                at_part += 1

    held: list[pa.RecordBatch] = []
    for batch in batches:
        while batch.num_rows:
            take = min(batch.num_rows, most - sum(b.num_rows for b in held))
            held.append(batch.slice(0, take))
            batch = batch.slice(take)
            if sum(b.num_rows for b in held) == most:
                yield from packed(pa.Table.from_batches(held))
                held = []
    if held:
        yield from packed(pa.Table.from_batches(held))


def segment_stats(x: np.ndarray, segments: int) -> np.ndarray:
    """Means and deviations of the segments of rows of x, each times the root of the segment's length, side by side."""
    parts = np.array_split(x.astype(np.float64), segments, 1)
    root = np.sqrt([p.shape[1] for p in parts])
    return np.hstack([np.stack([f(p, 1) for p in parts], 1) * root for f in (np.mean, np.std)]).astype(np.float32)


def _widened(m: np.ndarray, dim: int) -> np.ndarray:
    return m if m.shape[1] == dim else np.pad(m, ((0, 0), (0, dim - m.shape[1])))


def _levels(m: np.ndarray) -> list[np.ndarray]:
    """What bounds are made of, from coarse to fine."""
    return [*(segment_stats(m, s) for s in RESOLUTIONS if s < m.shape[1]), m.astype(np.float32)]


def _places(alive: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """np.nonzero(), but faster where little is set."""
    return np.divmod(np.flatnonzero(alive), alive.shape[1])


def _dots(a: np.ndarray, b: np.ndarray, rows: np.ndarray, cols: np.ndarray, kind: type) -> np.ndarray:
    out = np.empty(len(rows), kind)
    step = max(1, PAIRS_AT_ONCE * 64 // max(64, a.shape[1]))
    for i in range(0, len(rows), step):
        at = slice(i, i + step)
        out[at] = np.einsum("ij,ij->i", a[rows[at]].astype(kind), b[cols[at]].astype(kind))
    return out


def _large(q: np.ndarray, q_uid: np.ndarray, x: np.ndarray, x_uid: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row of x, score) of each query's k best rows of x, with integers of any size; scores are cut to 64 bits."""
    dim = min(q.shape[1], x.shape[1])
    whole = lambda m: [[int(v) for v in row] for row in m[:, :dim].tolist()]
    rows, cols, scores, others = [], [], [], whole(x)
    for i, a in enumerate(whole(q)):
        found = ((max(-(2**63), min(2**63 - 1, sum(map(mul, a, b)))), j) for j, b in enumerate(others) if q_uid[i] != x_uid[j])
        for score, j in heapq.nsmallest(k, found, key=lambda t: (-t[0], t[1])):
            rows.append(i)
            cols.append(j)
            scores.append(score)
    return np.array(rows, np.int64), np.array(cols, np.int64), np.array(scores, np.int64)


class Best:
    """The k best rows so far of each of some queries of one kind and width."""

    def __init__(self, ids: np.ndarray, uids: np.ndarray, q: np.ndarray, k: int) -> None:
        self.ids, self.uids, self.q, self.k = ids, uids, q, k
        self.score, self.vec, self.uid = (np.zeros((len(q), k), np.int64) for _ in range(3))
        self.have, self.least = np.zeros(len(q), np.int64), np.full(len(q), -np.inf)
        self.peak = float(np.abs(q.astype(np.float64)).max(initial=0))
        self.levels, self.norm, self.seen, self.poor = None, None, 0, set()

    def take(self, ids: np.ndarray, uids: np.ndarray, x: np.ndarray) -> None:
        """Compares all queries with the rows of x, which are by id and uid."""
        dim = max(self.q.shape[1], x.shape[1])
        most = self.peak * float(np.abs(x.astype(np.float64)).max(initial=0)) * dim
        if self.q.dtype == np.float64 or x.dtype == np.float64 or most >= 2**62:
            for a in range(0, len(self.q), QUERIES_AT_ONCE):
                rows, cols, value = _large(self.q[a : a + QUERIES_AT_ONCE], self.uids[a : a + QUERIES_AT_ONCE], x, uids, self.k)
                self._merged(rows + a, ids[cols], uids[cols], value)
            return
        x = _widened(x, dim)
        if self.q.shape[1] != dim:
            self.q, self.levels = _widened(self.q, dim), None
        if self.levels is None:
            self.levels, self.norm = _levels(self.q), np.linalg.norm(self.q.astype(np.float64), axis=1)
        room = self.norm * np.linalg.norm(x.astype(np.float64), axis=1).max() * (dim + 16) * 2.0**-22 + 1e-6
        levels, by_uid = _levels(x), np.argsort(uids)
        for a in range(0, len(self.q), QUERIES_AT_ONCE):
            self._chunk(slice(a, a + QUERIES_AT_ONCE), ids, uids, by_uid, x, levels, room, most < 2**53)
        self.seen += 1

    def _chunk(self, at: slice, ids: np.ndarray, uids: np.ndarray, by_uid: np.ndarray, x: np.ndarray, levels: list[np.ndarray], room: np.ndarray, exact: bool) -> None:
        q, own, k, kind = self.q[at], self.uids[at], self.k, np.float64 if exact else np.int64
        mine = [level[at] for level in self.levels]
        least = self.least[at]
        if len(x) > 2 * k and np.isinf(least).any():
            seeds = np.argpartition(-(mine[0] @ levels[0][: max(SEEDED, 4 * k)].T), 2 * k - 1, 1)[:, : 2 * k]
            score = _dots(q, x, np.repeat(np.arange(len(q)), 2 * k), seeds.ravel(), kind).reshape(seeds.shape).astype(np.float64)
            score[uids[seeds] == own[:, None]] = -np.inf
            least = np.maximum(least, -np.partition(-score, k - 1, 1)[:, k - 1])
        bar = np.nextafter((least - room[at]).astype(np.float32), np.float32(-np.inf))
        alive, pairs, share = None, None, 1.0
        for i, (a, b) in enumerate(zip(mine, levels, strict=True)):
            if i in self.poor and self.seen % PROBE and i + 1 < len(levels):
                continue
            if share > 0.1:
                passed = a @ b.T >= bar[:, None]
                alive = passed if alive is None else np.logical_and(alive, passed, out=alive)
                before, share = share, np.count_nonzero(alive) / alive.size
                (self.poor.add if share > 0.5 * before else self.poor.discard)(i)
            else:
                rows, cols = _places(alive) if pairs is None else pairs
                keep = _dots(a, b, rows, cols, np.float32) >= bar[rows]
                pairs = rows[keep], cols[keep]
        if pairs is None and share > 0.05 and exact:
            value = q.astype(np.float64) @ x.T.astype(np.float64)
            near = np.minimum(np.searchsorted(uids, own, sorter=by_uid), len(uids) - 1)
            hit = np.nonzero(uids[by_uid[near]] == own)[0]
            value[hit, by_uid[near[hit]]] = -np.inf
            rows, found = np.arange(len(q)), []
            for _ in range(min(k, len(x))):
                cols = value.argmax(1)
                top = value[rows, cols]
                found.append((rows[good := top > -np.inf], cols[good], top[good]))
                value[rows, cols] = -np.inf
            rows, cols, value = (np.concatenate(c) for c in zip(*found, strict=True))
        else:
            rows, cols = _places(alive) if pairs is None else pairs
            other = own[rows] != uids[cols]
            rows, cols = rows[other], cols[other]
            value = _dots(q, x, rows, cols, kind)
        self._merged(rows + at.start, ids[cols], uids[cols], value.astype(np.int64))

    def _merged(self, rows: np.ndarray, ids: np.ndarray, uids: np.ndarray, value: np.ndarray) -> None:
        k = self.k
        good = (self.have[rows] < k) | (value >= self.score[rows, k - 1])
        rows, ids, uids, value = rows[good], ids[good], uids[good], value[good]
        touched = np.unique(rows)
        i, j = np.nonzero(np.arange(k) < self.have[touched][:, None])
        old = touched[i], j
        rows, ids, uids, value = (np.concatenate(c) for c in ((rows, old[0]), (ids, self.vec[old]), (uids, self.uid[old]), (value, self.score[old])))
        order = np.lexsort((uids, ids, ~value, rows))
        rows = rows[order]
        rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
        order, rows, rank = order[rank < k], rows[rank < k], rank[rank < k]
        for into, new in ((self.vec, ids), (self.uid, uids), (self.score, value)):
            into[rows, rank] = new[order]
        self.have[touched] = np.searchsorted(rows, touched, "right") - np.searchsorted(rows, touched)
        full = touched[self.have[touched] == k]
        self.least[full] = self.score[full, k - 1]

    def result(self) -> Iterator[pa.RecordBatch]:
        for a in range(0, len(self.q), BLOCK):
            i, j = np.nonzero(np.arange(self.k) < self.have[a : a + BLOCK, None])
            i += a
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in (self.uids[i], self.ids[i], self.vec[i, j], self.uid[i, j], self.score[i, j])], ["q_uid", "query_id", "vec_id", "uid", "score"])


def _searched(k: int, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows by slot, the queries of a slot before its vectors."""
    slot, asked, best = None, defaultdict(list), None
    for batch in batches:
        for i in range(batch.num_rows):
            row = {c: batch.column(c)[i].as_py() for c in batch.schema.names}
            if row["slot"] != slot:
                for b in best or []:
                    yield from b.result()
                slot, asked, best = row["slot"], defaultdict(list), None
            ids, uids = (np.frombuffer(row[c], np.int64) for c in ("ids", "uids"))
            x = np.frombuffer(row["x"], row["kind"]).reshape(len(ids), row["dim"]) if row["dim"] else np.zeros((len(ids), 0), np.int16)
            if not row["side"]:
                asked[row["kind"], row["dim"]].append((ids, uids, x))
                continue
            if best is None:
                best = [Best(*(np.concatenate(c) for c in zip(*asked.pop(key), strict=True)), k) for key in list(asked)]
            for b in best:
                b.take(ids, uids, x)
    for b in best or []:
        yield from b.result()


def top_k(vectors: DataFrame, queries: Column, k: int, scale: float) -> DataFrame:
    """The k best rows of vectors (vec_id, embedding) for each of its rows where `queries` is true: query_id, rank, vec_id, score."""
    spark = vectors.sparkSession
    bound_batches(spark)
    kind = "array<float>" if vectors.schema["embedding"].dataType.simpleString() == "array<float>" else "array<double>"
    whole = F.forall("embedding", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long"), F.col("embedding").cast(kind), F.coalesce(queries, F.lit(False)).alias("is_query"))
    rows = written(rows.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & whole).withColumn("uid", F.monotonically_increasing_id()), "vectors")
    n, asked, dim = rows.agg(F.count("*"), F.count_if("is_query"), F.coalesce(F.max(F.size("embedding")), F.lit(0))).first()
    most, parts, groups = layout(n, asked, dim, k, spark.sparkContext.defaultParallelism)

    def packed(part: DataFrame, side: int, count: int, slots: Column) -> DataFrame:
        made = part.select("vec_id", "uid", "embedding").mapInArrow(partial(_blocks, scale, most, count), "at int, dim int, kind string, ids binary, uids binary, x binary")
        return made.select(F.explode(slots).alias("slot"), F.lit(side).alias("side"), "dim", "kind", "ids", "uids", "x")

    q = packed(rows.where("is_query"), 0, groups, F.transform(F.sequence(F.lit(0), F.lit(parts - 1)), lambda p: p * groups + F.col("at")))
    x = packed(rows, 1, parts, F.transform(F.sequence(F.lit(0), F.lit(groups - 1)), lambda g: F.col("at") * groups + g))
    found = q.unionAll(x).repartitionById(parts * groups, F.col("slot")).sortWithinPartitions("slot", "side").mapInArrow(partial(_searched, k), FOUND)
    best = Window.partitionBy("q_uid").orderBy(F.col("score").desc(), "vec_id", "uid")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
