"""Benchmark decontamination with suffix arrays over the corpus.

The corpus is cut into shards (SHARD_BYTES of text each); every shard gets a suffix array over its words: the start positions of
suffixes, sorted by their first `window` words. Suffixes that cannot match are left out of the array: those whose
first two words are no word pair of the benchmark (or whose first word is no one-word item). Every benchmark suffix is
binary-searched in every shard's array, word by word, to a depth of `window` words; its interval of the array gives all verbatim occurrences, and
those that do not go on from an earlier one are followed to the right for the longest match and its place.

The benchmark is the stated query set. It comes to the driver PART_BYTES of text at a time, and each part is sent to the executors; a task searches
its shard for one part after another and joins what it finds, so a benchmark of any size is searched whole, with one part in memory. The corpus is read
once, is never shuffled, and a lost task is simply run again.

Cases: words are maximal runs of [0-9a-z] and of non-ASCII characters after lower-casing A-Z. A null or empty text has no words and no
hits; an item without words is never matched; a shorter item than the window is one window; equal windows of several items
count for each of them; rows of one item id are one item with several texts; repeated rows are judged one by one; other columns are ignored (kept, with any
names, by clean_documents()). An item without an id is left out. Of equally long matches the first in the document counts, then the one of the least item,
then the first in the item.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, slices, string_buffers

#: Bytes of benchmark text that are searched at a time, and bytes of corpus text in a shard.
PART_BYTES, SHARD_BYTES = 8 << 20, 4 << 20
#: Bits of the table that tells which word pairs the benchmark has.
PAIR_BITS = 24
#: Occurrences followed for their longest match at a time.
FOLLOWED = 1 << 20

_WORD = np.full(256, 32, np.uint8)
for _lo, _hi in ((48, 58), (97, 123), (128, 256)):
    _WORD[_lo:_hi] = np.arange(_lo, _hi)
_WORD[65:91] = np.arange(97, 123)
_TABLE = _WORD.tobytes()


def words_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(_TABLE).split()


class Searched:
    """A part of the benchmark as numbers: words by id (0: no benchmark word), windows without repeats, and the places in items that have them."""

    def __init__(self, items: list[tuple[int, str]], window: int) -> None:
        self.window = window
        self.ids: dict[bytes, int] = {}
        numbered = [np.array([self.ids.setdefault(x, len(self.ids) + 1) for x in words_of(text)], np.int32) for _, text in items]
        size = np.array([len(w) for w in numbered], np.int64)
        self.item = np.array([i for i, _ in items], np.int64)
        self.end = np.cumsum(size)
        self.first = self.end - size
        self.words = np.concatenate([*numbered, np.zeros(window, np.int32)])
        count = np.where(size > 0, np.maximum(1, size - window + 1), 0)
        of = np.repeat(np.arange(len(items)), count)
        start = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + self.first[of]
        rows = self.words[start[:, None] + np.arange(window)]
        rows[start[:, None] + np.arange(window) >= self.end[of][:, None]] = 0
        self.matrix, which = np.unique(rows, axis=0, return_inverse=True)
        self.depth = (self.matrix > 0).sum(1)
        order = np.argsort(which.ravel(), kind="stable")
        self.owner, self.start = of[order], start[order]
        self.owners = np.concatenate(([0], np.cumsum(np.bincount(which.ravel(), minlength=len(self.matrix))))).astype(np.int64)
        self.pairs = np.zeros(1 << PAIR_BITS, bool)
        self.alone = np.zeros(len(self.ids) + 1, bool)
        long = self.depth > 1
        self.pairs[self._slot(self.matrix[long, 0], self.matrix[long, 1] if window > 1 else self.matrix[long, 0])] = True
        self.alone[self.matrix[~long, 0]] = True

    @staticmethod
    def _slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + b.astype(np.uint64)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - PAIR_BITS)

    def suffix_array(self, shard: np.ndarray) -> np.ndarray:
        """Start positions of the shard's suffixes that may match, sorted by their first `window` words. The shard ends with `window` zeros."""
        n = len(shard) - self.window
        some = np.flatnonzero(shard[:n])
        keep = self.pairs[self._slot(shard[some], shard[some + 1])] | self.alone[shard[some]]
        at = some[keep]
        return at[np.lexsort([shard[at + d] for d in range(self.window - 1, -1, -1)])]

    def search(self, shard: np.ndarray, sa: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For every window, the interval of the suffix array whose suffixes begin with it."""
        lo, hi = np.zeros(len(self.matrix), np.int64), np.full(len(self.matrix), len(sa), np.int64)
        for d in range(self.window):
            column = shard[sa + d]
            live = np.flatnonzero((self.depth > d) & (lo < hi))
            if not len(live):
                break
            want = self.matrix[live, d]
            ends = []
            for right in (False, True):
                a, b = lo[live].copy(), hi[live].copy()
                while (open_ := a < b).any():
                    mid = (a + b) >> 1
                    value = column[np.minimum(mid, len(column) - 1)]
                    less = (value <= want) if right else (value < want)
                    a = np.where(open_ & less, mid + 1, a)
                    b = np.where(open_ & ~less, mid, b)
                ends.append(a)
            lo[live], hi[live] = ends
        return lo, hi

    def longest(self, shard: np.ndarray, begin: np.ndarray, doc: np.ndarray, at: np.ndarray, which: np.ndarray) -> np.ndarray:
        """The longest match of each document that has one: (document, words, first word there, item, first word in the item) as rows.

        at, which: occurrences of windows; doc: their documents; begin: where each document begins.
        """
        best = np.zeros((0, 5), np.int64)
        times = np.diff(self.owners)[which]
        cut = np.concatenate(([0], np.cumsum(times)))
        i = 0
        while i < len(at):
            j = max(i + 1, int(np.searchsorted(cut, cut[i] + FOLLOWED, "right")) - 1)
            n = times[i:j]
            place = np.repeat(self.owners[which[i:j]] - (cut[i:j] - cut[i]), n) + np.arange(n.sum())
            pos, of, item, start = np.repeat(at[i:j], n), np.repeat(doc[i:j], n), self.owner[place], self.start[place]
            new = (start == self.first[item]) | (pos == begin[of]) | (shard[pos - 1] != self.words[start - 1])  # else a longer match holds this one
            pos, of, item, start = pos[new], of[new], item[new], start[new]
            length = np.repeat(self.depth[which[i:j]], n)[new]
            live = np.arange(len(pos))
            while len(live):
                live = live[start[live] + length[live] < self.end[item[live]]]
                live = live[shard[pos[live] + length[live]] == self.words[start[live] + length[live]]]
                length[live] += 1
            found = np.stack((of, length, pos - begin[of], self.item[item], start - self.first[item]), 1)
            best = first_of_each(np.concatenate((best, found)))
            i = j
        return best


def first_of_each(rows: np.ndarray) -> np.ndarray:
    """The preferred row (longest; then first in the document, least item, first in the item) of each document."""
    rows = rows[np.lexsort((rows[:, 4], rows[:, 3], rows[:, 2], -rows[:, 1], rows[:, 0]))]
    return rows[np.concatenate(([True], rows[1:, 0] != rows[:-1, 0]))] if len(rows) else rows


def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Arrow batches put together until they have SHARD_BYTES."""
    held, size = [], 0
    for batch in slices(batches):
        held.append(batch)
        size += batch.nbytes
        if size >= SHARD_BYTES:
            yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _number(batch: pa.RecordBatch, ids: dict[bytes, int], window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word numbers of all texts, each followed by `window` zeros; each text's start, and its number of words."""
    raw, at = string_buffers(batch.column("text"))
    clean = _WORD[raw].tobytes()
    numbers, counts = [], []
    gap = np.zeros(window, np.int32)
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        w = clean[a:b].split()
        counts.append(len(w))
        numbers.append(np.fromiter(map(ids.get, w, repeat(0)), np.int32, len(w)))
        numbers.append(gap)
    n = np.array(counts, np.int64)
    return np.concatenate(numbers), np.concatenate(([0], np.cumsum(n + window)[:-1])), n


def search_shard(batch: pa.RecordBatch, searched: Searched) -> tuple[np.ndarray, ...]:
    """Word numbers of a shard, text starts, word counts, hit words, and occurrences (position, window, document)."""
    shard, starts, n = _number(batch, searched.ids, searched.window)
    hit = np.zeros(len(shard) + 1, np.int32)
    where, which = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if len(searched.matrix):
        sa = searched.suffix_array(shard)
        lo, hi = searched.search(shard, sa)
        size = np.maximum(hi - lo, 0)
        which = np.repeat(np.arange(len(size)), size)
        where = sa[np.repeat(lo, size) + np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)]
        np.add.at(hit, where, 1)
        np.add.at(hit, where + searched.depth[which], -1)
    return shard, starts, n, np.cumsum(hit[:-1]) > 0, where, which, np.searchsorted(starts, where, "right") - 1


def _parts(shared: list) -> Iterator[Searched]:
    for part in shared:
        yield part.value
        if len(shared) > 1:
            vars(part).pop("_value", None)  # one part in memory at a time


def _judged(shared, batches):
    for batch in shards(batches):
        found: list[set[int]] = [set() for _ in range(batch.num_rows)]
        best, hits = np.zeros((0, 5), np.int64), None
        for searched in _parts(shared):
            shard, starts, n, hit, where, which, doc = search_shard(batch, searched)
            hits = hit if hits is None else hits | hit
            seen = np.unique(doc * len(searched.matrix) + which) if len(which) else which
            for d, w in zip(*(x.tolist() for x in np.divmod(seen, max(1, len(searched.matrix)))), strict=True):
                found[d].update(searched.item[searched.owner[searched.owners[w] : searched.owners[w + 1]]].tolist())
            best = first_of_each(np.concatenate((best, searched.longest(shard, starts, doc, where, which))))
        total = np.concatenate(([0], np.cumsum(hits)))
        n_hit = total[starts + n] - total[starts]
        items = [sorted(x) for x in found]
        marks = [hashlib.sha256(",".join(sorted(map(str, x))).encode()).hexdigest() for x in items]
        longest = np.zeros((4, batch.num_rows), np.int64)
        longest[:, best[:, 0]] = best[:, 1:].T
        none = np.ones(batch.num_rows, bool)
        none[best[:, 0]] = False
        cols = [batch.column("doc_id"), pa.array(n), pa.array(n_hit.astype(np.int64)), pa.array([len(x) for x in items], pa.int64()), pa.array(marks), pa.array(n_hit > 0), pa.array(items, pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays([*cols, pa.array(longest[0]), *(pa.array(x, mask=none) for x in longest[1:])], [*_NAMES])


def _clean(shared, batches):
    for batch in shards(batches):
        hits = None
        for searched in _parts(shared):
            _, starts, n, hit, *_ = search_shard(batch, searched)
            hits = hit if hits is None else hits | hit
        total = np.concatenate(([0], np.cumsum(hits)))
        yield batch.filter(pa.array(total[starts + n] == total[starts]))


_SCHEMA = "doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, item_ids array<long>, longest_words long, longest_at long, longest_item long, longest_item_at long"
_NAMES = [c.split()[0] for c in _SCHEMA.split(", ")]


def _benchmark(docs: DataFrame, benchmark: DataFrame, window: int) -> list:
    """The benchmark's parts, sent to all executors (at least one part, empty for an empty benchmark)."""
    bound_batches(docs.sparkSession)
    rows = benchmark.where("item_id is not null").select(F.col("item_id").cast("long").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    shared, items, size = [], [], 0
    for row in rows.orderBy("id", "text").toLocalIterator():
        items.append((row.id, row.text))
        size += len(row.text.encode()) + 16
        if size >= PART_BYTES:
            shared.append(docs.sparkSession.sparkContext.broadcast(Searched(items, window)))
            items, size = [], 0
    if items or not shared:
        shared.append(docs.sparkSession.sparkContext.broadcast(Searched(items, window)))
    return shared


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """A row per row of docs: doc_id, n_words, n_hit (words inside an occurrence of a benchmark window), n_items, items_sha256, contaminated
    (n_hit > 0), item_ids, and the longest verbatim match of at least a window: longest_words (0: none), longest_at (its first word in the document,
    from 0), longest_item and longest_item_at (its first word in that item)."""
    shared = _benchmark(docs, benchmark, window)
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(partial(_judged, shared), _SCHEMA)


def clean_documents(docs: DataFrame, benchmark: DataFrame, window: int = 10) -> DataFrame:
    """The rows of docs, with all their columns, that share no window with the benchmark. A shuffle-free filter over the same search."""
    shared = _benchmark(docs, benchmark, window)
    return docs.withColumn("text", F.col("text").cast("string")).mapInArrow(partial(_clean, shared), docs.schema)
