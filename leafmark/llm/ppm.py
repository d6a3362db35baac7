"""Language-model scoring: prediction by partial matching over bytes, and a word-frequency base.

Training counts every run of ORDER + 1 symbols (256 bytes and a boundary) of the training texts; the counts of shorter contexts are
their sums. The trie node of a context holds the symbols seen after it. A symbol is coded from the longest context on; a context
that has not seen it codes an escape with probability d / (N + d) (d symbols seen, N times), and the symbols it has seen are
excluded below. Because the symbols of a context are also symbols of each shorter one, what exclusion takes from N and d of the shorter
context depends on the longer context alone, so a text is scored by table look-ups. Below order 0 the symbols left are equally likely.

Scale. Each task counts what it reads into sorted arrays and the counts meet in one partially aggregated shuffle. A score depends on the
symbol and the ORDER symbols before it alone, so each distinct run that occurs in any text is scored once: runs are dealt by the two
symbols before the last, which brings together all they share of orders 2 and up, while orders 0 and 1 (66,049 entries at most) are sent to
all tasks. No entry is left out. The scores of the ENTRIES most frequent runs at most are broadcast, the occurrences of all others are
joined by a shuffle. Word counts are exact for all words: those with at least the share 1 / WORDS of the tokens (so WORDS of them at most)
are broadcast, the occurrences of all others are joined by a shuffle, and no key of these joins is hot.
Words are counted by 64-bit hashes.

Cases: a null or empty text is scored as an empty one (its end alone); a null id counts as the empty string where documents are
divided; without training rows the byte model is uniform; repeated rows are scored one by one; other columns are ignored.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, drop_written, slices, string_buffers, written
from .near_dup import word_hashes

ORDER, BITS, SYMBOLS, BOUNDARY = 5, 9, 257, 256
ENTRIES, WORDS = 1 << 20, 1 << 21
#: Counts that a task holds before it hands them on.
HELD = 1_500_000
#: Runs that a task scores at a time; all runs with the same two symbols before the last stay together.
SCORED = 400_000
#: Slots of a worker's memory of scored symbols.
MEMO_BITS = 21

#: The end of a text, as a word.
_END = np.uint64(0)


def gram_keys(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A key for each symbol of all texts (the symbol in the low bits, the symbols before it above), and each text's first key. Every text ends with a boundary."""
    raw, at = string_buffers(column)
    length = np.diff(at)
    padded = np.full(len(raw) + len(length) * (ORDER + 1), BOUNDARY, np.int64)
    shift = np.arange(len(length)) * (ORDER + 1) + ORDER
    padded[np.arange(len(raw)) + np.repeat(shift, length)] = raw
    key = padded[ORDER:].copy()
    for j in range(1, ORDER + 1):
        key |= padded[ORDER - j : len(padded) - j] << (BITS * j)
    first = at[:-1] + np.arange(len(length)) * (ORDER + 1)
    keep = np.ones(len(key), bool)
    for j in range(1, ORDER + 1):
        pad = first + length + j
        keep[pad[pad < len(key)]] = False
    return key[keep], at[:-1] + np.arange(len(length))


def _tally(keys: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    if n is None:
        keys = np.sort(keys)
    else:
        order = np.argsort(keys)
        keys, n = keys[order], n[order]
    if not len(keys):
        return keys, np.zeros(0, np.int64)
    cut = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[cut], (np.diff(np.append(cut, len(keys))) if n is None else np.add.reduceat(n, cut))


class _Held:
    """Counts of one kind that a task has gathered."""

    def __init__(self, kind: int) -> None:
        self.kind, self.parts, self.size = kind, [], 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        self.parts.append(_tally(keys))
        self.size += len(self.parts[-1][0])
        if self.size > HELD:
            merged = self._merged()
            self.parts, self.size = [merged], len(merged[0])
            if self.size > HELD // 2:
                yield from self.flush()

    def _merged(self) -> tuple[np.ndarray, np.ndarray]:
        return _tally(np.concatenate([k for k, _ in self.parts]), np.concatenate([n for _, n in self.parts]))

    def flush(self) -> Iterator[pa.RecordBatch]:
        if self.parts:
            keys, n = self._merged()
            for i in range(0, len(keys), 200_000):
                part = keys[i : i + 200_000]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(part), self.kind, np.int32)), pa.array(part), pa.array(n[i : i + 200_000])], ["kind", "key", "n"])
        self.parts, self.size = [], 0


def _counted(batches):
    grams, words, others = _Held(0), _Held(1), _Held(2)
    for batch in slices(batches):
        known = batch.column("training")
        texts, rest = batch.column("text").filter(known), batch.column("text").filter(pc.invert(known))
        if len(texts):
            yield from grams.add(gram_keys(texts)[0])
            hashes, _ = word_hashes(texts)
            yield from words.add(np.concatenate((hashes, np.full(len(texts), _END))).view(np.int64))
        if len(rest):
            yield from others.add(gram_keys(rest)[0])
    yield from grams.flush()
    yield from words.flush()
    yield from others.flush()


class Trie:
    """Sorted entries of each order: keys (context and symbol) with counts, and contexts with what exclusion leaves of the shorter context."""

    def __init__(self, levels: list[tuple[np.ndarray, np.ndarray]]) -> None:
        self.keys, self.counts, self.ctx, self.total, self.seen, self.taken = [], [], [], [], [], []
        for k, (keys, counts) in enumerate(levels):
            counts = counts.astype(np.float64)
            ctx = keys >> BITS
            cut = np.flatnonzero(np.concatenate(([True], ctx[1:] != ctx[:-1]))) if len(keys) else np.zeros(0, np.int64)
            taken = np.zeros(len(cut))
            if k and len(keys):
                taken = np.add.reduceat(self.counts[k - 1][np.searchsorted(self.keys[k - 1], keys & ((1 << (BITS * k)) - 1))], cut)
            self.keys.append(keys)
            self.counts.append(counts)
            self.ctx.append(ctx[cut])
            self.total.append(np.add.reduceat(counts, cut) if len(keys) else np.zeros(0))
            self.seen.append(np.diff(np.append(cut, len(keys))).astype(np.float64))
            self.taken.append(taken)

    @staticmethod
    def _find(table: np.ndarray, want: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if not len(table):
            return np.zeros(len(want), np.int64), np.zeros(len(want), bool)
        at = np.minimum(np.searchsorted(table, want), len(table) - 1)
        return at, table[at] == want

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """The code length, as log10 of the probability, of the low symbol of each key after the symbols above it."""
        out = np.zeros(len(keys))
        live = np.arange(len(keys))
        less_total, less_seen = np.zeros(len(keys)), np.zeros(len(keys))
        for k in range(len(self.keys) - 1, -1, -1):
            if not len(live):
                return out
            want = keys[live] & ((1 << (BITS * (k + 1))) - 1)
            at, known = self._find(self.ctx[k], want >> BITS)
            here = np.flatnonzero(known)
            rows, at = live[here], at[here]
            total, seen = self.total[k][at] - less_total[rows], self.seen[k][at] - less_seen[rows]
            entry, found = self._find(self.keys[k], want[here])
            with np.errstate(divide="ignore", invalid="ignore"):
                coded = np.where(found, self.counts[k][entry] if len(self.keys[k]) else 0.0, seen) / (total + seen)
                out[rows] += np.where(seen > 0, np.log10(coded), 0.0)
            less_total[rows] = self.taken[k][at]
            less_seen[rows] = self.seen[k][at]
            gone = np.zeros(len(live), bool)
            gone[here[found]] = True
            live = live[~gone]
        out[live] -= np.log10(np.maximum(SYMBOLS - less_seen[live], 1))
        return out


def _run_scores(shared, batches):
    """Scores runs that come sorted by the two symbols before the last."""
    held, size, last = [], 0, None

    def scored():
        keys, n, uses = (np.concatenate([part[i] for part in held]) for i in range(3))
        known = n > 0
        levels = [*shared.value, *(_tally(keys[known] & ((1 << (BITS * (k + 1))) - 1), n[known]) for k in range(2, ORDER + 1))]
        value = Trie(levels).log10(keys)
        for i in range(0, len(keys), 200_000):
            yield pa.RecordBatch.from_arrays([pa.array(a[i : i + 200_000]) for a in (keys, uses, value)], ["key", "uses", "log"])

    for batch in batches:
        keys, n, uses = (batch.column(c).to_numpy() for c in ("key", "n", "uses"))
        if not len(keys):
            continue
        pair = (keys >> BITS) & ((1 << (2 * BITS)) - 1)
        if size >= SCORED:
            new = np.flatnonzero(pair != last)
            if len(new):
                held.append((keys[: new[0]], n[: new[0]], uses[: new[0]]))
                yield from scored()
                held, size = [], 0
                keys, n, uses = keys[new[0] :], n[new[0] :], uses[new[0] :]
        held.append((keys, n, uses))
        size += len(keys)
        last = pair[-1]
    if held:
        yield from scored()


class _Runs:
    """The scores sent to every executor; those of other runs are not a number."""

    def __init__(self, keys: np.ndarray, logs: np.ndarray) -> None:
        self.keys, self.logs = keys, logs

    def log10(self, keys: np.ndarray) -> np.ndarray:
        at, known = Trie._find(self.keys, keys)
        return np.where(known, self.logs[at] if len(self.logs) else 0.0, np.nan)


class _Memo:
    """Scores of keys met before, in a table of fixed size that is looked up without branches."""

    def __init__(self, runs: _Runs) -> None:
        self.runs = runs
        self.keys = np.full(1 << MEMO_BITS, -1, np.int64)
        self.values = np.zeros(1 << MEMO_BITS)

    def log10(self, keys: np.ndarray) -> np.ndarray:
        slot = ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEMO_BITS)).view(np.int64)
        out = self.values[slot]
        miss = np.flatnonzero(self.keys[slot] != keys)
        if len(miss):
            new, back = np.unique(keys[miss], return_inverse=True)
            value = self.runs.log10(new)
            out[miss] = value[back]
            at = ((new.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - MEMO_BITS)).view(np.int64)
            self.keys[at], self.values[at] = new, value
            kept = self.keys[at] == new  # where several keys share a slot, value and key must be of the same one
            self.values[at[kept]] = value[kept]
        return out


_worker: dict[str, _Memo] = {}


def _scored(shared, tag: str, batches):
    runs, words, logs = shared.value
    memo = _worker.get(tag)
    if memo is None:
        _worker.clear()
        memo = _worker[tag] = _Memo(_Runs(*runs))
    for batch in slices(batches):
        keys, first = gram_keys(batch.column("text"))
        each = memo.log10(keys)
        open_at = np.flatnonzero(np.isnan(each))
        each[open_at] = 0.0
        score = np.add.reduceat(each, first)
        open_runs = pa.ListArray.from_arrays(pa.array(np.searchsorted(open_at, np.append(first, len(keys))).astype(np.int32)), pa.array(keys[open_at]))
        hashes, at = word_hashes(batch.column("text"))
        distinct, back = np.unique(hashes.view(np.int64), return_inverse=True)
        where, known = Trie._find(words, distinct)
        value = np.where(known, logs[where] if len(logs) else 0.0, 0.0)[back]
        known = known[back]
        sums = np.concatenate(([0.0], np.cumsum(value)))
        end, has_end = Trie._find(words, np.zeros(1, np.int64))
        end_log = float(logs[end[0]]) if has_end[0] else 0.0
        n = np.diff(at)
        n_known = np.add.reduceat(np.append(known, False).astype(np.int64), np.minimum(at[:-1], len(known))) * (n > 0)
        rare = np.flatnonzero(~known)
        tail = pa.ListArray.from_arrays(pa.array(np.searchsorted(rare, at).astype(np.int32)), pa.array(hashes[rare].view(np.int64)))
        yield pa.RecordBatch.from_arrays(
            [batch.column("rid"), batch.column("doc_id"), batch.column("held_out"), pa.array(n + 1), pa.array(n_known + int(has_end[0])), pa.array(sums[at[1:]] - sums[at[:-1]] + end_log), pa.array(score), tail, open_runs],
            ["rid", "doc_id", "held_out", "n_tokens", "n_known", "logs", "score", "tail", "runs"],
        )


def _column(table: pa.Table, name: str) -> np.ndarray:
    return table.column(name).combine_chunks().to_numpy(zero_copy_only=False) if table.num_rows else np.zeros(0, np.int64)


def train(docs: DataFrame) -> DataFrame:
    """Counts of the byte model (kind 0) and of words (kind 1) over the texts with `training`, and of runs in the others (kind 2), written to the shared folder."""
    counted = docs.select("text", F.coalesce("training", F.lit(False)).alias("training")).mapInArrow(_counted, "kind int, key long, n long")
    return written(counted.groupBy("kind", "key").agg(F.sum("n").alias("n")), "counts")


def run_scores(counts: DataFrame) -> DataFrame:
    """key, uses (occurrences in all texts) and log10 of the probability of each run that occurs in any text, written to the shared folder."""
    short = counts.where("kind = 0").groupBy(F.col("key").bitwiseAND(F.lit((1 << (2 * BITS)) - 1)).alias("key")).agg(F.sum("n").alias("n")).toArrow()
    pairs = _tally(_column(short, "key"), _column(short, "n"))
    shared = counts.sparkSession.sparkContext.broadcast([_tally(pairs[0] & ((1 << BITS) - 1), pairs[1]), pairs])
    runs = counts.where("kind in (0, 2)").groupBy("key").agg(F.sum(F.when(F.col("kind") == 0, F.col("n")).otherwise(F.lit(0))).alias("n"), F.sum("n").alias("uses"))
    runs = runs.withColumn("pair", F.shiftright("key", BITS).bitwiseAND(F.lit((1 << (2 * BITS)) - 1)))
    return written(runs.repartition("pair").sortWithinPartitions("pair").select("key", "n", "uses").mapInArrow(partial(_run_scores, shared), "key long, uses long, log double"), "runs")


def _least_uses(scores: DataFrame) -> int:
    """The least number of uses that at most ENTRIES runs have."""
    table = scores.groupBy("uses").count().toArrow()
    uses, n = _column(table, "uses"), _column(table, "count")
    order = np.argsort(-uses)
    fit = int(np.searchsorted(np.cumsum(n[order]), ENTRIES, "right"))
    return int(uses[order[fit - 1]]) if fit else (int(uses.max()) + 1 if len(uses) else 1)


def score_texts(docs: DataFrame, training: Column, held_out: Column) -> DataFrame:
    """Scores each row of docs by models learned from the rows where `training` is true.

    Returns doc_id, held_out, n_tokens (words and the end), n_known, train_tokens, base_score (add-one word model) and score (the byte model), both log10.
    """
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), training.alias("training"), held_out.alias("held_out"))
    counts = train(docs)
    total, distinct = counts.where("kind = 1").agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    often = F.col("n") >= total / WORDS
    words = counts.where("kind = 1").where(often).select("key", "n").toArrow()
    keys, n = _column(words, "key"), _column(words, "n")
    order = np.argsort(keys)
    runs = run_scores(counts)
    frequent = F.col("uses") >= _least_uses(runs)
    table = runs.where(frequent).select("key", "log").toArrow()
    run_keys, run_logs = _column(table, "key"), _column(table, "log")
    by_key = np.argsort(run_keys)
    shared = spark.sparkContext.broadcast(((run_keys[by_key], run_logs[by_key]), keys[order], np.log10(n[order] + 1.0)))
    schema = "rid long, doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double, tail array<long>, runs array<long>"
    scored = docs.select(F.monotonically_increasing_id().alias("rid"), "doc_id", "held_out", "text").mapInArrow(partial(_scored, shared, uuid.uuid4().hex), schema)
    scored = written(scored, "scored")
    rare = counts.where("kind = 1").where(~often).select("key", "n")
    more = scored.select("rid", F.explode("tail").alias("key")).join(rare, "key").groupBy("rid").agg(F.sum(F.log10(F.col("n") + 1)).alias("more"), F.count("*").alias("also"))
    share = float(np.log10(total + distinct + 1.0))
    left = scored.select("rid", F.explode("runs").alias("key")).join(runs.where(~frequent), "key").groupBy("rid").agg(F.sum("log").alias("left"))
    out = scored.drop("tail", "runs").join(more, "rid", "left").join(left, "rid", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("also", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("logs") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * share).alias("base_score"),
        (F.col("score") + F.coalesce("left", F.lit(0.0))).alias("score"),
    )
