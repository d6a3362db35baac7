"""Near-duplicate detection by HyperMinHash sketches.

Every document becomes the set of its distinct word shingles. The sketch has REGISTERS buckets; a register holds the count of
leading zeros and MANTISSA following bits of the least hash that fell into its bucket. Registers are banded to find candidates,
a collision-corrected Jaccard estimate from the whole sketches drops the hopeless ones, and every link that stays is confirmed on
the full sets.

Scale. Documents with equal sets are one class from the start, so a group of copies is one sketch, whatever its size. Joins on keys that many rows
may share (the set of a group of copies, a band of registers, the centre of a bucket, a node with many links) deal such keys to several tasks. In a band
bucket, all members are first compared with one centre (as many pairs as members). Only buckets whose other members are not yet
in one component go on: a centre's members are dealt into blocks, and pairs of blocks are compared sketch by sketch in numpy, which
emits the members (not the pairs) that may have a link to another component. Those get the difference of their set from the centre's,
and pairs of blocks are compared again, exactly, on these differences; a tree of links is emitted. So a big bucket costs no
quadratic number of rows, no group is held by one task, and no component is missed. With four registers a band and 32 bands, a pair at a similarity of 0.85 misses
every band with probability (1 - 0.85**4)**32 < 1e-10 (at 0.8: < 1e-7).

Cases: a null or empty text, or one of white space alone, has an empty set and is linked with nothing; a text of fewer words than a
shingle has its whole word sequence as the one shingle; repeated rows share their class; an id with several texts links their groups, so its rows have one
component; rows without an id are reported with a null component and kept; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BROADCAST_ROWS, bound_batches, drop_written, join_small, slices, spread_join, string_buffers, word_lower_bytes, written

REGISTERS, MANTISSA, BAND = 128, 10, 4
#: Members of a block of a bucket that is compared all against all.
BLOCK = 1024
#: Standard errors by which an estimate may miss the threshold and still be confirmed on the sets.
SLACK = 5.0

_LOWER = word_lower_bytes()
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BASE = 0x9E3779B97F4A7C15 | 1
_powers: tuple[np.ndarray, np.ndarray] = (np.ones(1, np.uint64), np.ones(1, np.uint64))


def _pow_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    global _powers
    if len(_powers[0]) < n:
        size = 1 << (n - 1).bit_length()
        tables = []
        for base in (_BASE, pow(_BASE, -1, 2**64)):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.multiply.accumulate(table))
        _powers = (tables[0], tables[1])
    return _powers


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective finaliser over 64 bits."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all lower-cased words of a string column in order, and the offsets of its rows in them."""
    raw, at = string_buffers(column)
    if not len(raw):
        return np.zeros(0, np.uint64), np.zeros(len(at), np.int64)
    low = _LOWER[raw]
    inside = ~_SPACE[low]
    first = np.zeros(len(raw) + 1, bool)
    first[at] = True
    starts = inside.copy()
    starts[1:] &= ~inside[:-1] | first[1:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:] | first[1:-1]
    s, e = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    power, inverse = _pow_tables(len(raw) + 1)
    total = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum((low.astype(np.uint64) + np.uint64(1)) * power[: len(raw)], out=total[1:])
    return mix((total[e] - total[s]) * inverse[s]), np.searchsorted(s, at)


def shingle_sets(column: pa.Array, k: int) -> Iterator[np.ndarray]:
    """For each row, the sorted distinct 64-bit hashes of its k-word shingles."""
    words, at = word_hashes(column)
    key = np.uint64(0xD6E8FEB86659FD93)
    n = len(words) - k + 1
    if n > 0:
        joined = words[:n].copy()
        for i in range(1, k):
            joined = mix(joined * key + words[i : i + n])
    for a, b in zip(at[:-1].tolist(), at[1:].tolist(), strict=True):
        if b - a >= k:
            yield np.unique(joined[a : b - k + 1])
        elif b > a:
            whole = np.full(1, b - a, np.uint64)
            for w in words[a:b]:
                whole = mix(whole * key + w)
            yield whole
        else:
            yield np.zeros(0, np.uint64)


def sketch(hashes: np.ndarray) -> np.ndarray:
    """Registers (16 bits: leading zeros + 1, then the mantissa; 0: empty bucket) of sorted distinct hashes."""
    shift = np.uint64(64 - (REGISTERS - 1).bit_length())
    out = np.zeros(REGISTERS, np.uint16)
    if len(hashes):
        bucket = (hashes >> shift).astype(np.int64)
        least = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))
        rest = (hashes[least] << (np.uint64(64) - shift)) >> np.uint64(11)
        bits = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
        up = np.maximum(bits - MANTISSA - 1, 0).astype(np.uint64)
        down = np.maximum(MANTISSA + 1 - bits, 0).astype(np.uint64)
        mantissa = ((rest >> up) << down) & np.uint64((1 << MANTISSA) - 1)
        out[bucket[least]] = ((54 - bits).astype(np.uint64) << np.uint64(MANTISSA)) | mantissa
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimates of sketches (registers last), less the collisions that chance makes, and the buckets they rest on."""
    used = ((a | b) != 0).sum(-1)
    same = ((a == b) & (a != 0)).sum(-1)
    big, small = np.maximum(n_a, n_b).astype(float), np.maximum(np.minimum(n_a, n_b), 1).astype(float)
    ratio = small / np.maximum(big, 1)
    chance = 0.169919487159739 * used * 2.0**-MANTISSA * 4 * ratio / (1 + ratio) ** 2
    return (same - chance) / np.maximum(used, 1), used


def may_link(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, percent: int) -> np.ndarray:
    t = percent / 100
    found, used = estimate(a, b, n_a, n_b)
    sizes = 100 * np.minimum(n_a, n_b).astype(np.int64) >= percent * np.maximum(n_a, n_b).astype(np.int64)
    return sizes & (found >= t - SLACK * np.sqrt(t * (1 - t) / np.maximum(used, 1)))


def _mark(hashes: np.ndarray) -> bytes | None:
    """A name of a set: equal sets have the same, the empty set has none."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest() if len(hashes) else None


def _sketched(k: int, batches):
    for batch in slices(batches):
        n, mark, regs = [], [], []
        for hashes in shingle_sets(batch.column("text"), k):
            n.append(len(hashes))
            mark.append(_mark(hashes))
            regs.append(sketch(hashes).tobytes() if len(hashes) else None)
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(mark, pa.binary()), pa.array(regs, pa.binary())], ["doc_id", "n_shingles", "mark", "regs"])


def _bands(batches):
    """A row for each band of a sketch that is not empty: a 64-bit key of the band's number and registers."""
    odd = mix(np.arange(1, REGISTERS // BAND + 1, dtype=np.uint64))
    for batch in batches:
        regs = np.frombuffer(b"".join(batch.column("regs").to_pylist()), np.uint64).reshape(-1, REGISTERS // BAND)  # four 16-bit registers make 64 bits
        keys = mix(regs * np.uint64(_BASE) + odd)
        full = regs != 0
        rep = np.repeat(batch.column("rep").to_numpy(), full.sum(1))
        yield pa.RecordBatch.from_arrays([pa.array(keys[full].view(np.int64)), pa.array(rep)], ["key", "rep"])


def _pairs_pass(percent: int, batches):
    for batch in batches:
        if not batch.num_rows:
            continue
        a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS) for c in ("regs_a", "regs_b"))
        ok = may_link(a, b, batch.column("n_a").to_numpy(), batch.column("n_b").to_numpy(), percent)
        yield batch.select(["a", "b"]).filter(pa.array(ok))


def _sides(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, bool]:
    regs = np.frombuffer(b"".join(table.column("regs").to_pylist()), np.uint16).reshape(-1, REGISTERS)
    rep, comp, n, block = (table.column(c).to_numpy() for c in ("rep", "comp", "n_shingles", "block"))
    i, j = table.column("i")[0].as_py(), table.column("j")[0].as_py()
    return regs, rep, comp, n, np.flatnonzero(block == i), np.flatnonzero(block == j), i != j


def _likely_of(x: int, right: np.ndarray, two: bool, regs: np.ndarray, rep: np.ndarray, comp: np.ndarray, n: np.ndarray, percent: int) -> np.ndarray:
    """The members among `right` of another component than member x whose sketches are similar enough to its own."""
    y = right[(comp[right] != comp[x]) & ((rep[right] > rep[x]) | two)]
    return y[may_link(regs[x], regs[y], n[x], n[y], percent)] if len(y) else y


def _hopeful(percent: int, table: pa.Table) -> pa.Table:
    """Of the members of one or two blocks of a bucket: those with a partner of another component that may be similar enough."""
    regs, rep, comp, n, left, right, two = _sides(table)
    found = np.zeros(len(rep), bool)
    for x in left:
        y = _likely_of(x, right, two, regs, rep, comp, n, percent)
        found[y] = True
        found[x] |= len(y) > 0
    return table.select(["centre", "rep"]).filter(pa.array(found))


def _linked(percent: int, table: pa.Table) -> pa.Table:
    """Links between members of one or two blocks that are confirmed on the full sets; of links that close a circle, some are left out.

    The sets come as differences from their centre's set: the difference of two sets is the difference of those. Which values two differences
    share is a product of 0-1 matrices, for some columns at a time.
    """
    regs, rep, comp, n, left, right, two = _sides(table)
    apart = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("apart").combine_chunks()]
    size = np.array([len(x) for x in apart], np.int64)
    value, code = np.unique(np.concatenate(apart), return_inverse=True)
    often = np.bincount(code, minlength=len(value)) > 1
    code = np.where(often, np.cumsum(often) - 1, -1)[code]
    owner = np.repeat(np.arange(len(apart)), size)[code >= 0]
    code = code[code >= 0]
    shared = np.zeros((len(left), len(right)), np.int64)
    place_l, place_r = (np.full(len(rep), -1) for _ in range(2))
    place_l[left], place_r[right] = np.arange(len(left)), np.arange(len(right))
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    for at in range(0, int(often.sum()), 4096):
        part = slice(np.searchsorted(code, at), np.searchsorted(code, at + 4096))
        sides = []
        for place, count in ((place_l, len(left)), (place_r, len(right))):
            mine = place[owner[part]] >= 0
            m = np.zeros((count, 4096), np.float32)
            m[place[owner[part]][mine], code[part][mine] - at] = 1
            sides.append(m)
        shared += np.rint(sides[0] @ sides[1].T).astype(np.int64)
    both = n[left][:, None] + n[right][None, :]
    differ = size[left][:, None] + size[right][None, :] - 2 * shared
    linked = (100 * (both - differ) >= percent * (both + differ)) & (comp[left][:, None] != comp[right][None, :])  # |A & B| = (both - differ) / 2, |A | B| = (both + differ) / 2
    root = {int(c): int(c) for c in np.unique(comp)}

    def find(c: int) -> int:
        while root[c] != c:
            root[c] = c = root[root[c]]
        return c

    a, b = [], []
    for x, y in zip(*np.nonzero(linked), strict=True):
        i, j = left[x], right[y]
        p, q = find(int(comp[i])), find(int(comp[j]))
        if p != q:
            root[p] = q
            a.append(min(rep[i], rep[j]))
            b.append(max(rep[i], rep[j]))
    return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})


def _in_blocks(members: DataFrame) -> DataFrame:
    """Members (centre, rep, ...) dealt into blocks, once for each pair (i, j) of blocks of their centre that they belong to."""
    counts = written(members.groupBy("centre").agg(F.count("*").alias("n"), F.ceil(F.count("*") / BLOCK).cast("int").alias("blocks")), "counts")
    dealt = spread_join(members, counts, "centre", "n", ["rep"]).withColumn("block", F.pmod(F.xxhash64("rep", F.lit(7)), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return dealt.withColumn("i", F.least("block", "other")).withColumn("j", F.greatest("block", "other")).drop("blocks", "other")


def _apart(batches):
    """The values that are in one of set_a and set_b."""
    for batch in batches:
        out = [np.setxor1d(np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64), assume_unique=True).tobytes() for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True)]
        yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(out, pa.binary())], ["centre", "rep", "apart"])


def _sets(k: int, batches):
    for batch in slices(batches):
        sets = list(shingle_sets(batch.column("text"), k))
        yield pa.RecordBatch.from_arrays([pa.array([_mark(h) for h in sets], pa.binary()), pa.array([h.tobytes() for h in sets], pa.binary())], ["mark", "hashes"])


def _confirm(percent: int, batches):
    for batch in batches:
        ok = []
        for x, y in zip(batch.column("set_a"), batch.column("set_b"), strict=True):
            p, q = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
            shared = len(np.intersect1d(p, q, assume_unique=True))
            ok.append(100 * shared >= percent * (len(p) + len(q) - shared))
        yield batch.select(["a", "b"]).filter(pa.array(ok, pa.bool_()))


def with_sets(docs: DataFrame, classes: DataFrame, pairs: DataFrame, k: int, repeated: bool) -> DataFrame:
    """Written pairs (a, b) of classes with their full sets, made again from one text of each of these classes alone."""
    wanted = pairs.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    ids = written(classes.select("rep", "mark", "least").join(wanted, "rep", "left_semi"), "ids")
    texts = join_small(docs.select(F.col("doc_id").alias("least"), "text"), written(ids.select("least").distinct(), "least"), ["least"], "left_semi")
    sets = texts.mapInArrow(partial(_sets, k), "mark binary, hashes binary")
    if repeated:  # other texts of these ids, and other rows of one text
        sets = sets.groupBy("mark").agg(F.first("hashes").alias("hashes"))
    sets = written(join_small(sets, ids.select("rep", "mark"), ["mark"], "inner").select("rep", "hashes"), "sets")
    partners = pairs.groupBy(F.col("a").alias("rep")).agg(F.count("*").alias("n"))
    left = written(sets.join(partners, "rep").select(F.col("rep").alias("a"), F.col("hashes").alias("set_a"), "n"), "centre-sets")
    drop_written(ids)
    return spread_join(pairs, left, "a", "n", ["b"]).join(sets.select(F.col("rep").alias("b"), F.col("hashes").alias("set_b")), "b")


def components(links: DataFrame) -> DataFrame:
    """(node, comp) for each node of links (a, b): the least node it can reach. Least labels of neighbours, then of labels, until nothing changes."""
    both = written(links.select("a", "b").union(links.select("b", "a")), "both")
    label = written(both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m"), F.count("*").alias("n")).select("node", F.least("node", "m").alias("comp"), "n"), "label")
    small = label.count() <= BROADCAST_ROWS
    while True:
        if small:
            seen = both.join(F.broadcast(label.select(F.col("node").alias("b"), "comp")), "b")
        else:
            seen = spread_join(both, label.select(F.col("node").alias("b"), "comp", "n"), "b", "n", ["a"])
        near = seen.groupBy(F.col("a").alias("node")).agg(F.min("comp").alias("m"))
        step = label.join(near, "node").select("node", F.col("comp").alias("old"), F.least("comp", "m").alias("mid"), "n")
        if small:
            far = step.join(F.broadcast(label.select(F.col("node").alias("mid"), F.col("comp").alias("far"))), "mid", "left")
        else:
            step = written(step, "step")
            many = step.groupBy("mid").agg(F.count("*").alias("times"))
            far = spread_join(step, written(many.join(label.select(F.col("node").alias("mid"), F.col("comp").alias("far")), "mid"), "far"), "mid", "times", ["node"])
        after = written(far.select("node", "old", F.least("mid", "far").alias("comp"), "n"), "label")
        done = after.where("comp <> old").limit(1).count() == 0
        drop_written(label)
        label = after.select("node", "comp", "n")
        if done:
            drop_written(both)
            return label.select("node", "comp")


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """Groups documents linked by 100 * |shared shingles| >= percent * |all shingles|, directly or over others.

    Returns a row per row of docs: doc_id, n_shingles (size of its set), component_id (least doc_id of its group) and
    kept (doc_id = component_id).
    """
    bound_batches(docs.sparkSession)
    docs = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    base = written(docs.mapInArrow(partial(_sketched, words), "doc_id long, n_shingles long, mark binary, regs binary"), "sketch")
    known = base.where("mark is not null and doc_id is not null")
    classes = known.groupBy("mark", "regs", "n_shingles").agg(F.min("doc_id").alias("least"), F.count("*").alias("copies"))
    classes = written(classes.withColumn("rep", F.monotonically_increasing_id()), "class")
    twice = written(known.groupBy("doc_id").count().where("count > 1").select("doc_id"), "twice")
    repeated = twice.limit(1).count() > 0
    bands = classes.select("rep", "regs").mapInArrow(_bands, "key long, rep long")
    centres = written(bands.groupBy("key").agg(F.min("rep").alias("centre"), F.count("*").alias("n"), F.count("*").alias("size")).where("n > 1"), "centre")
    buckets = written(spread_join(bands, centres, "key", "n", ["rep"]), "bucket")
    regs = classes.select("rep", "regs", "n_shingles")
    sides = [regs.select(F.col("rep").alias(c), F.col("regs").alias(f"regs_{c}"), F.col("n_shingles").alias(f"n_{c}")) for c in "ab"]

    star = buckets.where("rep <> centre").select(F.col("centre").alias("a"), F.col("rep").alias("b")).distinct()
    likely = written(star.join(sides[0], "a").join(sides[1], "b").mapInArrow(partial(_pairs_pass, percent), "a long, b long"), "likely")
    links = with_sets(docs, classes, likely, words, repeated).mapInArrow(partial(_confirm, percent), "a long, b long").distinct()
    if repeated:
        texts = join_small(known.select("doc_id", "mark"), twice, ["doc_id"], "left_semi").distinct().join(classes.select("mark", "rep"), "mark")
        texts = written(texts.select("doc_id", "rep"), "texts")
        firsts = written(texts.groupBy("doc_id").agg(F.min("rep").alias("a"), F.count("*").alias("n")), "firsts")
        links = links.union(spread_join(texts, firsts, "doc_id", "n", ["rep"]).where("rep <> a").select("a", F.col("rep").alias("b"))).distinct()
    links = written(links, "links")
    comp = components(links)

    others = buckets.where("rep <> centre and size > 2").join(comp.withColumnRenamed("node", "rep"), "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    open_ = written(others.groupBy("key").agg(F.min("comp").alias("x"), F.max("comp").alias("y"), F.count("*").alias("n")).where("x <> y").select("key", "n"), "open-keys")
    members = written(spread_join(others, open_, "key", "n", ["rep"]).select("centre", "rep", "comp").distinct().join(regs, "rep"), "open")
    groups = _in_blocks(members).groupBy("centre", "i", "j")
    hopeful = written(groups.applyInArrow(lambda t: _hopeful(percent, t), "centre long, rep long").distinct(), "hopeful")
    if hopeful.limit(1).count():
        pairs = hopeful.select(F.col("centre").alias("a"), F.col("rep").alias("b"))
        apart = written(with_sets(docs, classes, pairs, words, repeated).mapInArrow(_apart, "centre long, rep long, apart binary"), "apart")
        groups = _in_blocks(written(members.join(apart, ["centre", "rep"]), "apart")).groupBy("centre", "i", "j")
        extra = written(groups.applyInArrow(lambda t: _linked(percent, t), "a long, b long").distinct(), "extra")
        comp = components(links.union(extra))
    drop_written(buckets, likely, centres)

    named = written(comp.withColumnRenamed("node", "rep").join(classes.select("rep", "least"), "rep"), "named")
    least = written(named.groupBy("comp").agg(F.min("least").alias("component"), F.count("*").alias("n")), "component")
    of_class = classes.join(spread_join(named, least, "comp", "n", ["rep"]).select("rep", "component"), "rep", "left")
    of_class = written(of_class.select("mark", F.coalesce("component", "least").alias("component"), "copies"), "of-class")
    some = spread_join(known.select("doc_id", "n_shingles", "mark", F.monotonically_increasing_id().alias("row")), of_class, "mark", "copies", ["row"])
    rest = base.where("mark is null or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component"))
    out = some.select("doc_id", "n_shingles", "component").union(rest).withColumnRenamed("component", "component_id")
    return out.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
