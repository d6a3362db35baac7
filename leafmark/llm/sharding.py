"""Sharding by a Feistel permutation with cycle walking over global row numbers.

Rows get gapless numbers in the order of (doc_id, checksum, size), null ids first. A keyed Feistel network over Z_a x Z_b, with a * b just above the number of rows,
permutes the numbers; a result beyond the last row is permuted again until it is one (cycle walking), so the result is a permutation of exactly
the rows. Position p is shard p mod n_shards, slot p div n_shards: shard sizes differ by one row at most, slots have no gaps, and any row's place
can be computed from its number, and the row from its place, without the other rows (inverse()).

Scale. One range partitioning by key, in which also rows of one id are split by their other keys; a count per partition gives the numbers; nothing
is gathered in one task.

Cases: a null text has no bytes (size 1, checksum 0); null ids come first; repeated rows get numbers of their own; an empty table gives an
empty result; all other columns are kept, those that have the name of a column added here under that name with `_source` after it.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import named, packed, written

ROUNDS, PRIME = 6, (1 << 31) - 1


class Feistel:
    """A permutation of range(n) chosen by a seed; works on int64 arrays. n is at most 2**60."""

    def __init__(self, n: int, seed: int) -> None:
        self.n = n
        self.a = max(1, math.isqrt(max(n - 1, 0)) + 1)
        self.b = max(1, -(-n // self.a))
        word = lambda j, what: int.from_bytes(hashlib.sha256(f"{seed}:{j}:{what}".encode()).digest()[:4], "little") % (PRIME - 1) + 1
        self.keys = [(word(j, "a"), word(j, "b"), word(j, "c")) for j in range(ROUNDS)]

    @staticmethod
    def _f(v: np.ndarray, key: tuple[int, int, int]) -> np.ndarray:
        x = (v % PRIME * key[0] + key[1]) % PRIME
        return (x * x + key[2]) % PRIME * (x | 1) % PRIME

    def _once(self, x: np.ndarray) -> np.ndarray:
        left, right = x % self.a, x // self.a
        for j, key in enumerate(self.keys):
            left, right = right, (left + self._f(right, key)) % (self.b if j % 2 else self.a)
        return right * self.a + left

    def _back(self, x: np.ndarray) -> np.ndarray:
        left, right = x % self.a, x // self.a
        for j, key in reversed(list(enumerate(self.keys))):
            left, right = (right - self._f(left, key)) % (self.b if j % 2 else self.a), left
        return right * self.a + left

    def _walk(self, x: np.ndarray, step) -> np.ndarray:
        out = step(x)
        while (far := out >= self.n).any():
            out[far] = step(out[far])
        return out

    def permute(self, x: np.ndarray) -> np.ndarray:
        return self._walk(np.asarray(x, np.int64), self._once)

    def inverse(self, x: np.ndarray) -> np.ndarray:
        return self._walk(np.asarray(x, np.int64), self._back)


def numbered(df: DataFrame, keys: list[str], name: str) -> tuple[DataFrame, int]:
    """df, written to the shared folder, with gapless row numbers in the order of keys; and the number of rows."""
    mid = f"_{name}_id"
    rows = written(df.repartitionByRange(*keys, F.monotonically_increasing_id()).sortWithinPartitions(*keys).withColumn(mid, F.monotonically_increasing_id()), "numbered")
    part = F.shiftright(mid, 33)
    counts = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))  # as many rows as partitions
    before = counts.withColumn("_before", F.sum("_n").over(Window.orderBy("_part")) - F.col("_n"))
    total = counts.agg(F.coalesce(F.sum("_n"), F.lit(0))).first()[0]
    out = rows.withColumn("_part", part).join(F.broadcast(before.drop("_n")), "_part")
    return out.withColumn(name, F.col("_before") + F.col(mid).bitwiseAND(F.lit((1 << 33) - 1))).drop("_part", "_before", mid), total


def sharded(docs: DataFrame, n_shards: int, seed: int, keep: list[str] | None = None, add: tuple[str, ...] = ("size", "text_crc32", "shard", "slot")) -> DataFrame:
    """docs (or the columns `keep` of it, and no others) with size, text_crc32, shard and slot, or those of them that `add` names."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    kept = docs.columns if keep is None else keep
    sized = docs.select(packed(*[named(c) for c in kept]), F.col("doc_id").alias("id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"))
    rows, total = numbered(sized, ["id", "text_crc32", "size"], "place")
    feistel = Feistel(total, seed)

    @F.pandas_udf("long")
    def place(row: pd.Series) -> pd.Series:
        return pd.Series(feistel.permute(row.to_numpy()))

    at = rows.withColumn("place", place("place")).withColumn("shard", (F.col("place") % n_shards).cast("int")).withColumn("slot", F.expr(f"place div {n_shards}"))
    taken, columns = {c.lower() for c in (*add, *kept)}, []
    for c in kept:
        name = c
        if c.lower() in add:
            while name.lower() in taken:
                name += "_source"
            taken.add(name.lower())
        columns.append(F.col("row").getField(c).alias(name))
    return at.select(*columns, *add)
