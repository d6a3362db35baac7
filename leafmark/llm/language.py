"""Language identification as mixture inference.

Learned: for each language, the distribution of hashed byte trigrams (letters lower-cased if ASCII, everything that is no letter or non-ASCII byte
counts as a space). For a document, expectation-maximisation estimates the shares of the languages in its trigrams. The set of
languages is chosen by penalised likelihood: the log-likelihood less PENALTY * (languages - 1) * ln(trigrams) / 2. The sets tried are the one, two,
... languages with the largest shares in the full mixture, as long as the full mixture's likelihood, which bounds that of every set, less the penalty
beats the best value found; most
documents need no second estimation. A document is rejected if it has no letter, or if even its best set explains it worse than
equally likely trigrams do.

Scale. Learning counts into one dense table per task and sums them in a shuffle; the model has languages * BUCKETS numbers, whatever the corpus, with
MAX_LANGUAGES languages at most (else an error). Prediction reads each whole text once and shuffles nothing.

Cases: a null text or one without a letter is `und` with score 0; without labelled rows everything is `und`; rows with null text or language
teach nothing; repeated rows are judged one by one; columns that are kept may have any names, but those of the columns added here replace theirs.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import bound_batches, named, packed, slices, string_buffers, unpacked

BUCKET_BITS = 16
BUCKETS = 1 << BUCKET_BITS
MAX_LANGUAGES = 256
SMOOTHING, PENALTY, STEPS = 0.1, 4.0, 15
MADE = ["lang_pred", "score", "languages", "accepted"]

_LETTERS = np.full(256, 32, np.uint8)
_LETTERS[97:123] = np.arange(97, 123)
_LETTERS[65:91] = np.arange(97, 123)
_LETTERS[128:] = np.arange(128, 256)
_LETTER = regex.compile(r"\p{L}")


def trigrams(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bucket and the row of each trigram that has a letter; every text stands between two spaces."""
    raw, at = string_buffers(column)
    n = np.diff(at)
    rows = np.arange(len(n))
    text = np.full(len(raw) + 2 * len(n), 32, np.uint8)
    owner = np.repeat(rows, n + 2)
    text[np.arange(len(raw)) + np.repeat(2 * rows + 1, n)] = _LETTERS[raw]
    if len(text) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key = text[:-2].astype(np.uint32) | text[1:-1].astype(np.uint32) << np.uint32(8) | text[2:].astype(np.uint32) << np.uint32(16)
    keep = (owner[:-2] == owner[2:]) & (key != 0x202020)
    return ((key[keep] * np.uint32(0x9E3779B1)) >> np.uint32(32 - BUCKET_BITS)).astype(np.int64), owner[:-2][keep]


def _counted(languages: list[str], batches):
    number = {x: i for i, x in enumerate(languages)}
    table = np.zeros(len(languages) * BUCKETS, np.int64)
    for batch in slices(batches):
        bucket, row = trigrams(batch.column("text"))
        lang = np.array([number[x] for x in batch.column("lang").to_pylist()], np.int64)
        np.add(table, np.bincount(lang[row] * BUCKETS + bucket, minlength=len(table)), out=table)
    at = np.flatnonzero(table)
    for i in range(0, len(at), 200_000):
        part = at[i : i + 200_000]
        yield pa.RecordBatch.from_arrays([pa.array(part), pa.array(table[part])], ["at", "n"])


class Languages:
    """Names, and the probability of each bucket (buckets first)."""

    def __init__(self, names: list[str], counts: np.ndarray) -> None:
        self.names = names
        counts = counts.reshape(len(names), BUCKETS).astype(np.float64) + SMOOTHING
        self.p = np.ascontiguousarray((counts / counts.sum(1, keepdims=True)).T)


def learn(labelled: DataFrame) -> Languages:
    """The trigram models of all languages of labelled (text, lang)."""
    bound_batches(labelled.sparkSession)
    rows = labelled.where("text is not null and lang is not null").select(F.col("text").cast("string"), F.col("lang").cast("string"))
    names = [r[0] for r in rows.select("lang").distinct().limit(MAX_LANGUAGES + 1).collect()]
    if len(names) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    names.sort()
    counts = np.zeros(len(names) * BUCKETS, np.int64)
    if names:
        table = rows.mapInArrow(partial(_counted, names), "at long, n long").groupBy("at").agg(F.sum("n").alias("n")).toArrow()
        if table.num_rows:
            counts[table.column("at").to_numpy()] = table.column("n").to_numpy()
    return Languages(names, counts)


def mixture(p: np.ndarray, weight: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Shares and log-likelihoods by EM. p: a row per distinct trigram of a document; first: where each document's rows begin; allowed: documents x languages."""
    size = np.diff(np.append(first, len(p)))
    total = np.add.reduceat(weight, first)
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(STEPS):
        joint = p * np.repeat(share, size, 0)
        joint *= (weight / joint.sum(1))[:, None]
        share = np.add.reduceat(joint, first, 0) / total[:, None]
    like = (p * np.repeat(share, size, 0)).sum(1)
    return share, np.add.reduceat(weight * np.log(like), first)


def judge(model: Languages, column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Shares of the chosen languages (0: not chosen), and whether they explain the text better than chance; rows without a trigram have no share."""
    n_rows, n_lang = len(column), len(model.names)
    shares, accepted = np.zeros((n_rows, n_lang)), np.zeros(n_rows, bool)
    bucket, row = trigrams(column)
    if not len(bucket) or not n_lang:
        return shares, accepted
    key, count = np.unique(row * BUCKETS + bucket, return_counts=True)
    row, p, weight = key >> BUCKET_BITS, model.p[key & (BUCKETS - 1)], count.astype(np.float64)
    first = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
    docs, size = row[first], np.diff(np.append(first, len(row)))
    total = np.add.reduceat(weight, first)
    cost = PENALTY * np.log(np.maximum(total, 2)) / 2
    share, bound = mixture(p, weight, first, np.ones((len(docs), n_lang)))
    rank = np.argsort(-share, 1, kind="stable")
    single = np.zeros_like(share)
    single[np.arange(len(docs)), rank[:, 0]] = 1
    value = np.add.reduceat(weight * np.log((p * np.repeat(single, size, 0)).sum(1)), first)
    best = single
    for k in range(2, n_lang + 1):
        left = np.flatnonzero(bound - (k - 1) * cost > value)
        if not len(left):
            break
        rows = np.repeat(np.isin(np.arange(len(docs)), left), size)
        allowed = np.zeros((len(left), n_lang))
        np.put_along_axis(allowed, rank[left, :k], 1, 1)
        part, like = mixture(p[rows], weight[rows], np.concatenate(([0], np.cumsum(size[left])[:-1])), allowed)
        better = like - (k - 1) * cost[left] > value[left]
        value[left[better]] = (like - (k - 1) * cost[left])[better]
        best[left[better]] = part[better]
    shares[docs] = best
    accepted[docs] = value > -total * np.log(BUCKETS)
    return shares, accepted


def _identified(shared, batches):
    model = shared.value
    names = np.array([*model.names, "und"], object)
    spans = pa.list_(pa.struct([("lang", pa.string()), ("share", pa.float64())]))
    for batch in slices(batches, "text", most=max(1 << 16, (2 << 20) * 8 // max(8, len(model.names)))):
        text = batch.column("text")
        shares, accepted = judge(model, text)
        letters = np.array([t is not None and _LETTER.search(t) is not None for t in text.to_pylist()], bool)
        known = letters & (shares.sum(1) > 0)
        top = shares.argmax(1) if model.names else np.zeros(batch.num_rows, np.int64)
        score = np.where(known, shares.max(1, initial=0.0), 0.0)
        mixed = [[{"lang": names[j], "share": float(s[j])} for j in np.argsort(-s, kind="stable") if s[j] > 0] if k else [] for s, k in zip(shares, known, strict=True)]
        made = [pa.array(names[np.where(known, top, len(model.names))], pa.string()), pa.array(np.clip(score, 0, 1)), pa.array(mixed, spans), pa.array(known & accepted)]
        yield pa.RecordBatch.from_arrays([batch.column("row"), *made], ["row", *MADE])


def identify(docs: DataFrame, labelled: DataFrame, *keep: Column | str) -> DataFrame:
    """A row per row of docs: the columns `keep` (all, if none is given), lang_pred, score (share of that language), languages (chosen ones with
    shares) and accepted."""
    rows = _identify(docs, labelled, *keep)
    return rows.select(*unpacked(rows, MADE), *MADE)


def accepted(docs: DataFrame, labelled: DataFrame) -> DataFrame:
    """The rows of docs, as they are, whose language is accepted."""
    rows = _identify(docs, labelled).where("accepted")
    return rows.select(*unpacked(rows))


def _identify(docs: DataFrame, labelled: DataFrame, *keep: Column | str) -> DataFrame:
    bound_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(learn(labelled))
    rows = docs.select(packed(*(keep or [named(c) for c in docs.columns])), F.col("text").cast("string").alias("text"))
    schema = T.StructType([rows.schema["row"], *T._parse_datatype_string("lang_pred string, score double, languages array<struct<lang: string, share: double>>, accepted boolean").fields])
    return rows.mapInArrow(partial(_identified, shared), schema)
