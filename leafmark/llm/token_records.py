"""Token ids as length-delimited binary records, with a separate offset index.

A shard file is a run of frames:  length (8 bytes) | masked checksum of those 8 bytes (4) | payload | masked checksum of the payload (4) | 0x0A.
All numbers are little-endian; a checksum is a CRC-32 turned by 15 bits, plus 0xA282EAD8. The payload is  id (8) | has id (1) |
bytes of a token id (1: 2 or 4) | number of ids (4) | ids.  The last byte of a frame lets Spark's own line writer put frames into files
on any Hadoop file system under its commit protocol, so a lost executor or a retried task leaves no broken or double file.

The index (Parquet, folder `index`) has file, ordinal, offset, length, doc_id, n_tokens, start (ids of all records before) and ids_crc32
for each record; read_records() fetches any subset of it, in any order, without reading frames one after another.

Scale. Documents are range-partitioned by id and sorted within partitions, so file order is id order without a global sort in one task. A worker
hands frames on in bundles of at least a megabyte and at least the largest frame, so a bundle is less than two such; a file holds as many bundles
as keep it within FILE_BYTES (one, if the largest document alone is beyond it). Only per-file totals are summed in one place.

Cases: a null or empty text has just the end id; strings of a tokenizer's special tokens in a text become those tokens, as the library's encode() has it;
a null id is kept (it sorts first, has id 0); rows with one id are ordered by their text's hash; an empty table gives an empty index; other columns are
ignored. A checksum that fails is an error. A document whose frame is beyond 2 GB cannot be read back by Spark.
"""

from __future__ import annotations

import json
import os
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator
from functools import partial
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import bound_batches, drop_written, join_small, new_path, slices, string_buffers, written

FILE_BYTES, BUNDLE_BYTES = 64 << 20, 1 << 20
#: Pieces whose ids a worker remembers in each of two generations.
PIECES = 400_000

#: Bytes of text that are cut into pieces at a time, and characters beyond which a piece is not remembered.
WINDOW, LONG = 4 << 20, 64

_HEAD = struct.Struct("<qBBI")

#: A byte-level model's character for each byte: itself if it prints, else the next from 256 on.
_PRINTS = [*range(33, 127), *range(161, 173), *range(174, 256)]
_BYTE_CHARS = {b: b for b in _PRINTS} | {b: 256 + i for i, b in enumerate(sorted(set(range(256)) - set(_PRINTS)))}
_SPACE = chr(_BYTE_CHARS[32])

#: What a byte is: part of a letter, a digit, a mark (no apostrophe: it may begin a piece with letters), white space of three kinds, a byte to look behind.
_OTHER, _LETTER, _DIGIT, _MARK, _WHITE, _BLANK, _NEWLINE, _LEAD = range(8)
_KINDS = np.full(256, _OTHER, np.uint8)
_KINDS[33:127] = _MARK
_KINDS[[*range(65, 91), *range(97, 123)]] = _LETTER
_KINDS[48:58] = _DIGIT
_KINDS[39] = _OTHER
_KINDS[[9, 11, 12, 13, 28, 29, 30, 31]] = _WHITE
_KINDS[32], _KINDS[10] = _BLANK, _NEWLINE
_KINDS[[0xC2, 0xC3, 0xE1, 0xE2, 0xE3]] = _LEAD
_WIDE = np.array([0x1680, 0x180E, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000])


def _kinds(raw: np.ndarray) -> np.ndarray:
    """The kind of each byte of UTF-8. Beside ASCII only the letters from U+00C0 to U+00FF and white space are told apart."""
    kind = _KINDS[raw]
    look = np.flatnonzero(kind == _LEAD)
    if len(look):
        kind[look] = _OTHER
        look = look[look < len(raw) - 1]
        lead, second = raw[look], raw[look + 1]
        for found, what in (((lead == 0xC3) & (second != 0x97) & (second != 0xB7), _LETTER), ((lead == 0xC2) & ((second == 0x85) | (second == 0xA0)), _WHITE)):
            kind[look[found]] = kind[look[found] + 1] = what
        look = look[(lead >= 0xE1) & (look < len(raw) - 2)]
        point = (raw[look].astype(np.int64) & 15) << 12 | (raw[look + 1].astype(np.int64) & 63) << 6 | raw[look + 2] & 63
        look = look[np.isin(point, _WIDE)]
        kind[look] = kind[look + 1] = kind[look + 2] = _WHITE
    return kind


class Remembered(dict):
    """Ids of strings, worked out by `make` when first asked for. Two generations: what is not asked for while a new one fills up is forgotten."""

    def __init__(self, most: int, make: Callable[[str], bytes]) -> None:
        self.most, self.make, self.old = most, make, {}

    def __missing__(self, key: str) -> bytes:
        if len(key) > LONG:
            return self.make(key)
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(key)
        self[key] = ids = self.make(key) if ids is None else ids
        return ids


class PieceEncoder:
    """Encodes whole texts. A byte-level tokenizer's own split always begins a new piece where letters, digits and marks meet each other, at a lone space
    between two characters that are no white space, and at and after such a line end. There texts are cut, equal pieces are encoded once, and the ids are
    those of the whole text. Texts with a special string, and those of other tokenizers, are not cut."""

    def __init__(self, path: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        with open(path) as f:
            spec = json.load(f)
        pre = spec.get("pre_tokenizer") or {}
        self.special = [x["content"] for x in spec.get("added_tokens") or []]
        self.cuts = not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.tokenize, self.code = self.tokenizer.model.tokenize, self.dtype.char
        self.pieces, self.plain = Remembered(PIECES, self._piece), Remembered(PIECES, self._plain)

    def _plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        """Ids of what is one piece of the tokenizer's split: letters, digits or marks, maybe after a space. The tokenizer's model gets it without that split."""
        if piece.isascii():
            chars = _SPACE + piece[1:] if piece[0] == " " else piece
        else:
            chars = piece.encode().decode("latin-1").translate(_BYTE_CHARS)
        return array(self.code, [t.id for t in self.tokenize(chars)]).tobytes()

    def encode(self, texts: pa.Array) -> list[bytes]:
        """Ids of each text. All texts are cut together, and what they share is looked up once."""
        texts = texts.fill_null("")
        whole = np.full(len(texts), not self.cuts)
        for content in self.special if self.cuts else []:
            whole |= pc.match_substring(texts, content).to_numpy(zero_copy_only=False)
        if not whole.any():
            return self._joined(*string_buffers(texts))
        cut = iter(self._joined(*string_buffers(texts.filter(pa.array(~whole)))))
        return [self._plain(texts[i].as_py()) if w else next(cut) for i, w in enumerate(whole.tolist())]

    def _joined(self, raw: np.ndarray, at: np.ndarray) -> list[bytes]:
        """Ids of the texts between the places `at`."""
        first = np.zeros(len(raw) + 1, bool)
        first[at] = True
        rows, parts, n, here = np.zeros(len(at), np.int64), [], 0, 0
        while here < len(raw):
            starts, plain, end = self._cut(raw, first, here)
            tokens, before = self._looked_up(raw[here:end], starts, plain)
            a, b = np.searchsorted(at, [here, end])
            rows[a:b] = n + before[np.searchsorted(starts, at[a:b] - here)]
            parts.append(tokens)
            n, here = n + len(tokens), end
        rows[np.searchsorted(at, len(raw)) :] = n
        tokens = parts[0] if len(parts) == 1 else np.concatenate([np.zeros(0, np.uint8), *parts])
        return [tokens[a:b].tobytes() for a, b in pairwise(rows.tolist())]

    def _cut(self, raw: np.ndarray, first: np.ndarray, here: int) -> tuple[np.ndarray, np.ndarray, int]:
        """The places, from `here` on, at which pieces of the next window begin; which of them need the tokenizer's split; and where the window ends."""
        size = WINDOW
        while True:
            end = min(here + size, len(raw))
            kind = _kinds(raw[here:end])
            known = kind - np.uint8(1) < 3  # letter, digit or mark: 0 becomes 255
            cut = first[here:end].copy()
            cut[1:] |= (kind[1:] != kind[:-1]) & known[1:] & known[:-1]
            solid = kind < _WHITE
            lone = np.flatnonzero((kind[1:-1] >= _BLANK) & solid[:-2] & solid[2:]) + 1
            cut[lone] = True
            cut[lone[kind[lone] == _NEWLINE] + 1] = True
            cut[0] = True
            if end < len(raw):  # the last bytes may be part of a character, or before one that is not seen
                cut[-8:] = False
            starts = np.flatnonzero(cut)
            if end == len(raw):
                break
            if len(starts) > 1:
                starts, end = starts[:-1], here + int(starts[-1])
                break
            size *= 2
        known[starts[kind[starts] == _BLANK]] = True
        return starts, ~np.logical_and.reduceat(known[: end - here], starts), end

    def _looked_up(self, raw: np.ndarray, starts: np.ndarray, plain: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the pieces as bytes, and where those of each piece begin; the end of the last one."""
        offsets = np.append(starts, len(raw))
        found = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(raw)).dictionary_encode()
        split = np.zeros(len(found.dictionary), bool)
        split[found.indices.to_numpy()[plain]] = True
        ids = [self.plain[x] if s else self.pieces[x] for x, s in zip(found.dictionary.to_numpy(zero_copy_only=False), split.tolist(), strict=True)]
        out = pa.array(ids, pa.large_binary()).take(found.indices)
        _, ends, data = out.buffers()
        return np.frombuffer(data or b"", np.uint8), np.frombuffer(ends, np.int64)[: len(out) + 1]


_encoders: dict[str, PieceEncoder] = {}


def masked(data: bytes) -> int:
    crc = zlib.crc32(data)
    return (((crc >> 15) | (crc << 17)) + 0xA282EAD8) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    length = struct.pack("<Q", len(payload))
    return b"".join((length, struct.pack("<I", masked(length)), payload, struct.pack("<I", masked(payload)), b"\n"))


def unframe(data: memoryview, at: int) -> tuple[memoryview, int]:
    """The payload of the frame at `at`, and where the next one begins."""
    length = struct.unpack_from("<Q", data, at)[0]
    end = at + 12 + length
    if masked(data[at : at + 8]) != struct.unpack_from("<I", data, at + 8)[0] or masked(data[at + 12 : end]) != struct.unpack_from("<I", data, end)[0]:
        raise ValueError(f"a record's checksum is wrong at byte {at}")
    return data[at + 12 : end], end + 5


def parse(payload: memoryview) -> tuple[int | None, np.ndarray]:
    doc_id, has_id, width, n = _HEAD.unpack_from(payload, 0)
    return doc_id if has_id else None, np.frombuffer(payload, f"<u{width}", n, _HEAD.size)


def _framed(path: str, end_id: int, bundle: int, batches):
    if path not in _encoders:
        _encoders[path] = PieceEncoder(path)
    encoder = _encoders[path]
    end = np.array([end_id], encoder.dtype).tobytes()
    width = encoder.dtype.itemsize
    held, size = [], 0
    for batch in slices(batches, most=4 << 20):
        out = []
        for doc_id, ids in zip(batch.column("doc_id").to_pylist(), encoder.encode(batch.column("text")), strict=True):
            ids += end
            held.append(frame(_HEAD.pack(doc_id or 0, doc_id is not None, width, len(ids) // width) + ids))
            size += len(held[-1])
            if size >= bundle:
                out.append(b"".join(held)[:-1])
                held, size = [], 0
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.binary())], ["frames"])
    if held:
        yield pa.RecordBatch.from_arrays([pa.array([b"".join(held)[:-1]], pa.binary())], ["frames"])


def _listed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["file", "ordinal", "offset", "length", "doc_id", "n_tokens", "before", "ids_crc32"]
    for batch in batches:
        for path, content in zip(batch.column("path").to_pylist(), batch.column("content"), strict=True):
            data, at, before, ordinal, rows = memoryview(content.as_buffer()), 0, 0, 0, []
            while at < len(data):
                payload, after = unframe(data, at)
                doc_id, ids = parse(payload)
                rows.append((path, ordinal, at, after - at, doc_id, len(ids), before, zlib.crc32(ids.astype("<u4").tobytes())))
                at, before, ordinal = after, before + len(ids), ordinal + 1
                if len(rows) == 50_000 or at == len(data):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string() if i == 0 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))], names)
                    rows = []


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """Writes the shard files (folder `shards`) and the index of docs (doc_id, text) below path."""
    bound_batches(docs.sparkSession)
    spark = docs.sparkSession
    keyed = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    largest = keyed.agg(F.coalesce(F.max(F.octet_length("text")), F.lit(0))).first()[0]
    bundle = max(BUNDLE_BYTES, 4 * (largest + 16))  # a token id takes 4 bytes at most and stands for a byte at least
    frames = keyed.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(partial(_framed, tokenizer, end_id, bundle), "frames binary")
    frames.select(F.col("frames").cast("string")).write.option("maxRecordsPerFile", max(1, FILE_BYTES // (2 * bundle))).option("compression", "none").text(f"{path}/shards")
    files = spark.read.format("binaryFile").load(f"{path}/shards").select("path", "content")
    rows = written(files.mapInArrow(_listed, "file string, ordinal long, offset long, length long, doc_id long, n_tokens long, before long, ids_crc32 long"), "records")
    # Spark numbers files by task, then by file of the task; there are as many rows here as files
    place = F.struct(F.regexp_extract("file", r"part-(\d+)", 1).cast("int"), F.regexp_extract("file", r"-c(\d+)", 1).cast("int"))
    totals = rows.groupBy("file").agg(F.sum("n_tokens").alias("n")).withColumn("file_start", F.sum("n").over(Window.orderBy(place)) - F.col("n"))
    totals = written(totals.drop("n"), "totals")
    join_small(rows, totals, ["file"], "inner").withColumn("start", F.col("file_start") + F.col("before")).drop("before", "file_start").write.parquet(f"{path}/index")
    drop_written(rows, totals)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/index")


def _fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for content, wanted in zip(batch.column("content"), batch.column("wanted").to_pylist(), strict=True):
            data, ranks, ids, tokens = memoryview(content.as_buffer()), [], [], []
            for w in wanted:
                doc_id, found = parse(unframe(data, w["offset"])[0])
                ranks.append(w["rank"])
                ids.append(doc_id)
                tokens.append(found.astype(np.int32))
            yield pa.RecordBatch.from_arrays([pa.array(ranks, pa.int64()), pa.array(ids, pa.int64()), pa.array(tokens, pa.list_(pa.int32()))], ["rank", "doc_id", "ids"])


def read_records(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame:
    """The records of some rows of the index (columns file, offset and rank, an order of the caller's): rank, doc_id, ids. Files are read whole, and are at most FILE_BYTES long unless one document is."""
    bound_batches(spark)
    by_file = wanted.groupBy("file").agg(F.collect_list(F.struct("offset", "rank")).alias("wanted"))
    files = spark.read.format("binaryFile").load(f"{path}/shards").select(F.col("path").alias("file"), "content")
    return files.join(by_file, "file").select("content", "wanted").mapInArrow(_fetched, "rank long, doc_id long, ids array<int>")


def shuffled_index(spark: SparkSession, path: str, seed: int) -> DataFrame:
    """The index with a rank that puts the records into a reproducible random order."""
    return read_index(spark, path).withColumn("rank", F.xxhash64(F.lit(seed), "start"))


def token_table(docs: DataFrame, tokenizer: str, end_id: int) -> DataFrame:
    """Writes docs to a new place in the shared folder and returns doc_id, start, n_tokens and ids_crc32 of the records as read back."""
    path = new_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, tokenizer, end_id)
    return read_index(docs.sparkSession, path).select("doc_id", "start", "n_tokens", "ids_crc32")
