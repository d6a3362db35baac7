"""Chat formatting by columnar byte assembly.

A turn is  <|im_start|>role\\ntext<|im_end|>\\n . Inside a role or text every "<", backslashes, "|" gets one backslash more, so no control string can
appear there, and taking one away gives the source back; a role's own backslashes and line ends are escaped first.

For a batch of turns the lengths of headers, contents and ends give cumulative offsets; scatter indices made in numpy copy all header bytes
and all content bytes into one preallocated buffer, which becomes an Arrow string column without another copy.

Scale. Turns are hash-partitioned by conversation and sorted within partitions (Spark's sort spills), and worked off as a stream. A
conversation comes as one row, or, beyond PART_BYTES, as several parts in order, so memory is bounded also where one conversation holds a
third of all rows.

Cases: a null text or role is empty; a null conv_id is a conversation of its own; turns of one number are ordered by role, then text, null first;
repeated rows are all formatted; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bound_batches, slices, string_buffers

PART_BYTES = 2 << 20
START, END = "<|im_start|>", "<|im_end|>\n"
FORMATTED = "conv_id long, part int, n_turns long, formatted string, loss array<struct<start: long, end: long>>"

_UNESCAPE = re.compile(r"<(\\*)\\\|")
_ROLE = re.compile(r"\\(.)", re.S)


def _escaped(column: pa.Array) -> pa.Array:
    return pc.replace_substring_regex(column, r"<(\\*)\|", r"<\1\\|")


def unescape(text: str) -> str:
    return _UNESCAPE.sub(r"<\1|", text)


def unescape_role(role: str) -> str:
    return _ROLE.sub(lambda m: "\n" if m[1] == "n" else m[1], unescape(role))


def assemble(roles: pa.Array, texts: pa.Array, first: np.ndarray) -> tuple[pa.Array, list[list[dict]]]:
    """Formatted conversations, whose first turns are given, and the byte spans of their assistants' texts."""
    roles = roles.dictionary_encode()
    headers = [f"{START}{r}\n".encode() for r in _escaped(pc.replace_substring(pc.replace_substring(roles.dictionary, "\\", "\\\\"), "\n", "\\n")).to_pylist()]
    pool = np.frombuffer(b"".join(headers), np.uint8)
    pool_len = np.array([len(h) for h in headers], np.int64)
    pool_at = np.cumsum(pool_len) - pool_len
    which = roles.indices.to_numpy().astype(np.int64)
    content, at = string_buffers(_escaped(texts))
    end = np.frombuffer(END.encode(), np.uint8)
    n = len(which)
    lengths = np.stack((pool_len[which], np.diff(at), np.full(n, len(end))), 1)
    places = np.concatenate(([0], np.cumsum(lengths.ravel())))
    head, body, tail = (places[:-1].reshape(n, 3)[:, i] for i in range(3))
    out = np.empty(places[-1], np.uint8)
    size = lengths[:, 0]
    step = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    out[np.repeat(head, size) + step] = pool[np.repeat(pool_at[which], size) + step]
    out[np.arange(len(content)) + np.repeat(body - at[:-1], lengths[:, 1])] = content
    out[tail[:, None] + np.arange(len(end))] = end
    offsets = np.append(places[::3][:-1][first], places[-1]).astype(np.int32)
    assistant = np.array([r == "assistant" for r in roles.dictionary.to_pylist()], bool)[which]
    conv = np.searchsorted(first, np.arange(n), "right") - 1
    spans: list[list[dict]] = [[] for _ in first]
    for i in np.flatnonzero(assistant).tolist():
        base = int(offsets[conv[i]])
        spans[conv[i]].append({"start": int(body[i]) - base, "end": int(tail[i]) - base})
    return pa.StringArray.from_buffers(len(first), pa.py_buffer(offsets), pa.py_buffer(out)), spans


def _formatted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(table: pa.Table, part: int) -> pa.RecordBatch:
        ids = table.column("conv_id").to_pylist()
        first = np.array([i for i in range(len(ids)) if not i or ids[i] != ids[i - 1]], np.int64)
        text, spans = assemble(table.column("role").combine_chunks(), table.column("text").combine_chunks(), first)
        parts = [part, *[0] * (len(first) - 1)]
        loss = pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.RecordBatch.from_arrays([pa.array([ids[i] for i in first], pa.int64()), pa.array(parts, pa.int32()), pa.array(np.diff(np.append(first, len(ids)))), text, loss], ["conv_id", "part", "n_turns", "formatted", "loss"])

    held: pa.Table | None = None  # the turns so far of a conversation that may go on
    part = 0
    for batch in slices(batches, most=PART_BYTES):
        table = pa.Table.from_batches([batch])
        if held is not None:
            if held.column("conv_id")[0].as_py() != table.column("conv_id")[0].as_py():
                yield rows(held, part)
                held, part = None, 0
            elif held.nbytes > PART_BYTES:
                yield rows(held, part)
                held, part = None, part + 1
            else:
                table = pa.concat_tables([held, table])
        ids = table.column("conv_id").to_pylist()
        cut = len(ids) - 1
        while cut and ids[cut - 1] == ids[-1]:
            cut -= 1
        if cut:
            yield rows(table.slice(0, cut), part)
            part = 0
        held = table.slice(cut).combine_chunks()
    if held is not None:
        yield rows(held, part)


def format_conversations(turns: DataFrame) -> DataFrame:
    """Formatted conversations (conv_id, part, n_turns, formatted, loss: byte spans of assistants' texts), from turns (conv_id, turn, role, text)."""
    bound_batches(turns.sparkSession)
    rows = turns.select(F.col("conv_id").cast("long"), F.col("turn").cast("long"), *[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("role", "text")])
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", "turn", "role", "text").select("conv_id", "role", "text").mapInArrow(_formatted, FORMATTED)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The roles and texts of a formatted conversation or part."""
    turns = []
    for segment in formatted.split(START)[1:]:
        role, _, text = segment.removesuffix(END).partition("\n")
        turns.append((unescape_role(role), unescape(text)))
    return turns


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
    state: list | None = None

    def close() -> list:
        return [state[0], state[1], state[2].hexdigest(), state[3], state[4].hexdigest(), state[5]]

    for batch in batches:
        done = []
        for conv, part, formatted, loss in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "part", "formatted", "loss")), strict=True):
            if state is not None and part == 0:
                done.append(close())
                state = None
            if state is None:
                state = [conv, 0, hashlib.sha256(), 0, hashlib.sha256(), 0, 0]
            if (state[0], state[6]) != (conv, part):
                raise ValueError(f"part {part} of conversation {conv} does not follow its part {part - 1}; use ordered=False")
            state[6] += 1
            for role, text in parse(formatted):
                state[1] += 1
                state[2].update(f"{role}\n{text}\n".encode())
            raw = formatted.encode()
            for span in loss:
                text = unescape(raw[span["start"] : span["end"]].decode())
                state[3] += len(text)
                state[4].update(text.encode())
            state[5] += len(formatted)
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*done, strict=True) if done else [[]] * 6, kinds, strict=True)], names)
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([x], k) for x, k in zip(close(), kinds, strict=True)], names)


def digests(formatted: DataFrame, ordered: bool = True) -> DataFrame:
    """What the formatted conversations say when they are parsed again, by conversation. Takes the result of format_conversations() as it comes; a
    table that was written and read again, whose parts may lie anywhere, needs ordered=False (a shuffle). Parts out of order are an error."""
    if not ordered:
        formatted = formatted.repartition("conv_id").sortWithinPartitions("conv_id", "part")
    return formatted.mapInArrow(_digested, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")
