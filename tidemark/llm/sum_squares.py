"""Packing whole documents into token sequences by the sum of squares of open bins per level.

Every document is tokenized once and closed with an end id. Only documents longer than a sequence are
cut: the first piece takes what is left over, all others fill a sequence and are placed at once. The
pieces become narrow rows (places, lengths and checksums, no ids), are written once and dealt at random
into groups of about ``GROUP_PIECES``; each group is packed by itself.

Within a group, N(h) counts the open bins filled to h. A piece of s tokens moves one bin from h to h + s;
it goes where the sum of N(h)^2 becomes smallest, that is where 2 * (N(h+s) - N(h) + 1) is least, or
1 - 2 * N(h) if it closes the bin. Equal choices go to the fullest bin. Pieces come in decreasing length,
and a bin is opened only if none has room: so small pieces, which fit anywhere, are left for the gaps.
Closed bins and bins at one level are alike, so a group needs one counter per level.

Defined cases: a null or empty text is its end id alone; repeated rows are packed separately; a null id
is kept; an empty table gives no sequences; extra columns are not read. Groups are dealt by the place of
a piece in the written table, so repeated ids and repeated lengths spread too.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of
from tidemark.llm.tokens import blocks, default_tokenizer, tokenizer
from tidemark.session import settle

SEQUENCE = 2048
END_ID = 0
GROUP_PIECES = 32_768
_FIELDS = "doc_id long, piece int, start long, length long, ids_crc32 long"
_PIECE = _FIELDS + ", part long, number long"
_PLACED = _FIELDS + ", sequence_id long, offset long"
_NEVER = np.int64(1) << 60


def cuts(total: int, sequence: int) -> list[int]:
    """Where a document of ``total`` tokens is cut, both ends included."""
    first = total % sequence or sequence
    return [0, *range(first, total + 1, sequence)]


def _pieces(batches: Iterator[pa.RecordBatch], path: str, sequence: int) -> Iterator[pa.RecordBatch]:
    coder = tokenizer(path)
    end = np.array([END_ID], "<u4").tobytes()
    part, number = TaskContext.get().partitionId(), 0
    types = [pa.int64(), pa.int32(), *[pa.int64()] * 5]
    names = [x.split()[0] for x in _PIECE.split(", ")]
    for batch in blocks(batches):
        out: list[tuple] = []
        for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text"))):
            data = np.frombuffer(ids, coder.dtype).astype("<u4").tobytes() + end
            places = cuts(len(data) // 4, sequence)
            for i, (a, b) in enumerate(zip(places, places[1:])):
                out.append((doc, i, a, b - a, zlib.crc32(data[4 * a : 4 * b]), part, number))
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def least_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece; no piece may be longer than ``capacity``."""
    counts = np.zeros(capacity, np.int64)  # open bins by how full they are; none is empty
    at_level: list[list[int]] = [[] for _ in range(capacity)]
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    opened = 0
    for piece in np.argsort(-lengths, kind="stable").tolist():
        size = int(lengths[piece])
        level, change = 0, _NEVER
        if size < capacity - 1:
            own = counts[1 : capacity - size]
            moved = np.where(own > 0, 2 * (counts[1 + size :] - own) + 2, _NEVER)[::-1]
            best = int(moved.argmin())
            if moved[best] < _NEVER:
                level, change = len(moved) - best, moved[best]
        closes = capacity - size
        if 0 < closes < capacity and counts[closes] and 1 - 2 * counts[closes] <= change:
            level = closes
        if level:
            own_bin = at_level[level].pop()
            counts[level] -= 1
        else:
            own_bin, opened = opened, opened + 1
        bins[piece], offsets[piece] = own_bin, level
        if level + size < capacity:
            at_level[level + size].append(own_bin)
            counts[level + size] += 1
    return bins, offsets


def _pack_group(group: pa.Table, sequence: int) -> pa.Table:
    group = group.sort_by([("part", "ascending"), ("number", "ascending")])  # alike when a task is repeated
    bins, offsets = least_squares(group.column("length").to_numpy(), sequence)
    number = (group.column("grp")[0].as_py() << 24) + bins << 1
    kept = group.select([x.split()[0] for x in _FIELDS.split(", ")])
    return kept.append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offsets))


def pack(
    docs: DataFrame,
    tokenizer_path: str | None = None,
    sequence: int = SEQUENCE,
    group_pieces: int = GROUP_PIECES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per piece: where it lies in its document and where in which sequence."""
    path = tokenizer_path or default_tokenizer()
    texts = texts_of(docs, id_col, text_col)
    pieces = settle(texts.mapInArrow(lambda rows: _pieces(rows, path, sequence), _PIECE), "whole-pieces")
    fields = [x.split()[0] for x in _FIELDS.split(", ")]
    full = pieces.where(F.col("length") == sequence).select(
        *fields,
        (F.shiftleft(F.col("part") * F.lit(1 << 36) + F.col("number"), 1) + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    short = pieces.where(F.col("length") < sequence)
    groups = max(1, round(short.count() / group_pieces))
    dealt = short.withColumn("grp", F.pmod(F.xxhash64("part", "number"), F.lit(groups)))
    return full.unionByName(dealt.groupBy("grp").applyInArrow(lambda group: _pack_group(group, sequence), _PLACED))
