"""Packing documents into token sequences: first-fit decreasing in randomised groups.

Every document is tokenized once, closed with an end id, and cut: whole sequences first, then the rest,
which is cut again at a pseudo-random place. These pieces of all sizes are what fills the gaps, also where
many documents have one length. The pieces are narrow rows (places, lengths
and checksums, no ids); they are written once, dealt at random into groups of about ``GROUP_PIECES``,
and each group is packed by itself: pieces in decreasing order go to the first bin with room, found by
walking down a tournament tree of the bins' free capacities. A group leaves one poorly filled bin or so.

Groups are dealt by the place of a piece in the written table, not by id, so repeated ids spread too.

Defined cases: a null or empty text is its end id alone; repeated rows are packed separately; a null id
is kept; long texts give many whole sequences; an empty table gives no sequences.
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

SEQUENCE = 1024
END_ID = 0
GROUP_PIECES = 8192
_PIECE = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, part long, number long"
_PLACED = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


def cuts(n: int, number: int, sequence: int = SEQUENCE) -> list[int]:
    """Where a document of ``n`` tokens is cut, ends included. ``number`` only varies the last cut."""
    full = n // sequence
    places = [i * sequence for i in range(full + 1)]
    rest = n - places[-1]
    if rest:
        mixed = (number * 0x9E3779B97F4A7C15 + 0x7F4A7C15) & 0xFFFFFFFFFFFFFFFF
        mixed ^= mixed >> 29
        if rest > 1:
            places.append(places[-1] + 1 + (mixed >> 8) % (rest - 1))
        places.append(n)
    return places


def _pieces(batches: Iterator[pa.RecordBatch], path: str, sequence: int) -> Iterator[pa.RecordBatch]:
    coder = tokenizer(path)
    end = np.array([END_ID], "<u4").tobytes()
    part = TaskContext.get().partitionId()
    number = 0
    names = [x.split()[0] for x in _PIECE.split(", ")]
    for batch in blocks(batches):
        out: list[tuple] = []
        for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text"))):
            data = np.frombuffer(ids, coder.dtype).astype("<u4").tobytes() + end
            total = len(data) // 4
            places = cuts(total, number, sequence)
            for a, b in zip(places, places[1:]):
                out.append((doc, a, b - a, zlib.crc32(data[4 * a : 4 * b]), total, part, number))
                number += 1
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out)], names)


def first_fit_decreasing(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each piece.

    The tree holds the largest free capacity below each node; leaves are bins in order of opening.
    """
    leaves = 1
    while leaves < len(lengths):
        leaves *= 2
    tree = [capacity] * (2 * leaves)
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    for piece in np.argsort(-lengths, kind="stable").tolist():
        size, node = int(lengths[piece]), 1
        while node < leaves:
            node *= 2
            if tree[node] < size:
                node += 1
        bins[piece], offsets[piece] = node - leaves, capacity - tree[node]
        tree[node] -= size
        while node > 1:
            node //= 2
            best = max(tree[2 * node], tree[2 * node + 1])
            if tree[node] == best:
                break
            tree[node] = best
    return bins, offsets


def _pack_group(group: pa.Table, sequence: int) -> pa.Table:
    bins, offsets = first_fit_decreasing(group.column("length").to_numpy(), sequence)
    number = (group.column("grp")[0].as_py() << 24) + bins << 1
    keep = [c for c in group.column_names if c not in ("part", "number", "grp")]
    return group.select(keep).append_column("sequence_id", pa.array(number)).append_column("offset", pa.array(offsets))


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
    pieces = settle(texts.mapInArrow(lambda rows: _pieces(rows, path, sequence), _PIECE), "pieces")
    whole = pieces.where(F.col("length") == sequence).select(
        *[c for c in pieces.columns if c not in ("part", "number")],
        (F.shiftleft(F.col("part") * F.lit(1 << 36) + F.col("number"), 1) + 1).alias("sequence_id"),
        F.lit(0).cast("long").alias("offset"),
    )
    rest = pieces.where(F.col("length") < sequence)
    groups = max(1, round(rest.count() / group_pieces))
    dealt = rest.withColumn("grp", F.pmod(F.xxhash64("part", "number"), F.lit(groups)))
    packed = dealt.groupBy("grp").applyInArrow(lambda group: _pack_group(group, sequence), _PLACED)
    return whole.unionByName(packed)
