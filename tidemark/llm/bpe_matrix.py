"""Byte-level BPE in numpy: many words merge at once.

A text is cut by the vocabulary's pattern; the distinct words a worker has not met yet are put into
buckets by length, each bucket a padded matrix of ranks, one word per row. Each round looks up the rank
of every neighbouring pair in an open-addressing hash table, every row merges its leftmost pair of
minimum rank, and the gap is closed by compaction; rows without a pair leave the matrix. A pair has a
rank when the joined bytes are a token, so the ids are those of the reference encoder for the ranks.

Words above ``MATRIX_BYTES`` bytes (long runs of one kind of character) would need as many rounds as
they have bytes; they merge by the same rule with a heap of pairs over a linked list.

Defined cases: a null or empty text has no ids; a repeated row gives a repeated result; long texts are
cut in the same way as short ones; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, texts_of

MATRIX_BYTES = 256
CACHED_WORDS = 600_000
CACHED_LENGTH = 48
BATCH_BYTES = 4 << 20
MATRIX_CELLS = 1 << 20
NONE = np.int64(1 << 40)
_MIX = np.uint64(0x9E3779B97F4A7C15)
_open: dict[tuple[str, str], MatrixBpe] = {}


class PairTable:
    """Ranks of pairs in an open-addressing table with linear probing."""

    def __init__(self, left: np.ndarray, right: np.ndarray, ranks: np.ndarray):
        self.bits = max(4, int(len(left) * 4 - 1).bit_length())
        self.keys = np.full(1 << self.bits, -1, np.int64)
        self.ranks = np.full(1 << self.bits, NONE, np.int64)
        keys = (left.astype(np.int64) << 32) | right
        at, todo = self._slots(keys), np.arange(len(keys))
        while len(todo):
            free = self.keys[at[todo]] == -1
            slots, first = np.unique(at[todo[free]], return_index=True)
            placed = todo[free][first]
            self.keys[slots], self.ranks[slots] = keys[placed], ranks[placed]
            left_over = np.ones(len(keys), bool)
            left_over[placed] = False
            todo = todo[left_over[todo]]
            at[todo] = (at[todo] + (self.keys[at[todo]] != keys[todo])) & (len(self.keys) - 1)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * _MIX) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``NONE`` where the pair does not merge; any shape."""
        keys = ((left.astype(np.int64) << 32) | right).ravel()
        out = np.full(len(keys), NONE, np.int64)
        todo = np.flatnonzero((left >= 0).ravel() & (right >= 0).ravel())
        at = self._slots(keys[todo])
        while len(todo):
            found = self.keys[at]
            hit = found == keys[todo]
            out[todo[hit]] = self.ranks[at[hit]]
            on = ~hit & (found != -1)
            todo, at = todo[on], (at[on] + 1) & (len(self.keys) - 1)
        return out.reshape(left.shape)


class MatrixBpe:
    """Encoder and decoder for a file of base64 tokens and ranks."""

    def __init__(self, path: str, pattern: str):
        import regex

        with open(path, "rb") as lines:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        self.tokens = {rank: token for token, rank in self.ranks.items()}
        self.pattern = regex.compile(pattern)
        pairs = [
            (self.ranks[t[:i]], self.ranks[t[i:]], rank)
            for t, rank in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
        ]
        left, right, ranks = (np.array(x, np.int64) for x in zip(*pairs)) if pairs else (np.zeros(0, np.int64),) * 3
        self.pairs = PairTable(left, right, ranks)
        self.single = np.array([self.ranks.get(bytes([b]), -1) for b in range(256)], np.int64)
        self.known: dict[str, bytes] = {}

    def _matrix(self, words: list[bytes]) -> list[np.ndarray]:
        """Ids of words of similar length."""
        width = max(map(len, words))
        ids = np.full((len(words), width), -1, np.int64)
        joined = self.single[np.frombuffer(b"".join(words), np.uint8)]
        lengths = np.array([len(w) for w in words])
        ids[np.arange(width) < lengths[:, None]] = joined
        out: list[np.ndarray] = [None] * len(words)
        rows = np.arange(len(words))
        ranks = self.pairs.get(ids[:, :-1], ids[:, 1:])
        while len(rows):
            if ids.shape[1] == 1:
                at, best = np.zeros(len(rows), np.int64), np.full(len(rows), NONE)
            else:
                at = ranks.argmin(axis=1)
                best = ranks[np.arange(len(rows)), at]
            done = best == NONE
            if done.any():
                for row, values in zip(rows[done].tolist(), ids[done]):
                    out[row] = values[values >= 0]
                go = ~done
                rows, ids, ranks, at, best = rows[go], ids[go], ranks[go], at[go], best[go]
                if not len(rows):
                    break
            every = np.arange(len(rows))
            ids[every, at] = best
            keep = np.ones(ids.shape, bool)
            keep[every, at + 1] = False
            ids = ids[keep].reshape(len(rows), -1)
            kept = np.ones(ranks.shape, bool)
            kept[every, at] = False
            ranks = ranks[kept].reshape(len(rows), -1)
            if ids.shape[1] > 1:
                # Only the pairs on either side of the merged one are new.
                last = ids.shape[1] - 2
                inner = at <= last
                ranks[every[inner], at[inner]] = self.pairs.get(ids[every[inner], at[inner]], ids[every[inner], at[inner] + 1])
                before = at > 0
                ranks[every[before], at[before] - 1] = self.pairs.get(ids[every[before], at[before] - 1], ids[every[before], at[before]])
                used = int((ids >= 0).sum(axis=1).max())
                if used < ids.shape[1]:
                    ids, ranks = ids[:, :used].copy(), ranks[:, : max(used - 1, 0)].copy()
        return out

    def _heap(self, word: bytes) -> list[int]:
        """Ids of one long word."""
        ids = self.single[np.frombuffer(word, np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        pair = self._pair_ranks()
        queue = [(pair[k], i, *k) for i, k in enumerate(zip(ids, ids[1:])) if k in pair]
        heapq.heapify(queue)
        while queue:
            rank, i, a, b = heapq.heappop(queue)
            j = after[i]
            if j >= n or ids[i] != a or ids[j] != b:
                continue
            ids[i], ids[j] = rank, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
                k = (rank, ids[after[j]])
                if k in pair:
                    heapq.heappush(queue, (pair[k], i, *k))
            if before[i] >= 0:
                k = (ids[before[i]], rank)
                if k in pair:
                    heapq.heappush(queue, (pair[k], before[i], *k))
        return [x for x in ids if x >= 0]

    def _pair_ranks(self) -> dict[tuple[int, int], int]:
        if not hasattr(self, "_pairs"):
            used = np.flatnonzero(self.pairs.keys >= 0)
            keys = self.pairs.keys[used]
            self._pairs = dict(zip(zip((keys >> 32).tolist(), (keys & 0xFFFFFFFF).tolist()), self.pairs.ranks[used].tolist()))
        return self._pairs

    def _learn(self, words: list[str]) -> dict[str, bytes]:
        out = {}
        coded = sorted(((w.encode(), w) for w in words), key=lambda x: len(x[0]))
        start = 0
        while start < len(coded):
            length = len(coded[start][0])
            if length > MATRIX_BYTES:
                out[coded[start][1]] = np.array(self._heap(coded[start][0]), "<u4").tobytes()
                start += 1
                continue
            # A bucket holds lengths up to a third above its shortest and a bounded number of cells.
            stop = start
            widest = min(max(length + 2, length * 4 // 3), MATRIX_BYTES)
            while stop < len(coded) and len(coded[stop][0]) <= widest and (stop - start) * widest < MATRIX_CELLS:
                stop += 1
            for (_, word), ids in zip(coded[start:stop], self._matrix([b for b, _ in coded[start:stop]])):
                out[word] = ids.astype("<u4").tobytes()
            start = stop
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        cut = [self.pattern.findall(t) for t in texts]
        wanted: set[str] = set()
        for words in cut:
            wanted.update(words)
        if len(self.known) > CACHED_WORDS:
            self.known.clear()
        known = self.known
        long = {}
        for word, ids in self._learn([w for w in wanted if w not in known]).items():
            (known if len(word) <= CACHED_LENGTH else long)[word] = ids
        if long:
            known = {w: known[w] if w in known else long[w] for w in wanted}
        find = known.__getitem__
        return [b"".join(map(find, words)) for words in cut]

    def decode(self, ids: bytes) -> bytes:
        find = self.tokens.__getitem__
        return b"".join(map(find, np.frombuffer(ids, "<u4").tolist()))


def default_vocabulary() -> tuple[str, str]:
    """Path of the 50k ranks and their pattern; both are installed on every node."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def coder(path: str, pattern: str) -> MatrixBpe:
    """The coder of this worker; workers serve many tasks."""
    if (path, pattern) not in _open:
        _open[path, pattern] = MatrixBpe(path, pattern)
    return _open[path, pattern]


def encode(docs: DataFrame, path: str | None = None, pattern: str | None = None, id_col="doc_id", text_col="text") -> DataFrame:
    """``doc_id, ids`` with the ids as little-endian unsigned 32-bit integers."""
    default = default_vocabulary() if path is None or pattern is None else ("", "")
    where, cut = path or default[0], pattern or default[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(where, cut)
        for batch in slices(batches, "text", BATCH_BYTES):
            ids = bpe.encode(batch.column("text").to_pylist())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.binary())], ["doc_id", "ids"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, ids binary")


def decoded(column: Column | str, path: str | None = None, pattern: str | None = None) -> Column:
    """The bytes that a column of ids stands for."""
    default = default_vocabulary() if path is None or pattern is None else ("", "")
    where, cut = path or default[0], pattern or default[1]

    @F.arrow_udf("binary")
    def run(ids: pa.Array) -> pa.Array:
        bpe = coder(where, cut)
        return pa.array([None if x is None else bpe.decode(x) for x in ids.to_pylist()], pa.binary())

    return run(column)


def round_trip(docs: DataFrame, path: str | None = None, pattern: str | None = None) -> DataFrame:
    """Encode, decode again, and digest both: ``doc_id, n_tokens, ids_sha256, decoded_sha256``."""
    default = default_vocabulary() if path is None or pattern is None else ("", "")
    where, cut = path or default[0], pattern or default[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = coder(where, cut)
        for batch in slices(batches, "text", BATCH_BYTES):
            ids = bpe.encode(batch.column("text").to_pylist())
            columns = [
                batch.column("doc_id"),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(bpe.decode(x)).hexdigest() for x in ids]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return texts_of(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
