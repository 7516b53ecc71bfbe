"""Token ids in wavelet matrices: one compressed, searchable file per shard.

Documents are dealt by ranges of their id, tokenized, closed with an end id and gathered into shards of
about ``SHARD_TOKENS`` ids. A shard is a wavelet matrix: one bit-plane per bit of an id, most significant
first, each plane stably parting the sequence by its bit. Planes are compressed in chunks, and the running
counts of ones per chunk and block stand in the file, so single ids, counts of an id in a span, and the
places where an id occurs come from the stored counts and a few chunks. Spark's Parquet writer puts each
shard into a file of its own (one row: ids and lengths of the documents, the matrix as one blob), so that a
repeated task replaces its own files and any store that Spark can write will do. Reading documents back
undoes the planes of a shard as a whole, and looks up the first and last id of every document by ``access``
as a check of the stored counts; a file that disagrees with itself fails the job.

Global starts come from per-shard totals: sums within a task's shards plus sums over tasks.

Defined cases: a null or empty text is its end id alone; equal ids are ordered by text, a null id comes
first; a document longer than a shard gets a larger one; an empty table gives no shards and no rows.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import texts_of
from tidemark.llm.tokens import blocks, default_tokenizer, tokenizer
from tidemark.session import new_folder

END_ID = 0
BLOCK = 512  # bits
CHUNK = 64 * BLOCK
STEP = 4096
SHARD_TOKENS = 4 << 20
TASK_BYTES = 32 << 20
_SHARD = "part long, seq long, n_tokens long, doc_ids binary, no_id binary, lengths binary, planes binary"
_READ = "part long, seq long, doc_id long, local_start long, n_tokens long, ids_crc32 long"


class WaveletMatrix:
    """A sequence of unsigned integers as bit-planes with rank and select, read in place from its bytes.

    The bytes hold, in this order: the number of ids and of planes; per plane the running count of ones
    before each chunk of ``CHUNK`` bits, and inside each chunk before each block of ``BLOCK`` bits; where each
    chunk begins; the chunks, each compressed on its own (or as it is, if that does not make it smaller).
    Rank adds two stored counts to the ones of one block; select searches the stored counts and then one
    block. Either unpacks only the chunks it needs.
    """

    def __init__(self, data: bytes):
        self.data = data
        self.n, self.bits = (int(x) for x in np.frombuffer(data, "<u8", 2))
        self.chunks = self.n // CHUNK + 1
        per_plane, at = CHUNK // BLOCK, 16

        def stored(kind: str, *shape: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(data, kind, int(np.prod(shape)), at).reshape(shape)
            at += found.nbytes
            return found

        self.chunk_ones = stored("<i8", self.bits, self.chunks + 1)
        self.block_ones = stored("<u2", self.bits, self.chunks, per_plane)
        self.begins = stored("<u4", self.bits * self.chunks + 1)
        self.body = at
        self.zeros = [self.n - int(o[-1]) for o in self.chunk_ones]
        self.unpacked = 0

    @classmethod
    def of(cls, ids: np.ndarray, bits: int) -> WaveletMatrix:
        """The matrix of ``ids``, whose values have at most ``bits`` bits."""
        chunks, size = len(ids) // CHUNK + 1, CHUNK // 8
        packer = zstandard.ZstdCompressor(level=1, write_checksum=False)
        outer = np.zeros((bits, chunks + 1), "<i8")
        inner = np.zeros((bits, chunks, CHUNK // BLOCK), "<u2")
        parts: list[bytes] = []
        rest = ids
        for level in range(bits):
            one = (rest & rest.dtype.type(1 << (bits - 1 - level))) != 0
            plane = np.zeros(chunks * size, np.uint8)
            packed = np.packbits(one)
            plane[: len(packed)] = packed
            ones = np.bitwise_count(plane.reshape(chunks, -1, BLOCK // 8)).sum(axis=2, dtype=np.int64)
            outer[level, 1:] = np.cumsum(ones.sum(axis=1))
            inner[level] = np.cumsum(ones, axis=1) - ones
            for chunk in plane.reshape(chunks, -1):
                raw = chunk.tobytes()
                small = packer.compress(raw)
                parts.append(small if len(small) < size else raw)
            rest = np.concatenate([rest.take(np.flatnonzero(~one)), rest.take(np.flatnonzero(one))])
        begins = np.concatenate([[0], np.cumsum([len(p) for p in parts])]).astype("<u4")
        head = np.array([len(ids), bits], "<u8")
        return cls(b"".join([head.tobytes(), outer.tobytes(), inner.tobytes(), begins.tobytes(), *parts]))

    def to_bytes(self) -> bytes:
        return self.data

    @classmethod
    def from_bytes(cls, data: bytes) -> WaveletMatrix:
        return cls(data)

    def _chunks(self, level: int, wanted: np.ndarray) -> np.ndarray:
        """The bytes of some chunks of a plane, a row each."""
        size, opener = CHUNK // 8, zstandard.ZstdDecompressor()
        out = np.empty((len(wanted), size), np.uint8)
        for row, chunk in enumerate(wanted.tolist()):
            a, b = (self.body + int(x) for x in self.begins[level * self.chunks + chunk :][:2])
            raw = self.data[a:b]
            out[row] = np.frombuffer(raw if b - a == size else opener.decompress(raw), np.uint8)
        self.unpacked += out.nbytes
        return out

    def _blocks(self, level: int, blocks: np.ndarray) -> np.ndarray:
        """The bytes of some blocks of a plane, a row each."""
        wanted, row = np.unique(blocks // (CHUNK // BLOCK), return_inverse=True)
        chunks = self._chunks(level, wanted).reshape(len(wanted), -1, BLOCK // 8)
        return chunks[row, blocks % (CHUNK // BLOCK)]

    def _rank1(self, level: int, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ones of a plane before each place, and the bit at it: stored counts and the bits of one block."""
        block, byte, bit = places // BLOCK, (places % BLOCK) >> 3, (places & 7).astype(np.uint8)
        data = self._blocks(level, block)
        here = data[np.arange(len(places)), byte]
        whole = np.where(np.arange(BLOCK // 8) < byte[:, None], np.bitwise_count(data), 0).sum(axis=1, dtype=np.int64)
        part = np.bitwise_count(here & ~(np.uint8(255) >> bit))
        chunk, inside = places // CHUNK, block % (CHUNK // BLOCK)
        ones = self.chunk_ones[level][chunk] + self.block_ones[level][chunk, inside] + whole + part
        return ones, (here >> (np.uint8(7) - bit)) & np.uint8(1)

    def access(self, places: np.ndarray) -> np.ndarray:
        """The ids at ``places``."""
        found = [self._access(np.asarray(places[i : i + STEP], np.int64)) for i in range(0, len(places), STEP)]
        return np.concatenate(found) if found else np.zeros(0, np.uint32)

    def _access(self, places: np.ndarray) -> np.ndarray:
        out = np.zeros(len(places), np.uint32)
        for level in range(self.bits):
            ones, bit = self._rank1(level, places)
            places = np.where(bit == 1, self.zeros[level] + ones, places - ones)
            out = (out << np.uint32(1)) | bit
        return out

    def sequence(self) -> np.ndarray:
        """All ids in order: the stable partings undone from the last plane up."""
        kind = np.uint16 if self.bits <= 16 else np.uint32
        out = np.zeros(self.n, kind)
        for level in range(self.bits - 1, -1, -1):
            plane = self._chunks(level, np.arange(self.chunks)).ravel()
            one = np.unpackbits(plane, count=self.n).view(bool)
            before = np.empty_like(out)
            zeros = self.zeros[level]
            before[np.flatnonzero(~one)] = out[:zeros]
            before[np.flatnonzero(one)] = out[zeros:] | kind(1 << (self.bits - 1 - level))
            out = before
        return out

    def rank(self, symbol: int, place: int) -> int:
        """How often ``symbol`` occurs before ``place``."""
        first, last = self._descend(symbol, 0, place)
        return last - first

    def count(self, symbol: int, start: int = 0, stop: int | None = None) -> int:
        first, last = self._descend(symbol, start, self.n if stop is None else stop)
        return last - first

    def _descend(self, symbol: int, start: int, stop: int) -> tuple[int, int]:
        if symbol < 0 or symbol >> self.bits:
            return 0, 0
        for level in range(self.bits):
            ones, _ = self._rank1(level, np.array([start, stop]))
            if symbol >> (self.bits - 1 - level) & 1:
                start, stop = (int(x) + self.zeros[level] for x in ones)
            else:
                start, stop = start - int(ones[0]), stop - int(ones[1])
        return start, stop

    def _select(self, level: int, bit: int, k: np.ndarray) -> np.ndarray:
        """Places of the k-th (from 0) ``bit`` of a plane: the chunk and block by stored counts, then its bits."""
        per_chunk = CHUNK // BLOCK
        outer = self.chunk_ones[level] if bit else np.arange(self.chunks + 1) * CHUNK - self.chunk_ones[level]
        chunk = np.searchsorted(outer, k, "right") - 1
        k = k - outer[chunk]
        inner = self.block_ones[level][chunk].astype(np.int64)
        if not bit:
            inner = np.arange(per_chunk) * BLOCK - inner
        inside = (inner <= k[:, None]).sum(axis=1) - 1
        k = k - inner[np.arange(len(k)), inside]
        block = chunk * per_chunk + inside
        bits = np.unpackbits(self._blocks(level, block), axis=1) == bit
        reached = np.cumsum(bits, axis=1, dtype=np.int16) == (k + 1)[:, None]
        return block * BLOCK + np.argmax(reached, axis=1)

    def _up(self, symbol: int, places: np.ndarray) -> np.ndarray:
        """From places below the last plane back to places of the sequence."""
        for level in range(self.bits - 1, -1, -1):
            bit = symbol >> (self.bits - 1 - level) & 1
            places = self._select(level, bit, places - self.zeros[level] if bit else places)
        return places

    def occurrences(self, symbol: int, start: int = 0, stop: int | None = None) -> np.ndarray:
        """All places of ``symbol`` in a span: down by rank, back up by select."""
        first, last = self._descend(symbol, start, self.n if stop is None else stop)
        found = [self._up(symbol, np.arange(i, min(i + STEP, last))) for i in range(first, last, STEP)]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def select(self, symbol: int, k: int) -> int:
        """Place of the k-th (from 0) ``symbol``; IndexError if there are fewer."""
        first, last = self._descend(symbol, 0, self.n)
        if not 0 <= k < last - first:
            raise IndexError(k)
        return int(self._up(symbol, np.array([first + k]))[0])


def _shards(batches: Iterator[pa.RecordBatch], path: str, shard_tokens: int) -> Iterator[pa.RecordBatch]:
    coder = tokenizer(path)
    bits = int(coder.size - 1).bit_length()
    part, seq = TaskContext.get().partitionId(), 0
    docs: list[int | None] = []
    lengths: list[int] = []
    data: list[bytes] = []
    end = np.array([END_ID], coder.dtype).tobytes()

    def shard() -> pa.RecordBatch:
        ids = np.frombuffer(b"".join(data), coder.dtype)
        values = [
            [part],
            [seq],
            [len(ids)],
            [np.array([d or 0 for d in docs], "<i8").tobytes()],
            [np.array([d is None for d in docs], np.uint8).tobytes()],
            [np.array(lengths, "<i8").tobytes()],
            [WaveletMatrix.of(ids, bits).to_bytes()],
        ]
        types = [pa.int64()] * 3 + [pa.binary()] * 4
        names = [x.split()[0] for x in _SHARD.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, types)], names)

    total = 0
    for batch in blocks(batches):
        for doc, ids in zip(batch.column("doc_id").to_pylist(), coder.encode(batch.column("text"))):
            n = len(ids) // coder.dtype.itemsize + 1
            if docs and total + n > shard_tokens:
                yield shard()
                seq, total = seq + 1, 0
                docs, lengths, data = [], [], []
            docs.append(doc)
            lengths.append(n)
            data.append(ids + end)
            total += n
    if docs:
        yield shard()


def write_shards(
    docs: DataFrame,
    path: str,
    tokenizer_path: str | None = None,
    shard_tokens: int = SHARD_TOKENS,
    task_bytes: int = TASK_BYTES,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> None:
    """Encode ``docs`` in ascending order of id and write a file per shard below ``path``."""
    vocabulary = tokenizer_path or default_tokenizer()
    texts = texts_of(docs, id_col, text_col)
    size = texts.agg(F.sum(F.octet_length("text").cast("long"))).first()[0] or 0
    ranges = texts.repartitionByRange(max(1, -(-size // task_bytes)), "doc_id").sortWithinPartitions("doc_id", "text")
    shards = ranges.mapInArrow(lambda rows: _shards(rows, vocabulary, shard_tokens), _SHARD)
    shards.write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(path)


def _documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in _READ.split(", ")]
    for batch in batches:
        for row in batch.to_pylist():
            matrix = WaveletMatrix.from_bytes(row["planes"])
            whole = matrix.sequence().astype("<u4")
            docs, none = np.frombuffer(row["doc_ids"], "<i8"), np.frombuffer(row["no_id"], np.uint8)
            lengths = np.frombuffer(row["lengths"], "<i8")
            ends = np.cumsum(lengths)
            edges = np.stack([ends - lengths, ends - 1], axis=1).ravel()
            if not (np.array_equal(matrix.access(edges), whole[edges]) and (whole[ends - 1] == END_ID).all()):
                raise ValueError(f"shard {row['part']}, {row['seq']}: stored counts and ids disagree")
            ids = whole.tobytes()
            sums = [zlib.crc32(ids[4 * a : 4 * b]) for a, b in zip((ends - lengths).tolist(), ends.tolist())]
            columns = [
                pa.array(np.full(len(docs), row["part"])),
                pa.array(np.full(len(docs), row["seq"])),
                pa.array(docs, mask=none.astype(bool)),
                pa.array(ends - lengths),
                pa.array(lengths),
                pa.array(sums, pa.int64()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """A row per stored document: ``doc_id, start, n_tokens, ids_crc32``, from the files alone."""
    shards = spark.read.parquet(path)
    totals = shards.select("part", "seq", "n_tokens")
    parts = totals.groupBy("part").agg(F.sum("n_tokens").alias("n"))
    before = parts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    within = Window.partitionBy("part").orderBy("seq")
    starts = totals.withColumn("in_part", F.sum("n_tokens").over(within) - F.col("n_tokens")).join(before, "part")
    starts = starts.select("part", "seq", (F.col("before") + F.col("in_part")).alias("shard_start"))
    return (
        shards.mapInArrow(_documents, _READ)
        .join(starts, ["part", "seq"])
        .select("doc_id", (F.col("shard_start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32")
    )


def store_tokens(docs: DataFrame, tokenizer_path: str | None = None) -> DataFrame:
    """Write the shards of ``docs`` to a new folder and read them back."""
    path = new_folder(docs.sparkSession, "tokens")
    write_shards(docs, path, tokenizer_path)
    return read_documents(docs.sparkSession, path)
