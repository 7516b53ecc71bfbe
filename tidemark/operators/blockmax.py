"""Postings in blocks that carry their best values, and bitmaps over document numbers.

Documents of a segment are numbered; 64 consecutive numbers are a cell, and a block holds one word's postings
in one cell with the highest count and the shortest document among them. BM25 rises with the count and falls
with the length, so these two bound what the word can add to any document of the cell, whatever the word and
length statistics have become since.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.search import B, K1

CELL_BITS = 6
SHARDS = 16
BATCH_WORDS = 500_000
ROW_SCHEMA = (
    "term string, cell bigint, n bigint, max_tf bigint, min_len int, "
    "postings array<struct<ord: bigint, tf: bigint, doc_len: int>>"
)
BLOCK_SCHEMA = (
    "segment string, shard int, term string, cell bigint, n bigint, max_tf bigint, min_len int, "
    "postings array<struct<ord: bigint, tf: bigint, doc_len: int>>"
)
BITMAP_SCHEMA = "segment string, bucket bigint, bitmap binary"


def shard_of(term: Column) -> Column:
    return F.pmod(F.xxhash64(term), F.lit(SHARDS)).cast("int")


def cell_of(number: Column) -> Column:
    return F.shiftright(number, CELL_BITS)


def blocks_of(postings: DataFrame) -> DataFrame:
    """Blocks of the postings (ord, doc_len, term, tf)."""
    return (
        postings.groupBy("term", cell_of(F.col("ord")).alias("cell"))
        .agg(
            F.count("*").alias("n"),
            F.max("tf").alias("max_tf"),
            F.min("doc_len").alias("min_len"),
            F.sort_array(F.collect_list(F.struct("ord", "tf", "doc_len"))).alias("postings"),
        )
        .withColumn("shard", shard_of(F.col("term")))
    )


def _blocks(rows: pa.Table) -> pa.RecordBatch:
    """Blocks of whole cells, from rows in order of their numbers."""
    numbers = rows.column("ord").to_numpy()
    words = rows.column("words").combine_chunks()
    lengths = pc.list_value_length(words).to_numpy(zero_copy_only=False).astype(np.int64)
    found = words.flatten().dictionary_encode()
    row = np.repeat(np.arange(len(numbers)), lengths)
    # Sorted by word, then by document.
    pairs, tf = np.unique(found.indices.to_numpy().astype(np.int64) * len(numbers) + row, return_counts=True)
    word, row = np.divmod(pairs, len(numbers))
    cell = numbers[row] >> CELL_BITS
    starts = np.flatnonzero(np.concatenate([[True], (word[1:] != word[:-1]) | (cell[1:] != cell[:-1])]))
    ends, doc_len = np.append(starts, len(pairs)), lengths[row].astype(np.int32)
    postings = pa.StructArray.from_arrays([pa.array(numbers[row]), pa.array(tf), pa.array(doc_len)], ["ord", "tf", "doc_len"])
    columns = {
        "term": found.dictionary.take(pa.array(word[starts])),
        "cell": pa.array(cell[starts]),
        "n": pa.array(np.diff(ends)),
        "max_tf": pa.array(np.maximum.reduceat(tf, starts)),
        "min_len": pa.array(np.minimum.reduceat(doc_len, starts)),
        "postings": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), postings),
    }
    return pa.RecordBatch.from_arrays(list(columns.values()), list(columns))


def _whole_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks from rows sorted by number; cells are taken together up to ``BATCH_WORDS``, and none is cut."""
    held: list[pa.RecordBatch] = []
    last, size = None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        cells = batch.column("ord").to_numpy() >> CELL_BITS
        counts = pc.list_value_length(batch.column("words")).to_numpy(zero_copy_only=False)
        starts = np.flatnonzero(np.concatenate([[True], cells[1:] != cells[:-1]]))
        for start, end in zip(starts.tolist(), np.append(starts[1:], len(cells)).tolist()):
            if size >= BATCH_WORDS and cells[start] != last:
                yield _blocks(pa.Table.from_batches(held))
                held, size = [], 0
            held.append(batch.slice(start, end - start))
            last, size = cells[start], size + int(counts[start:end].sum())
    if size:
        yield _blocks(pa.Table.from_batches(held))


def word_blocks(bags: DataFrame) -> DataFrame:
    """Blocks of the documents (ord, words).

    Documents are dealt by cell, and the words of a cell are counted where its documents are: no word is
    shuffled on its own, and the commonest word spreads over all cells.
    """
    dealt = bags.select("ord", "words").repartition(cell_of(F.col("ord"))).sortWithinPartitions("ord")
    return dealt.mapInArrow(_whole_cells, ROW_SCHEMA).withColumn("shard", shard_of(F.col("term")))


def write_blocks(blocks: DataFrame, path: str) -> None:
    """A folder per shard of words, words in order within a file."""
    ordered = blocks.hint("rebalance", "shard").sortWithinPartitions("shard", "term", "cell")
    ordered.write.mode("overwrite").partitionBy("shard").parquet(path)


def idf(df: Column, n: Column) -> Column:
    return F.log(1 + (n - df + 0.5) / (df + 0.5))


def impact(tf: Column, doc_len: Column, avg_len: Column) -> Column:
    """What a word adds to a document's score for each unit of its idf."""
    return (tf * (K1 + 1)) / (tf + K1 * (1 - B + B * doc_len / avg_len))


# --------------------------------------------------------------------- bitmaps


def bucket_of(number: Column) -> Column:
    return F.bitmap_bucket_number(number + 1)


def bitmap_of(number: Column) -> Column:
    """Aggregate: the bits of these numbers, all of one bucket."""
    return F.bitmap_construct_agg(F.bitmap_bit_position(number + 1))


def has_bit(bitmap: Column, number: Column) -> Column:
    position = F.bitmap_bit_position(number + 1)
    byte = F.conv(F.hex(F.substring(bitmap, F.shiftright(position, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("bigint")
    return F.coalesce(F.getbit(byte, (position % 8).cast("int")) == 1, F.lit(False))
