import random
import zlib
from collections import defaultdict

import numpy as np
import pytest

from tidemark.llm import sum_squares, tokens

public_tokenizers = pytest.importorskip("public_tokenizers")


def plain_squares(lengths, capacity):
    """Every open bin tried, the sum of squares added up anew each time."""
    levels, placed = [], []
    for i in sorted(range(len(lengths)), key=lambda i: -lengths[i]):
        tries = []
        for level in {x for x in levels if x < capacity and x + lengths[i] <= capacity}:
            after = [x for x in levels if x < capacity]
            after[after.index(level)] += lengths[i]
            squares = sum(after.count(x) ** 2 for x in set(after) if x < capacity)
            tries.append((squares, -level))
        if tries:
            level = -min(tries)[1]
            levels[levels.index(level)] += lengths[i]
        else:
            level = 0
            levels.append(lengths[i])
        placed.append((i, level))
    return len(levels), sorted(placed)


@pytest.mark.parametrize("seed", range(12))
def test_placing_equals_trying_every_bin(seed):
    rng = random.Random(seed)
    capacity = rng.choice([1, 2, 5, 16, 40])
    lengths = [rng.randint(1, capacity) for _ in range(rng.randint(0, 60))]
    bins, offsets = sum_squares.least_squares(np.array(lengths, np.int64), capacity)
    number, placed = plain_squares(lengths, capacity)
    assert len(set(bins.tolist())) == number
    assert sorted(enumerate(offsets.tolist())) == placed


def test_few_bins_for_many_pieces():
    rng = np.random.default_rng(3)
    lengths = np.minimum(rng.lognormal(6, 1, 20_000).astype(int) + 1, 2047)
    bins, _ = sum_squares.least_squares(lengths, 2048)
    assert bins.max() + 1 <= 1.002 * lengths.sum() / 2048 + 1


def check(packed, docs, sequence):
    """Every id lies in one piece, pieces are as cut by the rule, sequences are gapless and not too long."""
    from tokenizers import Tokenizer

    fresh = Tokenizer.from_file(tokens.default_tokenizer())
    pieces, bins = defaultdict(list), defaultdict(list)
    for r in packed.collect():
        pieces[r.doc_id].append((r.piece, r.start, r.length, r.ids_crc32))
        bins[r.sequence_id].append((r.offset, r.length))
    wanted = defaultdict(list)
    for r in docs.collect():
        ids = np.array(fresh.encode(r.text or "", add_special_tokens=False).ids + [0], "<u4")
        first = len(ids) % sequence or sequence
        edges = [0, *range(first, len(ids) + 1, sequence)]
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            wanted[r.doc_id].append((i, a, b - a, zlib.crc32(ids[a:b].tobytes())))
    assert {k: sorted(v) for k, v in pieces.items()} == {k: sorted(v) for k, v in wanted.items()}
    for placed in bins.values():
        at = 0
        for offset, length in sorted(placed):
            assert offset == at
            at += length
        assert at <= sequence
    return len(bins), sum(p[2] for v in pieces.values() for p in v)


@pytest.mark.parametrize("sequence,group", [(2048, 32_768), (8, 5), (1, 3)])
def test_pack_odd_documents(spark, odd_docs, sequence, group):
    check(sum_squares.pack(odd_docs, sequence=sequence, group_pieces=group), odd_docs, sequence)


def test_pack_whole_table_leaves_little_room(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    found, total = check(sum_squares.pack(docs), docs, 2048)
    assert found <= 1.02 * total / 2048 + 1


def test_pack_nothing(no_docs):
    assert sum_squares.pack(no_docs).count() == 0
