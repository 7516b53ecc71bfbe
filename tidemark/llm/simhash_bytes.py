"""SimHash near-duplicates through an inverted index on byte positions, with count filtering.

A text gets a 64-bit fingerprint: each bit is the majority over the XXH64 hashes of its word shingles.
Two fingerprints link when at most ``bits`` of their bits differ; those bits lie in at most ``bits`` of
the 8 byte positions, so linked fingerprints share at least 8 - ``bits`` positional bytes. With the
default of 4 that guaranteed minimum is 4.

Lists of single positional bytes would each hold 1/256 of all fingerprints. The index therefore keeps
the intersections of three lists that any four shared positions must contain one of: the 20 triples of
a Turán system on 8 positions. A list is read in one task; per pair the shared positional bytes are
tallied, pairs below the minimum go, and the rest are verified bit by bit. Only the links of a spanning
forest of the list leave it: a linked fingerprint is taken out of the comparison, so lists of near
copies cost about their length, not its square, and no list emits more links than entries.

Equal fingerprints are one entry (aggregated before the shuffle), represented by their smallest id.
Lists above ``LIST_ENTRIES`` entries are split into blocks that are compared pairwise in tasks of their
own. Links of all lists go to connected components; a component is named by its smallest id.

Defined cases: a null text counts as empty; a text without words has fingerprint zero, linked like any
other; fewer words than a shingle give one shingle of them all; rows without an id get a fingerprint
and the component of equal ones, if any; repeated rows are repeated; empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import slices, texts_of
from tidemark.llm.components import components
from tidemark.session import settle

SHINGLE = 4
SEED = 42
MAX_BITS = 4
LIST_ENTRIES = 20_000
BATCH_BYTES = 8 << 20
POSITIONS = 8


def triples() -> list[tuple[int, int, int]]:
    """Triples of positions such that any four positions contain one of them.

    Positions are dealt into three classes; taken are triples inside a class, and those with two
    positions in a class and one in the next.
    """
    kind = {p: p % 3 for p in range(POSITIONS)}
    chosen = []
    for triple in combinations(range(POSITIONS), 3):
        counts = [sum(kind[p] == k for p in triple) for k in range(3)]
        if 3 in counts or any(counts[k] == 2 and counts[(k + 1) % 3] == 1 for k in range(3)):
            chosen.append(triple)
    return chosen


def fingerprint(text: str, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """Majority bits over the hashes of word shingles, as an unsigned integer."""
    words = text.encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[a:b], seed) for a, b in spans], "<u8")
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 16):
        bits = np.unpackbits(hashes[at : at + (1 << 16)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp`` with the fingerprint's bits in a long."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            found = np.array([fingerprint(t) for t in batch.column("text").to_pylist()], np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found.view(np.int64))], ["doc_id", "fp"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, "doc_id long, fp long")


def forest(entries: np.ndarray, bits: int = MAX_BITS) -> list[tuple[int, int]]:
    """Links (as places in ``entries``) of a spanning forest of the pairs within ``bits`` bits."""
    links: list[tuple[int, int]] = []
    shared = POSITIONS - bits
    left = np.arange(len(entries))
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            node = queue.pop()
            differ = entries[left] ^ entries[node]
            tally = (differ.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)
            near = tally >= shared
            near[near] = np.bitwise_count(differ[near]) <= bits
            if near.any():
                found = left[near].tolist()
                links += [(node, other) for other in found]
                queue += found
                left = left[~near]
    return links


def _short_lists(key: np.ndarray, entries: np.ndarray, bits: int, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """Links inside many short lists at once: neighbours at each distance within a list."""
    found: list[np.ndarray] = []
    for step in range(1, longest):
        at = np.flatnonzero(key[:-step] == key[step:])
        if not len(at):
            break
        differ = entries[at] ^ entries[at + step]
        near = (differ.view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1) >= POSITIONS - bits
        at, differ = at[near], differ[near]
        at = at[np.bitwise_count(differ) <= bits]
        found += [np.stack([at, at + step])]
    both = np.concatenate(found, axis=1) if found else np.zeros((2, 0), np.int64)
    return both[0], both[1]


SHORT_LIST = 24


def _list_links(batches: Iterator[pa.RecordBatch], bits: int) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by list; a list that goes on in the next batch waits for its end."""
    rest: list[pa.Table] = []

    def links(rows: pa.Table) -> pa.RecordBatch:
        key, rep = rows.column("list").to_numpy(), rows.column("rep").to_numpy()
        entries = np.ascontiguousarray(rows.column("fp").to_numpy()).view(np.uint64)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        sizes = np.diff(np.append(starts, len(key)))
        short = np.repeat(sizes <= SHORT_LIST, sizes)
        a, b = _short_lists(key[short], entries[short], bits, SHORT_LIST)
        pairs = [(rep[short][a], rep[short][b])]
        for start, size in zip(starts[sizes > SHORT_LIST].tolist(), sizes[sizes > SHORT_LIST].tolist()):
            found = forest(entries[start : start + size], bits)
            if found:
                places = np.array(found) + start
                pairs.append((rep[places[:, 0]], rep[places[:, 1]]))
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*pairs)], ["a", "b"])

    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("list").to_numpy()
        last = int(np.searchsorted(lists, lists[-1]))
        if rest and rest[0].column("list")[0].as_py() == lists[-1]:
            rest.append(pa.Table.from_batches([batch]))
            continue
        whole = pa.concat_tables([*rest, pa.Table.from_batches([batch.slice(0, last)])])
        rest = [pa.Table.from_batches([batch.slice(last)])]
        if whole.num_rows:
            yield links(whole)
    if rest:
        yield links(pa.concat_tables(rest))


def _lists(entries: DataFrame) -> DataFrame:
    """``key, fp, rep``: each entry under the 20 intersections it belongs to."""
    keys = []
    for number, triple in enumerate(triples()):
        key = F.lit(number).cast("long")
        for position in triple:
            byte = F.shiftrightunsigned("fp", 8 * position).bitwiseAND(F.lit(255))
            key = F.shiftleft(key, 8).bitwiseOR(byte)
        keys.append(key)
    return entries.select(F.explode(F.array(*keys)).alias("key"), "fp", "rep")


def links_of(entries: DataFrame, bits: int = MAX_BITS, list_entries: int = LIST_ENTRIES) -> DataFrame:
    """``a, b``: enough links between the ``rep`` of entries to connect all within ``bits`` bits."""
    lists = _lists(entries)
    large = lists.groupBy("key").count().where(F.col("count") > list_entries)
    large = settle(large.select("key", F.ceil(F.col("count") / list_entries).cast("int").alias("blocks")), "large-lists")
    if large.isEmpty():
        dealt = lists.withColumnRenamed("key", "list")
    else:
        # Each entry of a large list goes to the pairs that its block forms with every block.
        block = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
        marked = lists.join(large, "key", "left").withColumn("block", block)
        partner = F.explode(F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1))
        dealt = marked.withColumn("partner", partner).select(
            F.when(F.col("blocks").isNull(), F.col("key"))
            .otherwise(F.xxhash64("key", F.least("block", "partner"), F.greatest("block", "partner")))
            .alias("list"),
            "fp",
            "rep",
        )
    return dealt.repartition("list").sortWithinPartitions("list").mapInArrow(lambda rows: _list_links(rows, bits), "a long, b long")


def near_duplicates(docs: DataFrame, bits: int = MAX_BITS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fingerprint, component_id`` of every row."""
    if not 0 <= bits <= 4:
        raise ValueError("the index serves up to 4 differing bits")
    prints = settle(fingerprints(docs, id_col, text_col), "fingerprints")
    entries = prints.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("rep"))
    entries = settle(entries, "fingerprint-classes")
    grouped = components(links_of(entries, bits))
    named = entries.join(grouped, entries.rep == grouped.node, "left")
    named = named.select("fp", F.coalesce("component", "rep").alias("component_id"))
    return prints.join(named, "fp", "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
