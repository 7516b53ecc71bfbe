"""SimHash near-duplicates at a stated similarity of word shingles, for texts that differ by more than a few bits.

Operator 4 finds fingerprints of 64 bits within 4 bits. Texts whose five-word shingles have a Jaccard
similarity of 0.8 differ in about 15 % of their fingerprint's bits, which is out of its reach. This form
takes a fingerprint of 256 bits, hence 32 positional bytes, and goes the same way: an inverted index on
positional bytes, a tally of the shared ones per pair, verification.

At such distances no number of shared bytes is guaranteed. The index keeps the intersections of two lists
(``PAIRS``), so the minimum that the tally asks for is 2; pairs within ``BITS`` differing bits are then
verified on the whole texts: a link is kept if the sets of shingles have the asked similarity. What may be
missed are pairs that share no indexed pair of bytes or differ in more than ``BITS`` bits; see the README
for the measured recall.

Lists hold 1/65,536 of all fingerprints, and a list's pairs are compared in blocks, so that part of the
work grows with the square of the input at a small rate. Only links of spanning forests leave the lists
at first, so a list emits fewer links than entries and a group of many copies is not expanded. Rows of equal
fingerprint and equal set of shingles are one entry; they are linked to the smallest id and verified like all links.

A link of a forest that fails on the texts may have stood for others that would not. So groups by bits that the
verified links do not hold together are compared again: every pair of theirs within the bits whose ends are
not joined so far is verified as well, in the task where the group (or two blocks of a large one) meets with the sets
of its texts, and only links that join parts leave it. A pair that is not verified then lies within one group already,
so the groups are at least those of all pairs the lists show (``open_pairs``, which expands them, is for comparison).

Defined cases: a null text counts as empty; texts without words are one group; fewer words than a shingle
give one shingle of them all; rows without an id and rows whose id is given to several rows are not
compared and belong to no group; empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import keep_ids, slices, texts_of
from tidemark.llm.components import between, components, joined
from tidemark.session import settle

SHINGLE = 5
SIMILARITY = 0.8
SEED = 42
WORDS = 4
POSITIONS = 8 * WORDS
BITS = 51
LIST_ENTRIES = 20_000
BATCH_BYTES = 8 << 20
BLOCK = 512
GROUP_ENTRIES = 512
GROUP_BYTES = 8 << 20

#: Pairs of byte positions under which a fingerprint is filed: each position with two others.
PAIRS = [(p, (p + step) % POSITIONS) for step in (1, 7) for p in range(POSITIONS)]


def shingle_hashes(text: str, shingle: int = SHINGLE, seed: int = SEED) -> np.ndarray:
    """XXH64 of every word shingle of a text, repeats included."""
    words = text.encode().lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    joined = b" ".join(words)
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    spans = zip(starts[:n].tolist(), ends[-n:].tolist())
    return np.fromiter((digest(joined[a:b], seed) for a, b in spans), np.uint64, n)


def _mixed(hashes: np.ndarray) -> np.ndarray:
    """``WORDS`` hashes from each one, by multiplying and shifting with a summand per column."""
    out = hashes[:, None] + np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    out = (out ^ (out >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    out = (out ^ (out >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return out ^ (out >> np.uint64(31))


def fingerprint(hashes: np.ndarray) -> np.ndarray:
    """Majority bits over the mixed hashes, as ``WORDS`` unsigned numbers; zero without hashes.

    Bits are counted eight columns at a time: 255 rows of zeros and ones fit the bytes of a number.
    """
    ones = np.zeros(64 * WORDS, np.int64)
    for at in range(0, len(hashes), 1 << 14):
        mixed = np.ascontiguousarray(_mixed(hashes[at : at + (1 << 14)]))
        bits = np.unpackbits(mixed.view(np.uint8), bitorder="little").reshape(len(mixed), -1).view(np.uint64)
        sums = np.add.reduceat(bits, np.arange(0, len(bits), 255), axis=0)
        ones += sums.view(np.uint8).sum(axis=0, dtype=np.int64)
    return np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, fp, shingles`` of every row: ``fp`` in 32 bytes, and a digest of the set of shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            prints, sets = [], []
            for text in batch.column("text").to_pylist():
                hashes = shingle_hashes(text, shingle)
                prints.append(fingerprint(hashes).tobytes())
                sets.append(xxhash.xxh3_128_digest(np.unique(hashes).tobytes()))
            columns = [batch.column("doc_id"), pa.array(prints, pa.binary()), pa.array(sets, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "fp", "shingles"])

    return docs.mapInArrow(run, "doc_id long, fp binary, shingles binary")


def near_pairs(left: np.ndarray, right: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Which rows of ``left`` and ``right`` share two positional bytes and are within ``bits`` bits."""
    differ = left[:, None, :] ^ right[None, :, :]
    near = np.bitwise_count(differ).sum(axis=2, dtype=np.int64) <= bits
    i, j = np.nonzero(near)
    tally = (differ[i, j].view(np.uint8).reshape(-1, POSITIONS) == 0).sum(axis=1)
    near[i, j] = tally >= 2
    return near


def forest(entries: np.ndarray, bits: int = BITS) -> list[tuple[int, int]]:
    """Links (as places in ``entries``) of a spanning forest of the near pairs of one list.

    Entries that are near nothing go first, found block by block; the rest is walked from the first.
    """
    size = len(entries)
    linked = np.zeros(size, bool)
    for a in range(0, size, BLOCK):
        # Only rows without a partner so far are compared with all; a group of copies is found at once.
        rows = a + np.flatnonzero(~linked[a : a + BLOCK])
        for b in range(0, size if len(rows) else 0, BLOCK):
            near = near_pairs(entries[rows], entries[b : b + BLOCK], bits)
            near[rows[:, None] == np.arange(b, b + near.shape[1])] = False
            linked[rows] |= near.any(axis=1)
            linked[b : b + BLOCK] |= near.any(axis=0)
    links: list[tuple[int, int]] = []
    left = np.flatnonzero(linked)
    while len(left) > 1:
        queue, left = [int(left[0])], left[1:]
        while queue and len(left):
            node = queue.pop(0)
            near = near_pairs(entries[node : node + 1], entries[left], bits)[0]
            if near.any():
                found = left[near].tolist()
                links += [(node, other) for other in found]
                queue += found
                left = left[~near]
    return links


def _near_lists(entries: np.ndarray, sizes: np.ndarray, bits: int, longest: int) -> np.ndarray:
    """Which lists of up to ``longest`` entries hold a near pair: neighbours at each distance, all lists at once."""
    number = np.repeat(np.arange(len(sizes)), sizes)
    short = np.repeat((sizes > 1) & (sizes <= longest), sizes)
    number, entries = number[short], entries[short]
    found = np.zeros(len(sizes), bool)
    for step in range(1, longest):
        at = np.flatnonzero(number[:-step] == number[step:]) if len(number) > step else np.zeros(0, np.int64)
        if not len(at):
            break
        near = np.bitwise_count(entries[at] ^ entries[at + step]).sum(axis=1, dtype=np.int64) <= bits
        found[number[at[near]]] = True
    return found


SHORT_LIST = 24


def _links(rows: pa.Table, bits: int) -> pa.RecordBatch:
    """Links of whole lists."""
    key, rep = rows.column("list").to_numpy(), rows.column("rep").to_numpy()
    entries = np.frombuffer(b"".join(rows.column("fp").to_pylist()), "<u8").reshape(-1, WORDS)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    sizes = np.diff(np.append(starts, len(key)))
    wanted = _near_lists(entries, sizes, bits, SHORT_LIST) | (sizes > SHORT_LIST)
    pairs = []
    for start, size in zip(starts[wanted].tolist(), sizes[wanted].tolist()):
        pairs += [(start + a, start + b) for a, b in forest(entries[start : start + size], bits)]
    places = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(rep[places[:, 0]]), pa.array(rep[places[:, 1]])], ["a", "b"])


def _open_pairs(rows: pa.Table, bits: int) -> pa.RecordBatch:
    """Near pairs of whole lists whose ends are of different ``part``. Each leaves the first list that both are in."""
    key, rep, part = (rows.column(c).to_numpy() for c in ("list", "rep", "part"))
    number = rows.column("number").to_numpy()
    entries = np.frombuffer(b"".join(rows.column("fp").to_pylist()), "<u8").reshape(-1, WORDS)
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    first, second = np.array(PAIRS).T
    found = [np.zeros((0, 2), np.int64)]
    for start, end in zip(starts.tolist(), np.append(starts[1:], len(key)).tolist()):
        if end - start < 2 or (part[start:end] == part[start]).all():
            continue
        for a in range(start, end, BLOCK):
            for b in range(a, end, BLOCK):
                one, other = slice(a, min(a + BLOCK, end)), slice(b, min(b + BLOCK, end))
                near = near_pairs(entries[one], entries[other], bits) & (part[one][:, None] != part[other][None, :])
                i, j = np.nonzero(near)
                i, j = i[i + a < j + b] + a, j[i + a < j + b] + b
                equal = (entries[i] ^ entries[j]).view(np.uint8).reshape(-1, POSITIONS) == 0
                shared = equal[:, first] & equal[:, second]
                here = shared.argmax(axis=1) == number[start]
                found.append(np.stack([rep[i[here]], rep[j[here]]], axis=1))
    pairs = np.concatenate(found)
    return pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])


def _list_links(batches: Iterator[pa.RecordBatch], bits: int, links=_links) -> Iterator[pa.RecordBatch]:
    """Links from rows sorted by list; a list that goes on in the next batch waits for its end."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        lists = batch.column("list").to_numpy()
        last = int(np.searchsorted(lists, lists[-1]))
        if last == 0 and rest and rest[0].column("list")[0].as_py() == lists[-1]:
            rest.append(batch)
            continue
        whole = pa.Table.from_batches([*rest, batch.slice(0, last)])
        rest = [batch.slice(last)]
        if whole.num_rows:
            yield links(whole, bits)
    if rest:
        yield links(pa.Table.from_batches(rest), bits)


def _lists(entries: DataFrame, list_entries: int) -> DataFrame:
    """``list, number`` and all columns of ``entries``: an entry in its lists, sorted; ``number`` is the place in ``PAIRS``."""

    def byte(position: int):
        return F.ascii(F.substring(F.hex("fp"), 2 * position + 1, 1)) * 256 + F.ascii(F.substring(F.hex("fp"), 2 * position + 2, 1))

    keys = [F.lit(n).cast("long") * (1 << 32) + byte(p) * (1 << 16) + byte(q) for n, (p, q) in enumerate(PAIRS)]
    lists = entries.select(F.posexplode(F.array(*keys)).alias("number", "key"), *entries.columns)
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
            "number",
            *entries.columns,
        )
    return dealt.repartition("list").sortWithinPartitions("list", "rep")


def links_of(entries: DataFrame, bits: int = BITS, list_entries: int = LIST_ENTRIES) -> DataFrame:
    """``a, b``: links between the ``rep`` of entries that connect what the lists show to be near."""
    lists = _lists(entries.select("fp", "rep"), list_entries).drop("number")
    return lists.mapInArrow(lambda rows: _list_links(rows, bits), "a long, b long").distinct()


def open_pairs(entries: DataFrame, bits: int = BITS, list_entries: int = LIST_ENTRIES) -> DataFrame:
    """``a, b``: all pairs of ``rep`` that the lists show to be near and whose ``part`` differs."""
    lists = _lists(entries.select("fp", "rep", "part"), list_entries)
    # In a large list that was cut, blocks meet several times.
    return lists.mapInArrow(lambda rows: _list_links(rows, bits, _open_pairs), "a long, b long").distinct()


def _torn_groups(entries: DataFrame, links: DataFrame, parts: DataFrame) -> DataFrame:
    """``entries`` of groups by bits that are not one of the ``parts``, with their ``whole`` group and ``part`` of it.

    Only links between parts are followed, so those that were verified are not gone through once more.
    """

    def named(rows: DataFrame, key: str, group: DataFrame, name: str) -> DataFrame:
        to = group.select(F.col("node").alias(key), F.col("component").alias(name))
        return rows.join(to, key, "left").withColumn(name, F.coalesce(name, key))

    wholes = components(between(links, parts))
    marked = named(named(entries.select("fp", "rep"), "rep", parts, "part"), "part", wholes, "whole")
    marked = settle(marked, "wide-parts")
    torn = marked.groupBy("whole").agg(F.min("part").alias("one"), F.max("part").alias("other")).where("one <> other")
    return marked.join(torn.select("whole"), "whole", "left_semi")


def alike_links(
    entries: np.ndarray, sets: list[np.ndarray], part: np.ndarray, block: np.ndarray, own: np.ndarray, bits: int, least: float
) -> list[tuple[int, int]]:
    """Links (as places) that join the parts of one list: pairs within ``bits`` whose sets have the asked similarity.

    A pair whose ends are joined by then is left out, so there are fewer links than entries. Rows of one ``block`` are
    compared where the list is their ``own``.
    """
    links: list[tuple[int, int]] = []
    tokens, place = np.unique(np.concatenate(sets), return_inverse=True)
    words = np.split(place, np.cumsum([len(s) for s in sets])[:-1])
    sizes, part, held = np.array([len(s) for s in sets]), part.copy(), np.zeros(len(tokens), bool)
    for i in range(len(sets) - 1):
        rest = slice(i + 1, None)
        asked = (part[rest] != part[i]) & (own[i] | (block[rest] != block[i]))
        asked &= np.minimum(sizes[rest], sizes[i]) >= least * np.maximum(sizes[rest], sizes[i]) - 1
        others = i + 1 + np.flatnonzero(asked)
        others = others[near_pairs(entries[i : i + 1], entries[others], bits)[0]]
        held[words[i]] = True
        for j in others.tolist():
            if part[j] != part[i]:
                shared = int(held[words[j]].sum())
                if shared >= least * (sizes[i] + sizes[j] - shared) and similarity(sets[i], sets[j]) >= least:
                    links.append((i, j))
                    part[part == part[j]] = part[i]
        held[words[i]] = False
    return links


def _alike_lists(rows: pa.Table, bits: int, least: float) -> pa.RecordBatch:
    """Links of whole lists, each a group or a pair of blocks of one."""
    key, rep, part, block = (rows.column(c).to_numpy() for c in ("list", "rep", "part", "block"))
    own = rows.column("own").to_numpy()
    entries = np.frombuffer(b"".join(rows.column("fp").to_pylist()), "<u8").reshape(-1, WORDS)
    sets = [np.frombuffer(s, "<u8") for s in rows.column("hashes").to_pylist()]
    starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
    pairs: list[tuple[int, int]] = []
    for start, end in zip(starts.tolist(), np.append(starts[1:], len(key)).tolist()):
        at = slice(start, end)
        found = alike_links(entries[at], sets[at], part[at], block[at], own[at], bits, least)
        pairs += [(start + a, start + b) for a, b in found]
    places = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(rep[places[:, 0]]), pa.array(rep[places[:, 1]])], ["a", "b"])


def alike_in_groups(
    torn: DataFrame,
    texts: DataFrame,
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
    bits: int = BITS,
    group_entries: int = GROUP_ENTRIES,
) -> DataFrame:
    """``a, b``: links that connect all alike texts within the bits of each ``whole`` group, beyond what its parts connect.

    A group meets in one task with the sets of its texts; a large one is cut into blocks that meet in pairs. Only links
    leave a task, never its pairs.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            sets = [np.unique(shingle_hashes(text, shingle)).astype("<u8").tobytes() for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(sets, pa.binary())], ["rep", "hashes"])

    wanted = keep_ids(texts, torn.select(F.col("rep").alias("doc_id")))
    rows = settle(torn.join(wanted.mapInArrow(run, "rep long, hashes binary"), "rep"), "wide-torn")
    weight = F.greatest(F.count(F.lit(1)) / group_entries, F.sum(F.length("hashes")) / GROUP_BYTES)
    large = rows.groupBy("whole").agg(F.ceil(weight).cast("int").alias("blocks")).where("blocks > 1")
    marked = rows.join(settle(large, "wide-large"), "whole", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    marked = marked.withColumn("block", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    dealt = marked.withColumn("partner", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))).select(
        F.xxhash64("whole", F.least("block", "partner"), F.greatest("block", "partner")).alias("list"),
        "rep", "fp", "part", "hashes", "block", F.expr("block = partner").alias("own"),
    )
    lists = dealt.repartition("list").sortWithinPartitions("list", "rep")
    whole_lists = lambda rows: _list_links(rows, bits, lambda t, b: _alike_lists(t, b, least))
    return lists.mapInArrow(whole_lists, "a long, b long").distinct()


def similarity(one: np.ndarray, other: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes; two empty ones are equal."""
    shared = len(np.intersect1d(one, other, assume_unique=True))
    return shared / (len(one) + len(other) - shared) if shared or len(one) or len(other) else 1.0


def verified(links: DataFrame, texts: DataFrame, shingle: int = SHINGLE, least: float = SIMILARITY) -> DataFrame:
    """The links ``a, b`` between texts of ``doc_id, text`` whose shingles have the asked similarity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[int | None, np.ndarray] = (None, np.zeros(0, np.uint64))
        for whole in batches:
            for batch in slices([whole], "text_a", BATCH_BYTES):
                keep = []
                for b, one, other in zip(*(batch.column(c).to_pylist() for c in ("b", "text_a", "text_b"))):
                    if last[0] != b:
                        last = (b, np.unique(shingle_hashes(other, shingle)))
                    keep.append(similarity(np.unique(shingle_hashes(one, shingle)), last[1]) >= least)
                chosen = batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))
                yield chosen

    ends = links.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    named = settle(keep_ids(texts, ends), "linked-texts")
    first = named.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a"))
    second = named.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b"))
    return links.join(first, "a").join(second, "b").select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    shingle: int = SHINGLE,
    least: float = SIMILARITY,
    bits: int = BITS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """``doc_id, component_id`` of every row that is in a group and has not its smallest id, which names the group."""
    texts = texts_of(docs, id_col, text_col).where("doc_id is not null")
    prints = fingerprints(texts, shingle).groupBy("doc_id").agg(
        F.min("fp").alias("fp"), F.min("shingles").alias("shingles"), F.count(F.lit(1)).alias("rows")
    )
    prints = settle(prints.where("rows = 1").drop("rows"), "wide-fingerprints")
    entries = settle(prints.groupBy("fp", "shingles").agg(F.min("doc_id").alias("rep")), "wide-classes")
    equal = prints.join(entries, ["fp", "shingles"]).where("doc_id <> rep").select(F.col("rep").alias("a"), F.col("doc_id").alias("b"))
    links = settle(links_of(entries, bits).unionByName(equal), "wide-links")
    good = settle(verified(links, texts, shingle, least), "wide-verified")
    grouped = components(good)
    if good.count() < links.count():
        torn = settle(_torn_groups(entries, links, grouped), "wide-parts-torn")
        grouped = joined(grouped, alike_in_groups(torn, texts, shingle, least, bits))
    return grouped.select(F.col("node").alias("doc_id"), F.col("component").alias("component_id"))
