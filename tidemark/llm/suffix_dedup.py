"""Removal of byte strings that occur more than once, by column-wise ordering of many texts at once.

A byte goes when it lies in a string of ``length`` bytes that also starts anywhere else. The order of
text positions by what they hold is built column by column: each round adds one symbol per text, parts
the current order stably by it (one step of the Burrows-Wheeler transform of the collection), and
updates how far neighbours in the order agree (their common prefix). Neighbours that agree on
``length`` symbols start equal strings, and a string has an equal one exactly if a neighbour agrees.

Whole texts would need as many rounds as the longest has bytes, and each round the state of the whole
collection. Texts are therefore first cut into pieces that can be ordered apart:

* The anchor of a string of ``length`` bytes is its leftmost ``ANCHOR`` bytes of smallest hash. Equal
  strings have equal anchors at equal places. Strings that follow each other mostly share an anchor and
  form one piece, of ``length`` to 2 * ``length`` - ``ANCHOR`` bytes.
* Anchors are shuffled by hash as narrow rows and read sequentially in sorted order; those that occur
  once are dropped. Of equal anchors in one batch of texts only the first goes by hash, with their
  number, and the others are spread: they are known to be repeated. Only pieces with a repeated anchor have their bytes sent, sorted by anchor.
* Pieces with one anchor are aligned at it, so rounds are columns: at most 2 * ``length`` - ``ANCHOR``
  of them, whatever the length of the texts. The hash only gathers; bytes decide.

Shuffle files, read sequentially, take the place of the external files; a task holds ``TASK_PIECES``
pieces or one anchor's. An anchor above ``HOT_PIECES`` pieces is reduced to different
ones first (equal in all bytes; all strings of one that occurs again are repeated). If it still has more, its
pieces are cut into ``PARTS`` by the place of the anchor in their strings: the strings of a part share
more bytes around the anchor, which gather them into smaller groups; parts are reduced to different ones
and, where a group is still too large, cut again, down to single strings, of which equal ones are one. Every
group is ordered column by column as above. Only the way back from a piece to its copies goes by SHA-256.

Defined cases: a null or empty text, or one shorter than ``length``, keeps all bytes; overlapping
occurrences and occurrences in the same text count; a repeated row makes all of its strings repeated; a
null id is kept; strings are judged on the input, so every copy goes, the first one too.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import BROADCAST_ROWS, slices
from tidemark.session import settle

LENGTH = 200
ANCHOR = 64
BATCH_BYTES = 2 << 20
TASK_PIECES = 20_000
HOT_PIECES = 50_000
PARTS = 8
_BASE = 0x9E3779B97F4A7C15 | 1
_PIECES = "hash long, row long, start long, strings int, shift int"
_ANCHORS = _PIECES + ", n long, spread long"
_CROPS = "row binary, start long, hash long, shift int, lo int, hi int, piece binary, n long"


def _powers(n: int, base: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_TABLE = np.random.default_rng(42).integers(1, 1 << 63, 256, dtype=np.uint64)
_INVERSE = pow(_BASE, -1, 1 << 64)


def anchor_hashes(data: np.ndarray, anchor: int = ANCHOR) -> np.ndarray:
    """A hash of the ``anchor`` bytes at each place; equal bytes have equal hashes."""
    n = len(data)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(_TABLE[data] * _powers(n, _BASE), out=sums[1:])
    out = (sums[anchor:] - sums[:-anchor]) * _powers(n - anchor + 1, _INVERSE)
    out ^= out >> np.uint64(29)
    out *= np.uint64(0xBF58476D1CE4E5B9)
    return out ^ (out >> np.uint64(32))


def find_pieces(texts: list[bytes], length: int = LENGTH, anchor: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """Text, first string, number of strings, place of the anchor in the first string, and its hash, per piece."""
    sizes = np.array([len(t) for t in texts], np.int64)
    data = np.frombuffer(b"".join(texts), np.uint8)
    none = np.zeros(0, np.int64)
    if len(data) < length:
        return none, none, none, none, none
    hashes = anchor_hashes(data, anchor)
    bits = np.uint64(int(len(data)).bit_length())
    low = (hashes >> bits << bits) | np.arange(len(hashes), dtype=np.uint64)
    width, done = length - anchor + 1, 1
    least = low
    while done * 2 <= width:
        least = np.minimum(least[:-done], least[done:])
        done *= 2
    if done < width:
        least = np.minimum(least[: len(least) - (width - done)], least[width - done :])
    places = (least & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    ends = np.cumsum(sizes)
    text = np.repeat(np.arange(len(texts)), sizes)[: len(places)]
    starts = np.arange(len(places))
    inside = starts + length <= ends[text]
    starts, places, text = starts[inside], places[inside], text[inside]
    if not len(starts):
        return none, none, none, none, none
    new = np.ones(len(starts), bool)
    new[1:] = (places[1:] != places[:-1]) | (text[1:] != text[:-1])
    first = np.flatnonzero(new)
    strings = np.diff(np.append(first, len(starts)))
    text, begin, place = text[first], starts[first], places[first]
    return text, begin - (ends - sizes)[text], strings, place - begin, hashes[place].view(np.int64)


def repeated_strings(rows: list[bytes], shifts: np.ndarray, groups: np.ndarray, length: int = LENGTH, anchor: int = ANCHOR):
    """Which strings of which pieces have an equal one, as a matrix of piece by column of the string's start.

    ``groups`` is the anchor's number of each piece, ascending; ``shifts`` the anchor's place in a piece.
    """
    n, before = len(rows), length - anchor
    columns = 2 * length - anchor
    first = before - shifts
    sizes = np.array([len(r) for r in rows])
    cell = np.arange(columns)
    covered = (cell >= first[:, None]) & (cell < (first + sizes)[:, None])
    symbols = np.zeros((n, columns), np.int16)
    symbols[covered] = np.frombuffer(b"".join(rows), np.uint8)
    symbols[~covered] = 256
    symbols = np.ascontiguousarray(symbols.T)
    found = np.zeros((columns - length + 1, n), bool)
    order = np.arange(n)
    block = groups.astype(np.int64) * 257
    # agree[i]: the column from which on the i-th and the one before it in the order are equal.
    agree = np.zeros(n, np.int64)
    agree[1:][groups[1:] != groups[:-1]] = columns + 1
    for column in range(columns):
        symbol = symbols[column][order]
        key = block[order] + symbol
        moved = np.argsort(key, kind="stable")
        key = key[moved]
        same = np.zeros(n, bool)
        same[1:] = (key[1:] == key[:-1]) & (symbol[moved[1:]] != 256)
        after = np.full(n, column + 1, np.int64)
        at = np.flatnonzero(same)
        if len(at):
            # Between two that stay neighbours, the weakest agreement of those that stood between counts.
            low, high = moved[at - 1] + 1, moved[at]
            near = high == low
            after[at[near]] = agree[low[near]]
            far = ~near
            if far.any():
                spans = np.stack([low[far], high[far] + 1], axis=1).ravel()
                padded = np.append(agree, 0)
                after[at[far]] = np.maximum.reduceat(padded, spans)[::2]
        order, agree = order[moved], after
        start = column - length + 1
        if start >= 0:
            equal = agree <= start
            equal[0] = False
            either = equal.copy()
            either[:-1] |= equal[1:]
            found[start][order[either]] = True
    return found.T, first


def _spans(found: np.ndarray, first: np.ndarray, begins: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Piece and byte span of each run of repeated strings."""
    edge = np.zeros((len(found), found.shape[1] + 2), np.int8)
    edge[:, 1:-1] = found
    change = np.diff(edge, axis=1)
    piece, start = np.nonzero(change == 1)
    stop = np.nonzero(change == -1)[1]
    return piece, begins[piece] + start - first[piece], begins[piece] + stop - first[piece] + length - 1


def _groups(batches: Iterator[pa.RecordBatch], column: str, at_least: int) -> Iterator[pa.Table]:
    """Rows sorted by ``column`` in tables of about ``at_least`` rows that never part equal values."""
    rest: list[pa.RecordBatch] = []
    held = 0
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(column).to_numpy()
        cut = int(np.searchsorted(values, values[-1]))
        if held and held + cut >= at_least and (cut > 0 or rest[-1].column(column)[-1].as_py() != values[-1]):
            yield pa.Table.from_batches([*rest, batch.slice(0, cut)])
            rest, held = [batch.slice(cut)], batch.num_rows - cut
        else:
            rest.append(batch)
            held += batch.num_rows
    if held:
        yield pa.Table.from_batches(rest)


def _counted(hashes: np.ndarray) -> np.ndarray:
    """For the first of equal hashes how many there are, 0 for the others."""
    _, first, counts = np.unique(hashes, return_index=True, return_counts=True)
    out = np.zeros(len(hashes), np.int64)
    out[first] = counts
    return out


def _repeated_only(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Anchors that occur more than once, with how often; 0 for those counted with another of their batch."""
    for table in _groups(batches, "spread", TASK_PIECES):
        n = table.column("n").to_numpy()
        table = table.drop_columns(["n", "spread"])
        values = table.column("hash").to_numpy()[n > 0]
        starts = np.flatnonzero(np.concatenate([[True], values[1:] != values[:-1]])) if len(values) else np.zeros(0, int)
        total = np.zeros(len(n), np.int64)
        if len(starts):
            total[n > 0] = np.repeat(np.add.reduceat(n[n > 0], starts), np.diff(np.append(starts, len(values))))
        table = table.append_column("total", pa.array(total)).filter(pa.array((n == 0) | (total > 1)))
        yield from table.to_batches(max_chunksize=50_000)


def _columnwise(batches: Iterator[pa.RecordBatch], length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    for table in _groups(batches, "hash", TASK_PIECES):
        values = table.column("hash").to_numpy()
        groups = np.concatenate([[0], np.cumsum(values[1:] != values[:-1])])
        found, first = repeated_strings(table.column("piece").to_pylist(), table.column("shift").to_numpy(), groups, length, anchor)
        piece, start, stop = _spans(found, first, table.column("start").to_numpy(), length)
        rows = table.column("row").take(pa.array(piece)).combine_chunks()
        yield pa.RecordBatch.from_arrays([rows, pa.array(start), pa.array(stop)], ["row", "start", "stop"])


def _split(batches: Iterator[pa.RecordBatch], width: int, length: int, anchor: int) -> Iterator[pa.RecordBatch]:
    """Pieces cut by how many bytes their strings have before the anchor, ``width`` numbers to a part.

    All strings of a part hold the same stretch around the anchor, by whose bytes the part is gathered.
    """
    before = length - anchor
    names = [x.split()[0] for x in _CROPS.split(", ")]
    for batch in batches:
        out: list[tuple] = []
        for row, key, shift, lo, hi, piece, n in zip(*(batch.column(c).to_pylist() for c in ("id", *names[2:]))):
            last = shift - (len(piece) - length)
            for a in range(lo, hi + 1, width):
                b = min(a + width - 1, hi)
                most, least = min(b, shift), max(a, last)
                if least > most:
                    continue
                around = piece[shift - a : shift + anchor + before - b]
                gathered = xxhash.xxh64_intdigest(b"%d %d %d " % (key, a, b) + around) - (1 << 63)
                out.append((row, shift - most, gathered, most, a, b, piece[shift - most : shift - least + length], n))
        columns = zip(*out) if out else [()] * len(names)
        types = [pa.binary(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.int64()]
        yield from pa.Table.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names).to_batches(max_chunksize=20_000)


def _merged(spans: DataFrame) -> DataFrame:
    """Spans of a row that touch or overlap as one."""
    order = Window.partitionBy("row").orderBy("start", "stop")
    reached = F.max("stop").over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.when(F.col("start") <= reached, 0).otherwise(1)
    runs = spans.withColumn("new", new).withColumn("run", F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("row", "run").agg(F.min("start").alias("start"), F.max("stop").alias("stop")).drop("run")


def _few(keys: DataFrame) -> tuple[DataFrame, int]:
    """Written keys, sent to all tasks if there are few, and how many (counted up to a limit)."""
    keys = settle(keys, "hot-anchors")
    n = keys.limit(BROADCAST_ROWS + 1).count()
    return (F.broadcast(keys) if n <= BROADCAST_ROWS else keys), n


def _hot_spans(cut: DataFrame, length: int, anchor: int, hot: int) -> DataFrame:
    """Spans of repeated strings in pieces whose anchors have very many: the same order over different pieces."""
    same = ["hash", "shift", "lo", "hi", "piece"]
    label = F.encode(F.concat_ws(":", *same[:-1]), "utf-8")
    named = F.unhex(F.sha2(F.concat(label, F.col("piece")), 256))
    width = length - anchor + 1
    level = cut.select(
        "row", "start", "hash", "shift", F.lit(0).alias("lo"), F.lit(width - 1).alias("hi"), "piece", F.lit(1).cast("long").alias("n")
    )
    ways, found = [], []
    while True:
        level = level.withColumn("id", named)
        ways.append(level.select("id", F.col("row").alias("up"), F.col("start").alias("at")))
        different = settle(level.groupBy("id", *same).agg(F.sum("n").alias("n")), "hot-pieces")
        over, n_over = _few(different.groupBy("hash").count().where(F.col("count") > hot).select("hash"))
        if width == 1:
            n_over = 0  # equal strings, which are one row
        usual = different.join(over, "hash", "left_anti") if n_over else different
        usual = usual.select(F.col("id").alias("row"), F.lit(0).cast("long").alias("start"), "hash", "shift", "piece")
        usual = usual.repartition("hash").sortWithinPartitions("hash")
        # All strings of a piece that occurs again are repeated.
        size = F.octet_length("piece").cast("long")
        whole = different.where("n > 1").select(F.col("id").alias("row"), F.lit(0).cast("long").alias("start"), size.alias("stop"))
        spans = usual.mapInArrow(lambda rows: _columnwise(rows, length, anchor), "row binary, start long, stop long")
        found.append(spans.unionByName(whole))
        if not n_over:
            break
        width = -(-width // PARTS)
        crops = different.join(over, "hash", "left_semi").select("id", *same, "n")
        level = settle(crops.mapInArrow(partial(_split, width=width, length=length, anchor=anchor), _CROPS), "crops")
    spans = None
    for way, own in zip(reversed(ways), reversed(found)):
        # Stored, so that the join can split the many copies of a piece.
        spans = settle(_merged(own if spans is None else own.unionByName(spans)), "hot-runs")
        spans = way.join(spans, F.col("id") == F.col("row")).select(
            F.col("up").alias("row"), (F.col("at") + F.col("start")).alias("start"), (F.col("at") + F.col("stop")).alias("stop")
        )
    return spans


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Texts with a ``row`` of their own (the id, unless ids repeat or are missing) and their whole input row."""
    others = [F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(docs.columns)]
    texts = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), F.struct(*others).alias("source")
    )
    ids = texts.groupBy("doc_id").agg(F.count(F.lit(1)).alias("n"))
    if ids.where("n > 1 or doc_id is null").isEmpty():
        return texts.withColumn("row", F.col("doc_id"))
    return settle(texts.withColumn("row", F.monotonically_increasing_id()), "numbered")


def repeated_spans(keyed: DataFrame, length: int = LENGTH, anchor: int = ANCHOR, hot: int = HOT_PIECES) -> DataFrame:
    """``row, start, stop``: byte spans of repeated strings, possibly overlapping."""

    def anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            text, begin, strings, shift, hashes = find_pieces(texts, length, anchor)
            rows = batch.column("row").to_numpy()[text] if len(text) else np.zeros(0, np.int64)
            n = _counted(hashes)
            spread = np.where(n > 0, hashes, (rows * 31 + begin) * np.int64(0x9E3779B97F4A7C1))
            columns = [hashes, rows, begin, strings.astype(np.int32), shift.astype(np.int32), n, spread]
            names = ["hash", "row", "start", "strings", "shift", "n", "spread"]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["hash", "row", "start", "strings", "shift", "piece"]
        for batch in slices(batches, "text", BATCH_BYTES):
            texts = [t.encode() for t in batch.column("text").to_pylist()]
            runs = batch.column("runs")
            counts = np.diff(runs.offsets.to_numpy())
            flat = runs.flatten()
            fields = {name: flat.field(name) for name in ("hash", "start", "strings", "shift")}
            begin, strings = fields["start"].to_numpy(), fields["strings"].to_numpy()
            which = np.repeat(np.arange(len(texts)), counts)
            cut = [texts[i][a : a + k + length - 1] for i, a, k in zip(which.tolist(), begin.tolist(), strings.tolist())]
            columns = [fields["hash"], pa.array(batch.column("row").to_numpy()[which]), *list(fields.values())[1:], pa.array(cut, pa.binary())]
            yield from pa.Table.from_arrays(columns, names).to_batches(max_chunksize=20_000)

    found = keyed.select("row", "text").mapInArrow(anchors, _ANCHORS)
    repeated = found.repartition("spread").sortWithinPartitions("spread").mapInArrow(_repeated_only, _PIECES + ", total long")
    runs = repeated.groupBy("row").agg(F.collect_list(F.struct("hash", "start", "strings", "shift", "total")).alias("runs"))
    runs = settle(runs, "pieces")
    cut = keyed.select("row", "text").join(runs, "row").mapInArrow(pieces, _PIECES + ", piece binary")
    often = runs.select(F.explode("runs").alias("run")).where(F.col("run.total") > hot).select("run.hash").distinct()
    often, n_often = _few(often)
    cut = settle(cut, "cut") if n_often else cut
    usual = cut.join(often, "hash", "left_anti") if n_often else cut
    usual = usual.repartition("hash").sortWithinPartitions("hash")
    spans = usual.mapInArrow(lambda rows: _columnwise(rows, length, anchor), "row long, start long, stop long")
    if not n_often:
        return spans
    return spans.unionByName(_hot_spans(cut.join(often, "hash", "left_semi"), length, anchor, hot))


def _apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["row", "doc_id", "kept", "n_bytes", "n_removed", "n_spans"]
    for batch in slices(batches, "text", BATCH_BYTES):
        out: list[tuple] = []
        spans = batch.column("spans")
        for row, (number, doc, text) in enumerate(
            zip(*(batch.column(c).to_pylist() for c in ("row", "doc_id", "text")))
        ):
            data, merged = text.encode(), []
            if spans[row].is_valid:
                values = spans[row].values
                start, stop = values.field("start").to_numpy(), values.field("stop").to_numpy()
                order = np.argsort(start, kind="stable")
                start, stop = start[order], np.maximum.accumulate(stop[order])
                new = np.flatnonzero(np.concatenate([[True], start[1:] > stop[:-1]]))
                merged = list(zip(start[new].tolist(), stop[np.append(new[1:] - 1, len(stop) - 1)].tolist()))
            kept, at = [], 0
            for a, b in merged:
                kept.append(data[at:a])
                at = b
            kept.append(data[at:])
            rest = b"".join(kept)
            out.append((number, doc, rest, len(data), len(data) - len(rest), len(merged)))
        types = [pa.int64(), pa.int64(), pa.binary()] + [pa.int64()] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def _found(keyed: DataFrame, length: int, anchor: int | None) -> DataFrame:
    found = repeated_spans(keyed, length, anchor or max(1, length * ANCHOR // LENGTH))
    return found.groupBy("row").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))


def dedup_strings(
    docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text", anchor: int | None = None
) -> DataFrame:
    """``doc_id, kept, n_bytes, n_removed, n_spans`` per row, ``kept`` being the bytes that stay."""
    keyed = _keyed(docs, id_col, text_col)
    joined = keyed.select("row", "doc_id", "text").join(_found(keyed, length, anchor), "row", "left")
    return joined.mapInArrow(_apply, "row long, doc_id long, kept binary, n_bytes long, n_removed long, n_spans long").drop("row")


def without_repeats(docs: DataFrame, length: int = LENGTH, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The input rows with repeated strings taken out of the text; other columns as they came.

    Where a cut parts a character, what is left of the character goes too. A null text stays null.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            source = batch.column("source")
            rest = next(_apply([batch.drop_columns(["source"])])).column("kept").to_pylist()
            texts = pa.array([r.decode("utf-8", "ignore") for r in rest], pa.string())
            yield pa.RecordBatch.from_arrays([source, texts], ["source", "text"])

    keyed = _keyed(docs, id_col, text_col)
    joined = keyed.join(_found(keyed, length, None), "row", "left")
    schema = T.StructType([keyed.schema["source"], T.StructField("text", T.StringType())])
    changed = joined.select("source", "row", "doc_id", "text", "spans").mapInArrow(cut, schema)
    columns = []
    for i, name in enumerate(docs.columns):
        column = F.col(f"source.c{i}")
        if name == text_col:
            column = F.when(column.isNotNull(), F.col("text"))
        columns.append(column.alias(name))
    return changed.select(*columns)
