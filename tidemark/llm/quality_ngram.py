"""Quality filter: perplexity under an n-gram model of trusted text, judged per language.

The model is an interpolated modified Kneser-Ney model over UTF-8 bytes, so its vocabulary is closed
(256 symbols) and any text has a probability. Counts of the highest order come from all trusted rows,
whole texts; lower orders count the distinct bytes that come before; each order has three discounts from
its counts of counts. All of these are tables, sharded by context.

Scoring joins counts, not texts: texts are gathered into blocks of about ``BLOCK_BYTES``; each block asks
once for every n-gram in it; the distinct n-grams of all blocks meet the sharded counts order by order;
the answers go back to their blocks, where each document's log-probabilities are summed. Rows asked for
grow with the number of blocks, hence with the input, and no table of the model is held by any one task
beyond the 256 contexts of its lowest orders.

A document is judged by its mean loss less ``SURE`` standard errors, so that a few words are not
rejected on thin evidence. The limit of a language is the ``QUANTILE`` of that figure over its trusted
rows, each scored without its own counts: trusted rows are dealt into ``FOLDS`` by the hash of their text,
and besides the model of all rows (which judges) there is one without each fold. The fold that a model
leaves out lies in the integers of its n-grams, above their bytes, so all models are the same tables.
A quantile of few rows says little: with n rows it counts n parts, and the language's median plus what the
quantile of all languages lies above theirs counts 1 / (1 - ``QUANTILE``) parts. The median of n rows in
turn counts n parts, the median of all rows ``MEDIAN_ROWS``. A language without trusted rows has the limit
of all trusted rows.

Defined cases: an empty or null text has no loss and is kept; a null language is a language of its own;
without trusted rows nothing is rejected; repeated rows are judged alike, and count twice when trusted;
long texts are scored in full; an empty table gives an empty result; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS
from tidemark.session import settle

ORDER = 4
QUANTILE = 0.995
SURE = 2.0
FOLDS = 5
MEDIAN_ROWS = 5
BLOCK_BYTES = 12 << 20
UNIQUE_BYTES = 2 << 20
_SCORES = "doc_id long, text_hash long, lang string, fold long, n_bytes long, loss double, loss_error double"


def grams(texts: list[bytes], order: int = ORDER) -> np.ndarray:
    """The n-gram that ends at each byte, as an integer; a text starts after zero bytes."""
    pad = b"\0" * (order - 1)
    data = np.frombuffer(b"".join(pad + t for t in texts) if texts else b"", np.uint8).astype(np.int64)
    out = data.copy()
    for back in range(1, order):
        out[back:] |= data[:-back] << (8 * back)
    ends = np.cumsum([len(t) + order - 1 for t in texts]) if texts else np.zeros(0, int)
    real = np.ones(len(data), bool)
    for k in range(order - 1):
        real[ends - np.array([len(t) for t in texts], int) - 1 - k] = False
    return out[real]


def _unique(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct n-grams and their counts, a few megabytes of text at a time."""
    parts: list[tuple[np.ndarray, np.ndarray]] = []
    group: list[bytes] = []
    size = 0
    for text in [*texts, None]:
        if group and (text is None or size + len(text) > UNIQUE_BYTES):
            parts.append(np.unique(grams(group, order), return_counts=True))
            group, size = [], 0
        if text is not None:
            group.append(text)
            size += len(text)
    if not parts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    keys, counts = (np.concatenate(x) for x in zip(*parts))
    found, place = np.unique(keys, return_inverse=True)
    return found, np.bincount(place, weights=counts).astype(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[tuple[int, pa.Table]]:
    """The rows of a task in numbered blocks of about ``limit`` bytes of text."""
    part, number = TaskContext.get().partitionId(), 0
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        ends = np.cumsum([len(t.as_buffer() or b"") for t in batch.column("text")]) if batch.num_rows else []
        start = 0
        while start < batch.num_rows:
            before = int(ends[start - 1]) if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit - size, side="right")))
            held.append(batch.slice(start, stop - start))
            size += int(ends[stop - 1]) - before
            start = stop
            if size >= limit or start < batch.num_rows:
                yield part << 24 | number, pa.Table.from_batches(held)
                number, held, size = number + 1, [], 0
    if held:
        yield part << 24 | number, pa.Table.from_batches(held)


def _bytes_of(table: pa.Table, rows: np.ndarray) -> list[bytes]:
    return [t.encode() for t in table.column("text").take(pa.array(rows)).to_pylist()]


def _by_fold(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """Each fold of a block and its rows."""
    own = table.column("fold").to_numpy()
    for fold in np.unique(own).tolist():
        yield fold, np.flatnonzero(own == fold)


def _views(table: pa.Table) -> Iterator[tuple[int, np.ndarray]]:
    """By model, the rows of a block that it scores: the whole model all, the others their fold."""
    yield 0, np.arange(table.num_rows)
    yield from ((fold, rows) for fold, rows in _by_fold(table) if fold)


def _last(n: int, order: int) -> Column:
    """The last ``n`` bytes of a column ``gram``, and its fold."""
    return F.col("gram").bitwiseAND(F.lit((1 << (8 * n)) - 1 - (1 << (8 * order))))


def fold_of(folds: int) -> Column:
    """The fold of a column ``text``, from 1; equal texts share theirs."""
    return F.pmod(F.xxhash64(F.coalesce("text", F.lit(""))), F.lit(folds)) + 1


class Model:
    """Per order the contexts with their total, their back-off weight and the counts of what follows."""

    def __init__(self, highest: DataFrame, order: int = ORDER):
        self.order = order
        self.contexts: dict[int, DataFrame] = {}
        self.discounts: dict[int, dict[int, list[float]]] = {}
        counts = settle(highest, "ngrams")
        for n in range(order, 0, -1):
            if n < order:
                lower = counts.groupBy(_last(n, order).alias("gram")).agg(F.count(F.lit(1)).alias("n"))
                counts = settle(lower, "ngrams")
            self.discounts[n] = self._discounts(counts)
            self.contexts[n] = settle(self._contexts(counts, self.discounts[n]), "contexts")

    def _discounts(self, counts: DataFrame) -> dict[int, list[float]]:
        """By fold left out, what counts of 1, 2, and 3 or more give up, from the counts of counts."""
        fold = F.shiftright("gram", 8 * self.order).alias("fold")
        found = {}
        for left_out, *seen in counts.groupBy(fold).agg(*[F.count_if(F.col("n") == k) for k in (1, 2, 3, 4)]).collect():
            n1, n2, n3, n4 = (max(1, x) for x in seen)
            ratio = n1 / (n1 + 2 * n2)
            wanted = [1 - 2 * ratio * n2 / n1, 2 - 3 * ratio * n3 / n2, 3 - 4 * ratio * n4 / n3]
            found[left_out] = [min(max(x, 0.1), k - 0.05) for k, x in enumerate(wanted, 1)]
        return found

    def _discount(self, n: Column, discounts: dict[int, list[float]]) -> Column:
        given = F.lit(None).cast("double")
        for left_out, (one, two, more) in discounts.items():
            own = F.when(n == 1, F.lit(one)).when(n == 2, F.lit(two)).otherwise(F.lit(more))
            given = F.when(F.shiftright("gram", 8 * self.order) == left_out, own).otherwise(given)
        return given

    def _contexts(self, counts: DataFrame, discounts: dict[int, list[float]]) -> DataFrame:
        given = self._discount(F.col("n"), discounts)
        entry = F.struct(F.col("gram").bitwiseAND(F.lit(255)).cast("int").alias("byte"), (F.col("n") - given).alias("rest"))
        grouped = counts.groupBy(F.shiftright("gram", 8).alias("context")).agg(
            F.sum("n").alias("total"), F.sum(given).alias("given"), F.map_from_entries(F.collect_list(entry)).alias("rest")
        )
        return grouped.select("context", (F.col("given") / F.col("total")).alias("back_off"), "total", "rest")

    def probability(self, asked: DataFrame) -> DataFrame:
        """``gram, p`` for a table of distinct ``gram``: the orders interpolated from the lowest up."""
        found = asked.withColumn("p", F.lit(1 / 256))
        byte = F.col("gram").bitwiseAND(F.lit(255)).cast("int")
        for n in range(1, self.order + 1):
            key = F.shiftright(_last(n, self.order), 8).alias("context")
            # The two lowest orders have, for each model, at most 256 contexts of at most 256 bytes.
            table = F.broadcast(self.contexts[n]) if n <= 2 else self.contexts[n]
            joined = found.withColumn("context", key).join(table, "context", "left")
            own = F.coalesce(F.try_element_at("rest", byte), F.lit(0.0)) / F.col("total")
            seen = F.col("total").isNotNull()
            found = joined.select("gram", F.when(seen, own + F.col("back_off") * F.col("p")).otherwise(F.col("p")).alias("p"))
        return found


def count_grams(texts: DataFrame, order: int = ORDER, folds: int = 0) -> DataFrame:
    """``gram, n`` over all rows of a table with ``text``, and over all but those of each fold."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, table in _blocks(batches, BLOCK_BYTES):
            for fold, some in _by_fold(table):
                keys, counts = _unique(_bytes_of(table, some), order)
                yield pa.RecordBatch.from_arrays([pa.array(keys | fold << 8 * order), pa.array(counts)], ["gram", "n"])

    fold = fold_of(folds) if folds else F.lit(0).cast("long")
    counted = texts.select(F.coalesce("text", F.lit("")).alias("text"), fold.alias("fold")).mapInArrow(run, "gram long, n long")
    counted = counted.groupBy("gram").agg(F.sum("n").alias("n"))
    if not folds:
        return counted
    # Counts of a fold go to the model of all rows and to those that leave out another fold.
    own = F.shiftright("gram", 8 * order)
    models = F.filter(F.sequence(F.lit(0).cast("long"), F.lit(folds).cast("long")), lambda x: x != F.col("own"))
    dealt = counted.select("gram", "n", own.alias("own")).select("gram", "n", F.explode(models).alias("model"))
    gram = F.col("gram").bitwiseAND(F.lit((1 << (8 * order)) - 1)).bitwiseOR(F.shiftleft("model", 8 * order))
    return dealt.groupBy(gram.alias("gram")).agg(F.sum("n").alias("n"))


def score(docs: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, text_hash, lang, fold, n_bytes, loss, loss_error`` of every row, in bits per byte.

    The whole model scores all rows (``fold`` 0). ``docs`` may have a column ``fold``: rows where it is not 0 get
    a second row, scored by the model without that fold.
    """
    order = model.order
    texts = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.xxhash64("text").alias("text_hash"),
        "lang",
        F.coalesce("text", F.lit("")).alias("text"),
        (F.col("fold") if "fold" in docs.columns else F.lit(0)).cast("long").alias("fold"),
    )

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table in _blocks(batches, block_bytes):
            for fold, rows in _views(table):
                keys = _unique(_bytes_of(table, rows), order)[0] | fold << 8 * order
                for at in range(0, len(keys), 100_000):
                    some = keys[at : at + 100_000]
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), block)), pa.array(some)], ["block", "gram"])

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block, table in _blocks(batches, block_bytes):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, table.schema) as writer:
                writer.write_table(table)
            packed = zstandard.ZstdCompressor(level=9).compress(sink.getvalue().to_pybytes())
            yield pa.RecordBatch.from_arrays([pa.array([block]), pa.array([packed], pa.binary())], ["block", "texts"])

    def answer(texts: pa.Table, answers: pa.Table) -> pa.Table:
        keys = answers.column("gram").to_numpy()
        order_of = np.argsort(keys)
        keys, logs = keys[order_of], answers.column("bits").to_numpy()[order_of].astype(np.float64)
        out: list[pd.DataFrame] = []
        for packed in texts.column("texts").to_pylist():
            whole = pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(packed)).read_all()
            for fold, some in _views(whole):
                rows, data = whole.drop_columns("text").take(pa.array(some)), _bytes_of(whole, some)
                means, errors = np.full(len(data), np.nan), np.zeros(len(data))
                start = 0
                while start < len(data):
                    stop, size = start, 0
                    while stop < len(data) and (stop == start or size + len(data[stop]) <= UNIQUE_BYTES):
                        size += len(data[stop])
                        stop += 1
                    wanted = grams(data[start:stop], order) | fold << 8 * order
                    place = np.searchsorted(keys, wanted)
                    if len(wanted) and (not len(keys) or place.max() == len(keys) or not np.array_equal(keys[place], wanted)):
                        raise ValueError("a block changed between asking and scoring; write the documents to a table first")
                    lengths = np.array([len(d) for d in data[start:stop]])
                    full = np.flatnonzero(lengths)
                    if len(full):
                        begins = (np.cumsum(lengths) - lengths)[full]
                        n, loss = lengths[full], logs[place]
                        mean = np.add.reduceat(loss, begins) / n
                        spread = np.maximum(np.add.reduceat(loss * loss, begins) / n - mean * mean, 0)
                        # A handful of bytes says little about its own spread; that of a usual text is added as one byte's worth.
                        means[start + full], errors[start + full] = mean, np.sqrt((spread * n + 6.0) / n / n)
                    start = stop
                out.append(
                    pa.table(
                        {
                            "doc_id": rows.column("doc_id"),
                            "text_hash": rows.column("text_hash"),
                            "lang": rows.column("lang"),
                            "fold": pa.array(np.full(len(data), fold)),
                            "n_bytes": pa.array([len(d) for d in data], pa.int64()),
                            "loss": pa.array(means, mask=np.isnan(means)),
                            "loss_error": pa.array(errors),
                        }
                    )
                )
        empty = {"doc_id": pa.int64(), "text_hash": pa.int64(), "lang": pa.string(), "fold": pa.int64(), "n_bytes": pa.int64()}
        empty |= {"loss": pa.float64(), "loss_error": pa.float64()}
        return pa.concat_tables(out) if out else pa.schema(empty).empty_table()

    asked = settle(texts.select("text", "fold").mapInArrow(ask, "block long, gram long"), "asked")
    known = model.probability(asked.select("gram").distinct())
    answers = asked.join(known, "gram").select("block", "gram", (-F.log2("p")).cast("float").alias("bits"))
    packed = texts.mapInArrow(gather, "block long, texts binary")
    return packed.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(answer, _SCORES)


def _limits(good: DataFrame, quantile: float) -> tuple[DataFrame, float | None]:
    """``of, own`` by language from trusted rows with ``low``, and the limit of them all."""

    def at(part: float) -> Column:
        # Quantiles of mergeable sketches; the error is one part in their accuracy.
        return F.percentile_approx("low", F.lit(part), F.lit(100_000))

    median, overall = good.agg(at(0.5), at(quantile)).first()
    own = settle(good.groupBy(F.col("lang").alias("of")).agg(F.count(F.lit(1)).alias("n"), at(0.5).alias("middle"), at(quantile).alias("high")), "limits")
    above = good.join(own, F.col("lang").eqNullSafe(F.col("of"))).withColumn("low", F.col("low") - F.col("middle")).agg(at(quantile)).first()[0]
    n, parts = F.col("n"), 1 / max(1 - quantile, 1e-9)
    middle = (n * F.col("middle") + F.lit(MEDIAN_ROWS) * F.lit(median).cast("double")) / (n + MEDIAN_ROWS)
    limit = (n * F.col("high") + F.lit(parts) * (middle + F.lit(above).cast("double"))) / (n + F.lit(parts))
    return own.select("of", limit.alias("own")), overall


def _marked(docs: DataFrame, trusted: DataFrame) -> DataFrame:
    """``docs`` with the ``fold`` of trusted rows, 0 for others; always in the same order, as blocks need."""
    wanted = trusted.select(F.col("doc_id").alias("_wanted")).where("_wanted is not null").distinct()
    few = wanted.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    joined = docs.join(F.broadcast(wanted) if few else wanted, docs["doc_id"] == F.col("_wanted"), "left")
    fold = F.when(F.col("_wanted").isNull(), F.lit(0).cast("long")).otherwise(fold_of(FOLDS))
    marked = joined.select(docs["doc_id"], "text", "lang", fold.alias("fold"))
    return marked if few else settle(marked, "marked")


def judge(docs: DataFrame, trusted: DataFrame, quantile: float = QUANTILE, sure: float = SURE, order: int = ORDER) -> DataFrame:
    """``doc_id, text_hash, lang, n_bytes, perplexity, limit, keep`` of every row.

    ``docs`` has ``doc_id, text, lang``; ``trusted`` has the ``doc_id`` of the trusted rows. Perplexity is
    per byte, under the model of all trusted rows; ``limit`` bounds the loss less its standard errors.
    """
    marked = _marked(docs.select("doc_id", "text", "lang"), trusted)
    model = Model(count_grams(marked.where("fold > 0"), order, FOLDS), order)
    scored = settle(score(marked, model), "losses")
    scored = scored.withColumn("low", F.col("loss") - sure * F.col("loss_error"))
    limits, overall = _limits(scored.where("fold > 0 and low is not null"), quantile)
    joined = scored.where("fold = 0").join(limits, F.col("lang").eqNullSafe(F.col("of")), "left")
    limit = F.coalesce("own", F.lit(overall).cast("double"))
    return joined.select(
        "doc_id",
        "text_hash",
        "lang",
        "n_bytes",
        F.pow(F.lit(2.0), "loss").alias("perplexity"),
        limit.alias("limit"),
        F.coalesce(F.col("low") <= limit, F.lit(True)).alias("keep"),
    )
