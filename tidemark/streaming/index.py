"""A text index of numbered segments that is refreshed with what changed."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark.commits import CommitLog
from tidemark.functions.columns import words
from tidemark.operators import blockmax as X
from tidemark.operators.joins import fits_broadcast, lookup_join
from tidemark.operators.latest import latest_per_key
from tidemark.operators.quality import freshness
from tidemark.operators.search import query_terms, rank_top
from tidemark.session import settle
from tidemark.sources.files import ntz
from tidemark.state import child_names, exists, remove
from tidemark.streaming.ingest import batch_key, check_ownership, claim, run_stream

FAN = 4  # segments of one size that are merged into one
TIER_BASE = 1000
FEW_TERMS = 400
BITMAP_ROWS = 8_000  # of four kilobytes each, as a broadcast
SEED_TERMS, SEED_CELLS = 8, 16
SLACK = 1e-5  # scores are compared at six decimals


class TextIndex:
    """Segments of postings, and a log whose newest commit names the segments that count.

    A refresh writes one segment with the documents that changed, and bitmaps of those that are dead in older
    ones; segments of a like size are merged, so their number grows with the logarithm of the documents.
    Readers take segments by folder. A segment has its documents (with number, length, hash and
    attributes), blocks of postings by hash of the word, and a bitmap per attribute value.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint"):
        self.spark, self.path, self.id_type = spark, path, id_type
        self.log = CommitLog(spark, f"{path}/commits")
        self.doc_schema = (
            f"segment string, ord bigint, doc_id {id_type}, doc_len int, content_hash string, refresh string, "
            "indexed_at timestamp_ntz, attributes map<string, string>"
        )

    # ------------------------------------------------------------------ tables

    def _state(self) -> dict[str, Any]:
        return self.log.newest()[1] or {"segments": {}, "dead": None, "refreshes": [], "n": 0, "words": 0}

    def _table(self, kind: str, segments: Sequence[str], schema: str) -> DataFrame:
        """Rows of these segments; no other folder is listed."""
        if not segments:
            return self.spark.createDataFrame([], schema)
        base = f"{self.path}/{kind}"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*[f"{base}/segment={s}" for s in segments])

    def _dead(self, state: dict[str, Any]) -> DataFrame | None:
        """Bitmaps of the documents that were replaced or dropped."""
        if state["dead"] is None:
            return None
        bitmaps = self.spark.read.schema(X.BITMAP_SCHEMA).parquet(f"{self.path}/dead/{state['dead']}")
        return bitmaps.where(F.col("segment").isin(list(state["segments"])))

    @staticmethod
    def _with_bitmaps(rows: DataFrame, bitmaps: DataFrame, how: str) -> DataFrame:
        small = F.broadcast(bitmaps) if fits_broadcast(bitmaps, max_rows=BITMAP_ROWS) else bitmaps
        return rows.withColumn("bucket", X.bucket_of(F.col("ord"))).join(small, ["segment", "bucket"], how)

    def _only_live(self, rows: DataFrame, state: dict[str, Any]) -> DataFrame:
        dead = self._dead(state)
        if dead is None:
            return rows
        return self._with_bitmaps(rows, dead, "left").where(~X.has_bit(F.col("bitmap"), F.col("ord"))).drop("bucket", "bitmap")

    def _live(self, state: dict[str, Any]) -> DataFrame:
        return self._only_live(self._table("docs", list(state["segments"]), self.doc_schema), state)

    def current(self) -> DataFrame:
        return self._live(self._state())

    def postings(self) -> DataFrame:
        """Words of the current documents: (doc_id, doc_len, term, tf)."""
        state = self._state()
        blocks = self._table("blocks", list(state["segments"]), X.BLOCK_SCHEMA)
        rows = blocks.select("segment", "term", F.inline("postings"))
        live = self._live(state).select("segment", "ord", "doc_id")
        return rows.join(live, ["segment", "ord"]).select("doc_id", "doc_len", "term", "tf")

    def stats(self) -> DataFrame:
        state = self._state()
        return self.spark.range(1).select(F.lit(state["n"]).alias("n"), F.lit(state["words"]).alias("total_len"))

    def lag(self, run_ts: dt.datetime, target: dt.timedelta) -> DataFrame:
        """Age of the newest refresh against the promised lag; twice the lag is an error."""
        at = self._state().get("at")
        newest = self.spark.range(1 if at else 0).select(F.lit(at).cast("timestamp_ntz").alias("indexed_at"))
        return freshness(newest, "indexed_at", run_ts, target, 2 * target)

    # ----------------------------------------------------------------- refresh

    def refresh(self, docs: DataFrame, refresh: str, at: dt.datetime, complete: bool = True) -> None:
        """Index the documents (doc_id, text, attributes as further columns) that are new or differ, and drop the absent ones.

        With ``complete=False`` the documents given are only the changed ones and nothing is dropped.
        Documents are compared by hash; only changed ones are read into words. A refresh that has already
        finished under this name is left as it is. A NULL text is indexed as an empty one.
        """
        attributes = [c for c in docs.columns if c not in ("doc_id", "text")]
        pairs = [x for c in attributes for x in (F.lit(c), F.col(f"`{c}`").cast("string"))]
        held = F.map_filter(F.create_map(*pairs), lambda _, v: v.isNotNull()) if pairs else F.lit(None)
        text = F.coalesce("text", F.lit(""))
        shown = F.to_json(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) for c in attributes])) if attributes else F.lit("")
        given = docs.select(
            "doc_id",
            text.alias("text"),
            held.cast("map<string,string>").alias("attributes"),
            F.sha2(F.concat(text, F.lit("\n") if attributes else F.lit(""), shown), 256).alias("content_hash"),
        )

        def build(number: int, before: dict[str, Any]) -> dict[str, Any] | None:
            before = before or self._state()
            if refresh in before["refreshes"] or exists(self.spark, f"{self.path}/done/{refresh}"):
                return None
            return self._next(given, f"{number:09d}-{uuid.uuid4().hex[:8]}", refresh, at, complete, before)

        self.log.change(build)
        self._fs_mark(refresh)
        self.merge()

    def _fs_mark(self, refresh: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/done/{refresh}")
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).create(path, True).close()

    def _next(
        self, given: DataFrame, name: str, refresh: str, at: dt.datetime, complete: bool, before: dict[str, Any]
    ) -> dict[str, Any]:
        """The commit after this refresh, with its files written."""
        after = {
            "segments": dict(before["segments"]), "dead": before["dead"], "refreshes": [*before["refreshes"], refresh][-20:],
            "n": before["n"], "words": before["words"], "at": at.isoformat(sep=" "),
        }
        dead, changed = None, given
        if before["n"]:
            known = self._live(before).select("doc_id", "segment", "ord", "doc_len", F.col("content_hash").alias("known_hash"))
            asked = given.select("doc_id", "content_hash")
            compared = asked.join(known, "doc_id", "full" if complete else "left").where(
                ~F.col("content_hash").eqNullSafe(F.col("known_hash"))
            )
            compared = settle(compared, "compared")  # narrow: ids, hashes and places
            dead = compared.where("segment IS NOT NULL").select("segment", "ord", "doc_len")
            ids = compared.where("content_hash IS NOT NULL").select("doc_id")
            changed = given.join(F.broadcast(ids) if fits_broadcast(ids) else ids, "doc_id", "left_semi")
        # Neighbours of like length have like scores, so the bounds of a cell are tight.
        bags = changed.select("doc_id", words(F.col("text")).alias("words"), "attributes", "content_hash")
        bags = bags.withColumn("doc_len", F.size("words"))
        bags = bags.sortWithinPartitions("doc_len").withColumn("ord", F.monotonically_increasing_id())
        staged = f"{self.path}/staged/{name}"
        bags.write.parquet(staged)  # numbers are given once; taken away again below
        bags = self.spark.read.schema(bags.schema).parquet(staged)
        counted = bags.agg(F.count("*").alias("n"), F.coalesce(F.sum("doc_len"), F.lit(0)).alias("words")).first()
        if counted.n:
            docs = bags.select(
                "ord", "doc_id", "doc_len", "content_hash", F.lit(refresh).alias("refresh"),
                ntz(at).alias("indexed_at"), "attributes",
            )
            self._write_segment(name, docs, X.word_blocks(bags))
            after["segments"][name] = {"docs": counted.n, "dead": 0}
            after["n"] += counted.n
            after["words"] += counted.words
        remove(self.spark, staged)
        if dead is not None:
            lost = dead.groupBy("segment").agg(F.count("*").alias("n"), F.sum("doc_len").alias("words")).collect()  # a row per segment
            for row in lost:
                own = after["segments"][row.segment]
                after["segments"][row.segment] = own | {"dead": own["dead"] + row.n}
                after["n"] -= row.n
                after["words"] -= row.words
            if lost:
                after["dead"] = self._write_dead(name, dead, before)
        return after

    def _write_segment(self, name: str, docs: DataFrame, blocks: DataFrame) -> None:
        docs.write.mode("overwrite").parquet(f"{self.path}/docs/segment={name}")
        X.write_blocks(blocks, f"{self.path}/blocks/segment={name}")
        stored = self._table("docs", [name], self.doc_schema)
        values = stored.select("ord", F.explode("attributes").alias("attribute", "value"))
        bits = values.groupBy("attribute", "value", X.bucket_of(F.col("ord")).alias("bucket")).agg(X.bitmap_of(F.col("ord")).alias("bitmap"))
        bits.sortWithinPartitions("attribute", "value").write.mode("overwrite").parquet(f"{self.path}/bits/segment={name}")

    def _write_dead(self, name: str, dead: DataFrame, before: dict[str, Any]) -> str:
        new = dead.groupBy("segment", X.bucket_of(F.col("ord")).alias("bucket")).agg(X.bitmap_of(F.col("ord")).alias("bitmap"))
        old = self._dead(before)
        if old is not None:
            new = new.unionByName(old).groupBy("segment", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        new.write.mode("overwrite").parquet(f"{self.path}/dead/{name}")
        return name

    # ------------------------------------------------------------------- merge

    @staticmethod
    def _due(segments: Mapping[str, Mapping[str, int]]) -> list[str]:
        """Segments to merge next: several of one size, or one that is mostly dead."""
        tiers: dict[int, list[str]] = {}
        for name, own in sorted(segments.items()):
            if own["dead"] * 2 > own["docs"]:
                return [name]
            size, tier = own["docs"] - own["dead"], 0
            while size > TIER_BASE * FAN**tier:
                tier += 1
            tiers.setdefault(tier, []).append(name)
        return next((names for _, names in sorted(tiers.items()) if len(names) >= FAN), [])

    def merge(self) -> None:
        """Merge segments until no tier is full. Their live documents get new numbers in a new segment."""

        def build(number: int, before: dict[str, Any]) -> dict[str, Any] | None:
            names = self._due(before["segments"]) if before else []
            if not names:
                return None
            kept = {n: s for n, s in before["segments"].items() if n not in names}
            name = f"{number:09d}-{uuid.uuid4().hex[:8]}"
            live = self._live(before).where(F.col("segment").isin(names))
            staged = f"{self.path}/staged/{name}"
            live.withColumn("new_ord", F.monotonically_increasing_id()).write.parquet(staged)
            schema = T.StructType([*live.schema.fields, T.StructField("new_ord", T.LongType())])
            numbered = self.spark.read.schema(schema).parquet(staged)
            count = numbered.count()
            if count:
                places = numbered.select("segment", "ord", "new_ord")
                old = self._table("blocks", names, X.BLOCK_SCHEMA).select("segment", "term", F.inline("postings"))
                moved = old.join(F.broadcast(places) if fits_broadcast(places) else places, ["segment", "ord"])
                postings = moved.select(F.col("new_ord").alias("ord"), "doc_len", "term", "tf")
                docs = numbered.drop("segment", "ord").withColumnRenamed("new_ord", "ord")
                self._write_segment(name, docs.select(*[c for c in T._parse_datatype_string(self.doc_schema).names if c != "segment"]), X.blocks_of(postings))
                kept[name] = {"docs": count, "dead": 0}
            remove(self.spark, staged)
            return before | {"segments": kept, "dead": before["dead"] if any(s["dead"] for s in kept.values()) else None}

        while self._due(self._state()["segments"]):
            self.log.change(build)

    def vacuum(self) -> None:
        """Remove files that the newest commit does not name. Not while older commits are being read."""
        state = self._state()
        for kind in ("docs", "blocks", "bits"):
            for folder in child_names(self.spark, f"{self.path}/{kind}"):
                if folder.removeprefix("segment=") not in state["segments"]:
                    remove(self.spark, f"{self.path}/{kind}/{folder}")
        for folder in child_names(self.spark, f"{self.path}/dead"):
            if folder != state["dead"]:
                remove(self.spark, f"{self.path}/dead/{folder}")

    # ------------------------------------------------------------------ search

    def _allowed(self, state: dict[str, Any], where: Mapping[str, Sequence[str]]) -> DataFrame:
        """Bitmaps of the documents with one of the given values of each attribute."""
        bits = self._table("bits", list(state["segments"]), "segment string, attribute string, value string, bucket bigint, bitmap binary")
        one_of = [(F.col("attribute") == a) & F.col("value").isin(list(v)) for a, v in where.items()]
        picked = one_of[0]
        for other in one_of[1:]:
            picked = picked | other
        each = bits.where(picked).groupBy("segment", "bucket", "attribute").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
        both = each.groupBy("segment", "bucket").agg(F.bitmap_and_agg("bitmap").alias("bitmap"), F.count("*").alias("found"))
        return both.where(F.col("found") == len(where)).drop("found")

    def _asked(self, state: dict[str, Any], terms: DataFrame) -> DataFrame:
        """Blocks of the asked words: shards by folder, words by filter or, if they are many, by join."""
        vocabulary = terms.select("term").distinct()
        blocks = self._table("blocks", list(state["segments"]), X.BLOCK_SCHEMA)
        few = vocabulary.withColumn("shard", X.shard_of(F.col("term"))).limit(FEW_TERMS + 1).collect()
        if len(few) <= FEW_TERMS:
            return blocks.where(F.col("shard").isin(sorted({r.shard for r in few})) & F.col("term").isin([r.term for r in few]))
        return blocks.join(F.broadcast(vocabulary) if fits_broadcast(terms) else vocabulary, "term", "left_semi")

    def search(
        self,
        queries: DataFrame,
        k: int,
        where: Mapping[str, Sequence[str]] | None = None,
        shown: Sequence[str] = (),
    ) -> DataFrame:
        """(query_id, rank, doc_id, score, shown attributes): the k best documents of each query by BM25.

        ``where`` names allowed values of attributes; word statistics still cover all documents. The best
        cells of a query are scored first; their k-th score is a bound that others must reach: only cells with
        a word that can matter, and whose blocks together reach the bound, are opened.
        """
        state = self._state()
        terms = settle(query_terms(queries), "terms")
        blocks = self._asked(state, terms)
        opened = self._cells(state, terms, blocks, k, where)
        scored = self._scored(state, blocks, opened, where)
        order = Window.partitionBy("query_id").orderBy(F.desc("score"))
        near = scored.withColumn("_r", F.rank().over(order)).where(F.col("_r") <= k)  # ties are settled by id below
        docs = self._table("docs", list(state["segments"]), self.doc_schema)
        if fits_broadcast(queries, rows_each=4 * k):
            near = F.broadcast(near)
        named = docs.select("segment", "ord", "doc_id", *[F.col("attributes")[a].alias(a) for a in shown]).join(near, ["segment", "ord"])
        return rank_top(named.drop("segment", "ord", "_r"), k)

    @staticmethod
    def _some_dead(state: dict[str, Any]) -> bool:
        return any(s["dead"] for s in state["segments"].values())

    def _wanted(self, state: dict[str, Any], terms: DataFrame, blocks: DataFrame) -> DataFrame:
        """(query_id, term, idf, most): most is the highest score the word can add anywhere."""
        if self._some_dead(state):
            live = self._only_live(blocks.select("segment", "term", F.inline("postings")), state)
            df = live.groupBy("term").agg(F.count("*").alias("df"))
        else:
            df = blocks.groupBy("term").agg(F.sum("n").alias("df"))
        best = blocks.groupBy("term").agg(F.max(self._impact(state)).alias("best"))
        weighed = terms.join(df, "term").join(best, "term").withColumn("idf", X.idf(F.col("df"), F.lit(state["n"])))
        return weighed.select("query_id", "term", "idf", (F.col("idf") * F.col("best")).alias("most"))

    @staticmethod
    def _impact(state: dict[str, Any], tf: str = "max_tf", doc_len: str = "min_len") -> Column:
        average = F.lit(state["words"]) / F.lit(max(1, state["n"]))
        return X.impact(F.col(tf), F.col(doc_len), average)

    def _cells(
        self, state: dict[str, Any], terms: DataFrame, blocks: DataFrame, k: int, where: Mapping[str, Sequence[str]] | None
    ) -> DataFrame:
        """(query_id, segment, cell, term, idf): the blocks to open."""
        meta = settle(blocks.select("segment", "term", "cell", "n", "max_tf", "min_len"), "block-bounds")
        salted = 0 if not fits_broadcast(terms) else None  # counted once for all the joins by word

        def by_word(lookup: DataFrame) -> DataFrame:
            if salted is None:
                return meta.join(F.broadcast(lookup), "term")
            return lookup_join(meta, lookup, ["term"], F.col("cell"), max_rows=salted)

        wanted = settle(self._wanted(state, terms, blocks if self._some_dead(state) else meta), "wanted")
        most_first = Window.partitionBy("query_id").orderBy(F.desc("most"), "term")
        first_terms = wanted.withColumn("_t", F.row_number().over(most_first)).where(F.col("_t") <= SEED_TERMS)
        likely = by_word(first_terms)
        likely = likely.groupBy("query_id", "segment", "cell").agg(F.sum(F.col("idf") * self._impact(state)).alias("bound"))
        best_cells = Window.partitionBy("query_id").orderBy(F.desc("bound"), "segment", "cell")
        seeds = settle(likely.withColumn("_c", F.row_number().over(best_cells)).where(F.col("_c") <= SEED_CELLS), "seeds")
        seed_blocks = seeds.select("query_id", "segment", "cell").join(wanted, "query_id")
        seeded = self._scored(state, blocks, seed_blocks.select("query_id", "segment", "cell", "term", "idf"), where)
        kth = Window.partitionBy("query_id").orderBy(F.desc("score"))
        least = seeded.withColumn("_r", F.row_number().over(kth)).where(F.col("_r") == k).select("query_id", F.col("score").alias("least"))
        least = settle(least, "thresholds")

        # a document with none but words that cannot reach the bound together is out
        rising = Window.partitionBy("query_id").orderBy("most", "term").rowsBetween(Window.unboundedPreceding, 0)
        together = wanted.join(least, "query_id", "left").withColumn("_sum", F.sum("most").over(rising))
        needed = F.coalesce(F.col("least"), F.lit(0.0)) - SLACK
        essential = together.where(F.col("_sum") >= needed).select("query_id", "term")
        cells = by_word(essential).select("query_id", "segment", "cell").distinct()
        in_cells = cells.join(wanted, "query_id").join(meta, ["segment", "cell", "term"])
        bounds = in_cells.groupBy("query_id", "segment", "cell").agg(F.sum(F.col("idf") * self._impact(state)).alias("bound"))
        kept = bounds.join(least, "query_id", "left").where(F.col("bound") >= needed).select("query_id", "segment", "cell")
        return settle(kept.join(wanted.select("query_id", "term", "idf"), "query_id"), "opened")

    def _scored(
        self, state: dict[str, Any], blocks: DataFrame, opened: DataFrame, where: Mapping[str, Sequence[str]] | None
    ) -> DataFrame:
        """(query_id, segment, ord, score) of the allowed documents in these blocks."""
        small = F.broadcast(opened) if fits_broadcast(opened) else opened
        hits = blocks.select("segment", "cell", "term", "postings").join(small, ["segment", "cell", "term"]).select("query_id", "segment", "idf", F.inline("postings"))
        hits = self._only_live(hits, state)
        if where:
            allowed = self._with_bitmaps(hits, self._allowed(state, where), "inner")
            hits = allowed.where(X.has_bit(F.col("bitmap"), F.col("ord")))
        gain = F.col("idf") * self._impact(state, "tf", "doc_len")
        return hits.groupBy("query_id", "segment", "ord").agg(F.round(F.sum(gain), 6).alias("score"))

    def opened_share(self, queries: DataFrame, k: int, where: Mapping[str, Sequence[str]] | None = None) -> float:
        """Blocks opened per block that holds an asked word, over all queries."""
        state = self._state()
        terms = settle(query_terms(queries), "terms")
        blocks = self._asked(state, terms)
        keys = ["segment", "cell", "term"]
        opened = self._cells(state, terms, blocks, k, where).join(blocks.select(*keys), keys)
        every = lookup_join(blocks.select(*keys), terms, ["term"], F.col("cell"))
        return opened.count() / max(1, every.count())


def newest_versions(docs: DataFrame, version: str | None) -> DataFrame:
    """One (doc_id, text) per document: that of the highest version. Without a version column all copies
    of a document must hold the same text, as nothing says which is newer."""
    if version is not None:
        return latest_per_key(docs, "doc_id", [version], ["text"]).select("doc_id", "text")
    texts = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    found = texts.groupBy("doc_id").agg(F.max("text").alias("text"), F.min("text").alias("other"))
    same = F.when(F.col("text") == F.col("other"), F.col("text"))
    unclear = F.raise_error(F.concat(F.lit("several texts without a version of document "), F.col("doc_id").cast("string")))
    return found.select("doc_id", F.coalesce(same, unclear.cast("string")).alias("text"))


def index_stream(
    docs: DataFrame, path: str, checkpoint: str, at: dt.datetime, every: str | None = None, version: str | None = None
) -> StreamingQuery:
    """Refresh the index with documents (doc_id, text) as they arrive; ``version`` orders texts of one document."""
    check_ownership(docs.sparkSession, f"{path}/done", checkpoint, child_names(docs.sparkSession, f"{path}/done"))

    def write(batch: DataFrame, batch_id: int) -> None:
        claim(batch.sparkSession, f"{path}/done", checkpoint)
        newest = newest_versions(batch, version)
        TextIndex(batch.sparkSession, path).refresh(newest, batch_key(batch_id), at, complete=False)

    writer = docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return run_stream(writer, every)
