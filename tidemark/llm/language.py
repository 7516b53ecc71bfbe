"""Language identification in two steps: first the family, then the language within it.

A text becomes a vector of hashed byte n-grams (1 to 3 bytes, letters only, square-root counts, unit
length), read in full. One linear support vector machine per family, against the rest, chooses the
family; inside it one machine per pair of languages votes (one versus one). Each machine is trained in a
task of its own by dual coordinate descent.

Training may use a bounded sample: at most ``PER_LANGUAGE`` rows per language, those with the smallest
hash of their id, whole texts; it bounds what one machine's task holds. The weights (a row of ``WIDTH``
numbers per machine) are all that reaches the driver and the scoring tasks.

``FAMILIES`` groups languages that are easily confused; a language not named there is a family of its
own. The score is the chance the family's margin gives, times the mean over the votes for the winner.

Defined cases: a null text, or one without a letter, is ``und`` with score 0; a language with no
training row is never predicted; without any training row all is ``und``; ties go to the smaller name;
repeated rows get equal predictions; extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, slices
from tidemark.session import settle

WIDTH = 1 << 13
PER_LANGUAGE = 600
EPOCHS = 12
COST = 1.0
BATCH_BYTES = 8 << 20
CHUNK = 1 << 20
UNKNOWN = "und"
# Language codes by family.
FAMILIES = {
    "germanic": ["af", "da", "de", "en", "nl", "no", "sv"],
    "romance": ["ca", "es", "fr", "gl", "it", "pt", "ro"],
    "slavic": ["bg", "cs", "hr", "pl", "ru", "sk", "sl", "sr", "uk"],
}
_FAMILY_OF = {language: family for family, members in FAMILIES.items() for language in members}
_LETTER = regex.compile(r"\p{L}")  # numerals such as Roman ones or fractions are not letters
_FOLD = np.full(256, 32, np.uint32)
_FOLD[128:] = np.arange(128, 256)
for _b in range(26):
    _FOLD[65 + _b] = _FOLD[97 + _b] = 97 + _b


def family_of(language: str) -> str:
    return _FAMILY_OF.get(language, language)


def features(text: str) -> np.ndarray:
    """Hashed n-gram vector of a whole text, of unit length."""
    data = text.encode()
    counts = np.zeros(WIDTH, np.int64)
    for at in range(0, len(data), CHUNK):
        # The two bytes before the chunk belong to the n-grams that end in it.
        b = _FOLD[np.frombuffer(data[max(0, at - 2) : at + CHUNK], np.uint8)]
        two = b[1:] + b[:-1] * np.uint32(257)
        three = two[1:] + b[:-2] * np.uint32(66049)
        skip = min(at, 2)
        for grams, size in ((b, 1), (two, 2), (three, 3)):
            mixed = (grams + np.uint32(size)) * np.uint32(2654435761)
            counts += np.bincount((mixed[max(0, skip - size + 1) :] >> np.uint32(19)), minlength=WIDTH)
    vector = np.sqrt(counts).astype(np.float32)
    length = np.linalg.norm(vector)
    return vector / length if length else vector


def train_machine(x: np.ndarray, y: np.ndarray, epochs: int = EPOCHS, cost: float = COST) -> np.ndarray:
    """Weights, the last one a bias, of a linear support vector machine (squared hinge, dual descent)."""
    x = np.concatenate([x, np.ones((len(x), 1), np.float32)], axis=1)
    # Classes weigh alike, however many rows each has.
    share = {s: len(y) / (2 * max(1, int((y == s).sum()))) for s in (-1, 1)}
    damp = np.array([1 / (2 * cost * share[s]) for s in y])
    square = (x * x).sum(axis=1) + damp
    alpha, weights = np.zeros(len(y)), np.zeros(x.shape[1])
    rng = np.random.default_rng(42)
    for _ in range(epochs):
        for i in rng.permutation(len(y)):
            gradient = y[i] * (x[i] @ weights) - 1 + damp[i] * alpha[i]
            new = max(0.0, alpha[i] - gradient / square[i])
            if new != alpha[i]:
                weights += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return weights


def _fit(group: pa.Table) -> pa.Table:
    machine = group.column("machine")[0].as_py()
    order = np.argsort(group.column("doc_id").to_numpy(), kind="stable")
    x = np.stack([np.frombuffer(v, np.float32) for v in group.column("vector").to_pylist()])[order]
    y = group.column("side").to_numpy()[order]
    weights = train_machine(x, y).astype("<f4")
    return pa.table({"machine": [machine], "weights": pa.array([weights.tobytes()], pa.binary())})


class Model:
    """Machines by name: ``family:f`` and ``pair:a:b``."""

    def __init__(self, languages: list[str], machines: dict[str, np.ndarray]):
        self.languages = sorted(languages)
        self.families: dict[str, list[str]] = {}
        for language in self.languages:
            self.families.setdefault(family_of(language), []).append(language)
        self.names = sorted(machines)
        self.weights = np.stack([machines[n] for n in self.names]) if machines else np.zeros((0, WIDTH + 1))

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        out, scores = [UNKNOWN] * len(texts), [0.0] * len(texts)
        rows = [i for i, t in enumerate(texts) if t and self.languages and _LETTER.search(t)]
        for at in range(0, len(rows), 256):
            some = rows[at : at + 256]
            x = np.stack([features(texts[i]) for i in some])
            margins = x @ self.weights[:, :-1].T + self.weights[:, -1]
            chance = 1 / (1 + np.exp(-np.clip(4 * margins.astype(float), -50, 50)))
            for i, row in zip(some, chance):
                out[i], scores[i] = self._decide(dict(zip(self.names, row.tolist())))
        return out, scores

    def _decide(self, chance: dict[str, float]) -> tuple[str, float]:
        family = max(sorted(self.families), key=lambda f: chance.get(f"family:{f}", 1.0))
        members = self.families[family]
        sure = chance.get(f"family:{family}", 1.0)
        votes: dict[str, list[float]] = {m: [] for m in members}
        for a, b in combinations(members, 2):
            votes[a].append(chance[f"pair:{a}:{b}"])
            votes[b].append(1 - chance[f"pair:{a}:{b}"])
        best = max(members, key=lambda m: (sum(v >= 0.5 for v in votes[m]), sum(votes[m])))
        return best, sure * (sum(votes[best]) / len(votes[best]) if votes[best] else 1.0)


def train(docs: DataFrame, per_language: int = PER_LANGUAGE) -> Model:
    """Fit on rows with ``doc_id, text, lang``; the caller leaves out what is held out."""
    known = docs.where("lang is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text", "lang")
    order = Window.partitionBy("lang").orderBy(F.xxhash64("doc_id"), "doc_id")
    chosen = known.select("doc_id", "lang").withColumn("n", F.row_number().over(order)).where(F.col("n") <= per_language)
    chosen = settle(chosen.select("doc_id", "lang").distinct(), "language-sample")
    few = chosen.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS  # per_language rows for each language
    sample = known.join(F.broadcast(chosen) if few else chosen, ["doc_id", "lang"], "left_semi")

    def vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text", BATCH_BYTES):
            found = [features(t).tobytes() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("lang"), pa.array(found, pa.binary())], ["doc_id", "lang", "vector"]
            )

    rows = sample.where(F.col("text").rlike(r"\p{L}")).select("doc_id", "text", "lang")
    rows = settle(rows.mapInArrow(vectors, "doc_id long, lang string, vector binary"), "language-vectors")
    languages = sorted(r[0] for r in rows.select("lang").distinct().collect())
    sides: list[tuple[str, str, int]] = []
    families = sorted({family_of(x) for x in languages})
    if len(families) > 1:
        sides += [(f"family:{f}", x, 1 if family_of(x) == f else -1) for f in families for x in languages]
    for a, b in combinations(languages, 2):
        if family_of(a) == family_of(b):
            sides += [(f"pair:{a}:{b}", a, 1), (f"pair:{a}:{b}", b, -1)]
    if not sides:
        return Model(languages, {})
    roles = docs.sparkSession.createDataFrame(sides, "machine string, lang string, side long")
    fitted = rows.join(F.broadcast(roles), "lang").groupBy("machine").applyInArrow(_fit, "machine string, weights binary")
    return Model(languages, {r["machine"]: np.frombuffer(r["weights"], "<f4") for r in fitted.collect()})


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, lang_pred, score`` of every row, from its text alone."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 2000):
                part = batch.slice(start, 2000)
                found, scores = model.predict(part.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(found), pa.array(scores)], ["doc_id", "lang_pred", "score"]
                )

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return texts.mapInArrow(run, "doc_id long, lang_pred string, score double")


def held_out(doc_id="doc_id"):
    """Whether a row is kept from training: the checksum of its id, as text, is divisible by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 5 == 0, F.lit(False))
