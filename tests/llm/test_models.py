import math
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tidemark.llm import language, quality_ngram, topk_lists, warc


def plain_model(texts, order):
    """Interpolated modified Kneser-Ney over bytes, written from its definition."""
    padded = [b"\0" * (order - 1) + t for t in texts]
    counts = {order: Counter(p[i : i + order] for p in padded for i in range(len(p) - order + 1))}
    for n in range(order - 1, 0, -1):
        counts[n] = Counter(g[1:] for g in counts[n + 1])
    discounts = {}
    for n, table in counts.items():
        n1, n2, n3, n4 = (max(1, sum(c == k for c in table.values())) for k in (1, 2, 3, 4))
        y = n1 / (n1 + 2 * n2)
        wanted = [1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3]
        discounts[n] = [min(max(x, 0.1), k - 0.05) for k, x in enumerate(wanted, 1)]
    after = defaultdict(dict)
    for n, table in counts.items():
        for gram, c in table.items():
            after[n, gram[:-1]][gram[-1]] = c

    def p(gram):
        if not gram:
            return 1 / 256
        found = after.get((len(gram), gram[:-1]))
        lower = p(gram[1:])
        if found is None:
            return lower
        taken = {b: discounts[len(gram)][min(c, 3) - 1] for b, c in found.items()}
        total = sum(found.values())
        own = found.get(gram[-1], 0) - taken.get(gram[-1], 0)
        return own / total + sum(taken.values()) / total * lower

    def loss(text):
        data = b"\0" * (order - 1) + text
        return -sum(math.log2(p(data[i : i + order])) for i in range(len(text))) / len(text)

    return loss


def test_losses_equal_the_definition(spark):
    trusted = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "éé the"]
    others = ["the cat", "zzz ###", "dog dog dog", "", None, "é"]
    rows = [(i, t, "en") for i, t in enumerate([*trusted, *others])]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = quality_ngram.Model(quality_ngram.count_grams(docs.where("doc_id < 4"), 3), 3)
    plain = plain_model([t.encode() for t in trusted], 3)
    for block in (1 << 20, 7):
        got = {r.doc_id: r for r in quality_ngram.score(docs, model, block).collect()}
        assert len(got) == len(rows)
        for i, text, _ in rows:
            if text:
                assert got[i].loss == pytest.approx(plain(text.encode()))
            else:
                assert got[i].loss is None and got[i].n_bytes == 0


def test_quality_rejects_noise_and_keeps_the_rest(spark, odd_docs, no_docs):
    good = [(i, f"a plain sentence about {w} and the weather", "en") for i, w in enumerate("rain sun wind snow fog".split() * 8)]
    bad = [(100 + i, "#$%&" * 30 + str(i), "en") for i in range(3)]
    docs = spark.createDataFrame([*good, *bad, (200, None, None), (201, "", "en")], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i in range(0, 40, 2)], "doc_id long")
    kept = {r.doc_id: r.keep for r in quality_ngram.judge(docs, trusted).collect()}
    assert not any(kept[100 + i] for i in range(3)) and kept[200] and kept[201]
    assert sum(kept[i] for i in range(40)) >= 38
    nobody = trusted.where("false")
    assert all(r.keep for r in quality_ngram.judge(odd_docs, nobody).collect())
    assert quality_ngram.judge(no_docs, trusted).count() == 0


def test_models_without_a_fold_equal_the_definition(spark):
    texts = ["the cat sat on the mat", "the dog sat", "a cat and a dog", "éé the", "the cat sat on the mat"]
    df = spark.createDataFrame([(i, t, "en") for i, t in enumerate(texts)], "doc_id long, text string, lang string")
    folds = {r.doc_id: r.fold for r in df.withColumn("fold", quality_ngram.fold_of(3)).collect()}
    assert folds[0] == folds[4] and set(folds.values()) <= {1, 2, 3} and len(set(folds.values())) > 1
    model = quality_ngram.Model(quality_ngram.count_grams(df, 3, 3), 3)
    got = quality_ngram.score(df.withColumn("fold", quality_ngram.fold_of(3)), model, 30).collect()
    assert len(got) == 2 * len(texts)
    for r in got:
        seen = [t.encode() for i, t in enumerate(texts) if not r.fold or folds[i] != r.fold]
        assert r.loss == pytest.approx(plain_model(seen, 3)(texts[r.doc_id].encode())), (r.doc_id, r.fold)


def test_quality_keeps_clean_rows_it_was_not_trained_on(spark):
    rng = np.random.default_rng(11)
    rows = []
    for lang, letters, n in (("en", "etaoinshrdlu", 300), ("es", "aeosrnidlctu", 60)):
        words = ["".join(rng.choice(list(letters), rng.integers(2, 9))) for _ in range(1500)]
        rows += [(len(rows) + i, " ".join(rng.choice(words, rng.integers(20, 60))), lang) for i in range(n)]
    noise = [(1000 + i, "".join(rng.choice(list("#$%&0123456789"), 200)), ("en", "es")[i % 2]) for i in range(6)]
    docs = spark.createDataFrame([*rows, *noise], "doc_id long, text string, lang string")
    trusted = spark.createDataFrame([(i,) for i, _, _ in rows[::2]], "doc_id long")
    kept = {r.doc_id: r.keep for r in quality_ngram.judge(docs, trusted).collect()}
    for lang in ("en", "es"):
        fresh = [kept[i] for i, _, own in rows[1::2] if own == lang]
        assert sum(fresh) >= 0.95 * len(fresh), (lang, sum(fresh), len(fresh))
    assert not any(kept[i] for i, _, _ in noise)


def test_languages(spark, odd_docs, no_docs):
    words = {"en": "the and of to with that", "de": "der und das mit nicht ein", "fr": "le et une dans que pour", "xx": "zzq qzz zqz"}
    rows = [(i * 10 + k, " ".join(np.random.default_rng(i * 7 + k).choice(w.split(), 30)), lang) for k, (lang, w) in enumerate(words.items()) for i in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(docs)
    found = language.identify(docs.drop("lang"), model).collect()
    want = {r[0]: r[2] for r in rows}
    assert all(r.lang_pred == want[r.doc_id] and 0 <= r.score <= 1 for r in found)
    odd = {r.doc_id: r for r in language.identify(odd_docs, model).collect()}
    assert odd[0].lang_pred == odd[1].lang_pred == odd[2].lang_pred == "und" and odd[0].score == 0
    numerals = ["½ ² ①", "Ⅷ", "12 – 3", "_", "٣"]
    assert model.predict(numerals) == (["und"] * 5, [0.0] * 5)
    assert model.predict(["ª", "Ⅷ a", "漢"])[0].count("und") == 0
    assert language.identify(no_docs, model).count() == 0
    empty = language.train(no_docs.select("doc_id", "text", "lang"))
    assert {r.lang_pred for r in language.identify(docs, empty).collect()} == {"und"}


def test_top_k_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(topk_lists, "BLOCK", 40)
    monkeypatch.setattr(topk_lists, "SLICE_ROWS", 150)
    rng = np.random.default_rng(5)
    v = rng.normal(0, 0.2, (400, 6)).astype(np.float32)
    v[100:220] = v[7]
    rows = [(i, [float(x) for x in r]) for i, r in enumerate(v)]
    rows += [(900, None), (901, [1.0, None]), (902, [float("nan")] * 6), (920, [float("inf")] * 6), (904, [0.5])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").withColumn("score", F.lit("x"))
    got = defaultdict(list)
    for r in sorted(topk_lists.top_k(df, F.col("vec_id") % 20 == 0).collect(), key=lambda r: (r.query_id, r["rank"])):
        got[r.query_id].append((r.vec_id, r.score))
    whole = np.floor(64 * v.astype(float)).astype(int)
    for q in range(0, 400, 20):
        scores = whole @ whole[q]
        order = sorted((i for i in range(400) if i != q), key=lambda i: (-scores[i], i))[:20]
        assert got[q] == [(i, scores[i]) for i in order]
    assert set(got) == set(range(0, 400, 20))
    assert topk_lists.top_k(df.where("false"), F.col("vec_id") % 20 == 0).count() == 0


def _serve_rows(q_ids, q, ids, v):
    tables = [pa.table({"vec_id": np.array(i, np.int64), "v": pa.array(m.tolist(), pa.list_(pa.int64()))}) for i, m in ((q_ids, q), (ids, v))]
    got = defaultdict(list)
    for r in topk_lists._serve(*tables, 20).to_pylist():
        got[r["query_id"]].append((r["vec_id"], r["score"]))
    return got


@pytest.mark.parametrize("scale", [1, 10**5, 10**6])
def test_queries_of_a_group_read_the_lists_together(monkeypatch, scale):
    monkeypatch.setattr(topk_lists, "BLOCK", 300)
    calls = []
    read = topk_lists.Lists.candidates
    monkeypatch.setattr(topk_lists.Lists, "candidates", lambda self, *a: calls.append(1) or read(self, *a))
    rng = np.random.default_rng(3)
    v = (rng.normal(0, 30, (900, 5)) * np.array([9, 1, 1, 0.1, 0])).astype(np.int64) * scale
    ids = np.arange(900)
    got = _serve_rows(ids[::3], v[::3], ids, v)
    assert len(calls) == 3  # one reading of each block, not one a query
    for i in ids[::3]:
        scores = v @ v[i]
        order = sorted((j for j in ids if j != i), key=lambda j: (-scores[j], j))[:20]
        assert got[i] == [(j, scores[j]) for j in order]


def test_bounds_leave_out_vectors_that_cannot_reach_a_score():
    v = np.stack([np.arange(160.0), np.zeros(160)], axis=1)
    block = topk_lists.Lists(np.arange(160), v)
    wanted = block.candidates(np.array([[1.0, 0], [-1, 1], [1, 0]]), np.array([155.0, -3, 155]), np.array([True, True, False]), 0.0)
    assert np.flatnonzero(wanted[0]).tolist() == list(range(155, 160))
    assert np.flatnonzero(wanted[1]).tolist() == list(range(4)) and wanted[2].all()


def test_versions_of_one_id_take_one_place_in_a_slice():
    v = np.stack([np.arange(90, 0, -1), np.ones(90)], axis=1).astype(np.int64)
    ids = np.array([1] * 40 + list(range(100, 150)))
    got = _serve_rows([0], np.array([[1, 0]]), ids, v)
    assert got[0] == [(1, 90)] + [(100 + i, 50 - i) for i in range(19)]


def test_archive_round_trip(spark):
    long, odd = "<p>" + "x" * 300, "line\r\n\r\nWARC/1.1\r\n" * 20 + "é漢"
    pages = [(5, "http://a/", long), (2, None, long), (9, "http://b/ c\r\nX: y", odd), (7, "u", odd), (1, "u", "short"), (3, "u", "short"), (4, "u", None)]
    pages += [(2, None, long), (None, "u", "z" * 200), (8, "u", "y" * 70_000)]
    df = spark.createDataFrame([(*p, "extra") for p in pages], "page_id long, url string, html string, digest string")
    got = warc.archive_pages(df).collect()
    assert len(got) == len(pages)
    for r in got:
        html = next((h or "") for i, _, h in pages if i == r.page_id)
        first = {long: 2, odd: 7}.get(html)
        assert r.payload_bytes == len(html.encode())
        assert (r.record_type, r.refers_to) == (("revisit", first) if first not in (None, r.page_id) else ("response", None))
    assert warc.archive_pages(df.where("false")).count() == 0
