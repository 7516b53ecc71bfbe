import hashlib
import random
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import xxhash

from tidemark.llm import exact_dedup, simhash_bytes, suffix_dedup


def test_exact_groups(odd_docs, no_docs):
    groups = defaultdict(list)
    rows = odd_docs.collect()
    for r in rows:
        groups[r.text or ""].append(r.doc_id)
    want = []
    for r in rows:
        ids = groups[r.text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        want.append((r.doc_id, keep, len(ids), r.doc_id == keep, hashlib.sha256((r.text or "").encode()).hexdigest()))
    got = [tuple(r) for r in exact_dedup.exact_groups(odd_docs).collect()]
    assert Counter(got) == Counter(want)
    assert exact_dedup.exact_groups(no_docs).count() == 0


def test_keep_one_row_per_text(odd_docs, no_docs):
    kept = exact_dedup.keep_one(odd_docs)
    assert kept.columns == odd_docs.columns
    assert Counter(r.text or "" for r in kept.collect()) == Counter({r.text or "": 1 for r in odd_docs.collect()})
    assert exact_dedup.keep_one(no_docs).count() == 0


def test_four_positions_always_hold_a_triple():
    chosen = simhash_bytes.triples()
    assert len(chosen) == 20
    assert all(any(set(t) <= set(four) for t in chosen) for four in combinations(range(8), 4))


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_of(prints):
    parent = list(range(len(prints)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(prints)), 2):
        if (prints[i] ^ prints[j]).bit_count() <= 4:
            parent[top(i)] = top(j)
    return [top(i) for i in range(len(prints))]


def test_fingerprints_and_components(spark, odd_docs, no_docs):
    rng = random.Random(4)
    base = [[rng.choice("abcdefghij") * 3 for _ in range(60)] for _ in range(12)]
    texts = []
    for words in base:
        for _ in range(6):
            copy = list(words)
            copy[rng.randrange(60)] = "changed"
            texts.append(" ".join(copy))
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in simhash_bytes.near_duplicates(df).collect()}
    prints = [plain_fingerprint(t) for t in texts]
    tops = components_of(prints)
    least = {t: min(i for i, x in enumerate(tops) if x == t) for t in tops}
    assert len(set(tops)) < len(set(prints))
    for i, t in enumerate(tops):
        assert got[i].fingerprint == f"{prints[i]:016x}" and got[i].component_id == least[t]
    odd = simhash_bytes.near_duplicates(odd_docs).collect()
    assert len(odd) == 12 and all(int(r.fingerprint, 16) == 0 and r.component_id == 0 for r in odd if r.doc_id in (0, 1, 2, 9))
    assert simhash_bytes.near_duplicates(no_docs).count() == 0


def test_large_lists_are_split_without_loss(spark):
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 1 << 62, 3)
    prints = np.unique([c ^ (1 << a) ^ (1 << b) for c in centre.tolist() for a in range(0, 62, 3) for b in range(1, 62, 5)])
    entries = spark.createDataFrame([(int(p), i) for i, p in enumerate(prints)], "fp long, rep long")
    from tidemark.llm.components import components

    whole = {tuple(r) for r in components(simhash_bytes.links_of(entries)).collect()}
    split = {tuple(r) for r in components(simhash_bytes.links_of(entries, list_entries=10)).collect()}
    assert whole == split and len({c for _, c in whole}) == len(set(components_of([int(p) for p in prints])))


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = bytearray(len(t))
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        runs = sum(1 for i in range(len(gone)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((bytes(x for x, y in zip(t, gone) if not y), len(t), sum(gone), runs))
    return out


def test_repeated_strings_equal_brute_force(spark, monkeypatch):
    rng = random.Random(3)
    parts = ["".join(rng.choice("abcdé ") for _ in range(rng.randint(0, 300))) for _ in range(20)]
    texts = ["".join(rng.choice(parts)[rng.randint(0, 50) :][: rng.randint(0, 250)] for _ in range(rng.randint(0, 5))) for _ in range(50)]
    texts += ["a" * 500, "", "ab" * 300, "-" * 45, None, texts[3]]
    ids = [*range(len(texts) - 2), None, 3]
    df = spark.createDataFrame(list(zip(ids, texts)), "doc_id long, text string")
    want = Counter(zip(ids, brute([(t or "").encode() for t in texts], 40)))
    for hot in (50_000, 5, 1):
        monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (200, 64, hot))
        got = Counter((r[0], (bytes(r[1]), *r[2:])) for r in suffix_dedup.dedup_strings(df, 40).collect())
        assert got == want


def test_hot_anchors_are_ordered_in_smaller_groups(spark, monkeypatch):
    rng = random.Random(6)
    shared = "".join(rng.choice("qrstuv") for _ in range(70))
    other = "".join(rng.choice("abcd") for _ in range(30))
    texts = []
    for _ in range(400):
        cut = sorted(rng.sample(range(71), 2))
        texts.append(f"{rng.randrange(50)}{other[: rng.randint(0, 30)]}{shared[cut[0] : cut[1]]}{other[rng.randint(0, 30) :]}")
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = dict(enumerate(brute([t.encode() for t in texts], 40)))
    widths = []
    split = suffix_dedup.partial

    def watched(function, **given):
        widths.append(given["width"])
        return split(function, **given)

    monkeypatch.setattr(suffix_dedup, "partial", watched)
    monkeypatch.setattr(suffix_dedup.repeated_spans, "__defaults__", (200, 64, 3))
    got = {r[0]: (bytes(r[1]), *r[2:]) for r in suffix_dedup.dedup_strings(df, 40).collect()}
    assert got == want and sum(w[2] for w in want.values()) > 0
    assert widths == [4, 1]  # 29 places of an anchor, in eighths


def test_texts_without_repeats(odd_docs, no_docs):
    out = suffix_dedup.without_repeats(odd_docs)
    assert out.columns == odd_docs.columns and out.count() == 12
    texts = {r.doc_id: r.text for r in out.collect()}
    assert texts[5] == "" and texts[0] is None and texts[8] == "a  b \n c"
    assert suffix_dedup.without_repeats(no_docs).count() == 0
