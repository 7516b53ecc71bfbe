import os
import random
from itertools import combinations

import numpy as np
import pytest

import corpus_pipeline
from tidemark.llm import components, simhash_wide

SF_DIR = "/root/testdata/sf0.01"


def shingles(text):
    words = text.lower().split()
    return {" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def alike(one, other):
    return len(one & other) / len(one | other) if one | other else 1.0


def test_fingerprint_is_the_majority_of_mixed_hashes():
    rng = np.random.default_rng(1)
    for n in (0, 1, 2, 254, 255, 256, 20_000):
        hashes = rng.integers(0, 1 << 63, n).astype(np.uint64)
        bits = np.unpackbits(simhash_wide._mixed(hashes).view(np.uint8), bitorder="little").reshape(n, 256)
        want = np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > n, bitorder="little")
        assert simhash_wide.fingerprint(hashes).tobytes() == want.tobytes()


def test_forest_connects_what_is_near():
    rng = np.random.default_rng(2)
    base = rng.integers(0, 1 << 62, (5, 4)).astype(np.uint64)
    entries = np.concatenate([b ^ (np.uint64(1) << rng.integers(0, 62, (n, 4)).astype(np.uint64)) for b, n in zip(base, (700, 1, 2, 3, 40))])
    places = {x for link in simhash_wide.forest(entries) for x in link}
    assert places == set(range(len(entries))) - {700} and len(simhash_wide.forest(entries)) == len(entries) - 5


def test_near_copies_meet_and_others_stay(spark, odd_docs, no_docs):
    rng = random.Random(5)
    rows, group = [], {}
    for base, copies in ((0, 60), (1, 2), (2, 3), (3, 1), (4, 1)):
        words = ["".join(rng.choice("abcdefgh") for _ in range(6)) for _ in range(300)]
        for _ in range(copies):
            copy = list(words)
            for at in rng.sample(range(300), 3):
                copy[at] = f"w{rng.randrange(10**6)}"
            group[len(rows)] = base
            rows.append((len(rows), " ".join(copy)))
    # Half of a text in common is no near copy; nor is a text whose one repeated line outweighs the rest.
    rows.append((100, rows[-1][1][: len(rows[-1][1]) // 2] + " " + rows[-2][1][: len(rows[-2][1]) // 2]))
    line = "this line comes again "
    rows += [(101, line * 300 + rows[0][1]), (102, line * 300 + rows[62][1])]
    # Texts that share an id are not compared; texts without words are one group.
    rows += [(200, rows[0][1]), (200, rows[0][1] + " more"), (301, " "), (302, "\n"), (303, None), (None, rows[0][1])]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in simhash_wide.near_duplicates(df).collect()}
    want = {i: min(k for k in group if group[k] == g) for i, g in group.items()}
    assert got == {i: c for i, c in want.items() if i != c} | {302: 301, 303: 301}
    odd = {r.doc_id: r.component_id for r in simhash_wide.near_duplicates(odd_docs).collect()}
    assert odd == {1: 0, 2: 0, 9: 0}
    assert simhash_wide.near_duplicates(no_docs).count() == 0


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not here")
def test_stage_against_brute_force(spark):
    """No document goes without a similar one, and at least nine of ten similar pairs lose a document."""
    docs = corpus_pipeline.exact(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR)
    sets = {r.doc_id: shingles(r.text or "") for r in docs.collect()}
    kept = {r.doc_id for r in corpus_pipeline.near(spark, docs, SF_DIR).collect()}
    sizes = {i: len(s) for i, s in sets.items()}
    close = [(a, b) for a, b in combinations(sets, 2) if 0.8 <= (sizes[a] + 1) / (sizes[b] + 1) <= 1.25]
    pairs = [(a, b) for a, b in close if not sets[a].isdisjoint(sets[b]) and alike(sets[a], sets[b]) >= 0.8]
    assert pairs and set(sets) - kept <= {i for pair in pairs for i in pair}
    assert sum(not {a, b} <= kept for a, b in pairs) >= 0.9 * len(pairs)


def test_a_failed_link_of_a_forest_loses_no_other(spark):
    """The first text is near to both others by bits wherever these meet, but alike to neither; they are alike."""
    rng = random.Random(3)
    word = lambda: f"w{rng.randrange(10**6)}"

    def shared(one, other):
        equal = (one ^ other).view(np.uint8).reshape(-1) == 0
        return {n for n, (p, q) in enumerate(simhash_wide.PAIRS) if equal[p] and equal[q]}

    rows, want = [], {}
    while len(want) < 2:
        first = [word() for _ in range(300)]
        changed = rng.sample(range(0, 300, 5), 7)
        second = [word() if at in changed else w for at, w in enumerate(first)]
        third = [word() if at in changed[:6] else w for at, w in enumerate(second)]
        texts = [" ".join(t) for t in (first, second, third)]
        a, b, c = (simhash_wide.fingerprint(simhash_wide.shingle_hashes(t)) for t in texts)
        meet = shared(b, c)
        if not meet or not meet <= shared(a, b):
            continue
        if not all(simhash_wide.near_pairs(x[None], y[None])[0, 0] for x, y in ((a, b), (a, c), (b, c))):
            continue
        x, y, z = map(shingles, texts)
        if max(alike(x, y), alike(x, z)) < 0.8 <= alike(y, z):
            want[len(rows) + 2] = len(rows) + 1
            rows += [(len(rows) + i, t) for i, t in enumerate(texts)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in simhash_wide.near_duplicates(df).collect()} == want


def test_open_pairs_are_all_near_pairs_of_different_parts(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 62, 4).astype(np.uint64)
    entries = base ^ (np.uint64(1) << rng.integers(0, 62, (700, 4)).astype(np.uint64))
    rows = [(e.tobytes(), i, i % 3 if i < 30 else 0) for i, e in enumerate(entries)]
    df = spark.createDataFrame([(bytearray(f), r, p) for f, r, p in rows], "fp binary, rep long, part long")
    i, j = np.nonzero(simhash_wide.near_pairs(entries, entries))
    want = {(a, b) for a, b in zip(i.tolist(), j.tolist()) if a < b and rows[a][2] != rows[b][2]}
    for size in (20_000, 100):
        got = [tuple(sorted((r.a, r.b))) for r in simhash_wide.open_pairs(df, list_entries=size).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_a_torn_group_is_joined_without_its_pairs(spark):
    """A large group of which no pair or only some are alike: the same groups as by all open pairs, fewer links than texts."""
    rng = random.Random(6)
    words = [f"w{rng.randrange(10**6)}" for _ in range(400)]
    rows = []
    for n in range(120):
        copy = list(words)
        for at in rng.sample(range(0, 400, 5), 7 if n % 3 else 4):
            copy[at] = f"w{rng.randrange(10**6)}"
        rows.append((n, " ".join(copy)))
    texts = spark.createDataFrame(rows, "doc_id long, text string")
    prints = {n: simhash_wide.fingerprint(simhash_wide.shingle_hashes(t)).tobytes() for n, t in rows}
    torn = spark.createDataFrame([(bytearray(f), n, 0, n) for n, f in prints.items()], "fp binary, rep long, whole long, part long")
    sets = {n: shingles(t) for n, t in rows}
    entries = np.frombuffer(b"".join(prints.values()), "<u8").reshape(-1, 4)
    near = simhash_wide.near_pairs(entries, entries)
    group = list(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        if near[a, b] and alike(sets[a], sets[b]) >= 0.8:
            group = [group[a] if g == group[b] else g for g in group]
    pairs = sum(group[a] != group[b] and near[a, b] for a, b in combinations(range(len(rows)), 2))
    assert pairs > 10 * len(rows) and 1 < len(set(group)) < len(rows)
    for size in (512, 30):
        links = [(r.a, r.b) for r in simhash_wide.alike_in_groups(torn, texts, group_entries=size).collect()]
        got = list(range(len(rows)))
        for a, b in links:
            got = [got[a] if g == got[b] else g for g in got]
        assert {frozenset(i for i, g in enumerate(got) if g == x) for x in got} == {frozenset(i for i, g in enumerate(group) if g == x) for x in group}
        assert size == 30 or len(links) < len(rows)
        assert len(links) < pairs / 10


def test_links_within_a_part_are_gone_through_once(spark, monkeypatch):
    """Groups by bits and the links found last are joined from parts; the groups are those of all links together."""
    rng = random.Random(7)
    links = [sorted(rng.sample(range(300), 2)) for _ in range(260)]
    first, then = links[:150], links[150:]
    frame = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    want = {tuple(r) for r in components.components(frame(links)).collect()}
    parts = components.components(frame(first))
    assert {tuple(r) for r in components.joined(parts, frame(then)).collect()} == want
    assert components.between(frame(first), parts).count() == 0
    assert {tuple(r) for r in components.joined(parts, frame([])).collect()} == {tuple(r) for r in parts.collect()}
    assert {tuple(r) for r in components.joined(components.components(frame([])), frame(links)).collect()} == want

    words = [f"w{rng.randrange(10**6)}" for _ in range(300)]
    rows = []
    for n in range(60):
        copy = list(words)
        for at in rng.sample(range(0, 300, 5), 1 if n < 50 else 5):
            copy[at] = f"w{rng.randrange(10**6)}"
        rows.append((n, " ".join(copy)))
    seen, counted = [], components.components
    for module in (components, simhash_wide):
        monkeypatch.setattr(module, "components", lambda links: seen.append(links.count()) or counted(links))
    simhash_wide.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).count()
    # Verified links, those between parts of a group by bits, and those found in groups.
    assert len(seen) == 3 and sum(seen[1:]) < seen[0] / 5
