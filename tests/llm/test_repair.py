import hashlib
import os
import random
import zlib

import pytest

from tidemark.llm import queries, turn_repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string, gone_by string"
WHITE = " \t\n\x0b\x0c\r"


def plain_damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * {0: 0, 3: 2}.get(kind, 1)
    return out


def plain_repair(rows):
    """Faults and cheapest edits of one conversation; every way is kept with its letters and lines."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode()))
    faults, seen = [], set()
    for _, _, role, text in rows:
        last = text.strip(WHITE)[-1:]
        faults.append("blank" if not last else "duplicate" if (role, text) in seen else "" if last in ".!?" else "truncated")
        seen.add((role, text))
    # by what stands at the end: nothing, s, u or a
    ways = {"": (0, "", ())}

    def put(into, state, way):
        into[state] = min(way, into.get(state, way))

    def follows(state):
        return {"": "us", "s": "u", "u": "a", "a": "u"}[state]

    def insert(ways):
        for _ in range(3):
            for state, (cost, letters, lines) in list(ways.items()):
                due = follows(state)[0]
                put(ways, due, (cost + 3, letters + "I", (*lines, {"u": "user:", "a": "assistant:"}[due])))

    insert(ways)
    for (_, _, role, text), fault in zip(rows, faults):
        after = {}
        for state, (cost, letters, lines) in ways.items():
            put(after, state, (cost + 4, letters + "D", lines))
            if fault in ("blank", "duplicate"):
                continue
            extra = 3 if fault else 0
            if role[:1] and role[:1] in follows(state):
                put(after, role[:1], (cost + extra, letters + "K", (*lines, f"{role}:{text}")))
            due = follows(state)[0]
            put(after, due, (cost + 3 + extra, letters + "R", (*lines, f"{'user' if due == 'u' else 'assistant'}:{text}")))
        ways = after
        insert(ways)
    cost, letters, lines = min(ways[s] for s in ("", "a") if s in ways)
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:])]
    digest = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    counts = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, *counts, sum(p not in ("su", "ua", "au") for p in pairs), cost, letters, digest), lines


def random_rows(seed, conversations=60):
    rng = random.Random(seed)
    texts = ["Yes.", "no", "", " \t\n", None, "Really?", "Wow! ", "a b c", "é.", "漢字", "x\n"]
    roles = ["user", "assistant", "system", "user", "assistant", None, "", "tool", "User", "sys"]
    rows = []
    for conv in range(conversations):
        for turn in range(rng.randint(1, 9)):
            rows.append((conv, rng.choice([turn, turn, turn, turn + 3, None]), rng.choice(roles), rng.choice(texts)))
    return rows


def grouped(rows):
    out = {}
    for r in rows:
        out.setdefault(r[0], []).append(r)
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("prime", [turn_repair.PRIME, 3])
def test_edits_equal_trying_all_ways(monkeypatch, prime):
    """Also where nearly all hashes collide."""
    monkeypatch.setattr(turn_repair, "PRIME", prime)
    for rows in grouped(random_rows(1, 400)).values():
        rows = [(c, t, r or " ", x or "") for c, t, r, x in rows]
        want, _ = plain_repair(rows)
        own = turn_repair.Repair()
        for _, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2].encode(), r[3].encode())):
            own.add(turn, role, text, text.rstrip(WHITE)[-1:])
        assert own.result() == want


def test_order_of_letters_with_shared_and_separate_prefixes():
    rng = random.Random(4)
    root = turn_repair.Edit(None, "")
    nodes = [root]
    for _ in range(400):
        nodes.append(turn_repair.Edit(rng.choice(nodes[-12:]), rng.choice("DIK")))
    for _ in range(3000):
        a, b, x, y = rng.choice(nodes), rng.choice(nodes), rng.choice("DIKR"), rng.choice("DIKR")
        assert turn_repair.comes_first(a, x, b, y) == (a.letters() + x < b.letters() + y)


def test_long_conversations_are_let_go(spark):
    own = turn_repair.Repair()
    for i in range(60_000):
        own.add(i, ("user", "assistant", "user")[i % 3], f"text {i}.", ".")
    assert len(own.result()[6]) >= 60_000


@pytest.mark.parametrize("seed", [2, 3])
def test_query_on_random_rows(spark, seed):
    rows = random_rows(seed) + [(None, None, None, None), (None, 3, "user", "Hi."), (77, 1, "assistant", "Yes.")] + [(5, 1, "user", "Same.")] * 4
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA).repartition(5)
    damaged = turn_repair.damage(df)
    repairs = turn_repair.repair(damaged)
    by_conv = {c: [] for c, *_ in rows} | grouped(plain_damage(rows))
    want = {c: plain_repair(r) for c, r in by_conv.items()}
    assert found(repairs) == {c: w[0] for c, w in want.items()}
    lines = {c: [] for c in by_conv}
    for r in sorted(turn_repair.repaired_rows(damaged, repairs).collect(), key=lambda r: r.place):
        assert r.place == len(lines[r.conv_id])
        lines[r.conv_id].append(f"{r.role}:{r.text}")
    assert lines == {c: list(w[1]) for c, w in want.items()}


def test_a_conversation_with_a_third_of_all_rows(spark):
    rows = [(1, i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(30_000)]
    rows += [(2 + i // 4, i % 4, "user", "Hm") for i in range(60_000)]
    df = spark.createDataFrame([(*r, "x", "y") for r in rows], SCHEMA)
    got = found(turn_repair.repair(turn_repair.rows_of(df)))
    assert len(got) == 15_001 and got[1][5:7] == (0, "K" * 30_000)
    assert got[2] == plain_repair(rows[30_000:30_004])[0]


def test_no_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert turn_repair.repair(turn_repair.damage(empty)).count() == 0
    gone = [(c, 0, "user", "Hi.", "", "") for c in range(300) if zlib.crc32(f"{c}:0".encode()) % 20 == 0]
    got = found(turn_repair.repair(turn_repair.damage(spark.createDataFrame(gone, SCHEMA))))
    assert len(got) == len(gone) > 0
    assert set(got.values()) == {(0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())}


@pytest.mark.parametrize("name", ["op11_audit_repair", "op12_sharded_lloyd"])
def test_query_equals_sql(spark, name):
    duckdb = pytest.importorskip("duckdb")
    sf_dir = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for file in os.listdir(sf_dir):
        con.sql(f"CREATE VIEW {file[:-8]} AS SELECT * FROM '{sf_dir}/{file}'")
    df = queries.QUERIES[name](spark, sf_dir)
    want = con.execute(queries.ORACLE[name])
    assert df.columns == [d[0] for d in want.description]
    assert sorted(map(tuple, df.collect())) == sorted(want.fetchall())
