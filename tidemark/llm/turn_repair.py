"""Repair of conversation structure by the cheapest edits, with the edits as an audit trail.

A repaired conversation has the roles ``(s?(ua)+)?`` by their first letters. Rows are read in order and
each is kept (0), given the role that is due (3) or deleted (4, and required if it is blank or a
duplicate); rows of either role without text are inserted where needed (3); a truncated row that stays
adds 3. Of the cheapest ways the one whose letters D, I, K, R come first counts.

The dynamic program keeps the best edits so far for each of four states (nothing yet, system, user,
assistant). Edits are persistent: each is a node that links to the one before, so all states share their
prefixes. A node has its ancestors at distances 1, 2, 4, ... and a rolling hash of all letters up to it. Where
two ways cost the same, their longest common prefix is found by climbing both in step while the hashes differ,
and equal hashes are verified letter by letter up to the shared node. Two ways of equal cost to the same
state are never prefixes of one another (an extra insertion costs 3), so the first letters in order stay first
whatever follows.

A conversation is read as a stream in order: a task holds the narrow nodes of one conversation and digests
of its rows, and the digest of each state's repaired text so far, but no texts beyond the current batch. As
a digest over all texts of a conversation and one string of edits are asked for, the rows of one conversation
meet in one task; Spark sorts them on disk.

Defined cases: a null role or text is one space (so such a text is blank); a null id is a
conversation of its own; null turns come first; rows of equal turn are taken by role and text; repeated rows
are duplicates; an empty table gives no rows; gaps beyond 64 bits are null; extra columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

WHITE = " \t\n\x0b\x0c\r"
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
START, SYSTEM, USER, ASSISTANT = range(4)
LEGAL_PAIRS = {"su", "ua", "au"}
BASE, PRIME = 131, (1 << 61) - 1
_FIGURES = (
    "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"
)
_NAMES = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


class Edit:
    """The last of a row of edits; ``up[j]`` is the one 2^j edits earlier."""

    __slots__ = ("letter", "depth", "digest", "up")

    def __init__(self, before: Edit | None, letter: str):
        self.letter = letter
        if before is None:
            self.depth = self.digest = 0
            self.up: list[Edit] = []
            return
        self.depth = before.depth + 1
        self.digest = (before.digest * BASE + ord(letter)) % PRIME
        self.up = up = [before]
        while len(up[-1].up) >= len(up):
            up.append(up[-1].up[len(up) - 1])

    def at(self, depth: int) -> Edit:
        """The edit at that depth."""
        node, steps, j = self, self.depth - depth, 0
        while steps:
            if steps & 1:
                node = node.up[j]
            steps >>= 1
            j += 1
        return node

    def letters(self) -> str:
        node, out = self, []
        while node.depth:
            out.append(node.letter)
            node = node.up[0]
        return "".join(reversed(out))


def _equal(a: Edit, b: Edit) -> bool:
    """Whether two rows of edits of one length are the same; equal hashes are verified."""
    if a.digest != b.digest:
        return False
    while a is not b:
        if a.letter != b.letter:
            return False
        a, b = a.up[0], b.up[0]
    return True


def comes_first(a: Edit, x: str, b: Edit, y: str) -> bool:
    """Whether the letters of ``a`` and then ``x`` sort before those of ``b`` and then ``y``."""
    depth = min(a.depth, b.depth)
    u, v = a.at(depth), b.at(depth)
    if _equal(u, v):
        x, y = x if a.depth == depth else a.at(depth + 1).letter, y if b.depth == depth else b.at(depth + 1).letter
        return x < y or (x == y and a.depth < b.depth)
    for j in reversed(range(len(u.up))):
        if j < len(u.up) and not _equal(u.up[j], v.up[j]):
            u, v = u.up[j], v.up[j]
    return u.letter < v.letter


class Way:
    """The best edits up to here that lead to one state, with the digest of the text they give."""

    __slots__ = ("cost", "edits", "text")

    def __init__(self, cost: int, edits: Edit, text):
        self.cost, self.edits, self.text = cost, edits, text


class Repair:
    """One conversation, row by row."""

    def __init__(self) -> None:
        self.ways: list[Way | None] = [Way(0, Edit(None, ""), hashlib.sha256()), None, None, None]
        self.seen: set[bytes] = set()
        self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial: str | None = None
        self.first = self.last = None
        self.turns = 0
        self._insert()

    def _best(self, tries: list[tuple[int, int, str, bytes | None]]) -> Way | None:
        """The best of (former state, cost, letter, new line of text)."""
        best = None
        for state, cost, letter, line in tries:
            way = self.ways[state]
            if way is None:
                continue
            cost += way.cost
            if best is None or cost < best[0] or cost == best[0] and comes_first(way.edits, letter, best[1].edits, best[2]):
                best = cost, way, letter, line, state
        if best is None:
            return None
        cost, way, letter, line, state = best
        text = way.text
        if line is not None:
            text = text.copy()
            text.update(line if state == START else b"\n" + line)
        return Way(cost, Edit(way.edits, letter), text)

    def _better(self, state: int, other: Way | None) -> None:
        own = self.ways[state]
        if own is None or other is not None and (
            other.cost < own.cost or other.cost == own.cost and comes_first(other.edits, "", own.edits, "")
        ):
            self.ways[state] = other

    def _insert(self) -> None:
        """Rows that could be put in here: a user's, and then an assistant's. More would come round to the same state."""
        self._better(USER, self._best([(s, INSERT, "I", b"user:") for s in (START, SYSTEM, ASSISTANT)]))
        self._better(ASSISTANT, self._best([(USER, INSERT, "I", b"assistant:")]))

    def add(self, turn: int | None, role: str, text: str, last_visible: str) -> None:
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in LEGAL_PAIRS:
            self.illegal += 1
        self.initial = initial
        if turn is not None and (self.last is None or turn != self.last):
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        role_bytes, body = role.encode(), text.encode()
        digest = hashlib.sha256(b"%d:%b%b" % (len(role_bytes), role_bytes, body)).digest()
        again = digest in self.seen
        self.seen.add(digest)
        tries: list[list[tuple[int, int, str, bytes | None]]] = [[(s, DELETE, "D", None)] for s in range(4)]
        if not last_visible:
            self.blank += 1
        elif again:
            self.duplicate += 1
        else:
            extra = 0
            if last_visible not in ".!?":
                self.truncated += 1
                extra = TRUNCATED
            kept = role_bytes + b":" + body
            if initial == "s":
                tries[SYSTEM].append((START, extra, "K", kept))
            for state in (START, SYSTEM, ASSISTANT):
                if initial == "u":
                    tries[USER].append((state, extra, "K", kept))
                tries[USER].append((state, REROLE + extra, "R", b"user:" + body))
            if initial == "a":
                tries[ASSISTANT].append((USER, extra, "K", kept))
            tries[ASSISTANT].append((USER, REROLE + extra, "R", b"assistant:" + body))
        self.ways = [self._best(t) for t in tries]
        self._insert()

    def result(self) -> tuple:
        self._better(START, self.ways[ASSISTANT])
        way = self.ways[START]
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (
            gaps if gaps < 1 << 63 else None, self.blank, self.duplicate, self.truncated, self.illegal,
            way.cost, way.edits.letters(), way.text.hexdigest(),
        )


def _stream(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """Rows of whole conversations in order to one row each; a conversation may span batches."""
    types = [conv_type, *[pa.int64()] * 6, pa.string(), pa.string()]
    current, repair, done = None, None, []

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], _NAMES)

    for batch in batches:
        columns = [batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text", "last_visible", "gone")]
        for conv, turn, role, text, last_visible, gone in zip(*columns):
            if repair is None or conv != current:
                if repair is not None:
                    done.append((current, *repair.result()))
                current, repair = conv, Repair()
            if not gone:
                repair.add(turn, role, text, last_visible)
        if done:
            yield batch_of(done)
            done = []
    if repair is not None:
        yield batch_of([(current, *repair.result())])


def rows_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with nulls of the last two as one space."""
    space = F.lit(" ")
    return conversations.select(
        "conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text")
    )


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with faults put in by a checksum of conversation and turn. Dropped rows stay, marked ``gone`` and without text."""
    space = F.lit(" ")
    rows = rows_of(conversations)
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = (F.crc32(key.cast("binary")) % 20).cast("int")
    text = F.when(kind <= 1, "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    role = F.when(kind == 4, "user").otherwise(F.col("role"))
    copies = F.when(kind == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), (kind == 0).alias("gone"), F.explode(copies).alias("_c")).drop("_c")


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cost, edits and digest of each conversation; ``rows`` may have a column ``gone`` for rows that only name theirs."""
    if "gone" not in rows.columns:
        rows = rows.withColumn("gone", F.lit(False))
    plain = rows.select("conv_id", "turn", "role", "text", "gone", F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1)).alias("last_visible"))
    ordered = plain.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    kind = ordered.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)
    return ordered.mapInArrow(lambda b: _stream(b, arrow), f"conv_id {kind.simpleString()}, {_FIGURES}")


def _places(batches: Iterator[pa.RecordBatch], conv_type: pa.DataType) -> Iterator[pa.RecordBatch]:
    """One row per edit that leaves a row: its place, the row it takes its text from, and its new role.

    Users and assistants take turns and an assistant is last, so a role follows from the place counted from the end.
    """
    types = [conv_type, pa.int64(), pa.int64(), pa.string()]
    for batch in batches:
        out: list[tuple] = []
        for conv, audit in zip(batch.column("conv_id").to_pylist(), batch.column("audit").to_pylist()):
            row, left = 0, len(audit) - audit.count("D")
            for letter in audit:
                row += letter != "I"
                if letter != "D":
                    left -= 1
                    role = None if letter == "K" else ("user" if left % 2 else "assistant")
                    out.append((conv, left, row if letter != "I" else None, role))
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], ["_conv", "left", "_row", "new_role"])


def repaired_rows(rows: DataFrame, repairs: DataFrame) -> DataFrame:
    """The rows that the edits leave: (conv_id, place, role, text), places from 0 without gaps. ``repairs`` is the result of ``repair``."""
    kind = repairs.schema["conv_id"].dataType
    arrow = to_arrow_type(kind)
    schema = f"_conv {kind.simpleString()}, left bigint, _row bigint, new_role string"
    places = repairs.select("conv_id", "audit").mapInArrow(lambda b: _places(b, arrow), schema)
    there = rows if "gone" not in rows.columns else rows.where(~F.col("gone"))
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "text")
    numbered = there.select("conv_id", "role", "text", F.row_number().over(order).cast("bigint").alias("row"))
    same = F.col("_conv").eqNullSafe(F.col("conv_id")) & (F.col("_row") == F.col("row"))
    lines = F.row_number().over(Window.partitionBy("_conv").orderBy(F.desc("left"))) - 1
    return places.join(numbered, same, "left").select(
        F.col("_conv").alias("conv_id"), lines.alias("place"), F.coalesce("new_role", "role").alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )


def oracle_sql() -> str:
    """Damage, faults and the cheapest edits by SQL that goes row by row with the four states and their texts."""

    def way(state: str, cost: str, letter: str, line: str | None, when: str = "TRUE") -> str:
        text = f"{state}.t" if line is None else f"{state}.t || CASE WHEN {state}.t = '' THEN '' ELSE chr(10) END || {line}"
        return f"CASE WHEN {state}.c IS NOT NULL AND {when} THEN {{'c': {state}.c + {cost}, 'a': {state}.a || '{letter}', 't': {text}}} END"

    def best(*ways: str) -> str:
        return f"list_min([{', '.join(ways)}])"

    stays, own = "fault NOT IN ('blank', 'duplicate')", "role || ':' || text"
    extra = "CASE WHEN fault = 'truncated' THEN 3 ELSE 0 END"

    def keep(state: str, initial: str) -> str:
        return way(state, extra, "K", own, f"{stays} AND left(role, 1) = '{initial}'")

    def rerole(state: str, role: str) -> str:
        return way(state, f"3 + {extra}", "R", f"'{role}:' || text", stays)

    def deleted(state: str) -> str:
        return way(state, "4", "D", None)

    users = [f("p" + s, x) for s in "013" for f, x in ((keep, "u"), (rerole, "user"))]
    put_in = lambda state, role: way(state, "3", "I", f"'{role}:'")
    return f"""
        WITH RECURSIVE src AS (
            SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
                   coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS key
            FROM conversations
        ), keyed AS (
            SELECT *, xor(list_reduce(
                list_concat([4294967295::UBIGINT], [ord(x)::UBIGINT for x in string_split(key, '')]),
                lambda c, b: list_reduce(
                    list_concat([xor(c, b)], [j::UBIGINT for j in range(8)]),
                    lambda d, j: CASE WHEN d & 1 = 1 THEN xor(d >> 1, 3988292384::UBIGINT) ELSE d >> 1 END
                )
            ), 4294967295::UBIGINT) % 20 AS kind
            FROM src
        ), damaged AS (
            SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
                   CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN translate(text, '.!?', '') ELSE text END AS text
            FROM keyed, (SELECT unnest(range(2)) AS copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
        ), numbered AS (
            SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
                   rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS visible
            FROM damaged
        ), faults AS MATERIALIZED (
            SELECT conv_id, turn, role, text, i,
                   CASE WHEN visible = '' THEN 'blank' WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'duplicate'
                        WHEN right(visible, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
                   lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) || left(role, 1) AS pair
            FROM numbered
        ), figures AS (
            SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
                   count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
                   count(*) FILTER (fault = 'truncated') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal,
                   count(*) AS n
            FROM faults GROUP BY conv_id
        ), walk AS (
            SELECT DISTINCT conv_id, CAST(0 AS BIGINT) AS i, {{'c': 0, 'a': '', 't': ''}} AS s0,
                   {{'c': CAST(NULL AS INTEGER), 'a': '', 't': ''}} AS s1, {{'c': 3, 'a': 'I', 't': 'user:'}} AS s2,
                   {{'c': 6, 'a': 'II', 't': 'user:' || chr(10) || 'assistant:'}} AS s3
            FROM conversations
            UNION ALL
            SELECT conv_id, i, q0, q1, r2, {best("q3", put_in("r2", "assistant"))}
            FROM (
                SELECT conv_id, i, q0, q1, q3, {best("q2", *[put_in(f"q{s}", "user") for s in "013"])} AS r2
                FROM (
                    SELECT conv_id, i, {best(deleted("p0"))} AS q0, {best(deleted("p1"), keep("p0", "s"))} AS q1,
                           {best(deleted("p2"), *users)} AS q2,
                           {best(deleted("p3"), keep("p2", "a"), rerole("p2", "assistant"))} AS q3
                    FROM (
                        SELECT f.conv_id, f.i, f.role, f.text, f.fault, w.s0 AS p0, w.s1 AS p1, w.s2 AS p2, w.s3 AS p3
                        FROM walk AS w JOIN faults AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id AND f.i = w.i + 1
                    )
                )
            )
        ), ended AS (
            SELECT w.conv_id, f.* EXCLUDE (conv_id), list_min([w.s0, w.s3]) AS b
            FROM walk AS w LEFT JOIN figures AS f ON f.conv_id IS NOT DISTINCT FROM w.conv_id
            WHERE w.i = coalesce(f.n, 0)
        )
        SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
               coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(b.c AS BIGINT) AS cost, b.a AS audit,
               sha256(b.t) AS repaired_sha256
        FROM ended
    """
