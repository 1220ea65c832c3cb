"""Repair of conversation structure by aligning turns to an alternating grammar.

A sound conversation's role initials are ``(s?(ua)+)?``. Turns are kept, given another role or deleted, and empty turns are inserted. For each
feasible length of the grammar's string a Wagner-Fischer table aligns the turns to it, within an Ukkonen band that the cheapest audit so far
allows; lengths whose least cost is beyond it are not tried. Audits of equal cost are compared, the ASCII-least stays.

Rows are shuffled and sorted once by conversation and read as a stream, so a worker holds a batch, the current conversation's
first WHOLE turns and 16 bytes of hash for each of its distinct turns. A conversation that is longer is aligned in segments: for each pair of grammar states
before and after a segment the cheapest audit is found in the same way, and audits are joined state by state, with the running
hash of the repaired text beside each. No audit of equal cost begins with another one, so the joined audit is the cheapest and ASCII-least one of the whole conversation.
The hash of one conversation's repaired text is sequential by nature: its turns pass through one task, but never stand in it together.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .base import small_batches
from .sharding import CRC_TABLE, crc_sql

#: Costs of edits, and of a truncated turn that stays (fixed values).
DELETE, INSERT, REROLE, TRUNCATED = 2, 5, 1, 5
#: Turns that are aligned at once, and text bytes that stand for them at most; a longer conversation goes by segments.
WHOLE, WHOLE_BYTES, SEGMENT = 48, 8 << 20, 12
#: Adjacent role initials that are in order (fixed values).
LEGAL = frozenset(("su", "ua", "au"))
_SPACES = " \t\n\x0b\x0c\r"
_NAMES = {"u": "user", "a": "assistant"}
_COLUMNS = "gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"
EMPTY_SHA = hashlib.sha256(b"").hexdigest()


# ---------------------------------------------------------------- alignment


def align(turns: str, target: str, most: float) -> tuple[int, str] | None:
    """Cost and ASCII-least audit of the cheapest edits that turn ``turns`` into ``target``, None if they cost more than ``most``.

    A turn is ``-`` (must be deleted) or its initial, ``x`` for one that the grammar does not know, in upper case when it is truncated.
    A cell's diagonal is the surplus of target over turns; leaving the corridor between the first and the last cell's
    diagonals costs a deletion and an insertion for each step.
    """
    n, size = len(turns), len(target)
    surplus = size - n
    least = INSERT * surplus if surplus > 0 else -DELETE * surplus
    if least > most:
        return None
    slack = n + size if most == float("inf") else int(most - least) // (INSERT + DELETE)
    low, high = min(0, surplus) - slack, max(0, surplus) + slack
    never = float("inf")
    # rest[i][j]: what turns from i and targets from j on cost; cells beyond the band are never reached
    rest = [[never] * (size + 2) for _ in range(n + 2)]
    for i in range(n, -1, -1):
        row, below = rest[i], rest[i + 1]
        for j in range(min(size, i + high), max(0, i + low) - 1, -1):
            best = 0 if i == n and j == size else never
            if i < n:
                best = min(best, below[j] + DELETE)
                if j < size:
                    best = min(best, below[j + 1] + _stay(turns[i], target[j]))
            if j < size and target[j] != "s":
                best = min(best, row[j + 1] + INSERT)
            row[j] = best
    if rest[0][0] > most or rest[0][0] == never:
        return None
    i = j = 0
    audit = []
    while i < n or j < size:
        cost = rest[i][j]
        if i < n and rest[i + 1][j] + DELETE == cost:
            audit.append("D")
            i += 1
        elif j < size and target[j] != "s" and rest[i][j + 1] + INSERT == cost:
            audit.append("I")
            j += 1
        else:
            audit.append("K" if turns[i].lower() == target[j] else "R")
            i, j = i + 1, j + 1
    return int(rest[0][0]), "".join(audit)


def _stay(turn: str, wanted: str) -> float:
    """Cost of a turn that stays in the place of ``wanted``."""
    if turn == "-":
        return float("inf")
    extra = TRUNCATED if turn.isupper() else 0
    if turn.lower() == wanted:
        return extra
    return float("inf") if wanted == "s" else extra + REROLE


def _targets(state: str, after: str, size: int) -> list[str]:
    """Grammar strings of one length that lead from a state (``-`` at the start, else the last initial) to another."""
    if not size:
        return [""] if state == after else []
    cycle = "au" if state == "u" else "ua"
    out = [(cycle * (size // 2 + 1))[:size]]
    if state == "-":
        out.append("s" + ("ua" * (size // 2 + 1))[: size - 1])
    return [t for t in out if t[-1] == after]


@lru_cache(maxsize=100_000)
def cheapest(turns: str, state: str, after: str) -> tuple[int, str] | None:
    """Cost and audit of the cheapest edits of ``turns`` between two states, over all feasible lengths."""
    forced = turns.count("-")
    free = len(turns) - forced
    found = None

    def floor(size: int) -> int:
        return DELETE * (len(turns) - size) if size <= free else DELETE * forced + INSERT * (size - free)

    # deleting every turn and inserting two is the dearest that can be needed, or no string leads there
    longest = free + (DELETE * free + 2 * INSERT) // INSERT
    for size in sorted(range(longest + 1), key=floor):
        if found and floor(size) > found[0]:
            break
        for target in _targets(state, after, size):
            got = align(turns, target, found[0] if found else float("inf"))
            found = min(filter(None, (found, got)), default=None)
    return found


# ---------------------------------------------------------------- one conversation


def _joined(node) -> str:
    parts = []
    while node:
        parts.append(node[1])
        node = node[0]
    return "".join(reversed(parts))


def _less(a, b) -> bool:
    """Whether the audit of one chain of segments is smaller; common beginnings are skipped."""
    left, right = [], []
    while a is not b:
        left.append(a[1])
        right.append(b[1])
        a, b = a[0], b[0]
    return "".join(reversed(left)) < "".join(reversed(right))


class _Conversation:
    """The state of the conversation that is read."""

    def __init__(self, name):
        self.name = name
        self.turns: list[tuple[str, str, str]] = []  # symbol, role, text
        self.bytes = self.read = 0
        self.live = {"-": (0, None, hashlib.sha256())}  # grammar state: cost, chain of audits, hash
        self.seen: set[bytes] = set()
        self.low = self.turn = self.last = None
        self.distinct = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.long = False

    def add(self, turn: int | None, role: str, text: str) -> None:
        if turn is not None and turn != self.turn:
            self.low = turn if self.low is None else self.low
            self.turn = turn
            self.distinct += 1
        first = role[:1]
        if self.last is not None and self.last + first not in LEGAL:
            self.illegal += 1
        self.last = first
        self.turns.append((self._symbol(first, role, text), role, text))
        self.bytes += len(text)
        if len(self.turns) >= (SEGMENT if self.long else WHOLE) or self.bytes > WHOLE_BYTES:
            self.long = True
            self._segments(SEGMENT)

    def _symbol(self, first: str, role: str, text: str) -> str:
        body = text.rstrip(_SPACES)
        if not body:
            self.blank += 1
            return "-"
        mark = hashlib.blake2b(f"{len(role)}:{role}{text}".encode(), digest_size=16).digest()
        if mark in self.seen:
            self.duplicate += 1
            return "-"
        self.seen.add(mark)
        symbol = first if first in ("s", "u", "a") else "x"
        if body[-1] in ".!?":
            return symbol
        self.truncated += 1
        return symbol.upper()

    def _segments(self, size: int) -> None:
        for at in range(0, len(self.turns), size):
            self._advance(self.turns[at : at + size], ("-", "s", "u", "a"))
        self.turns, self.bytes = [], 0

    def _advance(self, turns: list, ends: tuple[str, ...]) -> None:
        """Join the cheapest audits of further turns to those so far."""
        key = "".join(t[0] for t in turns)
        after = {}
        for state, (cost, chain, _) in self.live.items():
            for end in ends:
                if got := cheapest(key, state, end):
                    new = (cost + got[0], (chain, got[1]), state)
                    old = after.get(end)
                    if old is None or new[0] < old[0] or (new[0] == old[0] and _less(new[1], old[1])):
                        after[end] = new
        self.live = {end: (cost, chain, self._hashed(self.live[state][2], state, chain[1], turns)) for end, (cost, chain, state) in after.items()}

    @staticmethod
    def _hashed(so_far, state: str, audit: str, turns: list):
        out, row = so_far.copy(), 0
        for edit in audit:
            if edit == "D":
                row += 1
                continue
            lead = "" if state == "-" else "\n"
            wanted = "a" if state == "u" else "u"
            role, text = (_NAMES[wanted], "") if edit == "I" else turns[row][1:]
            if edit == "K":
                state = role[0]
            else:
                role, state = _NAMES[wanted], wanted
            row += edit != "I"
            out.update(f"{lead}{role}:{text}".encode())
        return out

    def result(self) -> tuple:
        self._advance(self.turns, ("-", "a"))
        ends = [self.live[e] for e in ("-", "a") if e in self.live]
        cost, chain, digest = ends[0]
        if len(ends) == 2 and (ends[1][0] < cost or (ends[1][0] == cost and _less(ends[1][1], chain))):
            cost, chain, digest = ends[1]
        gaps = self.turn - self.low + 1 - self.distinct if self.distinct else 0
        return self.name, gaps, self.blank, self.duplicate, self.truncated, self.illegal, cost, _joined(chain), digest.hexdigest()


def _repairs(batches: Iterator[pa.RecordBatch], schema: pa.Schema, most: int = 1000) -> Iterator[pa.RecordBatch]:
    """A row for each conversation of a stream sorted by conversation, then turn."""
    now, key, out, held = None, None, [], 0
    for batch in batches:
        for k, name, *turn in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is None or k != key:
                if now is not None:
                    out.append(now.result())
                    held += len(out[-1][7])
                now, key = _Conversation(name), k
            now.add(*turn)
            if len(out) >= most or held > WHOLE_BYTES:
                yield _batch(out, schema)
                out, held = [], 0
    if now is not None:
        out.append(now.result())
    if out:
        yield _batch(out, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


# ---------------------------------------------------------------- operator


def _turns(conversations: DataFrame, conv: str, turn: str, role: str, text: str) -> DataFrame:
    """``_k`` (a conversation's name as text, null apart), ``_conv``, ``_turn``, ``_role``, ``_text``; a null role or text is one space."""
    name = F.col(f"`{conv}`")
    said = lambda c: F.coalesce(F.col(f"`{c}`").cast("string"), F.lit(" "))
    return conversations.select(F.coalesce(F.concat(F.lit("="), name.cast("string")), F.lit("")).alias("_k"), name.alias("_conv"), F.col(f"`{turn}`").cast("long").alias("_turn"), said(role).alias("_role"), said(text).alias("_text"))


def repair(conversations: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: its id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.

    Turns go by number, null ones first, equal ones by role and text; each row's first fault counts. ``audit`` has
    an initial for each edit (Keep, Rerole, Delete, Insert). A null role or text counts as one space, so such a text is blank; a null id is one
    conversation. Repeated rows are duplicates of the first. Roles that do not start with s, u or a are given another one or go. Texts of any length are read
    whole. An empty table gives an empty result; other columns are not read.
    """
    spark = conversations.sparkSession
    small_batches(spark)
    rows = _turns(conversations, conv, turn, role, text)
    dealt = rows.repartition("_k").sortWithinPartitions("_k", F.col("_turn").asc_nulls_first(), "_role", "_text")
    kind = dict(conversations.dtypes)[conv]
    from pyspark.sql.pandas.types import to_arrow_schema

    fields = spark.createDataFrame([], f"_conv {kind}, {_COLUMNS}").schema
    schema = to_arrow_schema(fields)
    return dealt.mapInArrow(lambda batches: _repairs(batches, schema), fields).withColumnRenamed("_conv", conv)


def repaired_turns(conversations: DataFrame, repaired: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The repaired conversations: ``conv_id, position, edit, turn, role, text``; inserted turns have no number.

    A repaired conversation ends with an assistant's turn, so the places from its end tell roles that are given.
    """
    by_place = Window.partitionBy("_k").orderBy(F.col("_turn").asc_nulls_first(), "_role", "_text")
    rows = _turns(conversations, conv, turn, role, text).withColumn("_row", F.row_number().over(by_place))
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{conv}`").cast("string")), F.lit(""))
    letters = F.posexplode(F.split(F.col("audit"), "")).alias("_p", "edit")
    edits = repaired.where("audit <> ''").select(name.alias("_k"), F.col(f"`{conv}`").alias("_name"), letters).where("edit <> ''")
    order = Window.partitionBy("_k").orderBy("_p")
    edits = edits.withColumns({
        "_row": F.sum((F.col("edit") != "I").cast("int")).over(order),
        "position": F.sum((F.col("edit") != "D").cast("long")).over(order) - 1,
        "_left": F.sum((F.col("edit") != "D").cast("long")).over(Window.partitionBy("_k").orderBy(F.desc("_p"))),
    }).where("edit <> 'D'")
    found = edits.join(rows.drop("_conv"), ["_k", "_row"])
    inserted = edits.where("edit = 'I' AND _row = 0")
    found = found.unionByName(inserted, allowMissingColumns=True)
    fresh = F.col("edit") == "I"
    given = F.when(F.col("_left") % 2 == 1, "assistant").otherwise("user")
    return found.select(
        F.col("_name").alias(conv), "position", "edit", F.when(~fresh, F.col("_turn")).alias(turn),
        F.when(F.col("edit") == "K", F.col("_role")).otherwise(given).alias(role), F.when(fresh, F.lit("")).otherwise(F.col("_text")).alias(text),
    )


# ---------------------------------------------------------------- the query's faults


def damaged(conversations: DataFrame) -> DataFrame:
    """The given conversations with faults by crc32 of ``conv_id:turn``: dropped, emptied, cut, repeated and misattributed turns.

    Nulls count as one space in that text, as role and as text.
    """
    said = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.pmod(F.crc32(F.concat(said("conv_id"), F.lit(":"), said("turn")).cast("binary")), F.lit(20))
    rows = conversations.select("conv_id", "turn", said("role").alias("role"), said("text").alias("text"), fault.alias("_fault")).where("_fault <> 0")
    rows = rows.withColumns({
        "role": F.when(F.col("_fault") == 4, "user").otherwise(F.col("role")),
        "text": F.when(F.col("_fault") == 1, "").when(F.col("_fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")),
    })
    times = F.when(F.col("_fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.withColumn("_time", F.explode(times)).select("conv_id", "turn", "role", "text")


def repaired_digest(conversations: DataFrame) -> DataFrame:
    """``repair`` of the damaged conversations, with a row for those of which no turn is left."""
    every = conversations.select(F.col("conv_id").alias("_id")).distinct()
    got = repair(damaged(conversations))
    filled = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    out = every.join(got, F.col("_id").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("_id").alias("conv_id"), *[c.alias(n) for n, c in filled.items()], F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(EMPTY_SHA)).alias("repaired_sha256"))


def oracle() -> str:
    """The same by one fold over each conversation's turns: the cheapest audit for each last initial, as cost and edits in one text."""
    plus = lambda x, c, e: f"(lpad(CAST(CAST({x}[1:9] AS BIGINT) + {c} AS VARCHAR), 9, '0') || {x}[10:] || '{e}')"
    # z: nothing yet; s, u, a: last initial. Before each turn and at the end at most one turn is inserted.
    u = f"least(r.u, {plus('r.z', 5, 'I')}, {plus('r.s', 5, 'I')}, {plus('r.a', 5, 'I')})"
    a = f"least(r.a, {plus('r.u', 5, 'I')})"
    extra = "CASE WHEN t.truncated THEN 5 ELSE 0 END"
    stay = lambda x, role: f"CASE WHEN t.forced THEN NULL WHEN t.first = '{role}' THEN {plus(x, extra, 'K')} ELSE {plus(x, f'{extra} + 1', 'R')} END"
    spaces = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
    return f"""
WITH RECURSIVE {CRC_TABLE},
k AS (SELECT conv_id, coalesce('=' || CAST(conv_id AS VARCHAR), '') AS c, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
  hex(encode(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '))) AS digits FROM conversations),
f AS (SELECT conv_id, c, turn, role, text, {crc_sql('digits')} % 20 AS fault FROM k, crc_table),
d AS (SELECT c, turn, CASE WHEN fault = 4 THEN 'user' ELSE role END AS role, CASE WHEN fault = 1 THEN '' WHEN fault = 2 THEN translate(text, '.!?', '') ELSE text END AS text,
  unnest(range(CASE WHEN fault = 3 THEN 2 ELSE 1 END)) AS copy FROM f WHERE fault <> 0),
n AS (SELECT *, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, role, text) AS i, rtrim(text, {spaces}) AS body, substr(role, 1, 1) AS first FROM d),
e AS (SELECT *, body = '' AS blank, body <> '' AND row_number() OVER (PARTITION BY c, role, text ORDER BY i) > 1 AS duplicate, lag(first) OVER (PARTITION BY c ORDER BY i) AS before FROM n),
t AS (SELECT *, blank OR duplicate AS forced, NOT blank AND NOT duplicate AND right(body, 1) NOT IN ('.', '!', '?') AS truncated FROM e),
q AS (SELECT c, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank, count(*) FILTER (WHERE duplicate) AS duplicate,
  count(*) FILTER (WHERE truncated) AS truncated, count(*) FILTER (WHERE before IS NOT NULL AND before || first NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM t GROUP BY c),
r(c, i, z, s, u, a) AS (SELECT c, CAST(0 AS BIGINT), '000000000', CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR) FROM q
  UNION ALL
  SELECT r.c, t.i, {plus('r.z', 2, 'D')}, least({plus('r.s', 2, 'D')}, CASE WHEN t.first = 's' AND NOT t.forced THEN {plus('r.z', extra, 'K')} END),
    least({plus(u, 2, 'D')}, {stay('r.z', 'u')}, {stay('r.s', 'u')}, {stay(a, 'u')}), least({plus(a, 2, 'D')}, {stay(u, 'a')})
  FROM r JOIN t ON t.c = r.c AND t.i = r.i + 1),
b AS (SELECT r.c, least(r.z, {a}) AS best FROM r JOIN q ON q.c = r.c AND q.n = r.i),
x AS (SELECT c, CAST(best[1:9] AS BIGINT) AS cost, best[10:] AS audit FROM b),
p AS (SELECT c, p, audit[p:p] AS edit FROM (SELECT c, audit, unnest(range(1, length(audit) + 1)) AS p FROM x)),
l AS (SELECT *, count(*) FILTER (WHERE edit <> 'I') OVER (PARTITION BY c ORDER BY p) AS i, count(*) FILTER (WHERE edit <> 'D') OVER (PARTITION BY c ORDER BY p DESC) AS rest FROM p),
h AS (SELECT l.c, string_agg((CASE WHEN edit = 'K' THEN t.role WHEN rest % 2 = 1 THEN 'assistant' ELSE 'user' END) || ':' || (CASE WHEN edit = 'I' THEN '' ELSE t.text END), chr(10) ORDER BY p) AS whole
  FROM l LEFT JOIN t ON t.c = l.c AND t.i = l.i WHERE edit <> 'D' GROUP BY l.c),
o AS (SELECT DISTINCT c, conv_id FROM k)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(cost, 0) AS cost, coalesce(audit, '') AS audit, sha256(coalesce(whole, '')) AS repaired_sha256
FROM o LEFT JOIN q ON q.c = o.c LEFT JOIN x ON x.c = o.c LEFT JOIN h ON h.c = o.c"""
