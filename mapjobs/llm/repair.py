"""Conversation structure repair (operator 12): conversations streamed in order of their turns, with the state of a small dynamic program carried along."""

from __future__ import annotations

import hashlib
import tempfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

#: States of role initials that can become ``(s?(ua)+)?``: nothing yet, after s, after u, after a. The first and the last may end.
NOTHING, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = {NOTHING: "", AFTER_A: "", AFTER_U: "I", AFTER_S: "II"}
#: The state after a role's initial.
NEXT = {(NOTHING, "s"): AFTER_S, (NOTHING, "u"): AFTER_U, (AFTER_S, "u"): AFTER_U, (AFTER_U, "a"): AFTER_A, (AFTER_A, "u"): AFTER_U}
#: Costs of the edits.
REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
ROLES = {"u": "user", "a": "assistant"}
#: Bytes of choices that a task keeps before they go to a file of its own.
KEPT_BYTES = 1 << 20
NONE = 255
OUT = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


def damaged(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, dropped) of rows (conv_id, turn, role, text), damaged by the crc32 of ``conv_id:turn`` modulo 20.

    Nulls count as one space: in role and text, and in the text that is hashed; conv_id and turn themselves stay null. 0 marks a row as dropped (it then
    only says that its conversation exists), 1 empties the text, 2 removes its full stops, exclamation and question marks, 3 repeats the row, 4 makes it the user's."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(space("conv_id"), F.lit(":"), space("turn")).cast("binary")) % 20
    text = F.when(kind == 1, "").when(kind == 2, F.regexp_replace(space("text"), "[.!?]", "")).otherwise(space("text"))
    d = rows.select("conv_id", "turn", F.when(kind == 4, "user").otherwise(space("role")).alias("role"), text.alias("text"), (kind == 0).alias("dropped"), F.when(kind == 3, 2).otherwise(1).alias("times"))
    return d.withColumn("one", F.explode(F.sequence(F.lit(1), "times"))).select("conv_id", "turn", "role", "text", "dropped")


def _moves() -> dict:
    """For each kind of row (must go, initial, truncated): what can follow a state, as (state, cost, edits, new state). Two inserts at most are of use in a row."""
    inserted = {s: [(s, 0)] for s in range(4)}
    for s in range(4):
        for initial in "ua" if s != AFTER_U else "a":
            m = NEXT.get((inserted[s][-1][0], initial))
            if m is not None:
                inserted[s].append((m, len(inserted[s])))
    table = {}
    for gone in (True, False):
        for initial in "sua-":
            for truncated in (True, False):
                moves = []
                for s in range(4):
                    for m, k in inserted[s]:
                        paid, more = INSERT * k, TRUNCATED * truncated
                        moves.append((s, paid + DELETE, "I" * k + "D", m))
                        if not gone and (m, initial) in NEXT:
                            moves.append((s, paid + more, "I" * k + "K", NEXT[m, initial]))
                        if not gone:
                            moves.append((s, paid + REROLE + more, "I" * k + "R", NEXT[m, "a" if m == AFTER_U else "u"]))
                table[gone, initial, truncated] = moves
    return table


MOVES = _moves()
#: What follows the start: costs by state (None: not to be reached) and the order of the edits that lead there.
START = ((0, None, None, None), (0, 0, 0, 0))
_steps: dict = {}


def step(state: tuple, kind: tuple) -> tuple:
    """(least cost so far, costs above it and order of the edits by state, choices) after a row of a kind.

    Edits up to a row end with that row's, so of two different ones neither begins the other: the order of what was, then of the new edits, is the order of the
    whole, and ties go to the least. Costs above the least are bounded, so few steps differ and each is worked out once."""
    found = _steps.get((state, kind))
    if found is None:
        costs, order = state
        best: list = [None] * 4
        for s, cost, edits, new in MOVES[kind]:
            if costs[s] is not None:
                x = (costs[s] + cost, order[s], edits, s)
                if best[new] is None or x < best[new]:
                    best[new] = x
        least = min(x[0] for x in best if x)
        sorted_by = sorted({x[1:3] for x in best if x})
        ranks = tuple(sorted_by.index(x[1:3]) if x else 0 for x in best)
        choices = bytes(x[3] | (len(x[2]) - 1) << 2 | "DKR".index(x[2][-1]) << 4 if x else NONE for x in best)
        found = _steps[state, kind] = (least, (tuple(x[0] - least if x else None for x in best), ranks), choices)
    return found


class Log:
    """Choices of a conversation, four bytes a row. Beyond ``most`` bytes they go to a nameless file, which is the task's own and goes with it."""

    def __init__(self, most: int = KEPT_BYTES):
        self.most, self.here, self.file, self.there = most, bytearray(), None, 0

    def add(self, choices: bytes) -> None:
        self.here += choices
        if len(self.here) >= self.most:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(self.there)
            self.file.write(self.here)
            self.there += len(self.here)
            self.here.clear()

    def backwards(self) -> Iterator[bytes]:
        yield from (self.here[i:i + 4] for i in range(len(self.here) - 4, -1, -4))
        block, at = self.most - self.most % 4 or 4, self.there
        while at:
            n = min(block, at)
            at -= n
            self.file.seek(at)
            part = self.file.read(n)
            yield from (part[i:i + 4] for i in range(n - 4, -1, -4))

    def close(self) -> None:
        if self.file:
            self.file.close()


class Conversation:
    """What has been seen of one conversation: counts, the dynamic program's four states, and for each the hash of the rows that it has repaired so far."""

    def __init__(self, conv: str | None, most: int):
        self.conv, self.log, self.state, self.base = conv, Log(most), START, 0
        self.first = self.last = None
        self.turns = self.blank = self.duplicate = self.truncated = self.illegal = 0
        self.initial = None
        self.hashes: list = [(hashlib.sha256(), False), None, None, None]

    def row(self, turn: str | None, role: str, text: str, first: bool) -> None:
        if turn is not None and turn != self.last:
            self.first = turn if self.first is None else self.first
            self.last, self.turns = turn, self.turns + 1
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.illegal += 1
        self.initial = initial
        end = text.rstrip(" \t\n\x0b\x0c\r")[-1:]
        blank, duplicate = not end, bool(end) and not first
        truncated = bool(end) and first and end not in ".!?"
        self.blank, self.duplicate, self.truncated = self.blank + blank, self.duplicate + duplicate, self.truncated + truncated
        cost, self.state, choices = step(self.state, (blank or duplicate, initial if initial in ("s", "u", "a") else "-", truncated))
        self.base += cost
        self.log.add(choices)
        line, was = None, self.hashes
        self.hashes = now = []
        for c in choices:
            if c == NONE:
                now.append(None)
                continue
            s, inserts, edit = c & 3, c >> 2 & 3, c >> 4
            state, begun = was[s]
            parts = _inserted(s, inserts)
            if edit:
                line = text.encode() if line is None else line
                named = role if edit == 1 else ROLES["a" if (s == AFTER_U) != bool(inserts % 2) else "u"]
                parts.append(named.encode() + b":" + line)
            now.append(_extended(state, begun, parts))

    def result(self) -> tuple:
        costs, order = self.state
        cost, _, edits, s = min((costs[s] + INSERT * len(e), order[s], e, s) for s, e in ENDS.items() if costs[s] is not None)
        state, _ = _extended(*self.hashes[s], _inserted(s, len(edits)))
        audit = bytearray(edits.encode())
        for choices in self.log.backwards():
            c = choices[s]
            s = c & 3
            audit += b"DKR"[c >> 4:(c >> 4) + 1] + b"I" * (c >> 2 & 3)
        audit.reverse()
        self.log.close()
        gaps = int(self.last) - int(self.first) + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.blank, self.duplicate, self.truncated, self.illegal, self.base + cost, audit.decode(), state.hexdigest())


def _inserted(s: int, n: int) -> list[bytes]:
    return [b"assistant:" if (s == AFTER_U) != bool(i % 2) else b"user:" for i in range(n)]


def _extended(state, begun: bool, lines: list[bytes]) -> tuple:
    if lines:
        state = state.copy()
        for x in lines:
            if begun:
                state.update(b"\n")
            state.update(x)
            begun = True
    return state, begun


def repaired(rows: DataFrame, kept_bytes: int = KEPT_BYTES, most: int = 8 << 20) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) for every conversation of rows (conv_id, turn, role, text, dropped).

    Rows are taken by turn (nulls first; rows of one turn by role and text). A row is blank (white space only), else a duplicate (its conversation has had its role and text), else truncated (it does
    not end in a full stop, exclamation or question mark). gaps: turns missing between the least and the greatest; illegal: neighbours whose role initials are not su, ua or au.
    The cheapest edits make the role initials ``(s?(ua)+)?``: Keep 0, Rerole to user or assistant 1, Delete 2 (a must for blank and duplicate rows), Insert an empty row of user
    or assistant 5; a truncated row that stays adds 5. audit has their initials in order, the least in ASCII of equally cheap ones. The hash is the
    sha256 of the repaired rows as ``role:text``, joined by newlines.

    One shuffle, by conversation, serves the window that marks duplicates and the stream in order of turns; both sorts spill. A task keeps
    four states for a conversation, whatever its length, with four running hashes; choices are four bytes a row, and beyond ``kept_bytes`` in a file
    of the task's own. A lost task starts its conversations again. So a conversation of any length takes one core's time, and bounded memory but for its audit, which
    is part of the result.

    Conversations without rows (all ``dropped``): zeros, an empty audit, the hash of the empty text. A null conv_id is a conversation of its own; a role without an initial fits nowhere and is
    reroled or deleted. Null roles and texts count as one space. Other columns are ignored; no rows give no rows.
    """
    kind = rows.schema["conv_id"].dataType
    role, text = F.coalesce(F.col("role"), F.lit(" ")), F.coalesce(F.col("text"), F.lit(" "))
    same = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    r = rows.select(F.col("conv_id").cast("string").alias("conv"), "turn", role.alias("role"), text.alias("text"), F.coalesce("dropped", F.lit(False)).alias("dropped"))
    r = r.withColumn("same", F.when(~F.col("dropped"), same))
    r = r.withColumns({c: F.when(~F.col("dropped"), F.col(c)) for c in ("role", "text")})
    r = r.repartition("conv").withColumn("nth", F.row_number().over(W.partitionBy("conv", "same").orderBy(F.col("turn").asc_nulls_first())))
    r = r.sortWithinPartitions("conv", F.col("turn").asc_nulls_first(), "role", "text", "nth")
    r = r.select("conv", F.col("turn").cast("string").alias("turn"), "role", "text", (F.col("nth") == 1).alias("first"), "dropped")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        now, done, size = None, [], 0
        frame = lambda: pd.DataFrame(done, columns=[c.split()[0] for c in OUT.split(", ")])
        for batch in batches:
            for conv, turn, role, text, first, dropped in zip(*(batch[c] for c in ("conv", "turn", "role", "text", "first", "dropped"))):
                if now is None or conv != now.conv:
                    if now is not None:
                        done.append(now.result())
                        size += 300 + len(done[-1][7])
                    now = Conversation(conv, kept_bytes)
                if not dropped:
                    now.row(turn, role, text, first)
            if size > most:
                yield frame()
                done, size = [], 0
        if now is not None:
            done.append(now.result())
        if done:
            yield frame()

    out = r.mapInPandas(run, OUT)
    return out.select(F.col("conv").cast(kind).alias("conv_id"), *[c.split()[0] for c in OUT.split(", ")[1:]])


#: One step of recursion a row: (state, cost, edits, repaired lines) for each conversation, the cheapest and least per state.
SQL = r"""
WITH RECURSIVE crc AS (
  SELECT list(list_reduce([i] || [0, 0, 0, 0, 0, 0, 0, 0], lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) ORDER BY i) AS t
  FROM (SELECT unnest(range(256)) AS i)),
k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce([4294967295] || list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda x: ascii(x)::BIGINT), lambda c, x: xor(c // 256, t[xor(c, x) % 256 + 1])), 4294967295) % 20 AS kind
  FROM conversations, crc),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM k, unnest(CASE kind WHEN 0 THEN []::BIGINT[] WHEN 3 THEN [1, 2]::BIGINT[] ELSE [1]::BIGINT[] END) AS u(nth)),
c AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM d),
o AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS ini, nth,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i,
         right(regexp_replace(text, '[\x20\x09-\x0D]+$', ''), 1) AS last FROM c),
f AS (
  SELECT *, CASE WHEN last = '' THEN 'b' WHEN nth > 1 THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
         lag(ini) OVER (PARTITION BY conv_id ORDER BY i) || ini AS pair FROM o),
sums AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
         count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (pair NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM f GROUP BY conv_id),
ins(s, m, cost, e, lines) AS (VALUES
  (0, 0, 0, '', []::VARCHAR[]), (0, 2, 5, 'I', ['user:']), (0, 3, 10, 'II', ['user:', 'assistant:']),
  (1, 1, 0, '', []), (1, 2, 5, 'I', ['user:']), (1, 3, 10, 'II', ['user:', 'assistant:']),
  (2, 2, 0, '', []), (2, 3, 5, 'I', ['assistant:']), (3, 3, 0, '', []), (3, 2, 5, 'I', ['user:'])),
ed(m, e, ini, new) AS (VALUES
  (0, 'D', NULL, 0), (1, 'D', NULL, 1), (2, 'D', NULL, 2), (3, 'D', NULL, 3),
  (0, 'K', 's', 1), (0, 'K', 'u', 2), (1, 'K', 'u', 2), (2, 'K', 'a', 3), (3, 'K', 'u', 2),
  (0, 'R', NULL, 2), (1, 'R', NULL, 2), (2, 'R', NULL, 3), (3, 'R', NULL, 2)),
r AS (
  SELECT conv_id, 0::BIGINT AS i, 0 AS s, {'cost': 0::BIGINT, 'audit': '', 'lines': []::VARCHAR[]} AS x FROM sums
  UNION ALL
  SELECT r.conv_id, r.i + 1, ed.new,
         min({'cost': r.x.cost + ins.cost + CASE ed.e WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN ed.e <> 'D' AND f.fault = 't' THEN 5 ELSE 0 END,
              'audit': r.x.audit || ins.e || ed.e,
              'lines': r.x.lines || ins.lines || CASE ed.e WHEN 'D' THEN []::VARCHAR[] WHEN 'K' THEN [f.role || ':' || f.text] ELSE [CASE ed.new WHEN 3 THEN 'assistant:' ELSE 'user:' END || f.text] END})
  FROM r JOIN f ON r.conv_id IS NOT DISTINCT FROM f.conv_id AND f.i = r.i + 1 JOIN ins ON ins.s = r.s JOIN ed ON ed.m = ins.m
  WHERE (ed.e = 'D' OR f.fault NOT IN ('b', 'd')) AND (ed.ini IS NULL OR ed.ini = f.ini)
  GROUP BY r.conv_id, r.i, ed.new),
best AS (
  SELECT sums.conv_id, min({'cost': x.cost + ins.cost, 'audit': x.audit || ins.e, 'lines': x.lines || ins.lines}) AS x
  FROM r JOIN sums ON r.conv_id IS NOT DISTINCT FROM sums.conv_id AND r.i = sums.n JOIN ins USING (s) WHERE ins.m IN (0, 3) GROUP BY sums.conv_id),
every AS (SELECT DISTINCT conv_id FROM conversations)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
       coalesce(x.cost, 0)::BIGINT AS cost, coalesce(x.audit, '') AS audit, sha256(coalesce(array_to_string(x.lines, chr(10)), '')) AS repaired_sha256
FROM every LEFT JOIN sums ON every.conv_id IS NOT DISTINCT FROM sums.conv_id LEFT JOIN best ON every.conv_id IS NOT DISTINCT FROM best.conv_id
"""
