"""Conversation structure repair by depth-first branch and bound.

A conversation's rows, in order of their turns, get the cheapest edits after
which the initials of its roles read ``(s?(ua)+)?``: Keep (0), Rerole to user
or assistant (1), Delete (2; blank and repeated rows must go), Insert an empty
row (5); a truncated row that stays adds 5. Of equally cheap edits the ones
whose initials in order, the *audit*, are least in ASCII are taken.

* Search. A node is a row and the last kept initial. An explicit stack holds
  open nodes, the most promising on top. Suffix sums of each row's least cost
  bound from below what a node still costs; nodes that can't beat the best
  complete (cost, audit) found so far, the incumbent, are cut off. A table
  keeps the least (cost, audit) that reached each node: worse prefixes go.
  When the stack is empty, the incumbent is proved optimal.
* Long conversations are searched in blocks of ``BLOCK`` rows: of each block,
  for every initial it can end with, the least (cost, audit) is carried on.
* Conversations are shuffled by id and sorted by turn, and a task streams
  through its rows. It holds per row of one conversation its faults and the
  hash of role and text; texts wait in a temporary file beyond ``SPOOL``
  bytes. The audit and the hash of the repaired text are serial over a
  conversation, so one conversation is the work of one task.

Defined results: null roles and texts are one space, so such a text is blank;
rows of a null conv_id are one conversation; rows with equal turns (null ones
come first) are ordered by role, then text; a conversation without rows has
zeros, an empty audit and the hash of the empty string; an empty table gives
an empty result; extra columns are ignored.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, python_ready, table

BLOCK = 16
SPOOL = 8_000_000

_SPACE = " \t\n\x0b\x0c\r"
_LEGAL = {"su", "ua", "au"}
#: what stays after each last initial ("" at the start), and what an added or renamed row becomes
_KEEPS = {"": {"s": "s", "u": "u"}, "s": {"u": "u"}, "u": {"a": "a"}, "a": {"u": "u"}}
_NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}
_ROLES = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, CUT_OFF = 0, 1, 2, 5, 5


def _bounds(rows: list[tuple[bool, bool, str]]) -> list[int]:
    """Least cost of the rows from each on, once a row has been kept."""
    out = [0]
    for gone, cut, initial in reversed(rows):
        out.append(out[-1] + (DELETE if gone or cut else KEEP if initial in ("u", "a") else REROLE))
    return out[::-1]


def search(rows: list[tuple[bool, bool, str]], entries: dict[str, tuple[int, str]], last: bool) -> dict[str, tuple[int, str]]:
    """Least (cost, audit) for each initial that the rows can end with (the
    last block of a conversation must end with a or without rows), from the
    (cost, audit) of the initials before them. ``rows``: must go, truncated, initial."""
    n = len(rows)
    bound = _bounds(rows)
    # the first kept row may have the initial s for nothing
    systems = [0] * (n + 1)
    for k in range(n - 1, -1, -1):
        gone, cut, initial = rows[k]
        systems[k] = systems[k + 1] or (initial == "s" and not gone and not cut)
    ends = {"": ("", "s", "u", "a"), "s": ("s", "u", "a"), "u": ("u", "a"), "a": ("u", "a")}
    if last:
        ends = {q: ("", "a") if not q else ("a",) for q in ends}
    incumbent: dict[str, tuple[int, str]] = {}
    table = {(0, q): label for q, label in entries.items()}
    stack = sorted(((0, q, *label) for q, label in entries.items()), key=lambda x: x[2], reverse=True)

    def hopeless(k: int, q: str, cost: int, audit: str) -> bool:
        least = cost + bound[k] - (1 if not q and systems[k] else 0)
        for end in ends[q]:
            best = incumbent.get(end)
            if best is None or least < best[0] or least == best[0] and audit <= best[1]:
                return False
        return True

    while stack:
        k, q, cost, audit = stack.pop()
        if table[k, q] != (cost, audit) or hopeless(k, q, cost, audit):
            continue
        if k == n and q in ends[q] and ((cost, audit) < incumbent.get(q, (cost + 1, ""))):
            incumbent[q] = cost, audit
        grown = [(k, _NEXT[q], cost + INSERT, audit + "I")]
        if k < n:
            gone, cut, initial = rows[k]
            grown.append((k + 1, q, cost + DELETE, audit + "D"))
            if not gone:
                stays = cost + (CUT_OFF if cut else KEEP)
                kept = _KEEPS[q].get(initial)
                if kept:
                    grown.append((k + 1, kept, stays, audit + "K"))
                if kept != _NEXT[q]:
                    grown.append((k + 1, _NEXT[q], stays + REROLE, audit + "R"))
        better = []
        for node in grown:
            known = table.get(node[:2])
            if known is None or node[2:] < known:
                table[node[:2]] = node[2:]
                better.append(node)
        # the cheapest continuation is opened first
        stack += sorted(better, key=lambda x: (x[2] + bound[x[0]], x[3]), reverse=True)
    return incumbent


def cheapest_edits(rows: list[tuple[bool, bool, str]]) -> tuple[int, str]:
    """(cost, audit) of a whole conversation."""
    labels = {"": (0, "")}
    for lo in range(0, max(len(rows), 1), BLOCK):
        labels = search(rows[lo:lo + BLOCK], labels, lo + BLOCK >= len(rows))
    return min(labels.values())


class _Conversation:
    """The rows of one conversation, as they stream by."""

    def __init__(self, conv_id):
        import tempfile
        self.conv_id = conv_id
        self.rows: list[tuple[bool, bool, str]] = []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.before = None
        self.seen: set[bytes] = set()
        self.held = tempfile.SpooledTemporaryFile(SPOOL)

    def add(self, turn, role: str, text: str) -> None:
        from hashlib import blake2b
        if turn is not None:
            # sorted by turn, so equal turns are neighbours
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.rows:
            self.illegal += self.before + role[:1] not in _LEGAL
        self.before = role[:1]
        name, body = role.encode(), text.encode()
        key = blake2b(struct.pack("<q", len(name)) + name + body, digest_size=16).digest()
        words = text.rstrip(_SPACE)
        blank, again, cut = not words, key in self.seen, words[-1:] not in (".", "!", "?")
        self.seen.add(key)
        self.blank += blank
        self.duplicate += again and not blank
        self.truncated += cut and not again and not blank
        gone = blank or again
        self.rows.append((gone, cut and not gone, role[:1]))
        if not gone:
            self.held.write(struct.pack("<?qqq", turn is not None, turn or 0, len(name), len(body)) + name + body)

    def facts(self) -> tuple:
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return gaps, self.blank, self.duplicate, self.truncated, self.illegal

    def repaired(self, audit: str) -> Iterator[tuple]:
        """(edit, turn, role, text) of the rows that the audit leaves, in order."""
        self.held.seek(0)
        k, q = 0, ""
        for edit in audit:
            if edit == "I":
                q = _NEXT[q]
                yield edit, None, _ROLES[q], ""
                continue
            gone, _, initial = self.rows[k]
            k += 1
            if gone:
                continue
            known, turn, n, m = struct.unpack("<?qqq", self.held.read(25))
            role, text = self.held.read(n).decode(), self.held.read(m).decode()
            if edit == "K":
                q = initial
            elif edit == "R":
                q = _NEXT[q]
                role = _ROLES[q]
            if edit != "D":
                yield edit, turn if known else None, role, text


def _conversations(parts: Iterator) -> Iterator[_Conversation]:
    """Conversations from batches of (conv_id, turn, role, text, present), sorted."""
    now = None
    for part in parts:
        for lo in range(0, part.num_rows, 1024):
            for conv_id, turn, role, text, present in zip(*(c.to_pylist() for c in part.slice(lo, 1024).columns)):
                if now is None or now.conv_id != conv_id:
                    if now:
                        yield now
                    now = _Conversation(conv_id)
                if present:
                    now.add(turn, role, text)
    if now:
        yield now


def _sorted_rows(rows: DataFrame) -> DataFrame:
    python_ready(rows.sparkSession)
    types = {"conv_id": "long", "turn": "long", "role": "string", "text": "string"}
    space = F.lit(" ")
    d = narrow(rows, types | ({"present": "boolean"} if "present" in rows.columns else {}))
    return d.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                    (F.col("present") if "present" in d.columns else F.lit(True)).alias("present")) \
        .repartition("conv_id").sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text")


def repair_report(rows: DataFrame) -> DataFrame:
    """One row per conversation of ``rows`` (conv_id, turn, role, text): its
    gaps and faults, the cheapest edits and the SHA-256 of the repaired
    ``role:text`` lines. Rows with a false ``present`` only name their conversation."""

    def run(parts: Iterator) -> Iterator:
        from hashlib import sha256

        import pyarrow as pa
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        kinds = pa.schema([(c, pa.string() if c in names[-2:] else pa.int64()) for c in names])
        out = []
        for c in _conversations(parts):
            cost, audit = cheapest_edits(c.rows)
            digest, sep = sha256(), b""
            for _, _, role, text in c.repaired(audit):
                digest.update(sep + role.encode() + b":" + text.encode())
                sep = b"\n"
            c.held.close()
            out.append((c.conv_id, *c.facts(), cost, audit, digest.hexdigest()))
            if len(out) == 1024:
                yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), kinds)], schema=kinds)
                out = []
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), kinds)], schema=kinds)

    return _sorted_rows(rows).mapInArrow(
        run, "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place (from 0), edit, turn (null
    where inserted), role, text. A conversation that loses all rows has none."""

    def run(parts: Iterator) -> Iterator:
        import pyarrow as pa
        kinds = pa.schema([("conv_id", pa.int64()), ("place", pa.int64()), ("edit", pa.string()), ("turn", pa.int64()),
                           ("role", pa.string()), ("text", pa.string())])
        out = []
        for c in _conversations(parts):
            for place, row in enumerate(c.repaired(cheapest_edits(c.rows)[1])):
                out.append((c.conv_id, place, *row))
                if len(out) == 512:
                    yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), kinds)], schema=kinds)
                    out = []
            c.held.close()
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*out), kinds)], schema=kinds)

    return _sorted_rows(rows).mapInArrow(run, "conv_id long, place long, edit string, turn long, role string, text string")


def damaged(rows: DataFrame) -> DataFrame:
    """Seeded faults for rows (conv_id, turn, role, text), by crc32(``conv_id:turn``) % 20:
    0 drops the row (it stays with a false ``present``), 1 empties its text, 2 takes the
    ``[.!?]`` out of it, 3 repeats it, 4 makes it the user's."""
    space = F.lit(" ")
    d = narrow(rows, {"conv_id": "long", "turn": "long", "role": "string", "text": "string"})
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    d = d.withColumn("fault", F.crc32(key.cast("binary")) % 20)
    text = F.coalesce("text", space)
    return d.select(
        "conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.coalesce("role", space)).alias("role"),
        F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (F.col("fault") != 0).alias("present"),
        F.explode(F.when(F.col("fault") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("copy")).drop("copy")


# query --------------------------------------------------------------------
def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    return repair_report(damaged(table(spark, sf_dir, "conversations")))


OP13_SQL = r"""
WITH RECURSIVE h AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''),
        lambda c: ord(c)::BIGINT)), lambda a, b: list_reduce(list_prepend(xor(a, b), [0::BIGINT, 1, 2, 3, 4, 5, 6, 7]),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)), 4294967295::BIGINT) % 20 AS f FROM conversations),
d AS (SELECT conv_id, turn, CASE f WHEN 4 THEN 'user' ELSE role END AS role,
             CASE f WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text,
             unnest(CASE f WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy FROM h),
o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
             rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS t FROM d),
x AS (SELECT *, t = '' AS blank, t <> '' AND row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 AS again, substr(role, 1, 1) AS c,
             lag(substr(role, 1, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p FROM o),
r AS (SELECT *, blank OR again AS gone, NOT blank AND NOT again AND right(t, 1) NOT IN ('.', '!', '?') AS cut FROM x),
n AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank,
             count(*) FILTER (again) AS duplicate, count(*) FILTER (cut) AS truncated,
             count(*) FILTER (i > 1 AND p || c NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n FROM r GROUP BY conv_id),
q(q, z, j, added, adds) AS (VALUES ('', '', 0, [], ''), ('s', 's', 0, [], ''), ('u', 'u', 0, [], ''), ('a', 'a', 0, [], ''),
    ('', 'u', 1, ['user:'], 'I'), ('s', 'u', 1, ['user:'], 'I'), ('u', 'a', 1, ['assistant:'], 'I'), ('a', 'u', 1, ['user:'], 'I'),
    ('', 'a', 2, ['user:', 'assistant:'], 'II'), ('s', 'a', 2, ['user:', 'assistant:'], 'II')),
e(q, w, z) AS (VALUES ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('u', 'a', 'a'), ('a', 'u', 'u')),
s AS (
  SELECT conv_id, 0::BIGINT AS i, z AS q, {'cost': 5 * j, 'audit': adds, 'out': added::VARCHAR[]} AS b FROM n, q WHERE q.q = ''
  UNION ALL
  SELECT conv_id, i, q, min(b) AS b FROM (
    SELECT m.conv_id, m.i, q.z AS q, {'cost': m.cost + 5 * q.j, 'audit': m.audit || q.adds, 'out': m.out || q.added::VARCHAR[]} AS b
    FROM (
      SELECT s.conv_id, r.i, s.q, s.b.cost + 2 AS cost, s.b.audit || 'D' AS audit, s.b.out AS out
      FROM s JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1
      UNION ALL
      SELECT s.conv_id, r.i, e.z, s.b.cost + CASE WHEN r.cut THEN 5 ELSE 0 END, s.b.audit || 'K', list_append(s.b.out, r.role || ':' || r.text)
      FROM s JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1 JOIN e ON e.q = s.q AND e.w = r.c WHERE NOT r.gone
      UNION ALL
      SELECT s.conv_id, r.i, e.z, s.b.cost + 1 + CASE WHEN r.cut THEN 5 ELSE 0 END, s.b.audit || 'R',
             list_append(s.b.out, CASE e.w WHEN 'u' THEN 'user:' ELSE 'assistant:' END || r.text)
      FROM s JOIN r ON r.conv_id IS NOT DISTINCT FROM s.conv_id AND r.i = s.i + 1 JOIN e ON e.q = s.q AND e.w <> 's' WHERE NOT r.gone) m JOIN q ON q.q = m.q)
  GROUP BY conv_id, i, q),
f AS (SELECT s.conv_id, min(s.b) AS b FROM s JOIN n ON n.conv_id IS NOT DISTINCT FROM s.conv_id AND n.n = s.i WHERE s.q IN ('', 'a') GROUP BY s.conv_id)
SELECT k.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
       coalesce(illegal, 0) AS illegal, coalesce(f.b.cost, 0)::BIGINT AS cost, coalesce(f.b.audit, '') AS audit,
       sha256(coalesce(array_to_string(f.b.out, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) k LEFT JOIN n ON n.conv_id IS NOT DISTINCT FROM k.conv_id
     LEFT JOIN f ON f.conv_id IS NOT DISTINCT FROM k.conv_id"""
