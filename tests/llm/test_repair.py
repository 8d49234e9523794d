"""Conversation repair against all edit sequences (short rows) and against a table over all nodes, and odd rows."""

from __future__ import annotations

import itertools
import random
from hashlib import sha256

import duckdb
import pytest

from tessera.llm import repair as R

#: extra columns are named like the operator's own
SCHEMA = "conv_id long, turn long, role string, text string, copy int, fault string, audit string, gaps int, edit string, place int"


def frame(spark, rows, schema=SCHEMA):
    return spark.createDataFrame([(*r, 7, "f", "K", 3, "e", 4) for r in rows], schema)


def every_repair(rows):
    """Least (cost, audit) by trying all edits of the rows with up to two inserts in each gap."""
    best = None
    for edits in itertools.product("DKR", repeat=len(rows)):
        if any(e != "D" and rows[i][0] for i, e in enumerate(edits)):
            continue
        for inserts in itertools.product(range(3), repeat=len(rows) + 1):
            cost, audit, q = 5 * sum(inserts), "", ""
            for i in range(len(rows) + 1):
                for _ in range(inserts[i]):
                    q, audit = R._NEXT[q], audit + "I"
                if i == len(rows):
                    break
                _, cut, initial = rows[i]
                audit += edits[i]
                cost += {"D": 2, "K": 5 if cut else 0, "R": 6 if cut else 1}[edits[i]]
                if edits[i] == "K":
                    q = R._KEEPS[q].get(initial)
                    if q is None:
                        break
                elif edits[i] == "R":
                    q = R._NEXT[q]
            if q in ("", "a") and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def by_table(rows):
    def inserted(labels):
        out = dict(labels)
        for _ in range(2):
            for q, (c, a) in list(out.items()):
                out[R._NEXT[q]] = min(out.get(R._NEXT[q], (1 << 60, "")), (c + 5, a + "I"))
        return out

    labels = inserted({"": (0, "")})
    for gone, cut, initial in rows:
        new = {}
        for q, (c, a) in labels.items():
            stays = c + (5 if cut else 0)
            ways = [(q, (c + 2, a + "D"))]
            if not gone:
                ways += [(R._KEEPS[q][initial], (stays, a + "K"))] if initial in R._KEEPS[q] else []
                ways.append((R._NEXT[q], (stays + 1, a + "R")))
            for z, label in ways:
                new[z] = min(new.get(z, (1 << 60, "")), label)
        labels = inserted(new)
    return min(labels[q] for q in ("", "a") if q in labels)


def random_rows(rng, n):
    rows = [(rng.random() < 0.2, rng.random() < 0.25, rng.choice(["s", "u", "u", "a", "a", "t", ""])) for _ in range(n)]
    return [(gone, cut and not gone, initial) for gone, cut, initial in rows]


def test_search_against_all_edits():
    rng = random.Random(1)
    for n in (0, 1, 2, 3, 3, 3, 4, 4):
        rows = random_rows(rng, n)
        assert R.cheapest_edits(rows) == every_repair(rows), rows


@pytest.mark.parametrize("block", [1, 3, 16, 40])
def test_search_in_blocks(monkeypatch, block):
    monkeypatch.setattr(R, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(400):
        rows = random_rows(rng, rng.randrange(0, 45))
        assert R.cheapest_edits(rows) == by_table(rows), rows


def test_report_and_rows(spark):
    rows = [
        (1, 0, "system", "S."), (1, 1, "user", "Hi."), (1, 2, "assistant", "Yes."),
        (2, 0, "user", "Hi."), (2, 1, "user", "  \n"), (2, 2, "user", "Hi."), (2, 7, "assistant", "cut off"),
        (3, None, None, None), (3, None, "user", "Q?"), (3, 4, "tool", "A!"),
        (None, 1, "user", "a."), (None, 1, "assistant", "b."), (None, 2, "user", "c."),
        (5, 1, "assistant", "x" * 300_000 + "."), (5, 1, "user", "same turn."), (6, 3, "", ""),
    ]
    got = {r.conv_id: r for r in R.repair_report(frame(spark, rows)).collect()}
    of = lambda c: tuple(got[c])[1:8]
    digest = lambda *lines: sha256("\n".join(lines).encode()).hexdigest()
    assert of(1) == (0, 0, 0, 0, 0, 0, "KKK") and got[1].repaired_sha256 == digest("system:S.", "user:Hi.", "assistant:Yes.")
    # the cut-off answer is dearer to keep (2 + 2 + 5) than to go with the question (2 + 2 + 2 + 2)
    assert of(2) == (4, 1, 1, 1, 2, 8, "DDDD") and got[2].repaired_sha256 == digest()
    assert of(3) == (0, 1, 0, 0, 2, 3, "DKR") and got[3].repaired_sha256 == digest("user:Q?", "assistant:A!")
    # equal turns by role: assistant b., user a., user c.
    assert of(None) == (0, 0, 0, 0, 1, 3, "DKR") and got[None].repaired_sha256 == digest("user:a.", "assistant:c.")
    assert of(5)[5] == 2 and of(6) == (0, 1, 0, 0, 0, 2, "D")
    fixed = [tuple(r) for r in R.repair(frame(spark, rows)).orderBy("conv_id", "place").collect() if r.conv_id == 3]
    assert fixed == [(3, 0, "K", None, "user", "Q?"), (3, 1, "R", 4, "assistant", "A!")]


def test_large_texts_wait_in_a_file(spark, monkeypatch):
    rng = random.Random(9)
    rows = [(1, k, rng.choice(["user", "assistant"]), chr(97 + k % 26) * 500 + f" {k}.") for k in range(300)]
    want = R.repair_report(frame(spark, rows)).collect()
    assert want[0].cost == by_table([(False, False, r[2][0]) for r in rows])[0]
    lines = [f"{r.role}:{r.text}" for r in R.repair(frame(spark, rows)).orderBy("place").collect()]
    assert want[0].repaired_sha256 == sha256("\n".join(lines).encode()).hexdigest()
    conversation = R._Conversation(1)
    conversation.held = __import__("tempfile").SpooledTemporaryFile(64)
    for _, turn, role, text in rows[:20]:
        conversation.add(turn, role, text)
    kept = list(conversation.repaired("K" * 20))
    assert [x[1:] for x in kept] == [r[1:] for r in rows[:20]]


def test_damage_and_empty(spark):
    rows = [(c, t, "assistant", "One. Two! Three?") for c in range(30) for t in range(30)] + [(None, None, None, None)]
    d = R.damaged(frame(spark, rows)).collect()
    import zlib
    for r in d[:200] + d[-1:]:
        key = f"{' ' if r.conv_id is None else r.conv_id}:{' ' if r.turn is None else r.turn}"
        fault = zlib.crc32(key.encode()) % 20
        assert r.present == (fault != 0) and (r.role == "user") == (fault == 4)
        assert r.text == {1: "", 2: "One Two Three"}.get(fault, "One. Two! Three?") or r.conv_id is None
    assert len(d) == len(rows) + sum(zlib.crc32(f"{c}:{t}".encode()) % 20 == 3 for c in range(30) for t in range(30)) + (
        zlib.crc32(b" : ") % 20 == 3)
    assert R.repair_report(frame(spark, [])).collect() == [] and R.repair(R.damaged(frame(spark, []))).collect() == []
    # all rows of a conversation dropped: it stays, with zeros
    gone = next((c, t) for c in range(100) for t in range(100) if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0)
    one = R.repair_report(R.damaged(frame(spark, [(*gone, "user", "Q.")]))).collect()
    assert [tuple(r) for r in one] == [(gone[0], 0, 0, 0, 0, 0, 0, "", sha256(b"").hexdigest())]


def test_query_against_sql_on_odd_rows(spark, tmp_path):
    rng = random.Random(6)
    texts = ["A.", "B?", "no end", "", " \t", None, "A.", "Tail!\n", "x."]
    rows = [(rng.choice([None, 0, 1, 2, 3, 40, 41]), rng.choice([None, *range(9)]), rng.choice(["user", "assistant", "system", None, "tool"]),
             rng.choice(texts)) for _ in range(160)]
    frame(spark, rows).write.parquet(f"{tmp_path}/conversations.parquet")
    got = R.op13_conversation_repair(spark, str(tmp_path))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW conversations AS SELECT * FROM '{tmp_path}/conversations.parquet/*.parquet'")
    want = con.sql(R.OP13_SQL)
    assert want.columns == got.columns
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(want.fetchall(), key=repr)
