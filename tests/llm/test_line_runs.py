"""Line dedup against brute force, on odd rows, by both ways of dropping, and its runs."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tessera.llm.line_runs import LineRuns, drop_repeated_lines

SPACE = " \t\n\x0b\x0c\r"
#: extra columns are named like the operator's own
SCHEMA = "doc_id long, text string, n long, hi string, lo double, batch string, t0 int, gone string, n_lines string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 1, "h", 0.5, "b", 2, "g", "x") for r in rows], SCHEMA)


def lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def brute(rows, min_docs):
    split = [(i, (t or "").split("\n")) for i, t in rows]
    count = Counter(k for _, lines in split for k in {lower(x).strip(SPACE) for x in lines} if k)
    out = []
    for i, lines in split:
        kept = [x for x in lines if count[lower(x).strip(SPACE)] < min_docs]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out, key=repr)


def sample():
    rng = random.Random(3)
    lines = [f"Line {k} é" for k in range(40)] + ["", "  ", "\t", "x", "É", "é", "İ", " pad ", "end\r"]
    rows = []
    for i in range(120):
        some = [rng.choice(lines[:8] if rng.random() < 0.3 else lines) for _ in range(rng.randrange(0, 12))]
        rows.append((i, "\n".join((x.upper() if rng.random() < 0.2 else x) + rng.choice(["", " ", "\t", "\r"]) for x in some)))
    # nulls, empty and blank texts, repeated rows, a long text, a line that one document repeats
    rows += [(500, None), (501, ""), (502, "\n\n"), (None, "Line 1 é"), (503, "copy\nmine"), (503, "copy\nmine"),
             (504, "w\n" * 30_000), (505, "only here\n" * 50 + "once")]
    return rows


@pytest.mark.parametrize("way", [2_000_000, 0])
@pytest.mark.parametrize("batches,fanout,min_docs", [(1, 2, 10), (5, 2, 3)])
def test_dropped_lines_against_brute_force(spark, way, batches, fanout, min_docs):
    rows = sample()
    docs = frame(spark, rows).repartition(9)
    got = drop_repeated_lines(docs, min_docs, batches, fanout, broadcast_keys=way)
    assert got.columns == ["doc_id", "n_lines", "n_dropped", "text"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, min_docs)


def test_no_documents(spark):
    assert drop_repeated_lines(frame(spark, [])).collect() == []


def test_runs_are_levelled_and_mark_a_key_once(spark):
    runs = LineRuns(spark, min_docs=4, fanout=2)
    seen = Counter()
    rng = random.Random(1)
    for turn in range(1, 8):
        batch = [(rng.randrange(12), 0, rng.randrange(1, 3)) for _ in range(6)]
        for k, _, n in batch:
            seen[k] += n
        runs.add(spark.createDataFrame(batch, "hi long, lo long, n long"))
        # two runs of a level become one of the next: as the binary digits of the batches so far
        assert [len(x) for x in runs.levels] == [turn >> k & 1 for k in range(len(runs.levels))]
        assert sorted(r.hi for r in runs.repeated().collect()) == sorted(k for k, n in seen.items() if n >= 4)
    sorted_run = spark.table(runs.runs()[-1])
    plan = sorted_run.join(sorted_run.select("hi", "lo", F.col("n").alias("m")).hint("merge"), ["hi", "lo"])
    assert "Exchange" not in plan._jdf.queryExecution().executedPlan().toString()
    runs.close()
    assert runs.runs() == []
