"""Phrase collocations against brute force, whatever the budget and the dictionary, and odd rows."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessera.llm.collocations import collocations, subtree_counts, suffixes_of

#: extra columns are named like the operator's own
SCHEMA = "doc_id long, text string, lang string, word string, n long, code string, codes int, score string, total int, grp int, f int"


def frame(spark, rows):
    return spark.createDataFrame([(k, *r, "w", 1, "c", 2, "s", 3, 4, 5) for k, r in enumerate(rows)], SCHEMA)


def brute(rows, min_count, max_words, top):
    f, total = defaultdict(Counter), Counter()
    for text, lang in rows:
        text = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang or "und"] += len(w)
            for i in range(len(w)):
                for m in range(1, max_words + 1):
                    if i + m <= len(w):
                        f[lang or "und"][tuple(w[i:i + m])] += 1
    out = []
    for lang, c in f.items():
        found = [p for p, a in c.items() if len(p) > 1 and a >= min_count]
        inside = {q[i:i + m] for q in found for m in range(2, len(q)) for i in range(len(q) - m + 1) if c[q] >= c[q[i:i + m]]}
        scored = []
        for p in found:
            if p not in inside:
                score, k = min((1000 * c[p] * total[lang] // (c[p[:k]] * c[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -c[p], " ".join(p).encode(), c[p[:k]], c[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(scored)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def texts():
    rng = random.Random(11)
    common, rare = ["the", "of", "New", "york", "ÉTÉ", "été", "x"], [f"r{k}" for k in range(60)]
    fixed = ["New York City hall", "of the late king of the hill", "one two three four five six"]
    rows = []
    for k in range(150):
        parts = []
        for _ in range(rng.randrange(1, 14)):
            parts.append(rng.choice(fixed) if rng.random() < 0.25 else rng.choice(common if rng.random() < 0.7 else rare))
            parts.append(rng.choice([" ", " ", "  ", "\t", ", ", "\n", ". "]))
        rows.append(("".join(parts), rng.choice(["en", "en", "fr", None, "und"])))
    # nulls, empty and blank texts, a long run of one word, repeated rows, an unknown language
    rows += [(None, "en"), ("", None), (" ,;\n\t ", "fr"), ("aa " * 5000, "en"), ("a b a b a b a b", "yy")] + [("same old story told again today", "fr")] * 40
    return rows


@pytest.mark.parametrize("budget,dictionary,max_heavy", [(1_000_000, 1_000_000, 1_000_000), (320, 1_000_000, 1_000_000), (160, 5, 3)])
def test_against_brute_force(spark, budget, dictionary, max_heavy):
    rows = texts()
    got = collocations(frame(spark, rows).repartition(5), min_count=6, top=40, budget=budget, dictionary=dictionary, max_heavy=max_heavy)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 6, 5, 40)


def test_no_phrases(spark):
    assert collocations(frame(spark, [])).collect() == []
    assert collocations(frame(spark, [("a b c", "en"), (None, None)])).collect() == []


def test_products_beyond_64_bits(spark):
    """a * n * 1000 and l * r of billions: the score's arithmetic is that of exact decimals."""
    a, n, left, right = 9_000_000_000, 9_000_000_000_000, 9_100_000_000, 9_000_000_007
    row = spark.sql(f"""SELECT (CAST({a}L AS DECIMAL(19,0)) * CAST({n}L AS DECIMAL(19,0)) * 1000)
                        div (CAST({left}L AS DECIMAL(19,0)) * CAST({right}L AS DECIMAL(19,0))) AS s""").first()
    assert row.s == 1000 * a * n // (left * right)


def test_subtrees_count_what_starts_with_each_node():
    rng = np.random.default_rng(2)
    codes = rng.integers(0, 4, 3000)
    s = suffixes_of(codes, 4)
    want = Counter()
    for x in s:
        for m in range(2, 5):
            if x[m - 1]:
                want[tuple(x[:m])] += 1
    got = {tuple(c): int(n) for rows, counts in subtree_counts(s, np.zeros(len(s), np.int64), 20) for c, n in zip(rows, counts)}
    assert got == {p: n for p, n in want.items() if n >= 20}
