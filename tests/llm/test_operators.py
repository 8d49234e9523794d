"""Small cases of each operator: nulls, empty and long texts, ties and
repeated rows, empty tables, clashing extra columns, and brute force."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm.components import components
from tessera.llm.html_blocks import extract_html, main_text
from tessera.llm.licenses import OP4_SQL, TEMPLATES, scan_licenses
from tessera.llm.mixing import mix, mixed_documents, permute, shard_counts, taken_words, targets
from tessera.llm.ngram_join import LIST, one_of_each, similar_sets
from tessera.llm.pieces import decode_pieces, encode_pieces, pieces, round_trip
from tessera.llm.quality_pu import class_prior, classify
from tessera.llm.quality_rules import quality_rules
from tessera.llm.rp_forest import LEAF, SAMPLE, THRESHOLD, TREES, Forest, near_vectors
from tessera.llm.toxicity import Lexicon, score_toxicity
from tessera.llm.url_templates import url_filter

SF = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, source string, n long, cls string, m double, score string, id string, token string"


def docs_frame(spark, rows):
    """(doc_id, text, source) rows with extra columns named like the operators' own."""
    return spark.createDataFrame([(*r, 1, "c", 0.5, "s", "i", "t") for r in rows], DOCS)


ODD = [(1, None, "a"), (2, "", None), (3, "   \n\t ", "b"), (4, "one", "a"), (4, "one", "a"), (None, "some words here now", "b"),
       (5, "w " * 30_000, "a")]


def brute_components(sets, percent):
    ids = list(sets)
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for k, i in enumerate(ids):
        for j in ids[k + 1:]:
            inter = len(sets[i] & sets[j])
            if inter and 100 * inter >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                parent[max(a, b)] = min(a, b)
    return {i: find(i) for i in ids}


def word_shingles(text, n):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return {tuple(w)} if 0 < len(w) < n else set(zip(*[w[k:] for k in range(n)]))


# 1 ------------------------------------------------------------------------
def test_similar_sets_against_brute_force(spark):
    rng = random.Random(5)
    vocabulary = [f"w{k}" for k in range(400)]
    common = [rng.choice(vocabulary) for _ in range(60)]
    rows, texts = [], []
    for k in range(30):                                   # families of different closeness
        base = [rng.choice(vocabulary) for _ in range(rng.choice((5, 40, 150)))] + (common if k % 3 == 0 else [])
        for _ in range(rng.choice((1, 2, 6))):
            w = list(base)
            for _ in range(rng.choice((0, 1, 2, 6))):
                w[rng.randrange(len(w))] = rng.choice(vocabulary)
            texts.append(" ".join(w))
    base = [rng.choice(vocabulary) for _ in range(120)]
    for _ in range(3 * LIST):                             # a family with lists beyond LIST
        w = list(base)
        for _ in range(rng.choice((0, 1, 2, 3, 4))):
            w[rng.randrange(len(w))] = f"x{rng.randrange(10 ** 6)}"
        texts.append(" ".join(w))
    texts += ["Only Three words", "only three WORDS", "", "  "]
    rows = [(i, t, "a") for i, t in enumerate(texts)]
    sets = {i: word_shingles(t, 4) for i, t, _ in rows}
    want = brute_components(sets, 85)
    got = similar_sets(docs_frame(spark, rows)).collect()
    assert {r.doc_id: r.component_id for r in got} == want
    assert all(r.n_shingles == len(sets[r.doc_id]) for r in got)


def test_similar_sets_odd_rows(spark):
    got = [tuple(r) for r in similar_sets(docs_frame(spark, ODD)).collect()]
    assert len(got) == len(ODD)
    assert (1, 0, 1) in got and (2, 0, 2) in got and (3, 0, 3) in got and (None, 1, None) in got
    assert got.count((4, 1, 4)) == 2 and (5, 1, 5) in got
    assert similar_sets(docs_frame(spark, [])).count() == 0
    kept = one_of_each(docs_frame(spark, [(7, "a b c d e f", "x"), (9, "A B c d e f", "y"), (8, None, "z")]))
    assert sorted(r.doc_id for r in kept.collect()) == [7, 8] and len(kept.columns) == 9


def test_components(spark):
    links = spark.createDataFrame([(1, 2), (3, 2), (9, 8), (4, 3), (8, 10), (5, 5), (None, 3), (2, 1)], "a long, b long")
    assert {r.id: r.component for r in components(links).collect()} == {1: 1, 2: 1, 3: 1, 4: 1, 8: 8, 9: 8, 10: 8}


# 2 ------------------------------------------------------------------------
def test_url_filter(spark):
    bad = [(i, f"http://h.example.net/shop/{i}.html", i) for i in range(60)]
    good = [(100 + i, f"http://h.example.net/news/{i}.html", 100 + i) for i in range(60)]
    odd = [(300, None, None), (301, "no scheme", None), (302, "x://A.Org", None), (303, "x://a.example.org/es/1?q", None),
           (304, "x://EXAMPLE.org/en/1#z", None), (305, "x://notexample.com/de/", None), (305, "x://notexample.com/de/", None)]
    urls = spark.createDataFrame([(*r, "z") for r in bad + good + odd], "page_id long, url string, label_id long, host string")
    labels = spark.createDataFrame([(i, 0) for i in range(60)] + [(100 + i, 1) for i in range(60)], "label_id long, good int")
    got = {r.page_id: r for r in url_filter(urls, labels).collect()}
    assert all(got[i].verdict == "block" and got[i].template == "/shop/*" for i in range(60))
    assert all(got[100 + i].verdict == "allow" for i in range(60))
    assert (got[300].host, got[300].path, got[300].rule, got[300].verdict) == ("", "", None, "allow")
    assert (got[301].host, got[302].host, got[302].rule) == ("", "a.org", None)      # an empty path starts with no rule's
    assert (got[303].rule, got[303].verdict) == ("example.org/es/", "block")
    assert (got[304].rule, got[305].rule) == ("example.org/en/1", "com/de/")
    assert url_filter(urls.limit(0), labels).count() == 0
    assert url_filter(urls, labels.limit(0)).where("verdict = 'block' AND rule IS NULL").count() == 0


def test_url_filter_on_deep_paths(spark):
    rows = [(i, f"http://h.example.net/a/b/2024/05/{'casino' if i % 2 else 'news'}-x/{i}", i) for i in range(120)]
    rows += [(200 + i, "http://h.example.net" + path, None) for i, path in enumerate(("/a/b/c/d/e/f/g", "/a/b/c/d/e/f/g/", "//", "/a//b///c", "/" + "z/" * 50))]
    urls = spark.createDataFrame(rows, "page_id long, url string, label_id long")
    labels = spark.createDataFrame([(i, 1 - i % 2) for i in range(120)], "label_id long, good int")
    got = {r.page_id: r for r in url_filter(urls, labels).collect()}
    assert len(got) == 125
    assert all((got[i].template, got[i].verdict, got[i].n_urls) == (
        ("/*/*/*/*/casino-x/*", "block", 60) if i % 2 else ("/*/*/*/*/news-x/*", "allow", 60)) for i in range(120))
    assert [got[200 + i].template for i in range(5)] == ["/*" * 7, "/*" * 7, "", "/*" * 3, "/*" * 50]


def test_similar_siblings_merge(spark):
    """Two branches all bad, two all good, one between: three templates; equal urls of 2,000 segments grow few levels."""
    rows, labels, i = [], [], 0
    for branch, share in (("a", 0), ("b", 0), ("c", 100), ("d", 100), ("e", 60)):
        for k in range(100):
            rows.append((i, f"http://h.net//{branch}/{k}", i))
            labels.append((i, int(k < share)))
            i += 1
    rows += [(i + k, "http://h.net" + "/z" * 2000, k if k % 2 else 200 + k) for k in range(30)]
    urls = spark.createDataFrame(rows, "page_id long, url string, label_id long")
    made = url_filter(urls, spark.createDataFrame(labels, "label_id long, good int"))
    got = {(r.template, r.verdict, r.n_urls, r.n_good) for r in made.collect()}
    assert got == {("/{a+1}/*", "block", 200, 0), ("/{c+1}/*", "allow", 200, 200), ("/*/*", "allow", 100, 60),
                   ("/*" * 2000, "allow", 30, 15)}


# 3 ------------------------------------------------------------------------
def test_permutations_and_shards():
    for n in (1, 2, 3, 64, 1000):
        got = permute(np.arange(n, dtype=np.uint64), np.full(n, n, np.uint64), np.full(n, 9, np.uint64))
        assert sorted(got.tolist()) == list(range(n))
    slots = np.array([100, 3, 5000, 0, 77])
    total = np.zeros(5, int)
    for shard, offset, counts in shard_counts(slots, range(-(-5180 // 64)), 64, 5):
        assert (offset == total).all()
        total += counts
    assert (total == slots).all()
    every = {s: (tuple(o), tuple(c)) for s, o, c in shard_counts(slots, range(81), 64, 5)}
    assert all(every[s] == (tuple(o), tuple(c)) for s, o, c in shard_counts(slots, [3, 80], 64, 5))


def brute_targets(sizes, weights=(5, 2, 1)):
    names = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    w = {s: weights[k % 3] for k, s in enumerate(names)}
    total, target, free = sum(sizes.values()), {}, set(names)
    while free:
        left = total - sum(target.values())
        share = {s: left * w[s] / sum(w[x] for x in free) for s in free}
        over = [s for s in free if share[s] > 3 * sizes[s]]
        if not over:
            return target | share
        for s in over:
            target[s] = 3.0 * sizes[s]
        free -= set(over)
    return target


def test_mix(spark):
    rng = random.Random(1)
    rows = [(i, " ".join("w" * rng.randint(1, 4) for _ in range(rng.choice((0, 3, 50, 700)))), rng.choice(("a", "b", "c", None, "é")))
            for i in range(300)] + [(1000, "x y\nz", "tiny"), (1000, "x y\nz", "tiny"), (1001, None, "none")]
    d = docs_frame(spark, rows)
    planned = mix(d)
    got = taken_words(*planned).collect()
    assert len(got) == len(rows)
    sizes = Counter()
    for _, t, s in rows:
        sizes[s] += len(WORD.findall(t or ""))
    want = brute_targets(dict(sizes))
    by = Counter()
    for r in got:
        assert 0 <= r.taken <= 3 * r["size"] and r.source_size == sizes[r.source] and abs(r.target - want[r.source]) < 1e-6
        by[r.source] += r.taken
    assert all(abs(by[s] - want[s]) <= 65 for s in sizes)
    again = taken_words(*mix(d)).collect()
    key = lambda r: (r.doc_id, r.source or "", r.taken)
    assert sorted(map(key, got)) == sorted(map(key, again))
    texts = mixed_documents(d.where("doc_id < 1000"))
    assert texts.columns == d.columns
    words = Counter()
    for r in texts.collect():
        words[r.doc_id] += len(WORD.findall(r.text))
    assert words == Counter({r.doc_id: r.taken for r in taken_words(*mix(d.where("doc_id < 1000"))).collect() if r.taken})
    # every slot of a shard once; every pass over a source takes each block once
    slots = planned[2].collect()
    assert len({(r.shard, r.slot) for r in slots}) == len(slots)
    assert taken_words(*mix(d.limit(0))).count() == 0


def test_targets_are_capped(spark):
    s = spark.createDataFrame([("a", 10, 1), ("b", 1000, 1), (None, 0, 1)], "source string, source_size long, n_docs long")
    assert {r.source: r.target for r in targets(s).collect()} == {"a": 30.0, "b": 980.0, None: 0.0}


# 4 ------------------------------------------------------------------------
def test_licenses(spark):
    long = "word " * 5000 + "THIS is free and unencumbered software, released into the public domain! " + "more " * 5000
    rows = [(1, "Text.\nReleased under the MIT License.\nEnd", "a"), (2, "licensed under cc by-nc 4.0", "a"), (3, None, "a"), (4, "", "a"),
            (5, long, "a"), (6, "mit license under released the", "a"), (1, "Text.\nReleased under the MIT License.\nEnd", "a"),
            (7, "Licensed under the Apache License, Version 3.0 alpha", "b")]
    got = sorted((r.doc_id, r.license, r.n_found) for r in scan_licenses(docs_frame(spark, rows)).collect())
    assert got == [(1, "MIT", 3), (1, "MIT", 3), (2, "CC-BY-NC-4.0", 5), (5, "Unlicense", 9)]     # 7: 4 of 6 shingles
    assert scan_licenses(docs_frame(spark, [])).count() == 0


def test_every_notice_names_its_license_alone(spark):
    """Each template in a text of its own, then notices that share most of their shingles, together and damaged."""
    import duckdb

    rows = [(i, f"Read me. {text} More words follow here.", "a") for i, (_, text) in enumerate(TEMPLATES)]
    want = {i: {name} for i, (name, _) in enumerate(TEMPLATES)}
    gpl, lgpl, agpl = (next(t for n, t in TEMPLATES if n == name and len(t) > 120) for name in ("GPL", "LGPL", "AGPL"))
    rows += [(100, gpl + "\nand also\n" + lgpl, "a"), (101, lgpl.replace("GNU", "G N U", 1), "a"), (102, agpl + " " + gpl, "a"),
             (103, "x " * 9000 + lgpl.upper(), "a")]
    want |= {100: {"GPL", "LGPL"}, 101: {"LGPL"}, 102: {"AGPL", "GPL"}, 103: {"LGPL"}}
    found = scan_licenses(docs_frame(spark, rows)).collect()
    got = {}
    for r in found:
        got.setdefault(r.doc_id, set()).add(r.license)
    assert got == want
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", [r[:2] for r in rows])
    assert sorted(con.sql(OP4_SQL).fetchall()) == sorted((r.doc_id, r.license, r.template, r.n_shingles, r.n_found) for r in found)


# 5 ------------------------------------------------------------------------
def test_pieces_round_trip(spark):
    texts = [None, "", " ", "Hello  world\n x", " é▁▁ 日本 😀\x00", "a" * 3000 + "\t\r\n", "ab " * 9000, "Hello  world\n x"]
    rows = [(k if k else None, t, "a") for k, t in enumerate(texts)] + [(3, texts[3], "b")]
    enc = encode_pieces(docs_frame(spark, rows))
    got = decode_pieces(enc).collect()
    assert len(got) == len(rows) and all(r.decoded == r.text for r in got)
    assert all((r.ids is None) == (r.text is None) and r.n_ids == len(r.ids or []) for r in got)
    assert len({tuple(r.ids) for r in got if r.doc_id == 3}) == 1
    parts = {(r.doc_id, tuple(r.ids or [])) for r in enc.repartition(5).collect()}
    assert parts == {(r.doc_id, tuple(r.ids or [])) for r in got}
    assert round_trip(docs_frame(spark, rows)).where("lossless").count() == len(rows)
    assert round_trip(docs_frame(spark, [])).count() == 0


def test_sampled_segmentations_follow_the_lattice():
    p = pieces("/opt/tokenizers/piece_bpe_32k.model", 1.0)
    vocabulary = {p.raw[i].as_py().decode(): i for i in range(259, len(p.raw)) if p.raw[i].as_py()}

    def ways(s):
        if not s:
            yield ()
        for k in range(1, len(s) + 1):
            if s[:k] in vocabulary:
                yield from ((vocabulary[s[:k]], *rest) for rest in ways(s[k:]))

    weight = {w: math.exp(sum(p.log_weight[i] for i in w)) for w in ways(" than")}
    n = 20_000
    ids, counts = p.encode(["than"] * n, np.arange(n), 5)
    ends = np.cumsum(counts)
    seen = Counter(tuple(ids[a:b].tolist()) for a, b in zip(ends - counts, ends))
    for w, x in weight.items():
        share = x / sum(weight.values())
        assert abs(seen[w] / n - share) < 5 * math.sqrt(share * (1 - share) / n) + 1e-4


def test_lattice_edges_are_numbered_as_found(monkeypatch):
    p = pieces("/opt/tokenizers/piece_bpe_32k.model", 1.5)
    vocabulary = {p.raw[i].as_py().decode(): i for i in range(259, len(p.raw)) if p.raw[i].as_py()}
    rnd = random.Random(4)
    units = list({"".join(rnd.choices("thean ingé日\x00😀", k=rnd.randint(1, 12))) for _ in range(200)}) + ["a" * 90, "\n", "  "]
    sizes = []
    search = np.searchsorted
    monkeypatch.setattr(np, "searchsorted", lambda a, v, **k: sizes.append(len(a)) or search(a, v, **k))
    length, first, keys, code, back = p.lattice(units)
    assert max(sizes, default=0) <= len(units)              # neither the vocabulary nor the edges are searched
    node = 0
    for unit in units:
        for end in range(1, len(unit) + 1):
            want = [(vocabulary[unit[end - n:end]], n) for n in range(1, end + 1) if unit[end - n:end] in vocabulary]
            if unit[end - 1] not in vocabulary:
                c = ord(unit[end - 1])
                want.insert(0, (int(p.byte_ids[c]) if c < 128 else -1 - c, 1))
            stop = first[node + 1] if node + 1 < len(first) else len(code)
            assert list(zip(code[first[node]:stop].tolist(), back[first[node]:stop].tolist())) == want
            assert (np.diff(keys[first[node]:stop]) >= 0).all() and keys[stop - 1] == np.inf
            node += 1
    assert node == length.sum() == len(first)


# 6, 7 -----------------------------------------------------------------------
def test_class_prior():
    rng = np.random.default_rng(0)
    p = rng.normal(0, 1, (2000, 2))
    u = np.vstack([rng.normal(0, 1, (3500, 2)), rng.normal(4, 1, (1500, 2))])
    assert abs(class_prior(p, u) - 0.7) < 0.08


def test_classifiers_on_odd_rows(spark):
    labels = spark.createDataFrame([(1, 1, 0, "x"), (4, 0, 1, "y"), (4, 1, 0, "z"), (None, 1, 1, "n"), (5, None, None, "u")],
                                   "doc_id long, quality int, toxic int, text string")
    for run in (classify, score_toxicity):
        for lab in (labels, labels.limit(0)):
            got = run(docs_frame(spark, ODD), lab).collect()
            assert len(got) == len(ODD) and all(0 <= r.score <= 1 and r.predicted in (0, 1) and r.held_out is not None for r in got)
        assert run(docs_frame(spark, []), labels).count() == 0


@pytest.mark.parametrize("name,column,least", [("op6_quality_classifier", "quality", 0.95), ("op7_toxicity", "toxic", 0.93)])
def test_held_out_accuracy(spark, name, column, least):
    from tessera.llm.common import table
    from tessera.llm.queries import QUERIES
    got = QUERIES[name](spark, SF).join(table(spark, SF, "labels"), "doc_id").where("held_out")
    share = got.agg(F.avg((F.col("predicted") == F.col(column)).cast("double"))).first()[0]
    assert share >= least


def test_lexicon_finds_misspellings_and_quotations():
    lex = Lexicon({"idiot": 8.0, "scum": 8.0}, {"vequ": 8.0}, frozenset({"idiom"}))

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            row, left = [i], row
            for j, y in enumerate(b, 1):
                row.append(min(left[j] + 1, row[-1] + 1, left[j - 1] + (x != y)))
        return row[-1]

    rng = random.Random(2)
    for _ in range(3000):
        w = "".join(rng.choice("idotx") for _ in range(rng.randint(3, 7)))
        assert (lex.misspelt(w) > 0) == (edits(w, "idiot") <= 1), w
    assert lex.weight("vequxyz") == 8.0 and lex.weight("idiom") == 0.0 and lex.weight("scam") == 0.0
    abuse, quote = lex.score("you are an IDIOT, go")[0], lex.score('they said "idiot" once')[0]
    assert abuse > 0.9 and quote < 0.5 and lex.score("an idiqt here")[0] > 0.5 and lex.score(None) == lex.score("fine")


# 8 ------------------------------------------------------------------------
def brute_rules(text):
    w = WORD.findall(text or "")
    windows = Counter(tuple(w[i:i + 5]) for i in range(len(w) - 4))
    inside = {i + k for i in range(len(w) - 4) if windows[tuple(w[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, len(inside)


def test_quality_rules(spark):
    rng = random.Random(3)
    texts = [None, "", "a b c d e", "a " * 40, "x#y <b> | & $\n\nx#y <b> | & $\n \n", "é ü\x0bß\x0c\r\n" * 4, "the of and " * 2000]
    texts += ["".join(rng.choice(("a ", "b ", "c\n", "the\t", "## ")) for _ in range(rng.randint(1, 120))) for _ in range(200)]
    got = quality_rules(docs_frame(spark, [(i, t, "s") for i, t in enumerate(texts)])).collect()
    for r in got:
        want = brute_rules(texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, texts[r.doc_id]
        assert r.base_failed == (want[0] < 10 or 100 * want[4] > 20 * want[0]) and not (r.base_failed and r.kept)
    assert quality_rules(docs_frame(spark, [])).count() == 0


# 9 ------------------------------------------------------------------------
PAGE = """<html><head><title>T</title></head><body><header>Site</header><nav><a href="/a">A</a></nav>
<div class="cookie-notice">We use the cookies of the site and of the others.</div>{body}
<aside>More of the same</aside><div id="comments"><p>First the worst</p></div><form>Mail <input></form>
<script>var a="<p>no</p>";</script><footer>&copy; all</footer>"""


def test_html():
    article = "<article><h1>Head &amp; tail</h1><p>One\n  two<br>three &eacute;<p>Short.<div class=ad>Buy</div><p><a href='x>y'>Link</a> text goes on</article>"
    assert main_text(PAGE.format(body=article)) == "Head & tail\nOne two three é\nShort.\nLink text goes on"
    prose = "It was the best of the times and it was the worst of the times for all that were in it, as the book of the two cities says at the start of it."
    bare = f"<div><h2>Two cities</h2><p>{prose}</p><p>So it goes.</p><p>{prose}</p></div>"
    assert main_text(PAGE.format(body=bare)) == f"Two cities\n{prose}\nSo it goes.\n{prose}"
    for odd in (None, "", "<", "<!-- never", "<p", "<script>x", "<a b='>", "</p></div>"):
        assert isinstance(main_text(odd), str)
    assert main_text("just words & more") == "just words & more"
    assert len(main_text("<article>" + "<p>long text</p>" * 20_000)) == 20_000 * 10 - 1


def _plain_labels(found):
    """The two passes once more, block by block: every neighbour is looked at."""
    from tessera.llm import html_blocks as H
    main = any(m and not bad for _, _, bad, m, _ in found)
    region = [b for b in found if not main or (b[3] and not b[2])]

    def share(t):
        w = [x.strip(".,;:!?%*#&$|\"'()") for x in t.lower().split()]
        return sum(x in H.STOP_WORDS for x in w) / len(w)

    def dense(k):
        return 0 <= k < len(region) and region[k][1] > 0.5 * len(region[k][0])

    known = any(share(b[0]) >= 0.12 for k, b in enumerate(region) if not b[2] and not dense(k) and len(b[0]) >= 140)
    first = {}
    for k, (text, _, bad, _, heading) in enumerate(region):
        menu = any(all(dense(j) for j in range(s, s + 3)) for s in range(k - 2, k + 1))
        if bad or dense(k) and not (main and (heading or not menu or share(text) >= 0.12)):
            first[k] = False
        elif not dense(k) and not heading and len(text) >= (40 if main else 140):
            if share(text) >= 0.12 or not known:
                first[k] = True
            elif not main and share(text) < 0.04:
                first[k] = False
    kept = []
    for k in range(len(region)):
        near = min((abs(k - j) for j in first), default=0)
        kept.append(not first or any(v for j, v in first.items() if abs(k - j) == near))
    return "\n".join(b[0] for b, good in zip(region, kept) if good)


def test_html_passes_equal_plain_ones_on_given_pages(spark):
    """All given pages as they are and with their main elements' names blanked out."""
    from tessera.llm import html_blocks as H
    pages = [r[0] for r in spark.read.parquet(f"{SF}/pages.parquet").select("html").collect() if r[0]]
    for page in pages:
        blank = re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", page)
        for html in (page, blank):
            assert H.main_text(html) == _plain_labels(H.blocks(html))
    # without the names, articles keep most of their text
    whole = sum(len(H.main_text(page)) for page in pages)
    kept = sum(len(H.main_text(re.sub(r"<(/?)(?:article|main)\b[^>]*>", r"<\1div>", page))) for page in pages)
    assert 0.9 * whole < kept <= 1.1 * whole, kept / whole


def test_html_densities_decide_inside_main():
    from tessera.llm.html_blocks import main_text
    prose = "It was the best of the times and it was the start of it all, as they said in the town."
    menu = "".join(f"<li><a href=x>Topic {k}</a></li>" for k in range(4))
    assert main_text(f"<main><ul>{menu}</ul><h1>Head</h1><p>{prose}</p><p>End</p></main>") == f"Head\n{prose}\nEnd"
    assert main_text(f"<main><p>{prose}</p><ul>{menu}</ul><p>{prose}</p></main>") == f"{prose}\n{prose}"
    # one or two links are text; a linked heading too; nothing decided: all stays
    assert main_text(f"<main><h1><a href=x>Head</a></h1><p>{prose}</p><p><a href=x>More</a></p></main>") == f"Head\n{prose}\nMore"
    assert main_text("<main><p>Одна строка</p><p>Ещё одна</p></main>") == "Одна строка\nЕщё одна"
    # an advert inside the main element takes no neighbour with it
    assert main_text(f"<main><p>Hi</p><div class=ad>Buy the thing</div><p>{prose}</p></main>") == f"Hi\n{prose}"
    # a language without listed stop words, no main element
    other = "Слово за слово и ещё слово, так и дальше по строке до самого конца абзаца, " * 3
    assert main_text(f"<nav>Меню</nav><div><p>{other}</p></div>") == " ".join(other.split())


def test_html_keeps_whole_articles():
    prose = "It was the best of the times and it was the worst of the times for all that were in it, as the book of the two cities says at the start of it."
    # a head, title or textarea without its closing tag; head's own text is none of the page's
    assert main_text(f"<html><head><title>T</title><body><article><p>{prose}</article>") == prose
    assert main_text(f"<html><head><title>T</title><p>{prose}") == prose
    assert main_text(f"<html><head><title>T<body><article><p>{prose}</article>") == prose
    assert main_text(f"<head><title>T</title><noscript>off</noscript></head>{prose}") == prose
    assert main_text(f"<article><p>One <textarea>two<p>{prose}</article>") == f"One\n{prose}"
    # self-closed elements are empty
    for lone in ("<svg/>", "<math />", "<svg><path class='ad'/></svg>", "<script src='x'/>", "<template/>", "<canvas/>"):
        assert main_text(f"<article><p>One{lone} two</p><p>{prose}</p><svg><title>Icon</title></svg></article>") == f"One two\n{prose}"
    # text of math, object, canvas, noscript and svg
    assert main_text("<article><p>If <math><mi>x</mi><mo>=</mo><mn>1</mn></math> then <object>o</object> <canvas>c</canvas> <svg><text>s</text></svg>"
                     "<noscript>n</noscript></p></article>") == "If x=1 then o c sn"
    assert main_text("<article><p>a<script>x</script><style>y</style></p><template><p>z</p></template></article>") == "a"
    # names on what holds the main element, or all long text
    for holder in ("div class='page has-sidebar'", "div id=header-fixed"):
        assert main_text(f"<{holder}><nav>Menu</nav><article class='share-buttons-off'><p>{prose}</p><div class=ad>Buy</div></article></div>") == prose
        assert main_text(f"<{holder}><main class=no-banner><p>{prose}</main></div>") == prose
        assert main_text(f"<{holder}><p>{prose}</p><div class=comments><p>Me too.</p></div></div>") == prose
    assert main_text(f"<article><p>{prose}</p></article><div id=comments><article><p>Me too.</p></article></div>") == prose
    assert main_text(f"<div><p>{prose}</p></div><div class=sidebar><article><p>Teaser</p></article></div>") == prose
    # links are text of an article
    assert main_text(f"<article><p>{prose}</p><ul><li><a href=x>Source</a></li></ul></article>") == f"{prose}\nSource"
    assert main_text("<textarea>" * 20_000 + "x") == ""
    assert main_text("<div class=ad><article class=ad>a" * 5_000) == "a"      # the rest is in adverts


def test_html_frame(spark):
    pages = spark.createDataFrame([(1, "u", "<article><p>a</p></article>", "x"), (2, None, None, "y"), (2, None, None, "y")],
                                  "page_id long, url string, html string, text string")
    assert sorted((r.page_id, r.text, r.n_chars) for r in extract_html(pages).collect()) == [(1, "a", 1), (2, "", 0), (2, "", 0)]
    assert extract_html(pages.limit(0)).count() == 0


# 10 -----------------------------------------------------------------------
def test_near_vectors_against_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((900, 16))
    for k in range(0, 300, 3):
        x[k + 1] = x[k] + rng.normal(0, 0.05, 16)
        x[k + 2] = x[k] * 2
    x[600:700] = x[600]
    x[700:760] = x[601] + rng.normal(0, 0.04, (60, 16))
    rows = [(i, v.tolist(), 1, "e") for i, v in enumerate(x)]
    odd = [(2000, None, 0, "n"), (2001, [0.0] * 16, 0, "z"), (2002, [1.0, None] + [0.0] * 14, 0, "m"),
           (2003, [float("nan")] * 16, 0, "f"), (2004, [1.0, 2.0], 0, "d"), (None, [1.0] * 16, 0, "i"), (2005, [], 0, "s")]
    v = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>, label int, links string")
    got = {r.vec_id: r for r in near_vectors(v, leaf=64).collect()}
    assert len(got) == 907
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    near = unit @ unit.T >= 0.95
    np.fill_diagonal(near, False)
    found, want = sum(got[i].n_links for i in range(900)), int(near.sum())
    assert 0.9 * want <= found <= want
    assert all(got[i].n_links <= near[i].sum() for i in range(900))
    whole = {r.vec_id: r for r in near_vectors(v).collect()}          # one leaf: exact
    label = np.arange(900)
    while True:
        new = np.minimum(label, np.where(near, label[None, :], 900).min(axis=1))
        if (new == label).all():
            break
        label = new
    assert all((whole[i].n_links, whole[i].component_id) == (near[i].sum(), label[i]) for i in range(900))
    assert all(whole[i].n_links == 0 and whole[i].component_id == i and whole[i].kept for i in range(2000, 2006))
    assert whole[None].n_links == 0 and whole[None].kept is False
    assert near_vectors(v.limit(0)).count() == 0


def dense_third(rng, n):
    """``n`` unit vectors; the first third are pairwise at a cosine of about 0.96."""
    x = rng.standard_normal((n, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    aside = x[1:n // 3] - np.outer(x[1:n // 3] @ x[0], x[0])
    x[1:n // 3] = math.sqrt(0.96) * x[0] + math.sqrt(0.04) * aside / np.linalg.norm(aside, axis=1)[:, None]
    return x


def test_near_vectors_in_a_dense_group(spark):
    x = dense_third(np.random.default_rng(6), 6000)
    v = spark.createDataFrame([(i, e.tolist()) for i, e in enumerate(x)], "vec_id long, embedding array<double>")
    near = x @ x.T >= THRESHOLD
    np.fill_diagonal(near, False)
    got = {r.vec_id: r.n_links for r in near_vectors(v, leaf=32).collect()}
    assert all(got[i] <= near[i].sum() for i in range(6000))
    assert sum(got.values()) >= 0.99 * near.sum()


def test_forest_keeps_links_of_a_third_of_100000_vectors():
    rng = np.random.default_rng(7)
    x = dense_third(rng, 100_000)
    lists = Forest(x[rng.permutation(len(x))[:SAMPLE]], len(x), LEAF, TREES, 5, THRESHOLD).leaves(x)
    a, b = rng.integers(1, len(x) // 3, (2, 50_000))
    linked = (a != b) & ((x[a] * x[b]).sum(axis=1) >= THRESHOLD)
    a, b = lists[a[linked]], lists[b[linked]]
    met = ((a[:, :, :, None] == b[:, :, None, :]) & (a[:, :, :, None] >= 0)).any(axis=(1, 2, 3))
    assert len(met) > 10_000 and met.mean() >= 0.99


def test_one_of_each_and_mix_of_rows_with_the_same_id(spark):
    words = [f"w{k}" for k in range(300)]
    text, other = " ".join(words), " ".join([*words[:-1], "x"])
    apart = " ".join(f"v{k}" for k in range(200))
    rows = [(1, text, "a")] * 3 + [(1, other, "a"), (None, text, "a"), (2, text, "a"), (3, apart, "b"), (None, "u " * 9, "b"),
                                   (None, "u " * 9, "b"), (4, None, "b"), (5, "", "b")]
    docs = docs_frame(spark, rows)
    one = one_of_each(docs, 5, 80)
    kept = Counter((r.doc_id, len(WORD.findall(r.text or ""))) for r in one.collect())
    assert kept == {(1, 300): 1, (3, 200): 1, (None, 9): 1, (4, 0): 1, (5, 0): 1} and one.columns == docs.columns
    # copies have their own places in the mix: each gives the words the mix takes of it
    for many in (docs, docs_frame(spark, [(1, text, "a")] * 4 + [(7, apart, "b")] * 2 + [(None, apart, "c")] * 2)):
        want, got = Counter(), Counter()
        for r in taken_words(*mix(many)).collect():
            want[r.doc_id] += r.taken
        for r in mixed_documents(many).collect():
            got.update(WORD.findall(r.text))
        total = Counter()
        for r in many.collect():
            total.update(WORD.findall(r.text or ""))
        assert sum(got.values()) == sum(want.values()) and set(got) <= set(total)


# the five-stage pipeline ----------------------------------------------------
def test_pipeline_stages(spark):
    """Each stage against its operator's own rows on the same input."""
    import corpus_pipeline as P
    from tessera.llm.common import cut_lineage, table
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    labels = table(spark, "/root/testdata/sf0.001", "labels")
    ids = lambda df: Counter(r.doc_id for r in df.collect())
    good = cut_lineage(P.quality(spark, docs, "/root/testdata/sf0.001"))
    assert ids(good) == ids(classify(docs, labels).where("predicted = 1")) and good.columns == docs.columns
    clean = cut_lineage(P.toxicity(spark, good, "/root/testdata/sf0.001"))
    assert ids(clean) == ids(score_toxicity(good, labels).where("predicted = 0")) and clean.columns == docs.columns
    sets = {r.doc_id: word_shingles(r.text, 5) for r in clean.collect()}
    single = cut_lineage(P.near_copies(spark, clean, ""))
    assert ids(single) == Counter(set(brute_components(sets, 80).values())) and single.columns == docs.columns
    mixed = cut_lineage(P.mixing(spark, single, ""))
    want = {r.doc_id: r.taken for r in taken_words(*mix(single)).collect() if r.taken}
    got = Counter()
    for r in mixed.collect():
        got[r.doc_id] += len(WORD.findall(r.text))
    assert got == want and mixed.columns == docs.columns
    last = P.encoding(spark, mixed, "")
    assert last.count() == mixed.count() == last.where("lossless").count()
    assert ids(P.run(spark, "/root/testdata/sf0.001")) == ids(mixed)


def test_sample_of_a_repeated_id_is_bounded(spark):
    """One id in thousands of rows: as many feature rows as ids reach the driver."""
    from tessera.llm import quality_pu
    docs = spark.range(6000).select(F.when(F.col("id") < 5000, 7).otherwise(F.col("id")).alias("doc_id"),
                                    F.concat(F.lit("some words, number "), F.col("id").cast("string")).alias("text"))
    labels = spark.createDataFrame([(7, 1), (5999, 0), *[(i, 1) for i in range(5000, 5040)]], "doc_id long, quality int")
    seen = []
    real = quality_pu.fit
    try:
        quality_pu.fit = lambda p, u, prior: seen.append((len(p), len(u))) or real(p, u, prior)
        got = classify(docs, labels).select("doc_id", "score")
    finally:
        quality_pu.fit = real
    assert got.count() == 6000 and len(seen) == 1 and seen[0][0] <= 41 and seen[0][1] <= 1001


def test_large_hypergeometric_draws():
    """The rejection draw has the mean, spread and total of the library's."""
    from tessera.llm.mixing import _hypergeometric, _log_binomial
    rng = np.random.default_rng(4)
    totals = np.array([700, 200, 100])
    ours = np.array([_hypergeometric(rng, totals, 400) for _ in range(4000)])
    library = rng.multivariate_hypergeometric(totals, 400, size=4000, method="marginals")
    assert (ours.sum(axis=1) == 400).all() and (ours <= totals).all()
    assert np.allclose(ours.mean(axis=0), library.mean(axis=0), atol=0.6)
    assert np.allclose(ours.std(axis=0), library.std(axis=0), rtol=0.06)
    big = np.array([6 * 10 ** 11, 3 * 10 ** 11, 10 ** 5])
    got = np.array([_hypergeometric(rng, big, 4 * 10 ** 11) for _ in range(200)])
    assert (got.sum(axis=1) == 4 * 10 ** 11).all() and (got <= big).all()
    p = 4 * 10 ** 11 / big.sum()
    # of the smallest source the draw is nearly binomial
    assert abs(got[:, 2].mean() - 10 ** 5 * p) < 60 and 100 < got[:, 2].std() < 220
    assert math.isclose(sum(math.exp(_log_binomial(k, 50, 0.3)) for k in range(51)), 1.0, rel_tol=1e-9)


def test_mix_and_copies_keep_clashing_columns(spark):
    rows = [(i % 3, f"word{i % 4} " * 40 + f"tail {i % 4}", "a", 5, "p", 7, 8, "t") for i in range(9)] * 2 + [(None, None, None, 1, "q", 2, 3, "u")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, n_chars int, parts string, __row int, __turn int, row string")
    kept = one_of_each(docs).collect()
    assert {(r.parts, r.__getitem__("__row"), r.__getitem__("__turn"), r.row) for r in kept} == {("p", 7, 8, "t"), ("q", 2, 3, "u")}
    assert len(kept) == 5 and sorted(r.text or "" for r in kept) == sorted({x[1] or "" for x in rows})
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    got = mixed.collect()
    assert got and all((r.parts, r.__getitem__("__row"), r.row) == ("p", 7, "t") and r.n_chars == len(r.text) for r in got)
    taken = taken_words(*mix(docs.select("doc_id", "text", "source"))).agg(F.sum("taken")).first()[0]
    assert sum(len(WORD.findall(r.text)) for r in got) == taken
