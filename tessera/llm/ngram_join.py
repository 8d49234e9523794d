"""N-gram Jaccard join with adaptive multi-match prefixes.

Documents are sets of word shingles; two are linked when their sets' Jaccard
similarity reaches the threshold; the operator returns the groups.

* Order. Shingles are ordered by hash; the frequent ones come after all
  others, by the number of documents they were counted in.
  Linked sets x, y share at least ``T = ceil(t * n)`` shingles, so their first
  ``n - T + m`` shingles have ``m`` in common.
* Adaptive prefixes. The cost of a document's candidates is estimated from
  the documents its frequent prefix shingles occur in. Documents without
  such keep the plain prefix (m = 1). Costly ones get a prefix lengthened past
  their frequent shingles and by ``m - 1`` more, with m growing with the cost,
  and a pair must then share the smaller m of the two before it is verified.
  A document with too few rare shingles for that also indexes frequent ones.
* Candidates. Postings of rare shingles are sorted by shingle and read as a
  stream: lists up to ``LIST`` give all pairs, longer ones are treated like a
  frequent shingle's. Pair counts and positions bound the overlap from above, and only pairs that can still reach the
  threshold are verified, exactly, on the whole sets.
* Frequent shingles. In a few rounds, each list's hubs are compared with
  the members of other groups; groups merge as links are found, so a family
  of thousands of near copies costs a few comparisons per member. What is
  still outside a list's largest group is then compared with all the list's
  members, in blocks of bounded size, without writing pairs.
* Copies (equal sets) are one class from the start.

Defined results: documents without words have an empty set and link with
nothing; fewer words than ``n`` make one shingle; rows without doc_id link
with nothing and get a null component; repeated ids are separate rows; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut_lineage, narrow, python_ready, row_id, scratch, table
from .components import components

ZONE = 8                    # shingles are counted one ``1 / ZONE`` of the set beyond the plain prefix
LIST = 32                   # documents of a shingle from which it is frequent
MAX_FREQUENT = 500_000      # frequent shingles sent to all tasks; LIST doubles until they fit
MAX_MATCHES = 8
BROADCAST_IDS = 2_000_000   # documents whose ids may be broadcast to pick their texts
HUBS, HUB_ROUNDS = 2, 2
GROUP_PARTS = 16            # a group's members meet its smallest id in so many parts
BLOCK_SETS, BLOCK_SHINGLES = 1024, 1_000_000      # of a block that is compared in memory

_U = np.uint64
_WORDS: dict[bytes, int] = {}
_KEPT_WORDS = 300_000


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the public splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def shingles(text: bytes | None, n: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes (uint64) of the text's n-word shingles."""
    words = text.lower().split() if text else []     # on bytes: A-Z and ASCII white space only
    if not words:
        return np.zeros(0, np.uint64)
    known = _WORDS
    if len(known) > _KEPT_WORDS:
        known.clear()
    h = []
    for w in words:
        v = known.get(w)
        if v is None:
            v = known[w] = int.from_bytes(blake2b(w, digest_size=8).digest(), "little")
        h.append(v)
    a = np.array(h, np.uint64)
    with np.errstate(over="ignore"):
        if len(a) < n:
            s = _U(len(a))
            for v in a:
                s = _mix(np.array([s * _U(0x9E3779B97F4A7C15) + v]))[0]
            return np.array([s], np.uint64)
        s = np.zeros(len(a) - n + 1, np.uint64)
        for k in range(n):
            s = s * _U(0x9E3779B97F4A7C15) + _mix(a[k:len(a) - n + 1 + k])
        return np.unique(_mix(s))


def set_key(s: np.ndarray) -> int:
    """64-bit identity of a shingle set."""
    return int.from_bytes(blake2b(s.tobytes(), digest_size=8).digest(), "little", signed=True)


def least_overlap(n, percent: int):
    """Shingles a set of ``n`` shares with any set it links with, at least."""
    return (percent * n + 99) // 100


def _long(s: np.ndarray) -> np.ndarray:
    return s.view(np.int64)


def _sets(docs: DataFrame, make, schema: str, n: int) -> DataFrame:
    """Map ``make(set, key) -> tuple | None`` over the documents' shingle sets."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        kinds = pa.schema([(c.split()[0], {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}
                            [c.split()[1]]) for c in schema.split(", ")])
        for b in batches:
            for lo in range(0, b.num_rows, 512):
                part = b.slice(lo, 512)
                rows = []
                for doc, text in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    s = shingles(text, n)
                    row = make(doc, s, set_key(s))
                    if row is not None:
                        rows.append(row)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([r[k] for r in rows], kinds.field(k).type) for k in range(len(names))], schema=kinds)

    return docs.mapInArrow(run, schema)


def _texts_of(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The documents whose doc_id is in ``ids`` (distinct); broadcast only below a counted size."""
    ids = cut_lineage(ids)
    small = ids.count() <= BROADCAST_IDS
    return docs.join(F.broadcast(ids) if small else ids.hint("merge"), "doc_id", "left_semi")


def _stream_pairs(postings: DataFrame) -> DataFrame:
    """Read ``postings`` (token, cls, pos), sorted by token within partitions.
    Lists of up to ``LIST`` classes give their pairs as rows (a, b, pa, pb)
    with pa, pb >= 0; the members of longer lists come back one by one, as
    a = class, b = token, pa = pb = -1. At most one Arrow batch and one list
    of ``LIST`` are held."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        def rows(*columns):
            return pa.RecordBatch.from_arrays([pa.array(x) for x in columns], names=["a", "b", "pa", "pb"])

        def pairs(t, c, p) -> Iterator:
            start = np.flatnonzero(np.diff(t, prepend=0) != 0) if len(t) else np.zeros(0, np.int64)
            start = start if len(start) and start[0] == 0 else np.concatenate([[0], start])
            size = np.diff(np.append(start, len(t)))
            for k in range(1, LIST):                 # pairs (i, i + k) of each list
                own = size > k
                start, size = start[own], size[own]
                if not len(size):
                    return
                n = size - k
                i = np.repeat(start - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
                j = i + k
                swap = c[i] > c[j]
                i, j = np.where(swap, j, i), np.where(swap, i, j)
                yield rows(c[i], c[j], p[i], p[j])

        nothing = (np.zeros(0, np.int64),) * 3
        held, long_token = nothing, None
        for b in batches:
            if not b.num_rows:
                continue
            t, c, p = (np.concatenate([h, np.asarray(b.column(k)).astype(np.int64)]) for k, h in enumerate(held))
            start = np.flatnonzero(np.concatenate([[True], t[1:] != t[:-1]]))
            size = np.diff(np.append(start, len(t)))
            is_long = size > LIST
            if t[0] == long_token:
                is_long[0] = True
            member = np.repeat(is_long, size)
            if member.any():
                none = np.full(int(member.sum()), -1, np.int64)
                yield rows(c[member], t[member], none, none)
            rest = ~member
            if is_long[-1]:
                held, long_token = nothing, t[-1]
            else:                                    # the last list may go on in the next batch
                held, long_token = (t[start[-1]:], c[start[-1]:], p[start[-1]:]), None
                rest[start[-1]:] = False
            if rest.any():
                yield from pairs(t[rest], c[rest], p[rest])
        if len(held[0]):
            yield from pairs(*held)

    return postings.mapInArrow(run, "a long, b long, pa long, pb long")


def _linked_blocks(group, percent: int):
    """Links between the outsiders (role 1) and members (role 0) of one block
    pair, as one edge from each linked set to the first of its connected ones."""
    import pyarrow as pa
    cls, first = np.unique(np.asarray(group.column("cls")).astype(np.int64), return_index=True)
    role, at = np.asarray(group.column("role")), np.searchsorted(cls, np.asarray(group.column("cls")).astype(np.int64))
    members, outsiders = np.unique(at[role == 0]), np.unique(at[role == 1])
    lists = group.column("s").combine_chunks().take(pa.array(first))
    n = np.asarray(lists.value_lengths()).astype(np.int64)
    _, token, count = np.unique(np.asarray(lists.flatten()), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(len(cls)), n)
    keep = count[token] > 1                              # a shingle of one set links nothing
    shared = np.cumsum(count > 1) - 1
    token, row = shared[token[keep]], row[keep]
    overlap = np.zeros((len(outsiders), len(members)), np.float32)
    order = np.argsort(token, kind="stable")
    token, row = token[order], row[order]
    width = int(token[-1]) + 1 if len(token) else 0
    for lo in range(0, width, 4096):
        some = slice(*np.searchsorted(token, [lo, lo + 4096]))
        has = np.zeros((len(cls), min(4096, width - lo)), np.float32)
        has[row[some], token[some] - lo] = 1
        overlap += has[outsiders] @ has[members].T
    overlap = overlap.astype(np.float64)                 # exact beyond 2**24 / 100 shingles too
    union = n[outsiders][:, None] + n[members][None, :] - overlap
    linked = (100 * overlap >= percent * union) & (outsiders[:, None] != members[None, :])
    i, j = np.nonzero(linked)
    label = np.arange(len(cls))
    while True:                                          # smallest label along the links
        new = label.copy()
        np.minimum.at(new, outsiders[i], label[members[j]])
        np.minimum.at(new, members[j], label[outsiders[i]])
        new = new[new]
        if (new == label).all():
            break
        label = new
    some = np.flatnonzero(label != np.arange(len(cls)))
    return pa.table({"a": cls[some], "b": cls[label[some]]})


def similar_sets(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): doc_id, n_shingles, component_id."""
    python_ready(docs.sparkSession)
    with scratch(docs.sparkSession) as scope:
        return _similar_sets(docs, n, percent, scope)


def _similar_sets(docs: DataFrame, n: int, percent: int, scope) -> DataFrame:
    spark = docs.sparkSession
    d = narrow(docs, {"doc_id": "long", "text": "string"}).select("doc_id", F.col("text").cast("binary").alias("text"))

    # plain prefixes, and the classes of equal sets
    def plain(doc, s, key):
        p = len(s) - least_overlap(len(s), percent) + 1 if len(s) else 0
        return doc, len(s), key, _long(s[:p + len(s) // ZONE])

    rows = cut_lineage(_sets(d, plain, "doc_id long, n long, cls long, prefix array<long>", n))
    sound = rows.where("n > 0 AND doc_id IS NOT NULL")
    classes = cut_lineage(sound.groupBy("cls", "n").agg(F.min("doc_id").alias("rep"), F.first("prefix").alias("prefix")))

    # frequent shingles: in more than LIST classes' prefixes
    often = cut_lineage(classes.select(F.explode("prefix").alias("token")).groupBy("token").count().where(F.col("count") > LIST))
    bound = LIST
    while often.where(F.col("count") > bound).limit(MAX_FREQUENT + 1).count() > MAX_FREQUENT:
        bound *= 2
    listed = often.where(F.col("count") > bound).select("token", "count").toArrow()
    tokens = np.asarray(listed.column("token")).astype(np.int64).view(np.uint64)
    counts = np.asarray(listed.column("count")).astype(np.int64)
    order = np.argsort(tokens)
    shared = spark.sparkContext.broadcast((tokens[order], counts[order]))

    def frequent(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which shingles are frequent, and their counts (else 0)."""
        known, df = shared.value
        if not len(known):
            return np.zeros(len(s), bool), np.zeros(len(s), np.int64)
        at = np.minimum(np.searchsorted(known, s), len(known) - 1)
        hit = known[at] == s
        return hit, np.where(hit, df[at], 0)

    def lengthened(doc, s, key):
        """(cls, m, tokens of the prefix, how many of them are rare)"""
        size = len(s)
        plain_length = size - least_overlap(size, percent) + 1
        hit, df = frequent(s)
        cost = int(df[:plain_length].sum())
        m = min(MAX_MATCHES, 1 + int(np.log2(1 + cost / LIST)))
        rare = s[~hit]
        m = max(1, min(m, len(rare) - plain_length + 1))
        if len(rare) >= plain_length + m - 1:
            return key, m, _long(rare[:plain_length + m - 1]), plain_length + m - 1
        by_count = s[hit][np.argsort(df[hit], kind="stable")]
        return key, 1, _long(np.concatenate([rare, by_count])[:plain_length]), len(rare)

    plain_prefix = F.slice("prefix", F.lit(1), (F.col("n") - F.floor((F.lit(percent) * F.col("n") + 99) / 100) + 1).cast("int"))
    bare = classes.select("cls", F.lit(1).alias("m"), plain_prefix.alias("prefix")).withColumn("rare", F.size("prefix"))
    hit = longer = frequent_table = None
    if len(tokens):
        frequent_table = cut_lineage(often.where(F.col("count") > bound).select("token"))
        few = frequent_table.count() <= BROADCAST_IDS
        hit = classes.select("cls", "rep", F.explode(plain_prefix).alias("token")).join(
            F.broadcast(frequent_table) if few else frequent_table, "token", "left_semi").select("cls", "rep").distinct()
        hit = cut_lineage(hit)
        longer = cut_lineage(_sets(_texts_of(d, hit.select(F.col("rep").alias("doc_id")).distinct()), lengthened,
                              "cls long, m int, prefix array<long>, rare int", n)
                        .join(hit.select("cls").distinct(), "cls", "left_semi")
                        .groupBy("cls").agg(F.first("m").alias("m"), F.first("prefix").alias("prefix"), F.first("rare").alias("rare")))
        prefixes = bare.join(longer.select("cls"), "cls", "left_anti").unionByName(longer)
    else:
        prefixes = bare

    # candidates from rare shingles
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    light = prefixes.select("cls", F.posexplode(F.slice("prefix", F.lit(1), F.col("rare"))).alias("pos", "token"))
    light = light.repartition(partitions, "token").sortWithinPartitions("token", "cls").select("token", "cls", F.col("pos").cast("long"))
    read = cut_lineage(_stream_pairs(light))
    pairs = read.where("pa >= 0").groupBy("a", "b").agg(
        F.count(F.lit(1)).alias("c"), F.max("pa").alias("pa"), F.max("pb").alias("pb"))
    # what a pair's overlap can still be: shared so far, plus the rest of the smaller side
    about = prefixes.join(classes.select("cls", "n"), "cls").select(
        "cls", "n", "m", "rare", (F.col("rare") < F.size("prefix")).alias("mixed"), F.size("prefix").alias("len"),
        F.element_at("prefix", -1).alias("last"))
    about = cut_lineage(about)
    x = about.select(*[F.col(c).alias("a" if c == "cls" else c + "_a") for c in about.columns])
    y = about.select(*[F.col(c).alias("b" if c == "cls" else c + "_b") for c in about.columns])
    need = F.ceil(F.lit(percent) * (F.col("n_a") + F.col("n_b")) / F.lit(100 + percent))
    # hashes compare as unsigned numbers
    unsigned = lambda c: F.col(c).bitwiseXOR(F.lit(-2**63))
    a_first = unsigned("last_a") <= unsigned("last_b")
    room = F.least(F.col("n_a") - F.when(a_first, F.col("len_a")).otherwise(F.col("pa") + 1),
                   F.col("n_b") - F.when(a_first, F.col("pb") + 1).otherwise(F.col("len_b")))
    sized = (F.lit(percent) * F.greatest("n_a", "n_b") <= F.lit(100) * F.least("n_a", "n_b"))
    # documents that index frequent shingles have all their rare ones in the prefix
    frequent_room = F.least(F.col("n_a") - F.col("rare_a"), F.col("n_b") - F.col("rare_b"))
    able = F.when(F.col("mixed_a") & F.col("mixed_b"), F.col("c") + frequent_room >= need) \
        .when(F.col("mixed_a") | F.col("mixed_b"), F.lit(True)).otherwise(
        (F.col("c") >= F.least("m_a", "m_b")) & (F.col("c") + room >= need))
    able = cut_lineage(pairs.join(x, "a").join(y, "b").where(sized & able).select("a", "b", "c"))

    # lists that must be gone through with hubs: frequent shingles, and rare ones whose stream met the limit
    # (slack: shingles that two of a list's documents without a common rare one can share at most)
    heavy = prefixes.where(F.col("rare") < F.size("prefix")).select(
        "cls", "rare", F.explode(F.slice("prefix", F.col("rare") + 1, F.size("prefix"))).alias("token"))
    over = read.where("pa < 0").select(F.col("b").alias("token"), F.col("a").alias("cls"), F.lit(0).alias("rare"))
    lists = cut_lineage(heavy.select("token", "cls", "rare").unionByName(over).join(classes.select("cls", "n"), "cls")
                        .select("token", "cls", "n", (F.col("n") - F.col("rare")).alias("slack")))
    scope.free(often, frequent_table, hit, longer, read, about)
    return _group(d, rows, classes, able, lists, n, percent, scope)


def _group(d, rows, classes, able, lists, n: int, percent: int, scope) -> DataFrame:
    """Verify the candidates and return the groups."""
    spark = d.sparkSession
    some = able.select(F.col("a").alias("cls")).unionByName(able.select(F.col("b").alias("cls"))) \
        .unionByName(lists.select("cls")).distinct()
    some = cut_lineage(some.join(classes.select("cls", "rep"), "cls"))
    sets = cut_lineage(_sets(_texts_of(d, some.select(F.col("rep").alias("doc_id")).distinct()),
                        lambda doc, s, key: (key, _long(s)), "cls long, s array<long>", n)
                  .join(some.select("cls"), "cls", "left_semi")
                  .groupBy("cls").agg(F.first("s").alias("s")))

    def verified(pairs: DataFrame) -> DataFrame:
        left = sets.select(F.col("cls").alias("a"), F.col("s").alias("sa"))
        right = sets.select(F.col("cls").alias("b"), F.col("s").alias("sb"))
        both = pairs.select("a", "b").join(left.hint("merge"), "a").join(right.hint("merge"), "b")
        shared = F.size(F.array_intersect("sa", "sb"))
        return cut_lineage(both.withColumn("i", shared).where(
            F.lit(100) * F.col("i") >= F.lit(percent) * (F.size("sa") + F.size("sb") - F.col("i"))).select("a", "b"))

    def apart(pairs: DataFrame, label: DataFrame) -> DataFrame:
        """The pairs whose ends are not yet in one group."""
        la, lb = (label.select(F.col("id").alias(c), F.col("component").alias("c" + c)) for c in "ab")
        return pairs.join(la, "a", "left").join(lb, "b", "left").where(
            F.coalesce("ca", "a") != F.coalesce("cb", "b")).select(*pairs.columns)

    # first each document's most promising partner, then what is still apart
    none = spark.createDataFrame([], "a long, b long")
    links = none
    label = spark.createDataFrame([], "id long, component long")
    if able.limit(1).count():
        ends = able.select(F.col("a").alias("x"), "a", "b", "c").unionByName(able.select(F.col("b").alias("x"), "a", "b", "c"))
        best = ends.groupBy("x").agg(F.max(F.struct("c", "a", "b")).alias("p")).select("p.a", "p.b").distinct()
        links = verified(best)
        label = components(links)
        rest = apart(able.select("a", "b").join(best, ["a", "b"], "left_anti"), label)
        links = links.unionByName(verified(rest))
        label = cut_lineage(components(links))

    def remaining(lists: DataFrame) -> tuple[DataFrame, DataFrame]:
        """Members (token, cls, n, slack, g, top) of the lists with more than one group, and
        of these the ones outside the list's largest group ``top``."""
        named = cut_lineage(lists.join(label.withColumnRenamed("id", "cls"), "cls", "left").select(
            "token", "cls", "n", "slack", F.coalesce("component", "cls").alias("g")))
        largest = named.groupBy("token", "g").agg(F.count(F.lit(1)).alias("k")).groupBy("token").agg(
            F.max(F.struct("k", "g"))["g"].alias("top"), F.count(F.lit(1)).alias("groups"))
        named = named.join(cut_lineage(largest.where("groups > 1").select("token", "top")), "token")
        return named, cut_lineage(named.where("g <> top"))

    for turn in range(HUB_ROUNDS):
        named, waiting = remaining(lists)
        if not waiting.limit(1).count():
            break
        hubs = waiting.groupBy("token").agg(F.array_distinct(F.array(*[
            F.min(F.struct(F.xxhash64("cls", F.lit(turn * HUBS + k)), "cls", "n", "slack", "g")) for k in range(HUBS)])).alias("h"))
        hubs = cut_lineage(hubs.select("token", F.explode("h").alias("h")).select("token", *[
            F.col(f"h.{c}").alias(f"hub_{c}") for c in ("cls", "n", "slack", "g")]))
        near = named.join(hubs, "token").where(
            (F.col("g") != F.col("hub_g"))
            & (F.lit(percent) * F.greatest("n", "hub_n") <= F.lit(100) * F.least("n", "hub_n"))
            & (F.lit(100 + percent) * F.least("slack", "hub_slack") >= F.lit(percent) * (F.col("n") + F.col("hub_n"))))
        near = near.select(F.least("cls", "hub_cls").alias("a"), F.greatest("cls", "hub_cls").alias("b")).distinct()
        links = links.unionByName(verified(near))
        label = cut_lineage(components(links))

    named, waiting = remaining(lists)
    if waiting.limit(1).count():
        # lists with the same largest group are put together; outsiders against members, block by block
        sides = []
        for role, side in ((0, named), (1, waiting)):
            docs = cut_lineage(side.select("top", "cls", "n").distinct())
            k = docs.groupBy("top").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_SETS), F.ceil(F.sum("n") / BLOCK_SHINGLES)).alias("k"))
            sides.append((docs, cut_lineage(k)))
        parts = []
        for role in (0, 1):
            docs, own = sides[role]
            other = sides[1 - role][1].withColumnRenamed("k", "others")
            mine = F.pmod(F.xxhash64("cls", F.lit("block")), F.col("k"))
            spread = docs.join(own, "top").join(other, "top").select(
                "top", "cls", F.lit(role).alias("role"), mine.alias("mine"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("theirs"))
            parts.append(spread.select("top", "cls", "role", F.col("mine" if role == 0 else "theirs").alias("b0"),
                                       F.col("theirs" if role == 0 else "mine").alias("b1")))
        facing = parts[0].unionByName(parts[1]).join(sets.hint("merge"), "cls")
        met = facing.groupBy("top", "b0", "b1").applyInArrow(lambda group: _linked_blocks(group, percent), "a long, b long")
        label = cut_lineage(components(links.unionByName(met)))

    # linked classes take their group's smallest id; its members meet it in parts, as a group may be large
    linked = cut_lineage(classes.select("cls", "rep").join(label.withColumnRenamed("id", "cls"), "cls").withColumn(
        "part", F.pmod(F.xxhash64("cls"), F.lit(GROUP_PARTS))))
    first = linked.groupBy("component").agg(F.min("rep").alias("component_id")).withColumn(
        "part", F.explode(F.array(*[F.lit(k).cast("long") for k in range(GROUP_PARTS)])))
    moved = linked.join(first, ["component", "part"]).select("cls", "component_id")
    named = cut_lineage(moved.unionByName(classes.select("cls", F.col("rep").alias("component_id")).join(label.select(F.col("id").alias("cls")), "cls", "left_anti")))
    scope.keep(rows, named)
    own = rows.select("doc_id", F.col("n").alias("n_shingles"), "cls")
    full = own.where("n_shingles > 0 AND doc_id IS NOT NULL").join(named, "cls").select("doc_id", "n_shingles", "component_id")
    return full.unionByName(own.where("n_shingles = 0 OR doc_id IS NULL").select(
        "doc_id", "n_shingles", F.col("doc_id").alias("component_id")))


def one_of_each(docs: DataFrame, n: int = 4, percent: int = 85) -> DataFrame:
    """One row of ``docs``, all columns, of each group of similar texts: one
    with the smallest doc_id (none counts as the largest; of equal ones that
    with the least text hash). Rows stand for themselves by a hash of doc_id and text, so no text is
    copied; of rows equal in both one stays. Texts without words are groups
    of their own, so only their repeated rows go. An empty table gives an empty result."""
    me, extra = docs.columns, _unused("row", docs)
    key = row_id(docs, ["doc_id", "text"])
    with scratch(docs.sparkSession) as scope:
        rows = docs.select(key.alias("doc_id"), "text")
        found = similar_sets(rows, n, percent)
        moved = cut_lineage(found.where(F.col("doc_id") != F.col("component_id")).select(F.col("doc_id").alias("id"), "component_id").distinct())
        linked = moved.unionByName(moved.select(F.col("component_id").alias("id"), "component_id").distinct())
        known = docs.select(key.alias("id"), F.col("doc_id").cast("long").alias("doc_id"))
        member = cut_lineage(known.join(linked.hint("merge"), "id").distinct())
        stays = member.groupBy("component_id").agg(
            F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "id"))["id"].alias("id"))
        gone = cut_lineage(member.select("id").join(stays.select("id").hint("merge"), "id", "left_anti").withColumnRenamed("id", extra))
        again = cut_lineage(known.groupBy("id").count().where("count > 1").select(F.col("id").alias(extra)))
        scope.keep(gone, again)
    few = {t: t.count() <= BROADCAST_IDS for t in (gone, again)}

    def side(ids: DataFrame) -> DataFrame:
        return F.broadcast(ids) if few[ids] else ids.hint("merge")

    left = docs.withColumn(extra, key).join(side(gone), extra, "left_anti")
    if not again.limit(1).count():
        return left.select(*me)
    once = left.join(side(again), extra, "left_anti")
    return once.unionByName(left.join(side(again), extra, "left_semi").dropDuplicates([extra])).select(*me)


def _unused(name: str, df: DataFrame) -> str:
    """A column name that the frame doesn't have."""
    while name.lower() in [c.lower() for c in df.columns]:
        name += "_"
    return name


# query --------------------------------------------------------------------
def op1_ngram_jaccard_join(spark, sf_dir: str) -> DataFrame:
    return similar_sets(table(spark, sf_dir, "documents"))


OP1_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                 '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
             ELSE list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * i >= 85 * (x.n + y.n - i)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r AS (SELECT doc_id AS id, doc_id AS c FROM w UNION SELECT e.b, r.c FROM r JOIN e ON r.id = e.a)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, m.c AS component_id
FROM w LEFT JOIN n ON w.doc_id = n.doc_id LEFT JOIN (SELECT id, min(c) AS c FROM r GROUP BY id) m ON w.doc_id = m.id"""
