"""SentencePiece encoding with sampled segmentations, and lossless decoding.

A text's segmentations into vocabulary pieces form a lattice. One is drawn
by forward filtering and backward sampling: forward sums give each node the
weight of all ways to reach it; walking back from the end, each step picks
the incoming piece in proportion to the weight of the ways through it.

* No piece crosses from a non-space to a space, or touches a newline, so the
  lattice falls apart exactly at those places. The forward pass runs once per
  distinct unit between them, the backward walk once per unit, both over all
  units of a chunk of rows at once.
* The uniform number of a step is a hash of (row key, seed, position in the
  text). A row's segmentation therefore doesn't depend on its batch,
  partition or run.
* The weight of a piece is ``rank ** -alpha`` (Zipf's law over the
  vocabulary order), as public piece models of the merge kind hold ranks, not
  probabilities. Characters outside the vocabulary fall back to byte pieces.

Encoding puts one space before the text, as the model expects; decoding joins
the pieces' bytes and takes it away again. A literal U+2581 in a text goes
through byte pieces, so decoding returns every text exactly.

Defined results: a null text has null ids and decodes to null; an empty text
has no ids; a null key counts as 0; repeated rows get equal ids; extra columns
are ignored. Memory is bounded by ``CHUNK_CHARS`` and the longest text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import narrow, python_ready, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
ALPHA = 1.5
SEED = 11
CHUNK_CHARS = 300_000    # characters of text sampled together

_UNIT = re.compile(r" *[^ \n]+|\n| +")
_U = np.uint64


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (the public splitmix64)."""
    x = x + _U(0x9E3779B97F4A7C15)
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Pieces:
    """Vocabulary, lattice table and both directions for one model and alpha."""

    def __init__(self, model: str, alpha: float):
        import pyarrow as pa
        import sentencepiece
        sp = sentencepiece.SentencePieceProcessor(model_file=model)
        n = sp.get_piece_size()
        self.byte_ids = np.zeros(256, np.int64)
        raw: list[bytes] = [b""] * n
        self.log_weight = np.zeros(n)
        trie: list[dict[str, int]] = [{}]
        piece_at = [-1]
        rank = self.longest = 0
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                b = int(piece[3:5], 16)
                self.byte_ids[b] = i
                raw[i] = bytes([b])
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                rank += 1
                spaced = piece.replace("▁", " ")
                raw[i] = spaced.encode()
                self.log_weight[i] = -alpha * np.log(rank)
                self.longest = max(self.longest, len(spaced))
                at = 0
                for c in spaced:
                    if c not in trie[at]:
                        trie[at][c] = len(trie)
                        trie.append({})
                        piece_at.append(-1)
                    at = trie[at][c]
                piece_at[at] = i
        self.fallback = -2 * alpha * np.log(rank + 1.0)         # below any piece
        self._hash_moves(np.array([at * 0x110000 + ord(c) for at, kids in enumerate(trie) for c in kids], np.int64),
                         np.array([to for kids in trie for to in kids.values()], np.int32))
        self.piece_at = np.array(piece_at, np.int64)
        self.raw = pa.array(raw, pa.binary())

    def _hash_moves(self, moves: np.ndarray, targets: np.ndarray) -> None:
        """The trie's moves as a hash table with linear probing, an eighth to a
        quarter full."""
        bits = int(len(moves)).bit_length() + 2
        self.shift = _U(64 - bits)
        self.slot_move = np.full((1 << bits) + len(moves) + 1, -1, np.int64)
        self.slot_to = np.zeros(len(self.slot_move), np.int32)
        todo, slot = np.arange(len(moves)), self._slots(moves)
        while len(todo):
            free = np.flatnonzero(self.slot_move[slot] < 0)
            taken, one = np.unique(slot[free], return_index=True)
            self.slot_move[taken], self.slot_to[taken] = moves[todo[free[one]]], targets[todo[free[one]]]
            rest = np.ones(len(todo), bool)
            rest[free[one]] = False
            todo, slot = todo[rest], slot[rest] + 1

    def _slots(self, moves: np.ndarray) -> np.ndarray:
        with np.errstate(over="ignore"):
            return ((moves.view(_U) * _U(0x9E3779B97F4A7C15)) >> self.shift).view(np.int64)

    def _follow(self, want: np.ndarray) -> np.ndarray:
        """The trie states that some moves (state * 0x110000 + code point) lead to, or -1."""
        slot = self._slots(want)
        found = self.slot_move[slot]
        hit = found == want
        to = np.where(hit, self.slot_to[slot], -1)
        todo = np.flatnonzero(~hit & (found >= 0))
        while len(todo):
            slot[todo] += 1
            found = self.slot_move[slot[todo]]
            hit = found == want[todo]
            to[todo[hit]] = self.slot_to[slot[todo[hit]]]
            todo = todo[~hit & (found >= 0)]
        return to

    def lattice(self, units: list[str]) -> tuple:
        """The lattices of some units, laid end to end: (characters per unit,
        first edges, keys, codes, backs). A node is a character end; the incoming
        edges of node k (counted over all units) start at its first edge, by
        length, and have keys k + cumulative share (the last one's infinite),
        code = piece id or -1 - code point for byte pieces, back = characters."""
        length = np.array(list(map(len, units)), np.int64)
        chars = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
        total = len(chars)
        stop = np.repeat(np.cumsum(length), length)            # where each character's unit ends
        # all pieces, found by walking the vocabulary's trie from every start at once;
        # a node has one edge of a length at most, so its edges are numbered as they are found
        count = np.zeros(total, np.int64)
        found = []

        def edges(nodes: np.ndarray, codes: np.ndarray, back: int) -> None:
            found.append((nodes, count[nodes], codes, back))
            count[nodes] += 1

        here, state = np.arange(total), np.zeros(total, np.int64)
        for back in range(1, self.longest + 1):
            state = self._follow(state * 0x110000 + chars[here + (back - 1)])
            hit = np.flatnonzero(state >= 0)
            here, state = here[hit], state[hit].astype(np.int64)
            full = self.piece_at[state]
            good = np.flatnonzero(full >= 0)
            edges(here[good] + (back - 1), full[good], back)
            if back == 1:                                       # characters the vocabulary lacks
                odd = np.flatnonzero(count == 0)
                edges(odd, np.where(chars[odd] < 128, self.byte_ids[chars[odd] & 127], -1 - chars[odd]), back)
            inside = np.flatnonzero(here + back < stop[here])
            here, state = here[inside], state[inside]
            if not len(here):
                break
        first = np.cumsum(count) - count
        code, back = np.empty(int(count.sum()), np.int64), np.empty(int(count.sum()), np.int64)
        for nodes, nth, codes, chars_back in found:
            at = first[nodes] + nth
            code[at], back[at] = codes, chars_back
        del found
        log_w = np.where(code >= 0, self.log_weight[np.maximum(code, 0)], self.fallback)
        # forward sums depth by depth, the longest units first
        share = np.empty(len(code))
        log_f = np.zeros(total)
        by_length = np.argsort(-length, kind="stable")
        origin = (np.cumsum(length) - length)[by_length]
        active = np.searchsorted(-length[by_length], -np.arange(int(length.max())), side="left")
        for d, k in enumerate(active):
            at = origin[:k] + d
            n = count[at]
            head = np.cumsum(n) - n
            e = np.repeat(first[at] - head, n)
            e += np.arange(len(e))
            far = back[e]
            v = log_w[e] + np.where(far <= d, log_f[np.repeat(at, n) - far], 0.0)
            top = np.maximum.reduceat(v, head)
            p = np.exp(v - np.repeat(top, n))
            sums = np.add.reduceat(p, head)
            log_f[at] = top + np.log(sums)
            share[e] = p / np.repeat(sums, n)
        run = np.cumsum(share)
        keys = np.minimum(run - np.repeat(run[first] - share[first], count), 1.0)
        keys += np.repeat(np.arange(total), count)
        keys[first + count - 1] = np.inf
        return length, first, keys, code, back

    def encode(self, texts: list[str], keys: np.ndarray, seed: int) -> tuple[np.ndarray, np.ndarray]:
        """All ids one after another, and the number of ids of each text."""
        units: list[str] = []
        per_text = np.zeros(len(texts), np.int64)
        for r, t in enumerate(texts):
            if t:
                found = _UNIT.findall(" " + t)
                per_text[r] = len(found)
                units += found
        if not units:
            return np.zeros(0, np.int32), per_text
        # one lattice per distinct unit, their edges laid end to end
        distinct = list(dict.fromkeys(units))
        which = np.fromiter(map(dict(zip(distinct, range(len(distinct)))).__getitem__, units), np.int64, len(units))
        nodes, first_edge, edge_keys, edge_codes, edge_backs = self.lattice(distinct)
        base = np.cumsum(nodes) - nodes

        length = nodes[which]
        row = np.repeat(np.arange(len(texts)), per_text)
        start = np.cumsum(length) - length
        first = np.concatenate([[0], np.cumsum(per_text)])[:-1]
        place = start - start[np.minimum(first, len(start) - 1)][row]      # of the unit in its text
        steps: list[tuple[np.ndarray, np.ndarray]] = []
        with np.errstate(over="ignore"):
            row_seed = _mix(_mix(keys.astype(np.int64).view(np.uint64)) ^ _U(seed))
            todo, end = np.arange(len(units)), length.copy()
            node0, at0 = base[which], place.astype(np.uint64)
            rs = row_seed[row]
            while len(todo):
                u = (_mix(rs + (at0 + end.astype(np.uint64)) * _U(0xD6E8FEB86659FD93)) >> _U(11)) * 2.0 ** -53
                node = node0 + end - 1
                edge, u = first_edge[node], node + u
                past = np.flatnonzero(edge_keys[edge] <= u)
                while len(past):                                # the node's first edge whose key is above u
                    edge[past] += 1
                    past = past[edge_keys[edge[past]] <= u[past]]
                steps.append((todo, edge_codes[edge]))
                end = end - edge_backs[edge]
                on = end > 0
                if not on.all():
                    todo, end, node0, at0, rs = todo[on], end[on], node0[on], at0[on], rs[on]
        count = np.zeros(len(units), np.int64)
        for t, _ in steps:
            count[t] += 1
        stop = np.cumsum(count)
        codes = np.empty(int(stop[-1]), np.int64)
        for k, (t, c) in enumerate(steps):
            codes[stop[t] - 1 - k] = c
        n_ids = np.bincount(row, weights=count, minlength=len(texts)).astype(np.int64)
        if (codes < 0).any():
            codes, n_ids = self._expand(codes, n_ids)
        return codes.astype(np.int32), n_ids

    def _expand(self, codes: np.ndarray, n_ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of characters outside the vocabulary replaced by their bytes' ids."""
        odd = np.flatnonzero(codes < 0)
        spelt = {c: [int(self.byte_ids[b]) for b in chr(-1 - c).encode("utf-8", "surrogatepass")]
                 for c in np.unique(codes[odd]).tolist()}
        width = np.ones(len(codes), np.int64)
        width[odd] = [len(spelt[c]) for c in codes[odd].tolist()]
        text = np.repeat(np.arange(len(n_ids)), n_ids)
        out = np.repeat(codes, width)
        at = (np.cumsum(width) - width)[odd]
        for a, c in zip(at.tolist(), codes[odd].tolist()):
            out[a:a + len(spelt[c])] = spelt[c]
        return out, np.bincount(text, weights=width, minlength=len(n_ids)).astype(np.int64)

    def decode(self, ids, offsets):
        """Binary array of the texts whose ids lie between the offsets."""
        import pyarrow as pa
        import pyarrow.compute as pc
        if len(ids) == 0:
            return pa.array([b""] * (len(offsets) - 1), pa.binary())
        joined = pc.binary_join(pa.ListArray.from_arrays(offsets, self.raw.take(ids)), b"")
        return pa.array([x[1:] for x in joined.to_pylist()], pa.binary())


_LOADED: dict[tuple, Pieces] = {}


def pieces(model: str, alpha: float) -> Pieces:
    """The worker's own copy of a model."""
    key = (model, alpha)
    if key not in _LOADED:
        _LOADED[key] = Pieces(model, alpha)
    return _LOADED[key]


def _chunks(sizes: list[int]) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``CHUNK_CHARS`` characters."""
    lo = total = 0
    for k, n in enumerate(sizes):
        if k > lo and total + n > CHUNK_CHARS:
            yield lo, k
            lo, total = k, 0
        total += n
    if lo < len(sizes):
        yield lo, len(sizes)


def _encoded(p: Pieces, batches: Iterator, seed: int) -> Iterator:
    """(rows, ids as list array) of each chunk of (key, text, size) batches."""
    import pyarrow as pa
    for b in batches:
        sizes = [n or 0 for n in b.column(2).to_pylist()]
        for lo, hi in _chunks(sizes):
            part = b.slice(lo, hi - lo)
            keys = np.array([k or 0 for k in part.column(0).to_pylist()], np.int64)
            ids, n = p.encode(part.column(1).to_pylist(), keys, seed)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            null = pa.array(np.asarray(part.column(1).is_null()))
            yield part, pa.ListArray.from_arrays(offsets, pa.array(ids), mask=null), pa.array(n), offsets


def _keyed(docs: DataFrame, key: str) -> DataFrame:
    python_ready(docs.sparkSession)
    return narrow(docs, {key: "long", "text": "string"}).select(F.col(key).alias("key"), "text", F.length("text").alias("size"))


def encode_pieces(docs: DataFrame, key: str = "doc_id", model: str = MODEL, alpha: float = ALPHA,
                  seed: int = SEED) -> DataFrame:
    """Per row of ``docs`` (key, text): key, text, ids (array<int>), n_ids."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        for part, ids, n, _ in _encoded(pieces(model, alpha), batches, seed):
            yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), ids, n], names=["key", "text", "ids", "n_ids"])

    return _keyed(docs, key).mapInArrow(run, "key long, text string, ids array<int>, n_ids long").withColumnRenamed("key", key)


def round_trip(docs: DataFrame, key: str = "doc_id", model: str = MODEL, alpha: float = ALPHA,
               seed: int = SEED) -> DataFrame:
    """``encode_pieces`` and decoding in one pass: key, ids, n_ids and whether
    the decoded ids equal the text (both null: true)."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        p = pieces(model, alpha)
        for part, ids, n, offsets in _encoded(p, batches, seed):
            text = part.column(1)
            same = pc.equal(p.decode(ids.flatten(), offsets), text.cast(pa.binary()))
            yield pa.RecordBatch.from_arrays([part.column(0), ids, n, pc.if_else(text.is_null(), True, same)],
                                             names=["key", "ids", "n_ids", "lossless"])

    return _keyed(docs, key).mapInArrow(run, "key long, ids array<int>, n_ids long, lossless boolean").withColumnRenamed("key", key)


def decode_pieces(encoded: DataFrame, model: str = MODEL) -> DataFrame:
    """``encoded`` (with ids array<int>) with a column ``decoded``."""
    python_ready(encoded.sparkSession)
    names = [c for c in encoded.columns if c != "decoded"]
    schema = ", ".join(f"`{c}` {encoded.schema[c].dataType.simpleString()}" for c in names) + ", decoded string"
    at = names.index("ids")

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa
        import pyarrow.compute as pc
        p = pieces(model, 1.0)
        for b in batches:
            ids = b.column(at)
            n = np.asarray(pc.fill_null(pc.list_value_length(ids), 0)).astype(np.int64)
            offsets = pa.array(np.concatenate([[0], np.cumsum(n)]).astype(np.int32))
            text = pc.if_else(ids.is_null(), None, p.decode(ids.flatten(), offsets)).cast(pa.string())
            yield pa.RecordBatch.from_arrays([*b.columns, text], names=[*names, "decoded"])

    return encoded.select(*names).mapInArrow(run, schema)


# query --------------------------------------------------------------------
def op5_sentencepiece(spark, sf_dir: str) -> DataFrame:
    return round_trip(table(spark, sf_dir, "documents"))
