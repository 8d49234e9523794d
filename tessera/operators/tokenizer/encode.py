"""Encoding and decoding with a trained model.

Encoding: the JVM cuts out special tokens, normalizes (NFC) and splits
into byte-level pre-tokens (:func:`tessera.functions.bytelevel.raw_pretokens`).
Each pre-token then needs its byte symbols, the numeric split and the merge
loop; that runs in Python, as an Arrow UDF (whole Arrow batches), once per
*distinct* word of a batch and over all of them at once. Nothing is kept from
batch to batch but the model, and what a batch needs beside its words and ids
is bounded by ``STEP`` and ``MERGED``. No shuffle: encoding is a map-side projection.

Decoding is JVM-only: ids -> tokens through an array literal of the
vocabulary (bounded by the vocabulary size), byte symbols -> UTF-8.
"""

from __future__ import annotations

import hashlib
import heapq

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F

from ... import constants as C
from ...functions import bytelevel as B
from .train import BPEModel

_CACHE: dict[str, "_Table"] = {}
_CACHE_LIMIT = 4            # models kept per worker
STEP = 200_000              # occurrences expanded together
MERGED = 250_000            # bytes of distinct words merged together
_LONG = 64                  # words of more bytes are merged one by one

_B2S = B.byte_to_symbol()
_NUMERIC = set(B.NUMERIC_SYMBOLS)


def _fingerprint(model: BPEModel) -> str:
    h = hashlib.sha1()
    for t in model.vocab:
        h.update(t.encode("utf-8") + b"\x00")
    for a, b in model.merges:
        h.update(a.encode("utf-8") + b"\x01" + b.encode("utf-8") + b"\x00")
    return h.hexdigest()


def encoder(model: BPEModel):
    """``Column(text) -> Column(ARRAY<INT>)`` for this model."""
    from pyspark.sql import SparkSession
    from ...session import ship_package
    ship_package(SparkSession.getActiveSession())
    key = _fingerprint(model)
    vocab, merges = list(model.vocab), list(model.merges)
    specials = set(vocab[:model.n_specials])

    @F.arrow_udf("array<int>")
    def encode_words(words: pa.Array) -> pa.Array:
        if isinstance(words, pa.ChunkedArray):
            words = words.combine_chunks()
        table = _CACHE.get(key)
        if table is None:
            while len(_CACHE) >= _CACHE_LIMIT:
                _CACHE.pop(next(iter(_CACHE)))
            table = _CACHE[key] = _Table(vocab, merges, specials)
        return _encode_batch(words, table)

    def encode(text: Column) -> Column:
        return encode_words(B.raw_pretokens(text))

    return encode


class _Table:
    """A model as arrays: symbols numbered, merges as sorted codes of symbol pairs."""

    def __init__(self, vocab: list[str], merges: list[tuple[str, str]], specials: set):
        self.tok_id = {t: i for i, t in enumerate(vocab)}
        self.unk = self.tok_id[C.UNK]
        self.ranks = {(a, b): i for i, (a, b) in enumerate(merges)}
        self.specials = sorted(specials)
        symbols: dict[str, int] = {}
        for s in _B2S.values():
            symbols.setdefault(s, len(symbols))
        for a, b in merges:
            for s in (a, b, a + b):
                symbols.setdefault(s, len(symbols))
        self.n = len(symbols)
        self.of_byte = np.array([symbols[_B2S[b]] for b in range(256)], np.int64)
        self.alone = np.array([_B2S[b] in _NUMERIC for b in range(256)])
        self.id = np.array([self.tok_id.get(s, self.unk) for s in symbols], np.int32)
        code = {symbols[a] * self.n + symbols[b]: (i, symbols[a + b]) for (a, b), i in self.ranks.items()}
        self.codes = np.array(sorted(code), np.int64)
        self.rank = np.array([code[c][0] for c in sorted(code)], np.int64)
        self.result = np.zeros(len(merges), np.int64)
        for i, made in code.values():
            self.result[i] = made

    def pair_rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of each pair; ``len(result)`` if it is no merge."""
        none = len(self.result)
        if not len(self.codes):
            return np.full(len(left), none, np.int64)
        want = left * self.n + right
        at = np.minimum(np.searchsorted(self.codes, want), len(self.codes) - 1)
        return np.where(self.codes[at] == want, self.rank[at], none)

    def merge(self, data: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of words laid end to end as UTF-8 bytes. In each round every
        word merges its lowest-rank pair, the leftmost of equals, as :func:`_merge` does."""
        none = len(self.result)
        sym, alone = self.of_byte[data], self.alone[data]
        word = np.repeat(np.arange(len(length)), length)
        rank = np.full(len(sym), none, np.int64)               # of the pair that starts here
        joined = np.flatnonzero((word[:-1] == word[1:]) & ~alone[:-1] & ~alone[1:])
        rank[joined] = self.pair_rank(sym[joined], sym[joined + 1])
        done_sym, done_word = [], []
        while len(sym):
            head = np.flatnonzero(np.diff(word, prepend=-1))
            best = np.minimum.reduceat(rank * len(sym) + np.arange(len(sym)), head)
            lowest, at = best // len(sym), best % len(sym)
            on = lowest < none
            if not on.all():                                   # words without a merge are done
                live = np.repeat(on, np.diff(np.append(head, len(sym))))
                done_sym.append(sym[~live])
                done_word.append(word[~live])
                at = (np.cumsum(live) - 1)[at[on]]
                lowest, sym, word, alone, rank = lowest[on], sym[live], word[live], alone[live], rank[live]
                if not len(sym):
                    break
            sym[at] = self.result[lowest]
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            at -= np.arange(len(at))                           # one symbol a word leaves before it
            sym, word, alone, rank = sym[keep], word[keep], alone[keep], rank[keep]
            for left in (at, at[at > 0] - 1):
                right = np.minimum(left + 1, len(sym) - 1)
                ok = (left + 1 < len(sym)) & (word[left] == word[right]) & ~alone[left] & ~alone[right]
                # the symbol before a word's first is another word's: its pair stays none
                rank[left] = np.where(ok, self.pair_rank(sym[left], sym[right]), none)
        sym, word = np.concatenate([*done_sym, sym]), np.concatenate([*done_word, word])
        sym = sym[np.argsort(word, kind="stable")]
        return self.id[sym], np.bincount(word, minlength=len(length)).astype(np.int64)

    def encode(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids, ids per word) of distinct words."""
        raw = words.cast(pa.large_binary())
        ends = np.frombuffer(raw.buffers()[1], np.int64)[raw.offset:raw.offset + len(raw) + 1] if len(raw) else np.zeros(1, np.int64)
        data = np.frombuffer(raw.buffers()[2] or b"", np.uint8)
        length = np.diff(ends)
        special = np.asarray(pc.is_in(words, value_set=pa.array(self.specials, words.type)), dtype=bool)
        single = special | (length > _LONG)
        ids: list[np.ndarray] = []
        count = np.zeros(len(words), np.int64)
        lo = 0
        while lo < len(words):
            hi = max(lo + 1, int(np.searchsorted(ends, ends[lo] + MERGED, side="right")) - 1)
            many = ~single[lo:hi]
            part = data[ends[lo]:ends[hi]][np.repeat(many, length[lo:hi])]
            found, n = self.merge(part, length[lo:hi] * many)
            count[lo:hi] = n
            odd = lo + np.flatnonzero(~many)
            if len(odd):
                stop = np.cumsum(n)
                texts = words.take(pa.array(odd)).to_pylist()
                own = [np.array(self._one(w, s), np.int32) for w, s in zip(texts, special[odd])]
                pieces, before = [], 0
                for k, x in zip(odd - lo, own):
                    pieces += [found[before:stop[k]], x]
                    before = stop[k]
                    count[lo + k] = len(x)
                found = np.concatenate([*pieces, found[before:]])
            ids.append(found)
            lo = hi
        return np.concatenate(ids) if ids else np.zeros(0, np.int32), count

    def _one(self, word: str, special: bool) -> list[int]:
        if special:
            return [self.tok_id[word]]
        return [i for piece in _pieces(word) for i in _merge(piece, self.ranks, self.tok_id, self.unk)]


def _encode_batch(words: pa.ListArray, table: _Table) -> pa.Array:
    """Encode one Arrow batch of pre-token lists: its distinct pre-tokens at
    once, then every occurrence, ``STEP`` at a time."""
    enc = pc.dictionary_encode(words.flatten())
    u_flat, u_len = table.encode(enc.dictionary)
    u_off = np.cumsum(u_len) - u_len
    codes = enc.indices.to_numpy(zero_copy_only=False)
    total = int(np.bincount(codes, minlength=len(u_len)) @ u_len) if len(codes) else 0
    if total > np.iinfo(np.int32).max:
        raise ValueError("an Arrow batch has more than 2**31 - 1 ids; lower spark.sql.execution.arrow.maxRecordsPerBatch")
    out = np.empty(total, np.int32)
    run = np.zeros(len(codes) + 1, np.int32)               # ids before each occurrence
    for lo in range(0, len(codes), STEP):
        c = codes[lo:lo + STEP]
        lens = u_len[c]
        end = np.cumsum(lens)
        first = int(run[lo])
        run[lo + 1:lo + 1 + len(c)] = first + end
        idx = np.arange(int(end[-1])) + np.repeat(u_off[c] - (end - lens), lens)
        out[first:first + len(idx)] = u_flat[idx]
    # row offsets: token offsets of the input mapped through the running id count
    tok_off = words.offsets.to_numpy(zero_copy_only=False).astype(np.int64) - words.offsets[0].as_py()
    return pa.ListArray.from_arrays(pa.array(run[tok_off]), pa.array(out), mask=words.is_null())


def _pieces(raw: str) -> list[str]:
    """Byte symbols of a raw pre-token, numeric symbols standing alone."""
    out, cur = [], []
    for b in raw.encode("utf-8"):
        s = _B2S[b]
        if s in _NUMERIC:
            if cur:
                out.append("".join(cur))
                cur = []
            out.append(s)
        else:
            cur.append(s)
    if cur:
        out.append("".join(cur))
    return out


def _merge(word: str, ranks: dict, tok_id: dict, unk: int) -> list[int]:
    """Merge a word's symbols by rank: repeatedly the lowest-rank adjacent
    pair, leftmost first; symbols outside the vocabulary become ``<unk>``.
    The symbols are a linked list and the pairs a heap, so a word of n
    symbols takes O(n log n) steps."""
    syms, n = list(word), len(word)
    after, before = list(range(1, n + 1)), list(range(-1, n - 1))
    heap = [(r, i, syms[i], syms[i + 1]) for i in range(n - 1)
            if (r := ranks.get((syms[i], syms[i + 1]))) is not None]
    heapq.heapify(heap)
    while heap:
        _, i, left, right = heapq.heappop(heap)
        j = after[i]
        if syms[i] != left or j >= n or syms[j] != right:
            continue                       # one of the two has been merged meanwhile
        syms[i], syms[j] = left + right, None
        k = after[i] = after[j]
        if k < n:
            before[k] = i
        for a, b in ((before[i], i), (i, k)):
            if a >= 0 and b < n and (r := ranks.get((syms[a], syms[b]))) is not None:
                heapq.heappush(heap, (r, a, syms[a], syms[b]))
    return [tok_id.get(s, unk) for s in syms if s is not None]


def decoder(model: BPEModel, skip_special: bool = False):
    """``Column(ARRAY<INT>) -> Column(text)``; with ``skip_special`` the
    special ids (chat markers, house tokens, operators *and digits*) are
    dropped, as the reference tokenizer does."""
    # one literal that Spark folds to an array: an expression per token is too much for 16,384
    vocab_arr = F.split(F.lit("\0".join(model.vocab)), "\0")
    n_spec = model.n_specials

    def decode(ids: Column) -> Column:
        keep = F.filter(ids, lambda i: i >= n_spec) if skip_special else ids
        toks = F.transform(keep, lambda i: F.coalesce(F.try_element_at(vocab_arr, i + 1), F.lit("")))
        return B.from_symbols(F.array_join(toks, ""))

    return decode
