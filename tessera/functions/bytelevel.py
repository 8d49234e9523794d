"""Byte-level text handling as column expressions, JVM-side but for the last.

* special-token segmentation (leftmost match over the special list),
* NFC normalization (ICU4J in the JVM through ``reflect``),
* UTF-8 bytes <-> byte symbols (the public GPT-2 byte-to-unicode rule,
  expressed as ``encode``/``decode`` + a 1:1 ``translate``),
* byte-level pre-tokenization with individual numeric symbols,
* the *byte variant* encoder: no merges, every UTF-8 byte is one id (an Arrow
  UDF over whole batches).
"""

from __future__ import annotations

import re

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import BYTELEVEL_PATTERN, SPECIAL_IDS, SPECIAL_TOKENS


# --------------------------------------------------------------------------
# byte <-> symbol rule
# --------------------------------------------------------------------------
def _printable_bytes() -> list[int]:
    return (list(range(ord("!"), ord("~") + 1)) + list(range(ord("¡"), ord("¬") + 1))
            + list(range(ord("®"), ord("ÿ") + 1)))


def byte_to_symbol() -> dict[int, str]:
    """Printable bytes stand for themselves; the others, in byte order, take
    the code points from 256 upward."""
    keep = set(_printable_bytes())
    out, n = {}, 0
    for b in range(256):
        if b in keep:
            out[b] = chr(b)
        else:
            out[b] = chr(256 + n)
            n += 1
    return out


_B2S = byte_to_symbol()
# translate() tables: Latin-1 char of each remapped byte -> its symbol
_FROM = "".join(chr(b) for b in range(256) if _B2S[b] != chr(b))
_TO = "".join(_B2S[b] for b in range(256) if _B2S[b] != chr(b))

# Byte symbols that are numeric (\p{N}); the digit pre-tokenizer isolates them
NUMERIC_SYMBOLS = "".join(s for s in sorted(_B2S.values()) if re.match(r"\d|[²³¹¼½¾]", s))


def byte_symbol_alphabet() -> list[str]:
    """All 256 byte symbols sorted by code point (alphabet order)."""
    return sorted(_B2S.values())


def byte_variant_vocab() -> list[tuple[int, str]]:
    """Byte-variant vocabulary: the 28 specials, then every byte symbol not
    already present, in code-point order (274 ids)."""
    vocab = list(enumerate(SPECIAL_TOKENS))
    seen = set(SPECIAL_TOKENS)
    for s in byte_symbol_alphabet():
        if s not in seen:
            vocab.append((len(vocab), s))
            seen.add(s)
    return vocab


def _byte_ids() -> list[int]:
    sym_id = {s: i for i, s in byte_variant_vocab()}
    return [sym_id[_B2S[b]] for b in range(256)]


BYTE_IDS = _byte_ids()
BYTE_VOCAB_SIZE = len(byte_variant_vocab())


# --------------------------------------------------------------------------
# special tokens
# --------------------------------------------------------------------------
def special_regex(tokens: list[str] = SPECIAL_TOKENS) -> str:
    """The special tokens as one regex, grouped by first character (a
    first-character trie) behind a one-class lookahead, so a position that
    cannot start a special costs one class test instead of one attempt per
    token. Within a group the longer token comes first; with this set no
    two specials of different length match at one position anyway, so the
    leftmost match is the leftmost-longest one."""
    groups: dict[str, list[str]] = {}
    for t in tokens:
        groups.setdefault(t[0], []).append(t)
    alts = []
    for first, toks in groups.items():
        rests = [re.escape(t[1:]) for t in sorted(toks, key=lambda t: (-len(t), SPECIAL_TOKENS.index(t)))]
        if rests == [""]:
            alts.append(re.escape(first))
        else:
            alts.append(re.escape(first) + "(?:" + "|".join(rests) + ")")
    digits = [a for a in alts if len(a) == 1 and a.isdigit()]
    others = [a for a in alts if a not in digits]
    if digits:
        others.append("[" + "".join(digits) + "]")
    starts = "".join(re.escape(f) for f in groups)
    return f"(?=[{starts}])(?:" + "|".join(others) + ")"


SPECIAL_RE = special_regex()


def _special_array() -> Column:
    return F.array(*[F.lit(t) for t in SPECIAL_TOKENS])


def _special_map() -> Column:
    return F.create_map(*[x for t in SPECIAL_TOKENS for x in (F.lit(t), F.lit(SPECIAL_IDS[t]))])


def segments(text: Column, pattern: str = SPECIAL_RE) -> Column:
    """Split a text into specials and the runs between them (order kept,
    empty runs dropped).

    ``split`` on the special pattern gives the runs, ``regexp_extract_all``
    the specials (the same leftmost, non-overlapping matches); the two are
    interleaved. Neither regex repeats a group, so Java's matcher does not
    recurse per character and long texts are safe."""
    runs = F.split(text, pattern, -1)
    specials = F.regexp_extract_all(text, F.lit(f"({pattern})"), 1)
    # arrays_zip pads the shorter side with NULL; lambdas capture nothing
    # (a captured expression would be re-evaluated for every element)
    pairs = F.arrays_zip(runs.alias("r"), specials.alias("s"))
    inter = F.flatten(F.transform(pairs, lambda z: F.when(
        z["s"].isNull(), F.array(z["r"])).otherwise(F.array(z["r"], z["s"]))))
    return F.filter(inter, lambda p: p != "")


def is_special(piece: Column) -> Column:
    return F.array_contains(_special_array(), piece)


def special_id(piece: Column) -> Column:
    return F.element_at(_special_map(), piece)


def special_token_counts(text: Column) -> Column:
    """All special-token occurrences, leftmost first, as an array."""
    return F.regexp_extract_all(text, F.lit(f"({SPECIAL_RE})"), 1)


# --------------------------------------------------------------------------
# NFC: ICU4J ships with Spark, so normalization runs in the JVM through
# ``reflect`` (Normalizer.compose(s, false) is NFC). Spark has no built-in.
# --------------------------------------------------------------------------
_ICU = "com.ibm.icu.text.Normalizer"


_HAS_ICU: bool | None = None


def _icu_available() -> bool:
    global _HAS_ICU
    if _HAS_ICU is None:
        from pyspark.sql import SparkSession
        spark = SparkSession.getActiveSession()
        try:
            spark.sparkContext._jvm.java.lang.Class.forName(_ICU)
            _HAS_ICU = True
        except Exception:  # noqa: BLE001 - any failure means "not on the classpath"
            _HAS_ICU = False
    return _HAS_ICU


def nfc(s: Column) -> Column:
    """NFC in the JVM (ICU4J); where ICU4J is not on the classpath, a small
    Arrow UDF with Python's ``unicodedata`` (already-normalized strings are
    passed through after a quick check). Catalyst treats ``reflect`` as
    non-deterministic: project columns built on it (token counts, ids)
    before aggregating them."""
    if _icu_available():
        return F.when(s.isNotNull(), F.reflect(F.lit(_ICU), F.lit("compose"), s, F.lit(False)))
    global _NFC_UDF
    from pyspark.sql import SparkSession
    from ..session import ship_package
    ship_package(SparkSession.getActiveSession())
    if _NFC_UDF is None:
        _NFC_UDF = F.arrow_udf("string")(_nfc_py)
    return _NFC_UDF(s)


def _nfc_py(arr):
    import unicodedata

    import pyarrow as pa
    vals = arr.to_pylist()
    out = [v if v is None or v.isascii() or unicodedata.is_normalized("NFC", v)
           else unicodedata.normalize("NFC", v) for v in vals]
    return pa.array(out, type=pa.string())


_NFC_UDF = None


def nfc_each(a: Column) -> Column:
    return F.transform(a, lambda s: nfc(s))


def normalized_segments(text: Column) -> Column:
    """Specials extracted from the raw text; every other run NFC-normalized
    on its own."""
    return F.transform(segments(text), lambda p: F.when(is_special(p), p).otherwise(nfc(p)))


# --------------------------------------------------------------------------
# bytes <-> symbols
# --------------------------------------------------------------------------
def latin1_bytes(s: Column) -> Column:
    """A string whose i-th char has code = i-th UTF-8 byte of ``s``."""
    return F.decode(F.encode(s, "UTF-8"), "ISO-8859-1")


def to_symbols(s: Column) -> Column:
    """UTF-8 bytes of ``s`` as byte symbols (one char per byte)."""
    return F.translate(latin1_bytes(s), _FROM, _TO)


def from_symbols(s: Column) -> Column:
    """Inverse of :func:`to_symbols`; invalid UTF-8 becomes U+FFFD."""
    raw = F.encode(F.translate(s, _TO, _FROM), "ISO-8859-1")
    return F.make_valid_utf8(raw.cast("string"))


def isolate_numeric(symbols: Column) -> Column:
    """Split a symbol string so that every numeric symbol stands alone."""
    cls = re.escape(NUMERIC_SYMBOLS)
    return F.regexp_extract_all(symbols, F.lit(f"[{cls}]|[^{cls}]+"), 0)


def _factored_pattern(pattern: str) -> str:
    """The pre-token pattern with its leading contraction alternatives
    ('s|'t|...) folded into one branch behind their shared apostrophe:
    the same matches, one test instead of seven at every position."""
    alts = pattern.split("|")
    contractions = [a for a in alts if a.startswith("'")]
    rest = [a for a in alts if not a.startswith("'")]
    assert alts[:len(contractions)] == contractions
    return "'(?:" + "|".join(a[1:] for a in contractions) + ")|" + "|".join(rest)


# (?U): white space is Unicode white space
PRETOKEN_RE = "(?U)" + _factored_pattern(BYTELEVEL_PATTERN)


def pretokenize(text: Column) -> Column:
    """Byte-level pre-tokens of a (normalized) text, before byte mapping."""
    return F.regexp_extract_all(text, F.lit(PRETOKEN_RE), 0)


def raw_pretokens(text: Column) -> Column:
    """Encoder input: specials kept whole; every other run NFC-normalized
    and split into byte-level pre-tokens (still Unicode, not yet mapped to
    byte symbols -- the encoder maps each *distinct* word once)."""
    segs = normalized_segments(text)
    return F.flatten(F.transform(segs, lambda s: F.when(is_special(s), F.array(s)).otherwise(pretokenize(s))))


def word_pieces(raw: Column) -> Column:
    """A raw pre-token as BPE words: byte symbols, numeric symbols isolated."""
    return isolate_numeric(to_symbols(raw))


def training_words(text: Column) -> Column:
    """Pre-token words as seen by BPE training: NFC, byte-level split, byte
    symbols, numeric symbols isolated. Special tokens are ordinary text."""
    pieces = pretokenize(nfc(text))
    return F.flatten(F.transform(pieces, lambda p: isolate_numeric(to_symbols(p))))


def encoding_words(text: Column) -> Column:
    """Words as seen by the encoder: specials kept whole; other runs NFC,
    pre-tokenized, mapped to byte symbols, numeric symbols isolated."""
    segs = normalized_segments(text)
    return F.flatten(F.transform(segs, lambda s: F.when(
        is_special(s), F.array(s)).otherwise(
        F.flatten(F.transform(pretokenize(s), lambda p: isolate_numeric(to_symbols(p)))))))


# --------------------------------------------------------------------------
# byte variant (no merges). Specials and NFC stay in the JVM; an Arrow UDF maps
# the bytes of a whole batch to ids at once (one array element per byte, made
# and looked up by JVM expressions, cost most of a corpus build).
# --------------------------------------------------------------------------
# A digit's special id is its byte id too, and no canonical composition starts
# with a digit, so only the longer specials part a text.
_LONG = [t for t in SPECIAL_TOKENS if len(t) > 1]
_LONG_RE = special_regex(_LONG)
# the first two characters of a special: most texts hold no such pair
_LONG_HINT = "".join("[" + "".join(sorted({re.escape(t[i]) for t in _LONG})) + "]" for i in (0, 1))
_TABLE = np.array(BYTE_IDS, np.int32)


def _is_long(piece: Column) -> Column:
    return F.array_contains(F.array(*[F.lit(t) for t in _LONG]), piece)


def _byte_parts(text: Column) -> Column:
    """The longer specials of a text and the normalized runs between them."""
    parts = F.transform(segments(text, _LONG_RE), lambda p: F.when(_is_long(p), p).otherwise(nfc(p)))
    return F.when(text.rlike(_LONG_HINT), parts).when(text.isNotNull(), F.array(nfc(text)))


def _parts_to_ids(parts, limit: int | None):
    """Ids of an Arrow batch of :func:`_byte_parts`, a row's first ``limit``."""
    import pyarrow as pa
    import pyarrow.compute as pc
    if isinstance(parts, pa.ChunkedArray):
        parts = parts.combine_chunks()
    values = parts.flatten().cast(pa.large_string())
    if not len(values):
        ids, ends = np.zeros(0, np.int32), np.zeros(1, np.int64)
    else:
        _, offsets, data = values.buffers()
        ends = np.frombuffer(offsets, np.int64)[values.offset:values.offset + len(values) + 1]
        first, ends = ends[0], ends - ends[0]
        ids = _TABLE[np.frombuffer(data, np.uint8, ends[-1], first)] if ends[-1] else np.zeros(0, np.int32)
        which = pc.fill_null(pc.index_in(values, pa.array(_LONG, pa.large_string())), -1).to_numpy()
        special = np.flatnonzero(which >= 0)
        if len(special):
            start, n = ends[special], np.diff(ends)
            ids[start] = np.array([SPECIAL_IDS[t] for t in _LONG], np.int32)[which[special]]
            rest = n[special] - 1                           # a special's bytes but its first give no id
            keep = np.ones(len(ids), bool)
            keep[np.repeat(start + 1 - (np.cumsum(rest) - rest), rest) + np.arange(rest.sum())] = False
            n[special] = 1
            ids, ends = ids[keep], np.concatenate([[0], np.cumsum(n)])
    n_parts = np.asarray(pc.fill_null(pc.list_value_length(parts), 0))
    offsets = ends[np.concatenate([[0], np.cumsum(n_parts, dtype=np.int64)])]
    n = np.diff(offsets)
    if limit is not None and (n > limit).any():
        n = np.minimum(n, limit)
        ids = np.concatenate([ids[a:a + k] for a, k in zip(offsets.tolist(), n.tolist())])
        offsets = np.concatenate([[0], np.cumsum(n)])
    return pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(ids), mask=parts.is_null())


def byte_ids(text: Column, limit: int | None = None) -> Column:
    """Byte-variant encoding of a text: ARRAY<INT>, no BOS/EOS. With ``limit``
    the whole text is encoded, but only its first ids go back to the JVM."""
    from pyspark.sql import SparkSession
    from ..session import ship_package
    ship_package(SparkSession.getActiveSession())

    @F.arrow_udf("array<int>")
    def byte_variant(parts):
        return _parts_to_ids(parts, limit)

    return byte_variant(_byte_parts(text))


def byte_token_count(text: Column) -> Column:
    """Byte-variant token count: one per special, one per UTF-8 byte of the
    normalized text between them."""
    return F.aggregate(_byte_parts(text), F.lit(0).cast("long"),
                       lambda acc, p: acc + F.when(_is_long(p), 1).otherwise(F.octet_length(p)))
