"""Quality rules: a threshold table compiled into one projection.

``METRICS`` counts things of a text (words, their code points, symbols,
lines, repeated words, stop words); ``RULES`` bounds ratios of two counts.
``quality_rules`` turns both into a single ``select`` of built-in functions:
no shuffle, no user function, one pass over the text.

Defined results: a null or empty text has zero of everything and fails
``min_words``; a ratio whose denominator is zero never fails its rule;
repeated rows are judged one by one; other columns of the input are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import bind, narrow, words_of

#: Words of this many form a window for ``n_repeat_words``.
WINDOW = 5

#: Frequent function words of the four languages.
STOP_WORDS = (
    "the", "of", "and", "to", "in", "a", "is", "that", "for", "it", "on", "as", "with", "was", "be", "by", "at", "this", "are", "or",
    "der", "die", "das", "und", "den", "von", "zu", "mit", "auf", "für", "ist", "im", "dem", "nicht", "ein", "eine", "als", "auch", "des", "sich",
    "le", "la", "les", "de", "et", "un", "une", "du", "que", "qui", "dans", "pour", "pas", "sur", "par", "est", "au", "avec", "ce",
    "el", "los", "las", "y", "en", "del", "se", "por", "con", "no", "su", "para", "una", "al", "lo",
)


@dataclass(frozen=True)
class Rule:
    """Fails when ``scale * top`` is below ``low`` or above ``high`` times
    ``bottom`` (``bottom`` None: times 1), judged only from ``min_words`` on."""
    name: str
    top: str
    bottom: str | None
    low: int | None = None
    high: int | None = None
    scale: int = 100
    min_words: int = 0


#: The two rules every table starts with.
BASE_RULES = (
    Rule("min_words", "n_words", None, low=10, scale=1),
    Rule("repeat_words", "n_repeat_words", "n_words", high=20),
)

#: The further thresholds; all judged by integer arithmetic.
METHOD_RULES = (
    Rule("symbols_per_word", "n_symbols", "n_words", high=30),
    Rule("shout_words", "n_shout_words", "n_words", high=40),
    Rule("word_length_low", "word_chars", "n_words", low=200, min_words=50),
    Rule("word_length_high", "word_chars", "n_words", high=1500),
    Rule("stop_words", "n_stop_words", "n_words", low=3, min_words=100),
    Rule("dup_lines", "n_dup_lines", "n_lines", high=40, min_words=100),
)


def _repeat_words(words: Column) -> Column:
    """Words inside windows of ``WINDOW`` words found twice or more."""
    def window_hash(w: Column, i: Column) -> Column:
        return F.xxhash64(*[F.get(w, i + k) for k in range(WINDOW)])

    def covered(starts: Column) -> Column:
        last = F.size(starts) - 1
        step = F.transform(starts, lambda p, k: F.when(k == last, F.lit(WINDOW)).otherwise(
            F.least(F.lit(WINDOW), F.get(starts, k + 1) - p)))
        return F.aggregate(step, F.lit(0), lambda a, x: a + x)

    def repeated_starts(pairs: Column) -> Column:
        same = F.filter(pairs, lambda x, k: ((k > 0) & (F.get(pairs, k - 1)["h"] == x["h"]))
                        | F.coalesce(F.get(pairs, k + 1)["h"] == x["h"], F.lit(False)))
        return F.sort_array(F.transform(same, lambda x: x["p"]))

    def of_words(w: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(w) - WINDOW)

        def of_hashes(h: Column) -> Column:
            pairs = F.sort_array(F.transform(h, lambda x, p: F.struct(x.alias("h"), p.alias("p"))))
            # most texts repeat no window; only the others are sorted
            return F.when(F.size(F.array_distinct(h)) == F.size(h), F.lit(0)).otherwise(
                bind(pairs, lambda s: bind(repeated_starts(s), covered)))

        return F.when(F.size(w) <= WINDOW, F.lit(0)).otherwise(
            bind(F.transform(at, lambda i: window_hash(w, i)), of_hashes))

    return of_words(words)


def metrics(text: Column) -> Column:
    """Struct of all counts (long) of a text, computed in one go."""
    text = F.coalesce(text, F.lit(""))

    def of(w: Column) -> Column:
        lines = F.filter(F.split(text, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        counts = {
            "n_words": F.size(w),
            "word_chars": F.length(F.array_join(w, "")),
            "n_symbols": F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", "")),
            "n_repeat_words": _repeat_words(w),
            "n_stop_words": F.size(F.filter(w, lambda x: F.lower(x).isin(*STOP_WORDS))),
            "n_shout_words": F.size(F.filter(w, lambda x: x.endswith("!!"))),
        }
        line_counts = bind(lines, lambda x: F.struct(
            F.size(x).cast("long").alias("n_lines"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
        return F.struct(*[c.cast("long").alias(n) for n, c in counts.items()], line_counts.alias("lines"))

    return bind(words_of(text), of)


def failed(rule: Rule, m) -> Column:
    """Whether the counts ``m`` (name -> column) break the rule."""
    value = F.lit(rule.scale) * m(rule.top)
    base = m(rule.bottom) if rule.bottom else F.lit(1)
    bad = F.lit(False)
    if rule.low is not None:
        bad = bad | (value < F.lit(rule.low) * base)
    if rule.high is not None:
        bad = bad | (value > F.lit(rule.high) * base)
    if rule.bottom:
        bad = bad & (base > 0)
    if rule.min_words:
        bad = bad & (m("n_words") >= rule.min_words)
    return bad


def quality_rules(docs: DataFrame, base: tuple[Rule, ...] = BASE_RULES,
                  method: tuple[Rule, ...] = METHOD_RULES) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): the counts, ``base_failed``,
    ``failed_rules`` (names in table order) and ``kept``."""
    d = narrow(docs, {"doc_id": "long", "text": "string"}).select("doc_id", metrics(F.col("text")).alias("m"))

    def m(name: str) -> Column:
        return F.col(f"m.lines.{name}" if name in ("n_lines", "n_dup_lines") else f"m.{name}")

    base_failed = F.lit(False)
    for r in base:
        base_failed = base_failed | failed(r, m)
    names = F.array_compact(F.array(*[F.when(failed(r, m), F.lit(r.name)) for r in (*base, *method)]))
    return d.select("doc_id", *[m(c).alias(c) for c in (
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words", "n_shout_words", "n_lines")],
        base_failed.alias("base_failed"), names.alias("failed_rules"), (F.size(names) == 0).alias("kept"))


# query --------------------------------------------------------------------
def op8_quality_rules(spark, sf_dir: str) -> DataFrame:
    from .common import table
    return quality_rules(table(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_stop_words",
        "n_shout_words", "base_failed", "kept")


def _sql() -> str:
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT doc_id, t, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS l FROM d),
tok AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM w),
win AS (SELECT doc_id, p, word || ' ' || lead(word, 1) OVER o || ' ' || lead(word, 2) OVER o || ' ' ||
               lead(word, 3) OVER o || ' ' || lead(word, 4) OVER o AS g
        FROM tok WINDOW o AS (PARTITION BY doc_id ORDER BY p)),
dup AS (SELECT doc_id, p FROM (SELECT doc_id, p, count(*) OVER (PARTITION BY doc_id, g) AS c FROM win WHERE g IS NOT NULL)
        WHERE c > 1),
rep AS (SELECT doc_id, count(DISTINCT p + k) AS n FROM dup, (SELECT unnest(range({WINDOW})) AS k) GROUP BY doc_id),
m AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, length(list_aggregate(list_concat(w, ['']), 'string_agg', ''))::BIGINT AS word_chars,
             length(regexp_replace(t, '[^#*$%&|<>]+', '', 'g'))::BIGINT AS n_symbols,
             (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines, len(l)::BIGINT AS n_lines,
             coalesce(rep.n, 0)::BIGINT AS n_repeat_words,
             len(list_filter(w, lambda x: lower(x) IN ({stop})))::BIGINT AS n_stop_words,
             len(list_filter(w, lambda x: suffix(x, '!!')))::BIGINT AS n_shout_words
      FROM w LEFT JOIN rep ON w.doc_id = rep.doc_id)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_stop_words, n_shout_words,
       n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
       NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words
            OR (n_words > 0 AND 100 * n_symbols > 30 * n_words)
            OR (n_words > 0 AND 100 * n_shout_words > 40 * n_words)
            OR (n_words >= 50 AND 100 * word_chars < 200 * n_words)
            OR (n_words > 0 AND 100 * word_chars > 1500 * n_words)
            OR (n_words >= 100 AND 100 * n_stop_words < 3 * n_words)
            OR (n_words >= 100 AND n_lines > 0 AND 100 * n_dup_lines > 40 * n_lines)) AS kept
FROM m"""


OP8_SQL = _sql()
