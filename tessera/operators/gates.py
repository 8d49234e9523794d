"""Row gates and per-row flags.

All are native column expressions, so Catalyst can push the cheap ones into
the Parquet scan and keep them inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import constants as C


def _lit_array(values: Sequence[str]) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast("array<string>")


def overlaps(arr: Column, values: Sequence[str]) -> Column:
    """``any(x in values for x in arr)``; a null array counts as empty and a
    null element never matches (arrays_overlap alone can return NULL)."""
    if not values:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(arr, _lit_array(values)), F.lit(False))


# P1 -----------------------------------------------------------------------
def _cols(**named):
    """Column arguments default to the record's column of the same name."""
    return [F.col(default) if c is None else c for default, c in named.items()]


def audit_skip(author: Column | None = None, text: Column | None = None,
               tags: Column | None = None, warnings: Column | None = None,
               views: Column | None = None,
               blocked_tags: Sequence[str] = C.EXCLUDE_GENRES,
               blocked_warnings: Sequence[str] = C.EXCLUDE_WARNINGS,
               min_views: float = C.MIN_VIEWS) -> Column:
    """Audit gate: skip when author or text is null, a tag or warning is
    blocked, or views are below the threshold (missing views count as 0)."""
    author, text, tags, warnings, views = _cols(author=author, text=text, tags=tags, warnings=warnings,
                                                average_views=views)
    return (author.isNull() | text.isNull()
            | overlaps(tags, blocked_tags) | overlaps(warnings, blocked_warnings)
            | (F.coalesce(views, F.lit(0.0)) < F.lit(min_views)))


# P3 -----------------------------------------------------------------------
def unicode_pattern(pattern: str) -> str:
    """Make ``\\b``, ``\\w``, ``\\s`` and case folding Unicode-aware, as in
    Python's ``re``."""
    return "(?U)" + pattern


def pattern_flag(text: Column, patterns: Sequence[str], skip: Column | None = None) -> Column:
    """True when any pattern matches ``text``. The patterns are a caller
    parameter. When ``skip`` is given the regex is evaluated only for rows
    that are not skipped (NULL otherwise), so cheap predicates run first."""
    if not patterns:
        hit = F.lit(False)
    else:
        joined = "|".join(f"(?:{p})" for p in patterns)
        hit = text.rlike(unicode_pattern(joined))
    return hit if skip is None else F.when(~skip, hit)


# P2 -----------------------------------------------------------------------
def prepare_keep(author: Column | None = None, text: Column | None = None,
                 tags: Column | None = None, warnings: Column | None = None,
                 views: Column | None = None,
                 blocked_tags: Sequence[str] = C.EXCLUDE_GENRES,
                 blocked_warnings: Sequence[str] = C.EXCLUDE_WARNINGS,
                 min_views: float = C.MIN_VIEWS) -> Column:
    """Prepare gate (without the author exclusion, which is a join): keep
    rows with a non-empty author and text, views at or above the threshold
    and no blocked tag or warning. The views comparison is written without
    a ``coalesce`` so that it reaches the Parquet scan as a pushed filter
    (a NULL view fails it, the same as 0)."""
    author, text, tags, warnings, views = _cols(author=author, text=text, tags=tags, warnings=warnings,
                                                average_views=views)
    return ((F.length(author) > 0) & (F.length(text) > 0)
            & (views >= F.lit(float(min_views)))
            & ~overlaps(warnings, blocked_warnings) & ~overlaps(tags, blocked_tags))


# P4 -----------------------------------------------------------------------
def long_story(df: DataFrame, min_tokens: int = C.LONG_STORY_MIN_TOKENS) -> DataFrame:
    """``format == 'story'`` and ``token_length > min_tokens`` (missing = 0)."""
    return df.where((F.col("format") == "story") & (F.col("token_length") > min_tokens))


# P5 -----------------------------------------------------------------------
def length_gate(df: DataFrame, min_tokens: int, n_tokens: str = "n_tokens") -> DataFrame:
    """Keep rows whose untruncated token count reaches ``min_tokens``."""
    return df.where(F.col(n_tokens) >= min_tokens)


# P7 -----------------------------------------------------------------------
_STRIP = r"^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"


def py_strip(s: Column) -> Column:
    """Python ``str.strip()``: Unicode whitespace on both ends."""
    return F.regexp_replace(s, "(?U)" + _STRIP, "")


def py_rstrip(s: Column) -> Column:
    return F.regexp_replace(s, r"(?U)[\s\x1c-\x1f]+$", "")


def titled_text(text: Column | None = None, title: Column | None = None) -> Column:
    """``Chapter title: {t}\\n\\n{text}`` with ``t`` the stripped title (a
    null title reads ``<untitled>``); an empty title leaves the text alone."""
    text, title = _cols(text=text, chapter_title=title)
    t = F.when(title.isNull(), F.lit(C.UNTITLED)).otherwise(py_strip(title))
    return F.when(t == "", text).otherwise(
        F.concat(F.lit(C.TITLE_TEMPLATE_PREFIX), t, F.lit("\n\n"), text))
