"""ChatML rendering of a ``messages`` array (H1-H4, H6).

Three variants differ on purpose and are kept apart:

* training format (tokenizer corpus): content right-stripped, newline
  before and after the end marker;
* chat template: no newline after the end marker, the assistant header is
  always appended;
* fallback: newline after the end marker; the prompt form adds the header.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..constants import ASSISTANT_HEADER, IM_END, IM_START


def _render(messages: Column, piece) -> Column:
    return F.array_join(F.transform(messages, piece), "")


def _rstrip(s: Column) -> Column:
    # Python str.rstrip(): Unicode whitespace (Spark rtrim strips spaces only)
    return F.regexp_replace(s, r"(?U)[\s\x1c-\x1f]+$", "")


# H1
def chatml_train(messages: Column) -> Column:
    return _render(messages, lambda m: F.concat(
        F.lit(IM_START), m["role"], F.lit("\n"), _rstrip(m["content"]), F.lit("\n" + IM_END + "\n")))


# H2
def chatml_template(messages: Column, add_header: bool = True) -> Column:
    body = _render(messages, lambda m: F.concat(
        F.lit(IM_START), m["role"], F.lit("\n"), m["content"], F.lit(IM_END)))
    return F.concat(body, F.lit(ASSISTANT_HEADER)) if add_header else body


def template_piece(role: Column, content: Column) -> Column:
    """One message of the chat template (used for per-message costs)."""
    return F.concat(F.lit(IM_START), role, F.lit("\n"), content, F.lit(IM_END))


# H3
def chatml_fallback(messages: Column) -> Column:
    return _render(messages, lambda m: F.concat(
        F.lit(IM_START), m["role"], F.lit("\n"), m["content"], F.lit(IM_END + "\n")))


# H4
def chatml_prompt(messages: Column) -> Column:
    return F.concat(chatml_fallback(messages), F.lit(ASSISTANT_HEADER))


# H6
def preview(s: Column, n: int = 50) -> Column:
    return F.substring(s, 1, n)
