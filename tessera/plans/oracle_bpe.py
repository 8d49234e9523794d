"""DuckDB SQL for the trained tokenizer: a trainer that makes one merge a step
(a recursive query over the distinct words) and an encoder that applies the
merges in rank order. It shares nothing with the Spark trainer, which accepts
several merges a round, or with its heap-based encoder.

A word is text of its symbol ids, each between bars: ``|53||72||9|``. Applying
the merges once each in rank order is what a lowest-rank-first encoder gives
as long as no merge spells an older token, which ``bpe_train`` shows (all
tokens differ).
"""

from __future__ import annotations

from .. import constants as C
from .oracle import ORACLE, SPECIAL_RE_SQL, _sql_list, byte_count_sql, register


def trainer_ctes(vocab_size: int, texts: str = "", min_frequency: int = C.MIN_FREQUENCY) -> str:
    """CTEs ``learned(step, l, r, vocab)``, one row a merge, and ``model(vocab, rules)``:
    the whole vocabulary and the merges as ``pattern + tab + result``."""
    specials = _sql_list(C.SPECIAL_TOKENS)
    return f"""
train_words AS MATERIALIZED ({ORACLE["word_counts"]}),
start AS MATERIALIZED (SELECT {specials} || list(symbol ORDER BY unicode(symbol)) AS vocab
  FROM ({ORACLE["base_alphabet"]}) WHERE NOT list_contains({specials}, symbol)),
train_ids AS MATERIALIZED (SELECT n, array_to_string(list_transform(
    list_filter(string_split(word, ''), lambda c: c <> ''),
    lambda c: '|' || (list_position(vocab, c) - 1) || '|'), '') AS ids
  FROM train_words, start WHERE length(word) > 1),
train(step, ids, n, l, r, vocab) AS (
  SELECT 0, ids, n, NULL::INTEGER, NULL::INTEGER, NULL::VARCHAR[] FROM train_ids
  UNION ALL SELECT 0, NULL, NULL, NULL, NULL, vocab FROM start
  UNION ALL (
    WITH v AS (SELECT step, vocab FROM train WHERE vocab IS NOT NULL),
    parts AS (SELECT string_split(ids[2:length(ids) - 1], '||') AS p, n FROM train WHERE contains(ids, '||')),
    pairs AS (SELECT unnest(list_zip(p[:len(p) - 1], p[2:])) AS q, n FROM parts),
    best AS (SELECT CAST(q[1] AS INTEGER) AS l, CAST(q[2] AS INTEGER) AS r FROM pairs GROUP BY ALL
             HAVING sum(n) >= {min_frequency} ORDER BY sum(n) DESC, l, r LIMIT 1),
    made AS (SELECT v.step + 1 AS step, l, r, vocab, vocab[l + 1] || vocab[r + 1] AS token
             FROM v, best WHERE len(vocab) < {vocab_size})
    SELECT m.step, CASE WHEN t.ids IS NULL THEN NULL ELSE replace(t.ids, '|' || m.l || '||' || m.r || '|',
             '|' || coalesce(list_position(m.vocab, m.token) - 1, len(m.vocab)) || '|') END, t.n,
      CASE WHEN t.vocab IS NOT NULL THEN m.l END, CASE WHEN t.vocab IS NOT NULL THEN m.r END,
      CASE WHEN t.vocab IS NULL THEN NULL WHEN list_contains(m.vocab, m.token) THEN m.vocab
           ELSE list_append(m.vocab, m.token) END
    FROM train t, made m)),
learned AS MATERIALIZED (SELECT step, l, r, vocab FROM train WHERE vocab IS NOT NULL AND step > 0),
model AS MATERIALIZED (SELECT max_by(vocab, step) AS vocab, list('|' || l || '||' || r || '|' || chr(9) || '|'
    || (list_position(vocab, vocab[l + 1] || vocab[r + 1]) - 1) || '|' ORDER BY step) AS rules FROM learned)"""


def encoded_ctes(source: str) -> str:
    """CTEs over ``source(key, text)``: ``word_ids(word, ids, ids_small)``, the
    merged ids of every distinct word, and ``placed(key, pos, word)``."""
    marked = ORACLE["pretokenize"].replace("doc_id", "key").replace("FROM documents", f"FROM {source}")
    return f"""
placed AS MATERIALIZED ({marked}),
first_ids AS (SELECT word, CASE WHEN list_contains({_sql_list(C.SPECIAL_TOKENS)}, word)
    THEN '|' || (list_position(vocab, word) - 1) || '|'
    ELSE array_to_string(list_transform(list_filter(string_split(word, ''), lambda c: c <> ''),
      lambda c: '|' || coalesce(list_position(vocab, c) - 1, {C.UNK_ID}) || '|'), '') END AS ids
  FROM (SELECT DISTINCT word FROM placed), model),
word_ids AS MATERIALIZED (SELECT word, {_merged('rules')} AS ids,
    {_merged(f'rules[:greatest({SMALL} - first_size, 0)]')} AS ids_small
  FROM first_ids, model, (SELECT len(vocab) AS first_size FROM start))"""


def _merged(rules: str) -> str:
    done = (f"list_reduce(list_prepend(ids, {rules}), lambda s, rule: "
            "replace(s, split_part(rule, chr(9), 1), split_part(rule, chr(9), 2)))")
    return f"CAST(string_split({done}[2:-2], '||') AS INTEGER[])"


VOCAB, SMALL = 352, 320      # the registered models' sizes


def _with(*ctes: str) -> str:
    return "WITH RECURSIVE " + ",\n".join(ctes) + "\n"


TRAINED = trainer_ctes(VOCAB)
CHATS = f"chats AS MATERIALIZED ({ORACLE['chatml_train']})"
DOC_TEXTS = "texts AS MATERIALIZED (SELECT doc_id AS key, text FROM documents)"
ENCODED = """
encoded AS MATERIALIZED (SELECT key, flatten(list(ids ORDER BY pos)) AS ids,
    sum(len(ids)) AS n, sum(len(ids_small)) AS n_small FROM placed JOIN word_ids USING (word) GROUP BY key)"""

register("bpe_train", _with(TRAINED) + """
SELECT CAST(step - 1 AS INTEGER) AS rank, vocab[l + 1] AS left, vocab[r + 1] AS right,
  vocab[l + 1] || vocab[r + 1] AS token FROM learned""")
register("tokenizer_build", _with(TRAINED) + f"""
SELECT CAST(generate_subscripts(vocab, 1) - 1 AS INTEGER) AS id, unnest(vocab) AS token,
  generate_subscripts(vocab, 1) <= {len(C.SPECIAL_TOKENS)} AS is_special FROM model""")
register("encode_column", _with(TRAINED, DOC_TEXTS, encoded_ctes("texts"), ENCODED) + """
SELECT t.key AS doc_id, coalesce(e.ids, []) AS input_ids FROM texts t LEFT JOIN encoded e USING (key)""")

# token -> bytes: the inverse of the byte symbols, as hex
_BYTE_OF = """CASE WHEN unicode(c) BETWEEN 256 AND 288 THEN unicode(c) - 256
  WHEN unicode(c) BETWEEN 289 AND 322 THEN unicode(c) - 162 WHEN unicode(c) = 323 THEN 173 ELSE unicode(c) END"""
register("decode_bpe", _with(TRAINED, DOC_TEXTS, encoded_ctes("texts"), ENCODED) + f"""
, kept AS (SELECT key, array_to_string(list_transform(list_filter(ids, lambda i: i >= {len(C.SPECIAL_TOKENS)}),
    lambda i: vocab[i + 1]), '') AS symbols FROM encoded, model),
bytes AS (SELECT key, unhex(array_to_string(list_transform(list_filter(string_split(symbols, ''), lambda c: c <> ''),
    lambda c: printf('%02X', {_BYTE_OF})), '')) AS raw
  FROM kept)
SELECT t.key AS doc_id, coalesce(decode(raw), '') AS text FROM texts t LEFT JOIN bytes b USING (key)""")

_OPS = _sql_list(C.OPERATORS)
register("tokenizer_checks", _with(TRAINED, CHATS, "texts AS (SELECT conv_id AS key, text FROM chats)",
                                   encoded_ctes("texts"), ENCODED) + f"""
, bad AS (SELECT list_transform(list_filter(list_zip(vocab, range(len(vocab))),
    lambda v: regexp_full_match(v[1], '[0-9]{{2,}}')), lambda v: v[2]) AS ids FROM model),
one AS (SELECT len(list_filter(e.ids, lambda i: list_contains(bad.ids, i))) AS multi,
    len(list_filter(regexp_extract_all(text, {SPECIAL_RE_SQL}, 1), lambda s: list_contains({_OPS}, s)))
      <> len(list_filter(e.ids, lambda i: list_contains({[C.SPECIAL_IDS[o] for o in C.OPERATORS]}, i))) AS split,
    list_contains(e.ids, {C.UNK_ID}) AND NOT contains(text, '{C.UNK}') AS lost
  FROM texts JOIN encoded e USING (key), bad)
SELECT count(*) AS n_rows, CAST(sum(multi) AS BIGINT) AS n_multi_digit_tokens,
  count(*) FILTER (WHERE split) AS n_operator_split, count(*) FILTER (WHERE lost) AS n_roundtrip_fail FROM one""")

_SIZED = f"""
, sized AS MATERIALIZED (SELECT t.*, length(text) AS chars, {byte_count_sql('text')} AS n_byte,
    coalesce(n, 0) AS n_big, coalesce(n_small, 0) AS n_little FROM texts t LEFT JOIN encoded USING (key)),
kinds(tokenizer, vocab_size) AS (VALUES ('byte', 274), ('bpe{SMALL}', {SMALL}), ('bpe{VOCAB}', {VOCAB})),
counted AS (SELECT s.*, tokenizer, vocab_size,
    CASE tokenizer WHEN 'byte' THEN n_byte WHEN 'bpe{SMALL}' THEN n_little ELSE n_big END AS tokens
  FROM sized s, kinds)"""
register("tokenizer_ranking", _with(TRAINED, DOC_TEXTS, encoded_ctes("texts"), ENCODED) + _SIZED + """
, summed AS (SELECT tokenizer, CAST(sum(tokens) AS BIGINT) AS total_tokens, sum(chars) AS total_chars, vocab_size
  FROM counted GROUP BY tokenizer, vocab_size)
SELECT tokenizer, total_tokens, round(total_chars / total_tokens, 6) AS chars_per_token, vocab_size,
  CAST(rank() OVER (ORDER BY total_tokens, tokenizer) AS INTEGER) AS rank,
  total_tokens = min(total_tokens) OVER () AS best FROM summed""")
register("single_token_coverage", _with(
    TRAINED, r"texts AS MATERIALIZED (SELECT DISTINCT unnest(regexp_extract_all(text, '\p{L}+')) AS key, key AS text FROM documents)",
    encoded_ctes("texts"), ENCODED) + _SIZED + """
SELECT tokenizer, count(*) FILTER (WHERE tokens = 1) AS single, count(*) AS terms,
  round(count(*) FILTER (WHERE tokens = 1) / count(*) * 100, 3) AS pct FROM counted GROUP BY tokenizer""")
register("token_counts_by_class", _with(TRAINED, CHATS, """texts AS MATERIALIZED (
  SELECT 'd' || doc_id AS key, lang AS cls, text FROM documents
  UNION ALL SELECT 'c' || conv_id, 'chat', text FROM chats)""", encoded_ctes("texts"), ENCODED) + _SIZED + """
SELECT tokenizer, cls, count(*) AS n_texts, CAST(sum(chars) AS BIGINT) AS chars, CAST(sum(tokens) AS BIGINT) AS tokens
FROM counted GROUP BY tokenizer, cls""")

# what must hold of the model of full size on its own corpus, whatever its merges
register("tokenizer_checks_full", """
SELECT count(DISTINCT conv_id) AS n_rows, CAST(0 AS BIGINT) AS n_multi_digit_tokens,
  CAST(0 AS BIGINT) AS n_operator_split, CAST(0 AS BIGINT) AS n_roundtrip_fail FROM conversations""")
register("decode_full", f"""
SELECT conv_id, nfc_normalize(text) AS text FROM ({ORACLE['chatml_train']})""")
