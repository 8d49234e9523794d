"""DuckDB SQL for every SQL-checkable query (the correctness oracle).

Each statement runs on the driver's tables registered as views and must
return the same columns (names and values) as the Spark query of the same
key. Shared fragments -- the fixture views and the byte-variant encoder --
are generated here as SQL text.
"""

from __future__ import annotations

from ..constants import SPECIAL_TOKENS
from ..sources import fixtures as FX

# ---------------------------------------------------------------------------
# fixture views
# ---------------------------------------------------------------------------
STORIES = """stories AS (
  SELECT d.doc_id, d.text,
    CASE WHEN d.doc_id % 53 = 0 THEN NULL
         WHEN d.doc_id % 10 = 0 THEN concat('minor', d.doc_id - d.doc_id % 25)
         ELSE concat(d.source, '-', d.doc_id - d.doc_id % 200) END AS author,
    CASE WHEN d.doc_id % 7 = 0 THEN NULL WHEN d.doc_id % 11 = 0 THEN ''
         ELSE concat('  Part ', d.doc_id, ' ') END AS chapter_title,
    CAST(d.n_chars AS DOUBLE) AS average_views,
    CASE WHEN d.lang = 'fr' THEN ['grimdark', 'fr'] ELSE [d.lang] END AS tags,
    CASE WHEN l.toxic = 1 THEN ['toxic'] WHEN l.quality = 0 THEN ['low_quality']
         WHEN l.doc_id IS NULL THEN NULL ELSE ['none'] END AS warnings,
    CASE WHEN d.doc_id % 3 = 0 THEN 'story' ELSE 'textbook' END AS format
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)"""

TURNS = """turns AS (SELECT conv_id, turn, role, text AS content FROM conversations)"""


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_list(values) -> str:
    return "[" + ", ".join(_sql_str(v) for v in values) + "]"


FLAG_RE = _sql_str(FX.FLAG_PATTERN)

FLAGGED = f"""flagged AS (
  SELECT *,
    (author IS NULL OR text IS NULL
     OR coalesce(list_has_any(tags, {_sql_list(FX.BLOCKED_TAGS)}), false)
     OR coalesce(list_has_any(warnings, {_sql_list(FX.BLOCKED_WARNINGS)}), false)
     OR coalesce(average_views, 0) < {FX.VIEWS_THRESHOLD}) AS skip
  FROM stories),
flags AS (
  SELECT *, CASE WHEN NOT skip THEN regexp_matches(text, {FLAG_RE}) END AS hit FROM flagged),
author_stats AS (
  SELECT author,
    count(*) FILTER (WHERE NOT skip) AS total,
    count(*) FILTER (WHERE NOT skip AND hit) AS bad,
    count(*) FILTER (WHERE skip) AS skipped
  FROM flags WHERE author IS NOT NULL GROUP BY author),
flagged_authors AS (
  SELECT * FROM author_stats WHERE total < 3 OR bad >= 2 OR bad / total > 0.1),
excluded AS (
  SELECT DISTINCT trim(author) AS author FROM flagged_authors WHERE trim(author) <> '')"""

# ---------------------------------------------------------------------------
# byte-variant encoder in SQL
# ---------------------------------------------------------------------------
_SPECIAL_ALT = "|".join(
    "".join("\\" + ch if ch in "|*+/\\.?()[]{}^$" else ch for ch in t)
    for t in sorted(SPECIAL_TOKENS, key=lambda t: (-len(t), SPECIAL_TOKENS.index(t))))
SPECIAL_RE_SQL = _sql_str(f"({_SPECIAL_ALT})")

_CP_BYTES = """CASE WHEN c < 128 THEN [c]
  WHEN c < 2048 THEN [192 + c // 64, 128 + c % 64]
  WHEN c < 65536 THEN [224 + c // 4096, 128 + (c // 64) % 64, 128 + c % 64]
  ELSE [240 + c // 262144, 128 + (c // 4096) % 64, 128 + (c // 64) % 64, 128 + c % 64] END"""

# byte -> id of the byte variant: specials are ids 0-27 (digits 18-27), the
# other byte symbols follow in code-point order (printable bytes stand for
# themselves, the rest map to U+0100 upward)
_BYTE_ID = """CASE WHEN b BETWEEN 48 AND 57 THEN b - 30
  WHEN b BETWEEN 33 AND 47 THEN b - 5
  WHEN b BETWEEN 58 AND 126 THEN b - 15
  WHEN b BETWEEN 161 AND 172 THEN b - 49
  WHEN b BETWEEN 174 AND 255 THEN b - 50
  WHEN b <= 32 THEN b + 206
  WHEN b BETWEEN 127 AND 160 THEN b + 112
  ELSE 273 END"""


def byte_ids_sql(text: str) -> str:
    """SQL expression: byte-variant ids of ``text`` (specials cut out of the
    raw text, each other run NFC-normalized, one id per UTF-8 byte)."""
    seg_ids = (f"flatten(list_transform(string_split(nfc_normalize(seg), ''), lambda ch: "
               f"CASE WHEN ch = '' THEN [] ELSE list_transform({_CP_BYTES.replace('c', 'unicode(ch)')}, "
               f"lambda b: {_BYTE_ID}) END))")
    return (f"CAST(flatten(list_transform(string_split(regexp_replace({text}, {SPECIAL_RE_SQL}, "
            f"chr(1) || '\\1' || chr(1), 'g'), chr(1)), lambda seg, i: "
            f"CASE WHEN i % 2 = 0 THEN [list_position({_sql_list(SPECIAL_TOKENS)}, seg) - 1] "
            f"ELSE {seg_ids} END)) AS INTEGER[])")


def byte_count_sql(text: str) -> str:
    """SQL expression: byte-variant token count (specials count one)."""
    return f"strlen(regexp_replace(nfc_normalize({text}), {SPECIAL_RE_SQL}, chr(1), 'g'))"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


ORACLE: dict[str, str] = {}


def register(key: str, sql: str) -> None:
    ORACLE[key] = sql.strip()


# ---------------------------------------------------------------------------
# author audit
# ---------------------------------------------------------------------------
register("audit_gate", with_(STORIES, FLAGGED) + "SELECT doc_id, author, skip FROM flagged")
register("pattern_flag", with_(STORIES, FLAGGED) + "SELECT doc_id, skip, hit AS flagged FROM flags")
register("author_stats", with_(STORIES, FLAGGED) + "SELECT author, total, bad, skipped FROM author_stats")
register("flagged_authors", with_(STORIES, FLAGGED)
         + "SELECT author, total, bad, skipped FROM flagged_authors")
register("author_audit", with_(STORIES, FLAGGED)
         + "SELECT author, total, bad, skipped, round(CASE WHEN total > 0 THEN bad / total END, 9) AS ratio "
           "FROM flagged_authors")
register("infraction_histogram", with_(STORIES, FLAGGED) + f"""
, r AS (SELECT bad / total AS r FROM author_stats WHERE total >= 3),
rng AS (SELECT CASE WHEN min(r) = max(r) THEN min(r) - 0.5 ELSE min(r) END AS lo,
               CASE WHEN min(r) = max(r) THEN max(r) + 0.5 ELSE max(r) END AS hi FROM r),
g AS (SELECT r, lo, hi, (hi - lo) / 40 AS step,
        least(greatest(floor((r - lo) / (hi - lo) * 40), 0), 39) AS g FROM r, rng),
b AS (SELECT CAST(CASE WHEN r < lo + g * step THEN g - 1
                  WHEN g < 39 AND r >= lo + (g + 1) * step THEN g + 1 ELSE g END AS INTEGER) + 1 AS bin
      FROM g),
counts AS (SELECT bin, count(*) AS n FROM b GROUP BY bin)
SELECT CAST(s.bin AS INTEGER) AS bin,
  round(lo + (s.bin - 1) * ((hi - lo) / 40), 9) AS bin_lo,
  round(CASE WHEN s.bin = 40 THEN hi ELSE lo + s.bin * ((hi - lo) / 40) END, 9) AS bin_hi,
  coalesce(counts.n, 0) AS n_authors
FROM range(1, 41) s(bin) CROSS JOIN rng LEFT JOIN counts ON counts.bin = s.bin""")
register("top_flagged", with_(STORIES, FLAGGED) + """
SELECT author, bad, total, format('{:.1f}%', bad / total * 100) AS ratio_pct
FROM author_stats WHERE bad > 0 ORDER BY bad DESC, author ASC LIMIT 20""")
register("exclude_authors", with_(STORIES, FLAGGED) + """
SELECT s.doc_id, s.author FROM stories s
WHERE NOT EXISTS (SELECT 1 FROM excluded e WHERE e.author = s.author)""")
register("quality_gate", with_(STORIES, FLAGGED) + f"""
SELECT s.doc_id, s.author FROM stories s
WHERE length(s.author) > 0 AND length(s.text) > 0 AND s.average_views >= {FX.VIEWS_THRESHOLD}
  AND NOT coalesce(list_has_any(s.warnings, {_sql_list(FX.BLOCKED_WARNINGS)}), false)
  AND NOT coalesce(list_has_any(s.tags, {_sql_list(FX.BLOCKED_TAGS)}), false)
  AND NOT EXISTS (SELECT 1 FROM excluded e WHERE e.author = s.author)""")
register("title_prefix", with_(STORIES) + """
SELECT doc_id,
  CASE WHEN chapter_title IS NULL THEN concat('Chapter title: <untitled>', chr(10), chr(10), text)
       WHEN regexp_replace(chapter_title, '^\\s+|\\s+$', '', 'g') = '' THEN text
       ELSE concat('Chapter title: ', regexp_replace(chapter_title, '^\\s+|\\s+$', '', 'g'),
                   chr(10), chr(10), text) END AS full_text
FROM stories""")


# ---------------------------------------------------------------------------
# global order
# ---------------------------------------------------------------------------
def order_idx(key: str, salt: str) -> str:
    return (f"row_number() OVER (ORDER BY md5(CAST({key} AS VARCHAR) || '|{salt}'), {key}) - 1")


def split_cte(table: str, key: str, frac: float = 0.01, seed: int = 42, name: str = "splits") -> str:
    return f"""{name} AS (
  SELECT *, CASE WHEN row_number() OVER (ORDER BY md5(CAST({key} AS VARCHAR) || '|split-{seed}'), {key})
                      <= ceil({frac} * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
  FROM {table})"""


register("seeded_shuffle", f"SELECT doc_id, {order_idx('doc_id', '42')} AS shuffle_idx FROM documents")
register("take_n", f"""
SELECT doc_id, lang FROM (SELECT doc_id, lang, {order_idx('doc_id', '42')} AS i FROM documents) WHERE i < 600""")
register("train_test_split", with_(split_cte("documents", "doc_id")) + "SELECT doc_id, split FROM splits")
register("split_sizes", with_(split_cte("documents", "doc_id"))
         + "SELECT split, count(*) AS n_rows FROM splits GROUP BY split")
register("assign_batches", f"""
SELECT doc_id, CAST(i // 16 AS BIGINT) AS batch_id, CAST(i % 16 AS INTEGER) AS row_in_batch
FROM (SELECT doc_id, {order_idx('doc_id', '42')} AS i FROM documents)""")
register("length_grouped_batches", f"""
WITH s AS (SELECT doc_id, {byte_count_sql('text')} AS len, {order_idx('doc_id', '42')} AS i FROM documents),
m AS (SELECT *, i // 200 AS mb,
        row_number() OVER (PARTITION BY i // 200 ORDER BY len DESC, i) - 1 AS pos FROM s)
SELECT doc_id, CAST(mb * 50 + pos // 4 AS BIGINT) AS batch_id, CAST(pos % 4 AS INTEGER) AS row_in_batch FROM m""")
register("sample_k", """
SELECT doc_id, n_chars FROM documents ORDER BY md5(CAST(doc_id AS VARCHAR) || '|sample'), doc_id LIMIT 64""")
register("step_budget", """
WITH d AS (SELECT count(*) AS n FROM documents), c AS (SELECT count(DISTINCT conv_id) AS n FROM conversations),
p(phase, frac, bs, acc, ep, sec) AS (VALUES ('phase1', 0.01, 16, 16, 2, NULL), ('phase2', 0.01, 2, 64, 3, NULL),
  ('phase3', 0.01, 8, 32, 1, 2.5), ('phase4', 0.01, 8, 32, 1, 2.5), ('phase5', 0.005, 8, 32, 1, 2.5),
  ('sft', 0.01, 4, 64, 3, 3.0)),
t AS (SELECT *, CASE WHEN phase = 'sft' THEN c.n ELSE d.n END AS rows FROM p, d, c),
n AS (SELECT *, CAST(rows - ceil(frac * rows) AS BIGINT) AS n_train FROM t)
SELECT phase, n_train, bs * acc AS effective_batch, CAST(n_train // (bs * acc) * ep AS BIGINT) AS total_steps,
  CAST(round(n_train // (bs * acc) * ep * CAST(sec AS DOUBLE) / 60, 3) AS DOUBLE) AS minutes
FROM n""")

# ---------------------------------------------------------------------------
# chat formats (H1-H4) and context
# ---------------------------------------------------------------------------
register("chatml_train", """
SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || regexp_replace(text, '\\s+$', '')
  || chr(10) || '<|im_end|>' || chr(10), '' ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
register("chatml_template", """
SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>', '' ORDER BY turn)
  || '<|im_start|>assistant' || chr(10) AS text FROM conversations GROUP BY conv_id""")
register("chatml_fallback", """
SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
  ORDER BY turn) AS text FROM conversations GROUP BY conv_id""")
register("chatml_prompt", """
SELECT conv_id, string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>' || chr(10), ''
  ORDER BY turn) || '<|im_start|>assistant' || chr(10) AS text FROM conversations GROUP BY conv_id""")
register("trim_history", f"""
SELECT conv_id, turn, role FROM (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn,
            count(*) OVER (PARTITION BY conv_id) AS n FROM conversations)
WHERE n <= {FX.TRIM_KEEP_LAST} + 1 OR rn = 1 OR rn > n - {FX.TRIM_KEEP_LAST}""")
register("seed_system", """
WITH c AS (SELECT conv_id, turn, role, text,
             first(role ORDER BY turn) OVER (PARTITION BY conv_id) AS first_role FROM conversations)
SELECT conv_id, CAST(0 AS INTEGER) AS pos, 'system' AS role, 'You are a helpful AI assistant.' AS content
FROM c GROUP BY conv_id HAVING any_value(first_role) <> 'system'
UNION ALL
SELECT conv_id, CAST(row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1
       + CASE WHEN first_role <> 'system' THEN 1 ELSE 0 END AS INTEGER) AS pos, role, text AS content FROM c""")
register("fit_context", f"""
WITH t AS (SELECT conv_id, turn, role,
             {byte_count_sql("'<|im_start|>' || role || chr(10) || text || '<|im_end|>'")} AS cost
           FROM conversations),
w AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn) AS rn,
        count(*) OVER (PARTITION BY conv_id) AS n,
        first(cost ORDER BY turn) OVER (PARTITION BY conv_id) AS first_cost,
        sum(cost) OVER (PARTITION BY conv_id ORDER BY turn DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
          AS suffix FROM t)
SELECT conv_id, turn, role, cost FROM w
WHERE rn = 1 OR rn = n OR first_cost + suffix + 11 <= {FX.CONTEXT_MAX}""")


# ---------------------------------------------------------------------------
# byte-variant encoding, arrays and padding
# ---------------------------------------------------------------------------
DOC_IDS = f"doc_ids AS (SELECT doc_id, {byte_ids_sql('text')} AS ids FROM documents)"
TEMPLATE = ("string_agg('<|im_start|>' || role || chr(10) || text || '<|im_end|>', '' ORDER BY turn)"
            " || '<|im_start|>assistant' || chr(10)")
SFT_IDS = (f"sft_text AS (SELECT conv_id, {TEMPLATE} AS t FROM conversations GROUP BY conv_id),\n"
           f"sft_ids AS (SELECT conv_id, {byte_ids_sql('t')} AS ids FROM sft_text)")

register("nfc_normalize", "SELECT doc_id, nfc_normalize(text) AS text_nfc FROM documents")
register("special_token_counts", f"""
WITH occ AS (SELECT unnest(regexp_extract_all(text, {SPECIAL_RE_SQL}, 1)) AS token FROM documents)
SELECT token, CAST(list_position({_sql_list(SPECIAL_TOKENS)}, token) - 1 AS INTEGER) AS id, count(*) AS n
FROM occ GROUP BY token""")
register("token_ids", with_(DOC_IDS) + """
SELECT id, count(*) AS n, id < 28 AS is_special FROM (SELECT unnest(ids) AS id FROM doc_ids) GROUP BY id""")
register("id_range_check", with_(DOC_IDS) + """
SELECT count(*) AS n_rows, count(*) FILTER (WHERE list_max(ids) >= 274) AS n_out_of_range,
  max(list_max(ids)) AS max_id, 274 AS vocab_size FROM doc_ids""")
register("tokenizer_efficiency", f"""
SELECT 'byte' AS tokenizer, CAST(sum(length(text)) AS BIGINT) AS total_chars,
  CAST(sum({byte_count_sql('text')}) AS BIGINT) AS total_tokens,
  round(sum(length(text)) / sum({byte_count_sql('text')}), 6) AS chars_per_token, 274 AS vocab_size
FROM documents""")
register("truncate_head", with_(DOC_IDS) + "SELECT doc_id, ids[1:2048] AS input_ids FROM doc_ids")
register("truncate_tail", with_(SFT_IDS) + """
SELECT conv_id, CASE WHEN len(ids) > 8192 THEN ids[len(ids) - 8191:] ELSE ids END AS input_ids FROM sft_ids""")
register("pad_right_fixed", with_(DOC_IDS) + """
SELECT doc_id, list_resize(ids[1:2048], 2048, 4) AS input_ids,
  list_resize(list_transform(ids[1:2048], lambda x: 1), 2048, 0) AS attention_mask FROM doc_ids""")
register("labels_by_pad_id", with_(DOC_IDS) + """
SELECT doc_id, list_transform(list_resize(ids, greatest(len(ids), 2048), 4), lambda x: CASE WHEN x = 4 THEN -100 ELSE x END)
  AS labels FROM doc_ids""")
DOC_BATCHES = f"""doc_batches AS (
  SELECT doc_id, ids, ({order_idx('doc_id', '42')}) // 2 AS batch_id FROM doc_ids),
doc_padded AS (
  SELECT doc_id, batch_id, max(len(ids)) OVER (PARTITION BY batch_id) AS L, ids FROM doc_batches)"""
register("pad_right_dynamic", with_(DOC_IDS, DOC_BATCHES) + """
SELECT doc_id, batch_id, list_resize(ids, L, 4) AS input_ids,
  list_resize(list_transform(ids, lambda x: 1), L, 0) AS attention_mask FROM doc_padded""")
register("labels_plain", with_(DOC_IDS, DOC_BATCHES) + "SELECT doc_id, list_resize(ids, L, 4) AS labels FROM doc_padded")
CHAT_BATCHES = f"""chat_ord AS (SELECT conv_id, ids, ({order_idx('conv_id', '42')}) // 4 AS batch_id FROM sft_ids),
chat_batches AS (
  SELECT conv_id, batch_id, CASE WHEN len(ids) > 8192 THEN ids[len(ids) - 8191:] ELSE ids END AS ids,
    least(max(len(ids)) OVER (PARTITION BY batch_id), 8192) AS L FROM chat_ord),
chat_padded AS (
  SELECT conv_id, batch_id,
    list_concat(list_transform(range(L - len(ids)), lambda x: 4), ids) AS input_ids,
    list_concat(list_transform(range(L - len(ids)), lambda x: 0), list_transform(ids, lambda x: 1)) AS attention_mask
  FROM chat_batches)"""
register("pad_left_dynamic", with_(SFT_IDS, CHAT_BATCHES)
         + "SELECT conv_id, batch_id, input_ids, attention_mask FROM chat_padded")
WHOLE_CHATS = f"""chat_ord AS (SELECT conv_id, ids, ({order_idx('conv_id', '42')}) // 4 AS batch_id FROM sft_ids),
chat_batches AS (SELECT conv_id, ids, max(len(ids)) OVER (PARTITION BY batch_id) AS L FROM chat_ord),
chat_padded AS (
  SELECT conv_id, list_concat(list_transform(range(L - len(ids)), lambda x: 4), ids) AS input_ids,
    list_concat(list_transform(range(L - len(ids)), lambda x: 0), list_transform(ids, lambda x: 1)) AS attention_mask
  FROM chat_batches)"""
register("labels_masked", with_(SFT_IDS, WHOLE_CHATS) + """
SELECT conv_id, list_transform(list_zip(input_ids, attention_mask), lambda p: CASE WHEN p[2] = 0 THEN -100 ELSE p[1] END)
  AS labels FROM chat_padded""")
register("padding_waste", with_(SFT_IDS) + f"""
, b AS (SELECT ({order_idx('conv_id', '42')}) // 4 AS batch_id, least(len(ids), 8192) AS length FROM sft_ids),
pb AS (SELECT batch_id, count(*) AS rows, max(length) AS longest, sum(length) AS real FROM b GROUP BY batch_id),
t AS (SELECT CAST(sum(rows) AS BIGINT) AS n_rows, CAST(sum(real) AS BIGINT) AS real_tokens,
        CAST(sum(rows * longest) AS BIGINT) AS dynamic_tokens FROM pb)
SELECT n_rows, real_tokens, CAST(n_rows * 8192 AS BIGINT) AS fixed_tokens, CAST(dynamic_tokens AS BIGINT) AS dynamic_tokens,
  round((1 - real_tokens / (n_rows * 8192)) * 100, 3) AS fixed_waste_pct,
  round((1 - real_tokens / dynamic_tokens) * 100, 3) AS dynamic_waste_pct,
  round(n_rows * 8192 / dynamic_tokens, 3) AS speedup FROM t""")


# ---------------------------------------------------------------------------
# sources, gates, plans
# ---------------------------------------------------------------------------
TITLED = """CASE WHEN chapter_title IS NULL THEN concat('Chapter title: <untitled>', chr(10), chr(10), text)
       WHEN regexp_replace(chapter_title, '^\\s+|\\s+$', '', 'g') = '' THEN text
       ELSE concat('Chapter title: ', regexp_replace(chapter_title, '^\\s+|\\s+$', '', 'g'),
                   chr(10), chr(10), text) END"""

CLEAN = f"""kept AS (
  SELECT s.* FROM stories s
  WHERE length(s.author) > 0 AND length(s.text) > 0 AND s.average_views >= {FX.VIEWS_THRESHOLD}
    AND NOT coalesce(list_has_any(s.warnings, {_sql_list(FX.BLOCKED_WARNINGS)}), false)
    AND NOT coalesce(list_has_any(s.tags, {_sql_list(FX.BLOCKED_TAGS)}), false)
    AND NOT EXISTS (SELECT 1 FROM excluded e WHERE e.author = s.author)),
enc AS (SELECT doc_id, author, {byte_ids_sql(TITLED)} AS ids FROM kept),
gated AS (SELECT doc_id, author, ids[1:{FX.MAX_TOKENS}] AS input_ids FROM enc WHERE len(ids) >= {FX.MIN_TOKENS}),
{split_cte('gated', 'doc_id', name='clean')}"""

register("read_corpus", "SELECT doc_id, lang, source, n_chars, text FROM documents")
register("read_config", "SELECT doc_id, lang AS config FROM documents WHERE lang = 'en'")
register("read_limited", "SELECT count(*) AS n_rows FROM (SELECT DISTINCT conv_id FROM conversations LIMIT 8000000)")
register("long_story_filter", f"""
SELECT doc_id, CAST({byte_count_sql('text')} AS INTEGER) AS token_length FROM documents
WHERE doc_id % 3 = 0 AND {byte_count_sql('text')} > 1000""")
register("length_gate", with_(STORIES) + f"""
SELECT doc_id, {byte_count_sql(TITLED)} AS n_tokens FROM stories WHERE {byte_count_sql(TITLED)} >= {FX.MIN_TOKENS}""")
register("fixed_length_corpus", with_(DOC_IDS) + """
SELECT doc_id, list_resize(ids[1:512], 512, 4) AS input_ids,
  list_resize(list_transform(ids[1:512], lambda x: 1), 512, 0) AS attention_mask,
  CAST(least(len(ids), 512) AS INTEGER) AS n_real FROM doc_ids""")
SFT = f"""sft_split AS (SELECT * FROM (SELECT DISTINCT conv_id FROM conversations)),
{split_cte('sft_split', 'conv_id', name='sft_s')},
{SFT_IDS.replace('FROM conversations GROUP BY conv_id', 'FROM conversations GROUP BY conv_id')},
sft AS (SELECT i.conv_id, s.split, i.ids[1:8192] AS input_ids, CAST(least(len(i.ids), 8192) AS INTEGER) AS length
        FROM sft_ids i JOIN sft_s s USING (conv_id))"""
register("sft_corpus", with_(SFT) + "SELECT conv_id, split, input_ids, length FROM sft")
register("length_summary", with_(SFT) + """
SELECT min(length) AS min_length, max(length) AS max_length, round(avg(length), 6) AS mean_length,
  count(*) FILTER (WHERE length > 4096) AS n_over_1, count(*) FILTER (WHERE length > 6144) AS n_over_2,
  count(*) FILTER (WHERE length = 8192) AS n_at_max FROM sft WHERE split = 'train'""")
register("clean_stories", with_(STORIES, FLAGGED, CLEAN) + """
SELECT doc_id, input_ids, CAST(len(input_ids) AS INTEGER) AS length, author, split FROM clean""")
register("stage_counts", with_(STORIES, FLAGGED) + f"""
, gate AS (SELECT s.* FROM stories s
  WHERE length(s.author) > 0 AND length(s.text) > 0 AND s.average_views >= {FX.VIEWS_THRESHOLD}
    AND NOT coalesce(list_has_any(s.warnings, {_sql_list(FX.BLOCKED_WARNINGS)}), false)
    AND NOT coalesce(list_has_any(s.tags, {_sql_list(FX.BLOCKED_TAGS)}), false)),
ne AS (SELECT * FROM gate g WHERE NOT EXISTS (SELECT 1 FROM excluded e WHERE e.author = g.author))
SELECT 'read' AS stage, (SELECT count(*) FROM stories) AS n_rows
UNION ALL SELECT 'gate', (SELECT count(*) FROM gate)
UNION ALL SELECT 'not_excluded', (SELECT count(*) FROM ne)
UNION ALL SELECT 'length_ok', (SELECT count(*) FROM ne WHERE {byte_count_sql(TITLED)} >= {FX.MIN_TOKENS})""")
register("write_splits", with_(STORIES, FLAGGED, CLEAN) + "SELECT split, count(*) AS n_rows FROM clean GROUP BY split")
HEAD = """head AS (SELECT * FROM clean WHERE split = 'train'
  ORDER BY md5(CAST(doc_id AS VARCHAR) || '|split-42'), doc_id LIMIT 1000)"""
register("head_length_summary", with_(STORIES, FLAGGED, CLEAN, HEAD) + """
SELECT count(*) AS n_rows, round(avg(len(input_ids)), 6) AS mean_length,
  CAST(max(len(input_ids)) AS INTEGER) AS max_length, CAST(min(len(input_ids)) AS INTEGER) AS min_length,
  count(*) FILTER (WHERE len(input_ids) < 100) AS n_short FROM head""")
register("saved_corpus_check", with_(STORIES, FLAGGED, CLEAN, HEAD) + """
SELECT 'n_train' AS metric, CAST(count(*) FILTER (WHERE split = 'train') AS DOUBLE) AS value FROM clean
UNION ALL SELECT 'n_test', count(*) FILTER (WHERE split = 'test') FROM clean
UNION ALL SELECT 'n_out_of_range', count(*) FILTER (WHERE list_max(input_ids) >= 274) FROM clean
UNION ALL SELECT 'head_n_rows', count(*) FROM head
UNION ALL SELECT 'head_mean_length', round(avg(len(input_ids)), 6) FROM head
UNION ALL SELECT 'head_max_length', max(len(input_ids)) FROM head
UNION ALL SELECT 'head_min_length', min(len(input_ids)) FROM head
UNION ALL SELECT 'head_n_short', count(*) FILTER (WHERE len(input_ids) < 100) FROM head""")
register("corpus_manifest", with_(split_cte("documents", "doc_id")) + """
SELECT 'cosmopedia-v2' AS source, count(*) FILTER (WHERE split = 'train') AS n_train,
  count(*) FILTER (WHERE split = 'test') AS n_test, 512 AS seq_len, 256 AS effective_batch FROM splits""")
register("phase_corpus", f"""
WITH sel AS (SELECT doc_id, text FROM (SELECT doc_id, text, {order_idx('doc_id', '42')} AS i
                                      FROM documents WHERE lang = 'en')),
{split_cte('sel', 'doc_id', name='ps')},
enc AS (SELECT doc_id, split, {byte_ids_sql('text')} AS ids FROM ps)
SELECT doc_id, split, list_resize(ids[1:512], 512, 4) AS input_ids,
  list_resize(list_transform(ids[1:512], lambda x: 1), 512, 0) AS attention_mask FROM enc""")
register("long_story_corpus", f"""
WITH sel AS (SELECT doc_id, text FROM documents WHERE doc_id % 3 = 0 AND {byte_count_sql('text')} > 1000),
{split_cte('sel', 'doc_id', name='ls')},
enc AS (SELECT doc_id, split, {byte_ids_sql('text')} AS ids FROM ls)
SELECT doc_id, split, list_resize(ids[1:2048], 2048, 4) AS input_ids,
  list_resize(list_transform(ids[1:2048], lambda x: 1), 2048, 0) AS attention_mask FROM enc""")
register("sft_batches", with_(SFT) + f"""
, tr AS (SELECT conv_id, input_ids AS ids, length, {order_idx('conv_id', '42')} AS i FROM sft WHERE split = 'train'),
g AS (SELECT *, i // 200 AS mb, row_number() OVER (PARTITION BY i // 200 ORDER BY length DESC, i) - 1 AS pos FROM tr),
b AS (SELECT conv_id, ids, CAST(mb * 50 + pos // 4 AS BIGINT) AS batch_id, CAST(pos % 4 AS INTEGER) AS row_in_batch FROM g),
c AS (SELECT *, least(max(len(ids)) OVER (PARTITION BY batch_id), 8192) AS L FROM b),
p AS (SELECT conv_id, batch_id, row_in_batch,
        list_concat(list_transform(range(L - len(ids)), lambda x: 4), ids) AS input_ids,
        list_concat(list_transform(range(L - len(ids)), lambda x: 0), list_transform(ids, lambda x: 1)) AS attention_mask
      FROM c)
SELECT conv_id, batch_id, row_in_batch, input_ids, attention_mask,
  list_transform(list_zip(input_ids, attention_mask), lambda q: CASE WHEN q[2] = 0 THEN -100 ELSE q[1] END) AS labels
FROM p""")
ORACLE["sft_batches"] = " UNION ALL ".join(
    "SELECT *, '" + x + "' AS split FROM (" + ORACLE["sft_batches"].replace("split = 'train'", "split = '" + x + "'") + ")" for x in ("train", "test"))
register("story_batches", with_(STORIES, FLAGGED, CLEAN) + f"""
, tr AS (SELECT doc_id, input_ids AS ids, {order_idx('doc_id', '42')} AS i FROM clean WHERE split = 'train'),
b AS (SELECT *, CAST(i // 2 AS BIGINT) AS batch_id, CAST(i % 2 AS INTEGER) AS row_in_batch FROM tr),
c AS (SELECT *, max(len(ids)) OVER (PARTITION BY batch_id) AS L FROM b)
SELECT doc_id, batch_id, row_in_batch, list_resize(ids, L, 4) AS input_ids,
  list_resize(list_transform(ids, lambda x: 1), L, 0) AS attention_mask, list_resize(ids, L, 4) AS labels FROM c""")
ORACLE["story_batches"] = " UNION ALL ".join(
    "SELECT *, '" + x + "' AS split FROM (" + ORACLE["story_batches"].replace("split = 'train'", "split = '" + x + "'") + ")" for x in ("train", "test"))


# ---------------------------------------------------------------------------
# tokenizer queries that SQL can express (byte variant, specials)
# ---------------------------------------------------------------------------
register("encode_bytes", with_(DOC_IDS) + "SELECT doc_id, ids AS input_ids FROM doc_ids")
register("decode_column", "SELECT doc_id, nfc_normalize(text) AS text FROM documents")
_SPECIAL_ROWS = ", ".join(f"({_sql_str(t)}, {i})" for i, t in enumerate(SPECIAL_TOKENS))
register("stream_chatml", ORACLE["chatml_train"])
register("exclusion_list", with_(STORIES, FLAGGED) + "SELECT author FROM excluded")
# the trained vocabulary reaches the requested 352 tokens on these corpora;
# samples = conversations seen by training
register("tokenizer_stats", f"""
WITH s(token, id) AS (VALUES {_SPECIAL_ROWS})
SELECT token, CAST(id AS INTEGER) AS id, 352 AS vocab_size,
  (SELECT count(DISTINCT conv_id) FROM conversations) AS samples FROM s""")


# ---------------------------------------------------------------------------
# byte-level pre-tokens in SQL. RE2 has no lookahead: a mark is put before the
# last blank of every run that a non-blank follows, so that "a run but its
# last blank" and "the last blank with what follows" are plain alternatives.
# ---------------------------------------------------------------------------
def pretokens_sql(text: str) -> str:
    marked = rf"regexp_replace({text}, '(\s+)(\s\S)', '\1' || chr(2) || '\2', 'g')"
    return (rf"regexp_extract_all({marked}, '''(?:s|t|re|ve|m|ll|d)| ?\p{{L}}+| ?\p{{N}}+"
            rf"| ?[^\s\p{{L}}\p{{N}}\x02]+|\s+')")


_SYMBOL = """CASE WHEN b BETWEEN 33 AND 126 OR b BETWEEN 161 AND 172 OR b BETWEEN 174 AND 255 THEN chr(CAST(b AS INTEGER))
  WHEN b <= 32 THEN chr(CAST(256 + b AS INTEGER)) WHEN b BETWEEN 127 AND 160 THEN chr(CAST(162 + b AS INTEGER))
  ELSE chr(323) END"""
_CH_BYTES = _CP_BYTES.replace("c ", "unicode(ch) ").replace("[c]", "[unicode(ch)]")


def word_pieces_sql(word: str) -> str:
    """SQL expression: byte symbols of a word, numeric symbols standing alone."""
    symbols = (f"array_to_string(flatten(list_transform(string_split({word}, ''), lambda ch: CASE WHEN ch = '' THEN [] "
               f"ELSE list_transform({_CH_BYTES}, lambda b: {_SYMBOL}) END)), '')")
    return f"regexp_extract_all({symbols}, '[0-9²³¹¼½¾]|[^0-9²³¹¼½¾]+')"


register("word_counts", f"""
WITH t AS ({ORACLE["chatml_train"]}),
raw AS (SELECT unnest({pretokens_sql("nfc_normalize(text)")}) AS raw FROM t),
counted AS (SELECT raw, count(*) AS n FROM raw GROUP BY raw)
SELECT word, CAST(sum(n) AS BIGINT) AS n FROM (SELECT unnest({word_pieces_sql("raw")}) AS word, n FROM counted)
GROUP BY word""")
register("base_alphabet", f"""
WITH t AS ({ORACLE["chatml_train"]}),
ch AS (SELECT DISTINCT unnest(string_split(nfc_normalize(text), '')) AS ch FROM t),
b AS (SELECT DISTINCT unnest({_CH_BYTES}) AS b FROM ch WHERE ch <> '')
SELECT {_SYMBOL} AS symbol FROM b UNION SELECT unnest(['0','1','2','3','4','5','6','7','8','9'])""")
register("pretokenize", rf"""
WITH seg AS (SELECT doc_id, string_split(regexp_replace(text, {SPECIAL_RE_SQL}, chr(1) || '\1' || chr(1), 'g'), chr(1)) AS segs
             FROM documents),
one AS (SELECT doc_id, unnest(segs) AS seg, generate_subscripts(segs, 1) AS i FROM seg),
words AS (SELECT doc_id, i, CASE WHEN i % 2 = 0 THEN [seg] ELSE flatten(list_transform(
  {pretokens_sql("nfc_normalize(seg)")}, lambda p: {word_pieces_sql("p")})) END AS w FROM one),
docs AS (SELECT doc_id, flatten(list(w ORDER BY i)) AS w FROM words GROUP BY doc_id)
SELECT doc_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS pos, unnest(w) AS word FROM docs""")


# ---------------------------------------------------------------------------
# phases and their manifests, first rows, token lookup
# ---------------------------------------------------------------------------
def _phase_ctes(name: str, where: str, rows: int, frac: float) -> str:
    return f"""{name}_sel AS (SELECT doc_id, text FROM (SELECT doc_id, text, {order_idx('doc_id', '42')} AS i
  FROM documents WHERE {where}) WHERE i < {rows}),
{split_cte(f'{name}_sel', 'doc_id', frac, name=name)}"""


_PHASES = [_phase_ctes("phase1", "lang = 'en'", 20_000_000, 0.01), _phase_ctes("phase3", "true", 10_000_000, 0.01),
           _phase_ctes("phase5", "lang = 'de'", 7_680_000, 0.005)]
register("phase_corpora", with_(*_PHASES) + " UNION ALL ".join(f"""
SELECT '{phase}' AS phase, doc_id, split, list_resize(ids[1:{n}], {n}, 4) AS input_ids,
  list_resize(list_transform(ids[1:{n}], lambda x: 1), {n}, 0) AS attention_mask
FROM (SELECT *, {byte_ids_sql('text')} AS ids FROM {phase})""" for phase, n in (("phase1", 512), ("phase3", 2048), ("phase5", 2048))))
register("phase_manifests", with_(
    STORIES, FLAGGED, CLEAN, *_PHASES,
    f"long_sel AS (SELECT doc_id FROM documents WHERE doc_id % 3 = 0 AND {byte_count_sql('text')} > 1000)",
    split_cte("long_sel", "doc_id", name="phase4"),
    "chat_sel AS (SELECT DISTINCT conv_id FROM conversations)", split_cte("chat_sel", "conv_id", name="sft")) + " UNION ALL ".join(f"""
SELECT '{phase}' AS phase, '{source}' AS source, count(*) FILTER (WHERE split = 'train') AS n_train,
  count(*) FILTER (WHERE split = 'test') AS n_test, {n} AS seq_len, {batch} AS effective_batch FROM {table}"""
    for phase, table, source, n, batch in (
        ("phase1", "phase1", "cosmopedia-v2", 512, 256), ("phase2", "clean", "clean-stories", 8192, 128),
        ("phase3", "phase3", "sample-10BT", 2048, 256), ("phase4", "phase4", "cosmopedia-v2", 2048, 256),
        ("phase5", "phase5", "python-edu", 2048, 256), ("sft", "sft", "smol-smoltalk", 8192, 256))))
register("read_first", "SELECT doc_id, lang FROM documents LIMIT 250")
BYTE_VOCAB = f"""byte_vocab AS (SELECT {_SYMBOL} AS token, {_BYTE_ID} AS id FROM range(256) t(b)
  UNION SELECT * FROM (VALUES {_SPECIAL_ROWS}))"""
register("ids_to_tokens", with_(DOC_IDS, BYTE_VOCAB) + """
SELECT d.id, token, n FROM (SELECT id, count(*) AS n FROM (SELECT unnest(ids) AS id FROM doc_ids) GROUP BY id) d
LEFT JOIN byte_vocab v ON d.id = v.id""")
register("tokens_to_ids", with_(BYTE_VOCAB) + f"""
, seen AS (SELECT unnest(string_split(text, '')) AS token FROM documents
  UNION ALL SELECT token FROM (SELECT unnest(regexp_extract_all(text, {SPECIAL_RE_SQL}, 1)) AS token FROM documents)
  WHERE length(token) > 1)
SELECT s.token, CAST(coalesce(v.id, 5) AS INTEGER) AS id, v.id IS NOT NULL AS known, n
FROM (SELECT token, count(*) AS n FROM seen WHERE token <> '' GROUP BY token) s LEFT JOIN byte_vocab v ON s.token = v.token""")
