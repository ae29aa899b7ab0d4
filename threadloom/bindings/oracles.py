"""The same results in SQL over the same tables."""

from __future__ import annotations

from threadloom.bindings.tables import EPOCH, SITE
from threadloom.functions.answers import MISSING_ID
from threadloom.templates import (
    ARGUMENT_SYSTEM,
    ARGUMENT_USER,
    STANCE_USER,
    STRATEGIES,
)


def _text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def _filled(template: str, body: str) -> str:
    head, _, tail = template.partition("{}")
    return f"({_text(head)} || {body} || {_text(tail)})"


def _url(post_id: str) -> str:
    return f"('{SITE}' || lpad(CAST({post_id} AS VARCHAR), 18, '0'))"


def _quoted(column: str) -> str:
    return f"replace(coalesce({column}, 'nan'), '\"', '''')"


def _line(item_id: str, column: str) -> str:
    return (
        f"('[id: ' || CAST({item_id} AS VARCHAR) || ', text: \"' || {_quoted(column)} "
        f"|| '\"],' || chr(10))"
    )


REPLIES = f"""replies AS (
  SELECT conv_id * 1000 + turn AS id,
         CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS in_reply_to_id,
         conv_id * 1000 AS root_id, turn AS reply_depth,
         {_url('conv_id * 1000 + turn')} AS url, text AS content, role AS username,
         {EPOCH} + conv_id * 1000 + turn AS created_at
  FROM conversations)"""

ARGUMENTS = """frame AS (
  SELECT d.doc_id AS external_id, d.text AS content,
         CASE l.quality WHEN 1 THEN 'argumentative' WHEN 0 THEN '' END AS AM_output
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
pending AS (SELECT * FROM frame WHERE AM_output IS NULL OR AM_output = ''),
batches AS (
  SELECT *, rn // 20 AS batch_id FROM (
    SELECT *, row_number() OVER (ORDER BY external_id) - 1 AS rn FROM pending))"""

STANCES = REPLIES + """,
batches AS (
  SELECT *, rn // 25 AS batch_id FROM (
    SELECT r.id AS external_id, r.content, r.reply_depth, p.url AS parent_url,
           p.content AS parent_content,
           row_number() OVER (ORDER BY r.reply_depth NULLS LAST, p.url NULLS LAST, r.id) - 1 AS rn
    FROM replies r LEFT JOIN replies p ON r.in_reply_to_id = p.id))"""

RUNS = f"""{STANCES},
named AS (SELECT *, {_quoted('parent_content')} AS parent_text FROM batches),
runs AS (
  SELECT *, row_number() OVER w = 1 OR parent_text IS DISTINCT FROM lag(parent_text) OVER w
         AS run_start,
         row_number() OVER w = 1 AS batch_start
  FROM named WINDOW w AS (PARTITION BY batch_id ORDER BY rn))"""

_STANCE_WORD = (
    "CASE (external_id // 1000 + external_id) % 4 "
    "WHEN 0 THEN 'FOR' WHEN 1 THEN 'AGAINST' WHEN 2 THEN 'NEUTRAL' END"
)
_ARGUMENT_WORD = (
    "CASE external_id % 3 WHEN 0 THEN 'argumentative' WHEN 1 THEN 'not argumentative' END"
)
STANCE_VALUES = f"""{STANCES},
answered AS (
  SELECT *, 'The response is ' || {_STANCE_WORD} || ' because: reply '
         || CAST(external_id AS VARCHAR) || ' [sic] says so.' AS answer,
         {_STANCE_WORD} AS label
  FROM batches)"""

ARGUMENT_VALUES = f"""{ARGUMENTS},
answered AS (
  SELECT *, 'The response is ' || {_ARGUMENT_WORD} || ' because: of post '
         || CAST(external_id AS VARCHAR) AS answer,
         {_ARGUMENT_WORD} AS label,
         first_value(external_id) OVER (PARTITION BY batch_id ORDER BY rn) AS first_id
  FROM batches)"""


def _sliced(quote: str) -> str:
    """Slices from each id's first occurrence in the answer text to the next id's."""
    return f"""outputs AS (
  SELECT batch_id, '[' || chr(10) || coalesce(string_agg(
           '[id: ' || CAST(external_id AS VARCHAR) || ', annotation: {quote}' || answer || '{quote}]',
           ',' || chr(10) ORDER BY rn) FILTER (WHERE answer IS NOT NULL), '')
         || chr(10) || ']' AS output
  FROM answered GROUP BY batch_id),
marks AS (
  SELECT a.batch_id, a.external_id, o.output,
         strpos(o.output, CAST(a.external_id AS VARCHAR)) AS pos
  FROM answered a JOIN outputs o ON a.batch_id = o.batch_id),
slices AS (
  SELECT batch_id, external_id,
         regexp_replace(substr(output, pos, lead(pos, 1, length(output) + 1) OVER (
           PARTITION BY batch_id ORDER BY pos, external_id) - pos), '^\\s+|\\s+$', '', 'g') AS slice
  FROM marks WHERE pos > 0)"""


LOG = """parts AS (
  SELECT event_id // 4 AS "row", (event_id % 5) * 1000000000000 + event_id AS ord,
         CASE event_type WHEN 'error' THEN 0 WHEN 'purchase' THEN 1 END AS scraped,
         CASE WHEN event_type = 'error' THEN 'no answer'
              WHEN event_type IN ('purchase', 'click') THEN json_extract_string(props, '$.k')
         END AS output
  FROM events),
log AS (
  SELECT "row", CAST(arg_min(scraped, ord) FILTER (WHERE scraped IS NOT NULL) AS BIGINT) AS scraped,
         arg_min(output, ord) FILTER (WHERE output IS NOT NULL) AS output
  FROM parts GROUP BY "row")"""

OUTCOMES = f"""{REPLIES}, {LOG},
posts AS (
  SELECT doc_id AS "row", doc_id * 1000 AS root_id, {_url('doc_id * 1000')} AS url FROM documents),
pending AS (
  SELECT p.* FROM posts p
  WHERE NOT EXISTS (SELECT 1 FROM log l WHERE l."row" = p."row" AND l.scraped IN (0, 1)))"""

_STRATEGY_ROWS = ", ".join(f"({_text(k)}, {_text(v)})" for k, v in STRATEGIES.items())

ORACLES: dict[str, str] = {
    "scan_posts": f"""SELECT doc_id AS "row", {_url('doc_id * 1000')} AS url, text AS content,
      source AS file, n_chars FROM documents""",
    "scan_typed": f"WITH {REPLIES} SELECT id AS external_id, content, reply_depth FROM replies",
    "snapshot_commit": """SELECT doc_id AS "row", text AS content, source AS file FROM documents
      UNION ALL SELECT -doc_id, text, source FROM documents""",
    "input_rejects": f"""WITH {REPLIES}, tagged AS (
        SELECT r.id AS external_id, CASE WHEN r.id IS NULL THEN 'null id' WHEN r.content IS NULL THEN 'null text'
          WHEN p.content IS NULL THEN 'null parent' WHEN r.username = 'system' THEN 'null handle' END AS reason
        FROM replies r LEFT JOIN replies p ON r.in_reply_to_id = p.id)
      SELECT external_id, reason, CAST(1 AS BIGINT) AS n FROM tagged WHERE reason IS NOT NULL
      UNION ALL SELECT NULL, name, count(external_id) FROM
        (SELECT unnest(['null id', 'null text', 'null parent', 'null handle']) AS name)
        LEFT JOIN tagged ON reason = name GROUP BY name
      UNION ALL SELECT NULL, 'rows', count(*) FROM tagged
      UNION ALL SELECT NULL, 'kept', count(*) FROM tagged WHERE reason IS NULL""",
    "scan_files_union": """SELECT doc_id AS "row", text AS content,
      CASE WHEN length(source) = 4 THEN lang END AS lang, source AS file FROM documents""",
    "annotation_file": f"""WITH {ARGUMENTS}
      SELECT external_id, coalesce(AM_output, '') AS AM_output,
             CASE WHEN coalesce(AM_output, '') = '' THEN 'r1' ELSE 'r2' END AS run_id FROM frame""",
    "flatten_replies": f"""WITH {REPLIES}
      SELECT id, in_reply_to_id, created_at, CAST(NULL AS BIGINT) AS edited_at, url,
             reply_depth AS replies_count, length(content) AS favourites_count, content,
             username = 'system' AS sensitive, CAST(in_reply_to_id AS VARCHAR) AS first_mention,
             CAST(1 AS BIGINT) AS n_mentions, CAST(NULL AS VARCHAR) AS card_url,
             {_url('root_id')} AS PARENT_ID
      FROM replies WHERE id <> root_id""",
    "flatten_authors": f"""WITH {REPLIES}
      SELECT username, root_id // 1000 AS followers_count, reply_depth AS following_count,
             CAST({EPOCH} AS BIGINT) AS created_at, 'https://social.example/@' || username AS url,
             'account-' || username AS id, '<p>I am "' || username || '"</p>' AS note,
             username = 'system' AS bot, username = 'assistant' AS verified
      FROM replies WHERE id <> root_id""",
    "nested_to_json": f"""WITH {REPLIES}
      SELECT id, '[{{"id":"' || CAST(in_reply_to_id AS VARCHAR) || '","username":"parent"}}]' AS mentions,
             CAST(NULL AS VARCHAR) AS tags, CAST(NULL AS VARCHAR) AS card,
             {_url('root_id')} AS PARENT_ID
      FROM replies WHERE id <> root_id""",
    "json_field": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k
      FROM events""",
    "url_tail": "SELECT page_id, string_split(url, '/')[-1] AS tail FROM pages",
    "id_cast": """SELECT page_id, TRY_CAST(string_split(url, '/')[-1] AS BIGINT) AS external_id,
      TRY_CAST(string_split(url, '/')[-1] AS BIGINT) IS NOT NULL AS valid FROM pages""",
    "renamed_replies": f"""WITH {REPLIES}
      SELECT id AS external_id, reply_depth AS reply_count, length(content) AS like_count
      FROM replies WHERE id <> root_id""",
    "prepare_stances": f"""WITH {REPLIES}
      SELECT r.id AS external_id, r.content, r.reply_depth, p.url AS PARENT_URL,
             p.content AS PARENT_content
      FROM replies r LEFT JOIN replies p ON r.in_reply_to_id = p.id WHERE r.id <> r.root_id""",
    "prompt_lines": f"SELECT doc_id, {_line('doc_id', 'text')} AS line FROM documents",
    "prompt_template": f"""SELECT doc_id, {_filled(ARGUMENT_USER, _quoted('text'))} AS prompt
      FROM documents""",
    "strategy_join": f"""WITH strategies(strategy, rules) AS (VALUES {_STRATEGY_ROWS})
      SELECT d.doc_id, s.strategy, {_filled(ARGUMENT_SYSTEM, 's.rules')} AS system_prompt
      FROM documents d JOIN strategies s ON s.strategy = CASE d.lang WHEN 'en' THEN 'AM_Shots'
        WHEN 'de' THEN 'AM_CoT' WHEN 'fr' THEN 'AM_Shots_CoT' ELSE 'SD_Shots_CoT' END""",
    "am_pending": f"WITH {ARGUMENTS} SELECT external_id FROM pending",
    "sd_pending": f"""WITH {ARGUMENTS}
      SELECT external_id, 'all' AS rule FROM frame
      UNION ALL SELECT external_id, 'missing' AS rule FROM pending""",
    "eligible_counts": f"""WITH {ARGUMENTS}
      SELECT (SELECT count(*) FROM frame) AS n_rows, (SELECT count(*) FROM pending) AS n_pending""",
    "shard_assign": """SELECT doc_id AS "row",
      CAST(('0x' || substr(md5(CAST(doc_id AS VARCHAR)), 1, 8)) AS BIGINT) % 10 AS shard
      FROM documents""",
    "seeded_order": """SELECT doc_id AS "row",
      row_number() OVER (ORDER BY md5('42:' || CAST(doc_id AS VARCHAR)), doc_id) - 1 AS position
      FROM documents""",
    "min_replies": f"""WITH {REPLIES}
      SELECT root_id AS id, count(*) AS reply_count FROM replies WHERE id <> root_id
      GROUP BY root_id HAVING count(*) >= 3""",
    "pending_posts": f"""WITH {OUTCOMES} SELECT "row", url FROM pending""",
    "log_update": f"""WITH {REPLIES}, {LOG},
      news AS (SELECT root_id // 1000 AS "row", count(*) - 1 AS n FROM replies GROUP BY 1)
      SELECT log."row", CASE WHEN n IS NULL THEN scraped ELSE 1 END AS scraped,
             coalesce(CAST(n AS VARCHAR), output) AS output
      FROM log LEFT JOIN news ON log."row" = news."row" """,
    "merge_logs": f"WITH {LOG} SELECT * FROM log",
    "file_counts": "SELECT source AS file, count(*) AS n_rows FROM documents GROUP BY ROLLUP (source)",
    "dup_count": """SELECT count(*) AS n_rows, count(*) - count(DISTINCT text) AS n_duplicates,
      count(DISTINCT text) AS n_kept FROM documents""",
    "dedup_first": """SELECT doc_id AS "row", source AS file, text AS content FROM documents
      QUALIFY row_number() OVER (PARTITION BY text ORDER BY source, doc_id) = 1""",
    "combine_threads": """SELECT file, count(*) AS n_rows, CAST(count_if(nth = 1) AS BIGINT) AS n_kept FROM (
        SELECT source AS file, row_number() OVER (PARTITION BY text ORDER BY source, doc_id) AS nth
        FROM documents) GROUP BY file""",
    "distinct_authors": "SELECT DISTINCT o_custkey AS username FROM orders",
    "author_lookup": """SELECT u.username, c_name, c_nationkey, c_acctbal, c_mktsegment
      FROM (SELECT DISTINCT o_custkey AS username FROM orders) u
      LEFT JOIN customer ON u.username = c_custkey""",
    "missing_authors": """SELECT DISTINCT o_custkey AS username FROM orders
      WHERE o_custkey NOT IN (SELECT s_suppkey FROM supplier)""",
    "collect_authors": """WITH users AS (SELECT DISTINCT o_custkey AS k FROM orders)
      SELECT s_name AS username, CAST(s_nationkey AS BIGINT) AS followers_count,
             CAST(NULL AS VARCHAR) AS note, count(*) AS n
      FROM users JOIN supplier ON k = s_suppkey GROUP BY 1, 2
      UNION ALL
      SELECT 'not found', NULL, NULL, count(*) FROM users
      WHERE k NOT IN (SELECT s_suppkey FROM supplier)""",
    "post_replies": f"""WITH {REPLIES}
      SELECT {_url('root_id')} AS post_url, id, content FROM replies WHERE id <> root_id""",
    "reply_counts": f"""WITH {REPLIES}
      SELECT d.doc_id * 1000 AS root_id, d.doc_id AS "row", count(r.id) AS n_replies
      FROM documents d LEFT JOIN replies r ON r.root_id = d.doc_id * 1000 AND r.id <> r.root_id
      GROUP BY d.doc_id""",
    "direct_replies": f"WITH {REPLIES} SELECT root_id, id FROM replies WHERE in_reply_to_id = root_id",
    "oldest_n": f"""WITH {REPLIES}
      SELECT root_id, id, content FROM replies WHERE id <> root_id
      QUALIFY row_number() OVER (PARTITION BY root_id ORDER BY created_at, id) <= 3""",
    "pull_replies": f"""WITH {REPLIES}
      SELECT {_url('d.doc_id * 1000')} AS post_url, r.id, r.content
      FROM documents d JOIN replies r ON r.root_id = d.doc_id * 1000 AND r.id <> r.root_id
      QUALIFY row_number() OVER (PARTITION BY r.root_id ORDER BY r.created_at, r.id) <= 2""",
    "link_parents": f"""WITH {REPLIES}
      SELECT r.id, r.in_reply_to_id, p.url AS PARENT_URL, p.content AS PARENT_content
      FROM replies r LEFT JOIN replies p ON r.in_reply_to_id = p.id""",
    "thread_depth": f"""WITH RECURSIVE {REPLIES},
      tree AS (
        SELECT id, id AS root_id, CAST(0 AS BIGINT) AS reply_depth FROM replies
        WHERE in_reply_to_id IS NULL
        UNION ALL
        SELECT r.id, t.root_id, t.reply_depth + 1 FROM replies r JOIN tree t
        ON r.in_reply_to_id = t.id)
      SELECT *, CASE reply_depth WHEN 0 THEN 'root' ELSE 'reply' END AS status FROM tree""",
    "compile_thread": f"""WITH {OUTCOMES},
      counts AS (SELECT root_id, count(*) - 1 AS n FROM replies GROUP BY root_id)
      SELECT p."row", CAST(CASE WHEN n IS NULL THEN 0 ELSE 1 END AS BIGINT) AS scraped,
             coalesce(CAST(n AS VARCHAR), 'thread not landed') AS output
      FROM pending p LEFT JOIN counts c ON p.root_id = c.root_id""",
    "collected_replies": f"""WITH {OUTCOMES}
      SELECT r.id, p.url AS PARENT_ID, r.content
      FROM pending p JOIN replies r ON r.root_id = p.root_id AND r.id <> r.root_id""",
    "sd_order": f"""WITH {STANCES}
      SELECT external_id, reply_depth, parent_url AS PARENT_URL, rn FROM batches""",
    "dense_number": """SELECT source AS file, doc_id AS "row",
      row_number() OVER (ORDER BY source, doc_id) - 1 AS rn FROM documents""",
    "am_batches": f"WITH {ARGUMENTS} SELECT external_id, rn, batch_id FROM batches",
    "sd_batches": f"WITH {STANCES} SELECT external_id, rn, batch_id FROM batches",
    "batch_ids": f"""WITH {STANCES}
      SELECT batch_id, string_agg(CAST(external_id AS VARCHAR), ',' ORDER BY rn) AS ids,
             count(DISTINCT external_id) AS n_ids FROM batches GROUP BY batch_id""",
    "sd_runs": f"WITH {RUNS} SELECT batch_id, rn, external_id, run_start FROM runs",
    "am_prompts": f"""WITH {ARGUMENTS}
      SELECT batch_id, {_filled(ARGUMENT_USER,
        'string_agg(' + _line('external_id', 'content') + ", '' ORDER BY rn)")} AS prompt
      FROM batches GROUP BY batch_id""",
    "sd_prompts": f"""WITH {RUNS},
      pieces AS (
        SELECT batch_id, rn,
          CASE WHEN run_start AND NOT batch_start THEN ']],' || chr(10) ELSE '' END
          || CASE WHEN run_start THEN '[Tweet: "' || parent_text || '", Replies: [' || chr(10)
             ELSE '' END
          || {_line('external_id', 'content')} AS piece
        FROM runs)
      SELECT batch_id, {_filled(STANCE_USER,
        "('[' || string_agg(piece, '' ORDER BY rn) || ']]]')")} AS prompt
      FROM pieces GROUP BY batch_id""",
    "extract_compat": f"""WITH {STANCE_VALUES}, {_sliced('"')}
      SELECT a.batch_id, a.external_id AS id, coalesce(s.slice, '{MISSING_ID}') AS result
      FROM answered a LEFT JOIN slices s
      ON a.batch_id = s.batch_id AND a.external_id = s.external_id""",
    "extract_strict": f"""WITH {STANCE_VALUES}
      SELECT batch_id, external_id AS id, coalesce(answer, '{MISSING_ID}') AS result
      FROM answered""",
    "extract_nested": f"""WITH {REPLIES}
      SELECT id // 20 AS batch_id, id, CASE id % 6
        WHEN 0 THEN 'FOR because: see ["x' || CAST(id AS VARCHAR) || '"] and more'
        WHEN 1 THEN 'AGAINST because: they quote "[id: ' || CAST(id + 1 AS VARCHAR) || ', annotation: x]" here'
        WHEN 2 THEN 'NEUTRAL because: [sic] and' || chr(10) || 'a new line'
        WHEN 3 THEN 'FOR because: open [ bracket'
        WHEN 4 THEN 'AGAINST because: shut ] bracket'
        ELSE '{MISSING_ID}' END AS result FROM replies""",
    "am_label": f"""WITH {ARGUMENTS}
      SELECT external_id, CASE WHEN AM_output = 'argumentative' THEN AM_output
        ELSE replace({_ARGUMENT_WORD}, ' ', '_') END AS AM_label FROM frame""",
    "sd_label": f"WITH {STANCE_VALUES} SELECT external_id, label AS SD_label FROM answered",
    "annotate_arguments": f"""WITH {ARGUMENT_VALUES}
      SELECT f.external_id, CASE WHEN a.external_id IS NULL THEN f.AM_output
        ELSE coalesce(a.answer, '{MISSING_ID}') END AS AM_output
      FROM frame f LEFT JOIN answered a ON f.external_id = a.external_id""",
    "annotate_with_failures": f"""WITH {ARGUMENT_VALUES}
      SELECT f.external_id, CASE WHEN a.external_id IS NULL OR a.first_id % 7 = 3
        THEN f.AM_output ELSE coalesce(a.answer, '{MISSING_ID}') END AS AM_output
      FROM frame f LEFT JOIN answered a ON f.external_id = a.external_id""",
    "routed_arguments": f"""WITH {ARGUMENT_VALUES}
      SELECT f.external_id, CASE WHEN a.external_id IS NULL OR a.batch_id % 3 = 2 THEN f.AM_output
        WHEN a.batch_id % 3 = 1 THEN 'argumentative' ELSE coalesce(a.answer, '{MISSING_ID}') END AS AM_output
      FROM frame f LEFT JOIN answered a ON f.external_id = a.external_id""",
    "resume_arguments": f"""WITH {ARGUMENT_VALUES}
      SELECT f.external_id, CASE WHEN a.external_id IS NULL THEN f.AM_output
        ELSE coalesce(a.answer, '{MISSING_ID}') END AS AM_output
      FROM frame f LEFT JOIN answered a ON f.external_id = a.external_id""",
    "stream_retry": f"""SELECT doc_id AS external_id, CASE doc_id % 3
        WHEN 0 THEN 'The response is argumentative because: of post ' || CAST(doc_id AS VARCHAR)
        WHEN 1 THEN 'The response is not argumentative because: of post ' || CAST(doc_id AS VARCHAR)
        ELSE '{MISSING_ID}' END AS AM_output FROM documents""",
    "reply_rejects": f"""WITH {REPLIES}, posts AS (
        SELECT root_id, url, root_id // 1000 % 4 AS kind FROM replies WHERE id = root_id)
      SELECT p.url AS post_url,
        CASE WHEN kind = 0 THEN count(r.id) END AS n_replies,
        CASE kind WHEN 0 THEN NULL WHEN 1 THEN 'Record not found' ELSE 'page not readable' END AS error
      FROM posts p LEFT JOIN replies r ON r.root_id = p.root_id AND r.id <> r.root_id
      GROUP BY p.url, p.kind""",
    "am_output_projection": f"""WITH {ARGUMENT_VALUES}, {_sliced('')}
      SELECT f.external_id, CASE WHEN a.external_id IS NULL THEN f.AM_output
        ELSE coalesce(s.slice, '{MISSING_ID}') END AS AM_output
      FROM frame f LEFT JOIN answered a ON f.external_id = a.external_id
      LEFT JOIN slices s ON a.batch_id = s.batch_id AND a.external_id = s.external_id""",
    "annotate_stance": f"""WITH {STANCE_VALUES}
      SELECT external_id, coalesce(answer, '{MISSING_ID}') AS SD_output, label AS SD_label
      FROM answered""",
    "stream_replies": f"WITH {REPLIES} SELECT id, in_reply_to_id, content FROM replies",
    "stream_collect": f"""WITH {REPLIES}
      SELECT {_url('root_id')} AS PARENT_ID, 'reply' AS kind, content AS name
      FROM replies WHERE id <> root_id
      UNION ALL
      SELECT NULL, 'author', username FROM replies WHERE id <> root_id""",
    "stream_annotate": f"""WITH {STANCE_VALUES}
      SELECT external_id, coalesce(answer, '{MISSING_ID}') AS SD_output FROM answered""",
}

ORACLES["progress_counts"] = f"""WITH names AS (
    SELECT CASE WHEN o_orderkey % 7 <> 0 THEN o_custkey END AS username FROM orders),
  log AS ({ORACLES['merge_logs']})
  SELECT 'n_rows' AS what, count(*) AS n FROM log
  UNION ALL SELECT 'n_done', count(*) FROM log WHERE scraped = 1
  UNION ALL SELECT 'n_failed', count(*) FROM log WHERE scraped = 0
  UNION ALL SELECT 'n_open', count(*) FROM log WHERE scraped IS NULL
  UNION ALL SELECT 'n_names', count(*) FROM names
  UNION ALL SELECT 'n_null', count(*) FROM names WHERE username IS NULL
  UNION ALL SELECT 'n_authors', count(DISTINCT username) FROM names"""

ORACLES["scan_csv_blocks"] = ORACLES["scan_files_union"]
ORACLES["stream_items"] = ORACLES["stream_retry"]
ORACLES["stream_late_parents"] = ORACLES["link_parents"]
