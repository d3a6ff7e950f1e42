"""SQL for the registered queries, over the same tables.

Each statement restates the operator on its own terms, not Spark's: it reads the tables, applies the
planting rules of the stand-ins and computes the result in one go.
"""

from __future__ import annotations

# Fixed values, written out here so that a wrong constant in the operators shows.
_WS = (
    "chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || chr(28) || chr(29) || chr(30) || chr(31) || chr(32)"
    " || chr(133) || chr(160) || chr(5760) || chr(8192) || chr(8193) || chr(8194) || chr(8195) || chr(8196)"
    " || chr(8197) || chr(8198) || chr(8199) || chr(8200) || chr(8201) || chr(8202) || chr(8232) || chr(8233)"
    " || chr(8239) || chr(8287) || chr(12288)"
)
_EVAL_NOTES = "Метрики с train; отдельный test split не использовался."
_ARTIFACTS = (
    "bronze_raw",
    "bronze_validated",
    "validation_report",
    "silver",
    "gold",
    "sft_train",
    "qwen_checkpoint_dir",
    "qwen_train_manifest",
    "qwen_metrics",
    "eval_report",
)
_DEFAULT_SYSTEM = "You are Qwen, created by Alibaba Cloud. You are a helpful assistant."


def _strip(expr: str) -> str:
    return f"trim({expr}, ({_WS}))"


def _share(part: str, total: str) -> str:
    """Share to four places from whole numbers, halves to even."""
    rest = f"2 * ({part} * 10000 % {total})"
    whole = f"{part} * 10000 // {total}"
    return (
        f"({whole} + CASE WHEN {rest} > {total} OR ({rest} = {total} AND ({whole}) % 2 = 1) "
        f"THEN 1 ELSE 0 END) / 10000.0::DOUBLE"
    )


_PUBLISHED = (
    "('2024-' || lpad(CAST(1 + doc_id % 12 AS VARCHAR), 2, '0') || '-' || "
    "lpad(CAST(1 + doc_id % 28 AS VARCHAR), 2, '0') || 'T00:00:00Z')"
)
_DAY = "('2026-01-0' || CAST(1 + doc_id % 3 AS VARCHAR))"

# Documents as bronze records.
_BRONZE = f"""
bronze AS (
  SELECT doc_id,
         CASE WHEN doc_id % 23 = 0 THEN 'http://example.com/abs/' ELSE 'http://arxiv.org/abs/' END
           || CAST(doc_id AS VARCHAR) AS url,
         CASE WHEN doc_id % 31 = 0 THEN 'abc' ELSE split_part(text, chr(10), 1) END AS title,
         text AS content,
         CASE WHEN doc_id % 5 <> 0 THEN source || '|' || lang ELSE '' END AS authors,
         CASE WHEN doc_id % 5 <> 0 THEN 2 ELSE 0 END AS n_authors,
         CASE WHEN doc_id % 29 = 0 THEN 'not-a-date' ELSE {_PUBLISHED} END AS published_at,
         {_DAY} AS process_date
  FROM documents)
"""

_EDGE = "CASE WHEN doc_id % 3 = 0 THEN '  ' WHEN doc_id % 3 = 1 THEN chr(9) ELSE chr(12288) || ' ' END"
_PADDED = f"""{_BRONZE},
padded AS (
  SELECT * REPLACE (
    CASE WHEN doc_id % 17 <> 0 THEN {_EDGE} || title || {_EDGE} END AS title,
    {_EDGE} || content || {_EDGE} AS content)
  FROM bronze)
"""


def _silver_of(rows: str) -> str:
    return f"""
silver AS (
  SELECT url, trim(title, ' ') AS title, trim(content, ' ') AS body, authors, published_at, process_date,
         CAST(length(trim(title, ' ')) AS INTEGER) AS title_len,
         CAST(length(trim(content, ' ')) AS INTEGER) AS body_len,
         CAST(n_authors AS INTEGER) AS n_authors, 'silver' AS layer
  FROM {rows})
"""


_GOLD = """
gold AS (
  SELECT * REPLACE ('gold' AS layer),
         CASE WHEN coalesce(title, '') = '' THEN 'unknown'
              ELSE list_extract(['nlp', 'deep-learning', 'systems', 'theory', 'evaluation'], h + 1) || '|' ||
                   list_extract(['nlp', 'deep-learning', 'systems', 'theory', 'evaluation'], (h + 2) % 5 + 1)
         END AS mock_topics,
         round(0.55::DOUBLE + least(body_len, 8000) / 20000.0::DOUBLE, 4) AS mock_quality_score,
         '[MOCK] Статья «' || substr(coalesce(title, ''), 1, 120) || '»; ~' ||
           CAST(body_len AS VARCHAR) || ' символов текста.' AS mock_summary,
         CAST(1 AS INTEGER) AS gold_schema_version
  FROM (SELECT *, CAST(coalesce(list_sum(list_transform(
                    string_split(substr(title, 1, 80), ''), lambda c: unicode(c))), 0) % 5 AS INTEGER) AS h
        FROM silver))
"""

_SILVER = f"WITH {_PADDED}, {_silver_of('padded')}"
_PADDED_GOLD = f"{_SILVER}, {_GOLD}"

# First failing check of the planted lines.
_FLAGGED = f"""{_BRONZE},
flagged AS (
  SELECT *,
    CASE
      WHEN doc_id % 37 = 0 OR doc_id % 41 = 0 OR doc_id % 43 = 0 OR doc_id % 47 = 0 THEN 'unparsable'
      WHEN doc_id % 61 = 0 AND doc_id % 53 <> 0 AND doc_id % 59 <> 0 THEN 'missing_key'
      WHEN doc_id % 67 = 0 AND doc_id % 53 <> 0 AND doc_id % 59 <> 0 AND doc_id % 61 <> 0 THEN 'bad_title'
      WHEN length({_strip('title')}) < 5 THEN 'bad_title'
      WHEN length({_strip('content')}) < 20 THEN 'bad_content'
      WHEN NOT contains(lower(url), 'arxiv') THEN 'bad_url'
      WHEN try_cast(replace(published_at, 'Z', '+00:00') AS TIMESTAMPTZ) IS NULL THEN 'bad_published_at'
      WHEN doc_id % 53 = 0 OR doc_id % 59 = 0 THEN 'bad_authors'
    END AS reason
  FROM bronze),
valid AS (
  SELECT * REPLACE (CASE WHEN nulled THEN '' ELSE authors END AS authors,
                    CASE WHEN nulled THEN 0 ELSE n_authors END AS n_authors)
  FROM (SELECT *, doc_id % 71 = 0 AND doc_id % 67 <> 0 AND doc_id % 61 <> 0 AS nulled
        FROM flagged WHERE reason IS NULL))
"""
_VALID_GOLD = f"WITH {_FLAGGED}, {_silver_of('valid')}, {_GOLD}"


def _split(rows: str) -> str:
    """Head, tail and fallback, with the two gates as they are stated."""
    return f"""
bodies AS (SELECT *, {_strip("coalesce(body, '')")} AS b, {_strip("coalesce(title, '')")} AS t FROM {rows}),
tails AS (SELECT *, substr(b, 1, 1400) AS head, substr(b, 1401, 1400) AS direct FROM bodies
          WHERE length(b) >= 160),
pieces AS (SELECT *, length(direct) < 50 AS fallback,
                  CASE WHEN length(direct) < 50 THEN substr(b, 801, 700) ELSE direct END AS tail
           FROM tails),
messages AS (
  SELECT *,
    'Given the arXiv paper title and the beginning of the abstract, continue the abstract in English.'
      || chr(10) || chr(10) || 'Title:' || chr(10) || t || chr(10) || chr(10)
      || 'Abstract (prefix):' || chr(10) || head || chr(10) AS prompt,
    {_strip('tail')} AS answer
  FROM pieces WHERE length(tail) >= 50)
"""


def _turn(role: str, content: str) -> str:
    return f"'<|im_start|>' || {role} || chr(10) || {content} || '<|im_end|>' || chr(10)"


_SYSTEM = _turn("'system'", f"'{_DEFAULT_SYSTEM}'")


def _gated(select: str, rows: str, text: str = "raw_text") -> str:
    """Strip, keep more than 40 characters, cut to 12,000."""
    return f"SELECT {select}, substr({_strip(text)}, 1, 12000) AS text FROM {rows} WHERE length({_strip(text)}) > 40"


def _forms(chat: bool) -> str:
    """Training rows in all forms; without a chat template messages render to nothing."""
    message = f"{_SYSTEM} || {_turn(chr(39) + 'user' + chr(39), 'doc')}" if chat else "NULL"
    layout = (
        "'### Instruction' || chr(10) || doc || chr(10) || '### Input' || chr(10) || "
        "CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END || chr(10) || '### Output' || chr(10) || source"
    )
    return f"""
forms AS (
  SELECT doc_id,
         CASE form WHEN 0 THEN {message}
                   WHEN 1 THEN {_strip('doc')} WHEN 2 THEN {_strip('doc')} WHEN 4 THEN {_strip('doc')}
                   WHEN 3 THEN {layout} END AS raw_text
  FROM (SELECT doc_id, text AS doc, doc_id % 5 AS form, lang, source FROM documents
        UNION ALL
        SELECT -1 - doc_id, repeat('x', CAST(doc_id % 9 + 36 AS BIGINT)), doc_id % 5, lang, source
        FROM documents WHERE doc_id % 11 = 0))
"""


_PLAIN = f"texts AS ({_gated('doc_id, lang', 'documents', 'text')})"

_CATEGORIES = "['cs.AI', 'cs.CL', 'cs.LG', 'cs.DB', 'math.CO']"
_ENTRIES = f"""
entries AS (
  SELECT doc_id, 'http://arxiv.org/abs/' || CAST(doc_id AS VARCHAR) AS id, split_part(text, chr(10), 1) AS title,
         CASE WHEN doc_id % 29 <> 0 THEN {_PUBLISHED} END AS published
  FROM documents
  WHERE list_has_any([list_extract({_CATEGORIES}, doc_id % 5 + 1),
                      list_extract({_CATEGORIES}, doc_id % 7 % 5 + 1)], ['cs.AI', 'cs.CL', 'cs.LG']))
"""

_LOSSES = f"""
losses AS (
  SELECT doc_id, {_DAY} AS process_date, source AS model_name, n_chars AS n_samples,
         CASE WHEN doc_id % 17 = 0 THEN NULL
              WHEN doc_id % 13 = 0 THEN 710.0::DOUBLE + n_chars
              ELSE (n_chars % 12000) / 1000.0::DOUBLE END AS train_loss
  FROM documents),
priced AS (
  SELECT *, CASE WHEN train_loss < 709.782712893384 THEN round(exp(train_loss), 4) END AS perplexity_estimate
  FROM losses)
"""


def _manifest() -> str:
    made = {
        "bronze_raw": "TRUE",
        "bronze_validated": "bool_or(ok)",
        "validation_report": "bool_or(ok)",
        "silver": "bool_or(ok)",
        "gold": "bool_or(ok)",
        "sft_train": f"bool_or(ok AND length({_strip('content')}) >= 850)",
    }
    trained = ("qwen_checkpoint_dir", "qwen_train_manifest", "qwen_metrics", "eval_report")
    made |= dict.fromkeys(trained, made["sft_train"])
    columns = [
        f"CASE WHEN {made[a]} THEN '{a}/process_date=' || day END AS {a}"
        if a in made
        else f"CAST(NULL AS VARCHAR) AS {a}"
        for a in _ARTIFACTS
    ]
    return f"""WITH {_FLAGGED},
days AS (SELECT *, reason IS NULL AS ok,
                CASE WHEN reason = 'unparsable' THEN 'unknown' ELSE process_date END AS day,
                CASE WHEN reason = 'unparsable' THEN NULL ELSE 'fixture' END AS run FROM flagged)
SELECT day AS process_date, run AS run_id, 'daily' AS pipeline, {', '.join(columns)}
FROM days GROUP BY day, run"""


_SILVER_COLUMNS = (
    "url, title, body, authors, published_at, process_date, title_len, body_len, n_authors, layer"
)
_GOLD_COLUMNS = (
    f"{_SILVER_COLUMNS}, mock_topics, mock_quality_score, mock_summary, gold_schema_version"
)


def oracle_sql() -> dict[str, str]:
    valid_gold = f"{_VALID_GOLD} SELECT {_GOLD_COLUMNS} FROM gold"
    chain = f"{_VALID_GOLD}, {_split('gold')}"
    rendered = f"{_SYSTEM} || {_turn(chr(39) + 'user' + chr(39), 'prompt')} || {_turn(chr(39) + 'assistant' + chr(39), 'answer')}"
    chain_texts = f"{chain}, chats AS (SELECT *, {rendered} AS raw_text FROM messages)"
    return {
        "raw_line_scan": f"""
SELECT lang, count(*) AS n_lines, CAST(sum(length(line)) AS BIGINT) AS n_chars
FROM (SELECT lang, {_strip("unnest(string_split(text, chr(10)))")} AS line FROM documents)
WHERE length(line) > 0 GROUP BY lang""",
        "feed_window": f"""WITH {_ENTRIES}
SELECT id, title, published FROM entries ORDER BY published DESC NULLS LAST, id LIMIT 200""",
        "feed_page": f"""WITH {_ENTRIES}
SELECT id, title, published FROM entries ORDER BY published DESC NULLS LAST, id LIMIT 20 OFFSET 20""",
        "feed_ranks": f"""WITH {_ENTRIES}, ranked AS (
  SELECT id, row_number() OVER (ORDER BY published DESC NULLS LAST, id) - 1 AS rank FROM entries)
SELECT id, rank, rank // 20 AS page FROM ranked""",
        "feed_deep_page": f"""WITH {_ENTRIES}, ranked AS (
  SELECT id, title, published, row_number() OVER (ORDER BY published DESC NULLS LAST, id) - 1 AS rank FROM entries)
SELECT id, title, published FROM ranked WHERE rank // 20 = (SELECT count(*) FROM ranked) // 20 // 2""",
        "scale_resolution": """WITH runs AS (
  SELECT doc_id,
         CASE doc_id % 7 WHEN 1 THEN 'smoke' WHEN 3 THEN 'test' END AS conf,
         CASE doc_id % 5 WHEN 0 THEN 'full' WHEN 3 THEN 'huge' END AS env,
         CASE doc_id % 3 WHEN 0 THEN 'smoke' END AS params
  FROM documents), named AS (
  SELECT doc_id, coalesce(conf, env, params, 'full') AS name FROM runs)
SELECT doc_id, CASE WHEN name IN ('smoke', 'test') THEN name ELSE 'full' END AS scale,
       CAST(CASE name WHEN 'smoke' THEN 5 WHEN 'test' THEN 20 ELSE 200 END AS BIGINT) AS n_rows
FROM named""",
        "rejected_lines": f"""WITH {_FLAGGED}, landed AS (
  SELECT doc_id // 500 AS shelf, reason,
         2 * row_number() OVER (PARTITION BY doc_id // 500 ORDER BY doc_id) AS line_number
  FROM flagged)
SELECT shelf, line_number, reason FROM landed WHERE reason IS NOT NULL""",
        "atom_ingest": f"""
SELECT 'arxiv' AS source, 'http://arxiv.org/abs/' || CAST(doc_id AS VARCHAR) AS url,
       {_strip('split_part(text, chr(10), 1)')} AS title, {_strip('text')} AS content,
       CASE WHEN doc_id % 5 <> 0 THEN source || '|' || lang ELSE '' END AS authors,
       CASE WHEN doc_id % 29 <> 0 THEN {_PUBLISHED} ELSE '' END AS published_at,
       {_PUBLISHED} AS updated_at, '2026-01-01' AS process_date, 'run' AS run_id
FROM documents""",
        "layer_roundtrip": f"{_SILVER} SELECT {_SILVER_COLUMNS} FROM silver",
        "validate_flags": f"WITH {_FLAGGED} SELECT doc_id, reason FROM flagged",
        "validated_records": f"""WITH {_FLAGGED}
SELECT doc_id, 'arxiv' AS source, url, title, content, nullif(authors, '') AS authors,
       published_at, published_at AS updated_at, process_date, 'fixture' AS run_id
FROM valid""",
        "validation_report": f"""WITH {_FLAGGED}
SELECT 'raw' AS raw_path, 'validated' AS validated_path, count(*) AS total_lines,
       count(*) - count(reason) AS valid, count(reason) AS invalid,
       {_share('count(reason)', 'count(*)')} AS invalid_ratio
FROM flagged""",
        "reject_reasons": f"""WITH {_FLAGGED}
SELECT reason, count(*) AS n FROM flagged WHERE reason IS NOT NULL GROUP BY reason""",
        "quality_gates": f"""WITH {_FLAGGED},
counts AS (
  SELECT CASE WHEN doc_id % 37 = 0 THEN 'cut' WHEN doc_id % 23 = 0 OR doc_id % 46 = 1 THEN 'mixed'
              ELSE 'rest' END AS delivery,
         count(*) AS total_lines, count(*) - count(reason) AS valid, count(reason) AS invalid
  FROM flagged GROUP BY delivery)
SELECT *, {_share('invalid', 'total_lines')} AS invalid_ratio,
       CASE WHEN valid = 0 THEN 'no valid records'
            WHEN invalid / total_lines > 0.5 THEN 'too many invalid lines' END AS failure
FROM counts""",
        "silver": f"{_SILVER} SELECT {_SILVER_COLUMNS} FROM silver",
        "gold_topics": f"{_PADDED_GOLD} SELECT url, title, mock_topics FROM gold",
        "gold_score": f"{_PADDED_GOLD} SELECT url, body_len, mock_quality_score FROM gold",
        "gold_summary": f"{_PADDED_GOLD} SELECT url, mock_summary FROM gold",
        "gold_full": f"{_PADDED_GOLD} SELECT {_GOLD_COLUMNS} FROM gold",
        "training_messages": f"{_PADDED_GOLD}, {_split('gold')} SELECT url, fallback, prompt, answer FROM messages",
        "training_split_stats": f"""{_SILVER}, {_split('silver')}
SELECT fallback, count(*) AS n, CAST(sum(length(head)) AS BIGINT) AS head_chars,
       CAST(sum(length(tail)) AS BIGINT) AS tail_chars, CAST(min(length(b)) AS INTEGER) AS shortest_body
FROM messages GROUP BY fallback""",
        "render_chat": f"""WITH chats AS (
  SELECT conv_id,
         CASE WHEN arg_min(role, turn) = 'system' THEN '' ELSE {_SYSTEM} END ||
         string_agg({_turn('role', 'text')}, '' ORDER BY turn) AS raw_text
  FROM conversations GROUP BY conv_id)
{_gated('conv_id', 'chats')}""",
        "render_fallbacks": f"WITH {_forms(True)} {_gated('doc_id', 'forms')}",
        "render_lines": f"WITH {_forms(False)} {_gated('doc_id', 'forms')}",
        "render_template": f"""WITH lines AS (
  SELECT doc_id, text, string_split(text, chr(10)) AS l, CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END AS system FROM documents),
turns AS (
  SELECT *, l[1 + system:] AS t,
         CASE WHEN system = 1 THEN '<<SYS>>' || chr(10) || {_strip('l[1]')} || chr(10) || '<</SYS>>' || chr(10) || chr(10) ELSE '' END AS opening
  FROM lines),
chats AS (
  SELECT doc_id, CASE WHEN doc_id % 7 = 0 OR len(t) = 0 THEN text ELSE array_to_string(list_transform(t, lambda x, i:
           CASE WHEN i % 2 = 1 THEN '<s>[INST] ' || {_strip("CASE WHEN i = 1 THEN opening || x ELSE x END")} || ' [/INST]'
                ELSE ' ' || {_strip('x')} || ' </s>' END), '') END AS raw_text
  FROM turns)
{_gated('doc_id', 'chats')}""",
        "text_gate": f"""WITH {_PLAIN}
SELECT lang, count(*) AS n_samples, CAST(sum(length(text)) AS BIGINT) AS n_chars FROM texts GROUP BY lang""",
        "token_truncate": f"""WITH {_PLAIN}, pieces AS (
  SELECT doc_id, regexp_extract_all(text, '[A-Za-z0-9]+|[^A-Za-z0-9\\t\\n\\x0B\\f\\r ]')[1:512] AS tokens FROM texts)
SELECT doc_id, CAST(len(tokens) AS INTEGER) AS n_tokens, array_to_string(tokens, ' ') AS tokens FROM pieces""",
        "token_ids": f"""WITH {_PLAIN}
SELECT doc_id, substr(hex(encode(text)), 1, 1024) AS ids,
       CAST(least(octet_length(encode(text)), 512) AS INTEGER) AS n_ids FROM texts""",
        "sample_count": f"""{chain_texts}
SELECT process_date, count(*) AS n_samples FROM chats
WHERE length({_strip('raw_text')}) > 40 GROUP BY process_date""",
        "perplexity": f"WITH {_LOSSES} SELECT doc_id, train_loss, perplexity_estimate FROM priced",
        "eval_report": f"""WITH {_LOSSES}
SELECT process_date, FALSE AS mock, train_loss, perplexity_estimate,
       'metrics/' || CAST(doc_id AS VARCHAR) AS metrics_source, 'cpu' AS device, model_name,
       '{_EVAL_NOTES}' AS notes
FROM priced""",
        "train_manifest": f"""WITH {_LOSSES}
SELECT doc_id, 'finished_micro_sft' AS status, FALSE AS mock, 'models/' || CAST(doc_id AS VARCHAR) AS checkpoint_dir,
       'models/' || CAST(doc_id AS VARCHAR) || '/metrics.json' AS metrics_path,
       model_name AS base_model, n_samples AS train_samples, 'cpu' AS device
FROM priced""",
        "manifest": _manifest(),
        "lines_to_gold": valid_gold,
        "lines_to_text": f"{chain_texts} {_gated('url', 'chats')}",
        "incremental": valid_gold,
        "stage_rows": f"""{chain}
SELECT 'silver' AS stage, process_date, count(*) AS rows, 'pyspark' AS engine FROM silver GROUP BY process_date
UNION ALL SELECT 'gold', process_date, count(*), 'pyspark' FROM gold GROUP BY process_date
UNION ALL SELECT 'sft_train', process_date, count(*), 'pyspark' FROM messages GROUP BY process_date""",
    }
