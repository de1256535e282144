"""The registered queries as SQL for DuckDB, over views of the same tables."""

from stowline.plans.queries import CAP, DOCS_PER_FILE, NOW

_TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_REC = """
rec AS (
  SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition",
         row_number() OVER (PARTITION BY event_type, user_id % 4 ORDER BY event_id) - 1 AS "offset",
         epoch_us(ts) // 1000 AS ms, CAST(ts AS DATE) AS day, CAST(user_id AS VARCHAR) AS k, props AS v,
         CAST(event_id AS VARCHAR) AS h, event_id
  FROM events),
sized AS (
  SELECT *, CAST(28 + coalesce(strlen(k), 0) + coalesce(strlen(v), 0) + 8 + 8 + strlen(h) AS BIGINT) AS size,
         format('{:016X}', "offset") || format('{:016X}', ms)
         || format('{:08X}', strlen(k)) || format('{:08X}', strlen(v)) || '00000001'
         || hex(k) || hex(v) || '00000008' || hex('event_id') || format('{:08X}', strlen(h)) || hex(h)
         AS bytes
  FROM rec)"""

# one greedy walk in offset order over all groups at once
_WALK = f"""
WITH RECURSIVE {_REC},
walk AS (
  SELECT topic, "partition", "offset" AS pos, "offset" AS segment_start, 4 + size AS fill
  FROM sized WHERE "offset" = 0
  UNION ALL
  SELECT s.topic, s."partition", s."offset",
         CASE WHEN w.fill + s.size > {CAP} THEN s."offset" ELSE w.segment_start END,
         CASE WHEN w.fill + s.size > {CAP} THEN 4 + s.size ELSE w.fill + s.size END
  FROM walk w JOIN sized s
    ON s.topic = w.topic AND s."partition" = w."partition" AND s."offset" = w.pos + 1),
seg AS (
  SELECT topic, "partition", segment_start AS start_offset, max(pos) AS end_offset,
         count(*) AS record_count, max(fill) AS byte_length
  FROM walk GROUP BY ALL),
keyed AS (
  SELECT *, topic || '/' || "partition" || '/' || printf('%019d', start_offset) || '-'
         || printf('%019d', end_offset) AS key
  FROM seg)"""

_DAILY = f"""
WITH RECURSIVE {_REC},
numbered AS (
  SELECT *, row_number() OVER (PARTITION BY topic, "partition", day ORDER BY "offset") AS n FROM sized),
walk AS (
  SELECT topic, "partition", day, n, "offset" AS pos, "offset" AS segment_start, 4 + size AS fill
  FROM numbered WHERE n = 1
  UNION ALL
  SELECT s.topic, s."partition", s.day, s.n, s."offset",
         CASE WHEN w.fill + s.size > {CAP} THEN s."offset" ELSE w.segment_start END,
         CASE WHEN w.fill + s.size > {CAP} THEN 4 + s.size ELSE w.fill + s.size END
  FROM walk w JOIN numbered s
    ON s.topic = w.topic AND s."partition" = w."partition" AND s.day = w.day AND s.n = w.n + 1),
seg AS (
  SELECT topic, "partition", CAST(day AS VARCHAR) AS epoch, segment_start AS start_offset,
         max(pos) AS end_offset, count(*) AS record_count, max(fill) AS byte_length
  FROM walk GROUP BY ALL)
SELECT 'daily/' || topic || '/' || "partition" || '/' || printf('%019d', start_offset) || '-'
       || printf('%019d', end_offset) AS object_key, *
FROM seg"""

_SHOWN = """topic, "partition", "offset", ms, hex(k) AS key_hex, hex(v) AS value_hex,
       'event_id' AS header, hex(h) AS header_hex"""

_FILES = """
files AS (SELECT source || '/' || doc_id AS path, n_chars AS length, doc_id FROM documents),
state AS (
  SELECT path AS filename,
         CASE WHEN toxic = 1 THEN NULL WHEN quality = 1 THEN length ELSE length // 2 END AS position,
         CASE WHEN toxic = 1 AND quality = 1 THEN CAST(1.0 AS DOUBLE)
              WHEN toxic = 1 THEN CAST(0.5 AS DOUBLE) END AS progress
  FROM files JOIN labels USING (doc_id))"""

_LINES = f"""
parts AS (
  SELECT doc_id, lang, doc_id // {DOCS_PER_FILE} AS chunk, string_split(text, chr(10)) AS lines
  FROM documents WHERE text IS NOT NULL),
split AS (
  SELECT doc_id, lang, chunk, unnest(lines) AS line, CAST(generate_subscripts(lines, 1) - 1 AS INTEGER) AS line_no
  FROM parts),
placed AS (
  SELECT lang, chunk, line,
         CAST(sum(strlen(line) + 1) OVER (PARTITION BY lang, chunk ORDER BY doc_id, line_no) AS BIGINT) AS position
  FROM split),
own AS (
  SELECT doc_id, line_no, line,
         CAST(sum(strlen(line) + 1) OVER (PARTITION BY doc_id ORDER BY line_no) AS BIGINT) AS position,
         row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS n
  FROM split)"""

_LATENCY = f"epoch_us(TIMESTAMP '{NOW}') // 1000 - epoch_us(ts) // 1000"

_TARGETS = """CASE column_type
  WHEN 'BIGINT' THEN 'INT64' WHEN 'INTEGER' THEN 'INT32' WHEN 'VARCHAR' THEN 'STRING'
  WHEN 'DOUBLE' THEN 'FLOAT64' WHEN 'FLOAT' THEN 'FLOAT32' WHEN 'BOOLEAN' THEN 'BOOLEAN'
  WHEN 'TIMESTAMP' THEN 'INT64' WHEN 'DATE' THEN 'INT32' WHEN 'FLOAT[]' THEN 'STRUCT' END"""

_TEXT_FILES = """
        SELECT lang || '/' || (doc_id // DOCS) AS name, CAST(sum(strlen(text) + 1) AS BIGINT) AS length
        FROM documents GROUP BY 1"""

_ORDER_KEY = """'archive/2024/' || o_orderpriority || '/' || (o_custkey % 16) || '/'
       || printf('%019d', o_orderkey) || '-' || printf('%019d', o_orderkey + o_custkey)"""


def _swapped(expression: str) -> str:
    return f"array_to_string(list_reverse(regexp_extract_all({expression}, '..')), '')"


ORACLES = {
    "record_size": f"WITH {_REC} SELECT event_id, size FROM sized",
    "encode_record": f"WITH {_REC} SELECT event_id, bytes FROM sized",
    "encode_headers": """
        SELECT event_id, 'text' AS name, event_type AS value FROM events
        UNION ALL SELECT event_id, 'raw', to_base64(encode(props)) FROM events
        UNION ALL SELECT event_id, 'flag', CAST(user_id > 50 AS VARCHAR) FROM events
        UNION ALL SELECT event_id, 'number', CAST(nullif(user_id, 8) AS VARCHAR) FROM events""",
    "sortable_long": "SELECT o_orderkey, printf('%019d', o_orderkey) AS sortable FROM orders",
    "normalize_prefix": """
        SELECT doc_id, CASE WHEN length(text) % 3 = 0 THEN '' ELSE source || '/' END AS prefix
        FROM documents""",
    "valid_prefix": """
        SELECT o_orderkey, regexp_full_match(o_orderpriority, '[-a-zA-Z0-9_./]*') AS valid FROM orders""",
    "target_topic": """
        SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang || '-' || source ELSE source END AS topic
        FROM documents""",
    "object_key": f"SELECT o_orderkey, {_ORDER_KEY} AS object_key FROM orders",
    "parse_object_key": """
        SELECT o_orderkey, o_orderpriority AS topic, CAST(o_custkey % 16 AS INTEGER) AS "partition",
               o_orderkey AS start_offset, o_orderkey + o_custkey AS end_offset FROM orders""",
    "latency_ms": f"SELECT event_id, {_LATENCY} AS latency_ms FROM events",
    "text_byte_length": """
        SELECT doc_id, CAST(strlen(text) AS BIGINT) AS utf8,
               CAST(2 * length(text) + 2 * length(regexp_replace(text, '[^\\x{10000}-\\x{10FFFF}]', '', 'g')) AS BIGINT) AS utf16
        FROM documents""",
    "assign_segments": f"""{_WALK}
        SELECT topic, "partition", pos AS "offset", segment_start FROM walk""",
    "assign_segments_by_epoch": _DAILY,
    "segments_per_flush": f'SELECT topic, "partition", epoch, count(*) AS segments FROM ({_DAILY}) GROUP BY ALL',
    "segment_summary": f"""{_WALK}
        SELECT 'archive/' || key AS object_key, topic, "partition", start_offset, end_offset,
               record_count, byte_length FROM keyed""",
    "assemble_segments": f"""{_WALK}
        SELECT 'archive/' || key AS object_key, any_value(record_count) AS record_count,
               any_value(byte_length) AS byte_length,
               md5(unhex('00000000' || string_agg(bytes, '' ORDER BY w.pos))) AS payload_md5
        FROM walk w
        JOIN sized s ON s.topic = w.topic AND s."partition" = w."partition" AND s."offset" = w.pos
        JOIN keyed g ON g.topic = w.topic AND g."partition" = w."partition" AND g.start_offset = w.segment_start
        GROUP BY key""",
    "decode_segments": f"WITH {_REC} SELECT {_SHOWN} FROM rec",
    "write_segments": f"{_WALK} SELECT 'archive/' || key AS object_key, byte_length FROM keyed",
    "scan_segments": f"WITH {_REC} SELECT {_SHOWN} FROM rec",
    "scan_segments_range": f"""WITH {_REC} SELECT {_SHOWN} FROM rec
        WHERE topic IN ('click', 'view') AND "offset" BETWEEN 100 AND 300""",
    "segments_pushed": f"""WITH {_REC} SELECT {_SHOWN} FROM rec
        WHERE topic IN ('click', 'view') AND "offset" BETWEEN 100 AND 300""",
    "restore_order": f"""{_WALK}
        SELECT topic, "partition", key AS object_key, start_offset,
          CAST(row_number() OVER (PARTITION BY topic, "partition" ORDER BY key) AS INTEGER) AS rank FROM keyed""",
    "oversized_records": """
        SELECT lang AS topic, doc_id AS "offset", CAST(28 + strlen(text) AS BIGINT) AS size
        FROM documents WHERE 28 + strlen(text) + 4 > 8192""",
    "out_of_order": """
        WITH arrived AS (
          SELECT o_orderpriority AS topic, CAST(o_custkey % 4 AS INTEGER) AS "partition",
                 o_custkey AS "offset", o_orderkey AS arrival,
                 lag(o_custkey) OVER (PARTITION BY o_orderpriority, o_custkey % 4 ORDER BY o_orderkey)
                   AS previous_offset
          FROM orders)
        SELECT * FROM arrived WHERE previous_offset >= "offset" """,
    "dedupe_records": f"WITH {_REC} SELECT {_SHOWN} FROM rec",
    "list_files": _TEXT_FILES.replace("DOCS", str(DOCS_PER_FILE)),
    "regular_files": "SELECT page_id, url AS path FROM pages WHERE url NOT LIKE '%/'",
    "discover_new_files": _TEXT_FILES.replace("DOCS", str(DOCS_PER_FILE)),
    "plan_extents": f"""WITH {_FILES},
        begun AS (SELECT path, length, unnest(range(0, length, 1000)) AS start FROM files)
        SELECT path, start, least(1000, length - start) AS size FROM begun""",
    "files_with_offsets": f"""WITH {_FILES}
        SELECT path, length, position, progress FROM files LEFT JOIN state ON path = filename""",
    "unfinished_files": f"""WITH {_FILES}
        SELECT path FROM files LEFT JOIN state ON path = filename
        WHERE NOT coalesce(position >= length, false) AND NOT coalesce(progress >= 1.0, false)""",
    "new_files": f"""WITH {_FILES}
        SELECT path FROM files WHERE path NOT IN (SELECT filename FROM state)""",
    "latest_offsets": """
        SELECT 'conversation/' || conv_id AS filename, max(turn) AS position,
               max(CAST(turn AS DOUBLE) / 64) AS progress
        FROM conversations GROUP BY conv_id""",
    "invalid_offsets": """
        SELECT o_orderkey,
               CASE o_orderkey % 5 WHEN 1 THEN 'position is negative' WHEN 2 THEN 'position is missing'
                 WHEN 3 THEN 'position is not a long' ELSE 'filename is missing' END AS error
        FROM orders
        WHERE o_orderkey % 5 IN (1, 2, 3) OR (o_orderkey % 5 = 0 AND o_custkey % 2 = 0)""",
    "scan_lines": f"WITH {_LINES} SELECT lang, chunk, position, line FROM placed",
    "scan_lines_from_offsets": f"""WITH {_LINES},
        seen AS (
          SELECT lang, chunk, coalesce(max(position) FILTER (position <= 20000), 0) AS position
          FROM placed GROUP BY ALL)
        SELECT p.lang, p.chunk, p.position, p.line FROM placed p
        JOIN seen s ON s.lang = p.lang AND s.chunk = p.chunk WHERE p.position > s.position""",
    "tail_lines": f"WITH {_LINES} SELECT lang, chunk, position, line FROM placed",
    "tail_lines_restarted": f"WITH {_LINES} SELECT lang, chunk, position, line FROM placed",
    "tail_lines_bounded": f"WITH {_LINES} SELECT lang, chunk, position, line, TRUE AS bounded FROM placed",
    "scan_lines_reported": f"""WITH {_LINES}
        SELECT lang, chunk, position, line, FALSE AS failed FROM placed
        UNION ALL SELECT 'xx', 9, 0, NULL, TRUE""",
    "scan_lines_unterminated": f"""
        WITH flat AS (
          SELECT doc_id, lang, doc_id // {DOCS_PER_FILE} AS chunk, translate(text, chr(10), ' ') AS line
          FROM documents WHERE text IS NOT NULL)
        SELECT lang, chunk, line,
               CAST(sum(strlen(line) + 1) OVER (PARTITION BY lang, chunk ORDER BY doc_id) AS BIGINT) AS position
        FROM flat
        QUALIFY row_number() OVER (PARTITION BY lang, chunk ORDER BY doc_id DESC) > 1""",
    "line_position": f"WITH {_LINES} SELECT doc_id, line_no, position FROM own",
    "batch_number": f"WITH {_LINES} SELECT doc_id, line_no, (n - 1) // 10 AS batch FROM own",
    "to_source_records": f"""WITH {_LINES}
        SELECT 'documents/' || doc_id AS filename, position, CAST(NULL AS DOUBLE) AS progress,
               'documents' AS topic, CAST(NULL AS INTEGER) AS "partition", CAST(NULL AS VARCHAR) AS key,
               line AS value, epoch_ms(TIMESTAMP '{NOW}') AS ms
        FROM own""",
    "to_kafka_rows": f"""WITH {_LINES}
        SELECT 'documents' AS topic, CAST(NULL AS INTEGER) AS "partition", CAST(NULL AS VARCHAR) AS key,
               hex(line) AS value, CAST(0 AS BIGINT) AS headers
        FROM own""",
    "schema_inventory": " UNION ALL ".join(
        f"SELECT '{t}' AS name, column_name, {_TARGETS} AS target_type FROM (DESCRIBE {t})"
        for t in _TABLES
    ),
    "scan_parquet_physical": """
        SELECT vec_id, label, CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS idx,
               CAST(unnest(embedding) AS DOUBLE) AS element
        FROM embeddings""",
    "scan_parquet_merged": """
        SELECT event_id, CASE WHEN event_id % 2 = 1 THEN user_id END AS user_id,
               CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type,
               CASE WHEN event_id % 2 = 0 THEN value END AS value,
               CASE WHEN event_id % 2 = 0 THEN props END AS props
        FROM events""",
    "scan_timestamps_physical": """
        SELECT event_id, epoch_us(ts) AS ts, user_id, event_type, value, props FROM events""",
    "stream_parquet": """
        SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, epoch_us(o_orderdate) AS o_orderdate,
               o_orderpriority
        FROM orders""",
    "stream_parquet_widened": """
        SELECT event_id, CASE WHEN event_id % 2 = 1 THEN user_id END AS user_id,
               CASE WHEN event_id % 2 = 1 THEN event_type END AS event_type,
               CASE WHEN event_id % 2 = 0 THEN value END AS value,
               CASE WHEN event_id % 2 = 0 THEN props END AS props
        FROM events""",
    "parquet_progress": """
        SELECT event_id,
               CAST(row_number() OVER (ORDER BY event_id) AS DOUBLE) / count(*) OVER () AS progress
        FROM events""",
    "int96_bytes": f"""
        SELECT event_id,
               {_swapped("format('{:016X}', (epoch_us(ts) % 86400000000) * 1000)")}
               || {_swapped("format('{:08X}', 2440588 + epoch_us(ts) // 86400000000)")} AS int96
        FROM events""",
    "physical_maps": """
        SELECT o_orderkey, 'status' AS key, o_orderstatus AS value FROM orders
        UNION ALL SELECT o_orderkey, 'priority', o_orderpriority FROM orders""",
    "append_latencies": f"SELECT {_LATENCY} AS latency_ms, 2 * count(*) AS count FROM events GROUP BY 1",
    "append_latencies_stream": f"SELECT {_LATENCY} AS latency_ms, count(*) AS count FROM events GROUP BY 1",
    "write_segments_stream": """
        SELECT event_type AS topic, CAST(user_id % 4 AS INTEGER) AS "partition", event_id AS "offset",
               epoch_us(ts) // 1000 AS ms, hex(CAST(user_id AS VARCHAR)) AS key_hex, hex(props) AS value_hex,
               CAST(0 AS BIGINT) AS headers
        FROM events""",
}
