"""SQL counterparts of the queries, for an independent engine to check them.

Written from the definitions, not from the Spark plans: the alignment, for one,
is the sequential rule itself, turn by turn, as a recursive query.
"""

from __future__ import annotations

from batchlens.functions import prompts
from batchlens.operators import backends
from batchlens.sources import synthetic

SYSTEM = "Answer in one sentence."


def _text(value: str) -> str:
    quoted = value.replace("'", "''").replace("\n", "' || chr(10) || '")
    return f"('{quoted}')"


def _around(template: str, hole: str, filler: str) -> str:
    before, after = template.split(hole)
    return f"{_text(before)} || {filler} || {_text(after)}"


def _question(spell: str, define: str) -> str:
    words = ", ".join(f"'{w}'" for w in synthetic.WORDS)
    return f"""
        SELECT id,
               CASE WHEN bits % 2 = 0 THEN {_around(spell, "{word}", "word")}
                    ELSE {_around(define, "{word}", "word")} END AS ask,
               word, bits % 2 = 0 AS spelled
        FROM (SELECT id, bits, [{words}][(bits // 2) % 20 + 1] AS word
              FROM (SELECT doc_id AS id,
                           (((doc_id % 2147483648) * 1103515245 + 12345) % 2147483648) // 65536
                               AS bits
                    FROM documents))"""


_QUESTIONS = _question(synthetic.SPELL, synthetic.DEFINE)
_BRIEF = _question(synthetic.SPELL_BRIEFLY, synthetic.DEFINE_BRIEFLY)
_ANSWER = """CASE WHEN spelled THEN array_to_string(string_split(upper(word), ''), '-')
                  ELSE 'A definition of ' || word || ' is not known to a rule.' END"""


def _llama(user: str) -> str:
    return (
        f"{_text(prompts.LLAMA_OPEN)} || '{SYSTEM}' || {_text(prompts.LLAMA_MIDDLE)} || {user}"
        f" || {_text(prompts.LLAMA_CLOSE)}"
    )


def _chatml(user: str) -> str:
    return (
        f"{_text(prompts.CHATML_SYSTEM)} || '{SYSTEM}' || {_text(prompts.CHATML_USER)} || {user}"
        f" || {_text(prompts.CHATML_ASSISTANT)}"
    )


_GENERATIONS = f"""
    SELECT id, text, 'The prompt has ' || length(text) || ' characters.' AS generated
    FROM (SELECT doc_id AS id, {_llama("text")} AS text FROM documents)"""

# --- rows: events as segments and chunks ------------------------------------

_CUT_SHORT = 'least("end", lead(start) OVER w)'
_EVENTS = f"""
    ev AS (SELECT user_id AS f, event_id AS pos, epoch_us(ts) / 1e6 AS start,
                  epoch_us(ts) / 1e6 + value AS "end", event_type AS label, props AS text
           FROM events),
    ch AS (SELECT f, row_number() OVER w - 1 AS i, text, start,
                  CASE WHEN lead(start) OVER w IS NOT NULL
                       THEN {_CUT_SHORT} END AS "end"
           FROM ev WINDOW w AS (PARTITION BY f ORDER BY start, pos))"""


def _turns(segments: str) -> str:
    """``tu(f, k, speaker, start, end)`` from ``segments(f, pos, start, end, label)``."""
    return f"""
    heads AS (SELECT f, pos, start, label, "end",
                     coalesce(lag(label) OVER w <> label, true) AS head,
                     last_value("end") OVER (PARTITION BY f ORDER BY start, pos
                         ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS final_end
              FROM {segments} WINDOW w AS (PARTITION BY f ORDER BY start, pos)),
    tu AS (SELECT f, row_number() OVER w - 1 AS k, label AS speaker, start,
                  coalesce(lead(start) OVER w, final_end) AS "end"
           FROM heads WHERE head WINDOW w AS (PARTITION BY f ORDER BY start, pos))"""


# The sequential rule: turn k takes what is left up to the nearest chunk end.
_FOLD = """
    ends AS (SELECT f, list(coalesce("end", 1.7976931348623157e308) ORDER BY i) AS e
             FROM ch GROUP BY f),
    fold AS (SELECT f, CAST(-1 AS BIGINT) AS k, CAST(0 AS BIGINT) AS lo, CAST(0 AS BIGINT) AS nxt
             FROM ends
             UNION ALL
             SELECT f, k, lo, lo + list_position(far, list_min(far)) AS nxt
             FROM (SELECT fold.f, tu.k, fold.nxt AS lo,
                          [abs(x - tu."end") for x in ends.e[fold.nxt + 1:]] AS far
                   FROM fold JOIN tu ON tu.f = fold.f AND tu.k = fold.k + 1
                             JOIN ends ON ends.f = fold.f
                   WHERE fold.nxt < len(ends.e))),
    taken AS (SELECT ch.f, ch.i, fold.k, tu.speaker, ch.text, ch.start, ch."end"
              FROM fold JOIN tu ON tu.f = fold.f AND tu.k = fold.k
                        JOIN ch ON ch.f = fold.f AND ch.i >= fold.lo AND ch.i < fold.nxt)"""

_BY_TURN = """
    SELECT f, k, any_value(speaker) AS speaker, string_agg(text, '' ORDER BY i) AS text,
           arg_min(start, i) AS start, list("end" ORDER BY i)[-1] AS "end"
    FROM taken GROUP BY f, k"""

# --- scripts: documents as transcripts, pages as diarized speech ------------


def _pieces(table: str, key: str, text: str, separator: str) -> str:
    return f"""
        SELECT f, i, piece, before / {backends.SPEECH_RATE}::DOUBLE AS start,
               (before + length(piece)) / {backends.SPEECH_RATE}::DOUBLE AS "end"
        FROM (SELECT f, i, piece,
                     CAST(coalesce(sum(length(piece)) OVER (PARTITION BY f ORDER BY i
                         ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS DOUBLE) AS before
              FROM (SELECT f, unnest(parts) AS piece,
                           unnest(range(len(parts))) AS i
                    FROM (SELECT {key} AS f, string_split({text}, {separator}) AS parts
                          FROM {table})))"""


_TRANSCRIPT = f"""
    ch AS (SELECT f, i, piece AS text, start,
                  CASE WHEN lead(i) OVER (PARTITION BY f ORDER BY i) IS NOT NULL THEN "end" END
                      AS "end"
           FROM ({_pieces("documents", "doc_id", "text", "chr(10)")}))"""
_SEGMENTS = f"""
    sg AS (SELECT f, i AS pos, start, "end",
                  'SPEAKER_0' || (length(piece) % 6) AS label
           FROM ({_pieces("pages", "page_id", "html", "'<'")}))"""
_SPEECH = f"{_TRANSCRIPT}, {_SEGMENTS}, {_turns('sg')}"
# Segments of a script can start together (empty pieces); their order is `pos`.
_SPEECH = _SPEECH.replace("ORDER BY start, pos", "ORDER BY pos")

_FILES = """
    SELECT c_custkey AS file_ids, c_name || '.mp3' AS file_name,
           '/audio/' || c_mktsegment || '/' || c_name || '.mp3' AS file_path
    FROM customer"""
_PRODUCTS = """
    SELECT p_partkey AS product_id, p_type AS "Category", p_brand AS "Gender",
           p_name || '.jpg' AS "Image",
           '/images/' || p_type || '/' || p_brand || '/Images/images_with_product_ids/'
               || p_name || '.jpg' AS file_path
    FROM part"""

_PIECE = """
    CASE WHEN before IS NULL THEN '<s>' ELSE '' END ||
    CASE WHEN role = 'assistant' THEN ' ' || text || '</s>'
         WHEN role = 'system' THEN
             CASE WHEN before.role = 'system' THEN '' ELSE '[INST] ' END || text ||
             CASE WHEN after IS NOT NULL AND after.role IS DISTINCT FROM 'assistant' THEN chr(10) || chr(10) ELSE ' [/INST]' END
         ELSE CASE WHEN before.role = 'system' THEN '' ELSE '[INST] ' END || text || ' [/INST]' END"""
_PIECES = f"""
    SELECT conv_id, turn, {_PIECE} AS piece
    FROM (SELECT conv_id, turn, role, coalesce(text, '') AS text,
                 lag({{'role': role}}) OVER w AS before, lead({{'role': role}}) OVER w AS after
          FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))"""

GIVEN = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

ORACLE = {
    "prompt_synth": f"SELECT id, ask AS text FROM ({_QUESTIONS})",
    "prompt_llama": f"SELECT doc_id AS id, {_llama('text')} AS text FROM documents",
    "prompt_mistral": "SELECT doc_id AS id, '[INST] ' || text || ' [/INST]' AS text FROM documents",
    "prompt_chatml": f"SELECT doc_id AS id, {_chatml('text')} AS text FROM documents",
    "prompt_chat": f"""
        SELECT conv_id, CAST(0 AS BIGINT) AS part, string_agg(piece, '' ORDER BY turn) AS prompt
        FROM ({_PIECES}) GROUP BY conv_id""",
    "prompt_chat_parts": f"""
        SELECT conv_id, part, string_agg(piece, '' ORDER BY turn) AS prompt
        FROM (SELECT *, CAST(((sum(length(piece)) OVER (PARTITION BY conv_id ORDER BY turn))
                              - length(piece)) // 200 AS BIGINT) AS part
              FROM ({_PIECES}))
        GROUP BY conv_id, part""",
    "batch_report": """
        SELECT CAST(greatest(4, ceil(n_rows / 1024)) AS BIGINT) AS n_partitions, n_rows, chars,
               TRUE AS even
        FROM (SELECT count(*) AS n_rows, CAST(sum(length(text)) AS BIGINT) AS chars FROM documents)""",
    "media_scan": """
        SELECT unnest(['region', 'nation', 'customer', 'supplier', 'part', 'orders', 'lineitem',
                       'events', 'documents', 'embeddings', 'pages', 'benchmark', 'labels',
                       'conversations']) || '.parquet' AS file_name,
               TRUE AS whole, 'PAR1' AS opens_with, 'PAR1' AS closes_with""",
    "media_content": " UNION ALL ".join(
        f"SELECT '{name}.parquet' AS file_name, count(*) AS n_rows FROM {name}" for name in GIVEN
    ),
    "batch_weights": """
        SELECT CAST(16 AS BIGINT) AS n_partitions, count(*) AS n_rows,
               CAST(sum(length(text)) AS BIGINT) AS chars, TRUE AS even
        FROM documents""",
    "partition_plan": """
        SELECT workload, total_rows,
               CAST(greatest(workers, ceil(total_rows / per_task)) AS BIGINT) AS num_partitions
        FROM (SELECT 'text' AS workload, count(*) AS total_rows, 4 AS workers, 1024 AS per_task
              FROM documents
              UNION ALL SELECT 'audio', count(*), 2, 4096 FROM customer
              UNION ALL SELECT 'image', count(*), 1, 32 FROM part)""",
    "generate": _GENERATIONS,
    "generate_questions": f"SELECT id, ask AS text, {_ANSWER} AS generated FROM ({_QUESTIONS})",
    "generate_chatml": f"""
        SELECT id, {_chatml("ask")} AS text, {_ANSWER} AS generated FROM ({_BRIEF})""",
    "generations_scan": _GENERATIONS,
    "write_table": _GENERATIONS,
    "join_candidates": f"""
        SELECT id, {_ANSWER} || ' ' || {_ANSWER} AS generated FROM ({_QUESTIONS})""",
    "token_totals": f"""
        SELECT sum(length(text)) / 4 AS input_tokens, sum(length(generated)) / 4 AS output_tokens,
               count(*) AS total_ct
        FROM ({_GENERATIONS})""",
    "chunk_plan": """
        SELECT doc_id AS id, (row_number() OVER (ORDER BY doc_id) - 1) // 4096 AS chunk_no
        FROM documents""",
    "union_chunks": """
        SELECT 'documents' AS piece, doc_id AS id,
               'The prompt has ' || length(text) || ' characters.' AS generated
        FROM documents
        UNION ALL
        SELECT 'benchmark', item_id, 'The prompt has ' || length(text) || ' characters.'
        FROM benchmark""",
    "speaker_turns": f"""
        WITH {_EVENTS}, {_turns("ev")}
        SELECT f AS file_ids, k AS turn, speaker, start, "end" FROM tu""",
    "align_chunks": f"""
        WITH RECURSIVE {_EVENTS}, {_turns("ev")}, {_FOLD}
        SELECT f AS file_ids, i AS chunk, k AS turn, speaker, text, start, "end" FROM taken""",
    "align_any_order": f"""
        WITH RECURSIVE {_EVENTS.replace(_CUT_SHORT, '"end"')}, {_turns("ev")}, {_FOLD}
        SELECT f AS file_ids, i AS chunk, k AS turn, speaker, text, start, "end" FROM taken""",
    "align_turns": f"""
        WITH RECURSIVE {_EVENTS}, {_turns("ev")}, {_FOLD}
        SELECT f AS file_ids, k AS turn, CAST(0 AS BIGINT) AS part, speaker, text, start, "end"
        FROM ({_BY_TURN})""",
    "transcribe": f"""
        WITH {_TRANSCRIPT}
        SELECT f AS file_ids, CAST(i AS INTEGER) AS chunk, text, start, "end" FROM ch""",
    "transcribe_windows": """
        SELECT doc_id AS file_ids, CAST(i AS INTEGER) AS chunk, substr(text, i * 75 + 1, 75) AS text,
               CAST(i * 5 AS DOUBLE) AS start, CASE WHEN i < n - 1 THEN CAST(i * 5 + 5 AS DOUBLE) END
                   AS "end"
        FROM (SELECT doc_id, text, n, unnest(range(n)) AS i
              FROM (SELECT doc_id, text, greatest(1, CAST(ceil(length(text) / 75.0) AS BIGINT)) AS n
                    FROM documents))""",
    "diarize_bounds": f"""
        SELECT f AS file_ids, CAST(i AS INTEGER) AS position, start, "end", 'A' AS track,
               'SPEAKER_0' || (length(piece) % greatest(2, least(3, count(*) OVER (PARTITION BY f))))
                   AS label
        FROM ({_pieces("pages", "page_id", "html", "'<'")})""",
    "diarize": f"""
        WITH {_SEGMENTS}
        SELECT f AS file_ids, CAST(pos AS INTEGER) AS position, start, "end", 'A' AS track, label
        FROM sg""",
    "diarize_turns": f"""
        WITH {_SPEECH}
        SELECT f AS file_ids, CAST(k AS INTEGER) AS turn, speaker, start, "end" FROM tu""",
    "turns_json": f"""
        WITH {_SPEECH}
        SELECT f AS file_ids,
               CAST(to_json(list({{'segment': {{'start': start, 'end': "end"}}, 'speaker': speaker}}
                                 ORDER BY k)) AS VARCHAR) AS diarization
        FROM tu GROUP BY f""",
    "parse_media_json": f"""
        WITH {_SPEECH}
        SELECT f AS file_ids, CAST(k AS INTEGER) AS turn, speaker, start, "end" FROM tu""",
    "media_join": f"""
        WITH {_SPEECH}
        SELECT file_ids, file_name, file_path,
               CAST(c.n AS INTEGER) AS n_chunks, CAST(t.n AS INTEGER) AS n_turns
        FROM ({_FILES})
        LEFT JOIN (SELECT f, count(*) AS n FROM ch GROUP BY f) c ON c.f = file_ids
        LEFT JOIN (SELECT f, count(*) AS n FROM tu GROUP BY f) t ON t.f = file_ids""",
    "media_final": f"""
        WITH RECURSIVE {_SPEECH}, {_FOLD}
        SELECT file_ids, file_name, CAST(i AS INTEGER) AS position, speaker, text, start, "end"
        FROM ({_FILES}) LEFT JOIN taken ON taken.f = file_ids""",
    "media_final_turns": f"""
        WITH RECURSIVE {_SPEECH}, {_FOLD}
        SELECT f AS file_ids, CAST(k AS INTEGER) AS position, speaker, text, start, "end"
        FROM ({_BY_TURN}) JOIN customer ON c_custkey = f""",
    "media_path": f"SELECT product_id, file_path FROM ({_PRODUCTS})",
    "csv_scan": """
        SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_type AS "Category",
               p_brand AS "Gender", p_name || '.jpg' AS "Image"
        FROM part""",
    "bounded_sample": f"SELECT * FROM ({_PRODUCTS}) ORDER BY product_id LIMIT 1000",
    "caption": f"""
        SELECT *, {_text(backends.CAPTION_QUESTION)} || ' A picture named ' || "Image" || '.'
                   AS caption
        FROM ({_PRODUCTS})""",
    "audio_prepare": """
        WITH w AS (SELECT vec_id, embedding AS x, [8000, 16000, 22050, 44100][label % 4 + 1] AS rate
                   FROM embeddings),
             g AS (SELECT *, rate // gcd(rate, 16000) AS step, 16000 // gcd(rate, 16000) AS phases
                   FROM w),
             o AS (SELECT *, least(step, phases) * 0.99::DOUBLE AS cutoff,
                          unnest(range(CAST(ceil(len(x) * phases / step) AS BIGINT))) AS j
                   FROM g),
             t AS (SELECT vec_id, rate, j, x, step, cutoff,
                          unnest(range(len(x))) AS n, phases
                   FROM o WHERE rate <> 16000),
             a AS (SELECT vec_id, j, CAST(x[n + 1] AS DOUBLE) AS v, step, cutoff,
                          (n / step - j / phases) * cutoff AS z
                   FROM t),
             r AS (SELECT vec_id, j,
                          sum(CASE WHEN abs(z) >= 6 THEN 0
                                   ELSE v * CASE WHEN z = 0 THEN 1
                                                 ELSE sin(pi() * z) / (pi() * z) END
                                        * pow(cos(z * pi() / 12), 2) * cutoff / step END) AS v
                   FROM a GROUP BY vec_id, j)
        SELECT vec_id AS file_ids, 16000 AS sampling_rate, CAST(j AS INTEGER) AS j,
               CAST(round(v * 32767) AS BIGINT) AS level
        FROM (SELECT vec_id, j, v FROM r
              UNION ALL
              SELECT vec_id, j, CAST(x[j + 1] AS DOUBLE) FROM o WHERE rate = 16000)""",
}
# Other ways to the same rows.
ORACLE["replace_table"] = _GENERATIONS
ORACLE["csv_by_header"] = ORACLE["csv_scan"]
ORACLE["media_ranges"] = ORACLE["media_scan"]
ORACLE["audio_rows"] = ORACLE["audio_prepare"]
ORACLE["transcribe_function"] = ORACLE["transcribe"]
ORACLE["diarize_function"] = ORACLE["diarize"]

ORACLE |= {
    "sql_prompts": f"""
        SELECT doc_id AS id, {_llama('text')} AS llama, '[INST] ' || text || ' [/INST]' AS mistral,
               {_chatml('text')} AS chatml
        FROM documents""",
    "sql_token_totals": ORACLE["token_totals"],
    "sql_media_join": ORACLE["media_join"],
    "sql_media_final_turns": ORACLE["media_final_turns"],
    "parse_media_variant": f"""
        WITH {_SPEECH}
        SELECT f AS file_ids, CAST(CASE f % 3 WHEN 0 THEN k + 2 ELSE k END AS INTEGER) AS turn,
               speaker, start, "end", CAST(NULL AS VARCHAR) AS problem
        FROM tu WHERE f % 3 <> 1
        UNION ALL SELECT page_id, 0, NULL, NULL, NULL, 'element' FROM pages WHERE page_id % 3 = 0
        UNION ALL SELECT page_id, 1, 'x', NULL, 1.0, 'element' FROM pages WHERE page_id % 3 = 0
        UNION ALL SELECT page_id, NULL, NULL, NULL, NULL, 'text' FROM pages WHERE page_id % 3 = 1""",
}
