"""SQL, written for DuckDB, that each check query must agree with."""

from ..functions import words as W
from .vocabulary import CHECK_LEXICON, EDITS

# Unicode white space, as the body of a character class.
SPACE = (r"\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
         r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}")
MARK = "|".join("".join(f"[{c}]" for c in m) for m in sorted(W.EDGE_PUNCTUATION, key=len, reverse=True))
PLAIN = rf"[^{SPACE}!-/:-@\[-`{{-~]{{2,}}"
BATCH = r"^[0-9]{4}(-[0-9]{2}){4}$"


def text(value):
    return "'" + value.replace("'", "''") + "'"


def values(rows):
    def cell(v):
        return text(v) if isinstance(v, str) else f"{v!r}::DOUBLE"
    return "(VALUES " + ", ".join("(" + ", ".join(map(cell, r)) + ")" for r in rows) + ")"


def table(name, columns, rows):
    return f"{name}({', '.join(columns)}) AS {values(rows)}"


CHECK_WORDS = table("lexicon", ["word", "valence"], CHECK_LEXICON.items())
CORPUS_WORDS = r"""lexicon AS (
  SELECT word, ((length(word) * 7 + ascii(word)) % 17 - 8)::DOUBLE / 4.0::DOUBLE AS valence
  FROM (SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{M}]+')) AS word FROM benchmark))"""


def edited(column, edits):
    for old, new in edits:
        column = f"replace({column}, {text(old)}, {text(new)})"
    return column


def _step(distance, before):
    """One neighbour's effect on the valence ``before``."""
    k, x = distance, before
    near = "(w1 = 'so' OR w1 = 'this')"
    turned = f"CASE WHEN g{k} THEN -0.74e0 ELSE 1e0 END"
    factor = {
        1: turned,
        2: f"CASE WHEN w2 = 'never' AND {near} THEN 1.5e0 ELSE {turned} END",
        3: f"CASE WHEN (w3 = 'never' AND w2 IN ('so', 'this')) OR {near} THEN 1.25e0 ELSE {turned} END",
    }[k]
    decay = {1: "1e0", 2: "0.95e0", 3: "0.9e0"}[k]
    return f"""CASE WHEN w{k} IS NOT NULL AND v{k} IS NULL THEN
      ({x} + {decay} * coalesce(b{k} * CASE WHEN {x} < 0 THEN -1e0 ELSE 1e0 END
        + CASE WHEN u{k} AND shout THEN CASE WHEN {x} > 0 THEN 0.733e0 ELSE -0.733e0 END ELSE 0e0 END, 0e0))
      * {factor} ELSE {x} END"""


def scored(docs, lexicon=CHECK_WORDS, context="first", name="scored"):
    """CTEs that end in ``scored(id, body, score)`` for ``docs``, a query ``(id, body)``."""
    lag = ", ".join(f"lag({c}, {k}) OVER t AS {a}{k}" for c, a in
                    (("w", "w"), ("val", "v"), ("boost", "b"), ("neg", "g"), ("up", "u")) for k in (1, 2, 3))
    idioms = {"i1": "w1 || ' ' || w", "i2": "w2 || ' ' || w1 || ' ' || w", "i3": "w2 || ' ' || w1",
              "i4": "w3 || ' ' || w2 || ' ' || w1", "i5": "w3 || ' ' || w2",
              "i6": "w || ' ' || n1 || ' ' || n2", "i7": "w || ' ' || n1"}
    joins = " ".join(f"LEFT JOIN idioms {a} ON {a}.words = {e}" for a, e in idioms.items())
    judged = "first_value(x5) OVER (PARTITION BY id, w ORDER BY i)" if context == "first" else "x5"
    return f"""
{lexicon},
{table("boosters", ["word", "delta"], W.BOOSTERS.items())},
{table("negators", ["word"], [(w,) for w in W.NEGATORS])},
{table("idioms", ["words", "valence"], W.IDIOMS.items())},
docs AS ({docs}),
parts AS (
  SELECT id, list_transform(list_filter(string_split_regex(body, '[{SPACE}]+'), lambda x: length(x) > 1),
    lambda x: regexp_replace(x, {text(f"^(?:(?:{MARK})({PLAIN})|({PLAIN})(?:{MARK}))$")}, '\\1\\2')) AS ws
  FROM docs WHERE body IS NOT NULL),
tok AS (SELECT id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM parts),
low AS (SELECT *, lower(w) AS lw, (w = upper(w) AND w <> lower(w)) AS up FROM tok),
looked AS (
  SELECT low.*, l.valence AS val, b.delta AS boost, (n.word IS NOT NULL OR contains(lw, 'n''t')) AS neg
  FROM low LEFT JOIN lexicon l ON l.word = lw LEFT JOIN boosters b ON b.word = lw LEFT JOIN negators n ON n.word = lw),
ctx AS (
  SELECT *, {lag}, lead(w, 1) OVER t AS n1, lead(w, 2) OVER t AS n2,
    count(*) FILTER (WHERE up) OVER (PARTITION BY id) AS ups, count(*) OVER (PARTITION BY id) AS n,
    min(CASE WHEN lw = 'but' THEN i END) OVER (PARTITION BY id) AS but_at
  FROM looked WINDOW t AS (PARTITION BY id ORDER BY i)),
c0 AS (
  SELECT *, (ups > 0 AND ups < n) AS shout,
    val + CASE WHEN up AND ups > 0 AND ups < n THEN CASE WHEN val > 0 THEN 0.733e0 ELSE -0.733e0 END ELSE 0e0 END AS x0
  FROM ctx WHERE val IS NOT NULL),
c1 AS (SELECT *, {_step(1, "x0")} AS x1 FROM c0),
c2 AS (SELECT *, {_step(2, "x1")} AS x2 FROM c1),
c3 AS (SELECT *, {_step(3, "x2")} AS x3 FROM c2),
c4 AS (
  SELECT c3.*, CASE WHEN w3 IS NOT NULL AND v3 IS NULL THEN
      coalesce(i6.valence, i7.valence, i1.valence, i2.valence, i3.valence, i4.valence, i5.valence, x3)
      + CASE WHEN w3 || ' ' || w2 IN (SELECT word FROM boosters) OR w2 || ' ' || w1 IN (SELECT word FROM boosters)
             THEN -0.293e0 ELSE 0e0 END
    ELSE x3 END AS x4
  FROM c3 {joins}),
c5 AS (
  SELECT *, CASE WHEN boost IS NOT NULL OR (lw = 'kind' AND lower(n1) = 'of') THEN 0e0
    WHEN v1 IS NULL AND lower(w1) = 'least' AND coalesce(lower(w2), '') NOT IN ('at', 'very') THEN x4 * -0.74e0
    ELSE x4 END AS x5
  FROM c4),
judged AS (
  SELECT id, {judged} * CASE WHEN but_at IS NULL OR i = but_at THEN 1e0 WHEN i < but_at THEN 0.5e0 ELSE 1.5e0 END AS v
  FROM c5),
totals AS (SELECT id, sum(v) AS s FROM judged GROUP BY id),
marks AS (
  SELECT docs.id, body, round(coalesce(s, 0e0), 9) AS s,
    least(length(body) - length(replace(body, '!', '')), 4) * 0.292e0
    + CASE WHEN length(body) - length(replace(body, '?', '')) <= 1 THEN 0e0
           WHEN length(body) - length(replace(body, '?', '')) <= 3
           THEN (length(body) - length(replace(body, '?', ''))) * 0.18e0 ELSE 0.96e0 END AS p
  FROM docs LEFT JOIN totals ON totals.id = docs.id),
summed AS (SELECT id, body, s + sign(s) * p AS s FROM marks),
{name} AS (SELECT id, body, round(s / sqrt(s * s + 15e0), 4) AS score FROM summed)"""


def language(docs, name="detected"):
    """CTEs that end in ``detected(id, body, lang)`` for ``docs``, a query ``(id, body)``."""
    rows = [(lang, w) for lang, listed in W.STOP_WORDS.items() for w in listed]
    return f"""
{table("stop_words", ["lang", "word"], rows)},
texts AS ({docs}),
runs AS (SELECT id, unnest(regexp_extract_all(lower(body), '[\\p{{L}}\\p{{M}}]+')) AS word FROM texts),
ranks AS (SELECT id, lang, count(*) AS n FROM runs JOIN stop_words USING (word) GROUP BY id, lang),
best AS (SELECT id, max_by(lang, (n, lang)) AS lang FROM ranks GROUP BY id),
{name} AS (SELECT texts.id, body, lang FROM texts LEFT JOIN best ON best.id = texts.id)"""


def english(docs, name="translated"):
    """CTEs that end in ``translated(id, body, lang, english)``."""
    rows = [(f"{lang} {w}", e) for lang, listed in W.GLOSSARY.items() for w, e in listed.items()]
    return f"""{language(docs)},
{table("glossary", ["word", "english"], rows)},
cuts AS (
  SELECT id, lang, regexp_extract_all(body, '[\\p{{L}}\\p{{M}}]+|[^\\p{{L}}\\p{{M}}]+') AS ps
  FROM detected WHERE lang <> 'en'),
pieces AS (SELECT id, lang, unnest(ps) AS p, unnest(range(len(ps))) AS i FROM cuts),
turned AS (
  SELECT id, i, CASE WHEN g.english IS NULL THEN p
    WHEN length(p) > 1 AND p = upper(p) THEN upper(g.english)
    WHEN substr(p, 1, 1) <> lower(substr(p, 1, 1)) THEN upper(substr(g.english, 1, 1)) || substr(g.english, 2)
    ELSE g.english END AS p
  FROM pieces LEFT JOIN glossary g ON g.word = lang || ' ' || lower(p)),
rejoined AS (SELECT id, string_agg(p, '' ORDER BY i) AS english FROM turned GROUP BY id),
{name} AS (SELECT detected.id, body, lang, coalesce(english, body) AS english
           FROM detected LEFT JOIN rejoined ON rejoined.id = detected.id)"""


DOCUMENTS = "SELECT doc_id AS id, text AS body FROM documents"


def score_query(edits=(), **options):
    docs = f"SELECT doc_id AS id, {edited('text', edits)} AS body FROM documents"
    return f"WITH {scored(docs, **options)} SELECT id AS doc_id, score AS sentiment_score FROM scored"


REVIEWS = """reviews AS (
  SELECT d.doc_id AS review_id, CAST(substr(source, 4) AS INTEGER) AS business_id, text,
    CAST(DATE '2024-01-01' + CAST(d.doc_id % 366 AS INTEGER) AS VARCHAR) AS date, quality AS stars
  FROM documents d LEFT JOIN labels l ON l.doc_id = d.doc_id),
businesses AS (
  SELECT n_nationkey AS business_id, n_name AS name, r_name AS categories
  FROM nation JOIN region ON r_regionkey = n_regionkey)"""

REPORT = f"""WITH {scored(DOCUMENTS)}, {REVIEWS}
SELECT name AS "NOME", categories AS "CATEGORIAS", text AS "REVIEW", date AS "DATA_AVALIACAO",
  stars AS "ESTRELAS", score AS "SENTIMENT_SCORE",
  CASE WHEN score = 0 THEN 'NEUTRO' WHEN score > 0 THEN 'POSITIVO' WHEN score < 0 THEN 'NEGATIVO' END AS "SENTIMENTO"
FROM scored JOIN reviews ON review_id = id JOIN businesses USING (business_id)"""

MESSAGES = """messages AS (
  SELECT conv_id, turn, role || '@example.com' AS sender, 'desk-' || (conv_id % 7) || '@example.com' AS recipient,
    CASE WHEN turn % 4 = 3 THEN '' ELSE 'Conversation ' || conv_id || chr(10) || ' turn ' || turn END AS subject,
    CASE WHEN turn % 3 <> 0 THEN 'Mon, 1 Jan 2024 10:' || lpad(CAST(turn % 60 AS VARCHAR), 2, '0') || ':00 -0300' END AS date,
    text AS body, conv_id % 5 = 4 AS is_multipart
  FROM conversations)"""

LABEL_EMAIL = "CASE WHEN {0} > 0 THEN 'Positive' WHEN {0} < 0 THEN 'Negative' ELSE 'Neutral' END"
LABEL_REVIEW = "CASE WHEN {0} = 0 THEN 'NEUTRO' WHEN {0} > 0 THEN 'POSITIVO' WHEN {0} < 0 THEN 'NEGATIVO' END"

# The zone has kept UTC-3 since 2019.
EVENT_BATCHES = """batched AS (
  SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d-%H-%M') AS batch,
    CASE event_id % 5 WHEN 0 THEN 'zz-notes/' WHEN 1 THEN '' ELSE strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d-%H-%M') || '/' END
      || 'f' || event_id || '.json' AS name
  FROM events)"""

OBJECTS = """objects AS (
  SELECT page_id, '2024-01-0' || (page_id % 3 + 1) || '-10-00/'
    || CASE page_id % 4 WHEN 0 THEN 'emails_feedback_faker/' WHEN 1 THEN 'emails_feedback_faker_old/' WHEN 2 THEN '' ELSE 'x/y/' END
    || 'set_' || CASE page_id % 2 WHEN 0 THEN 'business' ELSE 'review' END
    || CASE page_id % 5 WHEN 0 THEN '.EML' WHEN 1 THEN '.json' ELSE '.eml' END AS name
  FROM pages)"""

MEMBERS = """SELECT 'html/' || page_id || '.html' AS member, CAST(strlen(html) AS BIGINT) AS size, md5(html) AS digest
FROM pages"""
LINES = """SELECT page_id, CAST(count(*) AS BIGINT) AS lines, CAST(sum(length(line)) AS BIGINT) AS characters FROM (
  SELECT page_id, unnest(string_split(html, chr(10))) AS line FROM pages)
GROUP BY page_id"""


def emails_report(docs):
    return f"""WITH {english(docs)}, {scored("SELECT id, english AS body FROM translated")}
SELECT id AS doc_id, score AS sentiment_score, {LABEL_EMAIL.format("score")} AS sentiment FROM scored"""


def oracles():
    sql = {f"score_{name}": score_query(edits) for name, edits in EDITS.items()}
    sql |= {
        "review_report": REPORT,
        "review_report_unique": REPORT,
        "refresh_view": f"SELECT DISTINCT * FROM ({REPORT})",
        "report_view": REPORT,
        "job_reviews": REPORT,
        "job_reviews_files": REPORT,
        "score_each": score_query(context="each"),
        "score_corpus_lexicon": score_query(lexicon=CORPUS_WORDS),
        "score_cut_lexicon": score_query(lexicon=CORPUS_WORDS),
        "score_joined_lexicon": score_query(lexicon=CORPUS_WORDS),
        "score_reviews": f"WITH {scored(DOCUMENTS)} SELECT id AS review_id, score AS sentiment_score FROM scored",
        "score_with_function": "SELECT doc_id, round(length(text)::DOUBLE / (length(text) + 1000), 4) AS sentiment_score FROM documents",
        "emails_report": emails_report(DOCUMENTS),
        "detect_language": f"WITH {language(DOCUMENTS)} SELECT id AS doc_id, lang AS language FROM detected",
        "detect_page": "WITH " + language(
            "SELECT page_id AS id, regexp_replace(html, '<[^>]*>', ' ', 'g') AS body FROM pages")
            + " SELECT id AS page_id, lang AS language FROM detected",
        "translate": f"WITH {english(DOCUMENTS)} SELECT id AS doc_id, english AS translated FROM translated",
        "translate_cut_glossary": f"WITH {english(DOCUMENTS)} SELECT id AS doc_id, english AS translated FROM translated",
        "translate_joined_glossary": f"WITH {english(DOCUMENTS)} SELECT id AS doc_id, english AS translated FROM translated",
        "translate_with_function": f"WITH {language(DOCUMENTS)} SELECT id AS doc_id, "
            "CASE WHEN lang <> 'en' THEN lang || ': ' || body ELSE body END AS translated FROM detected",
        "translate_in_part": f"""WITH {language(DOCUMENTS)} SELECT id AS doc_id,
            CASE WHEN lang <> 'en' AND NOT contains(body, 'ez') THEN lang || ': ' || body ELSE body END AS translated,
            CASE WHEN lang <> 'en' THEN NOT contains(body, 'ez') END AS ok FROM detected""",
        "label_nulls": f"""SELECT event_id, {LABEL_EMAIL.format("v")} AS email_label, {LABEL_REVIEW.format("v")} AS review_label
            FROM (SELECT event_id, CASE event_id % 10 WHEN 0 THEN NULL WHEN 1 THEN 0 ELSE value - 10 END AS v FROM events)""",
        "parse_emails": f"WITH {MESSAGES} SELECT * FROM messages",
        "parse_emails_original_names": f"""WITH {MESSAGES} SELECT conv_id, turn, sender AS remetente, recipient AS destinatario,
            subject AS assunto, date AS data, body AS corpo, is_multipart FROM messages""",
        "email_parts": """SELECT conv_id, turn, v.path, v.content_type, CASE WHEN v.path = '2.2' THEN turn || '.txt' END AS filename,
            CASE v.path WHEN '1' THEN md5(text) WHEN '2.1' THEN md5('<p>' || text || '</p>') WHEN '2.2' THEN md5(role) END AS digest
            FROM conversations CROSS JOIN (VALUES ('1', 'text/plain'), ('2', 'multipart/alternative'), ('2.1', 'text/html'),
            ('2.2', 'text/plain')) v(path, content_type) WHERE conv_id % 5 <> 3""",
        "email_rejects": "SELECT conv_id, turn FROM conversations WHERE conv_id % 7 = 0",
        "drop_json_key": """SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, event_type, value,
            CAST(2 AS BIGINT) AS keep, false AS has_attributes, CASE WHEN event_id % 20 = 6 THEN '2' END AS twice,
            CASE WHEN event_id % 20 = 6 THEN '123456789012345678901234567890123456789012345' ELSE '' END AS long
            FROM events WHERE event_id % 20 NOT IN (0, 1, 2, 3, 4, 10)""",
        "json_rejects": """SELECT event_id FROM events WHERE event_id % 20 IN (0, 1, 2, 3, 4, 10)""",
        "batch_key": "SELECT event_id, strftime(ts - INTERVAL 3 HOUR, '%Y-%m-%d-%H-%M') AS batch FROM events",
        "batches": f"WITH {EVENT_BATCHES} SELECT DISTINCT batch FROM batched WHERE name LIKE '2%/%'",
        "latest_batch": f"""WITH {EVENT_BATCHES} SELECT event_id, batch FROM batched
            WHERE name LIKE '2%/%' AND batch = (SELECT max(batch) FROM batched WHERE name LIKE '2%/%')""",
        "select_paths": f"""WITH {OBJECTS} SELECT page_id, name FROM objects
            WHERE name LIKE '%/emails!_feedback!_faker/%' ESCAPE '!' AND suffix(name, '.eml')""",
        "select_entity": f"WITH {OBJECTS} SELECT page_id, name FROM objects WHERE contains(name, 'business')",
        "entity_name": f"WITH {OBJECTS} SELECT page_id, CASE page_id % 2 WHEN 0 THEN 'business' ELSE 'review' END AS entity FROM objects",
        "list_objects": "SELECT 'b/' || page_id || '.html' AS name, CAST(strlen(html) AS BIGINT) AS length FROM pages WHERE page_id % 2 = 1",
        "create_table_as": "SELECT doc_id, text, lang, source, n_chars FROM documents",
        "create_table_as_columns": """SELECT n_nationkey AS business_id, r_name AS categories, n_name AS name
            FROM nation JOIN region ON r_regionkey = n_regionkey""",
        "replace_table": "SELECT doc_id, n_chars + 1 AS n_chars FROM documents",
        "external_table": "SELECT doc_id, lang, n_chars, text FROM documents",
        "save_external": "SELECT conv_id, turn, role, text FROM conversations",
        "archive_zip": MEMBERS,
        "archive_tar": MEMBERS,
        "archive_tar_gz": MEMBERS,
        "archive_members": f"SELECT v.kind, m.* FROM ({MEMBERS}) m CROSS JOIN (VALUES ('zip'), ('tar')) v(kind)",
        "archive_lines_zip": LINES,
        "archive_lines_tar": LINES,
        "write_batch": "SELECT '2024-01-02-10-00' AS batch, page_id, md5(md5(html)) AS digest FROM pages",
        "reland_batch": """SELECT '2024-01-02-10-00' AS batch, landing, CASE WHEN landing = 'again' OR page_id % 2 = 0 THEN 'review' ELSE 'tip' END AS entity,
            page_id, md5(html) AS digest FROM pages CROSS JOIN (VALUES ('after a failure'), ('again')) v(landing)""",
        "landing_members": """SELECT landing, 'emails_feedback_faker/' || CASE page_id % 5 WHEN 0 THEN '_' WHEN 1 THEN '.' ELSE '' END
            || page_id || '.eml' AS member, CAST(strlen(body) AS BIGINT) AS size, md5(body) AS digest
            FROM (SELECT page_id, CASE WHEN page_id % 7 = 0 THEN '' ELSE html END AS body FROM pages)
            CROSS JOIN (VALUES ('parquet'), ('files')) v(landing)""",
        "all_columns": """SELECT landing, name, number FROM (
              SELECT CAST(doc_id AS VARCHAR) AS name, CAST(doc_id % 9 AS BIGINT) AS number FROM documents
              UNION ALL SELECT n_name, CAST(n_nationkey AS BIGINT) FROM nation)
            CROSS JOIN (VALUES ('parquet'), ('files')) v(landing)""",
        "write_member_files": MEMBERS,
        "load_audit": "SELECT 'documents_copy' AS \"table\", count(*) AS \"rows\" FROM documents",
        "load_audit_content": """SELECT v."table", count(*) + CAST(v.more AS BIGINT) AS "rows", true AS as_stored, v.same
            FROM documents, (VALUES ('documents_copy', 0, true), ('dealt_anew', 0, true), ('changed', 0, false), ('doubled', 1, false)) v("table", more, same)
            GROUP BY v."table", v.more, v.same""",
        "preview": "SELECT doc_id, lang, n_chars FROM documents ORDER BY doc_id LIMIT 5",
        "job_emails": f"""WITH {MESSAGES}, {english("SELECT conv_id * 1000 + turn AS id, text AS body FROM conversations")},
            {scored("SELECT id, english AS body FROM translated")}
            SELECT sender, subject, score AS sentiment_score, {LABEL_EMAIL.format("score")} AS sentiment
            FROM scored JOIN messages ON id = conv_id * 1000 + turn""",
        "job_emails_files": f"WITH {MESSAGES} SELECT sender, recipient, subject, date, body, is_multipart FROM messages",
    }
    return sql
