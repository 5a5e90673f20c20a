"""The queries of ``checks/queries.py`` in SQL, for DuckDB.

Written from the meaning of each operator: windows, plain joins and whole
tables, without the short cuts that the Spark operators take.
"""

from __future__ import annotations

from veristream import fixed_values as fv

# --- pieces -------------------------------------------------------------------

WS = (
    r"\t-\r\x{1c}- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
)
BLANKS = "".join(
    [chr(c) for c in (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 0x85, 0xA0, 0x1680)]
    + [chr(c) for c in range(0x2000, 0x200B)]
    + [chr(c) for c in (0x2028, 0x2029, 0x202F, 0x205F, 0x3000)]
)
HIDDEN = (
    r"(?is)<!--.*?-->|<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>"
    r"|<template\b[^>]*>.*?</template\s*>|<![^>]*>"
)


def q(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def trim(x: str) -> str:
    return f"trim({x}, {q(BLANKS)})"


def sub(x: str, pattern: str, by: str = " ") -> str:
    return f"regexp_replace({x}, {q(pattern)}, {q(by)}, 'g')"


def collapse(x: str) -> str:
    return sub(x, f"[{WS}]+")


def no_urls(x: str) -> str:
    return sub(x, f"http[^{WS}]+|www\\.[^{WS}]+")


def no_tags(x: str) -> str:
    return sub(x, "<.*?>")


def alnum(x: str) -> str:
    return sub(x, f"[^a-z0-9{WS}]")


def clean_train(x: str) -> str:
    return trim(collapse(alnum(no_tags(no_urls(f"lower({x})")))))


def clean_similarity(x: str) -> str:
    return trim(collapse(alnum(sub(no_urls(no_tags(f"lower({x})")), "&nbsp;|&amp;|&quot;"))))


def strip_tags(x: str) -> str:
    return trim(collapse(sub(x, "<[^>]+>")))


def decode(x: str) -> str:
    for name, char in [
        ("&nbsp;", "\xa0"), ("&#160;", "\xa0"), ("&quot;", '"'), ("&#34;", '"'), ("&apos;", "'"),
        ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&hellip;", "…"), ("&mdash;", "—"),
        ("&ndash;", "–"), ("&lsquo;", "‘"), ("&rsquo;", "’"), ("&ldquo;", "“"),
        ("&rdquo;", "”"), ("&copy;", "\xa9"), ("&reg;", "\xae"), ("&middot;", "\xb7"), ("&amp;", "&"), ("&#38;", "&"),
    ]:
        x = f"replace({x}, {q(name)}, {q(char)})"
    return f"regexp_replace({x}, '&amp([^a-zA-Z0-9]|$)', '&\\1', 'g')"  # this one does without its semicolon


def pieces(x: str, separator: str) -> str:
    split = f"string_split_regex({sub(x, HIDDEN, '<>')}, '<[^>]*>')"
    return (
        f"array_to_string(list_filter(list_transform({split}, lambda z: {trim(decode('z'))}), "
        f"lambda z: z <> ''), {q(separator)})"
    )


def has(x: str, words) -> str:
    return "(" + " OR ".join(f"contains(lower({x}), {q(w)})" for w in words) + ")"


def cases(x: str, mapping: dict, default: str | None = None) -> str:
    whens = " ".join(f"WHEN {k if isinstance(k, int) else q(k)} THEN {q(v)}" for k, v in mapping.items())
    return f"CASE {x} {whens} ELSE {'NULL' if default is None else q(default)} END"


HOAX = ["tion der", "stion", "ouon", "the the"]
FORMAL = ["with", "des", "und"]
EVENT_LABELS = {
    "error": "Penipuan", "click": "Hoaks", "view": "Valid", "purchase": "Netral", "signup": "Review",
}
TOPIC = cases("user_id % 3", {0: "rss-news", 1: "telegram-messages"}, "twitter-tweets")
ISO = "strftime({}, '%Y-%m-%dT%H:%M:%SZ')"

FEED = f"""feed AS (
  SELECT CAST(event_id AS VARCHAR) AS id,
    CASE WHEN user_id % 50 = 0 THEN '' ELSE {ISO.format('ts')} END AS timestamp,
    CASE WHEN user_id % 20 = 7 THEN '' ELSE 'user_' || (user_id % 20) END AS source,
    {cases('user_id % 3', {0: 'RSS', 1: 'Telegram'}, 'Twitter')} AS source_type,
    event_type || ' ' || props AS text_snippet,
    {cases('event_type', EVENT_LABELS)} AS label,
    least(value / 5, 100.0) AS confidence,
    json_extract_string(props, '$.k') AS topic,
    'http://example.com/' || event_id AS url
  FROM events)"""

LABELED = """labeled AS (
  SELECT doc_id, text, source,
    CASE WHEN quality = 1 AND toxic <> 1 THEN 'Valid' WHEN quality <> 1 AND toxic <> 1 THEN 'Netral'
         WHEN quality = 1 AND toxic = 1 THEN 'Hoaks' ELSE 'Penipuan' END AS final_label
  FROM labels JOIN documents USING (doc_id))"""

CODE = "CASE final_label WHEN 'Valid' THEN 0 WHEN 'Hoaks' THEN 1 WHEN 'Penipuan' THEN 2 ELSE 3 END"

MESSAGES = f"""messages AS (
  SELECT event_id, ts, {TOPIC} AS topic,
    CASE event_id % 7
      WHEN 0 THEN '{{"message":"<b>m</b>  ' || event_id || '","title":"t"}}'
      WHEN 1 THEN '{{"title":"t ' || event_id || '","description":""}}'
      WHEN 2 THEN '{{"text":"x ' || event_type || '","message":"m"}}'
      WHEN 3 THEN '{{"text":null,"message":"m ' || event_id || '"}}'
      WHEN 4 THEN 'oops ' || event_id
      WHEN 5 THEN '{{"title":"  a\\n' || event_id || ' <i>b</i>"}}'
      ELSE '{{"description":' || event_id || '}}' END AS value
  FROM events),
chosen AS (
  SELECT *, CASE WHEN NOT json_valid(value) THEN NULL
      WHEN json_exists(value, '$.text') THEN '$.text'
      WHEN json_exists(value, '$.message') THEN '$.message'
      WHEN json_exists(value, '$.description') THEN '$.description'
      ELSE '$.title' END AS path
  FROM messages),
cleaned AS (
  SELECT event_id, topic, value, ts,
    CASE WHEN path IS NOT NULL AND json_type(value, path) = 'VARCHAR'
      THEN {strip_tags('json_extract_string(value, path)')} END AS text,
    CASE WHEN path IS NULL THEN 'not json'
      WHEN json_type(value, path) <> 'VARCHAR' THEN 'no text' END AS problem
  FROM chosen)"""

ENVELOPES = f"""envelopes AS (
  SELECT event_id, {TOPIC} AS source_topic, value / 5 AS score,
    {cases('event_type', EVENT_LABELS)} AS label,
    CASE WHEN event_id % 5 = 0 THEN 'politik' ELSE '' END AS category,
    {ISO.format('ts')} AS iso, event_type, user_id, user_id % 3 AS kind
  FROM events),
originals AS (
  SELECT *,
    CASE WHEN kind = 0 THEN NULL WHEN kind = 2 THEN 'tw_' || (event_id - event_id % 6) END AS given_id,
    CASE kind WHEN 0 THEN 'src' || (event_id % 9) WHEN 1 THEN 'ch' || (event_id % 4) ELSE source_topic END AS source,
    CASE kind WHEN 0 THEN 'RSS' WHEN 1 THEN 'Telegram' ELSE 'Twitter' END AS source_type,
    CASE kind WHEN 0 THEN 'http://e.com/' || event_id ELSE '' END AS url,
    CASE kind
      WHEN 0 THEN 'T ' || event_id || CASE WHEN event_id % 40 > 0
          THEN ' - ' || rtrim(repeat(event_type || ' ', CAST(event_id % 40 AS BIGINT))) ELSE '' END
      WHEN 1 THEN 'hello ' || event_id ELSE event_type || ' ' || event_id END AS body
  FROM envelopes),
flat AS (
  SELECT event_id,
    coalesce(given_id, sha256(source_topic || chr(31) || CASE WHEN kind = 0 THEN url ELSE body END || chr(31) || iso || chr(31) || source || chr(31) || CASE WHEN kind = 1 THEN 'u' || (user_id % 50) ELSE '' END)) AS id,
    iso AS timestamp, source, source_type,
    CASE WHEN length(body) > 150 THEN substring(body, 1, 147) || '...' ELSE body END AS text_snippet,
    label, score AS confidence,
    CASE WHEN category <> '' THEN category WHEN kind = 2 THEN 'social_media' ELSE 'umum' END AS topic,
    url
  FROM originals)"""

REGISTRY = """registry AS (
  SELECT 'scam-' || c_custkey AS id,
    CASE WHEN c_custkey % 2 = 0 THEN 'bank_account' ELSE 'phone_number' END AS identifier_type,
    CASE WHEN c_custkey % 11 = 0 THEN '1234' ELSE c_name END AS identifier_value,
    CASE WHEN c_custkey % 13 = 0 THEN '' ELSE c_mktsegment END AS owner_name,
    'nation_' || c_nationkey AS source,
    CAST(c_custkey % 7 - CASE WHEN c_custkey % 17 = 0 THEN 7 ELSE 0 END AS INTEGER) AS report_count,
    CASE c_custkey % 4 WHEN 0 THEN 'active' WHEN 1 THEN 'under_review' WHEN 2 THEN 'resolved' ELSE 'Aktif' END AS status,
    CAST(NULL AS VARCHAR) AS notes,
    '2024-01-01T00:00:' || lpad(CAST(c_custkey % 60 AS VARCHAR), 2, '0') || 'Z' AS created_at,
    '2024-01-01T00:00:00Z' AS updated_at
  FROM customer)"""

CHANGES = f"""changes AS (
  SELECT CASE o_orderkey % 7 WHEN 0 THEN 'create' WHEN 1 THEN 'delete' ELSE 'update' END AS op,
    'scam-' || CASE WHEN o_orderkey % 10 = 0 THEN 'new-' ELSE '' END || o_custkey AS id,
    o_orderkey AS seq, o_orderkey % 3 AS k,
    'bank_account' AS identifier_type, 'acc' || o_orderkey AS identifier_value,
    'own' || o_orderkey AS owner_name, o_orderpriority AS source,
    CAST(o_orderkey % 90 AS INTEGER) AS report_count,
    CASE WHEN o_orderstatus = 'F' THEN 'resolved' ELSE 'under_review' END AS status,
    CASE WHEN o_orderkey % 4 = 0 THEN NULL ELSE 'n' || o_orderkey END AS notes,
    {ISO.format('o_orderdate')} AS changed_at
  FROM orders)"""

STATUS = """CASE WHEN lower(coalesce(status, '')) IN ('aktif', 'active') THEN 'Aktif'
  WHEN lower(coalesce(status, '')) IN ('selesai', 'resolved') THEN 'Selesai' ELSE 'Review' END"""

HASH = "md5(CAST(doc_id AS VARCHAR) || ':42')"

HASH_OR_NOT = "md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':42')"


def ranked(label: str, key: str = "doc_id") -> str:
    return f"""ranked AS (
  SELECT doc_id, final_label, text_md5, rank() OVER (PARTITION BY final_label ORDER BY {HASH_OR_NOT}) AS pos,
    count(*) OVER (PARTITION BY final_label) AS size
  FROM (SELECT {key} AS doc_id, {label} AS final_label, md5(text) AS text_md5 FROM labeled))"""


GAPS = "CASE WHEN doc_id % 10 <> 3 THEN final_label END"


def numbers(key: str, prefix: str, factors) -> str:
    return ", ".join(
        f"({key} * {m} % 1000) / 10.0::DOUBLE AS {prefix}_{n}"
        for n, m in zip(("valid", "hoaks", "penipuan", "netral"), factors)
    )


def best(*columns: str) -> str:
    return f"greatest({', '.join(columns)})"


VERDICT = f"""scored AS (
  SELECT doc_id, text, lang, {has('text', HOAX)} AS hoax, {has('text', FORMAL)} AS formal,
    {numbers('doc_id', 'r', (37, 53, 71, 97))}
  FROM documents),
deep AS (SELECT vec_id AS doc_id, {numbers('vec_id', 'd', (41, 59, 73, 89))} FROM embeddings),
both_scores AS (
  SELECT s.doc_id, text, lang, hoax,
    r_valid + CASE WHEN NOT hoax AND formal THEN 8 ELSE 0 END AS b_valid,
    r_hoaks + CASE WHEN hoax THEN 30 ELSE 0 END AS b_hoaks, r_penipuan AS b_penipuan, r_netral AS b_netral,
    coalesce(d_valid, 0) AS d_valid, coalesce(d_hoaks, 0) AS d_hoaks,
    coalesce(d_penipuan, 0) AS d_penipuan, coalesce(d_netral, 0) AS d_netral
  FROM scored s LEFT JOIN deep USING (doc_id)),
ruled AS (
  SELECT *, CASE WHEN d_penipuan > 55 THEN 1 WHEN hoax AND b_hoaks > 35 THEN 2
      WHEN b_hoaks > 55 THEN 3 ELSE 4 END AS rule,
    greatest(d_valid, b_valid) AS m_valid, greatest(d_hoaks, b_hoaks) AS m_hoaks,
    greatest(d_penipuan, b_penipuan) AS m_penipuan, greatest(d_netral, b_netral) AS m_netral
  FROM both_scores),
fused AS (
  SELECT *,
    CASE WHEN rule = 1 THEN 'Penipuan' WHEN rule < 4 THEN 'Hoaks'
      WHEN m_valid = {best('m_valid', 'm_hoaks', 'm_penipuan', 'm_netral')} THEN 'Valid'
      WHEN m_hoaks = {best('m_valid', 'm_hoaks', 'm_penipuan', 'm_netral')} THEN 'Hoaks'
      WHEN m_penipuan = {best('m_valid', 'm_hoaks', 'm_penipuan', 'm_netral')} THEN 'Penipuan'
      ELSE 'Netral' END AS label,
    least(100, round(CASE rule WHEN 1 THEN d_valid WHEN 2 THEN b_valid * 0.2::DOUBLE WHEN 3 THEN b_valid ELSE m_valid END, 2)) AS s_valid,
    least(100, round(CASE rule WHEN 1 THEN b_hoaks * 0.3::DOUBLE WHEN 4 THEN m_hoaks ELSE b_hoaks END, 2)) AS s_hoaks,
    least(100, round(CASE rule WHEN 1 THEN d_penipuan WHEN 2 THEN b_penipuan * 0.3::DOUBLE WHEN 3 THEN d_penipuan * 0.3::DOUBLE ELSE m_penipuan END, 2)) AS s_penipuan,
    least(100, round(CASE rule WHEN 4 THEN m_netral ELSE b_netral * 0.2::DOUBLE END, 2)) AS s_netral
  FROM ruled),
verdicts AS (
  SELECT *, CASE label WHEN 'Valid' THEN s_valid WHEN 'Hoaks' THEN s_hoaks
      WHEN 'Penipuan' THEN s_penipuan ELSE s_netral END AS score,
    {cases('label', fv.RECOMMENDATIONS, '')} AS recommendation,
    regexp_extract_all(text, '\\b(?:08|628|\\+628)\\d{{8,11}}\\b') AS phones,
    regexp_extract_all(text, '\\b\\d{{10,16}}\\b') AS accounts,
    regexp_extract_all(text, {q(f'(https?://[^{WS}]+|bit\\.ly/[^{WS}]+|wa\\.me/[^{WS}]+|t\\.me/[^{WS}]+)')}) AS links
  FROM fused)"""


def joined(x: str) -> str:
    return f"nullif(array_to_string({x}, '|'), '')"


def terms(clean: str, source: str, id: str) -> str:
    """CTEs ``grams`` (id, term) over cleaned texts."""
    return f"""
  clean_{source} AS (SELECT {id}, list_filter(string_split({clean}, ' '), lambda z: length(z) > 1) AS t FROM {source}),
  grams_{source} AS (
    SELECT {id}, unnest(t) AS term FROM clean_{source}
    UNION ALL
    SELECT {id}, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1])) FROM clean_{source}),
  tf_{source} AS (SELECT {id}, term, count(*) AS tf FROM grams_{source} GROUP BY ALL)"""


def similarity(k: int, threshold: float, text: str = "text") -> str:
    return f"""
  corpus AS (SELECT item_id, 'item ' || item_id || ' ' || text AS text FROM benchmark),
  {terms(clean_similarity('text'), 'corpus', 'item_id')},
  vocab AS (
    SELECT term, ln((1 + (SELECT count(*) FROM corpus)) / (1 + count(*))) + 1 AS idf
    FROM tf_corpus GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 20000),
  c AS (SELECT item_id, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY item_id)) AS w
        FROM tf_corpus JOIN vocab USING (term)),
  {terms(clean_similarity(text), 'documents', 'doc_id')},
  d AS (SELECT doc_id, term, tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY doc_id)) AS w
        FROM tf_documents JOIN vocab USING (term)),
  sims AS (SELECT doc_id, item_id, sum(d.w * c.w) AS sim FROM d JOIN c USING (term) GROUP BY ALL),
  best AS (
    SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY round(sim, 9) DESC, item_id) AS rank
    FROM sims WHERE round(sim, 9) >= {threshold} QUALIFY rank <= {k})"""


PREDICTED = f"""predicted AS (
  SELECT {CODE} AS y, CASE WHEN length(text) < 300 THEN 3 WHEN length(text) < 600 THEN 1 ELSE 0 END AS p
  FROM labeled),
classes AS (
  SELECT label, (SELECT count(*) FROM predicted WHERE y = label AND p = label) AS tp,
    (SELECT count(*) FROM predicted WHERE p = label) AS said,
    (SELECT count(*) FROM predicted WHERE y = label) AS support
  FROM (SELECT y AS label FROM predicted UNION SELECT p FROM predicted)),
pr AS (
  SELECT label, tp, support, CASE WHEN said > 0 THEN tp / said ELSE 0 END AS precision,
    CASE WHEN support > 0 THEN tp / support ELSE 0 END AS recall FROM classes),
measures AS (
  SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0 END AS f1
  FROM pr)"""

CORRECTIONS = f"""corrections AS (
  SELECT doc_id AS row_id, {clean_train('text')} AS text,
    CASE WHEN doc_id % 2 = 0 THEN 1 ELSE 2 END AS label_num FROM labeled)"""

SILVER = f"""raw AS (
  SELECT 0 AS source_rank, conv_id * 1000 + turn AS row_id, text,
    CASE turn % 4 WHEN 1 THEN 'Penipuan' WHEN 0 THEN 'Netral' WHEN 2 THEN 'Netral' END AS final_label, 'sms' AS source
  FROM conversations
  UNION ALL SELECT 1, doc_id, text, CASE WHEN doc_id % 3 = 0 THEN 'Hoaks' ELSE 'Valid' END, 'kaggle'
  FROM documents WHERE doc_id % 5 = 0
  UNION ALL SELECT 2, doc_id, text, 'Netral', 'synthetic' FROM documents WHERE doc_id % 5 = 1
  UNION ALL SELECT 3, item_id, {trim("'item ' || item_id || '. ' || text")}, 'Hoaks', 'komdigi' FROM benchmark
  UNION ALL SELECT 4, doc_id, text, 'Hoaks', 'vijayandika' FROM documents WHERE doc_id % 5 = 2
  UNION ALL SELECT 5, doc_id, text, 'Penipuan', 'ocr' FROM documents WHERE doc_id % 5 > 2),
silver AS (SELECT * FROM raw WHERE text IS NOT NULL AND final_label IS NOT NULL)"""

CHAT = """chat AS (
  SELECT 'ch' || (conv_id % 3) AS channel_name,
    CASE WHEN turn % 3 > 0 THEN turn END AS sender_id,
    CASE WHEN (conv_id + turn) % 5 > 0 THEN text ELSE ' ' || chr(10) END AS message,
    conv_id * 100 + turn + 1700000000 AS sent, conv_id, turn
  FROM conversations)"""




# --- queries ---------------------------------------------------------------------


def build() -> dict[str, str]:
    o: dict[str, str] = {}
    page = lambda x: f"SELECT page_id, {x} AS out FROM pages"

    # text
    o["clean_train"] = page(clean_train("html"))
    o["clean_similarity"] = page(clean_similarity("html"))
    o["clean_serve"] = page(trim(alnum(no_urls("lower(html)"))))
    o["strip_tags"] = page(strip_tags("html"))
    o["html_to_text"] = page(pieces("html", " "))
    body = sub("html", HIDDEN, "<>")
    blocks = f"regexp_extract_all({body}, '(?is)<p(?:\\s[^>]*)?>(.*?)</p\\s*>', 1)"
    o["article_text"] = f"""
      WITH p AS (SELECT page_id, html, array_to_string(list_transform({blocks}, lambda b: {pieces('b', '')}), ' ') AS t FROM pages)
      SELECT page_id, {trim(f"substring(CASE WHEN t <> '' THEN t ELSE {pieces('html', ' ')} END, 1, 5000)")} AS out FROM p"""
    o["container_text"] = page(pieces(
        """regexp_extract(html, '(?is)<div\\b[^>]*class="[^"]*\\bad\\b[^"]*"[^>]*>(.*?)</div\\s*>', 1)""", " "))
    o["scam_entities"] = f"""
      WITH t AS (SELECT 'd' || doc_id AS id, text FROM documents UNION ALL
        SELECT 'p' || page_id, url || ' 0812' || lpad(CAST(page_id AS VARCHAR), 8, '3') || ' wa.me/' || page_id FROM pages)
      SELECT id, {joined("regexp_extract_all(text, '\\b(?:08|628|\\+628)\\d{8,11}\\b')")} AS nomor_hp,
        {joined("regexp_extract_all(text, '\\b\\d{10,16}\\b')")} AS rekening,
        {joined(f"regexp_extract_all(text, 'https?://[^{WS}]+|bit\\.ly/[^{WS}]+|wa\\.me/[^{WS}]+|t\\.me/[^{WS}]+')")} AS links
      FROM t"""
    o["keyword_any"] = f"SELECT doc_id, {has('text', HOAX)} AS hoax, {has('text', FORMAL)} AS formal FROM documents"
    words = "['the', 'tion', 'der', 'with', 'oui', 'sch']"
    o["indicator_rule"] = f"""
      WITH h AS (SELECT doc_id, list_filter({words}, lambda w: contains(lower(text), w)) AS hits FROM documents)
      SELECT doc_id, array_to_string(hits, '|') AS indicators,
        CASE WHEN len(hits) >= 3 THEN 'Scam' ELSE 'Review' END AS classification,
        CASE WHEN len(hits) >= 3 THEN 96.4 ELSE 61.5 END::DOUBLE AS confidence,
        CASE WHEN len(hits) >= 3 THEN {q(fv.INDICATOR_ADVICE['Scam'])} ELSE {q(fv.INDICATOR_ADVICE['Review'])} END AS recommendation
      FROM h"""
    o["is_url"] = f"""
      SELECT page_id, regexp_matches({trim("CASE WHEN page_id % 2 = 0 THEN ' ' || url || chr(10) ELSE url || ' x' END")},
        '^https?://[^{WS}]+$') AS is_url FROM pages"""
    o["ellipsis"] = """
      SELECT doc_id, CASE WHEN length(text) > 150 THEN substring(text, 1, 147) || '...' ELSE text END AS short,
        CASE WHEN length(text) > 300 THEN substring(text, 1, 300) || '...' ELSE text END AS preview,
        substring(text, 1, 500) AS cut FROM documents"""
    o["join_title"] = f"""
      WITH t AS (SELECT doc_id, text, lang, CASE WHEN doc_id % 3 > 0 THEN substring(text, 1, 40) ELSE '' END AS title FROM documents)
      SELECT doc_id, {trim("title || '. ' || text")} AS dotted, {trim("title || ' ' || text")} AS plain,
        upper(lang[1]) || lower(lang[2:]) AS lang_name FROM t"""
    o["recover_json"] = """
      SELECT doc_id, CASE WHEN doc_id % 4 < 3 THEN upper(lang) END AS kategori,
        CASE WHEN doc_id % 4 < 3 THEN 't ' || doc_id END AS text FROM documents"""
    o["hour_label"] = f"""WITH {FEED}
      SELECT id, CASE WHEN substring(timestamp, 12, 2) = '' THEN '00' ELSE substring(timestamp, 12, 2) END AS hour FROM feed"""
    o["parse_time"] = """
      SELECT event_id, CASE event_id % 4 WHEN 0 THEN floor(epoch(ts))::BIGINT - 7 * 3600 WHEN 3 THEN NULL
        ELSE floor(epoch(ts))::BIGINT END AS epoch FROM events"""
    o["iso_format"] = "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') AS iso FROM events"
    spelled = cases("event_type", {"error": " Penipuan ", "click": "Hoax", "view": "VALID", "purchase": "netral\t"}, "other")
    o["label_codes"] = f"""
      WITH s AS (SELECT event_id, {trim(spelled)} AS s FROM events),
      n AS (SELECT *, CASE s WHEN 'Hoax' THEN 'Hoaks' ELSE s END AS normal,
        CASE lower(s) WHEN 'hoax' THEN 1 WHEN 'hoaks' THEN 1 WHEN 'penipuan' THEN 2 WHEN 'netral' THEN 3 ELSE 0 END AS code FROM s)
      SELECT event_id, code,
        CASE s WHEN 'Valid' THEN 0 WHEN 'Hoaks' THEN 1 WHEN 'Hoax' THEN 1 WHEN 'Penipuan' THEN 2 WHEN 'Netral' THEN 3 END AS feedback_code,
        normal, normal IN ('Valid', 'Hoaks', 'Penipuan', 'Netral') AS known, normal IN ('Hoaks', 'Penipuan') AS risk,
        ['Valid', 'Hoaks', 'Penipuan', 'Netral'][code + 1] AS name FROM n"""
    o["source_labels"] = """
      SELECT doc_id, CASE quality + toxic * 2 WHEN 0 THEN 'Netral' WHEN 1 THEN 'Penipuan' WHEN 2 THEN 'Netral' END AS sms,
        CASE WHEN quality = 1 THEN 'Hoaks' ELSE 'Valid' END AS flag FROM labels"""
    o["percent_clamp"] = """
      SELECT event_id, round((event_id % 7) / greatest(event_id % 11, 1) * 100, 2) AS pct, least(value, 100.0) AS clamped FROM events"""

    # messages and feed
    o["select_text"] = f"WITH {MESSAGES} SELECT event_id, text, problem FROM cleaned"
    o["dead_letters"] = f"""WITH {MESSAGES}
      SELECT topic, value, coalesce(problem, 'blank text') AS reason FROM cleaned WHERE problem IS NOT NULL OR text = ''"""
    o["envelope"] = """
      SELECT doc_id, '{"doc_id":' || doc_id || ',"lang":"' || lang || '"}' AS original_data, 'rss-news' AS source_topic,
        (doc_id % 100)::DOUBLE AS score, CASE WHEN doc_id % 2 = 0 THEN 'Hoaks' ELSE 'Valid' END AS label,
        '' AS reason, '' AS category, '' AS sentiment, false AS is_sensational, false AS ai_generated_flag,
        0 AS processing_time_ms, '' AS recommendation FROM documents"""
    o["feed_flatten"] = f"WITH {ENVELOPES} SELECT * FROM flat"
    o["insert_ignore"] = f"""WITH {ENVELOPES}
      SELECT event_id, id FROM flat WHERE id NOT IN (SELECT id FROM flat WHERE event_id % 9 = 0)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY event_id) = 1"""
    display = f"""WITH {FEED}, shown AS (
      SELECT id, CASE WHEN timestamp = '' THEN '-' ELSE substring(timestamp, 12, 8) END AS time,
        CASE WHEN source = '' THEN source_type ELSE source END AS source, text_snippet AS snippet,
        CASE WHEN label IN ('Valid', 'Hoaks', 'Penipuan', 'Netral') THEN label ELSE 'Review' END AS status,
        round(confidence)::INTEGER AS confidence, url FROM feed)"""
    o["feed_display"] = f"{display} SELECT * FROM shown"
    o["latest_feed"] = f"WITH {FEED} SELECT * FROM feed ORDER BY timestamp DESC, id LIMIT 25"
    o["feed_search"] = f"""{display} SELECT id, source, snippet FROM shown
      WHERE contains(lower(concat_ws(' ', time, source, snippet, status, confidence)), 'user_1 click')"""
    o["dimension_search"] = """
      SELECT c_custkey, n_name FROM customer JOIN nation ON c_nationkey = n_nationkey
      WHERE contains(lower(c_mktsegment || ' ' || n_name), 'building nation_1')"""
    o["alerts"] = f"""WITH {FEED} SELECT id, label, confidence FROM feed
      WHERE label IN ('Hoaks', 'Penipuan') AND confidence >= 15"""
    o["purge"] = f"WITH {FEED} SELECT id, source_type FROM feed WHERE source_type <> 'RSS'"
    o["purge_table"] = f"""WITH {FEED} SELECT id, source_type, text_snippet, (SELECT count(*) FROM feed WHERE source_type = 'RSS') AS n_deleted
      FROM feed WHERE source_type <> 'RSS'"""
    o["reclean_stored"] = f"""WITH {FEED} SELECT id, CASE WHEN source_type = 'RSS' THEN text_snippet || ' & x' ELSE text_snippet END AS text_snippet,
        (SELECT count(*) FROM feed WHERE source_type = 'RSS') AS n_changed FROM feed"""
    o["html_references"] = f"""SELECT page_id, 'Café ’…&lt; &nosuch; –©' || CASE WHEN text <> '' THEN ' ' || text ELSE '' END AS out
      FROM (SELECT page_id, {pieces('html', ' ')} AS text FROM pages)"""
    o["length_shifted"] = """
      SELECT count(text) AS count, round(1000000000 + avg(length(text)), 4) AS mean, round(stddev_samp(length(text)), 4) AS std,
        1000000000 + min(length(text))::DOUBLE AS min, 1000000000 + quantile_cont(length(text), 0.25) AS p25,
        1000000000 + quantile_cont(length(text), 0.5) AS p50, 1000000000 + quantile_cont(length(text), 0.75) AS p75,
        1000000000 + max(length(text))::DOUBLE AS max FROM documents"""
    o["first_existing"] = "SELECT item_id, md5(text) AS text_md5 FROM benchmark"
    o["reclean"] = f"""
      WITH r AS (SELECT page_id, CASE WHEN page_id % 3 = 0 THEN url ELSE html END AS old FROM pages),
      n AS (SELECT page_id, old, CASE WHEN contains(old, '<') AND contains(old, '>') THEN {pieces('old', ' ')} ELSE old END AS new FROM r)
      SELECT page_id, new AS text_snippet, new <> old AS changed FROM n"""
    o["reclean_count"] = f"SELECT count_if(contains(html, '<') AND contains(html, '>') AND {pieces('html', ' ')} <> html)::BIGINT AS n_changed FROM pages"

    # dashboard
    o["total_rows"] = "SELECT count(*) AS total FROM events"
    o["label_counts"] = f"""WITH {FEED}
      SELECT l.label, count(feed.id) AS n FROM (SELECT unnest(['Valid', 'Hoaks', 'Penipuan', 'Netral']) AS label) l
      LEFT JOIN feed ON feed.label = l.label GROUP BY l.label"""
    known = "label IN ('Valid', 'Hoaks', 'Penipuan', 'Netral')"
    share = lambda k: f"round(count_if(label = '{k}') / greatest(count_if({known}), 1) * 100, 2)"
    o["label_share"] = f"WITH {FEED} SELECT {share('Valid')} AS valid, {share('Hoaks')} AS hoaks, {share('Penipuan')} AS scam FROM feed"
    o["log_stats"] = f"""WITH {FEED}, log AS (SELECT CASE WHEN topic <> '7' THEN label ELSE 'Valid' END AS label FROM feed)
      SELECT count(*) AS total_predictions, {', '.join(f"count_if(label = '{k}')::BIGINT AS {k}" for k in fv.LABELS)} FROM log"""
    o["active_sources"] = f"WITH {FEED} SELECT count(DISTINCT source) AS active_sources FROM feed"
    hour = "CASE WHEN substring(timestamp, 12, 2) = '' THEN '00' ELSE substring(timestamp, 12, 2) END"
    hourly = f"WITH {FEED}, hourly AS (SELECT {hour} AS label, count(*) AS value FROM feed GROUP BY 1)"
    o["hourly_volume"] = f"{hourly} SELECT * FROM hourly"
    risk = f"""WITH {FEED}, risk AS (
      SELECT CASE WHEN source = '' THEN 'Unknown' ELSE source END AS label, count(*) AS value FROM feed
      WHERE label IN ('Hoaks', 'Penipuan') GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 6)"""
    risk = risk.replace("FROM feed\n      WHERE label IN", "FROM feed\n      WHERE feed.label IN")
    o["risk_sources"] = f"{risk} SELECT * FROM risk"
    o["risk_share"] = f"{risk} SELECT label, value, round(value / sum(value) OVER () * 100)::INTEGER AS percent FROM risk"
    o["bar_heights"] = f"{hourly} SELECT label, value, round(value / max(value) OVER () * 100, 2) AS height FROM hourly"
    o["stats_snapshot"] = f"""{risk}, hourly AS (SELECT {hour} AS label, count(*) AS value FROM feed GROUP BY 1)
      SELECT count(*) AS total_messages_today, count_if(label = 'Hoaks')::BIGINT AS hoax_detected_today,
        count_if(label = 'Penipuan')::BIGINT AS scam_detected_today, count_if(label = 'Valid')::BIGINT AS valid_detected_today,
        {share('Valid')} AS valid, {share('Hoaks')} AS hoaks, {share('Penipuan')} AS scam,
        count(DISTINCT source) AS active_sources, 'now' AS last_updated,
        (SELECT string_agg(label || '=' || value, '|' ORDER BY label) FROM hourly) AS hourly_volume,
        (SELECT string_agg(label || '=' || value, '|' ORDER BY value DESC, label) FROM risk) AS risk_scatter
      FROM feed"""

    # looking at data
    o["value_counts"] = "SELECT lang, count(*) AS n FROM documents WHERE lang IS NOT NULL GROUP BY lang"
    o["value_shares"] = "SELECT source, round(count(*) / sum(count(*)) OVER (), 9) AS share FROM documents GROUP BY source"
    o["length_describe"] = """
      SELECT count(text) AS count, round(avg(length(text)), 4) AS mean, round(stddev_samp(length(text)), 4) AS std,
        min(length(text))::DOUBLE AS min, quantile_cont(length(text), 0.25) AS p25, quantile_cont(length(text), 0.5) AS p50,
        quantile_cont(length(text), 0.75) AS p75, max(length(text))::DOUBLE AS max FROM documents"""
    o["class_samples"] = f"""WITH {LABELED}
      SELECT final_label, doc_id, substring(text, 1, 200) AS sample FROM labeled
      QUALIFY row_number() OVER (PARTITION BY final_label ORDER BY doc_id) <= 2"""

    # lake
    o["silver_union"] = f"WITH {SILVER} SELECT row_id, final_label, source, md5(text) AS text_md5 FROM silver"
    o["silver_build"] = f"""WITH {SILVER}, firsts AS (
        SELECT * FROM silver QUALIFY row_number() OVER (PARTITION BY text ORDER BY source_rank, row_id) = 1)
      SELECT final_label, source, md5(text) AS text_md5 FROM firsts WHERE length(text) > 30"""
    o["dedup_keep_first"] = "SELECT doc_id, source FROM documents QUALIFY row_number() OVER (PARTITION BY text ORDER BY doc_id) = 1"
    o["min_length"] = "SELECT doc_id FROM documents WHERE length(text) > 400"
    o["drop_null"] = "SELECT doc_id, quality FROM documents JOIN labels USING (doc_id) WHERE quality IS NOT NULL AND text IS NOT NULL"
    n = fv.GOLD_PER_CLASS
    o["gold_balanced"] = f"""WITH {LABELED}, {ranked(GAPS)},
      sizes AS (SELECT DISTINCT final_label, size FROM ranked WHERE size < {n} AND final_label IS NOT NULL),
      draws AS (SELECT final_label, 1 + ('0x' || substring(md5(final_label || ':' || i || ':42'), 1, 12))::BIGINT % size AS pos
                FROM sizes, range({n}) r(i))
      SELECT doc_id, final_label, text_md5 FROM ranked WHERE size >= {n} AND pos <= {n} AND final_label IS NOT NULL
      UNION ALL SELECT doc_id, final_label, text_md5 FROM draws JOIN ranked USING (final_label, pos)"""
    o["stratified_split"] = f"""WITH {LABELED}, {ranked(GAPS, "CASE WHEN doc_id % 10 <> 4 THEN doc_id END")}
      SELECT doc_id, final_label, text_md5, CASE WHEN pos <= ceil(0.2 * size) THEN 'test' ELSE 'train' END AS part FROM ranked"""
    o["three_way_split"] = f"""WITH {LABELED}, {ranked(GAPS)}
      SELECT doc_id, final_label, text_md5, CASE WHEN pos <= ceil(0.15 * size) THEN 'test' WHEN pos <= ceil(0.30 * size) THEN 'val'
        ELSE 'train' END AS part FROM ranked"""
    o["shuffled"] = f"SELECT doc_id, source FROM documents ORDER BY {HASH}, doc_id"
    o["class_weights"] = f"""WITH {LABELED}, n AS (SELECT {CODE} AS label_num, count(*) AS n FROM labeled GROUP BY 1)
      SELECT label_num, n, round(sum(n) OVER () / (count(*) OVER () * n), 9) AS weight FROM n"""
    o["assert_classes"] = f"WITH {LABELED} SELECT count(DISTINCT final_label) AS n_classes FROM labeled"
    o["unprocessed"] = "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)"
    o["run_summary"] = """
      WITH d AS (SELECT doc_id, CASE lang WHEN 'en' THEN 'Penipuan' WHEN 'fr' THEN 'ERROR' ELSE 'VALID' END AS kategori,
        doc_id IN (SELECT doc_id FROM labels) AS done FROM documents)
      SELECT count(*) AS n_total, count_if(NOT done AND kategori <> 'ERROR')::BIGINT AS n_ok, count_if(done)::BIGINT AS n_skipped,
        count_if(upper(kategori) = 'PENIPUAN')::BIGINT AS n_category FROM d"""
    o["train_prepare"] = f"WITH {LABELED} SELECT md5({clean_train('text')}) AS text_md5, {CODE} AS label_num FROM labeled"

    # verdict
    o["heuristic_boost"] = f"""WITH {VERDICT}
      SELECT doc_id, {', '.join(f'round(b_{n}, 2) AS b_{n}' for n in ('valid', 'hoaks', 'penipuan', 'netral'))} FROM both_scores"""
    o["hybrid_fusion"] = f"WITH {VERDICT} SELECT doc_id, label, score, s_valid, s_hoaks, s_penipuan, s_netral FROM verdicts"
    o["verdict_record"] = f"""WITH {VERDICT}
      SELECT doc_id, label, score, recommendation, d_valid AS deep_valid, d_hoaks AS deep_hoaks, d_penipuan AS deep_penipuan,
        d_netral AS deep_netral, round(b_hoaks, 2) AS base_hoaks, {joined('accounts')} AS rekening FROM verdicts"""
    emoji = cases("label", fv.LABEL_EMOJI, fv.UNKNOWN_EMOJI)
    line = lambda title, x: f"CASE WHEN len({x}) > 0 THEN '  {title}: ' || array_to_string({x}, ', ') || chr(10) ELSE '' END"
    o["render_verdict"] = f"""WITH {VERDICT}
      SELECT doc_id, {emoji} || ' HASIL DETEKSI: ' || upper(label) || chr(10) || 'Skor keyakinan: ' || score || '%' || chr(10) || chr(10)
        || 'Rincian skor tiap kelas:' || chr(10) || '  - Valid: ' || s_valid || '%' || chr(10) || '  - Hoaks: ' || s_hoaks || '%' || chr(10)
        || '  - Penipuan: ' || s_penipuan || '%' || chr(10) || '  - Netral: ' || s_netral || '%' || chr(10)
        || CASE WHEN len(phones) + len(accounts) + len(links) > 0 THEN chr(10) || 'Entitas mencurigakan terdeteksi:' || chr(10) ELSE '' END
        || {line('Nomor HP', 'phones')} || {line('Nomor Rekening', 'accounts')} || {line('Link', 'links')}
        || chr(10) || 'Alasan / Rekomendasi:' || chr(10) || recommendation AS rendered
      FROM verdicts"""
    shot = VERDICT.replace("FROM documents)", "FROM shots)", 1)
    kind = "CASE doc_id % 4 WHEN 0 THEN 'Penipuan' WHEN 1 THEN 'Hoax' ELSE 'Valid' END"
    o["screenshot_verdict"] = f"""
      WITH shots AS (SELECT doc_id, lang, 'hubungi 081299998888 ' || text AS text FROM documents WHERE doc_id % 10 <> 9), {shot},
      final AS (SELECT *, {kind} AS ocr_label, CASE WHEN doc_id % 4 = 0 THEN 'Penipuan' ELSE label END AS f FROM verdicts),
      named AS (SELECT doc_id, f AS label, ocr_label, label AS hybrid_label, text,
        CASE f WHEN 'Valid' THEN s_valid WHEN 'Hoaks' THEN s_hoaks WHEN 'Penipuan' THEN s_penipuan ELSE s_netral END AS score,
        {cases('f', fv.RECOMMENDATIONS, '')} AS recommendation,
        CASE WHEN doc_id % 3 = 0 THEN '0811' ELSE '081299998888' END AS nomor_hp,
        CASE WHEN doc_id % 2 = 0 THEN 'sebab' ELSE '' END AS ocr_reason FROM final)
      SELECT * EXCLUDE (text), {emoji} || ' HASIL DETEKSI SCREENSHOT: ' || upper(label) || chr(10) || 'Skor keyakinan: ' || score || '%'
        || chr(10) || chr(10) || 'Teks terbaca dari gambar (OCR):' || chr(10) || '"'
        || CASE WHEN length({trim('text')}) > 300 THEN substring({trim('text')}, 1, 300) || '...' ELSE {trim('text')} END || '"' || chr(10) || chr(10)
        || CASE WHEN ocr_reason <> '' THEN 'Alasan deteksi (Gemini OCR):' || chr(10) || ocr_reason || chr(10) || chr(10) ELSE '' END
        || 'Rekomendasi:' || chr(10) || recommendation AS rendered
      FROM named"""

    # features and similarity
    doc_terms = terms(clean_train("text"), "documents", "doc_id")
    o["idf_table"] = f"""WITH {doc_terms}
      SELECT term, sum(tf)::BIGINT AS total, count(*) AS df,
        round(ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1, 9) AS idf FROM tf_documents GROUP BY term"""
    o["vocabulary"] = f"""WITH {doc_terms}
      SELECT term, sum(tf)::BIGINT AS total, count(*) AS df FROM tf_documents GROUP BY term ORDER BY total DESC, term LIMIT 10000"""
    o["tfidf_long"] = f"""WITH {doc_terms}, vocab AS (
        SELECT term, ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf
        FROM tf_documents GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 10000)
      SELECT doc_id, term, round(tf * idf / sqrt(sum((tf * idf) ** 2) OVER (PARTITION BY doc_id)), 9) AS weight
      FROM tf_documents JOIN vocab USING (term)"""
    o["similarity_topk"] = f"""WITH {similarity(3, 0.3)}
      SELECT doc_id AS query_id, rank, item_id AS article_id, 'item ' || item_id AS title, '' AS url, '' AS category,
        round(sim, 4) AS similarity FROM best"""
    o["similarity_saved"] = o["similarity_topk"]
    o["similarity_reason"] = f"""WITH {similarity(1, 0.5)}
      SELECT documents.doc_id, CASE WHEN sim IS NULL THEN {q(fv.REASON_NONE)} ELSE
        'Mirip dengan hoaks terverifikasi Komdigi (' || round(round(sim, 4) * 100, 1) || '%): "item ' || item_id || '"' END AS reason
      FROM documents LEFT JOIN best ON best.doc_id = documents.doc_id"""

    # evaluation and feedback
    w = lambda c: f"sum({c} * support) / sum(support)"
    o["eval_summary"] = f"""WITH {LABELED}, {PREDICTED}
      SELECT round(sum(tp) / sum(support), 9) AS accuracy, round({w('f1')}, 9) AS f1_weighted FROM measures"""
    r = lambda f: ", ".join(f"round({f(c)}, 9) AS {c}" for c in ("precision", "recall", "f1"))
    o["eval_report"] = f"""WITH {LABELED}, {PREDICTED}
      SELECT CAST(label AS VARCHAR) AS label, {r(lambda c: c)}, support FROM measures
      UNION ALL SELECT 'macro avg', {r(lambda c: f'avg({c})')}, sum(support)::BIGINT FROM measures
      UNION ALL SELECT 'weighted avg', {r(w)}, sum(support)::BIGINT FROM measures"""
    o["confusion"] = f"""WITH {LABELED}, {PREDICTED}
      SELECT y AS label, {', '.join(f'count_if(p = {k})::BIGINT AS p{k}' for k in range(4))} FROM predicted GROUP BY y"""
    o["feedback_codes"] = f"""
      SELECT event_id, {clean_train("'Teks <b>' || props || '</b>'")} AS text,
        CASE event_type WHEN 'error' THEN 2 WHEN 'click' THEN 1 ELSE 3 END AS label_num
      FROM events WHERE event_type IN ('error', 'click', 'purchase')"""
    o["feedback_training_set"] = f"""WITH {LABELED}, {CORRECTIONS}, parts AS (
        SELECT 0 AS part, doc_id AS row_id, {clean_train('text')} AS text, {CODE} AS label_num FROM labeled WHERE doc_id % 3 = 0
        UNION ALL SELECT 1, row_id, text, label_num FROM corrections)
      SELECT md5(text) AS text_md5, label_num FROM parts
      QUALIFY row_number() OVER (PARTITION BY text ORDER BY part, row_id) = 1"""
    o["feedback_pool"] = f"""WITH {LABELED}, {CORRECTIONS}
      SELECT md5(text) AS text_md5, label_num FROM corrections
      QUALIFY row_number() OVER (PARTITION BY text ORDER BY CASE WHEN row_id % 4 = 1 THEN 0 ELSE 1 END, row_id) = 1"""

    o["feedback_retrain"] = f"""WITH {LABELED}, {CORRECTIONS}
      SELECT md5(text) AS text_md5, min(label_num) AS label_num, row_id % 2 + 1 AS run, (SELECT count(*) FROM labeled) AS n_archived FROM corrections
      GROUP BY text, row_id % 2 QUALIFY row_number() OVER (PARTITION BY text ORDER BY row_id % 2) = 1"""
    o["feedback_trigger"] = f"""WITH {LABELED}, {CORRECTIONS}, n AS (SELECT row_id % 3 AS k, count(*) AS n FROM corrections GROUP BY 1),
      a AS (SELECT coalesce(max(n) FILTER (k = 0), 0) AS a, coalesce(max(n) FILTER (k = 1), 0) AS b, coalesce(max(n) FILTER (k = 2), 0) AS c FROM n),
      t AS (SELECT *, a >= 100 AS t1, b + CASE WHEN a >= 100 THEN 0 ELSE a END >= 100 AS t2 FROM a)
      SELECT md5(text) AS text_md5, label_num, (SELECT t1::BIGINT + t2::BIGINT
        + (c + CASE WHEN t2 THEN 0 WHEN t1 THEN b ELSE a + b END >= 100)::BIGINT FROM t) AS n_trainings FROM corrections"""

    # registry
    fields = ["identifier_type", "identifier_value", "owner_name", "source", "report_count", "status", "notes"]
    sets = {"status": "k = 0", "report_count": "k = 0", "notes": "k > 0", "owner_name": "k = 2"}

    def last(c: str) -> str:
        value = c
        if c == "report_count":
            value = "CASE WHEN op = 'create' AND k <> 0 THEN 1 ELSE report_count END"
        if c == "status":
            value = "CASE WHEN op = 'create' AND k <> 0 THEN 'active' ELSE status END"
        when = f"op = 'create' OR (op = 'update' AND {sets.get(c, 'false')})"
        return f"arg_max({{'v': {value}}}, seq) FILTER (WHERE {when}) AS n_{c}"

    pick = lambda c, n: f"CASE WHEN {n} IS NOT NULL THEN {n}.v ELSE r.{c} END AS {c}"
    o["registry_apply"] = f"""WITH {REGISTRY}, {CHANGES}, folded AS (
        SELECT id, arg_max(op, seq) FILTER (WHERE op <> 'update') AS life,
          arg_max({{'v': changed_at}}, seq) FILTER (WHERE op = 'create') AS n_created_at,
          arg_max({{'v': changed_at}}, seq) FILTER (WHERE op <> 'delete') AS n_updated_at, {', '.join(last(c) for c in fields)}
        FROM changes GROUP BY id)
      SELECT coalesce(r.id, f.id) AS id, {', '.join(pick(c, 'f.n_' + c) for c in [*fields, 'created_at', 'updated_at'])}
      FROM registry r FULL JOIN folded f ON r.id = f.id
      WHERE coalesce(life, CASE WHEN r.id IS NULL THEN 'delete' ELSE 'create' END) = 'create'"""
    o["registry_rejected"] = f"""WITH {REGISTRY}, {CHANGES}, state AS (
        SELECT *, last_value(CASE WHEN op <> 'update' THEN op END IGNORE NULLS) OVER (
            PARTITION BY id ORDER BY seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM changes)
      SELECT id, seq, op, 'Scam record ''' || id || ''' not found.' AS error FROM state
      WHERE op <> 'create' AND coalesce(before = 'create', id IN (SELECT id FROM registry)) = false"""
    o["registry_lookup"] = f"""WITH {REGISTRY}, {CHANGES}
      SELECT c.id, identifier_value, CASE WHEN r.id IS NULL THEN 'Scam record ''' || c.id || ''' not found.' END AS error
      FROM (SELECT DISTINCT id FROM changes) c LEFT JOIN registry r ON c.id = r.id"""
    o["registry_kpis"] = f"""WITH {REGISTRY}
      SELECT count_if({STATUS} = 'Aktif')::BIGINT AS n_active, sum(report_count)::BIGINT AS n_reports,
        count_if({STATUS} = 'Review')::BIGINT AS n_review FROM registry"""
    o["registry_display"] = f"""WITH {REGISTRY}
      SELECT id, CASE WHEN identifier_type = 'phone_number' THEN 'Nomor Telepon' ELSE 'Nomor Rekening' END AS type,
        identifier_value AS value, CASE WHEN owner_name = '' THEN 'Tidak diketahui' ELSE owner_name END AS owner, source,
        report_count AS reports, {STATUS} AS status, substring(updated_at, 12, 5) AS updated_at FROM registry"""
    o["registry_list"] = f"WITH {REGISTRY} SELECT id, created_at FROM registry ORDER BY created_at DESC, id"
    o["registry_ids"] = "SELECT c_custkey, 'scam-' || sha256('bank_account' || chr(31) || c_name) AS id FROM customer"
    reasons = f"""WITH {REGISTRY}, checked AS (SELECT id, concat_ws('|',
        CASE WHEN length(identifier_value) < 5 OR length(identifier_value) > 64 THEN 'identifier_value' END,
        CASE WHEN length(owner_name) < 2 OR length(owner_name) > 120 THEN 'owner_name' END,
        CASE WHEN report_count < 0 THEN 'report_count' END,
        CASE WHEN status NOT IN ('active', 'under_review', 'resolved') THEN 'status' END) AS reasons FROM registry)"""
    o["registry_validate"] = f"{reasons} SELECT id, reasons FROM checked WHERE reasons <> ''"
    o["registry_valid"] = f"{reasons} SELECT id FROM checked WHERE reasons = ''"
    o["feed_validate"] = f"""WITH {FEED}
      SELECT id, CASE WHEN confidence * 8 > 100 OR confidence < 0 THEN 'confidence' ELSE '' END AS reasons FROM feed"""

    # ingestion
    title = "regexp_extract(html, '<title>(.*?)</title>', 1)"
    o["normalize_rss"] = f"""
      SELECT 'Detik News' AS source, 'news' AS category, {title} AS title, url AS link, {pieces('html', ' ')} AS description,
        'Mon, 29 Jun 2026 10:00:00 +0700' AS published_at, 'now' AS ingested_at FROM pages WHERE page_id % 8 > 0"""
    o["normalize_chat"] = f"""WITH {CHAT}
      SELECT channel_name, coalesce(CAST(sender_id AS VARCHAR), 'unknown') AS sender_id, message,
        strftime(make_timestamp(sent * 1000000), '%Y-%m-%dT%H:%M:%SZ') AS sent_at, 'now' AS ingested_at
      FROM chat WHERE {trim('message')} <> ''"""
    o["backfill"] = f"""WITH {CHAT}, newest AS (SELECT * FROM chat
        QUALIFY row_number() OVER (PARTITION BY channel_name ORDER BY sent DESC, conv_id, turn) <= 100)
      SELECT channel_name, conv_id, turn FROM newest WHERE {trim('message')} <> ''"""
    o["normalize_post"] = """
      SELECT 'tw_' || event_id AS tweet_id, event_type AS text, user_id::INTEGER AS account_age_days, event_id::INTEGER AS likes,
        NULL::INTEGER AS replies, 'bit.ly/' || event_id || '|x' AS links, NULL::VARCHAR AS scam_type FROM events"""
    first = lambda tag, x: f"regexp_extract({x}, '(?is)<{tag}\\b[^>]*>(.*?)</{tag}\\s*>', 1)"
    o["listing_articles"] = f"""
      WITH a AS (SELECT page_id, unnest(regexp_extract_all({body}, '(?is)<article\\b[^>]*>(.*?)</article\\s*>', 1)) AS post FROM pages),
      h AS (SELECT *, CASE WHEN regexp_matches(post, '(?is)<h2\\b[^>]*>.*?</h2\\s*>') THEN {first('h2', 'post')} ELSE {first('h1', 'post')} END AS head FROM a)
      SELECT page_id, {pieces('head', '')} AS title, {decode("regexp_extract(head, '(?is)<a\\b[^>]*?\\bhref=[\"'']([^\"'']*)[\"'']', 1)")} AS link,
        regexp_extract(post, '(?is)<time\\b[^>]*?\\bdatetime=["'']([^"'']*)["'']', 1) AS date, {pieces(first('p', 'post'), '')} AS excerpt,
        'hoax' AS label, 'turnbackhoax.id' AS source, 'now' AS scraped_at
      FROM h WHERE {pieces('head', '')} <> ''"""
    o["hoax_articles"] = f"""
      SELECT 'd' || doc_id AS title, md5(CASE WHEN doc_id % 2 = 0 THEN text ELSE {trim("regexp_replace(text, '[<>&]', '', 'g')")} END) AS body_md5,
        CASE WHEN doc_id % 3 = 0 THEN 'hoaks kesehatan' ELSE 'Klarifikasi Hoaks' END AS category, '' AS url, 'Hoaks' AS label,
        'komdigi.go.id' AS source FROM documents"""
    o["article_load"] = """
      WITH t AS (SELECT doc_id, text, string_split(text, chr(10))[1] AS title FROM documents),
      f AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY title ORDER BY doc_id) = 1)
      SELECT doc_id, title FROM f WHERE length(text) > 50"""
    o["feed_dimension"] = """
      WITH d AS (SELECT doc_id, CASE source WHEN 'src1' THEN 'Detik News' WHEN 'src2' THEN 'Turnbackhoax' WHEN 'src3' THEN 'Antara Tekno'
          ELSE 'blog' END AS source FROM documents)
      SELECT doc_id, source, CASE source WHEN 'Detik News' THEN 'https://www.detik.com/news/rss' WHEN 'Turnbackhoax' THEN 'https://turnbackhoax.id/feed'
          WHEN 'Antara Tekno' THEN 'https://www.antaranews.com/rss/tekno.xml' END AS url,
        CASE source WHEN 'Detik News' THEN 'news' WHEN 'Turnbackhoax' THEN 'fact-check' WHEN 'Antara Tekno' THEN 'cyber-security' END AS category
      FROM d"""
    o["feed_dimension_table"] = """
      SELECT doc_id, source, n_name AS category FROM documents LEFT JOIN nation ON source = 'src' || n_nationkey"""
    o["unsent_links"] = """
      SELECT page_id, url AS link FROM pages WHERE page_id % 8 > 0
        AND url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0 AND page_id % 8 > 0)"""
    o["ocr_rows"] = f"""
      SELECT md5({trim('text')}) AS text_md5, 'Penipuan' AS final_label, 'ocr_screenshot' AS source FROM documents
      WHERE doc_id % 5 <> 0 AND lang = 'en' AND {trim('text')} <> ''"""
    o["topic_summary"] = f"""WITH {MESSAGES}
      SELECT count(*) AS n_messages, (SELECT value FROM messages ORDER BY event_id % 3 DESC, event_id DESC LIMIT 1) AS last_value FROM messages"""
    o["manifest"] = "SELECT 'now' AS downloaded_at, count(*) AS total_articles, 'documents' AS source, 'Hoaks' AS label FROM documents"

    # files
    o["csv_scan"] = "SELECT doc_id, lang, length(text) AS n FROM documents"
    o["glob_union"] = """
      SELECT CAST(doc_id AS VARCHAR) AS doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS lang,
        CASE WHEN doc_id % 2 = 1 THEN source END AS origin, 'file_part-' AS source FROM documents"""
    o["json_array_scan"] = "SELECT CAST(doc_id AS VARCHAR) AS filename, 'PENIPUAN' AS kategori, lang AS text FROM documents"
    o["jsonl_scan"] = f"""WITH {MESSAGES}
      SELECT json_extract_string(value, '$.message') AS message, json_extract_string(value, '$.title') AS title,
        json_extract_string(value, '$.text') AS text FROM messages WHERE event_id % 10 <> 9 AND json_valid(value)"""
    o["jsonl_bad_lines"] = f"WITH {MESSAGES} SELECT value FROM messages WHERE NOT json_valid(value)"
    o["rss_scan"] = """
      SELECT url AS link, 'page ' || page_id AS title, CASE WHEN page_id % 2 = 0 THEN 'ringkas' ELSE '<b>isi</b>' END AS description,
        '' AS published FROM pages"""
    o["atom_scan"] = """
      SELECT url AS link, 'page ' || page_id AS title, CASE WHEN page_id % 2 = 0 THEN 'ringkas' ELSE 'isi' END AS description,
        CASE WHEN page_id % 3 = 0 THEN '2024-01-02T03:04:05Z' ELSE '2024-05-06T07:08:09Z' END AS published FROM pages
      UNION ALL SELECT url, 'page ' || page_id, 'kedua', '' FROM pages"""
    o["history_then_live"] = f"""WITH {MESSAGES} SELECT topic, value, event_id % 2 = 0 AS history FROM messages"""
    o["lake_roundtrip"] = f"""WITH {LABELED}
      SELECT final_label, count(*) AS n, sum(length(text))::BIGINT AS n_chars FROM labeled GROUP BY final_label"""
    o["prediction_log"] = f"""WITH {VERDICT}
      SELECT count(*) AS total_predictions, {', '.join(f"count_if(label = '{k}')::BIGINT AS {k}" for k in fv.LABELS)} FROM verdicts"""

    # streams
    o["stream_enrich"] = f"""WITH {MESSAGES}, good AS (
        SELECT *, {has('text', ['click', 'b'])} AS hoax, {has('text', ['view'])} AS formal FROM cleaned WHERE problem IS NULL AND text <> ''),
      v AS (SELECT *, CASE WHEN hoax THEN 'Hoaks' ELSE 'Valid' END AS label FROM good)
      SELECT topic AS source_topic, label, CASE WHEN hoax THEN 30.0 WHEN formal THEN 8.0 ELSE 0.0 END::DOUBLE AS score,
        {cases('label', fv.RECOMMENDATIONS, '')} AS recommendation, json_extract_string(value, '$.title') AS title FROM v"""
    o["stream_reason"] = f"""WITH {similarity(1, 0.5, strip_tags('text'))}
      SELECT documents.doc_id, CASE WHEN sim IS NULL THEN {q(fv.REASON_NONE)} ELSE
        'Mirip dengan hoaks terverifikasi Komdigi (' || round(round(sim, 4) * 100, 1) || '%): "item ' || item_id || '"' END AS reason
      FROM documents LEFT JOIN best ON best.doc_id = documents.doc_id WHERE {strip_tags('text')} <> ''"""
    o["stream_dead_letters"] = o["dead_letters"]
    o["stream_feed"] = f"""WITH {ENVELOPES} SELECT id, source, source_type, timestamp, text_snippet FROM flat JOIN events USING (event_id)
      QUALIFY row_number() OVER (PARTITION BY id ORDER BY ts, event_id % 3, event_id) = 1"""
    o["stream_dedup"] = "SELECT DISTINCT user_id || '/' || event_type AS link FROM events"
    o["stream_hourly"] = f"""
      SELECT epoch(date_trunc('hour', ts))::BIGINT AS hour_start, count(*) AS n_messages,
        count_if(event_type IN ('error', 'click'))::BIGINT AS n_risk FROM events GROUP BY 1
      HAVING hour_start + 3600 <= (SELECT epoch(max(ts)) - 600 FROM events)"""
    o["stream_link_surge"] = """
      WITH w AS (SELECT 'bit.ly/' || event_type AS link, user_id % 20 AS channel, (floor(epoch(ts) / 300)::BIGINT - i) * 300 AS window_start
        FROM events, range(6) r(i))
      SELECT window_start, link, count(*) AS n_uses, count(DISTINCT channel) AS n_channels FROM w GROUP BY ALL
      HAVING window_start + 1800 <= (SELECT epoch(max(ts)) - 600 FROM events)"""
    return o
