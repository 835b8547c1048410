"""SQL whose rows must equal those of the registered queries."""

from __future__ import annotations

from tallystar.llm import license_scan, mixing

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

MIXING = rf"""
WITH sized AS (
  SELECT doc_id, source, coalesce('=' || source, 'null') AS source_key,
         len({WORDS}) AS size, coalesce(doc_id, 0) % {mixing.TIE_CELLS} AS cell
  FROM documents),
sizes AS (
  SELECT source_key, any_value(source) AS source, sum(size)::BIGINT AS source_size
  FROM sized GROUP BY source_key),
weighed AS (
  SELECT *, row_number() OVER (ORDER BY source ASC NULLS LAST) AS position,
         [{", ".join(map(str, mixing.WEIGHTS))}][
           ((row_number() OVER (ORDER BY source ASC NULLS LAST)) - 1) % {len(mixing.WEIGHTS)} + 1
         ] AS weight,
         source_size * {mixing.MAX_COPIES} AS cap,
         (sum(source_size) OVER ())::BIGINT AS total
  FROM sizes),
levels AS (
  SELECT *, cap / weight AS ratio,
         (total - coalesce(sum(cap) OVER (ORDER BY cap / weight, position
            ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT)
         / (sum(weight) OVER (ORDER BY cap / weight, position
            ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::BIGINT AS level
  FROM weighed),
chosen AS (
  SELECT arg_min(level, position_of) AS level FROM (
    SELECT level, row_number() OVER (ORDER BY ratio, position) AS position_of
    FROM levels WHERE level <= ratio)),
targets AS (
  SELECT source_key, source_size, source, coalesce(
           least(cap::DOUBLE, (SELECT level FROM chosen) * weight), cap::DOUBLE) AS target
  FROM levels),
placed AS (
  SELECT s.doc_id, s.size, t.source_size, t.target,
         row_number() OVER (PARTITION BY s.source_key ORDER BY size, cell, doc_id) AS position,
         CASE WHEN t.source_size > 0 THEN t.target / t.source_size ELSE 0.0 END AS rate,
         ('0x' || substr(md5('{mixing.SEED}' || coalesce(s.source, chr(0) || 'null')), 1, 8))::BIGINT
           / 4294967296.0 AS shift
  FROM sized s JOIN targets t USING (source_key))
SELECT doc_id, size, source_size, target,
       least((floor(position * rate + shift) - floor((position - 1) * rate + shift))::BIGINT,
             {mixing.MAX_COPIES}) * size AS taken
FROM placed
"""

EXACT_DEDUP = r"""
WITH bodies AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS body
  FROM documents)
SELECT doc_id, min(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = min(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM bodies WINDOW same AS (PARTITION BY body)
"""


LINE_DEDUP = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS spot
  FROM documents),
keyed AS (
  SELECT *, translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'),
                      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
  GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
judged AS (
  SELECT doc_id, spot, line, keeper IS NOT NULL AND keeper <> doc_id AS gone
  FROM keyed LEFT JOIN repeated USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY spot) FILTER (NOT gone), '')) AS kept_sha256
FROM judged GROUP BY doc_id
"""

SOURCE_DIVERGENCE = r"""
WITH plain AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(coalesce(text, ''), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS words,
         row_number() OVER () AS doc
  FROM documents),
terms AS (
  SELECT lang, source, doc, translate(unnest(words), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                      'abcdefghijklmnopqrstuvwxyz') AS term
  FROM plain),
kept AS (
  SELECT lang, term, count(*)::HUGEINT AS total FROM terms
  GROUP BY ALL HAVING count(DISTINCT doc) >= 3),
langs AS (SELECT lang, count(*) AS v, sum(total)::HUGEINT AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM plain),
counts AS (SELECT lang, source, term, count(*)::HUGEINT AS c FROM terms GROUP BY ALL),
sizes AS (
  SELECT lang, source, sum(c)::HUGEINT AS n FROM counts JOIN kept USING (lang, term) GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.c, 0) AS c,
         1 + 1000000000::HUGEINT * (coalesce(c.c, 0) + 1) // (coalesce(s.n, 0) + l.v) AS p,
         1 + 1000000000::HUGEINT * (k.total + 1) // (l.n + l.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN langs l USING (lang)
  LEFT JOIN sizes s USING (lang, source) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN (
    SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
    FROM shares a JOIN shares b
      ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
    GROUP BY ALL) priced ON priced.lang = a.lang AND priced.source = a.source AND priced.item = b.source),
every AS (
  SELECT lang, source, 'pair' AS part, item, value FROM pairs
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // q)::BIGINT FROM shares WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value,
       (row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item))::INTEGER AS rank
FROM every
QUALIFY part = 'pair' OR rank <= 200
"""


def _quoted(words: str) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words.split()) + "]"


def _license_scan() -> str:
    """The block at every word of every text that has enough of a template's words anywhere,
    and every word as a place of every phrase."""
    phrases, notices = license_scan.PHRASES, license_scan.NOTICES
    width = license_scan.block_words([*phrases, *notices])
    phrase_rows = ", ".join(f"({_quoted(t)}, '{label}')" for t, label in phrases)
    notice_rows = ", ".join(
        f"(list_sort(list_distinct({_quoted(t)})), '{label}')" for t, label in notices)
    return rf"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(lower(replace(coalesce(text, ''), chr(8490), chr(8486))),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words
  FROM documents),
phrases(wording, label) AS (VALUES {phrase_rows}),
notices(wording, label) AS (VALUES {notice_rows}),
starts AS (
  SELECT doc_id, words, unnest(range(len(words))) AS spot FROM split),
places AS (
  SELECT doc_id, label, spot, 1.0::DOUBLE AS score
  FROM starts, phrases
  WHERE words[spot + 1] = wording[1] AND words[spot + 1 : spot + len(wording)] = wording),
hopeful AS (
  SELECT doc_id, words, wording, label, ceil({license_scan.THRESHOLD} * len(wording) - 1e-9) AS needed
  FROM split, notices WHERE len(list_intersect(wording, words)) >= needed),
blocks AS (
  SELECT doc_id, wording, label, needed, unnest(list_transform(
           range(len(words)), lambda spot: words[spot + 1 : spot + {width}])) AS block
  FROM hopeful),
found AS (
  SELECT doc_id, label, NULL AS spot, len(list_intersect(wording, block)) / len(wording) AS score
  FROM blocks WHERE len(list_intersect(wording, block)) >= needed),
every AS (SELECT * FROM places UNION ALL SELECT * FROM found),
listed AS (
  SELECT doc_id, count(spot) AS n_base, min(spot) AS first_word, max(spot) AS last_word,
         array_to_string(list_sort(list_distinct(coalesce(
           list(label) FILTER (spot IS NOT NULL), []))), ',') AS base_labels,
         array_to_string(list_sort(list_distinct(list(label))), ',') AS labels,
         max(score) AS score
  FROM every GROUP BY doc_id)
SELECT s.doc_id, len(words) AS n_words, coalesce(n_base, 0) AS n_base, first_word, last_word,
       coalesce(base_labels, '') AS base_labels, coalesce(labels, '') AS labels,
       coalesce(score, 0.0) AS score
FROM split s LEFT JOIN listed USING (doc_id)
"""


LICENSE_SCAN = _license_scan()


def url_filter(start: int, step: int, span: int) -> str:
    """Every capture against every interval of its host and parent domains."""
    number = lambda at: f"('0x' || substr(md5(pattern), {at}, 4))::BIGINT"
    return rf"""
WITH captures AS (
  SELECT DISTINCT page_id, url, page_id * {step} % {span} + {start} AS fetched_at,
         nullif(rtrim(lower(regexp_extract(url,
           '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)', 1)), '.'), '') AS host
  FROM pages),
domains AS (
  SELECT DISTINCT CASE WHEN len(string_split(host, '.')) > 3
           THEN substr(host, instr(host, '.') + 1) ELSE host END AS pattern
  FROM captures WHERE host IS NOT NULL),
hosts AS (
  SELECT pattern, {number(1)} AS kind, {start} + {number(5)} % 300 * 86400 AS opens,
         ({number(9)} % 60 + 1) * 86400 AS stay, ({number(13)} % 40 + 1) * 86400 AS gap
  FROM domains),
intervals AS (
  SELECT pattern, kind, opens AS valid_from, opens + stay AS valid_to FROM hosts WHERE kind % 3 > 0
  UNION ALL
  SELECT pattern, kind, opens + stay + gap, NULL FROM hosts WHERE kind % 3 > 0 AND kind % 2 = 0),
found AS (
  SELECT c.page_id, c.url, c.fetched_at, i.pattern,
         CASE WHEN kind % 5 < 2 THEN 'adult' ELSE 'spam' END AS category
  FROM captures c JOIN intervals i
    ON (c.host = i.pattern OR ends_with(c.host, '.' || i.pattern))
   AND c.fetched_at >= i.valid_from AND (i.valid_to IS NULL OR c.fetched_at < i.valid_to)),
judged AS (
  SELECT page_id, url, fetched_at, string_agg(DISTINCT category, ',' ORDER BY category) AS categories,
         arg_max(pattern, len(pattern)) AS matched
  FROM found GROUP BY ALL)
SELECT c.page_id, c.url, c.host, c.fetched_at, j.matched IS NOT NULL AS blocked,
       coalesce(j.categories, '') AS categories, j.matched
FROM captures c LEFT JOIN judged j USING (page_id, url, fetched_at)
"""
