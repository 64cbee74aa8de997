"""DuckDB twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

from clickpulse.llm.licences import TEMPLATES
from clickpulse.llm.url_filter import ORACLE as URL_FILTER

# Windows of ten words (or whole shorter items), by comparing every window of
# every document with every window of every item.
DECONTAMINATE = r"""
WITH cut(kind, id, words) AS (
  SELECT 'doc', doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM documents
  UNION ALL
  SELECT 'item', item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
docs AS (SELECT row_number() OVER () AS i, id AS doc_id, words FROM cut WHERE kind = 'doc'),
items AS (SELECT id AS item_id, words, least(10, len(words)) AS size FROM cut WHERE kind = 'item' AND len(words) > 0),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(words[p:p + size - 1], ' ') AS window_text
  FROM (SELECT *, unnest(range(1, len(words) - size + 2)) AS p FROM items)),
doc_windows AS (
  SELECT i, size, p, array_to_string(words[p:p + size - 1], ' ') AS window_text
  FROM (SELECT i, words, size, unnest(range(1, len(words) - size + 2)) AS p
        FROM docs, (SELECT DISTINCT size FROM items) WHERE len(words) >= size)),
found AS (SELECT i, p, d.size, item_id FROM doc_windows d JOIN item_windows w ON d.size = w.size AND d.window_text = w.window_text),
hit AS (SELECT i, count(DISTINCT word) AS n_hit FROM (SELECT i, unnest(range(p, p + size)) AS word FROM found) GROUP BY i),
named AS (SELECT i, count(*) AS n_items, string_agg(CAST(item_id AS VARCHAR), ',' ORDER BY CAST(item_id AS VARCHAR)) AS ids
          FROM (SELECT DISTINCT i, item_id FROM found) GROUP BY i)
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN hit USING (i) LEFT JOIN named USING (i)
"""

# Every line, block and text against every template, without pruning.
_LICENCES = r"""
WITH templates(k, name, text) AS (VALUES
  @VALUES@),
docs AS (SELECT row_number() OVER () AS i, doc_id, coalesce(text, '') AS text FROM documents),
units AS (
  SELECT i, unnest(string_split(text, chr(10))) AS unit FROM docs
  UNION ALL SELECT i, text FROM docs WHERE contains(text, chr(10))
  UNION ALL SELECT i, unit FROM (SELECT i, unnest(regexp_split_to_array(text, '\n[ \t\r\f\v]*\n\s*')) AS unit FROM docs) WHERE contains(unit, chr(10))),
texts AS (
  SELECT 'unit' AS kind, row_number() OVER () AS u, i, NULL AS name, regexp_extract_all(lower(unit), '[\p{L}\p{N}]+') AS w FROM units
  UNION ALL SELECT 'template', k, NULL, name, regexp_extract_all(lower(text), '[\p{L}\p{N}]+') FROM templates),
grams AS (
  SELECT kind, u, i, name, len(w) - 1 AS n, unnest(list_transform(range(1, len(w)), lambda p: w[p] || ' ' || w[p + 1])) AS g
  FROM texts WHERE len(w) > 1),
counted AS (SELECT kind, u, i, name, n, g, count(*) AS c FROM grams GROUP BY ALL),
shared AS (
  SELECT a.u, a.i, b.name, b.u AS k, b.n AS size, CAST(2 * sum(least(a.c, b.c)) AS DOUBLE) / (a.n + b.n) AS dice
  FROM counted a JOIN counted b ON a.kind = 'unit' AND b.kind = 'template' AND a.g = b.g GROUP BY a.u, a.i, a.n, b.name, b.u, b.n),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY u ORDER BY dice DESC, size DESC, name) AS r FROM shared) WHERE r = 1 AND dice >= 0.8),
named AS (SELECT i, name, max(dice) AS dice FROM best GROUP BY ALL),
per AS (SELECT i, first(name ORDER BY dice DESC, name) AS licence, max(dice) AS dice, string_agg(name, ',' ORDER BY name) AS licences FROM named GROUP BY i)
SELECT doc_id, licence, dice, coalesce(licences, '') AS licences FROM docs LEFT JOIN per USING (i)
"""


def licences() -> str:
    rows = [(n, " ".join(t.split())) for n, texts in TEMPLATES.items() for t in texts]
    quoted = ", ".join("({}, '{}', '{}')".format(i, n, t.replace("'", "''")) for i, (n, t) in enumerate(rows))
    return _LICENCES.replace("@VALUES@", quoted)


# Of equal texts the row of largest id stays; ids are unique in the tables.
EXACT_DEDUP = """
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY text) AS keep_id, count(*) OVER (PARTITION BY text) AS group_size,
  row_number() OVER (PARTITION BY text ORDER BY doc_id DESC NULLS LAST) = 1 AS kept, sha256(text) AS text_sha256
FROM docs
"""

ORACLES = {"op5_url_filter": URL_FILTER, "op6_licences": licences(), "op7_decontaminate": DECONTAMINATE,
           "op11_exact_dedup": EXACT_DEDUP}
