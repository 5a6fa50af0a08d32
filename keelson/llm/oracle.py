"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from keelson.llm import filter_audit, licenses


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def license_sql() -> str:
    """The licence scan as plain relational SQL: pieces unnested, joined with
    the known sentences, aggregated back to a chain of identifiers."""
    known = ", ".join(f"({_quoted(s)}, {_quoted(name)})" for name, s in licenses.SENTENCES.items())
    rules = ", ".join(f"({_quoted(r)}, {_quoted(lic)}, {_quoted('<' + '><'.join(ids) + '>')})" for r, lic, ids in licenses.RULES)
    hides = ", ".join(f"({_quoted(long)}, {_quoted(short)})" for long, short in licenses.HIDES)
    bars = ", ".join(f"({_quoted('<' + name + '>')}, {_quoted(rule)})" for name, rule in licenses.BARS)
    parts = ", ".join(f"({_quoted(p)})" for p in licenses.FIXED_PARTS)
    return f"""
WITH known(sentence, name) AS (VALUES {known}),
rules(rule, licence, pattern) AS (VALUES {rules}),
bars(sentence, rule) AS (VALUES {bars}),
parts(part) AS (VALUES {parts}),
hides AS (
  SELECT l.rule AS longer, s.rule AS shorter FROM rules l JOIN rules s ON l.licence = s.licence AND l.pattern <> s.pattern AND contains(l.pattern, s.pattern)
  UNION VALUES {hides}),
d AS (SELECT row_number() OVER () AS row_id, doc_id, text FROM documents),
marked AS (
  SELECT row_id, regexp_replace(regexp_replace(regexp_replace(
           text, '\n[^A-Za-z0-9\n]*([0-9]{{1,2}}[.)]|\\([a-z0-9]{{1,2}}\\)|[a-z]\\))[ \t]', chr(1), 'g'), '[.!?]+(\\s|$)', chr(1), 'g'), '\n[^A-Za-z0-9\n]*\n', chr(1), 'g') AS s,
         regexp_replace(text, '[\n\r]+', chr(1), 'g') AS l
  FROM d WHERE text IS NOT NULL),
pieces AS (
  SELECT row_id, 's' AS cut, generate_subscripts(string_split(s, chr(1)), 1) AS pos, unnest(string_split(s, chr(1))) AS piece FROM marked
  UNION ALL
  SELECT row_id, 'l', generate_subscripts(string_split(l, chr(1)), 1), unnest(string_split(l, chr(1))) FROM marked),
plain AS (SELECT row_id, cut, pos, trim(regexp_replace(lower(piece), '[^a-z0-9]+', ' ', 'g')) AS piece FROM pieces),
chains AS (
  SELECT row_id, cut, count(*) AS n, '<' || string_agg(name, '><' ORDER BY pos) || '>' AS chain
  FROM plain LEFT JOIN parts ON contains(piece, part) JOIN known ON sentence = coalesce(part, piece)
  GROUP BY row_id, cut),
barred AS (SELECT DISTINCT row_id, rule FROM chains JOIN bars ON contains(chain, sentence)),
fits AS (SELECT DISTINCT row_id, rule, licence FROM chains, rules WHERE contains(chain, pattern) AND (row_id, rule) NOT IN (SELECT (row_id, rule) FROM barred)),
shown AS (
  SELECT * FROM fits f WHERE NOT EXISTS (
    SELECT 1 FROM fits g JOIN hides h ON h.longer = g.rule WHERE g.row_id = f.row_id AND h.shorter = f.rule)),
found AS (
  SELECT row_id, string_agg(DISTINCT rule, ',' ORDER BY rule) AS rules, string_agg(DISTINCT licence, ',' ORDER BY licence) AS licences
  FROM shown GROUP BY row_id),
most AS (SELECT row_id, max(n) AS n FROM chains GROUP BY row_id)
SELECT doc_id, coalesce(n, 0) AS n_known, coalesce(rules, '') AS rules, coalesce(licences, '') AS licences
FROM d LEFT JOIN most USING (row_id) LEFT JOIN found USING (row_id)
"""


ORACLE_SQL = {"op3_licenses": license_sql(), "op11_filter_audit": filter_audit.SQL}
