"""DuckDB SQL for the operators that SQL can express."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WHITE = " || ".join(f"chr({c})" for c in (32, 9, 10, 11, 12, 13))


def line_dedup() -> str:
    """Lines by key, the keys of enough documents, and what stays of each text."""
    return f"""
WITH split AS (
  SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), lines AS (
  SELECT doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS place FROM split
), keyed AS (
  SELECT *, translate(trim(line, {WHITE}), '{UPPER}', '{LOWER}') AS key FROM lines
), common AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), judged AS (
  SELECT k.*, coalesce(k.doc_id <> c.keeper, false) AS goes FROM keyed k LEFT JOIN common c ON k.key = c.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (goes) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT goes), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""


def vector_codes() -> str:
    """Four rounds of nearest entries and floored means over all pairs of part and entry, written out."""
    steps = ["""
whole AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, label, part, v[part * (len(v) // 4) + 1 : (part + 1) * (len(v) // 4)] AS v
  FROM whole, (SELECT unnest(range(4)) AS part)
), entries0 AS MATERIALIZED (
  SELECT part, entry, v FROM parts JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM whole ORDER BY vec_id LIMIT 256
  ) USING (vec_id)
)"""]
    assign = """
assigned{i} AS MATERIALIZED (
  SELECT p.vec_id, p.label, p.part, any_value(p.v) AS v, min({{
    'd': list_dot_product(p.v, p.v) - 2 * list_dot_product(p.v, e.v) + list_dot_product(e.v, e.v), 'entry': e.entry
  }}) AS best
  FROM parts p JOIN entries{i} e ON p.part = e.part GROUP BY p.vec_id, p.label, p.part
)"""
    update = """
means{i} AS (
  SELECT part, entry, list(mean ORDER BY pos) AS v FROM (
    SELECT part, best.entry AS entry, pos, floor(sum(v[pos + 1]) / count(*)) AS mean
    FROM assigned{i}, (SELECT unnest(range((SELECT max(len(v)) FROM parts))) AS pos) GROUP BY ALL
  ) GROUP BY part, entry
), entries{j} AS MATERIALIZED (
  SELECT e.part, e.entry, coalesce(m.v, e.v) AS v FROM entries{i} e LEFT JOIN means{i} m ON e.part = m.part AND e.entry = m.entry
)"""
    for i in range(4):
        steps += [assign.format(i=i), update.format(i=i, j=i + 1)]
    steps.append(assign.format(i=4))
    return "WITH " + ", ".join(steps) + """, coded AS (
  SELECT vec_id, label, string_agg(lpad(lower(to_hex(best.entry)), 2, '0'), '' ORDER BY part) AS code,
    sum(best.d)::BIGINT AS error
  FROM assigned4 GROUP BY vec_id, label
), digest AS (
  SELECT sha256(string_agg(array_to_string(list_transform(v, lambda x: x::BIGINT), ','), ',' ORDER BY part, entry)) AS codebooks_sha256
  FROM entries4
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
FROM coded, digest"""


def spelling_variants() -> str:
    """Near words by equal texts after deleting or blanking one letter; roots by recursion."""
    return f"""
WITH RECURSIVE crc_table AS MATERIALIZED (
  SELECT list_transform(range(256), lambda b: list_reduce(list_prepend(b::BIGINT, range(8)),
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t
), runs AS (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), '{UPPER}', '{LOWER}') AS run FROM documents
), counted AS MATERIALIZED (
  SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL
), bytes AS (
  SELECT doc_id, run, n, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS h FROM counted
), checked AS MATERIALIZED (
  SELECT run, n, xor(list_reduce(list_prepend(4294967295, list_transform(range(length(h) // 2), lambda i: ('0x' || h[2 * i + 1 : 2 * i + 2])::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS crc
  FROM bytes, crc_table
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN crc % 199 = 0 THEN left(run, crc % length(run)) || substr(run, crc % length(run) + 2) ELSE run END AS word, n FROM checked
  ) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), places AS (
  SELECT word, unnest(range(1, length(word) + 1)) AS pos FROM words
), without AS MATERIALIZED (
  SELECT DISTINCT word, left(word, pos - 1) || substr(word, pos + 1) AS rest FROM places
), blanked AS MATERIALIZED (
  SELECT word, pos, left(word, pos - 1) || '_' || substr(word, pos + 1) AS rest FROM places
), near AS MATERIALIZED (
  SELECT a.word, b.word AS other FROM blanked a JOIN blanked b ON a.pos = b.pos AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, w.word FROM without d JOIN words w ON d.rest = w.word
  UNION SELECT w.word, d.word FROM without d JOIN words w ON d.rest = w.word
), best AS (
  SELECT near.word, count(*) AS n_near, min({{'least': -o.n, 'other': other}}) AS most
  FROM near JOIN words o ON o.word = near.other GROUP BY near.word
), formed AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -most.least >= 5 * w.n THEN most.other END AS form, CASE WHEN -most.least >= 5 * w.n THEN -most.least END AS form_n
  FROM words w LEFT JOIN best b ON b.word = w.word
), led AS (
  SELECT word, word AS root FROM formed
  UNION ALL SELECT led.word, f.form FROM led JOIN formed f ON f.word = led.root WHERE f.form IS NOT NULL
), last AS (
  SELECT led.word, led.root FROM led JOIN formed f ON f.word = led.root WHERE f.form IS NULL
)
SELECT f.word, form, root, n, n_near, form_n FROM formed f JOIN last ON last.word = f.word"""
