"""DuckDB twins of the queries that SQL can express on whole tables."""

from __future__ import annotations

import string

_NORMAL = f"translate(coalesce(text, ''), '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

EXACT_DEDUP = f"""
WITH d AS (SELECT doc_id, sha256({_NORMAL}) AS text_sha256 FROM documents)
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       text_sha256
FROM d WINDOW g AS (PARTITION BY text_sha256)
"""


def _escaped(x: str) -> str:
    out = f"replace({x}, chr(92), chr(92) || chr(92))"
    for c in ("<s>", "</s>", "[INST]", "[/INST]", "<<SYS>>", "<</SYS>>", "<|im_start|>", "<|im_end|>"):
        out = f"replace({out}, '{c}', '{c[0]}' || chr(92) || '{c[1:]}')"
    return out


CHAT = f"""
WITH t AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>' || {_escaped('role')} || chr(10) || {_escaped('text')} || '<|im_end|>' || chr(10)))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

COLLOCATIONS = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_NORMAL}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents
),
w AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[ \\x09]+'), lambda x: x <> '') AS ws FROM pieces),
ones AS (SELECT lang, word, count(*) AS f FROM (SELECT lang, unnest(ws) AS word FROM w) GROUP BY ALL),
totals AS (SELECT lang, sum(f)::BIGINT AS n FROM ones GROUP BY lang),
twos AS (
  SELECT lang, p[1] AS x, p[2] AS y, count(*) AS a
  FROM (SELECT lang, unnest(list_transform(range(1, len(ws)), lambda i: [ws[i], ws[i + 1]])) AS p FROM w) GROUP BY ALL
),
threes AS (
  SELECT lang, p[1] AS x, p[2] AS y, p[3] AS z, count(*) AS a
  FROM (SELECT lang, unnest(list_transform(range(1, len(ws) - 1), lambda i: [ws[i], ws[i + 1], ws[i + 2]])) AS p FROM w) GROUP BY ALL
  HAVING count(*) >= 10
),
longer AS (
  SELECT lang, x, y, max(a) AS m
  FROM (SELECT lang, x, y, a FROM threes UNION ALL SELECT lang, y, z, a FROM threes) GROUP BY ALL
),
cut AS (
  SELECT t.lang, t.x || ' ' || t.y AS phrase, t.a, 1 AS k, l.f AS l, r.f AS r
  FROM twos t JOIN ones l ON l.lang = t.lang AND l.word = t.x JOIN ones r ON r.lang = t.lang AND r.word = t.y
  LEFT JOIN longer g ON g.lang = t.lang AND g.x = t.x AND g.y = t.y
  WHERE t.a >= 10 AND (g.m IS NULL OR 100 * g.m < 50 * t.a)
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.a, 1, l.f, r.a
  FROM threes t JOIN ones l ON l.lang = t.lang AND l.word = t.x JOIN twos r ON r.lang = t.lang AND r.x = t.y AND r.y = t.z
  UNION ALL
  SELECT t.lang, t.x || ' ' || t.y || ' ' || t.z, t.a, 2, l.a, r.f
  FROM threes t JOIN twos l ON l.lang = t.lang AND l.x = t.x AND l.y = t.y JOIN ones r ON r.lang = t.lang AND r.word = t.z
),
scored AS (SELECT *, (1000000::HUGEINT * a * a // (l::HUGEINT * r))::BIGINT AS score FROM cut),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM best)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN totals USING (lang) WHERE rank <= 2000
"""

ORACLE = {"op8_chat": CHAT, "op9_exact_dedup": EXACT_DEDUP, "op12_collocations": COLLOCATIONS}
