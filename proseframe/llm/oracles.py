"""DuckDB SQL for the queries of this subpackage that SQL can express."""

_WORDS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

DECONTAMINATE = f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[k : k + least(len(w), 10) - 1], ' ') AS p
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
),
places AS (
  SELECT doc_id, n, k, array_to_string(w[k : k + n - 1], ' ') AS p
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS k FROM d, (SELECT DISTINCT n FROM win) WHERE len(w) >= n)
),
found AS (SELECT doc_id, k, n, item_id FROM places JOIN win USING (n, p)),
hit AS (
  SELECT doc_id, count(DISTINCT k + o) AS n_hit FROM (SELECT doc_id, k, unnest(range(0, n)) AS o FROM found) GROUP BY doc_id
),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item_id FROM found) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""

_CONTROL = r"<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|<\|system\|>|<\|user\|>|<\|assistant\|>|<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>"


def _escaped(column: str) -> str:
    return f"length(regexp_replace(replace({column}, chr(92), chr(92) || chr(92)), '{_CONTROL}', '++\\0', 'g'))"


CHAT = f"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(12 + {_escaped('role')} + length(role) - length(replace(role, chr(10), '')) + 1 + {_escaped('text')} + 10 + 1) AS BIGINT) AS formatted_chars
FROM rows GROUP BY conv_id
"""

PHRASES = r"""
WITH d AS (
  SELECT coalesce(lang, 'und') AS lang,
    unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM d),
g AS (
  SELECT lang, k, array_to_string(w[i : i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (VALUES (1), (2), (3), (4)) AS v(k) WHERE len(w) >= k)
),
c AS (SELECT lang, k, phrase, count(*) AS a FROM g GROUP BY ALL),
cand AS (SELECT lang, k, phrase, a, string_split(phrase, ' ') AS w FROM c WHERE k >= 2 AND a >= 30),
cuts AS (
  SELECT lang, k, phrase, a, j, array_to_string(w[1 : j], ' ') AS first, array_to_string(w[j + 1 : k], ' ') AS rest
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand)
),
scored AS (
  SELECT q.lang, q.phrase, q.a, q.j, x.a AS l, y.a AS r, CAST((CAST(2000000 AS HUGEINT) * q.a) // (x.a + y.a) AS BIGINT) AS score
  FROM cuts q JOIN c x ON x.lang = q.lang AND x.phrase = q.first JOIN c y ON y.lang = q.lang AND y.phrase = q.rest
),
best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inside AS (
  SELECT lang, array_to_string(w[i : i + m - 1], ' ') AS phrase, max(a) AS more
  FROM (SELECT lang, w, a, m, unnest(range(1, k - m + 2)) AS i FROM cand, (VALUES (2), (3)) AS v(m) WHERE m < k) GROUP BY ALL
),
n AS (SELECT lang, sum(a) AS n FROM c WHERE k = 1 GROUP BY lang),
ranked AS (
  SELECT b.lang, row_number() OVER (PARTITION BY b.lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank, phrase, a, l, r, score
  FROM best b LEFT JOIN inside USING (lang, phrase) WHERE more IS NULL OR 100 * more < 80 * a
)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
