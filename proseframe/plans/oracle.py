"""DuckDB SQL twins of the catalogue's queries."""

from __future__ import annotations

from proseframe.functions.stem import IRREGULAR, STEP2, STEP3, STEP4_LONGEST_FIRST
from proseframe.functions.text import WS_CLASS
from proseframe.operators.report import RULE_WIDTH
from proseframe.plans.catalogue import ENCODED_LENGTH, VOCABULARY_IDS
from proseframe.sources.synthetic import CHOICES


# --- SQL fragments -----------------------------------------------------------


def _strip(x: str) -> str:
    return f"regexp_replace({x}, '^[{WS_CLASS}]+|[{WS_CLASS}]+$', '', 'g')"


def _collapse(x: str) -> str:
    return f"trim(regexp_replace({x}, '[{WS_CLASS}]+', ' ', 'g'), ' ')"


def _words(x: str) -> str:
    return f"regexp_extract_all({x}, '[^{WS_CLASS}]+')"


def _key(x: str, seed: int = 42) -> str:
    return f"md5('{seed}-' || {x}::VARCHAR)"


def _answer(x: str, lower: bool = True) -> str:
    text = f"lower({x})" if lower else x
    return _strip(f"regexp_replace({text}, '[^\\p{{L}}\\p{{N}}_{WS_CLASS}]', '', 'g')")


def _case(x: str, table: dict[str, str]) -> str:
    return " ".join(f"WHEN {x} = '{k}' THEN {v}" for k, v in table.items())


def _split_cte(source: str, id_col: str, train: float, val: float) -> str:
    """Rows of ``source`` with their split by global rank."""
    return f"""
      SELECT * EXCLUDE (rk, n),
        CASE WHEN rk <= floor(n::DOUBLE * {train}::DOUBLE) THEN 'train'
             WHEN rk <= floor(n::DOUBLE * {train}::DOUBLE) + floor(n::DOUBLE * {val}::DOUBLE) THEN 'validation'
             ELSE 'test' END AS split
      FROM (SELECT *, row_number() OVER (ORDER BY {_key(id_col)}, {id_col}) AS rk, count(*) OVER () AS n FROM {source})"""


_PAIRS = """
  SELECT u.conv_id, u.turn, u.text AS reference, a.text AS prediction
  FROM conversations u JOIN conversations a ON a.conv_id = u.conv_id AND a.turn = u.turn + 1
  WHERE u.role = 'user' AND a.role = 'assistant'"""

_ALTERED = """
  SELECT doc_id AS row_id, lang, text AS reference,
    CASE WHEN lang = 'en' THEN lower(text)
         WHEN lang = 'fr' THEN '  ' || text || ' !'
         WHEN lang = 'de' THEN regexp_replace(text, '[.,]', '', 'g')
         ELSE text || ' fin' END AS prediction
  FROM documents"""

_GRADED = """
  SELECT d.doc_id, d.lang, 'q' || l.quality || 't' || l.toxic AS reference,
    CASE WHEN n_chars > 3000 THEN 'q0t0' WHEN n_chars > 400 THEN 'q1t0'
         WHEN n_chars > 200 THEN 'q1t1' ELSE 'other' END AS prediction
  FROM documents d JOIN labels l ON d.doc_id = l.doc_id"""

_OUTCOMES = """
  SELECT event_id, user_id, event_type, props,
    CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'signup' THEN '' ELSE props END AS output
  FROM events"""

_LOG = """
  SELECT user_id::VARCHAR AS run_id, event_id AS log_seq, day(ts)::DOUBLE AS epoch, event_id AS step, ts,
    CASE WHEN event_type = 'purchase' THEN value END AS train_loss,
    CASE WHEN event_type IN ('view', 'click') THEN value END AS eval_loss,
    value AS total_time
  FROM events"""

_CLASSES = """
  SELECT lang, reference AS class, count(*) AS support, 0 AS predicted,
    sum((reference = prediction)::INT) AS hit FROM graded GROUP BY ALL
  UNION ALL
  SELECT lang, prediction, 0, count(*), 0 FROM graded GROUP BY ALL"""


def _class_report(by: str = "") -> str:
    """CTEs up to ``report``: precision, recall and F1 per class."""
    keys = f"{by}, " if by else ""
    return f"""
  WITH graded AS ({_GRADED}), sides AS ({_CLASSES}),
  sums AS (SELECT {keys}class, sum(support)::BIGINT AS support, sum(predicted)::BIGINT AS predicted,
           sum(hit)::BIGINT AS hit FROM sides GROUP BY ALL),
  pr AS (SELECT *, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0.0 END::DOUBLE AS precision,
         CASE WHEN support > 0 THEN hit / support ELSE 0.0 END::DOUBLE AS recall FROM sums),
  report AS (SELECT *, CASE WHEN precision + recall > 0
             THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END::DOUBLE AS f1 FROM pr)"""


_WEIGHTED = """round(sum(hit) / sum(support), 6) AS accuracy,
  round(sum(precision * support) / sum(support), 6) AS precision,
  round(sum(recall * support) / sum(support), 6) AS recall,
  round(sum(f1 * support) / sum(support), 6) AS f1"""

# the 13a rules written for this dialect, on a column named "line"
_TOKENS_13A = r"""regexp_replace(regexp_replace(regexp_replace(regexp_replace(
    ' ' || replace(replace(replace(replace(replace(replace(replace(
      regexp_replace({x}, '[%s]+$', ''), '<skipped>', ''), '-' || chr(10), ''), chr(10), ' '),
      '&quot;', '"'), '&amp;', '&'), '&lt;', '<'), '&gt;', '>') || ' ',
    '([\{-\~\[-\x60 -\&\(-\+\:-\@\/])', ' \1 ', 'g'),
    '([^0-9])([\.,])', '\1 \2 ', 'g'), '([\.,])([^0-9])', ' \1 \2', 'g'), '([0-9])(-)', '\1 \2 ', 'g')""" % WS_CLASS


def _bleu_tokens(x: str) -> str:
    return _words(_TOKENS_13A.replace('{x}', x))


def _lead(n: int) -> str:
    """The n-gram that starts at a token; null near the end."""
    return " || ' ' || ".join(["w"] + [f"lead(w, {k}) OVER win" for k in range(1, n)])


def _stack(source: str, keys: str) -> str:
    return " UNION ALL ".join(f"SELECT {keys}, {n} AS n, g{n} AS gram FROM {source}" for n in range(1, 5))


def _bleu(source: str, by: str = "") -> str:
    """Corpus BLEU of ``source`` (row_id, g, prediction, refs): grams are unnested and counted."""
    group = "g"
    out = f"g AS {by}, " if by else ""
    return f"""
  WITH src AS ({source}),
  preds AS (SELECT row_id, {group}, {_bleu_tokens("prediction")} AS t FROM src),
  refs0 AS (SELECT row_id, {group}, generate_subscripts(refs, 1) AS ref_no, unnest(refs) AS ref FROM src),
  refs AS (SELECT row_id, {group}, ref_no, {_bleu_tokens("ref")} AS t FROM refs0),
  orders(n) AS (VALUES (1), (2), (3), (4)),
  ptok AS (SELECT row_id, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM preds),
  pwin AS (SELECT row_id, w AS g1, {_lead(2)} AS g2, {_lead(3)} AS g3, {_lead(4)} AS g4
      FROM ptok WINDOW win AS (PARTITION BY row_id ORDER BY i)),
  pg AS (SELECT row_id, n, gram, count(*) AS c FROM ({_stack("pwin", "row_id")}) WHERE gram IS NOT NULL GROUP BY ALL),
  rtok AS (SELECT row_id, ref_no, unnest(t) AS w, generate_subscripts(t, 1) AS i FROM refs),
  rwin AS (SELECT row_id, ref_no, w AS g1, {_lead(2)} AS g2, {_lead(3)} AS g3, {_lead(4)} AS g4
      FROM rtok WINDOW win AS (PARTITION BY row_id, ref_no ORDER BY i)),
  rg AS (SELECT row_id, n, gram, max(c) AS c FROM (
      SELECT row_id, ref_no, n, gram, count(*) AS c FROM ({_stack("rwin", "row_id, ref_no")})
      WHERE gram IS NOT NULL GROUP BY ALL) GROUP BY ALL),
  matched AS (SELECT s.{group}, p.n, sum(least(p.c, r.c)) AS m
      FROM pg p JOIN rg r USING (row_id, n, gram) JOIN src s USING (row_id) GROUP BY ALL),
  totals AS (SELECT {group}, n, sum(greatest(len(t) - n + 1, 0)) AS total FROM preds, orders GROUP BY ALL),
  closest AS (SELECT p.row_id, p.{group}, len(p.t) AS sys,
      (min(struct_pack(gap := abs(len(r.t) - len(p.t)), l := len(r.t)))).l AS ref
      FROM preds p JOIN refs r USING (row_id) GROUP BY p.row_id, p.{group}, len(p.t)),
  lengths AS (SELECT {group}, sum(sys) AS sys, sum(ref) AS ref FROM closest GROUP BY ALL),
  stats AS (SELECT t.{group}, t.n, t.total, coalesce(m.m, 0) AS m,
      sum((coalesce(m.m, 0) = 0)::INT) OVER (PARTITION BY t.{group} ORDER BY t.n) AS misses
      FROM totals t LEFT JOIN matched m ON m.{group} = t.{group} AND m.n = t.n),
  scores AS (SELECT {group}, sum(m) AS hits, min(total) AS least_total,
      avg(CASE WHEN total = 0 THEN NULL WHEN m > 0 THEN ln(100.0 * m / total) ELSE ln(100.0 / (power(2, misses) * total)) END) AS mean_log
      FROM stats GROUP BY ALL)
  SELECT {out}round(CASE WHEN hits = 0 OR least_total = 0 THEN 0.0
      ELSE (CASE WHEN sys < ref THEN exp(1 - ref / sys) ELSE 1.0 END) * exp(mean_log) END, 6) AS bleu
  FROM scores JOIN lengths USING ({group})"""


def _stem_steps(source: str) -> str:
    """CTEs from ``source`` (token) to stems (token, stem): a step of the stemmer each, on the word and its consonants and vowels."""
    shape = """list_reduce(list_prepend('', string_split(w, '')), lambda a, c: a || CASE
      WHEN c IN ('a', 'e', 'i', 'o', 'u') OR (c = 'y' AND right(a, 1) = 'c') THEN 'v' ELSE 'c' END)"""

    def ends(*suffixes: str) -> str:
        return f"regexp_matches(w, '({'|'.join(suffixes)})$')"

    def cut(n: int, x: str = "w") -> str:
        return f"left({x}, len(w) - {n})"

    def measure(n: int) -> str:
        return f"len(regexp_extract_all({cut(n, 's')}, 'vc'))"

    def short_end(word: str, s: str) -> str:
        return f"(({s} LIKE '%cvc' AND right({word}, 1) NOT IN ('w', 'x', 'y')) OR {s} = 'vc')"

    def swap(table) -> str:
        cases = " ".join(f"WHEN {ends(old)} THEN CASE WHEN {measure(len(old))} > 0 THEN {cut(len(old))} || '{new}' ELSE w END" for old, new in table)
        return f"CASE {cases} ELSE w END"

    step4 = " ".join(
        f"WHEN {ends(x)} THEN CASE WHEN {measure(len(x))} > 1{" AND right(" + cut(3) + ", 1) IN ('s', 't')" if x == "ion" else ""} THEN {cut(len(x))} ELSE w END"
        for x in STEP4_LONGEST_FIRST
    )
    steps = [
        f"CASE WHEN {ends('ies')} AND len(w) = 4 THEN {cut(1)} WHEN {ends('sses', 'ies')} THEN {cut(2)} WHEN {ends('s')} AND NOT {ends('ss')} THEN {cut(1)} ELSE w END",
        f"""CASE WHEN {ends('ied')} THEN CASE WHEN len(w) = 4 THEN {cut(1)} ELSE {cut(2)} END
          WHEN {ends('eed')} THEN CASE WHEN {measure(3)} > 0 THEN {cut(1)} ELSE w END
          WHEN {ends('ed')} AND contains({cut(2, 's')}, 'v') THEN {cut(2)} || '+'
          WHEN {ends('ing')} AND contains({cut(3, 's')}, 'v') THEN {cut(3)} || '+' ELSE w END""",
        # a plus marks what lost "ed" or "ing"
        f"""CASE WHEN w NOT LIKE '%+' THEN w
          WHEN regexp_matches(w, '(at|bl|iz)[+]$') THEN {cut(1)} || 'e'
          WHEN len(w) > 2 AND w[-2] = w[-3] AND s[-2] = 'c' THEN CASE WHEN w[-2] IN ('l', 's', 'z') THEN {cut(1)} ELSE {cut(2)} END
          WHEN {measure(1)} = 1 AND {short_end(cut(1), cut(1, 's'))} THEN {cut(1)} || 'e' ELSE {cut(1)} END""",
        f"CASE WHEN {ends('y')} AND len(w) > 2 AND s[-2] = 'c' THEN {cut(1)} || 'i' ELSE w END",
        f"CASE WHEN {ends('alli')} AND {measure(4)} > 0 THEN {cut(2)} ELSE w END",
        f"CASE WHEN {ends('logi')} AND {measure(3)} > 0 THEN {cut(1)} ELSE {swap(STEP2)} END",
        swap(STEP3),
        f"CASE {step4} ELSE w END",
        f"CASE WHEN {ends('e')} AND ({measure(1)} > 1 OR ({measure(1)} = 1 AND NOT {short_end(cut(1), cut(1, 's'))})) THEN {cut(1)} ELSE w END",
        f"CASE WHEN {ends('ll')} AND {measure(1)} > 1 THEN {cut(1)} ELSE w END",
    ]
    ctes = [f"stem0 AS (SELECT token, w, {shape} AS s FROM (SELECT token, token AS w FROM {source}))"]
    for i, step in enumerate(steps, 1):
        ctes.append(f"stem{i} AS (SELECT token, w, {shape} AS s FROM (SELECT token, {step} AS w FROM stem{i - 1}))")
    irregular = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in IRREGULAR.items())
    return ",\n  ".join([*ctes, f"stems AS (SELECT token, CASE token {irregular} ELSE w END AS stem FROM stem{len(steps)})"])


def _rouge_tokens(stemmed: bool) -> str:
    """CTEs p and r: (conv_id, turn, t), the tokens of predictions and references."""
    plain = f"""pairs AS ({_PAIRS}),
  raw AS (SELECT conv_id, turn, regexp_extract_all(lower(prediction), '[a-z0-9]+') AS p,
      regexp_extract_all(lower(reference), '[a-z0-9]+') AS r FROM pairs)"""
    if not stemmed:
        return f"{plain}, p AS (SELECT conv_id, turn, p AS t FROM raw), r AS (SELECT conv_id, turn, r AS t FROM raw)"

    def listed(side: str) -> str:
        return f"""{side}_words AS (SELECT conv_id, turn, unnest({side}) AS token, generate_subscripts({side}, 1) AS i FROM raw),
  {side}_stems AS (SELECT conv_id, turn, list(coalesce(stem, token) ORDER BY i) AS t FROM {side}_words LEFT JOIN stems USING (token) GROUP BY ALL),
  {side} AS (SELECT conv_id, turn, coalesce(t, []) AS t FROM raw LEFT JOIN {side}_stems USING (conv_id, turn))"""

    words = "known AS (SELECT DISTINCT token FROM (SELECT unnest(list_concat(p, r)) AS token FROM raw) WHERE len(token) > 3)"
    return ",\n  ".join([plain, words, _stem_steps("known"), listed("p"), listed("r")])


def _rouge_n(n: int, stemmed: bool = False) -> str:
    name = f"rouge{n}"
    grams = f"list_transform(range(1, len(t) - {n} + 2), lambda i: array_to_string(t[i:i + {n} - 1], ' '))"
    return f"""
  WITH {_rouge_tokens(stemmed)},
  pg AS (SELECT conv_id, turn, gram, count(*) AS c FROM (SELECT conv_id, turn, unnest({grams}) AS gram FROM p) GROUP BY ALL),
  rg AS (SELECT conv_id, turn, gram, count(*) AS c FROM (SELECT conv_id, turn, unnest({grams}) AS gram FROM r) GROUP BY ALL),
  o AS (SELECT conv_id, turn, sum(least(pg.c, rg.c)) AS m FROM pg JOIN rg USING (conv_id, turn, gram) GROUP BY ALL),
  s AS (SELECT coalesce(m, 0) / greatest(len(p.t) - {n} + 1, 1) AS pr, coalesce(m, 0) / greatest(len(r.t) - {n} + 1, 1) AS re
        FROM p JOIN r USING (conv_id, turn) LEFT JOIN o USING (conv_id, turn))
  SELECT round(avg(pr), 6) AS {name}_precision, round(avg(re), 6) AS {name}_recall,
    round(avg(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0.0 END), 6) AS {name}_fmeasure FROM s"""


def _rouge_l(stemmed: bool = False) -> str:
    """The table of the subsequence program, one row of it per recursion step."""
    return f"""
  WITH RECURSIVE {_rouge_tokens(stemmed)},
  t AS (SELECT row_number() OVER (ORDER BY conv_id, turn) AS id, p.t AS p, r.t AS r FROM p JOIN r USING (conv_id, turn)),
  walk AS (SELECT id, 0 AS i, list_transform(range(len(r) + 1), lambda j: 0::BIGINT) AS cells FROM t
      UNION ALL
      SELECT w.id, w.i + 1, list_reduce(list_transform(range(1, len(t.r) + 1), lambda j: [j]),
        lambda acc, j: list_append(acc, CASE WHEN t.p[w.i + 1] = t.r[j[1]] THEN w.cells[j[1]] + 1
          ELSE greatest(w.cells[j[1] + 1], acc[j[1]]) END), [0::BIGINT])
      FROM walk w JOIN t USING (id) WHERE w.i < len(t.p)),
  s AS (SELECT w.cells[-1] / greatest(len(t.p), 1) AS pr, w.cells[-1] / greatest(len(t.r), 1) AS re
      FROM t JOIN walk w ON w.id = t.id AND w.i = len(t.p))
  SELECT round(avg(pr), 6) AS "rougeL_precision", round(avg(re), 6) AS "rougeL_recall",
    round(avg(CASE WHEN pr + re > 0 THEN 2 * pr * re / (pr + re) ELSE 0.0 END), 6) AS "rougeL_fmeasure" FROM s"""


_ROUGE_STEMMED = f"SELECT * FROM ({_rouge_n(1, True)}), ({_rouge_n(2, True)}), ({_rouge_l(True)})"


def _all_text_metrics(stemmed: bool = False) -> str:
    pairs = f"SELECT conv_id * 1000 + turn AS row_id, 0 AS g, [reference] AS refs, prediction FROM ({_PAIRS})"
    exact = f"""SELECT round(avg((p = r)::INT), 6) AS exact_match, count(*)::DOUBLE AS total_examples,
        sum((p = r)::INT)::DOUBLE AS correct_examples
      FROM (SELECT {_answer("prediction")} AS p, {_answer("reference")} AS r FROM ({_PAIRS}))"""
    shares = ("precision", "recall", "fmeasure")
    parts = {
        "a": (_rouge_n(1, stemmed), [f"rouge1_{m}" for m in shares]),
        "b": (_rouge_n(2, stemmed), [f"rouge2_{m}" for m in shares]),
        "c": (_rouge_l(stemmed), [f"rougeL_{m}" for m in shares]),
        "d": (_bleu(pairs), ["bleu"]),
        "e": (exact, ["exact_match", "total_examples", "correct_examples"]),
    }
    ctes = ", ".join(f"{name} AS ({sql})" for name, (sql, _) in parts.items())
    rows = [f"SELECT '{m}' AS metric, \"{m}\"::DOUBLE AS value FROM {name}" for name, (_, ms) in parts.items() for m in ms]
    return f"WITH {ctes} " + " UNION ALL ".join(rows)


def _pick(options: tuple[str, ...], id_col: str, purpose: str) -> str:
    values = ", ".join("'" + o.replace("'", "''") + "'" for o in options)
    number = f"('0x' || substr(md5('42-' || {id_col}::VARCHAR || '-{purpose}'), 1, 7))::BIGINT"
    return f"([{values}])[({number} % {len(options)} + 1)::INT]"


def _encoded(select: str) -> str:
    length = ENCODED_LENGTH
    return f"""
  WITH vocabulary AS (SELECT DISTINCT token, (('0x' || substr(md5(token), 1, 7))::BIGINT % {VOCABULARY_IDS} + 2)::INT AS token_id
      FROM (SELECT unnest(string_split({_strip("text")}, ' ')) AS token FROM documents) WHERE token <> ''),
  words AS (SELECT doc_id, 0 AS side, ({_words("text")})[1:{length}] AS w FROM documents
      UNION ALL SELECT doc_id, 1, ({_words("source")})[1:{length}] FROM documents),
  ids AS (SELECT doc_id, side, list(coalesce(token_id, 1) ORDER BY pos) AS ids FROM (
      SELECT doc_id, side, unnest(w) AS token, generate_subscripts(w, 1) AS pos FROM words) LEFT JOIN vocabulary USING (token)
      GROUP BY ALL),
  both_sides AS (SELECT d.doc_id, coalesce(a.ids, []) AS a, coalesce(b.ids, []) AS b FROM documents d
      LEFT JOIN ids a ON a.doc_id = d.doc_id AND a.side = 0 LEFT JOIN ids b ON b.doc_id = d.doc_id AND b.side = 1)
  {select}"""


_ENCODED_LISTS = _encoded(f"""SELECT doc_id AS sample_id,
    array_to_string(list_concat(list_transform(range({ENCODED_LENGTH} - len(a)), lambda i: 0), a), ' ') AS input_ids,
    array_to_string(list_concat(list_transform(range({ENCODED_LENGTH} - len(a)), lambda i: 0), list_transform(a, lambda i: 1)), ' ') AS attention_mask,
    array_to_string(list_concat(list_transform(range({ENCODED_LENGTH} - len(b)), lambda i: 0), b), ' ') AS labels
  FROM both_sides""")

_METRIC_VALUES = """
  SELECT model, metric, round(avg(value), 6) AS value FROM (
    SELECT CASE WHEN k < 33 THEN 'small' WHEN k < 66 THEN 'medium' ELSE 'large' END AS model,
      CASE event_type WHEN 'view' THEN 'rouge1_fmeasure' WHEN 'click' THEN 'perplexity' WHEN 'error' THEN 'accuracy'
        WHEN 'signup' THEN 'total_examples' ELSE 'bleu' END AS metric, value
    FROM (SELECT *, regexp_extract(props, '[0-9]+')::INT AS k FROM events))
  WHERE NOT (model = 'large' AND metric = 'bleu') GROUP BY ALL"""


def _comparison(higher: str, where: str) -> str:
    return f"""
  WITH mv AS ({_METRIC_VALUES}),
  common AS (SELECT metric FROM mv WHERE {where} GROUP BY metric
      HAVING count(DISTINCT model) = (SELECT count(DISTINCT model) FROM mv)),
  ranked AS (SELECT metric, model, value,
      row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric IN ({higher}) THEN -value ELSE value END, model) AS b,
      row_number() OVER (PARTITION BY metric ORDER BY CASE WHEN metric IN ({higher}) THEN value ELSE -value END, model) AS w
      FROM mv JOIN common USING (metric))
  SELECT metric, max(model) FILTER (b = 1) AS best_model, max(value) FILTER (b = 1) AS best_value,
    max(model) FILTER (w = 1) AS worst_model, max(value) FILTER (w = 1) AS worst_value FROM ranked GROUP BY metric"""


def _running_best(better: str, fn: str) -> str:
    return f"""SELECT run_id, log_seq, eval_loss,
    {fn}(eval_loss) OVER (PARTITION BY run_id ORDER BY log_seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prior,
    eval_loss IS NOT NULL AND coalesce(eval_loss {better} prior, true) AS is_best
  FROM ({_LOG})"""


# strikes by walking each run's evaluations one at a time
_STRIKES = f"""
  WITH RECURSIVE log AS ({_LOG}),
  evals AS (SELECT run_id, log_seq, eval_loss AS v, row_number() OVER (PARTITION BY run_id ORDER BY log_seq) AS k
      FROM log WHERE eval_loss IS NOT NULL),
  walk AS (
      SELECT run_id, log_seq, v, k, v AS best, 0 AS strikes FROM evals WHERE k = 1
      UNION ALL
      SELECT e.run_id, e.log_seq, e.v, e.k, least(w.best, e.v),
        CASE WHEN e.v < w.best AND abs(e.v - w.best) > 0.5 THEN 0 ELSE w.strikes + 1 END
      FROM walk w JOIN evals e ON e.run_id = w.run_id AND e.k = w.k + 1)"""

_SUMMARY = f"""SELECT run_id, count(*) AS n_entries, arg_max(step, log_seq) AS total_steps,
    last(train_loss ORDER BY log_seq) AS final_train_loss, last(eval_loss ORDER BY log_seq) AS final_eval_loss,
    min(eval_loss) AS best_eval_loss, max(total_time) AS total_time_seconds
  FROM ({_LOG}) GROUP BY run_id"""

_ROUNDTRIP = f"SELECT doc_id AS sample_id, {_strip('text')} AS text, {_strip('lang')} AS label FROM documents"

_SHARES = """count(*) AS n_prompts, count(output) AS n_success,
    round(avg((output IS NOT NULL)::INT), 6) AS success_rate"""


def _exact(by: str, lower: bool) -> str:
    keys, group = (f"{by}, ", f"GROUP BY {by}") if by else ("", "")
    return f"""SELECT {keys}round(avg((p = r)::INT), 6) AS exact_match, count(*) AS total_examples,
    sum((p = r)::INT)::BIGINT AS correct_examples
  FROM (SELECT lang, {_answer("prediction", lower)} AS p, {_answer("reference", lower)} AS r FROM ({_ALTERED})) {group}"""



ORACLES: dict[str, str] = {
    "clean_text_default": f"""SELECT doc_id AS sample_id, {_collapse('text')} AS text, {_collapse('lang')} AS label
  FROM documents WHERE {_collapse('text')} <> ''""",
    "clean_text_max200": f"""SELECT doc_id, text FROM (
    SELECT doc_id, CASE WHEN length(t) < 50 THEN ''
      WHEN length(t) > 200 THEN trim(regexp_replace(substring(t, 1, 200), ' [^ ]*$', ''), ' ') ELSE t END AS text
    FROM (SELECT doc_id, lower({_collapse('text')}) AS t FROM documents)) WHERE text <> ''""",
    "clean_counts": f"""SELECT count(*) AS n_before,
    count(*) FILTER (length({_collapse('text')}) >= 300) AS n_after FROM documents""",
    "word_char_counts": f"""SELECT doc_id, len({_words('text')})::INT AS n_words, length(text)::INT AS n_characters FROM documents""",
    "render_template": "SELECT doc_id, 'Category: ' || lang || '. Description: ' || text AS text FROM documents",
    "split_hash": f"""SELECT doc_id, CASE WHEN k < 'cccccccc' THEN 'train' WHEN k < 'e6666666' THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT doc_id, substr({_key('doc_id')}, 1, 8) AS k FROM documents)""",
    "split_hash_counts": f"""SELECT split, count(*) AS n_rows FROM (
    SELECT CASE WHEN k < 'cccccccc' THEN 'train' WHEN k < 'e6666666' THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT substr({_key('doc_id')}, 1, 8) AS k FROM documents)) GROUP BY split""",
    "split_exact": _split_cte("(SELECT doc_id, lang FROM documents)", "doc_id", 0.7, 0.17),
    "split_exact_counts": f"SELECT split, count(*) AS n_rows FROM ({_split_cte('documents', 'doc_id', 0.7, 0.17)}) GROUP BY split",
    "split_exact_large": f"""SELECT split, count(*) AS n_rows FROM ({_split_cte(
        '(SELECT o_orderkey FROM orders)', 'o_orderkey', 0.8, 0.1)}) GROUP BY split""",
    "first_k_per_split": f"""SELECT doc_id, text, source, split FROM (
    SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS place FROM ({_split_cte('documents', 'doc_id', 0.8, 0.1)}))
  WHERE place <= 10""",
    "sample_exact": f"SELECT doc_id, n_chars FROM documents ORDER BY {_key('doc_id', 7)}, doc_id LIMIT 250",
    "batch_numbers": f"""SELECT doc_id, ((row_number() OVER (ORDER BY {_key('doc_id')}, doc_id) - 1) // 8)::BIGINT AS batch FROM documents""",
    "prepared_dataset": f"""WITH cleaned AS (SELECT doc_id, {_collapse('text')} AS text FROM documents WHERE length({_collapse('text')}) >= 300)
  SELECT split, count(*) AS n_rows, sum(length(text))::BIGINT AS n_characters
  FROM ({_split_cte('cleaned', 'doc_id', 0.8, 0.1)}) GROUP BY split""",
    "prepared_dataset_limited": f"""WITH limited AS (SELECT * FROM documents ORDER BY {_key('doc_id')}, doc_id LIMIT 600),
  cleaned AS (SELECT doc_id, {_collapse('text')} AS text FROM limited WHERE length({_collapse('text')}) >= 300)
  SELECT split, count(*) AS n_rows, sum(length(text))::BIGINT AS n_characters
  FROM ({_split_cte('cleaned', 'doc_id', 0.8, 0.1)}) GROUP BY split""",
    "data_summary": f"""SELECT 'documents' AS input_source, true AS clean_data,
    count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation,
    count(*) FILTER (split = 'test') AS test FROM ({_split_cte('documents', 'doc_id', 0.8, 0.1)})""",
    "report_file": f"""SELECT 'documents' AS input_source, true AS clean_data,
    count(*) FILTER (split = 'train') AS train, count(*) FILTER (split = 'validation') AS validation,
    count(*) FILTER (split = 'test') AS test FROM ({_split_cte('documents', 'doc_id', 0.8, 0.1)})""",
    "inspection_files": f"""SELECT doc_id, text, source, split FROM (
    SELECT *, row_number() OVER (PARTITION BY split ORDER BY doc_id) AS place FROM ({_split_cte('documents', 'doc_id', 0.8, 0.1)}))
  WHERE place <= 10""",
    "metric_report": f"""SELECT row_number() OVER (ORDER BY k, line) - 1 AS line_no, line FROM (
    SELECT 0 AS k, 'Evaluation' AS line UNION ALL SELECT 1, '{'=' * RULE_WIDTH}' UNION ALL SELECT 2, '' UNION ALL SELECT 3, 'Task: events'
    UNION ALL SELECT 4, '' UNION ALL SELECT 5, 'Metrics:'
    UNION ALL SELECT 6, printf('  %s: %.4f', event_type, avg(value)) FROM events GROUP BY event_type)""",
    "roundtrip_csv": _ROUNDTRIP,
    "roundtrip_tsv": _ROUNDTRIP,
    "roundtrip_json": _ROUNDTRIP,
    "roundtrip_jsonl": _ROUNDTRIP,
    "jsonl_quarantine": """SELECT reason, count(*) AS n_rows FROM (
    SELECT CASE WHEN lang = 'en' THEN 'ok' WHEN lang = 'fr' AND n_chars > 1500 THEN 'text is null'
      WHEN lang = 'fr' THEN 'text key missing' ELSE 'not a JSON object' END AS reason FROM documents) GROUP BY reason""",
    "stream_jsonl_quarantine": """SELECT reason, count(*) AS n_rows FROM (
    SELECT CASE WHEN lang = 'en' THEN 'ok' WHEN lang = 'fr' AND n_chars > 1500 THEN 'text is null'
      WHEN lang = 'fr' THEN 'text key missing' ELSE 'not a JSON object' END AS reason FROM documents) GROUP BY reason""",
    "prompt_lines": f"""SELECT prompt, count(*) AS n_rows FROM (
    SELECT {_strip('line')} AS prompt FROM (SELECT unnest(regexp_split_to_array(text, '\\r\\n|\\r|\\n')) AS line FROM conversations))
  WHERE prompt <> '' GROUP BY prompt""",
    "sample_exact_string_ids": "SELECT 'u-' || doc_id AS key, n_chars FROM documents ORDER BY md5('42-u-' || doc_id) LIMIT 300",
    "split_exact_repeated_ids": """SELECT user_id, event_id, CASE WHEN rk <= floor(n * 0.6::DOUBLE) THEN 'train'
      WHEN rk <= floor(n * 0.6::DOUBLE) + floor(n * 0.3::DOUBLE) THEN 'validation' ELSE 'test' END AS split
    FROM (SELECT user_id, event_id, count(*) OVER () AS n,
      row_number() OVER (ORDER BY md5('42-' || user_id) || md5(event_id::VARCHAR)) AS rk FROM events)""",
    "load_named_path": "SELECT doc_id, text, lang AS label FROM documents",
    "directory_scan": _ROUNDTRIP,
    "suffix_dispatch": _ROUNDTRIP,
    "json_values": """SELECT doc_id::VARCHAR AS sample_id, CASE doc_id % 3 WHEN 0 THEN doc_id::VARCHAR WHEN 1 THEN 'true'
      ELSE '{"n":' || n_chars || '}' END AS text, '[1,2.5]' AS label FROM documents""",
    "listing_report": """WITH n AS (SELECT *, row_number() OVER (ORDER BY doc_id) AS number FROM documents)
  SELECT line, count(*) AS n_lines FROM (SELECT 'Example ' || number || ':' AS line FROM n UNION ALL SELECT 'Input: ' || source FROM n
    UNION ALL SELECT 'Local Output: ' || lang FROM n UNION ALL SELECT repeat('-', 80) FROM n) GROUP BY line""",
    "retry_attempts": "SELECT doc_id AS prompt_id, length(text)::VARCHAR AS output, 2 AS attempts, NULL::VARCHAR AS error FROM documents",
    "pair_strict": "SELECT doc_id AS row_id, lang AS prediction, source AS reference FROM documents",
    "compare_models_null_value": _comparison("'rouge1_fmeasure', 'accuracy', 'bleu'", "metric NOT IN ('total_examples', 'accuracy')"),
    "evaluate_by_model": """WITH scored AS (SELECT lang AS reference, CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'odd' END AS model,
      CASE WHEN source LIKE '%9' THEN NULL WHEN source LIKE '%3' THEN 'fr' ELSE 'en' END AS prediction FROM documents),
  graded AS (SELECT * FROM scored WHERE prediction IS NOT NULL),
  sides AS (SELECT model, reference AS class, 1 AS support, 0 AS predicted, (reference = prediction)::INT AS hit FROM graded
      UNION ALL SELECT model, prediction, 0, 1, 0 FROM graded),
  sums AS (SELECT model, class, sum(support) AS support, sum(predicted) AS predicted, sum(hit) AS hit FROM sides GROUP BY ALL),
  pr AS (SELECT *, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0.0 END AS p, CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS r FROM sums),
  wide AS (SELECT model, sum(hit) / sum(support) AS a, sum(p * support) / sum(support) AS p, sum(r * support) / sum(support) AS r,
      sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support) AS f FROM pr GROUP BY model)
  SELECT model, 'accuracy' AS metric, round(a, 6)::DOUBLE AS value FROM wide UNION ALL SELECT model, 'precision', round(p, 6) FROM wide
  UNION ALL SELECT model, 'recall', round(r, 6) FROM wide UNION ALL SELECT model, 'f1', round(f, 6) FROM wide
  UNION ALL SELECT model, 'success_rate', round(avg((prediction IS NOT NULL)::INT), 6) FROM scored GROUP BY model""",
    "read_split_present": f"SELECT * FROM ({_split_cte('(SELECT doc_id, text FROM documents)', 'doc_id', 0.8, 0.1)}) WHERE split = 'validation'",
    "read_split_fallback": f"SELECT * FROM ({_split_cte('(SELECT doc_id, text FROM documents)', 'doc_id', 0.5, 0.5)}) WHERE split = 'train'",
    "named_dataset": "SELECT doc_id, text, source AS label, lang FROM documents",
    "resolved_dataset": f"""SELECT doc_id, text, lang AS label, split FROM ({_split_cte('documents', 'doc_id', 0.8, 0.1)})
  WHERE split = 'test' ORDER BY {_key('doc_id')}, doc_id LIMIT 40""",
    "synthetic_classification": f"""SELECT doc_id AS sample_id, {_pick(CHOICES['classification'][0], 'doc_id', 'text')} AS text,
    {_pick(CHOICES['classification'][1], 'doc_id', 'label')} AS label FROM documents""",
    "synthetic_completion": f"""SELECT text, label, count(*) AS n_rows FROM (
    SELECT {_pick(CHOICES['completion'][0], 'o_orderkey', 'text')} AS text,
      {_pick(CHOICES['completion'][1], 'o_orderkey', 'label')} AS label FROM orders) GROUP BY text, label""",
    "prompt_pairs": _PAIRS,
    "pairing_report": """SELECT count(*) FILTER (l.doc_id IS NOT NULL AND d.doc_id IS NULL) AS n_without_reference,
    count(*) FILTER (l.doc_id IS NULL AND d.doc_id IS NOT NULL) AS n_without_prediction,
    (count(*) - count(DISTINCT coalesce(d.doc_id, l.doc_id)))::BIGINT AS n_repeated,
    count(*) FILTER (l.doc_id IS NOT NULL AND d.doc_id IS NOT NULL) AS n_paired
  FROM documents d FULL JOIN labels l ON d.doc_id = l.doc_id""",
    "continuations": f"SELECT conv_id, turn, reference || ' ' || prediction AS text FROM ({_PAIRS})",
    "outputs_side_by_side": """SELECT event_id AS prompt_id, CASE WHEN event_type = 'click' THEN props END AS click,
    CASE WHEN event_type = 'error' THEN props END AS error, CASE WHEN event_type = 'purchase' THEN props END AS purchase,
    CASE WHEN event_type = 'signup' THEN props END AS signup, CASE WHEN event_type = 'view' THEN props END AS view FROM events""",
    "inference_listing": f"""SELECT d.doc_id AS prompt_id, d.source AS input, len({_words('d.text')})::INT AS local_output_length,
    CASE WHEN l.quality = 1 THEN 'good text' END AS remote_output, CASE WHEN l.quality = 1 THEN 2 END AS remote_output_length
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "exact_match": _exact("", True),
    "exact_match_by_lang": _exact("lang", False),
    "rouge1": _rouge_n(1),
    "rouge2": _rouge_n(2),
    "rouge_l": _rouge_l(),
    "rouge_stemmed": _ROUGE_STEMMED,
    "all_text_metrics": _all_text_metrics(),
    "all_text_metrics_stemmed": _all_text_metrics(stemmed=True),
    "bleu_corpus": _bleu(
        "SELECT doc_id AS row_id, 0 AS g, [text] AS refs, regexp_replace(text, ' [a-zA-Z]{2} ', ' ', 'g') AS prediction FROM documents"
    ),
    "bleu_by_group": _bleu(
        f"SELECT conv_id * 1000 + turn AS row_id, lower(substring(reference, 1, 1)) AS g, [reference] AS refs, prediction FROM ({_PAIRS})",
        by="first",
    ),
    "bleu_two_references": _bleu(
        f"""SELECT conv_id * 1000 + turn AS row_id, 0 AS g,
          [reference, array_to_string(list_reverse(string_split(prediction, ' ')), ' ')] AS refs, prediction FROM ({_PAIRS})"""
    ),
    "confusion": f"SELECT reference, prediction, count(*) AS n FROM ({_GRADED}) GROUP BY ALL",
    "classification_weighted": f"{_class_report()} SELECT {_WEIGHTED} FROM report",
    "classification_by_lang": f"{_class_report('lang')} SELECT lang, {_WEIGHTED} FROM report GROUP BY lang",
    "classification_per_class": f"""{_class_report()} SELECT class, round(precision, 6) AS precision,
    round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM report""",
    "classification_with_labels": f"""{_class_report()} SELECT {_WEIGHTED}, """
    + ", ".join(
        f"round(coalesce(max({m}) FILTER (class = '{c}'), 0.0), 6) AS {m}_{c}"
        for c in ("q1t0", "q0t1", "absent")
        for m in ("precision", "recall", "f1")
    )
    + " FROM report",
    "metric_union": f"""{_class_report()},
  wide AS (SELECT {_WEIGHTED} FROM report),
  em AS (SELECT avg(({_answer('prediction')} = {_answer('reference')})::INT) AS share, count(*) AS n,
         sum(({_answer('prediction')} = {_answer('reference')})::INT) AS hits FROM graded)
  SELECT 'accuracy' AS metric, accuracy::DOUBLE AS value FROM wide UNION ALL SELECT 'precision', precision FROM wide
  UNION ALL SELECT 'recall', recall FROM wide UNION ALL SELECT 'f1', f1 FROM wide
  UNION ALL SELECT 'exact_match', round(share, 6) FROM em UNION ALL SELECT 'total_examples', n::DOUBLE FROM em
  UNION ALL SELECT 'correct_examples', hits::DOUBLE FROM em""",
    "perplexity_logits": """SELECT round(exp(avg(ce)), 6) AS perplexity, count(ce) AS n_positions FROM (
    SELECT m + ln(list_sum(list_transform(e, lambda x: exp(x - m)))) - e[label + 1] AS ce FROM (
      SELECT e, label, list_max(e) AS m FROM (SELECT embedding::DOUBLE[] AS e, label FROM embeddings WHERE label <> 0)))""",
    "perplexity_wide_logits": """SELECT round(exp(avg(ce)), 6) AS perplexity, count(ce) AS n_positions FROM (
    SELECT m + ln(782 * list_sum(list_transform(e, lambda x: exp(x - m)))) - e[label + 1] AS ce FROM (
      SELECT e, label, list_max(e) AS m FROM (SELECT embedding::DOUBLE[] AS e, label FROM embeddings WHERE label <> 0)))""",
    "pair_by_position": """SELECT position, prediction, reference
  FROM (SELECT row_number() OVER (ORDER BY doc_id) - 1 AS position, lang AS prediction FROM documents)
  JOIN (SELECT row_number() OVER (ORDER BY md5(doc_id::VARCHAR), doc_id) - 1 AS position, source AS reference FROM documents) USING (position)""",
    "csv_by_blocks": f"""SELECT doc_id AS sample_id, md5(replace({_strip("text")}, chr(10), ' ')) AS text_md5, lang AS label FROM documents""",
    "json_by_blocks": """SELECT doc_id AS sample_id, md5('}"' || chr(10) || text || '{') AS text_md5, lang AS label FROM documents""",
    "complete_ledger": """SELECT doc_id AS prompt_id, CASE WHEN text IN (SELECT text FROM documents WHERE lang = 'en') THEN 'first ' ELSE 'second ' END || md5(text) AS output,
    NULL::VARCHAR AS error FROM documents""",
    "latest_checkpoint_folder": """SELECT 'run' || s_nationkey AS run_id, 'run' || s_nationkey || '/checkpoint-' || max(s_suppkey) AS path, max(s_suppkey)::BIGINT AS step
  FROM supplier GROUP BY s_nationkey""",
    "perplexity_weighted": """SELECT round(exp(sum(value / 100 * user_id) / sum(user_id)), 6) AS perplexity,
    round(sum(value / 100 * user_id) / sum(user_id), 6) AS avg_loss, sum(user_id)::BIGINT AS total_tokens FROM events""",
    "perplexity_by_type": """SELECT event_type, round(exp(sum(value / 100 * user_id) / sum(user_id)), 6) AS perplexity,
    round(sum(value / 100 * user_id) / sum(user_id), 6) AS avg_loss, sum(user_id)::BIGINT AS total_tokens
  FROM events GROUP BY event_type""",
    "compare_models": _comparison("'rouge1_fmeasure', 'accuracy', 'bleu'", "metric <> 'total_examples'"),
    "compare_models_strict": _comparison("'accuracy', 'bleu'", "true"),
    "success_rate": f"SELECT user_id, {_SHARES} FROM ({_OUTCOMES}) GROUP BY user_id",
    "length_table": f"""SELECT lang AS provider, 'Word Count' AS metric, sum(w)::BIGINT AS total, round(avg(w), 6) AS mean
    FROM (SELECT lang, len({_words('text')}) AS w FROM documents) GROUP BY lang
  UNION ALL SELECT lang, 'Character Count', sum(length(text))::BIGINT, round(avg(length(text)), 6) FROM documents GROUP BY lang""",
    "length_comparison": f"""SELECT conv_id * 1000 + turn AS prompt_id, 'Word Count' AS metric,
    len({_words('prediction')})::INT AS prediction, len({_words('reference')})::INT AS reference FROM ({_PAIRS})
  UNION ALL SELECT conv_id * 1000 + turn, 'Character Count', length(prediction)::INT, length(reference)::INT FROM ({_PAIRS})""",
    "provider_fallback": f"""SELECT event_id, coalesce(nullif(l, ''), nullif(r, ''), nullif(s, '')) AS output,
    CASE WHEN l <> '' THEN 'local' WHEN r <> '' THEN 'remote' WHEN s <> '' THEN 'spare' END AS winner
  FROM (SELECT event_id, output AS l, CASE WHEN event_type = 'signup' THEN props END AS r,
    CASE WHEN user_id > 20 THEN 'spare' ELSE '' END AS s FROM ({_OUTCOMES}))""",
    "batch_complete": f"""SELECT item_id AS prompt_id, 'local' AS provider,
    CASE WHEN length(text) > 100 THEN {_strip("replace(text, 'a', 'A')")} END AS output, 1 AS attempts, NULL::VARCHAR AS error FROM benchmark""",
    "complete_fallback": f"""SELECT item_id AS prompt_id, CASE WHEN text LIKE 'T%' THEN 'questions' ELSE 'local' END AS provider,
    {_strip("CASE WHEN text LIKE 'T%' THEN text ELSE split_part(text, ' ', 1) END")} AS output, 1 AS attempts, NULL::VARCHAR AS error
  FROM benchmark""",
    "complete_paced": f"""SELECT item_id AS prompt_id, CASE WHEN text LIKE 'T%' THEN 'questions' ELSE 'local' END AS provider,
    {_strip("CASE WHEN text LIKE 'T%' THEN text ELSE split_part(text, ' ', 1) END")} AS output, 1 AS attempts, NULL::VARCHAR AS error
  FROM benchmark""",
    "evaluate_completions": """WITH scored AS (SELECT lang AS reference,
      CASE WHEN source LIKE '%9' THEN NULL WHEN source LIKE '%3' THEN 'fr' ELSE 'en' END AS prediction FROM documents),
  graded AS (SELECT * FROM scored WHERE prediction IS NOT NULL),
  sides AS (SELECT reference AS class, 1 AS support, 0 AS predicted, (reference = prediction)::INT AS hit FROM graded
      UNION ALL SELECT prediction, 0, 1, 0 FROM graded),
  sums AS (SELECT class, sum(support) AS support, sum(predicted) AS predicted, sum(hit) AS hit FROM sides GROUP BY class),
  pr AS (SELECT *, CASE WHEN predicted > 0 THEN hit / predicted ELSE 0.0 END AS p, CASE WHEN support > 0 THEN hit / support ELSE 0.0 END AS r FROM sums),
  wide AS (SELECT sum(hit) / sum(support) AS a, sum(p * support) / sum(support) AS p, sum(r * support) / sum(support) AS r,
      sum(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END * support) / sum(support) AS f FROM pr)
  SELECT 'accuracy' AS metric, round(a, 6)::DOUBLE AS value FROM wide UNION ALL SELECT 'precision', round(p, 6) FROM wide
  UNION ALL SELECT 'recall', round(r, 6) FROM wide UNION ALL SELECT 'f1', round(f, 6) FROM wide
  UNION ALL SELECT 'success_rate', round(avg((prediction IS NOT NULL)::INT), 6) FROM scored""",
    "encode_fixed_length": _ENCODED_LISTS,
    "encode_fixed_length_joined": _ENCODED_LISTS,
    "token_counts": _encoded("SELECT doc_id AS sample_id, len(a)::INT AS n_tokens FROM both_sides"),
    "running_best": f"""SELECT run_id, log_seq, is_best, CASE WHEN is_best THEN eval_loss ELSE prior END AS best_so_far
  FROM ({_running_best('<', 'min')})""",
    "running_best_highest": f"SELECT run_id, log_seq, eval_loss AS best FROM ({_running_best('>', 'max')}) WHERE is_best",
    "early_stop": f"""{_STRIKES}
  SELECT run_id, min(log_seq) FILTER (strikes >= 3) AS stop_at, arg_min(v, log_seq) FILTER (strikes >= 3) AS stop_value, count(v) AS n_evals
  FROM (SELECT run_id, log_seq, v, strikes FROM walk UNION ALL SELECT DISTINCT run_id, NULL::BIGINT, NULL::DOUBLE, 0 FROM log) GROUP BY run_id""",
    "last_known_metric": f"""SELECT run_id, log_seq,
    last_value(eval_loss IGNORE NULLS) OVER (PARTITION BY run_id ORDER BY log_seq) AS last_value FROM ({_LOG})""",
    "elapsed_time": f"""SELECT run_id, log_seq,
    round((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run_id)) / 1e6, 6) AS total_time,
    round((epoch_us(ts) - min(epoch_us(ts)) OVER (PARTITION BY run_id, epoch)) / 1e6, 6) AS epoch_time FROM ({_LOG})""",
    "training_summary": _SUMMARY,
    "metric_log_roundtrip": _SUMMARY,
    "latest_checkpoint": """SELECT run_id, arg_min(path, struct_pack(k := -step, p := path)) AS path, max(step)::BIGINT AS step FROM (
    SELECT o_custkey::VARCHAR AS run_id, CASE WHEN o_orderstatus = 'P' THEN 0 ELSE o_orderkey END AS step,
      '/runs/checkpoint-' || CASE WHEN o_orderstatus = 'P' THEN 'last' ELSE o_orderkey::VARCHAR END AS path FROM orders) GROUP BY run_id""",
    "stream_clean_split": f"""SELECT doc_id AS sample_id, md5({_collapse('text')}) AS text_md5,
    CASE WHEN k < 'cccccccc' THEN 'train' WHEN k < 'e6666666' THEN 'validation' ELSE 'test' END AS split
  FROM (SELECT doc_id, text, substr({_key('doc_id')}, 1, 8) AS k FROM documents) WHERE {_collapse('text')} <> ''""",
    "stream_success_rate": f"""SELECT user_id, {_SHARES} FROM (
    SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS output FROM events) GROUP BY user_id""",
    "stream_success_rate_batches": f"""SELECT user_id, {_SHARES} FROM (
    SELECT user_id, CASE WHEN event_type <> 'error' THEN event_type END AS output FROM events) GROUP BY user_id""",
    "stream_running_best": f"""{_STRIKES},
  best AS ({_running_best('<', 'min')})
  SELECT b.run_id, b.log_seq, is_best, CASE WHEN is_best THEN eval_loss ELSE prior END AS best_so_far,
    coalesce(last_value(w.strikes IGNORE NULLS) OVER (PARTITION BY b.run_id ORDER BY b.log_seq), 0)::BIGINT AS strikes, false AS is_late
  FROM best b LEFT JOIN walk w ON w.run_id = b.run_id AND w.log_seq = b.log_seq""",
    "stream_run_states": f"""{_STRIKES},
  best AS ({_running_best('<', 'min')})
  SELECT b.run_id, b.log_seq, is_best, CASE WHEN is_best THEN eval_loss ELSE prior END AS best_so_far,
    coalesce(last_value(w.strikes IGNORE NULLS) OVER (PARTITION BY b.run_id ORDER BY b.log_seq), 0)::BIGINT AS strikes, false AS is_late
  FROM best b LEFT JOIN walk w ON w.run_id = b.run_id AND w.log_seq = b.log_seq
  UNION ALL SELECT run_id, log_seq, NULL, NULL, NULL, true FROM log WHERE log_seq < 40""",
}
