"""The same results in plain SQL over the given tables, for every query that SQL can express."""

from __future__ import annotations

from modelyard.plans.catalog import CLASSES, EVALUATED_AT_LEAST, PROMPT, WIDTH


def _hash(key: str) -> str:
    return f"('0x' || substr(md5('42:' || {key}::varchar), 1, 15))::bigint"


# 0.2 * 2^60, rounded up.
_TEST_BELOW = 230584300921369396


def _dataset(key: str) -> str:
    return f"CASE WHEN {_hash(key)} < {_TEST_BELOW} THEN 'test' ELSE 'train' END"


MODELS = """models AS (
  SELECT 'm-' || c_custkey AS model_id, c_mktsegment AS name, c_custkey AS search_order FROM customer)"""

LOG = f"""log AS (
  SELECT 'r-' || strftime(ts, '%Y-%m-%d') AS run_id, 'm-' || user_id AS model_id, {_dataset('event_id')} AS dataset,
         event_type AS key, value, event_id % 101 AS step, event_id AS log_seq, ts
  FROM events)"""

REGISTRATIONS = """registrations AS (
  SELECT 'main.default.m' || o_custkey AS name, o_orderkey AS arrival, 'm-' || o_custkey AS model_id,
         o_orderdate < TIMESTAMP '1998-04-25 00:00:00' AS is_earlier
  FROM orders)"""

VERSIONS = f"""{REGISTRATIONS},
existing AS (
  SELECT name, arrival, model_id, row_number() OVER (PARTITION BY name ORDER BY arrival) AS version
  FROM registrations WHERE is_earlier),
fresh AS (
  SELECT r.name, r.arrival, r.model_id,
         row_number() OVER (PARTITION BY r.name ORDER BY r.arrival) + coalesce(t.taken, 0) AS version
  FROM registrations r
  LEFT JOIN (SELECT name, max(version) AS taken FROM existing GROUP BY name) t ON r.name = t.name
  WHERE NOT r.is_earlier)"""

GATE = f"""{REGISTRATIONS},
gate AS (
  SELECT name, arrival AS version, model_id,
         CASE arrival % 4 WHEN 0 THEN 'missing' WHEN 1 THEN 'approved' WHEN 2 THEN 'rejected'
              ELSE 'key_case_mismatch' END AS reason
  FROM registrations)"""

REGRESSION = f"""scored AS (
  SELECT 'm-' || l_suppkey AS model_id, {_dataset('l_orderkey')} AS dataset,
         l_extendedprice AS y, l_quantity * p_retailprice AS p
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

FEATURES = f"""features AS (
  SELECT vec_id, embedding, label, (label = 2)::int AS quality, {_dataset('vec_id')} AS dataset FROM embeddings)"""

_R2 = """CASE WHEN var_pop({y}) * count(*) = 0
  THEN CASE WHEN sum(({y} - {p}) ** 2) = 0 THEN 1.0 ELSE 0.0 END
  ELSE 1 - sum(({y} - {p}) ** 2) / (var_pop({y}) * count(*)) END"""


def _bundle(y: str, p: str, digits: int) -> str:
    return f"""count(*) AS n, round(avg(({y} - {p}) ** 2), {digits}) AS mse,
  round(sqrt(avg(({y} - {p}) ** 2)), {digits}) AS rmse, round(avg(abs({y} - {p})), {digits}) AS mae,
  round({_R2.format(y=y, p=p)}, 6) AS r2, round(max(abs({y} - {p})), {digits}) AS max_error,
  round(sum({y})::double, {digits}) AS target_sum, round(avg({y}), {digits}) AS target_mean"""


FIRST = """first AS (
  SELECT model_id, arg_min(value, log_seq) AS value FROM log WHERE key = 'purchase' GROUP BY model_id)"""

SCORED_MODELS = f"""{MODELS}, {LOG}, {FIRST},
scored AS (
  SELECT m.model_id, m.name, m.search_order, f.value, f.value IS NOT NULL AS has_metric
  FROM models m LEFT JOIN first f ON m.model_id = f.model_id)"""

MESSAGES = "SELECT conv_id, turn, role, text, role = 'assistant' AND length(text) % 3 = 0 AS calls_tools FROM conversations"

_TOKENS = (
    "list_filter(regexp_split_to_array(regexp_replace(lower(coalesce({t}, '')), "
    "'[^\\p{{L}}\\p{{N}} \\t\\n\\r\\f]', '', 'g'), '[ \\t\\n\\r\\f]+'), lambda x: x NOT IN ('', 'a', 'an', 'the'))"
)

RESPONSES = """responses AS (
  SELECT d.doc_id AS request_id, d.lang, d.text AS response, b.text AS expected
  FROM documents d JOIN benchmark b ON b.item_id = d.doc_id % (SELECT count(*) FROM benchmark))"""


def _overlap(source: str, extra: str = "") -> str:
    """Common table expressions ending in `overlap`, one row per request."""
    tokens_r, tokens_e = _TOKENS.format(t="response"), _TOKENS.format(t="expected")
    return f"""cut AS MATERIALIZED (SELECT request_id{extra}, {tokens_r} AS r, {tokens_e} AS e FROM {source}),
r AS MATERIALIZED (SELECT request_id, token, count(*) AS n FROM (SELECT request_id, unnest(r) AS token FROM cut) GROUP BY ALL),
e AS MATERIALIZED (SELECT request_id, token, count(*) AS n FROM (SELECT request_id, unnest(e) AS token FROM cut) GROUP BY ALL),
common AS (SELECT request_id, sum(least(r.n, e.n))::bigint AS n FROM r JOIN e USING (request_id, token) GROUP BY 1),
counted AS (
  SELECT request_id{extra}, coalesce(common.n, 0) AS n_common, len(r)::bigint AS n_response,
         len(e)::bigint AS n_expected, (array_to_string(r, ' ') = array_to_string(e, ' '))::int AS exact_match
  FROM cut LEFT JOIN common USING (request_id)),
rated AS (
  SELECT *, CASE WHEN n_response = 0 THEN 0.0 ELSE n_common::double / n_response END AS precision,
         CASE WHEN n_expected = 0 THEN 0.0 ELSE n_common::double / n_expected END AS recall FROM counted),
overlap AS (
  SELECT *, CASE WHEN precision + recall = 0 THEN 0.0 ELSE 2 * precision * recall / (precision + recall) END AS f1
  FROM rated)"""


_HIDDEN = 16
_B1 = _HIDDEN * WIDTH
_W2 = _B1 + _HIDDEN
_B2 = _W2 + CLASSES * _HIDDEN


def _weight(position: str) -> str:
    """The i-th weight of the 64-16-10 network is ((37 i + 11) mod 65 - 32) / 64."""
    return f"(((({position}) * 37 + 11) % 65) - 32) / 64.0::double"


_FORWARD = f"""x AS (
  SELECT vec_id, label, embedding[j + 1]::double AS x, j FROM embeddings, range({WIDTH}) AS js(j)),
h AS (
  SELECT vec_id, label, h, greatest(sum(x * {_weight(f"h * {WIDTH} + j")}) + {_weight(f"{_B1} + h")}, 0.0) AS a
  FROM x, range({_HIDDEN}) AS hs(h) GROUP BY vec_id, label, h),
z AS (
  SELECT vec_id, label, c, sum(a * {_weight(f"{_W2} + c * {_HIDDEN} + h")}) + {_weight(f"{_B2} + c")} AS score
  FROM h, range({CLASSES}) AS cs(c) GROUP BY vec_id, label, c)"""

_MLP_SCORE = f"""WITH {_FORWARD}
SELECT vec_id, arg_max(c, (score, -c)) AS predicted, round(max(score), 6) AS top_score FROM z GROUP BY vec_id"""

_MLP_GRADIENT = f"""WITH {_FORWARD},
top AS (SELECT vec_id, max(score) AS m FROM z GROUP BY vec_id),
total AS (SELECT z.vec_id, m, sum(exp(score - m)) AS s FROM z JOIN top USING (vec_id) GROUP BY ALL),
d AS (SELECT z.vec_id, z.c, exp(score - m) / s - (c = label)::int AS d FROM z JOIN total USING (vec_id)),
back AS (
  SELECT h.vec_id, h.h, sum(d * {_weight(f"{_W2} + c * {_HIDDEN} + h")}) AS b
  FROM h JOIN d USING (vec_id) WHERE a > 0 GROUP BY h.vec_id, h.h),
sums AS (
  SELECT h * {WIDTH} + j AS pos, sum(b * x) AS v FROM back JOIN x USING (vec_id) GROUP BY h, j
  UNION ALL SELECT {_B1} + h, sum(b) FROM back GROUP BY h
  UNION ALL SELECT {_W2} + c * {_HIDDEN} + h, sum(d * a) FROM d JOIN h USING (vec_id) GROUP BY c, h
  UNION ALL SELECT {_B2} + c, sum(d) FROM d GROUP BY c
  UNION ALL SELECT {_B2} + {CLASSES}, sum(ln(s) + m - score) FROM z JOIN total USING (vec_id) WHERE c = label
  UNION ALL SELECT {_B2} + {CLASSES} + 1, count(*) FROM embeddings),
positions AS (SELECT unnest(range({_B2} + {CLASSES} + 2)) AS pos)
SELECT pos::int AS pos, round(coalesce(v, 0.0), 6) AS v FROM positions LEFT JOIN sums USING (pos)"""


def _mlp_updates(steps: int) -> str:
    """Forward pass, gradient and Adam step as CTEs, once for each update; weights are rows (pos, v)."""
    parts = [
        f"""x AS MATERIALIZED (
  SELECT vec_id, label, embedding[j + 1]::double AS x, j FROM embeddings, range({WIDTH}) AS js(j)),
n AS (SELECT count(*) AS n FROM embeddings),
s0 AS (SELECT pos, {_weight("pos")} AS v, 0.0::double AS first, 0.0::double AS second FROM range({_B2 + CLASSES}) AS ps(pos))"""
    ]
    for k in range(steps):
        parts.append(f"""h{k} AS MATERIALIZED (
  SELECT vec_id, label, h, greatest(s + b.v, 0.0) AS a
  FROM (SELECT vec_id, label, w.pos // {WIDTH} AS h, sum(x * v) AS s
        FROM x JOIN s{k} w ON w.pos < {_B1} AND w.pos % {WIDTH} = x.j GROUP BY ALL)
  JOIN s{k} b ON b.pos = {_B1} + h),
z{k} AS MATERIALIZED (
  SELECT vec_id, label, c, s + b.v AS score
  FROM (SELECT vec_id, label, (w.pos - {_W2}) // {_HIDDEN} AS c, sum(a * v) AS s
        FROM h{k} JOIN s{k} w ON w.pos >= {_W2} AND w.pos < {_B2} AND (w.pos - {_W2}) % {_HIDDEN} = h GROUP BY ALL)
  JOIN s{k} b ON b.pos = {_B2} + c),
t{k} AS (SELECT vec_id, max(score) AS m FROM z{k} GROUP BY vec_id),
u{k} AS (SELECT z.vec_id, any_value(m) AS m, sum(exp(score - m)) AS s FROM z{k} z JOIN t{k} USING (vec_id) GROUP BY z.vec_id),
d{k} AS MATERIALIZED (SELECT z.vec_id, c, exp(score - m) / s - (c = label)::int AS d FROM z{k} z JOIN u{k} USING (vec_id)),
b{k} AS MATERIALIZED (
  SELECT vec_id, h, sum(d * v) AS b
  FROM (SELECT vec_id, h, c, d FROM h{k} JOIN d{k} USING (vec_id) WHERE a > 0)
  JOIN s{k} w ON w.pos = {_W2} + c * {_HIDDEN} + h GROUP BY vec_id, h),
g{k} AS (
  SELECT pos, sum(v) / any_value(n) AS g FROM (
    SELECT h * {WIDTH} + j AS pos, b * x AS v FROM b{k} JOIN x USING (vec_id)
    UNION ALL SELECT {_B1} + h, b FROM b{k}
    UNION ALL SELECT {_W2} + c * {_HIDDEN} + h, d * a FROM d{k} JOIN h{k} USING (vec_id)
    UNION ALL SELECT {_B2} + c, d FROM d{k}), n GROUP BY pos),
m{k} AS (
  SELECT pos, v, 0.9 * first + 0.1 * coalesce(g, 0.0) AS first, 0.999 * second + 0.001 * coalesce(g, 0.0) ** 2 AS second
  FROM s{k} LEFT JOIN g{k} USING (pos)),
s{k + 1} AS MATERIALIZED (
  SELECT pos, v - 0.01 * (first / (1 - 0.9::double ** {k + 1})) / (sqrt(second / (1 - 0.999::double ** {k + 1})) + 1e-8::double) AS v,
         first, second FROM m{k})""")
    rows = " UNION ALL ".join(f"SELECT {k}::bigint AS step, pos::int AS pos, round(v, 6) AS v FROM s{k + 1}" for k in range(steps))
    return f"WITH {', '.join(parts)} {rows}"


def _elastic_net(alphas: str, last: str) -> str:
    """Proximal gradient steps on the covariance matrix, all weights at once, until they settle."""
    return f"""WITH RECURSIVE {FEATURES},
x AS (SELECT vec_id, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS idx, quality::double AS y FROM features),
centred AS (SELECT vec_id, idx, x - avg(x) OVER (PARTITION BY idx) AS x, y - avg(y) OVER (PARTITION BY idx) AS y FROM x),
n AS (SELECT count(*) AS n FROM features),
entry AS (
  SELECT a.idx, b.idx AS other, sum(a.x * b.x) / any_value(n) AS v
  FROM centred a JOIN centred b USING (vec_id), n GROUP BY ALL),
gram AS (SELECT list(row ORDER BY idx) AS g FROM (SELECT idx, list(v ORDER BY other) AS row FROM entry GROUP BY idx)),
pull AS (SELECT list(c ORDER BY idx) AS c FROM (SELECT idx, sum(x * y) / any_value(n) AS c FROM centred, n GROUP BY idx)),
bound AS (SELECT max(s) AS top FROM (SELECT sum(abs(v)) AS s FROM entry GROUP BY idx)),
steps AS (
  SELECT 0 AS k, alpha, list_transform(c, lambda v: 0.0::double) AS w FROM pull, (SELECT unnest({alphas}) AS alpha)
  UNION ALL
  SELECT k + 1, alpha,
         list_transform(range(1, len(w) + 1), lambda i:
           sign(w[i] + (c[i] - list_dot_product(g[i], w)) / top)
           * greatest(abs(w[i] + (c[i] - list_dot_product(g[i], w)) / top) - alpha * 0.5 / top, 0.0)
           / (1 + alpha * 0.5 / top))
  FROM steps, gram, pull, bound WHERE k < 400),
settled AS (SELECT alpha, w FROM steps WHERE k = 400),
means AS (SELECT list(m ORDER BY idx) AS m FROM (SELECT idx, avg(x) AS m FROM x GROUP BY idx)),
weights AS (
  SELECT alpha, unnest(w) AS value, generate_subscripts(w, 1)::int - 1 AS idx FROM settled
  UNION ALL
  SELECT alpha, (SELECT avg(quality) FROM features) - list_dot_product(m, w), -1 FROM settled, means)
{last}"""


ORACLE: dict[str, str] = {
    "q_source_scan": "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders",
    "q_signature_check": """
SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id,
       array_to_string(list_filter([
         CASE WHEN event_id % 7 = 0 OR user_id IS NULL THEN 'user_id: null' END,
         CASE WHEN event_id % 5 = 0 OR value IS NULL THEN 'value: null' END,
         CASE WHEN value IS NULL THEN 'history: null inside' END,
         CASE WHEN event_id % 3 <> 1 THEN 'history: not 2 items' END], lambda v: v IS NOT NULL), ', ') AS violations
FROM events""",
    "q_dataset_profile": """
SELECT 'events' AS name, count(*) AS n_rows,
       sum((event_id IS NULL)::int + (ts IS NULL)::int + (user_id IS NULL)::int + (event_type IS NULL)::int
           + (value IS NULL)::int + (props IS NULL)::int)::bigint AS n_null_cells,
       sum(('0x' || substr(md5(concat_ws(chr(1), event_id::varchar, epoch_us(ts)::varchar, user_id::varchar,
           event_type, value::varchar, props)), 1, 15))::bigint)::varchar AS digest
FROM events""",
    "q_schema_conformance": """
SELECT count(*) AS n_rows, c AS "column", expected, actual, status,
       CASE c WHEN 'event_id' THEN count(*) - count(event_id) WHEN 'event_type' THEN count(*) - count(event_type)
              WHEN 'props' THEN count(*) - count(props) WHEN 'value' THEN count(*) - count(value) END AS n_null,
       CASE c WHEN 'event_id' THEN min(event_id)::double WHEN 'value' THEN min(value) END AS lowest,
       CASE c WHEN 'event_id' THEN max(event_id)::double WHEN 'value' THEN max(value) END AS highest
FROM events, (VALUES ('event_id', 'bigint', 'bigint', 'ok'), ('event_type', 'string', 'string', 'ok'),
  ('props', NULL, 'string', 'unexpected'), ('step', 'bigint', NULL, 'missing'),
  ('value', 'float', 'double', 'type_mismatch')) AS s(c, expected, actual, status)
GROUP BY c, expected, actual, status""",
    "q_feature_projection": "SELECT vec_id, "
    + ", ".join(f"embedding[{i + 1}]::double AS f{i}" for i in range(WIDTH))
    + " FROM embeddings",
    "q_label_projection": "SELECT (label = 2)::int AS quality, count(*) AS n FROM embeddings GROUP BY 1",
    "q_positional_split": f"""
SELECT len(embedding) AS n_features, embedding[1]::double AS first_feature, embedding[{WIDTH}]::double AS last_feature,
       label::bigint AS target FROM embeddings""",
    "q_binary_label": "SELECT vec_id, label, (label = 2)::int AS quality FROM embeddings",
    "q_argmax": "SELECT vec_id, (list_position(embedding, list_max(embedding)) - 1)::bigint AS predicted FROM embeddings",
    "q_shape": """
SELECT count(*) AS n_rows, min(len(embedding)) AS min_features, max(len(embedding)) AS max_features,
       count(DISTINCT label) AS n_classes FROM embeddings""",
    "q_endpoint_name": """
SELECT c_custkey, replace('main.default.' || c_name, '.', '-') || '-serving-endpoint' AS endpoint_name FROM customer""",
    "q_model_uri": f"""
WITH {REGISTRATIONS}
SELECT arrival, CASE WHEN arrival % 2 = 0 THEN 'models:/' || model_id ELSE 'models:/' || name || '/' || arrival END AS uri,
       CASE WHEN arrival % 2 = 0 THEN model_id ELSE name END AS subject,
       CASE WHEN arrival % 2 = 0 THEN '' ELSE arrival::varchar END AS version
FROM registrations""",
    "q_qualified_name": """
SELECT p_partkey, CASE WHEN p_size > 3 THEN p_brand ELSE '' END || '.' || p_type || '.' || p_name AS full_name,
       p_size > 3 AND p_type <> '' AND p_name <> '' AS is_complete, p_name AS model_part
FROM part""",
    "q_params_map": """
SELECT event_id, json_extract_string(props, '$.k') AS k, json_extract_string(props, '$.k')::double AS k_number,
       NULL::double AS absent_number, value::varchar AS value_text
FROM events""",
    "q_metric_map_rows": f"""
WITH {LOG}
SELECT model_id, dataset, 'mean' AS key, round(avg(value), 6) AS value FROM log GROUP BY ALL
UNION ALL SELECT model_id, dataset, 'highest', round(max(value), 6) FROM log GROUP BY ALL
UNION ALL SELECT model_id, dataset, 'count', count(value)::double FROM log GROUP BY ALL""",
    "q_checkpoint_steps": f"WITH {LOG} SELECT step, count(*) AS n FROM log WHERE step % 10 = 0 GROUP BY step",
    "q_split_hash": f"SELECT o_orderkey, {_dataset('o_orderkey')} AS dataset FROM orders",
    "q_split_exact": f"""
WITH ranked AS (
  SELECT o_orderkey, row_number() OVER (ORDER BY {_hash('o_orderkey')}, o_orderkey) AS r, count(*) OVER () AS n FROM orders)
SELECT o_orderkey, CASE WHEN r <= ceil(n * 0.2) THEN 'test' ELSE 'train' END AS dataset FROM ranked""",
    "q_regression_metrics": f"""
WITH {REGRESSION}
SELECT round(avg((y - p) ** 2), 2) AS mse, round(avg((y - p) ** 2), 2) AS compat_rmse,
       round({_R2.format(y='y', p='p')}, 6) AS compat_r2, round(avg(abs(y - p)), 2) AS compat_mae,
       round(sqrt(avg((y - p) ** 2)), 2) AS rmse
FROM scored""",
    "q_evaluate_regressor": f"WITH {REGRESSION} SELECT {_bundle('y', 'p', 2)} FROM scored",
    "q_metrics_by_model_dataset": f"""
WITH {REGRESSION} SELECT model_id, dataset, {_bundle('y', 'p', 2)} FROM scored GROUP BY model_id, dataset""",
    "q_train_test_gap": f"""
WITH {REGRESSION},
wide AS (
  SELECT model_id, dataset, avg(abs(y - p)) AS mae, {_R2.format(y='y', p='p')} AS r2
  FROM scored GROUP BY model_id, dataset),
rows_ AS (
  SELECT model_id, dataset, 'mae' AS key, mae AS value FROM wide
  UNION ALL SELECT model_id, dataset, 'r2', r2 FROM wide)
SELECT model_id, key, round(max(value) FILTER (dataset = 'train'), 4) AS train,
       round(max(value) FILTER (dataset = 'test'), 4) AS test,
       round(max(value) FILTER (dataset = 'test') - max(value) FILTER (dataset = 'train'), 4) AS gap
FROM rows_ GROUP BY model_id, key""",
    "q_accuracy": """
SELECT source, count(*) AS n, round(avg((quality = toxic)::int), 6) AS accuracy
FROM labels JOIN documents USING (doc_id) GROUP BY source""",
    "q_custom_metric": f"""
WITH {REGRESSION}
SELECT dataset, count(*) AS n, round(avg(y - p), 4) AS bias,
       count(*) FILTER (abs(y - p) <= abs(y) * 0.1::double) AS within_tenth
FROM scored GROUP BY dataset""",
    "q_custom_aggregates": """
WITH scored AS (
  SELECT lang, toxic, least(n_chars % 997 / 1000.0::double + toxic / 5.0::double, 1.0::double) AS score
  FROM labels JOIN documents USING (doc_id)),
binned AS (SELECT lang, toxic, score, least(floor(score * 100), 99) AS b, least(floor(score * 10), 9) AS c FROM scored),
bins AS (
  SELECT lang, b, count(*) FILTER (toxic = 1) AS ones, count(*) FILTER (toxic = 0) AS zeros FROM binned GROUP BY ALL),
won AS (
  SELECT lang, ones, zeros,
         ones * (coalesce(sum(zeros) OVER (PARTITION BY lang ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)
                 + zeros / 2.0::double) AS won FROM bins),
areas AS (SELECT lang, sum(won) / nullif(sum(ones)::double * sum(zeros), 0) AS auc FROM won GROUP BY lang),
apart AS (SELECT lang, count(*) AS n, abs(sum(toxic) - sum(score)) AS d FROM binned GROUP BY lang, c)
SELECT lang, round(auc, 6) AS auc, round(calibration, 6) AS calibration
FROM areas JOIN (SELECT lang, sum(d) / sum(n) AS calibration FROM apart GROUP BY lang) USING (lang)""",
    "q_cross_entropy": """
WITH z AS (SELECT list_transform(embedding, lambda x: x::double) AS z, label FROM embeddings)
SELECT count(*) AS n, round(avg(list_max(z) + ln(list_sum(list_transform(z, lambda x: exp(x - list_max(z))))) - z[label + 1]), 6) AS loss
FROM z""",
    "q_lineage": f"""
WITH {MODELS}, {LOG},
linked AS (
  SELECT model_id, run_id, dataset, key, count(*) AS n_metrics, arg_max(value, log_seq) AS last_value FROM log GROUP BY ALL),
datasets AS (SELECT dataset, count(*) AS dataset_rows FROM log GROUP BY dataset),
runs AS (SELECT run_id, min(log_seq) AS first_seq, max(log_seq) AS last_seq FROM log GROUP BY run_id)
SELECT m.model_id, m.name, l.run_id, l.dataset, l.key, l.n_metrics, l.last_value, d.dataset_rows, r.first_seq, r.last_seq
FROM models m LEFT JOIN linked l ON m.model_id = l.model_id
LEFT JOIN datasets d ON l.dataset = d.dataset LEFT JOIN runs r ON l.run_id = r.run_id""",
    "q_model_lookup": f"""
WITH {MODELS}, {LOG},
first_any AS (SELECT model_id, arg_min(key, log_seq) AS key, arg_min(value, log_seq) AS value FROM log GROUP BY model_id)
SELECT m.model_id, m.name, m.search_order, f.key, f.value
FROM models m LEFT JOIN first_any f ON m.model_id = f.model_id
WHERE m.model_id IN (SELECT 'm-' || o_custkey FROM orders WHERE o_orderstatus = 'P')""",
    "q_model_document": f"""
WITH {MODELS}, {LOG},
placed AS (SELECT *, row_number() OVER (PARTITION BY model_id ORDER BY log_seq) AS place FROM log)
SELECT (l.place - 1) >> 12 AS part, m.model_id, m.name, l.log_seq, l.key, l.value, l.step, l.dataset
FROM models m LEFT JOIN placed l ON m.model_id = l.model_id""",
    "q_first_metric": f"""
WITH {LOG}
SELECT model_id, arg_min(key, log_seq) AS first_key, arg_min(value, log_seq) AS first_value,
       arg_min(value, log_seq) FILTER (key = 'purchase') AS first_purchase
FROM log GROUP BY model_id""",
    "q_first_metric_of_dataset": f"""
WITH {LOG}
SELECT model_id, 'purchase' AS key, arg_min(value, log_seq) AS value
FROM log WHERE key = 'purchase' AND dataset = 'test' GROUP BY model_id""",
    "q_rank_checkpoints": f"""
WITH {SCORED_MODELS}
SELECT model_id, name, search_order, value, has_metric,
       row_number() OVER (ORDER BY coalesce(value, '-inf'::double) DESC, search_order) AS rank
FROM scored""",
    "q_rank_of_run": f"""
WITH {MODELS}, {LOG},
first AS (
  SELECT model_id, arg_min(value, log_seq) AS value FROM log
  WHERE key = 'purchase' AND run_id = (SELECT max(run_id) FROM log) GROUP BY model_id)
SELECT model_id, name, search_order, value, value IS NOT NULL AS has_metric,
       row_number() OVER (ORDER BY coalesce(value, '-inf'::double) DESC, search_order) AS rank
FROM models JOIN first USING (model_id)""",
    "q_best_worst": f"""
WITH {SCORED_MODELS},
ordered AS (
  SELECT *, row_number() OVER (ORDER BY coalesce(value, '-inf'::double) DESC, search_order) AS r, count(*) OVER () AS n FROM scored)
SELECT CASE WHEN r = 1 THEN 'best' ELSE 'worst' END AS place, model_id, value, has_metric
FROM ordered WHERE r = 1 OR r = n""",
    "q_best_per_group": f"""
WITH {SCORED_MODELS}
SELECT name, model_id, value, has_metric FROM scored
QUALIFY row_number() OVER (PARTITION BY name ORDER BY coalesce(value, '-inf'::double) DESC, search_order) = 1""",
    "q_metric_curve": f"""
WITH {LOG},
points AS (SELECT model_id, key, step, arg_max(value, log_seq) AS value FROM log GROUP BY model_id, key, step)
SELECT model_id, key, step, value, max(value) OVER (w ROWS UNBOUNDED PRECEDING) AS best,
       round(value - lag(value) OVER w, 6) AS change
FROM points WINDOW w AS (PARTITION BY model_id, key ORDER BY step)""",
    "q_latest_metric": f"""
WITH {LOG}
SELECT model_id, key, dataset, arg_max(value, (step, log_seq)) AS value, max(step) AS step
FROM log GROUP BY model_id, key, dataset""",
    "q_elastic_net": f"""
WITH {FEATURES},
x AS (SELECT vec_id, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) - 1 AS idx, quality FROM features),
pull AS (SELECT idx, abs(covar_pop(x, quality)) AS c FROM x GROUP BY idx)
SELECT idx::int AS idx, CASE WHEN c <= 0.25 THEN 0.0::double END AS value FROM pull
UNION ALL SELECT -1, round(avg(quality), 8) FROM features""",
    "q_elastic_net_sparse": _elastic_net("[0.002::double]", "SELECT idx, round(value, 6) AS value FROM weights"),
    "q_elastic_net_path": _elastic_net(
        "[0.05::double, 0.004, 0.002, 0.001]", "SELECT alpha, idx, round(value, 6) AS value FROM weights"
    ),
    "q_train_evaluate": f"""
WITH {FEATURES},
scored AS (
  SELECT dataset, quality::double AS y, (SELECT avg(quality) FROM features WHERE dataset = 'train') AS p FROM features)
SELECT dataset, {_bundle('y', 'p', 6)} FROM scored GROUP BY dataset""",
    "q_linear_score": f"""
WITH {FEATURES},
x AS (SELECT unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS idx FROM features WHERE quality = 1),
w AS (SELECT list(m ORDER BY idx) AS w FROM (SELECT idx, avg(x) AS m FROM x GROUP BY idx)),
b AS (SELECT avg(quality) AS b FROM features)
SELECT vec_id, round(list_dot_product(embedding::double[], w) + b, 6) AS prediction FROM features, w, b""",
    "q_score_many_models": f"""
WITH {FEATURES},
x AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS idx FROM features),
w AS (SELECT label AS model, list(m ORDER BY idx) AS w FROM (SELECT label, idx, avg(x) AS m FROM x GROUP BY ALL) GROUP BY label),
scored AS (
  SELECT 'm-' || model AS model_id, dataset, (label = model)::int::double AS y, list_dot_product(embedding::double[], w) AS p
  FROM features, w)
SELECT model_id, dataset, {_bundle('y', 'p', 6)} FROM scored GROUP BY model_id, dataset""",
    "q_mlp_score": _MLP_SCORE,
    "q_mlp_gradient": _MLP_GRADIENT,
    "q_mlp_updates": _mlp_updates(3),
    "q_score_by_address": f"""WITH {_FORWARD},
net AS (SELECT vec_id, arg_max(c, (score, -c)) AS predicted, max(score) AS top FROM z GROUP BY vec_id),
line AS (SELECT vec_id, sum(x * {_weight("j")}) + 0.25 AS p FROM x GROUP BY vec_id)
SELECT vec_id, CASE vec_id % 4 WHEN 0 THEN 'm-line' WHEN 1 THEN 'm-net' END AS model_id,
       CASE WHEN vec_id % 4 < 2 THEN 'ok' ELSE 'no_model' END AS status,
       CASE vec_id % 4 WHEN 0 THEN round(p, 6) WHEN 1 THEN predicted::double END AS prediction,
       CASE WHEN vec_id % 4 = 1 THEN round(top, 6) END AS top_score
FROM embeddings JOIN net USING (vec_id) JOIN line USING (vec_id)""",
    "q_vector_topk": """
WITH ranked AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(v.embedding::double[], q.embedding::double[]) AS similarity
  FROM embeddings v, embeddings q WHERE q.vec_id % 20 = 0)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank, vec_id,
       round(similarity, 6) AS similarity FROM ranked
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) <= 10""",
    "q_vector_index_recall": """
WITH n AS (SELECT count(*) AS n, count(*) FILTER (vec_id % 20 = 0) AS q FROM embeddings)
SELECT q * least(n, 10) AS wanted, q * n AS pairs, true AS recall_reached, true AS few_compared FROM n""",
    "q_vector_filtered": """
WITH ranked AS (
  SELECT q.vec_id AS query_id, v.vec_id, list_cosine_similarity(v.embedding::double[], q.embedding::double[]) AS similarity
  FROM embeddings v, embeddings q WHERE q.vec_id % 20 = 0 AND v.label = 3)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank, vec_id,
       round(similarity, 6) AS similarity FROM ranked
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) <= 5""",
    "q_vector_means": f"""
WITH {FEATURES},
x AS (SELECT label, unnest(embedding)::double AS x, generate_subscripts(embedding, 1) AS idx FROM features),
w AS (SELECT label, list(m ORDER BY idx) AS w FROM (SELECT label, idx, avg(x) AS m FROM x GROUP BY ALL) GROUP BY label),
ranked AS (
  SELECT w.label::bigint AS query_id, f.vec_id, list_cosine_similarity(f.embedding::double[], w.w) AS similarity
  FROM features f, w)
SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) AS rank, vec_id,
       round(similarity, 6) AS similarity FROM ranked
QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY similarity DESC, vec_id) <= 10""",
    "q_prepend_system": f"""
SELECT conv_id, turn, role, text FROM conversations
UNION ALL SELECT DISTINCT conv_id, -1, 'system', '{PROMPT}' FROM conversations""",
    "q_last_message": """
SELECT conv_id, turn, role, text FROM conversations
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "q_route": f"""
SELECT conv_id, turn, CASE WHEN calls_tools THEN 'continue' ELSE 'end' END AS route FROM ({MESSAGES})
QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY turn DESC) = 1""",
    "q_flatten_updates": f"""
SELECT conv_id, turn AS event_seq, 0::bigint AS node_pos, 0::bigint AS msg_pos,
       CASE WHEN role = 'assistant' THEN 'agent' ELSE 'tools' END AS node, role, text AS content, calls_tools
FROM ({MESSAGES}) WHERE role <> 'system'""",
    "q_message_validate": """
SELECT conv_id, turn, CASE WHEN conv_id % 4 = 0 OR role IS NULL OR trim(role) = '' THEN 'no_role'
  WHEN conv_id % 7 = 0 OR text IS NULL THEN 'no_content' ELSE 'ok' END AS status
FROM conversations""",
    "q_pair_turns": """
SELECT conv_id, turn, text AS request, next_text AS response
FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations
      WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
WHERE role = 'user' AND next_role = 'assistant'""",
    "q_trace_summary": """
SELECT conv_id, count(*) AS n_steps, count(*) FILTER (role = 'user') AS n_user,
       count(*) FILTER (role = 'assistant') AS n_assistant, count(*) FILTER (role = 'system') AS n_system,
       count(*) FILTER (role NOT IN ('user', 'assistant', 'system')) AS n_other,
       coalesce(sum(length(text)), 0)::bigint AS n_chars, max(length(text)) AS longest_step
FROM conversations GROUP BY conv_id""",
    "q_agent_batch": """
WITH context AS (
  SELECT conv_id, arg_max(text, turn) AS last_text, count(*) % 3 AS rounds FROM conversations GROUP BY conv_id),
numbered AS (SELECT *, unnest(range(2 * rounds + 1)) AS seq FROM context)
SELECT conv_id, seq, CASE WHEN seq % 2 = 1 THEN 'tool' ELSE 'assistant' END AS role,
  CASE WHEN seq % 2 = 1 THEN CASE WHEN seq = 1 THEN length(last_text)::varchar ELSE 'unknown tool: absent' END
       WHEN seq < 2 * rounds THEN 'round ' || seq // 2
       WHEN rounds = 0 THEN 'done: no tools'
       WHEN rounds = 1 THEN 'done: ' || length(last_text)
       ELSE 'done: unknown tool: absent' END AS content,
  seq % 2 = 0 AND seq < 2 * rounds AS calls_tools, true AS finished
FROM numbered""",
    "q_respond_rows": """
WITH seen AS (
  SELECT conv_id, turn, role, count(*) FILTER (role = 'user') OVER w AS users, sum(length(coalesce(text, ''))) OVER w AS chars
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn)),
parts AS (SELECT conv_id, turn, unnest(range(users % 3)) AS part, chars FROM seen WHERE role = 'user')
SELECT conv_id, turn::bigint AS turn, part, chars::bigint AS chars FROM parts
UNION ALL
SELECT conv_id, -1, count(*) FILTER (role = 'user'), sum(length(coalesce(text, '')))::bigint
FROM conversations GROUP BY conv_id HAVING count(*) FILTER (role = 'user') >= 2""",
    "q_predict_batch": """
SELECT conv_id, turn, 'chars: ' || length(text) AS response FROM conversations WHERE role = 'user'""",
    "q_token_f1": f"""
WITH {RESPONSES}, {_overlap('responses')}
SELECT request_id, n_common, n_response, n_expected, exact_match, round(precision, 6) AS precision,
       round(recall, 6) AS recall, round(f1, 6) AS f1
FROM overlap""",
    "q_eval_rows": f"""
WITH paired AS (
  SELECT conv_id || '-' || turn AS request_id, conv_id, text AS request, next_text AS response
  FROM (SELECT *, lead(role) OVER w AS next_role, lead(text) OVER w AS next_text FROM conversations
        WINDOW w AS (PARTITION BY conv_id ORDER BY turn))
  WHERE role = 'user' AND next_role = 'assistant'),
rows_ AS (
  SELECT p.*, b.text AS expected FROM paired p JOIN benchmark b
  ON b.item_id = p.conv_id % (SELECT count(*) FROM benchmark)),
{_overlap('rows_', ', request, response, expected')}
SELECT request_id, request, response, expected, n_common, n_response, n_expected, exact_match,
       round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1
FROM overlap""",
    "q_eval_summary": f"""
WITH {RESPONSES}, {_overlap('responses', ', lang')}
SELECT lang, count(*) AS n_rows, round(avg(exact_match), 6) AS exact_match, round(avg(precision), 6) AS precision,
       round(avg(recall), 6) AS recall, round(avg(f1), 6) AS f1, count(*) FILTER (n_response = 0) AS n_empty_responses
FROM overlap GROUP BY lang""",
    "q_toolcall_pr": f"""
WITH {LOG},
calls AS (
  SELECT model_id, run_id, coalesce(list(DISTINCT key) FILTER (dataset = 'train'), []) AS p,
         coalesce(list(DISTINCT key) FILTER (dataset = 'test'), []) AS e
  FROM log GROUP BY model_id, run_id),
sized AS (SELECT model_id, run_id, len(list_intersect(p, e))::bigint AS n_common, len(p) AS np, len(e) AS ne FROM calls)
SELECT model_id, run_id, n_common, ne - n_common AS n_missed, np - n_common AS n_extra,
       CASE WHEN np = 0 THEN 0.0 ELSE round(n_common::double / np, 6) END AS tool_precision,
       CASE WHEN ne = 0 THEN 0.0 ELSE round(n_common::double / ne, 6) END AS tool_recall
FROM sized""",
    "q_register_versions": f"WITH {VERSIONS} SELECT arrival, name, version FROM fresh",
    "q_resolve_uri": f"""
WITH {MODELS}, {VERSIONS},
versions AS (SELECT name, version, model_id FROM existing UNION ALL SELECT name, version, model_id FROM fresh),
requests AS (
  SELECT arrival, CASE arrival % 3 WHEN 0 THEN 'models:/' || model_id
    WHEN 1 THEN 'models:/' || name || '/' || (arrival % 20 + 1) ELSE 'runs:/' || name END AS uri, model_id, name
  FROM registrations)
SELECT r.arrival, r.uri,
       CASE r.arrival % 3 WHEN 0 THEN m.model_id WHEN 1 THEN v.model_id END AS model_id
FROM requests r LEFT JOIN models m ON r.model_id = m.model_id
LEFT JOIN versions v ON r.name = v.name AND v.version = r.arrival % 20 + 1""",
    "q_approval_gate": f"WITH {GATE} SELECT version, reason = 'approved' AS approved, reason FROM gate",
    "q_gate_at_two_times": """
WITH history AS (
  SELECT 'main.default.m' || o_custkey AS name, o_orderkey % 3 + 1 AS version,
         CASE o_orderkey % 5 WHEN 0 THEN 'owner' WHEN 1 THEN 'APPROVAL_CHECK' ELSE 'Approval_Check' END AS key,
         CASE o_orderstatus WHEN 'O' THEN 'approved' WHEN 'F' THEN 'Rejected' END AS value,
         o_orderdate::timestamp AS set_at, o_orderkey AS seq FROM orders),
asked AS (
  SELECT DISTINCT name, version, t AS asked_at
  FROM history, (VALUES (TIMESTAMP '1996-06-30'), (TIMESTAMP '1999-12-31')) ts(t)),
held AS (
  SELECT name, version, asked_at, key, value FROM asked JOIN history USING (name, version) WHERE set_at <= asked_at
  QUALIFY row_number() OVER (PARTITION BY name, version, asked_at, key ORDER BY set_at DESC, seq DESC) = 1),
facts AS (
  SELECT name, version, asked_at, count(*) AS n_tags, bool_or(lower(key) = 'approval_check') AS present,
         max(value) FILTER (key = 'Approval_Check') AS tag FROM held WHERE value IS NOT NULL GROUP BY ALL),
judged AS (
  SELECT name, version, asked_at, coalesce(n_tags, 0) AS n_tags,
         CASE WHEN NOT coalesce(present, false) THEN 'missing' WHEN lower(tag) = 'approved' THEN 'approved'
              WHEN tag IS NOT NULL THEN 'rejected' ELSE 'key_case_mismatch' END AS reason
  FROM asked LEFT JOIN facts USING (name, version, asked_at))
SELECT name, version, strftime(asked_at, '%Y-%m-%d') AS asked_on, n_tags, reason, reason = 'approved' AS approved FROM judged""",
    "q_deployable_versions": f"""
WITH {GATE}
SELECT name, version, model_id FROM gate
WHERE reason = 'approved' AND model_id IN (SELECT 'm-' || user_id FROM events)""",
    "q_deployable_evaluated": f"""
WITH {GATE}
SELECT name, version, model_id FROM gate
WHERE reason = 'approved' AND model_id IN (
  SELECT 'm-' || user_id FROM events WHERE event_type = 'purchase' AND value >= {EVALUATED_AT_LEAST} AND day(ts) % 2 = 0)""",
    "q_deployable_with_threshold": f"""
WITH {GATE}, {LOG},
latest AS (SELECT model_id, arg_max(value, (step, log_seq)) AS value FROM log WHERE key = 'purchase' GROUP BY model_id)
SELECT name, version, model_id FROM gate
WHERE reason = 'approved' AND model_id IN (SELECT model_id FROM latest WHERE value >= 10.0)""",
    "q_endpoint_upsert": f"""
WITH {REGISTRATIONS},
latest AS (SELECT name, is_earlier, max(arrival) AS version FROM registrations GROUP BY ALL),
e AS (SELECT * FROM latest WHERE is_earlier), i AS (SELECT * FROM latest WHERE NOT is_earlier)
SELECT replace(coalesce(i.name, e.name), '.', '-') || '-serving-endpoint' AS endpoint_name,
       coalesce(i.name, e.name) AS entity_name, coalesce(i.version, e.version) AS entity_version,
       'Small' AS workload_size, true AS scale_to_zero,
       CASE WHEN i.name IS NULL THEN 'keep' WHEN e.name IS NULL THEN 'create' ELSE 'update' END AS action
FROM e FULL JOIN i ON e.name = i.name""",
    "q_resource_manifest": """
SELECT 'endpoint' AS resource_kind, s_name AS resource_name FROM supplier
UNION ALL SELECT 'index', p_brand FROM part WHERE p_size % 3 = 0
UNION ALL SELECT 'index', p_type FROM part WHERE p_size % 3 = 0
UNION ALL SELECT 'function', 'tool-' || p_partkey FROM part WHERE p_size % 3 = 1""",
    "q_stream_deltas": f"""
SELECT conv_id, turn AS event_seq, 0::bigint AS node_pos, 0::bigint AS msg_pos, 'agent' AS node, role,
       text AS content, calls_tools FROM ({MESSAGES})""",
    "q_stream_dedup": f"WITH {LOG} SELECT model_id, key, value, log_seq FROM log",
    "q_stream_best": f"""
WITH {LOG}
SELECT model_id, key, max(value) AS best_value, arg_max(log_seq, (value, -log_seq)) AS best_seq FROM log GROUP BY model_id, key""",
}

_WINDOWS = """
SELECT date_diff('day', DATE '1970-01-01', ts::date) AS day, event_type AS key, count(*) AS n,
       round(sum(value), 4) AS total, min(value) AS lowest, max(value) AS highest
FROM events GROUP BY ALL"""
ORACLE["q_metric_windows"] = _WINDOWS
ORACLE["q_stream_windows"] = """
WITH marks AS (
  SELECT max(ts) - INTERVAL 1 HOUR AS closed, max(ts) FILTER (event_id % 97 <> 0) - INTERVAL 1 HOUR AS closed_before FROM events),
seen AS (
  SELECT ts::date AS day, ts::date + INTERVAL 1 DAY AS window_end, event_id % 97 = 0 AS late, event_type, value FROM events)
SELECT date_diff('day', DATE '1970-01-01', day) AS day, event_type AS key, count(*) AS n,
       round(sum(value), 4) AS total, min(value) AS lowest, max(value) AS highest
FROM seen, marks WHERE window_end <= closed AND (NOT late OR window_end > closed_before)
GROUP BY ALL"""
ORACLE["q_agent_history"] = """
WITH memories AS (
  SELECT conv_id, md5(string_agg(coalesce(role, '') || ':' || coalesce(text, '') || chr(10), '' ORDER BY turn)) AS memory
  FROM conversations GROUP BY conv_id),
asking AS (SELECT *, memory[1] IN ('0', '1', '2', '3', '4', '5', '6', '7') AS asks FROM memories)
SELECT conv_id, 0::bigint AS seq, 'assistant' AS role, 'asks' AS content, true AS calls_tools, true AS finished FROM asking WHERE asks
UNION ALL SELECT conv_id, 1, 'tool', upper(memory), false, true FROM asking WHERE asks
UNION ALL SELECT conv_id, CASE WHEN asks THEN 2 ELSE 0 END, 'assistant', 'read: ' || memory, false, true FROM asking"""
