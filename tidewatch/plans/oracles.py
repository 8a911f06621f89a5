"""The same queries in SQL over the same tables.

Written from the meaning of each operator, not from its Spark form: window
features by a range join, pairs by a real join, the score by the running
minimum, the split by a rank per class, and so on.
"""

from __future__ import annotations

from tidewatch import fixed_values as V
from tidewatch.functions.text import LINK_TLDS
from tidewatch.plans import inputs as I

SPACE = r"\s\x0B\x1C-\x1F\x{85}\p{Z}"


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def words_in(items) -> str:
    return ", ".join(lit(w) for w in items)


def sub(x: str, pattern: str, by: str = "", opts: str = "g") -> str:
    return f"regexp_replace({x}, {lit(pattern)}, {lit(by)}, {lit(opts)})"


def clean(x: str) -> str:
    return f"trim({sub(sub(x, r'<[^>' + chr(92) + 'n]*>'), f'[{SPACE}]+', ' ')})"


def redact(x: str) -> str:
    token = f"[^{SPACE}]"
    tlds = "|".join(V.REDACTED_TLDS)
    return sub(x, rf"https?://{token}+|www\.{token}+|{token}+\.({tlds})\b", V.LINK_REMOVED)


def leet(x: str) -> str:
    return f"translate(lower({x}), {lit(''.join(V.LEET_MAP))}, {lit(''.join(V.LEET_MAP.values()))})"


def norm(x: str) -> str:
    return sub(leet(x), f"[^a-z{SPACE}]")


def words(x: str) -> str:
    return f"list_filter(regexp_split_to_array({x}, {lit(f'[{SPACE}]+')}), lambda w: w <> '')"


def tokens(x: str) -> str:
    split = f"regexp_split_to_array(lower({x}), {lit(r'[^' + chr(92) + 'p{L}' + chr(92) + 'p{N}]+')})"
    return f"list_filter({split}, lambda w: w <> '')"


def contains_any(x: str, items) -> str:
    return "(" + " OR ".join(f"contains({x}, {lit(w)})" for w in items) + ")"


def squeezed(n: str) -> str:
    return f"replace({n}, ' ', '')"


def keyword(n: str, items) -> str:
    """Token or squeezed substring, both spelled out."""
    return f"(list_has_any({words(n)}, [{words_in(items)}]) OR {contains_any(squeezed(n), items)})"


def host(u: str) -> str:
    authority = f"coalesce(regexp_extract({u}, '^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)', 1), '')"
    return f"regexp_replace(lower({authority}), '^www\\.', '')"


def hits(t: str, items) -> str:
    return f"len(list_filter({t}, lambda w: w IN ({words_in(items)})))"


def category(t: str, items) -> str:
    return f"least(1.0::DOUBLE, 0.95::DOUBLE * {hits(t, items)})"


def urls(x: str) -> str:
    # Said anew: something with a scheme or www, or a host by its ending, not inside another word or address.
    begins = r"(?:^|[^[:alnum:].@/_-])"
    marked = r"(?:http://|https://|www\.)[^\s<>\"']+"
    host = rf"[[:alnum:]-]+(?:\.[[:alnum:]-]+)*\.(?:[[:alpha:]][[:alpha:]]|{'|'.join(LINK_TLDS)})\b"
    path = r"(?:[/?#:][^\s<>\"']*)?"
    found = f"regexp_extract_all({x}, {lit(f'(?i){begins}({marked}|{host}{path})')}, 1)"
    ends = r" .,;:!?()[]{}<>\"'|" + "\t\n\r\f\v"
    return f"list_transform({found}, lambda u: rtrim(u, {lit(ends)}))"


HASH = "CAST('0x' || substr(md5(CAST({k} AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296.0::DOUBLE"

# --- common table expressions ------------------------------------------------

TXN = """txn AS (SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id, value AS amount,
  ts AS event_time FROM events)"""
WINDOWS = f"""{TXN},
placed AS (SELECT *, unnest([date_trunc('day', event_time), date_trunc('day', event_time) - INTERVAL 1 DAY])
  AS window_start FROM txn),
win AS (SELECT user_id, window_start, window_start + INTERVAL 2 DAY AS window_end,
  count(transaction_id) AS txn_count, avg(amount) AS avg_amount FROM placed GROUP BY 1, 2)"""
FEATURES = f"""{WINDOWS},
feat AS (SELECT t.transaction_id, t.user_id, t.amount, t.event_time, w.window_start, w.window_end,
  w.txn_count, w.avg_amount FROM txn t JOIN win w ON t.user_id = w.user_id
  AND t.event_time >= w.window_start AND t.event_time <= w.window_end)"""
ALERTS = f"""{FEATURES},
alerts AS (SELECT * REPLACE (round(avg_amount, 6) AS avg_amount),
  coalesce(amount > {I.HIGH_AMOUNT} OR txn_count > {I.HIGH_COUNT}, false) AS is_fraud_alert,
  txn_count / 10.0::DOUBLE AS fraud_score FROM feat)"""

POSTS = """posts AS (SELECT e.event_id, e.ts AS event_time, d.text FROM events e JOIN documents d
  ON d.doc_id = e.event_id % (SELECT count(*) FROM documents) WHERE e.event_type IN ('click', 'error'))"""
SENTIMENT = (
    f"CASE WHEN {hits('w', I.POSITIVE)} > {hits('w', I.NEGATIVE)} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"
)
HYPE = f"""{POSTS},
social AS (SELECT event_id, event_time, {SENTIMENT} AS score FROM (SELECT *, {tokens('text')} AS w FROM posts)),
price AS (SELECT event_id, value AS price, ts AS event_time FROM events WHERE event_type IN ('view', 'purchase')),
pairs AS (SELECT time_bucket(INTERVAL {I.BUCKET_S} SECOND, p.event_time) AS time, p.price, s.score,
  p.event_id AS pid, s.event_id AS sid
  FROM price p JOIN social s
  ON time_bucket(INTERVAL {I.BUCKET_S} SECOND, p.event_time) = time_bucket(INTERVAL {I.BUCKET_S} SECOND, s.event_time)
  AND p.event_time BETWEEN s.event_time - INTERVAL {I.BUCKET_S} SECOND AND s.event_time + INTERVAL {I.BUCKET_S} SECOND),
hype AS (SELECT time, avg(price) AS avg_price, avg(score) AS hype_score FROM pairs GROUP BY 1)"""
INTERVALS = f"""WITH {HYPE} SELECT p.event_id AS price_id, s.event_id AS post_id, price, round(score, 6) AS sentiment_score
  FROM price p JOIN social s ON s.event_time >= p.event_time - INTERVAL {I.BEFORE_S} SECOND
  AND s.event_time <= p.event_time + INTERVAL {I.AFTER_S} SECOND"""
HYPE_ROUND = "time, round(avg_price, 6) AS avg_price, round(hype_score, 6) AS hype_score"

BARS = "bars AS (SELECT event_type AS symbol, ts, event_id AS bar_id, value AS close FROM events)"
RECENT = f"""{BARS},
newest AS (SELECT * FROM bars QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY ts DESC, bar_id DESC) <= 500),
recent AS (SELECT *, CASE WHEN count(close) OVER f = 50 THEN avg(close) OVER f END AS sma_50 FROM newest
  WINDOW f AS (PARTITION BY symbol ORDER BY ts, bar_id ROWS BETWEEN 49 PRECEDING AND CURRENT ROW))"""

COMMENTS = """comments AS (SELECT d.doc_id AS row_id, d.text AS body, d.source AS rule, l.toxic AS rule_violation
  FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""
LENGTHS = f"{COMMENTS}, len AS (SELECT rule_violation, CAST(length(body) AS INTEGER) AS body_length FROM comments)"
PREDICTIONS = f"""predictions AS (SELECT doc_id AS row_id, toxic AS true_label,
  ({HASH.format(k='doc_id')}) * 0.75::DOUBLE + toxic * 0.25::DOUBLE AS prob_violation FROM labels)"""
ERRORS = f"""{PREDICTIONS},
errors AS (SELECT *, CAST(prob_violation >= 0.5 AS INTEGER) AS predicted_label,
  CASE WHEN (prob_violation >= 0.5) = (true_label = 1) THEN {lit(V.CORRECT)}
       WHEN true_label = 0 THEN {lit(V.FALSE_POSITIVE)} ELSE {lit(V.FALSE_NEGATIVE)} END AS error_type
  FROM predictions)"""
PROMPTS = f"""{COMMENTS},
examples AS (SELECT rule,
  arg_min(body, row_id) FILTER (rule_violation = 1) AS p1, arg_max(body, row_id) FILTER (rule_violation = 1) AS p2,
  arg_min(body, row_id) FILTER (rule_violation = 0) AS n1, arg_max(body, row_id) FILTER (rule_violation = 0) AS n2
  FROM comments GROUP BY rule)"""


def prompt(tail: str = "") -> str:
    def part(x):
        return f"coalesce({clean(x)}, '')"

    return f"""WITH {PROMPTS}
SELECT row_id, 'COMMENT TO CLASSIFY: ' || {part('body')} || ' </s> RULE: ' || {part('c.rule')}
  || ' </s> POSITIVE EXAMPLES (Violation): ' || {part('p1')} || ' | ' || {part('p2')}
  || ' </s> NEGATIVE EXAMPLES (No Violation): ' || {part('n1')} || ' | ' || {part('n2')}{tail} AS prompt
FROM comments c LEFT JOIN examples x ON x.rule = c.rule"""


SPLIT = """sizes AS (SELECT toxic, count(*) AS n FROM labels GROUP BY 1),
shares AS (SELECT toxic, ceil(0.2 * (SELECT sum(n) FROM sizes)) * n / (SELECT sum(n) FROM sizes)::DOUBLE AS s FROM sizes),
wanted AS (SELECT toxic, floor(s) + CASE WHEN row_number() OVER (ORDER BY s - floor(s) DESC, toxic) <=
  (SELECT ceil(0.2 * (SELECT sum(n) FROM sizes)) - sum(floor(s)) FROM shares) THEN 1 ELSE 0 END AS k FROM shares),
split AS (SELECT l.doc_id AS row_id, l.toxic AS rule_violation, CASE WHEN row_number() OVER
  (PARTITION BY l.toxic ORDER BY md5(CAST(l.doc_id AS VARCHAR) || ':42')) <= w.k THEN 'val' ELSE 'train' END AS split
  FROM labels l JOIN wanted w ON w.toxic = l.toxic)"""

MESSAGES = """messages AS (SELECT d.doc_id AS message_id, d.source AS user_id, d.source || '-' || d.lang AS name,
  TIMESTAMP '2024-01-01 00:00:00' + to_minutes(d.doc_id) AS ts, concat_ws(' ', d.text, p.url) AS text
  FROM documents d LEFT JOIN pages p ON p.page_id = d.doc_id)"""
BAD_LINKS = f"""{MESSAGES},
threats AS (SELECT url, list_filter([CASE WHEN contains(url, 'utm_source') THEN 'SOCIAL_ENGINEERING' END,
  CASE WHEN contains(url, '/de/') THEN 'UNWANTED_SOFTWARE' END, CASE WHEN contains(url, 'cheap') THEN 'MALWARE' END],
  lambda x: x IS NOT NULL) AS kinds FROM (SELECT DISTINCT url FROM pages)),
found AS (SELECT DISTINCT message_id, unnest({urls('text')}) AS url FROM messages),
bad AS (SELECT f.message_id, count(DISTINCT f.url) AS n_malicious,
  array_to_string(list_sort(list_distinct(flatten(list(t.kinds)))), ', ') AS threats
  FROM found f JOIN threats t ON t.url = f.url WHERE len(t.kinds) > 0
  AND {host('f.url')} NOT IN ({words_in(I.TRUSTED)}) GROUP BY 1)"""
_LEX = V.TOXICITY_LEXICON
_TOXIC = " OR ".join(f"{category('w', _LEX[c])} > {t}" for c, t in V.TOXICITY_THRESHOLDS.items())
VERDICTS = f"""{BAD_LINKS},
normed AS (SELECT *, {norm('text')} AS n FROM messages),
checked AS (SELECT *, {tokens('n')} AS w FROM normed),
verdicts AS (SELECT c.message_id, c.user_id, c.name, c.ts, c.text AS content, b.threats, CASE
  WHEN b.message_id IS NOT NULL THEN {lit(V.MALICIOUS_LINK)}
  WHEN {keyword('n', I.ZERO_TOLERANCE)} THEN {lit(V.ZERO_TOLERANCE)}
  WHEN {contains_any('lower(c.text)', I.PHRASES)} THEN {lit(V.SPAM)}
  WHEN {keyword('n', V.TRIGGER_WORDS)} AND ({_TOXIC}) THEN {lit(V.TOXICITY)} END AS offense
  FROM checked c LEFT JOIN bad b ON b.message_id = c.message_id)"""
OFFENCES = f"""{VERDICTS},
offences AS (
  SELECT message_id, user_id, name, ts, 0 AS seq, offense, content, CASE offense
    WHEN {lit(V.SPAM)} THEN 1 WHEN {lit(V.TOXICITY)} THEN 3 ELSE 5 END AS points
  FROM verdicts WHERE offense IS NOT NULL
  UNION ALL
  SELECT l.doc_id, d.source, d.source || '-' || d.lang, TIMESTAMP '2024-01-01 00:00:00' + to_minutes(l.doc_id), 1,
    CASE WHEN toxic = 1 THEN {lit(V.MANUAL_ADJUSTMENT)} ELSE {lit(V.MANUAL_PARDON)} END, 'by hand',
    CASE WHEN toxic = 1 AND quality = 0 THEN 60 WHEN toxic = 1 THEN 4 ELSE -2 END
  FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""
SCORED = f"""{OFFENCES},
sums AS (SELECT *, sum(points) OVER (PARTITION BY user_id ORDER BY ts, message_id, seq) AS cs FROM offences),
scored AS (SELECT *, CAST(cs - least(0, min(cs) OVER (PARTITION BY user_id ORDER BY ts, message_id, seq)) AS BIGINT)
  AS score FROM sums)"""



def _draw(*parts: str) -> str:
    return f"CAST('0x' || substr(md5(concat_ws('|', {', '.join(parts)})), 1, 8) AS BIGINT)"


def _taken(wanted: str, rows: str) -> str:
    return f"floor(least(1.0::DOUBLE, ({wanted})::DOUBLE / (SELECT count(*) FROM {rows})) * 4294967296.0::DOUBLE)"


_AXES = "[a, c, b]"
_SPANS = "list_filter([{'i': 0, 'lo': min(x[1]), 'hi': max(x[1])}, {'i': 1, 'lo': min(x[2]), 'hi': max(x[2])}, {'i': 2, 'lo': min(x[3]), 'hi': max(x[3])}], lambda s: s.hi > s.lo)"


def _level(k: int) -> str:
    """Nodes of level k from the rows in them, and the rows of the next level."""
    inner = f"(len(spans) > 0 AND {k} < (SELECT depth FROM fit))"
    pick = f"spans[1 + {_draw('42', 'tree', 'node', chr(39) + 'feature' + chr(39))} % len(spans)]"
    width = f"{_draw('42', 'tree', 'node', chr(39) + 'cut' + chr(39))} / 4294967296.0::DOUBLE"
    return f"""
n{k} AS MATERIALIZED (SELECT tree, node, size, CASE WHEN {inner} THEN {pick} END AS s, {width} AS w
  FROM (SELECT tree, node, count(*) AS size, {_SPANS} AS spans FROM r{k} GROUP BY tree, node)),
r{k + 1} AS MATERIALIZED (SELECT r.tree, 2 * r.node + CASE WHEN x[s.i + 1] >= s.lo + w * (s.hi - s.lo) THEN 2 ELSE 1 END AS node, x
  FROM r{k} r JOIN n{k} n ON r.tree = n.tree AND r.node = n.node WHERE s IS NOT NULL)"""


def _route(k: int) -> str:
    """Rows to score, one level further down each tree."""
    return f"""
q{k + 1} AS MATERIALIZED (SELECT id, x, q.tree, node, length + CASE WHEN s IS NULL THEN 0 ELSE 1 END AS length,
  CASE WHEN s IS NULL THEN NULL WHEN x[s.i + 1] >= s.lo + w * (s.hi - s.lo) THEN 2 * node + 2 ELSE 2 * node + 1 END AS next,
  size, s IS NULL AS done FROM (SELECT id, x, tree, next AS at, length FROM q{k} WHERE NOT done) q
  LEFT JOIN n{k} n ON q.tree = n.tree AND q.at = n.node)"""


#: Depth of the trees: log2 of the sample of 256, rounded up; fewer rows make the lower levels empty.
_DEPTH = 8
_PATH = """CASE WHEN size > 2 THEN 2 * (ln(size - 1.0::DOUBLE) + 0.5772156649015329::DOUBLE) - 2 * (size - 1.0::DOUBLE) / size
  WHEN size = 2 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END"""
FOREST = f"""WITH {FEATURES},
pts AS MATERIALIZED (SELECT transaction_id || '@' || CAST(window_start AS VARCHAR) AS id, coalesce(amount, 0) AS a, txn_count, CAST(txn_count AS DOUBLE) AS c,
  round(avg_amount, 6) AS avg_amount, coalesce(round(avg_amount, 6), 0) AS b, amount FROM feat),
fit AS (SELECT least(256, count(*)) AS sample, ceil(log2(greatest(2, least(256, count(*))))) AS depth FROM pts),
pool AS MATERIALIZED (SELECT id, {_AXES} AS x FROM pts WHERE {_draw("42", "'pool'", "id")} < {_taken("1.5::DOUBLE * 100 * 256", "pts")}),
r0 AS MATERIALIZED (SELECT tree, 0 AS node, x FROM (SELECT *, row_number() OVER (PARTITION BY tree ORDER BY d, id) AS k FROM (
  SELECT id, x, tree, {_draw("42", "'tree'", "tree", "id")} AS d FROM pool, range(100) t(tree))
  WHERE d < {_taken("1.5::DOUBLE * 256 + 50", "pool")}) WHERE k <= 256),
{",".join(_level(k) for k in range(_DEPTH + 1))},
q0 AS (SELECT id, {_AXES} AS x, tree, 0 AS next, 0 AS length, false AS done FROM pts, range(100) t(tree)),
{",".join(_route(k) for k in range(_DEPTH + 1))},
ends AS ({" UNION ALL ".join(f"SELECT id, length, size FROM q{k} WHERE done" for k in range(1, _DEPTH + 2))}),
mean AS (SELECT id, sum(length + {_PATH}) AS total FROM ends GROUP BY id),
norm AS (SELECT {_PATH} AS c FROM (SELECT sample AS size FROM fit)),
scored AS (SELECT id, round(pow(2.0::DOUBLE, -total / (100 * CASE WHEN c = 0 THEN 1 ELSE c END)), 6) AS s FROM mean, norm)
SELECT r.id AS row_key, r.amount, r.txn_count, r.avg_amount, s AS anomaly_score,
  s > (SELECT quantile_cont(s, 0.9) FROM scored) AS is_anomaly FROM pts r JOIN scored ON r.id = scored.id"""
USER_FEATURES = f"WITH {WINDOWS} SELECT * REPLACE (round(avg_amount, 6) AS avg_amount) FROM win"
LATEST_ALERTS = f"""WITH {ALERTS} SELECT * FROM alerts WHERE is_fraud_alert
  ORDER BY event_time DESC, transaction_id DESC, window_start DESC LIMIT 10"""
USER_STATS = f"""WITH {SCORED} SELECT user_id, arg_max(score, (ts, message_id, seq)) AS behavior_score
  FROM scored GROUP BY 1"""


def sma(n: int) -> str:
    return f"""WITH {BARS} SELECT symbol, ts, bar_id, close,
  CASE WHEN count(close) OVER f = {n} THEN round(avg(close) OVER f, 6) END AS sma_{n} FROM bars
  WINDOW f AS (PARTITION BY symbol ORDER BY ts, bar_id ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"""


def quantile(p: float) -> str:
    return f"round(quantile_cont(body_length, {p}), 6)"


def top_errors(kind: str, direction: str) -> str:
    return f"""WITH {COMMENTS}, {ERRORS} SELECT e.row_id, c.rule, e.prob_violation, {redact('c.body')} AS body
  FROM errors e JOIN comments c ON c.row_id = e.row_id WHERE error_type = {lit(kind)}
  ORDER BY prob_violation {direction}, e.row_id LIMIT 5"""


def audit_columns() -> str:
    out = []
    scores = {c: category("w", words) for c, words in _LEX.items()}
    scores["toxicity"] = f"greatest({', '.join(scores.values())})"
    for c in V.AUDIT_CATEGORIES:
        out.append(f"printf('%.4f', {scores[c]}) AS {c}_score, {scores[c]} > {V.AUDIT_FLAG_THRESHOLD} AS {c}_flag")
    return ", ".join(out)


_MAX_BODY = V.MAX_TOKENS - 2
_LINKED = f"CASE WHEN {redact('body')} <> body THEN 1 ELSE 0 END"

ORACLES: dict[str, str] = {
    "json_decode": "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events",
    "parse_event_time": """SELECT event_id, ts AS from_text,
  date_trunc('second', ts) + INTERVAL 123 MILLISECOND AS from_epoch,
  date_trunc('second', ts) + INTERVAL 5 MILLISECOND AS from_millis, CAST(NULL AS TIMESTAMP) AS from_junk FROM events""",
    "keyed_json_flatten": """SELECT event_type AS symbol, strftime(ts, '%Y-%m-%d') AS date, value AS open,
  value + 1 AS high, CASE WHEN event_type <> 'click' THEN value - 1 END AS low, value AS close,
  CAST(event_id AS DOUBLE) AS volume FROM events WHERE event_type <> 'error'""",
    "alert_json": f"WITH {ALERTS} SELECT transaction_id, user_id, amount, is_fraud_alert, fraud_score FROM alerts",
    "ledger_rows": r"""SELECT CAST(c_custkey AS VARCHAR) AS user_id, any_value(c_name) AS name, count(*) AS behavior_score,
  CAST(count(*) AS INTEGER) AS n_entries, CAST(sum(o_orderkey % 7) AS BIGINT) AS points,
  string_agg(o_orderpriority, ',' ORDER BY o_orderkey) AS offenses,
  '"' || arg_min(o_orderstatus, o_orderkey) || '\}, {' AS content, strftime(max(o_orderdate), '%Y-%m-%d') AS last
  FROM customer JOIN orders ON o_custkey = c_custkey GROUP BY c_custkey""",
    "user_window_features": USER_FEATURES,
    "fraud_features": f"WITH {FEATURES} SELECT * REPLACE (round(avg_amount, 6) AS avg_amount) FROM feat",
    "fraud_alerts": f"WITH {ALERTS} SELECT * FROM alerts",
    "fraud_alerts_once": f"""WITH {ALERTS} SELECT transaction_id, any_value(user_id) AS user_id,
  any_value(amount) AS amount, bool_or(is_fraud_alert) AS is_fraud_alert, max(fraud_score) AS fraud_score
  FROM alerts GROUP BY 1""",
    "latest_alerts": LATEST_ALERTS,
    "time_bucket": "SELECT event_id, CAST(floor(epoch(ts) / 10) * 10 AS BIGINT) AS bucket FROM events",
    "hype_pairs": f"""WITH {HYPE} SELECT time, round(avg(price), 6) AS avg_price, round(avg(score), 6) AS hype_score,
  count(DISTINCT pid) AS n_price, count(DISTINCT sid) AS n_social, count(*) AS n_pairs FROM pairs GROUP BY 1""",
    "hype_interval_join": INTERVALS,
    "hype_meter": f"WITH {HYPE} SELECT {HYPE_ROUND} FROM hype",
    "latest_hype": f"""WITH {HYPE} SELECT * FROM (SELECT {HYPE_ROUND} FROM hype ORDER BY time DESC LIMIT 100)
  ORDER BY time""",
    "current_metric": f"""WITH {HYPE} SELECT time, '$' || format('{{:,.2f}}', avg_price) AS price,
  round(hype_score, 6) AS hype_score FROM hype ORDER BY time DESC LIMIT 1""",
    "sma_20": sma(20),
    "sma_50": sma(50),
    "daily_return": f"""WITH {BARS},
filled AS (SELECT *, last_value(close IGNORE NULLS) OVER (PARTITION BY symbol ORDER BY ts, bar_id
  ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS f FROM bars)
SELECT symbol, ts, bar_id, close, CASE WHEN p <> 0 THEN round(f / p - 1, 6) WHEN p = 0 AND f > 0 THEN 'inf'::DOUBLE
  WHEN p = 0 AND f < 0 THEN '-inf'::DOUBLE END AS daily_return
  FROM (SELECT *, lag(f) OVER (PARTITION BY symbol ORDER BY ts, bar_id) AS p FROM filled)""",
    "recent_bars": f"WITH {RECENT} SELECT * REPLACE (round(sma_50, 6) AS sma_50) FROM recent",
    "series_payload": f"""WITH {RECENT} SELECT symbol,
  string_agg(strftime(ts, '%Y-%m-%d'), ',' ORDER BY ts, bar_id) AS dates,
  string_agg(coalesce(printf('%.2f', close), 'null'), ',' ORDER BY ts, bar_id) AS closes,
  string_agg(coalesce(printf('%.4f', sma_50), 'null'), ',' ORDER BY ts, bar_id) AS sma_prices
  FROM recent GROUP BY symbol""",
    "unknown_symbols": """SELECT r_name AS symbol, 'no data found for symbol ' || r_name AS reason FROM region
  UNION ALL SELECT '', 'no symbol given'""",
    "table_profile": f"""WITH {COMMENTS}
SELECT 'row_id' AS column_name, 'bigint' AS data_type, count(row_id) AS non_null FROM comments
UNION ALL SELECT 'body', 'string', count(body) FROM comments
UNION ALL SELECT 'rule', 'string', count(rule) FROM comments
UNION ALL SELECT 'rule_violation', 'int', count(rule_violation) FROM comments""",
    "preview_rows": f"WITH {COMMENTS} SELECT row_id, body, rule, rule_violation FROM comments ORDER BY row_id LIMIT 5",
    "distinct_rules": f"WITH {COMMENTS} SELECT count(DISTINCT rule) AS distinct_rule FROM comments",
    "value_counts": f"WITH {COMMENTS} SELECT rule, count(*) AS n FROM comments GROUP BY 1 ORDER BY 2 DESC, 1",
    "class_balance": """SELECT toxic AS rule_violation, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM labels), 2) AS percent FROM labels GROUP BY 1""",
    "imbalance_ratio": """SELECT printf('%.2f : %.2f', 100 - avg(toxic) * 100, avg(toxic) * 100) AS ratio FROM labels""",
    "violation_rate": f"""WITH {COMMENTS} SELECT rule, count(rule_violation) AS total_samples,
  round(avg(rule_violation), 6) AS violation_rate FROM comments GROUP BY 1 ORDER BY 3 DESC, 1""",
    "text_lengths": f"""WITH {COMMENTS} SELECT row_id, CAST(length(body) AS INTEGER) AS body_length,
  CAST(len({words('body')}) AS INTEGER) AS body_word_count FROM comments""",
    "length_describe": f"""WITH {LENGTHS} SELECT count(*) AS count, round(avg(body_length), 6) AS mean,
  round(stddev_samp(body_length), 6) AS std, min(body_length) AS min, {quantile(0.25)} AS p25, {quantile(0.5)} AS p50,
  {quantile(0.75)} AS p75, max(body_length) AS max FROM len""",
    "price_describe": """SELECT count(*) AS count, round(avg(o_totalprice), 6) AS mean, round(stddev_samp(o_totalprice), 6) AS std,
  min(o_totalprice) AS min, round(quantile_cont(o_totalprice, 0.25), 6) AS p25, round(quantile_cont(o_totalprice, 0.5), 6) AS p50,
  round(quantile_cont(o_totalprice, 0.75), 6) AS p75, max(o_totalprice) AS max FROM orders""",
    "value_box": """WITH q AS (SELECT event_type, quantile_cont(value, 0.25) AS q1, quantile_cont(value, 0.5) AS m,
  quantile_cont(value, 0.75) AS q3 FROM events GROUP BY 1),
j AS (SELECT *, value BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside FROM events JOIN q USING (event_type))
SELECT event_type, round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median, round(any_value(q3), 6) AS q3,
  min(value) FILTER (inside) AS whisker_low, max(value) FILTER (inside) AS whisker_high, count(*) FILTER (NOT inside) AS outliers
  FROM j GROUP BY 1""",
    "value_quantiles": """SELECT user_id, count(value) AS n, round(min(value), 6) AS low, round(quantile_cont(value, 0.01), 6) AS p1,
  round(quantile_cont(value, 0.5), 6) AS p50, round(quantile_cont(value, 0.9), 6) AS p90,
  round(quantile_cont(value, 0.99), 6) AS p99, round(max(value), 6) AS high FROM events GROUP BY 1""",
    "length_histogram": f"""WITH {LENGTHS}, b AS (SELECT min(body_length) AS lo, max(body_length) AS hi FROM len)
SELECT rule_violation, CAST(least(49, floor((body_length - lo) * 50 / (hi - lo)::DOUBLE)) AS INTEGER) AS bin,
  count(*) AS n FROM len, b GROUP BY 1, 2""",
    "length_box": f"""WITH {LENGTHS}, q AS (SELECT rule_violation, quantile_cont(body_length, 0.25) AS q1,
  quantile_cont(body_length, 0.5) AS m, quantile_cont(body_length, 0.75) AS q3 FROM len GROUP BY 1),
j AS (SELECT *, body_length BETWEEN q1 - 1.5::DOUBLE * (q3 - q1) AND q3 + 1.5::DOUBLE * (q3 - q1) AS inside
  FROM len JOIN q USING (rule_violation))
SELECT rule_violation, round(any_value(q1), 6) AS q1, round(any_value(m), 6) AS median, round(any_value(q3), 6) AS q3,
  min(body_length) FILTER (inside) AS whisker_low, max(body_length) FILTER (inside) AS whisker_high,
  count(*) FILTER (NOT inside) AS outliers FROM j GROUP BY 1""",
    "phrase_table_hits": """WITH b AS (SELECT string_split(lower(text), ' ') AS w FROM benchmark),
p AS (SELECT DISTINCT array_to_string(w[i:i + 2], ' ') AS phrase FROM (SELECT w, unnest(range(1, len(w) - 1)) AS i FROM b))
SELECT doc_id, count(*) AS n_found, min(phrase) AS first_found FROM documents d JOIN p ON contains(lower(d.text), phrase) GROUP BY 1""",
    "word_table_hits": """WITH b AS (SELECT DISTINCT unnest(string_split(lower(text), ' ')) AS word FROM benchmark),
t AS (SELECT DISTINCT doc_id, unnest(string_split(lower(text), ' ')) AS word FROM documents)
SELECT doc_id, count(*) AS n_found, min(word) AS first_found FROM t JOIN b USING (word) GROUP BY 1""",
    "clean_html": f"SELECT page_id, {clean('html')} AS cleaned FROM pages",
    "redact_links": f"SELECT doc_id, {redact('text')} AS redacted FROM documents",
    "leet_normalize": f"""SELECT doc_id, {norm('text')} AS normalized, {squeezed(norm('text'))} AS squeezed
  FROM documents""",
    "keyword_hits": f"""WITH n AS (SELECT doc_id, {norm('text')} AS n FROM documents),
h AS (SELECT doc_id, list_has_any({words('n')}, [{words_in(V.TRIGGER_WORDS)}]) AS token_hit,
  {contains_any(squeezed('n'), V.TRIGGER_WORDS)} AS squeezed_hit FROM n)
SELECT *, token_hit OR squeezed_hit AS hit FROM h""",
    "spam_hits": f"SELECT doc_id, {contains_any('lower(text)', I.PHRASES)} AS spam FROM documents",
    "extract_urls": f"SELECT page_id, unnest({urls('url || chr(32) || html')}) AS found FROM pages",
    "url_host": f"SELECT page_id, {host('url')} AS host FROM pages",
    "normalize_domain": """SELECT page_id, regexp_replace(split_part(replace(replace(lower(url), 'https://', ''),
  'http://', ''), '/', 1), '^www\\.', '') AS domain FROM pages""",
    "allow_list": f"""SELECT unnest([{words_in(I.TRUSTED)}]) AS domain UNION SELECT regexp_replace(split_part(
  replace(replace(lower(url), 'https://', ''), 'http://', ''), '/', 1), '^www\\.', '') FROM pages""",
    "untrusted_urls": f"SELECT page_id, url FROM pages WHERE {host('url')} NOT IN ({words_in(I.TRUSTED)})",
    "malicious_links": f"WITH {BAD_LINKS} SELECT message_id, n_malicious, threats FROM bad",
    "truncate_tokens": f"""WITH t AS (SELECT doc_id, list_slice({tokens('text')}, 1, {V.MAX_TOKENS}) AS t FROM documents)
SELECT doc_id, CAST(len(t) AS INTEGER) AS n_tokens, array_to_string(t, ' ') AS tokens FROM t""",
    "encode_tokens": f"""WITH {COMMENTS},
t AS (SELECT row_id, list_slice({tokens('body')}, 1, {_MAX_BODY}) AS t FROM comments)
SELECT row_id, array_to_string(list_concat(list_concat([0],
  list_transform(t, lambda w: CAST('0x' || substr(md5(w), 1, 4) AS INTEGER) + 3)), list_concat([2],
  list_transform(range({_MAX_BODY} - len(t)), lambda i: 1))), ' ') AS input_ids, CAST(len(t) + 2 AS INTEGER) AS n_used FROM t""",
    "sentiment_model_score": f"""WITH {POSTS} SELECT event_id, {SENTIMENT} AS sentiment_score
  FROM (SELECT event_id, {tokens('text')} AS w FROM posts)""",
    "requested_bars": """SELECT upper(event_type) AS symbol, event_id AS bar_id, value AS close FROM events
  WHERE event_type IN ('view', 'purchase')""",
    "fraud_features_default": """WITH txn AS (SELECT CAST(event_id AS VARCHAR) AS transaction_id, user_id % 3 AS user_id,
  value AS amount, CASE WHEN event_id % 7 = 0 THEN time_bucket(INTERVAL 5 MINUTE, ts) ELSE ts END AS event_time FROM events),
placed AS (SELECT *, unnest([time_bucket(INTERVAL 5 MINUTE, event_time),
  time_bucket(INTERVAL 5 MINUTE, event_time) - INTERVAL 5 MINUTE]) AS window_start FROM txn),
win AS (SELECT user_id, window_start, window_start + INTERVAL 10 MINUTE AS window_end,
  count(transaction_id) AS txn_count, avg(amount) AS avg_amount FROM placed GROUP BY 1, 2)
SELECT t.transaction_id, t.user_id, t.amount, t.event_time, w.window_start, w.window_end, w.txn_count,
  round(w.avg_amount, 6) AS avg_amount FROM txn t JOIN win w ON t.user_id = w.user_id
  AND t.event_time >= w.window_start AND t.event_time <= w.window_end""",
    "sentiment_score": f"""WITH {POSTS} SELECT event_id, {SENTIMENT} AS sentiment_score
  FROM (SELECT event_id, {tokens('text')} AS w FROM posts)""",
    "toxicity_scores": f"""WITH t AS (SELECT doc_id, {tokens('text')} AS w FROM documents),
s AS (SELECT doc_id, {', '.join(f'{category("w", words)} AS {c}' for c, words in _LEX.items())} FROM t)
{' UNION ALL '.join(f"SELECT doc_id, {lit(c)} AS category, {c} AS score FROM s" for c in _LEX)}
UNION ALL SELECT doc_id, 'toxicity', greatest({', '.join(_LEX)}) FROM s""",
    "text_audit": f"""WITH n AS (SELECT doc_id, {norm('text')} AS normalized FROM documents),
t AS (SELECT *, {tokens('normalized')} AS w FROM n)
SELECT doc_id, normalized, {keyword('normalized', V.TRIGGER_WORDS)} AS fast_trigger, {audit_columns()} FROM t""",
    "fewshot_prompt": prompt(),
    "url_flag_prompt": prompt(f" || ' </s> URL_PRESENT: ' || ({_LINKED})"),
    "stratified_split": f"WITH {SPLIT} SELECT row_id, rule_violation, split FROM split",
    "split_summary": f"""WITH {SPLIT} SELECT split, count(*) AS n, round(avg(rule_violation), 6) AS violation_rate
  FROM split GROUP BY 1""",
    "softmax_prob": f"""WITH {PREDICTIONS}, x AS (SELECT row_id, (prob_violation - 0.5) * 4 AS x FROM predictions)
SELECT row_id, round(exp(x) / (exp(x) + exp(-x)), 6) AS prob_violation FROM x""",
    "prediction_join": f"""WITH {COMMENTS}, {PREDICTIONS} SELECT p.row_id, true_label, prob_violation, body, rule,
  rule_violation FROM predictions p JOIN comments c ON c.row_id = p.row_id""",
    "error_types": f"WITH {ERRORS} SELECT row_id, true_label, prob_violation, predicted_label, error_type FROM errors",
    "error_distribution": f"""WITH {ERRORS} SELECT error_type, count(*) AS n,
  round(count(*) * 100.0::DOUBLE / (SELECT count(*) FROM errors), 2) AS percent FROM errors GROUP BY 1""",
    "top_false_positives": top_errors(V.FALSE_POSITIVE, "DESC"),
    "top_false_negatives": top_errors(V.FALSE_NEGATIVE, "ASC"),
    "auc": f"""WITH {PREDICTIONS}, g AS (SELECT prob_violation AS s, count(*) AS n, sum(true_label) AS pos
  FROM predictions GROUP BY 1),
r AS (SELECT pos, sum(n) OVER (ORDER BY s) - n + (n + 1) / 2.0::DOUBLE AS mean_rank FROM g),
c AS (SELECT sum(true_label)::DOUBLE AS p, (count(*) - sum(true_label))::DOUBLE AS q FROM predictions)
SELECT round((sum(pos * mean_rank) - any_value(p) * (any_value(p) + 1) / 2) / (any_value(p) * any_value(q)), 6) AS auc
  FROM r, c""",
    "evaluation": f"""WITH {PREDICTIONS}, g AS (SELECT prob_violation AS s, count(*) AS n, sum(true_label) AS pos
  FROM predictions GROUP BY 1),
r AS (SELECT pos, sum(n) OVER (ORDER BY s) - n + (n + 1) / 2.0::DOUBLE AS mean_rank FROM g),
c AS (SELECT sum(true_label)::DOUBLE AS p, (count(*) - sum(true_label))::DOUBLE AS q FROM predictions),
a AS (SELECT (sum(pos * mean_rank) - any_value(p) * (any_value(p) + 1) / 2) / (any_value(p) * any_value(q)) AS auc FROM r, c),
e AS (SELECT true_label AS t, prob_violation >= 0.5 AS hit FROM predictions)
SELECT count(*) AS n, round(avg(CASE WHEN hit = (t = 1) THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END), 6) AS accuracy,
  count(*) FILTER (hit AND t = 0) AS false_positives, count(*) FILTER (NOT hit AND t = 1) AS false_negatives,
  round((SELECT auc FROM a), 6) AS auc FROM e""",
    "action_routing": f"""WITH {PREDICTIONS} SELECT row_id, CASE WHEN prob_violation > 0.95 THEN 'auto_remove'
  WHEN prob_violation >= 0.5 THEN 'review' ELSE 'keep' END AS action FROM predictions""",
    "uncertainty_band": f"WITH {PREDICTIONS} SELECT * FROM predictions WHERE prob_violation BETWEEN 0.4 AND 0.6",
    "prediction_records": f"""WITH {COMMENTS}, {PREDICTIONS} SELECT p.row_id, prob_violation >= 0.5 AS violation_predicted,
  rule, round(prob_violation, 4) AS confidence_score FROM predictions p JOIN comments c ON c.row_id = p.row_id""",
    "hybrid_scores": f"""WITH {COMMENTS}, {PREDICTIONS} SELECT p.row_id, rule, CASE WHEN rule IN ('src1', 'src2')
  THEN CAST({_LINKED} AS DOUBLE) ELSE prob_violation END AS score
  FROM predictions p JOIN comments c ON c.row_id = p.row_id""",
    "moderation_verdict": f"WITH {VERDICTS} SELECT message_id, user_id, name, ts, offense, threats FROM verdicts",
    "offence_points": f"""WITH {OFFENCES} SELECT message_id, seq, user_id, offense, points,
  CASE WHEN points < 0 THEN 'green' WHEN points >= 50 THEN 'red' ELSE 'orange' END AS colour FROM offences""",
    "behavior_score": f"WITH {SCORED} SELECT user_id, message_id, seq, points, score FROM scored",
    "user_stats": USER_STATS,
    "recent_history": f"""WITH {SCORED}, r AS (SELECT *,
  row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, message_id DESC, seq DESC) AS rank FROM scored)
SELECT user_id, CAST(rank AS INTEGER) AS rank, first_value(score) OVER (PARTITION BY user_id ORDER BY rank) AS total_score,
  strftime(ts, '%Y-%m-%d %H:%M') || ' | ' || offense || ' (' || printf('%+d', points) || ')' AS title, content
  FROM r WHERE rank <= 5""",
    "offender_ledger": f"""WITH {SCORED} SELECT user_id, arg_min(name, (ts, message_id, seq)) AS name,
  arg_max(score, (ts, message_id, seq)) AS behavior_score, count(*) AS n_offences FROM scored GROUP BY 1""",
    "history_pages": f"""WITH {OFFENCES}, p AS (SELECT *, (row_number() OVER (PARTITION BY user_id
  ORDER BY ts, message_id, seq) - 1) // 10 AS page FROM offences)
SELECT user_id, page, CAST(count(*) AS INTEGER) AS n_entries, string_agg(offense, ',' ORDER BY ts, message_id, seq) AS offenses
  FROM p GROUP BY 1, 2""",
    "history_pages_bytes": f"""WITH {OFFENCES}, b AS (SELECT *, coalesce(strlen(content), 0) AS size, size * 2 > {I.PAGE_BYTES} AS big,
  row_number() OVER u AS pos FROM offences WINDOW u AS (PARTITION BY user_id ORDER BY ts, message_id, seq)),
p AS (SELECT *, sum(big::INT) OVER u - big::INT AS bigs, (sum(CASE WHEN big THEN 0 ELSE size END) OVER u
  - CASE WHEN big THEN 0 ELSE size END) * 2 // {I.PAGE_BYTES} AS half FROM b
  WINDOW u AS (PARTITION BY user_id ORDER BY pos))
SELECT user_id, min(pos) AS first_position, CAST(sum(size) AS BIGINT) AS n_bytes, CAST(count(*) AS INTEGER) AS n_entries,
  string_agg(offense, ',' ORDER BY pos) AS offenses FROM p GROUP BY user_id, bigs, half, big""",
    "training_union": f"""WITH {FEATURES} SELECT 'normal' AS kind, amount, CAST(txn_count AS DOUBLE) AS txn_count,
  round(avg_amount, 6) AS avg_amount FROM feat
UNION ALL SELECT 'outlier', max(o_totalprice), CAST(count(*) AS DOUBLE), round(avg(o_totalprice), 6)
  FROM orders GROUP BY o_custkey""",
    "isolation_forest_scores": FOREST,
    "stream_user_features": USER_FEATURES,
    "stream_fraud_alerts": f"WITH {ALERTS} SELECT * FROM alerts",
    "stream_hype_interval_join": INTERVALS,
    "stream_until_marker": """SELECT event_id, event_type, value FROM events
  WHERE event_id <= (SELECT floor(max(event_id) * 0.8) FROM events)""",
    "stream_hype_meter": f"WITH {HYPE} SELECT {HYPE_ROUND} FROM hype",
    "stream_behavior_score": USER_STATS,
    "stream_latest_alerts": LATEST_ALERTS,
}
ORACLES.update({f"{name}_split": ORACLES[name] for name in ("behavior_score", "sma_20", "daily_return", "history_pages", "history_pages_bytes")})
