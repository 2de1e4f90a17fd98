"""The same queries as SQL over views named like the tables."""

from __future__ import annotations

from logweave.catalogue.inputs import ADJECTIVES, MASKED, NOUNS
from logweave.operators.recommend import MATCH_REASON, STOCK_REASON


def _array(words) -> str:
    return "[" + ", ".join(f"'{w}'" for w in words) + "]"


def _noun(index: str) -> str:
    return f"{_array(NOUNS)}[CAST(({index}) % 8 + 1 AS INT)]"


def _adjective(index: str, size: int = 8) -> str:
    return f"{_array(ADJECTIVES)}[CAST(({index}) % {size} + 1 AS INT)]"


EV = """ev AS (
  SELECT event_id, ts, user_id, event_type, value, props,
         CAST(json_extract_string(props, '$.k') AS INT) AS k, epoch_us(ts) AS pos
  FROM events)"""
CLIENT = f"""client AS (
  SELECT event_id AS request_id, user_id, ts AS requested_at,
         CASE WHEN event_type = 'view' THEN 'search' ELSE event_type END AS request_type,
         CASE WHEN event_type = 'view' THEN {_noun('k')} END AS query
  FROM ev)"""
SEARCHES = """searches AS (
  SELECT user_id, query FROM (
    SELECT user_id, query, row_number() OVER (
      PARTITION BY user_id ORDER BY requested_at DESC, request_id DESC) AS n
    FROM client WHERE request_type = 'search') WHERE n = 1)"""
USERS = """users AS (
  SELECT u.user_id, s.query
  FROM (SELECT DISTINCT user_id FROM client WHERE user_id IS NOT NULL) u
  LEFT JOIN searches s ON u.user_id = s.user_id)"""
DENY = """deny AS (
  SELECT k AS key, k AS product_id, pos, event_id AS seq, 'r' || (event_id % 10) AS reason,
         CASE event_type WHEN 'signup' THEN 'add' WHEN 'error' THEN 'remove' ELSE event_type END AS action
  FROM ev)"""
BLOCK = """block AS (
  SELECT CAST(user_id AS VARCHAR) AS usr, CAST(k AS VARCHAR) AS blocked, pos, event_id AS seq,
         event_type = 'click' AS is_on
  FROM ev WHERE event_type IN ('click', 'purchase'))"""
MESSAGES = f"""messages AS (
  SELECT event_id AS message_id, CAST(user_id AS VARCHAR) AS recipient_id,
         CAST(k AS VARCHAR) AS sender_id, pos, event_id AS seq,
         {_adjective('event_id')} || ' ' || {_noun('k')} || ' ' || event_type AS text
  FROM ev WHERE event_type = 'view')"""
UPDATES = f"""updates AS (
  SELECT CASE WHEN event_id % 7 = 0 THEN 'other' ELSE 'global' END AS key,
         list_distinct([{_noun('k')}, {_adjective('k % 5')}]) AS words, event_id AS seq, pos,
         CASE WHEN event_id % 500 = 0 THEN 'replace' WHEN event_type IN ('signup', 'click') THEN 'add'
              WHEN event_type = 'error' THEN 'remove' ELSE event_type END AS action
  FROM ev),
known AS (SELECT * FROM updates WHERE action IN ('replace', 'add', 'remove')),
changes AS (SELECT key, unnest(words) AS word, action <> 'remove' AS is_on, seq, pos FROM known),
active AS (
  SELECT c.key, c.word
  FROM (SELECT key, word, arg_max(is_on, seq) AS is_on, max(seq) AS seq FROM changes GROUP BY ALL) c
  LEFT JOIN (SELECT key, max(seq) AS since FROM known WHERE action = 'replace' GROUP BY key) r
    ON c.key = r.key
  WHERE c.is_on AND c.seq >= coalesce(r.since, -1))"""
LOG = """log AS (
  SELECT event_type AS topic, CAST(user_id % 3 AS INT) AS partition, CAST(user_id AS VARCHAR) AS key,
         props AS value, ts, event_id, k,
         row_number() OVER (PARTITION BY event_type, user_id % 3 ORDER BY event_id) - 1 AS "offset"
  FROM ev)"""
GAPS = """gaps AS (
  SELECT event_id, partition, "offset", CASE WHEN topic <> 'error' THEN topic END AS topic,
         CASE WHEN event_id % 19 <> 0 THEN ts END AS ts, CASE WHEN event_id % 7 <> 0 THEN value END AS value
  FROM log)"""
NAMED = """named AS (
  SELECT * REPLACE (CASE topic WHEN 'view' THEN 'products.filtered' WHEN 'click' THEN 'client.events'
                    ELSE topic END AS topic) FROM log),
mirrored AS (
  SELECT * REPLACE ('primary.' || topic AS topic) FROM named
  WHERE topic IN ('products.filtered', 'client.events'))"""
ALERTS = """alerts AS (
  SELECT event_id, CASE WHEN k % 3 = 0 THEN 'resolved' ELSE 'firing' END AS status,
         event_type AS alertname, CAST(user_id % 3 AS VARCHAR) AS cluster,
         CAST(user_id AS VARCHAR) AS instance, pos, k
  FROM ev)"""


def _rates(keys: str, seconds: int, jump: str = "NULL", at: str = "pos") -> str:
    return f"""grown AS (
  SELECT event_type, event_id, {at} AS pos, 'c' || (user_id % 4) AS cluster,
    CASE WHEN event_id % 97 = 0 THEN NULL WHEN event_id % 1009 = 0 AND {jump} IS NOT NULL THEN {jump} ELSE CAST(sum(
      CAST(round(value * 100) AS BIGINT)) OVER (PARTITION BY event_type, event_id // 1000 ORDER BY event_id) AS DOUBLE)
    END AS counter
  FROM ev),
steps AS (
  SELECT *, last_value(counter IGNORE NULLS) OVER (
    PARTITION BY {keys} ORDER BY pos, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM grown),
rates AS (
  SELECT event_type, cluster, event_id, pos, sum(CASE WHEN prev IS NULL OR counter IS NULL THEN 0.0
      WHEN counter < prev THEN counter ELSE counter - prev END) OVER (
    PARTITION BY {keys} ORDER BY pos RANGE BETWEEN {seconds}000000 PRECEDING AND CURRENT ROW) / {seconds} AS rate
  FROM steps)"""


RATES = _rates("event_type", 3600)
JUMPS = _rates("event_type", 3600, "1e17", "pos // 1800000000 * 1800000000")
PUNCTUATED = "lambda acc, w: regexp_replace(acc, '(?i)\\b' || w || '\\b', repeat('*', length(w)), 'g')"


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _masked(words: str, text: str = "text") -> str:
    return f"list_reduce(list_prepend({text}, {words}), {PUNCTUATED})"


def _as_of_words(messages: str) -> str:
    """Messages of a relation with the shared words in force at their time."""
    return f"""
era AS (
  SELECT m.message_id, r.seq AS since FROM {messages} m
  ASOF LEFT JOIN (SELECT 1 AS one, pos, seq FROM known WHERE action = 'replace' AND key = 'global') r
    ON r.one = m.one AND m.pos >= r.pos),
vocabulary AS (SELECT DISTINCT word FROM changes WHERE key = 'global'),
seen AS (
  SELECT m.message_id, m.word, c.is_on, c.seq
  FROM (SELECT message_id, pos, word FROM {messages}, vocabulary) m
  ASOF LEFT JOIN (SELECT * FROM changes WHERE key = 'global') c ON c.word = m.word AND m.pos >= c.pos),
lists AS (
  SELECT seen.message_id, list_sort(list(word)) AS words
  FROM seen JOIN era ON seen.message_id = era.message_id
  WHERE is_on AND seq >= coalesce(since, -1) GROUP BY seen.message_id)"""


_ASOF_BLOCK = """kept AS (
  SELECT m.*, 1 AS one FROM messages m
  ASOF LEFT JOIN block b
    ON b.usr = m.recipient_id AND b.blocked = m.sender_id AND m.pos >= b.pos
  WHERE NOT coalesce(b.is_on, false))"""

_MUTATED = """
  SELECT CAST(p_partkey AS BIGINT) AS n, CAST(p_partkey AS VARCHAR) AS id, p_retailprice AS price,
    CASE WHEN p_partkey % 23 = 0 THEN 'field of another JSON type than declared'
         WHEN p_partkey % 29 = 0 THEN 'not a JSON record of the declared types'
         WHEN p_partkey % 17 = 0 THEN 'product_id is required'
         WHEN p_partkey % 19 = 0 THEN 'name is required'
         WHEN p_partkey % 13 = 0 THEN 'price.amount must not be negative'
         WHEN p_partkey % 11 = 0 THEN 'store_id is required' ELSE 'ok' END AS verdict
  FROM part WHERE NOT (p_partkey % 31 = 0 AND p_partkey % 23 <> 0 AND p_partkey % 29 <> 0)"""

_SPACES = "' ' || chr(9) || chr(10) || chr(160) || chr(12288)"


def all_sql() -> dict[str, str]:
    sql: dict[str, str] = {}

    sql["q_recs_pruned"] = (
        _with(EV, CLIENT, SEARCHES, USERS)
        + f"""SELECT user_id, rank, product_id, product_name,
  CASE WHEN m = 1 THEN '{MATCH_REASON}' ELSE '{STOCK_REASON}' END AS reason
FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, available DESC, product_id) AS rank
  FROM (
    SELECT u.user_id, p_partkey AS product_id, p_name AS product_name, p_size AS available,
      CASE WHEN u.query IS NOT NULL AND contains(lower(p_name), lower(u.query)) THEN 1 ELSE 0 END AS m
    FROM users u CROSS JOIN part)) WHERE rank <= 3"""
    )
    sql["q_recommendations"] = (
        _with(
            EV,
            CLIENT,
            """asked AS (
  SELECT user_id, requested_at, request_id, request_type, substr(query, 1, CAST(1 + request_id % 5 AS INT)) AS query
  FROM client)""",
            SEARCHES.replace("FROM client", "FROM asked"),
            USERS.replace("FROM client", "FROM asked"),
            """items AS (
  SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name || ' v3' AS product_name,
    (p_partkey * 7 + 33) % 40 AS available FROM part)""",
        )
        + f"""SELECT CAST(user_id AS VARCHAR) AS user_id, product_id, product_name,
  CASE WHEN m = 1 THEN '{MATCH_REASON}' ELSE '{STOCK_REASON}' END AS reason,
  epoch_us(TIMESTAMP '2024-05-06 07:08:09') AS generated_us
FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, available DESC, product_id) AS rank
  FROM (
    SELECT u.user_id, i.*,
      CASE WHEN u.query IS NOT NULL AND contains(lower(product_name), lower(u.query)) THEN 1 ELSE 0 END AS m
    FROM users u CROSS JOIN items i)) WHERE rank <= 3"""
    )
    sql["q_latest_product"] = """SELECT product_id, updated_us, l_orderkey, l_linenumber, value FROM (
  SELECT l_partkey AS product_id, epoch_us(l_shipdate) AS updated_us, l_orderkey, l_linenumber,
    l_extendedprice AS value, row_number() OVER (PARTITION BY l_partkey
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS n
  FROM lineitem) WHERE n = 1"""
    sql["q_latest_search"] = _with(EV, CLIENT, SEARCHES) + "SELECT user_id, query FROM searches"
    sql["q_users"] = _with(EV, CLIENT, SEARCHES, USERS) + "SELECT user_id, query FROM users"
    sql["q_search"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id, p_name AS name,
  p_retailprice AS price FROM part WHERE p_name ILIKE '%R_d R%'
ORDER BY p_name, CAST(p_partkey AS VARCHAR) LIMIT 20"""
    sql["q_user_recs"] = """SELECT o_custkey AS user_id, o_orderkey AS product_id,
  epoch_us(o_orderdate) AS generated_us FROM orders WHERE o_custkey = 7
ORDER BY o_orderdate DESC, o_orderkey"""

    sql["q_validate"] = f"""SELECT n, verdict,
  CASE WHEN n % 23 = 0 OR n % 29 = 0 THEN NULL WHEN n % 17 = 0 THEN ' ' ELSE id END AS product_id,
  CASE WHEN n % 23 = 0 OR n % 29 = 0 THEN NULL WHEN n % 13 = 0 THEN -1.0 ELSE price END AS amount
FROM ({_MUTATED})"""
    sql["q_json_roundtrip"] = _with(EV, CLIENT) + """SELECT request_id AS n, CAST(user_id AS VARCHAR) AS user_id,
  request_type, coalesce(query, '') AS query, epoch_us(requested_at) AS requested_us FROM client"""
    sql["q_normalize"] = f"""SELECT doc_id, word, 'a|' || lang || '|' || upper(source) AS items FROM (
  SELECT doc_id, lang, source,
    lower(trim(' ' || chr(9) || ' ' || upper(source) || chr(160) || chr(10) || chr(12288), {_SPACES})) AS word
  FROM documents)"""
    base = f"[{_noun('k')}, {_adjective('k')}, {_noun('k')}, '']"
    extra = f"[' ' || {_noun('k + 1')} || chr(9), ' ', {_adjective('k')}]"
    gone = f"[{_noun('k + 1')}, '', {_adjective('k')}]"
    sql["q_array_sets"] = _with(EV) + f"""SELECT event_id,
  array_to_string(list_sort(list_distinct(list_filter(
    list_transform(list_concat({base}, {extra}), lambda x: trim(x, {_SPACES})), lambda x: x <> ''))), '|') AS added,
  array_to_string(list_sort(list_filter({base},
    lambda x: x = '' OR NOT list_contains({gone}, x))), '|') AS removed,
  list_contains({base}, {_noun('k + 2')}) AS held
FROM ev"""

    files = """placed AS (
  SELECT m.*, CAST(n % 3 AS INT) AS part, row_number() OVER (PARTITION BY n % 3 ORDER BY n) AS line FROM mutated m),
told AS (
  SELECT part, line, CASE WHEN verdict LIKE '%declared%' THEN NULL WHEN n % 17 = 0 THEN ' ' ELSE id END AS product_id,
    verdict FROM placed WHERE verdict <> 'blank')"""
    every = _MUTATED[: _MUTATED.index(" WHERE NOT")]
    mutated = f"""mutated AS (
  SELECT n, id, CASE WHEN n % 31 = 0 AND n % 23 <> 0 AND n % 29 <> 0 THEN 'blank' ELSE verdict END AS verdict
  FROM ({every}))"""
    sql["q_product_file"] = f"WITH {mutated}, {files} SELECT * FROM told"
    sql["q_product_stop"] = f"""WITH {mutated}, {files},
ends AS (SELECT part, min(line) AS last FROM told WHERE verdict <> 'ok' GROUP BY part)
SELECT t.part, t.line, CASE WHEN verdict = 'ok' THEN product_id END AS product_id, verdict
FROM told t LEFT JOIN ends e ON t.part = e.part WHERE last IS NULL OR line <= last"""
    sql["q_deny_state"] = _with(EV, DENY) + """SELECT product_id, reason, pos AS blocked_at FROM (
  SELECT *, row_number() OVER (PARTITION BY key ORDER BY seq DESC) AS n FROM deny
  WHERE action IN ('add', 'remove')) WHERE n = 1 AND action = 'add'"""
    sql["q_deny_list"] = _with(EV, DENY) + """SELECT product_id, reason FROM (
  SELECT product_id, arg_max(action, seq) AS action, arg_max(reason, seq) AS reason
  FROM deny GROUP BY product_id) WHERE action = 'add' ORDER BY product_id"""
    sql["q_deny_filter"] = _with(EV, DENY) + """SELECT l_partkey, l_orderkey, l_linenumber FROM lineitem
WHERE l_partkey % 100 NOT IN (
  SELECT key FROM (SELECT key, arg_max(action, seq) AS action FROM deny
    WHERE action IN ('add', 'remove') GROUP BY key) WHERE action = 'add')"""
    sql["q_deny_asof"] = _with(EV, DENY) + """SELECT d.event_id, d.key
FROM (SELECT event_id, k AS key, pos FROM ev WHERE event_type = 'view') d
ASOF LEFT JOIN (SELECT * FROM deny WHERE action IN ('add', 'remove')) c
  ON c.key = d.key AND d.pos >= c.pos
WHERE coalesce(c.action, 'remove') <> 'add'"""
    sql["q_stream_deny"] = sql["q_deny_asof"]

    # Which turn a row comes in, which turn it is judged in, and the commands judged before it.
    sql["q_stream_late"] = "WITH " + EV + """, placed AS (
  SELECT event_id, k || '-' || (event_id % 3) AS key, pos, event_type = 'view' AS is_product,
    CASE event_type WHEN 'signup' THEN true WHEN 'error' THEN false END AS deny,
    (event_id * 4) // (max(event_id) OVER () + 1) AS own FROM ev),
turned AS (
  SELECT *, own + CASE WHEN event_id % 13 = 0 AND own < 3 THEN 1 ELSE 0 END AS turn,
    (pos // 1000000 + 1) * 1000 AS bucket_end FROM placed),
marks AS (
  SELECT turn, max(max(pos)) OVER (ORDER BY turn) // 1000 - 3600000 AS mark FROM turned GROUP BY turn
  UNION ALL SELECT 4, 9000000000000000),
judged AS (
  SELECT t.*, coalesce(bucket_end <= m.mark, false) AS late, (SELECT min(turn) FROM marks f WHERE f.mark >= bucket_end) AS fires
  FROM turned t LEFT JOIN marks m ON m.turn = t.turn - 1),
ordered AS (
  SELECT *, CASE WHEN late THEN 2 * turn ELSE 2 * fires + 1 END AS step FROM judged WHERE is_product OR deny IS NOT NULL)
SELECT event_id, key, late, denied FROM (
  SELECT *, coalesce(arg_max(deny, pos) FILTER (WHERE deny IS NOT NULL) OVER (
    PARTITION BY key ORDER BY step, pos ROWS UNBOUNDED PRECEDING), false) AS denied FROM ordered)
WHERE is_product"""
    sql["q_block_state"] = _with(EV, BLOCK) + """SELECT usr AS user, CAST(max(seq) AS VARCHAR) AS updated_at,
  coalesce(array_to_string(list_sort(list(blocked) FILTER (WHERE is_on)), ','), '') AS blocked
FROM (SELECT usr, blocked, arg_max(is_on, seq) AS is_on, max(seq) AS seq FROM block GROUP BY usr, blocked)
GROUP BY usr"""
    pairs = "(SELECT usr, blocked, arg_max(is_on, seq) AS is_on FROM block GROUP BY usr, blocked)"
    sql["q_block_rows"] = _with(EV, BLOCK) + f"SELECT usr AS user, blocked FROM {pairs} WHERE is_on"
    sql["q_block_pages"] = _with(EV, BLOCK) + f"""SELECT u.usr AS user, blocked, true AS sorted
FROM (SELECT DISTINCT usr FROM block) u LEFT JOIN (SELECT * FROM {pairs} WHERE is_on) p ON u.usr = p.usr"""
    sql["q_word_rows"] = _with(EV, UPDATES) + "SELECT key, word FROM active"
    sql["q_block_filter"] = _with(EV, BLOCK, MESSAGES) + """SELECT message_id, recipient_id, sender_id FROM messages m
WHERE NOT EXISTS (
  SELECT 1 FROM (SELECT usr, blocked, arg_max(is_on, seq) AS is_on FROM block GROUP BY usr, blocked) b
  WHERE b.is_on AND b.usr = m.recipient_id AND b.blocked = m.sender_id)"""
    sql["q_block_asof"] = _with(EV, BLOCK, MESSAGES, _ASOF_BLOCK) + (
        "SELECT message_id, recipient_id, sender_id FROM kept"
    )
    sql["q_word_state"] = _with(EV, UPDATES) + """SELECT h.key, CAST(h.seq AS VARCHAR) AS updated_at,
  coalesce(array_to_string(list_sort(l.words), ','), '') AS words
FROM (SELECT key, max(seq) AS seq FROM known GROUP BY key) h
LEFT JOIN (SELECT key, list(word) AS words FROM active GROUP BY key) l ON h.key = l.key"""
    five = _array(sorted(MASKED))
    sql["q_mask"] = f"SELECT doc_id, {_masked(five)} AS text FROM documents"
    sql["q_mask_turns"] = f"SELECT conv_id, turn, {_masked(five)} AS text FROM conversations"
    sql["q_mask_lookup"] = f"""WITH vocabulary AS (
  SELECT list_sort(list(DISTINCT w)) AS words FROM (
    SELECT unnest(regexp_extract_all(lower(text), '[a-z]{{8,}}')) AS w FROM benchmark))
SELECT doc_id, {_masked('(SELECT words FROM vocabulary)')} AS text FROM documents"""
    sql["q_mask_listed"] = sql["q_mask_lookup"]
    sql["q_mask_join"] = _with(EV, MESSAGES, UPDATES) + f"""SELECT message_id, recipient_id,
  {_masked("coalesce((SELECT list_sort(list(word)) FROM active WHERE key = 'global'), [])")} AS text
FROM messages"""
    sql["q_mask_asof"] = _with(EV, "all_" + MESSAGES, UPDATES) + (
        ", messages AS (SELECT *, 1 AS one FROM all_messages),"
        + _as_of_words("messages")
        + f"""
SELECT m.message_id, {_masked('coalesce(l.words, [])')} AS text
FROM messages m LEFT JOIN lists l ON m.message_id = l.message_id"""
    )
    sql["q_chat"] = _with(EV, BLOCK, MESSAGES, UPDATES, _ASOF_BLOCK) + (
        ","
        + _as_of_words("kept")
        + f"""
SELECT m.message_id, m.recipient_id, m.sender_id, {_masked('coalesce(l.words, [])')} AS text
FROM kept m LEFT JOIN lists l ON m.message_id = l.message_id"""
    )

    sql["q_stream_chat"] = sql["q_chat"]
    sql["q_upsert_products"] = """WITH arrived AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey
      ORDER BY l_orderkey DESC, l_linenumber DESC, l_extendedprice DESC) AS n FROM lineitem) WHERE n = 1)
SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE WHEN l_partkey IS NULL THEN p_name ELSE 'part ' || l_partkey END AS name,
  CAST(CAST(coalesce(l_extendedprice, p_retailprice) AS DECIMAL(14, 2)) AS DOUBLE) AS price,
  coalesce(CAST(l_quantity AS INT), p_size) AS available,
  CASE WHEN l_partkey IS NULL THEN 0 ELSE 1 END AS reserved,
  'sku-' || p_partkey AS data_sku,
  coalesce(epoch_us(l_shipdate), epoch_us(TIMESTAMP '2024-01-01 00:00:00')) AS updated_us
FROM part LEFT JOIN arrived ON l_partkey = p_partkey"""
    merge = """SELECT user_id, product_id, reason, seq FROM (
  SELECT user_id, k AS product_id, event_type AS reason, event_id AS seq,
    row_number() OVER (PARTITION BY user_id, k ORDER BY {order}) AS n
  FROM ev WHERE event_type IN ('view', 'purchase')) WHERE n = 1"""
    sql["q_upsert_recs"] = _with(EV) + merge.format(order="event_type DESC, event_id DESC")
    sql["q_insert_ignore"] = _with(EV) + merge.format(order="event_type, event_id")
    sql["q_stream_upsert"] = _with(EV) + """SELECT user_id, k AS product_id, 'view' AS reason, max(event_id) AS seq
FROM ev WHERE event_type = 'view' GROUP BY user_id, k"""
    sql["q_stream_fold"] = "WITH " + EV + """, arrived AS (SELECT user_id, k AS product_id, event_id AS seq FROM ev
  WHERE event_type = 'view'),
early AS (
  SELECT user_id, product_id, arg_max(seq, (seq % 2, seq)) AS seen FROM arrived
  WHERE seq <= (SELECT max(seq) // 2 FROM arrived) GROUP BY ALL)
SELECT a.user_id, a.product_id, 'view' AS reason,
  arg_max(seq, (seq > (SELECT max(seq) // 2 FROM arrived), seq % 2, seq)) AS seq, any_value(seen) AS seen
FROM arrived a LEFT JOIN early e ON a.user_id = e.user_id AND a.product_id = e.product_id GROUP BY 1, 2"""
    sql["q_stream_requests"] = _with(EV) + """SELECT user_id || ':' || k AS request_id, min(event_id) AS seq
FROM ev GROUP BY 1"""
    sql["q_compact"] = _with(EV, LOG) + """SELECT topic, key, arg_max(value, "offset") AS value,
  max("offset") AS "offset", arg_max(event_id, "offset") AS event_id FROM log GROUP BY topic, key"""
    sql["q_retention"] = _with(EV, LOG, GAPS) + """SELECT topic, partition, "offset", event_id FROM (
  SELECT *, max(epoch_us(ts)) OVER (PARTITION BY topic) AS newest FROM gaps)
WHERE ts IS NULL OR newest - epoch_us(ts) <= 86400000000"""
    sql["q_retain_bytes"] = _with(EV, LOG, GAPS) + """SELECT topic, partition, "offset", event_id FROM (
  SELECT *, sum(coalesce(strlen(value), 0)) OVER (PARTITION BY topic, partition ORDER BY "offset" DESC) AS size FROM gaps)
WHERE size <= 1000"""

    sql["q_archive_ready"] = _with(EV, LOG, NAMED) + """SELECT d.dataset, d.dataset <> 'nothing' AS ready, rows,
  (SELECT count(*) FROM named WHERE topic IN ('products.filtered', 'client.events')) AS lines
FROM (VALUES ('client-events'), ('products'), ('unknown'), ('nothing')) d(dataset)
LEFT JOIN (SELECT CASE topic WHEN 'products.filtered' THEN 'products' WHEN 'client.events' THEN 'client-events'
    ELSE 'unknown' END AS dataset, count(*) AS rows FROM named GROUP BY 1) n ON d.dataset = n.dataset"""
    sql["q_table_rows"] = """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CASE WHEN p_partkey % 5 = 0 THEN 'currency is too long' WHEN p_partkey % 7 = 0 THEN 'amount is out of range'
    ELSE 'stored' END AS verdict FROM part"""
    sql["q_request_ids"] = _with(EV, CLIENT) + """SELECT request_id, substr(sha256(
  '{"user_id":' || user_id || ',"request_type":"' || request_type || '"}'), 1, 32) AS stable_id FROM client"""
    sql["q_connectors"] = _with(EV) + """SELECT 'c' || c AS connector, coalesce(sum(value), 0.0) AS running
FROM range(3) t(c) LEFT JOIN (
  SELECT k % 3 AS c, user_id % 20 AS task, arg_max((event_id % 2)::DOUBLE, pos) AS value FROM ev
  WHERE k % 2 = 0 GROUP BY 1, 2) USING (c) GROUP BY c"""
    sql["q_deny_reason"] = _with(EV, DENY) + """SELECT seq, action,
  CASE WHEN action = 'add' THEN CASE WHEN seq % 3 = 2 THEN reason ELSE 'blocked by operator' END END AS reason,
  CASE WHEN seq % 4 <> 0 THEN 't' || seq ELSE strftime(make_timestamp(pos), '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN pos % 1000000 = 0 THEN '' ELSE '.' || rtrim(printf('%06d', pos % 1000000), '0') END || 'Z' END AS updated_at
FROM deny"""
    sql["q_deny_file"] = _with(EV, DENY) + """SELECT CAST(p_partkey AS VARCHAR) AS product_id,
  CAST(p_partkey % 100 AS VARCHAR) AS key FROM part WHERE p_partkey % 100 NOT IN (
  SELECT product_id FROM (SELECT product_id, arg_max(action, seq) AS action FROM deny GROUP BY 1) WHERE action = 'add')"""
    sql["q_chat_file"] = _with(EV, MESSAGES) + """SELECT recipient_id AS key, CAST(message_id AS VARCHAR) AS message_id,
  sender_id, text, 3 * row_number() OVER (ORDER BY seq) - 1 AS line FROM messages"""

    sql["q_archive"] = _with(EV, LOG, NAMED) + """SELECT event_id, topic, value,
  CASE WHEN suffix(topic, 'products.filtered') THEN 'products'
       WHEN suffix(topic, 'client.events') THEN 'client-events' ELSE 'unknown' END AS dataset
FROM (SELECT * FROM named UNION ALL SELECT * FROM mirrored)"""
    sql["q_stream_archive"] = _with(EV, LOG, NAMED) + """SELECT value, count(*) AS lines,
  CASE topic WHEN 'primary.products.filtered' THEN 'products' ELSE 'client-events' END AS dataset
FROM mirrored GROUP BY ALL"""
    sql["q_mirror"] = _with(EV, LOG, NAMED) + (
        'SELECT topic, partition, "offset", key, event_id FROM mirrored'
    )
    sql["q_publish"] = _with(EV) + """SELECT 'recommendations' AS topic,
  user_id || ':' || CASE WHEN k % 10 <> 0 THEN CAST(k AS VARCHAR) ELSE '' END AS key,
  '{"user_id":"' || user_id || '"' || CASE WHEN k % 10 <> 0 THEN ',"product_id":"' || k || '"' ELSE '' END
  || ',"product_name":"' || event_type || '"' || CASE WHEN k % 2 = 0 THEN '' ELSE ',"reason":"odd"' END
  || '}' AS value FROM ev"""
    sql["q_topic_offsets"] = _with(EV, LOG) + (
        "SELECT topic, CAST(count(*) AS BIGINT) AS total_offsets FROM log GROUP BY topic"
    )
    sql["q_first_records"] = _with(EV, LOG) + """SELECT topic, partition, "offset", event_id FROM log
ORDER BY ts, topic, partition, "offset" LIMIT 500"""
    sql["q_counted"] = _with(EV, LOG) + """SELECT topic, count(*) AS rows, (SELECT count(*) FROM log) AS counted
FROM log GROUP BY topic"""
    sql["q_pretty_records"] = _with(EV, CLIENT) + """SELECT request_id, '{' || chr(10) || '  "request_type" : "' || request_type || '"'
  || CASE WHEN query IS NULL THEN '' ELSE ',' || chr(10) || '  "query" : "' || query || '"' END || chr(10) || '}' AS shown
FROM client"""
    sql["q_lag"] = _with(EV, LOG) + """SELECT 'readers' AS "group", topic, partition, count(*) AS end_offset,
  coalesce(max("offset") FILTER (WHERE k < 50 AND (partition < 2 OR topic <> 'view')) + 1, 0) AS committed,
  count(*) - coalesce(max("offset") FILTER (WHERE k < 50 AND (partition < 2 OR topic <> 'view')) + 1, 0) AS lag
FROM log GROUP BY topic, partition"""
    sql["q_batch_gate"] = _with(EV, LOG) + """SELECT topic, partition, "offset" // 10 AS batch, count(*) AS rows,
  count(*) FILTER (WHERE k % 37 = 0) AS bad, min("offset") AS first_offset, max("offset") AS last_offset,
  count(*) FILTER (WHERE k % 37 = 0) = 0 AS commit, count(*) = 10 AS "full"
FROM log GROUP BY topic, partition, "offset" // 10"""

    sql["q_stream_gate"] = sql["q_batch_gate"]
    sql["q_stream_groups"] = _with(EV, LOG) + """SELECT "group", topic, partition, count(*) AS end_offset,
  CASE "group" WHEN 'late' THEN count(*) ELSE least(count(*), 200) END AS committed,
  CASE "group" WHEN 'late' THEN 0 ELSE count(*) - least(count(*), 200) END AS lag,
  CASE "group" WHEN 'late' THEN count(*) ELSE least(count(*), 200) END AS rows
FROM log, (VALUES ('early'), ('late')) g("group") GROUP BY "group", topic, partition"""
    sql["q_stream_idle"] = _with(EV, LOG) + """SELECT topic, partition, count(*) AS rows, max("offset") AS last
FROM log GROUP BY topic, partition"""
    sql["q_state_rows"] = _with(EV, DENY) + """SELECT CAST(key AS VARCHAR) AS key FROM (
  SELECT key, arg_max(action, seq) AS action FROM deny WHERE action IN ('add', 'remove') GROUP BY key)
WHERE action = 'add'"""
    sql["q_cdc_decode"] = _with(EV, LOG) + """SELECT topic, partition, "offset", key, k % 9 <> 0 AS is_json,
  CASE WHEN k % 9 = 0 THEN 'raw ' || k ELSE '{' || chr(10) || '  "k": ' || k || chr(10) || '}' END AS shown FROM log"""
    sql["q_cdc_state"] = _with(EV) + """SELECT "table", pk, op, seq, row FROM (
  SELECT event_type AS "table", CAST(user_id AS VARCHAR) AS pk, event_id AS seq, props AS row,
    CASE WHEN k % 10 = 0 THEN 'd' WHEN k % 10 < 5 THEN 'u' ELSE 'c' END AS op,
    row_number() OVER (PARTITION BY event_type, user_id ORDER BY event_id DESC) AS n
  FROM ev WHERE event_type IN ('signup', 'purchase')) WHERE n = 1 AND op <> 'd'"""
    sql["q_fk_check"] = """SELECT l_suppkey, count(*) AS rows FROM lineitem
WHERE l_suppkey NOT IN (SELECT s_suppkey FROM supplier WHERE s_acctbal > 0) GROUP BY l_suppkey"""
    sql["q_frame_schema"] = _with(EV) + """SELECT event_id, schema_id, n_name AS schema, body,
  coalesce(header, CASE WHEN n_name IS NULL THEN 'unknown schema id' END, 'ok') AS verdict
FROM (
  SELECT event_id, header,
    CASE WHEN header IS NULL THEN k % 7 END AS schema_id,
    CASE WHEN header IS NULL THEN props END AS body
  FROM (SELECT *, CASE WHEN k % 7 = 0 THEN 'no payload'
      WHEN event_id % 11 = 0 THEN 'unsupported magic byte'
      WHEN event_id % 13 = 0 THEN 'payload is too short' END AS header FROM ev))
LEFT JOIN nation ON n_nationkey = schema_id AND n_nationkey < 6"""
    sql["q_framed_notices"] = _with(EV) + """SELECT printf('event-%03d', event_id - 500) AS event_id,
  printf('event-%03d', event_id - 500) AS decoded_id, 'events' AS source,
  'text é ' || (event_id - 500) AS message, epoch_us(ts) // 1000 AS created_ms FROM ev"""

    sql["q_metric_names"] = _with(EV) + f"""SELECT event_id,
  CASE k % 6 WHEN 0 THEN 'kafka_server_' || event_type || '_' || {_noun('k')} || 'in_total'
    WHEN 1 THEN 'kafka_server_' || event_type || '_' || {_noun('k')}
    WHEN 2 THEN 'kafka_connect_task_error_total_errors'
    WHEN 3 THEN 'kafka_consumer_fetch_manager_records_lag'
    ELSE 'kafka_connect_version_info' END AS metric,
  CASE k % 6 WHEN 0 THEN 'COUNTER' ELSE 'GAUGE' END AS kind,
  CASE k % 6 WHEN 2 THEN 'connector=' || event_type || ',task=' || user_id
    WHEN 3 THEN 'clientId=' || event_type || ',partition=0,topic=t-' || user_id
    WHEN 4 THEN 'clientId=' || event_type || ',version=4.1.2' ELSE '' END AS labels,
  CASE k % 6 WHEN 4 THEN 1.0 ELSE round(value, 4) END AS metric_value
FROM ev WHERE k % 6 <> 5"""
    sql["q_metric_rate"] = _with(EV, JUMPS) + (
        "SELECT event_type, event_id, round(rate, 4) AS rate FROM rates"
    )
    sql["q_metric_sum"] = _with(EV, RATES) + """SELECT CAST(floor(pos / 3600000000) AS BIGINT) AS hour,
  round(sum(rate), 4) AS rate FROM rates GROUP BY 1"""
    sql["q_metric_cluster"] = _with(EV, _rates("event_type, cluster", 86400)) + """SELECT cluster, round(sum(rate), 4) AS rate
FROM (SELECT event_type, cluster, arg_max(rate, (pos, event_id)) AS rate FROM rates GROUP BY 1, 2) GROUP BY cluster"""
    sql["q_metric_latest"] = _with(EV) + """SELECT event_type AS metric, CAST(user_id % 10 AS VARCHAR) AS user,
  CAST(k % 3 AS VARCHAR) AS cluster, arg_max(value, (pos // 86400000000, event_id)) AS value,
  max(pos // 86400000000 * 86400000000) AS at_us
FROM ev GROUP BY 1, 2, 3"""
    sql["q_alert_for"] = _with(EV) + """SELECT event_id, since_us, pos - since_us >= 3600000000 AS firing FROM (
  SELECT *, min(pos) OVER (PARTITION BY event_type, run) AS since_us FROM (
    SELECT *, sum(CASE WHEN value < 30 THEN 0 ELSE 1 END) OVER (
      PARTITION BY event_type ORDER BY pos, event_id) AS run
    FROM (SELECT * REPLACE (pos // 7200000000 * 7200000000 AS pos) FROM ev))
  WHERE value < 30)"""
    sql["q_alerts_flat"] = _with(EV, ALERTS) + f"""SELECT event_id, false AS rejected,
  CASE WHEN copy = 0 THEN status ELSE 'firing' END AS status, alertname,
  CASE WHEN k % 5 <> 0 THEN instance ELSE '' END AS instance,
  CASE WHEN k % 5 <> 0 THEN '' ELSE cluster END AS cluster, {_noun('k')} AS summary
FROM alerts, range(2) t(copy) WHERE k % 17 <> 0
UNION ALL
SELECT event_id, true, NULL, NULL, NULL, NULL, NULL FROM alerts WHERE k % 17 = 0"""
    sql["q_alert_groups"] = _with(EV, ALERTS) + """SELECT alertname, cluster, min(pos) AS first_us,
  max(pos) AS last_us, count(*) AS alerts, count(*) FILTER (WHERE status = 'firing') AS firing,
  count(*) FILTER (WHERE status = 'resolved') AS resolved, count(DISTINCT instance) AS instances
FROM alerts GROUP BY alertname, cluster"""
    sql["q_alert_changes"] = _with(EV, ALERTS) + """SELECT event_id, status, was FROM (
  SELECT event_id, status, lag(status) OVER (
    PARTITION BY alertname, cluster, instance ORDER BY pos // 86400000000, event_id) AS was
  FROM alerts) WHERE status IS DISTINCT FROM was"""
    sql["q_alert_repeats"] = "WITH RECURSIVE " + ",\n".join([EV, ALERTS]) + """,
flagged AS (
  SELECT *, status IS DISTINCT FROM lag(status) OVER (PARTITION BY alertname, cluster ORDER BY pos, event_id) AS changed
  FROM alerts),
runs AS (
  SELECT *, sum(changed::INT) OVER (PARTITION BY alertname, cluster ORDER BY pos, event_id) AS run FROM flagged),
steps AS MATERIALIZED (
  SELECT a.event_id, b.event_id AS next_id FROM (SELECT *, pos + 3600000000 AS due FROM runs) a
  ASOF JOIN runs b ON a.alertname = b.alertname AND a.cluster = b.cluster AND a.run = b.run AND a.due <= b.pos),
chain AS (
  SELECT event_id FROM runs WHERE changed
  UNION ALL
  SELECT s.next_id FROM chain c JOIN steps s ON c.event_id = s.event_id)
SELECT event_id, alertname, cluster, status, changed FROM runs WHERE event_id IN (SELECT event_id FROM chain)"""

    sql["q_gen_orders"] = """SELECT printf('i1-msg-%06d', n) AS message_id, printf('order-%06d', n) AS order_id,
  printf('customer-%02d', n % 5 + 1) AS customer_id, 'i1' AS producer_instance,
  strftime(o_orderdate, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
  ['created', 'validated', 'ready-for-delivery'][CAST(n % 3 + 1 AS INT)] AS status,
  CAST(100 + (n % 9) * 25.5 AS DOUBLE) AS amount
FROM (SELECT o_orderkey + 1 AS n, o_orderdate FROM orders)"""
    sql["q_gen_events"] = """SELECT printf('event-%03d', event_id + 1) AS event_id, 'events' AS source,
  'message #' || (event_id + 1) AS message, epoch_us(ts) // 1000 AS created_ms FROM events"""
    return sql
