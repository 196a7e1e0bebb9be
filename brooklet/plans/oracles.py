"""The registered queries as SQL over the same tables, for a check by another engine."""

from __future__ import annotations

from ..schemas import CARD_TYPES, EVENT_STATES, SIMPLE_CARD_TYPES, SIMPLE_EVENT_STATES
from .queries import KEYWORDS, LANGUAGES


def _quoted(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _tx(states: dict[str, str], cards: dict[int, str]) -> str:
    state = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in states.items())
    card = " ".join(f"WHEN {k} THEN '{v}'" for k, v in cards.items())
    return f"""
  SELECT CAST(event_id AS VARCHAR) AS transaction_id,
         CASE WHEN digit NOT IN ('0', '1') THEN CAST(user_id * 11 AS INTEGER) END AS customer_id,
         CASE WHEN digit NOT IN ('2', '3')
              THEN CAST((user_id * 7 + event_id % 60) // 10 AS INTEGER) END AS vendor_id,
         CASE event_type {state} END AS event_state,
         ts AS event_timestamp,
         CASE WHEN digit <> '4'
              THEN CAST(CAST(round(value * 100) AS BIGINT) AS VARCHAR) END AS price,
         CASE event_id % 4 {card} END AS card_type
  FROM (SELECT *, substr(props, -2, 1) AS digit FROM events)"""


TX = _tx(
    {"view": "CREATED", "click": "SWIPED", "purchase": "AUTHORIZED", "signup": "INVALID"},
    {0: "Credit", 1: "Debit", 2: "Whatever"},
)
SIMPLE_TX = _tx(
    {"view": "created", "click": "swiped", "purchase": "Created"},
    {0: "Visa", 1: "MasterCard", 2: "visa"},
)
FLAGS = f"""
  SELECT *,
         customer_id IS NOT NULL AND vendor_id IS NOT NULL AND event_timestamp IS NOT NULL
           AS mandatory_fields_exist,
         card_type IN ({_quoted(CARD_TYPES)}) AS valid_card_type,
         event_state IN ({_quoted(EVENT_STATES)}) AS valid_event_state,
         event_timestamp AS parsed_event_timestamp,
         event_timestamp IS NOT NULL AS correct_timestamp_format
  FROM tx"""
CHECKED = """
  SELECT *, mandatory_fields_exist AND valid_card_type AND valid_event_state
            AND correct_timestamp_format AS valid_record
  FROM flags"""
WITH_CHECKED = f"WITH tx AS ({TX}), flags AS ({FLAGS}), checked AS ({CHECKED})"
COLUMNS = "transaction_id, customer_id, vendor_id, event_state, event_timestamp, price, card_type"

CUSTOMERS = """
  SELECT CAST(c_custkey AS INTEGER) AS customer_id, c_name AS first_name,
         c_mktsegment AS last_name, CAST(c_nationkey + 2 AS INTEGER) AS state_id,
         TIMESTAMP '2018-01-01 00:00:00' + to_seconds(c_custkey) AS update_timestamp
  FROM customer"""
VENDORS = """
  SELECT CAST(s_suppkey AS INTEGER) AS vendor_id, s_name AS vendor_name,
         '+1-' || lpad(CAST(s_nationkey AS VARCHAR), 3, '0') AS phone_number,
         TIMESTAMP '2018-01-01 00:00:00' + to_seconds(s_suppkey) AS update_timestamp
  FROM supplier"""

VALID = f"{WITH_CHECKED} SELECT {COLUMNS} FROM checked WHERE valid_record"
INVALID = f"{WITH_CHECKED} SELECT {COLUMNS} FROM checked WHERE NOT valid_record"
UNDECIDED = f"{WITH_CHECKED} SELECT {COLUMNS} FROM checked WHERE valid_record IS NULL"
CUSTOMER_ORPHANS = f"""{WITH_CHECKED}
SELECT DISTINCT customer_id, 'Unknown' AS first_name, 'Unknown' AS last_name, -1 AS state_id
FROM checked
WHERE valid_record AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id)"""
VENDOR_ORPHANS = f"""{WITH_CHECKED}
SELECT DISTINCT vendor_id, 'Unknown' AS vendor_name, 'Unknown' AS phone_number
FROM checked
WHERE valid_record AND NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey = vendor_id)"""
CUSTOMERS_ENRICHED = f"""WITH c AS ({CUSTOMERS})
SELECT customer_id, first_name, last_name, n_name AS state_name,
       'R' || CAST(n_regionkey AS VARCHAR) AS state_abbreviation, update_timestamp
FROM c LEFT JOIN nation ON n_nationkey = state_id"""
SIMPLE = f"""WITH tx AS ({SIMPLE_TX}), c AS ({CUSTOMERS})
SELECT {", ".join("tx." + c for c in COLUMNS.split(", "))},
       first_name AS customer_first_name, last_name AS customer_last_name,
       card_type IN ({_quoted(SIMPLE_CARD_TYPES)})
         AND event_state IN ({_quoted(SIMPLE_EVENT_STATES)}) AS is_valid
FROM tx LEFT JOIN c ON c.customer_id = tx.customer_id"""
WINDOWS = """SELECT date_trunc('minute', ts) AS start_ts,
       date_trunc('minute', ts) + INTERVAL 1 MINUTE AS end_ts,
       count(*) AS num_transactions
FROM events GROUP BY ALL"""
CLOSED_WINDOWS = f"""SELECT * FROM ({WINDOWS})
WHERE end_ts <= (SELECT max(ts) FROM events) - INTERVAL 10 SECOND"""

RICH = f"""{WITH_CHECKED}, known AS (
  SELECT *, customer_id IN (SELECT c_custkey FROM customer) AS known_customer,
         vendor_id IN (SELECT s_suppkey FROM supplier) AS known_vendor
  FROM checked)
SELECT date_trunc('minute', event_timestamp) AS start_ts,
       date_trunc('minute', event_timestamp) + INTERVAL 1 MINUTE AS end_ts,
       count(*) AS num_transactions,
       CAST(sum(CAST(price AS DECIMAL(20,4))) AS DOUBLE) / count(price) AS avg_price,
       count(*) FILTER (WHERE valid_record) AS num_valid,
       count(*) FILTER (WHERE NOT valid_record) AS num_invalid,
       count(*) FILTER (WHERE valid_record IS NULL) AS num_undecided,
       count(*) FILTER (WHERE valid_record AND NOT known_customer) AS num_customer_orphans,
       count(*) FILTER (WHERE valid_record AND NOT known_vendor) AS num_vendor_orphans
FROM known GROUP BY ALL"""

SCHEMA_ROWS = """
  SELECT p_partkey AS "offset", CAST(p_partkey % 7 + p_size * 2 AS INTEGER) AS id,
         p_type AS name, p_size AS version,
         '{"type": "record", "name": "' || replace(p_brand, '#', '_')
           || '", "fields": [{"name": "size", "type": "int"}]}' AS avro_schema,
         '{"name":"' || replace(p_brand, '#', '_')
           || '","type":"record","fields":[{"name":"size","type":"int"}]}' AS parsing_form
  FROM part"""


def _last_schema(key: str) -> str:
    return f"""WITH s AS ({SCHEMA_ROWS})
SELECT id, name, version, avro_schema, parsing_form FROM s
QUALIFY row_number() OVER (PARTITION BY {key} ORDER BY "offset" DESC) = 1"""


ACT_MESSAGES = """
  SELECT event_id AS "offset", event_type, user_id AS visitor, strftime(ts, '%Y-%m-%d') AS day,
         CAST(CASE event_type WHEN 'view' THEN 12 WHEN 'purchase' THEN 21 WHEN 'signup' THEN 44 ELSE 30 END
              AS INTEGER) AS schema_id,
         CASE WHEN event_id % 5 <> 0 THEN CAST(round(value * 100) AS INTEGER) END AS cents
  FROM events"""


ORACLES: dict[str, str] = {
    "registry_rejects": """SELECT event_id AS "offset",
       CASE event_type WHEN 'click' THEN 'not JSON' WHEN 'signup' THEN 'no id' ELSE 'no value' END AS reason
FROM events WHERE event_type IS DISTINCT FROM 'view'""",
    "lifecycle_unplaced": """WITH e AS (
  SELECT event_id, CASE WHEN event_id % 7 <> 0 THEN user_id END AS u, CASE WHEN event_id % 5 <> 0 THEN ts END AS t
  FROM events)
SELECT event_id, CASE WHEN u IS NOT NULL AND t IS NOT NULL
  THEN row_number() OVER (PARTITION BY u, t IS NULL ORDER BY t, event_id) END AS step
FROM e""",
    "valid_transactions": VALID,
    "invalid_transactions": INVALID,
    "undecided_transactions": UNDECIDED,
    "validation_flags": f"{WITH_CHECKED} SELECT * FROM checked",
    "text_timestamp_flags": f"""WITH tx AS ({TX}), t AS (
  SELECT transaction_id,
         CASE WHEN price IS NOT NULL THEN strftime(event_timestamp, '%Y-%m-%d')
              ELSE event_state END AS event_timestamp
  FROM tx)
SELECT *, event_timestamp IS NOT NULL AS mandatory_fields_exist,
       try_strptime(event_timestamp, '%Y-%m-%d') AS parsed_event_timestamp,
       try_strptime(event_timestamp, '%Y-%m-%d') IS NOT NULL AS correct_timestamp_format,
       event_timestamp IS NOT NULL
         AND try_strptime(event_timestamp, '%Y-%m-%d') IS NOT NULL AS valid_record
FROM t""",
    "transaction_routes": f"""{WITH_CHECKED}
SELECT CASE WHEN valid_record IS NULL THEN 'undecided' WHEN valid_record THEN 'valid'
            ELSE 'invalid' END AS route, count(*) AS num_rows
FROM checked GROUP BY ALL""",
    "customer_orphans": CUSTOMER_ORPHANS,
    "vendor_orphans": VENDOR_ORPHANS,
    "customers_enriched": CUSTOMERS_ENRICHED,
    "vendors_passthrough": VENDORS,
    "transactions_enriched_simple": SIMPLE,
    "ops_metadata_1min": WINDOWS,
    "ops_metadata_simple": WINDOWS,
    "ops_metadata_rich": RICH,
    "table_count_audit": f"""SELECT 'valid_transactions' AS table_name, count(*) AS num_rows FROM ({VALID})
UNION SELECT 'invalid_transactions', count(*) FROM ({INVALID})
UNION SELECT 'customer_orphans', count(*) FROM ({CUSTOMER_ORPHANS})
UNION SELECT 'vendor_orphans', count(*) FROM ({VENDOR_ORPHANS})
UNION SELECT 'transactions_operational_metadata', count(*) FROM ({WINDOWS})""",
    "json_parse": f"""WITH tx AS ({TX})
SELECT *, event_timestamp + INTERVAL 1 SECOND AS "timestamp" FROM tx""",
    "json_message_time": f"""WITH tx AS ({TX})
SELECT *, event_timestamp AS "timestamp" FROM tx""",
    "json_malformed": """SELECT CASE WHEN event_type <> 'error' THEN CAST(event_id AS VARCHAR) END AS transaction_id,
       '{"transaction_id":"' || event_id || CASE WHEN event_type <> 'error' THEN '"}' ELSE '' END AS raw
FROM events""",
    "json_roundtrip": f"""WITH tx AS ({TX})
SELECT * REPLACE (date_trunc('second', event_timestamp) AS event_timestamp) FROM tx""",
    "message_text": "SELECT text AS value FROM documents",
    "message_records": """SELECT conv_id * 1000 + turn AS "offset", role AS key, text AS value
FROM conversations""",
    "csv_payload": """SELECT CAST(event_id AS VARCHAR) AS key, date_trunc('millisecond', ts) AS seen_at,
       CASE WHEN event_type <> 'error' THEN value END AS lat,
       CASE WHEN event_type <> 'click' THEN CAST(user_id - 90 AS DOUBLE) END AS lon
FROM events""",
    "nth_field": """SELECT doc_id AS "offset", string_split(text, ',')[5] AS field FROM documents""",
    "keyword_lang_filter": f"""SELECT doc_id, lang, source FROM documents
WHERE lang IN ({_quoted(LANGUAGES)})
  AND regexp_matches(text, '{"|".join(KEYWORDS)}', 'i')""",
    "static_json_table": CUSTOMERS,
    "upsert_latest": """SELECT user_id, event_id, event_type, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY ts DESC, event_id DESC, event_type DESC, value DESC) = 1""",
    "upsert_log": """SELECT user_id, event_id, event_type, value, ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id
  ORDER BY list_position(['signup', 'error', 'view', 'click', 'purchase'], event_type) DESC,
           ts DESC, event_id DESC, value DESC) = 1""",
    "offload_old_months": """WITH s AS (
  SELECT DISTINCT l_shipdate, l_orderkey, l_linenumber,
         CASE WHEN l_shipdate < TIMESTAMP '1999-01-01' THEN 'files' ELSE 'table' END AS place
  FROM lineitem)
SELECT place, count(*) AS num_rows, min(l_shipdate) AS first_day, max(l_shipdate) AS last_day
FROM s GROUP BY place""",
    "transaction_lifecycle": """WITH t AS (
  SELECT CAST(l_orderkey AS VARCHAR) AS transaction_id, l_shipdate AS event_timestamp,
         l_returnflag || '_' || l_linestatus AS event_state, l_linenumber AS line,
         l_partkey AS part_id, CAST(l_suppkey AS INTEGER) AS vendor_id
  FROM lineitem)
SELECT *, row_number() OVER (PARTITION BY transaction_id
  ORDER BY event_timestamp, event_state, line, part_id, vendor_id) AS step
FROM t""",
    "reprocess_fixed": f"""{WITH_CHECKED}, again AS (
  SELECT {COLUMNS} FROM checked
  UNION ALL
  SELECT transaction_id, customer_id, vendor_id, coalesce(event_state, 'CREATED'),
         event_timestamp, price, coalesce(card_type, 'Credit')
  FROM checked WHERE valid_record IS NULL)
SELECT {COLUMNS} FROM again
WHERE customer_id IS NOT NULL AND vendor_id IS NOT NULL AND event_timestamp IS NOT NULL
  AND card_type IN ({_quoted(CARD_TYPES)}) AND event_state IN ({_quoted(EVENT_STATES)})""",
    "registry_latest": _last_schema("id"),
    "registry_by_version": _last_schema("name, version"),
    "registry_by_form": _last_schema("parsing_form"),
    "registry_list": f"SELECT * FROM ({_last_schema('id')}) WHERE name = 'ECONOMY'",
    "registry_match": f"""WITH last AS ({_last_schema('parsing_form')})
SELECT p_partkey, id, name, version
FROM part LEFT JOIN last
  ON parsing_form = '{{"name":"' || replace(p_brand, '#', '_')
     || '","type":"record","fields":[{{"name":"size","type":"int"}}]}}'""",
    "registry_next_id": """WITH used AS (
  SELECT CAST(p_partkey + CASE WHEN p_partkey >= 90 THEN 10 ELSE 0 END AS INTEGER) AS id FROM part),
free AS (SELECT 0 AS id UNION SELECT id + 1 FROM used EXCEPT SELECT id FROM used)
SELECT CAST(min(id) AS INTEGER) AS next_id FROM free""",
    "envelope_split": f"""WITH m AS ({ACT_MESSAGES})
SELECT "offset", schema_id,
       CASE event_type
         WHEN 'error' THEN '{{"kind":"error'
         WHEN 'view' THEN '{{"kind":"view","cents":' || coalesce(cents, 0) || ',"day":"' || day || '"}}'
         WHEN 'purchase' THEN '{{' || coalesce('"cents":' || cents || ',', '') || '"visitor":' || visitor || ',"grade":"fine"}}'
         ELSE '{{"kind":"' || event_type || '"' || coalesce(',"cents":' || cents, '') || ',"visitor":' || visitor || '}}' END AS body
FROM m""",
    "decode_user_v2": f"""WITH m AS ({ACT_MESSAGES})
SELECT "offset", event_type AS kind, cents, visitor FROM m WHERE event_type = 'click'""",
    "decode_user_v3": f"""WITH m AS ({ACT_MESSAGES})
SELECT "offset", CASE WHEN event_type = 'view' THEN coalesce(cents, 0) ELSE cents END AS cents,
       CASE WHEN event_type = 'view' THEN -1 ELSE visitor END AS visitor,
       CASE WHEN event_type = 'purchase' THEN 'fine' ELSE 'plain' END AS grade
FROM m WHERE event_type IN ('view', 'click', 'purchase')""",
    "decode_rejects": f"""WITH m AS ({ACT_MESSAGES})
SELECT "offset", schema_id,
       CASE event_type WHEN 'view' THEN 'field visitor has no default'
                       WHEN 'purchase' THEN 'field kind has no default'
                       WHEN 'signup' THEN 'unknown schema id'
                       ELSE 'unreadable body' END AS reason
FROM m WHERE event_type IN ('view', 'purchase', 'signup', 'error')""",
    "decode_waiting_stream": f"""WITH m AS ({ACT_MESSAGES})
SELECT "offset", schema_id,
       CASE WHEN event_type = 'click' THEN visitor END AS visitor,
       CASE WHEN event_type = 'click' THEN cents END AS cents,
       CASE event_type WHEN 'view' THEN 'field visitor has no default'
                       WHEN 'purchase' THEN 'field kind has no default'
                       WHEN 'signup' THEN 'unknown schema id'
                       WHEN 'error' THEN 'unreadable body' END AS reason
FROM m WHERE event_type <> 'signup' OR "offset" % 4 < 2""",
    "decode_two_names": f"""WITH m AS ({ACT_MESSAGES})
SELECT "offset", 'act' AS name, visitor, cents, CAST(NULL AS VARCHAR) AS brand, CAST(NULL AS BIGINT) AS size
FROM m WHERE event_type = 'click'
UNION ALL SELECT p_partkey, 'brand', NULL, NULL, p_brand, CAST(p_size AS BIGINT) FROM part""",
    "dedup_by_id": f"WITH tx AS ({TX}) SELECT DISTINCT * FROM tx",
    "valid_transactions_stream": VALID,
    "invalid_transactions_stream": INVALID,
    "customer_orphans_stream": CUSTOMER_ORPHANS,
    "vendor_orphans_stream": VENDOR_ORPHANS,
    "customers_stream": CUSTOMERS_ENRICHED,
    "vendors_stream": VENDORS,
    "ops_metadata_stream": WINDOWS,
    "ops_metadata_rich_stream": RICH,
    "ops_metadata_append_stream": CLOSED_WINDOWS,
    "shared_pass_stream": f"""SELECT 'valid_transactions' AS table_name, count(*) AS num_rows FROM ({VALID})
UNION SELECT 'invalid_transactions', count(*) FROM ({INVALID})
UNION SELECT 'customer_orphans', count(*) FROM ({CUSTOMER_ORPHANS})
UNION SELECT 'vendor_orphans', count(*) FROM ({VENDOR_ORPHANS})""",
    "simple_transactions_stream": SIMPLE,
    "message_files_stream": f"""SELECT * REPLACE (date_trunc('second', event_timestamp) AS event_timestamp)
FROM ({VALID})""",
    "csv_sink_stream": f"SELECT * REPLACE (date_trunc('millisecond', event_timestamp) AS event_timestamp) FROM ({VALID})",
    "dedup_by_id_stream": CLOSED_WINDOWS,
    "ops_metadata_simple_stream": WINDOWS,
    "live_customers_stream": f"""{WITH_CHECKED}
SELECT DISTINCT customer_id, 'Unknown' AS first_name, 'Unknown' AS last_name, -1 AS state_id
FROM checked
WHERE valid_record AND NOT EXISTS (
  SELECT 1 FROM customer
  WHERE c_custkey = customer_id AND (c_custkey % 3 <> 0 OR CAST(transaction_id AS BIGINT) % 4 >= 2))""",
    "orphan_first_seen_stream": f"""{WITH_CHECKED}
SELECT customer_id, TIMESTAMP '2024-01-01 00:00:00' + to_hours(min(CAST(transaction_id AS BIGINT) % 4)) AS update_timestamp
FROM checked
WHERE valid_record AND NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = customer_id)
GROUP BY customer_id""",
    "table_count_audit_commits": f"""SELECT 'valid_transactions' AS table_name, count(*) AS num_rows FROM ({VALID})
UNION SELECT 'invalid_transactions', count(*) FROM ({INVALID})
UNION SELECT 'customer_orphans', count(*) FROM ({CUSTOMER_ORPHANS})
UNION SELECT 'vendor_orphans', count(*) FROM ({VENDOR_ORPHANS})""",
    "day_lookup": """
SELECT CAST(l_shipdate AS TIMESTAMP) AS l_shipdate, l_orderkey, CAST(l_linenumber AS INTEGER) AS l_linenumber, CAST(l_quantity AS DOUBLE) AS l_quantity
FROM lineitem
WHERE l_shipdate BETWEEN DATE '1995-03-10' AND DATE '1995-03-14'""",
}
