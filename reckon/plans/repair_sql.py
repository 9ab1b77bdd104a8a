"""DuckDB SQL for queries p1 to p5, written from the problem statements, not from the operators."""

_LAST = """
WITH ranked AS (
  SELECT *, row_number() OVER (PARTITION BY entity_id ORDER BY created DESC, event_id DESC) AS rn
  FROM silver_events WHERE entity_id IS NOT NULL
)
SELECT {cols} FROM ranked
WHERE rn = 1 AND event_type NOT IN ('customer.deleted', 'payment_method.detached')
"""

_COMMITS = """
commits AS (
  SELECT created, count(DISTINCT event_id) FILTER (side = 'log') AS declared, count(DISTINCT event_id) FILTER (side = 'feed') AS arrived
  FROM (SELECT created, event_id, 'log' AS side FROM bronze_events WHERE event_id IS NOT NULL
        UNION ALL SELECT created, event_id, 'feed' FROM silver_events) GROUP BY created
), told AS (
  SELECT *, row_number() OVER (ORDER BY created NULLS FIRST) AS no, arrived >= declared AS whole FROM commits
), reached AS (
  SELECT coalesce(min(no) FILTER (NOT whole) - 1, max(no), 0) AS watermark FROM told
)"""

_BUFFER = """
arrivals AS (
  SELECT event_id, min(ingested_at) AS arrival, min(created) AS created
  FROM bronze_events WHERE event_id IS NOT NULL GROUP BY event_id
), closed AS (
  SELECT close_date, min(closed_at) AS closed_at FROM daily_close_log
  WHERE close_date IN (SELECT close_date FROM daily_close) GROUP BY close_date
), buffer AS (
  SELECT a.event_id, a.created, c.close_date,
         CASE WHEN arrival <= closed_at THEN 'on_time'
              WHEN arrival <= closed_at + INTERVAL 240 HOURS THEN 'corrected' ELSE 'too_late' END AS status
  FROM arrivals a JOIN closed c ON CAST(a.created AS DATE) = c.close_date
)"""


def _version(name: str, statuses: str) -> str:
    return f"""
{name}_steps AS (
  SELECT *, epoch_us(created) - epoch_us(lag(created) OVER (PARTITION BY close_date ORDER BY created, event_id)) AS step,
         row_number() OVER (PARTITION BY close_date ORDER BY created, event_id) AS f,
         row_number() OVER (PARTITION BY close_date ORDER BY created DESC, event_id DESC) AS l
  FROM buffer WHERE status IN ({statuses})
), {name} AS (
  SELECT close_date, count(*) AS events, max(CASE WHEN f = 1 THEN event_id END) AS first_id,
         max(CASE WHEN l = 1 THEN event_id END) AS last_id,
         CAST(coalesce(max(step), 0) // 1000000 AS BIGINT) AS longest_gap_s
  FROM {name}_steps GROUP BY close_date
)"""


_TREE = """
nodes AS (
  SELECT DISTINCT b.event_id, md5(b.payload) AS doc, t.fullkey, t.path, t.key, t.type, t.value
  FROM (SELECT DISTINCT event_id, payload FROM bronze_events
        WHERE event_id IS NOT NULL AND payload LIKE '%"balance_transaction"%' AND json_valid(payload)) b,
       json_tree(b.payload, '$.data.object') t
), movements AS (
  SELECT event_id, doc, fullkey, value FROM nodes
  WHERE type = 'OBJECT' AND json_extract_string(value, '$.object') = 'balance_transaction'
)"""

#: Labels from the tree: places in order of the nodes' ids; a node closes after its descendants and before its ancestors.
_LABELS = """
docs AS (
  SELECT DISTINCT event_id, payload, md5(payload) AS document FROM bronze_events
  WHERE event_id IS NOT NULL AND payload LIKE '%"balance_transaction"%' AND json_valid(payload)
), raw AS (
  SELECT d.event_id, d.document, t.id, t.parent, t.key, t.type, t.value FROM docs d, json_tree(d.payload, '$.data.object') t
), up AS (
  SELECT event_id, document, id, parent AS above FROM raw WHERE parent IS NOT NULL
  UNION ALL SELECT u.event_id, u.document, u.id, r.parent FROM up u JOIN raw r ON r.event_id = u.event_id AND r.document = u.document AND r.id = u.above WHERE r.parent IS NOT NULL
), depths AS (SELECT event_id, document, id, count(*) AS depth FROM up GROUP BY ALL
), sizes AS (SELECT event_id, document, above AS id, count(*) AS below FROM up GROUP BY ALL
), placed AS (
  SELECT r.*, row_number() OVER (PARTITION BY event_id, document ORDER BY id) - 1 AS pre, coalesce(depth, 0) AS depth, coalesce(below, 0) AS below
  FROM raw r LEFT JOIN depths USING (event_id, document, id) LEFT JOIN sizes USING (event_id, document, id)
), labels AS (
  SELECT n.event_id, n.document, n.pre, n.pre + n.below - n.depth AS post, CAST(n.depth AS INTEGER) AS depth, p.pre AS parent_pre, n.type, n.value,
    CASE WHEN p.type = 'ARRAY' THEN p.key ELSE n.key END AS field, CASE WHEN p.type = 'ARRAY' THEN CAST(n.key AS BIGINT) END AS position
  FROM placed n LEFT JOIN placed p ON p.event_id = n.event_id AND p.document = n.document AND p.id = n.parent
), movements AS (
  SELECT * FROM labels WHERE type = 'OBJECT' AND json_extract_string(value, '$.object') = 'balance_transaction'
)"""


def _long(name: str) -> str:
    return f"CASE WHEN json_type(value, '$.{name}') IN ('BIGINT', 'UBIGINT') THEN CAST(json_extract(value, '$.{name}') AS BIGINT) END AS {name}"


def _string(name: str) -> str:
    return f"json_extract_string(value, '$.{name}') AS {name}"


_LEDGER = """
named AS (SELECT DISTINCT posting_id, account, amount, lower(trim(currency)) AS currency, posted_on FROM ledger_postings),
grid AS (
  SELECT c.currency, CAST(d.day AS DATE) AS as_of_date
  FROM (SELECT DISTINCT currency FROM named) c,
       (SELECT unnest(generate_series((SELECT min(posted_on) FROM named), (SELECT max(posted_on) FROM named), INTERVAL 1 DAY)) AS day) d
), moved AS (
  SELECT currency, posted_on,
         sum(CASE WHEN account = 'asset:balance_pending' THEN amount ELSE 0 END) AS p,
         sum(CASE WHEN account = 'asset:balance_available' THEN amount ELSE 0 END) AS a
  FROM named GROUP BY ALL
), ledger AS (
  SELECT g.as_of_date, g.currency, CAST(coalesce(sum(m.p), 0) AS BIGINT) AS pending, CAST(coalesce(sum(m.a), 0) AS BIGINT) AS available
  FROM grid g LEFT JOIN moved m ON m.currency = g.currency AND m.posted_on <= g.as_of_date GROUP BY ALL
), reported AS (SELECT DISTINCT as_of_date, lower(trim(currency)) AS currency, pending, available FROM reported_balance)"""

_KEPT = """
SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY kafka_timestamp, kafka_partition, kafka_offset) AS rn,
       count(*) OVER (PARTITION BY event_id) AS copies
FROM bronze_events WHERE event_id IS NOT NULL"""

SQL = {
    "p1_found": _LAST.format(cols="entity_id, event_id"),
    "p1_state": _LAST.format(cols="entity_id, event_id, entity_type, amount, currency, status"),
    "p1_watermark": f"""WITH {_COMMITS}
SELECT count(*) AS transactions, count(*) FILTER (whole) AS whole, CAST(coalesce(sum(declared), 0) AS BIGINT) AS declared, CAST(coalesce(sum(arrived), 0) AS BIGINT) AS arrived,
  (SELECT watermark FROM reached) AS watermark, (SELECT max(created) FROM told WHERE no <= (SELECT watermark FROM reached)) AS frontier FROM told""",
    "p2_found": f"WITH {_BUFFER} SELECT event_id, strftime(close_date, '%Y-%m-%d') AS close_date FROM buffer WHERE status = 'corrected'",
    "p2_days": f"""WITH {_BUFFER}, {_version("prov", "'on_time'")}, {_version("fin", "'on_time', 'corrected'")}
SELECT d.close_date, p.events AS provisional_events, p.first_id AS provisional_first_id, p.last_id AS provisional_last_id,
       p.longest_gap_s AS provisional_longest_gap_s, f.events AS final_events, f.first_id AS final_first_id,
       f.last_id AS final_last_id, f.longest_gap_s AS final_longest_gap_s, d.too_late
FROM (SELECT close_date, count(*) FILTER (status = 'too_late') AS too_late FROM buffer GROUP BY close_date) d
LEFT JOIN prov p USING (close_date) LEFT JOIN fin f USING (close_date)""",
    "p3_found": f"""WITH {_TREE}
SELECT DISTINCT event_id, json_extract_string(value, '$.id') AS balance_transaction_id, CAST(unnest(
  CASE WHEN json_type(value, '$.fee_details') = 'ARRAY' AND json_array_length(value, '$.fee_details') > 0
       THEN range(CAST(json_array_length(value, '$.fee_details') AS BIGINT)) ELSE [-1] END) AS BIGINT) AS fee_no
FROM movements""",
    "p3_movements": f"""WITH RECURSIVE {_LABELS}
SELECT event_id, document, pre, post, depth, parent_pre, field, position, json_extract_string(value, '$.id') AS balance_transaction_id,
  {", ".join(map(_string, ("source", "type", "reporting_category")))}, {", ".join(map(_long, ("amount", "fee", "net")))}, {_string("currency")}, {_string("status")} FROM movements""",
    "p3_fee_lines": f"""WITH RECURSIVE {_LABELS}
SELECT f.event_id, f.document, m.pre AS movement_pre, json_extract_string(m.value, '$.id') AS balance_transaction_id, f.pre, f.position AS fee_no,
  {_long("amount").replace("(value", "(f.value")}, {", ".join(_string(c).replace("(value", "(f.value") for c in ("currency", "description", "type"))}
FROM movements m JOIN labels a ON a.event_id = m.event_id AND a.document = m.document AND a.parent_pre = m.pre AND a.field = 'fee_details' AND a.position IS NULL
JOIN labels f ON f.event_id = a.event_id AND f.document = a.document AND f.parent_pre = a.pre AND f.position IS NOT NULL""",
    "p3_events": "SELECT DISTINCT event_id, md5(payload) AS document, event_type, created, livemode, api_version FROM bronze_events WHERE event_id IS NOT NULL",
    "p4_found": f"""WITH {_LEDGER}
SELECT DISTINCT strftime(coalesce(l.as_of_date, r.as_of_date), '%Y-%m-%d') AS as_of_date, coalesce(l.currency, r.currency) AS currency,
  unnest(CASE WHEN l.currency IS NULL THEN ['missing_in_ledger'] WHEN r.currency IS NULL THEN ['missing_in_reported']
    ELSE list_filter([CASE WHEN l.pending IS DISTINCT FROM r.pending THEN 'pending' END,
                      CASE WHEN l.available IS DISTINCT FROM r.available THEN 'available' END], lambda x: x IS NOT NULL) END) AS finding
FROM ledger l FULL JOIN reported r ON l.as_of_date = r.as_of_date AND l.currency = r.currency""",
    "p4_values": f"""WITH {_LEDGER}, j AS (
  SELECT coalesce(l.as_of_date, r.as_of_date) AS d, coalesce(l.currency, r.currency) AS c,
         l.pending AS lp, r.pending AS rp, l.available AS la, r.available AS ra, l.currency IS NOT NULL AS hl, r.currency IS NOT NULL AS hr
  FROM ledger l FULL JOIN reported r ON l.as_of_date = r.as_of_date AND l.currency = r.currency)
SELECT strftime(d, '%Y-%m-%d') AS as_of_date, c AS currency, 'pending' AS field, CAST(lp AS VARCHAR) AS ledger_value, CAST(rp AS VARCHAR) AS reported_value
FROM j WHERE lp IS DISTINCT FROM rp OR hl <> hr
UNION ALL SELECT strftime(d, '%Y-%m-%d'), c, 'available', CAST(la AS VARCHAR), CAST(ra AS VARCHAR) FROM j WHERE la IS DISTINCT FROM ra OR hl <> hr""",
    "p5_found": f"""WITH kept AS ({_KEPT})
SELECT event_id, CAST(kafka_partition AS BIGINT) AS kafka_partition, kafka_offset FROM kept WHERE rn = 1 AND copies > 1""",
    "p5_messages": """WITH kept AS (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY kafka_timestamp NULLS FIRST, kafka_partition NULLS FIRST, kafka_offset NULLS FIRST,
           event_type NULLS FIRST, ingested_at NULLS FIRST) AS rn, count(*) OVER (PARTITION BY event_id) AS n FROM bronze_events)
SELECT event_id, event_type, kafka_timestamp, kafka_partition, kafka_offset, ingested_at, CASE WHEN event_id IS NULL THEN 1 ELSE n END AS copies
FROM kept WHERE rn = 1 OR event_id IS NULL""",
}
SQL["p2_stream"] = SQL["p2_days"]
SQL["p5_shuffled"] = SQL["p5_found"]
