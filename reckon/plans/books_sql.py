"""DuckDB SQL for the queries of ``books``, written from the definitions, not from the operators."""

import re

from reckon.plans.build import COLUMNS


def _in(values: list[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


_CHARGES = """
SELECT entity_id AS charge_id, payment_intent_id, entity_created AS created, amount, currency, status, balance_transaction_id,
       coalesce(amount_refunded, 0) AS amount_refunded, coalesce(refunded, false) AS refunded, event_type AS last_event_type, created AS last_event_at, events
FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY entity_id) AS events FROM silver_events
      WHERE entity_type = 'charge' AND entity_id IS NOT NULL WINDOW w AS (PARTITION BY entity_id ORDER BY created DESC, event_id DESC)) WHERE rn = 1"""


def _latest(entity: str, key: str, cols: str) -> str:
    return f"""
SELECT entity_id AS {key}, charge_id, payment_intent_id, entity_created AS created, {cols}, created AS last_event_at, events
FROM (SELECT *, row_number() OVER w AS rn, count(*) OVER (PARTITION BY entity_id) AS events FROM silver_events
      WHERE entity_type = '{entity}' AND entity_id IS NOT NULL WINDOW w AS (PARTITION BY entity_id ORDER BY created DESC, event_id DESC)) WHERE rn = 1"""


_POSTINGS = """
SELECT concat(balance_transaction_id, ':', e, '|', a) AS posting_id, concat(balance_transaction_id, ':', e) AS entry_id, e AS entry_type,
       balance_transaction_id, source_id, reporting_category, a AS account, x AS amount, currency, t AS posted_at, CAST(t AS DATE) AS posted_on
FROM (
  SELECT *, 'recognition' AS e, 'asset:balance_pending' AS a, net AS x, created AS t FROM balance_transaction_list
  UNION ALL SELECT *, 'recognition', 'expense:processing_fees', fee, created FROM balance_transaction_list WHERE reporting_category = 'charge'
  UNION ALL SELECT *, 'recognition', 'revenue:gross_sales', -amount, created FROM balance_transaction_list WHERE reporting_category = 'charge'
  UNION ALL SELECT *, 'recognition', CASE reporting_category WHEN 'refund' THEN 'contra_revenue:refunds' WHEN 'dispute' THEN 'expense:disputes'
      WHEN 'dispute_reversal' THEN 'expense:disputes' WHEN 'payout' THEN 'asset:bank' ELSE 'expense:unclassified' END, -net, created
    FROM balance_transaction_list WHERE reporting_category <> 'charge'
  UNION ALL SELECT *, 'availability', 'asset:balance_pending', -net, available_on FROM balance_transaction_list
  UNION ALL SELECT *, 'availability', 'asset:balance_available', net, available_on FROM balance_transaction_list)"""

_TRIAL = "SELECT account, currency, CAST(sum(amount) AS BIGINT) AS balance, count(*) AS postings, min(posted_on) AS first_posting_on, max(posted_on) AS last_posting_on FROM ledger_postings GROUP BY ALL"

_FLOW = """
SELECT CASE WHEN x > 0 THEN lo ELSE hi END AS source, CASE WHEN x > 0 THEN hi ELSE lo END AS target, currency, CAST(abs(x) AS BIGINT) AS amount
FROM (SELECT least(s.account, u.account) AS lo, greatest(s.account, u.account) AS hi, u.currency,
             sum(CASE WHEN s.account < u.account THEN u.amount ELSE -u.amount END) AS x
      FROM ledger_postings u JOIN ledger_postings s ON s.entry_id = u.entry_id AND s.currency = u.currency AND s.amount < 0
      WHERE u.amount > 0 GROUP BY ALL) WHERE x <> 0"""

_GRID = """
SELECT CAST(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS close_date, currency
FROM (SELECT min(posted_on) AS a, max(posted_on) AS b FROM ledger_postings), (SELECT DISTINCT currency FROM ledger_postings)"""


def _figure(name: str, account: str, sign: str = "") -> str:
    return f"CAST(coalesce(sum(CASE WHEN account = '{account}' THEN {sign}amount END), 0) AS BIGINT) AS {name}"


_RUN = "CAST(sum({over}) OVER (PARTITION BY currency ORDER BY close_date) AS BIGINT) AS {name}"
_DAILY = f"""
WITH g AS ({_GRID}), d AS (
  SELECT g.close_date, g.currency, {_figure("gross_sales", "revenue:gross_sales", "-")}, {_figure("refunds", "contra_revenue:refunds")},
    {_figure("processing_fees", "expense:processing_fees")}, {_figure("disputes", "expense:disputes")},
    {_figure("pending_movement", "asset:balance_pending")}, {_figure("available_movement", "asset:balance_available")}, {_figure("bank_movement", "asset:bank")}
  FROM g LEFT JOIN ledger_postings p ON p.posted_on = g.close_date AND p.currency = g.currency GROUP BY ALL)
SELECT *, {_RUN.format(over="pending_movement", name="balance_pending")}, {_RUN.format(over="available_movement", name="balance_available")},
  {_RUN.format(over="bank_movement", name="balance_bank")}, {_RUN.format(over="disputes", name="disputes_to_date")}, {_RUN.format(over="refunds", name="refunds_to_date")} FROM d"""

_UNPOSTED = """
SELECT CAST(created AS DATE) AS close_date, currency, CAST(sum(net) AS BIGINT) AS net FROM balance_transaction_list
WHERE balance_transaction_id NOT IN (SELECT balance_transaction_id FROM ledger_postings WHERE balance_transaction_id IS NOT NULL) GROUP BY ALL"""

_WEIGHED = f"""
j AS (
  SELECT coalesce(l.close_date, r.as_of_date) AS close_date, coalesce(l.currency, r.currency) AS currency,
    coalesce(l.balance_pending, 0) AS ledger_pending, coalesce(l.balance_available, 0) AS ledger_available,
    coalesce(r.pending, 0) AS reported_pending, coalesce(r.available, 0) AS reported_available,
    l.close_date IS NOT NULL AS ledger_closed_the_day, r.as_of_date IS NOT NULL AS processor_reported_the_day
  FROM daily_close l FULL JOIN reported_balance r ON l.close_date = r.as_of_date AND l.currency = r.currency
), k AS (
  SELECT j.*, CAST(sum(coalesce(u.net, 0)) OVER (PARTITION BY j.currency ORDER BY j.close_date ROWS UNBOUNDED PRECEDING) AS BIGINT) AS unposted_net
  FROM j LEFT JOIN ({_UNPOSTED}) u ON u.close_date = j.close_date AND u.currency = j.currency
), m AS (
  SELECT *, ledger_pending + ledger_available AS ledger_total, reported_pending + reported_available AS reported_total,
    ledger_pending - reported_pending AS pending_difference, ledger_available - reported_available AS available_difference,
    ledger_pending + ledger_available - reported_pending - reported_available AS total_difference,
    ledger_pending + ledger_available - reported_pending - reported_available + unposted_net AS unexplained_difference FROM k
), weighed AS (
  SELECT *, unexplained_difference - coalesce(lag(unexplained_difference) OVER (PARTITION BY currency ORDER BY close_date), 0) AS unexplained_movement FROM m
)"""

#: pairs: the last two runs, or every run and the one before; a movement is late for the pair it was loaded in.
_RESTATED = """
runs AS (SELECT closed_at AS restated_at, lag(closed_at) OVER (ORDER BY closed_at) AS closed_then FROM (SELECT DISTINCT closed_at FROM daily_close_log)),
pairs AS (SELECT * FROM runs WHERE closed_then IS NOT NULL{only}),
moved AS (
  SELECT DISTINCT n.close_date, n.currency, p.closed_then, p.restated_at, t.balance_pending AS pending_then, n.balance_pending AS pending_now,
    n.balance_pending - t.balance_pending AS pending_movement, t.balance_available AS available_then, n.balance_available AS available_now,
    n.balance_available - t.balance_available AS available_movement
  FROM pairs p JOIN daily_close_log n ON n.closed_at = p.restated_at JOIN daily_close_log t ON t.closed_at = p.closed_then AND t.close_date = n.close_date AND t.currency = n.currency
  WHERE n.balance_pending <> t.balance_pending OR n.balance_available <> t.balance_available
), late AS (
  SELECT l.*, CAST(l.created AS DATE) AS s, CAST(l.available_on AS DATE) AS m, p.closed_then FROM balance_transaction_list l JOIN pairs p ON l.loaded_at > p.closed_then AND l.loaded_at <= {until}
), why AS (
  SELECT d.close_date, d.currency, d.closed_then,
    coalesce(sum(CASE WHEN s <= d.close_date AND m > d.close_date THEN net END), 0) AS p, coalesce(sum(CASE WHEN m <= d.close_date THEN net END), 0) AS a,
    count(*) FILTER (s = d.close_date OR m = d.close_date) AS n
  FROM (SELECT DISTINCT close_date, currency, closed_then FROM moved) d LEFT JOIN late ON late.currency = d.currency AND late.closed_then = d.closed_then GROUP BY ALL
), restated AS (
  SELECT moved.*, CAST(n AS BIGINT) AS late_transactions, CAST(p AS BIGINT) AS late_pending_effect, CAST(a AS BIGINT) AS late_available_effect,
    p = pending_movement AND a = available_movement AS fully_explained_by_what_arrived_late
  FROM moved JOIN why USING (close_date, currency, closed_then)
)"""
_LAST_TWO = _RESTATED.format(only=" AND restated_at = (SELECT max(closed_at) FROM daily_close_log)", until="TIMESTAMP '9999-01-01'")
_EVERY_RUN = _RESTATED.format(only="", until="p.restated_at")

_EXPANDED = """
last_disputes AS (
  SELECT event_id FROM (SELECT event_id, row_number() OVER (PARTITION BY entity_id ORDER BY created DESC, event_id DESC) AS rn FROM silver_events
    WHERE entity_type = 'dispute' AND entity_id IS NOT NULL) WHERE rn = 1
), payloads AS (
  SELECT event_id, payload FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset, payload) AS rn FROM bronze_events
    WHERE event_id IS NOT NULL) WHERE rn = 1
), expanded AS (
  SELECT json_extract_string(t, '$.id') AS balance_transaction_id, json_extract_string(t, '$.source') AS source_id, event_id AS source_event_id,
    json_extract_string(t, '$.type') AS type, json_extract_string(t, '$.reporting_category') AS reporting_category,
    CAST(json_extract(t, '$.amount') AS BIGINT) AS amount, CAST(json_extract(t, '$.fee') AS BIGINT) AS fee, CAST(json_extract(t, '$.net') AS BIGINT) AS net,
    json_extract_string(t, '$.currency') AS currency, CAST(json_extract(t, '$.created') AS BIGINT) AS created,
    CAST(json_extract(t, '$.available_on') AS BIGINT) AS available_on, json_extract_string(t, '$.status') AS status
  FROM (SELECT event_id, unnest(CAST(json_extract(payload, '$.data.object.balance_transactions') AS JSON[])) AS t FROM payloads
        WHERE event_id IN (SELECT event_id FROM last_disputes) AND json_type(payload, '$.data.object.balance_transactions') = 'ARRAY')
  WHERE json_type(t) = 'OBJECT'
)"""

_GAPS = f"""{_EXPANDED}, listed AS (SELECT * FROM balance_transaction_list WHERE reporting_category IN ('charge', 'refund', 'dispute', 'dispute_reversal')
), gaps AS (
  SELECT 'source_missing_from_the_stream' AS finding, balance_transaction_id, source_id, reporting_category, net, currency, CAST(created AS DATE) AS noticed_on
  FROM listed l WHERE NOT EXISTS (SELECT 1 FROM silver_events s WHERE s.entity_type IN ('charge', 'refund', 'dispute') AND s.entity_id = l.source_id)
  UNION ALL SELECT 'transaction_missing_from_the_list', balance_transaction_id, source_id, reporting_category, net, currency, CAST(to_timestamp(created) AT TIME ZONE 'UTC' AS DATE)
  FROM expanded e WHERE NOT EXISTS (SELECT 1 FROM listed l WHERE l.balance_transaction_id = e.balance_transaction_id)
)"""

_COLLAPSED = """
SELECT event_id, event_type, created{more}, CAST(deliveries AS INTEGER) AS deliveries, first_seen_at, last_seen_at FROM (
  SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY kafka_partition, kafka_offset, event_type, created) AS rn, count(*) OVER w AS deliveries,
    min(kafka_timestamp) OVER w AS first_seen_at, max(kafka_timestamp) OVER w AS last_seen_at
  FROM bronze_events WHERE event_id IS NOT NULL{where} WINDOW w AS (PARTITION BY event_id)) WHERE rn = 1"""


def _damaged(sql: str, **tables: str) -> str:
    """A query over the tables as they are and over damaged ones, given as SQL by name."""
    other = sql
    for name in tables:
        other = re.sub(rf"\b{name}\b", f"damaged_{name}", other)
    made = ", ".join(f"damaged_{name} AS ({how})" for name, how in tables.items())
    return f"WITH {made} SELECT 'as they are' AS tables, * FROM ({sql}) UNION ALL SELECT 'damaged' AS tables, * FROM ({other})"


def _lost(table: str, column: str) -> str:
    return f"SELECT * FROM {table} WHERE {column} IS NULL OR NOT starts_with(md5({column}), '0')"


_LOST_POSTINGS = _lost("ledger_postings", "balance_transaction_id")


def _violations(dataset: str, table: str) -> str:
    """Every column check of a dataset, whose rows are a table or a query."""
    not_null, unique, accepted = COLUMNS[dataset]
    counts = [("not_null", c, f"SELECT count(*) FROM t WHERE {c} IS NULL") for c in not_null]
    counts += [("unique", c, f"SELECT count(*) FROM (SELECT {c} FROM t WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) > 1)") for c in unique]
    counts += [("accepted_values", c, f"SELECT count(*) FROM t WHERE {c} NOT IN ({_in(v)})") for c, v in accepted.items()]
    rows = " UNION ALL ".join(f"SELECT '{dataset}' AS dataset, '{k}' AS \"check\", '{c}' AS column_name, CAST(({q}) AS BIGINT) AS violations" for k, c, q in counts)
    return f"SELECT * FROM (WITH t AS (SELECT * FROM {table}) {rows}) WHERE violations > 0"


def _field(name: str, kind: str) -> str:
    return f"CASE WHEN json_type(o, '$.{name}') IN ({kind}) THEN json_extract_string(o, '$.{name}') END"


_TEXT, _WHOLE = "'VARCHAR'", "'UBIGINT', 'BIGINT'"


def _referred(name: str) -> str:
    return f"CASE json_type(o, '$.{name}') WHEN 'OBJECT' THEN json_extract_string(o, '$.{name}.id') WHEN 'VARCHAR' THEN json_extract_string(o, '$.{name}') END"


_TYPED = f"""WITH p AS (SELECT *, CASE WHEN json_valid(payload) THEN json_extract(payload, '$.data.object') END AS o FROM bronze_events)
SELECT event_id, event_type, created, make_timestamp(CAST({_field("created", _WHOLE)} AS BIGINT) * 1000000) AS entity_created,
  coalesce({_field("object", _TEXT)}, split_part(event_type, '.', 1)) AS entity_type, {_field("id", _TEXT)} AS entity_id,
  coalesce({_referred("charge")}, CASE WHEN o->>'$.object' = 'charge' THEN o->>'$.id' END) AS charge_id, {_referred("payment_intent")} AS payment_intent_id,
  CAST({_field("amount", _WHOLE)} AS BIGINT) AS amount, {_field("currency", _TEXT)} AS currency, {_field("status", _TEXT)} AS status,
  {_referred("balance_transaction")} AS balance_transaction_id, CAST({_field("amount_refunded", _WHOLE)} AS BIGINT) AS amount_refunded,
  CAST({_field("refunded", "'BOOLEAN'")} AS BOOLEAN) AS refunded, {_field("reason", _TEXT)} AS reason, livemode, api_version, request_id, idempotency_key,
  kafka_partition, kafka_offset, kafka_timestamp FROM p"""

#: Embedded movements come from the stream as it is; what the list and the typed events lose is damage.
_ALL_GAPS = _damaged(
    f"WITH {_GAPS} SELECT * FROM gaps", balance_transaction_list=_lost("balance_transaction_list", "balance_transaction_id"), silver_events=_lost("silver_events", "entity_id")
).replace("FROM damaged_silver_events\n    WHERE entity_type = 'dispute'", "FROM silver_events\n    WHERE entity_type = 'dispute'")

SQL = {
    "trial_balance": _TRIAL,
    "ledger_postings": _POSTINGS,
    "money_flow": _FLOW,
    "daily_close": _DAILY,
    "day_grid": _GRID,
    "close_log_latest_two": "SELECT closed_at, CAST(row_number() OVER (ORDER BY closed_at DESC) AS INTEGER) AS recency FROM (SELECT DISTINCT closed_at FROM daily_close_log) QUALIFY recency <= 2",
    "restatements": f"WITH {_EVERY_RUN} SELECT * FROM restated",
    "restatement_causes": f"""WITH {_EVERY_RUN} SELECT r.close_date, r.currency, r.restated_at, l.balance_transaction_id, l.net, CASE WHEN l.s = r.close_date THEN 'created' ELSE 'matured' END AS touched_the_day_by
FROM restated r JOIN late l ON l.currency = r.currency AND l.closed_then = r.closed_then AND (l.s = r.close_date OR l.m = r.close_date)""",
    "typed_deliveries": _TYPED,
    "reconciliation": f"WITH {_WEIGHED} SELECT * FROM weighed",
    "reconciliation_items": f"""WITH {_WEIGHED}
SELECT w.close_date, w.currency, w.unexplained_difference, w.unexplained_movement, t.balance_transaction_id, t.source_id, t.reporting_category, t.net,
  CASE WHEN CAST(t.created AS DATE) = w.close_date THEN 'created' ELSE 'matured' END AS touched_the_day_by,
  coalesce(p.n, 0) AS postings, coalesce(p.e, 0) AS entries, coalesce(p.e, 0) <> 2 AS posting_count_is_wrong, t.net = w.unexplained_movement AS net_matches_the_movement
FROM weighed w JOIN balance_transaction_list t ON t.currency = w.currency AND (CAST(t.created AS DATE) = w.close_date OR CAST(t.available_on AS DATE) = w.close_date)
LEFT JOIN (SELECT balance_transaction_id, count(*) AS n, count(DISTINCT entry_id) AS e FROM ledger_postings GROUP BY ALL) p ON p.balance_transaction_id = t.balance_transaction_id
WHERE w.unexplained_movement <> 0""",
    "reconciliation_after_loss": f"WITH damaged AS ({_LOST_POSTINGS}), {_WEIGHED.replace('ledger_postings', 'damaged')} SELECT * FROM weighed",
    "unposted_net": _damaged(_UNPOSTED, ledger_postings=_LOST_POSTINGS),
    "dedup_collapse": _COLLAPSED.format(more=", livemode", where="").replace("event_type, created)", "event_type, created, livemode)"),
    "dedup_upsert_two_batches": f"""WITH a AS ({_COLLAPSED.format(more="", where=" AND day(ingested_at) <= 15")}), b AS ({_COLLAPSED.format(more="", where=" AND day(ingested_at) > 15")})
SELECT coalesce(a.event_id, b.event_id) AS event_id, coalesce(a.event_type, b.event_type) AS event_type, coalesce(a.created, b.created) AS created,
  CAST(coalesce(a.deliveries, 0) + coalesce(b.deliveries, 0) AS INTEGER) AS deliveries, least(a.first_seen_at, b.first_seen_at) AS first_seen_at, greatest(a.last_seen_at, b.last_seen_at) AS last_seen_at
FROM a FULL JOIN b ON a.event_id = b.event_id""",
    "partition_keys": """WITH p AS (SELECT [json_extract(payload, '$.data.object.charge'), json_extract(payload, '$.data.object.payment_intent'), json_extract(payload, '$.data.object.id'),
    json_extract(payload, '$.id')] AS c FROM bronze_events WHERE event_id IS NOT NULL AND json_valid(payload))
SELECT coalesce(list_filter(c, lambda x: json_type(x) = 'VARCHAR' AND json_extract_string(x, '$') <> '')[1]->>'$', 'unknown') AS key, count(*) AS deliveries FROM p GROUP BY 1""",
    "quarantined": "SELECT kafka_partition, kafka_offset, kafka_timestamp, payload FROM bronze_events WHERE event_id IS NULL",
    "redacted_payloads": r"""SELECT event_id, regexp_replace(payload, '("(?:idempotency_key|email|name)"\s*:\s*)"(?:[^"\\]|\\.)*"', '\1""', 'g') AS payload, 0 AS leaks
FROM bronze_events WHERE event_id IS NOT NULL""",
    "charges": _CHARGES,
    "refunds": _latest("refund", "refund_id", "amount, currency, status, balance_transaction_id, reason"),
    "disputes": _latest("dispute", "dispute_id", "amount, currency, status, reason"),
    "expanded_movements": f"WITH {_EXPANDED} SELECT * FROM expanded",
    "coverage_gaps": _ALL_GAPS,
    "cross_check_agreement": f"""WITH {_EXPANDED}, one AS (SELECT balance_transaction_id, max((amount, fee, net)) AS m FROM balance_transaction_list GROUP BY ALL)
SELECT count(*) AS embedded, count(one.m) AS listed, count(*) FILTER (one.m = (e.amount, e.fee, e.net)) AS agreeing FROM expanded e LEFT JOIN one USING (balance_transaction_id)""",
    "disputes_after_their_charge": f"""WITH c AS ({_CHARGES}), d AS ({_latest("dispute", "dispute_id", "amount")})
SELECT d.dispute_id, d.charge_id, d.created AS disputed_at, c.created AS charged_at FROM d JOIN c USING (charge_id) WHERE d.created > c.created""",
    "event_type_counts": "SELECT event_type, count(*) AS n FROM bronze_events GROUP BY ALL ORDER BY n DESC, event_type",
    "distinct_events": "SELECT count(*) AS deliveries, count(DISTINCT event_id) AS events FROM bronze_events",
    "category_totals": "SELECT reporting_category, count(*) AS movements, CAST(sum(net) AS BIGINT) AS net FROM balance_transaction_list GROUP BY ALL",
    "date_checksum": f"SELECT CAST(sum(epoch_us(created) // 1000000) AS BIGINT) AS checksum FROM ({_CHARGES})",
    "latest_reported": "SELECT as_of_date, currency, pending, available FROM reported_balance WHERE as_of_date = (SELECT max(as_of_date) FROM reported_balance)",
    "movement_list_refresh": """SELECT balance_transaction_id, 'settled' AS status, CAST(NULL AS VARCHAR) AS description, any_value(net) AS net,
  CASE WHEN day(min(loaded_at)) <= 15 THEN min(loaded_at) ELSE TIMESTAMP '2027-01-01 00:00:00' END AS loaded_at FROM balance_transaction_list GROUP BY balance_transaction_id""",
    "reported_upsert": """SELECT as_of_date, currency, CASE WHEN day(as_of_date) % 2 = 0 THEN pending + 1 ELSE pending END AS pending, available FROM reported_balance""",
    "half_up_settlement": """SELECT balance_transaction_id, CAST(CASE WHEN net < 0 THEN -((2 * abs(net) * 86 + 100) // 200) ELSE (2 * net * 86 + 100) // 200 END AS BIGINT) AS settled,
  CAST(CAST(created AS DATE) + INTERVAL 7 DAYS AS DATE) AS due_on FROM balance_transaction_list""",
    "entries_balance_check": "SELECT entry_id, currency, CAST(sum(amount) AS BIGINT) AS off_by, count(*) AS postings FROM ledger_postings GROUP BY ALL HAVING sum(amount) <> 0",
    "every_movement_posted_check": _damaged("SELECT balance_transaction_id, reporting_category, net FROM balance_transaction_list l WHERE NOT EXISTS (SELECT 1 FROM ledger_postings p WHERE p.balance_transaction_id = l.balance_transaction_id)", ledger_postings=_LOST_POSTINGS),
    "available_explained_check": _damaged("SELECT close_date, currency, balance_available, disputes_to_date, refunds_to_date FROM daily_close WHERE balance_available < 0 AND disputes_to_date = 0 AND refunds_to_date = 0", daily_close="SELECT * REPLACE (-abs(balance_available) - 1 AS balance_available) FROM daily_close"),
    "unexplained_difference_check": f"WITH {_WEIGHED} SELECT close_date, currency, ledger_total, reported_total, unposted_net, unexplained_difference FROM weighed WHERE unexplained_difference <> 0",
    "same_days_check": f"WITH {_WEIGHED} SELECT close_date, currency, ledger_closed_the_day, processor_reported_the_day FROM weighed WHERE NOT (ledger_closed_the_day AND processor_reported_the_day)",
    "close_uniqueness_check": _damaged("SELECT close_date, currency, count(*) AS occurrences FROM daily_close GROUP BY ALL HAVING count(*) > 1", daily_close="SELECT * FROM daily_close UNION ALL SELECT * FROM daily_close WHERE day(close_date) % 2 = 0"),
    "one_source_check": "SELECT entry_id, currency, count(*) AS source_legs FROM ledger_postings WHERE amount < 0 GROUP BY ALL HAVING count(*) > 1",
    "flow_conservation_check": f"""WITH f AS ({_FLOW}), n AS (SELECT account, currency, sum(x) AS net_flow FROM (SELECT target AS account, currency, amount AS x FROM f UNION ALL SELECT source, currency, -amount FROM f) GROUP BY ALL)
SELECT coalesce(n.account, b.account) AS account, coalesce(n.currency, b.currency) AS currency, CAST(coalesce(net_flow, 0) AS BIGINT) AS net_flow, coalesce(balance, 0) AS balance
FROM n FULL JOIN ({_TRIAL}) b ON b.account = n.account AND b.currency = n.currency WHERE coalesce(net_flow, 0) <> coalesce(balance, 0)""",
    "restatement_explained_check": _damaged(f"WITH {_EVERY_RUN} SELECT close_date, currency, pending_movement, late_pending_effect, available_movement, late_available_effect FROM restated WHERE NOT fully_explained_by_what_arrived_late", balance_transaction_list="SELECT * REPLACE (CAST(NULL AS TIMESTAMP) AS loaded_at) FROM balance_transaction_list"),
    "list_complete_check": f"SELECT * EXCLUDE (finding) FROM ({_ALL_GAPS}) WHERE finding = 'transaction_missing_from_the_list'",
    "stream_complete_check": f"SELECT * EXCLUDE (finding) FROM ({_ALL_GAPS}) WHERE finding = 'source_missing_from_the_stream'",
}

#: Measure, table or query it reads, aggregate.
_MEASURES = [
    ("bronze_deliveries", "bronze_events", "count(*)"), ("bronze_events", "bronze_events", "count(DISTINCT event_id)"), ("silver_events", "silver_events", "count(*)"),
    ("silver_deliveries", "silver_events", "sum(deliveries)"), ("silver_charges", "charges", "count(*)"), ("silver_refunds", "refunds", "count(*)"), ("silver_disputes", "disputes", "count(*)"),
    ("silver_expanded_transactions", "expanded_movements", "count(*)"), ("list_transactions", "balance_transaction_list", "count(*)"), ("reported_days", "reported_balance", "count(*)"),
    ("charges_created_checksum", "charges", "sum(epoch_us(created) // 1000000)"), ("gold_postings", "ledger_postings", "count(*)"), ("gold_entries", "ledger_postings", "count(DISTINCT entry_id)"),
    ("gold_trial_balance", "ledger_postings", "sum(amount)"), ("gold_available", "ledger_postings", "sum(amount) FILTER (account = 'asset:balance_available')"),
    ("gold_close_rows", "daily_close", "count(*)"), ("gold_reconciliation_breaks", "reconciliation", "count(*) FILTER (unexplained_difference <> 0)"),
    ("gold_reconciliation_items", "reconciliation_items", "count(*)"), ("gold_coverage_gaps", "gaps", "count(*)"), ("gold_restatements", "last_restated", "count(*)"),
    ("gold_closes", "daily_close_log", "count(DISTINCT closed_at)"),
]
_MADE = {k: SQL[k] for k in ("charges", "refunds", "disputes", "expanded_movements", "reconciliation", "reconciliation_items")}
_MADE |= {"gaps": f"WITH {_GAPS} SELECT * FROM gaps", "last_restated": f"WITH {_LAST_TWO} SELECT * FROM restated"}
SQL["measurement_report"] = " UNION ALL ".join(f"SELECT '{m}' AS measure, CAST(coalesce((SELECT {a} FROM {f'({_MADE[t]})' if t in _MADE else t}), 0) AS BIGINT) AS value" for m, t, a in _MEASURES)
SQL["streaming_dedup"] = SQL["dedup_collapse"]
SQL["column_checks"] = " UNION ALL ".join(
    _violations(name, table)
    for name, table in {
        "list": "balance_transaction_list", "reported": "reported_balance", "expanded": f"({_MADE['expanded_movements']})", "postings": "ledger_postings", "balances": f"({_TRIAL})",
        "daily_close": "daily_close", "reconciliation": f"({_MADE['reconciliation']})", "money_flow": f"({_FLOW})", "close_log": "daily_close_log", "restatements": f"({SQL['restatements']})",
        "coverage_gaps": f"({_MADE['gaps']})", "reconciliation_items": f"({_MADE['reconciliation_items']})",
    }.items()
)
