"""Column types of the engine's tables, and the closed sets that checks compare with."""

from __future__ import annotations

#: The envelope of an event, as far as landing looks into it.
ENVELOPE = "id string, type string, created bigint, livemode boolean, api_version string, request struct<id: string, idempotency_key: string>"

#: A movement embedded in an event.
EMBEDDED = "id string, amount bigint, fee bigint, net bigint, currency string, available_on bigint, created bigint, status string, type string, reporting_category string, source string"

#: The object of an event. Absent fields are NULL; a reference may be an id or the expanded object.
#: Embedded movements stay text here: a list may mix objects, ids and NULLs, which no one type takes.
OBJECT = (
    "data struct<object: struct<id: string, object: string, amount: bigint, amount_refunded: bigint, refunded: boolean, currency: string, "
    "status: string, charge: string, payment_intent: string, balance_transaction: string, created: bigint, reason: string, "
    "balance_transactions: array<string>>>"
)

FEE_DETAILS = "array<struct<amount: bigint, currency: string, description: string, type: string>>"

#: A line of the processor's movement list.
MOVEMENT_LINE = f"id string, source string, type string, reporting_category string, amount bigint, fee bigint, net bigint, currency string, created bigint, available_on bigint, status string, description string, fee_details {FEE_DETAILS}"

#: A line of the reported balances.
BALANCE_LINE = "date string, currency string, pending bigint, available bigint"

BRONZE_EVENTS = (
    "event_id string, event_type string, created timestamp, livemode boolean, api_version string, request_id string, idempotency_key string, "
    "payload string, kafka_key string, kafka_partition int, kafka_offset bigint, kafka_timestamp timestamp, ingested_at timestamp"
)

SILVER_EVENTS = (
    "event_id string, event_type string, created timestamp, entity_created timestamp, entity_type string, entity_id string, charge_id string, "
    "payment_intent_id string, amount bigint, currency string, status string, balance_transaction_id string, amount_refunded bigint, "
    "refunded boolean, reason string, livemode boolean, api_version string, request_id string, idempotency_key string, payload string, "
    "deliveries int, first_seen_at timestamp, last_seen_at timestamp"
)

MOVEMENT_LIST = (
    "balance_transaction_id string, source_id string, type string, reporting_category string, amount bigint, fee bigint, net bigint, currency string, "
    f"created timestamp, available_on timestamp, status string, description string, fee_details {FEE_DETAILS}, payload string, loaded_at timestamp"
)

REPORTED_BALANCE = "as_of_date date, currency string, pending bigint, available bigint, payload string"

CLOSE_LOG = "run_id string, closed_at timestamp, close_date date, currency string, balance_pending bigint, balance_available bigint, gross_sales bigint, refunds bigint, processing_fees bigint, disputes bigint"

#: Stored tables: columns, and the time column and unit that each is partitioned by.
TABLES: dict[str, tuple[str, str, str]] = {
    "bronze_events": (BRONZE_EVENTS, "ingested_at", "day"),
    "silver_events": (SILVER_EVENTS, "created", "day"),
    "balance_transaction_list": (MOVEMENT_LIST, "created", "day"),
    "reported_balance": (REPORTED_BALANCE, "as_of_date", "month"),
    "daily_close_log": (CLOSE_LOG, "closed_at", "month"),
}

LIST_COLUMNS = ["balance_transaction_id", "source_id", "type", "reporting_category", "amount", "fee", "net", "currency", "created", "available_on", "status", "description", "fee_details", "payload", "loaded_at"]

# Account names of the ledger.
PENDING = "asset:balance_pending"
AVAILABLE = "asset:balance_available"
BANK = "asset:bank"
SALES = "revenue:gross_sales"
REFUNDS = "contra_revenue:refunds"
FEES = "expense:processing_fees"
DISPUTES = "expense:disputes"
UNCLASSIFIED = "expense:unclassified"
#: Accounts that a correct ledger may use; the unclassified one is never accepted.
ACCOUNTS = [PENDING, AVAILABLE, BANK, SALES, REFUNDS, FEES, DISPUTES]

#: Account that takes the other side of a movement of each category but charges.
COUNTERPARTS = {"refund": REFUNDS, "dispute": DISPUTES, "dispute_reversal": DISPUTES, "payout": BANK}
#: Categories that the event stream announces.
ANNOUNCED = ["charge", "refund", "dispute", "dispute_reversal"]
