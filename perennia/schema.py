"""Names, schemas and fixed vocabulary shared by every module."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values of the event format: event types, verbs and the amount suffix.
CUSTOMER = "CUSTOMER"
SITE_VISIT = "SITE_VISIT"
IMAGE = "IMAGE"
ORDER = "ORDER"
ALL_TYPES = (CUSTOMER, SITE_VISIT, IMAGE, ORDER)
NEW = "NEW"
UPDATE = "UPDATE"
CURRENCY_SUFFIX = " USD"

# Entities whose first event wins and whose verb is never looked at.
FIRST_WINS = (SITE_VISIT, IMAGE)
# Entities created by NEW and replaced by UPDATE.
UPSERTED = (CUSTOMER, ORDER)

# What can become of one event.
APPLIED = "APPLIED"
DUPLICATE_NEW = "DUPLICATE_NEW"
DUPLICATE_KEY = "DUPLICATE_KEY"
UPDATE_WITHOUT_KEY = "UPDATE_WITHOUT_KEY"
INVALID_AMOUNT = "INVALID_AMOUNT"
AMOUNT_OUT_OF_RANGE = "AMOUNT_OUT_OF_RANGE"
INVALID_EVENT_TIME = "INVALID_EVENT_TIME"
IGNORED_TYPE = "IGNORED_TYPE"
IGNORED_VERB = "IGNORED_VERB"
CORRUPT = "CORRUPT"
MISSING = "MISSING_"

# An amount keeps six decimals, so that amounts finer than a cent still add up before rounding, and 22
# digits before the point; a number beyond that has a reason of its own.
AMOUNT = "decimal(28,6)"
# Published, rounded money and ratios.
MONEY = "decimal(24,2)"

CORRUPT_COLUMN = "_corrupt_record"

RAW_FIELDS = (
    "type",
    "verb",
    "key",
    "event_time",
    "customer_id",
    "last_name",
    "adr_city",
    "adr_state",
    "tags",
    "camera_make",
    "camera_model",
    "total_amount",
)

# One raw event. `tags` comes in two JSON shapes, hence STRING: it then receives the raw JSON text.
RAW = T.StructType([T.StructField(name, T.StringType()) for name in RAW_FIELDS])

# Columns an entity row may carry besides its key; a log brings those it has.
CUSTOMER_FIELDS = ("last_name", "adr_city", "adr_state")
FACT_FIELDS = ("customer_id", "event_time", "event_date", "amount", "tags", "camera_make", "camera_model")
PAYLOAD = FACT_FIELDS + CUSTOMER_FIELDS
# What the lifetime value needs of visits and orders.
LTV_FIELDS = ("customer_id", "event_date", "amount")
