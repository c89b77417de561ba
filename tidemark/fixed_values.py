"""Word lists, names and constants that results must agree on."""

from __future__ import annotations

# --- fixed values: change events -------------------------------------------------------
UPSERT_OPS = ("c", "u", "r")
DELETE_OP = "d"
KNOWN_OPS = (*UPSERT_OPS, DELETE_OP)
PII_FIELDS = ("shopper_id",)
ENVELOPE_SECTIONS = ("before", "after")
REASON_NULL_OP = "null_op"
REASON_UNEXPECTED_OP = "unexpected_op"

# --- fixed values: payment vocabulary --------------------------------------------------
PAYMENT_METHODS = ("apple_pay", "bank_transfer", "card", "google_pay", "paypal")
PAYMENT_STATUSES = ("authorized", "cancelled", "chargeback", "failed", "pending", "refunded")
AUTHORIZED = "authorized"
CURRENCY_PATTERN = "^[A-Z]{3}$"
COUNTRY_PATTERN = "^[A-Z]{2}$"

# --- fixed values: column contracts (mapped onward, deliberately left out) --------------
CONTRACTS = {
    "payments": (
        (
            "payment_id", "merchant_id", "amount", "currency", "payment_method",
            "payment_status", "country_code", "created_at", "updated_at",
        ),
        ("shopper_id",),
    ),
    "merchants": ((), ("merchant_id", "merchant_name", "country_code", "category", "created_at")),
    "refunds": ((), ("refund_id", "payment_id", "refund_amount", "refund_reason", "created_at")),
}

# --- fixed values: query states --------------------------------------------------------
QUERY_STATES = ("RUNNING", "QUEUED", "BLOCKED", "FINISHED", "FAILED")

# --- fixed values: demo data -----------------------------------------------------------
DEMO_MERCHANTS = (
    (1, "Northwind Fashion", "NL", "fashion"),
    (2, "Blue Harbor Travel", "US", "travel"),
    (3, "Green Basket Foods", "DE", "grocery"),
    (4, "Cedar Health Market", "CA", "health"),
    (5, "Metro Home Studio", "GB", "home"),
    (6, "Sierra Outdoor Co", "US", "outdoors"),
    (7, "Luna Beauty Lab", "FR", "beauty"),
    (8, "Iberia Tech Depot", "ES", "electronics"),
    (9, "Atlas Books", "BE", "books"),
    (10, "Nordic Fitness Works", "NL", "fitness"),
)
# payment_id, merchant_id, shopper_id, amount, currency, method, status, country,
# hours before the base time of created_at and of updated_at
DEMO_PAYMENTS = (
    (1001, 1, 501, "149.99", "EUR", "card", "authorized", "NL", 48, 48),
    (1002, 2, 502, "499.50", "USD", "paypal", "failed", "US", 24, 24),
    (1003, 1, 503, "89.00", "EUR", "card", "authorized", "BE", 12, 12),
    (1004, 3, 504, "44.25", "EUR", "card", "refunded", "DE", 6, 2),
)
# refund_id, payment_id, amount, reason, hours before the base time
DEMO_REFUNDS = ((9001, 1004, "44.25", "duplicate", 1),)
DEMO_SERIES_LENGTH = 120
DEMO_CURRENCIES = ("EUR", "USD", "GBP", "CAD")
DEMO_METHODS = ("card", "paypal", "apple_pay", "bank_transfer", "google_pay")
DEMO_STATUSES = (
    "authorized", "failed", "authorized", "pending",
    "refunded", "authorized", "chargeback", "cancelled",
)
DEMO_COUNTRIES = ("NL", "US", "DE", "BE", "FR", "GB", "CA", "ES")
REFUND_REASONS = ("requested_by_customer", "duplicate", "suspected_fraud", "inventory_shortfall")
REFUND_ID_OFFSET = 9100
